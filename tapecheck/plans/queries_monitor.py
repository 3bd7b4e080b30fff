"""Alert rules and dashboard series. The derived samples are minutes apart, so windows, steps and
holding times are hours here; all of them are parameters of the operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from tapecheck.functions.timecols import epoch_ms, wall_clock
from tapecheck.operators import monitor as mo, ordering as od
from tapecheck.plans import sqlparts as s
from tapecheck.plans.catalog import query
from tapecheck.plans.queries_ordering import _quantile_sql
from tapecheck.settings import HOUR_MS
from tapecheck.sources import derived as dv
from tapecheck.sources.derived_metrics import METRICS, metric, metric_samples

STEP, WINDOW, FOR = HOUR_MS // 2, 2 * HOUR_MS, HOUR_MS
LOOKBACK = 3 * HOUR_MS


def _m(spark, d, name):
    return metric(dv.events_trades(spark, d), name)


# --- SQL side -----------------------------------------------------------------------------

def _samples(name: str, cte: str) -> str:
    labels, value = METRICS[name]
    cols = ", ".join(f"CAST({e.replace(' div ', ' // ')} AS VARCHAR) AS {k}" for k, e in labels.items())
    return (
        f"{cte} AS (SELECT event_id, ingest_ms AS ts_ms, (ingest_ms + {STEP - 1}) // {STEP} * {STEP} AS eval_ms, {cols}, "
        f"CAST({value.replace(' div ', ' // ')} AS DOUBLE) AS value FROM trades)"
    )


def _increase(name: str, cte: str, by: list[str], window: int = WINDOW) -> list[str]:
    series = ", ".join(METRICS[name][0])
    keys = by or ["scope"]
    k = ", ".join(keys)
    first = "" if by else "'all' AS scope, "
    on = " AND ".join(f"g.{x} = p.{x}" for x in keys)
    return [
        _samples(name, f"{cte}_s"),
        f"""{cte}_p AS (SELECT {first}{', '.join(by) + ', ' if by else ''}eval_ms, sum(CASE WHEN pv IS NULL THEN 0 WHEN value < pv THEN value ELSE value - pv END) AS gain
  FROM (SELECT *, lag(value) OVER (PARTITION BY {series} ORDER BY ts_ms, event_id) AS pv FROM {cte}_s) GROUP BY {k}, eval_ms)""",
        f"""{cte}_g AS (SELECT {k}, unnest(generate_series((SELECT min(eval_ms) FROM {cte}_p), (SELECT max(eval_ms) FROM {cte}_p), {STEP})) AS eval_ms
  FROM (SELECT DISTINCT {k} FROM {cte}_p))""",
        f"""{cte} AS (SELECT {', '.join('g.' + x for x in keys)}, g.eval_ms, coalesce(sum(p.gain), 0) AS increase
  FROM {cte}_g g LEFT JOIN {cte}_p p ON {on} AND p.eval_ms > g.eval_ms - {window} AND p.eval_ms <= g.eval_ms GROUP BY ALL)""",
    ]


def _level(name: str, cte: str) -> list[str]:
    keys = list(METRICS[name][0])
    k = ", ".join(keys)
    return [
        _samples(name, f"{cte}_s"),
        f"{cte}_p AS (SELECT {k}, eval_ms, arg_max(value, (ts_ms, event_id)) AS v, max(ts_ms) AS at_ms FROM {cte}_s GROUP BY {k}, eval_ms)",
        f"""{cte}_g AS (SELECT {k}, unnest(generate_series((SELECT min(eval_ms) FROM {cte}_p), (SELECT max(eval_ms) FROM {cte}_p), {STEP})) AS eval_ms
  FROM (SELECT DISTINCT {k} FROM {cte}_p))""",
        f"""{cte} AS (SELECT {', '.join('g.' + x for x in keys)}, g.eval_ms, arg_max(p.v, p.eval_ms) AS level
  FROM {cte}_g g JOIN {cte}_p p ON {' AND '.join(f'g.{x} = p.{x}' for x in keys)} AND p.eval_ms <= g.eval_ms AND p.at_ms > g.eval_ms - {LOOKBACK}
  GROUP BY ALL)""",
    ]


def _firing(evals: str, keys: list[str], cond: str, out: str = "firing") -> list[str]:
    part = f"PARTITION BY {', '.join(keys)}" if keys else ""
    return [
        f"{out}_e AS (SELECT *, coalesce({cond}, false) AS ok FROM {evals})",
        f"""{out}_w AS (SELECT *, coalesce(max(CASE WHEN NOT ok THEN eval_ms END) OVER w + {STEP}, min(eval_ms) OVER w) AS since_ms
  FROM {out}_e WINDOW w AS ({part} ORDER BY eval_ms ROWS UNBOUNDED PRECEDING))""",
        f"{out} AS (SELECT * FROM {out}_w WHERE ok AND eval_ms - since_ms >= {FOR})",
    ]


def _alert(name: str, severity: str, keys: list[str], firing: str = "firing") -> str:
    labels = " || ',' || ".join(f"'{k}=' || {k}" for k in keys) or "''"
    k = "".join(f"{x}, " for x in keys)
    return f"""SELECT '{name}' AS alert, '{severity}' AS severity, {labels} AS labels, {s.ms_ts('a')} AS fired_from, {s.ms_ts('b')} AS fired_to, evaluations
  FROM (SELECT {k}since_ms, min(eval_ms) AS a, max(eval_ms) AS b, count(*) AS evaluations FROM {firing} GROUP BY {k}since_ms)"""


# --- samples and primitives ---------------------------------------------------------------

@query(
    "src8_metric_samples",
    s.with_(
        [s.TRADES],
        " UNION ALL ".join(
            f"SELECT {s.ms_ts('ingest_ms')} AS ts, '{n}' AS metric, "
            + " || ',' || ".join(f"'{k}=' || CAST({e.replace(' div ', ' // ')} AS VARCHAR)" for k, e in labels.items())
            + f" AS series, CAST({v.replace(' div ', ' // ')} AS DOUBLE) AS value FROM trades"
            for n, (labels, v) in METRICS.items()
        ),
    ),
)
def _(spark, d):
    series = F.array_join(F.transform(F.map_entries("labels"), lambda e: F.concat(e["key"], F.lit("="), e["value"])), ",")
    return metric_samples(dv.events_trades(spark, d)).select("ts", "metric", series.alias("series"), "value")


@query("mon0_counter_increase", s.with_([s.TRADES, *_increase("trades_total", "x", ["instance"])], f"SELECT instance, {s.ms_ts('eval_ms')} AS ts, increase FROM x"))
def _(spark, d):
    x = mo.increase(_m(spark, d, "trades_total"), ["instance"], ["instance"], STEP, WINDOW, "event_id")
    return x.select("instance", wall_clock("eval_ms").alias("ts"), "increase")


def _group_lag(spark, d, prefix=""):
    lags = _m(spark, d, "group_lag")
    of = mo.selected(lags, "grp", prefix)
    lv = mo.level(of, ["grp", "part"], STEP, "event_id", lookback_ms=LOOKBACK, among=lags if prefix else None)
    return lv.groupBy("grp", "eval_ms").agg(F.sum("level").alias("lag"))


_LAG = [*_level("group_lag", "lv"), "lag AS (SELECT grp, eval_ms, sum(level) AS lag FROM lv GROUP BY 1, 2)"]
_SLOPE = f"""sl AS (SELECT *, CASE WHEN count(*) OVER w > 1 THEN regr_slope(lag, eval_ms / 1000.0::DOUBLE) OVER w END AS slope
  FROM lag WINDOW w AS (PARTITION BY grp ORDER BY eval_ms RANGE BETWEEN {WINDOW} PRECEDING AND CURRENT ROW))"""


@query("mon0_lag_slope_sign", s.with_([s.TRADES, *_LAG, _SLOPE], f"SELECT grp, {s.ms_ts('eval_ms')} AS ts, lag, CASE WHEN slope > 1e-9 THEN 1 WHEN slope < -1e-9 THEN -1 WHEN slope IS NOT NULL THEN 0 END AS direction FROM sl"))
def _(spark, d):
    sl = mo.slope(_group_lag(spark, d), ["grp"], "lag", WINDOW)
    direction = F.when(F.col("slope") > 1e-9, 1).when(F.col("slope") < -1e-9, -1).when(F.col("slope").isNotNull(), 0)
    return sl.select("grp", wall_clock("eval_ms").alias("ts"), "lag", direction.alias("direction"))


# --- alerts -------------------------------------------------------------------------------

_CONNECTED = [*_level("connected", "cn"), "con AS (SELECT eval_ms, max(level) AS connected FROM cn GROUP BY 1)"]


def _connected(spark, d):
    lv = mo.level(_m(spark, d, "connected"), ["instance"], STEP, "event_id", lookback_ms=LOOKBACK)
    return lv.groupBy("eval_ms").agg(F.max("level").alias("connected"))


_NO_CANDLES = [
    *_increase("candle_rows_total", "cr", []), *_increase("trades_total", "tt", []), *_CONNECTED,
    """e1 AS (SELECT c.eval_ms, c.increase AS candles, t.increase AS trades, x.connected
       FROM cr c JOIN tt t ON c.eval_ms = t.eval_ms JOIN con x ON c.eval_ms = x.eval_ms)""",
    *_firing("e1", [], "candles = 0 AND connected = 1 AND trades > 0", "f1"),
]
_DISCONNECTED = _firing("con", [], "connected = 0", "f2")


def _no_candles(spark, d):
    # Each side is summed before it is compared: counters are per task and never line up singly.
    candles = mo.increase(_m(spark, d, "candle_rows_total"), ["task"], [], STEP, WINDOW, "event_id", "candles")
    trades = mo.increase(_m(spark, d, "trades_total"), ["instance"], [], STEP, WINDOW, "event_id", "trades")
    e = candles.drop("scope").join(trades.drop("scope"), "eval_ms").join(_connected(spark, d), "eval_ms")
    cond = (F.col("candles") == 0) & (F.col("connected") == 1) & (F.col("trades") > 0)
    return mo.firing_steps(e, [], cond, FOR, STEP)


def _disconnected(spark, d):
    return mo.firing_steps(_connected(spark, d), [], F.col("connected") == 0, FOR, STEP)


@query("mon1_no_candles", s.with_([s.TRADES, *_NO_CANDLES], _alert("candles_absent", "page", [], "f1")))
def _(spark, d):
    return mo.alerts(_no_candles(spark, d), [], "candles_absent", "page")


@query("mon2_source_disconnected", s.with_([s.TRADES, *_CONNECTED, *_DISCONNECTED], _alert("source_down", "page", [], "f2")))
def _(spark, d):
    return mo.alerts(_disconnected(spark, d), [], "source_down", "page")


_FAILED = [
    *_increase("failed_checkpoints_total", "fc", ["job_id"]), *_level("job_uptime_ms", "up"),
    f"e3 AS (SELECT f.*, EXISTS (SELECT 1 FROM up u WHERE u.job_id = f.job_id AND u.eval_ms = f.eval_ms AND u.level > {WINDOW}) AS old_enough FROM fc f)",
]


@query("mon3_checkpoints_failing", s.with_([s.TRADES, *_FAILED, *_firing("e3", ["job_id"], "increase > 3 AND old_enough")], _alert("checkpoints_failing", "page", ["job_id"])))
def _(spark, d):
    # Per run instance, not per job name; a run that just started is given time.
    fails = mo.increase(_m(spark, d, "failed_checkpoints_total"), ["job_id"], ["job_id"], STEP, WINDOW, "event_id")
    old = mo.level(_m(spark, d, "job_uptime_ms"), ["job_id"], STEP, "event_id", lookback_ms=LOOKBACK).filter(F.col("level") > WINDOW)
    both = mo.label_and(fails.filter(F.col("increase") > 3), old, ["job_id", "eval_ms"]).select("job_id", "eval_ms", F.lit(True).alias("hit"))
    evals = fails.join(both, ["job_id", "eval_ms"], "left")
    return mo.alerts(mo.firing_steps(evals, ["job_id"], F.col("hit"), FOR, STEP), ["job_id"], "checkpoints_failing", "page")


@query(
    "jn9_label_matched_and",
    s.with_([s.TRADES, *_FAILED], f"SELECT job_id, {s.ms_ts('eval_ms')} AS ts, increase FROM e3 WHERE increase > 3 AND old_enough"),
)
def _(spark, d):
    fails = mo.increase(_m(spark, d, "failed_checkpoints_total"), ["job_id"], ["job_id"], STEP, WINDOW, "event_id")
    old = mo.level(_m(spark, d, "job_uptime_ms"), ["job_id"], STEP, "event_id", lookback_ms=LOOKBACK).filter(F.col("level") > WINDOW)
    return mo.label_and(fails.filter(F.col("increase") > 3), old, ["job_id", "eval_ms"]).select(
        "job_id", wall_clock("eval_ms").alias("ts"), "increase"
    )


@query("mon4_late_trades", s.with_([s.TRADES, *_increase("late_dropped_total", "lt", []), *_firing("lt", [], "increase > 100")], _alert("late_trades", "warning", [])))
def _(spark, d):
    x = mo.increase(_m(spark, d, "late_dropped_total"), ["task"], [], STEP, WINDOW, "event_id")
    return mo.alerts(mo.firing_steps(x, [], F.col("increase") > 100, FOR, STEP), [], "late_trades", "warning")


@query("mon5_lag_growing", s.with_([s.TRADES, *_LAG, _SLOPE, *_firing("sl", ["grp"], "lag > 20000 AND slope > 1e-9")], _alert("lag_growing", "warning", ["grp"])))
def _(spark, d):
    sl = mo.slope(_group_lag(spark, d), ["grp"], "lag", WINDOW)
    cond = (F.col("lag") > 20_000) & (F.col("slope") > 1e-9)
    return mo.alerts(mo.firing_steps(sl, ["grp"], cond, FOR, STEP), ["grp"], "lag_growing", "warning")


_PREFIX = "cand"  # which groups the alert is about; groups of ended experiments must not keep it firing
_LAG_OF = [*_level("group_lag", "lv"), f"lag AS (SELECT grp, eval_ms, sum(level) AS lag FROM lv WHERE starts_with(grp, '{_PREFIX}') GROUP BY 1, 2)"]


@query("mon5_lag_growing_selected", s.with_([s.TRADES, *_LAG_OF, _SLOPE, *_firing("sl", ["grp"], "lag > 20000 AND slope > 1e-9")], _alert("lag_growing", "warning", ["grp"])))
def _(spark, d):
    sl = mo.slope(_group_lag(spark, d, _PREFIX), ["grp"], "lag", WINDOW)
    cond = (F.col("lag") > 20_000) & (F.col("slope") > 1e-9)
    return mo.alerts(mo.firing_steps(sl, ["grp"], cond, FOR, STEP), ["grp"], "lag_growing", "warning")


_RESTARTS = [*_increase("job_restarts_total", "rs", ["job_name", "attempt"]), "e6 AS (SELECT job_name, eval_ms, max(increase) AS increase FROM rs GROUP BY 1, 2)"]


@query("mon6_restart_loop", s.with_([s.TRADES, *_RESTARTS, *_firing("e6", ["job_name"], "increase > 3")], _alert("restart_loop", "page", ["job_name"])))
def _(spark, d):
    x = mo.increase(_m(spark, d, "job_restarts_total"), ["job_name", "attempt"], ["job_name", "attempt"], STEP, WINDOW, "event_id")
    top = x.groupBy("job_name", "eval_ms").agg(F.max("increase").alias("increase"))
    return mo.alerts(mo.firing_steps(top, ["job_name"], F.col("increase") > 3, FOR, STEP), ["job_name"], "restart_loop", "page")


_OFFSETS = [
    *_level("topic_end_offset", "eo"), *_level("group_offset", "go"),
    "nobody AS (SELECT topic, partition, eval_ms FROM go GROUP BY 1, 2, 3 HAVING max(level) = -1)",
    """e7 AS (SELECT e.*, EXISTS (SELECT 1 FROM nobody n WHERE n.topic = e.topic AND n.partition = e.partition AND n.eval_ms = e.eval_ms) AS unread FROM eo e)""",
]


@query("mon7_partition_not_consumed", s.with_([s.TRADES, *_OFFSETS, *_firing("e7", ["topic", "partition"], "level > 0 AND unread")], _alert("partition_unread", "page", ["topic", "partition"])))
def _(spark, d):
    keys = ["topic", "partition"]
    ends = mo.level(_m(spark, d, "topic_end_offset"), keys, STEP, "event_id", lookback_ms=LOOKBACK)
    best = (
        mo.level(_m(spark, d, "group_offset"), ["grp", *keys], STEP, "event_id", lookback_ms=LOOKBACK)
        .groupBy(*keys, "eval_ms").agg(F.max("level").alias("best"))
    )
    evals = ends.join(best, [*keys, "eval_ms"], "left")
    cond = (F.col("level") > 0) & (F.col("best") == -1)
    return mo.alerts(mo.firing_steps(evals, keys, cond, FOR, STEP), keys, "partition_unread", "page")


AS_OF = 30 * HOUR_MS  # after the first sample: two partitions were still undiscovered
_LATEST = f"""t AS (SELECT min(ts_ms) + {AS_OF} AS as_of FROM eo_s),
latest AS (SELECT topic, partition, arg_max(value, (ts_ms, event_id)) AS value FROM eo_s, t WHERE ts_ms <= as_of GROUP BY 1, 2),
committed AS (SELECT grp, topic, partition, arg_max(value, (ts_ms, event_id)) AS value FROM go_s, t WHERE ts_ms <= as_of GROUP BY 1, 2, 3)"""


@query(
    "jn10_unread_partitions",
    s.with_(
        [s.TRADES, _samples("topic_end_offset", "eo_s"), _samples("group_offset", "go_s"), _LATEST],
        """SELECT topic, partition, value FROM latest l WHERE value > 0 AND EXISTS (
             SELECT 1 FROM committed c WHERE c.topic = l.topic AND c.partition = l.partition HAVING max(c.value) = -1)""",
    ),
)
def _(spark, d):
    ends, offsets = _m(spark, d, "topic_end_offset"), _m(spark, d, "group_offset")
    as_of = ends.agg(F.min("ts_ms") + AS_OF).first()[0]
    return mo.unread_partitions(
        mo.state_at(ends, ["topic", "partition"], as_of, "event_id"), mo.state_at(offsets, ["grp", "topic", "partition"], as_of, "event_id")
    )


@query("mon9_freshness", s.with_(
    [s.TRADES, s.ARCHIVE, s.mine(), f"""wr AS (SELECT (epoch_ms(ingested_at) + {STEP - 1}) // {STEP} * {STEP} AS eval_ms, max(epoch_ms(window_start)) AS newest FROM mine GROUP BY 1)""",
     f"g AS (SELECT unnest(generate_series((SELECT min(eval_ms) FROM wr), (SELECT max(eval_ms) FROM wr), {STEP})) AS eval_ms)"],
    f"SELECT {s.ms_ts('g.eval_ms')} AS ts, g.eval_ms - max(newest) OVER (ORDER BY g.eval_ms ROWS UNBOUNDED PRECEDING) AS age_ms FROM g LEFT JOIN wr ON g.eval_ms = wr.eval_ms",
))
def _(spark, d):
    writes = dv.own_of(spark, d).select(epoch_ms("ingested_at").alias("written_ms"), epoch_ms("window_start").alias("window_ms"))
    return mo.freshness(writes, STEP).select(wall_clock("eval_ms").alias("ts"), "age_ms")


@query(
    "mon10_inhibition",
    s.with_(
        [s.TRADES, *_NO_CANDLES, *_DISCONNECTED],
        f"SELECT {s.ms_ts('eval_ms')} AS ts FROM f1 WHERE eval_ms NOT IN (SELECT eval_ms FROM f2)",
    ),
)
def _(spark, d):
    return mo.inhibit(_no_candles(spark, d), _disconnected(spark, d)).select(wall_clock("eval_ms").alias("ts"))


# --- dashboard series ---------------------------------------------------------------------

@query(
    "mon8_receive_rate",
    s.with_([s.TRADES, f"r AS (SELECT symbol, (ingest_ms + {STEP - 1}) // {STEP} * {STEP} AS eval_ms, count(*) AS n FROM trades GROUP BY 1, 2)"],
            f"SELECT symbol, {s.ms_ts('eval_ms')} AS ts, n / {STEP / 1000.0}::DOUBLE AS per_second FROM r"),
)
def _(spark, d):
    t = dv.events_trades(spark, d)
    per = t.groupBy("symbol", mo.step_of("ingest_ms", STEP).alias("eval_ms")).agg(F.count(F.lit(1)).alias("n"))
    return per.select("symbol", wall_clock("eval_ms").alias("ts"), (F.col("n") / F.lit(STEP / 1000.0)).alias("per_second"))


@query("mon8_group_lag", s.with_([s.TRADES, *_LAG], f"SELECT grp, {s.ms_ts('eval_ms')} AS ts, lag FROM lag"))
def _(spark, d):
    return _group_lag(spark, d).select("grp", wall_clock("eval_ms").alias("ts"), "lag")


@query(
    "flt7_known_lag",
    s.with_([s.TRADES, _samples("group_lag", "gl")],
            "SELECT grp, sum(value) FILTER (value >= 0) AS lag, sum(value) AS lag_with_unknown FROM gl GROUP BY 1"),
)
def _(spark, d):
    return mo.known_lag(_m(spark, d, "group_lag"), ["grp"])


@query("mon8_partition_inflow", s.with_([s.TRADES, *_increase("topic_end_offset", "po", ["topic", "partition"])], f"SELECT topic, partition, {s.ms_ts('eval_ms')} AS ts, increase / {WINDOW / 1000.0}::DOUBLE AS per_second FROM po"))
def _(spark, d):
    x = mo.increase(_m(spark, d, "topic_end_offset"), ["topic", "partition"], ["topic", "partition"], STEP, WINDOW, "event_id")
    return x.select("topic", "partition", wall_clock("eval_ms").alias("ts"), (F.col("increase") / F.lit(WINDOW / 1000.0)).alias("per_second"))


@query("mon8_reconnects", s.with_([s.TRADES, *_increase("reconnects_total", "rc", [])], f"SELECT {s.ms_ts('eval_ms')} AS ts, increase AS reconnects FROM rc"))
def _(spark, d):
    x = mo.increase(_m(spark, d, "reconnects_total"), ["instance"], [], STEP, WINDOW, "event_id", "reconnects")
    return x.select(wall_clock("eval_ms").alias("ts"), "reconnects")


@query(
    "mon8_inflow_vs_output",
    s.with_([s.TRADES, *_increase("trades_total", "tt", []), *_increase("candle_rows_total", "cr", [])],
            f"SELECT {s.ms_ts('t.eval_ms')} AS ts, t.increase AS inflow, c.increase AS output FROM tt t JOIN cr c ON t.eval_ms = c.eval_ms"),
)
def _(spark, d):
    i = mo.increase(_m(spark, d, "trades_total"), ["instance"], [], STEP, WINDOW, "event_id", "inflow").drop("scope")
    o = mo.increase(_m(spark, d, "candle_rows_total"), ["task"], [], STEP, WINDOW, "event_id", "output").drop("scope")
    return i.join(o, "eval_ms").select(wall_clock("eval_ms").alias("ts"), "inflow", "output")


@query("mon8_dead_letter_outcomes", s.with_([s.TRADES, *_increase("dead_letters_total", "dl", ["outcome"])], f"SELECT outcome, {s.ms_ts('eval_ms')} AS ts, increase FROM dl"))
def _(spark, d):
    x = mo.increase(_m(spark, d, "dead_letters_total"), ["outcome"], ["outcome"], STEP, WINDOW, "event_id")
    return x.select("outcome", wall_clock("eval_ms").alias("ts"), "increase")


@query("mon8_late_dropped", s.with_([s.TRADES, *_increase("late_dropped_total", "ld", ["task"])], f"SELECT task, {s.ms_ts('eval_ms')} AS ts, increase AS late_dropped FROM ld"))
def _(spark, d):
    x = mo.increase(_m(spark, d, "late_dropped_total"), ["task"], ["task"], STEP, WINDOW, "event_id", "late_dropped")
    return x.select("task", wall_clock("eval_ms").alias("ts"), "late_dropped")


@query("mon8_task_throughput", s.with_([s.TRADES, *_increase("records_out_total", "ro", ["subtask"])], f"SELECT subtask, {s.ms_ts('eval_ms')} AS ts, increase / {WINDOW / 1000.0}::DOUBLE AS per_second FROM ro"))
def _(spark, d):
    x = mo.increase(_m(spark, d, "records_out_total"), ["subtask"], ["subtask"], STEP, WINDOW, "event_id")
    return x.select("subtask", wall_clock("eval_ms").alias("ts"), (F.col("increase") / F.lit(WINDOW / 1000.0)).alias("per_second"))


@query("mon8_lag_quantiles_by_hour", s.with_(
    [s.TRADES, "lags AS (SELECT (ingest_ms // 3600000) * 3600000 AS hour_ms, greatest(ingest_ms - event_ms, 0) / 1000.0::DOUBLE AS lag_s FROM trades)",
     f"c AS (SELECT hour_ms, {', '.join(f'count(*) FILTER (lag_s <= {b}) AS b{i}' for i, b in enumerate(od.LAG_BUCKETS))}, count(*) AS total FROM lags GROUP BY 1)"],
    f"SELECT {s.ms_ts('hour_ms')} AS hour, total, " + ", ".join(_quantile_sql(q) for q in (0.5, 0.95, 0.99)) + " FROM c",
))
def _(spark, d):
    from tapecheck.functions.timecols import bucket_start

    t = dv.events_trades(spark, d).withColumn("hour_ms", bucket_start("ingest_ms", HOUR_MS))
    return od.lag_quantiles(t, [0.5, 0.95, 0.99], ["hour_ms"]).withColumn("hour", wall_clock("hour_ms")).drop("hour_ms")
