"""Arrival order, disorder, watermark what-if, lag and replay."""

from __future__ import annotations

from pyspark.sql import functions as F

from tapecheck.functions.timecols import bucket_start, text, wall_clock
from tapecheck.operators import ordering as od, replay as rp
from tapecheck.plans import sqlparts as s
from tapecheck.plans.catalog import query
from tapecheck.settings import HOUR_MS
from tapecheck.sources import derived as dv

_D = [s.TRADES, s.DISORDERED]


def _disordered(spark, d):
    return dv.disordered(dv.events_trades(spark, d))


@query(
    "win2_sequence_in_ms",
    s.with_(
        _D,
        """SELECT event_id, symbol, event_ms - event_ms % 3600000 AS event_ms,
                  CAST(row_number() OVER (PARTITION BY symbol, event_ms - event_ms % 3600000 ORDER BY ingest_ms, event_id) - 1 AS INTEGER) AS seq_in_ms
           FROM disordered""",
    ),
)
def _(spark, d):
    # The data has no equal milliseconds, so event times are cut to the hour to get crowded ones.
    crowded = _disordered(spark, d).withColumn("event_ms", bucket_start("event_ms", HOUR_MS))
    return od.sequence_in_ms(crowded, "event_id").select("event_id", "symbol", "event_ms", F.col("seq_in_ms").cast("int"))


_OOO = """flagged AS (
  SELECT *, coalesce(CAST(event_ms < mx AS INTEGER), 0) AS out_of_order, coalesce(greatest(mx - event_ms, 0), 0) AS behind_ms
  FROM (SELECT *, max(event_ms) OVER (PARTITION BY symbol ORDER BY ingest_ms, event_id
               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS mx FROM disordered))"""


@query("win3_out_of_order", s.with_([*_D, _OOO], "SELECT event_id, symbol, out_of_order, behind_ms FROM flagged"))
def _(spark, d):
    return od.out_of_order(_disordered(spark, d), "event_id").select("event_id", "symbol", "out_of_order", "behind_ms")


@query(
    "agg18_disorder_report",
    s.with_(
        [*_D, _OOO],
        """SELECT symbol, count(*) AS trades, CAST(sum(out_of_order) AS BIGINT) AS out_of_order,
                  count(*) FILTER (behind_ms > 60000) AS over_limit, max(behind_ms) AS max_behind_ms FROM flagged GROUP BY 1""",
    ),
)
def _(spark, d):
    return od.disorder_report(od.out_of_order(_disordered(spark, d), "event_id"))


_GAPPED = """linked AS (SELECT *, least(greatest(coalesce(ingest_ms - lag(ingest_ms) OVER (ORDER BY ingest_ms, event_id), 0), 0), 300000) AS gap_ms FROM disordered),
sched AS (SELECT *, CAST(sum(gap_ms) OVER (ORDER BY ingest_ms, event_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS offset_ms FROM linked)"""


@query("win4_gap_compression", s.with_([*_D, _GAPPED], "SELECT event_id, gap_ms, offset_ms FROM sched"))
def _(spark, d):
    return rp.replay_schedule(_disordered(spark, d), "event_id", 300_000).select("event_id", "gap_ms", "offset_ms")


@query(
    "exp5_replay_schedule",
    s.with_([*_D, _GAPPED], "SELECT event_id, symbol, conn_id, CAST(floor(offset_ms / 20.0) AS BIGINT) AS send_at_ms FROM sched"),
)
def _(spark, d):
    return rp.replay_schedule(_disordered(spark, d), "event_id", 300_000, speed=20.0).select(
        "event_id", "symbol", "conn_id", "send_at_ms"
    )


_PROGRESS = """progress AS (
  SELECT *, max(event_ms) OVER w AS p1,
         max(event_ms) FILTER (kafka_partition = 0) OVER w AS q0, max(event_ms) FILTER (kafka_partition = 1) OVER w AS q1,
         max(event_ms) FILTER (kafka_partition = 2) OVER w AS q2
  FROM disordered WINDOW w AS (ORDER BY ingest_ms, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
marks AS (SELECT *, CASE WHEN q0 IS NOT NULL AND q1 IS NOT NULL AND q2 IS NOT NULL THEN least(q0, q1, q2) END AS p3 FROM progress)"""


@query(
    "win5_record_watermark",
    s.with_(
        [*_D, _PROGRESS],
        """SELECT event_id, p1 - 5000 AS watermark_ms,
                  coalesce(CAST(event_ms - event_ms % 3600000 + 3600000 <= p1 - 5000 AS INTEGER), 0) AS late FROM marks""",
    ),
)
def _(spark, d):
    w = od.watermarked(_disordered(spark, d), "event_id")
    return w.select(
        "event_id", (F.col("progress_ms") - 5000).alias("watermark_ms"), od.late_flag(HOUR_MS, 5000).cast("int").alias("late")
    )


_DELAYS = [0, 60_000, 300_000, 3_600_000, 14_400_000]
_SWEEP = s.with_(
    [*_D, _PROGRESS, f"dl AS (SELECT unnest({_DELAYS}) AS delay_ms)"],
    """SELECT CAST(pc.partitions AS BIGINT) AS partitions, CAST(delay_ms AS BIGINT) AS delay_ms, count(*) AS trades,
              count(*) FILTER (event_ms - event_ms % 3600000 + 3600000 <= CASE WHEN pc.partitions = 1 THEN p1 ELSE p3 END - delay_ms) AS late
       FROM marks, dl, (SELECT unnest([1, 3]) AS partitions) pc GROUP BY 1, 2""",
)


@query("str8_watermark_sweep", _SWEEP)
def _(spark, d):
    return od.watermark_sweep(_disordered(spark, d), "event_id", HOUR_MS, _DELAYS, [1, 3])


@query(
    "exp6_late_by_symbol",
    s.with_(
        [*_D, _PROGRESS],
        """SELECT symbol, count(*) FILTER (event_ms - event_ms % 3600000 + 3600000 <= p1) AS late_1,
                  count(*) FILTER (event_ms - event_ms % 3600000 + 3600000 <= p3) AS late_3 FROM marks GROUP BY 1""",
    ),
)
def _(spark, d):
    t = _disordered(spark, d)
    one = od.watermarked(t, "event_id", 1).groupBy("symbol").agg(F.count_if(od.late_flag(HOUR_MS, 0)).alias("late_1"))
    three = od.watermarked(t, "event_id", 3).groupBy("symbol").agg(F.count_if(od.late_flag(HOUR_MS, 0)).alias("late_3"))
    return one.join(three, "symbol")


@query(
    "prj7_log_coordinates",
    s.with_(
        [s.TRADES],
        """SELECT event_id, kafka_partition,
                  row_number() OVER (PARTITION BY kafka_partition ORDER BY ingest_ms, event_id) - 1 AS kafka_offset FROM trades""",
    ),
)
def _(spark, d):
    return od.with_offsets(dv.events_trades(spark, d), "event_id").select("event_id", "kafka_partition", "kafka_offset")


_LAG = """lags AS (SELECT symbol, greatest(ingest_ms - event_ms, 0) / 1000.0::DOUBLE AS lag_s FROM trades)"""
_BUCKETS = ", ".join(f"count(*) FILTER (lag_s <= {b}) AS b{i}" for i, b in enumerate(od.LAG_BUCKETS))


@query(
    "agg16_lag_buckets",
    s.with_(
        [s.TRADES, _LAG, f"c AS (SELECT symbol, {_BUCKETS}, count(*) AS total FROM lags GROUP BY 1)"],
        " UNION ALL ".join(
            [f"SELECT symbol, CAST({b} AS DOUBLE) AS le, b{i} AS n FROM c" for i, b in enumerate(od.LAG_BUCKETS)]
            + ["SELECT symbol, CAST('inf' AS DOUBLE) AS le, total AS n FROM c"]
        ),
    ),
)
def _(spark, d):
    return od.lag_histogram(dv.events_trades(spark, d), ["symbol"])


def _quantile_sql(q: float) -> str:
    arms, low, below = [], 0.0, "0"
    for i, b in enumerate(od.LAG_BUCKETS):
        arms.append(f"WHEN b{i} >= {q} * total THEN {low} + ({b} - {low})::DOUBLE * ({q}::DOUBLE * total - {below}) / nullif(b{i} - {below}, 0)")
        low, below = b, f"b{i}"
    return f"CASE {' '.join(arms)} ELSE {od.LAG_BUCKETS[-1]} END::DOUBLE AS p{int(q * 100)}"


@query(
    "agg16_lag_quantiles",
    s.with_(
        [s.TRADES, _LAG, f"c AS (SELECT symbol, {_BUCKETS}, count(*) AS total FROM lags GROUP BY 1)"],
        f"SELECT symbol, total, {_quantile_sql(0.5)}, {_quantile_sql(0.95)}, {_quantile_sql(0.99)} FROM c",
    ),
)
def _(spark, d):
    return od.lag_quantiles(dv.events_trades(spark, d), [0.5, 0.95, 0.99], ["symbol"])


@query(
    "agg17_clock_ahead",
    s.with_(
        [s.TRADES],
        f"""SELECT {s.ms_ts('ingest_ms - ingest_ms % 3600000')} AS hour, count(*) AS trades,
                   count(*) FILTER (ingest_ms < event_ms) AS ahead,
                   CAST(count(*) FILTER (ingest_ms < event_ms) AS DOUBLE) / count(*) AS ahead_share,
                   greatest(-min(ingest_ms - event_ms), 0) AS max_skew_ms,
                   CAST(median(ingest_ms - event_ms) AS DOUBLE) AS median_lag_ms
            FROM trades GROUP BY 1""",
    ),
)
def _(spark, d):
    return od.clock_ahead(dv.events_trades(spark, d))


@query(
    "src4_bounded_scan",
    s.with_(
        [s.TRADES],
        """SELECT event_id, symbol, ingest_ms, n AS arrival FROM (
             SELECT *, row_number() OVER (ORDER BY ingest_ms, event_id) - 1 AS n FROM trades WHERE conn_id = 'synth-1')
           WHERE n >= 5 AND n < 1005""",
    ),
)
def _(spark, d):
    return rp.arrival_range(dv.events_trades(spark, d), "event_id", 5, 1000, conn_id="synth-1").select(
        "event_id", "symbol", "ingest_ms", "arrival"
    )


@query("flt8_one_connection", s.with_([s.TRADES], "SELECT event_id, symbol, recv_seq FROM trades WHERE conn_id = 'synth-1'"))
def _(spark, d):
    return dv.events_trades(spark, d).filter(F.col("conn_id") == "synth-1").select("event_id", "symbol", "recv_seq")


@query(
    "srt3_skip_and_take",
    s.with_(
        _D,
        """SELECT event_id, symbol, ingest_ms FROM disordered ORDER BY ingest_ms, event_id LIMIT 500 OFFSET 250""",
    ),
)
def _(spark, d):
    return rp.arrival_range(_disordered(spark, d), "event_id", 250, 500).select("event_id", "symbol", "ingest_ms")


@query("srt4_arrival_order", s.with_(_D, "SELECT event_id, symbol, ingest_ms FROM disordered ORDER BY ingest_ms, event_id"))
def _(spark, d):
    return rp.in_arrival_order(_disordered(spark, d), "event_id").select("event_id", "symbol", "ingest_ms")


_INJECT = """late AS (
  SELECT * REPLACE (CASE WHEN (event_id * 7919) % 1000 < 100 THEN event_ms - ((event_id * 104729) % 180 + 1) * 1000 ELSE event_ms END AS event_ms),
         CASE WHEN (event_id * 7919) % 1000 < 100 THEN 1 ELSE 0 END AS late_injected FROM trades)"""


@query(
    "exp3_injection",
    s.with_(
        [s.TRADES, _INJECT],
        """SELECT event_id, event_ms, late_injected, 0 AS delivery FROM late
           UNION ALL SELECT event_id, event_ms, late_injected, 1 FROM late WHERE (event_id * 15485863) % 1000 < 50""",
    ),
)
def _(spark, d):
    late = rp.inject_late(dv.events_trades(spark, d), "event_id", 100, 180)
    return rp.inject_copies(late, "event_id", 50).select("event_id", "event_ms", "late_injected", "delivery")


@query(
    "exp3_injection_renumbered",
    s.with_(
        [s.TRADES, _INJECT],
        """SELECT event_id, symbol, event_ms,
                  CAST(row_number() OVER (PARTITION BY symbol, event_ms ORDER BY ingest_ms, event_id) - 1 AS INTEGER) AS seq_in_ms FROM late""",
    ),
)
def _(spark, d):
    # Moving event times can make (symbol, time, number) collide, so numbers are assigned again.
    late = rp.inject_late(dv.events_trades(spark, d), "event_id", 100, 180)
    return od.sequence_in_ms(late, "event_id").select("event_id", "symbol", "event_ms", F.col("seq_in_ms").cast("int"))


_TARGET = 1_760_000_000_000


@query(
    "exp4_shifted_replay",
    s.with_(
        [s.TRADES],
        f"""SELECT event_id, {s.ms_text(f'event_ms + {_TARGET} - (SELECT min(event_ms) FROM trades)')} AS event_time,
                   'replay-000001' AS conn_id, row_number() OVER (ORDER BY ingest_ms, event_id) AS recv_seq FROM trades""",
    ),
)
def _(spark, d):
    out = rp.shift_to(dv.events_trades(spark, d), "event_id", _TARGET, "replay-000001")
    return out.select("event_id", text(wall_clock("event_ms")).alias("event_time"), "conn_id", "recv_seq")
