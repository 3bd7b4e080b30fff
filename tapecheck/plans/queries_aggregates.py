"""Candles, latest rows, loss and origin checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from tapecheck.operators import candles as cd, compare as cmp, continuity as ct, dedup, ordering as od
from tapecheck.plans import sqlparts as s
from tapecheck.plans.catalog import query
from tapecheck.settings import DAY_MS, HOUR_MS, MINUTE_MS
from tapecheck.sources import derived as dv

_A = [s.TRADES, s.ARCHIVE]


@query("agg1_ohlcv_1h", s.with_([s.TRADES], s.ohlcv("trades", HOUR_MS)))
def _(spark, d):
    return cd.candles(dv.events_trades(spark, d), HOUR_MS)


@query("agg1_ohlcv_60s", s.with_([s.TRADES], s.ohlcv("trades", MINUTE_MS)))
def _(spark, d):
    return cd.candles(dv.events_trades(spark, d), MINUTE_MS)


@query("agg1_ohlcv_lineitem_1d", s.with_([s.LINE_TRADES], s.ohlcv("line_trades", DAY_MS)))
def _(spark, d):
    return cd.candles(dv.lineitem_trades(spark, d), DAY_MS)


@query(
    "agg2_exact_ties_lineitem_1d",
    s.with_(
        [s.LINE_TRADES],
        f"""SELECT symbol, make_timestamp((event_ms - event_ms % {DAY_MS}) * 1000) AS window_start,
         arg_min(price, (event_ms, seq_in_ms, price)) AS open, max(price) AS high, min(price) AS low,
         arg_max(price, (event_ms, seq_in_ms, price)) AS close,
         CAST(sum(volume) AS DECIMAL(18,8)) AS volume, count(*) AS trade_count
  FROM line_trades GROUP BY 1, 2""",
    ),
)
def _(spark, d):
    return cd.candles(dv.lineitem_trades(spark, d), DAY_MS, exact_ties=True)


@query(
    "agg2_open_close_under_disorder",
    s.with_([s.TRADES, s.DISORDERED], s.ohlcv("disordered", HOUR_MS)),
)
def _(spark, d):
    return cd.candles(dv.disordered(dv.events_trades(spark, d)), HOUR_MS)


@query("agg3_rollup_60s_to_1h", s.with_([s.TRADES], s.ohlcv("trades", HOUR_MS)))
def _(spark, d):
    minute = cd.partial_candles(dv.events_trades(spark, d), MINUTE_MS)
    return cd.finish_partials(cd.merge_partials(minute, HOUR_MS))


_DEDUP_COLS = "symbol, window_start, open, high, low, close, volume, trade_count, write_count"


@query("agg4_candles_latest", s.with_([s.TRADES, s.ARCHIVE, s.mine(), s.DEDUP], f"SELECT {_DEDUP_COLS} FROM mine_latest"))
def _(spark, d):
    return dedup.latest_candles(dv.own_of(spark, d))


@query(
    "agg5_latest_per_column",
    s.with_(
        [s.TRADES, s.ARCHIVE, s.mine()],
        """SELECT symbol, window_start, open, high, low, close, volume, writes
           FROM (SELECT *, row_number() OVER (PARTITION BY symbol, window_start ORDER BY ingested_at DESC) AS nth,
                        count(*) OVER (PARTITION BY symbol, window_start) AS writes FROM mine)
           WHERE nth = 1""",
    ),
)
def _(spark, d):
    # Taken from one row on purpose: six separate picks may mix rows when write times tie.
    return dedup.latest_candles(dv.own_of(spark, d)).select(
        "symbol", "window_start", "open", "high", "low", "close", "volume", F.col("write_count").alias("writes"),
    )


_CONT = f"""continuity AS (
  SELECT conn_id, received, first_seq, last_seq, span AS expected, absent - repeated AS gaps,
         round(CAST(absent - repeated AS DOUBLE) / span * 100, 4) AS loss_pct, first_seen, last_seen
  FROM (SELECT conn_id, CAST(sum(n) AS BIGINT) AS received, min(recv_seq) AS first_seq, max(recv_seq) AS last_seq,
               CAST(sum(step) AS BIGINT) AS span, CAST(sum(step - 1) AS BIGINT) AS absent, CAST(sum(n - 1) AS BIGINT) AS repeated,
               {s.ms_text('min(t0)')} AS first_seen, {s.ms_text('max(t1)')} AS last_seen
        FROM (SELECT *, recv_seq - coalesce(lag(recv_seq) OVER (PARTITION BY conn_id ORDER BY recv_seq), recv_seq - 1) AS step
              FROM (SELECT conn_id, recv_seq, count(*) AS n, min(ingest_ms) AS t0, max(ingest_ms) AS t1 FROM archive GROUP BY 1, 2))
        GROUP BY 1))"""


@query("agg6_source_continuity", s.with_([*_A, _CONT], "SELECT * FROM continuity"))
def _(spark, d):
    return ct.source_continuity(dv.archive_of(spark, d))


@query(
    "flt4_continuity_real_sources",
    s.with_([*_A, _CONT], "SELECT * FROM continuity WHERE conn_id NOT LIKE 'synth%' AND conn_id NOT LIKE 'replay%' ORDER BY received DESC"),
)
def _(spark, d):
    # The origin filter sits below the aggregate: rows of test producers never reach the shuffle.
    real = dv.archive_of(spark, d).filter(ct.is_real_origin())
    return ct.source_continuity(real).orderBy(F.desc("received"), "conn_id")


@query(
    "agg7_loss_by_minute",
    s.with_(
        _A,
        f"""SELECT conn_id, {s.ms_ts('ingest_ms - ingest_ms % 60000')} AS minute, count(*) AS received,
                   max(recv_seq) - min(recv_seq) + 1 - count(*) AS gaps
            FROM archive GROUP BY 1, 2 ORDER BY 2""",
    ),
)
def _(spark, d):
    return ct.loss_by_minute(dv.archive_of(spark, d)).orderBy("minute", "conn_id")


_ORIGIN_LABEL = "coalesce(nullif(regexp_extract(conn_id, '^(synth|replay)', 1), ''), 'other')"


@query(
    "agg8_origin_profile",
    s.with_(
        _A,
        f"""SELECT conn_id, {_ORIGIN_LABEL} AS label, count(*) AS trades, count(DISTINCT symbol) AS syms,
                   CAST(round(min(price), 0) AS BIGINT) AS price_min, CAST(round(max(price), 0) AS BIGINT) AS price_max,
                   {s.ms_kst('min(ingest_ms)')} AS first_kst, {s.ms_kst('max(ingest_ms)')} AS last_kst
            FROM archive GROUP BY 1 ORDER BY first_kst""",
    ),
)
def _(spark, d):
    return ct.origin_profile(dv.archive_of(spark, d)).orderBy("first_kst", "conn_id")


@query(
    "prj14_origin_labels",
    s.with_(_A, f"SELECT {_ORIGIN_LABEL} AS label, count(*) AS trades FROM archive GROUP BY 1"),
)
def _(spark, d):
    return dv.archive_of(spark, d).groupBy(ct.origin_label().alias("label")).agg(F.count(F.lit(1)).alias("trades"))


_SPANS = "spans AS (SELECT conn_id, min(ingest_ms) AS t0, max(ingest_ms) AS t1 FROM archive GROUP BY 1)"


@query(
    "jn4_connection_overlaps",
    s.with_(
        [*_A, _SPANS],
        f"""SELECT a.conn_id AS conn_a, b.conn_id AS conn_b, {s.ms_kst('greatest(a.t0, b.t0)')} AS overlap_from,
                   {s.ms_kst('least(a.t1, b.t1)')} AS overlap_to
            FROM spans a JOIN spans b ON a.conn_id < b.conn_id AND a.t0 <= b.t1 AND b.t0 <= a.t1""",
    ),
)
def _(spark, d):
    return ct.connection_overlaps(ct.connection_spans(dv.archive_of(spark, d)))


_REAL_SPANS = """spans AS (SELECT conn_id, min(ingest_ms) AS t0, max(ingest_ms) AS t1 FROM archive
  WHERE conn_id NOT LIKE 'synth%' AND conn_id NOT LIKE 'replay%' GROUP BY 1)"""
_GAPS = "gaps AS (SELECT t1 AS a, nt AS b FROM (SELECT *, lead(t0) OVER (ORDER BY t0, t1) AS nt FROM spans) WHERE nt > t1)"
_GAP_COLS = f"SELECT {s.ms_kst('a')} AS gap_start_kst, {s.ms_kst('b')} AS gap_end_kst, round((b - a) / 1000.0, 3) AS gap_seconds FROM gaps"


@query("win1_connection_gaps", s.with_([*_A, _REAL_SPANS, _GAPS], _GAP_COLS.replace("round((b - a) / 1000.0, 3)", "round(CAST(b - a AS DOUBLE) / 1000.0, 3)")))
def _(spark, d):
    real = dv.archive_of(spark, d).filter(ct.is_real_origin())
    return ct.gap_report(ct.connection_gaps(ct.connection_spans(real)))


@query(
    "win1_coverage_gaps",
    s.with_(
        [*_A, _REAL_SPANS, """gaps AS (SELECT a, b FROM (SELECT t0 AS b, max(t1) OVER (ORDER BY t0, t1 ROWS BETWEEN UNBOUNDED PRECEDING
            AND 1 PRECEDING) AS a FROM spans) WHERE b > a)"""],
        _GAP_COLS.replace("round((b - a) / 1000.0, 3)", "round(CAST(b - a AS DOUBLE) / 1000.0, 3)"),
    ),
)
def _(spark, d):
    return ct.gap_report(ct.coverage_gaps(ct.connection_spans(dv.archive_of(spark, d).filter(ct.is_real_origin()))))


@query(
    "agg14_duplicate_report",
    s.with_(
        _A,
        """SELECT count(*) AS n_rows, count(DISTINCT (symbol, event_ms, seq_in_ms)) AS n_keys,
                  count(*) - count(DISTINCT (symbol, event_ms, seq_in_ms)) AS n_duplicates FROM archive""",
    ),
)
def _(spark, d):
    return cmp.duplicate_report(dv.archive_of(spark, d))


@query(
    "agg19_partition_skew",
    s.with_(
        _A,
        """SELECT kafka_partition, CAST(sum(n) AS BIGINT) AS records,
                  CAST(sum(n) AS DOUBLE) / (SELECT count(*) FROM archive) AS share,
                  count(*) AS active_keys, max(n) AS largest_key
           FROM (SELECT kafka_partition, symbol, count(*) AS n FROM archive GROUP BY 1, 2) GROUP BY 1""",
    ),
)
def _(spark, d):
    return od.partition_skew(dv.archive_of(spark, d))


@query(
    "agg20_trades_per_minute",
    s.with_(
        [s.TRADES],
        f"SELECT symbol, {s.ms_ts('event_ms - event_ms % 60000')} AS window_start, count(*) AS trades FROM trades GROUP BY 1, 2",
    ),
)
def _(spark, d):
    return od.trades_per_window(dv.events_trades(spark, d))


@query("set3_distinct_symbols", s.with_(_A, "SELECT count(DISTINCT symbol) AS symbols, count(DISTINCT conn_id) AS connections FROM archive"))
def _(spark, d):
    return dv.archive_of(spark, d).agg(F.countDistinct("symbol").alias("symbols"), F.countDistinct("conn_id").alias("connections"))


_SESS_MS = 7_200_000


@query(
    "str19_session_candles",
    s.with_(
        [
            s.TRADES,
            f"""marked AS (SELECT *, CASE WHEN event_ms - lag(event_ms) OVER (PARTITION BY symbol ORDER BY event_ms, seq_in_ms)
                 <= {_SESS_MS} THEN 0 ELSE 1 END AS fresh FROM trades)""",
            "numbered AS (SELECT *, sum(fresh) OVER (PARTITION BY symbol ORDER BY event_ms, seq_in_ms) AS sid FROM marked)",
        ],
        f"""SELECT symbol, {s.ms_ts('min(event_ms)')} AS session_start, {s.ms_ts(f'max(event_ms) + {_SESS_MS}')} AS session_end,
                   arg_min(price, (event_ms, seq_in_ms)) AS open, max(price) AS high, min(price) AS low,
                   arg_max(price, (event_ms, seq_in_ms)) AS close, CAST(sum(volume) AS DECIMAL(18,8)) AS volume,
                   count(*) AS trade_count
            FROM numbered GROUP BY symbol, sid""",
    ),
)
def _(spark, d):
    return cd.session_candles(dv.events_trades(spark, d), _SESS_MS)


@query(
    "str20_fill_quiet_windows",
    s.with_(
        [
            s.TRADES,
            f"c AS ({s.ohlcv('trades', HOUR_MS)})",
            "n AS (SELECT *, lead(window_start) OVER (PARTITION BY symbol ORDER BY window_start) AS nxt FROM c)",
        ],
        """SELECT symbol, window_start, open, high, low, close, volume, trade_count, 0 AS filled FROM c
           UNION ALL
           SELECT symbol, w AS window_start, close, close, close, close, CAST(0 AS DECIMAL(18,8)), CAST(0 AS BIGINT), 1
           FROM (SELECT symbol, close, unnest(generate_series(window_start + INTERVAL 1 HOUR, nxt - INTERVAL 1 HOUR, INTERVAL 1 HOUR)) AS w
                 FROM n WHERE nxt > window_start + INTERVAL 1 HOUR)""",
    ),
)
def _(spark, d):
    return cd.fill_quiet_windows(cd.candles(dv.events_trades(spark, d), HOUR_MS), HOUR_MS)


@query(
    "win6_latest_by_row_number",
    s.with_(
        [s.TRADES, s.ARCHIVE, s.mine()],
        """SELECT symbol, window_start, close, volume, run_id FROM (
             SELECT *, row_number() OVER (PARTITION BY symbol, window_start ORDER BY ingested_at DESC, run_id DESC) AS rn FROM mine)
           WHERE rn = 1""",
    ),
)
def _(spark, d):
    # An aggregate instead of a ranked window: the map side already drops all but one row per key.
    row = F.struct("close", "volume", "run_id")
    return (
        dv.own_of(spark, d).groupBy("symbol", "window_start")
        .agg(F.max_by(row, F.struct("ingested_at", "run_id")).alias("l"))
        .select("symbol", "window_start", "l.*")
    )
