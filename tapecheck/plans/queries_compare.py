"""Own candles against the answer key, the raw archive and the second store."""

from __future__ import annotations

from pyspark.sql import functions as F

from tapecheck.operators import candles as cd, compare as cmp, dedup, diagnosis as dg
from tapecheck.plans import sqlparts as s
from tapecheck.plans.catalog import query
from tapecheck.plans.queries_aggregates import _CONT, _SPANS
from tapecheck.plans.queries_parsing import _LETTERS, _REASONS, _letters as letters_of
from tapecheck.plans.verify import verification_report
from tapecheck.settings import HOUR_MS
from tapecheck.sources import derived as dv, stores

_S = s.STORES

_DIFF = """diff AS (
  SELECT o.symbol, o.window_start, CASE WHEN m.symbol IS NULL THEN 1 ELSE 0 END AS missing,
         coalesce(m.write_count, 0) AS write_count, coalesce(m.trade_count, 0) AS my_trade_count,
         CAST(m.close - o.close AS DECIMAL(18,4)) AS close_diff,
         CAST(m.volume - o.volume AS DECIMAL(18,8)) AS volume_diff,
         CAST(abs(m.volume - o.volume) AS DOUBLE) / nullif(CAST(o.volume AS DOUBLE), 0) AS volume_rel_err
  FROM official_latest o LEFT JOIN mine_latest m ON o.symbol = m.symbol AND o.window_start = m.window_start)"""


def _both(spark, d):
    return dv.own_of(spark, d), dv.official_of(spark, d)


@query("jn1_candle_diff", s.with_([*_S, _DIFF], "SELECT * FROM diff"))
def _(spark, d):
    return cmp.candle_diff(*_both(spark, d))


@query("flt6_problem_windows", s.with_([*_S, _DIFF], "SELECT * FROM diff WHERE missing = 1 OR write_count > 1"))
def _(spark, d):
    return cmp.problem_windows(cmp.candle_diff(*_both(spark, d)))


@query(
    "agg11_diff_summary",
    s.with_(
        [*_S, _DIFF],
        """SELECT count(*) AS n_official, count(*) FILTER (missing = 1) AS n_missing, count(*) FILTER (missing = 0) AS n_matched,
                  count(*) FILTER (close_diff = 0) AS n_close_exact, count(*) FILTER (volume_diff = 0) AS n_vol_exact,
                  count(*) FILTER (write_count > 1) AS n_dup FROM diff""",
    ),
)
def _(spark, d):
    return cmp.diff_summary(cmp.candle_diff(*_both(spark, d)))


_CHECK = f"""raw AS (SELECT symbol, {s.ms_ts('event_ms - event_ms % 3600000')} AS window_start, count(*) AS raw_trades
  FROM archive GROUP BY 1, 2),
chk AS (SELECT r.symbol, r.window_start, r.raw_trades, c.trade_count AS candle_trades, r.raw_trades - c.trade_count AS diff
  FROM raw r JOIN mine_latest c ON r.symbol = c.symbol AND r.window_start = c.window_start)"""


@query("jn2_trade_count_check", s.with_([*_S, _CHECK], "SELECT * FROM chk"))
def _(spark, d):
    return cmp.trade_count_check(dv.archive_of(spark, d), dv.own_of(spark, d), HOUR_MS)


@query(
    "jn2_trade_count_check_all",
    s.with_(
        [*_S, _CHECK],
        """SELECT r.symbol, r.window_start, r.raw_trades, coalesce(c.trade_count, 0) AS candle_trades,
                  r.raw_trades - coalesce(c.trade_count, 0) AS diff
           FROM raw r LEFT JOIN mine_latest c ON r.symbol = c.symbol AND r.window_start = c.window_start""",
    ),
)
def _(spark, d):
    return cmp.trade_count_check(dv.archive_of(spark, d), dv.own_of(spark, d), HOUR_MS, keep_unmatched=True)


@query(
    "agg10_count_check_summary",
    s.with_(
        [*_S, _CHECK],
        "SELECT count(*) AS windows, count(*) FILTER (diff = 0) AS exact, count(*) FILTER (diff <> 0) AS mismatched FROM chk",
    ),
)
def _(spark, d):
    return cmp.count_check_summary(cmp.trade_count_check(dv.archive_of(spark, d), dv.own_of(spark, d), HOUR_MS))


@query(
    "jn3_scorecard",
    s.with_(
        _S,
        """SELECT count(*) AS matched, count(*) FILTER (my_open = off_open) AS open_ok,
                  count(*) FILTER (my_high = off_high) AS high_ok, count(*) FILTER (my_low = off_low) AS low_ok,
                  count(*) FILTER (my_close = off_close) AS close_ok, count(*) FILTER (my_volume = off_volume) AS vol_ok,
                  count(*) FILTER (my_write_count > 1) AS duplicated,
                  round(CAST(count(*) FILTER (my_volume = off_volume) AS DOUBLE) / nullif(count(*), 0) * 100, 2) AS vol_pct
           FROM matched""",
    ),
)
def _(spark, d):
    return cmp.scorecard(*_both(spark, d))


@query("agg9_matched_windows", s.with_(_S, "SELECT symbol, window_start, my_volume, off_volume, my_close, off_close, my_write_count FROM matched"))
def _(spark, d):
    return cmp.matched(*_both(spark, d)).select(
        "symbol", "window_start", "my_volume", "off_volume", "my_close", "off_close", "my_write_count"
    )


@query("flt5_mismatches", s.with_(_S, "SELECT * FROM mismatches"))
def _(spark, d):
    return cmp.mismatches(*_both(spark, d))


@query(
    "srt2_first_mismatches",
    s.with_(
        _S,
        f"""SELECT {s.kst('window_start')} AS kst, symbol, my_vol, off_vol, vol_diff, close_diff
            FROM (SELECT * FROM mismatches ORDER BY window_start, symbol LIMIT 20)""",
    ),
)
def _(spark, d):
    return cmp.first_mismatches(*_both(spark, d))


@query(
    "srt1_mismatches_in_order",
    s.with_(_S, f"SELECT {s.kst('window_start')} AS kst, symbol, vol_diff, close_diff FROM mismatches ORDER BY window_start, symbol"),
)
def _(spark, d):
    from tapecheck.functions.timecols import kst_text

    return (
        cmp.mismatches(*_both(spark, d))
        .orderBy("window_start", "symbol")
        .select(kst_text("window_start").alias("kst"), "symbol", "vol_diff", "close_diff")
    )


@query(
    "jn5_accuracy_dataset",
    s.with_(
        _S,
        """SELECT window_start + INTERVAL 9 HOUR AS window_kst, symbol, CAST(my_volume AS DOUBLE) AS my_volume,
                  CAST(off_volume AS DOUBLE) AS off_volume, CAST(my_volume - off_volume AS DOUBLE) AS volume_diff,
                  CASE WHEN off_volume = 0 THEN 0.0
                       ELSE CAST(my_volume - off_volume AS DOUBLE) / CAST(off_volume AS DOUBLE) * 100 END AS volume_diff_pct,
                  CAST(my_close - off_close AS DOUBLE) AS close_diff, my_write_count AS write_count FROM matched""",
    ),
)
def _(spark, d):
    return cmp.accuracy_dataset(*_both(spark, d))


@query(
    "jn6_store_vs_store",
    s.with_(
        [*_S, """second AS (SELECT * FROM mine WHERE run_id = 'r1')"""],
        """SELECT count(*) AS matched,
                  count(*) FILTER (m.open = x.open AND m.high = x.high AND m.low = x.low AND m.close = x.close
                                   AND m.volume = x.volume AND m.trade_count = x.trade_count) AS identical
           FROM mine_latest m JOIN second x ON m.symbol = x.symbol AND m.window_start = x.window_start""",
    ),
)
def _(spark, d):
    own = dv.own_of(spark, d)
    return cmp.store_vs_store(own, own.filter(F.col("run_id") == "r1"))


@query(
    "src7_cross_store_scan",
    s.with_([*_S], "SELECT symbol, window_start, volume, trade_count FROM mine WHERE run_id = 'r1' AND window_start >= TIMESTAMP '2024-01-10 00:00:00'"),
)
def _(spark, d):
    # The second store is written day by day, then read back with a pruned, column-wise scan.
    path = stores.write_by_day(dv.own_of(spark, d).filter(F.col("run_id") == "r1"), "window_start", "second-store")
    return stores.read_days(spark, path, first_day="2024-01-10").select("symbol", "window_start", "volume", "trade_count")


@query(
    "jn7_alignment_probe",
    s.with_(
        [*_S, "sh AS (SELECT unnest([-3600000, 0, 3600000]) AS shift_ms)"],
        """SELECT CAST(shift_ms AS BIGINT) AS shift_ms, count(*) AS matched, count(*) FILTER (m.volume = o.volume) AS vol_exact,
                  count(*) FILTER (m.close = o.close) AS close_exact
           FROM mine_latest m, sh, official_latest o
           WHERE o.symbol = m.symbol AND epoch_ms(o.window_start) = epoch_ms(m.window_start) - shift_ms GROUP BY 1""",
    ),
)
def _(spark, d):
    return cmp.alignment_probe(*_both(spark, d), HOUR_MS)


@query(
    "jn8_volume_recheck",
    s.with_(
        [*_S, f"""raw AS (SELECT symbol, {s.ms_ts('event_ms - event_ms % 3600000')} AS window_start,
                CAST(sum(volume) AS DECIMAL(18,8)) AS raw_volume FROM archive GROUP BY 1, 2)"""],
        """SELECT r.symbol, r.window_start, r.raw_volume, m.volume AS candle_volume,
                  CASE WHEN r.raw_volume = m.volume THEN 1 ELSE 0 END AS same
           FROM raw r JOIN mine_latest m ON r.symbol = m.symbol AND r.window_start = m.window_start""",
    ),
)
def _(spark, d):
    return cmp.volume_recheck(dv.archive_of(spark, d), dv.own_of(spark, d), HOUR_MS)


@query(
    "agg13_range_summary",
    s.with_(
        _S,
        f"""SELECT 'mine' AS src, count(*) AS n_rows, {s.kst('min(window_start)')} AS first_kst, {s.kst('max(window_start)')} AS last_kst FROM mine
            UNION ALL SELECT 'official', count(*), {s.kst('min(window_start)')}, {s.kst('max(window_start)')} FROM official""",
    ),
)
def _(spark, d):
    return cmp.range_summary(*_both(spark, d))


@query(
    "set1_union_of_stores",
    s.with_(
        _S,
        """SELECT 'mine' AS src, symbol, window_start, volume FROM mine
           UNION ALL SELECT 'official', symbol, window_start, volume FROM official""",
    ),
)
def _(spark, d):
    own, off = _both(spark, d)
    cols = ["symbol", "window_start", "volume"]
    return own.select(F.lit("mine").alias("src"), *cols).unionByName(off.select(F.lit("official").alias("src"), *cols))


@query(
    "set2_total_or_zero",
    s.with_(_S, "SELECT coalesce(sum(trade_count), 0)::BIGINT AS total FROM mine WHERE run_id = 'never'"),
)
def _(spark, d):
    return dv.own_of(spark, d).filter(F.col("run_id") == "never").agg(
        F.coalesce(F.sum("trade_count"), F.lit(0)).cast("bigint").alias("total")
    )


@query(
    "agg15_sink_comparison",
    s.with_(
        _S,
        """SELECT store, count(*) AS windows, CAST(sum(n) AS BIGINT) AS rows_written, count(*) FILTER (n > 1) AS duplicated_windows
           FROM (SELECT 'first' AS store, symbol, window_start, count(*) AS n FROM mine GROUP BY ALL
                 UNION ALL SELECT 'second', symbol, window_start, count(*) FROM mine WHERE run_id = 'r1' GROUP BY ALL)
           GROUP BY 1""",
    ),
)
def _(spark, d):
    own = dv.own_of(spark, d)
    return cmp.sink_comparison({"first": own, "second": own.filter(F.col("run_id") == "r1")})


@query("snk9_official_latest", s.with_([s.TRADES, s.official(), s.OFFICIAL_LATEST], "SELECT * FROM official_latest"))
def _(spark, d):
    return dedup.latest_official(dv.official_of(spark, d))


_REAL_SPANS = """spans AS (SELECT conn_id, min(ingest_ms) AS t0, max(ingest_ms) AS t1 FROM archive
  WHERE conn_id NOT LIKE 'synth%' AND conn_id NOT LIKE 'replay%' GROUP BY 1),
gaps AS (SELECT t1 AS a, nt AS b FROM (SELECT *, lead(t0) OVER (ORDER BY t0, t1) AS nt FROM spans) WHERE nt > t1)"""
_GAP_WINDOWS = f"""gap_windows AS (
  SELECT {s.ms_ts('w')} AS window_start, CAST(sum(least(b, w + 3600000) - greatest(a, w)) AS BIGINT) AS gap_ms, count(*) AS gaps
  FROM (SELECT a, b, unnest(generate_series(a - a % 3600000, b - b % 3600000, 3600000)) AS w FROM gaps)
  WHERE least(b, w + 3600000) > greatest(a, w) GROUP BY 1)"""


@query(
    "jn11_gap_explained",
    s.with_(
        [*_S, _REAL_SPANS, _GAP_WINDOWS],
        "SELECT m.symbol, m.window_start, m.vol_diff, g.gap_ms, g.gaps FROM mismatches m JOIN gap_windows g ON m.window_start = g.window_start",
    ),
)
def _(spark, d):
    own, off = _both(spark, d)
    return dg.gap_explained(cmp.mismatches(own, off), dv.archive_of(spark, d), HOUR_MS)


_SYM = """sym AS (
  SELECT a.symbol, a.window_start, a.vol_diff, b.vol_diff AS next_diff
  FROM mismatches a JOIN mismatches b ON a.symbol = b.symbol AND b.window_start = a.window_start + INTERVAL 1 HOUR
  WHERE a.vol_diff <> 0 AND a.vol_diff + b.vol_diff = 0)"""


_SHIFTED = [s.TRADES, s.BOUNDARY, f"mine AS ({s.ohlcv('shifted', HOUR_MS)})", s.official(), s.OFFICIAL_LATEST,
            """mismatches AS (SELECT m.symbol, m.window_start, CAST(m.volume - o.volume AS DECIMAL(18,8)) AS vol_diff
               FROM mine m JOIN official_latest o ON m.symbol = o.symbol AND m.window_start = o.window_start
               WHERE m.volume <> o.volume OR m.close <> o.close)""", _SYM]


@query("win7_adjacent_symmetry", s.with_(_SHIFTED, "SELECT * FROM sym"))
def _(spark, d):
    trades = dv.events_trades(spark, d).filter(~F.col("conn_id").like("synth%"))
    own = cd.candles(dv.boundary_shifted(trades), HOUR_MS).withColumns(
        {"ingested_at": F.col("window_start"), "run_id": F.lit("r1")}
    )
    return dg.adjacent_symmetry(cmp.mismatches(own, dv.official_of(spark, d)), HOUR_MS)


@query(
    "exp1_mismatch_verdicts",
    s.with_(
        [*_S, _CHECK, _SYM, _REAL_SPANS, _GAP_WINDOWS],
        f"""SELECT m.symbol, m.window_start, m.vol_diff, m.close_diff,
           CASE WHEN EXISTS (SELECT 1 FROM sym y WHERE y.symbol = m.symbol
                             AND (y.window_start = m.window_start OR y.window_start + INTERVAL 1 HOUR = m.window_start)) THEN 'boundary'
                WHEN m.vol_diff < 0 AND EXISTS (SELECT 1 FROM gap_windows g WHERE g.window_start = m.window_start) THEN 'source-gap'
                WHEN m.vol_diff < 0 AND EXISTS (SELECT 1 FROM chk c WHERE c.symbol = m.symbol AND c.window_start = m.window_start AND c.diff > 0) THEN 'truncated'
                WHEN EXISTS (SELECT 1 FROM archive a WHERE a.symbol = m.symbol AND (a.conn_id LIKE 'synth%' OR a.conn_id LIKE 'replay%')
                             AND {s.ms_ts('a.event_ms - a.event_ms % 3600000')} = m.window_start) THEN 'contaminated'
                ELSE 'unexplained' END AS verdict
           FROM mismatches m""",
    ),
)
def _(spark, d):
    own, off = _both(spark, d)
    return dg.classify_mismatches(own, off, dv.archive_of(spark, d), HOUR_MS)


@query(
    "exp2_sign_distribution",
    s.with_(
        _S,
        """SELECT positive, negative, CASE WHEN positive > 0 AND negative > 0 THEN 'alignment' WHEN negative > 0 THEN 'loss'
                  WHEN positive > 0 THEN 'duplication' ELSE 'exact' END AS reading
           FROM (SELECT count(*) FILTER (vol_diff > 0) AS positive, count(*) FILTER (vol_diff < 0) AS negative FROM mismatches)""",
    ),
)
def _(spark, d):
    return dg.sign_distribution(cmp.mismatches(*_both(spark, d)))


_CUT = "kept AS (SELECT * FROM trades WHERE NOT (event_ms % 3600000 >= 1200000 AND event_ms % 3600000 < 1800000))"


@query(
    "exp9_slice_sensitivity",
    s.with_(
        [s.TRADES, _CUT, f"f AS ({s.ohlcv('trades', HOUR_MS)})", f"k AS ({s.ohlcv('kept', HOUR_MS)})"],
        """SELECT count(*) AS windows, count(*) FILTER (k.symbol IS NULL) AS vanished, count(*) FILTER (k.open <> f.open) AS open_moved, count(*) FILTER (k.high <> f.high) AS high_moved,
                  count(*) FILTER (k.low <> f.low) AS low_moved, count(*) FILTER (k.close <> f.close) AS close_moved,
                  count(*) FILTER (k.volume <> f.volume) AS volume_moved
           FROM f LEFT JOIN k ON f.symbol = k.symbol AND f.window_start = k.window_start""",
    ),
)
def _(spark, d):
    return dg.slice_sensitivity(
        dv.events_trades(spark, d), lambda t: cd.candles(t, HOUR_MS), 1_200_000, 1_800_000, HOUR_MS
    )


def _check(section: str, name: str, value: str, bad: str | None = None, good: str = "v = 0") -> str:
    verdict = f"CASE WHEN {good} THEN 'ok' ELSE '{bad}' END" if bad else "'info'"
    return f"""SELECT '{section}' AS section, '{name}' AS "check", CAST(v AS DOUBLE) AS value, {verdict} AS verdict FROM ({value})"""


_REPORT = [
    _check("continuity", "lost", "SELECT coalesce(sum(gaps) FILTER (gaps > 0), 0) AS v FROM continuity", "source loss"),
    _check("continuity", "delivered_twice", "SELECT coalesce(-sum(gaps) FILTER (gaps < 0), 0) AS v FROM continuity", "duplicates"),
    _check("origin", "foreign_rows", "SELECT count(*) AS v FROM archive WHERE regexp_matches(conn_id, '^(synth|replay)')", "scorecard void"),
    _check("origin", "overlapping_pairs", "SELECT count(*) AS v FROM spans a JOIN spans b ON a.conn_id < b.conn_id AND a.t0 <= b.t1 AND b.t0 <= a.t1", "second producer"),
    _check("raw-vs-candle", "windows", "SELECT count(*) AS v FROM chk"),
    _check("raw-vs-candle", "exact", "SELECT count(*) AS v FROM chk WHERE diff = 0"),
    _check("raw-vs-candle", "mismatched", "SELECT count(*) AS v FROM chk WHERE diff <> 0", "lost in the job"),
    _check("scorecard", "matched", "SELECT count(*) AS v FROM matched", "no claim possible", "v > 0"),
    *(_check("scorecard", f"{c}_ok", f"SELECT count(*) AS v FROM matched WHERE my_{c} = off_{c}") for c in ("open", "high", "low", "close")),
    _check("scorecard", "vol_ok", "SELECT count(*) AS v FROM matched WHERE my_volume = off_volume", "not exact", "v = (SELECT count(*) FROM matched)"),
    _check("scorecard", "duplicated", "SELECT count(*) AS v FROM matched WHERE my_write_count > 1", "written more than once"),
    _check("dead-letters", "dropped", "SELECT count(*) AS v FROM letters", "see reasons"),
    """SELECT 'dead-letters', stage || ': ' || reason, CAST(count(*) AS DOUBLE), 'info' FROM letters GROUP BY stage, reason""",
    *(
        f"""SELECT 'range', '{src}, ' || {s.kst('min(window_start)')} || ', ' || {s.kst('max(window_start)')}, CAST(count(*) AS DOUBLE), 'ok' FROM {src}"""
        for src in ("mine", "official")
    ),
]


@query("verify_report", s.with_([*_S, _CONT, _CHECK, _SPANS, _REASONS, _LETTERS], " UNION ALL ".join(_REPORT)))
def _(spark, d):
    return verification_report(dv.archive_of(spark, d), dv.own_of(spark, d), dv.official_of(spark, d), letters_of(spark, d), HOUR_MS)
