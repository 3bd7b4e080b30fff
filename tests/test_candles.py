"""Literal candle cases, and invariance under order and partitioning."""

import random
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from tapecheck.functions.numbers import price_of, volume_of
from tapecheck.operators.candles import (
    candles, fill_quiet_windows, finish_partials, merge_partials, partial_candles, session_candles,
)
from tapecheck.operators.dedup import latest_candles, latest_official

MIN = 60_000


def trades(spark, rows, symbol="A"):
    raw = spark.createDataFrame([(symbol, *r) for r in rows], "symbol string, event_ms bigint, seq_in_ms int, p string, v string")
    return raw.select("symbol", "event_ms", "seq_in_ms", price_of(F.col("p")).alias("price"), volume_of(F.col("v")).alias("volume"))


CASES = {
    "basic": ([(1000, 0, "100", "1"), (2000, 0, "120", "2"), (3000, 0, "90", "3"), (4000, 0, "110", "4")], ("100", "120", "90", "110", "10", 4)),
    "late arrival": ([(2000, 0, "120", "1"), (3000, 0, "90", "1"), (1000, 0, "100", "1"), (4000, 0, "110", "1")], ("100", "120", "90", "110", "4", 4)),
    "same ms": ([(1000, 2, "102", "1"), (1000, 0, "100", "1"), (1000, 1, "101", "1")], ("100", "102", "100", "102", "3", 3)),
    "single": ([(1000, 0, "71800", "5")], ("71800", "71800", "71800", "71800", "5", 1)),
    "exact volume": ([(1000, 0, "1", "0.1"), (2000, 0, "1", "0.2")], ("1", "1", "1", "1", "0.3", 2)),
    "cut not rounded": ([(1000, 0, "100.999999", "1")], ("100.9999", "100.9999", "100.9999", "100.9999", "1", 1)),
}


@pytest.mark.parametrize("case", CASES)
@pytest.mark.parametrize("exact_ties", [False, True])
def test_literal_cases(spark, case, exact_ties):
    rows, want = CASES[case]
    r = candles(trades(spark, rows), MIN, run_id="r", exact_ties=exact_ties).collect()
    assert len(r) == 1 and r[0].run_id == "r"
    assert tuple(r[0][c] for c in ("open", "high", "low", "close", "volume")) == tuple(D(x) for x in want[:5])
    assert r[0].trade_count == want[5]


def test_empty_gives_no_row(spark):
    assert candles(trades(spark, []), MIN).count() == 0


def test_merge(spark):
    a = partial_candles(trades(spark, [(3000, 0, "130", "1"), (4000, 0, "140", "1")]), MIN)
    b = partial_candles(trades(spark, [(1000, 0, "110", "1"), (2000, 0, "120", "1")]), MIN)
    r = finish_partials(merge_partials(a.unionByName(b))).first()
    assert (r.open, r.close, r.trade_count) == (D("110"), D("140"), 4)


def test_order_and_partitioning_do_not_matter(spark):
    rnd = random.Random(1)
    rows = [(rnd.randrange(300_000), i, str(rnd.randrange(1, 999)), str(rnd.randrange(1, 9))) for i in range(400)]
    want = sorted(map(tuple, candles(trades(spark, rows), MIN).collect()))
    for seed, parts in ((2, 1), (3, 7)):
        shuffled = rows[:]
        random.Random(seed).shuffle(shuffled)
        got = sorted(map(tuple, candles(trades(spark, shuffled).repartition(parts), MIN).collect()))
        assert got == want


def test_more_trades_in_one_ms_than_16_bits(spark):
    rows = [(1000, 70_000, "7", "1"), (1001, 0, "8", "1"), (1000, 0, "6", "1")]
    r = candles(trades(spark, rows), MIN).first()
    assert (r.open, r.close) == (D("6"), D("8"))


def test_fold_is_a_hash_aggregate(spark):
    plan = candles(trades(spark, CASES["basic"][0]), MIN)._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan


def test_sessions_split_and_spread(spark):
    rows = [(0, 0, "1", "1"), (5_000, 0, "2", "1"), (5_001, 0, "3", "1"), (70_000, 0, "4", "1"), (80_000, 0, "5", "1"), (90_001, 0, "6", "1")]
    for per in (None, 2):
        got = [tuple(r) for r in session_candles(trades(spark, rows), 10_000, rows_per_slice=per).orderBy("session_start")
               .select("open", "close", "trade_count").collect()]
        assert got == [(D(1), D(3), 3), (D(4), D(5), 2), (D(6), D(6), 1)]


def test_fill_quiet_windows(spark):
    rows = [(0, 0, "5", "1"), (4 * MIN, 0, "9", "2")]
    r = fill_quiet_windows(candles(trades(spark, rows), MIN), MIN).orderBy("window_start").collect()
    assert [x.filled for x in r] == [0, 1, 1, 1, 0]
    assert all(x.open == x.close == D(5) and x.volume == 0 for x in r if x.filled)


def test_latest_is_one_whole_row(spark):
    base = "symbol string, window_start timestamp_ntz, open decimal(18,4), high decimal(18,4), low decimal(18,4), close decimal(18,4), volume decimal(18,8), trade_count bigint, ingested_at timestamp_ntz, run_id string"
    import datetime as dt

    w, t = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 1, 0, 1, 6)
    rows = [("A", w, D(1), D(1), D(1), D(1), D(1), 1, t, "r1"), ("A", w, D(2), D(2), D(2), D(2), D(2), 2, t, "r2"),
            ("A", w, D(9), D(9), D(9), D(9), D(9), 9, t - dt.timedelta(seconds=1), "r9")]
    r = latest_candles(spark.createDataFrame(rows, base)).first()
    assert (r.open, r.close, r.volume, r.trade_count, r.write_count) == (D(2), D(2), D(2), 2, 3)
    off = spark.createDataFrame([(*x[:7], x[8]) for x in rows], base.replace("trade_count bigint, ingested_at", "fetched_at").replace(", run_id string", ""))
    assert latest_official(off).first().fetched_at == t


def test_decimal_text(spark):
    vals = [("100.999999", "100.9999"), ("-1.23456", "-1.2345"), ("abc", None), (" 5 ", "5"), ("", None), ("99999999999999999999", None), (None, None)]
    got = spark.createDataFrame([(a,) for a, _ in vals], "t string").select(price_of(F.col("t")).alias("p")).collect()
    assert [g.p for g in got] == [None if b is None else D(b).quantize(D("0.0001")) for _, b in vals]
