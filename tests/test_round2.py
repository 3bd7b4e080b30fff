"""Cases that earlier rules got wrong: NULL keys, wide numbers, skipped hours, vanished windows, ended series, lost batches."""

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tapecheck.functions.timecols import kst_text, text, wall_clock
from tapecheck.operators import continuity as ct, diagnosis as dg, monitor as mo
from tapecheck.operators.candles import candles
from tapecheck.operators.scan import number_within, ordered_scan, rows_before
from tapecheck.settings import HOUR_MS
from tapecheck.sources.official import official_rows
from tapecheck.streaming import sinks

TRADE = "symbol string, event_ms bigint, seq_in_ms bigint, price decimal(18,4), volume decimal(18,8)"


def trades(spark, rows):
    return spark.createDataFrame(rows, "symbol string, event_ms bigint, seq_in_ms bigint, p string, v string").select(
        "symbol", "event_ms", "seq_in_ms", F.col("p").cast("decimal(18,4)").alias("price"), F.col("v").cast("decimal(18,8)").alias("volume")
    )


@pytest.mark.parametrize("size", [60, 10_000])
def test_null_keys_are_a_group_of_their_own(spark, size):
    rows = [(None if k % 10 == 0 else f"k{k % 3}", k // 4, k) for k in range(1000)]
    df = spark.createDataFrame(rows, "k string, t bigint, id bigint")
    got = ordered_scan(df, ["k"], ["t", "id"], [rows_before("n")], rows_per_slice=size).collect()
    seen = {}
    for k, _, i in rows:
        assert next(r.n for r in got if r.id == i) == seen.get(k, 0)
        seen[k] = seen.get(k, 0) + 1
    assert len(got) == 1000


def test_null_keys_are_numbered_across_slices_of_a_hot_instant(spark):
    rows = [(None, 5, k) for k in range(900)] + [("a", k, k) for k in range(100)]
    df = spark.createDataFrame(rows, "k string, t bigint, id bigint")
    got = number_within(df, ["k"], "t", ["id"], "n", rows_per_slice=50).where("k is null").orderBy("id").collect()
    assert [r.n for r in got] == list(range(900))


def test_numbers_beyond_the_packed_key_are_refused_or_ordered(spark):
    t = trades(spark, [("a", 1000, 2**20 + 5, "1", "1"), ("a", 1001, 0, "2", "1")])
    with pytest.raises(PySparkException, match="wide_numbers"):
        candles(t, HOUR_MS).collect()
    row = candles(t, HOUR_MS, wide_numbers=True).first()
    assert (float(row.open), float(row.close)) == (1.0, 2.0)


def test_text_of_an_hour_that_the_session_zone_skips(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        at = spark.sql("SELECT TIMESTAMP_NTZ'2024-03-10 02:30:00.25' AS t").select(text("t").alias("t"), kst_text("t").alias("k")).first()
        assert (at.t, at.k) == ("2024-03-10 02:30:00.250", "2024-03-10 11:30:00.250")
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_blank_volume_is_zero(spark):
    page = spark.createDataFrame([("a", HOUR_MS, "1", "1", "1", "1", "\t ")], "symbol string, label_ms bigint, open string, high string, low string, close string, volume string")
    assert official_rows(page, F.lit(None).cast("timestamp_ntz"), HOUR_MS).first().volume == 0


def test_vanished_windows_are_counted(spark):
    t = trades(spark, [("a", 10, 0, "1", "1"), ("a", HOUR_MS + 10, 0, "1", "1"), ("a", HOUR_MS + 5000, 0, "2", "1")])
    row = dg.slice_sensitivity(t, lambda x: candles(x, HOUR_MS), 0, 1000, HOUR_MS).first()
    assert (row.windows, row.vanished, row.open_moved, row.volume_moved) == (2, 1, 1, 1)


def test_an_ended_series_has_no_level(spark):
    s = spark.createDataFrame([("a", 0, 1, 5.0), ("b", 0, 2, 1.0), ("b", 10_000, 3, 2.0)], "job string, ts_ms bigint, id bigint, value double")
    got = {(r.job, r.eval_ms): r.level for r in mo.level(s, ["job"], 1000, "id", lookback_ms=3000).collect()}
    assert got == {("a", 0): 5.0, ("a", 1000): 5.0, ("a", 2000): 5.0, ("b", 0): 1.0, ("b", 1000): 1.0, ("b", 2000): 1.0, ("b", 10_000): 2.0}


def test_overlaps_are_counted_without_listing_them(spark):
    rows = [("a", 0, 10), ("b", 10, 20), ("c", 5, 6), ("d", 21, 30), ("e", 0, 40), ("f", 6, 6)]
    spans = spark.createDataFrame(rows, "conn_id string, t0 bigint, t1 bigint")
    want = sum(a[1] <= b[2] and b[1] <= a[2] for k, a in enumerate(rows) for b in rows[:k])
    assert ct.overlap_count(spans).first()[0] == want == ct.connection_overlaps(spans).count()
    assert ct.overlap_count(spans.where("false")).first()[0] == 0


def test_second_store_is_refilled(spark, tmp_path):
    a, b = f"{tmp_path}/first", f"{tmp_path}/second"
    base = spark.range(6).select(
        F.concat(F.lit("s"), "id").alias("symbol"), wall_clock(F.col("id") * HOUR_MS).alias("window_start"),
        *[F.lit(1).cast("decimal(18,4)").alias(c) for c in ("open", "high", "low", "close")],
        F.lit(1).cast("decimal(18,8)").alias("volume"), F.lit(1).cast("bigint").alias("trade_count"),
    )
    rows = sinks.candle_row(base, "r1")
    write = sinks.fan_out(sinks.append_only(a), lambda batch, n: sinks.by_batch(b)(batch, n) if n != 1 else 1 / 0)
    for n in range(3):
        write(rows.where(f"int(substr(symbol, 2)) % 3 = {n}"), n)
    assert spark.read.parquet(b).count() == 4
    assert sinks.refill_second(spark, a, b) == 2 and spark.read.parquet(b).count() == 6
    assert sinks.refill_second(spark, a, b) == 0
    assert sinks.refill_second(spark, a, f"{tmp_path}/third") == 6
