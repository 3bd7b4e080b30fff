"""Collapsing repeated writes: latest row per window, as one row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tapecheck.functions.timecols import epoch_us
from tapecheck.schema import OHLCV

# Fixed value: leading bytes of a run's name that take part in the packed key.
RUN_BYTES = 7


def write_key(at: str, run: str | None, *row: str) -> Column:
    """(write time, run) packed into one DECIMAL that sorts the same way; missing parts sort first.

    A number stays in a hash aggregate, where a struct or text would force a sort of all rows. Microseconds take
    17 digits, the first bytes of the run's name 17 more, and three digits of a hash of the row decide between
    equal writes, so that every run of the query picks the same one.
    """
    name = F.lit(0) if run is None else F.conv(F.rpad(F.substring(F.hex(F.col(run)), 1, 2 * RUN_BYTES), 2 * RUN_BYTES, "0"), 16, 10)
    us = F.coalesce(epoch_us(at), F.lit(0)).cast("decimal(17,0)")
    second = F.coalesce(name.cast("decimal(17,0)"), F.lit(0).cast("decimal(17,0)"))
    last = F.pmod(F.xxhash64(*row), F.lit(1000)).cast("decimal(3,0)")
    return ((us * F.lit("1" + "0" * 20).cast("decimal(21,0)")).cast("decimal(38,0)") + (second * F.lit(1000).cast("decimal(4,0)") + last)).cast("decimal(38,0)")


def latest_candles(candle_rows: DataFrame) -> DataFrame:
    """Latest write of every (symbol, window), all columns from the same row, plus how often it
    was written. More than one write means a restart wrote the window again."""
    row = [*OHLCV, "trade_count"]
    key = F.col("_written")
    return (
        candle_rows.withColumn("_written", write_key("ingested_at", "run_id", *row))
        .groupBy("symbol", "window_start")
        .agg(*[F.max_by(c, key).alias(c) for c in row], F.count(F.lit(1)).alias("write_count"))
    )


def latest_official(official: DataFrame) -> DataFrame:
    """Newest fetch of every official candle."""
    key = F.col("_written")
    return (
        official.withColumn("_written", write_key("fetched_at", None, *OHLCV))
        .groupBy("symbol", "window_start")
        .agg(*[F.max_by(c, key).alias(c) for c in OHLCV], F.max("fetched_at").alias("fetched_at"))
    )
