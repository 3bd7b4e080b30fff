"""Candles from a stream with Spark's own watermark, window and state store."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tapecheck.functions.numbers import volume_sum
from tapecheck.functions.timecols import arrival_key, wall_clock
from tapecheck.settings import CandleSettings
from tapecheck.sources.stores import with_day


_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def stream_session(spark: SparkSession, several_states: bool = False) -> SparkSession:
    """Session for stateful queries. The first run fixes the number of state partitions for the life of
    the checkpoint, so it is the configured one, whatever number of executors exists at the start.

    A processor with state variables and timers of its own (``several_states``) needs a state store with
    column families. Spark's default store has none, so such a session names one that has.
    """
    s = spark.newSession()
    s.conf.set("spark.sql.shuffle.partitions", spark.conf.get("spark.sql.shuffle.partitions"))
    if several_states:
        s.conf.set("spark.sql.streaming.stateStore.providerClass", _ROCKSDB)
    return s


def window_candles(trades: DataFrame, cfg: CandleSettings) -> DataFrame:
    """One row per (symbol, window), written once, when the watermark passes the window's end.

    The state holds one buffer per open window, never the trades. Windows without trades give no
    row. Late trades are dropped by the engine; the strict path keeps them.
    """
    key = arrival_key("event_ms", "seq_in_ms")
    return (
        trades.withColumn("event_time", F.timestamp_millis("event_ms"))
        .withWatermark("event_time", f"{cfg.watermark_delay_ms} milliseconds")
        .groupBy("symbol", F.window("event_time", f"{cfg.window_ms} milliseconds").alias("w"))
        .agg(
            F.min_by("price", key).alias("open"),
            F.max("price").alias("high"),
            F.min("price").alias("low"),
            F.max_by("price", key).alias("close"),
            volume_sum().alias("volume"),
            F.count(F.lit(1)).alias("trade_count"),
        )
        .select("symbol", wall_clock(F.unix_millis("w.start")).alias("window_start"), "open", "high", "low", "close", "volume", "trade_count")
    )


def session_candles(trades: DataFrame, gap_ms: int, cfg: CandleSettings) -> DataFrame:
    """One row per (symbol, session), written once, when the watermark passes the session's end.

    The state holds one buffer per open session; buffers whose spans touch are merged when a trade joins
    them, late ones included as long as the watermark allows. A quiet time of ``gap_ms`` and no more still belongs to the session
    (the engine itself would end it there, so its gap is one millisecond longer).
    """
    key = arrival_key("event_ms", "seq_in_ms")
    return (
        trades.withColumn("event_time", F.timestamp_millis("event_ms"))
        .withWatermark("event_time", f"{cfg.watermark_delay_ms} milliseconds")
        .groupBy("symbol", F.session_window("event_time", f"{gap_ms + 1} milliseconds").alias("w"))
        .agg(
            F.min_by("price", key).alias("open"),
            F.max("price").alias("high"),
            F.min("price").alias("low"),
            F.max_by("price", key).alias("close"),
            volume_sum().alias("volume"),
            F.count(F.lit(1)).alias("trade_count"),
        )
        .select(
            "symbol", wall_clock(F.unix_millis("w.start")).alias("session_start"), wall_clock(F.unix_millis("w.end") - 1).alias("session_end"),
            "open", "high", "low", "close", "volume", "trade_count",
        )
    )


def rolled_up(trades: DataFrame, cfg: CandleSettings, wide_ms: int) -> DataFrame:
    """Candles of ``wide_ms`` made of the candles of ``cfg.window_ms`` in the same query: two stateful aggregates in a chain.

    The first one closes its windows by the watermark and drops late trades, the second one merges closed
    windows by their window time. A wide candle is thus made of exactly the narrow candles that were written.
    """
    if wide_ms % cfg.window_ms:
        raise ValueError("the wide window must be a multiple of the narrow one")
    key = arrival_key("event_ms", "seq_in_ms")
    narrow = (
        trades.withColumn("event_time", F.timestamp_millis("event_ms"))
        .withWatermark("event_time", f"{cfg.watermark_delay_ms} milliseconds")
        .groupBy("symbol", F.window("event_time", f"{cfg.window_ms} milliseconds").alias("w"))
        .agg(
            F.min(key).alias("open_key"),
            F.max(key).alias("close_key"),
            F.min_by("price", key).alias("open"),
            F.max("price").alias("high"),
            F.min("price").alias("low"),
            F.max_by("price", key).alias("close"),
            volume_sum().alias("volume"),
            F.count(F.lit(1)).alias("trade_count"),
        )
    )
    return (
        narrow.groupBy("symbol", F.window(F.window_time("w"), f"{wide_ms} milliseconds").alias("w"))
        .agg(
            F.min_by("open", "open_key").alias("open"),
            F.max("high").alias("high"),
            F.min("low").alias("low"),
            F.max_by("close", "close_key").alias("close"),
            F.sum("volume").cast("decimal(18,8)").alias("volume"),
            F.sum("trade_count").alias("trade_count"),
            F.count(F.lit(1)).alias("windows"),
        )
        .select(
            "symbol", wall_clock(F.unix_millis("w.start")).alias("window_start"), "open", "high", "low", "close", "volume", "trade_count", "windows",
        )
    )


def open_windows(spark: SparkSession, checkpoint: str) -> DataFrame:
    """Windows that a stopped query still holds, read from its state store.

    Spark's watermark only moves with events: when all is quiet the last windows stay open, and this is the
    list of what has not been written yet. One row per (symbol, window), one task per state partition.
    """
    held = spark.read.format("statestore").option("path", checkpoint).load()
    return held.select(
        F.col("key.symbol").alias("symbol"),
        wall_clock(F.unix_millis("key.window.start")).alias("window_start"),
        wall_clock(F.unix_millis("key.window.end")).alias("window_end"),
        F.col("value.count").alias("trade_count"),
    )


def to_files(stream: DataFrame, path: str, checkpoint: str, time_col: str, trigger: dict | None = None):
    """Transactional file sink: files count only once their batch is in the commit log."""
    return (
        with_day(stream, time_col)
        .writeStream.format("parquet")
        .partitionBy("day")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def to_batches(stream: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str, trigger: dict | None = None):
    return (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def discard(stream: DataFrame, checkpoint: str, trigger: dict | None = None):
    """Count and drop: the rows only feed the observed metrics."""
    return (
        stream.writeStream.format("noop")
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
