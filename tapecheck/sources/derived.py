"""Trade-shaped tables that Spark derives from the generic ``events`` and ``lineitem`` tables.

Every row of the input becomes a trade. The *stored* archive then carries injected faults
(records lost, records delivered twice) so that the checks have something to find; the
faults are functions of the row id, so any engine can reproduce them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tapecheck.functions.timecols import bucket_start, epoch_ms, wall_clock
from tapecheck.operators.candles import candles
from tapecheck.settings import HOUR_MS, MINUTE_MS

LOST_EVERY = 211
TWICE_EVERY = 307


def events_trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trades_from_events(spark.read.parquet(f"{sf_dir}/events.parquet"))


def trades_from_events(events: DataFrame) -> DataFrame:
    """One trade per event, batch or stream. No shuffle: every field comes from the row itself."""
    e = events.select("event_id", "ts", "event_type", "value")
    i = F.col("event_id")
    synth = i % 50 == 0
    return (
        e.withColumn("event_ms", epoch_ms("ts"))
        .select(
            "event_id",
            F.col("event_type").alias("symbol"),
            "event_ms",
            F.pmod((F.extract(F.lit("SECOND"), "ts") * 1_000_000).cast("bigint"), F.lit(1000)).cast("int").alias("seq_in_ms"),
            (F.col("event_ms") + (i * 37) % 4001 - 200).alias("ingest_ms"),
            (F.lit(100) + F.col("value")).cast("decimal(18,4)").alias("price"),
            (F.lit(1) + i % 50).cast("decimal(18,8)").alias("volume"),
            F.lit("KRW").alias("currency"),
            F.when(synth, F.lit("synth-1")).otherwise(F.concat(F.lit("c"), (i - i % 1000).cast("string"))).alias("conn_id"),
            F.when(synth, F.expr("event_id div 50 + 1"))
            .otherwise(F.expr("event_id % 1000 - (event_id % 1000 + 49) div 50 + 1"))
            .alias("recv_seq"),
            (F.ascii("event_type") % 3).cast("int").alias("kafka_partition"),
        )
    )


def disordered(trades: DataFrame) -> DataFrame:
    """The same trades with arrival delays of up to four hours, so that order really breaks."""
    return trades.withColumn("ingest_ms", F.col("event_ms") + (F.col("event_id") * 2_654_435) % 14_400_000)


def boundary_shifted(trades: DataFrame, window_ms: int = HOUR_MS, head_ms: int = 600_000) -> DataFrame:
    """Trades of every fifth window's first minutes, stamped as if they fell into the window
    before: what a clock or rounding fault at the boundary does."""
    e = F.col("event_ms")
    hit = (F.expr(f"event_ms div {window_ms}") % 5 == 0) & (F.pmod(e, F.lit(window_ms)) < head_ms)
    return trades.withColumn("event_ms", F.when(hit, e - head_ms).otherwise(e))


def archive(trades: DataFrame) -> DataFrame:
    """What the raw-trade archive holds after loss and double delivery. One pass, no union."""
    i = F.col("event_id")
    copies = (i % LOST_EVERY != 0).cast("int") + (i % TWICE_EVERY == 0).cast("int")
    return (
        trades.withColumn("copy", F.explode(F.array_repeat(F.lit(1), copies))).drop("copy")
    )


def archive_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive(events_trades(spark, sf_dir))


def official_candles(trades: DataFrame, window_ms: int = HOUR_MS) -> DataFrame:
    """Answer-key candles with a second, older fetch that must lose to the newer one."""
    c = candles(trades.filter(~F.col("conn_id").like("synth%")), window_ms)
    n = epoch_ms("window_start") / F.lit(window_ms)
    older = (n.cast("bigint") % 7 == 0)
    half = f"INTERVAL {window_ms // 2000} SECONDS"
    full = f"INTERVAL {window_ms // 1000} SECONDS"
    fetches = F.when(
        older,
        F.array(
            F.struct(F.lit(0).alias("bump"), F.expr(full).alias("after")),
            F.struct(F.lit(1).alias("bump"), F.expr(half).alias("after")),
        ),
    ).otherwise(F.array(F.struct(F.lit(0).alias("bump"), F.expr(full).alias("after"))))
    return c.withColumn("f", F.explode(fetches)).select(
        "symbol", "window_start", "open", "high", "low", "close",
        (F.col("volume") + F.col("f.bump")).cast("decimal(18,8)").alias("volume"),
        (F.col("window_start") + F.col("f.after")).alias("fetched_at"),
    )


def own_candles(stored: DataFrame, window_ms: int = HOUR_MS) -> DataFrame:
    """Candles as written by the job: some windows twice (two runs), some never."""
    c = candles(stored, window_ms)
    n = (epoch_ms("window_start") / F.lit(window_ms)).cast("bigint")
    first = F.struct(F.lit(66).alias("s"), F.lit("r1").alias("run_id"))
    second = F.struct(F.lit(126).alias("s"), F.lit("r2").alias("run_id"))
    writes = F.when(n % 13 == 0, F.array(first, second)).otherwise(F.array(first))
    return (
        c.filter(n % 17 != 0)
        .withColumn("w", F.explode(writes))
        .select(
            "symbol", "window_start", "open", "high", "low", "close", "volume", "trade_count",
            wall_clock(epoch_ms("window_start") + F.col("w.s") * 1000).alias("ingested_at"),
            F.col("w.run_id").alias("run_id"),
        )
    )


def official_of(spark: SparkSession, sf_dir: str, window_ms: int = HOUR_MS) -> DataFrame:
    return official_candles(events_trades(spark, sf_dir), window_ms)


def own_of(spark: SparkSession, sf_dir: str, window_ms: int = HOUR_MS) -> DataFrame:
    return own_candles(archive_of(spark, sf_dir), window_ms)


def lineitem_trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The large batch input: one trade per order line, traded in the day it was shipped."""
    return trades_from_lineitem(spark.read.parquet(f"{sf_dir}/lineitem.parquet"))


def trades_from_lineitem(lineitem: DataFrame, symbol: str = "l_suppkey") -> DataFrame:
    li = lineitem.select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_shipdate"
    )
    ms_of_day = F.pmod(
        F.col("l_orderkey") * 7919 + F.col("l_linenumber") * 104729 + F.col("l_partkey"), F.lit(86_400_000)
    )
    return li.select(
        F.col(symbol).alias("symbol"),
        (F.unix_date(F.to_date("l_shipdate")).cast("bigint") * 86_400_000 + ms_of_day).alias("event_ms"),
        ((F.col("l_orderkey") % 100_000) * 8 + F.col("l_linenumber")).cast("int").alias("seq_in_ms"),
        F.col("l_extendedprice").cast("decimal(18,4)").alias("price"),
        F.col("l_quantity").cast("decimal(18,8)").alias("volume"),
    )


def stored_trades(trades: DataFrame) -> DataFrame:
    """In-flight trades to archive rows (event and ingest time as wall-clock timestamps)."""
    return trades.withColumns(
        {"event_time": wall_clock("event_ms"), "ingest_time": wall_clock("ingest_ms")}
    ).drop("event_ms", "ingest_ms")


def in_flight(stored: DataFrame) -> DataFrame:
    """Archive rows back to epoch milliseconds."""
    return stored.withColumns(
        {"event_ms": epoch_ms("event_time"), "ingest_ms": epoch_ms("ingest_time")}
    ).drop("event_time", "ingest_time")


__all__ = [
    "archive", "archive_of", "bucket_start", "disordered", "events_trades", "in_flight",
    "lineitem_trades", "official_candles", "official_of", "own_candles", "own_of",
    "stored_trades", "MINUTE_MS",
]
