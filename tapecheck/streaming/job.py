"""The live job: one topic in; candles, archive and dead letters out."""

from __future__ import annotations

import warnings
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from tapecheck.functions.timecols import utc_now, wall_clock
from tapecheck.operators import letters as lt
from tapecheck.settings import CandleSettings
from tapecheck.sources.derived import stored_trades
from tapecheck.sources.stores import with_day
from tapecheck.streaming import candles as sc, sinks
from tapecheck.streaming.strict import StrictCandles


@dataclass(frozen=True)
class JobPaths:
    base: str

    def at(self, name: str) -> str:
        return f"{self.base}/{name}"

    def checkpoint(self, name: str) -> str:
        return f"{self.base}/_checkpoints/{name}"


def valid_trades(records: DataFrame) -> DataFrame:
    """Good trades of the stream, with counters of what was refused."""
    classified = lt.classify(records).observe(
        "records",
        F.count(F.lit(1)).alias("records"),
        F.count_if(F.col("reason") == "malformed-json").alias("malformed_json"),
        F.count_if(F.col("reason").isin("missing-symbol", "missing-field")).alias("missing_field"),
        F.count_if(F.col("reason") == "malformed-number").alias("malformed_number"),
    )
    return lt.good_trades(classified)


def start_candles(records: DataFrame, cfg: CandleSettings, paths: JobPaths, strict: bool = False, trigger: dict | None = None):
    """Candle query. The fast path uses the engine's windows and fans out to one or two stores;
    the strict path also keeps late trades and re-emits within the allowed lateness."""
    trades = valid_trades(records)
    second = sinks.by_batch(paths.at("candles_second")) if cfg.second_store else None

    def lost(batch_id: int, e: Exception) -> None:
        warnings.warn(f"second store lacks batch {batch_id} until refill_second: {e}", stacklevel=1)

    if strict or cfg.allowed_lateness_ms > 0:
        return sc.to_batches(trades, StrictCandles(paths.at("strict"), cfg, second, lost), paths.checkpoint("strict"), trigger)
    out = sinks.candle_row(sc.window_candles(trades, cfg), cfg.run_id)
    write = sinks.fan_out(sinks.with_retries(sinks.append_only(paths.at("candles"))), second, lost)
    return sc.to_batches(out, write, paths.checkpoint("candles"), trigger)


def start_archive(records: DataFrame, paths: JobPaths, trigger: dict | None = None):
    """Raw-trade archive. A query of its own, so that its volume never slows the candles; it sits
    before the window, so late trades are in the archive though not in a candle."""
    rows = stored_trades(lt.good_trades(lt.classify(records))).drop("currency")
    return sc.to_files(rows, paths.at("trades_raw"), paths.checkpoint("trades_raw"), "event_time", trigger)


def start_dead_letters(records: DataFrame, cfg: CandleSettings, paths: JobPaths, trigger: dict | None = None):
    rows = lt.dead_letters(lt.classify(records), cfg.run_id, utc_now())
    return sc.to_files(rows, paths.at("dead_letters"), paths.checkpoint("dead_letters"), "seen_at", trigger)


def progress_samples(query, spark: SparkSession) -> DataFrame:
    """Progress of a query as metric samples (a bounded list: recent batches x a few counters)."""
    rows = []
    for p in query.recentProgress:
        p = p if isinstance(p, dict) else __import__("json").loads(p.json)
        ts = p["timestamp"].rstrip("Z").replace("T", " ")
        labels = {"query": p.get("name") or p["runId"], "batch": str(p["batchId"])}
        values = {"input_rows": p.get("numInputRows", 0)}
        for group in (p.get("observedMetrics") or {}).values():
            values.update(group if isinstance(group, dict) else group.asDict())
        for op in p.get("stateOperators") or []:
            values["late_dropped_by_engine"] = op.get("numRowsDroppedByWatermark", 0)
            values["state_rows"] = op.get("numRowsTotal", 0)
        rows += [(ts, k, labels, float(v or 0)) for k, v in values.items()]
    df = spark.createDataFrame(rows, "ts STRING, metric STRING, labels MAP<STRING, STRING>, value DOUBLE")
    return df.withColumn("ts", F.col("ts").cast("timestamp_ntz"))


def blocks(trades: DataFrame, block: str = "block") -> Iterator[int]:
    """Numbers of the arrival blocks, in order (a handful)."""
    for r in trades.select(block).distinct().orderBy(block).collect():
        yield r[0]


def land_block(records: DataFrame, path: str) -> None:
    records.write.mode("append").json(path)


def stage_blocks(records: DataFrame, path: str, block: str = "block") -> list[int]:
    """Write the records of all arrival blocks in one pass, one folder a block; returns the blocks' numbers, in order.

    The files are columnar: a fraction of the text and cheaper to read. Nothing reads them before ``land_staged``. Records without an arrival time are in no block.
    """
    records.write.partitionBy(block).parquet(path)
    folder = records.sparkSession._jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(records.sparkSession.sparkContext._jsc.hadoopConfiguration())
    names = [x.getPath().getName().removeprefix(f"{block}=") for x in fs.listStatus(folder)]
    return sorted(int(n) for n in names if n.lstrip("-").isdigit())


def land_staged(spark: SparkSession, staged: str, number: int, landing: str, block: str = "block") -> None:
    """Land one staged block: its folder becomes ``landing/number``, and no record is written again. Streams read ``landing/*``."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs = path(landing).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(path(landing))
    if not fs.rename(path(f"{staged}/{block}={number}"), path(f"{landing}/{number}")):
        raise OSError(f"block {number} was not landed")


__all__ = [
    "JobPaths", "blocks", "land_block", "land_staged", "progress_samples", "stage_blocks", "start_archive", "start_candles",
    "start_dead_letters", "valid_trades", "wall_clock", "with_day",
]
