"""Writers with deliberately different guarantees."""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from tapecheck.functions.timecols import utc_now
from tapecheck.sources.stores import with_day

CANDLE_COLUMNS = ["symbol", "window_start", "open", "high", "low", "close", "volume", "trade_count", "ingested_at", "run_id"]


def candle_row(candles: DataFrame, run_id: str | None = None) -> DataFrame:
    """Full candle row: run_id is required ('' when unknown), the write time is now."""
    have = candles.columns
    run = F.lit(run_id) if run_id is not None else (F.col("run_id") if "run_id" in have else F.lit(None).cast("string"))
    return candles.withColumns(
        {
            "run_id": F.coalesce(run, F.lit("")),
            "ingested_at": F.col("ingested_at") if "ingested_at" in have else utc_now(),
        }
    ).select(*CANDLE_COLUMNS)


def append_only(path: str) -> Callable[[DataFrame, int], None]:
    """At-least-once: a batch that runs again is written again, and the duplicates stay visible."""

    def write(batch: DataFrame, batch_id: int) -> None:
        with_day(batch, "window_start").write.mode("append").partitionBy("day").parquet(path)

    return write


def by_batch(path: str) -> Callable[[DataFrame, int], None]:
    """Exactly-once: each batch owns its folder, so running it again replaces what it wrote."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return write


def refill_second(spark: SparkSession, primary: str | DataFrame, secondary: str) -> int:
    """Copy to the second store what only the first one has; returns the number of rows.

    ``primary`` is a folder, or the rows themselves where folders are packed (``StrictCandles.written_candles``).

    A failed write to the second store does not stop the job, so its rows are found by comparing the
    stores and not by a log that could itself be lost.
    """
    have = (spark.read.parquet(primary) if isinstance(primary, str) else primary).select(*CANDLE_COLUMNS)
    try:
        there = spark.read.parquet(secondary).select(*CANDLE_COLUMNS)
    except AnalysisException as e:  # no batch has ever arrived there
        if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        there = have.limit(0)
    # the write time tells a window that was written again from its first write
    key = ["symbol", "window_start", "run_id", "ingested_at"]
    missing = have.join(there.select(*key), key, "left_anti").persist()
    try:
        n = missing.count()
        if n:
            missing.select(*CANDLE_COLUMNS).write.parquet(f"{secondary}/batch_id=refill-{uuid.uuid4().hex}")
        return n
    finally:
        missing.unpersist()


def fan_out(
    primary: Callable[[DataFrame, int], None],
    secondary: Callable[[DataFrame, int], None] | None,
    on_secondary_error: Callable[[int, Exception], None] | None = None,
) -> Callable[[DataFrame, int], None]:
    """Same batch to two stores. The primary's failure fails the batch; the secondary's is
    reported and must not stop the primary."""

    def write(batch: DataFrame, batch_id: int) -> None:
        if secondary is None:
            primary(batch, batch_id)
            return
        batch.persist()
        try:
            primary(batch, batch_id)
            try:
                secondary(batch, batch_id)
            except Exception as e:  # noqa: BLE001
                if on_secondary_error:
                    on_secondary_error(batch_id, e)
        finally:
            batch.unpersist()

    return write


def with_retries(
    write: Callable[[DataFrame, int], None],
    attempts: int = 3,
    wait_s: float = 0.5,
    on_failure: Callable[[Exception], None] | None = None,
) -> Callable[[DataFrame, int], None]:
    """Try a few times with growing pauses, then let the query fail so that it replays the batch
    from its checkpoint. ``on_failure`` hears of every failed attempt."""

    def run(batch: DataFrame, batch_id: int) -> None:
        for n in range(1, attempts + 1):
            try:
                write(batch, batch_id)
                return
            except Exception as e:
                if on_failure:
                    on_failure(e)
                if n == attempts:
                    raise
                time.sleep(wait_s * n)

    return run
