"""Candles from a stream with exact late accounting and allowed lateness.

Spark's own windowed aggregate drops late rows without a trace and cannot emit a window a second
time. This path keeps both visible. Rules, for batch n with the watermark wm that batch n-1 left:

* a trade is late when ``window_end + lateness <= wm``; it goes to the dead letters;
* a window is emitted when ``window_end <= new wm``, and again after every later batch that still
  changed it; each emission is a complete candle, so re-emissions show as a higher write count;
* a window is forgotten when ``window_end + lateness <= new wm``;
* the watermark never moves back.

A batch reads only the open windows and the watermark its predecessor wrote.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tapecheck.functions.timecols import bucket_start, wall_clock
from tapecheck.operators.candles import finish_partials, merge_partials, partial_candles
from tapecheck.operators.letters import late_letters
from tapecheck.settings import CandleSettings
from tapecheck.streaming.sinks import candle_row, fan_out, with_retries
from tapecheck.streaming.state import BatchTable

_OPEN = (
    "symbol STRING, window_ms BIGINT, open_key BIGINT, close_key BIGINT, open DECIMAL(18,4), high DECIMAL(18,4), "
    "low DECIMAL(18,4), close DECIMAL(18,4), volume DECIMAL(18,8), trade_count BIGINT, fired INT"
)
_CANDLES = (
    "symbol STRING, window_start TIMESTAMP_NTZ, open DECIMAL(18,4), high DECIMAL(18,4), low DECIMAL(18,4), "
    "close DECIMAL(18,4), volume DECIMAL(18,8), trade_count BIGINT, ingested_at TIMESTAMP_NTZ, run_id STRING"
)
_LETTERS = "seen_at TIMESTAMP_NTZ, stage STRING, reason STRING, symbol STRING, payload STRING, job_run STRING"


class StrictCandles:
    """``foreachBatch`` body; ``base`` is a folder every executor can reach. ``second`` gets the same candles; that it
    fails is told to ``on_second_error`` and stops nothing. Every ``pack_every`` batches the folders of old batches are packed
    into one (read them through ``written_candles`` and ``written_letters``)."""

    def __init__(
        self,
        base: str,
        cfg: CandleSettings,
        second: Callable[[DataFrame, int], None] | None = None,
        on_second_error: Callable[[int, Exception], None] | None = None,
        pack_every: int = 100,
    ):
        self.cfg, self.pack_every = cfg, pack_every
        self._store = fan_out(with_retries(lambda rows, n: self.candles.write(rows, n)), second, on_second_error)
        self.progress = BatchTable(f"{base}/progress", "wm_ms BIGINT, trades BIGINT, late BIGINT")
        self.open = BatchTable(f"{base}/open_windows", _OPEN)
        self.candles = BatchTable(f"{base}/candles", _CANDLES)
        self.letters = BatchTable(f"{base}/dead_letters", _LETTERS)

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark, cfg = batch.sparkSession, self.cfg
        before = self.progress.at(spark, batch_id - 1).first()
        wm = before.wm_ms if before is not None else None
        lateness = cfg.allowed_lateness_ms

        window_end = bucket_start("event_ms", cfg.window_ms) + cfg.window_ms
        is_late = F.lit(False) if wm is None else (window_end + lateness <= F.lit(wm))
        # neither letters nor candles hold these, so they are neither parsed nor kept
        judged = batch.drop("currency", "kafka_partition", "kafka_offset").withColumn("late", is_late).persist()
        try:
            seen = judged.agg(
                F.max("event_ms").alias("newest"), F.count(F.lit(1)).alias("trades"), F.count_if("late").alias("late")
            ).first()
            marks = [m for m in (wm, None if seen.newest is None else seen.newest - cfg.watermark_delay_ms) if m is not None]
            new_wm = max(marks) if marks else None
            late = judged.filter("late")
            self.letters.write(late_letters(late, cfg.run_id, wall_clock("ingest_ms")), batch_id)

            fresh = partial_candles(judged.filter("NOT late"), cfg.window_ms).withColumns(
                {"fired": F.lit(0), "touched": F.lit(1)}
            )
            kept = self.open.at(spark, batch_id - 1).withColumn("touched", F.lit(0))
            flags = [F.max("fired").alias("fired"), F.max("touched").alias("touched")]
            merged = merge_partials(kept.unionByName(fresh), also=flags).persist()
            try:
                end = F.col("window_ms") + cfg.window_ms
                closed = F.lit(False) if new_wm is None else (end <= F.lit(new_wm))
                emit = merged.filter(closed & ((F.col("fired") == 0) | (F.col("touched") == 1)))
                self._store(candle_row(finish_partials(emit), cfg.run_id), batch_id)
                alive = F.lit(True) if new_wm is None else (end + lateness > F.lit(new_wm))
                self.open.write(merged.filter(alive).withColumn("fired", closed.cast("int")).drop("touched"), batch_id)
            finally:
                merged.unpersist()
            # Written last: a batch whose progress is missing never happened.
            self.progress.write(
                spark.range(0, 1, 1, 1).select(
                    F.lit(new_wm).cast("bigint").alias("wm_ms"), F.lit(seen.trades).cast("bigint").alias("trades"),
                    F.lit(seen.late).cast("bigint").alias("late"),
                ),
                batch_id,
            )
            self.open.forget(spark, batch_id)
            if batch_id and batch_id % self.pack_every == 0:
                # the next batch, or this one again, reads the last folders only
                for table in (self.progress, self.candles, self.letters):
                    table.pack(spark, batch_id - 2)
        finally:
            judged.unpersist()

    def written_candles(self, spark: SparkSession) -> DataFrame:
        return self.candles.all(spark)

    def written_letters(self, spark: SparkSession) -> DataFrame:
        return self.letters.all(spark)
