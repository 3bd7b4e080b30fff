"""Counters that outlive the query: one row of numbers per batch, replaced when the batch runs again.

``CounterLog`` is written by the batch body itself, after the data and before the batch commits. ``ProgressLog`` keeps what
only the engine knows (rows that its watermark dropped, rows of state); a query's own progress list holds its last hundred
batches and dies with it.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQueryListener

from tapecheck.functions.timecols import bucket_start
from tapecheck.settings import CandleSettings
from tapecheck.streaming.sinks import with_retries
from tapecheck.streaming.state import BatchTable

Write = Callable[[DataFrame, int], None]

COUNTERS = ("records", "rows_written", "flush_failures", "late")


class CounterLog:
    """``path/batch_id=N`` holds the counters of batch N and the watermark that it left."""

    def __init__(self, path: str):
        self.table = BatchTable(path, ", ".join(f"{c} BIGINT" for c in (*COUNTERS, "wm_ms")))
        self._last: tuple[int, dict[str, int | None]] | None = None

    def put(self, spark: SparkSession, batch_id: int, **values: int | None) -> None:
        names = [c.split()[0] for c in self.table.schema.split(", ")]
        # a batch's row is one small file
        row = spark.range(0, 1, 1, 1).select(*[F.lit(values.get(n)).cast("bigint").alias(n) for n in names])
        self.table.write(row, batch_id)
        self._last = batch_id, values

    def get(self, spark: SparkSession, batch_id: int) -> dict[str, int | None]:
        if self._last and self._last[0] == batch_id:
            return self._last[1]
        row = self.table.at(spark, batch_id).first() if self.table.has(spark, batch_id) else None
        return row.asDict() if row is not None else {}

    def totals(self, spark: SparkSession) -> DataFrame:
        """(metric, value, batches) over all batches there ever were."""
        rows = self.table.all(spark)
        sums = [F.struct(F.lit(c).alias("metric"), F.coalesce(F.sum(c), F.lit(0)).alias("value")) for c in COUNTERS]
        return rows.agg(F.count(F.lit(1)).alias("batches"), F.array(*sums).alias("m")).select("batches", F.inline("m"))


def counted(write: Write, log: CounterLog, cfg: CandleSettings, attempts: int = 3, wait_s: float = 0.5) -> Write:
    """A batch of trades through ``write``, with its counters.

    Rows, the newest event and late records (their window had closed before the batch began; the rule of the
    strict path) are observed in the scan that writes the batch. Failed attempts count even if the
    batch fails for good and runs again.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        wm = log.get(spark, batch_id - 1).get("wm_ms")
        failed = [None] * (log.get(spark, batch_id).get("flush_failures") or 0)
        end = bucket_start("event_ms", cfg.window_ms) + cfg.window_ms + cfg.allowed_lateness_ms
        late = F.lit(False) if wm is None else end <= F.lit(wm)
        seen = Observation()
        watched = batch.observe(
            seen, F.count(F.lit(1)).alias("records"), F.count_if(late).alias("late"), F.max("event_ms").alias("newest")
        )
        try:
            with_retries(write, attempts, wait_s, failed.append)(watched, batch_id)
        except Exception:
            log.put(spark, batch_id, flush_failures=len(failed))
            raise
        found = seen.get
        marks = [m for m in (wm, None if found["newest"] is None else found["newest"] - cfg.watermark_delay_ms) if m is not None]
        log.put(
            spark, batch_id, records=found["records"], rows_written=found["records"], late=found["late"],
            flush_failures=len(failed), wm_ms=max(marks, default=None),
        )

    return run


class ProgressLog(StreamingQueryListener):
    """One JSON file per (query, batch) below ``path``; a batch that runs again replaces its file."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path, self.done = spark, path, {}

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.done[str(event.runId)] = True

    def onQueryProgress(self, event) -> None:
        p = json.loads(event.progress.json)
        counters = {"input_rows": p.get("numInputRows", 0), "late_dropped_by_engine": 0, "state_rows": 0}
        for group in (p.get("observedMetrics") or {}).values():
            counters |= {k: v for k, v in group.items() if isinstance(v, int)}
        for op in p.get("stateOperators") or []:
            counters["late_dropped_by_engine"] += op.get("numRowsDroppedByWatermark", 0)
            counters["state_rows"] += op.get("numRowsTotal", 0)
        rows = [{"query_id": p["id"], "batch_id": p["batchId"], "metric": k, "value": v, "at": p["timestamp"]} for k, v in counters.items()]
        self._write(f"{p['id']}-{p['batchId']:012d}.json", "\n".join(map(json.dumps, rows)) + "\n")

    def _write(self, name: str, text: str) -> None:
        jvm, sc = self.spark._jvm, self.spark.sparkContext
        path = jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        out = path.getFileSystem(sc._jsc.hadoopConfiguration()).create(path, True)
        out.write(bytearray(text.encode()))
        out.close()

    def wait_for(self, query, timeout_s: float = 30) -> None:
        """Events arrive after the batch; wait for those of a query that has ended."""
        until = time.monotonic() + timeout_s
        while str(query.runId) not in self.done:
            if time.monotonic() > until:
                raise TimeoutError("the query's last events have not arrived")
            time.sleep(0.05)

    def samples(self) -> DataFrame:
        schema = "query_id STRING, batch_id BIGINT, metric STRING, value BIGINT, at STRING"
        return self.spark.read.schema(schema).json(self.path)
