"""The runnable job: records are parsed and classified once, and three queries share what was landed.

    records -> classified (file sink) -> candles  -> first store, second store
                                      -> archive
                                      -> dead letters

Each query has its own checkpoint, so a slow or failing store holds back nothing but itself. The file sink's commit log makes the
hand-over exactly-once. ``LiveJob`` starts the queries, restarts one that failed, and stops and resumes as a whole.
"""

from __future__ import annotations

import time
import warnings

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from tapecheck.functions.timecols import utc_now
from tapecheck.operators import letters as lt
from tapecheck.settings import CandleSettings
from tapecheck.sources.derived import stored_trades
from tapecheck.sources.positions import Start
from tapecheck.streaming import candles as sc, sinks
from tapecheck.streaming.job import JobPaths
from tapecheck.streaming.metrics import ProgressLog
from tapecheck.streaming.strict import StrictCandles

CLASSIFIED = "partition INT, offset BIGINT, value_text STRING, t STRUCT<symbol: STRING, event_ms: BIGINT, seq_in_ms: INT, ingest_ms: BIGINT, currency: STRING, conn_id: STRING, recv_seq: BIGINT>, price_n DECIMAL(18,4), volume_n DECIMAL(18,8), reason STRING"


def classified(records: DataFrame) -> DataFrame:
    """What is landed of each record: its fields, exact numbers, reason and text (kept for dead letters only)."""
    fields = ["symbol", "event_ms", "seq_in_ms", "ingest_ms", "currency", "conn_id", "recv_seq"]
    return lt.classify(records).select(
        F.col("partition").cast("int"), F.col("offset").cast("bigint"),
        F.when(F.col("reason").isNotNull(), F.col("value_text")).alias("value_text"),
        F.struct(*[F.col(f"t.{f}").alias(f) for f in fields]).alias("t"), "price_n", "volume_n", "reason",
    )


class LiveJob:
    """All queries of one ``CandleSettings``; ``start`` names the checkpoints (see ``sources.positions``)."""

    def __init__(self, spark: SparkSession, cfg: CandleSettings, paths: JobPaths, start: Start, restarts: int = 3, strict: bool = False):
        self.spark, self.cfg, self.paths, self.start_at, self.restarts = spark, cfg, paths, start, restarts
        self.session = sc.stream_session(spark)
        self.strict = strict or cfg.allowed_lateness_ms > 0
        self.queries: dict[str, StreamingQuery] = {}
        self.failed: dict[str, int] = {}
        self.progress = ProgressLog(self.session, paths.at("progress"))

    @property
    def landing(self) -> str:
        """Classified records of this generation; a new start position re-reads the log into a folder of its own."""
        return self.paths.at(f"classified/{self.start_at.generation}")

    def _starters(self, records: DataFrame | None) -> dict:
        cfg, paths, trigger = self.cfg, self.paths, {"processingTime": self.cfg.trigger}

        def ck(name: str) -> str:
            return f"{self.start_at.checkpoint}/{name}"

        def landed() -> DataFrame:
            return self.session.readStream.schema(CLASSIFIED).parquet(self.landing)

        def ingest():
            rows = classified(self.start_at.after(records))
            return rows.writeStream.format("parquet").option("path", self.landing).option("checkpointLocation", ck("ingest")).trigger(**trigger).start()

        def second():
            return sinks.by_batch(paths.at(f"{cfg.candles_table}_second/{self.start_at.generation}")) if cfg.second_store else None

        def lost(batch_id: int, e: Exception) -> None:
            warnings.warn(f"second store lacks batch {batch_id} until refill_second: {e}", stacklevel=1)

        def candles():
            trades = lt.good_trades(landed())
            if self.strict:
                return sc.to_batches(trades, StrictCandles(paths.at(f"strict/{self.start_at.generation}"), cfg, second(), lost), ck("candles"), trigger)
            rows = sinks.candle_row(sc.window_candles(trades, cfg), cfg.run_id)
            write = sinks.fan_out(sinks.with_retries(sinks.append_only(paths.at(cfg.candles_table))), second(), lost)
            return sc.to_batches(rows, write, ck("candles"), trigger)

        def archive():
            return sc.to_files(stored_trades(lt.good_trades(landed())).drop("currency"), paths.at("trades_raw"), ck("archive"), "event_time", trigger)

        def letters():
            return sc.to_files(lt.dead_letters(landed(), cfg.run_id, utc_now()), paths.at("dead_letters"), ck("letters"), "seen_at", trigger)

        out = {"ingest": ingest, "candles": candles, "letters": letters}
        return out | ({"archive": archive} if cfg.archive_trades else {})

    def start(self, records: DataFrame) -> LiveJob:
        self.session.streams.addListener(self.progress)
        self.starters = self._starters(records)
        self.queries["ingest"] = self.starters["ingest"]()
        self._wait_for_landing()
        for name in self.starters.keys() - {"ingest"}:
            self.queries[name] = self.starters[name]()
        return self

    def _wait_for_landing(self, timeout_s: float = 600) -> None:
        """The readers need the folder of the first batch."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.landing}/_spark_metadata")
        fs = path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        until = time.monotonic() + timeout_s
        while not fs.exists(path):
            if self.queries["ingest"].exception() is not None or time.monotonic() > until:
                self.stop()
                raise RuntimeError(f"nothing was landed: {self.queries['ingest'].exception()}")
            time.sleep(0.1)

    def check(self) -> None:
        """Restart queries that failed; one that fails too often stops the job."""
        for name, q in list(self.queries.items()):
            e = q.exception()
            if e is None:
                continue
            self.failed[name] = self.failed.get(name, 0) + 1
            if self.failed[name] > self.restarts:
                self.stop()
                raise RuntimeError(f"{name} failed {self.failed[name]} times") from e
            self.queries[name] = self.starters[name]()

    def run(self, poll_s: float = 5.0, for_s: float | None = None) -> None:
        """Supervise until stopped from outside, or for a while."""
        until = None if for_s is None else time.monotonic() + for_s
        while self.queries and (until is None or time.monotonic() < until):
            self.check()
            time.sleep(poll_s)

    def drain(self) -> LiveJob:
        """Wait until everything that is there now has passed through all queries."""
        for name in ["ingest", *(n for n in self.queries if n != "ingest")]:
            while True:
                self.check()
                try:
                    self.queries[name].processAllAvailable()
                    break
                except Exception:
                    if self.queries[name].exception() is None:
                        raise
        return self

    def stop(self) -> None:
        """Stop after the current batch of each query; a later job goes on from the checkpoints."""
        queries, self.queries = self.queries, {}
        for q in queries.values():
            q.stop()
        for q in queries.values():
            self.progress.wait_for(q)
        self.session.streams.removeListener(self.progress)
