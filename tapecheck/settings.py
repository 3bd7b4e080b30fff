"""Job settings and the session options the jobs are written for."""

from __future__ import annotations

import json
import os
import tempfile
import uuid
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

MINUTE_MS = 60_000
HOUR_MS = 3_600_000
DAY_MS = 86_400_000

START_POSITIONS = ("committed", "earliest", "latest")


@dataclass(frozen=True)
class CandleSettings:
    """Everything a candle run can be told; the defaults are the live settings."""

    topic: str = "trades.raw"
    bootstrap_servers: str = "localhost:9092"
    window_ms: int = MINUTE_MS
    watermark_delay_ms: int = 5_000
    idleness_ms: int = 10_000
    allowed_lateness_ms: int = 0
    start_position: str = "committed"
    archive_trades: bool = True
    second_store: bool = False
    candles_table: str = "candles_1m"
    run_id: str = ""
    trigger: str = "10 seconds"

    def describe(self) -> str:
        """All settings as one JSON text, to be stored next to the results they explain."""
        return json.dumps(asdict(self))

    def as_row(self, spark: SparkSession) -> DataFrame:
        """The settings as a one-row frame for a ``runs`` table."""
        return spark.range(1).select(
            F.lit(self.run_id).alias("run_id"),
            F.lit(self.window_ms).cast("bigint").alias("window_ms"),
            F.lit(self.watermark_delay_ms).cast("bigint").alias("watermark_delay_ms"),
            F.lit(self.allowed_lateness_ms).cast("bigint").alias("allowed_lateness_ms"),
            F.lit(self.topic).alias("topic"),
            F.lit(self.start_position).alias("start_position"),
            F.lit(self.describe()).alias("description"),
        )


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder below the shared folder the cluster names in ``spark.checkpoint.dir``.

    Only a local session without that setting falls back to a folder of this machine.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir", None
    )
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        base = os.path.join(tempfile.gettempdir(), "tapecheck-local")
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def local_session(name: str = "tapecheck", cpus: str = "*", memory: str = "8g") -> SparkSession:
    """Session for tests and the bench; a cluster brings its own master and sizes."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", "8" if cpus == "*" else cpus)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config(
            "spark.sql.streaming.stateStore.providerClass",
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        )
        .config("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark
