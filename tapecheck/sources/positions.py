"""Start positions that mean what they say.

A checkpoint remembers how far its query has read, so an explicit position has no effect on it. Each start
from an explicit position therefore opens a new generation of the checkpoint; ``committed`` goes on with the newest
one, and only a first run begins at the earliest record.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from tapecheck.sources.trades import start_options

_STARTS = "position STRING, partition INT, offset BIGINT"


@dataclass(frozen=True)
class Start:
    """Where a query reads from: its checkpoint, the position that opened it, and the recorded ends of the log."""

    checkpoint: str
    position: str
    generation: int
    resumed: bool
    record: str

    def after(self, records: DataFrame) -> DataFrame:
        """Records of a landed stream behind the start: those beyond the log's ends if it was opened at the latest."""
        if self.position != "latest":
            return records
        ends = records.sparkSession.read.schema(_STARTS).parquet(self.record)
        ends = ends.where("partition is not null").select("partition", F.col("offset").alias("_end"))
        kept = records.join(ends, "partition", "left").where(F.col("offset") > F.coalesce("_end", F.lit(-1)))
        return kept.select(*records.columns)


def _generations(spark: SparkSession, base: str) -> list[int]:
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{base}/starts")
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(path)]
    # a start whose record was not finished never happened
    return sorted(int(n) for n in names if n.isdigit() and fs.exists(spark._jvm.org.apache.hadoop.fs.Path(f"{base}/starts/{n}/_SUCCESS")))


def open_position(spark: SparkSession, base: str, position: str, landed: DataFrame | None = None) -> Start:
    """Open or resume the checkpoints below ``base``.

    ``landed`` (partition, offset) is what the log holds now; its last offsets are recorded, one row per partition,
    when a query starts at the latest record of landed files. A topic needs none: its source asks the broker.
    """
    start_options(position)  # refuses an unknown position
    have = _generations(spark, base)
    if position == "committed" and have:
        n = have[-1]
        record = f"{base}/starts/{n}"
        opened = spark.read.schema(_STARTS).parquet(record).first().position
        return Start(f"{base}/generation-{n}", opened, n, True, record)
    n, opened = (have[-1] + 1 if have else 0), ("earliest" if position == "committed" else position)
    row = spark.range(1).select(F.lit(opened).alias("position"), F.lit(None).cast("int").alias("partition"), F.lit(None).cast("bigint").alias("offset"))
    if opened == "latest" and landed is not None:
        ends = landed.groupBy("partition").agg(F.max("offset").alias("offset"))
        row = row.unionByName(ends.select(F.lit(opened).alias("position"), "partition", "offset"))
    row.coalesce(1).write.mode("overwrite").parquet(f"{base}/starts/{n}")
    return Start(f"{base}/generation-{n}", opened, n, False, f"{base}/starts/{n}")
