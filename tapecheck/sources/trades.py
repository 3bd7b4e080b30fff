"""Trade streams: a Kafka topic, or the same records landed as files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tapecheck.schema import WIRE_TRADE
from tapecheck.settings import START_POSITIONS, CandleSettings

LANDED = T.StructType(
    [
        T.StructField("key", T.StringType()),
        T.StructField("value", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
    ]
)


def start_options(position: str) -> dict[str, str]:
    """Source options of a start position. ``committed`` resumes from the checkpoint and only a
    first run starts at the earliest record; the others ask for a fresh checkpoint."""
    if position not in START_POSITIONS:
        raise ValueError(f"start position must be one of {', '.join(START_POSITIONS)}, not {position!r}")
    return {"startingOffsets": "latest" if position == "latest" else "earliest"}


def kafka_stream(spark: SparkSession, cfg: CandleSettings, max_per_trigger: int | None = None) -> DataFrame:
    """The live topic. Spark looks up partitions again at every micro-batch, so new partitions
    are picked up without a setting."""
    r = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", cfg.bootstrap_servers)
        .option("subscribe", cfg.topic)
        .option("failOnDataLoss", "true")
        .options(**start_options(cfg.start_position))
    )
    if max_per_trigger:
        r = r.option("maxOffsetsPerTrigger", max_per_trigger)
    return r.load().select(F.col("key").cast("string"), F.col("value").cast("string"), "partition", "offset")


def landed_stream(spark: SparkSession, path: str, files_per_trigger: int | None = None, fmt: str = "json") -> DataFrame:
    """The same relation from files, in file order."""
    r = spark.readStream.schema(LANDED)
    if files_per_trigger:
        r = r.option("maxFilesPerTrigger", files_per_trigger)
    return r.format(fmt).load(path)


def landed_batch(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(LANDED).json(path)


def land_in_order(records: DataFrame, block: str, path: str, fmt: str = "json") -> int:
    """Land records as one file per arrival block, in one write; returns the number of files.

    A file stream reads files by their time, so the times are set in the order of the blocks.
    """
    spark = records.sparkSession
    records.repartition(block).write.partitionBy(block).format(fmt).save(path)
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = sorted((f.getPath() for f in fs.globStatus(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{block}=*/*.{fmt}"))), key=lambda p: int(p.getParent().getName().split("=")[1]))
    first = fs.getFileStatus(folder).getModificationTime() - 1000 * len(found)
    for n, p in enumerate(found):
        fs.setTimes(p, first + 1000 * n, -1)
    return len(found)


def wire_json() -> Column:
    """The payload a producer publishes; log coordinates are never part of it."""
    fields = [
        F.col(f.name).cast("string").alias(f.name) if f.name in ("price", "volume") else F.col(f.name)
        for f in WIRE_TRADE.fields
    ]
    return F.to_json(F.struct(*fields))


def keyed_records(trades: DataFrame) -> DataFrame:
    """Trades as topic records, keyed by symbol so that one symbol keeps its order."""
    return trades.select(F.col("symbol").cast("string").alias("key"), wire_json().alias("value"))


def publish(trades: DataFrame, cfg: CandleSettings) -> None:
    """Write to the topic with full acknowledgement and an idempotent producer."""
    (
        keyed_records(trades)
        .write.format("kafka")
        .option("kafka.bootstrap.servers", cfg.bootstrap_servers)
        .option("topic", cfg.topic)
        .option("kafka.acks", "all")
        .option("kafka.enable.idempotence", "true")
        .save()
    )
