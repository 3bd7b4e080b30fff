"""Tables at rest: day-partitioned, sorted files, read back with partition pruning."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from tapecheck.settings import shared_dir

# Days a table keeps.
RETENTION_DAYS = {"trades_raw": 30, "dead_letters": 14}

# Sort columns inside a file, so min/max statistics can skip row groups.
SORT_KEYS = {
    "candles_1m": ["symbol", "window_start", "ingested_at"],
    "candles_1m_official": ["symbol", "window_start"],
    "trades_raw": ["symbol", "event_time", "seq_in_ms"],
    "dead_letters": ["stage", "reason", "seen_at"],
}


def with_day(df: DataFrame, time_col: str) -> DataFrame:
    return df.withColumn("day", F.to_date(time_col))


def write_by_day(
    df: DataFrame, time_col: str, name: str, path: str | None = None, mode: str = "append",
    sort_by: list[str] | None = None, one_writer_per_day: bool = False,
) -> str:
    """Write one folder per day, rows sorted inside each file.

    By default AQE's rebalance decides: small days end in one file, a hot day is split over
    several tasks instead of going through one. ``one_writer_per_day`` is for small tables (candles)
    that should have one file per day; the days are spread over as many tasks as the session shuffles to.
    """
    path = path or shared_dir(df.sparkSession, name)
    d = with_day(df, time_col)
    if one_writer_per_day:
        d = d.repartition("day")
    else:
        d = d.hint("rebalance", "day")
    keys = [c for c in (sort_by or SORT_KEYS.get(name, [])) if c in df.columns]
    d = d.sortWithinPartitions("day", *keys)
    d.write.mode(mode).partitionBy("day").parquet(path)
    return path


def read_days(spark: SparkSession, path: str, first_day: str | None = None, last_day: str | None = None) -> DataFrame:
    """Read stored days; the day bounds prune folders before any file is opened."""
    df = spark.read.parquet(path)
    if first_day is not None:
        df = df.filter(F.col("day") >= F.lit(first_day).cast("date"))
    if last_day is not None:
        df = df.filter(F.col("day") <= F.lit(last_day).cast("date"))
    return df


def read_written(spark: SparkSession, path: str, schema) -> DataFrame:
    """What a stream has written to day folders so far. The schema is told, not read from the files: as long as no
    row has been written there is none, and then the result is empty."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:  # no batch has run at all
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def retained(df: DataFrame, time_col: str, keep_days: int, as_of) -> DataFrame:
    """Rows a table still keeps at ``as_of`` (a timestamp column or value)."""
    limit = as_of - F.expr(f"INTERVAL {keep_days} DAYS")
    return df.filter(F.col(time_col) > limit)


def drop_expired_days(df: DataFrame, keep_days: int, as_of_day: str) -> DataFrame:
    """Same rule on whole day folders: decided from folder names, no file is read."""
    return df.filter(F.col("day") >= F.date_sub(F.lit(as_of_day).cast("date"), keep_days))


def create_table(spark: SparkSession, name: str, schema, path: str | None = None) -> None:
    """Create a day-partitioned table at start unless it exists; any failure stops the job.

    A table of that name with other columns or types is such a failure: rows must not be cast to it in silence.
    """
    from pyspark.sql import types as T

    fields = T.StructType([*schema.fields, T.StructField("day", T.DateType())])
    where = f" LOCATION '{path}'" if path else ""
    cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields.fields)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({cols}) USING parquet PARTITIONED BY (day){where}")
    have = [(f.name, f.dataType) for f in spark.table(name).schema.fields]
    want = [(f.name, f.dataType) for f in fields.fields]
    if have != want:
        differ = sorted(f"{n} {t.simpleString()}" for n, t in set(have) ^ set(want)) or ["order of columns"]
        raise ValueError(f"table {name} exists with another schema: {', '.join(differ)}")


def stream_to_table(stream: DataFrame, name: str, schema, time_col: str, checkpoint: str, path: str | None = None, trigger: dict | None = None):
    """Append a stream to a catalog table, which is created first. Columns are matched by name and must be those of ``schema``."""
    create_table(stream.sparkSession, name, schema, path)
    rows = stream.select(*[F.col(f.name) for f in schema.fields])
    wrong = [f"{a.name} {a.dataType.simpleString()}, not {b.dataType.simpleString()}" for a, b in zip(rows.schema.fields, schema.fields) if a.dataType != b.dataType]
    if wrong:
        raise ValueError(f"table {name}: {'; '.join(wrong)}")
    return (
        with_day(rows, time_col).writeStream.partitionBy("day").option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True})).toTable(name)
    )


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """A catalog table with the days that streams have added to its folder."""
    spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")
    return spark.table(name)


def _folder(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def expire_days(spark: SparkSession, name: str, keep_days: int, as_of_day: str) -> list[str]:
    """Drop the partitions of a catalog table that are older than it keeps; returns their days.

    Decided from the catalog's list of partitions, so no file is opened. The folders of a table with a location of its own
    belong to nobody once the partition is dropped, and are deleted here.
    """
    limit = spark.sql(f"SELECT date_sub(DATE'{as_of_day}', {int(keep_days)}) AS d").first().d.isoformat()
    days = sorted(r.partition.split("=", 1)[1] for r in spark.sql(f"SHOW PARTITIONS {name}").collect())
    old = [d for d in days if d < limit]
    if not old:
        return []
    about = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()}
    spark.sql(f"ALTER TABLE {name} DROP IF EXISTS " + ", ".join(f"PARTITION (day = DATE'{d}')" for d in old))
    if about.get("Type") == "EXTERNAL":
        for d in old:
            path, fs = _folder(spark, f"{about['Location']}/day={d}")
            fs.delete(path, True)
    return old


def day_files(spark: SparkSession, path: str) -> DataFrame:
    """(day, file, bytes, rows) of a day-partitioned folder."""
    rows = spark.read.parquet(path).select("day", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("bytes"))
    return rows.groupBy("day", "file", "bytes").agg(F.count(F.lit(1)).alias("rows"))


def merge_latest(spark: SparkSession, path: str, fresh: DataFrame, time_col: str, latest, sort_by: list[str] | None = None) -> list[str]:
    """Merge rows into a store that keeps one row per key; returns the days that were rewritten.

    Only the days of ``fresh`` are read and replaced (dynamic partition overwrite); all other folders keep their files. ``latest``
    reduces old and new rows of these days to the newest per key. Running a merge again changes nothing but the file names.
    A reader meets the old or the new folder of a day, but not of all days at once.
    """
    fresh = with_day(fresh, time_col).persist()
    try:
        # as many days as one delivery touches
        days = sorted(r.day for r in fresh.select("day").distinct().collect() if r.day is not None)
        if not days:
            return []
        folder, fs = _folder(spark, path)
        rows = fresh
        if fs.exists(folder):
            there = spark.read.schema(fresh.schema).parquet(path)
            rows = there.where(F.col("day").isin(days)).unionByName(fresh)
        kept = with_day(latest(rows.drop("day")), time_col)
        kept = kept.hint("rebalance", "day").sortWithinPartitions("day", *(sort_by or []))
        kept.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day").parquet(path)
        return [d.isoformat() for d in days]
    finally:
        fresh.unpersist()


#: Bytes a compacted file should have, and how many small files make a day worth rewriting.
TARGET_BYTES, SMALL_FILES = 128 << 20, 2


def compact(spark: SparkSession, path: str, target_bytes: int = TARGET_BYTES, small_files: int = SMALL_FILES, sort_by: list[str] | None = None) -> list[str]:
    """Rewrite the days that have several small files (below half of ``target_bytes``); returns them.

    Files are packed into bins of about ``target_bytes`` by the running sum of their sizes within the day, which the scan's own
    metadata column gives; each bin becomes one file. Other days keep their files. Must not run beside a
    writer of the same days; files that a stream's commit log lists (``to_files``) are its own and must be compacted into another folder.
    """
    from pyspark.sql import Window

    rows = spark.read.parquet(path)
    files = rows.select("day", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("bytes")).distinct()
    small = files.where(F.col("bytes") < target_bytes / 2).groupBy("day").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= small_files)
    upto = Window.partitionBy("day").orderBy("bytes", "file").rowsBetween(Window.unboundedPreceding, -1)
    bins = files.join(small.select("day"), "day").withColumn("bin", F.floor(F.coalesce(F.sum("bytes").over(upto), F.lit(0)) / target_bytes))
    # the bins of a day are numbered on from those of the days before: (day, first number, bins), one row a day
    per_day = sorted((r.day, r.bins) for r in bins.groupBy("day").agg((F.max("bin") + 1).alias("bins")).collect() if r.day is not None)
    if not per_day:
        return []
    days, starts, total = [d for d, _ in per_day], [], 0
    for day, n in per_day:
        starts.append((day, total))
        total += n
    first = spark.createDataFrame(starts, "day DATE, start BIGINT")
    numbered = bins.join(first, "day").select("file", (F.col("bin") + F.col("start")).cast("int").alias("bin"))
    touched = rows.where(F.col("day").isin(days)).withColumn("file", F.col("_metadata.file_path"))
    packed = touched.join(numbered, "file").repartitionById(total, "bin").sortWithinPartitions("day", *(sort_by or []))
    packed.select(*rows.columns).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day").parquet(path)
    return [d.isoformat() for d in days]
