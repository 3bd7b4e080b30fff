"""Small tables a foreachBatch job keeps between batches, one folder per batch until they are packed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


class BatchTable:
    """``path/batch_id=N`` holds what batch N wrote; running a batch again replaces its folder,
    so a restart never counts anything twice."""

    def __init__(self, path: str, schema: str):
        self.path, self.schema = path, schema

    def at(self, spark: SparkSession, batch_id: int) -> DataFrame:
        """Rows written by one batch; empty before the first batch. A batch that wrote nothing never happened, so reading
        it is an error (see ``has``)."""
        if batch_id < 0:
            return spark.createDataFrame([], self.schema)
        return spark.read.schema(self.schema).parquet(f"{self.path}/batch_id={batch_id}")

    def has(self, spark: SparkSession, batch_id: int) -> bool:
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/batch_id={batch_id}/_SUCCESS")
        return batch_id >= 0 and path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path)

    def write(self, df: DataFrame, batch_id: int) -> None:
        df.write.mode("overwrite").parquet(f"{self.path}/batch_id={batch_id}")

    def all(self, spark: SparkSession) -> DataFrame:
        """Rows of all batches, with their batch_id: packed ones, and folders that are not packed yet."""
        schema = f"{self.schema}, batch_id INT"
        packs = self._packs(spark)
        folders = spark.read.schema(schema).parquet(self.path)
        if not packs:
            return folders
        # a folder that a pack holds already may still be there if the driver died before it was deleted
        packed = spark.read.schema(schema).parquet(*[f"{self.path}_packed/{n}" for n in packs])
        return folders.where(F.col("batch_id") > packs[-1]).unionByName(packed)

    def _packs(self, spark: SparkSession) -> list[int]:
        """Last batches of the finished packs."""
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}_packed")
        fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        if not fs.exists(path):
            return []
        names = [x.getPath().getName() for x in fs.listStatus(path)]
        return sorted(int(n) for n in names if n.isdigit() and fs.exists(spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}_packed/{n}/_SUCCESS")))

    def pack(self, spark: SparkSession, upto: int) -> int:
        """Put the folders of the batches up to ``upto`` into one; returns how many. Each row is packed once, so the work
        follows the rows, and the number of folders is bounded by packs plus what came after the last one."""
        packs = self._packs(spark)
        done = packs[-1] if packs else -1
        if upto <= done:
            return 0
        rows = spark.read.schema(f"{self.schema}, batch_id INT").parquet(self.path).where(F.col("batch_id").between(done + 1, upto))
        rows.hint("rebalance").write.mode("overwrite").parquet(f"{self.path}_packed/{upto}")
        path = spark._jvm.org.apache.hadoop.fs.Path(self.path)
        fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        gone = 0
        for x in fs.listStatus(path):
            name = x.getPath().getName()
            if name.startswith("batch_id=") and int(name.split("=")[1]) <= upto:
                gone += bool(fs.delete(x.getPath(), True))
        return gone

    def forget(self, spark: SparkSession, before: int, keep: int = 3) -> None:
        """Drop state no restart can ask for any more (a batch reads only its predecessor)."""
        old = before - keep
        if old < 0:
            return
        jvm, sc = spark._jvm, spark.sparkContext
        path = jvm.org.apache.hadoop.fs.Path(f"{self.path}/batch_id={old}")
        path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)
