"""Reading tables, tables written between steps, and row keys."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapecheck.settings import shared_dir

#: Columns of ``documents``.
DOCUMENT = ("doc_id", "text", "lang", "source", "n_chars")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, purpose: str, compression: str = "zstd") -> DataFrame:
    """``df`` written below the cluster's shared folder and read again.

    Later steps neither repeat the work before it nor depend on the executors that did it.
    """
    path = shared_dir(df.sparkSession, f"llm-{purpose}")
    df.write.option("compression", compression).parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.stored_at = path
    return out


def forget(*tables: DataFrame) -> None:
    """Delete ``stored`` tables that nothing reads any more (what was made of them has been written)."""
    for df in tables:
        spark = df.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(df.stored_at)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def keyed(docs: DataFrame) -> DataFrame:
    """(k1, k2, text, row): each document's key, its text, and all its columns as one struct, so that none can clash.

    The key tells documents apart even if ids are null or repeat: the id, and a hash of the text.
    """
    return docs.select(
        F.coalesce(F.col("doc_id").cast("bigint"), F.lit(-(2**63))).alias("k1"),
        F.xxhash64(F.coalesce("text", F.lit(""))).alias("k2"),
        F.col("text"),
        F.struct(*[docs[c] for c in docs.columns]).alias("row"),
    )


#: Bits of a ``Sieve``: 2 MB at least, 16 MB at most are sent to each executor.
SIEVE_BITS = (1 << 24, 1 << 27)


class Sieve:
    """A bitmap of 64-bit hashes, sent to all executors to drop most rows that a join would drop.

    Its size is bounded. It never loses a member; the more members, the more others it lets pass,
    so an exact join always follows.
    """

    def __init__(self, nodes: DataFrame, column: str):
        low, high = SIEVE_BITS
        self.bits = min(max(low, 1 << (16 * nodes.count()).bit_length()), high)
        at = F.pmod(F.col(column), F.lit(self.bits))
        words = nodes.groupBy(F.shiftright(at, 6).alias("word")).agg(
            F.bit_or(F.expr(f"shiftleft(1L, cast(pmod({column}, 64) as int))")).alias("mask")
        )
        found = words.toArrow()
        mask = np.zeros(self.bits // 64, dtype=np.uint64)
        mask[found["word"].to_numpy()] = found["mask"].to_numpy().view(np.uint64)
        self._sent = nodes.sparkSession.sparkContext.broadcast(mask)

    def __getstate__(self):
        return {"bits": self.bits, "_sent": self._sent}

    def passes(self, node: np.ndarray) -> np.ndarray:
        at = node.astype(np.uint64) & np.uint64(self.bits - 1)
        return (self._sent.value[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1) == 1
