"""Exact deduplication against a minimal perfect hash of the digests seen before.

Texts are equal when they are identical after deleting white space (space and \\x09-\\x0D). The digest
is SHA-256 of what is left. Of equal texts the one with the most code points stays, then the smallest
doc_id (a null doc_id counts as larger than any other).

``build_index`` turns the winners among historical documents into an index: the distinct digests are dealt to shards
by prefix, and each shard is one row that holds a minimal perfect hash (levels of bit arrays, a key
settles in the first level where it alone hits its bit; its slot is the rank of that bit) and slots
of 32 digest bytes, winner length and winner doc_id. A shard holds about ``SHARD`` digests at most, of the history
and of the new ones; shards grow with the larger of the two, none of them passes through the driver.

``lookup`` sends each distinct new digest to its shard, computes its slot and compares all 32 bytes, since
a perfect hash maps strangers to slots too. Members take over the historical winner's locator;
nonmembers are grouped separately.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapecheck.llm import batches
from tapecheck.llm.tables import stored

#: Digests of a shard, about; 48 bytes each.
SHARD = 100_000
#: Bits of a level for each key that is still unsettled.
GAMMA = 2.0

NO_ID = 2**63 - 1
WHITE = " \t\n\x0b\x0c\r"

U = np.uint64


def digests(docs: DataFrame, *more: Column) -> DataFrame:
    """(doc_id, digest, length) of every row, and more columns; a null text counts as empty."""
    text = F.coalesce("text", F.lit(""))
    return docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.unhex(F.sha2(F.translate(text, WHITE, ""), 256)).alias("digest"),
        F.char_length(text).cast("bigint").alias("length"),
        *more,
    )


def winners(rows: DataFrame) -> DataFrame:
    """(digest, n, winner): one row for each digest, reduced before it is shuffled."""
    rank = F.struct((-F.col("length")).alias("minus"), F.coalesce("doc_id", F.lit(NO_ID)).alias("id"))
    return rows.groupBy("digest").agg(F.count("*").alias("n"), F.min(rank).alias("winner"))


def shard_of(shards: int) -> Column:
    return F.pmod(F.conv(F.hex(F.substring("digest", 1, 6)), 16, 10).cast("bigint"), F.lit(shards)).cast("int")


def _keys(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The digests as (n, 32) bytes, and 64 bits of each for hashing."""
    raw = np.frombuffer(b"".join(column.to_pylist()), dtype=np.uint8).reshape(len(column), 32)
    words = raw.view(np.uint64)
    return raw, words[:, 1] ^ batches.mix(words[:, 2].copy())


def _bit(key: np.ndarray, level: int, bits: int) -> np.ndarray:
    return (batches.mix(key + U((level + 1) * 0x9E3779B97F4A7C15 % 2**64)) % U(bits)).astype(np.int64)


def _build(group: pa.Table) -> pa.Table:
    raw, key = _keys(group["digest"].combine_chunks())
    slot, left = np.full(len(key), -1), np.arange(len(key))
    sizes, levels, used = [], [], 0
    while len(left):
        bits = max(64, int(GAMMA * len(left)) // 64 * 64 + 64)
        at = _bit(key[left], len(sizes), bits)
        alone = np.bincount(at, minlength=bits) == 1
        settled = alone[at]
        rank = np.cumsum(alone) - 1
        slot[left[settled]] = used + rank[at[settled]]
        used += int(alone.sum())
        sizes.append(bits)
        levels.append(np.packbits(alone, bitorder="little"))
        left = left[~settled]
    order = np.argsort(slot)
    return pa.table(
        {
            "shard": group["shard"].slice(0, 1),
            "sizes": pa.array([sizes], pa.list_(pa.int64())),
            "levels": pa.array([np.concatenate(levels).tobytes()], pa.binary()),
            "slots": pa.array([raw[order].tobytes()], pa.binary()),
            "minus": pa.array([group["minus"].to_numpy()[order].tobytes()], pa.binary()),
            "ids": pa.array([group["id"].to_numpy()[order].tobytes()], pa.binary()),
        }
    )


INDEX = "shard int, sizes array<bigint>, levels binary, slots binary, minus binary, ids binary"


def build_index(known: DataFrame, shards: int) -> DataFrame:
    """The index of historical winners (see ``winners``): one row a shard."""
    known = known.select(shard_of(shards).alias("shard"), "digest", "winner.minus", "winner.id")
    return known.groupBy("shard").applyInArrow(_build, INDEX)


def _found(index: pa.Table, new: pa.Table) -> pa.Table:
    """The new digests of one shard with the locator of the historical winner, null for nonmembers."""
    n = new.num_rows
    member, minus, ids = np.zeros(n, bool), np.zeros(n, np.int64), np.zeros(n, np.int64)
    if n and index.num_rows:
        raw, key = _keys(new["digest"].combine_chunks())
        bits = np.frombuffer(index["levels"][0].as_py(), dtype=np.uint8)
        slots = np.frombuffer(index["slots"][0].as_py(), dtype=np.uint8).reshape(-1, 32)
        slot, left, byte, used = np.full(n, -1), np.arange(n), 0, 0
        for level, size in enumerate(index["sizes"][0].as_py()):
            alone = np.unpackbits(bits[byte : byte + size // 8], bitorder="little").astype(bool)
            at = _bit(key[left], level, size)
            settled = alone[at]
            slot[left[settled]] = used + (np.cumsum(alone) - 1)[at[settled]]
            used += int(alone.sum())
            byte += size // 8
            left = left[~settled]
        hit = np.flatnonzero(slot >= 0)
        hit = hit[(slots[slot[hit]] == raw[hit]).all(axis=1)]
        member[hit] = True
        minus[hit] = np.frombuffer(index["minus"][0].as_py(), dtype=np.int64)[slot[hit]]
        ids[hit] = np.frombuffer(index["ids"][0].as_py(), dtype=np.int64)[slot[hit]]
    out = new.select(["digest", "n", "minus", "id"])
    return out.append_column("old_minus", pa.array(minus, mask=~member)).append_column("old_id", pa.array(ids, mask=~member))


def lookup(index: DataFrame, new: DataFrame, shards: int) -> DataFrame:
    """``new`` (digest, n, winner), each digest once, with old_minus and old_id of members."""
    new = new.select(shard_of(shards).alias("shard"), "digest", "n", "winner.minus", "winner.id")
    both = index.groupBy("shard").cogroup(new.groupBy("shard"))
    return both.applyInArrow(_found, "digest binary, n bigint, minus bigint, id bigint, old_minus bigint, old_id bigint")


def exact_dedup(docs: DataFrame, is_history: Column) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    ``is_history`` tells which rows came before (null: no). Rows that repeat a doc_id and a text are
    equal in all respects: all of them are ``kept`` if their doc_id is. keep_id is null only for a
    group all of whose longest texts have no doc_id.
    """
    rows = stored(digests(docs, F.coalesce(is_history, F.lit(False)).alias("old")), "digests")
    old = stored(winners(rows.where("old")), "history")
    new = stored(winners(rows.where("not old")), "new")
    shards = max(1, -(-max(old.count(), new.count()) // SHARD))
    index = stored(build_index(old, shards), "index")
    found = lookup(index, new, shards)
    found = stored(found, "found")
    # members join the historical group; nonmembers are groups of their own
    news = found.where("old_id is not null").select("digest", F.col("n").alias("more"), F.struct("minus", "id").alias("newcomer"))
    groups = old.join(news, "digest", "left").select(
        "digest",
        (F.col("n") + F.coalesce("more", F.lit(0))).alias("group_size"),
        F.least("winner", F.coalesce("newcomer", "winner")).alias("winner"),
    )
    groups = groups.union(found.where("old_id is null").select("digest", "n", F.struct("minus", "id")))
    keep = groups.select("digest", "group_size", F.when(F.col("winner.id") != NO_ID, F.col("winner.id")).alias("keep_id"))
    return rows.join(keep, "digest").select(
        "doc_id",
        "keep_id",
        "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )
