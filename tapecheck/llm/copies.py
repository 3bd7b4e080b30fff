"""Near-duplicate documents by BagMinHash over the multiset of five-word shingles.

The weight of a shingle is how often it stands in the text, and two texts are near duplicates if the
weighted Jaccard similarity of their multisets (sum of minima over sum of maxima) is 0.8 or more.

BagMinHash gives each shingle a Poisson process over (time, weight level, register): a point counts
if its level is at most the shingle's weight, and a register keeps its earliest point. Two multisets
share a register's point with probability equal to their weighted Jaccard similarity. The levels
are discretised to whole numbers and grouped into (0,1], (1,2], (2,4], (4,8] ...: one process of that
block's rate serves all levels of a block, and a point's level comes from halving its block, bit by
bit, so a shingle that stands n times costs about log n processes. Points are made in order of
time and only up to a limit by which every register is nearly surely filled; a document with an
empty register is done again with a doubled limit, so the signature is exact.

Documents whose multisets are equal are one node before any pair is made, so copies cost nothing.
A document without words has no shingle and is like no other.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tapecheck.llm import batches
from tapecheck.llm.links import link
from tapecheck.llm.tables import Sieve, keyed, stored

WORDS = 5
THRESHOLD = 0.8
#: Rows of a band and bands. Two documents of similarity 0.8 share a band with probability 0.9996.
ROWS, BANDS = 5, 20

U = np.uint64


def bag(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(shingle, row, count) of whole texts."""
    texts, found = batches.texts_of(texts), []
    for at, end, data, off in batches.chunks(texts):
        h, row, *_ = batches.words(data, off)
        h, row, n = batches.occurrences(*batches.shingles(h, row, end - at, WORDS))
        found.append((h, row + at, n))
    if not found:
        return np.zeros(0, U), np.zeros(0, np.int64), np.zeros(0, np.int64)
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def _uniform(h: np.ndarray) -> np.ndarray:
    """In (0, 1]."""
    return ((h >> U(11)).astype(np.float64) + 1.0) * 2.0**-53


def bag_min_hash(shingle: np.ndarray, row: np.ndarray, count: np.ndarray, rows: int, registers: int) -> np.ndarray:
    """(rows x registers) times of the earliest points, as integers; a row without shingles has the largest value."""
    out = np.full(rows * registers, np.inf)
    mass = np.bincount(row, weights=count, minlength=rows)
    todo = mass > 0
    # by this time a register is empty with probability e**-6 / registers
    limit = (np.log(registers) + 6.0) / np.maximum(mass, 1)
    while todo.any():
        pick = todo[row]
        s, r, c = shingle[pick], row[pick], count[pick]
        blocks = np.where(c > 1, np.ceil(np.log2(np.maximum(c, 1))), 0).astype(np.int64) + 1
        at = np.repeat(np.arange(len(s)), blocks)
        block = np.arange(len(at)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
        r, c = r[at], c[at]
        low = np.where(block > 0, 1 << np.maximum(block - 1, 0), 0)  # the block's levels: low+1 ... low+width
        width = np.where(block > 0, low, 1)
        seed = batches.mix(s[at] + batches.mix(block.astype(np.uint64)))
        rate, until = width * float(registers), limit[r]
        time, point = np.zeros(len(at)), 0
        while len(time):
            point += 1
            h = batches.mix(seed + U(point * 0x9E3779B97F4A7C15 % 2**64))
            time = time - np.log(_uniform(h)) / rate
            live = time <= until
            seed, time, rate, until, r, c, low, width, h = (x[live] for x in (seed, time, rate, until, r, c, low, width, h))
            h = batches.mix(h ^ U(0xD6E8FEB86659FD93))
            level = low + 1 + ((h & U(0xFFFFFFFF)) & (width - 1).astype(np.uint64)).astype(np.int64)
            counts = level <= c
            np.minimum.at(out, r[counts] * registers + ((h[counts] >> U(32)) % U(registers)).astype(np.int64), time[counts])
        empty = np.isinf(out.reshape(rows, registers)).any(axis=1) & todo
        todo = empty
        limit = limit * 2
    return out.view(np.uint64).reshape(rows, registers)


def _scanned(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    registers = ROWS * BANDS
    for batch in rows:
        texts = batches.texts_of(batch["text"])
        for at, end, _, _ in batches.chunks(texts):
            n = end - at
            shingle, row, count = bag(texts[at:end])
            # the hash of the multiset: a sum over its members, each hashed with its count
            each = batches.mix(shingle ^ batches.mix(count.astype(np.uint64)))
            node, total = np.zeros(n, dtype=np.uint64), np.bincount(row, weights=count, minlength=n)
            np.add.at(node, row, each)
            node = batches.mix(node)
            sig = bag_min_hash(shingle, row, count, n, registers)
            bands = np.empty((n, BANDS), dtype=np.uint64)
            for b in range(BANDS):
                band = np.full(n, b + 1, dtype=np.uint64)
                for k in range(b * ROWS, (b + 1) * ROWS):
                    band = batches.mix(band * U(0x9E3779B97F4A7C15) + sig[:, k])
                bands[:, b] = band
            some = total > 0
            first = np.zeros(n, dtype=bool)
            first[np.unique(node, return_index=True)[1]] = True
            first &= some
            ends = np.concatenate(([0], np.cumsum(first * BANDS))).astype(np.int32)
            part = batch.slice(at, n)
            yield pa.RecordBatch.from_arrays(
                [
                    part["k1"],
                    part["k2"],
                    pa.array(batches.signed(node), mask=~some),
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(batches.signed(bands[first].ravel()))),
                ],
                names=["k1", "k2", "node", "bands"],
            )


def _texts(sieve: Sieve):
    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            texts = batches.texts_of(batch["text"])
            for at, end, _, _ in batches.chunks(texts):
                shingle, row, count = bag(texts[at:end])
                each = batches.mix(shingle ^ batches.mix(count.astype(np.uint64)))
                node = np.zeros(end - at, dtype=np.uint64)
                np.add.at(node, row, each)
                node, first = np.unique(batches.mix(node), return_index=True)
                found = sieve.passes(node)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(batches.signed(node[found])), texts.take(pa.array(first[found] + at)).cast(pa.string())], names=["node", "text"]
                )

    return run


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(k1, k2, class_k1, class_k2, class_size) of each different document; ``docs`` has k1, k2 and text.

    The class is named after its smallest (doc_id, hash of the text). ``class_size`` counts rows.
    """
    scanned = docs.select("k1", "k2", "text").mapInArrow(_scanned, "k1 bigint, k2 bigint, node bigint, bands array<bigint>")
    scanned = stored(scanned, "bags")

    def texts_of(nodes: DataFrame) -> DataFrame:
        found = docs.select("text").mapInArrow(_texts(Sieve(nodes, "node")), "node bigint, text string")
        return found.join(nodes, "node", "left_semi").dropDuplicates(["node"])

    names = link(scanned.select(F.explode("bands").alias("band"), "node"), texts_of, bag, threshold)
    seen = scanned.groupBy("node").agg(F.min(F.struct("k1", "k2")).alias("first"), F.count("*").alias("n")).where("node is not null")
    seen = seen.join(names, "node", "left").select("node", F.coalesce("component", "node").alias("component"), "first", "n")
    seen = stored(seen, "seen")
    whole = seen.groupBy("component").agg(F.min("first").alias("first"), F.sum("n").alias("class_size"))
    whole = seen.select("node", "component").join(whole, "component").select("node", "first", "class_size")
    alone = F.struct("k1", "k2")
    return (
        scanned.select("k1", "k2", "node")
        .join(whole, "node", "left")
        .select("k1", "k2", F.coalesce("first", alone).alias("first"), F.coalesce("class_size", F.lit(1)).alias("class_size"))
        .select("k1", "k2", F.col("first.k1").alias("class_k1"), F.col("first.k2").alias("class_k2"), "class_size")
    )


def near_dedup(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One document of each class, in the columns of ``docs``: the one of the smallest doc_id.

    Of rows that repeat a doc_id and a text one stays. A null doc_id counts as the smallest.
    """
    own = keyed(docs)
    classes = near_duplicates(own, threshold)
    stay = classes.where("k1 = class_k1 and k2 = class_k2").select("k1", "k2").distinct()
    once = Window.partitionBy("k1", "k2").orderBy(F.lit(1))
    return own.join(stay, ["k1", "k2"]).withColumn("_n", F.row_number().over(once)).where("_n = 1").select("row.*")
