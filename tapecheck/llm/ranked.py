"""Ranked lexical search by a dual tree over items and documents, exact.

Every item is a query against all documents. A document's score is the sum, over the item's terms with repeats, of
``weight(term) * impact(term, document)``; both are integers, fixed by the corpus:

* weight = floor(1000 ln((2N + 2) / (2 df + 1))), with N documents that hold a term and df that hold this one;
* impact = 10^9 tf div (1000 tf + 8 m), m = 25 + (75 n N) div L, with n terms of the document and L of all documents.

A score is thus an inner product, and coordinate maxima bound it: for a set of items and a set of documents no score
exceeds the product of the largest weights and the largest impacts by term.

1. ``postings`` keeps of each document its length and the frequencies of terms that occur in items (a bounded bitmap
   drops the others; what it lets through has no item and does no harm). df, N and L are Spark aggregates over it.
2. Items are dealt to bundles of about ``BUNDLE`` terms; one bundle at a time is broadcast. In a bundle items are ordered
   by their weightiest terms and form a hierarchy: groups, nodes, items, each with coordinate maxima.
3. Each task reads documents in blocks, orders a block by the documents' strongest terms and builds the same
   hierarchy over it: block, nodes, leaves, documents. From the top, a pair of an item set and a document set is dropped if its
   bound is below the weakest k-th best score of the items; pairs that survive down to leaves are scored.
4. A task starts with a lower bound of each item's k-th score: the k-th score among the documents of a fixed sample
   (``SEED``), found by the same search. It only saves work; every document is searched.
5. A task returns its k best per item, and the best of those win.

Terms are runs of digits, letters and characters beyond ASCII; A-Z count as a-z. They are held as 64-bit hashes.

A null or empty text has no terms and is never found. Items without terms, or whose terms no document holds, give no
rows. Items with equal id and text count once; an item with a null id is searched like any other. Equal scores are
ordered by doc_id, null last; repeated rows are documents of their own. Other columns are dropped.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tapecheck.llm import batches
from tapecheck.llm.tables import Sieve, stored

#: Terms of a bundle of items, about (16 bytes each); a longer item is a bundle of its own.
BUNDLE = 1 << 18
#: Documents of a block and of a leaf, and leaves of a node; items of a group and of a node.
BLOCK, LEAF, NODE_LEAVES = 4096, 16, 16
GROUP, FEW = 64, 8
#: One document in this many is searched first, for lower bounds.
SEED = 64

NO_ID = 2**63 - 1

POSTINGS = "doc_id bigint, n bigint, terms array<bigint>, tfs array<bigint>"


def _counted(text: pa.Array, sieve: Sieve | None) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """For chunks of rows: first row, end row, words of each row, and (row, term, frequency) of the terms that pass."""
    for first, end, data, offsets in batches.chunks(batches.texts_of(text)):
        h, row, _, _ = batches.words(data, offsets)
        n = np.bincount(row, minlength=end - first)
        if sieve is not None:
            ok = sieve.passes(h)
            h, row = h[ok], row[ok]
        term, at, tf = batches.occurrences(h, row)
        yield first, end, n, at, term, tf


def _lists(at: np.ndarray, rows: int, values: np.ndarray) -> pa.Array:
    offsets = np.concatenate(([0], np.cumsum(np.bincount(at, minlength=rows))))
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values.view(np.int64), pa.int64()))


def postings(rows: DataFrame, sieve: Sieve | None = None) -> DataFrame:
    """(doc_id, n, terms, tfs) of the rows (doc_id, text): all words counted, terms in the order of their hashes."""

    def read(parts: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            for first, end, n, at, term, tf in _counted(batch.column("text"), sieve):
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(first, end - first), pa.array(n, pa.int64()), _lists(at, end - first, term), _lists(at, end - first, tf)],
                    names=["doc_id", "n", "terms", "tfs"],
                )

    return rows.mapInArrow(read, POSTINGS)


class Bundle:
    """The hierarchy over a bundle's items: groups, nodes and items, each a stretch of the same order.

    Items with the same strongest terms stand next to each other. Columns are places in ``terms``.
    """

    def __init__(self, found: pa.Table):
        size = found["terms"].combine_chunks().value_lengths().to_numpy(zero_copy_only=False)
        term, weight = (found[c].combine_chunks().flatten().to_numpy() for c in ("terms", "weights"))
        item = np.repeat(np.arange(len(size)), size)
        #: Rows of the table in the order of the hierarchy.
        self.order = _by_strongest(item, term, weight, len(size))
        place = _inverse(self.order)[item]
        again = np.argsort(place, kind="stable")
        self.terms, column = np.unique(term[again], return_inverse=True)
        self.column, self.weight = column, weight[again]
        self.begin = np.searchsorted(place[again], np.arange(len(size) + 1))
        self.best = np.zeros(len(self.terms), dtype=np.int64)
        np.maximum.at(self.best, self.column, self.weight)

    def __len__(self) -> int:
        return len(self.begin) - 1

    def maxima(self, first: int, end: int, out: np.ndarray) -> np.ndarray:
        """Largest weights of some items, written into ``out``; returns the columns that are set."""
        part = slice(self.begin[first], self.begin[end])
        np.maximum.at(out, self.column[part], self.weight[part])
        return self.column[part]


def _inverse(order: np.ndarray) -> np.ndarray:
    out = np.empty_like(order)
    out[order] = np.arange(len(order))
    return out


def _by_strongest(row: np.ndarray, term: np.ndarray, value: np.ndarray, rows: int) -> np.ndarray:
    """The rows, those with the same strongest and second strongest term next to each other."""
    order = np.lexsort((term, -value, row))
    start = np.searchsorted(row[order], np.arange(rows + 1))
    top = np.full((2, rows), -1, dtype=np.int64)
    for k in range(2):
        has = np.diff(start) > k
        top[k, has] = term[order][start[:-1][has] + k]
    return np.lexsort((top[1], top[0]))


class Best:
    """The k best documents of each item so far, and the score a newcomer must reach."""

    def __init__(self, least: np.ndarray, k: int):
        self.least, self.k = least.copy(), k
        none = np.zeros(0, dtype=np.int64)
        self.found = [(none, none)] * len(least)

    def offer(self, item: int, scores: np.ndarray, ids: np.ndarray) -> None:
        good = (scores >= self.least[item]) & (scores > 0)
        if not good.any():
            return
        s, d = (np.concatenate(x) for x in zip(self.found[item], (scores[good], ids[good]), strict=True))
        order = np.lexsort((d, -s))[: self.k]
        self.found[item] = s[order], d[order]
        if len(order) == self.k:
            self.least[item] = max(self.least[item], s[order[-1]])


def _maxima(part: np.ndarray, column: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The largest value of each (part, column)."""
    order = np.lexsort((column, part))
    p, c = part[order], column[order]
    new = np.flatnonzero(np.concatenate(([True], (p[1:] != p[:-1]) | (c[1:] != c[:-1]))))
    return p[new], c[new], np.maximum.reduceat(value[order], new)


class Block:
    """The hierarchy over a block of documents: their impacts, and the largest ones of leaves and nodes."""

    def __init__(self, ids: np.ndarray, row: np.ndarray, column: np.ndarray, impact: np.ndarray, best: np.ndarray):
        order = _by_strongest(row, column, impact * best[column], len(ids))
        place = _inverse(order)[row]
        again = np.argsort(place, kind="stable")
        self.ids, self.place, self.column, self.impact = ids[order], place[again], column[again], impact[again]
        self.leaf = _maxima(self.place // LEAF, self.column, self.impact)
        self.node = _maxima(self.leaf[0] // NODE_LEAVES, *self.leaf[1:])
        self.leaves = -(-len(ids) // LEAF)
        self.begin = np.searchsorted(self.place, np.arange(self.leaves + 1) * LEAF)

    def offer(self, leaf: int, weights: np.ndarray, item: int, best: Best) -> None:
        """Score the documents of a leaf against an item."""
        part = slice(self.begin[leaf], self.begin[leaf + 1])
        ids = self.ids[leaf * LEAF : (leaf + 1) * LEAF]
        score = np.zeros(len(ids), dtype=np.int64)
        np.add.at(score, self.place[part] - leaf * LEAF, self.impact[part] * weights[self.column[part]])
        best.offer(item, score, ids)


def _reach(part: np.ndarray, column: np.ndarray, value: np.ndarray, weights: np.ndarray, parts: int) -> np.ndarray:
    """An upper bound of the scores of each part, above any rounding."""
    return np.bincount(part, value * weights[column].astype(float), minlength=parts) * (1 + 1e-9)


def _meet(bundle: Bundle, first: int, block: Block, best: Best, scratch: np.ndarray) -> None:
    """A group of items against a block, from the top of both hierarchies. ``scratch`` is zero before and after."""
    end = min(first + GROUP, len(bundle))
    used = bundle.maxima(first, end, scratch)
    live = _reach(*block.node, scratch, -(-block.leaves // NODE_LEAVES)) >= best.least[first:end].min()
    near = live[block.leaf[0] // NODE_LEAVES] & (scratch[block.leaf[1]] > 0)
    leaf, column, value = (x[near] for x in block.leaf)
    scratch[used] = 0
    for low in range(first, end, FEW):
        high = min(low + FEW, end)
        used = bundle.maxima(low, high, scratch)
        ok = (_reach(leaf, column, value, scratch, block.leaves) >= best.least[low:high].min())[leaf] & (scratch[column] > 0)
        own = leaf[ok], column[ok], value[ok]
        scratch[used] = 0
        for item in range(low, high):
            used = bundle.maxima(item, item + 1, scratch)
            reach = _reach(*own, scratch, block.leaves)
            # the most promising leaves first: what they find drops most of the others
            for at in np.argsort(-reach, kind="stable"):
                if reach[at] < best.least[item] or reach[at] == 0:
                    break
                block.offer(int(at), scratch, item, best)
            scratch[used] = 0


def _blocks(parts: Iterable[pa.RecordBatch], bundle: Bundle, stats: tuple[int, int]) -> Iterator[tuple[np.ndarray, ...]]:
    """(ids, row, column, impact) of blocks of documents, with the terms that the bundle knows."""
    n_docs, n_all = stats
    for batch in parts:
        lists, n = batch.column("terms"), batch.column("n").to_numpy()
        offsets, term, tf = lists.offsets.to_numpy(), lists.values.to_numpy(), batch.column("tfs").values.to_numpy()
        ids = batch.column("doc_id").fill_null(NO_ID).to_numpy(zero_copy_only=False)
        for begin in range(0, len(n), BLOCK):
            end = min(begin + BLOCK, len(n))
            part = slice(offsets[begin], offsets[end])
            row = np.repeat(np.arange(end - begin), np.diff(offsets[begin : end + 1]))
            column = np.minimum(np.searchsorted(bundle.terms, term[part]), len(bundle.terms) - 1)
            known = bundle.terms[column] == term[part]
            row, column, count = row[known], column[known], tf[part][known]
            if len(row):
                m = 25 + (75 * n[begin:end] * n_docs) // n_all
                yield ids[begin:end], row, column, (1_000_000_000 * count) // (1000 * count + 8 * m[row])


def _search(bundle: Bundle, least: np.ndarray, k: int, stats: tuple[int, int], parts: Iterable[pa.RecordBatch]) -> Best:
    """The k best documents of a task for each item, but none below ``least``."""
    best, scratch = Best(least, k), np.zeros(len(bundle.terms), dtype=np.int64)
    for ids, row, column, impact in _blocks(parts, bundle, stats):
        top = np.zeros(len(bundle.terms), dtype=np.int64)
        np.maximum.at(top, column, impact)
        block = None
        for first in range(0, len(bundle), GROUP):
            end = min(first + GROUP, len(bundle))
            used = bundle.maxima(first, end, scratch)
            some = np.unique(used)
            reach = float(top[some].astype(float) @ scratch[some]) * (1 + 1e-9)
            scratch[used] = 0
            if reach < best.least[first:end].min():
                continue  # the whole block is out of reach of the whole group
            block = block or Block(ids, row, column, impact, bundle.best)
            _meet(bundle, first, block, best, scratch)
    return best


def _items(items: DataFrame) -> DataFrame:
    """(k1, k2, terms, tfs): one row per different (id, text), by terms of the text."""
    rows = items.select(F.col("item_id").cast("bigint").alias("k1"), F.coalesce("text", F.lit("")).alias("text")).distinct()
    named = rows.withColumn("k2", F.xxhash64("text"))

    def read(parts: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            for first, end, _, at, term, tf in _counted(batch.column("text"), None):
                lists = [_lists(at, end - first, x) for x in (term, tf)]
                yield pa.RecordBatch.from_arrays([*(batch.column(c).slice(first, end - first) for c in ("k1", "k2")), *lists], names=["k1", "k2", "terms", "tfs"])

    return named.select("k1", "k2", "text").mapInArrow(read, "k1 bigint, k2 bigint, terms array<bigint>, tfs array<bigint>")


def search(docs: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    """Each item's ``k`` documents of the highest scores above 0: item_id, rank (from 1), doc_id, score."""
    spark = docs.sparkSession
    wanted = stored(_items(items), "ranked-items")
    entries = wanted.select("k1", "k2", F.explode(F.arrays_zip("terms", "tfs")).alias("e")).select("k1", "k2", F.col("e.terms").alias("term"), F.col("e.tfs").alias("tf"))
    sieve = Sieve(entries.select("term").distinct(), "term")
    kept = stored(postings(docs.select(F.col("doc_id").cast("bigint"), "text"), sieve), "ranked-postings")
    total = kept.agg(F.count_if(F.col("n") > 0).alias("docs"), F.coalesce(F.sum("n"), F.lit(0)).alias("words")).first()
    n, words = total.docs, total.words
    df = kept.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    weight = F.floor(F.lit(1000) * F.log(F.lit(2.0 * n + 2) / (2 * F.col("df") + 1))).cast("bigint")
    weighted = (
        entries.join(df, "term")
        .withColumn("weight", F.col("tf") * weight)
        .where("weight > 0")
        .groupBy("k1", "k2")
        .agg(F.array_sort(F.collect_list(F.struct("term", "weight"))).alias("e"))
        .select("k1", "k2", F.col("e.term").alias("terms"), F.col("e.weight").alias("weights"))
    )
    weighted = stored(weighted, "ranked-weights")
    size = weighted.agg(F.sum(F.size("terms"))).first()[0] or 0
    bundles = -(-size // BUNDLE)
    dealt = weighted.withColumn("bundle", F.pmod(F.xxhash64("k1", "k2"), F.lit(max(bundles, 1))))
    found = [_best(kept, dealt.where(F.col("bundle") == b).drop("bundle"), k, (n, words)) for b in range(bundles)]
    out = spark.createDataFrame([], "item_id bigint, rank int, doc_id bigint, score bigint")
    for one in found:
        out = out.unionByName(one)
    return out


def _best(kept: DataFrame, rows: DataFrame, k: int, stats: tuple[int, int]) -> DataFrame:
    """The result for one bundle of items: its size is bounded, so it may be read by the driver and broadcast."""
    spark = kept.sparkSession
    table = rows.toArrow()
    bundle = Bundle(table)
    items = table.select(["k1"]).take(pa.array(bundle.order)).append_column("item", pa.array(np.arange(len(bundle)), pa.int32()))
    sent = spark.sparkContext.broadcast(bundle)

    def ranked(docs: DataFrame, least: np.ndarray) -> DataFrame:
        floor = spark.sparkContext.broadcast(least)

        def run(parts: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            best = _search(sent.value, floor.value, k, stats, parts)
            for first in range(0, len(best.found), 1024):
                some = best.found[first : first + 1024]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.repeat(np.arange(first, first + len(some)), [len(s) for s, _ in some]), pa.int32()),
                        pa.array(np.concatenate([d for _, d in some]), pa.int64()),
                        pa.array(np.concatenate([s for s, _ in some]), pa.int64()),
                    ],
                    names=["item", "doc_id", "score"],
                )

        order = Window.partitionBy("item").orderBy(F.desc("score"), "doc_id")
        each = docs.mapInArrow(run, "item int, doc_id bigint, score bigint")
        return each.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)

    seeds = kept.where(F.pmod(F.xxhash64("doc_id", "n"), F.lit(SEED)) == 0)
    known = ranked(seeds, np.zeros(len(bundle), dtype=np.int64)).where(F.col("rank") == k).select("item", "score").toArrow()
    least = np.zeros(len(bundle), dtype=np.int64)
    least[known["item"].to_numpy()] = known["score"].to_numpy()
    named = spark.createDataFrame(items)
    return ranked(kept, least).join(F.broadcast(named), "item").select(F.col("k1").alias("item_id"), "rank", F.nullif("doc_id", F.lit(NO_ID)).alias("doc_id"), "score")
