"""Links between near duplicates among very many short texts, where most bucket mates are strangers.

Like ``links.link``, but what is compared first are sketches (the lowest byte of each of ``WIDTH`` signature values), not texts.
Two texts of similarity s agree in a share s of the values and in one of 256 others by chance, so pairs that agree in fewer than
``AGREE`` of them are far below 0.8: at 0.8 that is more than four standard deviations off. Texts are joined and
compared exactly for the rest only.

1. Each band is reduced to its smallest and largest node; most bands have one member and end here. They travel packed by
   slices of the range of bands, reduced before and after, so that a band of any size is a row or two for each part. A bounded
   bitmap of the others (``tables.Sieve``) drops nearly all single band rows before the second shuffle; an exact join follows.
2. Each member of a shared bucket is compared with the bucket's centre, and union-find joins what is linked.
3. Buckets that still hold several components: those of up to ``SMALL`` members are one row each, and many of them are decided in one
   batch; larger ones meet in blocks, as in ``links``. Either way only pairs whose sketches agree go on to the texts.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapecheck.llm import batches, links
from tapecheck.llm.tables import Sieve, forget, stored

WIDTH, AGREE = 60, 0.5
#: Members of a bucket that is one row.
SMALL = 32
#: Pairs (band, node) that are packed together, lines whose bands are one slice, and slices at least.
PACKED, SLICE, SLICES = 1 << 20, 1 << 14, 1 << 11

PAIR = "a bigint, b bigint"


def sketch(signature: np.ndarray) -> pa.Array:
    """The lowest bytes of the first ``WIDTH`` values of each row, as one binary value."""
    low = np.ascontiguousarray((signature[:, :WIDTH] & np.uint64(0xFF)).astype(np.uint8))
    ends = np.arange(0, low.size + 1, low.shape[1], dtype=np.int32)
    return pa.Array.from_buffers(pa.binary(), len(low), [None, pa.py_buffer(ends), pa.py_buffer(low)])


def _bytes(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Binary values of equal length as rows of bytes."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not len(column):
        return np.zeros((0, WIDTH), dtype=np.uint8)
    ends = np.frombuffer(column.buffers()[1], dtype=np.int32)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(column.buffers()[2], dtype=np.uint8)[ends[0] : ends[-1]].reshape(len(column), -1)


def _agreeing(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in rows:
        like = (_bytes(batch["x"]) == _bytes(batch["y"])).mean(axis=1) >= AGREE
        yield batch.select(["a", "b"]).filter(pa.array(like))


Hashes = Callable[[pa.Array], tuple[np.ndarray, np.ndarray]]


def similarities(left: pa.Array, right: pa.Array, hashes: Hashes) -> np.ndarray:
    """Jaccard similarity of each pair of texts, by the sets of their parts.

    Pair and hash share one 64-bit number, so that plain sorts do all the work; the hash keeps what the number of the pair
    leaves, 50 bits and more in the parts that ``verified`` cuts.
    """
    n = len(left)
    shift = np.uint64(max(1, n.bit_length()))
    keys = []
    for texts in (left, right):
        h, row = hashes(texts)
        key = np.sort((row.astype(np.uint64) << (np.uint64(64) - shift)) | (h >> shift))
        keys.append(key[np.concatenate(([True], key[1:] != key[:-1]))] if len(key) else key)
    both = np.sort(np.concatenate(keys))
    same = both[1:][both[1:] == both[:-1]] if len(both) else both
    size = [np.bincount((k >> (np.uint64(64) - shift)).astype(np.int64), minlength=n) for k in (*keys, same)]
    union = size[0] + size[1] - size[2]
    return np.divide(size[2], union, out=np.zeros(n), where=union > 0)


def _verified(hashes: Hashes, threshold: float):
    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            left, right = batches.texts_of(batch["left"]), batches.texts_of(batch["right"])
            size = np.cumsum(pa.compute.add(pa.compute.binary_length(left), pa.compute.binary_length(right)).to_numpy(zero_copy_only=False))
            at = 0
            while at < len(batch):
                n = max(1, int(np.searchsorted(size, (size[at - 1] if at else 0) + batches.CHUNK, side="right")) - at)
                like = similarities(left[at : at + n], right[at : at + n], hashes)
                yield batch.slice(at, n).select(["a", "b"]).filter(pa.array(like >= threshold))
                at += n

    return run


def verified(pairs: DataFrame, texts: DataFrame, hashes: Hashes, threshold: float) -> DataFrame:
    """The pairs (a, b) whose texts' similarity is ``threshold`` or more."""
    both = pairs.join(texts.select(F.col("node").alias("a"), F.col("text").alias("left")), "a")
    both = both.join(texts.select(F.col("node").alias("b"), F.col("text").alias("right")), "b")
    return both.select("a", "b", "left", "right").mapInArrow(_verified(hashes, threshold), PAIR)


def _mates(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of small buckets, one a row: pairs of different components whose sketches agree."""
    for batch in rows:
        lists = batch["members"]
        size = lists.value_lengths().to_numpy(zero_copy_only=False)
        flat = lists.flatten()
        node, name, sk = flat.field("node").to_numpy(), flat.field("component").to_numpy(), _bytes(flat.field("sketch"))
        begin = np.cumsum(size) - size
        a, b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for step in range(1, int(size.max(initial=1))):
            at = np.arange(len(node))
            left = at[at + step < np.repeat(begin + size, size)]
            left = left[name[left] != name[left + step]]
            like = (sk[left] == sk[left + step]).mean(axis=1) >= AGREE
            a.append(node[left[like]])
            b.append(node[left[like] + step])
        x, y = np.concatenate(a), np.concatenate(b)
        yield pa.RecordBatch.from_arrays([pa.array(np.minimum(x, y)), pa.array(np.maximum(x, y))], names=["a", "b"])


def _worth(group: pa.Table) -> pa.Table:
    """Members of a pair of blocks that agree with a member of another component."""
    sk, name, block = _bytes(group["sketch"]), group["component"].to_numpy(), group["block"].to_numpy()
    n = len(sk)
    wanted = np.zeros(n, dtype=bool)
    for k in range(n):
        like = (sk == sk[k]).mean(axis=1) >= AGREE
        like &= name != name[k]
        if group["i"][0] != group["j"][0]:
            like &= block != block[k]
        wanted[k] = like.any()
    return group.drop(["sketch"]).filter(pa.array(wanted))


def _pairs(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """(band, node) of each band of each node."""
    lists = batch["bands"]
    return lists.flatten().to_numpy(), np.repeat(batch["node"].to_numpy(), lists.value_lengths().to_numpy(zero_copy_only=False))


def _ends(band: np.ndarray, node: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each different band in order, with its smallest and its largest node."""
    order = np.argsort(band)
    band, node = band[order], node[order]
    first = np.flatnonzero(np.concatenate(([True], band[1:] != band[:-1])))
    return band[first], np.minimum.reduceat(node, first), np.maximum.reduceat(node, first)


def _packed(slices: int):
    """(slice, band, node): the bands of each slice, as one value, with the smallest and the largest node of each."""
    edges = np.arange(slices, dtype=np.uint64) << np.uint64(65 - slices.bit_length())

    def pack(parts: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        band, low, high = _ends(np.concatenate([band for band, _ in parts]).view(np.uint64), np.concatenate([node for _, node in parts]))
        times = 1 + (low < high)
        band, node = np.repeat(band, times), np.repeat(low, times)
        node[np.cumsum(times) - 1] = high
        ends = np.append(np.searchsorted(band, edges), len(band)).astype(np.int32)
        values = [pa.Array.from_buffers(pa.binary(), slices, [None, pa.py_buffer(ends * np.int32(8)), pa.py_buffer(x)]) for x in (band, node)]
        out = pa.RecordBatch.from_arrays([pa.array(np.arange(slices, dtype=np.int32)), *values], names=["slice", "band", "node"])
        return out.filter(pa.array(np.diff(ends) > 0))

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, n = [], 0
        for batch in rows:
            parts.append(_pairs(batch))
            n += len(parts[-1][0])
            if n >= PACKED:
                yield pack(parts)
                parts, n = [], 0
        if n:
            yield pack(parts)

    return run


def _centres(group: pa.Table) -> pa.Table:
    """Of a slice: the bands that several nodes share, with the smallest of these."""
    band, node = (np.frombuffer(b"".join(group[c].to_pylist()), dtype=kind) for c, kind in (("band", np.uint64), ("node", np.int64)))
    band, low, high = _ends(band, node)
    shared = low < high
    return pa.table({"band": pa.array(batches.signed(band[shared])), "centre": pa.array(low[shared])})


def shared_bands(own: DataFrame, lines: int) -> DataFrame:
    """(band, centre) of the bands that several nodes share; ``own`` (node, bands) has about ``lines`` rows."""
    slices = max(SLICES, 1 << (lines // SLICE).bit_length())
    packed = own.select("node", "bands").mapInArrow(_packed(slices), "slice int, band binary, node binary")
    return packed.groupBy("slice").applyInArrow(_centres, "band bigint, centre bigint")


def _through_sieve(sieve: Sieve):
    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            band, node = _pairs(batch)
            ok = sieve.passes(band.view(np.uint64))
            yield pa.RecordBatch.from_arrays([pa.array(band[ok]), pa.array(node[ok])], names=["band", "node"])

    return run


def extended(names: DataFrame, more: DataFrame) -> DataFrame:
    """Components after further links: only the components that these join are named anew."""

    def named(edges: DataFrame, end: str) -> DataFrame:
        to = names.select(F.col("node").alias(end), F.col("component").alias(f"_{end}"))
        return edges.join(to, end, "left").withColumn(end, F.coalesce(f"_{end}", end)).drop(f"_{end}")

    joined = links.components(named(named(more, "a"), "b"))
    to = joined.select(F.col("node").alias("component"), F.col("component").alias("to"))
    old = names.join(to, "component", "left").select("node", F.coalesce("to", "component").alias("component"))
    fresh = joined.join(names.select("node"), "node", "left_anti").join(names.select(F.col("component").alias("node")), "node", "left_anti")
    return old.unionByName(fresh)


def link(scanned: DataFrame, texts_of: Callable[[DataFrame], DataFrame], hashes: Hashes, parts: links.Parts, threshold: float) -> DataFrame:
    """(node, component) of every node that is linked to another one.

    ``scanned`` (node, bands, sketch) is a stored table in which a node may repeat, without its bands and sketch or with
    them. ``texts_of`` returns (node, text), each node once, for a stored table of nodes.
    """
    own = scanned.where(F.size("bands") > 0)
    shared = stored(shared_bands(own, scanned.count()), "shared-bands")
    kept = own.select("node", "bands").mapInArrow(_through_sieve(Sieve(shared, "band")), "band bigint, node bigint")
    crowd = stored(kept.join(shared, "band").distinct(), "crowd")
    nodes = stored(crowd.select("node").distinct(), "nodes")
    known = stored(own.join(nodes, "node", "left_semi").select("node", "sketch").dropDuplicates(["node"]), "sketches")

    def agreeing(pairs: DataFrame) -> DataFrame:
        both = pairs.join(known.select(F.col("node").alias("a"), F.col("sketch").alias("x")), "a")
        both = both.join(known.select(F.col("node").alias("b"), F.col("sketch").alias("y")), "b")
        return both.select("a", "b", "x", "y").mapInArrow(_agreeing, PAIR)

    star = crowd.where("node <> centre").select(F.col("centre").alias("a"), F.col("node").alias("b")).distinct()
    star = stored(agreeing(star), "star")
    # one pass over the documents fetches the texts of all members of shared buckets
    texts = stored(texts_of(nodes).select("node", "text"), "texts")
    edges = stored(verified(star, texts, hashes, threshold), "edges")
    names = stored(links.components(edges), "names")
    forget(star, edges)

    torn = crowd.select("band", "node").join(names, "node", "left").select("band", "node", F.coalesce("component", "node").alias("component"))
    state = torn.groupBy("band").agg(
        F.count("*").alias("n"),
        F.min("component").alias("low"),
        F.max("component").alias("high"),
        F.sum(F.xxhash64("node") % F.lit(1 << 40)).alias("who"),
        F.min("node").alias("centre"),
    )
    # the same members may fill buckets of several bands: one of them is enough; two members were compared already
    state = state.where("n > 2 and low < high").groupBy("who", "n", "centre").agg(F.min("band").alias("band"))
    members = stored(torn.join(state.select("band", "n"), "band").join(known, "node"), "torn")
    small = members.where(F.col("n") <= SMALL).groupBy("band").agg(F.collect_list(F.struct("node", "component", "sketch")).alias("members"))
    near = small.select("members").mapInArrow(_mates, PAIR).distinct()
    wide = members.where(F.col("n") > SMALL).withColumn("blocks", F.ceil(F.col("n") / links.BLOCK).cast("int"))
    wide = wide.withColumn("block", F.pmod(F.xxhash64("node", F.lit(7)), F.col("blocks")).cast("int"))
    wide = wide.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    wide = wide.select("band", F.least("block", "with").alias("i"), F.greatest("block", "with").alias("j"), "block", "node", "component", "sketch")
    worth = wide.groupBy("band", "i", "j").applyInArrow(_worth, "band bigint, i int, j int, block int, node bigint, component bigint")
    near, worth = stored(near, "near"), stored(worth, "worth")
    more = verified(near, texts, hashes, threshold)
    blocks = worth.join(texts, "node").groupBy("band", "i", "j").applyInArrow(links._joined(parts, threshold), PAIR)
    more = stored(more.unionByName(blocks), "more-edges")
    out = names if more.isEmpty() else stored(extended(names, more), "names")
    forget(shared, crowd, nodes, known, members, near, worth, texts, more)
    return out
