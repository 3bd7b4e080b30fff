"""Links between near duplicates that share a band bucket, and the components they form.

Every pair of a bucket is decided, but never by listing the pairs of a bucket:

1. each member is compared with the bucket's centre (its smallest node), one row a member;
2. union-find joins what is linked; members of one component need no comparison among themselves;
3. buckets that still hold several components are compared in blocks of at most about ``BLOCK``
   members: a block pair is one task's matrix product, which returns only links that join
   components. A bucket of any size is thereby spread over many tasks.

Nodes are 64-bit hashes of distinct contents (see the operators).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapecheck.llm import batches
from tapecheck.llm.tables import stored

#: Members of a block; two blocks meet in one task.
BLOCK = 512

#: (hash, row, count) of the parts of each text, as ``batches.occurrences`` returns them.
Parts = Callable[[pa.Array], tuple[np.ndarray, np.ndarray, np.ndarray]]


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of ``edges`` (a, b): union-find by hooking and path halving.

    In each round every component hooks to its smallest neighbour, the chains of hooks are
    shortened until they are flat, and the links are renamed; links inside a component vanish.
    A component is named after its smallest node. Rounds grow with the logarithm of the nodes.
    """
    links = stored(edges.select("a", "b").where("a <> b").distinct(), "links")
    if links.isEmpty():
        return links.select(F.col("a").alias("node"), F.col("b").alias("component"))
    names = None
    while not links.isEmpty():
        both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hooks = both.groupBy("a").agg(F.min("b").alias("p")).select("a", F.least("a", "p").alias("p"))
        hooks = stored(hooks, "hooks")
        while True:
            up = hooks.select(F.col("a").alias("p"), F.col("p").alias("pp"))
            hooks = hooks.join(up, "p").select("a", F.col("pp").alias("p"), (F.col("pp") != F.col("p")).alias("moved"))
            hooks = stored(hooks, "hooks")
            if hooks.where("moved").isEmpty():
                break
        hooks = hooks.select("a", "p")
        if names is None:
            names = hooks.select(F.col("a").alias("node"), F.col("p").alias("component"))
        else:
            to = hooks.select(F.col("a").alias("component"), "p")
            names = stored(names.join(to, "component", "left").select("node", F.coalesce("p", "component").alias("component")), "names")
        links = (
            links.join(hooks.withColumnRenamed("p", "pa"), "a")
            .select("pa", F.col("b").alias("a"))
            .join(hooks.withColumnRenamed("p", "pb"), "a")
            .where("pa <> pb")
            .select(F.col("pa").alias("a"), F.col("pb").alias("b"))
            .distinct()
        )
        links = stored(links, "links")
    return names


def _verified(parts: Parts, threshold: float):
    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            left, right = batches.texts_of(batch["left"]), batches.texts_of(batch["right"])
            at = 0
            while at < len(batch):
                # as many pairs as make one chunk of text
                size = np.cumsum(
                    pa.compute.add(pa.compute.binary_length(left[at:]), pa.compute.binary_length(right[at:])).to_numpy(zero_copy_only=False)
                )
                n = max(1, int(np.searchsorted(size, batches.CHUNK, side="right")))
                like = batches.overlap(parts(left[at : at + n]), parts(right[at : at + n]), n)
                part = batch.slice(at, n).select(["a", "b"])
                yield part.append_column("similarity", pa.array(like)).filter(pa.array(like >= threshold))
                at += n

    return run


def verified(pairs: DataFrame, texts: DataFrame, parts: Parts, threshold: float) -> DataFrame:
    """The pairs (a, b) whose texts overlap by ``threshold`` or more, with their similarity."""
    both = pairs.join(texts.select(F.col("node").alias("a"), F.col("text").alias("left")), "a").join(
        texts.select(F.col("node").alias("b"), F.col("text").alias("right")), "b"
    )
    return both.select("a", "b", "left", "right").mapInArrow(_verified(parts, threshold), "a bigint, b bigint, similarity double")


def _joined(parts: Parts, threshold: float):
    """Links that join components among the texts of one pair of blocks."""

    def run(group: pa.Table) -> pa.Table:
        node = group["node"].to_numpy()
        name = group["component"].to_numpy()
        block = group["block"].to_numpy()
        first, second = group["i"][0].as_py(), group["j"][0].as_py()
        h, r, c = parts(batches.texts_of(group["text"]))
        total = np.bincount(r, weights=c, minlength=len(node)).astype(np.float32)
        # a part that occurs k times is k parts, so the product counts common occurrences
        rep = np.repeat(np.arange(len(h)), c)
        nth = np.arange(len(rep)) - np.repeat(np.cumsum(c) - c, c)
        h, r = batches.mix(h[rep] ^ batches.mix(nth.astype(np.uint64))), r[rep]
        _, column, often = np.unique(h, return_inverse=True, return_counts=True)
        shared = often[column] > 1
        column, r = np.unique(column[shared], return_inverse=True)[1], r[shared]
        order = np.argsort(column, kind="stable")
        column, r = column[order], r[order]
        common = np.zeros((len(node), len(node)), dtype=np.float32)
        width = int(column[-1]) + 1 if len(column) else 0
        for low in range(0, width, 4096):
            part = slice(*np.searchsorted(column, [low, low + 4096]))
            m = np.zeros((len(node), min(4096, width - low)), dtype=np.float32)
            m[r[part], column[part] - low] = 1
            common += m @ m.T
        linked = common >= threshold * (total[:, None] + total[None, :] - common) - 1e-4
        linked &= (common > 0) & (name[:, None] != name[None, :])
        if first != second:
            linked &= block[:, None] != block[None, :]
        a, b = np.nonzero(np.triu(linked, 1))
        root = {x: x for x in name.tolist()}

        def find(x):
            while root[x] != x:
                root[x] = root[root[x]]
                x = root[x]
            return x

        keep = []
        for k, (x, y) in enumerate(zip(name[a].tolist(), name[b].tolist(), strict=True)):
            x, y = find(x), find(y)
            if x != y:
                root[max(x, y)] = min(x, y)
                keep.append(k)
        return pa.table({"a": pa.array(node[a[keep]], pa.int64()), "b": pa.array(node[b[keep]], pa.int64())})

    return run


def link(bands: DataFrame, texts_of: Callable[[DataFrame], DataFrame], parts: Parts, threshold: float) -> DataFrame:
    """(node, component) of every node that is linked to another one.

    ``bands`` (band, node) comes from a stored table and may repeat rows; ``texts_of`` returns
    (node, text), each node once, for a stored table of nodes.
    """
    centres = bands.groupBy("band").agg(F.min("node").alias("centre"), F.max("node").alias("last"))
    centres = centres.where("centre < last").drop("last")
    crowd = stored(bands.join(centres, "band").select("band", "node", "centre"), "crowd")
    texts = stored(texts_of(stored(crowd.select("node").distinct(), "nodes")).select("node", "text"), "texts")
    star = crowd.where("node <> centre").select(F.col("node").alias("a"), F.col("centre").alias("b")).distinct()
    edges = stored(verified(star, texts, parts, threshold).select("a", "b"), "edges")
    names = components(edges)

    # Buckets with several components. Two members were compared already, and the same members
    # may fill buckets of several bands: one of them is enough.
    crowd = crowd.select("band", "node").distinct().join(names, "node", "left")
    crowd = crowd.select("band", "node", F.coalesce("component", "node").alias("component"))
    torn = crowd.groupBy("band").agg(
        F.count("*").alias("n"),
        F.min("component").alias("low"),
        F.max("component").alias("high"),
        F.sum(F.xxhash64("node") % F.lit(1 << 40)).alias("who"),
        F.min("node").alias("centre"),
    )
    torn = torn.where("n > 2 and low < high").groupBy("who", "n", "centre").agg(F.min("band").alias("band"))
    torn = torn.select("band", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"))
    blocks = crowd.join(torn, "band").withColumn("block", F.pmod(F.xxhash64("node", F.lit(7)), F.col("blocks")).cast("int"))
    blocks = blocks.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    blocks = blocks.join(texts, "node").select(
        "band", F.least("block", "with").alias("i"), F.greatest("block", "with").alias("j"), "block", "node", "component", "text"
    )
    more = blocks.groupBy("band", "i", "j").applyInArrow(_joined(parts, threshold), "a bigint, b bigint")
    more = stored(more, "more-edges")
    if more.isEmpty():
        return names
    return components(edges.union(more))
