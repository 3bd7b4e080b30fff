"""Toxicity by the nearest labelled examples: exact TF-IDF cosine over a block-max inverted index.

The index holds a bounded sample of labelled documents (``TOXIC`` and ``OTHER``, those of the smallest
hashes) over all their words. A term weighs (1 + ln tf) x ln((N + 1) / (df + 1)) x relevance, with df and N counted
over all documents; its relevance is the size of the correlation (phi) between the examples that hold it
and those that are toxic. Without it the cosine finds texts of the same topic, not of the same tone.
Vectors have length one. A word that no example holds is as far from all of them, so it has no weight.

Examples stand in blocks of ``BLOCK``. A term of at most ``SHORT`` examples is one list of postings, which is scored in full; the
longer lists are cut by block, and a block keeps the largest weight of each. For a query, the sum of
query weight x block maximum, and the best of what the short lists gave, bounds every similarity of the block,
so blocks whose bound does not reach the k-th best similarity so far are skipped; the result is
the same as that of comparing with all examples. The ``NEAREST`` neighbours vote with weight
1 / (distance + ``SOFT``), and a logistic curve fitted on labelled documents outside the index turns the
vote into a probability. The nearest examples are returned as evidence.

The index is broadcast; it is as large as the distinct words of its at most ``TOXIC`` + ``OTHER`` examples, whatever the
number of documents.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapecheck.llm import batches

TOXIC, OTHER, CALIBRATION = 2_000, 4_000, 4_000
NEAREST, SOFT, EVIDENCE = 15, 0.05, 3
BLOCK = 128
#: Lists of more postings are cut by block. Where the cut lies changes no result.
SHORT = 96
FOLDS, HELD_OUT, CALIBRATING = 5, 0, 1
#: Documents scored at a time.
TOGETHER = 512


def fold() -> Column:
    """crc32 of the doc_id as text, modulo ``FOLDS``; null for a null doc_id."""
    return F.crc32(F.col("doc_id").cast("string")) % FOLDS


def _counted(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, part, toxic, terms, tf) of the sampled documents."""
    for batch in rows:
        texts = batches.texts_of(batch["text"])
        for at, end, data, off in batches.chunks(texts):
            h, row, *_ = batches.words(data, off)
            h, row, n = batches.occurrences(h, row)
            ends = pa.array(np.searchsorted(row, np.arange(end - at + 1)).astype(np.int32))
            columns = [batch[c].slice(at, end - at) for c in ("doc_id", "part", "toxic")]
            columns += [pa.ListArray.from_arrays(ends, pa.array(batches.signed(h))), pa.ListArray.from_arrays(ends, pa.array(n.astype(np.int32)))]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "part", "toxic", "terms", "tf"])


class Vocabulary:
    """The index's terms: sorted word hashes, and a column for each."""

    def __init__(self, terms: np.ndarray):
        self.terms = np.sort(terms.astype(np.int64).view(np.uint64))

    def columns(self, h: np.ndarray) -> np.ndarray:
        if not len(self.terms):
            return np.full(len(h), -1)
        at = np.minimum(np.searchsorted(self.terms, h), len(self.terms) - 1)
        return np.where(self.terms[at] == h, at, -1)


def _frequencies(sent):
    """One row per term and task: in how many documents of the task it stands; term -1 counts documents."""

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary: Vocabulary = sent.value
        df, total = np.zeros(len(vocabulary.terms), dtype=np.int64), 0
        for batch in rows:
            texts = batches.texts_of(batch["text"])
            total += len(texts)
            for _, end, data, off in batches.chunks(texts):
                h, row, *_ = batches.words(data, off)
                col = vocabulary.columns(h)
                pairs = np.unique(row[col >= 0] * np.int64(len(df)) + col[col >= 0]) if len(df) else np.zeros(0, np.int64)
                df += np.bincount(pairs % max(1, len(df)), minlength=len(df))
        some = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(some, -1)), pa.array(np.append(df[some], total))], names=["term", "n"])

    return run


def flat(columns: list, tf: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, term, tf) of lists of terms."""
    owner = np.repeat(np.arange(len(columns)), [len(c) for c in columns])
    return owner, *(np.concatenate([*x, np.zeros(0, np.int64)]).astype(np.int64) for x in (columns, tf))


def relevance(df: np.ndarray, toxic: np.ndarray, examples: int, toxic_examples: int) -> np.ndarray:
    """Size of the correlation between holding a term (df examples, of which ``toxic`` are toxic) and being toxic."""
    spread = df * (examples - df) * float(toxic_examples) * (examples - toxic_examples)
    return np.divide(np.abs(examples * toxic - df * float(toxic_examples)), np.sqrt(spread), out=np.zeros(len(df)), where=spread > 0)


class Index:
    """Unit vectors of examples as postings, with what scoring needs.

    ``weight`` has a number for each of the vocabulary's terms; ``columns`` and ``tf`` list the terms of each example.
    """

    def __init__(self, vocabulary: Vocabulary, weight: np.ndarray, columns: list, tf: list, label: np.ndarray, ids: np.ndarray):
        self.vocabulary, self.weight = vocabulary, weight
        n = len(columns)
        owner, column, value = self.entries(n, *flat(columns, tf))
        main = np.full(n, -1)
        up = np.argsort(value, kind="stable")
        main[owner[up]] = column[up]
        order = np.lexsort((ids, main, label))
        self.label, self.ids = label[order].astype(np.float64), ids[order]
        owner = np.argsort(order)[owner]
        many = np.bincount(column, minlength=len(weight)) > SHORT
        #: Number of a long list, or -1.
        self.long = np.where(many, np.cumsum(many) - 1, -1)
        cut = many[column]
        by = np.lexsort((owner[~cut], column[~cut]))
        self.example, self.value = owner[~cut][by], value[~cut][by]
        self.start = np.searchsorted(column[~cut][by], np.arange(len(weight) + 1))
        owner, column, value = owner[cut], self.long[column[cut]], value[cut]
        self.blocks, most = [], [np.zeros((many.sum(), 0), np.float32)]
        for low in range(0, n, BLOCK):
            here = (owner >= low) & (owner < low + BLOCK)
            part = np.zeros((many.sum(), min(BLOCK, n - low)), dtype=np.float32)
            part[column[here], owner[here] - low] = value[here]
            terms = np.flatnonzero(part.any(axis=1))
            self.blocks.append((low, terms, part[terms]))
            most.append(part.max(axis=1)[:, None])
        self.most = np.concatenate(most, axis=1)
        self.curve = (0.0, 1.0)

    def entries(self, rows: int, owner: np.ndarray, column: np.ndarray, tf: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, term, value) of unit vectors."""
        value = (1 + np.log(tf)) * self.weight[column]
        length = np.sqrt(np.bincount(owner, weights=value * value, minlength=rows))
        some = value > 0
        owner, column, value = owner[some], column[some], value[some]
        return owner, column, (value / length[owner]).astype(np.float32)

    def nearest(self, rows: int, owner: np.ndarray, column: np.ndarray, value: np.ndarray, k: int = NEAREST) -> tuple[np.ndarray, np.ndarray]:
        """(similarity, example) of the k best examples of each of ``rows`` queries, best first; ties go to the lower number."""
        n = len(self.label)
        k = min(k, n)
        best = np.full((rows, k), -1.0)  # similarity less a trifle for the example's number
        slot = self.long[column]
        cut = slot >= 0
        q = np.zeros((rows, len(self.most)), dtype=np.float32)
        q[owner[cut], slot[cut]] = value[cut]
        owner, column, value = owner[~cut], column[~cut], value[~cut]
        size = self.start[column + 1] - self.start[column]
        at = np.repeat(self.start[column] - np.cumsum(size) + size, size) + np.arange(size.sum())
        short = np.bincount(np.repeat(owner, size) * n + self.example[at], weights=np.repeat(value, size) * self.value[at], minlength=rows * n)
        short = short.reshape(rows, n)
        bound = q @ self.most + np.maximum.reduceat(short, np.arange(0, n, BLOCK), axis=1)

        def visit(b: int, some: np.ndarray) -> None:
            low, terms, postings = self.blocks[b]
            found = (q[np.ix_(some, terms)] @ postings).astype(np.float64) + short[some, low : low + postings.shape[1]]
            found = np.round(found, 6) - (low + np.arange(postings.shape[1])) * 1e-11
            both = np.concatenate([best[some], found], axis=1)
            best[some] = -np.partition(-both, k - 1, axis=1)[:, :k]

        first = bound.argmax(axis=1)
        for b in np.unique(first):
            visit(int(b), np.flatnonzero(first == b))
        for b in np.argsort(-bound.max(axis=0), kind="stable"):
            some = np.flatnonzero((first != b) & (bound[:, b] + 2e-6 >= best.min(axis=1)))
            if len(some):
                visit(int(b), some)
        best = -np.sort(-best, axis=1)
        similarity = np.round(best, 6)
        return similarity, np.rint((similarity - best) * 1e11).astype(np.int64)

    def votes(self, rows: int, owner: np.ndarray, column: np.ndarray, tf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Share of the votes for toxic, and the examples, of ``rows`` texts whose terms are given text by text."""
        share = np.zeros(rows)
        if not len(self.label):
            return share, np.zeros((rows, 0), np.int64)
        near = np.zeros((rows, min(NEAREST, len(self.label))), np.int64)
        owner, column, value = self.entries(rows, owner, column, tf)
        for low in range(0, rows, TOGETHER):
            high = min(rows, low + TOGETHER)
            own = slice(*np.searchsorted(owner, [low, high]))
            similarity, example = self.nearest(high - low, owner[own] - low, column[own], value[own])
            weight = 1 / (1 - np.clip(similarity, 0, 1) + SOFT)
            share[low:high] = (weight * self.label[example]).sum(axis=1) / weight.sum(axis=1)
            near[low:high] = example
        return share, near

    def calibrate(self, votes: np.ndarray, label: np.ndarray) -> None:
        """A logistic curve by Newton steps, with one pseudo-example of each label."""
        x = np.concatenate([votes, [0.0, 1.0]])
        y = np.concatenate([label, [0.0, 1.0]]).astype(np.float64)
        a = np.stack([np.ones(len(x)), x], axis=1)
        w = np.zeros(2)
        for _ in range(50):
            p = 0.5 * (1 + np.tanh(0.5 * (a @ w)))
            step = np.linalg.solve(a.T @ (a * (p * (1 - p))[:, None]) + 1e-3 * np.eye(2), a.T @ (y - p) - 1e-3 * w)
            w += np.clip(step, -3, 3)
        self.curve = (float(w[0]), float(w[1]))

    def score(self, votes: np.ndarray) -> np.ndarray:
        return 0.5 * (1 + np.tanh(0.5 * (self.curve[0] + self.curve[1] * votes)))


def sample(labels: DataFrame) -> DataFrame:
    """(doc_id, part, toxic) of the labelled documents that are learnt from; at most TOXIC + OTHER + CALIBRATION rows."""
    rows = labels.where("toxic in (0, 1)").where(fold() != HELD_OUT).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    rows = rows.select("doc_id", F.col("toxic").cast("int").alias("toxic"), (fold() == CALIBRATING).alias("aside"))
    at = (F.xxhash64("doc_id"), F.col("doc_id"))
    example = F.lit("example").alias("part")
    return (
        rows.where("not aside and toxic = 1").orderBy(*at).limit(TOXIC).select("doc_id", example, "toxic")
        .union(rows.where("not aside and toxic = 0").orderBy(*at).limit(OTHER).select("doc_id", example, "toxic"))
        .union(rows.where("aside").orderBy(*at).limit(CALIBRATION).select("doc_id", F.lit("calibration").alias("part"), "toxic"))
    )


def build(docs: DataFrame, labels: DataFrame) -> Index:
    spark = docs.sparkSession
    # broadcast: the sample has at most TOXIC + OTHER + CALIBRATION rows
    picked = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").join(F.broadcast(sample(labels)), "doc_id")
    picked = picked.groupBy("doc_id", "part", "toxic").agg(F.min("text").alias("text"))  # an id may repeat
    rows = picked.mapInArrow(_counted, "doc_id bigint, part string, toxic int, terms array<bigint>, tf array<int>").toArrow()
    rows = rows.sort_by([("doc_id", "ascending")])

    def of(part: str):
        own = rows.filter(pa.compute.equal(rows["part"], part))
        terms, tf = ([np.asarray(v, dtype=np.int64) for v in own[c].to_pylist()] for c in ("terms", "tf"))
        return terms, tf, own["toxic"].to_numpy(), own["doc_id"].to_numpy()

    terms, tf, label, ids = of("example")
    vocabulary = Vocabulary(np.unique(np.concatenate([*terms, np.zeros(0, np.int64)])))
    sent = spark.sparkContext.broadcast(vocabulary)
    found = docs.select("text").mapInArrow(_frequencies(sent), "term bigint, n bigint").groupBy("term").agg(F.sum("n").alias("n")).toArrow()
    term, n = found["term"].to_numpy(), found["n"].to_numpy()
    df = np.zeros(len(vocabulary.terms))
    df[term[term >= 0]] = n[term >= 0]
    owner, column, _ = flat([vocabulary.columns(x.view(np.uint64)) for x in terms], tf)
    held, toxic = (np.bincount(column, weights=x, minlength=len(df)) for x in (np.ones(len(owner)), label[owner]))
    idf = np.log((n[term < 0].sum() + 1) / (df + 1))
    weight = idf * relevance(held, toxic, len(label), int(label.sum()))
    index = Index(vocabulary, weight, [vocabulary.columns(x.view(np.uint64)) for x in terms], tf, label, ids)

    terms, tf, label, _ = of("calibration")
    owner, column, tf = flat([vocabulary.columns(x.view(np.uint64)) for x in terms], tf)
    known = column >= 0
    index.calibrate(index.votes(len(label), owner[known], column[known], tf[known])[0], label)
    return index


def _scored(sent):
    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index: Index = sent.value
        for batch in rows:
            texts = batches.texts_of(batch["text"])
            for at, end, data, off in batches.chunks(texts):
                n = end - at
                h, row, *_ = batches.words(data, off)
                col = index.vocabulary.columns(h)
                size = max(1, len(index.weight))
                pairs, tf = np.unique(row[col >= 0] * np.int64(size) + col[col >= 0], return_counts=True)
                votes, example = index.votes(n, pairs // size, pairs % size, tf)
                example = example[:, :EVIDENCE]
                bounds = pa.array((np.arange(n + 1) * example.shape[1]).astype(np.int32))
                evidence = pa.ListArray.from_arrays(bounds, pa.array(index.ids[example.ravel()] if example.size else np.zeros(0, np.int64)))
                yield pa.RecordBatch.from_arrays(
                    [batch["doc_id"].cast(pa.int64()).slice(at, n), pa.array(index.score(votes)), evidence],
                    names=["doc_id", "score", "evidence"],
                )

    return run


def scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted, evidence) of every row.

    Null texts are empty; an empty text has a vector of zeros and the votes of the first examples
    in the index's order. Without labels every score is 0.5. A null doc_id is not held out.
    """
    sent = docs.sparkSession.sparkContext.broadcast(build(docs, labels))
    found = docs.select("doc_id", "text").mapInArrow(_scored(sent), "doc_id bigint, score double, evidence array<bigint>")
    held = F.coalesce(fold() == HELD_OUT, F.lit(False))
    return found.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "evidence")
