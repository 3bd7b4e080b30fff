"""Quality classifier by positive-unlabelled learning (non-negative risk).

Trusted positives are documents labelled as good; the unlabelled side is web text of unknown quality.
With class prior p, the risk of a scorer g is

    p E_pos[l(g)] + max(0, E_unl[l(-g)] - p E_pos[l(-g)])

whose second part estimates the risk on the negatives; where a batch drives it below zero the step
undoes the overfit instead. The prior comes from positives and unlabelled text alone: for a first
scorer of positives against unlabelled, p is the smallest ratio of the shares above a cut, with a margin for
the counts ("best bin"). The scorer is a small network over measures of form and repetition that
know no language: labels, lang, source and doc_id are not among them.

Every whole text is measured once, and every document is scored. Only the fit uses a bounded sample: at most
``POSITIVES`` and ``UNLABELLED`` documents, those of the smallest hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapecheck.llm import batches
from tapecheck.llm.tables import stored

POSITIVES, UNLABELLED = 12_000, 24_000
HIDDEN, STEPS, RATE, DECAY = 24, 800, 0.01, 1e-4
FOLDS, HELD_OUT = 3, 1
#: Without a positive example there is nothing to learn: every document scores this.
UNTRAINED = 0.5

U = np.uint64
_CLASSES = [b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" \t", b"\n", b".", b",;:", b"!?", b"|", b"#*", b"$%&", b"+=<>{}[]()_\\/^~@", b"\"'-"]
_CLASS = np.full(256, len(_CLASSES), dtype=np.uint8)
for _k, _c in enumerate(_CLASSES):
    _CLASS[list(_c)] = _k
_CLASS[128:] = len(_CLASSES) + 1
MEASURES = len(_CLASSES) + 2 + 12


def _share(row: np.ndarray, rows: int, weights=None) -> np.ndarray:
    return np.bincount(row, weights=weights, minlength=rows).astype(np.float64)


def measures(texts: pa.Array) -> np.ndarray:
    """(rows x MEASURES) measures of whole texts; an empty text has zeros but for its lengths."""
    texts, found = batches.texts_of(texts), [np.zeros((0, MEASURES), dtype=np.float32)]
    for at, end, data, off in batches.chunks(texts):
        n = end - at
        size = np.maximum(np.diff(off), 1).astype(np.float64)
        owner = np.repeat(np.arange(n), np.diff(off))
        kinds = len(_CLASSES) + 2
        by = np.bincount(owner * kinds + _CLASS[data], minlength=n * kinds).reshape(n, kinds) / size[:, None]
        h, row, starts, ends = batches.words(data, off)
        count = np.bincount(row, minlength=n)
        some = np.maximum(count, 1).astype(np.float64)
        length = (ends - starts).astype(np.float64)
        mean = _share(row, n, length) / some
        _, r1, c1 = batches.occurrences(h, row)
        most = np.zeros(n)
        np.maximum.at(most, r1, c1)
        again = np.flatnonzero((h[1:] == h[:-1]) & (row[1:] == row[:-1])) if len(h) else np.zeros(0, np.int64)
        h3, row3 = batches.shingles(h, row, n, 3)
        _, r3, c3 = batches.occurrences(h3, row3)
        total3 = np.maximum(_share(row3, n), 1)
        lines = by[:, 3] * size + 1
        line_words = count / lines
        # a word right before a symbol that is neither a letter nor plain punctuation
        after = _CLASS[data[np.minimum(ends, max(len(data) - 1, 0))]] if len(h) else np.zeros(0, np.uint8)
        odd = np.isin(after, (6, 8, 9, 10)) & (ends < off[row + 1]) if len(h) else np.zeros(0, bool)
        more = np.stack(
            [
                np.log1p(count),
                mean,
                np.sqrt(np.maximum(_share(row, n, length**2) / some - mean**2, 0)),
                _share(r1, n) / some,
                most / some,
                _share(row[again], n) / some,
                _share(r3, n) / total3 * (count > 0),
                _share(r3, n, c3 * (c3 > 1)) / total3,
                np.log1p(line_words),
                _share(row[odd], n) / some,
                _share(row, n, length > 20) / some,
                by[:, 4] * size / some,
            ],
            axis=1,
        )
        found.append(np.concatenate([by, more], axis=1).astype(np.float32))
    return np.concatenate(found)


def _measured(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in rows:
        m = measures(batch["text"])
        flat = pa.FixedSizeListArray.from_arrays(pa.array(m.ravel()), MEASURES).cast(pa.list_(pa.float32()))
        yield pa.RecordBatch.from_arrays([batch["doc_id"].cast(pa.int64()), flat], names=["doc_id", "measures"])


class Network:
    """One hidden layer over standardised measures; ``score`` is in (0, 1)."""

    def __init__(self, mean: np.ndarray, spread: np.ndarray, seed: int = 1):
        rng = np.random.default_rng(seed)
        self.mean, self.spread = mean, spread
        self.w = [rng.normal(0, MEASURES**-0.5, (MEASURES, HIDDEN)), np.zeros(HIDDEN), rng.normal(0, HIDDEN**-0.5, HIDDEN), np.zeros(1)]

    def scaled(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.spread, -6, 6)

    def forward(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        hidden = np.tanh(x @ self.w[0] + self.w[1])
        return hidden, hidden @ self.w[2] + self.w[3][0]

    def gradient(self, x: np.ndarray, hidden: np.ndarray, slope: np.ndarray) -> list[np.ndarray]:
        back = np.outer(slope, self.w[2]) * (1 - hidden**2)
        return [x.T @ back, back.sum(axis=0), hidden.T @ slope, np.array([slope.sum()])]

    def logit(self, measured: np.ndarray) -> np.ndarray:
        return self.forward(self.scaled(measured.astype(np.float64)))[1]

    def score(self, measured: np.ndarray) -> np.ndarray:
        return _sigmoid(self.logit(measured))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def fit(positive: np.ndarray, unlabelled: np.ndarray, prior: float, steps: int = STEPS, seed: int = 1) -> Network:
    """Minimise the non-negative risk with logistic loss by Adam over random halves."""
    both = np.concatenate([positive, unlabelled]).astype(np.float64)
    net = Network(both.mean(axis=0), both.std(axis=0) + 1e-6, seed)
    p, u = net.scaled(positive.astype(np.float64)), net.scaled(unlabelled.astype(np.float64))
    rng = np.random.default_rng(seed)
    first, second = [np.zeros_like(w) for w in net.w], [np.zeros_like(w) for w in net.w]
    for step in range(1, steps + 1):
        xp, xu = p[rng.integers(0, len(p), min(len(p), 2048))], u[rng.integers(0, len(u), min(len(u), 4096))]
        (hp, gp), (hu, gu) = net.forward(xp), net.forward(xu)
        negative = np.logaddexp(0, gu).mean() - prior * np.logaddexp(0, gp).mean()
        # slopes of the three parts at each row
        plus = -prior * _sigmoid(-gp) / len(gp)
        minus_p, minus_u = -prior * _sigmoid(gp) / len(gp), _sigmoid(gu) / len(gu)
        if negative >= 0:
            g = [a + b for a, b in zip(net.gradient(xp, hp, plus + minus_p), net.gradient(xu, hu, minus_u), strict=True)]
        else:
            g = [-(a + b) for a, b in zip(net.gradient(xp, hp, minus_p), net.gradient(xu, hu, minus_u), strict=True)]
        for k, w in enumerate(net.w):
            d = g[k] + DECAY * w
            first[k] = 0.9 * first[k] + 0.1 * d
            second[k] = 0.999 * second[k] + 0.001 * d * d
            w -= RATE * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
    return net


def class_prior(positive: np.ndarray, unlabelled: np.ndarray) -> float:
    """The share of positives among the unlabelled: the smallest ratio of the shares above a cut."""
    if len(positive) < 4 or len(unlabelled) < 4:
        return 0.5
    net = fit(positive[::2], unlabelled[::2], 0.5, steps=STEPS // 4)
    p, u = net.logit(positive[1::2]), np.sort(net.logit(unlabelled[1::2]))
    cuts = np.quantile(p, np.linspace(0, 0.9, 91))
    above_p = np.array([(p >= c).mean() for c in cuts])
    above_u = 1 - np.searchsorted(u, cuts) / len(u)
    margin = np.sqrt(np.log(40) / (2 * len(u))) + np.sqrt(np.log(40) / (2 * len(p)))
    best = int(np.argmin((above_u + margin) / above_p))
    return float(np.clip(above_u[best] / above_p[best], 0.02, 0.98))


def held_out(folds: int = FOLDS, fold: int = HELD_OUT) -> Column:
    """Rows whose labels are never learnt from; a null doc_id has no label and is not held out."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % folds == fold, F.lit(False))


def _sample(rows: DataFrame, n: int) -> np.ndarray:
    picked = rows.orderBy(F.xxhash64("doc_id"), "doc_id").limit(n).select("measures").toArrow()["measures"]
    flat = pa.concat_arrays([c.flatten() for c in picked.chunks]).to_numpy() if len(picked) else np.zeros(0, np.float32)
    return flat.reshape(-1, MEASURES)


def train(measured: DataFrame, labels: DataFrame) -> Network | None:
    """The scorer learnt from ``measured`` (doc_id, measures) and labels (doc_id, quality) outside the held-out fold."""
    good = labels.where((F.col("quality") == 1) & ~held_out()).select("doc_id").distinct()
    positive = _sample(measured.join(good, "doc_id", "left_semi"), POSITIVES)
    unlabelled = _sample(measured, UNLABELLED)
    if not len(positive) or not len(unlabelled):
        return None
    return fit(positive, unlabelled, class_prior(positive, unlabelled))


def _scored(net: Network | None):
    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            if len(batch):
                m = batch["measures"].flatten().to_numpy().reshape(-1, MEASURES)
                s = net.score(m) if net else np.full(len(batch), UNTRAINED)
                yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(s)], names=["doc_id", "score"])

    return run


def measured(docs: DataFrame) -> DataFrame:
    return stored(docs.select("doc_id", "text").mapInArrow(_measured, "doc_id bigint, measures array<float>"), "measures")


def scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row; null texts are empty texts."""
    table = measured(docs)
    found = table.mapInArrow(_scored(train(table, labels)), "doc_id bigint, score double")
    return found.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def _passing(net: Network | None, cut: float):
    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            if len(batch):
                s = net.score(measures(batch["text"])) if net else np.full(len(batch), UNTRAINED)
                yield batch.filter(pa.array(s >= cut))

    return run


def accepted(docs: DataFrame, labels: DataFrame, cut: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that score ``cut`` or more, in its columns. The text is measured again instead of shuffled."""
    net = train(measured(docs), labels)
    return docs.mapInArrow(_passing(net, cut), docs.schema)
