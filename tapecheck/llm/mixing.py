"""Mixing sources to target weights by iterative proportional fitting (raking).

Documents fall into cells of source x language x topic. The token counts of the cells are raked: the
cells' weights are scaled to the target share of each source, then of each language, then of each
topic, again and again, until all three marginals hold. A document is then kept with a probability
proportional to its cell's weight per token, drawn from a hash of its doc_id and text, so a repeated
run keeps the same documents.

Size: ``keep`` (a share of the tokens) or ``budget`` (tokens) states it. Without them the mix is as large
as the weights allow (the largest probability is 1), but at least ``KEEP`` of the tokens, so that a
category of a few documents cannot set the size of the whole. Shares that ``targets`` names are binding:
where they leave room for less than all tokens, it is at least ``KEEP`` of that room. Where a cell's probability would pass 1 it
stays at 1, and the weight it lacks goes to the other cells of its categories, raked anew until stable.
A category whose tokens fall short of its target is kept whole; the others of its dimension share what
is missing in proportion to their targets. ``Plan.missed`` lists the targets that are not reached.

Targets: a category that ``targets`` names gets its share; all others of that dimension together get
the rest, in the proportions they have. Cells are counted over all documents; their number is bounded
by the categories (see ``CATEGORIES``), so the fitting itself runs on the driver.

Topic: no column has it, so it is found without training. Each word has a fixed random sign
in each of ``TOPIC_BITS`` directions; a text's mean sign, above or below the mean of its language,
gives one bit each. Texts of similar vocabulary fall into the same topic.
"""

from __future__ import annotations

import warnings
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tapecheck.llm import batches
from tapecheck.llm.tables import stored

TOPIC_BITS = 3
DIMENSIONS = ("source", "lang", "topic")
#: Categories of a dimension that are weighed one by one: those of most tokens. The rest of the
#: dimension is one category together; no document is left out.
CATEGORIES = 2_000
REST = "(rest)"
NONE = "(none)"
ROUNDS, TOLERANCE = 200, 1e-9
#: Target shares are the shares of tokens to this power, scaled to one: the smaller, the more even.
EVENNESS = 0.5
#: Share of the tokens that is kept at least if no size is stated and no target is named.
KEEP = 0.5
#: A category's share that is off its target by more than this part of it is reported.
MISSED = 1e-6

U = np.uint64


def _measured(batch: pa.RecordBatch) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """For parts of a batch: first row, end row, words of each text, mean signs, and a number in [0, 1)."""
    texts = batches.texts_of(batch["text"])
    ids = batch["doc_id"].cast(pa.int64()).fill_null(-1).to_numpy().astype(np.uint64)
    for at, end, data, off in batches.chunks(texts):
        n = end - at
        h, row, *_ = batches.words(data, off)
        count = np.bincount(row, minlength=n)
        signs = [np.bincount(row, weights=((h >> U(40 + k)) & U(1)).astype(np.float64) * 2 - 1, minlength=n) for k in range(TOPIC_BITS)]
        whole = batches.span_hashes(batches.prefix_hashes(data), off[:-1], off[1:])
        draw = (batches.mix(batches.mix(ids[at:end]) ^ whole) >> U(11)).astype(np.float64) * 2.0**-53
        yield at, end, count.astype(np.int64), np.stack(signs, axis=1) / np.maximum(count, 1)[:, None], draw


FEATURES = "source string, lang string, n_tokens bigint, " + ", ".join(f"z{k} double" for k in range(TOPIC_BITS))


def _features(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in rows:
        names = [batch[c].cast(pa.string()).fill_null(NONE) for c in ("source", "lang")]
        for at, end, count, z, _ in _measured(batch):
            columns = [x.slice(at, end - at) for x in names] + [pa.array(count), *map(pa.array, z.T.copy())]
            yield pa.RecordBatch.from_arrays(columns, schema=pa.schema([*zip(("source", "lang"), [pa.string()] * 2), ("n_tokens", pa.int64()), *((f"z{k}", pa.float64()) for k in range(TOPIC_BITS))]))


@dataclass(frozen=True)
class Plan:
    """Keep probabilities by cell, and what is needed to find a document's cell."""

    means: dict[str, tuple[float, ...]]
    named: dict[str, frozenset[str]]
    probability: dict[tuple[str, str, str], float]
    #: (dimension, category, target share, share reached), the largest differences first.
    missed: tuple[tuple[str, str, float, float], ...] = ()

    def cells(self, source, lang, z: np.ndarray) -> list[tuple[str, str, str]]:
        out = []
        for s, g, v in zip(source, lang, z, strict=True):
            g = NONE if g is None else g
            t = sum(1 << k for k, x in enumerate(v) if x > self.means[g][k]) if g in self.means else 0
            s = NONE if s is None else s
            out.append((s if s in self.named["source"] else REST, g if g in self.named["lang"] else REST, str(t)))
        return out


def rake(tokens: np.ndarray, codes: list[np.ndarray], targets: list[np.ndarray]) -> np.ndarray:
    """Cell weights, summing to one, whose marginals are the targets.

    Categories without tokens cannot be weighed up; the targets of the others are scaled to one.
    Where the targets contradict each other (empty cells), the last sweep is returned.
    """
    weight = tokens / tokens.sum()
    for _ in range(ROUNDS):
        off = 0.0
        for code, target in zip(codes, targets, strict=True):
            have = np.bincount(code, weights=weight, minlength=len(target))
            want = np.where(have > 0, target, 0)
            factor = np.divide(want / want.sum(), have, out=np.ones(len(target)), where=have > 0)
            off = max(off, float(np.abs(factor[have > 0] - 1).max()))
            weight = weight * factor[code]
        if off < TOLERANCE:
            break
    return weight / weight.sum()


def scaled(tokens: np.ndarray, p: np.ndarray, code: np.ndarray, want: np.ndarray) -> np.ndarray:
    """``p`` times one factor for each category, so that the sum of tokens * min(p, 1) is ``want`` in each of them.

    A category whose tokens are fewer than that gets the factor that lifts all its cells to 1.
    """
    n = len(want)
    have, free = (np.bincount(code, weights=x, minlength=n) for x in (tokens, tokens * p))
    least = np.full(n, np.inf)
    np.minimum.at(least, code[p > 0], p[p > 0])
    whole = want >= have * (1 - 1e-12)
    # from below the root: each step finds more cells that are full, and the others share the rest
    factor = np.divide(want, free, out=np.ones(n), where=free > 0)
    factor = np.where(whole, np.where(np.isfinite(least), 1 / least, 1), factor)
    full = np.zeros(len(p), dtype=bool)
    while (more := (p * factor[code] > 1) & ~full & ~whole[code]).any():
        full |= more
        lacks = want - np.bincount(code, weights=tokens * full, minlength=n)
        free = np.bincount(code, weights=tokens * p * ~full, minlength=n)
        factor = np.where(whole | (free <= 0), factor, np.divide(np.maximum(lacks, 0), free, out=np.ones(n), where=free > 0))
    return np.clip(p * factor[code], 0, 1e100)


def saturated(tokens: np.ndarray, codes: list[np.ndarray], targets: list[np.ndarray], size: float) -> np.ndarray:
    """Keep probabilities of the cells, ``size`` tokens together, whose marginals are the targets as far as the tokens go."""
    size = min(size, tokens.sum())
    wants = []
    for code, target in zip(codes, targets, strict=True):
        have = np.bincount(code, weights=tokens, minlength=len(target))
        one = np.zeros(len(have), dtype=np.int64)
        share = np.divide(target, have, out=np.zeros(len(have)), where=have > 0)
        wants.append(have * np.minimum(scaled(have, share, one, np.array([size])), 1))
    p = np.full(len(tokens), size / tokens.sum())
    for _ in range(ROUNDS):
        before = np.minimum(p, 1)
        for code, want in zip(codes, wants, strict=True):
            p = scaled(tokens, p, code, want)
        if np.abs(np.minimum(p, 1) - before).max() < TOLERANCE:
            break
    return np.minimum(p, 1)


def plan(
    features: DataFrame,
    targets: dict[str, dict[str, float]] | None = None,
    evenness: float = EVENNESS,
    keep: float | None = None,
    budget: float | None = None,
) -> Plan:
    """The keep probabilities for the documents in ``features`` (source, lang, n_tokens, z0..).

    Without targets for a dimension its shares of tokens are evened out by ``evenness``.
    """
    targets = targets or {}
    named, means = {}, {}
    for d in DIMENSIONS[:2]:
        by = features.groupBy(d).agg(F.sum("n_tokens").alias("n"), *(F.avg(f"z{k}").alias(f"z{k}") for k in range(TOPIC_BITS)))
        top = by.orderBy(F.desc("n"), d).limit(CATEGORIES).collect()
        named[d] = frozenset(r[d] for r in top) | frozenset(targets.get(d, {}))
        if d == "lang":
            means = {r[d]: tuple(r[f"z{k}"] for k in range(TOPIC_BITS)) for r in top}
    near = {d: F.when(F.col(d).isin(*named[d]), F.col(d)).otherwise(F.lit(REST)) if named[d] else F.lit(REST) for d in named}
    mean = F.create_map(*[x for g, m in means.items() for x in (F.lit(g), F.array(*map(F.lit, m)))]) if means else None
    bits = [F.when(F.col(f"z{k}") > F.get(mean[F.col("lang")], k), 1 << k).otherwise(0) for k in range(TOPIC_BITS)] if means else [F.lit(0)]
    topic = sum(bits[1:], bits[0]).cast("string")
    cells = (
        features.select(near["source"].alias("source"), near["lang"].alias("lang"), topic.alias("topic"), "n_tokens")
        .groupBy(*DIMENSIONS)
        .agg(F.sum("n_tokens").alias("n"))
        .where("n > 0")
        .orderBy(*DIMENSIONS)
        .collect()
    )
    if not cells:
        return Plan(means, named, {})
    tokens = np.array([r.n for r in cells], dtype=np.float64)
    codes, wanted, names, room = [], [], [], 1.0
    for d in DIMENSIONS:
        values, code = np.unique([r[d] for r in cells], return_inverse=True)
        share = np.bincount(code, weights=tokens) / tokens.sum()
        if d in targets:
            set_ = np.array([targets[d].get(v, -1.0) for v in values])
            others = share[set_ < 0].sum()
            rest = max(0.0, 1.0 - set_[set_ >= 0].sum())
            target = np.where(set_ >= 0, set_, rest * share / others if others else 0.0)
            room = min([room, *(share[set_ > 0] / set_[set_ > 0])])
        else:
            target = share**evenness
        codes.append(code)
        wanted.append(target / target.sum())
        names.append(values)
    each = rake(tokens, codes, wanted) / tokens
    each = each / each.max()
    if keep is not None or budget is not None:
        each = saturated(tokens, codes, wanted, budget if budget is not None else keep * tokens.sum())
    elif (each * tokens).sum() < KEEP * room * tokens.sum():
        each = saturated(tokens, codes, wanted, KEEP * room * tokens.sum())
    missed = []
    for d, values, code, target in zip(DIMENSIONS, names, codes, wanted, strict=True):
        got = np.bincount(code, weights=each * tokens, minlength=len(target))
        got = got / max(got.sum(), 1e-300)
        missed += [(d, str(values[k]), float(target[k]), float(got[k])) for k in np.flatnonzero(np.abs(got - target) > MISSED * target)]
    missed.sort(key=lambda x: -abs(x[3] - x[2]))
    if missed:
        some = ", ".join(f"{d} {v}: {g:.3g} instead of {t:.3g}" for d, v, t, g in missed[:5])
        warnings.warn(f"{len(missed)} target shares of the mix are not reached: {some}", stacklevel=2)
    return Plan(means, named, {tuple(r[d] for d in DIMENSIONS): float(p) for r, p in zip(cells, each, strict=True)}, tuple(missed))


def _weighed(sent, passed: list[str]):
    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            made: Plan = sent.value
            source, lang = (batch[c].cast(pa.string()) for c in ("source", "lang"))
            for at, end, count, z, draw in _measured(batch):
                n = end - at
                cells = made.cells(source.slice(at, n).to_pylist(), lang.slice(at, n).to_pylist(), z)
                # a cell without any words has nothing to weigh: its texts stay
                p = np.array([made.probability.get(c, 1.0) for c in cells])
                out = [pa.array(count), pa.array([c[2] for c in cells], pa.string()), pa.array(p), pa.array(draw < p)]
                yield pa.RecordBatch.from_arrays(
                    [*(batch[c].slice(at, n) for c in passed), *out], names=[*passed, "n_tokens", "topic", "probability", "kept"]
                )

    return run


WEIGHED = "n_tokens bigint, topic string, probability double, kept boolean"


def mixed(
    docs: DataFrame,
    targets: dict[str, dict[str, float]] | None = None,
    evenness: float = EVENNESS,
    keep: float | None = None,
    budget: float | None = None,
) -> DataFrame:
    """``docs`` with n_tokens, topic, probability and kept in place of columns of those names; all rows.

    Null sources and languages are categories of their own. Texts without words weigh nothing and are
    drawn with their cell's probability. Rows that repeat a doc_id and a text are kept or left together.
    """
    new = StructType.fromDDL(WEIGHED)
    own = docs.select(*[docs[c] for c in docs.columns if c not in new.names])
    features = own.select("doc_id", "text", "source", "lang").mapInArrow(_features, FEATURES)
    made = plan(stored(features, "mix-features"), targets, evenness, keep, budget)
    sent = docs.sparkSession.sparkContext.broadcast(made)
    return own.mapInArrow(_weighed(sent, own.columns), StructType([*own.schema.fields, *new.fields]))
