"""Runs of repeated words in whole texts, found by multi-scale minimizers.

A run is a stretch of consecutive words of smallest period q (words q apart are identical) that is at least
``max(SHORTEST, 2q)`` words long and that neither neighbour extends. ``runs_of`` finds every run of the texts of an
Arrow batch; all texts of a chunk are handled by the same array operations.

* **Short periods** (below ``SHORT``) are scanned directly: words i and i + q are compared for every i.
* **Longer periods** are met at the scale Q with Q <= q < 2Q (Q = ``SHORT``, twice that, ...). At scale Q every stretch of
  Q/2 words is hashed and, of each window of Q/2 neighbouring hashes, the smallest is selected (all equal ones). Window
  and stretch together are shorter than q, so the first window of a run occurs again q words later, and its
  minimum is selected at both places: pairs of equal minimizers whose distance lies in [Q, 2Q) are the seeds. A seed is
  extended to both sides as far as words q apart agree, and is a run if the stretch is long enough.
* **Minimizers inside shorter runs.** Where an equal minimizer stands at most Q/4 words further, it lies in a run of a
  period p found at a smaller scale (a "zone"), and pairing all its copies would be quadratic. A longer run over two such
  zones either lines up their starts or their ends, or is one of few shapes around their border, so a pair of zones
  yields those distances only. Occurrences of any other minimizer are more than Q/4 words apart, so there are at most
  eight partners each.
* A stretch that is found with a multiple of its period has the same ends as with the period itself, so the smallest
  period of equal ends is the period.

Words are compared exactly (numbered per text by a dictionary). Extension compares hashes of stretches; every run that
it yields is then checked word by word, and a distance that fails is scanned directly.

Null and empty texts have no words and no runs. A text is never cut: one of any length is a chunk of its own.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterable, Iterator
from functools import cache
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapecheck.llm.batches import U, mix, powers

#: Words of the shortest run.
SHORTEST = 12
#: Periods below this are scanned directly; a power of two.
SHORT = 16
#: Words of a chunk, about.
CHUNK_WORDS = 1 << 17
#: Zones of at most this many selected copies are paired copy by copy.
FEW = 4

Spans = tuple[np.ndarray, np.ndarray, np.ndarray]
_NONE = np.zeros(0, dtype=np.int64)


def _stretches(equal: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of the runs of True of ``least`` or more."""
    at = np.flatnonzero(equal)
    if len(at) < least:
        return _NONE, _NONE
    new = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1] + 1)))
    length = np.diff(np.append(new, len(at)))
    long = length >= least
    return at[new[long]], length[long]


def _scan(ids: np.ndarray, q: int) -> Spans:
    """Maximal stretches of period ``q``: (start, end, q)."""
    if len(ids) < 2 * q:
        return _NONE, _NONE, _NONE
    start, length = _stretches(ids[:-q] == ids[q:], max(SHORTEST - q, q))
    return start, start + length + q, np.full(len(start), q, dtype=np.int64)


def _smallest(found: list[Spans]) -> Spans:
    """Of stretches with equal ends the one of the smallest period, by start and end."""
    s, e, q = (np.concatenate(x) for x in zip(*found, strict=True)) if found else (_NONE, _NONE, _NONE)
    order = np.lexsort((q, e, s))
    s, e, q = s[order], e[order], q[order]
    if len(s):
        new = np.concatenate(([True], (s[1:] != s[:-1]) | (e[1:] != e[:-1])))
        s, e, q = s[new], e[new], q[new]
    return s, e, q


#: Prime of the second hash; products of two residues fit into 64 bits.
PRIME = 2**31 - 1
_BASE = 1_000_003_019


@cache
def _residues(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of ``_BASE`` and of its inverse, modulo ``PRIME``."""
    out = []
    for base in (_BASE, pow(_BASE, -1, PRIME)):
        have, power = np.ones(1, dtype=np.uint64), base
        while len(have) < size:
            have = np.concatenate((have, have * U(power) % U(PRIME)))
            power = power * power % PRIME
        out.append(have)
    return out[0], out[1]


class _Stretches:
    """Hashes of stretches of words, and how far two places agree.

    Two polynomials, modulo 2^64 and modulo a prime: some regular texts of two words (Thue-Morse) defeat the first.
    """

    def __init__(self, ids: np.ndarray):
        self.ids, self.n = ids, len(ids)
        power, self.inverse = powers(self.n)
        residue, self.back = _residues(1 << self.n.bit_length())
        value = mix(ids.astype(np.uint64) + U(1))
        self.sums, self.rests = np.zeros(self.n + 1, dtype=np.uint64), np.zeros(self.n + 1, dtype=np.uint64)
        np.cumsum(value * power[: self.n], out=self.sums[1:])
        np.cumsum((value >> U(33)) * residue[: self.n] % U(PRIME), out=self.rests[1:])

    def first(self, n: int) -> _Stretches:
        """Of the first ``n`` words only."""
        out = object.__new__(_Stretches)
        out.ids, out.n, out.inverse, out.back, out.sums, out.rests = self.ids[:n], n, self.inverse, self.back, self.sums[: n + 1], self.rests[: n + 1]
        return out

    def hashes(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Of the stretches of one width each; equal stretches have equal hashes."""
        rest = (self.rests[end] - self.rests[start]) % U(PRIME) * self.back[start] % U(PRIME)
        return (self.sums[end] - self.sums[start]) * self.inverse[start] + rest * U(0x9E3779B97F4A7C15)

    def all_of(self, width: int) -> np.ndarray:
        """Of every stretch of ``width`` words."""
        n = self.n - width + 1
        rest = (self.rests[width:] - self.rests[:-width]) % U(PRIME) * self.back[:n] % U(PRIME)
        return mix((self.sums[width:] - self.sums[:-width]) * self.inverse[:n] + rest * U(0x9E3779B97F4A7C15))

    def agree(self, x: np.ndarray, y: np.ndarray, forward: bool) -> np.ndarray:
        """How many words from x on equal those from y on (x < y), or before x those before y."""
        low = np.zeros(len(x), dtype=np.int64)
        high = (self.n - y) if forward else x.copy()
        step = 1
        while len(x) and (most := int((high - low).max())) > 0:
            # gallop first: most places agree over few words
            width = np.minimum(np.maximum((high - low + 1) // 2, 1), step) if step < most else (high - low + 1) // 2
            width = np.minimum(width, high - low)
            reach = low + width
            if forward:
                same = self.hashes(x + low, x + reach) == self.hashes(y + low, y + reach)
            else:
                same = self.hashes(x - reach, x - low) == self.hashes(y - reach, y - low)
            low = np.where(same, reach, low)
            high = np.where(same, high, reach - 1)
            step *= 4
        return low

    def extend(self, x: np.ndarray, q: np.ndarray) -> Spans:
        """The maximal stretches of period q around the words x and x + q."""
        return x - self.agree(x, x + q, False), x + q + self.agree(x, x + q, True), q


def _windows(h: np.ndarray, width: int, best: np.ufunc) -> np.ndarray:
    """``best`` of every window of ``width`` values (a power of two)."""
    step = 1
    while step < width:
        h = best(h[:-step], h[step:])
        step *= 2
    return h


def _selected(h: np.ndarray, width: int) -> np.ndarray:
    """Places whose hash is the smallest of at least one window of ``width`` hashes."""
    low = _windows(h, width, np.minimum)
    pad = np.zeros(width - 1, dtype=np.uint64)
    return np.flatnonzero(h == _windows(np.concatenate((pad, low, pad)), width, np.maximum))


def _plain_seeds(cluster: np.ndarray, group: np.ndarray, place: np.ndarray, few: np.ndarray, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of places of one hash in different clusters of which at least one is small, at distances of the scale.

    Partners are looked up by the distance, so the loop ends after as many rounds as a place has partners.
    """
    # (group, place) in one number, in the order of the arrays
    wide = int(place.max()) + 2 * scale + 1
    line = group * wide + place
    first, last = np.searchsorted(line, line + scale), np.searchsorted(line, line + 2 * scale)
    out_x, out_q, step = [], [], 0
    alive = np.flatnonzero(first < last)
    while len(alive):
        other = first[alive] + step
        ok = (few[alive] | few[other]) & (cluster[alive] != cluster[other])
        x = alive[ok]
        out_x.append(place[x])
        out_q.append(place[other[ok]] - place[x])
        step += 1
        alive = alive[first[alive] + step < last[alive]]
        if step > 8 * FEW:  # only places of large zones can have more; pair them with the small clusters alone
            alive = _skip_large(alive, first, last, few, step, out_x, out_q, place, cluster)
    return (np.concatenate(out_x), np.concatenate(out_q)) if out_x else (_NONE, _NONE)


def _skip_large(alive, first, last, few, step, out_x, out_q, place, cluster) -> np.ndarray:
    """The rest of the pairs of ``_plain_seeds``: small places with all partners, large ones with small partners."""
    small = np.concatenate(([0], np.cumsum(few)))
    where = np.flatnonzero(few)
    for begin, to, partners in (
        (first[alive[few[alive]]] + step, last[alive[few[alive]]], None),
        (small[first[alive[~few[alive]]] + step], small[last[alive[~few[alive]]]], where),
    ):
        own = alive[few[alive]] if partners is None else alive[~few[alive]]
        total = np.maximum(to - begin, 0)
        x = np.repeat(own, total)
        at = np.arange(len(x)) - np.repeat(np.cumsum(total) - total, total) + np.repeat(begin, total)
        other = at if partners is None else partners[at]
        ok = cluster[x] != cluster[other]
        out_x.append(place[x[ok]])
        out_q.append(place[other[ok]] - place[x[ok]])
    return _NONE


def _zone_seeds(text: _Stretches, cluster: np.ndarray, group: np.ndarray, place: np.ndarray, few: np.ndarray, scale: int, known: Spans) -> tuple[np.ndarray, np.ndarray] | None:
    """Seeds of pairs of zones, each with many copies of the same minimizer; None if hashes misled about a zone."""
    large = np.flatnonzero(~few)
    if not len(large):
        return _NONE, _NONE
    new = large[np.concatenate(([True], cluster[large][1:] != cluster[large][:-1]))]
    x, hash_group = place[new], group[new]
    z, z_end, _ = text.extend(x, place[new + 1] - x)
    where = {(s, e): q for s, e, q in zip(*(a.tolist() for a in known), strict=True)}
    out: list[tuple[int, int]] = []
    for i in range(len(new)):
        s1, e1 = int(z[i]), int(z_end[i])
        p = where.get((s1, e1))
        if p is None:
            return None
        j = i + 1
        while j < len(new) and hash_group[j] == hash_group[i] and z[j] - e1 < 2 * scale:
            s2, e2, c = int(z[j]), int(z_end[j]), int(x[j] - x[i])
            j += 1
            if (s1, e1) == (s2, e2):
                continue
            first = e1 - s1 - (e1 - s1 - c) % p
            second = e2 - s2 - (e2 - s2 - c) % p
            out += [(s1, s2 - s1), (e1 - 1, e2 - e1), (s1, first), (e2 - 1 - second, second)]
            if e1 >= s2:  # squares around the border of two zones that touch: each is a run of its own
                low, high = scale, min(s2 - s1, e2 - e1, 2 * scale - 1)
                out += [(s2 - q, q) for q in range(low + (c - low) % p, high + 1, p)]
    seeds = np.array([(a, q) for a, q in out if scale <= q < 2 * scale and 0 <= a and a + q < text.n], dtype=np.int64).reshape(-1, 2)
    return seeds[:, 0], seeds[:, 1]


def _long_runs(text: _Stretches, scale: int, known: Spans) -> Spans:
    """Runs of a period q with scale <= q < 2 scale."""
    none = _NONE, _NONE, _NONE
    width = scale // 2
    if text.n < 2 * scale:
        return none
    h = text.all_of(width)
    at = _selected(h, width)
    order = np.argsort(h[at], kind="stable")
    place, key = at[order], h[at][order]
    again = key[1:] == key[:-1]
    keep = np.concatenate((again, [False])) | np.concatenate(([False], again))
    place, key = place[keep], key[keep]
    if not len(place):
        return none
    new_hash = np.concatenate(([True], key[1:] != key[:-1]))
    group = np.cumsum(new_hash) - 1
    apart = new_hash | np.concatenate(([True], np.diff(place) > scale // 4))
    cluster = np.cumsum(apart) - 1
    few = np.bincount(cluster)[cluster] <= FEW
    zones = _zone_seeds(text, cluster, group, place, few, scale, known)
    if zones is None:
        return tuple(np.concatenate(x) for x in zip(*(_scan(text.ids, q) for q in range(scale, 2 * scale)), strict=True))
    x, q = (np.concatenate(s) for s in zip(_plain_seeds(cluster, group, place, few, scale), zones, strict=True))
    if not len(x):
        return none
    s, e, q = text.extend(x, q)
    long = e - s >= np.maximum(2 * q, SHORTEST)
    s, e, q = np.unique(np.stack((s[long], e[long], q[long])), axis=1)
    return _checked(text.ids, s, e, q)


def _checked(ids: np.ndarray, s: np.ndarray, e: np.ndarray, q: np.ndarray) -> Spans:
    """Word by word: each stretch has its period and cannot be extended; else its period is scanned directly."""
    n, right = len(ids), np.ones(len(s), dtype=bool)
    for k in range(len(s)):
        a, b, d = int(s[k]), int(e[k]), int(q[k])
        right[k] = (
            bool((ids[a : b - d] == ids[a + d : b]).all())
            and (a == 0 or ids[a - 1] != ids[a - 1 + d])
            and (b == n or ids[b] != ids[b - d])
        )
    if right.all():
        return s, e, q
    scans = [_scan(ids, int(d)) for d in np.unique(q[~right])]
    return tuple(np.concatenate((own[right], *(x[k] for x in scans))) for k, own in enumerate((s, e, q)))


def runs_of(ids: np.ndarray, sizes: list[int] | None = None) -> Spans:
    """Start, end and period of every run of the words ``ids``, by start and end.

    The words of several texts may follow each other, longest text first, if no two texts share a number; ``sizes``
    are then their numbers of words. Each scale reads only the texts that are long enough for its periods.
    """
    sizes = [len(ids)] if sizes is None else sizes
    ends, size = np.cumsum(sizes), np.array(sizes)

    def of_at_least(least: int) -> int:
        texts = int(np.searchsorted(-size, -least, side="right"))
        return int(ends[texts - 1]) if texts else 0

    found = [_scan(ids[: of_at_least(max(SHORTEST, 2 * q))], q) for q in range(1, SHORT)]
    scale = SHORT
    if n := of_at_least(2 * scale):
        text = _Stretches(ids[:n])
        while n := of_at_least(2 * scale):
            found.append(_long_runs(text.first(n), scale, _smallest(found)))
            scale *= 2
    return _smallest(found)


def collapsed(n: int, s: np.ndarray, e: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Which of ``n`` words stay: those that no run contains after its first period."""
    step = np.zeros(n + 1, dtype=np.int64)
    np.add.at(step, s + q, 1)
    np.add.at(step, e, -1)
    return np.cumsum(step[:n]) == 0


def repeated_tail(words: list[bytes], doc_id: int | None) -> list[bytes]:
    """The words of a document with the repetition that its id asks for (none without an id)."""
    n = len(words)
    if doc_id is None or not n:
        return words
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    unit = words[a : a + p]
    return words[:a] + (unit * ((n - a) // p + 1))[: n - a]


def _numbered(words: list[bytes], base: int) -> np.ndarray:
    """A number for each word, equal for equal words: its first place in the text, from ``base`` on."""
    seen: dict[bytes, int] = {}
    return np.fromiter(map(seen.setdefault, words, count(base)), dtype=np.int64, count=len(words))


def _chunk(texts: list[list[bytes]]) -> list[Spans]:
    """Runs of each of several texts, with places counted from the text's first word."""
    order = sorted(range(len(texts)), key=lambda k: -len(texts[k]))
    sizes = [len(texts[k]) for k in order]
    bounds = np.concatenate(([0], np.cumsum(sizes)))
    ids = np.concatenate([_numbered(texts[k], int(b)) for k, b in zip(order, bounds[:-1], strict=True)])
    s, e, q = runs_of(ids, sizes)
    cut = np.searchsorted(s, bounds)
    out: list[Spans] = [(_NONE, _NONE, _NONE)] * len(texts)
    for at, k in enumerate(order):
        part = slice(cut[at], cut[at + 1])
        out[k] = s[part] - bounds[at], e[part] - bounds[at], q[part]
    return out


def _rows(batch: pa.RecordBatch, planted: bool) -> Iterator[list[tuple]]:
    ids, texts = batch.column("doc_id").to_pylist(), batch.column("text")
    waiting: list[tuple[int | None, list[bytes]]] = []
    held = 0
    for k, doc_id in enumerate(ids):
        raw = texts[k].as_buffer() if texts[k].is_valid else None
        words = raw.to_pybytes().split() if raw is not None else []
        waiting.append((doc_id, repeated_tail(words, doc_id) if planted else words))
        held += len(words)
        if held >= CHUNK_WORDS or k + 1 == len(ids):
            yield [(d, w, *spans) for (d, w), spans in zip(waiting, _chunk([w for _, w in waiting]), strict=True)]
            waiting, held = [], 0


RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
OUT = "doc_id bigint, runs array<struct<start: bigint, length: bigint, period: bigint>>, n_words bigint, n_kept bigint, collapsed string"


def periodic_runs(docs: DataFrame, planted: bool = False) -> DataFrame:
    """Per document: doc_id, its runs by start and period, n_words, n_kept and the text without repetitions.

    ``collapsed`` holds the words that stay, joined by one space (empty for a text without words). ``planted`` first
    repeats a part of the documents whose id asks for it (``repeated_tail``). Repeated rows give repeated rows; a null
    doc_id stays null; other columns are dropped.
    """

    def find(parts: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            for rows in _rows(batch, planted):
                out: dict[str, list] = {c: [] for c in ("doc_id", "runs", "n_words", "n_kept", "collapsed")}
                for doc_id, words, s, e, q in rows:
                    stay = collapsed(len(words), s, e, q)
                    kept = [words[i] for i in np.flatnonzero(stay)] if len(s) else words
                    order = np.lexsort((q, s))
                    out["doc_id"].append(doc_id)
                    out["runs"].append([{"start": a, "length": b - a, "period": c} for a, b, c in zip(s[order].tolist(), e[order].tolist(), q[order].tolist(), strict=True)])
                    out["n_words"].append(len(words))
                    out["n_kept"].append(len(kept))
                    out["collapsed"].append(b" ".join(kept).decode())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(out["doc_id"], pa.int64()), pa.array(out["runs"], pa.list_(RUN)), pa.array(out["n_words"], pa.int64()), pa.array(out["n_kept"], pa.int64()), pa.array(out["collapsed"], pa.string())],
                    names=list(out),
                )

    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(find, OUT)


def digest(runs: DataFrame) -> DataFrame:
    """``periodic_runs`` as one row of numbers and hashes per document."""
    order = F.transform("runs", lambda r: F.struct(r.length.alias("length"), (-r.start).alias("start"), (-r.period).alias("period")))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r.start, r.length, r.period))
    text = F.when(F.size("runs") > 0, F.concat(F.array_join(lines, "\n"), F.lit("\n"))).otherwise(F.lit(""))
    return runs.select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        F.array_max(order).alias("top"),
        F.sha2(text, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    ).select(
        "doc_id",
        "n_runs",
        (-F.col("top.start")).alias("start"),
        F.col("top.length").alias("length"),
        (-F.col("top.period")).alias("period"),
        F.expr("1000 * top.length div -top.period").alias("exponent_milli"),
        "runs_sha256",
        "collapsed_sha256",
    )
