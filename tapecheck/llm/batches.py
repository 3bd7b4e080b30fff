"""Whole texts as byte arrays: words, shingles and hashes of an Arrow batch without a Python object per word.

A batch is read in chunks of about ``CHUNK`` bytes, so the arrays below stay small whatever the
batch holds; a single longer text is a chunk of its own and is never cut.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK = 1 << 20

U = np.uint64
_BASE, _INVERSE = 0x9E3779B97F4A7C15, pow(0x9E3779B97F4A7C15, -1, 1 << 64)

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Bytes of words: digits, lower-case letters and every byte of a character beyond ASCII.
IN_WORD = np.zeros(256, dtype=bool)
IN_WORD[48:58] = IN_WORD[97:123] = IN_WORD[128:] = True


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser; a bijection, so it adds no collisions."""
    x = x ^ (x >> U(30))
    x *= U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


@cache
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    out = []
    for base in (_BASE, _INVERSE):
        p = np.full(n, base, dtype=np.uint64)
        p[0] = 1
        out.append(np.multiply.accumulate(p))
    return out[0], out[1]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    size = max(CHUNK + 1, 1 << int(n).bit_length())
    return _powers(size)


def texts_of(column: pa.Array | pa.ChunkedArray) -> pa.Array:
    """A string column as one array without nulls (a null text is empty)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    return pc.fill_null(column, "") if column.null_count else column


def chunks(texts: pa.Array, size: int = CHUNK) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of consecutive rows of about ``size`` bytes together."""
    n = len(texts)
    if not n:
        return
    bounds = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + n + 1]
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8) if raw is not None else np.zeros(0, dtype=np.uint8)
    at = 0
    while at < n:
        end = max(at + 1, int(np.searchsorted(bounds, bounds[at] + size, side="right")) - 1)
        end = min(end, n)
        yield at, end, data[bounds[at] : bounds[end]], bounds[at : end + 1] - bounds[at]
        at = end


def prefix_hashes(data: np.ndarray) -> np.ndarray:
    """Prefix sums of a polynomial over the bytes; see ``span_hashes``."""
    power, _ = powers(len(data))
    sums = np.empty(len(data) + 1, dtype=np.uint64)
    sums[0] = 0
    np.cumsum((data.astype(np.uint64) + U(1)) * power[: len(data)], out=sums[1:])
    return sums


def span_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes of each span; equal bytes hash alike wherever they stand."""
    _, inverse = powers(len(sums))
    return mix(((sums[ends] - sums[starts]) * inverse[starts]) ^ (ends - starts).astype(np.uint64))


def spans(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and row of each run of True that does not cross a row's end."""
    n = len(inside)
    if not n:
        none = np.zeros(0, dtype=np.int64)
        return none, none, none
    first = np.zeros(n + 1, dtype=bool)
    first[offsets] = True
    begin = inside.copy()
    begin[1:] &= ~inside[:-1] | first[1:n]
    end = inside.copy()
    end[:-1] &= ~inside[1:] | first[1:n]
    starts = np.flatnonzero(begin)
    return starts, np.flatnonzero(end) + 1, np.searchsorted(offsets, starts, side="right") - 1


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash, row, start and end of every word, letters A-Z lower-cased."""
    low = LOWER[data]
    starts, ends, row = spans(IN_WORD[low], offsets)
    return span_hashes(prefix_hashes(low), starts, ends), row, starts, ends


def shingles(hashes: np.ndarray, row: np.ndarray, rows: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and row of each run of ``n`` consecutive words; a row of fewer words has one shingle of all."""
    count = np.bincount(row, minlength=rows)
    first = np.concatenate(([0], np.cumsum(count)))
    width = np.minimum(count, n)
    total = np.maximum(count - n + 1, (count > 0).astype(np.int64))
    out_row = np.repeat(np.arange(rows), total)
    at = np.arange(len(out_row)) - np.repeat(np.concatenate(([0], np.cumsum(total)))[:-1], total) + first[out_row]
    h = np.zeros(len(out_row), dtype=np.uint64)
    wide = width[out_row]
    for j in range(n):
        here = wide > j
        if here.all():
            h = h * U(_BASE) + hashes[at + j]
        else:
            h[here] = h[here] * U(_BASE) + hashes[at[here] + j]
    return mix(h), out_row


def occurrences(hashes: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The pairs (row, hash) in order, and how often each occurs."""
    order = np.lexsort((hashes, row))
    h, r = hashes[order], row[order]
    if not len(h):
        return h, r, np.zeros(0, dtype=np.int64)
    new = np.flatnonzero(np.concatenate(([True], (h[1:] != h[:-1]) | (r[1:] != r[:-1]))))
    return h[new], r[new], np.diff(np.append(new, len(h)))


def overlap(a: tuple[np.ndarray, ...], b: tuple[np.ndarray, ...], rows: int) -> np.ndarray:
    """Weighted Jaccard similarity of each row of two multisets given as (hash, row, count)."""
    h, r, c = (np.concatenate(x) for x in zip(a, b, strict=True))
    order = np.lexsort((h, r))
    h, r, c = h[order], r[order], c[order]
    same = np.flatnonzero((h[1:] == h[:-1]) & (r[1:] == r[:-1])) if len(h) else np.zeros(0, dtype=np.int64)
    both = np.bincount(r[same], weights=np.minimum(c[same], c[same + 1]), minlength=rows)
    union = np.bincount(r, weights=c, minlength=rows) - both
    return np.divide(both, union, out=np.zeros(rows), where=union > 0)


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)
