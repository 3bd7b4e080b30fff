"""Fuzzy line deduplication: of all lines that are alike, across all documents, one stays.

Lines are compared in lower case with white space runs as one space, by the sets of their
``SHINGLE`` consecutive characters. MinHash signatures (one hash a shingle, dealt over bins; an empty
bin borrows from another one) propose pairs in bands, the exact Jaccard similarity of the two sets
decides, and union-find over the links names one component for all lines that hang together. Of a
component the line of the smallest (doc_id, position) stays.

Only lines of ``MIN_WORDS`` words or more take part; shorter ones ("}", "Yes.") recur without being
copies (``min_words=1`` lets every line take part). In scripts without spaces each character counts as a word. A null text counts as empty and stays null. Blank lines stay. A text all of whose lines
go is empty; ``drop_emptied`` drops such documents (documents that came empty always stay). Rows with
the same doc_id and text are one document that appears several times: they lose the same lines.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapecheck.llm import batches, sketches
from tapecheck.llm.tables import Sieve, keyed, stored

MIN_WORDS = 5
THRESHOLD = 0.8
#: Characters of a shingle. One changed character touches five shingles, so lines of 49 characters can still be alike.
SHINGLE = 5
#: Rows of a band and bands. Two lines of similarity 0.8 share a band with probability 0.992; two lines of one language that have
#: nothing else in common (0.12) with probability 0.00005.
ROWS, BANDS = 6, 16
#: Characters that are written without spaces between words: Thai to Lao, Burmese, Khmer, Chinese and Japanese.
SPACELESS = r"[\x{0E00}-\x{0EFF}\x{1000}-\x{109F}\x{1780}-\x{17FF}\x{2E80}-\x{9FFF}\x{F900}-\x{FAFF}\x{20000}-\x{3FFFF}]"

#: Bytes whose shingles are made together, so that their arrays stay in a processor's cache; a longer line is a piece of its own.
PIECE = 1 << 16

U = np.uint64


def normalised(lines: pa.Array) -> pa.Array:
    """Lower case; each run of white space is one space, none at the ends."""
    lines = pc.utf8_trim_whitespace(pc.utf8_lower(lines))
    ragged = pc.match_substring_regex(lines, r"  |[\t\x0b\x0c\r]")
    if pc.any(ragged).as_py():
        lines = pc.if_else(ragged, pc.replace_substring_regex(lines, r"[ \t\x0b\x0c\r]+", " "), lines)
    return lines


def _shingles(data: np.ndarray, off: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, row) of every run of ``width`` characters of each row; a shorter row is one run.

    The characters' codes stand next to each other, so the hashes of all places are sums of shifted arrays; places whose run would
    cross a row's end are dropped.
    """
    if not len(data):
        return np.zeros(0, U), np.zeros(0, np.int64)
    wide = int(data.max()) >= 0x80
    code = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), dtype=np.uint32) if wide else data
    code = code.astype(np.uint64)
    at = np.searchsorted(np.append(np.flatnonzero((data & 0xC0) != 0x80), len(data)), off) if wide else np.asarray(off)
    length = np.diff(at)
    row = np.repeat(np.arange(len(length)), np.maximum(length - width + 1, 0))
    places = len(code) - width + 1
    h = np.zeros(max(places, 0), dtype=np.uint64)
    for k in range(width if places > 0 else 0):
        h *= U(0x9E3779B97F4A7C15)
        h += code[k : k + places]
    inside = np.ones(len(code) + width - 1, dtype=bool)
    for k in range(width - 1):  # the last places of each row; those before the first one are not places
        inside[at[1:] + k] = False
    h = batches.mix(h[inside[width - 1 : width - 1 + len(h)]])
    if (short := np.flatnonzero((length > 0) & (length < width))).size:
        sums = batches.prefix_hashes(data)
        h = np.concatenate((h, batches.span_hashes(sums, off[short], off[short + 1])))
        row = np.concatenate((row, short))
        order = np.argsort(row, kind="stable")
        h, row = h[order], row[order]
    return h, row


def shingle_hashes(texts: pa.Array, width: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """(hash, row) of every shingle of each normalised line."""
    texts, found = batches.texts_of(texts), []
    for at, _, data, off in batches.chunks(texts, PIECE):
        h, row = _shingles(data, off, width)
        found.append((h, row + at))
    if not found:
        return np.zeros(0, U), np.zeros(0, np.int64)
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def shingle_sets(texts: pa.Array, width: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, row, 1) of the distinct shingles of each normalised line."""
    h, r, _ = batches.occurrences(*shingle_hashes(texts, width))
    return h, r, np.ones(len(h), dtype=np.int64)


def signatures(data: np.ndarray, off: np.ndarray, bins: int, width: int = SHINGLE) -> np.ndarray:
    """A value for each (line, bin): the smallest hash among the line's shingles of that bin."""
    rows, at = len(off) - 1, 0
    none = ~U(0)
    out = np.full(rows * bins, none, dtype=np.uint64)
    while at < rows:
        end = max(at + 1, int(np.searchsorted(off, off[at] + PIECE, side="right")) - 1)
        h, row = _shingles(data[off[at] : off[end]], off[at : end + 1] - off[at], width)
        # the upper bits choose the bin, the lower ones are the value
        np.minimum.at(out, (row + at) * bins + (((h >> U(40)) * U(bins)) >> U(24)).astype(np.int64), h & U((1 << 40) - 1))
        at = end
    out = out.reshape(rows, bins)
    filled = out != none
    todo_row, todo_bin = np.nonzero(~filled & filled.any(axis=1)[:, None])
    attempt = 0
    while len(todo_row):
        attempt += 1
        to = (batches.mix(todo_bin.astype(np.uint64) * U(1 << 20) + U(attempt)) % U(bins)).astype(np.int64)
        hit = filled[todo_row, to]
        out[todo_row[hit], todo_bin[hit]] = out[todo_row[hit], to[hit]]
        todo_row, todo_bin = todo_row[~hit], todo_bin[~hit]
    return out


def _lines(texts: pa.Array, min_words: int) -> Iterator[tuple[np.ndarray, ...]]:
    """For parts of a batch: row, position, hash, bytes and offsets of the lines that take part."""
    for at, end, _, _ in batches.chunks(texts):
        parts = pc.split_pattern(texts[at:end], "\n")
        flat = normalised(parts.flatten())
        first = parts.offsets.to_numpy()
        first = first - first[0]
        row = np.repeat(np.arange(at, end), np.diff(first))
        position = np.arange(len(row)) - first[row - at]
        count = pc.count_substring(flat, " ").to_numpy(zero_copy_only=False) + 1
        wide = (count < min_words) & (pc.binary_length(flat).to_numpy(zero_copy_only=False) > pc.utf8_length(flat).to_numpy(zero_copy_only=False))
        if wide.any():
            some = np.flatnonzero(wide)
            count[some] += pc.count_substring_regex(flat.take(pa.array(some)), SPACELESS).to_numpy(zero_copy_only=False)
        keep = np.flatnonzero(count >= min_words)
        for low, high, data, off in batches.chunks(flat.take(pa.array(keep))):
            sums = batches.prefix_hashes(data)
            took = keep[low:high]
            yield row[took], position[took], batches.span_hashes(sums, off[:-1], off[1:]), data, off


def _scanned(min_words: int):
    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            k1, k2 = (batch[k].to_numpy() for k in ("k1", "k2"))
            for row, position, node, data, off in _lines(batches.texts_of(batch["text"]), min_words):
                # a line that stands twice in this part has its bands once
                first = np.zeros(len(node), dtype=bool)
                first[np.unique(node, return_index=True)[1]] = True
                sig = signatures(data, off, ROWS * BANDS)[first]
                bands = np.empty((len(sig), BANDS), dtype=np.uint64)
                for b in range(BANDS):
                    band = np.full(len(sig), b + 1, dtype=np.uint64)
                    for k in range(b * ROWS, (b + 1) * ROWS):
                        band = batches.mix(band * U(0x9E3779B97F4A7C15) + sig[:, k])
                    bands[:, b] = band
                ends = np.concatenate(([0], np.cumsum(first * BANDS))).astype(np.int32)
                # the sketch of a line that stands here first, null elsewhere
                which = np.where(first, np.cumsum(first) - 1, 0)
                sketch = sketches.sketch(sig).take(pa.array(which, mask=~first))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(k1[row]),
                        pa.array(k2[row]),
                        pa.array(position.astype(np.int32)),
                        pa.array(batches.signed(node)),
                        pa.ListArray.from_arrays(pa.array(ends), pa.array(batches.signed(bands.ravel()))),
                        sketch,
                    ],
                    names=["k1", "k2", "position", "node", "bands", "sketch"],
                )

    return run


def _texts(min_words: int, sieve: Sieve):
    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            for _, _, node, data, off in _lines(batches.texts_of(batch["text"]), min_words):
                buffers = [None, pa.py_buffer(np.ascontiguousarray(off)), pa.py_buffer(np.ascontiguousarray(data))]
                lines = pa.Array.from_buffers(pa.large_string(), len(node), buffers)
                node, first = np.unique(node, return_index=True)
                found = sieve.passes(node)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(batches.signed(node[found])), lines.take(pa.array(first[found])).cast(pa.string())], names=["node", "text"]
                )

    return run


def removed_lines(docs: DataFrame, threshold: float = THRESHOLD, min_words: int = MIN_WORDS) -> DataFrame:
    """(k1, k2, gone): the positions of the lines that go from a document; ``docs`` has k1, k2 and text."""
    scanned = docs.select("k1", "k2", "text").mapInArrow(
        _scanned(min_words), "k1 bigint, k2 bigint, position int, node bigint, bands array<bigint>, sketch binary"
    )
    scanned = stored(scanned, "lines", compression="none")  # hashes do not compress

    def texts_of(nodes: DataFrame) -> DataFrame:
        lines = docs.select("text").mapInArrow(_texts(min_words, Sieve(nodes, "node")), "node bigint, text string")
        return lines.join(nodes, "node", "left_semi").dropDuplicates(["node"])

    names = sketches.link(scanned.select("node", "bands", "sketch"), texts_of, shingle_hashes, shingle_sets, threshold)

    # One row for each different line, then one for each component: its first place and how many.
    seen = scanned.groupBy("node").agg(F.min(F.struct("k1", "k2", "position")).alias("place"), F.count("*").alias("places"))
    seen = seen.join(names, "node", "left").where("places > 1 or component is not null")
    seen = stored(seen.select("node", F.coalesce("component", "node").alias("component"), "place", "places"), "seen")
    first = seen.groupBy("component").agg(F.min("place").alias("place"))
    stays = seen.select("node", "component").join(first, "component").select("node", F.col("place").alias("stays"))
    return (
        scanned.select("k1", "k2", "position", "node")
        .join(stays, "node")
        .where(F.struct("k1", "k2", "position") != F.col("stays"))
        .groupBy("k1", "k2")
        .agg(F.collect_set("position").alias("gone"))
    )


def line_dedup(docs: DataFrame, threshold: float = THRESHOLD, min_words: int = MIN_WORDS, drop_emptied: bool = False) -> DataFrame:
    """``docs`` (doc_id, text and any other columns) without the lines that repeat, with n_lines and n_removed."""
    own = keyed(docs)
    gone = removed_lines(own, threshold, min_words)

    def left(lines: Column) -> Column:
        kept = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("gone"))
        return F.array_join(F.transform(kept, lambda i: F.get(lines, i)), "\n")

    # the array of lines is bound once; named inside the lambda it would be split anew for each line
    text = F.get(F.transform(F.array(F.split("text", "\n", -1)), left), 0)
    breaks = F.octet_length("text") - F.octet_length(F.replace("text", F.lit("\n"), F.lit("")))
    out = own.join(gone, ["k1", "k2"], "left").select(
        *[F.col("row")[c].alias(c) for c in docs.columns if c not in ("text", "n_lines", "n_removed")],
        F.when(F.col("gone").isNull(), F.col("text")).otherwise(text).alias("text"),
        F.when(F.coalesce("text", F.lit("")) == "", 0).otherwise(breaks + 1).cast("bigint").alias("n_lines"),
        F.coalesce(F.size("gone"), F.lit(0)).cast("bigint").alias("n_removed"),
    )
    if drop_emptied:
        out = out.where((F.col("n_removed") == 0) | (F.trim("text") != ""))
    return out
