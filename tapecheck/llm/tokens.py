"""Token counts of whole texts with a public tokenizer: a two-tier lookup on the map side.

A tokenizer never merges across the ends of a pre-token, so a text's count is the sum of its
pre-tokens' counts. Tier one is a hash table of the most frequent pre-tokens of the corpus and their
numbers of tokens, at most ``FREQUENT`` entries, sent to every executor. Tier two is a cache in each
worker, at most ``CACHE`` entries, filled by encoding what tier one lacks. No pre-token is
ever shuffled: to find the frequent ones each task counts its own and hands on its ``PER_TASK``
most frequent. The table decides how fast a count is found, never what it is.

Texts of Latin letters, digits, punctuation and plain white space are split here as the tokenizer splits
them. Any other text (other scripts, control characters, or the start of a special token's string) is
cut at plain white space, which no pre-token spans, and each piece is encoded by the
tokenizer itself, with the same cache. Long texts are taken in pieces cut at white space.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapecheck.llm import batches

LIMIT = 2048
FREQUENT, PER_TASK = 65_536, 4_096
#: Entries of a worker's cache; when it is full it starts anew.
CACHE = 1_000_000
#: Entries of a task's counts; when there are more, the upper half stays.
COUNTED = 400_000
#: Characters of a text taken at once.
PIECE = 1 << 20

# The splitting pattern of the tokenizer, with the letters and digits below U+0180 (whose
# lower case is below U+0180 as well, but for U+0130).
_LETTER, _DIGIT = r"a-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-ſ", r"0-9\xb2\xb3\xb9\xbc-\xbe"
_PRE = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTER}]+|[{_DIGIT}]|[^\s{_LETTER}{_DIGIT}]+")
_FOREIGN = re.compile(r"[^\t\n\r\x20-\x7e\xa1-įı-ſ]")
_PLAIN_WHITE = re.compile(r"[ \t\n\r]+")
_CUT = re.compile(r"[ \t\n\r]")


@cache
def tokenizer(path: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


class Lengths(dict):
    """Numbers of tokens of pieces of text: tier one as it was sent, then what this worker met."""

    def __init__(self, path: str, frequent: dict[str, int]):
        super().__init__(frequent)
        self.path, self.frequent = path, frequent

    def __missing__(self, piece: str) -> int:
        if len(self) >= len(self.frequent) + CACHE:
            self.clear()
            self.update(self.frequent)
        n = self[piece] = len(tokenizer(self.path).encode(piece, add_special_tokens=False).ids)
        return n


def pieces(text: str) -> Iterator[str]:
    """The text in parts of about ``PIECE`` characters, cut at plain white space."""
    at = 0
    while len(text) - at > PIECE:
        cut = _CUT.search(text, at + PIECE)
        if cut is None:
            break
        yield text[at : cut.start()]
        at = cut.end()
    yield text[at:] if at else text


def pre_tokens(text: str) -> list[str]:
    if _FOREIGN.search(text) or "<|" in text:
        return [x for x in _PLAIN_WHITE.split(text) if x]
    return _PRE.findall(text.lower())


def _frequent(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    found: Counter[str] = Counter()
    for batch in rows:
        for text in batch["text"].to_pylist():
            for piece in pieces(text or ""):
                found.update(pre_tokens(piece))
        if len(found) > COUNTED:
            found = Counter(dict(found.most_common(COUNTED // 2)))
    top = found.most_common(PER_TASK)
    yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in top], pa.string()), pa.array([n for _, n in top], pa.int64())], names=["piece", "n"])


def frequent_lengths(docs: DataFrame, path: str) -> dict[str, int]:
    """The most frequent pre-tokens of the corpus with their numbers of tokens."""
    top = docs.select("text").mapInArrow(_frequent, "piece string, n bigint").groupBy("piece").agg(F.sum("n").alias("n"))
    top = top.where(F.length("piece") <= 64).orderBy(F.desc("n"), "piece").limit(FREQUENT).select("piece").toArrow()["piece"].to_pylist()
    encoded = tokenizer(path).encode_batch(top, add_special_tokens=False)
    return {piece: len(e.ids) for piece, e in zip(top, encoded, strict=True)}


_LENGTHS: dict[str, Lengths] = {}


def _counts(path: str, sent):
    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # one cache per worker, shared by its tasks
        lengths = _LENGTHS.get(path)
        if lengths is None or lengths.frequent is not sent.value:
            lengths = _LENGTHS[path] = Lengths(path, sent.value)
        for batch in rows:
            text = batches.texts_of(batch["text"])
            n = [sum(sum(map(lengths.__getitem__, pre_tokens(p))) for p in pieces(t)) for t in text.to_pylist()]
            size = pa.compute.binary_length(text).cast(pa.int64())
            yield pa.RecordBatch.from_arrays([batch["doc_id"], size, pa.array(n, pa.int64())], names=["doc_id", "n_bytes", "n_tokens"])

    return run


def token_counts(docs: DataFrame, path: str, limit: int = LIMIT) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of every row; a null text counts as empty.

    ``path`` is a tokenizer file that every executor can open. Special strings inside texts count as the
    tokenizer's default has it: one token each.
    """
    sent = docs.sparkSession.sparkContext.broadcast(frequent_lengths(docs, path))
    own = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    found = own.mapInArrow(_counts(path, sent), "doc_id bigint, n_bytes bigint, n_tokens bigint")
    return found.withColumn("over_limit", F.col("n_tokens") > limit)
