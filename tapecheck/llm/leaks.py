"""Benchmark decontamination: passages of test items found by a generalised suffix automaton.

The automaton holds every run of words of every item. A document's words are fed through it; the state
after each word knows the longest run that ends there and stands in some item. Where that run has
``window`` words or more, its last ``window`` words are a window of the items named by the state; an
item of fewer words is one window, found through the suffix links. Every word in an occurrence is hit.

Words are runs of digits, letters and characters beyond ASCII, A-Z lower-cased. They are compared by
64-bit hashes. An item without an id marks hits like any other, but is not among a document's items. A stretch of words none of which the items lack must be as long as the shortest
window, so only such stretches are walked; the rest is skipped by array operations.

Items are split into automata of at most ``WORDS`` words (an item is never split). Only one of them is
built, sent and held at a time: with several, the documents pass through one after the other, and
what each has found is written down before the next one comes.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tapecheck.llm import batches
from tapecheck.llm.tables import stored

WINDOW = 10
#: Words of one automaton.
WORDS = 200_000
#: A document more than this share of whose words is hit is dropped whole.
COVERAGE = 0.5
#: Stands for a null item_id: its windows are hit, but it is no item of a document.
NO_ITEM = -(2**63)

U = np.uint64


def text_words(texts: list[str]) -> list[list[int]]:
    out: list[list[int]] = []
    for at, end, data, off in batches.chunks(batches.texts_of(pa.array(texts, pa.large_string()))):
        h, row, *_ = batches.words(data, off)
        out += [x.tolist() for x in np.split(h, np.searchsorted(row, np.arange(1, end - at)))]
    return out


class Automaton:
    """Generalised suffix automaton over word numbers, with the windows that end in each state."""

    def __init__(self, items: list[list[int]], names: list[int], window: int):
        self.window = window
        vocabulary = sorted({w for x in items for w in x})
        self.vocabulary = np.array(vocabulary, dtype=np.uint64)
        number = {w: k for k, w in enumerate(vocabulary)}
        self.shortest = min([window, *(len(x) for x in items if x)])
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        ends: list[tuple[int, int]] = []  # state of each prefix, item
        whole: list[tuple[int, int]] = []  # state of each item that is one window, item
        for name, item in zip(names, items, strict=True):
            last = 0
            for word in item:
                last = self._append(last, number[word])
                ends.append((last, name))
            if 0 < len(item) < window:
                whole.append((last, name, len(item)))
        # items that hold a state's words: those of its own ends and of all longer states
        holds: dict[int, set[int]] = defaultdict(set)
        for state, name in ends:
            holds[state].add(name)
        order = sorted(range(len(self.link)), key=self.length.__getitem__)
        for state in reversed(order):
            if self.link[state] >= 0 and self.length[self.link[state]] >= window:
                holds[self.link[state]] |= holds[state]
        self.items = {s: tuple(sorted(holds[s])) for s in order if self.length[s] >= window}
        short: dict[int, list[tuple[int, int]]] = defaultdict(list)
        for state, name, length in whole:
            short[state].append((length, name))
        self.short: dict[int, tuple[tuple[int, int], ...]] = {}
        for state in order:
            below = self.short.get(self.link[state], ()) if state else ()
            if own := (*below, *short.get(state, ())):
                self.short[state] = own

    def _append(self, last: int, word: int) -> int:
        if word in self.next[last]:
            to = self.next[last][word]
            return to if self.length[to] == self.length[last] + 1 else self._split(last, word, to)
        new = self._state({}, self.length[last] + 1, 0)
        while last >= 0 and word not in self.next[last]:
            self.next[last][word] = new
            last = self.link[last]
        if last >= 0:
            to = self.next[last][word]
            self.link[new] = to if self.length[to] == self.length[last] + 1 else self._split(last, word, to)
        return new

    def _split(self, last: int, word: int, to: int) -> int:
        half = self._state(dict(self.next[to]), self.length[last] + 1, self.link[to])
        self.link[to] = half
        while last >= 0 and self.next[last].get(word) == to:
            self.next[last][word] = half
            last = self.link[last]
        return half

    def _state(self, after: dict[int, int], length: int, link: int) -> int:
        self.next.append(after)
        self.length.append(length)
        self.link.append(link)
        return len(self.next) - 1

    def walk(self, run: list[int]) -> tuple[list[tuple[int, int]], set[int]]:
        """Spans (start, end) of windows in a stretch of word numbers, and their items."""
        after, link, length, window = self.next, self.link, self.length, self.window
        state, matched, found, items = 0, 0, [], set()
        for at, word in enumerate(run, 1):
            while state and word not in after[state]:
                state = link[state]
                matched = length[state]
            if word in after[state]:
                state = after[state][word]
                matched += 1
            if matched >= window:
                top = state
                while length[link[top]] >= window:
                    top = link[top]
                found.append((at - window, at))
                items.update(self.items[top])
            for size, name in self.short.get(state, ()):
                if size <= matched:
                    found.append((at - size, at))
                    items.add(name)
        return found, items

    def find(self, h: np.ndarray, row: np.ndarray) -> Iterator[tuple[int, list[tuple[int, int]], set[int]]]:
        """(row, spans in word indexes, items) of each stretch with windows."""
        if not len(self.vocabulary) or not len(h):
            return
        at = np.minimum(np.searchsorted(self.vocabulary, h), len(self.vocabulary) - 1)
        known = self.vocabulary[at] == h
        edges = np.concatenate(([0], np.flatnonzero(row[1:] != row[:-1]) + 1, [len(h)]))
        starts, ends, _ = batches.spans(known, edges)
        long = ends - starts >= self.shortest
        for s, e in zip(starts[long].tolist(), ends[long].tolist(), strict=True):
            spans, items = self.walk(at[s:e].tolist())
            if spans:
                yield int(row[s]), [(a + s, b + s) for a, b in spans], items


def automata(benchmark: DataFrame, window: int = WINDOW, limit: int = WORDS) -> Iterator[Automaton]:
    """Automata of all items of ``benchmark`` (item_id, text), each of at most ``limit`` words or one item; one without items if there are none.

    Items come to the driver one Spark partition at a time and are forgotten with their automaton.
    """
    part, names, size, made = [], [], 0, False
    for row in benchmark.select("item_id", "text").where("text is not null").toLocalIterator():
        words = text_words([row.text])[0]
        if part and size + len(words) > limit:
            yield Automaton(part, names, window)
            part, names, size, made = [], [], 0, True
        part.append(words)
        names.append(NO_ITEM if row.item_id is None else row.item_id)
        size += len(words)
    if part or not made:
        yield Automaton(part, names, window)


RESULT = "n_words bigint, n_hit bigint, items array<bigint>, spans array<struct<start:bigint,end:bigint>>"
FOUND = ("n_words", "n_hit", "items", "spans")


def _known(batch: pa.RecordBatch, at: int, n: int, off: np.ndarray, starts: np.ndarray, hit: np.ndarray) -> list[set[int]]:
    """Items that earlier automata found in the rows from ``at`` on; marks the words of their spans."""
    spans = batch["spans"].slice(at, n)
    flat = spans.flatten()
    row = np.repeat(np.arange(n), pa.compute.list_value_length(spans).to_numpy())
    low, high = (np.searchsorted(starts, flat.field(k).to_numpy() + off[row]) for k in ("start", "end"))
    change = np.zeros(len(hit) + 1, dtype=np.int64)
    np.add.at(change, low, 1)
    np.add.at(change, high, -1)
    hit |= np.cumsum(change[:-1]) > 0
    return [set(x) for x in batch["items"].slice(at, n).to_pylist()]


def _scan(sent, passed: list[str], again: bool):
    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            texts = batches.texts_of(batch["text"])
            for at, end, data, off in batches.chunks(texts):
                n = end - at
                h, row, starts, ends = batches.words(data, off)
                hit = np.zeros(len(h), dtype=bool)
                items: list[set[int]] = _known(batch, at, n, off, starts, hit) if again else [set() for _ in range(n)]
                for k, spans, names in sent.value.find(h, row):
                    items[k] |= names
                    for a, b in spans:
                        hit[a:b] = True
                # spans of hit words, as bytes of the text: from the first word's start to the last one's end
                edges = np.concatenate(([0], np.flatnonzero(row[1:] != row[:-1]) + 1, [len(h)])) if len(h) else np.zeros(1, int)
                first, last, _ = batches.spans(hit, edges)
                where = row[first]
                low, high = starts[first] - off[where], ends[last - 1] - off[where]
                bounds = np.searchsorted(where, np.arange(n + 1)).astype(np.int32)
                spans = pa.StructArray.from_arrays([pa.array(low.astype(np.int64)), pa.array(high.astype(np.int64))], ["start", "end"])
                yield pa.RecordBatch.from_arrays(
                    [
                        *(batch[c].slice(at, n) for c in passed),
                        pa.array(np.bincount(row, minlength=n).astype(np.int64)),
                        pa.array(np.bincount(row[hit], minlength=n).astype(np.int64)),
                        pa.array([sorted(x - {NO_ITEM}) for x in items], pa.list_(pa.int64())),
                        pa.ListArray.from_arrays(pa.array(bounds), spans),
                    ],
                    names=[*passed, *FOUND],
                )

    return run


def scanned(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, limit: int = WORDS) -> DataFrame:
    """``docs`` with n_words, n_hit, items and spans (bytes of the UTF-8 text, whole hit words) in place of columns of those names."""
    own = docs.select(*[docs[c] for c in docs.columns if c not in FOUND])
    schema = StructType([*own.schema.fields, *StructType.fromDDL(RESULT).fields])
    passed, out = own.columns, None
    for machine in automata(benchmark, window, limit):
        sent = docs.sparkSession.sparkContext.broadcast(machine)
        before = own if out is None else stored(out, "leaks")
        out = before.mapInArrow(_scan(sent, passed, out is not None), schema)
    return out


def decontaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, coverage: float = COVERAGE) -> DataFrame:
    """``docs`` without hit spans; documents with more than ``coverage`` of their words hit are dropped.

    A removed span becomes one space. Documents without hits, null and empty texts are returned unchanged.
    """
    found = scanned(docs, benchmark, window)
    found = found.where(F.col("n_hit") <= coverage * F.col("n_words"))
    return found.select(*[_cleaned().alias("text") if c == "text" else F.col(c) for c in docs.columns])


def _cleaned() -> Column:
    raw, spans = F.col("text").cast("binary"), F.col("spans")
    # what stands between two spans, in bytes; spans begin and end at words, so no character is cut
    starts = F.concat(F.array(F.lit(0).cast("bigint")), F.transform(spans, lambda s: s["end"]))
    ends = F.concat(F.transform(spans, lambda s: s["start"]), F.array(F.octet_length("text").cast("bigint")))
    parts = F.zip_with(starts, ends, lambda s, e: F.substring(raw, (s + 1).cast("int"), (e - s).cast("int")).cast("string"))
    return F.when(F.size(spans) > 0, F.array_join(parts, " ")).otherwise(F.col("text"))


def items_sha256(items: str = "items") -> Column:
    return F.sha2(F.array_join(F.array_sort(F.transform(items, lambda x: x.cast("string"))), ","), 256)
