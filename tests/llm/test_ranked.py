"""Ranked search against scores of all pairs."""

import math
import random
from collections import Counter

import duckdb
import numpy as np
import pytest

from tapecheck.llm import queries, ranked
from tests.llm import brute


def plain(docs, items, k=10):
    bags = [(d, Counter(brute.words(t))) for d, t in docs]
    n = sum(bool(b) for _, b in bags)
    words = sum(sum(b.values()) for _, b in bags)
    df = Counter(w for _, b in bags for w in b)
    out = []
    for item_id, text in {(i, t or "") for i, t in items}:
        want, found = Counter(brute.words(text)), []
        for doc_id, bag in bags:
            m = 25 + 75 * sum(bag.values()) * n // words if words else 0
            s = sum(c * math.floor(1000 * math.log((2 * n + 2) / (2 * df[w] + 1))) * (10**9 * bag[w] // (1000 * bag[w] + 8 * m)) for w, c in want.items() if w in bag)
            if s > 0:
                found.append((-s, doc_id is None, doc_id))
        found.sort(key=lambda x: x[:2] + (x[2] or 0,))
        out += [(item_id, r + 1, d, -s) for r, (s, _, d) in enumerate(found[:k])]
    return sorted(out, key=str)


def check(spark, docs, items, k=10):
    got = ranked.search(docs, items, k).collect()
    want = plain([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()], [(r.item_id, r.text) for r in items.select("item_id", "text").collect()], k)
    assert sorted((tuple(r) for r in got), key=str) == want
    return want


@pytest.fixture
def made(spark):
    rng = random.Random(12)
    pool = [f"w{int(rng.paretovariate(0.7))}" for _ in range(4000)]
    docs = [(k, " ".join(rng.choices(pool, k=rng.randint(0, 80)))) for k in range(3000)]
    docs += [(5000 + k, "same words in many copies W1 w2") for k in range(300)]
    items = [(k, " ".join(rng.choices(pool, k=rng.randint(0, 25)))) for k in range(150)] + [(900, "same copies copies"), (901, "nowhere"), (902, "")]
    return spark.createDataFrame(docs, "doc_id bigint, text string").repartition(5), spark.createDataFrame(items, "item_id bigint, text string")


@pytest.mark.parametrize("sizes", [{}, {"BLOCK": 128, "LEAF": 4, "NODE_LEAVES": 4, "GROUP": 8, "FEW": 2, "BUNDLE": 300, "SEED": 8}], ids=["usual", "small"])
def test_equals_all_pairs(spark, made, monkeypatch, sizes):
    for name, value in sizes.items():
        monkeypatch.setattr(ranked, name, value)
    assert len(check(spark, *made)) > 1000


def test_pairs_out_of_reach_are_dropped(monkeypatch):
    """Of documents on two topics, an item meets the leaves of its own only."""
    import pyarrow as pa

    rng = np.random.default_rng(1)
    bundle = ranked.Bundle(pa.table({"terms": [list(range(10)), list(range(10, 20))], "weights": [[100] * 10, [100] * 10]}))
    parts, seen = [], []
    for _ in range(4):
        topic = rng.integers(0, 2, 512)
        terms = [sorted(int(10 * t + x) for x in rng.choice(10, 5, replace=False)) for t in topic]
        parts.append(pa.record_batch({"doc_id": pa.array(range(512), pa.int64()), "n": pa.array([5] * 512, pa.int64()), "terms": pa.array(terms, pa.list_(pa.int64())), "tfs": pa.array([[1] * 5] * 512, pa.list_(pa.int64()))}))
    scored = ranked.Block.offer
    monkeypatch.setattr(ranked.Block, "offer", lambda self, leaf, *rest: seen.append(leaf) or scored(self, leaf, *rest))
    ranked._search(bundle, np.zeros(2, dtype=np.int64), 10, (2048, 10_240), parts)
    assert 0 < len(seen) < 4 * 2 * (512 // ranked.LEAF) * 0.6


def test_odd_rows(spark, odd_docs, no_docs):
    schema = "item_id bigint, text string, rank int, doc_id bigint"
    items = spark.createDataFrame(
        [(1, "one line of plain words", 1, 2), (1, "one line of plain words", 1, 2), (1, "word5 and", 1, 2), (None, "text of the line", 1, 2), (2, None, 1, 2), (3, "", 1, 2), (4, "Été ÄÖÜ \U0001f600 " * 50, 1, 2)], schema
    )
    want = check(spark, odd_docs, items)
    assert {r[0] for r in want} == {1, None, 4}
    check(spark, odd_docs, items, k=1)
    assert ranked.search(no_docs, items).count() == 0
    assert ranked.search(odd_docs, spark.createDataFrame([], schema)).count() == 0


def test_query_equals_sql(spark, sample_dir):
    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sample_dir}/{name}.parquet'")
    cursor = con.execute(queries.ORACLE["op12_dual_tree_search"])
    assert [c[0] for c in cursor.description] == ["item_id", "rank", "doc_id", "score"]
    got = queries.QUERIES["op12_dual_tree_search"](spark, sample_dir)
    assert sorted(map(tuple, got.collect())) == sorted(cursor.fetchall())
