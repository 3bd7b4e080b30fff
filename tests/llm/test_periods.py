"""Periodic runs against a scan of all periods."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from tapecheck.llm import periods


def every_run(words):
    found = {}
    for q in range(1, len(words) // 2 + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(12, 2 * q):
                found.setdefault((i, j + q), q)
            i = max(j, i) + 1
    return sorted((s, e - s, q) for (s, e), q in found.items())


def plain(doc_id, text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(w)
    if doc_id is not None and n and (h := zlib.crc32(str(doc_id).encode())) % 10 == 0:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = every_run(w)
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    top = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None,) * 3)
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (
        doc_id, len(runs), *top, 1000 * top[1] // top[2] if runs else None,
        sha("".join(f"{s},{length},{q}\n" for s, length, q in runs)), sha(" ".join(x for i, x in enumerate(w) if i not in gone)),
    )


def nested(rng):
    """Repetitions of repetitions, cut at odd places."""
    k = rng.choice([1, 2, 3, 5, 50])

    def unit(depth):
        if depth == 0 or rng.random() < 0.2:
            return [rng.randrange(k) for _ in range(rng.randint(1, 8))]
        v = [x for _ in range(rng.randint(1, 3)) for x in unit(depth - 1)] * rng.randint(1, 6)
        return v[: len(v) - rng.randint(0, min(5, len(v) - 1))]

    out, n = [], rng.randint(0, 400)
    while len(out) < n:
        out += unit(3)
    return out[:600]


def found(words, sizes=None):
    s, e, q = periods.runs_of(np.array(words, dtype=np.int64), sizes)
    return list(zip(s.tolist(), (e - s).tolist(), q.tolist(), strict=True))


def test_every_run_is_found():
    rng = random.Random(11)
    for _ in range(300):
        words = nested(rng)
        assert found(words) == every_run(words)


@pytest.mark.parametrize(
    "words",
    [
        [0] * 500,
        [0] * 100 + [1] + [0] * 100 + [1] + [0] * 98,
        [0, 1] * 100 + [1, 0] * 100,
        [bin(i).count("1") % 2 for i in range(700)],
        (list(range(70)) * 5)[:300],
        [0] * 11,
        [0] * 12,
        [],
    ],
    ids=["one word", "zones", "touching zones", "no cubes", "long period", "too short", "just long enough", "empty"],
)
def test_regular_texts(words):
    assert found(words) == every_run(words)


def test_all_plain_distances_when_hashes_mislead(monkeypatch):
    """Extension that always says "equal" is caught by the check, and zones that nothing knows are scanned."""
    rng = random.Random(3)
    monkeypatch.setattr(periods._Stretches, "hashes", lambda self, start, end: np.zeros(len(start), dtype=np.uint64))
    for _ in range(20):
        words = nested(rng)
        assert found(words) == every_run(words)


def test_work_grows_with_the_text():
    """Texts of few words, where pairing equal minimizers would be quadratic."""
    n = 200_000
    assert found([0] * n) == [(0, n, 1)]
    assert len(found(([0] * 1000 + [1]) * (n // 1001))) == n // 1001 + 1


def test_texts_of_one_chunk_do_not_meet():
    a, b = [1, 2, 3] * 20, [7] * 15
    ids = np.array([*a, *b], dtype=np.int64)
    assert found(ids, [60, 15]) == [(0, 60, 3), (60, 15, 1)]


def key(row):
    return tuple((x is not None, x) for x in row)


def test_documents_equal_the_plain_version(spark, odd_docs, no_docs, monkeypatch):
    rng = random.Random(7)
    made = [(k, rng.choice([" ", "\n", "\t \x0b"]).join(f"w{x}" for x in nested(rng))) for k in range(400)]
    made += [(k, " ".join(rng.choices("abcdefghij", k=rng.randint(0, 300)))) for k in range(400, 600)]
    for docs in (spark.createDataFrame(made, "doc_id bigint, text string"), odd_docs.where("doc_id is null or doc_id not in (4, 5)"), no_docs):
        want = sorted((plain(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()), key=key)
        got = sorted((tuple(r) for r in periods.digest(periods.periodic_runs(docs, planted=True)).collect()), key=key)
        assert got == want


def test_very_long_texts_and_repeated_rows(spark, odd_docs):
    rows = {r.doc_id: r for r in periods.periodic_runs(odd_docs).where("doc_id in (4, 5, 6)").collect()}
    # word0 and word1 and ...: the sequence of 977 numbers repeats, two words each
    assert [tuple(r) for r in rows[4].runs] == [(0, 60_000, 1954)] == [tuple(r) for r in rows[5].runs]
    assert rows[4].n_words == 60_001 and rows[4].n_kept == 1955
    assert periods.periodic_runs(odd_docs).where("doc_id = 6").count() == 2


def test_given_documents(spark, sample_dir):
    docs = spark.read.parquet(f"{sample_dir}/documents.parquet").where("length(text) < 6000")
    want = sorted(plain(r.doc_id, r.text) for r in docs.collect())
    got = sorted(tuple(r) for r in periods.digest(periods.periodic_runs(docs, planted=True)).collect())
    assert got == want and any(r[1] for r in got)
