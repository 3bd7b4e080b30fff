"""Near duplicates, fuzzy lines and the shared linking against all pairs on small inputs."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tapecheck.llm import batches, copies, lines, links
from tapecheck.llm.tables import keyed
from tests.llm import brute


def texts(seed, groups, size, edits):
    """Groups of texts that are edited copies of one another, and texts of their own."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choices("abcdefghij", k=rng.randint(3, 7)))
    out = []
    for _ in range(groups):
        base = [word() for _ in range(80)]
        for _ in range(size):
            own = list(base)
            for _ in range(rng.randint(0, edits)):
                own[rng.randrange(len(own))] = word()
            out.append(" ".join(own))
        out.append(" ".join(word() for _ in range(60)))
    return out


def test_signatures_estimate_weighted_jaccard():
    a = " ".join(["one two three four five six seven"] * 9 + ["alpha beta gamma delta"] * 4)
    b = " ".join(["one two three four five six seven"] * 4 + ["alpha beta gamma delta"] * 7)
    s, r, c = copies.bag(pa.array([a, b, a]))
    sig = copies.bag_min_hash(s, r, c, 3, 4096)
    want = brute.weighted_jaccard(brute.bag(a), brute.bag(b))
    assert abs((sig[0] == sig[1]).mean() - want) < 0.03 and (sig[0] == sig[2]).all()
    for n in (1, 2, 3, 5, 9, 100):  # {x: n} and {x: 1} share 1/n
        h = np.array([7, 7], dtype=np.uint64)
        sig = copies.bag_min_hash(h, np.array([0, 1]), np.array([n, 1]), 2, 4096)
        assert abs((sig[0] == sig[1]).mean() - 1 / n) < 0.04
    empty = copies.bag_min_hash(*copies.bag(pa.array(["", "--"])), 2, 8)
    assert (empty == empty[0, 0]).all()


def test_overlap_is_exact():
    rng = random.Random(1)
    a, b = ([" ".join(rng.choices("xyz", k=rng.randrange(25))) for _ in range(60)] for _ in range(2))
    got = batches.overlap(copies.bag(pa.array(a)), copies.bag(pa.array(b)), 60)
    assert np.allclose(got, [brute.weighted_jaccard(brute.bag(x), brute.bag(y)) for x, y in zip(a, b, strict=True)])


@pytest.mark.parametrize("block", [links.BLOCK, 4])
def test_near_duplicates_equal_all_pairs(spark, monkeypatch, block):
    monkeypatch.setattr(links, "BLOCK", block)
    made = texts(3, 4, 14, 5) + ["", "", None, "same few words", "same few words", "Same, few words!"]
    bags = [brute.bag(t) for t in made]
    want = brute.classes(len(made), lambda a, b: bool(bags[a]) and brute.weighted_jaccard(bags[a], bags[b]) >= 0.8)
    docs = spark.createDataFrame(list(enumerate(made)), "doc_id bigint, text string")
    got = {r.k1: (r.class_k1, r.class_size) for r in copies.near_duplicates(keyed(docs)).collect()}
    assert [got[k][0] for k in range(len(made))] == want
    assert all(got[k][1] == want.count(want[k]) for k in range(len(made)))
    kept = sorted(r.doc_id for r in copies.near_dedup(docs).collect())
    assert kept == sorted(set(want))


def test_near_dedup_keeps_odd_rows(spark, odd_docs, no_docs):
    left = copies.near_dedup(odd_docs)
    assert left.columns == odd_docs.columns and copies.near_dedup(no_docs).count() == 0
    ids = [r.doc_id for r in left.collect()]
    assert sorted(x for x in ids if x is not None) == [1, 2, 3, 4, 7, 8] and ids.count(None) == 2


def test_components_of_long_chains(spark):
    rng = random.Random(2)
    edges = [(k, k + 1) for k in range(60)] + [(100 + k, 100) for k in range(1, 50)] + [(200, 201), (201, 200), (300, 300)]
    names = list(range(400))
    rng.shuffle(names)
    renamed = [(names[a], names[b]) for a, b in edges]
    got = {r.node: r.component for r in links.components(spark.createDataFrame(renamed, "a bigint, b bigint")).collect()}
    groups = [range(61), range(100, 150), (200, 201)]
    assert got == {names[k]: min(names[x] for x in g) for g in groups for k in g}


def brute_lines(docs):
    """Positions that go from each (doc, row number)."""
    places = [(d, p, brute.line_form(x)) for d, t in docs for p, x in enumerate((t or "").split("\n")) if len(brute.line_form(x).split(" ")) >= 5]
    sets = [brute.line_shingles(x) for *_, x in places]
    where = brute.classes(len(places), lambda a, b: len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]))
    gone = {d: set() for d, _ in docs}
    for k, w in enumerate(where):
        if w != k:
            gone[places[k][0]].add(places[k][1])
    return gone


@pytest.mark.parametrize("block", [links.BLOCK, 3])
def test_lines_equal_all_pairs(spark, monkeypatch, block):
    monkeypatch.setattr(links, "BLOCK", block)
    rng = random.Random(8)
    pool = texts(5, 3, 6, 2) + ["short one", "Five words make a line", "five  words\tmake a LINE ", "", "é ü five words of it"]
    docs = [(k, "\n".join(rng.choices(pool, k=rng.randrange(1, 5)))) for k in range(40)] + [(90, None), (91, "")]
    gone = brute_lines(docs)
    got = {r.doc_id: r for r in lines.line_dedup(spark.createDataFrame(docs, "doc_id bigint, text string")).collect()}
    for d, t in docs:
        want = None if t is None else "\n".join(x for p, x in enumerate(t.split("\n")) if p not in gone[d])
        assert (got[d].text, got[d].n_removed) == (want, len(gone[d]))


def test_similarities_equal_plain_sets():
    from tapecheck.llm import sketches

    rng = random.Random(6)
    pool = ["".join(rng.choices("abé ", k=rng.choice([0, 1, 3, 4, 5, 6, 9, 200]))) for _ in range(400)]
    left, right = pool[:200], [x if rng.random() < 0.3 else y for x, y in zip(pool, pool[200:], strict=False)]
    got = sketches.similarities(pa.array(left, pa.large_string()), pa.array(right, pa.large_string()), lines.shingle_hashes)
    sets = [[brute.line_shingles(x) if x else set() for x in side] for side in (left, right)]
    want = [len(a & b) / len(a | b) if a | b else 0 for a, b in zip(*sets, strict=True)]
    assert got.tolist() == pytest.approx(want)


@pytest.mark.parametrize("small,block", [(32, links.BLOCK), (2, 4)], ids=["rows", "blocks"])
def test_buckets_of_strangers_are_torn_apart(spark, monkeypatch, small, block):
    """One band for all lines: every link must come from comparing members of different components."""
    from tapecheck.llm import sketches

    monkeypatch.setattr(sketches, "SMALL", small)
    monkeypatch.setattr(links, "BLOCK", block)
    rng, word = random.Random(3), lambda: "".join(rng.choices("abcdefgh", k=5))
    pool = []
    for _ in range(8):
        base = [word() for _ in range(30)]
        pool += [" ".join(base), " ".join([*base[:-1], word()]), " ".join([word(), *base[1:]])]
    sets = [brute.line_shingles(x) for x in pool]
    want = brute.classes(len(pool), lambda a, b: len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]))
    nodes = list(range(1000, 1000 + len(pool)))
    rng.shuffle(nodes)
    lines_ = batches.texts_of(pa.array(pool))
    _, _, data, off = next(batches.chunks(lines_))
    sk = sketches.sketch(lines.signatures(data, off, lines.ROWS * lines.BANDS)).to_pylist()
    rows = [(n, [7, 8], s) for n, s in zip(nodes, sk, strict=True)] + [(nodes[0], [], None)]
    scanned = spark.createDataFrame(rows, "node bigint, bands array<bigint>, sketch binary")
    texts_of = lambda some: spark.createDataFrame(list(zip(nodes, pool, strict=True)), "node bigint, text string").join(some, "node", "left_semi")
    got = {r.node: r.component for r in sketches.link(scanned, texts_of, lines.shingle_hashes, lines.shingle_sets, 0.8).collect()}
    groups = {}
    for k, w in enumerate(want):
        groups.setdefault(w, set()).add(nodes[k])
    assert got == {n: min(g) for g in groups.values() if len(g) > 1 for n in g}


def test_short_lines_equal_all_pairs(spark):
    rng, pool = random.Random(11), []
    for letters, space in (("abcdefghijklmnop", " "), ("абвгдежзиклмнопр", " "), ("天地玄黃宇宙洪荒日月盈昃辰宿列張", "")):
        word = lambda a=letters: "".join(rng.choices(a, k=rng.randint(3, 7)))
        for k in range(12):
            base = [word() for _ in range(10 + k % 9)]
            one, other = list(base), space.join(base)
            one[rng.randrange(len(one))] = word()
            at = rng.randrange(len(other))
            pool += [other, space.join(one), other[:at] + letters[0] + other[at + 1 :], other[:-1], space.join(word() for _ in range(8))]
    shingles = [{x[k : k + 5] for k in range(len(x) - 4)} for x in pool]
    like = lambda a, b: len(shingles[a] & shingles[b]) >= 0.8 * len(shingles[a] | shingles[b])
    want = brute.classes(len(pool), like)
    short = sum(len(pool[k]) < 119 and w != k for k, w in enumerate(want))
    left = lines.line_dedup(spark.createDataFrame(list(enumerate(pool)), "doc_id bigint, text string")).collect()
    stay = {r.doc_id for r in left if not r.n_removed}
    # nothing goes that should stay; bands may miss one pair in a hundred
    assert short > 60 and set(want) <= stay and len(stay - set(want)) <= 0.02 * (len(pool) - len(set(want)))


def test_bands_find_short_lines():
    rng = random.Random(5)
    for length in (20, 30, 50, 119, 300):
        a, b = [], []
        while len(a) < 1000:
            x = "".join(rng.choices("abcdefghij klmn", k=length))
            y = x[: -max(1, int((length - 4) * rng.uniform(0.1, 0.2)))]
            p, q = ({t[k : k + 5] for k in range(len(t) - 4)} for t in (x, y))
            if 0.8 <= len(p & q) / len(p | q) < 0.83:
                a.append(x)
                b.append(y)
        own = []
        for texts_ in (a, b):
            (_, _, data, off), = batches.chunks(batches.texts_of(pa.array(texts_)))
            own.append(lines.signatures(data, off, lines.ROWS * lines.BANDS).reshape(-1, lines.BANDS, lines.ROWS))
        assert (own[0] == own[1]).all(axis=2).any(axis=1).mean() >= 0.99


def test_long_repeated_passages_go(spark):
    passage = " ".join(f"word{k}" for k in range(60))
    docs = spark.createDataFrame([(k, f"own line number {k} has words enough\n{passage}\nanother closing line of number {k * 31} here") for k in range(30)], "doc_id bigint, text string")
    left = {r.doc_id: r.text for r in lines.line_dedup(docs).collect()}
    assert passage in left[0] and not any(passage in left[k] for k in range(1, 30))


def test_line_dedup_of_odd_rows(spark, odd_docs, no_docs):
    got = lines.line_dedup(odd_docs)
    assert got.count() == odd_docs.count() and set(odd_docs.columns) <= set(got.columns)
    by = {r.doc_id: r for r in got.where("doc_id is not null").collect()}
    assert by[2].text is None and by[3].text == "" and by[7].text == " \n\t\n " and by[1].n_removed == 0
    assert by[6].n_removed == 2 and by[5].n_removed == by[4].n_removed + 1
    assert lines.line_dedup(no_docs).count() == 0
    left = lines.line_dedup(odd_docs, drop_emptied=True)
    assert sorted(r.doc_id for r in left.where("doc_id is not null").collect()) == [1, 2, 3, 4, 5, 7, 8]


def test_sieve_never_loses_a_member(spark):
    from tapecheck.llm.tables import Sieve

    nodes = spark.range(5000).select(F.xxhash64("id").alias("node"))
    own = np.array([r.node for r in nodes.collect()], dtype=np.int64)
    sieve = Sieve(nodes, "node")
    assert sieve.passes(own).all()
    assert sieve.passes(batches.mix(np.arange(100_000, dtype=np.uint64))).mean() < 0.01


@pytest.mark.parametrize("slices", [2, 64])
def test_shared_bands_travel_packed(spark, monkeypatch, slices):
    """Bands are reduced part by part and packed: the shuffle gets a row for each slice of a part, not for each band."""
    from tapecheck.llm import sketches

    monkeypatch.setattr(sketches, "SLICES", slices)
    monkeypatch.setattr(sketches, "PACKED", 1000)
    rng = random.Random(4)
    some = [rng.randrange(-(2**63), 2**63) for _ in range(3000)] + [-(2**63), -1, 0, 1, 2**63 - 1]
    # a band that all nodes share, nodes that repeat with and without bands
    rows = [(n, [7, *rng.choices(some, k=rng.randrange(6))]) for n in rng.sample(some, 900)]
    rows += [(n, rng.choice([[], b, b])) for n, b in rng.choices(rows, k=300)]
    members = {}
    for n, bands in rows:
        for b in bands:
            members.setdefault(b, set()).add(n)
    want = {b: min(x) for b, x in members.items() if len(x) > 1}
    own = spark.createDataFrame(rows, "node bigint, bands array<bigint>")
    assert {r.band: r.centre for r in sketches.shared_bands(own, len(rows)).collect()} == want and len(want) > 300
    parts = pa.table({"node": [n for n, _ in rows], "bands": pa.array([b for _, b in rows], pa.list_(pa.int64()))}).to_batches(100)
    packed = list(sketches._packed(slices)(iter(parts)))
    assert sum(len(p) for p in packed) <= slices * len(packed) < sum(len(b) for _, b in rows) / 2
    hot = np.concatenate([np.frombuffer(x, np.int64) for p in packed for x in p["band"].to_pylist()]) == 7
    assert 2 < len(packed) and hot.sum() <= 2 * len(packed)
    table = pa.Table.from_batches(packed)
    found = [sketches._centres(table.filter(pa.compute.equal(table["slice"], k))) for k in range(slices) if k in table["slice"].to_pylist()]
    assert {b: c for t in found for b, c in zip(*t.to_pydict().values(), strict=True)} == want


def test_signatures_are_made_in_pieces(monkeypatch):
    """The same values whatever a piece holds, and work arrays that do not grow with the part."""
    import tracemalloc

    rng = random.Random(9)
    pool = ["".join(rng.choices("abé 天", k=rng.choice([0, 1, 3, 4, 5, 6, 9, 200]))) for _ in range(300)]
    (_, _, data, off), = batches.chunks(batches.texts_of(pa.array(pool)))
    whole = lines.signatures(data, off, 12)
    for piece in (1, 50, 700):
        monkeypatch.setattr(lines, "PIECE", piece, raising=False)
        assert (lines.signatures(data, off, 12) == whole).all()
    monkeypatch.undo()
    (_, _, data, off), = batches.chunks(batches.texts_of(pa.array(["some words of a line " * 100] * 400)))
    tracemalloc.start()
    out = lines.signatures(data, off, 96)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 4 * out.nbytes + (8 << 20)
