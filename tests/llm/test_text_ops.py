"""Token counts, personal data, page text, leaks and exact copies against plain versions."""

import random
import time

import duckdb
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from tapecheck.llm import exact, leaks, pages, private, queries, tokens
from tests.llm import brute

PATH = public_tokenizers.path("word_bpe_49k.json")


def rows(df):
    return [r.asDict() for r in df.collect()]


def test_tokens_equal_the_library(spark, sample_dir, odd_docs, no_docs):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(PATH)
    rng = random.Random(4)
    pool = [chr(k) for k in range(0x20, 0x250)] + ["\n", "\t", "<|endoftext|>", "<|StartOfText|>", "'ll", "İ", "中", "Σ", "́", "\x1c", "\x85", "　"]
    fuzz = spark.createDataFrame([(k, "".join(rng.choices(pool, k=rng.randint(0, 60)))) for k in range(3000)], "doc_id bigint, text string")
    for docs in (fuzz, odd_docs.select("doc_id", "text"), spark.read.parquet(f"{sample_dir}/documents.parquet").select("doc_id", "text")):
        want = sorted((r.doc_id or -1, len((r.text or "").encode()), len(tok.encode(r.text or "", add_special_tokens=False).ids)) for r in docs.collect())
        got = tokens.token_counts(docs, PATH).collect()
        assert sorted((r.doc_id or -1, r.n_bytes, r.n_tokens) for r in got) == want
        assert all(r.over_limit == (r.n_tokens > 2048) for r in got)
    assert tokens.token_counts(no_docs, PATH).count() == 0


def test_long_texts_are_cut_at_white_space(monkeypatch):
    monkeypatch.setattr(tokens, "PIECE", 10)
    text = "one two three fourfourfourfour five six"
    assert " ".join(tokens.pieces(text)) == text and max(map(len, tokens.pieces(text))) < 30
    assert list(tokens.pieces("x" * 50)) == ["x" * 50]


def test_full_cache_starts_anew(monkeypatch):
    monkeypatch.setattr(tokens, "CACHE", 3)
    own = tokens.Lengths(PATH, {"the": 1})
    counts = [own[w] for w in "a bb ccc dddd the bb".split()]
    assert counts == [len(tokens.tokenizer(PATH).encode(w).ids) for w in "a bb ccc dddd the bb".split()]
    assert own["the"] == 1 and len(own) <= 4


def test_personal_data_equals_plain_regexes(spark, sample_dir, odd_docs, no_docs):
    rng = random.Random(2)
    parts = ["a.b@c.de", "x@y", "@", "+", "1.2.3.4", "256.1.1.1", "001.02.3.255", "4111 1111 1111 1111", "4111111111111112", "+1 (499) 555-6503", "+12", "12-34",
             " ", "\n", ".", "-", "_", "7", "a", "é", "\U0001f600", "5500-0000-0000-0004", "1.2.3.4.5.6.7.8", "a@b.c_d@e.f", "+49.30.1234567", "(", ")"]
    fuzz = [(k, "".join(rng.choices(parts, k=rng.randint(0, 12)))) for k in range(4000)]
    fuzz += [(5000, "9" * 900), (5001, "a" * 900), (5002, "1 2" * 300 + "-3" * 300), (5003, "a.b." * 300 + "@x.y" + ".z" * 300), (5004, "me@here.org 1.2.3.4 " * 300)]
    for docs in (spark.createDataFrame(fuzz, "doc_id bigint, text string"), spark.read.parquet(f"{sample_dir}/documents.parquet"), odd_docs):
        texts = sorted((r.doc_id if r.doc_id is not None else -1, r.text or "") for r in docs.select("doc_id", "text").collect())
        want = sorted((i, *(sum(k == x for k, *_ in brute.personal(t)) for x in range(4)), brute.sha(brute.span_text(brute.personal(t)))) for i, t in texts)
        got = private.personal_data(docs).collect()
        assert sorted((r.doc_id if r.doc_id is not None else -1, r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256) for r in got) == want
        by = dict(texts)
        for r in got:
            if r.n_added == 0 and r.doc_id is not None:
                assert r.spans == brute.span_text(brute.personal(by[r.doc_id]))
    assert private.personal_data(no_docs).count() == 0


def test_long_runs_take_linear_time(spark):
    long = [(0, "9" * 300_000), (1, "a" * 300_000), (2, "1 23" * 50_000 + "-3" * 50_000), (3, "a.b." * 50_000 + "@x.y" + ".z" * 50_000), (4, "me@here.org 1.2.3.4 " * 3_000)]
    got = {r.doc_id: r for r in private.personal_data(spark.createDataFrame(long, "doc_id bigint, text string")).collect()}
    assert [got[k].spans for k in range(3)] == [""] * 3 and got[3].n_email == 1
    assert (got[4].n_email, got[4].n_ip) == (3_000, 3_000) and got[4].spans.endswith(f"ip:{20 * 2999 + 12}:{20 * 2999 + 19}")


def test_wide_spellings_are_added(spark):
    plain = [(k, f"call +1 (499) 555-{k:04d} now, mail me.{k}@mail.example.com or not") for k in range(200)]
    wide = [(1000 + k, f"phone: (499) 555-{k:04d} and mail: bob{k} (at) example (dot) com today") for k in range(60)]
    none = [(2000 + k, f"total 2{k % 10}0.555.{k:04d} in stock") for k in range(60)]
    got = {r.doc_id: r for r in private.personal_data(spark.createDataFrame(plain + wide + none, "doc_id bigint, text string")).collect()}
    assert got[1003].spans == "email:32:59,phone:7:21" and got[1003].n_email == 0
    assert all(got[k].n_added == 0 for k in (*range(200), *range(2000, 2060)))


def test_trees_learn_formats_that_no_single_feature_tells(spark):
    """Ten digits go with a bracket and nine without; the other two are stock numbers. One in 50 real ones has no naming word."""
    rng = random.Random(8)
    forms = {"real": ["({0:03d}) {1:03d}-{2:04d}", "{0:02d}-{1:03d}-{2:04d}"], "stock": ["({0:02d}) {1:03d}-{2:04d}", "{0:03d}-{1:03d}-{2:04d}"]}
    texts, want = [], {}
    for k in range(1600):
        sort = "real" if rng.random() < 0.6 else "stock"
        form = rng.choices(forms[sort], [2, 1])[0]
        low, high = (100, 999) if "{0:03d}" in form else (10, 99)
        value = form.format(rng.randint(low, high), rng.randint(100, 999), rng.randint(1000, 9999))
        word = ("phone" if k % 50 else "under") if sort == "real" else "stock"
        texts.append((k, f"some words {word} {value} and more"))
        want[k] = sort == "real"
    docs = spark.createDataFrame(texts, "doc_id bigint, text string")
    got = {r.doc_id: r for r in private.personal_data(docs).collect()}
    assert all((r.n_added, r.n_spans) == (1, 1) if want[k] else r.spans == "" for k, r in got.items())
    table = private.candidates(docs).selectExpr("doc_id", "inline(found)").collect()
    for feature in private.FEATURES:
        by = {}
        for r in table:
            by.setdefault(r[feature], []).append(want[r.doc_id])
        assert sum(max(sum(v), len(v) - sum(v)) for v in by.values()) < 0.8 * len(table), feature


def test_scores_and_thresholds_equal_plain_ones(spark, sample_dir):
    docs = spark.read.parquet(f"{sample_dir}/documents.parquet").select("doc_id", "text")
    wide = [(10_000 + k, f"{'tel' if k % 3 else 'no'} ({k:03d}) 555-{k:04d} or {'mail' if k % 7 else 'see'} bob{k} (at) example (dot) com") for k in range(120)]
    found = private.candidates(docs.union(spark.createDataFrame(wide, "doc_id bigint, text string")))
    trees, cuts = private.fitted(found)
    rows = found.select("fold", F.explode("found").alias("c")).select("fold", "c.*", trees.column(F.col("c")).alias("score")).collect()
    for r in rows:
        assert abs(trees.score((r.kind, *(r[f] for f in private.FEATURES))) - r.score) < 1e-9
    for kind, cut in enumerate(cuts):
        odd = [r for r in rows if r.fold == 1 and r.wide and r.kind == kind]
        best = float("inf")
        for at in {round(r.score, 9) for r in odd}:
            upper = [r.positive for r in odd if r.score >= at - 1e-8]
            if len(upper) >= private.LEAST and sum(upper) >= private.PRECISION * len(upper):
                best = min(best, at)
        assert best == cut or abs(best - cut) < 1e-8


HTML = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="</p>";</script></head><body>
<nav><ul><li>Home</li></ul></nav><div class="cookie-notice">We use cookies</div><!-- <p>no</p> -->
<article><header><h1>Head &amp; line</h1></header><p>First <b>bold</b>&nbsp;text<br>goes  on<p>Second &lt;p&gt; &#233;
<div class="share">Tweet</div><aside>More</aside><form><p>Mail?</p></form><section id="comments"><p>I agree</p></section></article>
<div role="contentinfo">Legal</div><footer>&copy; me</footer>"""


def page_texts(spark, found):
    frame = spark.createDataFrame([(k, u, h) for k, (u, h) in enumerate(found)], "page_id bigint, url string, html string")
    return {r.page_id: r.text for r in pages.main_text(frame).collect()}


def test_markup_decides_where_it_is_explicit(spark):
    got = page_texts(spark, [("http://a.org/x", HTML), (None, None), ("::bad[", ""), ("http://a.org/y", "<p>" * 50_000 + "deep")])
    assert got == {0: "Head & line\n\nFirst bold text goes on\n\nSecond <p> é", 1: "", 2: "", 3: "deep"}


@pytest.mark.parametrize(
    "broken",
    ["<a " * 350_000, "<i>" * 150_000 + "x</b>" * 100_000, "<!" * 500_000, '<a ">" ' * 150_000, "<p '" * 250_000 + ">", "</div>" * 170_000, "<!--" * 250_000, "<b>" + "<i>" * 300_000 + "</b>", "&" * 1_000_000],
    ids=["open tags", "stray ends", "declarations", "quotes", "one quote", "ends only", "comments", "deep", "references"],
)
def test_broken_markup_takes_linear_time(broken):
    began = time.perf_counter()
    found = pages.blocks("<p>first</p>" + broken)
    assert found[0] == ("first", pages.OPEN) and time.perf_counter() - began < 8


def test_pages_of_odd_rows(spark):
    schema = "page_id bigint, url string, html string, text string, gone array<int>"
    rows = [(1, "http://a.org/1", "<p>same</p>", "t", [0])] * 2 + [(None, None, None, None, None), (2, "http://a.org/1", "a < b > c", "t", None), (3, "http://b.org/" + "x" * 5000, "<p>" + "word " * 200_000 + "</p>", None, None)]
    got = sorted((r.page_id or 0, r.text, r.n_chars) for r in pages.main_text(spark.createDataFrame(rows, schema)).collect())
    assert got == [(0, "", 0), (1, "same", 4), (1, "same", 4), (2, "a < b > c", 9), (3, ("word " * 200_000).strip(), 999_999)]
    assert pages.main_text(spark.createDataFrame([], schema)).count() == 0


@pytest.mark.parametrize("parts", [1, 7])
def test_shared_lines_go_where_markup_is_silent(spark, monkeypatch, parts):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        def page(k):
            return f"<body><div>Welcome to our site</div><div>Story {k} begins with words {k * 7}</div><p>and ends {k} as it must, at length, for all</p><div>All rights kept</div></body>"

        found = [(f"http://h.org/news/{k:03d}", page(k)) for k in range(40)] + [("http://solo.org/", page(99))]
        found += [("http://m.org/a", page(7)), ("http://m.org/a?x=1", page(7))]  # mirrors of one another
        got = page_texts(spark, found)
        assert all(got[k] == f"Story {k} begins with words {k * 7}\n\nand ends {k} as it must, at length, for all" for k in range(40))
        assert got[40].startswith("Welcome") and got[41] == got[42] == "\n\n".join(t for t, _ in pages.blocks(page(7)))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_articles_are_evidence_and_no_switch(spark):
    """Teasers beside the story, template beside an article, a headline outside of it, a passage of two articles, mirrors."""
    story = [f"Story {k} is told at some length here, with {k * 7} words and more that no card would hold" for k in range(8)]

    def teasers(k):
        return f"<div>Read on below</div><main><h1>Head {k}</h1><p>{story[k]}</p></main><article><p>Other story {k}</p></article><article>And one {k + 1}</article>"

    def wrapped(k):
        return f"<div>Read on below</div><div>Page {k}</div><main><h1>Head {k}</h1><article><p>{story[k]}</p><p>A passage that many quote</p></article></main><p>All rights kept</p>"

    found = [(f"http://t.org/{k}", teasers(k)) for k in range(4)] + [(f"http://w.org/{k}", wrapped(k)) for k in range(4, 8)]
    found += [("http://m.org/a", wrapped(4)), ("http://m.org/b", wrapped(4)), ("http://solo.org/", teasers(5))]
    got = page_texts(spark, found)
    assert all(got[k] == f"Head {k}\n\n{story[k]}" for k in range(4))
    assert all(got[k] == f"Head {k}\n\n{story[k]}\n\nA passage that many quote" for k in range(4, 8))
    assert got[8] == got[9] == got[4] and got[10] == f"Read on below\n\nHead 5\n\n{story[5]}"


def test_pages_equal_plain_differencing(spark):
    """Whole pages of several hosts against the rules written out, with the common subsequence by a table."""
    rng = random.Random(11)
    found = []
    for host in range(4):
        for k in range(12):
            blocks = [("div", f"template {host} {x}") for x in range(rng.randrange(4))]
            blocks += [(rng.choice(["p", "article", "nav", "main"]), f"text {rng.randrange(60)} " + "of the page " * rng.randrange(1, 6)) for _ in range(rng.randrange(6))]
            blocks += [("div", f"end {host} {x}") for x in range(rng.randrange(3))]
            found.append((f"http://h{host}.org/{k // 4}/{k:02d}", blocks))
    kind = {"div": "open", "p": "open", "nav": "never", "article": "article", "main": "main"}

    def common(a, b):
        best = [[[]] * (len(b) + 1) for _ in range(len(a) + 1)]
        for x in range(len(a)):
            for y in range(len(b)):
                best[x + 1][y + 1] = [*best[x][y], x] if a[x] == b[y] else max(best[x][y + 1], best[x + 1][y], key=len)
        return best[-1][-1]

    want = []
    for at, (url, blocks) in enumerate(found):
        texts = [t.strip() for _, t in blocks]
        path = url.split(".org")[1]
        sides = [found[x] for x in (at - 1, at + 1) if 0 <= x < len(found) and found[x][0][:10] == url[:10]]
        sides.sort(key=lambda x: -next((k for k, (c, d) in enumerate(zip(path, x[0].split(".org")[1], strict=True)) if c != d)))
        gone, content = set(), [k for k, (x, _) in enumerate(blocks) if kind[x] != "never"]
        for _, other in sides:
            shared = set(common(texts, [t.strip() for _, t in other])) & set(content)
            if sum(len(texts[k]) for k in shared) < pages.MIRROR * sum(len(texts[k]) for k in content):
                gone = {k for k in shared if kind[blocks[k][0]] != "article"}
                break
        left = [(texts[k], kind[blocks[k][0]]) for k in content if k not in gone]
        size = {x: sum(len(t) for t, y in left if (y == "article") == x) for x in (True, False)}
        wanted = {"main", "article" if size[True] >= size[False] else "open"}
        want.append("\n\n".join(t for t, x in left if x in wanted))
    html = [(url, "".join(f"<{x}>{t}</{x}>" for x, t in blocks)) for url, blocks in found]
    got = page_texts(spark, html)
    differ = [k for k in range(len(found)) if got[k] != want[k]]
    # of several longest subsequences any may be taken: the kept text is then as long
    assert len(differ) <= 2 and all(len(got[k]) == len(want[k]) for k in differ), [(got[k], want[k]) for k in differ]
    assert sum(bool(w) for w in want) > 30


def test_common_lines_are_longest():
    rng = random.Random(3)
    for _ in range(400):
        a, b = ([rng.randrange(6) for _ in range(rng.randrange(14))] for _ in range(2))
        best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for x in range(len(a)):
            for y in range(len(b)):
                best[x + 1][y + 1] = best[x][y] + 1 if a[x] == b[y] else max(best[x][y + 1], best[x + 1][y])
        found = pages.common_lines(a, b)
        left = iter(b)
        assert len(found) == best[-1][-1] and all(any(a[k] == y for y in left) for k in found)


@pytest.mark.parametrize("limit", [leaks.WORDS, 40])
def test_leaks_equal_all_windows(spark, sample_dir, odd_docs, limit):
    rng = random.Random(5)
    vocabulary = ["a", "b", "c", "É", "9x"]
    items = [(k, " ".join(rng.choices(vocabulary, k=rng.choice([1, 3, 4, 10, 11, 14])))) for k in range(12)] + [(50, None), (51, ""), (52, "-- !"), (None, "a b")]
    texts = [(k, " ".join(rng.choices(vocabulary, k=rng.randrange(120))).replace("b a", "B--a")) for k in range(150)]
    cases = [(spark.createDataFrame(texts, "doc_id bigint, text string"), spark.createDataFrame([i for i in items if i[0] != 3], "item_id bigint, text string"))]
    real = (spark.read.parquet(f"{sample_dir}/documents.parquet"), spark.read.parquet(f"{sample_dir}/benchmark.parquet"))
    cases += [real, (odd_docs, real[1])]
    for docs, bench in cases:
        # an item without an id marks hits, but no document names it
        known = brute.windows([(r.item_id, r.text) for r in bench.collect()])
        want = sorted((r.doc_id or -1, *brute.leaks(r.text, known)[:2], tuple(sorted(brute.leaks(r.text, known)[2] - {None}))) for r in docs.select("doc_id", "text").collect())
        got = leaks.scanned(docs, bench, limit=limit).collect()
        assert sorted((r.doc_id or -1, r.n_words, r.n_hit, tuple(r["items"])) for r in got) == want


def test_spans_are_cut_out(spark):
    item = "zero one two three four five six seven eight nine ten"
    docs = spark.createDataFrame([(1, f"Ünter uns: {item}! und weiter geht es mit vielen anderen worten heute", 7), (2, item, 8), (3, None, 9), (4, "clean", 1)], "doc_id bigint, text string, n_hit int")
    bench = spark.createDataFrame([(1, item)], "item_id bigint, text string")
    got = {r.doc_id: r for r in leaks.decontaminated(docs, bench).collect()}
    assert set(got) == {1, 3, 4} and got[3].text is None and got[1].asDict().keys() == {"doc_id", "text", "n_hit"}
    assert got[1].text == "Ünter uns:  ! und weiter geht es mit vielen anderen worten heute" or got[1].text.split() == "Ünter uns: ! und weiter geht es mit vielen anderen worten heute".split()
    none = leaks.decontaminated(docs, bench.where("false"))
    assert none.count() == 4


def test_exact_copies_equal_sql(spark, odd_docs, no_docs, monkeypatch):
    monkeypatch.setattr(exact, "SHARD", 3)
    rng = random.Random(6)
    made = [(k, "".join(rng.choices(["a", "b", " ", "\n", " ", "\x0b"], k=rng.randrange(6)))) for k in range(400)]
    for docs in (spark.createDataFrame(made, "doc_id bigint, text string"), odd_docs.select("doc_id", "text"), no_docs.select("doc_id", "text")):
        con = duckdb.connect()
        con.register("documents", docs.toPandas().astype({"doc_id": "Int64"}))
        order = queries.ORACLE["op10_exact_dedup"]
        want = sorted((r[0] is None, r[0] or 0, r[1] or 0, r[2], r[4]) for r in con.execute(order).fetchall())
        for history in (F.col("doc_id") < 150, F.lit(False), F.lit(True)):
            got = exact.exact_dedup(docs, history).collect()
            assert sorted((r.doc_id is None, r.doc_id or 0, r.keep_id or 0, r.group_size, r.text_sha256) for r in got) == want


def test_strangers_are_told_from_members(spark):
    old = exact.winners(exact.digests(spark.range(2000).selectExpr("id as doc_id", "concat('old', id) as text")))
    new = exact.winners(exact.digests(spark.range(4000).selectExpr("id as doc_id", "concat(if(id < 1000, 'old', 'new'), id) as text")))
    found = exact.lookup(exact.build_index(old, 3), new, 3)
    assert found.count() == 4000 and found.where("old_id is not null").count() == 1000


@pytest.mark.parametrize("history", [0, 1])
def test_exact_dedup_of_a_short_history_is_dealt_to_many_shards(spark, monkeypatch, history):
    monkeypatch.setattr(exact, "SHARD", 20)
    most, lookup = [], exact.lookup

    def watched(index, new, shards):
        most.append(new.groupBy(exact.shard_of(shards)).count().agg(F.max("count")).first()[0])
        return lookup(index, new, shards)

    monkeypatch.setattr(exact, "lookup", watched)
    docs = spark.createDataFrame([(k, f"text {k % 600}") for k in range(1000)], "doc_id bigint, text string")
    got = {r.doc_id: (r.keep_id, r.group_size, r.kept) for r in exact.exact_dedup(docs, F.col("doc_id") < history).collect()}
    assert got == {k: (k % 600, 2 if k % 600 < 400 else 1, k < 600) for k in range(1000)}
    assert most[0] < 60
