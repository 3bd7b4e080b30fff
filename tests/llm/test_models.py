"""The scorers by held-out accuracy, the neighbour search against all examples, the mix by its marginals, and the pipeline."""

import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tapecheck.llm import copies, mixing, quality, queries, toxicity
from tapecheck.llm.tables import DOCUMENT, keyed
from tests.llm import brute

SF = "/root/testdata/sf0.01"


def read(spark, name):
    return spark.read.parquet(f"{SF}/{name}.parquet")


def test_quality_on_held_out_labels(spark):
    got = quality.scores(read(spark, "documents"), read(spark, "labels")).join(read(spark, "labels"), "doc_id").collect()
    held = [r for r in got if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got)
    assert np.mean([r.predicted == r.quality for r in held]) > 0.93 and all(0 <= r.score <= 1 for r in got)


def test_held_out_labels_change_nothing(spark):
    docs, labels = read(spark, "documents").limit(300), read(spark, "labels")
    flipped = labels.withColumn("quality", F.when(quality.held_out(), 1 - F.col("quality")).otherwise(F.col("quality")))
    flipped = flipped.withColumn("toxic", F.when(toxicity.fold() == 0, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    for scores in (quality.scores, toxicity.scores):
        a, b = ({r.doc_id: r.score for r in scores(docs, x).collect()} for x in (labels, flipped))
        assert a == b


def test_class_prior_is_found():
    rng = np.random.default_rng(0)
    good = rng.normal(0, 1, (3000, quality.MEASURES)).astype(np.float32)
    bad = rng.normal(2.5, 1, (1200, quality.MEASURES)).astype(np.float32)
    mixed = np.concatenate([rng.normal(0, 1, (2800, quality.MEASURES)).astype(np.float32), bad])
    assert abs(quality.class_prior(good, rng.permutation(mixed)) - 0.7) < 0.06


def test_toxicity_on_held_out_labels(spark):
    docs, labels = spark.read.parquet("/root/testdata/sf0.1/documents.parquet"), spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    got = toxicity.scores(docs, labels).join(labels, "doc_id").where("held_out").collect()
    assert all(zlib.crc32(str(r.doc_id).encode()) % 5 == 0 for r in got)
    assert np.mean([r.predicted == r.toxic for r in got]) > 0.95


@pytest.mark.parametrize(("terms", "longest"), [(40, 9), (40_000, 300)])
def test_nearest_equals_all_examples(terms, longest):
    rng = np.random.default_rng(3)
    n = 700
    # frequent and rare words, so that lists of both kinds occur
    words = [np.unique((terms * rng.random(rng.integers(1, longest)) ** 3).astype(int)) for _ in range(n)]
    words[5] = words[6] = words[7]
    words[8] = words[8][:0]
    tf = [rng.integers(1, 4, len(w)) for w in words]
    tf[5] = tf[6] = tf[7]
    weight = rng.random(terms) * (rng.random(terms) > 0.1)
    x = np.zeros((n, terms))
    for k, (w, t) in enumerate(zip(words, tf, strict=True)):
        x[k, w] = (1 + np.log(t)) * weight[w]
    x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)
    index = toxicity.Index(toxicity.Vocabulary(np.arange(terms)), weight, words, tf, rng.integers(0, 2, n), np.arange(n))
    assert (index.long >= 0).any() and ((index.long < 0) & (index.start[1:] > index.start[:-1])).any() or terms == 40
    all_ = (x @ x.T)[:, index.ids]
    similarity, example = index.nearest(n, *index.entries(n, *toxicity.flat(words, tf)))
    assert np.abs(similarity - -np.sort(-all_, axis=1)[:, : toxicity.NEAREST]).max() < 3e-6
    assert np.abs(np.take_along_axis(all_, example, axis=1) - similarity).max() < 3e-6


def test_index_holds_all_words_of_the_examples(spark):
    """Vocabulary, frequencies over all documents, relevance and neighbours against plain counting."""
    docs, labels = read(spark, "documents"), read(spark, "labels")
    docs = docs.union(docs.limit(3))
    index = toxicity.build(docs, labels)
    texts, own = {}, []
    for r in docs.select("doc_id", "text").collect():
        texts[r.doc_id] = r.text or ""
        own.append(Counter(brute.words(r.text)))
    toxic = {r.doc_id: r.toxic for r in labels.collect() if r.doc_id in texts and r.toxic in (0, 1)}
    examples = {k: Counter(brute.words(texts[k])) for k in toxic if zlib.crc32(str(k).encode()) % 5 > 1}
    assert sorted(index.ids.tolist()) == sorted(examples)
    vocabulary = sorted(set().union(*examples.values()))
    assert len(index.weight) == len(vocabulary) > 1000
    df, held, bad = (Counter(w for c in x for w in c) for x in (own, examples.values(), (c for k, c in examples.items() if toxic[k])))
    n, n1 = len(examples), sum(toxic[k] for k in examples)
    weight = {}
    for w in vocabulary:
        spread = held[w] * (n - held[w]) * n1 * (n - n1)
        weight[w] = np.log((len(own) + 1) / (df[w] + 1)) * (abs(n * bad[w] - held[w] * n1) / spread**0.5 if spread else 0)

    def vector(text):
        v = {w: (1 + np.log(t)) * weight[w] for w, t in Counter(brute.words(text)).items() if weight.get(w)}
        length = sum(x * x for x in v.values()) ** 0.5
        return {w: x / length for w, x in v.items()}

    near = {k: vector(texts[k]) for k in examples}
    at = {int(k): j for j, k in enumerate(index.ids)}
    some = sorted(texts)[::9]
    got = {r.doc_id: r for r in toxicity.scores(docs, labels).collect()}
    for k in some:
        v = vector(texts[k])
        best = sorted(((-round(sum(x * y.get(w, 0) for w, x in v.items()), 5), at[e]) for e, y in near.items()))[:15]
        votes = [1 / (1 + min(s, 0) + toxicity.SOFT) for s, _ in best]
        share = sum(x * index.label[j] for x, (_, j) in zip(votes, best, strict=True)) / sum(votes)
        assert abs(index.score(share) - got[k].score) < 0.01
        assert abs(sum(x * near[got[k].evidence[0]].get(w, 0) for w, x in v.items()) + best[0][0]) < 2e-5


@pytest.mark.parametrize("scores", [quality.scores, toxicity.scores])
def test_scorers_take_odd_rows_and_no_labels(spark, odd_docs, no_docs, scores):
    labels = spark.createDataFrame([(1, 1, 0), (4, 0, 1), (5, None, None), (None, 1, 1), (1, 1, 0)], "doc_id bigint, quality int, toxic int")
    for some in (labels, labels.where("false")):
        got = scores(odd_docs, some).collect()
        assert len(got) == odd_docs.count() and all(0 <= r.score <= 1 and r.held_out is not None for r in got)
    assert scores(no_docs, labels).count() == 0


def test_mix_meets_all_marginals(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    targets = {"lang": {"en": 0.4, "de": 0.3}, "source": {"src0": 0.01}}
    rows = mixing.mixed(docs, targets).select("source", "lang", "topic", "n_tokens", "probability", "kept").collect()
    weight = np.array([r.n_tokens * r.probability for r in rows])
    share = lambda pick: weight[[pick(r) for r in rows]].sum() / weight.sum()
    assert abs(share(lambda r: r.lang == "en") - 0.4) < 1e-6 and abs(share(lambda r: r.lang == "de") - 0.3) < 1e-6
    assert abs(share(lambda r: r.source == "src0") - 0.01) < 1e-6
    topics = sorted({r.topic for r in rows})
    tokens = np.array([sum(r.n_tokens for r in rows if r.topic == t) for t in topics]) ** 0.5
    assert np.allclose([share(lambda r, t=t: r.topic == t) for t in topics], tokens / tokens.sum(), atol=1e-6)
    kept = sum(r.n_tokens for r in rows if r.kept)
    assert abs(kept / weight.sum() - 1) < 0.05 and max(r.probability for r in rows) == 1.0
    assert all(r.n_tokens == len(brute.words(t.text)) for r, t in zip(mixing.mixed(docs.limit(50)).orderBy("doc_id").collect(), docs.limit(50).orderBy("doc_id").collect(), strict=True))


@pytest.mark.parametrize("size", [300, 3000])
def test_a_tiny_source_does_not_set_the_size_of_the_mix(spark, size):
    rows = [(k, f"word{k % 7} and word{k % 11} then some more words of text {k}", f"src{k % 3}", "en" if k % 4 else "de") for k in range(size)]
    rows += [(-1, "one document of a source of its own", "single", "en"), (-2, "no source at all in this one", None, "en")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string, lang string")
    got = mixing.mixed(docs).collect()
    total, weight = sum(r.n_tokens for r in got), sum(r.n_tokens * r.probability for r in got)
    assert weight >= 0.499 * total and all(r.probability > 0.999 for r in got if r.doc_id < 0)
    features = docs.mapInArrow(mixing._features, mixing.FEATURES)
    with pytest.warns(UserWarning, match="not reached"):
        made = mixing.plan(features, keep=0.3)
    assert {("source", "single"), ("source", mixing.NONE)} <= {x[:2] for x in made.missed}
    for want in ({"keep": 0.3}, {"budget": 0.3 * total}):
        assert abs(sum(r.n_tokens * r.probability for r in mixing.mixed(docs, **want).collect()) - 0.3 * total) < 1e-4 * total


def test_cells_saturate_and_the_others_take_their_weight():
    rng = np.random.default_rng(4)
    codes = [np.repeat(np.arange(6), 12), np.tile(np.repeat(np.arange(3), 4), 6), np.tile(np.arange(4), 18)]
    tokens = rng.lognormal(5, 2, 72)
    targets = [np.bincount(c, weights=tokens) ** 0.5 for c in codes]
    targets = [t / t.sum() for t in targets]
    for size in (0.05, 0.4, 0.9, 1.0):
        p = mixing.saturated(tokens, codes, targets, size * tokens.sum())
        assert abs((p * tokens).sum() / (size * tokens.sum()) - 1) < 1e-3 and 0 <= p.min() and p.max() <= 1
    assert (p > 1 - 1e-9).all()


def test_mix_of_odd_rows(spark, odd_docs, no_docs):
    got = mixing.mixed(odd_docs).collect()
    assert len(got) == odd_docs.count() and all(0 <= r.probability <= 1 for r in got)
    same = [(r.kept, r.probability) for r in got if r.doc_id == 6]
    assert same[0] == same[1] and mixing.mixed(no_docs).count() == 0
    again = {(r.doc_id, r.kept) for r in mixing.mixed(odd_docs.repartition(5)).collect()}
    assert again == {(r.doc_id, r.kept) for r in got}


def test_contradicting_targets_still_give_weights():
    tokens = np.array([5.0, 3.0])
    w = mixing.rake(tokens, [np.array([0, 1]), np.array([0, 1])], [np.array([0.9, 0.1]), np.array([0.2, 0.8])])
    assert np.isfinite(w).all() and abs(w.sum() - 1) < 1e-9


def test_pipeline_stages(spark):
    docs = read(spark, "documents")
    bench = brute.windows([(r.item_id, r.text) for r in read(spark, "benchmark").collect()])
    for name, stage in corpus_pipeline.STAGES:
        left = stage(spark, docs, SF)
        left = corpus_pipeline.stored(left, name)
        if name != "source_mixing":
            assert left.columns == list(DOCUMENT)
        before, after = {r.doc_id: r.text for r in docs.collect()}, {r.doc_id: r.text for r in left.collect()}
        assert set(after) <= set(before) and after
        if name == "near_dedup":
            assert copies.near_duplicates(keyed(left)).where("class_size > 1").count() == 0
        if name == "decontamination":
            hit = {k for k, t in before.items() if brute.leaks(t, bench)[1]}
            assert not any(brute.leaks(after[k], bench)[1] for k in hit & set(after))
            assert all(after[k] == t for k, t in before.items() if k not in hit)
        docs = left
    assert {"topic", "probability"} <= set(docs.columns)


def test_pipeline_takes_odd_rows(spark, odd_docs, no_docs):
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, odd_docs, SF).count() <= odd_docs.count(), name
        assert stage(spark, no_docs, SF).count() == 0, name


def test_every_operator_has_a_query():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 11))
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_filter", "line_dedup", "near_dedup", "decontamination", "source_mixing"]
