"""The queries of this folder: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapecheck.llm import copies, curves, exact, leaks, lines, mixing, pages, periods, private, quality, ranked, tokens, toxicity
from tapecheck.llm.tables import keyed, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of each document's lines: counts and the hash of its text."""
    left = lines.line_dedup(table(spark, sf_dir, "documents"))
    return left.select(
        "doc_id", "n_lines", "n_removed", F.char_length("text").cast("bigint").alias("n_chars"), F.sha2("text", 256).alias("text_sha256")
    )


@query
def op5_pu_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = leaks.scanned(docs, table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        leaks.items_sha256().alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


@query
def op8_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source", "lang")
    return mixing.mixed(docs).drop("text")


@query
def op9_bag_min_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document's class: the doc_id that stands for it and the class's size."""
    own = keyed(table(spark, sf_dir, "documents").select("doc_id", "text"))
    classes = copies.near_duplicates(own)
    return classes.select(
        F.nullif(F.col("k1"), F.lit(-(2**63))).alias("doc_id"),
        F.nullif(F.col("class_k1"), F.lit(-(2**63))).alias("class_id"),
        "class_size",
        (F.col("k1").eqNullSafe(F.col("class_k1")) & (F.col("k2") == F.col("class_k2"))).alias("kept"),
    )


@query
def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first half of the id range is the history, the rest arrives later."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    ends = docs.agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).first()
    middle = None if ends.low is None else (ends.low + ends.high) // 2
    return exact.exact_dedup(docs, F.col("doc_id") <= F.lit(middle).cast("bigint"))


ORACLE["op10_exact_dedup"] = r"""
    WITH d AS (
        SELECT doc_id, length(coalesce(text, '')) AS n,
               sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
        FROM documents
    )
    SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY text_sha256) AS group_size,
           doc_id = first_value(doc_id) OVER w AS kept, text_sha256
    FROM d WINDOW w AS (PARTITION BY text_sha256 ORDER BY n DESC, doc_id)
"""


@query
def op3_nearest_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return tokens.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query
def op6_page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.main_text(table(spark, sf_dir, "pages"))


@query
def op4_candidate_boosting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return private.personal_data(table(spark, sf_dir, "documents"))


@query
def op11_period_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periods.digest(periods.periodic_runs(table(spark, sf_dir, "documents"), planted=True))


@query
def op12_dual_tree_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op13_hilbert_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curves.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def _words(text: str) -> str:
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return rf"regexp_extract_all(translate(coalesce({text}, ''), '{upper}', '{upper.lower()}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


ORACLE["op7_decontamination"] = f"""
    WITH docs AS (SELECT doc_id, {_words("text")} AS w FROM documents),
    items AS (SELECT item_id, {_words("text")} AS w FROM benchmark),
    windows AS (
        SELECT DISTINCT item_id, len(x) AS l, x FROM (
            SELECT item_id, list_slice(w, i, i + least(10, len(w)) - 1) AS x
            FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM items WHERE len(w) > 0))),
    placed AS (
        SELECT doc_id, l, i, list_slice(w, i, i + l - 1) AS x FROM (
            SELECT doc_id, w, l, unnest(range(1, len(w) - l + 2)) AS i
            FROM docs, (SELECT DISTINCT l FROM windows) WHERE len(w) >= l)),
    found AS (SELECT doc_id, i, placed.l AS l, item_id FROM placed JOIN windows USING (x)),
    hits AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + l)) AS p FROM found) GROUP BY 1),
    ids AS (
        SELECT doc_id, count(*) AS n, string_agg(v, ',' ORDER BY v) AS v
        FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS v FROM found WHERE item_id IS NOT NULL) GROUP BY 1)
    SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(hits.n, 0) AS n_hit, coalesce(ids.n, 0) AS n_items,
           sha256(coalesce(ids.v, '')) AS items_sha256, coalesce(hits.n, 0) > 0 AS contaminated
    FROM docs LEFT JOIN hits USING (doc_id) LEFT JOIN ids USING (doc_id)
"""

ORACLE["op12_dual_tree_search"] = f"""
    WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_words("text")} AS w FROM documents),
    total AS (SELECT count(*) FILTER (WHERE len(w) > 0) AS nd, sum(len(w))::BIGINT AS l FROM d),
    tf AS (SELECT r, doc_id, len(w)::BIGINT AS n, term, count(*) AS tf
           FROM (SELECT r, doc_id, w, unnest(w) AS term FROM d) GROUP BY r, doc_id, len(w), term),
    i AS (SELECT row_number() OVER () AS q, item_id, {_words("text")} AS w FROM (SELECT DISTINCT item_id, coalesce(text, '') AS text FROM benchmark)),
    wanted AS (SELECT q, item_id, term, count(*) AS c FROM (SELECT q, item_id, unnest(w) AS term FROM i) GROUP BY ALL),
    weight AS (SELECT term, floor(1000 * ln((2.0::DOUBLE * nd + 2) / (2 * count(*) + 1)))::BIGINT AS wt FROM tf, total GROUP BY term, nd),
    scored AS (
        SELECT q, item_id, r, doc_id, sum(c * wt * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * nd) // l))))::BIGINT AS score
        FROM wanted JOIN weight USING (term) JOIN tf USING (term), total GROUP BY q, item_id, r, doc_id),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id) AS rank FROM scored WHERE score > 0)
    SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM ranked WHERE rank <= 10
"""
