"""From raw documents to a training mix: five stages, each written as Parquet before the next one reads it.

Each stage takes (spark, docs, sf_dir) and returns a table; all but the last return the columns of
``documents``. The rows that a stage drops are gone for the stages after it.

All stages: rows with nulls in any column pass like others (a null text is an empty one, a null doc_id is a document of its own text);
repeated rows are one document that appears several times, until near_dedup keeps one of them; very long texts are read
whole; an empty table gives an empty table; columns beyond those of ``documents`` are dropped by the first stage.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapecheck.llm import copies, leaks, lines, mixing, quality
from tapecheck.llm.tables import DOCUMENT, stored, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _counted(docs: DataFrame) -> DataFrame:
    """The columns of ``documents``, with n_chars of the text as it is now."""
    return docs.withColumn("n_chars", F.coalesce(F.char_length("text").cast("bigint"), "n_chars")).select(*DOCUMENT)


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the positive-unlabelled scorer rejects go. Empty texts are scored too; equal texts get equal scores."""
    return quality.accepted(docs, table(spark, sf_dir, "labels")).select(*DOCUMENT)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of lines that are alike the one of the smallest (doc_id, position) stays; documents of which nothing is left go, but
    those that came empty stay."""
    return _counted(lines.line_dedup(docs, drop_emptied=True))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates stays: that of the smallest doc_id, null first. Texts without words are like no other."""
    return copies.near_dedup(docs).select(*DOCUMENT)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of benchmark items are cut out, also of items without an id; documents more than half of whose words are hit go."""
    return _counted(leaks.decontaminated(docs, table(spark, sf_dir, "benchmark")))


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample by calibrated probabilities, with each document's topic and probability. A null source or language is a category of its own."""
    return mixing.mixed(docs).where("kept").select(*DOCUMENT, "n_tokens", "topic", "probability")


STAGES: list[tuple[str, Stage]] = [
    ("quality_filter", quality_filter),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("source_mixing", source_mixing),
]

#: SQL cannot express the fits of the first and the last stage nor the signatures of the second and
#: the third; ``tests/llm`` holds the pipeline against brute force instead.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
