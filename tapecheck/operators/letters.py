"""Validation of wire records, and the table of what was dropped and why."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tapecheck.functions.numbers import price_of, volume_of
from tapecheck.functions.timecols import fits_key, text as time_text, utc_now
from tapecheck.schema import WIRE_TRADE
from tapecheck.sources.frames import is_blank

# Payload length kept, mark of a cut payload, sample length in the summary.
PAYLOAD_CHARS = 2000
CUT_MARK = "…(truncated)"
SAMPLE_CHARS = 200

_WIRE = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in WIRE_TRADE.fields) + ", _bad STRING"


def truncated(text: Column, chars: int = PAYLOAD_CHARS) -> Column:
    t = F.coalesce(text, F.lit(""))
    return F.when(F.length(t) > chars, F.concat(F.substring(t, 1, chars), F.lit(CUT_MARK))).otherwise(t)


def classify(records: DataFrame, value: str = "value") -> DataFrame:
    """Parse wire JSON once and give every record a ``reason``: NULL when it is a good trade.

    The first rule that matches wins. Records without a value are skipped. Numbers that are not
    numbers are caught here too, before the record fans out to the archive and the fold; so are numbers in
    the millisecond that the packed order key cannot hold (negative, or 2^20 and more), because a fold that met one would
    fail on it again after every restart. A missing number in the millisecond counts as 0.
    """
    r = records.filter(F.col(value).isNotNull()).withColumn("value_text", F.col(value).cast("string"))
    parsed = F.from_json("value_text", _WIRE, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"})
    numbers = {"price_n": price_of(F.col("t.price")), "volume_n": volume_of(F.col("t.volume"))}
    # The generators keep the parse and the number conversion from being copied into every filter.
    r = r.select("*", F.explode(F.array(parsed)).alias("t"))
    r = r.select("*", F.inline(F.array(F.struct(*[c.alias(k) for k, c in numbers.items()]))))
    reason = (
        F.when(F.col("t").isNull() | F.col("t._bad").isNotNull(), "malformed-json")
        .when(is_blank(F.col("t.symbol")), "missing-symbol")
        .when(is_blank(F.col("t.price")) | is_blank(F.col("t.volume")) | F.col("t.event_ms").isNull(), "missing-field")
        .when(F.col("price_n").isNull() | F.col("volume_n").isNull() | ~fits_key("t.seq_in_ms"), "malformed-number")
    )
    return r.withColumn("reason", reason)


def good_trades(classified: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Valid records as typed trades with their log coordinates (-1 when unknown); a missing number in the millisecond is 0."""
    have = classified.columns

    def coordinate(name: str, source: str, dtype: str) -> Column:
        return (F.col(source) if source in have else F.lit(-1)).cast(dtype).alias(name)

    return classified.filter(F.col("reason").isNull()).select(
        "t.symbol", "t.event_ms", F.coalesce("t.seq_in_ms", F.lit(0)).alias("seq_in_ms"), "t.ingest_ms",
        F.col("price_n").alias("price"), F.col("volume_n").alias("volume"),
        "t.currency", "t.conn_id", "t.recv_seq",
        coordinate("kafka_partition", "partition", "int"), coordinate("kafka_offset", "offset", "bigint"),
        *(keep or []),
    )


def dead_letters(classified: DataFrame, job_run: str, seen_at: Column | None = None) -> DataFrame:
    """Dropped records with their reason and (cut) payload."""
    known = F.when(F.col("reason").isin("missing-field", "malformed-number"), F.col("t.symbol")).otherwise(F.lit(""))
    return classified.filter(F.col("reason").isNotNull()).select(
        (seen_at if seen_at is not None else utc_now()).alias("seen_at"),
        F.lit("deserialize").alias("stage"),
        "reason",
        F.coalesce(known, F.lit("")).alias("symbol"),
        truncated(F.col("value_text")).alias("payload"),
        F.lit(job_run).alias("job_run"),
    )


def late_payload() -> Column:
    """A late trade in the dead-letter table: its fields as JSON, prices as text."""
    text = [F.col(c).cast("string").alias(c) for c in ("price", "volume")]
    return F.to_json(F.struct("event_ms", "seq_in_ms", *text, "conn_id", "recv_seq"))


def late_letters(late: DataFrame, job_run: str, seen_at: Column) -> DataFrame:
    return late.select(
        seen_at.alias("seen_at"), F.lit("window").alias("stage"), F.lit("late-window").alias("reason"),
        F.coalesce("symbol", F.lit("")).alias("symbol"), truncated(late_payload()).alias("payload"),
        F.lit(job_run).alias("job_run"),
    )


def dead_letter_summary(letters: DataFrame) -> DataFrame:
    """Per stage and reason: how many, how many symbols, when, and one sample (the earliest, so
    that every run shows the same).

    Counts are reduced per (stage, reason, symbol) first, so a reason that makes up most of the table is spread
    over tasks. All values of that step are numbers, which keeps it a hash aggregate; the sample comes from the few
    letters that were seen first, by a join with one row per (stage, reason).
    """
    key = ["stage", "reason"]
    per_symbol = letters.groupBy(*key, "symbol").agg(
        F.count(F.lit(1)).alias("n"), F.min("seen_at").alias("t0"), F.max("seen_at").alias("t1")
    )
    whole = per_symbol.groupBy(*key).agg(
        F.sum("n").alias("dropped"), F.count(F.lit(1)).alias("symbols"), F.min("t0").alias("t0"), F.max("t1").alias("t1")
    )
    sample = F.substring("payload", 1, SAMPLE_CHARS).alias("sample")
    early = letters.select(*[F.col(c).alias(f"_{c}") for c in key], F.col("seen_at").alias("_seen_at"), sample)
    first = Window.partitionBy(*key).orderBy("sample")
    return (
        whole.join(early, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in key] + [F.col("t0").eqNullSafe(F.col("_seen_at"))])
        .withColumn("_n", F.row_number().over(first))
        .where("_n = 1")
        .select(*key, "dropped", "symbols", time_text("t0").alias("first_seen"), time_text("t1").alias("last_seen"), "sample")
    )
