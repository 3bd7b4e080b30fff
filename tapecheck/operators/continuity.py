"""Was anything lost before it reached us? Checks on the raw-trade archive."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tapecheck.functions.timecols import bucket_start, kst_text, text, wall_clock
from tapecheck.operators.scan import last_before, max_before, ordered_scan, sum_before
from tapecheck.settings import MINUTE_MS

# Connection-name prefixes of test producers.
TEST_ORIGINS = ("synth", "replay")


def is_real_origin(conn_id: str = "conn_id") -> Column:
    keep = F.lit(True)
    for prefix in TEST_ORIGINS:
        keep = keep & ~F.col(conn_id).like(f"{prefix}%")
    return keep


def origin_label(conn_id: str = "conn_id") -> Column:
    c = F.col(conn_id)
    return (
        F.when(c.like("synth%"), "synth")
        .when(c.like("replay%"), "replay")
        .otherwise("other")
    )


def _span(alias: str) -> Column:
    return (F.max("recv_seq") - F.min("recv_seq") + 1).alias(alias)


def source_continuity(trades: DataFrame) -> DataFrame:
    """Per connection: a complete sequence has last - first + 1 records. ``gaps`` keeps its
    sign: positive is loss, negative is double delivery."""
    return (
        trades.groupBy("conn_id")
        .agg(
            F.count(F.lit(1)).alias("received"),
            F.min("recv_seq").alias("first_seq"),
            F.max("recv_seq").alias("last_seq"),
            _span("expected"),
            F.min("ingest_ms").alias("t0"),
            F.max("ingest_ms").alias("t1"),
        )
        .select(
            "conn_id", "received", "first_seq", "last_seq", "expected",
            (F.col("expected") - F.col("received")).alias("gaps"),
            F.round(
                (F.col("expected") - F.col("received")) / F.nullif(F.col("expected").cast("double"), F.lit(0.0)) * 100, 4
            ).alias("loss_pct"),
            text(wall_clock("t0")).alias("first_seen"),
            text(wall_clock("t1")).alias("last_seen"),
        )
    )


def loss_by_minute(trades: DataFrame, width_ms: int = MINUTE_MS) -> DataFrame:
    """The same gap count per connection and ingest minute, to see where loss concentrates."""
    return (
        trades.groupBy("conn_id", bucket_start("ingest_ms", width_ms).alias("minute_ms"))
        .agg(F.count(F.lit(1)).alias("received"), _span("expected"))
        .select(
            "conn_id", wall_clock("minute_ms").alias("minute"), "received",
            (F.col("expected") - F.col("received")).alias("gaps"),
        )
    )


def origin_profile(trades: DataFrame) -> DataFrame:
    """Every connection with its price range: a foreign producer shows by its prices even when
    its name does not give it away."""
    return (
        trades.groupBy("conn_id")
        .agg(
            F.count(F.lit(1)).alias("trades"),
            F.countDistinct("symbol").alias("syms"),
            F.round(F.min("price"), 0).cast("bigint").alias("price_min"),
            F.round(F.max("price"), 0).cast("bigint").alias("price_max"),
            F.min("ingest_ms").alias("t0"),
            F.max("ingest_ms").alias("t1"),
        )
        .select(
            "conn_id", origin_label().alias("label"), "trades", "syms", "price_min", "price_max",
            kst_text(wall_clock("t0")).alias("first_kst"), kst_text(wall_clock("t1")).alias("last_kst"),
        )
    )


def connection_spans(trades: DataFrame) -> DataFrame:
    """First and last arrival of every connection."""
    return trades.groupBy("conn_id").agg(F.min("ingest_ms").alias("t0"), F.max("ingest_ms").alias("t1"))


def overlap_count(spans: DataFrame) -> DataFrame:
    """How many pairs of connections overlap, without listing them.

    A pair does not overlap exactly when one of the two ends before the other starts, so the ends
    before each start are counted in one pass over the times and taken off all pairs.
    """
    tie = F.xxhash64("conn_id").alias("tie")
    times = spans.select(F.col("t0").alias("at"), F.lit(0).cast("bigint").alias("ends"), tie).unionByName(
        spans.select(F.col("t1").alias("at"), F.lit(1).cast("bigint").alias("ends"), tie)
    )
    counted = ordered_scan(times, [], ["at", "ends", "tie"], [sum_before("ended", "ends")])
    n = F.count(F.lit(1))
    pairs = (n * (n - 1) / 2).cast("bigint") - F.coalesce(F.sum("ended"), F.lit(0))
    return counted.filter("ends = 0").agg(pairs.alias("overlapping_pairs"))


def connection_overlaps(spans: DataFrame) -> DataFrame:
    """Pairs of connections whose spans overlap.

    Two spans overlap exactly when the later start lies inside the other span, so every start
    is looked up in the spans that cover it: spans are spread over time cells of the mean span
    length (about two cells each), a start lives in one cell, and the join is an equi-join on
    the cell. Each pair is found once, at its later start.
    """
    mean = spans.agg(F.avg(F.col("t1") - F.col("t0")).alias("m")).first().m
    cell = max(1, int(mean or 0))

    def cell_of(c: str) -> Column:
        return F.expr(f"{c} div {cell}")

    cover = spans.select(
        F.col("conn_id").alias("id_1"), F.col("t0").alias("s_1"), F.col("t1").alias("e_1"),
        F.explode(F.sequence(cell_of("t0"), cell_of("t1"))).alias("cell"),
    )
    starts = spans.select(
        F.col("conn_id").alias("id_2"), F.col("t0").alias("s_2"), F.col("t1").alias("e_2"), cell_of("t0").alias("cell")
    )
    later = (F.col("s_2") > F.col("s_1")) | ((F.col("s_2") == F.col("s_1")) & (F.col("id_2") > F.col("id_1")))
    return (
        cover.join(starts, "cell")
        .filter(later & (F.col("s_2") <= F.col("e_1")))
        .select(
            F.least("id_1", "id_2").alias("conn_a"),
            F.greatest("id_1", "id_2").alias("conn_b"),
            kst_text(wall_clock("s_2")).alias("overlap_from"),
            kst_text(wall_clock(F.least("e_1", "e_2"))).alias("overlap_to"),
        )
    )


def connection_gaps(spans: DataFrame, rows_per_slice: int | None = None) -> DataFrame:
    """Silence between one connection's end and the start of the connection that starts next."""
    linked = ordered_scan(
        spans, [], ["t0", "t1"], [last_before("gap_from_ms", "t1")],
        rows_per_slice=rows_per_slice,
    )
    return _gap_rows(linked)


def coverage_gaps(spans: DataFrame, rows_per_slice: int | None = None) -> DataFrame:
    """Times covered by no connection at all. Unlike :func:`connection_gaps` a short connection
    inside a long one does not fake a gap."""
    linked = ordered_scan(
        spans, [], ["t0", "t1"], [max_before("gap_from_ms", "t1")],
        rows_per_slice=rows_per_slice,
    )
    return _gap_rows(linked)


def _gap_rows(linked: DataFrame) -> DataFrame:
    return linked.filter(F.col("t0") > F.col("gap_from_ms")).select(
        F.col("gap_from_ms"), F.col("t0").alias("gap_to_ms")
    )


def gap_report(gaps: DataFrame) -> DataFrame:
    return gaps.select(
        kst_text(wall_clock("gap_from_ms")).alias("gap_start_kst"),
        kst_text(wall_clock("gap_to_ms")).alias("gap_end_kst"),
        F.round((F.col("gap_to_ms") - F.col("gap_from_ms")) / F.lit(1000.0), 3).alias("gap_seconds"),
    )
