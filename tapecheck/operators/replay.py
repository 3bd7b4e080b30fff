"""Replaying stored trades: bounded scan, time shift, injected lateness and copies, schedule."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, functions as F

from tapecheck.operators import letters as lt
from tapecheck.operators.scan import max_before, measure_slices, ordered_scan, rows_before, sum_upto


def arrival_range(
    trades: DataFrame, tie: str, skip: int = 0, take: int | None = None, conn_id: str | None = None,
    rows_per_slice: int | None = None,
) -> DataFrame:
    """Skip N, take M in arrival order. Ranks come from the sliced scan and the range is a filter;
    a global sort with offset and limit would push skip + take rows through one task."""
    df = trades if conn_id is None else trades.filter(F.col("conn_id") == conn_id)
    ranked = ordered_scan(df, [], ["ingest_ms", tie], [rows_before("arrival")], rows_per_slice=rows_per_slice)
    keep = F.col("arrival") >= skip
    if take is not None:
        keep = keep & (F.col("arrival") < skip + take)
    return ranked.filter(keep)


def scan_records(records: DataFrame, store: str) -> dict[str, int]:
    """Read topic records once, write the good trades to ``store``, and count what was met on the way.

    The counts are observed in the scan that writes, so the log is read once however many counters there are.
    """
    seen = Observation("records")
    classified = lt.classify(records).observe(
        seen,
        F.count(F.lit(1)).alias("records"),
        F.count_if(F.col("reason").isNull()).alias("good"),
        F.count_if(F.col("reason") == "malformed-json").alias("malformed"),
        F.count_if(F.col("reason").isNotNull() & (F.col("reason") != "malformed-json")).alias("unusable"),
    )
    lt.good_trades(classified).write.mode("overwrite").parquet(store)
    return dict(seen.get)


def inject_late(trades: DataFrame, key: str, late_permille: int, late_max_s: int) -> DataFrame:
    """Move the event time of a share of the trades back by 1 to ``late_max_s`` seconds. Which
    ones is a function of the key, so every re-run and every engine picks the same."""
    k = F.col(key)
    chosen = F.pmod(k * 7919, F.lit(1000)) < late_permille
    back_ms = (F.pmod(k * 104729, F.lit(late_max_s)) + 1) * 1000
    return trades.withColumns(
        {
            "late_injected": chosen.cast("int"),
            "event_ms": F.when(chosen, F.col("event_ms") - back_ms).otherwise(F.col("event_ms")),
        }
    )


def inject_copies(trades: DataFrame, key: str, copy_permille: int) -> DataFrame:
    """Deliver a share of the trades twice, unchanged."""
    twice = F.pmod(F.col(key) * 15485863, F.lit(1000)) < copy_permille
    return trades.withColumn(
        "delivery", F.explode(F.when(twice, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    )


def shift_to(trades: DataFrame, tie: str, target_ms: int, conn_id: str, rows_per_slice: int | None = None) -> DataFrame:
    """Move the earliest event to ``target_ms`` keeping all spacing, under a new connection whose
    receive numbers follow arrival order."""
    first = trades.agg(F.min("event_ms")).first()[0]
    ranked = ordered_scan(trades, [], ["ingest_ms", tie], [rows_before("_rank")], rows_per_slice=rows_per_slice)
    return ranked.withColumns(
        {
            "event_ms": F.col("event_ms") + F.lit(target_ms - (first or 0)),
            "conn_id": F.lit(conn_id),
            "recv_seq": F.col("_rank") + 1,
        }
    ).drop("_rank")


def replay_schedule(
    trades: DataFrame, tie: str, max_gap_ms: int, speed: float = 1.0, rows_per_slice: int | None = None
) -> DataFrame:
    """When to send each trade, as milliseconds after the first: original arrival spacing with
    silences longer than ``max_gap_ms`` shortened to it, divided by the speed."""
    order = ["ingest_ms", tie]
    slices = measure_slices(trades, order, rows_per_slice)
    # In arrival order the previous arrival is also the newest one so far.
    linked = ordered_scan(trades, [], order, [max_before("prev_ms", "ingest_ms")], slices)
    gap: Column = F.least(F.coalesce(F.col("ingest_ms") - F.col("prev_ms"), F.lit(0)), F.lit(max_gap_ms))
    summed = ordered_scan(linked.withColumn("gap_ms", gap.cast("bigint")), [], order, [sum_upto("offset_ms", "gap_ms")], slices)
    return summed.withColumn("send_at_ms", F.floor(F.col("offset_ms") / F.lit(float(speed))).cast("bigint")).drop("prev_ms")


def in_arrival_order(trades: DataFrame, tie: str) -> DataFrame:
    """Arrival order, not event order: sorting by event time would hide the real disorder."""
    return trades.orderBy("ingest_ms", tie)
