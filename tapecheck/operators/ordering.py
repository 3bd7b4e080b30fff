"""Arrival order: numbering, disorder, lag, per-record watermarks and skew."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from tapecheck.functions.timecols import bucket_start, wall_clock
from tapecheck.operators.scan import max_before, number_within, ordered_scan, rows_before, sum_before
from tapecheck.settings import HOUR_MS, MINUTE_MS

# Upper bounds in seconds of the source-lag histogram.
LAG_BUCKETS = [0.05, 0.1, 0.25, 0.5, 1.0, 2.0, 5.0, 10.0, 30.0]


def sequence_in_ms(trades: DataFrame, tie: str, rows_per_slice: int | None = None) -> DataFrame:
    """0-based number of a trade within its (symbol, millisecond), in arrival order. Counting per
    millisecond keeps keys unique even when an older millisecond re-appears later."""
    return number_within(
        trades.drop("seq_in_ms"), ["symbol"], "event_ms", ["ingest_ms", tie], "seq_in_ms", rows_per_slice
    )


def out_of_order(trades: DataFrame, tie: str, rows_per_slice: int | None = None) -> DataFrame:
    """Flag trades older than the newest already-arrived trade of their symbol."""
    scanned = ordered_scan(
        trades, ["symbol"], ["ingest_ms", tie], [max_before("max_before_ms", "event_ms")], rows_per_slice=rows_per_slice
    )
    return scanned.withColumns(
        {
            "out_of_order": F.coalesce(F.col("event_ms") < F.col("max_before_ms"), F.lit(False)).cast("int"),
            "behind_ms": F.coalesce(F.greatest(F.col("max_before_ms") - F.col("event_ms"), F.lit(0)), F.lit(0)).cast("bigint"),
        }
    )


def disorder_report(flagged: DataFrame, over_ms: int = MINUTE_MS) -> DataFrame:
    return flagged.groupBy("symbol").agg(
        F.count(F.lit(1)).alias("trades"),
        F.sum("out_of_order").cast("bigint").alias("out_of_order"),
        F.count_if(F.col("behind_ms") > over_ms).alias("over_limit"),
        F.max("behind_ms").alias("max_behind_ms"),
    )


def watermarked(
    trades: DataFrame, tie: str, partitions: int = 1, partition_col: str = "kafka_partition",
    rows_per_slice: int | None = None,
) -> DataFrame:
    """The event-time progress each record meets on arrival: the newest event time seen earlier,
    as the minimum over the partitions (none until every partition has shown a record)."""
    names = [f"_p{p}" for p in range(partitions)]
    measures = [
        max_before(n, F.when(F.pmod(F.col(partition_col), F.lit(partitions)) == p, F.col("event_ms")))
        for p, n in enumerate(names)
    ]
    scanned = ordered_scan(trades, [], ["ingest_ms", tie], measures, rows_per_slice=rows_per_slice)
    low = F.col(names[0])
    for n in names[1:]:
        low = F.when(low.isNotNull() & F.col(n).isNotNull(), F.least(low, F.col(n)))
    return scanned.withColumn("progress_ms", low.cast("bigint")).drop(*names)


def late_flag(window_ms: int, delay_ms: int, lateness_ms: int = 0):
    """True when the record's window is already closed for good when the record arrives."""
    window_end = bucket_start("event_ms", window_ms) + window_ms
    return F.coalesce(window_end + lateness_ms <= F.col("progress_ms") - delay_ms, F.lit(False))


def watermark_sweep(
    trades: DataFrame, tie: str, window_ms: int, delays_ms: list[int], partition_counts: list[int],
    rows_per_slice: int | None = None,
) -> DataFrame:
    """Late records per (delay, partition count) on the same input. One scan per partition count;
    all delays are counted in the same pass."""
    parts = []
    for p in partition_counts:
        w = watermarked(trades, tie, p, rows_per_slice=rows_per_slice)
        counts = w.agg(
            F.count(F.lit(1)).alias("trades"),
            *[F.count_if(late_flag(window_ms, d)).alias(f"d{d}") for d in delays_ms],
        )
        rows = F.explode(
            F.array(*[F.struct(F.lit(d).cast("bigint").alias("delay_ms"), F.col(f"d{d}").alias("late")) for d in delays_ms])
        )
        parts.append(
            counts.select("trades", rows.alias("r")).select(
                F.lit(p).cast("bigint").alias("partitions"), "r.delay_ms", "trades", "r.late"
            )
        )
    out = parts[0]
    for x in parts[1:]:
        out = out.unionByName(x)
    return out


def with_offsets(trades: DataFrame, tie: str, rows_per_slice: int | None = None) -> DataFrame:
    """Number records per partition in arrival order, as a log would."""
    return ordered_scan(
        trades, ["kafka_partition"], ["ingest_ms", tie], [rows_before("kafka_offset")], rows_per_slice=rows_per_slice
    )


def lag_histogram(trades: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Cumulative bucket counts of the source lag (ingest - event, negative lags count as 0)."""
    lag_s = F.greatest(F.col("ingest_ms") - F.col("event_ms"), F.lit(0)) / F.lit(1000.0)
    counts = trades.groupBy(*(keys or [])).agg(
        F.count(F.lit(1)).alias("total"),
        *[F.count_if(lag_s <= b).alias(f"b{i}") for i, b in enumerate(LAG_BUCKETS)],
    )
    buckets = [F.struct(F.lit(b).alias("le"), F.col(f"b{i}").alias("n")) for i, b in enumerate(LAG_BUCKETS)]
    buckets.append(F.struct(F.lit(float("inf")).alias("le"), F.col("total").alias("n")))
    return counts.select(*(keys or []), F.explode(F.array(*buckets)).alias("b")).select(*(keys or []), "b.le", "b.n")


def lag_quantiles(trades: DataFrame, quantiles: list[float], keys: list[str] | None = None) -> DataFrame:
    """Quantiles by linear interpolation inside the histogram bucket that holds the rank; ranks
    above the last bound report the last bound. State is a dozen counters per key."""
    keys = keys or []
    lag_s = F.greatest(F.col("ingest_ms") - F.col("event_ms"), F.lit(0)) / F.lit(1000.0)
    counts = trades.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("total"),
        *[F.count_if(lag_s <= b).alias(f"b{i}") for i, b in enumerate(LAG_BUCKETS)],
    )

    def at(q: float):
        rank = F.lit(q) * F.col("total")
        out = F.when(F.lit(False), F.lit(0.0))
        low, below = 0.0, F.lit(0)
        for i, b in enumerate(LAG_BUCKETS):
            n = F.col(f"b{i}")
            out = out.when(n >= rank, F.lit(low) + F.lit(b - low) * (rank - below) / F.nullif(n - below, F.lit(0)))
            low, below = b, n
        return out.otherwise(F.lit(LAG_BUCKETS[-1]))

    return counts.select(*keys, "total", *[at(q).alias(f"p{int(q * 100)}") for q in quantiles])


def clock_ahead(trades: DataFrame, rows_per_slice: int | None = None) -> DataFrame:
    """Per hour: trades that arrived before they happened, the largest skew and the exact median
    of the signed lag.

    The median works on (hour, lag) counts, which the map side already shrinks; ranks inside an
    hour come from the sliced running sum, so a crowded hour is spread over tasks as well.
    """
    base = trades.select(
        bucket_start("ingest_ms", HOUR_MS).alias("hour_ms"), (F.col("ingest_ms") - F.col("event_ms")).alias("lag_ms")
    )
    per_value = base.groupBy("hour_ms", "lag_ms").agg(F.count(F.lit(1)).alias("n"))
    totals = per_value.groupBy("hour_ms").agg(
        F.sum("n").alias("trades"),
        F.sum(F.when(F.col("lag_ms") < 0, F.col("n")).otherwise(0)).alias("ahead"),
        F.greatest(-F.min("lag_ms"), F.lit(0)).alias("max_skew_ms"),
    )
    ranked = ordered_scan(per_value, ["hour_ms"], ["lag_ms"], [sum_before("before", "n")], rows_per_slice=rows_per_slice)
    lo, hi = F.expr("(trades + 1) div 2"), F.expr("(trades + 2) div 2")
    holds = lambda r: (F.col("before") < r) & (F.col("before") + F.col("n") >= r)
    medians = (
        ranked.join(totals, "hour_ms")
        .filter(holds(lo) | holds(hi))
        .groupBy("hour_ms", "trades", "ahead", "max_skew_ms")
        .agg(((F.min("lag_ms") + F.max("lag_ms")) / F.lit(2.0)).alias("median_lag_ms"))
    )
    return medians.select(
        wall_clock("hour_ms").alias("hour"), "trades", "ahead",
        (F.col("ahead") / F.col("trades").cast("double")).alias("ahead_share"),
        F.col("max_skew_ms").cast("bigint").alias("max_skew_ms"), "median_lag_ms",
    )


def partition_skew(trades: DataFrame) -> DataFrame:
    """Records and active keys per partition. The number of keys is the ceiling for keyed
    scale-out; the share shows the hot partition."""
    per_key = trades.groupBy("kafka_partition", "symbol").agg(F.count(F.lit(1)).alias("n"))
    per_part = per_key.groupBy("kafka_partition").agg(
        F.sum("n").alias("records"), F.count(F.lit(1)).alias("active_keys"), F.max("n").alias("largest_key")
    )
    # One row per log partition, so the unpartitioned window only ever sees a handful of rows.
    all_records = F.sum("records").over(Window.partitionBy())
    return per_part.select(
        "kafka_partition", "records", (F.col("records") / all_records.cast("double")).alias("share"),
        "active_keys", "largest_key",
    )


def trades_per_window(trades: DataFrame, window_ms: int = MINUTE_MS) -> DataFrame:
    return (
        trades.groupBy("symbol", bucket_start("event_ms", window_ms).alias("window_ms"))
        .agg(F.count(F.lit(1)).alias("trades"))
        .select("symbol", wall_clock("window_ms").alias("window_start"), "trades")
    )
