"""OHLCV candles: the fold, its mergeable partials, sessions and gap filling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tapecheck.functions.numbers import volume_sum
from tapecheck.functions.timecols import arrival_key, bucket_start, each_window, epoch_ms, wall_clock, wide_arrival_key
from tapecheck.operators.scan import last_before, max_before, ordered_scan, sum_upto


def _fold(order: Column) -> list[Column]:
    return [
        F.min_by("price", order).alias("open"),
        F.max("price").alias("high"),
        F.min("price").alias("low"),
        F.max_by("price", order).alias("close"),
        volume_sum().alias("volume"),
        F.count(F.lit(1)).alias("trade_count"),
    ]


def candles(
    trades: DataFrame,
    window_ms: int,
    run_id: str | None = None,
    exact_ties: bool = False,
    wide_numbers: bool = False,
) -> DataFrame:
    """One row per (symbol, window). Arrival order does not matter: open and close follow
    (event_ms, seq_in_ms).

    The key is one BIGINT, so both the map-side and the final step are hash aggregates and a
    hot symbol shrinks to one partial row per window before the shuffle. ``exact_ties`` adds
    the price to the key for inputs whose (event_ms, seq_in_ms) is not unique per symbol, so
    that re-runs agree there too (lowest price opens, highest closes). ``wide_numbers`` is for numbers in
    the millisecond of 2^20 and more, which the packed key refuses.
    """
    if exact_ties and wide_numbers:
        raise ValueError("one of exact_ties and wide_numbers")
    key = (wide_arrival_key if wide_numbers else arrival_key)("event_ms", "seq_in_ms")
    if exact_ties:
        key = (
            key.cast("decimal(19,0)") * F.lit(10**18).cast("decimal(19,0)")
            + (F.col("price") * 10_000).cast("decimal(18,0)")
        )
    out = (
        trades.groupBy("symbol", bucket_start("event_ms", window_ms).alias("window_ms"))
        .agg(*_fold(key))
        .select("symbol", wall_clock("window_ms").alias("window_start"),
                "open", "high", "low", "close", "volume", "trade_count")
    )
    return out if run_id is None else out.withColumn("run_id", F.lit(run_id))


def partial_candles(trades: DataFrame, window_ms: int, also: list[Column] | None = None) -> DataFrame:
    """Candles that can still be merged: they keep the keys of their first and last trade."""
    key = arrival_key("event_ms", "seq_in_ms")
    return trades.groupBy("symbol", bucket_start("event_ms", window_ms).alias("window_ms")).agg(
        F.min(key).alias("open_key"), F.max(key).alias("close_key"), *_fold(key), *(also or [])
    )


def merge_partials(partials: DataFrame, window_ms: int | None = None, also: list[Column] | None = None) -> DataFrame:
    """Combine partials of the same window; a larger ``window_ms`` rolls them up."""
    width = F.col("window_ms") if window_ms is None else bucket_start("window_ms", window_ms)
    return partials.groupBy("symbol", width.alias("window_ms")).agg(
        F.min("open_key").alias("open_key"),
        F.max("close_key").alias("close_key"),
        F.min_by("open", "open_key").alias("open"),
        F.max("high").alias("high"),
        F.min("low").alias("low"),
        F.max_by("close", "close_key").alias("close"),
        F.sum("volume").cast("decimal(18,8)").alias("volume"),
        F.sum("trade_count").alias("trade_count"),
        *(also or []),
    )


def finish_partials(partials: DataFrame, run_id: str | None = None) -> DataFrame:
    out = partials.select(
        "symbol", wall_clock("window_ms").alias("window_start"),
        "open", "high", "low", "close", "volume", "trade_count",
    )
    return out if run_id is None else out.withColumn("run_id", F.lit(run_id))


def session_candles(trades: DataFrame, gap_ms: int, rows_per_slice: int | None = None) -> DataFrame:
    """The same fold over sessions that end after a quiet gap.

    Trades that share a time cell of the gap's width are less than a gap apart and so belong to
    one session. They are folded per cell first (map-side combine), and only cells are linked to
    sessions: a busy symbol contributes at most one row per cell, however many trades it has.
    """
    cells = partial_candles(trades, gap_ms, also=[
        F.min("event_ms").alias("first_ms"), F.max("event_ms").alias("last_ms"),
    ])
    linked = ordered_scan(
        cells, ["symbol"], ["window_ms"], [max_before("previous_ms", "last_ms")], rows_per_slice=rows_per_slice
    )
    opens = F.coalesce(F.col("first_ms") - F.col("previous_ms") > gap_ms, F.lit(True)).cast("bigint")
    numbered = ordered_scan(
        linked.withColumn("opens", opens), ["symbol"], ["window_ms"], [sum_upto("session", "opens")],
        rows_per_slice=rows_per_slice,
    )
    return numbered.groupBy("symbol", "session").agg(
        F.min("first_ms").alias("a"),
        F.max("last_ms").alias("b"),
        F.min_by("open", "open_key").alias("open"),
        F.max("high").alias("high"),
        F.min("low").alias("low"),
        F.max_by("close", "close_key").alias("close"),
        F.sum("volume").cast("decimal(18,8)").alias("volume"),
        F.sum("trade_count").alias("trade_count"),
    ).select(
        "symbol", wall_clock("a").alias("session_start"), wall_clock(F.col("b") + gap_ms).alias("session_end"),
        "open", "high", "low", "close", "volume", "trade_count",
    )


def fill_quiet_windows(candle_rows: DataFrame, window_ms: int) -> DataFrame:
    """Add the rows an exchange would print for windows without trades: volume 0, all prices
    equal to the previous close. Only between a symbol's first and last candle."""
    c = candle_rows.withColumn("window_ms", epoch_ms("window_start"))
    linked = ordered_scan(
        c, keys=["symbol"], order=["window_ms"],
        measures=[last_before("prev_ms", "window_ms"), last_before("prev_close", "close")],
    )
    silent = linked.filter(F.col("window_ms") - F.col("prev_ms") > window_ms).select(
        "symbol", "prev_close", (F.col("prev_ms") + window_ms).alias("first_ms"), (F.col("window_ms") - window_ms).alias("last_ms")
    )
    quiet = (
        each_window(silent, "first_ms", "last_ms", window_ms, "window_ms")
        .select(
            "symbol", wall_clock("window_ms").alias("window_start"),
            F.col("prev_close").alias("open"), F.col("prev_close").alias("high"),
            F.col("prev_close").alias("low"), F.col("prev_close").alias("close"),
            F.lit(0).cast("decimal(18,8)").alias("volume"), F.lit(0).cast("bigint").alias("trade_count"),
            F.lit(1).alias("filled"),
        )
    )
    have = candle_rows.select(
        "symbol", "window_start", "open", "high", "low", "close", "volume", "trade_count", F.lit(0).alias("filled")
    )
    return have.unionByName(quiet)
