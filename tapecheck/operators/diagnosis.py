"""Why does a window differ? Boundary assignment, source gap, truncation or contamination."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tapecheck.functions.timecols import bucket_start, each_window, wall_clock
from tapecheck.operators.compare import KEY, matched
from tapecheck.operators.continuity import connection_gaps, connection_spans, is_real_origin


def adjacent_symmetry(diffs: DataFrame, window_ms: int) -> DataFrame:
    """Differing windows whose neighbour differs by the same amount with the opposite sign: the
    trades are all there, they sit on the other side of the boundary.

    Neighbours are exactly one window apart, so this is an equi-join on the shifted key and no
    symbol is ever brought to one task.
    """
    d = diffs.filter(F.col("vol_diff") != 0).select(*KEY, "vol_diff")
    step = F.expr(f"INTERVAL {window_ms // 1000} SECONDS")
    nxt = d.select("symbol", (F.col("window_start") - step).alias("window_start"), F.col("vol_diff").alias("next_diff"))
    return d.join(nxt, KEY).filter(F.col("vol_diff") + F.col("next_diff") == 0)


def gap_windows(gaps: DataFrame, window_ms: int) -> DataFrame:
    """The windows each connection gap falls in, with the gap seconds inside that window."""
    rows = each_window(gaps, bucket_start("gap_from_ms", window_ms), bucket_start("gap_to_ms", window_ms), window_ms, "window_ms")
    inside = F.least("gap_to_ms", F.col("window_ms") + window_ms) - F.greatest("gap_from_ms", "window_ms")
    return (
        rows.withColumn("inside_ms", inside)
        .filter(F.col("inside_ms") > 0)
        .groupBy("window_ms")
        .agg(F.sum("inside_ms").alias("gap_ms"), F.count(F.lit(1)).alias("gaps"))
        .select(wall_clock("window_ms").alias("window_start"), "gap_ms", "gaps")
    )


def gap_explained(diffs: DataFrame, trades: DataFrame, window_ms: int) -> DataFrame:
    """Differing windows that a silence between connections falls into."""
    real = trades.filter(is_real_origin())
    gw = gap_windows(connection_gaps(connection_spans(real)), window_ms)
    return diffs.select(*KEY, "vol_diff").join(gw, "window_start")


def classify_mismatches(
    own: DataFrame, official: DataFrame, trades: DataFrame, window_ms: int
) -> DataFrame:
    """One verdict per differing window; the first rule that holds wins.

    The stores are compared once, and one fold of the trades gives both the raw count and the
    foreign flag. Each differing window meets its two neighbours in one aggregate over shifted copies.
    """
    diffs = matched(own, official).withColumns({
        "vol_diff": (F.col("my_volume") - F.col("off_volume")).cast("decimal(18,8)"),
        "close_diff": (F.col("my_close") - F.col("off_close")).cast("decimal(18,4)"),
    }).filter("vol_diff <> 0 or close_diff <> 0")
    step = F.expr(f"INTERVAL {window_ms // 1000} SECONDS")
    value = F.struct("vol_diff", "close_diff", "my_trade_count")
    copies = [
        F.struct((F.col("window_start") + shift).alias("window_start"), *[
            F.when(F.lit(name == role), value if name == "own" else F.col("vol_diff")).alias(name) for name in ("own", "before", "after")
        ])
        for role, shift in (("own", F.expr("INTERVAL 0 SECONDS")), ("before", step), ("after", -step))
    ]
    around = diffs.select("symbol", F.explode(F.array(*copies)).alias("c")).select("symbol", "c.*").groupBy(*KEY).agg(
        F.any_value("own", F.lit(True)).alias("own"), F.any_value("before", F.lit(True)).alias("before"), F.any_value("after", F.lit(True)).alias("after")
    ).filter("own is not null").select(*KEY, "own.*", "before", "after")
    raw = (
        trades.groupBy("symbol", bucket_start("event_ms", window_ms).alias("window_ms"))
        .agg(F.count(F.lit(1)).alias("raw_trades"), F.max(~is_real_origin()).alias("is_foreign"))
        .select("symbol", wall_clock("window_ms").alias("window_start"), "raw_trades", "is_foreign")
    )
    gapped = gap_windows(connection_gaps(connection_spans(trades.filter(is_real_origin()))), window_ms).select(
        "window_start", F.lit(True).alias("is_gap")
    )
    less = F.col("vol_diff") < 0
    mirrored = F.coalesce(-F.col("vol_diff") == F.col("before"), F.lit(False)) | F.coalesce(-F.col("vol_diff") == F.col("after"), F.lit(False))
    return (
        around.join(raw, KEY, "left")
        .join(gapped, "window_start", "left")
        .select(
            *KEY, "vol_diff", "close_diff",
            F.when((F.col("vol_diff") != 0) & mirrored, "boundary")
            .when(less & F.col("is_gap"), "source-gap")
            .when(less & (F.col("raw_trades") > F.col("my_trade_count")), "truncated")
            .when(F.col("is_foreign"), "contaminated")
            .otherwise("unexplained")
            .alias("verdict"),
        )
    )


def sign_distribution(diffs: DataFrame) -> DataFrame:
    """Two-sided differences point to alignment, one-sided ones to loss or duplication."""
    up, down = F.count_if(F.col("vol_diff") > 0), F.count_if(F.col("vol_diff") < 0)
    return diffs.agg(up.alias("positive"), down.alias("negative")).withColumn(
        "reading",
        F.when((F.col("positive") > 0) & (F.col("negative") > 0), "alignment")
        .when(F.col("negative") > 0, "loss")
        .when(F.col("positive") > 0, "duplication")
        .otherwise("exact"),
    )


def slice_sensitivity(trades: DataFrame, candle_fn, from_ms_in_window: int, to_ms_in_window: int, window_ms: int) -> DataFrame:
    """Drop one slice of every window and count which columns notice. Both folds read the same
    trades; the comparison is per window. A window all of whose trades lie in the slice has vanished."""
    offset = F.col("event_ms") - bucket_start("event_ms", window_ms)
    kept = trades.filter(~((offset >= from_ms_in_window) & (offset < to_ms_in_window)))
    full, cut = candle_fn(trades), candle_fn(kept)
    j = full.select(*KEY, *[F.col(c).alias(f"f_{c}") for c in ("open", "high", "low", "close", "volume")]).join(
        cut.select(*KEY, "open", "high", "low", "close", "volume", F.lit(True).alias("left")), KEY, "left"
    )

    def moved(c: str):
        return F.count_if(F.col(c) != F.col(f"f_{c}"))

    return j.agg(
        F.count(F.lit(1)).alias("windows"), F.count_if(F.col("left").isNull()).alias("vanished"),
        moved("open").alias("open_moved"), moved("high").alias("high_moved"), moved("low").alias("low_moved"),
        moved("close").alias("close_moved"), moved("volume").alias("volume_moved"),
    )
