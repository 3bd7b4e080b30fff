"""Own candles against official candles, raw trades and a second store. All comparisons are
exact decimals; doubles appear only in columns made for reading."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tapecheck.functions.numbers import volume_sum
from tapecheck.functions.timecols import bucket_start, epoch_ms, kst_text, wall_clock
from tapecheck.operators.dedup import latest_candles, latest_official
from tapecheck.schema import OHLCV
from tapecheck.settings import MINUTE_MS

KEY = ["symbol", "window_start"]


def _side(df: DataFrame, prefix: str, extra: list[str] | None = None) -> DataFrame:
    return df.select(*KEY, *[F.col(c).alias(f"{prefix}_{c}") for c in [*OHLCV, *(extra or [])]])


def matched(own: DataFrame, official: DataFrame) -> DataFrame:
    """Windows both sides have, each side reduced to its latest row before the join."""
    return _side(latest_candles(own), "my", ["trade_count", "write_count"]).join(
        _side(latest_official(official), "off"), KEY
    )


def candle_diff(own: DataFrame, official: DataFrame) -> DataFrame:
    """Every official window with what we have for it. A missing window has NULL differences
    (absent is not zero) but zero counts."""
    o = _side(latest_official(official), "off")
    m = _side(latest_candles(own), "my", ["trade_count", "write_count"]).withColumn("present", F.lit(1))
    return o.join(m, KEY, "left").select(
        *KEY,
        F.col("present").isNull().cast("int").alias("missing"),
        F.coalesce("my_write_count", F.lit(0)).cast("bigint").alias("write_count"),
        F.coalesce("my_trade_count", F.lit(0)).cast("bigint").alias("my_trade_count"),
        (F.col("my_close") - F.col("off_close")).cast("decimal(18,4)").alias("close_diff"),
        (F.col("my_volume") - F.col("off_volume")).cast("decimal(18,8)").alias("volume_diff"),
        (
            F.abs(F.col("my_volume") - F.col("off_volume")).cast("double")
            / F.nullif(F.col("off_volume").cast("double"), F.lit(0.0))
        ).alias("volume_rel_err"),
    )


def problem_windows(diff: DataFrame) -> DataFrame:
    return diff.filter((F.col("missing") == 1) | (F.col("write_count") > 1))


def diff_summary(diff: DataFrame) -> DataFrame:
    present = F.col("missing") == 0
    return diff.agg(
        F.count(F.lit(1)).alias("n_official"),
        F.count_if(~present).alias("n_missing"),
        F.count_if(present).alias("n_matched"),
        F.count_if(F.col("close_diff") == 0).alias("n_close_exact"),
        F.count_if(F.col("volume_diff") == 0).alias("n_vol_exact"),
        F.count_if(F.col("write_count") > 1).alias("n_dup"),
    )


def scorecard(own: DataFrame, official: DataFrame) -> DataFrame:
    m = matched(own, official)

    def same(c: str) -> Column:
        return F.count_if(F.col(f"my_{c}") == F.col(f"off_{c}"))

    return m.agg(
        F.count(F.lit(1)).alias("matched"),
        same("open").alias("open_ok"),
        same("high").alias("high_ok"),
        same("low").alias("low_ok"),
        same("close").alias("close_ok"),
        same("volume").alias("vol_ok"),
        F.count_if(F.col("my_write_count") > 1).alias("duplicated"),
        F.round(same("volume") / F.nullif(F.count(F.lit(1)), F.lit(0)) * 100, 2).alias("vol_pct"),
    )


def mismatches(own: DataFrame, official: DataFrame) -> DataFrame:
    """Matched windows whose volume or close differs."""
    m = matched(own, official)
    return m.filter(
        (F.col("my_volume") != F.col("off_volume")) | (F.col("my_close") != F.col("off_close"))
    ).select(
        *KEY,
        F.col("my_volume").alias("my_vol"),
        F.col("off_volume").alias("off_vol"),
        (F.col("my_volume") - F.col("off_volume")).cast("decimal(18,8)").alias("vol_diff"),
        (F.col("my_close") - F.col("off_close")).cast("decimal(18,4)").alias("close_diff"),
    )


def first_mismatches(own: DataFrame, official: DataFrame, n: int = 20) -> DataFrame:
    """The report shows the first ``n`` mismatches; ties on the window are broken by symbol."""
    return (
        mismatches(own, official)
        .orderBy("window_start", "symbol")
        .limit(n)
        .select(kst_text("window_start").alias("kst"), "symbol", "my_vol", "off_vol", "vol_diff", "close_diff")
    )


def accuracy_dataset(own: DataFrame, official: DataFrame) -> DataFrame:
    """Matched windows in the shape a dashboard plots."""
    m = matched(own, official)
    diff = (F.col("my_volume") - F.col("off_volume")).cast("double")
    return m.select(
        (F.col("window_start") + F.expr("INTERVAL 9 HOURS")).alias("window_kst"),
        "symbol",
        F.col("my_volume").cast("double").alias("my_volume"),
        F.col("off_volume").cast("double").alias("off_volume"),
        diff.alias("volume_diff"),
        F.when(F.col("off_volume") == 0, F.lit(0.0))
        .otherwise(diff / F.nullif(F.col("off_volume").cast("double"), F.lit(0.0)) * 100)
        .alias("volume_diff_pct"),
        (F.col("my_close") - F.col("off_close")).cast("double").alias("close_diff"),
        F.col("my_write_count").alias("write_count"),
    )


def trade_count_check(trades: DataFrame, own: DataFrame, window_ms: int = MINUTE_MS, keep_unmatched: bool = False) -> DataFrame:
    """Raw trades per window against the count inside the candle. The inner form is the classic
    report; ``keep_unmatched`` also shows windows that never became a candle."""
    raw = (
        trades.groupBy("symbol", bucket_start("event_ms", window_ms).alias("window_ms"))
        .agg(F.count(F.lit(1)).alias("raw_trades"))
        .select("symbol", wall_clock("window_ms").alias("window_start"), "raw_trades")
    )
    mine = latest_candles(own).select(*KEY, F.col("trade_count").alias("candle_trades"))
    out = raw.join(mine, KEY, "left" if keep_unmatched else "inner")
    counted = F.coalesce("candle_trades", F.lit(0)) if keep_unmatched else F.col("candle_trades")
    return out.select(
        *KEY, "raw_trades", counted.cast("bigint").alias("candle_trades"),
        (F.col("raw_trades") - counted).cast("bigint").alias("diff"),
    )


def count_check_summary(check: DataFrame) -> DataFrame:
    return check.agg(
        F.count(F.lit(1)).alias("windows"),
        F.count_if(F.col("diff") == 0).alias("exact"),
        F.count_if(F.col("diff") != 0).alias("mismatched"),
    )


def volume_recheck(trades: DataFrame, own: DataFrame, window_ms: int) -> DataFrame:
    """Window volume re-added from the raw trades against the candle. Equal means the pipeline
    lost nothing, whatever the official candle says."""
    raw = (
        trades.groupBy("symbol", bucket_start("event_ms", window_ms).alias("window_ms"))
        .agg(volume_sum().alias("raw_volume"))
        .select("symbol", wall_clock("window_ms").alias("window_start"), "raw_volume")
    )
    return raw.join(latest_candles(own).select(*KEY, F.col("volume").alias("candle_volume")), KEY).withColumn(
        "same", (F.col("raw_volume") == F.col("candle_volume")).cast("int")
    )


def store_vs_store(first: DataFrame, second: DataFrame) -> DataFrame:
    """Exact match over all candle columns between the two stores."""
    a, b = latest_candles(first), latest_candles(second)
    cols = [*OHLCV, "trade_count"]
    same = F.lit(True)
    for c in cols:
        same = same & (F.col(f"a_{c}") == F.col(f"b_{c}"))
    left = a.select(*KEY, *[F.col(c).alias(f"a_{c}") for c in cols])
    right = b.select(*KEY, *[F.col(c).alias(f"b_{c}") for c in cols])
    return left.join(right, KEY).agg(F.count(F.lit(1)).alias("matched"), F.count_if(same).alias("identical"))


def alignment_probe(own: DataFrame, official: DataFrame, window_ms: int) -> DataFrame:
    """Exact matches at shifts of -1, 0 and +1 window: shows whether the official label is the
    start or the end of its window. Each own candle is offered at three keys, then one equi-join."""
    mine = latest_candles(own).select(
        "symbol", F.explode(F.array(*[F.lit(k * window_ms).cast("bigint") for k in (-1, 0, 1)])).alias("shift_ms"),
        "window_start", F.col("volume").alias("my_volume"), F.col("close").alias("my_close"),
    ).select(
        "symbol", "shift_ms", wall_clock(epoch_ms("window_start") - F.col("shift_ms")).alias("window_start"),
        "my_volume", "my_close",
    )
    off = latest_official(official).select(*KEY, F.col("volume").alias("off_volume"), F.col("close").alias("off_close"))
    return (
        mine.join(off, KEY)
        .groupBy("shift_ms")
        .agg(
            F.count(F.lit(1)).alias("matched"),
            F.count_if(F.col("my_volume") == F.col("off_volume")).alias("vol_exact"),
            F.count_if(F.col("my_close") == F.col("off_close")).alias("close_exact"),
        )
    )


def sink_comparison(stores: dict[str, DataFrame]) -> DataFrame:
    """Windows, rows and windows written more than once, per store."""
    parts = [
        df.groupBy(*KEY).agg(F.count(F.lit(1)).alias("n"))
        .agg(
            F.count(F.lit(1)).alias("windows"),
            F.coalesce(F.sum("n"), F.lit(0)).alias("rows_written"),
            F.count_if(F.col("n") > 1).alias("duplicated_windows"),
        )
        .select(F.lit(name).alias("store"), "windows", "rows_written", "duplicated_windows")
        for name, df in stores.items()
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def range_summary(own: DataFrame, official: DataFrame) -> DataFrame:
    def one(name: str, df: DataFrame) -> DataFrame:
        return df.agg(
            F.count(F.lit(1)).alias("n_rows"),
            kst_text(F.min("window_start")).alias("first_kst"),
            kst_text(F.max("window_start")).alias("last_kst"),
        ).select(F.lit(name).alias("src"), "n_rows", "first_kst", "last_kst")

    return one("mine", own).unionByName(one("official", official))


def duplicate_report(trades: DataFrame) -> DataFrame:
    """Archive rows against distinct idempotency keys."""
    return (
        trades.groupBy("symbol", "event_ms", "seq_in_ms")
        .agg(F.count(F.lit(1)).alias("n"))
        .agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"),
            F.count(F.lit(1)).alias("n_keys"),
            F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("n_duplicates"),
        )
    )
