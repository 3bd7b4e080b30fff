"""Health questions over metric samples (ts_ms, labels..., value): increase, level, slope, and
conditions that must hold for a while.

Everything is evaluated on a fixed grid of steps. Samples are first reduced to one row per series
and step; the windows below run over those, so their size is the covered time divided by the step.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tapecheck.functions.timecols import wall_clock, wide_arrival_key
from tapecheck.operators.scan import last_before, ordered_scan


def selected(samples: DataFrame, label: str, prefix: str) -> DataFrame:
    """Samples whose label begins with ``prefix``; the filter is applied before any sample is reduced."""
    return samples.filter(F.col(label).startswith(prefix)) if prefix else samples


def step_of(ts_ms: Column | str, step_ms: int) -> Column:
    """First evaluation time at or after the sample."""
    t = F.col(ts_ms) if isinstance(ts_ms, str) else ts_ms
    return t + F.pmod(-t, F.lit(step_ms).cast("bigint"))


def increments(samples: DataFrame, series: list[str], tie: str, rows_per_slice: int | None = None) -> DataFrame:
    """What a counter gained since its previous sample; a smaller value means it restarted at 0."""
    linked = ordered_scan(
        samples, series, ["ts_ms", tie], [last_before("previous", "value")], rows_per_slice=rows_per_slice
    )
    v, p = F.col("value"), F.col("previous")
    return linked.withColumn("gain", F.when(p.isNull(), F.lit(0.0)).when(v < p, v).otherwise(v - p)).drop("previous")


def on_grid(per_step: DataFrame, keys: list[str], step_ms: int) -> DataFrame:
    """One row per key and step between the first and last step seen anywhere."""
    span = per_step.agg(F.min("eval_ms").alias("lo"), F.max("eval_ms").alias("hi")).first()
    lo, hi = (span.lo, span.hi) if span.lo is not None else (0, -step_ms)
    every = F.explode(F.sequence(F.lit(lo), F.lit(max(lo, hi)), F.lit(step_ms).cast("bigint")))
    grid = per_step.select(*keys).distinct().withColumn("eval_ms", every)
    return grid.join(per_step, [*keys, "eval_ms"], "left")


def _ordered(keys: list[str]):
    return Window.partitionBy(*(keys or [F.lit("all")])).orderBy("eval_ms")


def increase(
    samples: DataFrame, series: list[str], by: list[str], step_ms: int, window_ms: int, tie: str, name: str = "increase"
) -> DataFrame:
    """Sum of the counter gains inside the trailing window, per ``by`` label, at every step."""
    by_ = by or ["scope"]
    s = samples if by else samples.withColumn("scope", F.lit("all"))
    per = (
        increments(s, list(dict.fromkeys([*series, *by_])), tie)
        .groupBy(*by_, step_of("ts_ms", step_ms).alias("eval_ms"))
        .agg(F.sum("gain").alias("gain"))
    )
    w = _ordered(by_).rangeBetween(-(window_ms - step_ms), 0)
    return on_grid(per, by_, step_ms).select(
        *by_, "eval_ms", F.sum(F.coalesce("gain", F.lit(0.0))).over(w).alias(name)
    )


LOOKBACK_MS = 5 * 60_000


def level(
    samples: DataFrame, series: list[str], step_ms: int, tie: str, name: str = "level", lookback_ms: int = LOOKBACK_MS,
    among: DataFrame | None = None,
) -> DataFrame:
    """Latest value of every series at every step at which it lives.

    A sample counts for ``lookback_ms``; a series without a younger one has no level, so a job that
    ended does not keep its last value. Each sample is spread over the steps up to the series' next one,
    so the rows follow the samples and not series x steps. The evaluation ends with the newest sample of
    ``among`` (default: of ``samples``): selected series that fall silent keep their level while others go on.
    """
    per = samples.groupBy(*series, step_of("ts_ms", step_ms).alias("eval_ms")).agg(
        F.max_by("value", wide_arrival_key("ts_ms", tie)).alias(name), F.max("ts_ms").alias("at_ms")
    )
    ends = per.agg(F.max("eval_ms")) if among is None else among.agg(F.max(step_of("ts_ms", step_ms)))
    last = F.lit(ends.first()[0]).cast("bigint")
    following = F.lead("eval_ms").over(_ordered(series)) - step_ms
    return (
        per.withColumn("until_ms", F.least(following, last, F.col("at_ms") + lookback_ms - 1))
        .filter("until_ms >= eval_ms")
        .select(*series, F.explode(F.sequence("eval_ms", "until_ms", F.lit(step_ms).cast("bigint"))).alias("eval_ms"), name)
    )


def slope(levels: DataFrame, keys: list[str], value: str, window_ms: int, name: str = "slope") -> DataFrame:
    """Least-squares slope per second of a level over the trailing window."""
    w = _ordered(keys).rangeBetween(-window_ms, 0)
    return levels.withColumn(name, F.regr_slope(F.col(value), F.col("eval_ms") / F.lit(1000.0)).over(w))


def firing_steps(evals: DataFrame, keys: list[str], cond: Column, for_ms: int, step_ms: int) -> DataFrame:
    """Steps at which the condition has held without a break for at least ``for_ms``."""
    w = _ordered(keys)
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    e = evals.withColumn("_ok", F.coalesce(cond, F.lit(False)))
    e = e.withColumn(
        "since_ms",
        F.coalesce(F.max(F.when(~F.col("_ok"), F.col("eval_ms"))).over(upto) + step_ms, F.min("eval_ms").over(upto)),
    )
    return e.filter(F.col("_ok") & (F.col("eval_ms") - F.col("since_ms") >= for_ms)).select(*keys, "eval_ms", "since_ms")


def alerts(firing: DataFrame, keys: list[str], name: str, severity: str) -> DataFrame:
    """Firing steps as one row per alert and stretch of time."""
    key = F.concat_ws(",", *[F.concat(F.lit(f"{k}="), F.col(k).cast("string")) for k in keys]) if keys else F.lit("")
    return firing.groupBy(*keys, "since_ms").agg(
        F.min("eval_ms").alias("a"), F.max("eval_ms").alias("b"), F.count(F.lit(1)).alias("evaluations")
    ).select(
        F.lit(name).alias("alert"), F.lit(severity).alias("severity"), key.alias("labels"),
        wall_clock("a").alias("fired_from"), wall_clock("b").alias("fired_to"), "evaluations",
    )


def label_and(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
    """``left and on(labels) right``: rows of the left that have a match, unchanged."""
    return left.join(right.select(*on), on, "left_semi")


def inhibit(firing: DataFrame, by: DataFrame) -> DataFrame:
    """Drop firing steps during which the inhibiting alert fires as well."""
    return firing.join(by.select("eval_ms").distinct(), "eval_ms", "left_anti")


def state_at(samples: DataFrame, series: list[str], as_of_ms: int, tie: str) -> DataFrame:
    """Latest value of every series at a time."""
    known = samples.filter(F.col("ts_ms") <= F.lit(as_of_ms).cast("bigint"))
    return known.groupBy(*series).agg(F.max_by("value", wide_arrival_key("ts_ms", tie)).alias("value"))


def unread_partitions(end_offsets: DataFrame, committed: DataFrame) -> DataFrame:
    """Partitions that hold records although no group has ever committed a position in them. The
    unknown position is -1, so the maximum over the groups decides."""
    nobody = committed.groupBy("topic", "partition").agg(F.max("value").alias("best")).filter(F.col("best") == -1)
    return label_and(end_offsets.filter(F.col("value") > 0), nobody, ["topic", "partition"])


def known_lag(lags: DataFrame, keys: list[str]) -> DataFrame:
    """Lag sums with and without the -1 that stands for an unknown position."""
    return lags.groupBy(*keys).agg(
        F.sum(F.when(F.col("value") >= 0, F.col("value"))).alias("lag"), F.sum("value").alias("lag_with_unknown")
    )


def freshness(candle_writes: DataFrame, step_ms: int) -> DataFrame:
    """Age of the newest written candle at every step."""
    per = candle_writes.groupBy(step_of("written_ms", step_ms).alias("eval_ms")).agg(F.max("window_ms").alias("newest"))
    per = per.withColumn("scope", F.lit("all"))
    w = _ordered(["scope"]).rowsBetween(Window.unboundedPreceding, 0)
    return on_grid(per, ["scope"], step_ms).select(
        "eval_ms", (F.col("eval_ms") - F.max("newest").over(w)).alias("age_ms")
    )
