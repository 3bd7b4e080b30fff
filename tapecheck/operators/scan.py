"""Running values over an ordered table, without ever bringing a whole group to one task.

A plain window function sends all rows of a key (or, without a key, all rows of the table) to
one task. Here the order is cut into slices of about equal row counts:

1. one cheap pass measures split points of the order columns: at most ``COARSE`` of them reach the driver and
   the plan; where more are needed each coarse slice is cut again by a table of its own fine points;
2. each (key, slice) is reduced to one row, with map-side combine;
3. those few rows are turned into the value carried into each slice;
4. inside a slice a normal window adds the rest.

Slices are functions of the row's own values, never of the partition it happens to sit in, so a
recomputed task puts every row into the same slice again.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window, functions as F

from tapecheck.settings import shared_dir

ROWS_PER_SLICE = 200_000
#: Split points that reach the driver and stand in a plan.
COARSE = 512
_GRID = 64
_LOWEST = -(2**63)
_sizes: ContextVar[tuple[int, int]] = ContextVar("sizes", default=(ROWS_PER_SLICE, COARSE))


@contextmanager
def slicing(rows_per_slice: int = ROWS_PER_SLICE, coarse: int = COARSE) -> Iterator[None]:
    """Other sizes for the plans that are built inside; other threads keep theirs."""
    token = _sizes.set((rows_per_slice, coarse))
    try:
        yield
    finally:
        _sizes.reset(token)


@dataclass(frozen=True)
class Measure:
    name: str
    kind: str  # count | sum | max | last
    value: Column | str | None = None
    inclusive: bool = False


def rows_before(name: str) -> Measure:
    """How many rows of the key come earlier."""
    return Measure(name, "count")


def sum_upto(name: str, value: Column | str) -> Measure:
    return Measure(name, "sum", value, inclusive=True)


def sum_before(name: str, value: Column | str) -> Measure:
    return Measure(name, "sum", value)


def max_before(name: str, value: Column | str) -> Measure:
    return Measure(name, "max", value)


def last_before(name: str, value: Column | str) -> Measure:
    """Value of the row directly before this one (the value must not be NULL)."""
    return Measure(name, "last", value)


@dataclass(frozen=True)
class Slices:
    """Measured split points of an order; ``cut`` gives each row its slice."""

    order: tuple[str, ...]
    points: tuple[tuple[int, int], ...] = ()
    hot: tuple[int, ...] = field(default=())
    #: (_coarse, _points): how each coarse slice is cut again, and (_value): first order values that span slices.
    fine: DataFrame | None = None
    fine_hot: DataFrame | None = None

    @property
    def count(self) -> int:
        return len(self.points) + 1

    def _key(self) -> Column:
        first = F.col(self.order[0]).cast("bigint")
        second = F.col(self.order[1]).cast("bigint") if len(self.order) > 1 else F.lit(0).cast("bigint")
        return F.struct(first.alias("a"), second.alias("b"))

    def of(self) -> Column:
        """The slice of a row, of the points that the plan holds."""
        if not self.points:
            return F.lit(0)
        # one literal: a column per point would take the optimizer longer than the query
        text = json.dumps([{"a": a, "b": b} for a, b in self.points])
        return _place(F.from_json(F.lit(text), "array<struct<a: bigint, b: bigint>>"), self._key(), len(self.points))

    def cut(self, df: DataFrame, name: str = "_slice") -> DataFrame:
        """``df`` with the number of each row's slice."""
        if self.fine is None:
            return df.withColumn(name, self.of())
        wide = df.withColumn("_coarse", self.of()).join(self.fine, "_coarse", "left")
        most = self.fine.agg(F.max(F.size("_points"))).first()[0] or 0
        inside = F.when(F.col("_points").isNull(), 0).otherwise(_place(F.col("_points"), self._key(), most))
        return wide.withColumn(name, F.col("_coarse").cast("bigint") * (1 << 32) + inside).drop("_coarse", "_points")

    def hot_values(self, df: DataFrame, column: str) -> DataFrame:
        """Rows whose value of ``column`` spans several slices."""
        kept = df.filter(F.col(column).isin(list(self.hot)))
        if self.fine_hot is None:
            return kept
        return kept.unionByName(
            df.filter(~F.coalesce(F.col(column).isin(list(self.hot)), F.lit(False))).join(
                self.fine_hot, F.col(column).cast("bigint") == F.col("_value"), "left_semi"
            )
        )

    @property
    def has_hot(self) -> bool:
        return bool(self.hot) or self.fine_hot is not None


def _place(points: Column, key: Column, most: int) -> Column:
    """How many of the sorted points are not beyond the key: a branch-free binary search."""
    steps, step = [], 1
    while step <= most:
        steps.insert(0, step)
        step *= 2
    return F.aggregate(
        F.array(*[F.lit(s) for s in steps]),
        F.lit(0),
        lambda at, s: F.when(F.get(points, at + s - 1) <= key, at + s).otherwise(at),
    )


def _accuracy(parts: int) -> Column:
    return F.lit(max(10_000, 20 * parts))


def _shares(parts: int) -> list[float]:
    return [k / parts for k in range(1, parts)]


def _quantiles(df: DataFrame, column: str, parts: int) -> tuple[int, list[int]]:
    row = df.agg(
        F.count(F.lit(1)).alias("n"),
        F.percentile_approx(F.col(column).cast("bigint"), _shares(parts), _accuracy(parts)).alias("q"),
    ).first()
    return row.n, [v for v in (row.q or []) if v is not None]


def measure_slices(
    df: DataFrame, order: list[str], rows_per_slice: int | None = None, coarse: int | None = None
) -> Slices:
    """Split points that give slices of about ``rows_per_slice`` rows.

    The first order column is cut at approximate quantiles. An instant that alone is worth more
    than a slice is cut again along the second order column, so a third of all rows may share
    one arrival time. At most ``coarse`` points reach the driver, however many slices there are.
    """
    usual, most_points = _sizes.get()
    rows_per_slice, coarse = rows_per_slice or usual, coarse or most_points
    first = order[0]
    # One pass gives the row count and a grid of quantiles that most sizes can be cut from.
    n, grid = _quantiles(df, first, _GRID)
    slices = -(-n // rows_per_slice) if n else 1
    want = min(slices, coarse)
    if want <= 1:
        return Slices(tuple(order))
    if want > _GRID:
        n, grid = _quantiles(df, first, want)
        found = grid
    else:
        found = [grid[max(0, round(k * _GRID / want) - 1)] for k in range(1, want)] if grid else []
    repeats: dict[int, int] = {}
    for v in found:
        repeats[v] = repeats.get(v, 0) + 1
    hot = sorted(v for v, r in repeats.items() if r > 1)
    points = {(v, _LOWEST) for v in repeats}
    if hot and len(order) > 1:
        points |= {(v + 1, _LOWEST) for v in hot}
        most = max(repeats[v] for v in hot) + 1
        inner = (
            df.filter(F.col(first).isin(hot))
            .groupBy(F.col(first).cast("bigint").alias("v"))
            .agg(F.percentile_approx(F.col(order[1]).cast("bigint"), _shares(most), _accuracy(most)).alias("q"))
            .collect()
        )
        for r in inner:
            # a value gets as many cuts as its own repeats ask for, not as many as the hottest one
            parts = repeats[r.v] + 1
            points |= {(r.v, r.q[round(k * most / parts) - 1]) for k in range(1, parts) if r.q}
    elif hot:
        hot = []
    made = Slices(tuple(order), tuple(sorted(points)), tuple(hot))
    return made if slices <= coarse else _cut_again(df, made, -(-slices // made.count))


def _cut_again(df: DataFrame, coarse: Slices, parts: int) -> Slices:
    """Fine points within each coarse slice, as a table: the same two steps, by groups instead of on the driver.

    The table is written before it is used, because approximate quantiles that are computed twice may differ.
    """
    if parts < 2:
        return coarse
    spark, order = df.sparkSession, coarse.order
    first = F.col(order[0]).cast("bigint")
    rows = df.withColumn("_coarse", coarse.of()).select("_coarse", first.alias("a"), *([F.col(order[1]).cast("bigint").alias("b")] if len(order) > 1 else []))
    quantiles = rows.groupBy("_coarse").agg(F.percentile_approx("a", _shares(parts), _accuracy(parts)).alias("q"))
    found = quantiles.select("_coarse", F.explode("q").alias("a")).groupBy("_coarse", "a").agg(F.count(F.lit(1)).cast("int").alias("repeats"))
    found = _written(found, "slices")
    low = F.lit(_LOWEST).cast("bigint").alias("b")
    points = found.select("_coarse", "a", low)
    hot = found.where("repeats > 1")
    if len(order) > 1:
        inner = rows.join(hot, ["_coarse", "a"]).groupBy("_coarse", "a", "repeats").agg(F.percentile_approx("b", _shares(parts), _accuracy(parts)).alias("q"))
        share = F.transform(F.sequence(F.lit(1), F.col("repeats")), lambda k: F.get("q", F.round(k * parts / (F.col("repeats") + 1)).cast("int") - 1))
        points = points.unionByName(hot.select("_coarse", (F.col("a") + 1).alias("a"), low)).unionByName(inner.select("_coarse", "a", F.explode(share).alias("b")))
    table = points.where("b is not null").groupBy("_coarse").agg(F.array_sort(F.collect_set(F.struct("a", "b"))).alias("_points"))
    hot = hot.select(F.col("a").alias("_value")).distinct() if len(order) > 1 else None
    return Slices(coarse.order, coarse.points, coarse.hot, _written(table, "slices"), None if hot is None else _written(hot, "slices"))


def _written(df: DataFrame, purpose: str) -> DataFrame:
    path = shared_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_BEFORE = (Window.unboundedPreceding, -1)


def _reduced(m: Measure, order: list[str]) -> Column:
    if m.kind == "count":
        return F.count(F.lit(1))
    value = F.col(m.value) if isinstance(m.value, str) else m.value
    if m.kind == "sum":
        return F.sum(value)
    if m.kind == "max":
        return F.max(value)
    return F.max_by(value, F.col(order[0]) if len(order) == 1 else F.struct(*order))


def _carried(m: Measure, w) -> Column:
    c = F.col(f"_{m.name}")
    if m.kind in ("count", "sum"):
        return F.coalesce(F.sum(c).over(w), F.lit(0))
    if m.kind == "max":
        return F.max(c).over(w)
    return F.last(c, ignorenulls=True).over(w)


def _inside(m: Measure, w, carry: Column | None) -> Column:
    value = F.col(m.value) if isinstance(m.value, str) else m.value
    frame = w.rowsBetween(Window.unboundedPreceding, 0) if m.inclusive else w.rowsBetween(*_BEFORE)
    if m.kind == "count":
        here = (F.row_number().over(w) - 1).cast("bigint")
        return here if carry is None else here + carry
    if m.kind == "sum":
        here = F.coalesce(F.sum(value).over(frame), F.lit(0))
        return here if carry is None else here + carry
    if m.kind == "max":
        here = F.max(value).over(frame)
        return here if carry is None else F.greatest(here, carry)
    here = F.lag(value).over(w)
    return here if carry is None else F.coalesce(here, carry)


def _null_safe(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Equi-join on ``keys`` in which NULL keys meet NULL keys."""
    right = right.withColumnsRenamed({k: f"_on_{k}" for k in keys})
    on = [left[k].eqNullSafe(right[f"_on_{k}"]) for k in keys]
    return left.join(right, on, how).drop(*[f"_on_{k}" for k in keys])


def ordered_scan(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    measures: list[Measure],
    slices: Slices | None = None,
    rows_per_slice: int | None = None,
) -> DataFrame:
    """Append the measures, computed over each key in the given total order.

    ``order`` holds BIGINT columns, the last of which makes the order total. One full shuffle
    (by key and slice); the carried rows number at most keys x slices and join on the same
    columns as the in-slice window, which reuses that partitioning.
    """
    if slices is None:
        slices = measure_slices(df, order, rows_per_slice)
    if slices.count == 1:
        w = Window.partitionBy(*keys).orderBy(*order) if keys else Window.orderBy(*order)
        return df.withColumns({m.name: _inside(m, w, None) for m in measures})
    cut = slices.cut(df)
    by_slice = cut.groupBy(*keys, "_slice").agg(*[_reduced(m, order).alias(f"_{m.name}") for m in measures])
    over = (Window.partitionBy(*keys) if keys else Window.partitionBy()).orderBy("_slice").rowsBetween(*_BEFORE)
    carries = by_slice.select(*keys, "_slice", *[_carried(m, over).alias(f"_{m.name}") for m in measures])
    joined = _null_safe(cut, carries, [*keys, "_slice"])
    w = Window.partitionBy(*keys, "_slice").orderBy(*order)
    return joined.withColumns({m.name: _inside(m, w, F.col(f"_{m.name}")) for m in measures}).drop(
        "_slice", *[f"_{m.name}" for m in measures]
    )


def number_within(
    df: DataFrame, keys: list[str], at: str, order: list[str], name: str, rows_per_slice: int | None = None
) -> DataFrame:
    """0-based number of each row among the rows with equal ``keys`` and equal ``at``.

    Such groups are small except where one value of ``at`` is hot. Slices run over (``at``,
    first order column), so only a hot value spans several slices, and only those few
    (key, slice) counts are carried.
    """
    slices = measure_slices(df, [at, *order], rows_per_slice)
    group = [*keys, at]
    if not slices.has_hot:
        return df.withColumn(name, F.row_number().over(Window.partitionBy(*group).orderBy(*order)) - 1)
    cut = slices.cut(df)
    over = Window.partitionBy(*group).orderBy("_slice").rowsBetween(*_BEFORE)
    carries = (
        slices.hot_values(cut, at)
        .groupBy(*group, "_slice").agg(F.count(F.lit(1)).alias("_n"))
        .select(*group, "_slice", F.coalesce(F.sum("_n").over(over), F.lit(0)).alias("_n"))
    )
    w = Window.partitionBy(*group, "_slice").orderBy(*order)
    return (
        _null_safe(cut, carries, [*group, "_slice"], "left")
        .withColumn(name, (F.row_number().over(w) - 1 + F.coalesce("_n", F.lit(0))).cast("int"))
        .drop("_slice", "_n")
    )
