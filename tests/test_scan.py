"""The sliced scan must equal a plain loop, whatever is hot."""

import random
import time

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from tapecheck.operators.scan import (
    last_before, max_before, measure_slices, number_within, ordered_scan, rows_before, slicing, sum_before, sum_upto,
)

SCHEMA = "k string, t bigint, id bigint, v bigint"


def expected(rows, keyed):
    out, state = {}, {}
    for k, t, i, v in sorted(rows, key=lambda r: (r[1], r[2])):
        s = state.setdefault(k if keyed else None, {"n": 0, "sum": 0, "max": None, "last": None})
        out[i] = (s["n"], s["sum"], s["sum"] + v, s["max"], s["last"])
        s["n"] += 1
        s["sum"] += v
        s["max"] = v if s["max"] is None else max(s["max"], v)
        s["last"] = v
    return out


def check(spark, rows, keyed, rows_per_slice):
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = ordered_scan(
        df, ["k"] if keyed else [], ["t", "id"],
        [rows_before("n"), sum_before("s", "v"), sum_upto("u", "v"), max_before("m", "v"), last_before("l", "v")],
        rows_per_slice=rows_per_slice,
    )
    assert {r.id: (r.n, r.s, r.u, r.m, r.l) for r in got.collect()} == expected(rows, keyed)


def make(n, seed, hot_instant=False, hot_key=False):
    r = random.Random(seed)
    rows = []
    for i in range(n):
        k = "hot" if hot_key and i % 3 == 0 else r.choice("abcde")
        t = 500 if hot_instant and i % 3 == 0 else r.randrange(1000)
        rows.append((k, t, i, r.randrange(-50, 50)))
    return rows


@pytest.mark.parametrize("keyed", [True, False])
@pytest.mark.parametrize("hot_instant", [True, False])
@pytest.mark.parametrize("hot_key", [True, False])
def test_scan_equals_loop(spark, keyed, hot_instant, hot_key):
    check(spark, make(900, 7, hot_instant, hot_key), keyed, rows_per_slice=60)


def test_hot_instant_is_cut_again(spark):
    rows = make(900, 3, hot_instant=True)
    df = spark.createDataFrame(rows, SCHEMA)
    slices = measure_slices(df, ["t", "id"], rows_per_slice=60)
    assert slices.hot == (500,)
    sizes = [r["count"] for r in df.groupBy(slices.of().alias("s")).count().collect()]
    assert max(sizes) <= 150 and sum(sizes) == 900


def test_single_slice_and_empty(spark):
    check(spark, make(40, 1), True, rows_per_slice=1000)
    empty = spark.createDataFrame([], SCHEMA)
    assert ordered_scan(empty, [], ["t", "id"], [rows_before("n")]).count() == 0


def test_number_within_hot_instant(spark):
    rows = make(900, 5, hot_instant=True)
    df = spark.createDataFrame(rows, SCHEMA)
    got = {r.id: r.seq for r in number_within(df, ["k"], "t", ["id"], "seq", rows_per_slice=50).collect()}
    seen, want = {}, {}
    for k, t, i, _ in sorted(rows, key=lambda r: r[2]):
        want[i] = seen.get((k, t), 0)
        seen[(k, t)] = want[i] + 1
    assert got == want


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    data=st.lists(st.tuples(st.sampled_from("ab"), st.integers(0, 6), st.integers(-9, 9)), min_size=1, max_size=40),
    per=st.integers(2, 12),
)
def test_scan_property(spark, data, per):
    rows = [(k, t, i, v) for i, (k, t, v) in enumerate(data)]
    check(spark, rows, True, per)


def test_slices_do_not_depend_on_partitioning(spark):
    rows = make(600, 9)
    df = spark.createDataFrame(rows, SCHEMA)
    slices = measure_slices(df, ["t", "id"], rows_per_slice=50)
    a = {r.id: r.s for r in df.repartition(3).select("id", slices.of().alias("s")).collect()}
    b = {r.id: r.s for r in df.repartition(7, F.col("v")).select("id", slices.of().alias("s")).collect()}
    assert a == b


@pytest.mark.parametrize("hot_instant", [True, False])
@pytest.mark.parametrize("keyed", [True, False])
def test_slices_that_are_cut_again(spark, keyed, hot_instant):
    rows = make(1200, 13, hot_instant, hot_key=True)
    with slicing(rows_per_slice=40, coarse=4):
        check(spark, rows, keyed, None)
        df = spark.createDataFrame(rows, SCHEMA)
        slices = measure_slices(df, ["t", "id"])
        assert slices.count <= 12 and slices.fine is not None
        sizes = [r["count"] for r in slices.cut(df.repartition(3), "s").groupBy("s").count().collect()]
        assert sum(sizes) == 1200 and max(sizes) <= 120 and len(sizes) >= 20
        got = {r.id: r.seq for r in number_within(df, ["k"], "t", ["id"], "seq").collect()}
    seen, want = {}, {}
    for k, t, i, _ in sorted(rows, key=lambda r: r[2]):
        want[i] = seen.get((k, t), 0)
        seen[(k, t)] = want[i] + 1
    assert got == want


def test_many_slices_are_planned_quickly(spark):
    """What the plan holds does not grow with the number of slices."""
    df = spark.range(500_000).select(F.col("id").alias("t"), (F.col("id") * 7 % 1000).alias("id"), F.lit("a").alias("k"))
    began = time.perf_counter()
    with slicing(rows_per_slice=10):
        slices = measure_slices(df, ["t", "id"])
    sizes = slices.cut(df, "s").groupBy("s").count()
    plan = sizes._jdf.queryExecution().optimizedPlan().toString()
    assert slices.count <= 512 and len(plan) < 60_000
    assert sizes.count() > 40_000
    assert time.perf_counter() - began < 30


def test_slicing_belongs_to_its_thread(spark):
    from concurrent.futures import ThreadPoolExecutor

    df = spark.createDataFrame(make(900, 1), SCHEMA)
    with slicing(rows_per_slice=60), ThreadPoolExecutor(1) as other:
        assert measure_slices(df, ["t", "id"]).count > 10
        assert other.submit(lambda: measure_slices(df, ["t", "id"]).count).result() == 1
