"""Continuity, comparison, diagnosis, ordering, replay and monitoring on small hand-made inputs."""

import datetime as dt
import random
from decimal import Decimal as D

from pyspark.sql import functions as F

from tapecheck.operators import compare as cmp, continuity as ct, diagnosis as dg, monitor as mo, ordering as od, replay as rp

H = 3_600_000
W0 = dt.datetime(2024, 1, 1)


def arrivals(spark, rows):
    return spark.createDataFrame(rows, "conn_id string, recv_seq bigint, ingest_ms bigint, symbol string, price decimal(18,4)")


def test_gap_sign(spark):
    rows = [("lossy", s, s * 10, "A", D(1)) for s in (1, 2, 5)] + [("twice", s, s * 10, "A", D(1)) for s in (1, 2, 2, 3)]
    got = {r.conn_id: (r.expected, r.gaps, r.loss_pct) for r in ct.source_continuity(arrivals(spark, rows)).collect()}
    assert got == {"lossy": (5, 2, 40.0), "twice": (3, -1, -33.3333)}


def test_overlaps_against_brute_force(spark):
    r = random.Random(4)
    spans = []
    for i in range(60):
        a = r.randrange(10_000)
        spans.append((f"c{i:02d}", a, a + r.choice([0, 5, 50, 500, 6000])))
    df = spark.createDataFrame(spans, "conn_id string, t0 bigint, t1 bigint")
    got = sorted((x.conn_a, x.conn_b) for x in ct.connection_overlaps(df).collect())
    want = sorted((a[0], b[0]) for a in spans for b in spans if a[0] < b[0] and a[1] <= b[2] and b[1] <= a[2])
    assert got == want


def test_nested_connection_fakes_a_gap_only_in_the_simple_form(spark):
    df = spark.createDataFrame([("a", 0, 1000), ("b", 100, 200), ("c", 900, 2000), ("d", 2500, 2600)], "conn_id string, t0 bigint, t1 bigint")
    for per in (None, 2):
        assert sorted(tuple(r) for r in ct.connection_gaps(df, per).collect()) == [(200, 900), (2000, 2500)]
        assert [tuple(r) for r in ct.coverage_gaps(df, per).collect()] == [(2000, 2500)]


def own(spark, rows):
    full = [(s, W0 + dt.timedelta(hours=h), D(1), D(1), D(1), D(c), D(v), n, W0, "r") for s, h, c, v, n in rows]
    return spark.createDataFrame(full, "symbol string, window_start timestamp_ntz, open decimal(18,4), high decimal(18,4), low decimal(18,4), close decimal(18,4), volume decimal(18,8), trade_count bigint, ingested_at timestamp_ntz, run_id string")


def official(spark, rows):
    full = [(s, W0 + dt.timedelta(hours=h), D(1), D(1), D(1), D(c), D(v), W0) for s, h, c, v in rows]
    return spark.createDataFrame(full, "symbol string, window_start timestamp_ntz, open decimal(18,4), high decimal(18,4), low decimal(18,4), close decimal(18,4), volume decimal(18,8), fetched_at timestamp_ntz")


def test_missing_is_null_and_counts_are_zero(spark):
    d = {r.window_start.hour: r for r in cmp.candle_diff(own(spark, [("A", 0, 1, 5, 3)]), official(spark, [("A", 0, 1, 5), ("A", 1, 1, 0)])).collect()}
    assert (d[0].missing, d[0].volume_diff, d[0].write_count) == (0, D(0), 1)
    assert (d[1].missing, d[1].close_diff, d[1].volume_diff, d[1].write_count, d[1].my_trade_count) == (1, None, None, 0, 0)
    assert d[1].volume_rel_err is None


def test_boundary_signature(spark):
    o = own(spark, [("A", 0, 1, 97_612, 1), ("A", 1, 1, 102_388, 1), ("A", 5, 1, 99_938, 1)])
    f = official(spark, [("A", h, 1, 100_000) for h in (0, 1, 5)])
    sym = dg.adjacent_symmetry(cmp.mismatches(o, f), H).collect()
    assert [(r.window_start.hour, r.vol_diff, r.next_diff) for r in sym] == [(0, D(-2388), D(2388))]


def test_verdicts(spark):
    base = int(W0.replace(tzinfo=dt.UTC).timestamp() * 1000)
    o = own(spark, [("A", 0, 1, 97_612, 1), ("A", 1, 1, 102_388, 1), ("A", 3, 1, 90, 1), ("A", 5, 1, 90, 1), ("A", 7, 1, 150, 2), ("A", 9, 1, 120, 1)])
    f = official(spark, [("A", 0, 1, 100_000), ("A", 1, 1, 100_000)] + [("A", h, 1, 100) for h in (3, 5, 7, 9)])
    t = []
    for h, conn, n in ((0, "c1", 1), (1, "c1", 1), (3, "c1", 1), (5, "c2", 3), (7, "c2", 1), (7, "synth-9", 1), (9, "c2", 1)):
        for i in range(n):
            ms = base + h * H + 1000 + i
            t.append((conn, "A", ms, ms + (60_000 if conn == "c2" and h == 5 else 0)))
    trades = spark.createDataFrame(t, "conn_id string, symbol string, event_ms bigint, ingest_ms bigint")
    got = {r.window_start.hour: r.verdict for r in dg.classify_mismatches(o, f, trades, H).collect()}
    # c1 ends in hour 3 and c2 starts in hour 5: that silence touches both windows.
    assert got == {0: "boundary", 1: "boundary", 3: "source-gap", 5: "source-gap", 7: "contaminated", 9: "unexplained"}


def test_truncated_and_sign(spark):
    base = int(W0.replace(tzinfo=dt.UTC).timestamp() * 1000)
    trades = spark.createDataFrame([("c1", "A", base + i, base + i) for i in range(5)], "conn_id string, symbol string, event_ms bigint, ingest_ms bigint")
    o, f = own(spark, [("A", 0, 1, 3, 3)]), official(spark, [("A", 0, 1, 5)])
    assert [r.verdict for r in dg.classify_mismatches(o, f, trades, H).collect()] == ["truncated"]
    s = dg.sign_distribution(cmp.mismatches(o, f)).first()
    assert (s.positive, s.negative, s.reading) == (0, 1, "loss")


def test_alignment_probe_finds_end_labels(spark):
    o = own(spark, [("A", h, h, 10 + h, 1) for h in range(1, 8)])
    f = official(spark, [("A", h + 1, h, 10 + h) for h in range(1, 8)])
    got = {r.shift_ms: r.vol_exact for r in cmp.alignment_probe(o, f, H).collect()}
    assert got[-H] == 7 and got.get(0, 0) == 0


def test_late_by_hand(spark):
    t0 = 1_700_000_040_000
    rows = [(i, "A", e, t0 + i, 0) for i, e in enumerate((t0, t0 + 300_000, t0 + 30_000))]
    df = spark.createDataFrame(rows, "id bigint, symbol string, event_ms bigint, ingest_ms bigint, kafka_partition int")
    for per in (None, 1):
        r = od.watermark_sweep(df, "id", 60_000, [0, 600_000], [1, 3], rows_per_slice=per).collect()
        assert {(x.partitions, x.delay_ms): x.late for x in r} == {(1, 0): 1, (1, 600_000): 0, (3, 0): 0, (3, 600_000): 0}


def test_sliced_sweep_and_offsets_equal_unsliced(spark):
    r = random.Random(2)
    rows = [(i, "hot" if i % 3 else "B", 1000 * r.randrange(500), 1000 * r.randrange(300), i % 3) for i in range(500)]
    df = spark.createDataFrame(rows, "id bigint, symbol string, event_ms bigint, ingest_ms bigint, kafka_partition int")
    one = sorted(map(tuple, od.watermark_sweep(df, "id", 60_000, [0, 50_000], [1, 3]).collect()))
    assert one == sorted(map(tuple, od.watermark_sweep(df, "id", 60_000, [0, 50_000], [1, 3], rows_per_slice=30).collect()))
    a = {x.id: x.kafka_offset for x in od.with_offsets(df, "id").collect()}
    assert a == {x.id: x.kafka_offset for x in od.with_offsets(df, "id", rows_per_slice=40).collect()}


def test_gap_compression_and_range(spark):
    rows = [(1, 0, 0), (2, 1_000, 5), (3, 100_000, 9), (4, 100_500, 9)]
    df = spark.createDataFrame(rows, "id bigint, ingest_ms bigint, event_ms bigint")
    for per in (None, 1):
        got = {r.id: (r.offset_ms, r.send_at_ms) for r in rp.replay_schedule(df, "id", 5_000, 2.0, per).collect()}
        assert got == {1: (0, 0), 2: (1_000, 500), 3: (6_000, 3_000), 4: (6_500, 3_250)}
        assert sorted(r.id for r in rp.arrival_range(df, "id", 1, 2, rows_per_slice=per).collect()) == [2, 3]


def test_histogram_quantile_is_linear_inside_the_bucket(spark):
    df = spark.createDataFrame([(0, 60), (0, 70), (0, 80), (0, 90)], "event_ms bigint, ingest_ms bigint")
    assert abs(od.lag_quantiles(df, [0.5]).first().p50 - 0.075) < 1e-12
    far = spark.createDataFrame([(0, 99_000)], "event_ms bigint, ingest_ms bigint")
    assert od.lag_quantiles(far, [0.99]).first().p99 == 30.0


def test_counter_restart_and_holding_time(spark):
    s = spark.createDataFrame([(i, i * 60_000, "x", v) for i, v in enumerate((5.0, 8.0, 2.0, 4.0))], "id bigint, ts_ms bigint, k string, value double")
    assert [r.gain for r in mo.increments(s, ["k"], "id").orderBy("id").collect()] == [0.0, 3.0, 2.0, 2.0]
    e = spark.createDataFrame([(i * 60_000, c) for i, c in enumerate((True, True, False, True, True, True))], "eval_ms bigint, c boolean")
    fired = mo.firing_steps(e, [], F.col("c"), 120_000, 60_000).collect()
    assert [(r.eval_ms, r.since_ms) for r in fired] == [(300_000, 180_000)]


def test_inhibition_and_unread(spark):
    a = spark.createDataFrame([(1, 0), (2, 0), (3, 0)], "eval_ms bigint, since_ms bigint")
    b = spark.createDataFrame([(2, 0)], "eval_ms bigint, since_ms bigint")
    assert sorted(r.eval_ms for r in mo.inhibit(a, b).collect()) == [1, 3]
    ends = spark.createDataFrame([("t", 0, 9.0), ("t", 1, 9.0), ("t", 2, 0.0)], "topic string, partition int, value double")
    com = spark.createDataFrame([("t", 0, -1.0), ("t", 0, 4.0), ("t", 1, -1.0), ("t", 2, -1.0)], "topic string, partition int, value double")
    assert [r.partition for r in mo.unread_partitions(ends, com).collect()] == [1]
    lag = mo.known_lag(com, ["topic"]).first()
    assert (lag.lag, lag.lag_with_unknown) == (4.0, 1.0)
