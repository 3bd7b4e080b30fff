"""Stateful batch bodies, writers and guarantees. Bodies are called batch by batch where the engine
itself adds nothing; the real engine runs in the last tests and in the registered queries."""

import datetime as dt
from decimal import Decimal as D
from types import SimpleNamespace

import pytest

from tapecheck.operators.compare import sink_comparison
from tapecheck.schema import CANDLE, TRADE
from tapecheck.settings import CandleSettings, shared_dir
from tapecheck.sources import stores, trades as tr
from tapecheck.streaming import candles as sc, job, sinks
from tapecheck.streaming.sequence import SequenceStage
from tapecheck.streaming.strict import StrictCandles

T = 1_700_000_000_000 - 1_700_000_000_000 % 60_000


def batch(spark, *rows):
    """rows: (event_ms, price[, symbol])"""
    full = [
        (r[2] if len(r) > 2 else "A", r[0], 0, r[0], D(r[1]), D(1), "KRW", "c1", i + 1, 0, i)
        for i, r in enumerate(rows)
    ]
    return spark.createDataFrame(full, TRADE)


def strict(spark, **cfg):
    return StrictCandles(shared_dir(spark, "t"), CandleSettings(run_id="r", watermark_delay_ms=0, **cfg))


def test_third_record_is_late(spark):
    s = strict(spark)
    for n, e in enumerate((T, T + 300_000, T + 30_000)):
        s(batch(spark, (e, 10)), n)
    letters = s.written_letters(spark).collect()
    assert [(x.stage, x.reason, x.symbol) for x in letters] == [("window", "late-window", "A")]
    assert letters[0].payload.startswith(f'{{"event_ms":{T + 30_000},"seq_in_ms":0,"price":"10.0000","volume":"1.00000000","conn_id":"c1"')
    out = s.written_candles(spark).collect()
    assert len(out) == 1 and out[0].trade_count == 1


def test_lateness_re_emits_the_whole_candle(spark):
    s = strict(spark, allowed_lateness_ms=600_000)
    for n, (e, p) in enumerate(((T, 10), (T + 300_000, 20), (T + 30_000, 30), (T + 900_000, 5), (T + 40_000, 1))):
        s(batch(spark, (e, p)), n)
    first = sorted((c.batch_id, c.close, c.trade_count) for c in s.written_candles(spark).collect() if c.open == D(10))
    assert first == [(1, D(10), 1), (2, D(30), 2)]
    assert s.written_letters(spark).count() == 1


def test_running_a_batch_again_changes_nothing(spark):
    s = strict(spark)
    s(batch(spark, (T, 10), (T + 1, 11)), 0)
    for _ in range(2):
        s(batch(spark, (T + 120_000, 12)), 1)
    out = s.written_candles(spark).collect()
    assert [(c.trade_count, c.close) for c in out] == [(2, D(11))]
    assert s.progress.at(spark, 1).first().wm_ms == T + 120_000


def test_watermark_never_moves_back_and_empty_batch(spark):
    s = strict(spark)
    s(batch(spark, (T + 600_000, 1)), 0)
    s(batch(spark, (T, 1)), 1)
    s(batch(spark).limit(0), 2)
    assert s.progress.at(spark, 2).first().wm_ms == T + 600_000
    assert s.written_letters(spark).count() == 1


def numbered(spark, *batches, horizon=120_000):
    st = SequenceStage(shared_dir(spark, "q"), "kafka_offset BIGINT, symbol STRING, event_ms BIGINT, ingest_ms BIGINT", "kafka_offset", horizon)
    at = 0
    for n, rows in enumerate(batches):
        full = []
        for sym, e in rows:
            full.append((sym, e, 0, 10_000 + at, D(1), D(1), "KRW", "c", at, 0, at))
            at += 1
        st(spark.createDataFrame(full, TRADE), n)
    out = st.out.all(spark).orderBy("kafka_offset").collect()
    return st, [(r.seq_in_ms, r.out_of_order) for r in out]


def test_sequence_cases(spark):
    a = lambda *es: [("A", e) for e in es]
    assert [x for x, _ in numbered(spark, a(1000, 1000), a(1000))[1]] == [0, 1, 2]
    assert [x for x, _ in numbered(spark, a(1000, 1001), a(1000, 1000))[1]] == [0, 0, 1, 2]
    assert numbered(spark, a(2000, 2001), a(1999, 1998))[1] == [(0, 0), (0, 0), (0, 1), (0, 1)]
    assert [x for x, _ in numbered(spark, a(1000) + [("B", 1000)])[1]] == [0, 0]


def test_sequence_keys_stay_unique_under_shuffle(spark):
    es = [1000, 1002, 1000, 1001, 1002, 1000, 1001, 1001, 1002, 1000]
    got = numbered(spark, [("A", e) for e in es[:4]], [("A", e) for e in es[4:]])[1]
    assert len({(e, s) for e, (s, _) in zip(es, got)}) == 10


def test_sequence_horizon(spark):
    st, _ = numbered(spark, [("A", 1_000_000 + i) for i in range(500)], [("A", 1_130_000)])
    assert st.counters.at(spark, 1).count() < 500


def candle_batch(spark, n=2):
    w = dt.datetime(2024, 1, 1)
    rows = [("A", w + dt.timedelta(minutes=i), D(1), D(1), D(1), D(1), D(1), 1, w, "r") for i in range(n)]
    return spark.createDataFrame(rows, CANDLE)


def test_append_shows_duplicates_and_overwrite_does_not(spark):
    a, b = shared_dir(spark, "a"), shared_dir(spark, "b")
    for _ in range(2):
        sinks.append_only(a)(candle_batch(spark), 0)
        sinks.by_batch(b)(candle_batch(spark), 0)
    got = {r.store: (r.windows, r.rows_written, r.duplicated_windows) for r in sink_comparison({"a": spark.read.parquet(a), "b": spark.read.parquet(b)}).collect()}
    assert got == {"a": (2, 4, 2), "b": (2, 2, 0)}


def test_retry_then_fail(spark):
    calls = []

    def flaky(_b, _n):
        calls.append(1)
        if len(calls) < 3:
            raise OSError("busy")

    sinks.with_retries(flaky, wait_s=0)(candle_batch(spark), 0)
    assert len(calls) == 3

    def broken(_b, _n):
        raise OSError("down")

    with pytest.raises(OSError):
        sinks.with_retries(broken, wait_s=0)(candle_batch(spark), 0)


def test_second_store_must_not_stop_the_first(spark):
    a, seen = shared_dir(spark, "a"), []

    def broken(_b, _n):
        raise OSError("catalog away")

    sinks.fan_out(sinks.append_only(a), broken, lambda n, e: seen.append((n, str(e))))(candle_batch(spark), 5)
    assert spark.read.parquet(a).count() == 2 and seen == [(5, "catalog away")]
    with pytest.raises(OSError):
        sinks.fan_out(broken, sinks.append_only(a))(candle_batch(spark), 6)


def test_candle_row_requires_run_id(spark):
    c = candle_batch(spark, 1).drop("ingested_at", "run_id")
    r = sinks.candle_row(c).first()
    assert r.run_id == "" and abs(r.ingested_at - dt.datetime.now(dt.UTC).replace(tzinfo=None)) < dt.timedelta(minutes=2)


def test_day_layout_prunes_and_retains(spark):
    c = candle_batch(spark, 3000)
    path = stores.write_by_day(c, "window_start", "candles_1m")
    day2 = stores.read_days(spark, path, first_day="2024-01-02", last_day="2024-01-02")
    assert day2.count() == 1440
    assert "PartitionFilters: [isnotnull(day" in day2._jdf.queryExecution().executedPlan().toString()
    assert stores.drop_expired_days(spark.read.parquet(path), 1, "2024-01-03").select("day").distinct().count() == 2


def test_create_table_twice(spark):
    path = shared_dir(spark, "tbl")
    for _ in range(2):
        stores.create_table(spark, "candles_1m_test", CANDLE, path)
    assert "day" in spark.table("candles_1m_test").columns
    spark.sql("DROP TABLE candles_1m_test")


def test_stream_equals_batch_and_new_files_are_picked_up(spark):
    """Land, run, land again (a partition nobody saw before), run: same candles as one batch. A
    record far in the future per symbol closes every window."""
    from tapecheck.operators.candles import candles

    base, landing = shared_dir(spark, "s"), shared_dir(spark, "landing")
    cfg = CandleSettings(run_id="r", second_store=True)
    paths = job.JobPaths(base)
    real = batch(spark, *[(T + 7_000 * i, 10 + i % 5, "AB"[i % 2]) for i in range(60)])
    sentinel = batch(spark, (T + 86_400_000, 1, "A"), (T + 86_400_000, 1, "B"))
    session = sc.stream_session(spark)
    for part, df in enumerate((real.filter("event_ms < %d" % (T + 200_000)), real.filter("event_ms >= %d" % (T + 200_000)), sentinel)):
        job.land_block(tr.keyed_records(df).selectExpr("key", "value", f"{part} as partition", "0L as offset"), landing)
        stream = tr.landed_stream(session, landing)
        job.start_candles(stream, cfg, paths).awaitTermination()
    job.start_dead_letters(tr.landed_stream(session, landing), cfg, paths).awaitTermination()
    want = sorted(tuple(r) for r in candles(real, 60_000).collect())
    for store in ("candles", "candles_second"):
        got = spark.read.parquet(paths.at(store)).select("symbol", "window_start", "open", "high", "low", "close", "volume", "trade_count")
        assert sorted(tuple(r) for r in got.collect()) == want


def test_shared_dir_follows_the_cluster_setting():
    class Conf:
        def __init__(self, v):
            self.v = v

        def get(self, _k, default=None):
            return self.v or default

    def session(setting, master):
        context = SimpleNamespace(getConf=lambda: Conf(None), master=master)
        return SimpleNamespace(conf=Conf(setting), sparkContext=context)

    assert shared_dir(session("/shared/ck/", "yarn"), "x").startswith("/shared/ck/x-")
    with pytest.raises(RuntimeError):
        shared_dir(session(None, "yarn"), "x")
    assert shared_dir(session(None, "local[2]"), "x")
