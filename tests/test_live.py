"""The wired job, its positions and counters, merging stores, and plans that must stay hash aggregates."""

import datetime as dt
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from tapecheck.functions.timecols import wall_clock
from tapecheck.operators import dedup, letters as lt, replay as rp
from tapecheck.operators.candles import candles
from tapecheck.plans.queries_streaming import second_store_with_outages
from tapecheck.schema import CANDLE, OFFICIAL_CANDLE, TRADE
from tapecheck.settings import CandleSettings, shared_dir
from tapecheck.sources import derived as dv, stores, trades as tr
from tapecheck.sources.positions import open_position
from tapecheck.streaming import candles as sc, job, sinks
from tapecheck.streaming.live import LiveJob
from tapecheck.streaming.metrics import CounterLog, ProgressLog, counted
from tapecheck.streaming.sequence import numbered
from tapecheck.streaming.strict import StrictCandles

T = 1_700_000_000_000 - 1_700_000_000_000 % 3_600_000


def trades(spark, *rows):
    """rows: (event_ms, price[, seq_in_ms])"""
    full = [("A", r[0], r[2] if len(r) > 2 else 0, r[0], D(r[1]), D(1), "KRW", "c1", i + 1, 0, i) for i, r in enumerate(rows)]
    return spark.createDataFrame(full, TRADE)


def record(n, value):
    return ("A", value, 0, n)


def wire(event_ms, price, seq="0"):
    number = "" if seq is None else f'"seq_in_ms":{seq},'
    return f'{{"symbol":"A","event_ms":{event_ms},{number}"ingest_ms":{event_ms},"price":"{price}","volume":"1","conn_id":"c","recv_seq":1}}'


def landed(spark, path, *values, first=0):
    rows = [record(first + n, v) for n, v in enumerate(values)]
    spark.createDataFrame(rows, tr.LANDED).coalesce(1).write.mode("append").json(path)


# --- numbers in the millisecond ---


def test_missing_number_is_zero(spark):
    values = [wire(T + 1000, 1, None), wire(T + 2000, 2), wire(T + 1000, 7, "1"), wire(T + 3000, 3, "null")]
    good = lt.good_trades(lt.classify(spark.createDataFrame([record(n, v) for n, v in enumerate(values)], tr.LANDED)))
    c = candles(good, 60_000).first()
    assert (c.open, c.high, c.low, c.close, c.trade_count) == (1, 7, 1, 3, 4)
    # the fold itself too, for trades that never were records
    c = candles(trades(spark, (T + 2000, 2), (T + 1000, 1, None)), 60_000).first()
    assert (c.open, c.close) == (1, 2)
    c = candles(trades(spark, (T + 2000, 2), (T + 1000, 1, None)), 60_000, wide_numbers=True).first()
    assert (c.open, c.close) == (1, 2)


@pytest.mark.parametrize("seq", ["-1", str(1 << 20), str(2**31 - 1)])
def test_impossible_number_is_a_dead_letter(spark, seq):
    classified = lt.classify(spark.createDataFrame([record(0, wire(T, 1, seq)), record(1, wire(T, 2, str((1 << 20) - 1)))], tr.LANDED))
    assert [r.reason for r in classified.orderBy("offset").collect()] == ["malformed-number", None]
    assert candles(lt.good_trades(classified), 60_000).first().open == 2


# --- positions ---


def read_all(spark, start, landing, out):
    session = sc.stream_session(spark)
    q = sc.to_batches(start.after(tr.landed_stream(session, landing)), sinks.by_batch(out), f"{start.checkpoint}/q")
    q.awaitTermination()


def test_committed_resumes_and_latest_skips(spark):
    landing, base = shared_dir(spark, "l"), shared_dir(spark, "p")
    landed(spark, landing, "a", "b")
    one = open_position(spark, base, "committed")
    assert (one.position, one.generation, one.resumed) == ("earliest", 0, False)
    two = open_position(spark, base, "latest", tr.landed_batch(spark, landing))
    landed(spark, landing, "c", first=2)
    read_all(spark, two, landing, f"{base}/out")
    assert [r.value for r in spark.read.parquet(f"{base}/out").collect()] == ["c"]
    again = open_position(spark, base, "committed")
    assert (again.checkpoint, again.position, again.resumed) == (two.checkpoint, "latest", True)
    with pytest.raises(ValueError):
        open_position(spark, base, "middle")


def test_a_start_without_its_record_never_happened(spark):
    base = shared_dir(spark, "p")
    open_position(spark, base, "earliest")
    spark.range(1).write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(f"{base}/starts/1")
    assert open_position(spark, base, "committed").generation == 0


# --- counters ---


def test_counters_survive_a_batch_that_runs_again(spark):
    log, store = CounterLog(shared_dir(spark, "c")), shared_dir(spark, "s")
    cfg, broken = CandleSettings(watermark_delay_ms=0), [True]

    def write(batch, n):
        if broken[0] and n == 1:
            raise OSError("down")
        sinks.by_batch(store)(batch, n)

    body = counted(write, log, cfg, attempts=2, wait_s=0)
    body(trades(spark, (T, 1), (T + 600_000, 2)), 0)
    with pytest.raises(OSError):
        body(trades(spark, (T + 1, 3)), 1)
    broken[0] = False
    # another driver takes over: nothing but the folder remembers
    body = counted(write, CounterLog(log.table.path), cfg, attempts=2, wait_s=0)
    for _ in range(2):
        body(trades(spark, (T + 1, 3), (T + 700_000, 4)), 1)
    got = {r.metric: (r.value, r.batches) for r in log.totals(spark).collect()}
    assert got == {"records": (4, 2), "rows_written": (4, 2), "flush_failures": (2, 2), "late": (1, 2)}


def test_progress_log_keeps_what_the_engine_dropped(spark):
    landing, base = shared_dir(spark, "l"), shared_dir(spark, "b")
    session = sc.stream_session(spark)
    log = ProgressLog(session, f"{base}/progress")
    session.streams.addListener(log)
    try:
        for values in ([wire(T, 1)], [wire(T + 7_200_000, 2)], [wire(T + 1, 3), wire(T + 2, 4)]):
            landed(spark, landing, *values)
            rows = sc.window_candles(job.valid_trades(tr.landed_stream(session, landing)), CandleSettings(watermark_delay_ms=0))
            q = sc.to_batches(rows, sinks.by_batch(f"{base}/out"), f"{base}/ck")
            q.awaitTermination()
            log.wait_for(q)
    finally:
        session.streams.removeListener(log)
    total = {r.metric: r.v for r in log.samples().groupBy("metric").agg(F.sum("value").alias("v")).collect()}
    # both late records fall into one window: the engine counts what is left after its partial aggregate
    assert total["input_rows"] == 4 and total["records"] == 4 and total["late_dropped_by_engine"] == 1


# --- the wired job ---


def run_live(spark, landing, paths, cfg, **how):
    live = LiveJob(spark, cfg, paths, open_position(spark, paths.at("_positions"), cfg.start_position, tr.landed_batch(spark, landing)), **how)
    try:
        live.start(tr.landed_stream(live.session, landing)).drain()
    finally:
        live.stop()
    return live


@pytest.mark.parametrize("strict", [False, True])
def test_live_job_resumes(spark, strict):
    landing, paths = shared_dir(spark, "l"), job.JobPaths(shared_dir(spark, "j"))
    cfg = CandleSettings(watermark_delay_ms=0, trigger="50 milliseconds", second_store=True, run_id="r", candles_table="own")
    landed(spark, landing, wire(T, 1), wire(T + 60_000, 2), "{broken")
    run_live(spark, landing, paths, cfg, strict=strict)
    landed(spark, landing, wire(T + 30_000, 9), wire(T + 120_000, 3), wire(T + 121_000, 4, "-5"), first=3)
    run_live(spark, landing, paths, cfg, strict=strict)
    first = spark.read.parquet(paths.at("strict/0/candles" if strict else "own")).select("window_start", "open", "trade_count")
    second = spark.read.parquet(paths.at("own_second/0")).select("window_start", "open", "trade_count")
    want = [(dt.datetime.fromtimestamp((T + k * 60_000) / 1000, dt.UTC).replace(tzinfo=None), D(k + 1), 1) for k in range(2)]
    assert sorted(map(tuple, first.collect())) == sorted(map(tuple, second.collect())) == want
    assert spark.read.parquet(paths.at("trades_raw")).count() == 4
    assert sorted(r.reason for r in spark.read.parquet(paths.at("dead_letters")).collect()) == ["malformed-json", "malformed-number"]


def test_live_job_without_archive_and_restart_of_a_query(spark):
    landing, paths = shared_dir(spark, "l"), job.JobPaths(shared_dir(spark, "j"))
    cfg = CandleSettings(watermark_delay_ms=0, trigger="50 milliseconds", archive_trades=False)
    landed(spark, landing, wire(T, 1), wire(T + 60_000, 2))
    live = LiveJob(spark, cfg, paths, open_position(spark, paths.at("_positions"), "committed"))
    made = live._starters

    def starters(records):
        out, tries = made(records), []

        def flaky():
            def write(batch, n):
                tries.append(n)
                if len(tries) < 3:
                    raise OSError("away")
                sinks.by_batch(paths.at("own"))(batch, n)

            rows = live.session.readStream.schema("reason STRING").parquet(live.landing)
            return sc.to_batches(rows, write, paths.at("flaky"), {"processingTime": "50 milliseconds"})

        return out | {"flaky": flaky}

    live._starters = starters
    try:
        live.start(tr.landed_stream(live.session, landing)).drain()
        assert set(live.queries) == {"ingest", "candles", "letters", "flaky"} and live.failed == {"flaky": 2}
        assert spark.read.parquet(paths.at("own")).count() == 2
    finally:
        live.stop()


def test_job_that_keeps_failing_stops(spark):
    landing, paths = shared_dir(spark, "l"), job.JobPaths(shared_dir(spark, "j"))
    landed(spark, landing, wire(T, 1))
    live = LiveJob(spark, CandleSettings(trigger="50 milliseconds"), paths, open_position(spark, paths.at("_positions"), "committed"), restarts=1)
    made = live._starters

    def broken(batch, n):
        raise OSError("away")

    live._starters = lambda records: made(records) | {
        "letters": lambda: sc.to_batches(live.session.readStream.schema("reason STRING").parquet(live.landing), broken, paths.at("x"), {"processingTime": "50 milliseconds"})
    }
    with pytest.raises(RuntimeError, match="letters failed 2 times"):
        live.start(tr.landed_stream(live.session, landing)).run(poll_s=0.1, for_s=60)
    assert not live.queries


# --- second store in the strict path ---


def test_strict_path_serves_both_stores(spark):
    base, lost = shared_dir(spark, "s"), []
    calls = []

    def second(rows, n):
        calls.append(n)
        if n == 1:
            raise OSError("away")
        sinks.by_batch(f"{base}/second")(rows, n)

    s = StrictCandles(f"{base}/first", CandleSettings(run_id="r", watermark_delay_ms=0, allowed_lateness_ms=600_000), second, lambda n, e: lost.append(n))
    for n, e in enumerate((T, T + 60_000, T + 120_000, T + 1)):
        s(trades(spark, (e, 10 + n)), n)
    assert lost == [1] and calls == [0, 1, 2, 3]
    first = s.written_candles(spark)
    # batch 1 is missing there, and batch 3 wrote the first window again: only what is missing is copied
    assert first.count() == 3 and spark.read.parquet(f"{base}/second").count() == 2
    assert sinks.refill_second(spark, f"{base}/first/candles", f"{base}/second") == 1
    assert sinks.refill_second(spark, f"{base}/first/candles", f"{base}/second") == 0


def test_old_batches_are_packed(spark):
    s = StrictCandles(shared_dir(spark, "s"), CandleSettings(run_id="r", watermark_delay_ms=0), pack_every=3)
    for n in range(8):
        s(trades(spark, (T + n * 60_000, 10 + n), (T + 1, 1)), n)
    got = sorted((r.batch_id, int(r.open), r.trade_count) for r in s.written_candles(spark).collect())
    assert got == [(1, 10, 3)] + [(n, 9 + n, 1) for n in range(2, 8)]
    assert sorted(r.batch_id for r in s.written_letters(spark).collect()) == list(range(2, 8))
    assert s.candles._packs(spark) == [1, 4] and not s.candles.has(spark, 4) and s.candles.has(spark, 5)
    # a pack that was written although its folders are still there counts once, and so does one that is made again
    s.candles.write(s.candles.all(spark).where("batch_id = 4").drop("batch_id"), 4)
    assert s.written_candles(spark).count() == 7 and s.candles.pack(spark, 4) == 0
    s(trades(spark, (T + 900_000, 5)), 8)
    assert s.written_candles(spark).count() == 8


def test_numbers_from_the_state_store(spark):
    """Three batches: numbers go on across batches, a closed cell gives none, a key's cells are independent."""
    landing, base = shared_dir(spark, "l"), shared_dir(spark, "b")
    rows = [
        ("A", 1000, 5_000, 1, 0), ("A", 1000, 4_000, 2, 0), ("B", 1000, 4_500, 3, 0), ("A", 12_000, 13_000, 4, 0),
        ("A", 1000, 14_000, 5, 1), ("A", 1001, 14_500, 6, 1), ("A", 12_000, 40_000, 7, 1),
        ("A", 1000, 41_000, 8, 2), ("B", 39_000, 42_000, 9, 2), ("A", 12_000, 43_000, 10, 2),
    ]
    df = spark.createDataFrame(rows, "symbol string, event_ms bigint, ingest_ms bigint, id bigint, block int")
    assert tr.land_in_order(df, "block", landing) == 3
    session = sc.stream_session(spark)
    stream = session.readStream.schema("symbol string, event_ms bigint, ingest_ms bigint, id bigint").option("maxFilesPerTrigger", 1).json(f"{landing}/*")
    sc.to_batches(numbered(stream, "id", cell_ms=10_000, horizon_ms=15_000), sinks.by_batch(f"{base}/out"), f"{base}/ck").awaitTermination()
    got = {r.tie: (r.seq_in_ms, r.late) for r in spark.read.parquet(f"{base}/out").collect()}
    # the third batch begins at 40 s: the cells up to 10 s and 20 s closed at 25 s and 35 s
    assert got == {
        2: (0, False), 1: (1, False), 3: (0, False), 4: (0, False), 5: (2, False), 6: (0, False), 7: (1, False), 8: (None, True), 9: (0, False), 10: (None, True),
    }


# --- stores ---


def official(spark, *rows):
    """rows: (minute, volume, fetched minute)"""
    t = dt.datetime(2024, 1, 1)
    full = [("A", t + dt.timedelta(minutes=m), D(1), D(1), D(1), D(1), D(v), t + dt.timedelta(minutes=f)) for m, v, f in rows]
    return spark.createDataFrame(full, OFFICIAL_CANDLE)


def test_merge_touches_its_days_only(spark):
    path, keys = shared_dir(spark, "o"), stores.SORT_KEYS["candles_1m_official"]

    def merge(*rows):
        days = stores.merge_latest(spark, path, official(spark, *rows), "window_start", dedup.latest_official, keys)
        spark.catalog.refreshByPath(path)
        return days, {r.day.isoformat(): r.file for r in stores.day_files(spark, path).collect()}

    days, first = merge((0, 1, 10), (1440, 1, 10))
    assert days == ["2024-01-01", "2024-01-02"] == sorted(first)
    days, second = merge((1440, 5, 20), (1441, 1, 20), (2880, 1, 20))
    assert days == ["2024-01-02", "2024-01-03"] and second["2024-01-01"] == first["2024-01-01"]
    days, third = merge((1440, 7, 5))  # an older fetch loses
    got = sorted((r.window_start.minute, r.day.day, int(r.volume)) for r in spark.read.parquet(path).collect())
    assert got == [(0, 1, 1), (0, 2, 5), (0, 3, 1), (1, 2, 1)]
    assert merge()[0] == [] and third["2024-01-03"] == second["2024-01-03"]


def candle_rows(spark, n):
    w = dt.datetime(2024, 1, 1)
    return spark.createDataFrame([("A", w + dt.timedelta(hours=i), D(1), D(1), D(1), D(1), D(1), 1, w, "r") for i in range(n)], CANDLE)


@pytest.mark.parametrize("external", [True, False])
def test_expired_partitions_are_gone(spark, external):
    name, path = f"expire_{external}".lower(), shared_dir(spark, "t")
    stores.create_table(spark, name, CANDLE, path if external else None)
    try:
        candle_rows(spark, 96).withColumn("day", F.to_date("window_start")).write.insertInto(name)
        where = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()}["Location"]
        assert stores.expire_days(spark, name, 1, "2024-01-04") == ["2024-01-01", "2024-01-02"]
        assert stores.read_table(spark, name).select("day").distinct().count() == 2
        assert spark.read.parquet(where).select("day").distinct().count() == 2
        assert stores.expire_days(spark, name, 1, "2024-01-04") == []
    finally:
        spark.sql(f"DROP TABLE {name}")


def test_wrong_schema_stops_the_job(spark):
    path = shared_dir(spark, "t")
    stores.create_table(spark, "wrong_schema", CANDLE, path)
    try:
        stores.create_table(spark, "wrong_schema", CANDLE, path)
        with pytest.raises(ValueError, match="fetched_at"):
            stores.create_table(spark, "wrong_schema", OFFICIAL_CANDLE, path)
        stream = spark.readStream.schema(CANDLE).parquet(shared_dir(spark, "none") + "*").withColumn("trade_count", F.col("trade_count").cast("int"))
        with pytest.raises(ValueError, match="trade_count int, not bigint"):
            stores.stream_to_table(stream, "wrong_schema", CANDLE, "window_start", shared_dir(spark, "ck"), path)
    finally:
        spark.sql("DROP TABLE wrong_schema")


def test_compaction_packs_small_files(spark):
    path = shared_dir(spark, "t")
    for n in range(5):
        stores.write_by_day(candle_rows(spark, 48).where(F.hour("window_start") % 5 == n), "window_start", "candles_1m", path=path)
    stores.write_by_day(candle_rows(spark, 72).where("window_start >= '2024-01-03'"), "window_start", "candles_1m", path=path)
    before = {r.file for r in stores.day_files(spark, path).collect()}
    rows = sorted(map(tuple, spark.read.parquet(path).collect()))
    size = max(r.bytes for r in stores.day_files(spark, path).collect() if r.day.day < 3)
    assert stores.compact(spark, path, target_bytes=2 * size + size // 2) == ["2024-01-01", "2024-01-02"]
    spark.catalog.refreshByPath(path)
    after = stores.day_files(spark, path).collect()
    per_day = sorted((r.day.day, r.rows) for r in after)
    assert all([d for d, _ in per_day].count(k) in (2, 3) for k in (1, 2))  # five files, two to three in a bin
    assert sum(r.day.day == 3 and r.file in before for r in after) == 1
    assert sorted(map(tuple, spark.read.parquet(path).collect())) == rows
    assert stores.compact(spark, path, target_bytes=size) == []


def test_scan_counts_in_one_pass(spark):
    landing, store = shared_dir(spark, "l"), shared_dir(spark, "s")
    landed(spark, landing, wire(T, 1), "{broken", "[]", wire(T, "x"), wire(T, 2))
    assert rp.scan_records(tr.landed_batch(spark, landing), store) == {"records": 5, "good": 2, "malformed": 2, "unusable": 1}
    assert spark.read.parquet(store).count() == 2


# --- windows in the stream ---


def test_open_windows_of_a_stopped_query(spark):
    landing, base = shared_dir(spark, "l"), shared_dir(spark, "b")
    landed(spark, landing, wire(T, 1), wire(T + 61_000, 2), wire(T + 62_000, 3))
    rows = sc.window_candles(lt.good_trades(lt.classify(tr.landed_stream(sc.stream_session(spark), landing))), CandleSettings(watermark_delay_ms=0))
    sc.to_batches(rows, sinks.by_batch(f"{base}/out"), f"{base}/ck").awaitTermination()
    left = sc.open_windows(spark, f"{base}/ck").withColumn("is", F.col("window_start") == wall_clock(F.lit(T + 60_000))).collect()
    assert [(r.symbol, r.trade_count, r["is"]) for r in left] == [("A", 2, True)]


def test_rollup_needs_a_multiple(spark):
    with pytest.raises(ValueError):
        sc.rolled_up(trades(spark, (T, 1)), CandleSettings(window_ms=7_000), 60_000)


@pytest.mark.parametrize("stretch", [3, 1000])
def test_each_window_of_a_long_silence(spark, monkeypatch, stretch):
    from tapecheck.functions import timecols

    monkeypatch.setattr(timecols, "STRETCH", stretch)
    spans = [(1, 0, 70), (2, 50, 50), (3, 60, 50), (4, 0, 60), (5, -20, 0)]
    got = timecols.each_window(spark.createDataFrame(spans, "k int, a bigint, b bigint"), "a", "b", 10, "w").collect()
    assert sorted((r.k, r.w) for r in got) == [(k, w) for k, a, b in spans for w in range(a, b + 1, 10)]


# --- plans ---


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_latest_writes_stay_hash_aggregates(spark, sf_dir):
    from tapecheck.plans import catalog

    for name in ("agg4_candles_latest", "snk9_official_latest", "agg12_dead_letter_summary", "jn1_candle_diff", "jn3_scorecard", "mon5_lag_growing"):
        names = [n for n in catalog.QUERIES if n == name or n.startswith(name.split("_")[0] + "_") and name.startswith("snk9") and "latest" in n]
        for n in names:
            assert "SortAggregate" not in plan_of(catalog.QUERIES[n](spark, sf_dir)), n


def test_equal_write_times_follow_the_run(spark):
    w = dt.datetime(2024, 1, 1)
    rows = [("A", w, D(k), D(k), D(k), D(k), D(k), k, w, run) for k, run in ((1, "r2"), (2, "r10"), (3, ""), (4, None))]
    rows += [("B", w, D(k), D(k), D(k), D(k), D(k), k, at, "r") for k, at in ((1, w), (2, w + dt.timedelta(microseconds=1)), (3, None))]
    got = {r.symbol: (int(r.open), r.trade_count, r.write_count) for r in dedup.latest_candles(spark.createDataFrame(rows, CANDLE)).collect()}
    assert got == {"A": (1, 1, 4), "B": (2, 2, 3)}


def test_second_store_is_refilled_also_from_packed_folders_and_rewritten_windows(spark, sf_dir):
    tape = dv.disordered(dv.events_trades(spark, sf_dir))
    for lateness in (0, 7_200_000):
        strict, second, refilled = second_store_with_outages(spark, tape, lateness)
        first = strict.written_candles(spark).drop("batch_id")
        there = spark.read.parquet(second).select(*first.columns)
        assert 0 < refilled < first.count() == there.count()
        assert first.exceptAll(there).count() == 0
        assert sinks.refill_second(spark, first, second) == 0
    assert first.count() > first.select("symbol", "window_start").distinct().count()
