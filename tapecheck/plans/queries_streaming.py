"""Streaming jobs run to the end of landed data, and the fault experiments.

Trades are landed block by block in arrival order; after each block the query runs until it has
caught up. The SQL next to each query computes the same outcome from the rules alone.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, functions as F

from tapecheck.functions.timecols import bucket_start, wall_clock
from tapecheck.operators import compare as cmp, letters as lt
from tapecheck.plans import sqlparts as s
from tapecheck.plans.catalog import query
from tapecheck.schema import BARE_CANDLE, CANDLE, STORED_TRADE
from tapecheck.settings import DAY_MS, HOUR_MS, CandleSettings, shared_dir
from tapecheck.sources import derived as dv, derived_text as tx, stores, trades as tr
from tapecheck.streaming import candles as sc, job, sinks
from tapecheck.streaming.sequence import SequenceStage
from tapecheck.streaming.strict import StrictCandles

# Arrival blocks: eight days each, cut twenty minutes before the hour so that windows stay open.
_BLOCK_MS, _BLOCK_SHIFT = 691_200_000, 1_200_000
_CFG = CandleSettings(window_ms=HOUR_MS, watermark_delay_ms=5_000, run_id="r1")


def _with_block(trades: DataFrame) -> DataFrame:
    return trades.withColumn("block", F.expr(f"(ingest_ms + {_BLOCK_SHIFT}) div {_BLOCK_MS}"))


def _records(trades: DataFrame, *more: str) -> DataFrame:
    return trades.select(
        F.col("symbol").alias("key"), tr.wire_json().alias("value"), F.col("kafka_partition").alias("partition"),
        F.col("event_id").alias("offset"), *more,
    )


def _landed_blocks(spark, trades: DataFrame, landing: str) -> Iterator[int]:
    """Land one block after the other; the trades are read once for all of them."""
    staged = shared_dir(spark, "staged")
    for b in job.stage_blocks(_records(_with_block(trades), "block"), staged):
        job.land_staged(spark, staged, b, landing)
        yield b


def _run(spark, trades: DataFrame, start, landing: str | None = None) -> None:
    """Land each block, then let ``start(stream)`` run until it has read everything landed."""
    landing = landing or shared_dir(spark, "landing")
    session = sc.stream_session(spark)
    for _ in _landed_blocks(spark, trades, landing):
        start(tr.landed_stream(session, f"{landing}/*", fmt="parquet")).awaitTermination()


def _wm(source: str, delay: int = 5_000) -> str:
    return f"""blk AS (SELECT *, (ingest_ms + {_BLOCK_SHIFT}) // {_BLOCK_MS} - (SELECT min((ingest_ms + {_BLOCK_SHIFT}) // {_BLOCK_MS}) FROM {source}) AS b
        FROM {source}),
wm AS (SELECT b, max(max(event_ms)) OVER (ORDER BY b) - {delay} AS wm FROM blk GROUP BY b)"""


def _judged(lateness: int = 0) -> str:
    return f"""judged AS (
  SELECT t.*, t.event_ms - t.event_ms % {HOUR_MS} AS ws,
         p.wm IS NOT NULL AND t.event_ms - t.event_ms % {HOUR_MS} + {HOUR_MS} + {lateness} <= p.wm AS late
  FROM blk t LEFT JOIN wm p ON p.b = t.b - 1)"""


_D = [s.TRADES, s.DISORDERED, _wm("disordered")]
_CLOSED = f"ws + {HOUR_MS} <= (SELECT max(wm) FROM wm)"
_COLS = "symbol, window_start, open, high, low, close, volume, trade_count"
_STREAM_CANDLES = s.with_([*_D, _judged(), f"c AS ({s.ohlcv('judged', HOUR_MS, f'NOT late AND {_CLOSED}')})"], f"SELECT {_COLS} FROM c")


def _disordered(spark, d):
    return dv.disordered(dv.events_trades(spark, d))


@query(
    "src1_trade_stream",
    s.with_([s.TRADES],
            "SELECT symbol, event_ms, seq_in_ms, ingest_ms, price, volume, conn_id, recv_seq, kafka_partition, event_id AS kafka_offset FROM trades"),
)
def _(spark, d):
    landing, out, ck = (shared_dir(spark, x) for x in ("landing", "trades", "ck"))
    job.land_block(_records(dv.events_trades(spark, d)), landing)
    stream = lt.good_trades(lt.classify(tr.landed_stream(sc.stream_session(spark), landing)))
    stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", ck).trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(out).drop("currency")


@query("str5_stream_candles", _STREAM_CANDLES)
def _(spark, d):
    out, ck = shared_dir(spark, "candles"), shared_dir(spark, "ck")

    def start(stream):
        return sc.to_files(sc.window_candles(job.valid_trades(stream), _CFG), out, ck, "window_start")

    _run(spark, _disordered(spark, d), start)
    return stores.read_written(spark, out, BARE_CANDLE).drop("day")


@query(
    "snk4_transactional_store",
    s.with_(
        [s.TRADES, f"c AS ({s.ohlcv('trades', HOUR_MS)})"],
        f"SELECT {_COLS} FROM c WHERE epoch_ms(window_start) + {HOUR_MS} + 5000 <= (SELECT max(event_ms) FROM trades)",
    ),
)
def _(spark, d):
    # Straight from the columnar source; files become visible only with the sink's commit log.
    out, ck = shared_dir(spark, "candles"), shared_dir(spark, "ck")
    session = sc.stream_session(spark)
    schema = spark.read.parquet(f"{d}/events.parquet").schema
    events = session.readStream.schema(schema).parquet(f"{d}/events.parquet*")
    sc.to_files(sc.window_candles(dv.trades_from_events(events), _CFG), out, ck, "window_start").awaitTermination()
    return stores.read_written(spark, out, BARE_CANDLE).drop("day")


def _stream_lineitem(spark, d, symbol: str):
    out, ck = shared_dir(spark, "candles"), shared_dir(spark, "ck")
    session = sc.stream_session(spark)
    schema = spark.read.parquet(f"{d}/lineitem.parquet").schema
    lines = session.readStream.schema(schema).parquet(f"{d}/lineitem.parquet*")
    cfg = CandleSettings(window_ms=DAY_MS, watermark_delay_ms=5_000)
    candles = sc.window_candles(dv.trades_from_lineitem(lines, symbol), cfg)
    sc.to_batches(candles, sinks.by_batch(out), ck).awaitTermination()
    return spark.read.parquet(out).drop("batch_id")


def _stream_lineitem_sql(symbol: str) -> str:
    lines = s.LINE_TRADES.replace("l_suppkey AS symbol", f"{symbol} AS symbol")
    return s.with_(
        [lines, f"c AS ({s.ohlcv('line_trades', DAY_MS)})"],
        f"SELECT {_COLS} FROM c WHERE epoch_ms(window_start) + {DAY_MS} + 5000 <= (SELECT max(event_ms) FROM line_trades)",
    )


@query("str4_stream_many_symbols", _stream_lineitem_sql("l_suppkey"))
def _(spark, d):
    return _stream_lineitem(spark, d, "l_suppkey")


@query("str4_stream_few_symbols", _stream_lineitem_sql("l_linenumber"))
def _(spark, d):
    # Seven symbols: the state and shuffle key is (symbol, window), so they do not cap the tasks.
    return _stream_lineitem(spark, d, "l_linenumber")


@query(
    "src3_new_partition_pickup",
    s.with_([s.TRADES], "SELECT kafka_partition, count(*) AS trades FROM trades GROUP BY 1"),
)
def _(spark, d):
    # One partition appears only after the query has been running on the others.
    landing, out, ck = (shared_dir(spark, x) for x in ("landing", "trades", "ck"))
    session = sc.stream_session(spark)
    records = _records(dv.events_trades(spark, d))
    for part in (F.col("partition") < 2, F.col("partition") >= 2):
        job.land_block(records.filter(part), landing)
        stream = lt.good_trades(lt.classify(tr.landed_stream(session, landing)))
        sc.to_files(dv.stored_trades(stream), out, ck, "event_time").awaitTermination()
    return stores.read_written(spark, out, STORED_TRADE).groupBy("kafka_partition").agg(F.count(F.lit(1)).alias("trades"))


def _strict(spark, d, lateness_ms: int = 0) -> StrictCandles:
    cfg = CandleSettings(window_ms=HOUR_MS, watermark_delay_ms=5_000, allowed_lateness_ms=lateness_ms, run_id="r1")
    strict, ck = StrictCandles(shared_dir(spark, "strict"), cfg), shared_dir(spark, "ck")
    _run(spark, _disordered(spark, d), lambda stream: sc.to_batches(job.valid_trades(stream), strict, ck))
    return strict


@query("str9_strict_candles", _STREAM_CANDLES)
def _(spark, d):
    return _strict(spark, d).written_candles(spark).drop("batch_id", "ingested_at", "run_id")


@query(
    "str7_late_letters",
    s.with_(
        [*_D, _judged()],
        f"""SELECT {s.ms_ts('ingest_ms')} AS seen_at, 'window' AS stage, 'late-window' AS reason, symbol,
               '{{"event_ms":' || event_ms || ',"seq_in_ms":' || seq_in_ms || ',"price":"' || price || '","volume":"' || volume
               || '","conn_id":"' || conn_id || '","recv_seq":' || recv_seq || '}}' AS payload, 'r1' AS job_run
            FROM judged WHERE late""",
    ),
)
def _(spark, d):
    return _strict(spark, d).written_letters(spark).drop("batch_id")


_L = 7_200_000


@query(
    "str6_allowed_lateness",
    s.with_(
        [
            *_D, _judged(_L),
            f"""touches AS (SELECT DISTINCT symbol, ws, b FROM judged WHERE NOT late),
closing AS (SELECT x.symbol, x.ws, min(w.b) AS b FROM (SELECT DISTINCT symbol, ws FROM touches) x JOIN wm w ON x.ws + {HOUR_MS} <= w.wm GROUP BY 1, 2),
emits AS (SELECT c.symbol, c.ws, greatest(c.b, (SELECT min(t.b) FROM touches t WHERE t.symbol = c.symbol AND t.ws = c.ws)) AS b FROM closing c
          UNION SELECT t.symbol, t.ws, t.b FROM touches t JOIN closing c ON t.symbol = c.symbol AND t.ws = c.ws WHERE t.b > c.b)""",
        ],
        f"""SELECT e.symbol, {s.ms_ts('e.ws')} AS window_start, CAST(e.b AS INTEGER) AS batch_id,
                   arg_min(price, (event_ms, seq_in_ms)) AS open, max(price) AS high, min(price) AS low,
                   arg_max(price, (event_ms, seq_in_ms)) AS close, CAST(sum(volume) AS DECIMAL(18,8)) AS volume, count(*) AS trade_count
            FROM emits e JOIN judged j ON j.symbol = e.symbol AND j.ws = e.ws AND j.b <= e.b AND NOT j.late
            GROUP BY e.symbol, e.ws, e.b""",
    ),
)
def _(spark, d):
    return _strict(spark, d, _L).written_candles(spark).drop("ingested_at", "run_id")


@query(
    "str12_stream_sequence",
    s.with_(
        _D,
        f"""SELECT event_id AS kafka_offset, symbol, event_ms - event_ms % {HOUR_MS} AS event_ms,
               CAST(row_number() OVER (PARTITION BY symbol, event_ms - event_ms % {HOUR_MS} ORDER BY ingest_ms, event_id) - 1 AS INTEGER) AS seq_in_ms,
               coalesce(CAST(event_ms - event_ms % {HOUR_MS} < max(event_ms - event_ms % {HOUR_MS}) OVER (PARTITION BY symbol ORDER BY ingest_ms, event_id
                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS INTEGER), 0) AS out_of_order
            FROM disordered""",
    ),
)
def _(spark, d):
    # Event times cut to the hour make crowded instants that re-appear across blocks.
    stage = SequenceStage(
        shared_dir(spark, "sequence"), "kafka_offset BIGINT, symbol STRING, event_ms BIGINT, ingest_ms BIGINT",
        tie="kafka_offset", horizon_ms=6 * HOUR_MS,
    )
    ck = shared_dir(spark, "ck")

    def start(stream):
        trades = job.valid_trades(stream).withColumn("event_ms", bucket_start("event_ms", HOUR_MS))
        return sc.to_batches(trades, stage, ck)

    _run(spark, _disordered(spark, d), start)
    return stage.out.all(spark).select("kafka_offset", "symbol", "event_ms", "seq_in_ms", "out_of_order")


@query(
    "snk3_trade_archive",
    s.with_(
        _D,
        f"""SELECT symbol, {s.ms_ts('event_ms')} AS event_time, seq_in_ms, {s.ms_ts('ingest_ms')} AS ingest_time, price, volume,
               recv_seq, conn_id, kafka_partition, event_id AS kafka_offset FROM disordered""",
    ),
)
def _(spark, d):
    paths = job.JobPaths(shared_dir(spark, "job"))
    _run(spark, _disordered(spark, d), lambda stream: job.start_archive(stream, paths))
    return stores.read_written(spark, paths.at("trades_raw"), STORED_TRADE).drop("day")


@query(
    "snk1_append_store",
    s.with_([*_D, _judged(), f"c AS ({s.ohlcv('judged', HOUR_MS, f'NOT late AND {_CLOSED}')})"], f"SELECT {_COLS}, 'r1' AS run_id FROM c"),
)
def _(spark, d):
    paths = job.JobPaths(shared_dir(spark, "job"))
    _run(spark, _disordered(spark, d), lambda stream: job.start_candles(stream, _CFG, paths))
    return stores.read_written(spark, paths.at("candles"), CANDLE).drop("day", "ingested_at")


_IN_ORDER = [s.TRADES, _wm("trades")]
_ALL = f"allw AS (SELECT DISTINCT symbol, event_ms - event_ms % {HOUR_MS} AS ws FROM blk)"


@query(
    "snk5_dual_store",
    s.with_([*_IN_ORDER, _ALL, f"n AS (SELECT count(*) AS n FROM allw WHERE {_CLOSED})"],
            """SELECT 'append' AS store, n AS windows, n AS rows_written, 0::BIGINT AS duplicated_windows FROM n
               UNION ALL SELECT 'by_batch', n, n, 0 FROM n"""),
)
def _(spark, d):
    cfg = CandleSettings(window_ms=HOUR_MS, watermark_delay_ms=5_000, run_id="r1", second_store=True)
    paths = job.JobPaths(shared_dir(spark, "job"))
    _run(spark, dv.events_trades(spark, d), lambda stream: job.start_candles(stream, cfg, paths))
    return cmp.sink_comparison(
        {"append": stores.read_written(spark, paths.at("candles"), CANDLE), "by_batch": spark.read.parquet(paths.at("candles_second"))}
    )


class _Away:
    """A store that is away during every batch of odd number."""

    def __init__(self, write):
        self.write, self.missed = write, []

    def __call__(self, batch, batch_id):
        if batch_id % 2:
            self.missed.append(batch_id)
            raise OSError("store is away")
        self.write(batch, batch_id)


def second_store_with_outages(spark, trades: DataFrame, lateness_ms: int = 0) -> tuple[StrictCandles, str, int]:
    """The strict path, packing as it goes, beside a store that is often away and is refilled afterwards:
    (the path, the second store, rows refilled)."""
    cfg = CandleSettings(window_ms=HOUR_MS, watermark_delay_ms=5_000, allowed_lateness_ms=lateness_ms, run_id="r1")
    second, ck = shared_dir(spark, "second"), shared_dir(spark, "ck")
    away = _Away(sinks.by_batch(second))
    strict = StrictCandles(shared_dir(spark, "strict"), cfg, away, pack_every=2)
    _run(spark, trades, lambda stream: sc.to_batches(job.valid_trades(stream), strict, ck))
    return strict, second, sinks.refill_second(spark, strict.written_candles(spark), second)


@query("snk5_refilled_store", _STREAM_CANDLES)
def _(spark, d):
    _, second, _ = second_store_with_outages(spark, _disordered(spark, d))
    return spark.read.parquet(second).drop("batch_id", "ingested_at", "run_id")


class _CrashOnce:
    """Fails the first non-empty batch of one block after the primary store has been written."""

    def __init__(self, primary, secondary, in_block: int):
        self.primary, self.secondary, self.in_block = primary, secondary, in_block
        self.block, self.crashed = -1, False

    def __call__(self, batch, batch_id):
        batch.persist()
        try:
            self.primary(batch, batch_id)
            if self.block == self.in_block and not self.crashed and not batch.isEmpty():
                self.crashed = True
                raise RuntimeError("stopped between write and commit")
            self.secondary(batch, batch_id)
        finally:
            batch.unpersist()


def crash_between_write_and_commit(spark, trades: DataFrame, cfg: CandleSettings, in_block: int = 2) -> dict[str, DataFrame]:
    """Run both stores over the same stream and kill the query once between write and commit."""
    base, landing = shared_dir(spark, "crash"), shared_dir(spark, "landing")
    crash = _CrashOnce(sinks.append_only(f"{base}/append"), sinks.by_batch(f"{base}/by_batch"), in_block)
    session = sc.stream_session(spark)
    for n, _ in enumerate(_landed_blocks(spark, trades, landing)):
        crash.block = n
        for attempt in (1, 2):
            out = sinks.candle_row(sc.window_candles(job.valid_trades(tr.landed_stream(session, f"{landing}/*", fmt="parquet")), cfg), cfg.run_id)
            try:
                sc.to_batches(out, crash, f"{base}/ck").awaitTermination()
                break
            except Exception:
                if attempt == 2 or not crash.crashed:
                    raise
    return {"append": stores.read_written(spark, f"{base}/append", CANDLE), "by_batch": spark.read.parquet(f"{base}/by_batch")}


@query(
    "exp7_crash_between_write_and_commit",
    s.with_(
        [*_IN_ORDER, _ALL,
         f"""n AS (SELECT count(*) FILTER ({_CLOSED}) AS n,
                   count(*) FILTER (ws + {HOUR_MS} > (SELECT wm FROM wm WHERE b = 1) AND ws + {HOUR_MS} <= (SELECT wm FROM wm WHERE b = 2)) AS dup FROM allw)"""],
        """SELECT 'append' AS store, n AS windows, n + dup AS rows_written, dup AS duplicated_windows FROM n
           UNION ALL SELECT 'by_batch', n, n, 0 FROM n""",
    ),
)
def _(spark, d):
    return cmp.sink_comparison(crash_between_write_and_commit(spark, dv.events_trades(spark, d), _CFG))


def restart_modes(spark, trades: DataFrame, cfg: CandleSettings, stop_after: int = 2) -> DataFrame:
    """Stop a run half-way and restart it three ways: with its checkpoint, with its position but
    without its state, and from the start. Compared with a run that never stopped."""
    t = _with_block(trades)
    numbers = list(job.blocks(t))
    cut = numbers[min(stop_after, len(numbers)) - 1]
    base = shared_dir(spark, "restart")
    session = sc.stream_session(spark)
    before, after = _records(t.filter(F.col("block") <= cut)), _records(t.filter(F.col("block") > cut))

    def run(landing: str, store: str, ck: str) -> None:
        out = sinks.candle_row(sc.window_candles(job.valid_trades(tr.landed_stream(session, landing)), cfg), cfg.run_id)
        sc.to_batches(out, sinks.append_only(store), ck).awaitTermination()

    job.land_block(before, f"{base}/early")
    results = {}
    for mode in ("checkpoint", "position only", "from the start"):
        store = f"{base}/{mode.replace(' ', '-')}"
        run(f"{base}/early", store, f"{store}-ck1") if mode != "checkpoint" else None
        if mode == "checkpoint":
            job.land_block(before, f"{base}/all")
            run(f"{base}/all", store, f"{store}-ck1")
            job.land_block(after, f"{base}/all")
            run(f"{base}/all", store, f"{store}-ck1")
        elif mode == "position only":
            job.land_block(after, f"{base}/late")
            run(f"{base}/late", store, f"{store}-ck2")
        else:
            run(f"{base}/all", store, f"{store}-ck2")
        results[mode] = stores.read_written(spark, store, CANDLE)
    from tapecheck.operators.candles import candles

    newest = trades.agg(F.max("event_ms")).first()[0]
    closed = F.col("window_start") <= wall_clock(F.lit(newest - cfg.watermark_delay_ms - cfg.window_ms))
    truth = candles(trades, cfg.window_ms).filter(closed).select(
        "symbol", "window_start", F.col("volume").alias("true_volume")
    )
    parts = []
    for mode, rows in results.items():
        kept = rows.groupBy("symbol", "window_start").agg(F.count(F.lit(1)).alias("n"), F.max("volume").alias("volume"))
        parts.append(
            truth.join(kept, ["symbol", "window_start"], "left")
            .agg(
                F.count(F.lit(1)).alias("windows"),
                F.coalesce(F.sum("n"), F.lit(0)).alias("rows_written"),
                F.count_if(F.col("n") > 1).alias("duplicated"),
                F.count_if(F.col("n").isNull()).alias("missing"),
                F.count_if(F.col("volume") < F.col("true_volume")).alias("short"),
            )
            .select(F.lit(mode).alias("restart"), "windows", "rows_written", "duplicated", "missing", "short")
        )
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query(
    "exp8_restart_modes",
    s.with_(
        [
            *_IN_ORDER,
            f"""w AS (SELECT symbol, event_ms - event_ms % {HOUR_MS} AS ws, CAST(count(*) FILTER (b <= 1) AS BIGINT) AS n1,
                   count(*) FILTER (b > 1) AS n2 FROM blk GROUP BY 1, 2),
t AS (SELECT *, ws + {HOUR_MS} <= (SELECT wm FROM wm WHERE b = 1) AS early FROM w WHERE {_CLOSED})""",
        ],
        """SELECT 'checkpoint' AS restart, count(*) AS windows, count(*) AS rows_written, 0 AS duplicated, 0 AS missing, 0 AS short FROM t
           UNION ALL
           SELECT 'position only', count(*), count(*) FILTER (early OR n2 > 0), count(*) FILTER (early AND n2 > 0),
                  count(*) FILTER (NOT early AND n2 = 0), count(*) FILTER (NOT early AND n1 > 0 AND n2 > 0) FROM t
           UNION ALL
           SELECT 'from the start', count(*), count(*) + count(*) FILTER (early), count(*) FILTER (early), 0, 0 FROM t""",
    ),
)
def _(spark, d):
    return restart_modes(spark, dv.events_trades(spark, d), _CFG)


@query(
    "str18_stream_counters",
    s.with_(
        [s.TRADES],
        """SELECT unnest(['records', 'malformed_json', 'missing_field', 'malformed_number']) AS metric,
                  unnest([count(*) FILTER (event_id % 101 <> 4), count(*) FILTER (event_id % 101 IN (0, 5, 6, 7)),
                          count(*) FILTER (event_id % 101 IN (1, 2)), count(*) FILTER (event_id % 101 = 3)])::DOUBLE AS value FROM trades""",
    ),
)
def _(spark, d):
    landing, ck = shared_dir(spark, "landing"), shared_dir(spark, "ck")
    tx.wire_records(dv.events_trades(spark, d)).select("key", "value").write.json(landing)
    q = sc.discard(job.valid_trades(tr.landed_stream(sc.stream_session(spark), landing)), ck)
    q.awaitTermination()
    samples = job.progress_samples(q, spark)
    wanted = ["records", "malformed_json", "missing_field", "malformed_number"]
    return samples.filter(F.col("metric").isin(wanted)).groupBy("metric").agg(F.sum("value").alias("value"))


__all__ = ["crash_between_write_and_commit", "restart_modes", "stores"]
