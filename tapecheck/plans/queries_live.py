"""The job as a whole, its positions and counters, chained and session state, and stores that are kept in order."""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, functions as F

from tapecheck.operators import candles as cd, dedup, letters as lt, replay as rp
from tapecheck.plans import sqlparts as s
from tapecheck.plans.catalog import query
from tapecheck.plans.queries_parsing import _REASONS
from tapecheck.plans.queries_streaming import _BLOCK_MS, _BLOCK_SHIFT, _COLS, _records, _run, _wm
from tapecheck.schema import CANDLE, DEAD_LETTER, ROLLED_UP, SESSION, STORED_TRADE
from tapecheck.settings import DAY_MS, HOUR_MS, CandleSettings, shared_dir
from tapecheck.sources import derived as dv, derived_text as tx, stores, trades as tr
from tapecheck.sources.positions import open_position
from tapecheck.streaming import candles as sc, job, sinks
from tapecheck.streaming.live import LiveJob
from tapecheck.streaming.metrics import CounterLog, counted
from tapecheck.streaming.sequence import numbered

_CFG = CandleSettings(window_ms=HOUR_MS, watermark_delay_ms=5_000, run_id="r1")

# --- counters over more than a hundred batches ---

_BATCHES, _FEWER = 110, 24


def _many(batches: int) -> str:
    spread = f"(ingest_ms - (SELECT min(ingest_ms) FROM disordered)) * {batches} // (SELECT max(ingest_ms) - min(ingest_ms) + 1 FROM disordered)"
    return f"""many AS (SELECT *, dense_rank() OVER (ORDER BY k) - 1 AS b FROM (SELECT *, {spread} AS k FROM disordered)),
wm AS (SELECT b, max(max(event_ms)) OVER (ORDER BY b) - 5000 AS wm FROM many GROUP BY b),
judged AS (SELECT m.*, p.wm IS NOT NULL AND m.event_ms - m.event_ms % {HOUR_MS} + {HOUR_MS} <= p.wm AS late FROM many m LEFT JOIN wm p ON p.b = m.b - 1),
nb AS (SELECT max(b) + 1 AS n FROM many)"""


class _Flaky:
    """A store that refuses the first attempt of every tenth batch."""

    def __init__(self, write):
        self.write, self.tried = write, set()

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        if batch_id % 10 == 0 and batch_id not in self.tried:
            self.tried.add(batch_id)
            raise OSError("store busy")
        self.write(batch, batch_id)


def _many_batches(spark, d, batches: int) -> tuple[CounterLog, str]:
    landing, store, ck = (shared_dir(spark, x) for x in ("landing", "trades", "ck"))
    trades = dv.disordered(dv.events_trades(spark, d))
    ends = trades.agg(F.min("ingest_ms").alias("lo"), F.max("ingest_ms").alias("hi")).first()
    block = F.expr(f"(ingest_ms - {ends.lo}) * {batches} div {ends.hi - ends.lo + 1}").alias("block")
    records = trades.select(F.col("symbol").alias("key"), tr.wire_json().alias("value"), F.col("kafka_partition").alias("partition"), F.col("event_id").alias("offset"), block)
    tr.land_in_order(records, "block", landing)
    log = CounterLog(shared_dir(spark, "counters"))
    write = counted(_Flaky(sinks.by_batch(store)), log, _CFG, wait_s=0)
    stream = tr.landed_stream(sc.stream_session(spark), f"{landing}/*", files_per_trigger=1)
    sc.to_batches(lt.good_trades(lt.classify(stream)), write, ck).awaitTermination()
    return log, store


@query(
    "str18_counters_over_many_batches",
    s.with_(
        [s.TRADES, s.DISORDERED, _many(_BATCHES)],
        """SELECT unnest(['records', 'rows_written', 'flush_failures', 'late']) AS metric, n AS batches,
                  unnest([count(*), count(*), CAST(ceil(n / 10) AS BIGINT), count(*) FILTER (late)]) AS value
           FROM judged, nb GROUP BY n""",
    ),
)
def _(spark, d):
    log, _ = _many_batches(spark, d, _BATCHES)
    return log.totals(spark)


@query(
    "snk2_store_that_refuses",
    s.with_([s.TRADES, s.DISORDERED, _many(_FEWER)], "SELECT CAST(b AS INTEGER) AS batch_id, count(*) AS rows, sum(volume) AS volume FROM many GROUP BY 1"),
)
def _(spark, d):
    # every refused batch was written by its second attempt, once
    _, store = _many_batches(spark, d, _FEWER)
    return spark.read.parquet(store).groupBy("batch_id").agg(F.count(F.lit(1)).alias("rows"), F.sum("volume").alias("volume"))


# --- the wired job ---

_CUT = f"(SELECT min((ingest_ms + {_BLOCK_SHIFT}) // {_BLOCK_MS}) + 1 FROM disordered)"


@query(
    "str13_live_job",
    s.with_(
        [
            s.TRADES, s.DISORDERED, _REASONS.replace("FROM trades", "FROM disordered"),
            f"g AS (SELECT *, CAST((ingest_ms + {_BLOCK_SHIFT}) // {_BLOCK_MS} > {_CUT} AS INTEGER) AS run FROM reasons)",
            "wm AS (SELECT run, max(max(event_ms)) OVER (ORDER BY run) - 5000 AS wm FROM g WHERE reason IS NULL GROUP BY run)",
            f"""kept AS (SELECT g.* FROM g LEFT JOIN wm p ON p.run = g.run - 1
                   WHERE reason IS NULL AND (p.wm IS NULL OR event_ms - event_ms % {HOUR_MS} + {HOUR_MS} > p.wm))""",
            f"c AS ({s.ohlcv('kept', HOUR_MS, f'event_ms - event_ms % {HOUR_MS} + {HOUR_MS} <= (SELECT max(wm) FROM wm)')})",
        ],
        f"""SELECT 'candle' AS store, symbol AS name, window_start AS at, open, high, low, close, volume, trade_count AS n FROM c
            UNION ALL SELECT 'second', symbol, window_start, open, high, low, close, volume, trade_count FROM c
            UNION ALL SELECT 'archive', symbol, {s.ms_ts('event_ms')}, price, price, price, price, volume, 1 FROM g WHERE reason IS NULL
            UNION ALL SELECT 'letter', reason, NULL, NULL, NULL, NULL, NULL, NULL, count(*) FROM g WHERE reason IS NOT NULL GROUP BY reason""",
    ),
)
def _(spark, d):
    # Two runs: the second one goes on where the first was stopped, from the same checkpoints.
    cfg = CandleSettings(window_ms=HOUR_MS, watermark_delay_ms=5_000, run_id="r1", second_store=True, trigger="100 milliseconds", candles_table="candles_1h")
    paths, landing = job.JobPaths(shared_dir(spark, "live")), shared_dir(spark, "landing")
    wire = tx.wire_records(dv.disordered(dv.events_trades(spark, d)))
    wire = wire.withColumn("run", F.expr(f"(seen_ms + {_BLOCK_SHIFT}) div {_BLOCK_MS}"))
    first = wire.agg(F.min("run")).first()[0]
    for part in (F.col("run") <= first + 1, F.col("run") > first + 1):
        records = wire.where(part).select("key", "value", F.lit(0).alias("partition"), F.col("event_id").alias("offset"))
        job.land_block(records, landing)
        start = open_position(spark, paths.at("_positions"), cfg.start_position)
        live = LiveJob(spark, cfg, paths, start)
        try:
            live.start(tr.landed_stream(live.session, landing)).drain()
        finally:
            live.stop()
    ohlcv = ["open", "high", "low", "close", "volume"]

    def candles(name: str, df: DataFrame) -> DataFrame:
        return df.select(F.lit(name).alias("store"), F.col("symbol").alias("name"), F.col("window_start").alias("at"), *ohlcv, F.col("trade_count").alias("n"))

    none = [F.lit(None).cast("decimal(18,8)" if c == "volume" else "decimal(18,4)").alias(c) for c in ohlcv]
    raw = stores.read_written(spark, paths.at("trades_raw"), STORED_TRADE)
    archived = raw.select(F.lit("archive").alias("store"), F.col("symbol").alias("name"), F.col("event_time").alias("at"),
                          *[F.col("price").alias(c) for c in ohlcv[:4]], "volume", F.lit(1).cast("bigint").alias("n"))
    letters = stores.read_written(spark, paths.at("dead_letters"), DEAD_LETTER).groupBy("reason").agg(F.count(F.lit(1)).alias("n"))
    letters = letters.select(F.lit("letter").alias("store"), F.col("reason").alias("name"), F.lit(None).cast("timestamp_ntz").alias("at"), *none, "n")
    return (
        candles("candle", stores.read_written(spark, paths.at("candles_1h"), CANDLE))
        .unionByName(candles("second", spark.read.parquet(paths.at("candles_1h_second/0"))))
        .unionByName(archived)
        .unionByName(letters)
    )


_THIRD = "(SELECT max(event_id) + 1 FROM trades)"


@query(
    "src2_start_position",
    s.with_(
        [
            s.TRADES,
            f"p AS (SELECT event_id, event_id * 3 // {_THIRD} AS part FROM trades)",
            """steps AS (SELECT * FROM (VALUES (1, 'committed', 0, FALSE, 0, 0), (2, 'committed', 0, TRUE, 1, 1), (3, 'latest', 1, FALSE, 2, 2),
                         (4, 'committed', 1, TRUE, 9, 9), (5, 'earliest', 2, FALSE, 0, 2)) AS v(step, position, generation, resumed, lo, hi))""",
        ],
        """SELECT step, position, generation, resumed, count(event_id) AS records, min(event_id) AS first_offset, max(event_id) AS last_offset
           FROM steps LEFT JOIN p ON part BETWEEN lo AND hi GROUP BY ALL""",
    ),
)
def _(spark, d):
    # (what is landed before the start, the position, what is landed after it)
    landing, base, out = (shared_dir(spark, x) for x in ("landing", "positions", "read"))
    session = sc.stream_session(spark)
    trades = dv.events_trades(spark, d)
    n = trades.agg(F.max("event_id")).first()[0] + 1
    records = _records(trades).withColumn("part", F.expr(f"offset * 3 div {n}"))

    def land(part: int | None) -> None:
        if part is not None:
            job.land_block(records.where(F.col("part") == part).drop("part"), landing)

    parts = []
    for step, (before, position, after) in enumerate(((0, "committed", None), (1, "committed", None), (None, "latest", 2), (None, "committed", None), (None, "earliest", None)), 1):
        land(before)
        start = open_position(spark, base, position, tr.landed_batch(spark, landing))
        land(after)
        read = start.after(tr.landed_stream(session, landing)).select("partition", "offset")
        sc.to_batches(read, sinks.by_batch(f"{out}/{step}"), f"{start.checkpoint}/read").awaitTermination()
        try:
            got = spark.read.schema("partition INT, offset BIGINT").option("recursiveFileLookup", "true").parquet(f"{out}/{step}")
        except AnalysisException as e:  # a run that found nothing has no batch
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            got = spark.createDataFrame([], "partition INT, offset BIGINT")
        parts.append(got.agg(
            F.lit(step).alias("step"), F.lit(position).alias("position"), F.lit(start.generation).alias("generation"), F.lit(start.resumed).alias("resumed"),
            F.count("offset").alias("records"), F.min("offset").alias("first_offset"), F.max("offset").alias("last_offset"),
        ))
    whole = parts[0]
    for p in parts[1:]:
        whole = whole.unionByName(p)
    return whole


# --- records without or with impossible numbers in the millisecond ---

_ODD = """odd AS (SELECT * REPLACE (CASE WHEN event_id % 7 = 0 THEN NULL WHEN event_id % 97 = 1 THEN -1 WHEN event_id % 97 = 2 THEN 1048576 ELSE seq_in_ms END AS seq_in_ms) FROM trades),
fit AS (SELECT * REPLACE (coalesce(seq_in_ms, 0) AS seq_in_ms) FROM odd WHERE coalesce(seq_in_ms, 0) BETWEEN 0 AND 1048575)"""


def _odd_records(spark, d) -> DataFrame:
    i = F.col("event_id")
    odd = F.when(i % 7 == 0, F.lit(None)).when(i % 97 == 1, -1).when(i % 97 == 2, 1 << 20).otherwise(F.col("seq_in_ms"))
    trades = dv.events_trades(spark, d).withColumn("seq_in_ms", odd.cast("int"))
    return trades.select(F.col("symbol").alias("key"), F.explode(F.array(tr.wire_json())).alias("value"), "event_id", "ingest_ms", "kafka_partition")


@query("agg1_odd_numbers", s.with_([s.TRADES, _ODD, f"c AS ({s.ohlcv('fit', HOUR_MS)})"], f"SELECT {_COLS} FROM c"))
def _(spark, d):
    return cd.candles(lt.good_trades(lt.classify(_odd_records(spark, d))), HOUR_MS)


@query(
    "flt2_odd_numbers",
    s.with_([s.TRADES, _ODD], "SELECT event_id, 'malformed-number' AS reason, seq_in_ms FROM odd WHERE seq_in_ms < 0 OR seq_in_ms > 1048575"),
)
def _(spark, d):
    bad = lt.classify(_odd_records(spark, d)).where("reason IS NOT NULL")
    return bad.select("event_id", "reason", F.col("t.seq_in_ms").alias("seq_in_ms"))


def _odd_stream(spark, d, start) -> None:
    landing = shared_dir(spark, "landing")
    records = _odd_records(spark, d).select("key", "value", F.col("kafka_partition").alias("partition"), F.col("event_id").alias("offset"))
    job.land_block(records, landing)
    start(tr.landed_stream(sc.stream_session(spark), landing)).awaitTermination()


_ODD_CLOSED = f"epoch_ms(window_start) + {HOUR_MS} + 5000 <= (SELECT max(event_ms) FROM fit)"


@query("str5_odd_numbers", s.with_([s.TRADES, _ODD, f"c AS ({s.ohlcv('fit', HOUR_MS)})"], f"SELECT {_COLS} FROM c WHERE {_ODD_CLOSED}"))
def _(spark, d):
    paths = job.JobPaths(shared_dir(spark, "job"))
    _odd_stream(spark, d, lambda stream: job.start_candles(stream, _CFG, paths))
    return stores.read_written(spark, paths.at("candles"), CANDLE).drop("day", "ingested_at", "run_id")


@query("str9_odd_numbers", s.with_([s.TRADES, _ODD, f"c AS ({s.ohlcv('fit', HOUR_MS)})"], f"SELECT {_COLS} FROM c WHERE {_ODD_CLOSED}"))
def _(spark, d):
    paths = job.JobPaths(shared_dir(spark, "job"))
    _odd_stream(spark, d, lambda stream: job.start_candles(stream, _CFG, paths, strict=True))
    return spark.read.parquet(paths.at("strict/candles")).drop("batch_id", "ingested_at", "run_id")


# --- sessions, chained aggregates and open windows in the stream ---

_GAP_MS = 1_800_000


@query(
    "str19_stream_sessions",
    s.with_(
        [
            s.TRADES,
            _wm("trades"),
            f"""marked AS (SELECT *, CASE WHEN event_ms - lag(event_ms) OVER (PARTITION BY symbol ORDER BY event_ms, seq_in_ms) <= {_GAP_MS} THEN 0 ELSE 1 END AS fresh FROM blk)""",
            "numbered AS (SELECT *, sum(fresh) OVER (PARTITION BY symbol ORDER BY event_ms, seq_in_ms) AS sid FROM marked)",
        ],
        f"""SELECT symbol, {s.ms_ts('min(event_ms)')} AS session_start, {s.ms_ts(f'max(event_ms) + {_GAP_MS}')} AS session_end,
                   arg_min(price, (event_ms, seq_in_ms)) AS open, max(price) AS high, min(price) AS low,
                   arg_max(price, (event_ms, seq_in_ms)) AS close, CAST(sum(volume) AS DECIMAL(18,8)) AS volume, count(*) AS trade_count
            FROM numbered GROUP BY symbol, sid HAVING max(event_ms) + {_GAP_MS} + 1 <= (SELECT max(wm) FROM wm)""",
    ),
)
def _(spark, d):
    out, ck = shared_dir(spark, "sessions"), shared_dir(spark, "ck")

    def start(stream):
        return sc.to_files(sc.session_candles(lt.good_trades(lt.classify(stream)), _GAP_MS, _CFG), out, ck, "session_start")

    _run(spark, dv.events_trades(spark, d), start)
    return stores.read_written(spark, out, SESSION).drop("day")


@query(
    "agg3_stream_rollup",
    s.with_(
        [
            s.TRADES, s.DISORDERED, _wm("disordered"),
            f"""kept AS (SELECT t.* FROM blk t LEFT JOIN wm p ON p.b = t.b - 1 WHERE p.wm IS NULL OR t.event_ms - t.event_ms % {HOUR_MS} + {HOUR_MS} > p.wm)""",
            f"c AS ({s.ohlcv('kept', DAY_MS)})",
            f"h AS (SELECT symbol, {s.ms_ts(f'event_ms - event_ms % {DAY_MS}')} AS window_start, count(DISTINCT event_ms // {HOUR_MS}) AS windows FROM kept GROUP BY 1, 2)",
        ],
        f"SELECT {_COLS}, windows FROM c JOIN h USING (symbol, window_start) WHERE epoch_ms(window_start) + {DAY_MS} <= (SELECT max(wm) FROM wm)",
    ),
)
def _(spark, d):
    # One query, two stateful aggregates: hours, and days made of them. Late trades fall at the hours' boundaries.
    out, ck = shared_dir(spark, "days"), shared_dir(spark, "ck")

    def start(stream):
        return sc.to_files(sc.rolled_up(lt.good_trades(lt.classify(stream)), _CFG, DAY_MS), out, ck, "window_start")

    _run(spark, dv.disordered(dv.events_trades(spark, d)), start)
    return stores.read_written(spark, out, ROLLED_UP).drop("day")


@query(
    "str11_open_windows",
    s.with_(
        [s.TRADES, _wm("trades")],
        f"""SELECT symbol, {s.ms_ts(f'event_ms - event_ms % {HOUR_MS}')} AS window_start, {s.ms_ts(f'event_ms - event_ms % {HOUR_MS} + {HOUR_MS}')} AS window_end,
                   count(*) AS trade_count
            FROM blk WHERE event_ms - event_ms % {HOUR_MS} + {HOUR_MS} > (SELECT max(wm) FROM wm) GROUP BY ALL""",
    ),
)
def _(spark, d):
    # The market falls silent: what is still open when the query has read everything.
    out, ck = shared_dir(spark, "candles"), shared_dir(spark, "ck")
    _run(spark, dv.events_trades(spark, d), lambda stream: sc.to_files(sc.window_candles(lt.good_trades(lt.classify(stream)), _CFG), out, ck, "window_start"))
    return sc.open_windows(spark, ck)


@query(
    "src4_scan_with_counts",
    s.with_(
        [s.TRADES, _REASONS],
        """SELECT count(*) AS records, count(*) FILTER (reason IS NULL) AS good, count(*) FILTER (reason = 'malformed-json') AS malformed,
                  count(*) FILTER (reason IS NOT NULL AND reason <> 'malformed-json') AS unusable,
                  CAST(sum(volume) FILTER (reason IS NULL) AS DECIMAL(38,8)) AS volume FROM reasons""",
    ),
)
def _(spark, d):
    landing, store = shared_dir(spark, "landing"), shared_dir(spark, "trades")
    tx.wire_records(dv.events_trades(spark, d)).select("key", "value", F.lit(0).alias("partition"), F.col("event_id").alias("offset")).write.json(landing)
    counts = rp.scan_records(tr.landed_batch(spark, landing), store)
    kept = spark.read.parquet(store).agg(F.sum("volume").cast("decimal(38,8)").alias("volume"))
    return kept.select(*[F.lit(counts[c]).cast("bigint").alias(c) for c in ("records", "good", "malformed", "unusable")], "volume")


# --- numbering in the engine's state, and a large fold in many batches ---

_CELL_MS, _FEW = 21_600_000, 12


def _landed_in_order(spark, rows: DataFrame, at: str, batches: int, fmt: str = "json") -> str:
    landing = shared_dir(spark, "landing")
    ends = rows.agg(F.min(at).alias("lo"), F.max(at).alias("hi")).first()
    block = F.expr(f"({at} - {ends.lo}) * {batches} div {ends.hi - ends.lo + 1}").alias("block")
    tr.land_in_order(rows.select("*", block), "block", landing, fmt)
    return landing


@query(
    "str12_state_store_numbers",
    s.with_(
        [
            s.TRADES, s.DISORDERED,
            _many(_FEW).split(",\nwm AS")[0],
            "wm AS (SELECT b, max(max(ingest_ms)) OVER (ORDER BY b) AS wm FROM many GROUP BY b)",
            f"""told AS (SELECT m.event_id, m.symbol, m.ingest_ms, m.event_ms - m.event_ms % {HOUR_MS} AS event_ms,
                       p.wm IS NOT NULL AND (m.event_ms // {_CELL_MS} + 1) * {_CELL_MS} + {HOUR_MS} <= p.wm AS late
                FROM many m LEFT JOIN wm p ON p.b = m.b - 1)""",
        ],
        """SELECT event_id AS tie, symbol, event_ms, late,
                  CASE WHEN NOT late THEN CAST(row_number() OVER (PARTITION BY symbol, event_ms, late ORDER BY ingest_ms, event_id) - 1 AS INTEGER) END AS seq_in_ms
           FROM told""",
    ),
)
def _(spark, d):
    # Event times cut to the hour: crowded instants that come back in many batches, some after their cell has closed.
    trades = dv.disordered(dv.events_trades(spark, d))
    rows = trades.select("event_id", "symbol", F.expr(f"event_ms - event_ms % {HOUR_MS}").alias("event_ms"), "ingest_ms")
    landing, out, ck = _landed_in_order(spark, rows, "ingest_ms", _FEW), shared_dir(spark, "numbered"), shared_dir(spark, "ck")
    stream = sc.stream_session(spark, several_states=True).readStream.schema("event_id BIGINT, symbol STRING, event_ms BIGINT, ingest_ms BIGINT").option("maxFilesPerTrigger", 1)
    sc.to_batches(numbered(stream.json(f"{landing}/*"), "event_id", _CELL_MS, HOUR_MS), sinks.by_batch(out), ck).awaitTermination()
    return spark.read.parquet(out).drop("batch_id")


@query(
    "str4_stream_many_batches",
    s.with_(
        [s.LINE_TRADES.replace("l_suppkey AS symbol", "l_linenumber AS symbol"), f"c AS ({s.ohlcv('line_trades', DAY_MS)})"],
        f"SELECT {_COLS} FROM c WHERE epoch_ms(window_start) + {DAY_MS} + 5000 <= (SELECT max(event_ms) FROM line_trades)",
    ),
)
def _(spark, d):
    # The large input in twelve batches: open windows pass from one batch to the next through the state store.
    rows = dv.trades_from_lineitem(spark.read.parquet(f"{d}/lineitem.parquet"), "l_linenumber")
    landing, out, ck = _landed_in_order(spark, rows, "event_ms", _FEW, "parquet"), shared_dir(spark, "candles"), shared_dir(spark, "ck")
    stream = sc.stream_session(spark).readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(f"{landing}/*")
    sc.to_batches(sc.window_candles(stream, CandleSettings(window_ms=DAY_MS, watermark_delay_ms=5_000)), sinks.by_batch(out), ck).awaitTermination()
    return spark.read.parquet(out).drop("batch_id")


# --- stores ---

#: Days of the month that each of three deliveries covers, what it adds to the volume, and its fetch time in hours.
_DELIVERIES = ((1, 15, 0, 0), (14, 24, 5, 24), (20, 31, 7, -24))

_DELIVERED = "delivered AS (" + " UNION ALL ".join(
    f"""SELECT {n} AS delivery, symbol, window_start, open, high, low, close, CAST(volume + {more} AS DECIMAL(18,8)) AS volume,
               fetched_at + INTERVAL ({hours}) HOUR AS fetched_at FROM official WHERE day(window_start) BETWEEN {a} AND {b}"""
    for n, (a, b, more, hours) in enumerate(_DELIVERIES, 1)
) + ")"


def _merged(spark, d) -> tuple[str, list[DataFrame]]:
    """The store after three deliveries, and the files it had after each."""
    path, listings = shared_dir(spark, "official"), []
    official = dv.official_of(spark, d)
    for a, b, more, hours in _DELIVERIES:
        part = official.where(F.dayofmonth("window_start").between(a, b)).withColumns({
            "volume": (F.col("volume") + more).cast("decimal(18,8)"), "fetched_at": F.col("fetched_at") + F.expr(f"INTERVAL {hours} HOURS"),
        })
        stores.merge_latest(spark, path, part, "window_start", dedup.latest_official, stores.SORT_KEYS["candles_1m_official"])
        spark.catalog.refreshByPath(path)
        files = stores.day_files(spark, path).select("day", "file").collect()  # a few files a day
        listings.append(spark.createDataFrame([(r.day, r.file) for r in files], "day DATE, file STRING"))
    return path, listings


@query(
    "snk9_merge_deliveries",
    s.with_(
        [s.TRADES, s.official(), _DELIVERED],
        """SELECT symbol, window_start, open, high, low, close, volume, fetched_at FROM (
             SELECT *, row_number() OVER (PARTITION BY symbol, window_start ORDER BY fetched_at DESC) AS n FROM delivered) WHERE n = 1""",
    ),
)
def _(spark, d):
    path, _ = _merged(spark, d)
    return spark.read.parquet(path).drop("day")


@query(
    "snk9_days_rewritten",
    s.with_([s.TRADES, s.official(), _DELIVERED], "SELECT delivery, CAST(window_start AS DATE) AS day FROM delivered GROUP BY ALL"),
)
def _(spark, d):
    # A day whose files are not those of the listing before was rewritten; all other days kept theirs.
    _, listings = _merged(spark, d)
    out = None
    for n, now in enumerate(listings, 1):
        fresh = now if n == 1 else now.join(listings[n - 2], ["day", "file"], "left_anti")
        part = fresh.select(F.lit(n).alias("delivery"), "day").distinct()
        out = part if out is None else out.unionByName(part)
    return out


_KEEP_DAYS = stores.RETENTION_DAYS["dead_letters"]


@query(
    "snk10_drop_partitions",
    s.with_(
        [s.TRADES, f"c AS ({s.ohlcv('trades', HOUR_MS)})", "x AS (SELECT CAST(window_start AS DATE) AS day FROM c)"],
        f"""SELECT day, count(*) AS rows, (SELECT count(DISTINCT day) FROM x WHERE day < (SELECT max(day) FROM x) - {_KEEP_DAYS}) AS dropped
            FROM x WHERE day >= (SELECT max(day) FROM x) - {_KEEP_DAYS} GROUP BY day""",
    ),
)
def _(spark, d):
    name, path = f"candles_{uuid.uuid4().hex}", shared_dir(spark, "candles_table")
    stores.create_table(spark, name, CANDLE, path)
    rows = sinks.candle_row(cd.candles(dv.events_trades(spark, d), HOUR_MS), "r1")
    stores.write_by_day(rows, "window_start", "candles_1m", path=path)
    newest = stores.read_table(spark, name).agg(F.max("day")).first()[0]
    dropped = stores.expire_days(spark, name, _KEEP_DAYS, newest.isoformat())
    spark.sql(f"DROP TABLE {name}")
    # what the folder holds now
    return spark.read.parquet(path).groupBy("day").agg(F.count(F.lit(1)).alias("rows")).withColumn("dropped", F.lit(len(dropped)).cast("bigint"))


@query(
    "snk8_table_made_at_start",
    s.with_(
        [s.TRADES, f"c AS ({s.ohlcv('trades', HOUR_MS)})"],
        f"""SELECT {_COLS}, 'r1' AS run_id, CAST(window_start AS DATE) AS day FROM c
            WHERE epoch_ms(window_start) + {HOUR_MS} + 5000 <= (SELECT max(event_ms) FROM trades)""",
    ),
)
def _(spark, d):
    name, path, ck, landing = f"candles_{uuid.uuid4().hex}", shared_dir(spark, "candles_table"), shared_dir(spark, "ck"), shared_dir(spark, "landing")
    job.land_block(_records(dv.events_trades(spark, d)), landing)
    session = sc.stream_session(spark)
    rows = sinks.candle_row(sc.window_candles(lt.good_trades(lt.classify(tr.landed_stream(session, landing))), _CFG), "r1")
    stores.stream_to_table(rows, name, CANDLE, "window_start", ck, path).awaitTermination()
    table = stores.read_table(session, name)
    found = spark.read.schema(table.schema).parquet(path)
    if table.count() != found.count():
        raise RuntimeError("the catalog and the folder disagree")
    session.sql(f"DROP TABLE {name}")
    return found.drop("ingested_at")


@query(
    "snk12_compaction",
    s.with_([s.TRADES], f"SELECT CAST({s.ms_ts('event_ms')} AS DATE) AS day, count(*) AS trades, sum(volume) AS volume, 1::BIGINT AS files FROM trades GROUP BY 1"),
)
def _(spark, d):
    # Six batches, each with a few rows of every day, become one file a day.
    path = shared_dir(spark, "trades_raw")
    rows = dv.stored_trades(dv.events_trades(spark, d))
    for n in range(6):
        stores.write_by_day(rows.where(F.col("event_id") % 6 == n), "event_time", "trades_raw", path=path)
    stores.compact(spark, path, sort_by=stores.SORT_KEYS["trades_raw"])
    spark.catalog.refreshByPath(path)
    files = spark.read.parquet(path).withColumn("file", F.input_file_name())
    return files.groupBy("day").agg(F.count(F.lit(1)).alias("trades"), F.sum("volume").alias("volume"), F.countDistinct("file").alias("files"))

