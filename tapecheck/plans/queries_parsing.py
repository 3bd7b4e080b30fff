"""Frames, wire records, official pages, exact numbers and dead letters."""

from __future__ import annotations

from pyspark.sql import functions as F

from tapecheck.functions.numbers import price_of
from tapecheck.functions.timecols import kst_text, wall_clock
from tapecheck.operators import candles as cd, letters as lt
from tapecheck.plans import sqlparts as s
from tapecheck.plans.catalog import query
from tapecheck.settings import HOUR_MS, CandleSettings
from tapecheck.sources import derived as dv, derived_text as tx, frames as fr, official as of, stores, trades as tr

# What the damage rules do to each record, written independently of the parser.
_FRAMES = """kinds AS (SELECT *, event_id % 101 AS kind FROM trades),
framed AS (SELECT *, CASE WHEN kind = 7 THEN 'subscriptions' WHEN kind = 8 THEN 'error' WHEN kind = 9 THEN 'pong'
                          WHEN kind = 12 THEN 'unknown' ELSE 'message' END AS type
           FROM kinds WHERE kind NOT IN (0, 2, 5, 10, 11))"""


def _frames(spark, d):
    return fr.frames(tx.raw_frames(dv.events_trades(spark, d)))


@query("prj1_frame_gate", s.with_([s.TRADES, _FRAMES], "SELECT event_id, type FROM framed"))
def _(spark, d):
    return _frames(spark, d).select("event_id", "type")


@query("agg21_frame_types", s.with_([s.TRADES, _FRAMES], "SELECT type, count(*) AS frames FROM framed GROUP BY 1"))
def _(spark, d):
    return fr.frame_type_counts(_frames(spark, d))


_FRAME_TRADES = """SELECT event_id, symbol, event_ms, CAST(price AS VARCHAR) AS price, CAST(volume AS VARCHAR) AS volume, currency
  FROM framed WHERE type = 'message' AND kind NOT IN (1, 3, 4)"""


@query("src6_frame_scan", s.with_([s.TRADES, _FRAMES], _FRAME_TRADES))
def _(spark, d):
    # Landed as text files first, then scanned the way socket dumps are.
    path = stores.shared_dir(spark, "frames")
    raw = tx.raw_frames(dv.events_trades(spark, d))
    raw.select(F.concat(F.col("event_id").cast("string"), F.lit("|"), F.col("value")).alias("value")).write.text(path)
    landed = spark.read.text(path).select(
        F.substring_index("value", "|", 1).cast("bigint").alias("event_id"),
        F.regexp_replace("value", r"^\d+\|", "").alias("value"),
    )
    return fr.frame_trades(fr.frames(landed)).select("event_id", "symbol", "event_ms", "price", "volume", "currency")


@query("prj2_frame_to_trade", s.with_([s.TRADES, _FRAMES], _FRAME_TRADES))
def _(spark, d):
    return fr.frame_trades(_frames(spark, d)).select("event_id", "symbol", "event_ms", "price", "volume", "currency")


@query(
    "prj3_offset_times",
    s.with_([s.TRADES, _FRAMES], f"SELECT event_id, {s.ms_ts('event_ms')} AS event_time FROM framed WHERE type = 'message' AND kind NOT IN (1, 3, 4)"),
)
def _(spark, d):
    return fr.frame_trades(_frames(spark, d)).select("event_id", wall_clock("event_ms").alias("event_time"))


@query("prj4_numbers_as_text", s.with_([s.TRADES, _FRAMES], "SELECT event_id, CAST(price AS VARCHAR) AS price FROM framed WHERE type = 'message' AND kind NOT IN (1, 3, 4)"))
def _(spark, d):
    return fr.frame_trades(_frames(spark, d)).select("event_id", "price")


@query(
    "prj5_exact_decimals",
    """SELECT l_orderkey, l_linenumber, l_partkey,
              CAST((CASE WHEN l_linenumber % 2 = 1 THEN -1 ELSE 1 END) * (CAST(l_extendedprice AS DECIMAL(18,2)) + 0.0099) AS DECIMAL(18,4)) AS price
       FROM lineitem""",
)
def _(spark, d):
    # Two decimals written with five more digits: everything past the fourth must be cut, not rounded.
    li = spark.read.parquet(f"{d}/lineitem.parquet").select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")
    text = F.concat(
        F.when(F.col("l_linenumber") % 2 == 1, "-").otherwise(""),
        F.col("l_extendedprice").cast("decimal(18,2)").cast("string"), F.lit("99999"),
    )
    return li.select("l_orderkey", "l_linenumber", "l_partkey", price_of(text).alias("price"))


@query("prj6_plain_decimal_text", s.with_([s.TRADES], "SELECT event_id, CAST(price AS VARCHAR) AS price, CAST(volume AS VARCHAR) AS volume FROM trades"))
def _(spark, d):
    return dv.events_trades(spark, d).select(
        "event_id", F.col("price").cast("string").alias("price"), F.col("volume").cast("string").alias("volume")
    )


@query(
    "prj8_archive_rows",
    s.with_(
        [s.TRADES],
        f"""SELECT symbol, {s.ms_ts('event_ms')} AS event_time, seq_in_ms, {s.ms_ts('ingest_ms')} AS ingest_time, price, volume,
                   recv_seq, conn_id, kafka_partition FROM trades""",
    ),
)
def _(spark, d):
    return dv.stored_trades(dv.events_trades(spark, d)).select(
        "symbol", "event_time", "seq_in_ms", "ingest_time", "price", "volume", "recv_seq", "conn_id", "kafka_partition"
    )


@query(
    "prj9_required_run_id",
    s.with_([s.TRADES, f"c AS ({s.ohlcv('trades', HOUR_MS)})"],
            "SELECT symbol, window_start, close, CASE WHEN trade_count % 2 = 0 THEN '' ELSE 'r1' END AS run_id FROM c"),
)
def _(spark, d):
    c = cd.candles(dv.events_trades(spark, d), HOUR_MS).withColumn("run_id", F.when(F.col("trade_count") % 2 == 1, "r1"))
    from tapecheck.streaming.sinks import candle_row

    return candle_row(c).select("symbol", "window_start", "close", "run_id")


@query("prj13_kst_display", s.with_([s.TRADES], f"SELECT event_id, {s.ms_kst('ingest_ms')} AS kst FROM trades"))
def _(spark, d):
    return dv.events_trades(spark, d).select("event_id", kst_text(wall_clock("ingest_ms")).alias("kst"))


@query(
    "prj15_late_payload",
    s.with_(
        [s.TRADES],
        """SELECT event_id, '{"event_ms":' || event_ms || ',"seq_in_ms":' || seq_in_ms || ',"price":"' || price || '","volume":"' || volume
                  || '","conn_id":"' || conn_id || '","recv_seq":' || recv_seq || '}' AS payload FROM trades""",
    ),
)
def _(spark, d):
    return dv.events_trades(spark, d).select("event_id", lt.late_payload().alias("payload"))


_RUN = CandleSettings(run_id="r1", window_ms=HOUR_MS)


@query(
    "prj16_run_description",
    s.with_(
        [s.TRADES, s.ARCHIVE, s.mine()],
        f"""SELECT run_id, count(*) AS windows, CASE WHEN run_id = 'r1' THEN '{_RUN.describe()}' END AS description
            FROM mine GROUP BY 1""",
    ),
)
def _(spark, d):
    per_run = dv.own_of(spark, d).groupBy("run_id").agg(F.count(F.lit(1)).alias("windows"))
    return per_run.join(_RUN.as_row(spark).select("run_id", "description"), "run_id", "left")


_PAGES = f"""paged AS (
  SELECT symbol, window_start, epoch_ms(window_start) + {HOUR_MS} AS label_ms, open, high, low, close,
         CASE WHEN date_diff('day', DATE '1970-01-01', CAST(window_start AS DATE)) % 2 = 1 AND hour(window_start) = 5
              THEN NULL ELSE volume END AS volume
  FROM official_base)"""


def _pages(spark, d):
    base = cd.candles(dv.events_trades(spark, d).filter(~F.col("conn_id").like("synth%")), HOUR_MS)
    return of.official_pages(tx.candle_pages(base))


@query(
    "src5_official_pages",
    s.with_([s.TRADES, s.official(), _PAGES],
            "SELECT symbol, label_ms, CAST(open AS VARCHAR) AS open, CAST(close AS VARCHAR) AS close, coalesce(CAST(volume AS VARCHAR), '') AS volume FROM paged"),
)
def _(spark, d):
    return _pages(spark, d).select("symbol", "label_ms", "open", "close", "volume")


_CUTOFF = "(SELECT max(label_ms) - 3 * 3600000 FROM paged)"


@query("flt3_settle_cutoff", s.with_([s.TRADES, s.official(), _PAGES], f"SELECT symbol, label_ms FROM paged WHERE label_ms <= {_CUTOFF}"))
def _(spark, d):
    pages = _pages(spark, d)
    newest = pages.agg(F.max("label_ms")).first()[0]
    return of.settled(pages, newest, settle_minutes=180).select("symbol", "label_ms")


@query(
    "prj10_official_rows",
    s.with_([s.TRADES, s.official(), _PAGES],
            "SELECT symbol, window_start, open, high, low, close, coalesce(volume, 0)::DECIMAL(18,8) AS volume FROM paged"),
)
def _(spark, d):
    return of.official_rows(_pages(spark, d), F.lit(None).cast("timestamp_ntz"), HOUR_MS).drop("fetched_at")


@query("prj11_end_to_start", s.with_([s.TRADES, s.official(), _PAGES], "SELECT symbol, label_ms, window_start FROM paged"))
def _(spark, d):
    return _pages(spark, d).select("symbol", "label_ms", wall_clock(F.col("label_ms") - HOUR_MS).alias("window_start"))


@query("prj12_blank_to_zero", s.with_([s.TRADES, s.official(), _PAGES], "SELECT symbol, window_start, 0::DECIMAL(18,8) AS volume FROM paged WHERE volume IS NULL"))
def _(spark, d):
    rows = of.official_rows(_pages(spark, d), F.lit(None).cast("timestamp_ntz"), HOUR_MS)
    return rows.filter(F.col("volume") == 0).select("symbol", "window_start", "volume")


_REASONS = """reasons AS (
  SELECT *, CASE event_id % 101 WHEN 0 THEN 'malformed-json' WHEN 1 THEN 'missing-symbol' WHEN 2 THEN 'missing-field'
                 WHEN 3 THEN 'malformed-number' WHEN 5 THEN 'malformed-json' WHEN 6 THEN 'malformed-json'
                 WHEN 7 THEN 'malformed-json' END AS reason
  FROM trades WHERE event_id % 101 <> 4)"""
_JSON = """'{"symbol":"' || CASE WHEN event_id % 101 = 1 THEN ' ' ELSE symbol END || '","event_ms":' || event_ms || ',"seq_in_ms":' || seq_in_ms
   || ',"ingest_ms":' || ingest_ms || ',"price":"' || CASE event_id % 101 WHEN 2 THEN '' WHEN 3 THEN 'abc' ELSE CAST(price AS VARCHAR) END
   || '","volume":"' || volume || '","currency":"KRW","conn_id":"' || conn_id || '","recv_seq":' || recv_seq || '}'"""
_PAYLOAD = f"""CASE event_id % 101 WHEN 0 THEN left({_JSON}, 30) WHEN 5 THEN '' WHEN 6 THEN '[]'
   WHEN 7 THEN repeat('x', 2000) || '…(truncated)' ELSE {_JSON} END"""
_LETTERS = f"""letters AS (
  SELECT {s.ms_ts('ingest_ms')} AS seen_at, 'deserialize' AS stage, reason,
         CASE WHEN reason IN ('missing-field', 'malformed-number') THEN symbol ELSE '' END AS symbol,
         {_PAYLOAD} AS payload, 'r1' AS job_run FROM reasons WHERE reason IS NOT NULL)"""


def _classified(spark, d):
    return lt.classify(tx.wire_records(dv.events_trades(spark, d)))


def _letters(spark, d):
    return lt.dead_letters(_classified(spark, d), "r1", wall_clock("seen_ms"))


@query("flt1_classify", s.with_([s.TRADES, _REASONS], "SELECT event_id, reason FROM reasons"))
def _(spark, d):
    return _classified(spark, d).select("event_id", "reason")


@query(
    "flt1_valid_trades",
    s.with_([s.TRADES, _REASONS],
            """SELECT event_id, symbol, event_ms, seq_in_ms, ingest_ms, price, volume, currency, conn_id, recv_seq,
                      -1 AS kafka_partition, -1 AS kafka_offset FROM reasons WHERE reason IS NULL"""),
)
def _(spark, d):
    return lt.good_trades(_classified(spark, d), keep=["event_id"])


@query("flt2_malformed_numbers", s.with_([s.TRADES, _REASONS], "SELECT event_id, symbol FROM reasons WHERE reason = 'malformed-number'"))
def _(spark, d):
    return _classified(spark, d).filter(F.col("reason") == "malformed-number").select("event_id", F.col("t.symbol").alias("symbol"))


@query(
    "flt9_no_empty_candles",
    s.with_([s.TRADES, _REASONS, f"c AS ({s.ohlcv('reasons', HOUR_MS, 'reason IS NULL')})"], "SELECT * FROM c WHERE trade_count > 0"),
)
def _(spark, d):
    return cd.candles(lt.good_trades(_classified(spark, d)), HOUR_MS)


@query("snk6_dead_letters", s.with_([s.TRADES, _REASONS, _LETTERS], "SELECT * FROM letters"))
def _(spark, d):
    return _letters(spark, d)


@query(
    "agg12_dead_letter_summary",
    s.with_(
        [s.TRADES, _REASONS, _LETTERS],
        """SELECT stage, reason, count(*) AS dropped, count(DISTINCT symbol) AS symbols,
                  strftime(min(seen_at), '%Y-%m-%d %H:%M:%S.%g') AS first_seen, strftime(max(seen_at), '%Y-%m-%d %H:%M:%S.%g') AS last_seen,
                  arg_min(left(payload, 200), (seen_at, left(payload, 200))) AS sample
           FROM letters GROUP BY 1, 2 ORDER BY dropped DESC""",
    ),
)
def _(spark, d):
    return lt.dead_letter_summary(_letters(spark, d)).orderBy(F.desc("dropped"), "stage", "reason")


@query(
    "snk10_retention",
    s.with_(
        [s.TRADES, _REASONS, _LETTERS],
        "SELECT reason, count(*) AS kept FROM letters WHERE seen_at > (SELECT max(seen_at) FROM letters) - INTERVAL 14 DAY GROUP BY 1",
    ),
)
def _(spark, d):
    letters = _letters(spark, d)
    newest = letters.agg(F.max("seen_at")).first()[0]
    kept = stores.retained(letters, "seen_at", stores.RETENTION_DAYS["dead_letters"], F.lit(str(newest)).cast("timestamp_ntz"))
    return kept.groupBy("reason").agg(F.count(F.lit(1)).alias("kept"))


@query(
    "snk11_day_layout",
    s.with_(
        [s.TRADES],
        f"SELECT CAST({s.ms_ts('event_ms')} AS DATE) AS day, count(*) AS trades FROM trades GROUP BY 1",
    ),
)
def _(spark, d):
    path = stores.write_by_day(dv.stored_trades(dv.events_trades(spark, d)), "event_time", "trades_raw")
    return stores.read_days(spark, path).groupBy("day").agg(F.count(F.lit(1)).alias("trades"))


@query(
    "snk13_keyed_records",
    s.with_(
        [s.TRADES],
        """SELECT symbol AS key, '{"symbol":"' || symbol || '","event_ms":' || event_ms || ',"seq_in_ms":' || seq_in_ms
   || ',"ingest_ms":' || ingest_ms || ',"price":"' || price || '","volume":"' || volume
   || '","currency":"KRW","conn_id":"' || conn_id || '","recv_seq":' || recv_seq || '}' AS value FROM trades""",
    ),
)
def _(spark, d):
    return tr.keyed_records(dv.events_trades(spark, d))


@query(
    "snk12_one_file_per_day",
    s.with_(
        [s.TRADES, f"c AS ({s.ohlcv('trades', HOUR_MS)})"],
        "SELECT CAST(window_start AS DATE) AS day, count(*) AS windows, 1::BIGINT AS files FROM c GROUP BY 1",
    ),
)
def _(spark, d):
    # Candles are small: rows of one day go to one writer, days are spread over the writers.
    path = stores.write_by_day(cd.candles(dv.events_trades(spark, d), HOUR_MS), "window_start", "candles_1m", one_writer_per_day=True)
    rows = stores.read_days(spark, path).withColumn("file", F.input_file_name())
    return rows.groupBy("day").agg(F.count(F.lit(1)).alias("windows"), F.countDistinct("file").alias("files"))
