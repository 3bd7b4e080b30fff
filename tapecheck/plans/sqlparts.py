"""SQL building blocks for the oracle: the same derived tables, in plain SQL."""

from __future__ import annotations

HOUR = 3_600_000
MINUTE = 60_000

TRADES = """trades AS (
  SELECT event_id, event_type AS symbol, epoch_us(ts) // 1000 AS event_ms,
         CAST(epoch_us(ts) % 1000 AS INTEGER) AS seq_in_ms,
         epoch_us(ts) // 1000 + (event_id * 37) % 4001 - 200 AS ingest_ms,
         CAST(100 + value AS DECIMAL(18,4)) AS price,
         CAST(1 + event_id % 50 AS DECIMAL(18,8)) AS volume,
         'KRW' AS currency,
         CASE WHEN event_id % 50 = 0 THEN 'synth-1'
              ELSE 'c' || CAST(event_id - event_id % 1000 AS VARCHAR) END AS conn_id,
         CASE WHEN event_id % 50 = 0 THEN event_id // 50 + 1
              ELSE event_id % 1000 - (event_id % 1000 + 49) // 50 + 1 END AS recv_seq,
         CAST(ascii(event_type) % 3 AS INTEGER) AS kafka_partition
  FROM events)"""

DISORDERED = """disordered AS (
  SELECT * REPLACE (event_ms + (event_id * 2654435) % 14400000 AS ingest_ms) FROM trades)"""

ARCHIVE = """archive AS (
  SELECT * FROM trades WHERE event_id % 211 <> 0
  UNION ALL SELECT * FROM trades WHERE event_id % 307 = 0)"""


BOUNDARY = """shifted AS (
  SELECT * REPLACE (CASE WHEN (event_ms // 3600000) % 5 = 0 AND event_ms % 3600000 < 600000
                         THEN event_ms - 600000 ELSE event_ms END AS event_ms)
  FROM trades WHERE conn_id NOT LIKE 'synth%')"""


def ohlcv(source: str, window: int, where: str = "TRUE") -> str:
    return f"""SELECT symbol, make_timestamp((event_ms - event_ms % {window}) * 1000) AS window_start,
         arg_min(price, (event_ms, seq_in_ms)) AS open, max(price) AS high, min(price) AS low,
         arg_max(price, (event_ms, seq_in_ms)) AS close,
         CAST(sum(volume) AS DECIMAL(18,8)) AS volume, count(*) AS trade_count
  FROM {source} WHERE {where} GROUP BY 1, 2"""


def official(window: int = HOUR) -> str:
    half, full = window // 2, window
    return f"""official_base AS ({ohlcv('trades', window, "conn_id NOT LIKE 'synth%'")}),
official AS (
  SELECT symbol, window_start, open, high, low, close, volume, window_start + to_milliseconds({full}) AS fetched_at
  FROM official_base
  UNION ALL
  SELECT symbol, window_start, open, high, low, close, CAST(volume + 1 AS DECIMAL(18,8)),
         window_start + to_milliseconds({half})
  FROM official_base WHERE (epoch_ms(window_start) // {window}) % 7 = 0)"""


def mine(window: int = HOUR) -> str:
    return f"""mine_base AS (SELECT * FROM ({ohlcv('archive', window)}) WHERE (epoch_ms(window_start) // {window}) % 17 <> 0),
mine AS (
  SELECT *, window_start + to_milliseconds(66000) AS ingested_at, 'r1' AS run_id FROM mine_base
  UNION ALL
  SELECT *, window_start + to_milliseconds(126000), 'r2' FROM mine_base
  WHERE (epoch_ms(window_start) // {window}) % 13 = 0)"""


DEDUP = """mine_latest AS (
  SELECT symbol, window_start, l.open AS open, l.high AS high, l.low AS low, l.close AS close, l.volume AS volume,
         l.trade_count AS trade_count, write_count
  FROM (SELECT symbol, window_start,
               arg_max({'open': open, 'high': high, 'low': low, 'close': close, 'volume': volume,
                        'trade_count': trade_count}, (ingested_at, run_id)) AS l,
               count(*) AS write_count
        FROM mine GROUP BY 1, 2))"""

OFFICIAL_LATEST = """official_latest AS (
  SELECT symbol, window_start, l.open AS open, l.high AS high, l.low AS low, l.close AS close, l.volume AS volume,
         fetched_at
  FROM (SELECT symbol, window_start,
               arg_max({'open': open, 'high': high, 'low': low, 'close': close, 'volume': volume}, fetched_at) AS l,
               max(fetched_at) AS fetched_at
        FROM official GROUP BY 1, 2))"""

MATCHED = """matched AS (
  SELECT m.symbol, m.window_start, m.open AS my_open, m.high AS my_high, m.low AS my_low, m.close AS my_close,
         m.volume AS my_volume, m.trade_count AS my_trade_count, m.write_count AS my_write_count,
         o.open AS off_open, o.high AS off_high, o.low AS off_low, o.close AS off_close, o.volume AS off_volume
  FROM mine_latest m JOIN official_latest o ON m.symbol = o.symbol AND m.window_start = o.window_start)"""

MISMATCHES = """mismatches AS (
  SELECT symbol, window_start, my_volume AS my_vol, off_volume AS off_vol,
         CAST(my_volume - off_volume AS DECIMAL(18,8)) AS vol_diff,
         CAST(my_close - off_close AS DECIMAL(18,4)) AS close_diff
  FROM matched WHERE my_volume <> off_volume OR my_close <> off_close)"""

STORES = [TRADES, ARCHIVE, official(), mine(), DEDUP, OFFICIAL_LATEST, MATCHED, MISMATCHES]

LINE_TRADES = """line_trades AS (
  SELECT l_suppkey AS symbol,
         epoch_ms(date_trunc('day', l_shipdate))
           + (l_orderkey * 7919 + l_linenumber * 104729 + l_partkey) % 86400000 AS event_ms,
         CAST(l_orderkey % 100000 * 8 + l_linenumber AS INTEGER) AS seq_in_ms,
         CAST(l_extendedprice AS DECIMAL(18,4)) AS price, CAST(l_quantity AS DECIMAL(18,8)) AS volume
  FROM lineitem)"""


def with_(parts: list[str], select: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n" + select


def kst(ts: str) -> str:
    """Nine hours ahead, as text with milliseconds."""
    return f"strftime({ts} + INTERVAL 9 HOUR, '%Y-%m-%d %H:%M:%S.%g')"


def ms_ts(ms: str) -> str:
    return f"make_timestamp(({ms}) * 1000)"


def ms_text(ms: str) -> str:
    return f"strftime({ms_ts(ms)}, '%Y-%m-%d %H:%M:%S.%g')"


def ms_kst(ms: str) -> str:
    return kst(ms_ts(ms))
