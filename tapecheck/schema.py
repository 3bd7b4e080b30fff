"""Declared schemas. Times at rest are UTC wall-clock (TIMESTAMP_NTZ), so no result
depends on the session time zone; times in flight are epoch milliseconds."""

from __future__ import annotations

from pyspark.sql import types as T

PRICE = T.DecimalType(18, 4)
VOLUME = T.DecimalType(18, 8)

# What a producer publishes; prices and volumes stay text until they are parsed once.
WIRE_TRADE = T.StructType(
    [
        T.StructField("symbol", T.StringType()),
        T.StructField("event_ms", T.LongType()),
        T.StructField("seq_in_ms", T.IntegerType()),
        T.StructField("ingest_ms", T.LongType()),
        T.StructField("price", T.StringType()),
        T.StructField("volume", T.StringType()),
        T.StructField("currency", T.StringType()),
        T.StructField("conn_id", T.StringType()),
        T.StructField("recv_seq", T.LongType()),
    ]
)

TRADE = T.StructType(
    [
        T.StructField("symbol", T.StringType()),
        T.StructField("event_ms", T.LongType()),
        T.StructField("seq_in_ms", T.IntegerType()),
        T.StructField("ingest_ms", T.LongType()),
        T.StructField("price", PRICE),
        T.StructField("volume", VOLUME),
        T.StructField("currency", T.StringType()),
        T.StructField("conn_id", T.StringType()),
        T.StructField("recv_seq", T.LongType()),
        T.StructField("kafka_partition", T.IntegerType()),
        T.StructField("kafka_offset", T.LongType()),
    ]
)

_OHLCV = [
    T.StructField("open", PRICE),
    T.StructField("high", PRICE),
    T.StructField("low", PRICE),
    T.StructField("close", PRICE),
    T.StructField("volume", VOLUME),
]

CANDLE = T.StructType(
    [T.StructField("symbol", T.StringType()), T.StructField("window_start", T.TimestampNTZType())]
    + _OHLCV
    + [
        T.StructField("trade_count", T.LongType()),
        T.StructField("ingested_at", T.TimestampNTZType()),
        T.StructField("run_id", T.StringType()),
    ]
)

#: What a window itself gives; run and write time are the store's.
BARE_CANDLE = T.StructType([f for f in CANDLE.fields if f.name not in ("ingested_at", "run_id")])

SESSION = T.StructType(
    [T.StructField("symbol", T.StringType()), T.StructField("session_start", T.TimestampNTZType()), T.StructField("session_end", T.TimestampNTZType())]
    + _OHLCV
    + [T.StructField("trade_count", T.LongType())]
)

ROLLED_UP = T.StructType([*BARE_CANDLE.fields, T.StructField("windows", T.LongType())])

OFFICIAL_CANDLE = T.StructType(
    [T.StructField("symbol", T.StringType()), T.StructField("window_start", T.TimestampNTZType())]
    + _OHLCV
    + [T.StructField("fetched_at", T.TimestampNTZType())]
)

STORED_TRADE = T.StructType(
    [
        T.StructField("symbol", T.StringType()),
        T.StructField("event_time", T.TimestampNTZType()),
        T.StructField("seq_in_ms", T.IntegerType()),
        T.StructField("ingest_time", T.TimestampNTZType()),
        T.StructField("price", PRICE),
        T.StructField("volume", VOLUME),
        T.StructField("recv_seq", T.LongType()),
        T.StructField("conn_id", T.StringType()),
        T.StructField("kafka_partition", T.IntegerType()),
        T.StructField("kafka_offset", T.LongType()),
    ]
)

DEAD_LETTER = T.StructType(
    [
        T.StructField("seen_at", T.TimestampNTZType()),
        T.StructField("stage", T.StringType()),
        T.StructField("reason", T.StringType()),
        T.StructField("symbol", T.StringType()),
        T.StructField("payload", T.StringType()),
        T.StructField("job_run", T.StringType()),
    ]
)

METRIC_SAMPLE = T.StructType(
    [
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("metric", T.StringType()),
        T.StructField("labels", T.MapType(T.StringType(), T.StringType())),
        T.StructField("value", T.DoubleType()),
    ]
)

OHLCV = ["open", "high", "low", "close", "volume"]
