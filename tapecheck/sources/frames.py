"""Text frames from the exchange socket, and the trades inside them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# Fixed value: keep-alive answer that is not JSON.
KEEP_ALIVE = "PONG"
_SPACE = " \t\r\n\f\v"
# Three parts, the first of which says trade; the market may be any, closing colons do not count.
_TRADE_TOPIC = r"^trade:[^:]*:([^:]+):*$"
# A time without an offset is refused: assuming one would move trades by hours.
_OFFSET_TIME = r"(?i)^\d{4}-\d{2}-\d{2}T.*(Z|[+-]\d{2}:\d{2}(:\d{2})?)$"

_FRAME = "type STRING, topic STRING, data STRING, rejected STRING, _bad STRING"
_DATA = "price STRING, volume STRING, timestamp STRING, currency STRING, _bad STRING"


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(_SPACE))


def is_blank(c: Column) -> Column:
    return c.isNull() | (strip(c) == "")


def json_object(text: Column, schema: str) -> Column:
    """Struct of the object's fields, nested values kept as text; ``_bad`` is set when the text
    is not a JSON object."""
    return F.from_json(text, schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"})


def offset_time_ms(text: Column) -> Column:
    """Epoch milliseconds of an ISO-8601 time that states its offset, else NULL."""
    return F.when(text.rlike(_OFFSET_TIME), F.unix_millis(text.try_cast("timestamp")))


def parsed_once(df: DataFrame, value: Column, schema: str) -> DataFrame:
    """Add the fields of a JSON object as columns. The generator keeps the optimizer from copying
    the parse into every filter and projection that reads one of its fields."""
    return df.select("*", F.inline(F.array(json_object(value, schema))))


def frames(raw: DataFrame, value: str = "value") -> DataFrame:
    """Rows that are frames at all: not empty, not keep-alive text, a JSON object."""
    s = strip(F.col(value))
    gated = raw.filter((s != "") & (s != KEEP_ALIVE) & s.startswith("{"))
    parsed = parsed_once(gated, strip(F.col(value)), _FRAME).filter(F.col("_bad").isNull()).drop("_bad")
    return parsed.withColumn("type", F.coalesce("type", F.lit("unknown")))


def frame_trades(framed: DataFrame) -> DataFrame:
    """Trades in ``message`` frames; price and volume stay text. Anything incomplete is no trade."""
    symbol = F.regexp_extract(F.coalesce("topic", F.lit("")), _TRADE_TOPIC, 1)
    shaped = (
        framed.filter((F.col("type") == "message") & strip(F.col("data")).startswith("{"))
        .withColumn("symbol", symbol)
        .filter(F.col("symbol") != "")
        .drop("type", "topic", "rejected")
    )
    d = parsed_once(shaped, F.col("data"), _DATA)
    return (
        d.filter(F.col("_bad").isNull() & ~is_blank(F.col("price")) & ~is_blank(F.col("volume")))
        .withColumns({"event_ms": offset_time_ms(F.col("timestamp")), "currency": F.coalesce("currency", F.lit(""))})
        .filter(F.col("event_ms").isNotNull())
        .drop("data", "timestamp", "_bad")
    )


def frame_type_counts(framed: DataFrame) -> DataFrame:
    return framed.groupBy("type").agg(F.count(F.lit(1)).alias("frames"))
