"""Raw text inputs derived from the trades, with a known share of damaged records.

The text is built behind a generator, so that it behaves like a scanned column: filters of the
parser are not rewritten into the building of the text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tapecheck.functions.timecols import epoch_ms, text, wall_clock
from tapecheck.sources.trades import wire_json

def _iso(ms: Column, hours: int = 0) -> Column:
    return F.translate(text(wall_clock(ms + hours * 3_600_000)), " ", "T")


def raw_frames(trades: DataFrame) -> DataFrame:
    """One socket frame per trade: (event_id, value)."""
    kind = F.col("event_id") % 101
    stamp = (
        F.when(kind == 4, _iso(F.col("event_ms"), 9))
        .when(F.col("event_id") % 3 == 0, F.concat(_iso(F.col("event_ms")), F.lit("Z")))
        .otherwise(F.concat(_iso(F.col("event_ms"), 9), F.lit("+09:00")))
    )
    topic = F.concat(
        F.when(kind == 1, "orderbook:kr:").when(kind == 6, "trade:us:").otherwise("trade:kr:"), F.col("symbol")
    )
    data = F.struct(
        F.when(kind == 3, F.lit("")).otherwise(F.col("price").cast("string")).alias("price"),
        F.col("volume").cast("string").alias("volume"),
        stamp.alias("timestamp"),
        F.col("currency").alias("currency"),
    )
    whole = F.to_json(F.struct(F.lit("message").alias("type"), topic.alias("topic"), data.alias("data")))
    value = (
        F.when(kind == 0, F.substring(whole, 1, 25))
        .when(kind == 2, F.lit("  PONG "))
        .when(kind == 5, F.lit("[1,2]"))
        .when(kind == 7, F.lit('{"type":"subscriptions","rejected":[]}'))
        .when(kind == 8, F.lit('{"type":"error","code":"x"}'))
        .when(kind == 9, F.lit('{"type":"pong"}'))
        .when(kind == 10, F.lit(" "))
        .when(kind == 11, F.lit("{not json"))
        .when(kind == 12, F.lit('{"topic":"trade:kr:x"}'))
        .otherwise(whole)
    )
    return trades.select("event_id", F.explode(F.array(value)).alias("value"))


def wire_records(trades: DataFrame) -> DataFrame:
    """One topic record per trade: (event_id, seen_ms, key, value), some of them unusable."""
    kind = F.col("event_id") % 101
    hurt = trades.withColumns(
        {
            "symbol": F.when(kind == 1, F.lit(" ")).otherwise(F.col("symbol")),
            "price": F.when(kind == 2, F.lit("")).when(kind == 3, F.lit("abc")).otherwise(F.col("price").cast("string")),
        }
    )
    whole = wire_json()
    value = (
        F.when(kind == 0, F.substring(whole, 1, 30))
        .when(kind == 4, F.lit(None))
        .when(kind == 5, F.lit(""))
        .when(kind == 6, F.lit("[]"))
        .when(kind == 7, F.repeat(F.lit("x"), 2500))
        .otherwise(whole)
    )
    return hurt.select(
        "event_id", F.col("ingest_ms").alias("seen_ms"), F.col("symbol").alias("key"),
        F.explode(F.array(value)).alias("value"),
    )


def candle_pages(official: DataFrame) -> DataFrame:
    """Official candles as landed response pages: (symbol, body), one page per symbol and day (at
    most 24 hourly candles), in all the shapes the interface has used."""
    end = F.concat(_iso(epoch_ms("window_start") + 3_600_000, 9), F.lit("+09:00"))
    day = F.unix_date(F.to_date("window_start"))
    cells = ["open", "high", "low", "close"]
    long_form = F.to_json(F.struct(
        end.alias("timestamp"), *[F.col(c).cast("string").alias(f"{c}Price") for c in cells],
        F.col("volume").cast("string").alias("volume"),
    ))
    short_form = F.to_json(F.struct(
        end.alias("time"), *[F.col(c).cast("string").alias(c) for c in cells],
        F.when(F.hour("window_start") == 5, F.lit("")).otherwise(F.col("volume").cast("string")).alias("accVolume"),
    ))
    item = F.when(day % 2 == 0, long_form).otherwise(short_form)
    pages = (
        official.select("symbol", day.alias("day"), "window_start", item.alias("item"))
        .groupBy("symbol", "day")
        .agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("window_start", "item"))), lambda s: s["item"]), ",").alias("items"))
    )
    shape = F.col("day") % 5
    arr = F.concat(F.lit("["), F.col("items"), F.lit("]"))
    body = (
        F.when(shape == 0, F.concat(F.lit('{"result":{"candles":'), arr, F.lit(',"nextBefore":"x"}}')))
        .when(shape == 1, arr)
        .when(shape == 2, F.concat(F.lit('{"data":'), arr, F.lit("}")))
        .when(shape == 3, F.concat(F.lit('{"items":'), arr, F.lit("}")))
        .otherwise(F.concat(F.lit('{"candles":'), arr, F.lit("}")))
    )
    return pages.select("symbol", body.alias("body"))
