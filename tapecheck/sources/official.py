"""Landed pages of the official candle interface."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tapecheck.functions.numbers import price_of, volume_of
from tapecheck.functions.timecols import wall_clock
from tapecheck.settings import MINUTE_MS
from tapecheck.sources.frames import offset_time_ms, strip

# Where the array may sit, and the spellings of each field, in order of preference.
_HOLDERS = ["result", "candles", "data", "items"]
_TIME = ["timestamp", "time", "dateTime"]
_FIELDS = {
    "open": ["openPrice", "open"],
    "high": ["highPrice", "high"],
    "low": ["lowPrice", "low"],
    "close": ["closePrice", "close"],
    "volume": ["volume", "accVolume"],
}


def _is_array(c: Column) -> Column:
    return strip(c).startswith("[")


def candle_array(body: Column) -> Column:
    """Text of the first candle array found in a page."""
    outer = F.from_json(body, ", ".join(f"{h} STRING" for h in _HOLDERS))
    found = F.when(_is_array(body), body)
    for h in _HOLDERS:
        held = outer[h]
        nested = F.get_json_object(held, "$.candles")
        found = found.when(_is_array(held), held).when(_is_array(nested), nested)
    return found


def official_pages(pages: DataFrame, body: str = "body") -> DataFrame:
    """One row per candle in the landed pages; the label is the interface's own time."""
    names = [*_TIME, *dict.fromkeys(n for ns in _FIELDS.values() for n in ns)]
    item = "ARRAY<STRUCT<" + ", ".join(f"{n}: STRING" for n in names) + ">>"
    rows = pages.withColumn("c", F.explode(F.from_json(candle_array(F.col(body)), item))).drop(body)
    label = F.coalesce(*[F.col(f"c.{n}") for n in _TIME])
    return rows.select(
        *[c for c in pages.columns if c != body],
        offset_time_ms(label).alias("label_ms"),
        *[F.coalesce(*[F.col(f"c.{n}") for n in ns]).alias(k) for k, ns in _FIELDS.items()],
    ).filter(F.col("label_ms").isNotNull())


def settled(rows: DataFrame, as_of_ms: Column | int, settle_minutes: int = 2) -> DataFrame:
    """Leave out candles that may still change; they are fetched again next time."""
    limit = (as_of_ms if isinstance(as_of_ms, Column) else F.lit(as_of_ms)) - settle_minutes * MINUTE_MS
    return rows.filter(F.col("label_ms") <= limit)


def official_rows(rows: DataFrame, fetched_at: Column, window_ms: int = MINUTE_MS) -> DataFrame:
    """Label (window end) to window start, blank numbers to zero, text to exact decimals."""

    def number(name: str, parse) -> Column:
        c = F.col(name)
        blank = c.isNull() | c.rlike(r"^\s*$")
        return parse(F.when(blank, "0").otherwise(c)).alias(name)

    return rows.select(
        "symbol", wall_clock(F.col("label_ms") - window_ms).alias("window_start"),
        *[number(n, price_of) for n in ("open", "high", "low", "close")],
        number("volume", volume_of),
        fetched_at.alias("fetched_at"),
    )
