"""Exact decimals from text, truncated toward zero, never through a double."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, functions as F


def parse_decimal(text: Column, scale: int) -> Column:
    """DECIMAL(18, scale) of a number written as text; NULL when it is not one or does not fit.

    A plain cast would round the digits that do not fit, so they are cut off first.
    """
    wide = F.trim(text).try_cast("decimal(38,18)")
    cut = F.when(wide >= 0, F.floor(wide, F.lit(scale))).otherwise(F.ceil(wide, F.lit(scale)))
    return cut.try_cast(f"decimal(18,{scale})")


def price_of(text: Column) -> Column:
    return parse_decimal(text, 4)


def volume_of(text: Column) -> Column:
    return parse_decimal(text, 8)


def volume_sum(volume: str = "volume") -> Column:
    """Exact sum of a DECIMAL(18,8), added up as whole 10^-8 units in a BIGINT.

    Spark widens a decimal sum to DECIMAL(28,8), which no longer fits a long and makes every row's
    addition a BigDecimal one. A sum too large for the BIGINT does not fit DECIMAL(18,8) either and
    is an error, not a wrong number.
    """
    units = (F.col(volume) * F.lit(100_000_000).cast("decimal(9,0)")).cast("bigint")
    return (F.sum(units) * F.lit(Decimal("0.00000001"))).cast("decimal(18,8)")
