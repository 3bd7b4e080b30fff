"""Time columns: epoch milliseconds in flight, UTC wall-clock at rest."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

DAY_MS = 86_400_000
KST_HOURS = 9
#: Bits of the packed order key that hold the number in the millisecond.
SEQUENCE_BITS = 20


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def epoch_ms(ts: Column | str) -> Column:
    """Milliseconds since 1970 of a UTC wall-clock timestamp, whatever the session zone is."""
    t = _col(ts)
    return (
        F.unix_date(F.to_date(t)).cast("bigint") * DAY_MS
        + F.hour(t).cast("bigint") * 3_600_000
        + F.minute(t).cast("bigint") * 60_000
        + (F.extract(F.lit("SECOND"), t) * 1000).cast("bigint")
    )


def epoch_us(ts: Column | str) -> Column:
    """Microseconds since 1970 of a UTC wall-clock timestamp."""
    t = _col(ts)
    whole = F.unix_date(F.to_date(t)).cast("bigint") * 86_400 + F.hour(t).cast("bigint") * 3_600 + F.minute(t).cast("bigint") * 60
    return whole * 1_000_000 + (F.extract(F.lit("SECOND"), t) * 1_000_000).cast("bigint")


def wall_clock(ms: Column | str) -> Column:
    """Inverse of :func:`epoch_ms`."""
    return F.timestamp_add("MILLISECOND", _col(ms), F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'"))


def bucket_start(ms: Column | str, width_ms: int) -> Column:
    """Start of the epoch-aligned tumbling window that holds ``ms``."""
    m = _col(ms)
    return m - F.pmod(m, F.lit(width_ms).cast("bigint"))


#: Windows that one row lists at a time.
STRETCH = 1_000


def each_window(df: DataFrame, first: Column | str, last: Column | str, width_ms: int, name: str) -> DataFrame:
    """One row per window start from ``first`` to ``last`` (both included; none if ``last`` lies before ``first``).

    A silence of years is listed in stretches of ``STRETCH`` windows, so no row holds an array of all of them.
    """
    one, many = F.lit(width_ms).cast("bigint"), F.lit(width_ms * STRETCH).cast("bigint")
    spans = df.withColumns({"_first": _col(first), "_last": _col(last)}).filter("_last >= _first")
    spans = spans.withColumn("_from", F.explode(F.sequence("_first", "_last", many)))
    until = F.least(F.col("_last"), F.col("_from") + width_ms * (STRETCH - 1))
    return spans.withColumn(name, F.explode(F.sequence("_from", until, one))).drop("_first", "_last", "_from")


def text(ts: Column | str) -> Column:
    """yyyy-MM-dd HH:mm:ss.SSS of a wall-clock timestamp.

    Built from its plain text: ``date_format`` would pass through the session zone, where hours
    that a clock change skips do not exist.
    """
    plain = _col(ts).cast("timestamp_ntz").cast("string")
    return F.concat(F.substring(plain, 1, 19), F.lit("."), F.rpad(F.substring(plain, 21, 3), 3, "0"))


def kst_text(ts: Column | str) -> Column:
    """Display form used by reports: nine hours ahead, millisecond resolution."""
    return text(_col(ts) + F.expr(f"INTERVAL {KST_HOURS} HOURS"))


def fits_key(seq: Column | str) -> Column:
    """Whether a number in the millisecond (or a missing one, which counts as 0) fits the packed order key."""
    return F.coalesce(_col(seq).cast("bigint"), F.lit(0)).between(0, (1 << SEQUENCE_BITS) - 1)


def arrival_key(event_ms: Column | str, seq: Column | str) -> Column:
    """(event_ms, seq) packed into one BIGINT that sorts the same way.

    A single BIGINT keeps ``min_by``/``max_by`` in a hash aggregate; a struct key would force
    a sort of the raw rows. 20 bits hold the in-millisecond number, 43 bits the time (until
    the year 2248). A missing number counts as 0: a key of NULL would drop the trade from open and close.
    A number outside that range is an error, never a wrong order; see :func:`wide_arrival_key`.
    """
    number = F.coalesce(_col(seq).cast("bigint"), F.lit(0))
    packed = F.shiftleft(_col(event_ms).cast("bigint"), SEQUENCE_BITS) + number
    return F.when(fits_key(seq), packed).otherwise(
        F.raise_error(F.lit("number in the millisecond does not fit the packed key; use wide_numbers")).cast("bigint")
    )


def wide_arrival_key(event_ms: Column | str, seq: Column | str) -> Column:
    """The same order for any BIGINT number, as a DECIMAL: still a hash aggregate, but slower to build."""
    half = F.lit("1" + "0" * 19).cast("decimal(20,0)")
    return (_col(event_ms).cast("decimal(18,0)") * half + F.coalesce(_col(seq).cast("decimal(19,0)"), F.lit(0).cast("decimal(19,0)"))).cast("decimal(38,0)")


def utc_now() -> Column:
    """Current UTC wall-clock, whatever the session zone is."""
    return wall_clock(F.unix_millis(F.current_timestamp()))
