"""Timestamp text to epoch seconds and back.

Text without a zone is read in the session time zone, so jobs pin it to UTC.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from vigil import fixed_values as fixed

# Text that names a time but no date; Spark would fill in today's date.
_TIME_ONLY = r"^\s*T?\d+:"


def with_default_date(ts: Column, date: str = fixed.DEFAULT_DATE) -> Column:
    """Put ``date`` before text as long as HH:MM:SS; leave other text alone."""
    return F.when(
        F.length(ts) == fixed.TIME_ONLY_LENGTH, F.concat(F.lit(date + " "), ts)
    ).otherwise(ts)


def parse_lenient(ts: Column) -> Column:
    """Any timestamp text Spark's cast accepts, but for time-only text; else null."""
    return F.when(~ts.rlike(_TIME_ONLY), ts.try_cast("timestamp"))


def parse_strict(ts: Column) -> Column:
    """Only ``yyyy-MM-dd HH:mm:ss``; else null."""
    return F.try_to_timestamp(ts, F.lit(fixed.STRICT_TS_FORMAT))


def parse(ts: Column, mode: str) -> Column:
    if mode == "lenient":
        return parse_lenient(ts)
    if mode == "strict":
        return parse_strict(ts)
    raise ValueError(f"unknown timestamp mode: {mode}")


def epoch_second(ts: Column, mode: str) -> Column:
    """Whole epoch second of timestamp text, null where it does not parse."""
    return F.unix_seconds(parse(ts, mode))


def parsed_once(rows: DataFrame, mode: str, name: str = "parsed", ts: str = "ts") -> DataFrame:
    """Add the timestamp of the text in ``ts``, null where it does not parse.

    It comes from a generator, so that what is made of it, and filters on that,
    stay above it. Below a plain projection each of them would make and parse
    the text once more.
    """
    return rows.select("*", F.explode(F.array(parse(F.col(ts), mode))).alias(name))


def _shown(second: Column, zone: str | None) -> Column:
    """The clock in ``zone`` at an epoch second; without one, the session's."""
    ts = F.timestamp_seconds(second)
    return ts if zone is None else F.convert_timezone(None, F.lit(zone), ts.cast("timestamp_ntz"))


def time_of_day(second: Column, zone: str | None = None) -> Column:
    """HH:mm:ss of an epoch second in ``zone``, else the session time zone; the date is lost."""
    return F.date_format(_shown(second, zone), fixed.TIME_OF_DAY_FORMAT)


def second_of_day(second: Column, zone: str | None = None) -> Column:
    """The clock time behind ``time_of_day`` as seconds since midnight."""
    ts = _shown(second, zone)
    return F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts)
