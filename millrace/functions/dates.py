"""Business-date and time helpers (built-in functions only)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, functions as F

OPEN_DATE = dt.date(9999, 12, 31)


def as_date(value: str | dt.date) -> dt.date:
    """Normalise ``2025-07-18``, ``20250718`` or a date into one date object."""
    if isinstance(value, dt.datetime):
        return value.date()
    if isinstance(value, dt.date):
        return value
    text = value.replace("-", "")
    return dt.date(int(text[:4]), int(text[4:6]), int(text[6:8]))


def back(as_of: str | dt.date, days: int) -> dt.date:
    return as_date(as_of) - dt.timedelta(days=days)


def window_start(as_of: str | dt.date, days: int) -> dt.date:
    """First day of the window of ``days`` days that ends on ``as_of``."""
    return back(as_of, days - 1)


def in_last(col: Column, as_of: str | dt.date, days: int) -> Column:
    """Inclusive last-N-days test, written so that a scan can prune on it."""
    return (col >= F.lit(window_start(as_of, days))) & (col <= F.lit(as_date(as_of)))


def since(col: Column, as_of: str | dt.date, days: int) -> Column:
    """``col >= as_of - days`` (recency filter)."""
    return col >= F.lit(back(as_of, days))


def millis_to_ts(col: Column) -> Column:
    return F.timestamp_millis(col.cast("bigint"))


def millis_to_text(col: Column, zone: str = "UTC") -> Column:
    """Epoch millis to ``yyyy-MM-dd HH:mm:ss`` in ``zone`` (session zone is UTC)."""
    return F.date_format(F.from_utc_timestamp(millis_to_ts(col), zone), "yyyy-MM-dd HH:mm:ss")


def millis_to_date(col: Column, zone: str = "UTC") -> Column:
    return F.to_date(F.from_utc_timestamp(millis_to_ts(col), zone))


def epoch_day_to_date(col: Column) -> Column:
    return F.date_add(F.lit(dt.date(1970, 1, 1)), col.cast("int"))


def repair_iso_text(col: Column) -> Column:
    """``yyyy-MM-ddTHH:mm:ss...`` to ``yyyy-MM-dd HH:mm:ss``."""
    return F.concat(F.substring(col, 1, 10), F.lit(" "), F.substring(col, 12, 8))


def is_weekend(col: Column) -> Column:
    return F.weekday(col) >= 5


def spans_weekend(start: Column, end: Column) -> Column:
    """1 if either end falls on a weekend or the span has seven days or more."""
    hit = is_weekend(start) | is_weekend(end) | (F.datediff(end, start) >= 7)
    return F.when(hit, 1).otherwise(0)


def week_start(col: Column) -> Column:
    return F.to_date(F.date_trunc("week", col))


def month_key(col: Column) -> Column:
    return F.date_format(col, "yyyy-MM")


def age_years(birthday: Column, as_of: str | dt.date) -> Column:
    """Completed years (zero for a birthday less than a year ahead)."""
    return F.timestamp_diff("YEAR", birthday.cast("timestamp"), F.lit(as_date(as_of)).cast("timestamp")).cast("int")


def birth_decade(birthday: Column) -> Column:
    return (F.floor(F.year(birthday) / 10) * 10).cast("int")


def minutes_between(start: Column, end: Column) -> Column:
    return F.timestamp_diff("MINUTE", start, end)


def seconds_between(start: Column, end: Column) -> Column:
    return F.unix_timestamp(end) - F.unix_timestamp(start)


def day_partitions(spark, first: str | dt.date, last: str | dt.date):
    """Day partitions between two dates: the date and its ``yyyymmdd`` number."""
    days = spark.range(1).select(
        F.explode(F.sequence(F.lit(as_date(first)), F.lit(as_date(last)))).alias("dt")
    )
    return days.withColumn("day_no", F.date_format("dt", "yyyyMMdd").cast("int"))
