"""Bucket keys: YYYYMM for months, YYYYMMDD for days, and their ordinals."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def unit_of(key: Column) -> Column:
    """'month' or 'day' by the key's length; null for any other length."""
    return F.when(F.length(key) == 6, "month").when(F.length(key) == 8, "day")


def first_day(key: Column) -> Column:
    return F.when(F.length(key) == 6, F.try_to_date(F.concat(key, F.lit("01")), "yyyyMMdd")).when(F.length(key) == 8, F.try_to_date(key, "yyyyMMdd"))


def last_day(key: Column) -> Column:
    return F.when(F.length(key) == 6, F.last_day(first_day(key))).otherwise(first_day(key))


def bucket_index(key: Column) -> Column:
    """Months since year 0, or days since 1970, by the key's unit; null where the key is no date."""
    d = first_day(key)
    return F.when(F.length(key) == 6, (F.year(d) * 12 + F.month(d) - 1).cast("long")).otherwise(F.unix_date(d).cast("long"))


def bucket_key(index: Column, unit: str) -> Column:
    if unit == "month":
        return F.concat(F.lpad(F.floor(index / 12).cast("string"), 4, "0"), F.lpad((F.pmod(index, F.lit(12)) + 1).cast("string"), 2, "0"))
    return F.date_format(F.date_from_unix_date(index.cast("int")), "yyyyMMdd")


def day_key(time: Column) -> Column:
    return F.date_format(time, "yyyyMMdd")


def month_key(time: Column) -> Column:
    return F.date_format(time, "yyyyMM")


def days_between(low: Column, high: Column) -> Column:
    """Days that two keys span, both ends counted."""
    return F.datediff(last_day(high), first_day(low)) + 1


def label(key: Column) -> Column:
    return F.when(F.length(key) == 6, F.date_format(first_day(key), "yyyy-MM")).otherwise(F.date_format(first_day(key), "yyyy-MM-dd"))


def later(a: Column, b: Column) -> Column:
    """The later of two keys of one unit; keys of different lengths raise."""
    return F.when(F.assert_true(F.length(a) == F.length(b), "keys of two units").isNull(), F.greatest(a, b))


def axis_position(key: Column, low: Column, size: Column) -> Column:
    """A key's place on an axis that starts at low, -1 where it is outside or no key."""
    at = bucket_index(key) - bucket_index(low)
    return F.when(at.isNotNull() & (at >= 0) & (at < size), at).otherwise(F.lit(-1).cast("long"))
