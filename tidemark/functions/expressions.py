"""Column expressions shared by the operators; all built-in, all codegen-friendly."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

MILLIS_PER_DAY = 86_400_000


def utc_day(epoch_ms: Column) -> Column:
    """UTC date of an epoch-millisecond column, whatever the session time zone."""
    days = F.floor(epoch_ms / F.lit(MILLIS_PER_DAY)).cast("int")
    return F.date_add(F.lit(dt.date(1970, 1, 1)), days)


def relative_change(value: Column, base: Column) -> Column:
    """``(value - base) / base``; null when the base is zero."""
    return F.try_divide(value - base, base)


def ratio_change(value: Column, base: Column) -> Column:
    """``value / base - 1``; null when the base is zero."""
    return F.try_divide(value, base) - F.lit(1.0)


def ordering(columns: list[Column]) -> Column:
    """One comparable value for a lexicographic order.

    A single column stays bare: aggregates keyed by a primitive keep Spark's
    hash aggregation, a struct key falls back to sort aggregation.
    """
    return columns[0] if len(columns) == 1 else F.struct(*columns)


def packed(high: Column, low: Column) -> Column:
    """One number ordered by ``high`` (up to 20 digits), then ``low`` (below 10**18); nulls as 0.

    A decimal stays in hash aggregation, where a struct would need a sort.
    """
    number = F.coalesce(high, F.lit(0)).cast("decimal(20,0)") * F.lit(10**17).cast("decimal(18,0)")
    return (number + F.coalesce(low, F.lit(0)).cast("decimal(18,0)")).cast("decimal(38,0)")


def stamp_number(stamp: Column) -> Column:
    """A ``yyyymmdd_hhmmss`` stamp as a number; 0 if it is none."""
    return F.coalesce(F.replace(stamp, F.lit("_"), F.lit("")).try_cast("long"), F.lit(0))


def file_stamp(file_name: Column) -> Column:
    """``yyyymmdd_hhmmss`` at the end of a landed file name."""
    return F.regexp_extract(file_name, r"_(\d{8}_\d{6})\.json$", 1)


def stamp_day(stamp: Column) -> Column:
    """Calendar date of a ``yyyymmdd_hhmmss`` stamp; null if it is none."""
    return F.try_to_timestamp(F.substring(stamp, 1, 8), F.lit("yyyyMMdd")).cast("date")
