"""Series operators: alignment, daily reduction, marks, incremental filter, gaps."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.expressions import ordering
from tidemark.schemas import FACT_KEY, MEASURES

HISTORY_DAYS = 365


def _last(value: str, order: Column, when: Column | None = None) -> Column:
    """Last non-null ``value`` by ``order``, optionally among matching rows."""
    present = F.col(value).isNotNull() if when is None else when & F.col(value).isNotNull()
    return F.max_by(value, F.when(present, order))


def align_long(points: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """Left-align market caps and volumes to prices, all given as one long frame.

    ``points`` holds ``keys``, ``series`` (price, market_cap or volume),
    ``order`` and ``value``. Prices are the spine: a key without a price point
    is dropped, a missing cap or volume is null. If a series repeats a key its
    last value wins, so repeats never multiply. Points without a key are left out. One aggregate with map-side
    combining replaces two joins.
    """
    series = F.col("series")
    columns = [_last("value", F.col(order), series == m).alias(m) for m in MEASURES]
    spine = F.count_if(series == "price").alias("_spine")
    return (
        points.where(reduce(lambda a, b: a & b, (F.col(key).isNotNull() for key in keys)))
        .groupBy(*keys)
        .agg(*columns, spine)
        .where(F.col("_spine") > 0)
        .drop("_spine")
    )


def align(
    prices: DataFrame, market_caps: DataFrame, volumes: DataFrame, keys: Sequence[str], order: str
) -> DataFrame:
    """``align_long`` for three frames with ``keys``, ``order`` and ``value``."""
    parts = zip(MEASURES, (prices, market_caps, volumes))
    tagged = [
        frame.select(*keys, F.lit(name).alias("series"), order, "value") for name, frame in parts
    ]
    return align_long(tagged[0].unionByName(tagged[1]).unionByName(tagged[2]), keys, order)


def daily_last(
    points: DataFrame, order: Sequence[str | Column], keep: Sequence[str] = MEASURES
) -> DataFrame:
    """One row per (coin, day): each column's last non-null value by ``order``.

    One number to order by, and numbers to keep, need no sort of the points.
    """
    by = ordering([F.col(c) if isinstance(c, str) else c for c in order])
    return (
        points.where(F.col("coin_id").isNotNull() & F.col("date").isNotNull())
        .groupBy(*FACT_KEY)
        .agg(*[_last(c, by).alias(c) for c in keep])
    )


def high_water_marks(fact: DataFrame, tracked: DataFrame | None = None) -> DataFrame:
    """Latest stored day per coin; null for a tracked coin without rows."""
    marks = fact.groupBy("coin_id").agg(F.max("date").alias("high_water_mark"))
    if tracked is None:
        return marks
    return tracked.select("coin_id").distinct().join(marks, "coin_id", "left")


def restate(marks: DataFrame, days: int) -> DataFrame:
    """Lower every mark by ``days`` so that recent days are loaded again."""
    if days == 0:
        return marks
    return marks.withColumn("high_water_mark", F.date_sub("high_water_mark", days))


def fetch_plan(marks: DataFrame, as_of: dt.date | Column, history_days: int = HISTORY_DAYS) -> DataFrame:
    """Days of history to ask for per coin; coins with nothing new are left out."""
    today = F.lit(as_of)
    days = F.coalesce(F.datediff(today, F.col("high_water_mark")), F.lit(history_days))
    return marks.withColumn("history_days", days).where(F.col("history_days") > 0)


def newer_than_marks(batch: DataFrame, marks: DataFrame) -> DataFrame:
    """Rows strictly newer than their coin's mark; coins without a mark pass whole.

    ``marks`` has one row per coin, ``batch`` one per coin and day, so the join
    is even at any size. Pass the marks as a written table: Spark then knows
    their size and broadcasts them when small.
    """
    known = marks.select("coin_id", F.col("high_water_mark").alias("_mark"))
    return (
        batch.join(known, "coin_id", "left")
        .where(F.col("_mark").isNull() | (F.col("date") > F.col("_mark")))
        .drop("_mark")
    )


def only_tracked(batch: DataFrame, tracked: Iterable[str] | DataFrame) -> DataFrame:
    """Rows of the tracked coins, given as a short list or as a frame.

    With a frame too large to broadcast, pass rows reduced to days.
    """
    if isinstance(tracked, DataFrame):
        ids = tracked.select("coin_id").where(F.col("coin_id").isNotNull()).distinct()
        return batch.join(ids, "coin_id", "left_semi")
    return batch.where(F.col("coin_id").isin(list(tracked)))


def calendar_gaps(rows: DataFrame) -> DataFrame:
    """Calendar days without a row between each coin's first and last day.

    Rows shrink to distinct days before the shuffle on the coin, and only the
    missing days are generated, never the whole calendar.
    """
    days = (
        rows.select(*FACT_KEY)
        .where(F.col("coin_id").isNotNull() & F.col("date").isNotNull())
        .distinct()
    )
    by_day = Window.partitionBy("coin_id").orderBy("date")
    following = days.withColumn("_next", F.lead("date").over(by_day))
    holes = following.where(F.datediff("_next", "date") > 1)
    missing = F.sequence(F.date_add("date", 1), F.date_sub("_next", 1))
    return holes.select("coin_id", F.explode(missing).alias("missing_date"))
