"""Stored marts, kept up to date from the rows that a load has changed.

``mart_daily`` holds all marts of a coin and day, ``mart_months`` the number of
rows and the highest price of a coin in each stored month. After a load only
the changed coins are computed again, from their first changed day on: from the
months table follows which earlier months hold the 30 rows that the frames
need, and the peak of all months before them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.expressions import ratio_change, relative_change
from tidemark.operators.store import Warehouse
from tidemark.scale import materialise
from tidemark.schemas import MART_DAILY, MART_MONTHS

# A return over 30 rows, and 30 returns, look 30 rows back.
CONTEXT = 30


def marts_of(rows: DataFrame, peak: str | None = None) -> DataFrame:
    """All marts of every row; ``peak`` names a column with the highest price before a coin's first row.

    One row a coin and day, so a window is bounded by the calendar.
    """
    by = Window.partitionBy("coin_id").orderBy("date")
    so_far = F.max("price").over(by.rowsBetween(Window.unboundedPreceding, 0))
    moved = rows.withColumns(
        {
            "_previous": F.lag("price").over(by),
            "price_30d_ago": F.lag("price", CONTEXT).over(by),
            "moving_avg_7d": F.avg("price").over(by.rowsBetween(-6, 0)),
            "moving_avg_30d": F.avg("price").over(by.rowsBetween(1 - CONTEXT, 0)),
            "running_peak": so_far if peak is None else F.greatest(so_far, F.col(peak)),
        }
    )
    moved = moved.withColumns(
        {
            "daily_return": relative_change(F.col("price"), F.col("_previous")),
            "return_30d": ratio_change(F.col("price"), F.col("price_30d_ago")),
            "drawdown": relative_change(F.col("price"), F.col("running_peak")),
        }
    )
    deviation = F.stddev_samp("daily_return").over(by.rowsBetween(1 - CONTEXT, 0))
    return moved.withColumn("volatility_30d", F.round(deviation, 5)).drop("_previous")


def _needed(months: DataFrame, changed: DataFrame) -> DataFrame:
    """(coin_id, month, first_day, before) of the stored months that the changed coins need.

    These are all from the first changed day's month on, and as many before as
    hold 30 rows; ``before`` is the highest price of the months left out.
    """
    first = changed.groupBy("coin_id").agg(F.min("date").alias("first_day"))
    known = months.join(first, "coin_id")
    early = F.col("month") < F.date_format("first_day", "yyyy-MM")
    by = Window.partitionBy("coin_id").orderBy(F.col("month").desc())
    later = F.sum(F.when(early, F.col("row_count")).otherwise(0)).over(by.rowsBetween(Window.unboundedPreceding, -1))
    known = known.withColumn("_left_out", early & (F.coalesce(later, F.lit(0)) >= CONTEXT))
    before = F.max(F.when(F.col("_left_out"), F.col("peak"))).over(Window.partitionBy("coin_id"))
    known = known.withColumn("before", before).where(~F.col("_left_out"))
    return known.select("coin_id", "month", "first_day", "before")


def _coins(needed: DataFrame) -> DataFrame:
    """(coin_id, first_month, first_day, before): a coin needs all its stored months from the first one on."""
    first = [F.min("month").alias("first_month"), F.min("first_day").alias("first_day"), F.max("before").alias("before")]
    return needed.groupBy("coin_id").agg(*first)


def context(warehouse: Warehouse, needed: DataFrame) -> DataFrame:
    """The stored rows of the needed coins and months; ``needed`` is a written frame.

    They are joined by coin alone, so the windows of the marts find them in place.
    """
    rows = warehouse.in_months("fact_price", needed).join(_coins(needed), "coin_id")
    return rows.where(F.col("month") >= F.col("first_month")).drop("first_month")


def refresh(warehouse: Warehouse, changed: DataFrame) -> None:
    """Bring the stored marts up to date with a load that changed the rows ``changed`` (coin_id, date, month).

    Repeating it with the same rows changes nothing, so a load that was
    interrupted is repeated as a whole.
    """
    if changed.isEmpty():
        return
    touched = warehouse.in_months("fact_price", changed)
    months = touched.groupBy("coin_id", "month").agg(F.count(F.lit(1)).alias("row_count"), F.max("price").alias("peak"))
    warehouse._replace("mart_months", months.select(*MART_MONTHS.names))
    needed = materialise(_needed(stored_months(warehouse), changed), "needed")
    computed = marts_of(context(warehouse, needed), "before").where(F.col("date") >= F.col("first_day"))
    # All rows of a changed coin from its first changed day on are computed; the others of their months stay.
    stored = warehouse.in_months("mart_daily", needed.where(F.col("month") >= F.date_format("first_day", "yyyy-MM")))
    known = stored.join(_coins(needed).select("coin_id", "first_day"), "coin_id", "left")
    kept = known.where(F.col("first_day").isNull() | (F.col("date") < F.col("first_day")))
    names = MART_DAILY.names
    warehouse._replace("mart_daily", kept.select(*names).unionByName(computed.select(*names)))


def stored_months(warehouse: Warehouse) -> DataFrame:
    warehouse._finish("mart_months")
    return warehouse.read("mart_months")


def stored_marts(warehouse: Warehouse) -> DataFrame:
    """All marts of every stored coin and day."""
    warehouse._finish("mart_daily")
    return warehouse.read("mart_daily").drop("month")
