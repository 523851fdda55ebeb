"""Analytical marts over the daily fact.

Input is the stored fact: one row per (coin, day). A coin's rows are thus
bounded by the calendar, not by the tick volume, so one window per coin is
safe however unevenly raw ticks are spread. Every mart needs one shuffle on
``coin_id``; filter by coin before (Spark pushes it to the scan), filter by
date after (a window must see the preceding days).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tidemark.functions.expressions import ratio_change, relative_change
from tidemark.scale import join_keyed, materialise, running, sliced, trailing


def _by_day():
    return Window.partitionBy("coin_id").orderBy("date")


def _trailing(rows: int):
    """The current row and up to ``rows - 1`` before it."""
    return _by_day().rowsBetween(1 - rows, Window.currentRow)


def _daily(fact: DataFrame) -> DataFrame:
    return fact.select("coin_id", "date", "price")


def daily_return(fact: DataFrame) -> DataFrame:
    """Change against the previous stored day, ``(p - prev) / prev``."""
    previous = _daily(fact).withColumn("_previous", F.lag("price").over(_by_day()))
    change = relative_change(F.col("price"), F.col("_previous"))
    return previous.select("coin_id", "date", "price", change.alias("daily_return"))


def percent_change(prices: DataFrame, ordered: bool = False) -> DataFrame:
    """All input columns plus ``return`` = ``p / prev - 1``; dates may be strings."""
    dated = prices.withColumn("date", F.col("date").cast("date"))
    previous = dated.withColumn("_previous", F.lag("price").over(_by_day()))
    result = previous.withColumn("return", ratio_change(F.col("price"), F.col("_previous")))
    return _maybe_ordered(result.drop("_previous"), ordered)


def moving_averages(fact: DataFrame) -> DataFrame:
    """7- and 30-row averages; the first rows average what there is."""
    return _daily(fact).select(
        "*",
        F.avg("price").over(_trailing(7)).alias("moving_avg_7d"),
        F.avg("price").over(_trailing(30)).alias("moving_avg_30d"),
    )


def moving_average(prices: DataFrame, window: int = 7, ordered: bool = False) -> DataFrame:
    """All input columns plus ``moving_average``, null until ``window`` prices are there."""
    if window <= 0:
        raise ValueError(f"a moving average needs a positive window, not {window}")
    frame = _trailing(window)
    full = F.count("price").over(frame) == window
    dated = prices.withColumn("date", F.col("date").cast("date"))
    result = dated.withColumn("moving_average", F.when(full, F.avg("price").over(frame)))
    return _maybe_ordered(result, ordered)


def rolling_volatility(fact: DataFrame) -> DataFrame:
    """Sample deviation of the last 30 daily returns, rounded to 5 places."""
    return daily_return(fact).withColumn("volatility_30d", _volatility())


def _volatility() -> Column:
    return F.round(F.stddev_samp("daily_return").over(_trailing(30)), 5)


def running_peak(fact: DataFrame) -> DataFrame:
    """Highest price so far."""
    so_far = _by_day().rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return _daily(fact).withColumn("running_peak", F.max("price").over(so_far))


def max_drawdown(fact: DataFrame) -> DataFrame:
    """Distance of each day's price from the running peak, as a share of it."""
    fall = relative_change(F.col("price"), F.col("running_peak"))
    return running_peak(fact).withColumn("drawdown", fall)


def worst_drawdown(fact: DataFrame) -> DataFrame:
    """Deepest drawdown per coin and the first day it was reached."""
    depth = F.min(F.struct("drawdown", "date"))
    return (
        max_drawdown(fact)
        .where(F.col("drawdown").isNotNull())
        .groupBy("coin_id")
        .agg(depth.alias("_worst"))
        .select("coin_id", F.col("_worst.drawdown").alias("worst_drawdown"), F.col("_worst.date").alias("worst_date"))
    )


def return_30d(fact: DataFrame) -> DataFrame:
    """Change against the price 30 rows earlier."""
    earlier = _daily(fact).withColumn("price_30d_ago", F.lag("price", 30).over(_by_day()))
    change = ratio_change(F.col("price"), F.col("price_30d_ago"))
    return earlier.withColumn("return_30d", change)


def best_return_30d(fact: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` highest 30-row returns; each partition keeps only its own top ``k``."""
    return _top(fact, F.col("return_30d").desc(), k)


def worst_return_30d(fact: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` lowest 30-row returns."""
    return _top(fact, F.col("return_30d").asc(), k)


def _top(fact: DataFrame, order: Column, k: int) -> DataFrame:
    changes = return_30d(fact).where(F.col("return_30d").isNotNull())
    return changes.orderBy(order, "coin_id", "date").limit(k)


def latest_per_coin(fact: DataFrame) -> DataFrame:
    """Each coin's newest row of ``rolling_volatility``.

    The newest row is the one no other row follows, read off in the same
    window order as the returns, so there is no second sort. Only the last 30
    rows, all that its deviation looks at, go through that window.
    """

    def none_after(rows: int) -> Column:
        return F.lead(F.lit(True), rows).over(_by_day()).isNull()

    late = daily_return(fact).withColumn("_late", none_after(30)).where("_late").drop("_late")
    flagged = late.withColumns({"volatility_30d": _volatility(), "_newest": none_after(1)})
    return flagged.where("_newest").drop("_newest")


def volatility_ranking(fact: DataFrame, nulls: str = "first") -> DataFrame:
    """Coins ranked by their latest volatility, highest first, ties sharing a rank.

    Coins without volatility rank first by default, then those whose
    volatility is not a number. The one-row-per-coin frame is written once, so
    the windows run once however the ranking is used.
    """
    if nulls not in ("first", "last"):
        raise ValueError("nulls must be 'first' or 'last'")
    latest = latest_per_coin(fact).select(
        "coin_id",
        "date",
        F.col("price").alias("latest_price"),
        F.col("daily_return").alias("latest_return"),
        "volatility_30d",
    )
    latest = materialise(latest, "latest")
    volatility = F.col("volatility_30d")
    by = volatility.desc_nulls_first() if nulls == "first" else volatility.desc_nulls_last()
    ranks = _ranks(latest, "volatility_30d", by).withColumnRenamed("rank", "volatility_rank")
    ranked = join_keyed(latest, ranks, ["volatility_30d"])
    # The coin breaks ties, so that many coins of one rank still sort in parallel.
    return ranked.orderBy(by, "coin_id")


def _ranks(rows: DataFrame, value: str, by: Column) -> DataFrame:
    """Rank of every distinct ``value`` in the order ``by``.

    Equal values collapse to one counted row first. Distinct values are cut
    into slices of that order; a value's rank is the number of rows in earlier
    slices plus those before it in its own. Only one total a slice meets in
    one task.
    """
    values = rows.groupBy(value).agg(F.count(F.lit(1)).alias("n"))
    parts = sliced(values, [by])
    earlier = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    totals = parts.groupBy("_slice").agg(F.sum("n").alias("_rows"))
    offsets = totals.select("_slice", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_offset"))
    before = Window.partitionBy("_slice").orderBy(by).rowsBetween(Window.unboundedPreceding, -1)
    local = F.coalesce(F.sum("n").over(before), F.lit(0))
    placed = parts.withColumn("_before", local).join(F.broadcast(offsets), "_slice")
    return placed.select(value, (F.lit(1) + F.col("_offset") + F.col("_before")).alias("rank"))


def drawdown_ticks(ticks: DataFrame, order: Sequence[str]) -> DataFrame:
    """``running_peak`` and ``drawdown`` of every tick, for coins with any number of ticks."""
    peaks = running(ticks, "coin_id", order, "price", "running_peak", "max")
    return peaks.withColumn("drawdown", relative_change(F.col("price"), F.col("running_peak")))


def trailing_ticks(ticks: DataFrame, order: Sequence[str]) -> DataFrame:
    """Averages, return, volatility and 30-row return of every tick, for coins with any number of ticks.

    Columns are those of the daily marts, over ticks instead of days.
    """

    def first(by: WindowSpec) -> dict[str, Column]:
        return {
            "_previous": F.lag("price").over(by),
            "moving_avg_7d": F.avg("price").over(by.rowsBetween(-6, 0)),
            "moving_avg_30d": F.avg("price").over(by.rowsBetween(-29, 0)),
            "price_30d_ago": F.lag("price", 30).over(by),
        }

    def then(by: WindowSpec) -> dict[str, Column]:
        return {
            "daily_return": relative_change(F.col("price"), F.col("_previous")),
            "return_30d": ratio_change(F.col("price"), F.col("price_30d_ago")),
        }

    def last(by: WindowSpec) -> dict[str, Column]:
        return {"volatility_30d": F.round(F.stddev_samp("daily_return").over(by.rowsBetween(-29, 0)), 5)}

    # The oldest return of a frame looks one price further back.
    return trailing(ticks, "coin_id", order, 31, [first, then, last]).drop("_previous")


def coverage(fact: DataFrame) -> DataFrame:
    """First day, last day and row count per coin, by coin."""
    return (
        fact.groupBy("coin_id")
        .agg(
            F.min("date").alias("min_date"),
            F.max("date").alias("max_date"),
            F.count(F.lit(1)).alias("row_count"),
        )
        .orderBy("coin_id")
    )


def coin_history(fact: DataFrame, coin_id: str) -> DataFrame:
    """One coin's rows, newest first; the filter reaches the scan."""
    return fact.where(F.col("coin_id") == coin_id).orderBy(F.col("date").desc())


def _maybe_ordered(df: DataFrame, ordered: bool) -> DataFrame:
    return df.orderBy("coin_id", "date") if ordered else df
