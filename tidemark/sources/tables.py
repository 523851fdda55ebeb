"""Adapters that read the given star-schema tables as coins, days and prices."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.expressions import MILLIS_PER_DAY
from tidemark.operators.series import daily_last

# Together these order the ticks of a supplier and day without ties.
TICK_ORDER = ["l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", "l_quantity"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def supplier_ticks(spark: SparkSession, sf_dir: str, only: int | None = None) -> DataFrame:
    """Every line item as a price tick of its supplier, with the tick order columns."""
    lines = table(spark, sf_dir, "lineitem")
    if only is not None:
        lines = lines.where(F.col("l_suppkey") == only)
    return lines.select(
        F.col("l_suppkey").cast("string").alias("coin_id"),
        F.col("l_shipdate").cast("date").alias("date"),
        F.col("l_extendedprice").alias("price"),
        (F.col("l_extendedprice") * F.col("l_quantity")).alias("market_cap"),
        F.col("l_quantity").alias("volume"),
        *TICK_ORDER,
        "l_returnflag",
        "l_linestatus",
    )


def plain(ticks: DataFrame) -> DataFrame:
    """Ticks with the columns the historical schema knows, plus their order."""
    return ticks.drop("l_returnflag", "l_linestatus")


def corrupted_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All supplier ticks, some with a bad price or market cap; none is left out."""

    def every(n: int) -> Column:
        return F.col("l_orderkey") % n == 0

    price = (
        F.when(every(97), -F.col("price")).when(~every(101), F.col("price")).alias("price")
    )
    cap = F.when(every(103), F.lit(-1.0)).when(~every(107), F.col("market_cap")).alias("market_cap")
    ticks = plain(supplier_ticks(spark, sf_dir))
    return ticks.select("coin_id", "date", price, cap, "volume", *TICK_ORDER)


def supplier_daily(spark: SparkSession, sf_dir: str, only: int | None = None) -> DataFrame:
    """Daily prices per supplier, or of ``only`` one: the fact the marts read."""
    ticks = supplier_ticks(spark, sf_dir, only)
    return daily_last(ticks, TICK_ORDER)


def supplier_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").cast("string").alias("coin_id"),
        F.concat(F.lit("s"), F.col("s_suppkey").cast("string")).alias("symbol"),
        F.col("s_name").alias("name"),
    )


def customer_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("coin_id"),
        F.col("c_mktsegment").alias("symbol"),
        F.col("c_name").alias("name"),
    )


def user_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as a price tick of its user."""
    return table(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").alias("coin_id"),
        F.col("ts").cast("date").alias("date"),
        F.col("ts").alias("timestamp"),
        F.col("value").alias("price"),
        "event_type",
    )


def user_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daily_last(user_ticks(spark, sf_dir), ["timestamp"], keep=["price"])


def epoch_millis(ts: Column) -> Column:
    """Milliseconds since 1970 of a timestamp without time zone."""
    day = F.unix_date(ts.cast("date")).cast("long") * MILLIS_PER_DAY
    seconds = F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts)
    # No time zone is off by parts of a second. Numbers, not decimals, for every event.
    millis = F.pmod(F.unix_millis(ts.cast("timestamp")), F.lit(1000))
    return day + seconds * 1000 + millis


def snapshot_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line item as one market snapshot object, updated on its ship date."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").cast("string").alias("id"),
        F.lower("l_returnflag").alias("symbol"),
        F.concat(F.lit("Part "), F.col("l_partkey").cast("string")).alias("name"),
        F.col("l_extendedprice").alias("current_price"),
        (F.col("l_extendedprice") * F.col("l_quantity")).alias("market_cap"),
        F.col("l_quantity").alias("total_volume"),
        F.concat(F.col("l_shipdate").cast("date").cast("string"), F.lit("T00:00:00.000Z")).alias(
            "last_updated"
        ),
    )


def customer_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every customer as one market snapshot object, the balance as its price."""
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("id"),
        F.col("c_mktsegment").alias("symbol"),
        F.col("c_name").alias("name"),
        (F.col("c_acctbal") + 1000).alias("current_price"),
        F.lit("2024-02-01T00:00:00.000Z").alias("last_updated"),
    )


def history_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as one history payload; only purchases carry a market cap."""
    events = table(spark, sf_dir, "events")
    at = epoch_millis(F.col("ts")).cast("double")
    count = F.get_json_object("props", "$.k").cast("double")

    def point(value: Column) -> Column:
        return F.array(F.array(at, value))

    nothing = F.array().cast("array<array<double>>")
    return events.select(
        F.col("user_id").cast("string").alias("coin_id"),
        point(F.col("value")).alias("prices"),
        F.when(F.col("event_type") == "purchase", point(F.col("value") * count))
        .otherwise(nothing)
        .alias("market_caps"),
        point(count).alias("total_volumes"),
    )
