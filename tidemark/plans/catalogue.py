"""Tables and mart views in the catalogue, for sessions that have not built them.

The tables lie over a warehouse's folders. The views are SQL stacked on each
other and on the tables, so that any session, and any SQL client of the same
catalogue, reads the marts by name and sees what was loaded since.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from tidemark.operators.store import STORED, Warehouse

TABLES = ("dim_coin", "fact_price", "quarantine")
_PARTITIONS = {"fact_price": "month", "quarantine": "run_id"}
_BY_DAY = "PARTITION BY coin_id ORDER BY date"

# In the order in which they build on each other.
VIEWS = {
    "daily_return": f"""
      SELECT coin_id, date, price, try_divide(price - previous, previous) AS daily_return
      FROM (SELECT coin_id, date, price, lag(price) OVER ({_BY_DAY}) AS previous FROM {{0}}.fact_price)""",
    "moving_averages": f"""
      SELECT coin_id, date, price,
             avg(price) OVER ({_BY_DAY} ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS moving_avg_7d,
             avg(price) OVER ({_BY_DAY} ROWS BETWEEN 29 PRECEDING AND CURRENT ROW) AS moving_avg_30d
      FROM {{0}}.fact_price""",
    "rolling_volatility": f"""
      SELECT coin_id, date, price, daily_return,
             round(stddev_samp(daily_return) OVER ({_BY_DAY} ROWS BETWEEN 29 PRECEDING AND CURRENT ROW), 5) AS volatility_30d
      FROM {{0}}.daily_return""",
    "running_peak": f"""
      SELECT coin_id, date, price, max(price) OVER ({_BY_DAY} ROWS UNBOUNDED PRECEDING) AS running_peak
      FROM {{0}}.fact_price""",
    "max_drawdown": """
      SELECT coin_id, date, price, running_peak, try_divide(price - running_peak, running_peak) AS drawdown
      FROM {0}.running_peak""",
    "return_30d": f"""
      SELECT coin_id, date, price, price_30d_ago, try_divide(price, price_30d_ago) - 1 AS return_30d
      FROM (SELECT coin_id, date, price, lag(price, 30) OVER ({_BY_DAY}) AS price_30d_ago FROM {{0}}.fact_price)""",
    # As rolling_volatility has it; only a coin's last 30 rows, all that its newest day looks at, get a deviation.
    "latest_per_coin": f"""
      SELECT coin_id, date, price, daily_return, volatility_30d
      FROM (SELECT coin_id, date, price, daily_return, lead(true) OVER ({_BY_DAY}) IS NULL AS newest,
                   round(stddev_samp(daily_return) OVER ({_BY_DAY} ROWS BETWEEN 29 PRECEDING AND CURRENT ROW), 5) AS volatility_30d
            FROM (SELECT *, lead(true, 30) OVER ({_BY_DAY}) IS NULL AS late FROM {{0}}.daily_return)
            WHERE late)
      WHERE newest""",
    # Equal values are counted first, so the unpartitioned window has a row a distinct volatility.
    "volatility_ranking": """
      SELECT l.coin_id, l.date, l.price AS latest_price, l.daily_return AS latest_return, l.volatility_30d, r.volatility_rank
      FROM {0}.latest_per_coin l JOIN (
        SELECT volatility_30d, CAST(1 + coalesce(sum(n) OVER (
                 ORDER BY volatility_30d DESC NULLS FIRST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT)
               AS volatility_rank
        FROM (SELECT volatility_30d, count(*) AS n FROM {0}.latest_per_coin GROUP BY volatility_30d)) r
      ON l.volatility_30d <=> r.volatility_30d""",
}


def publish(warehouse: Warehouse, database: str) -> None:
    """Declare the warehouse's tables and the mart views in ``database``; doing it again brings in new folders."""
    spark = warehouse.spark
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    for table in TABLES:
        name, folder = f"{database}.{table}", _PARTITIONS.get(table)
        columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in STORED[table].fields)
        by = f"PARTITIONED BY ({folder})" if folder else ""
        spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet {by} LOCATION '{warehouse.path(table)}'")
        if folder and warehouse.exists(warehouse.path(table)):
            spark.catalog.recoverPartitions(name)
        spark.catalog.refreshTable(name)
    for name, query in VIEWS.items():
        spark.sql(f"CREATE OR REPLACE VIEW {database}.{name} AS {query.format(database)}")


def check(spark: SparkSession, database: str, required: tuple[str, ...]) -> None:
    """Raise if a required view is missing from the database."""
    missing = sorted(name for name in required if not spark.catalog.tableExists(f"{database}.{name}"))
    if missing:
        raise RuntimeError(f"mart views not in {database}: {', '.join(missing)}")
