"""Mart views by name, and the check that the required ones exist."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.operators import marts

MARTS = {
    "daily_return": marts.daily_return,
    "moving_averages": marts.moving_averages,
    "rolling_volatility": marts.rolling_volatility,
    "max_drawdown": marts.max_drawdown,
    "volatility_ranking": marts.volatility_ranking,
    "return_30d": marts.return_30d,
}

# The views a run insists on.
REQUIRED = (
    "daily_return",
    "moving_averages",
    "rolling_volatility",
    "max_drawdown",
    "volatility_ranking",
)


def register(fact: DataFrame, dim: DataFrame, quarantine: DataFrame, ranking: DataFrame | None = None) -> None:
    """Make tables and marts available to ``spark.sql`` by name.

    Marts run when they are read; only the ranking runs now, once, unless a
    stored one is given.
    """
    tables = {"fact_price": fact, "dim_coin": dim, "quarantine": quarantine}
    for name, table in tables.items():
        table.createOrReplaceTempView(name)
    for name, mart in MARTS.items():
        stored = ranking if name == "volatility_ranking" else None
        (mart(fact) if stored is None else stored).createOrReplaceTempView(name)


def check(spark: SparkSession) -> None:
    """Raise if a required mart view is missing."""
    missing = sorted(name for name in REQUIRED if not spark.catalog.tableExists(name))
    if missing:
        raise RuntimeError(f"mart views not registered: {', '.join(missing)}")
