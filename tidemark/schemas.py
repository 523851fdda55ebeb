"""Declared schemas: payloads, stored tables and validation input.

Payload numbers mix JSON integers and floats, so nothing is ever inferred.
"""

from __future__ import annotations

from pyspark.sql import types as T

_STRING, _DOUBLE, _INT = T.StringType(), T.DoubleType(), T.IntegerType()


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, dtype) for name, dtype in fields])


# The 26 fields of one market snapshot object.
SNAPSHOT = _struct(
    ("id", _STRING),
    ("symbol", _STRING),
    ("name", _STRING),
    ("image", _STRING),
    ("current_price", _DOUBLE),
    ("market_cap", _DOUBLE),
    ("market_cap_rank", _INT),
    ("fully_diluted_valuation", _DOUBLE),
    ("total_volume", _DOUBLE),
    ("high_24h", _DOUBLE),
    ("low_24h", _DOUBLE),
    ("price_change_24h", _DOUBLE),
    ("price_change_percentage_24h", _DOUBLE),
    ("market_cap_change_24h", _DOUBLE),
    ("market_cap_change_percentage_24h", _DOUBLE),
    ("circulating_supply", _DOUBLE),
    ("total_supply", _DOUBLE),
    ("max_supply", _DOUBLE),
    ("ath", _DOUBLE),
    ("ath_change_percentage", _DOUBLE),
    ("ath_date", _STRING),
    ("atl", _DOUBLE),
    ("atl_change_percentage", _DOUBLE),
    ("atl_date", _STRING),
    ("roi", _struct(("times", _DOUBLE), ("currency", _STRING), ("percentage", _DOUBLE))),
    ("last_updated", _STRING),
)

_POINTS = T.ArrayType(T.ArrayType(_DOUBLE))

# The three parallel series of one history payload.
HISTORY = _struct(("prices", _POINTS), ("market_caps", _POINTS), ("total_volumes", _POINTS))

MEASURES = ("price", "market_cap", "volume")
FACT_KEY = ("coin_id", "date")
DIM_KEY = ("coin_id",)

DIM = T.StructType(
    [
        T.StructField("coin_id", _STRING, nullable=False),
        T.StructField("symbol", _STRING),
        T.StructField("name", _STRING),
    ]
)

# The longest texts that the stored tables take.
DIM_LENGTHS = {"coin_id": 50, "symbol": 50, "name": 100}

FACT = T.StructType(
    [
        T.StructField("coin_id", _STRING, nullable=False),
        T.StructField("date", T.DateType(), nullable=False),
        *[T.StructField(m, _DOUBLE) for m in MEASURES],
    ]
)

QUARANTINE = _struct(
    ("coin_id", _STRING),
    ("date", T.DateType()),
    *[(m, _DOUBLE) for m in MEASURES],
    ("reason", _STRING),
    ("rejected", _STRING),
    ("quarantined_at", T.TimestampType()),
    ("run_id", _STRING),
)

GAPS = _struct(("coin_id", _STRING), ("missing_date", T.DateType()))
MARKS = _struct(("coin_id", _STRING), ("high_water_mark", T.DateType()))

# The marts of a coin and day, and what is known of a coin's stored months.
MART_DAILY = _struct(
    ("coin_id", _STRING),
    ("date", T.DateType()),
    *[
        (name, _DOUBLE)
        for name in (
            "price",
            "daily_return",
            "moving_avg_7d",
            "moving_avg_30d",
            "volatility_30d",
            "running_peak",
            "drawdown",
            "price_30d_ago",
            "return_30d",
        )
    ],
    ("month", _STRING),
)
MART_MONTHS = _struct(("coin_id", _STRING), ("row_count", T.LongType()), ("peak", _DOUBLE), ("month", _STRING))
