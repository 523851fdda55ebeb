"""Bucketed facts, look-ups, marts kept up to date, and views of the catalogue."""

import datetime as dt
import random
import re

import pytest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from helpers import day, fact, plan, rows, scanned
from tidemark.operators import mart_store, marts
from tidemark.operators.store import BucketedWarehouse, Warehouse
from tidemark.plans import catalogue
from tidemark.schemas import MART_DAILY


def _load(warehouse, *given):
    return warehouse.upsert_fact(given[0] if isinstance(given[0], DataFrame) else fact(warehouse.spark, *given), [])


def _days(coin, first, n, price):
    start = day(first)
    return [(coin, str(start + dt.timedelta(days=i)), float(price + i)) for i in range(n)]


def test_marts_on_a_bucketed_fact_need_no_shuffle(spark, tmp_path):
    warehouse = BucketedWarehouse(spark, str(tmp_path / "w"), name="bucketed_one", buckets=3)
    assert warehouse.fact_price().count() == 0
    _load(warehouse, *_days("a", "2026-01-20", 20, 5), *_days("b", "2026-01-30", 3, 50))
    _load(warehouse, ("a", "2026-02-01", 9.0), ("c", "2026-02-02", 1.0))
    stored = warehouse.fact_price()
    for mart in (marts.daily_return, marts.rolling_volatility, marts.latest_per_coin, marts.max_drawdown):
        assert "Exchange" not in plan(mart(stored)) and "Bucketed: true" in plan(mart(stored))
    plain = Warehouse(spark, str(tmp_path / "plain"))
    _load(plain, *_days("a", "2026-01-20", 20, 5), *_days("b", "2026-01-30", 3, 50))
    _load(plain, ("a", "2026-02-01", 9.0), ("c", "2026-02-02", 1.0))
    assert "Exchange" in plan(marts.daily_return(plain.fact_price()))
    assert rows(stored) == rows(plain.fact_price())
    assert rows(marts.rolling_volatility(stored)) == rows(marts.rolling_volatility(plain.fact_price()))
    # Another catalogue finds the files again.
    again = BucketedWarehouse(spark, str(tmp_path / "w"), name="bucketed_two", buckets=3)
    assert rows(again.fact_price()) == rows(stored)
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "static"


def test_a_staged_load_is_finished_by_the_next_reader(spark, tmp_path, monkeypatch):
    warehouse = BucketedWarehouse(spark, str(tmp_path / "w"), name="bucketed_three", buckets=2)
    _load(warehouse, ("a", "2026-01-20", 1.0))
    with monkeypatch.context() as broken:
        broken.setattr(BucketedWarehouse, "_publish", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            _load(warehouse, ("a", "2026-01-20", 2.0), ("b", "2026-03-01", 3.0))
    assert rows(warehouse.fact_price(), "coin_id", "price") == [("a", 2.0), ("b", 3.0)]


def test_a_look_up_reads_few_row_groups(spark, tmp_path):
    options = (("parquet.block.size", str(16 << 10)), ("parquet.page.size", "1024"), ("parquet.page.row.count.limit", "200"))
    warehouse = Warehouse(spark, str(tmp_path / "w"), options)
    ids = spark.range(40_000).select(F.format_string("c%05d", F.col("id") * 2).alias("coin_id"), F.lit(day("2026-01-01")).alias("date"))
    _load(warehouse, ids.select("*", *[F.rand(1).alias(m) for m in ("price", "market_cap", "volume")]))
    stored = warehouse.fact_price()
    one, none = (stored.where(F.col("coin_id") == c) for c in ("c00100", "c00101"))
    assert scanned(one)["numOutputRows"] < 8_000 and one.count() == 1
    # Between two stored ids: only the filter can tell.
    assert scanned(none)["numOutputRows"] == 0
    assert marts.coin_history(stored, "c00100").count() == 1


def _all(warehouse):
    fresh = mart_store.marts_of(warehouse.fact_price())
    columns = [c for c in MART_DAILY.names if c != "month"]

    def near(frame):
        doubles = [F.round(c, 9).alias(c) if c not in ("coin_id", "date") else F.col(c) for c in columns]
        return rows(frame.select(*doubles))

    return near(mart_store.stored_marts(warehouse)), near(fresh)


def test_marts_after_each_load_equal_a_full_recompute(spark, tmp_path):
    rng = random.Random(8)
    warehouse = Warehouse(spark, str(tmp_path / "w"))
    start = day("2025-01-01")

    def some(coins, low, high, n):
        days = {(c, str(start + dt.timedelta(days=rng.randint(low, high)))) for c in coins for _ in range(n)}
        return [(c, d, rng.choice([None, 0.0, *map(float, range(1, 90))])) for c, d in sorted(days)]

    loads = [
        some("ab", 0, 200, 90),  # gaps: 30 rows span several months
        some("a", 201, 204, 3) + some("c", 0, 3, 2),  # new days, a new coin
        some("b", 60, 70, 4),  # restated in the middle
        [("a", str(start - dt.timedelta(days=40)), 500.0)],  # before all others: a new peak for all later days
    ]
    for load in loads:
        changed = _load(warehouse, *load)
        mart_store.refresh(warehouse, changed)
    found, want = _all(warehouse)
    assert found == want and len(found) > 100
    mart_store.refresh(warehouse, changed)
    assert _all(warehouse)[0] == want


def test_a_refresh_reads_only_the_months_it_needs(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path / "w"))
    mart_store.refresh(warehouse, _load(warehouse, *_days("a", "2024-01-01", 500, 5), ("b", "2024-01-05", 1.0)))
    changed = _load(warehouse, *_days("a", "2025-05-15", 2, 7))
    mart_store.refresh(warehouse, changed)
    needed = mart_store._needed(mart_store.stored_months(warehouse), changed)
    assert [(r.month, r.before) for r in needed.orderBy("month").collect()] == [("2025-04", 460.0), ("2025-05", 460.0)]
    needed = mart_store.materialise(needed, "needed")
    read = mart_store.context(warehouse, needed)
    assert "dynamicpruning" in plan(read) and scanned(read)["numPartitions"] == 2
    found, want = _all(warehouse)
    assert found == want


def test_the_windows_of_a_refresh_need_no_shuffle_beside_that_on_the_coin(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path / "w"))
    changed = _load(warehouse, *_days("a", "2024-01-01", 100, 5), ("b", "2024-01-05", 1.0))
    mart_store.refresh(warehouse, changed)
    needed = mart_store.materialise(mart_store._needed(mart_store.stored_months(warehouse), changed), "needed")
    threshold = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(threshold)
    spark.conf.set(threshold, -1)
    try:
        shown = plan(mart_store.marts_of(mart_store.context(warehouse, needed), "before"))
    finally:
        spark.conf.set(threshold, before)
    dealt = re.findall(r"hashpartitioning\(([^)]*)\)", shown)
    assert dealt and not any("coin_id" in keys and "month" in keys for keys in dealt)


def test_another_session_reads_the_marts_by_name(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path / "w"))
    with pytest.raises(RuntimeError, match="mart views not in marts_one: daily_return"):
        catalogue.check(spark, "marts_one", ("daily_return",))
    _load(warehouse, *_days("a", "2026-01-20", 40, 5), *_days("b", "2026-01-30", 3, 50), ("c", "2026-01-01", 2.0))
    catalogue.publish(warehouse, "marts_one")
    other = spark.newSession()
    catalogue.check(other, "marts_one", tuple(catalogue.VIEWS))
    _load(warehouse, ("d", "2026-04-01", 9.0))
    catalogue.publish(warehouse, "marts_one")
    stored = warehouse.fact_price()
    for name in ("daily_return", "moving_averages", "rolling_volatility", "max_drawdown", "return_30d", "latest_per_coin"):
        want = getattr(marts, name)(stored)
        assert rows(other.table(f"marts_one.{name}"), *want.columns) == rows(want), name
    ranked = marts.volatility_ranking(stored)
    assert rows(other.table("marts_one.volatility_ranking"), *ranked.columns) == rows(ranked)
    assert other.table("marts_one.dim_coin").count() == 0
    assert re.search("fact_price", other.sql("SHOW TABLES IN marts_one")._show_string(50, False, False))


def test_only_the_last_rows_of_a_coin_get_a_deviation_for_its_newest_day(spark, tmp_path):
    """The frames of the newest day reach 30 rows back, its oldest return one price further."""
    chance = random.Random(7)
    given = [
        (f"c{n}", str(day("2026-01-01") + dt.timedelta(days=i)), chance.choice([None, 0.0, *(chance.uniform(1, 9) for _ in range(18))]))
        for n in (1, 2, 29, 30, 31, 32, 75)
        for i in range(n)
    ]
    warehouse = Warehouse(spark, str(tmp_path / "w"))
    _load(warehouse, *given)
    catalogue.publish(warehouse, "marts_late")
    stored = warehouse.fact_price()
    last = stored.groupBy("coin_id").agg(F.max("date").alias("date"))
    want = rows(marts.rolling_volatility(stored).join(last, ["coin_id", "date"]), "coin_id", "date", "price", "daily_return", "volatility_30d")
    assert len(want) == 7
    for latest in (marts.latest_per_coin(stored), spark.table("marts_late.latest_per_coin")):
        assert rows(latest, "coin_id", "date", "price", "daily_return", "volatility_30d") == want
        below = latest._jdf.queryExecution().optimizedPlan().toString().rsplit("stddev_samp", 1)[1]
        assert "Filter" in below
