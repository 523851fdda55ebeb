import math

import pytest
from pyspark.sql import functions as F

from helpers import day, fact, plan, prices, rows
from tidemark.operators import quality

CURRENT = "coin_id string, price double, symbol string, date date, volume double, market_cap double, name string"


def _good(spark):
    return fact(
        spark,
        ("a", "2026-01-01", 10.0, 1.0, 1.0),
        ("a", "2026-01-02", 14.0, None, None),
        ("a", "2026-01-04", 30.0, 0.0, 0.0),
        ("b", "2026-01-01", 5.0, 1.0, 1.0),
    )


def _bad(spark):
    return fact(
        spark,
        ("a", "2026-01-03", -50.0, 1.0, 1.0),
        ("a", "2026-01-03", None, -1.0, 1.0),
        (None, "2026-01-03", 1.0, 1.0, -2.0),
        ("b", None, math.nan, 1.0, 1.0),
    )


def test_negative_price_of_a_snapshot_is_rejected(spark):
    bad = spark.createDataFrame(
        [("bitcoin", -50.0, "btc", day("2026-09-01"), 200000.0, 100000.0, "Bitcoin")], CURRENT
    )
    assert rows(quality.failure_cases(bad, "current")) == [
        ("bitcoin", "2026-09-01", "price", "greater_than(0)", "-50.0")
    ]
    parts = quality.validate(bad, "current")
    assert parts.valid.isEmpty()
    assert rows(parts.quarantined, "reason") == [("Schema validation failed: greater_than(0)",)]


def test_every_check_is_reported_in_schema_order(spark):
    checked = quality.schema_check(_bad(spark), "historical")
    got = [
        [(f["column"], f["check"]) for f in r.failures]
        for r in checked.orderBy(F.col("coin_id").asc_nulls_last(), F.col("price").desc()).collect()
    ]
    assert got == [
        [("price", "greater_than(0)")],
        [("price", "not_nullable"), ("market_cap", "greater_than_or_equal_to(0)")],
        [("price", "not_nullable"), ("date", "not_nullable")],
        [("coin_id", "not_nullable"), ("volume", "greater_than_or_equal_to(0)")],
    ]


def test_values_are_coerced_and_unreadable_ones_fail(spark):
    text = spark.createDataFrame(
        [("a", "10.5", "2026-01-01", "1", None), ("a", "ten", "2026-01-02", "1", "2"), ("a", "11", "soon", "1", "2")],
        "coin_id string, price string, date string, volume string, market_cap string",
    )
    parts = quality.validate(text, "historical")
    assert rows(parts.valid, "coin_id", "price", "date", "volume", "market_cap") == [
        ("a", 10.5, day("2026-01-01"), 1.0, None)
    ]
    assert rows(parts.quarantined, "price", "reason") == [
        (11.0, "Schema validation failed: coerce_dtype('date')"),
        (None, "Schema validation failed: coerce_dtype('double')"),
    ]
    assert rows(parts.quarantined, "rejected") == [("soon",), ("ten",)]
    cases = quality.failure_cases(text, "historical")
    assert rows(cases, "column", "value") == [("date", "soon"), ("price", "ten")]


def test_missing_extra_columns_and_unknown_types_raise(spark):
    with pytest.raises(ValueError, match="market_cap"):
        quality.validate(_good(spark).drop("market_cap"), "historical")
    with pytest.raises(ValueError, match="not in schema: \\['seen'\\]"):
        quality.validate(_good(spark).withColumn("seen", F.lit(1)), "historical")
    quality.validate(_good(spark).withColumn("seen", F.lit(1)), "historical", order=["seen"])
    with pytest.raises(ValueError, match="data_type"):
        quality.validate(_good(spark), "weekly")


def test_duplicates_keep_all_copies_and_match_nulls(spark):
    frame = fact(
        spark,
        ("a", "2026-01-01", 1.0),
        ("a", "2026-01-01", 2.0),
        ("a", "2026-01-02", 3.0),
        (None, None, 4.0),
        (None, None, 5.0),
        ("b", None, 6.0),
    )
    found = quality.duplicates(frame)
    assert rows(found, "price") == [(1.0,), (2.0,), (4.0,), (5.0,)]
    assert found.columns == frame.columns


def test_jump_is_strict_and_first_rows_pass(spark):
    frame = prices(
        spark,
        ("a", "2026-01-01", 100),
        ("a", "2026-01-05", 150),
        ("a", "2026-01-06", 226),
        ("b", "2026-01-01", 100),
        ("b", "2026-01-02", 49),
    )
    found = quality.anomalies(frame)
    assert rows(found, "coin_id", "price", "reason") == [
        ("a", 226.0, "Day-over-day price change > 50%"),
        ("b", 49.0, "Day-over-day price change > 50%"),
    ]
    assert rows(quality.anomalies(frame, bounded=True)) == rows(found)


def test_stored_history_supplies_the_row_before_the_batch(spark):
    batch = prices(spark, ("a", "2026-01-05", 100), ("b", "2026-01-05", 100))
    history = prices(spark, ("a", "2026-01-01", 100), ("a", "2026-01-03", 10), ("a", "2026-01-09", 100))
    assert rows(quality.anomalies(batch, history=history), "coin_id") == [("a",)]


def test_split_accounts_for_every_row(spark):
    batch = _good(spark).unionByName(_bad(spark))
    parts = quality.validate(batch, "historical")
    assert rows(parts.valid, "coin_id", "price") == [("a", 10.0), ("a", 14.0), ("b", 5.0)]
    assert rows(parts.quarantined, "price", "reason") == sorted(
        [
            (30.0, "Day-over-day price change > 50%"),
            (-50.0, "Schema validation failed: greater_than(0)"),
            (None, "Schema validation failed: not_nullable"),
            (None, "Schema validation failed: not_nullable"),
            (1.0, "Schema validation failed: not_nullable"),
        ],
        key=repr,
    )
    # Gaps look at surviving rows, jumps included.
    assert rows(parts.gaps) == [("a", day("2026-01-03"))]
    report = quality.report(parts.flagged, parts.gaps, quality.repeated_keys(parts.survivors))
    assert report.collect()[0].asDict() == {
        "rows_received": 8,
        "rows_passed": 3,
        "rows_quarantined": 5,
        "gaps_found": 1,
        "duplicates_found": 0,
    }


def test_batch_reason_is_the_first_check_of_the_schema(spark):
    parts = quality.validate(_bad(spark), "historical", reason_mode="batch")
    assert {r.reason for r in parts.quarantined.collect()} == {"Schema validation failed: not_nullable"}
    only_price = _bad(spark).where("price < 0")
    parts = quality.validate(only_price, "historical", reason_mode="batch")
    assert rows(parts.quarantined, "reason") == [("Schema validation failed: greater_than(0)",)]
    with pytest.raises(ValueError):
        quality.validate(_good(spark), "historical", reason_mode="day")


def test_in_batch_duplicates_are_reported_not_removed(spark):
    batch = fact(spark, ("a", "2026-01-01", 10.0), ("a", "2026-01-01", 11.0))
    parts = quality.validate(batch, "historical")
    assert parts.valid.count() == 2 and parts.duplicates.count() == 2 and parts.quarantined.isEmpty()


def test_empty_batch(spark):
    parts = quality.validate(fact(spark), "historical")
    for part in (parts.valid, parts.quarantined, parts.duplicates, parts.gaps):
        assert part.isEmpty()


def test_validation_scans_once_and_stays_in_the_jvm(spark, tmp_path):
    _good(spark).write.parquet(str(tmp_path / "good"))
    flagged = quality.flag(spark.read.parquet(str(tmp_path / "good")), "historical", bounded=True)
    assert plan(flagged).count("FileScan") == 1
    assert "Python" not in plan(flagged) and "Pandas" not in plan(flagged)
