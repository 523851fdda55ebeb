import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from helpers import day, fact, plan, prices, rows
from tidemark.functions.expressions import utc_day
from tidemark.operators import series


def test_utc_day_ignores_the_session_time_zone(spark):
    stamps = [0, 86_399_999, 86_400_000, -1, 1788296950000, 1788723880000]
    frame = spark.createDataFrame([(s,) for s in stamps], "ts long").select("ts", utc_day(F.col("ts")).alias("d"))
    spark.conf.set("spark.sql.session.timeZone", "Asia/Baku")
    try:
        got = {r.ts: r.d for r in frame.collect()}
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    epoch = dt.datetime(1970, 1, 1)
    assert got == {s: (epoch + dt.timedelta(milliseconds=s)).date() for s in stamps}
    assert got[1788296950000] == day("2026-09-01")


def test_daily_last_takes_each_columns_last_value_that_is_not_null(spark):
    points = spark.createDataFrame(
        [
            ("btc", day("2026-01-01"), 3, 12.0, None, None),
            ("btc", day("2026-01-01"), 1, 10.0, 100.0, None),
            ("btc", day("2026-01-01"), 2, 11.0, 110.0, None),
            ("btc", day("2026-01-02"), 4, 13.0, 130.0, 5.0),
            (None, day("2026-01-02"), 4, 1.0, 1.0, 1.0),
        ],
        "coin_id string, date date, ts long, price double, market_cap double, volume double",
    )
    expected = [
        ("btc", day("2026-01-01"), 12.0, 110.0, None),
        ("btc", day("2026-01-02"), 13.0, 130.0, 5.0),
    ]
    assert rows(series.daily_last(points, ["ts"])) == expected
    assert rows(series.daily_last(points, ["ts", "price"])) == expected


def test_daily_last_by_one_number_combines_before_the_shuffle_in_a_hash_aggregate(spark):
    points = spark.range(10).selectExpr(
        "cast(id as string) coin_id", "date'2026-01-01' as date", "id ts", "1D price", "1D market_cap", "1D volume"
    )
    text = plan(series.daily_last(points, ["ts"]))
    assert text.count("HashAggregate") == 2 and "SortAggregate" not in text


def _series(spark, *points):
    return spark.createDataFrame(list(points), "coin_id string, timestamp long, position long, value double")


def test_align_keeps_the_price_spine_and_never_multiplies(spark):
    aligned = series.align(
        _series(spark, ("a", 1, 0, 10.0), ("a", 2, 1, 20.0), ("a", 3, 2, 30.0)),
        _series(spark, ("a", 1, 0, 1.0), ("a", 1, 1, 2.0), ("a", 9, 2, 9.0)),
        _series(spark, ("a", 2, 0, 5.0), ("b", 1, 0, 7.0)),
        ["coin_id", "timestamp"],
        "position",
    )
    assert rows(aligned) == [("a", 1, 10.0, 2.0, None), ("a", 2, 20.0, None, 5.0), ("a", 3, 30.0, None, None)]


def test_marks_and_fetch_plan(spark):
    stored = prices(spark, ("a", "2026-01-01", 1), ("a", "2026-01-05", 1), ("b", "2026-01-10", 1))
    tracked = spark.createDataFrame([("a",), ("b",), ("c",)], "coin_id string")
    marks = series.high_water_marks(stored, tracked)
    assert rows(marks) == [("a", day("2026-01-05")), ("b", day("2026-01-10")), ("c", None)]
    plan_ = series.fetch_plan(marks, day("2026-01-10"))
    assert rows(plan_, "coin_id", "history_days") == [("a", 5), ("c", 365)]
    lowered = series.restate(marks, 2)
    assert rows(lowered)[0] == ("a", day("2026-01-03"))


def test_only_strictly_newer_rows_pass(spark):
    batch = prices(spark, ("a", "2026-01-05", 1), ("a", "2026-01-06", 2), ("c", "2020-01-01", 3))
    marks = spark.createDataFrame(
        [("a", day("2026-01-05")), ("c", None)], "coin_id string, high_water_mark date"
    )
    assert rows(series.newer_than_marks(batch, marks), "coin_id", "price") == [("a", 2.0), ("c", 3.0)]


def test_tracked_by_list_or_frame(spark):
    batch = prices(spark, ("a", "2026-01-05", 1), ("b", "2026-01-06", 2))
    ids = spark.createDataFrame([("b",), (None,), ("b",)], "coin_id string")
    assert rows(series.only_tracked(batch, ["a"]), "coin_id") == [("a",)]
    assert rows(series.only_tracked(batch, ids), "coin_id") == [("b",)]


def test_gap_between_first_and_third(spark):
    found = series.calendar_gaps(prices(spark, ("btc", "2026-01-01", 1), ("btc", "2026-01-03", 1)))
    assert rows(found) == [("btc", day("2026-01-02"))]


def test_gaps_of_nothing_keep_the_columns(spark):
    found = series.calendar_gaps(prices(spark))
    assert found.columns == ["coin_id", "missing_date"] and found.isEmpty()


def test_gaps_and_observed_days_make_the_whole_calendar(spark):
    generator = random.Random(7)
    start = day("2024-02-20")
    seen = {
        coin: {start + dt.timedelta(days=generator.randrange(60)) for _ in range(20)} for coin in "abc"
    }
    seen["d"] = {start}
    frame = spark.createDataFrame(
        [(c, d) for c, ds in seen.items() for d in ds for _ in range(2)], "coin_id string, date date"
    )
    found = {(r.coin_id, r.missing_date) for r in series.calendar_gaps(frame).collect()}
    expected = {
        (c, min(ds) + dt.timedelta(days=i))
        for c, ds in seen.items()
        for i in range((max(ds) - min(ds)).days)
        if min(ds) + dt.timedelta(days=i) not in ds
    }
    assert found == expected


@pytest.mark.parametrize("operator", [series.high_water_marks, series.calendar_gaps])
def test_empty_input_is_fine(spark, operator):
    assert operator(fact(spark)).isEmpty()
