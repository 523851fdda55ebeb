import datetime as dt
import math
import random
import statistics

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from helpers import column, day, fact, plan, prices, rows
from tidemark.operators import marts


def _walk(spark, days=80, coins="ab"):
    generator = random.Random(3)
    start = day("2025-01-01")
    walk = {c: [round(generator.uniform(50, 150), 2) for _ in range(days)] for c in coins}
    frame = spark.createDataFrame(
        [(c, start + dt.timedelta(days=i), p) for c, ps in walk.items() for i, p in enumerate(ps)],
        "coin_id string, date date, price double",
    )
    return walk, frame


def test_percent_change(spark):
    # Prices and changes that the operator must reproduce.
    frame = spark.createDataFrame(
        [("btc", "2026-01-01", 100.0), ("btc", "2026-01-02", 110.0), ("btc", "2026-01-03", 99.0)],
        "coin_id string, date string, price double",
    )
    result = marts.percent_change(frame, ordered=True)
    assert result.columns == ["coin_id", "date", "price", "return"]
    first, second, third = [r["return"] for r in result.collect()]
    assert first is None and second == pytest.approx(0.10) and third == pytest.approx(-0.10)


def test_strict_moving_average(spark):
    frame = prices(
        spark, *[("btc", f"2026-01-0{i}", 10 * i) for i in range(1, 5)]
    )
    assert column(marts.moving_average(frame, window=3), "moving_average") == [None, None, 20.0, 30.0]
    holed = prices(spark, ("b", "2026-01-01", 1), ("b", "2026-01-02", None), ("b", "2026-01-03", 3))
    assert column(marts.moving_average(holed, window=2), "moving_average") == [None, None, None]


def test_window_must_be_positive(spark):
    with pytest.raises(ValueError, match="needs a positive window"):
        marts.moving_average(prices(spark), window=0)


@pytest.mark.parametrize(
    "mart, added",
    [
        (marts.percent_change, "return"),
        (marts.moving_average, "moving_average"),
        (marts.daily_return, "daily_return"),
        (marts.moving_averages, "moving_avg_30d"),
        (marts.rolling_volatility, "volatility_30d"),
        (marts.max_drawdown, "drawdown"),
        (marts.worst_drawdown, "worst_date"),
        (marts.return_30d, "return_30d"),
        (marts.latest_per_coin, "volatility_30d"),
        (marts.volatility_ranking, "volatility_rank"),
        (marts.coverage, "row_count"),
    ],
)
def test_empty_input_keeps_the_columns(spark, mart, added):
    result = mart(prices(spark))
    assert result.isEmpty() and added in result.columns


def test_moving_averages_start_with_partial_frames(spark):
    walk, frame = _walk(spark)
    result = marts.moving_averages(frame).where("coin_id = 'a'")
    for name, width in (("moving_avg_7d", 7), ("moving_avg_30d", 30)):
        expected = [statistics.mean(walk["a"][max(0, i + 1 - width) : i + 1]) for i in range(80)]
        assert column(result, name) == pytest.approx(expected)


def test_volatility_ignores_the_missing_first_return(spark):
    walk, frame = _walk(spark)
    got = column(marts.rolling_volatility(frame).where("coin_id = 'b'"), "volatility_30d")
    p = walk["b"]
    changes = [None] + [(p[i] - p[i - 1]) / p[i - 1] for i in range(1, 80)]
    for i in range(80):
        window = [c for c in changes[max(0, i - 29) : i + 1] if c is not None]
        if len(window) < 2:
            assert got[i] is None
        else:
            assert got[i] == pytest.approx(statistics.stdev(window), abs=6e-6)
    assert len([c for c in changes[0:30] if c is not None]) == 29


def test_drawdown_runs_per_row_and_worst_keeps_the_first_deepest_day(spark):
    frame = prices(
        spark, ("a", "2026-01-01", 100), ("a", "2026-01-02", 50), ("a", "2026-01-03", 200), ("a", "2026-01-04", 100)
    )
    down = marts.max_drawdown(frame)
    assert column(down, "running_peak") == [100.0, 100.0, 200.0, 200.0]
    assert column(down, "drawdown") == [0.0, -0.5, 0.0, -0.5]
    assert rows(marts.worst_drawdown(frame)) == [("a", -0.5, day("2026-01-02"))]


def test_zero_price_gives_null_instead_of_an_error(spark):
    frame = prices(spark, ("a", "2026-01-01", 0), ("a", "2026-01-02", 5))
    assert column(marts.daily_return(frame), "daily_return") == [None, None]
    assert column(marts.percent_change(frame), "return") == [None, None]


def test_thirty_rows_back_not_thirty_days(spark):
    walk, frame = _walk(spark)
    thinned = frame.where(F.day("date") != 15)
    kept = [p for i, p in enumerate(walk["a"]) if (day("2025-01-01") + dt.timedelta(days=i)).day != 15]
    got = column(marts.return_30d(thinned).where("coin_id = 'a'"), "return_30d")
    assert got[:30] == [None] * 30
    assert got[30:] == pytest.approx([kept[i] / kept[i - 30] - 1 for i in range(30, len(kept))])


def test_best_and_worst(spark):
    _, frame = _walk(spark)
    changes = sorted(c for c in column(marts.return_30d(frame), "return_30d") if c is not None)
    assert [r.return_30d for r in marts.best_return_30d(frame, 3).collect()] == changes[:-4:-1]
    assert [r.return_30d for r in marts.worst_return_30d(frame, 3).collect()] == changes[:3]


def test_latest_per_coin_is_the_newest_row(spark):
    _, frame = _walk(spark)
    assert rows(marts.latest_per_coin(frame), "coin_id", "date") == [
        (c, day("2025-01-01") + dt.timedelta(days=79)) for c in "ab"
    ]


@pytest.mark.parametrize("nulls", ["first", "last"])
def test_ranking_shares_ranks_and_places_nulls(spark, nulls):
    # Coins a and b move alike, c swings more, d and e have too little history.
    moves = {"a": [10, 11, 10], "b": [20, 22, 20], "c": [10, 90, 10], "d": [5], "e": [5, 6]}
    frame = prices(
        spark, *[(c, f"2026-01-0{i + 1}", p) for c, ps in moves.items() for i, p in enumerate(ps)]
    )
    ranking = marts.volatility_ranking(frame, nulls=nulls)
    ranks = {r.coin_id: r.volatility_rank for r in ranking.collect()}
    if nulls == "first":
        assert ranks == {"d": 1, "e": 1, "c": 3, "a": 4, "b": 4}
    else:
        assert ranks == {"c": 1, "a": 2, "b": 2, "d": 4, "e": 4}


@pytest.mark.parametrize("nulls", ["first", "last"])
def test_ranks_equal_a_plain_rank(spark, nulls):
    generator = random.Random(11)
    values = [round(10 ** generator.uniform(-5, 7), 5) for _ in range(500)]
    values += [0.0] * 40 + values[:60] + [None] * 30 + [math.nan] * 3 + [math.inf] * 2
    frame = spark.createDataFrame([(v,) for v in values], "v double")
    by = F.col("v").desc_nulls_first() if nulls == "first" else F.col("v").desc_nulls_last()
    plain = frame.select("v", F.rank().over(Window.orderBy(by)).alias("rank")).distinct()
    assert repr(rows(marts._ranks(frame, "v", by))) == repr(rows(plain))


def test_infinite_prices_rank_after_missing_volatility(spark):
    steps = {"n": [5.0], "i": [1.0, math.inf, 2.0, 3.0], "j": [1.0, 2.0, 1.0, 3.0]}
    frame = prices(spark, *[(c, f"2026-01-0{i + 1}", p) for c, ps in steps.items() for i, p in enumerate(ps)])
    ranked = marts.volatility_ranking(frame).collect()
    assert [(r.coin_id, r.volatility_rank) for r in ranked] == [("n", 1), ("i", 2), ("j", 3)]


def test_ranking_rejects_unknown_null_placement(spark):
    with pytest.raises(ValueError):
        marts.volatility_ranking(prices(spark), nulls="middle")


@pytest.mark.parametrize(
    "mart",
    [marts.daily_return, marts.moving_averages, marts.rolling_volatility, marts.max_drawdown, marts.return_30d, marts.latest_per_coin],
)
def test_marts_shuffle_once_and_stay_in_the_jvm(spark, tmp_path, mart):
    _, frame = _walk(spark)
    frame.write.parquet(str(tmp_path / "fact"))
    text = plan(mart(spark.read.parquet(str(tmp_path / "fact"))))
    assert text.count("Exchange") == 1 and text.count("Sort [") == 1
    assert "hashpartitioning(coin_id" in text
    assert "Python" not in text and "Pandas" not in text


def test_coin_filter_reaches_the_scan_through_the_windows(spark, tmp_path):
    _, frame = _walk(spark)
    frame.write.parquet(str(tmp_path / "fact"))
    filtered = marts.rolling_volatility(spark.read.parquet(str(tmp_path / "fact"))).where("coin_id = 'a'")
    assert "EqualTo(coin_id,a)" in plan(filtered)


def test_coverage_and_coin_history(spark):
    frame = prices(spark, ("b", "2026-01-03", 1), ("a", "2026-01-01", 1), ("a", "2026-01-04", 2))
    assert [tuple(r) for r in marts.coverage(frame).collect()] == [
        ("a", day("2026-01-01"), day("2026-01-04"), 2),
        ("b", day("2026-01-03"), day("2026-01-03"), 1),
    ]
    assert [r.price for r in marts.coin_history(frame, "a").collect()] == [2.0, 1.0]
    assert marts.coverage(fact(spark)).isEmpty()
