"""Sliced passes and keyed joins give the same rows as plain windows."""

import random
import re

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from helpers import plan, rows
from tidemark import scale


def _ticks(spark, n=3000):
    """One coin with most rows, many copies of one row, a null coin, and some small coins."""
    generator = random.Random(5)
    data = []
    for _ in range(n):
        coin = generator.choice(["hot", "hot", "hot", "a", "b", None])
        data.append((coin, generator.randrange(40), generator.randrange(500), float(generator.randrange(1, 90))))
    data += [("hot", 7, 7, 7.0)] * (n // 3)
    data += [("single", 1, 1, 1.0)]
    return spark.createDataFrame(data, "coin_id string, day int, tick int, price double").repartition(6)


@pytest.mark.parametrize("slice_bytes", [1 << 40, 4000, 700])
@pytest.mark.parametrize("some", [False, True])
def test_previous_value_equals_a_plain_window(spark, monkeypatch, tmp_path, slice_bytes, some):
    monkeypatch.setattr(scale, "SLICE_BYTES", slice_bytes)
    _ticks(spark).write.parquet(str(tmp_path / "ticks"))
    ticks = spark.read.parquet(str(tmp_path / "ticks"))
    order = ["day", "tick", "price"]
    among = F.col("price") < 40 if some else None
    by_coin = Window.partitionBy("coin_id").orderBy(*order)
    if some:
        before = by_coin.rowsBetween(Window.unboundedPreceding, -1)
        plain = F.last(F.when(among, F.col("price")), ignorenulls=True).over(before)
    else:
        plain = F.lag("price").over(by_coin)
    want = ticks.withColumn("previous", plain)
    for bounded in (False, True):
        got = scale.previous_value(ticks, "coin_id", order, "price", "previous", among, bounded)
        assert got.columns == want.columns
        assert rows(got) == rows(want)


def test_slices_are_even(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(scale, "SLICE_BYTES", 1000)
    _ticks(spark).write.parquet(str(tmp_path / "ticks"))
    cut = scale.sliced(spark.read.parquet(str(tmp_path / "ticks")), ["coin_id", "day", "tick"])
    sizes = [r["count"] for r in cut.groupBy("_slice").count().collect()]
    assert len(sizes) > 8
    # A third of all rows are copies of one row; they spread as well.
    assert max(sizes) < 4 * sum(sizes) / len(sizes)


def test_join_keyed_equals_a_plain_join(spark):
    ticks = _ticks(spark)
    keyed = ticks.groupBy("coin_id", "day").agg(F.count(F.lit(1)).alias("n"), F.max("price").alias("top"))
    got = scale.join_keyed(ticks, keyed.where("n > 1").drop("n"), ["coin_id", "day"])
    by_key = Window.partitionBy("coin_id", "day")
    plain = ticks.select(
        "*", F.count(F.lit(1)).over(by_key).alias("n"), F.max("price").over(by_key).alias("top")
    ).where("n > 1")
    assert rows(got) == rows(plain.drop("n"))


def test_shared_folder_comes_from_the_session(spark):
    assert scale.shared_dir(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")


def _mixed(spark, seed):
    """Ticks of a hot key, a few others, a null key and null prices; many share their order value."""
    rng = random.Random(seed)
    keys = ["hot"] * 260 + ["a"] * 3 + ["b"] * 45 + [None] * 70
    rows = [(k, rng.randint(0, 40), i, rng.choice([None, *range(1, 90)])) for i, k in enumerate(keys)]
    rng.shuffle(rows)
    return rows, spark.createDataFrame([(k, d, i, None if p is None else float(p)) for k, d, i, p in rows], "key string, day int, id int, price double")


def _by_key(rows):
    grouped = {}
    for k, d, i, p in sorted(rows, key=lambda r: (str(r[0]), r[1], r[2])):
        grouped.setdefault(k, []).append((i, p))
    return grouped


@pytest.mark.parametrize("slices", [1, 7, 150])
def test_running_totals_equal_plain_ones_for_any_slices(spark, monkeypatch, slices):
    rows, frame = _mixed(spark, slices)
    monkeypatch.setattr(scale, "_slice_count", lambda _: slices)
    for total, fold in (("max", max), ("min", min), ("sum", sum)):
        found = {r.id: r.out for r in scale.running(frame, "key", ["day", "id"], "price", "out", total).collect()}
        assert len(found) == len(rows)
        for values in _by_key(rows).values():
            for n, (i, _) in enumerate(values):
                seen = [p for _, p in values[: n + 1] if p is not None]
                assert found[i] == (fold(seen) if seen else None), (total, i)


@pytest.mark.parametrize("slices", [1, 7, 150])
@pytest.mark.parametrize("width", [2, 31])
def test_trailing_frames_equal_plain_ones_for_any_slices(spark, monkeypatch, slices, width):
    rows, frame = _mixed(spark, slices)
    monkeypatch.setattr(scale, "_slice_count", lambda _: slices)

    def first(by):
        return {"previous": F.lag("price").over(by), "seen": F.collect_list("id").over(by.rowsBetween(1 - width, 0))}

    def then(by):
        return {"n": F.size("seen")}

    found = {r.id: r for r in scale.trailing(frame, "key", ["day", "id"], width, [first, then]).collect()}
    assert len(found) == len(rows)
    for values in _by_key(rows).values():
        for n, (i, _) in enumerate(values):
            assert list(found[i].seen) == [j for j, _ in values[max(0, n + 1 - width) : n + 1]]
            assert found[i].n == len(found[i].seen)
            if width > 1:
                assert found[i].previous == (values[n - 1][1] if n else None)


def test_no_window_holds_a_whole_key(spark):
    _, frame = _mixed(spark, 0)
    for found in (
        scale.running(frame, "key", ["day"], "price", "out"),
        scale.trailing(frame, "key", ["day"], 3, [lambda by: {"m": F.avg("price").over(by.rowsBetween(-2, 0))}]),
    ):
        over = re.findall(r"Window \[(.*?)\], \[(.*?)\]", plan(found))
        rowwise = [by for what, by in over if "price" in what]
        assert rowwise and all("_slice" in by for by in rowwise)


@pytest.mark.parametrize("function", ["running", "trailing"])
def test_no_rows_give_none(spark, function):
    empty = spark.createDataFrame([], "key string, day int, price double")
    if function == "running":
        assert scale.running(empty, "key", ["day"], "price", "out").columns[-1] == "out"
        assert scale.running(empty, "key", ["day"], "price", "out").count() == 0
    else:
        assert scale.trailing(empty, "key", ["day"], 5, [lambda by: {"m": F.lag("price").over(by)}]).count() == 0
