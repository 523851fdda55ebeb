import os
from glob import glob

import pytest
from pyspark.sql import functions as F

from helpers import day, fact, plan, prices, rows, scanned
from tidemark.operators import store
from tidemark.scale import materialise


@pytest.fixture
def warehouse(spark, tmp_path):
    return store.Warehouse(spark, str(tmp_path / "warehouse"))


def _ordered(frame):
    return frame.withColumn("ord", F.coalesce(F.col("price"), F.lit(0.0)))


def test_last_writer_wins_within_and_over_the_stored_rows(spark):
    stored = fact(spark, ("a", "2026-01-01", 1.0, 1.0, 1.0), ("a", "2026-01-02", 2.0))
    batch = spark.createDataFrame(
        [
            ("a", day("2026-01-02"), 8.0, None, None, 2),
            ("a", day("2026-01-02"), 9.0, 5.0, None, 1),
            ("b", day("2026-01-01"), 7.0, 7.0, 7.0, 1),
        ],
        "coin_id string, date date, price double, market_cap double, volume double, ord int",
    )
    merged = store.merge_latest(stored, batch, ["coin_id", "date"], ["ord"])
    assert rows(merged) == [
        ("a", day("2026-01-01"), 1.0, 1.0, 1.0),
        ("a", day("2026-01-02"), 8.0, None, None),
        ("b", day("2026-01-01"), 7.0, 7.0, 7.0),
    ]
    again = store.merge_latest(merged, batch, ["coin_id", "date"], ["ord"])
    assert rows(again) == rows(merged)


def test_an_upsert_reads_only_the_months_of_its_batch(spark, warehouse):
    months = [f"2025-{m:02d}-10" for m in range(1, 13)]
    warehouse.upsert_fact(_ordered(fact(spark, *[("a", d, 1.0) for d in months])), ["ord"])
    warehouse.upsert_fact(_ordered(fact(spark, ("a", "2025-03-11", 2.0))), ["ord"])
    batch = fact(spark, ("a", "2025-03-12", 3.0)).withColumn("month", F.date_format("date", "yyyy-MM"))
    touched = warehouse.in_months("fact_price", materialise(batch, "batch"))
    assert "dynamicpruning" in plan(touched)
    assert rows(touched, "date", "price") == [(day("2025-03-10"), 1.0), (day("2025-03-11"), 2.0)]
    assert scanned(touched)["numPartitions"] == 1


def test_upsert_rewrites_only_the_months_of_the_batch(spark, warehouse):
    first = fact(spark, ("a", "2026-01-31", 1.0), ("a", "2026-02-01", 2.0), ("b", "2026-02-03", 3.0))
    warehouse.upsert_fact(_ordered(first), ["ord"])
    january = glob(f"{warehouse.path('fact_price')}/month=2026-01/*.parquet")
    kept = {f: os.stat(f).st_mtime_ns for f in january}
    warehouse.upsert_fact(_ordered(fact(spark, ("a", "2026-02-01", 9.0), ("c", "2026-03-01", 4.0))), ["ord"])
    assert {f: os.stat(f).st_mtime_ns for f in january} == kept and kept
    expected = [
        ("a", day("2026-01-31"), 1.0),
        ("a", day("2026-02-01"), 9.0),
        ("b", day("2026-02-03"), 3.0),
        ("c", day("2026-03-01"), 4.0),
    ]
    assert rows(warehouse.fact_price(), "coin_id", "date", "price") == expected
    warehouse.upsert_fact(_ordered(fact(spark, ("a", "2026-02-01", 9.0), ("c", "2026-03-01", 4.0))), ["ord"])
    assert rows(warehouse.fact_price(), "coin_id", "date", "price") == expected


def test_a_half_moved_load_is_completed_on_the_next_read(spark, warehouse, monkeypatch):
    before = fact(spark, ("a", "2026-01-01", 1.0), ("a", "2026-02-01", 2.0))
    warehouse.upsert_fact(_ordered(before), ["ord"])
    publish = store.Warehouse._publish

    def one_then_lost(self, table, rows):
        publish(self, table, rows.where("month = '2026-01'"))
        raise OSError("driver lost")

    monkeypatch.setattr(store.Warehouse, "_publish", one_then_lost)
    changed = fact(spark, ("a", "2026-01-01", 5.0), ("a", "2026-02-01", 6.0))
    with pytest.raises(OSError):
        warehouse.upsert_fact(_ordered(changed), ["ord"])
    monkeypatch.undo()
    assert rows(warehouse.fact_price(), "price") == [(5.0,), (6.0,)]
    assert not warehouse.exists(warehouse.path("_staging/fact_price"))


def test_staged_months_are_moved_once_however_often_they_are_interrupted(spark, warehouse):
    def files():
        return {os.path.basename(f) for f in glob(f"{warehouse.path('fact_price')}/month=*/*.parquet")}

    warehouse.upsert_fact(_ordered(fact(spark, ("a", "2026-01-01", 1.0), ("a", "2026-02-01", 2.0))), ["ord"])
    changed = fact(spark, ("a", "2026-01-01", 5.0), ("a", "2026-02-01", 6.0), ("b", "2026-03-01", 7.0))
    staged = warehouse._staged("fact_price")
    with pytest.MonkeyPatch.context() as broken:
        broken.setattr(store.Warehouse, "_publish", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            warehouse.upsert_fact(_ordered(changed), ["ord"])
    written = {os.path.basename(f) for f in glob(f"{staged}/month=*/*.parquet")}
    # The driver is lost after the first month; its files must outlive the next attempt.
    target = warehouse.path("fact_price")
    old = [f"{os.path.basename(os.path.dirname(f))}/{os.path.basename(f)}" for f in glob(f"{target}/month=*/*.parquet")]
    spark.createDataFrame([(f,) for f in old], "value string").coalesce(1).write.text(f"{staged}/_replaced")
    for f in glob(f"{staged}/month=2026-01/*.parquet"):
        os.rename(f, f"{target}/month=2026-01/{os.path.basename(f)}")
    assert rows(warehouse.fact_price(), "price") == [(5.0,), (6.0,), (7.0,)]
    # What was staged is the table: nothing is written again.
    assert files() == written and not warehouse.exists(staged)


def test_dimension_upsert_overwrites_symbol_and_name(spark, warehouse):
    schema = "coin_id string, symbol string, name string, ord int"
    warehouse.upsert_dim(spark.createDataFrame([("a", "x", "A", 1), ("b", "y", "B", 1)], schema), ["ord"])
    warehouse.upsert_dim(spark.createDataFrame([("b", "z", "Bee", 1), ("b", "q", "Bea", 2)], schema), ["ord"])
    assert rows(warehouse.dim_coin()) == [("a", "x", "A"), ("b", "q", "Bea")]


def test_snapshot_and_history_loads(spark, warehouse):
    snapshot = spark.createDataFrame(
        [("a", "x", "A", day("2026-01-02"), 1.0, 2.0, 3.0)],
        "coin_id string, symbol string, name string, date date, price double, market_cap double, volume double",
    )
    warehouse.load_snapshot(snapshot, [])
    warehouse.load_history(fact(spark, ("a", "2026-01-01", 5.0)), [])
    assert rows(warehouse.dim_coin()) == [("a", "x", "A")]
    assert rows(warehouse.fact_price(), "date", "price") == [(day("2026-01-01"), 5.0), (day("2026-01-02"), 1.0)]


def test_quarantine_rerun_replaces_its_own_run(spark, warehouse):
    bad = fact(spark, ("a", "2026-01-01", -1.0), (None, None, None)).withColumn("reason", F.lit("why"))
    warehouse.append_quarantine(bad, "one")
    warehouse.append_quarantine(bad.limit(1), "two")
    warehouse.append_quarantine(bad, "one")
    kept = warehouse.quarantine()
    assert rows(kept.groupBy("run_id").count()) == [("one", 2), ("two", 1)]
    assert kept.where("quarantined_at is null").isEmpty()


def test_empty_loads_and_reads(spark, warehouse):
    warehouse.upsert_fact(_ordered(fact(spark)), ["ord"])
    warehouse.upsert_dim(spark.createDataFrame([], "coin_id string, symbol string, name string"), [])
    for table in (warehouse.fact_price(), warehouse.dim_coin(), warehouse.quarantine(), warehouse.gaps()):
        assert table.isEmpty()


def test_audits(spark):
    dim = spark.createDataFrame(
        [("a", "x" * 51, "A"), ("a", "y", "B" * 101), (None, "z", "C"), ("d" * 51, "w", "D")],
        "coin_id string, symbol string, name string",
    )
    stored = fact(spark, ("a", "2026-01-01", 1.0), ("a", "2026-01-01", 2.0), ("q" * 51, "2026-01-01", 1.0), (None, None, 1.0))
    assert rows(store.orphan_facts(stored, dim), "coin_id") == [("q" * 51,), (None,)]
    assert dict(rows(store.constraint_audit(stored, dim))) == {
        "dim_coin_key_not_null": 1,
        "dim_coin_key_unique": 1,
        "dim_coin_key_length": 1,
        "dim_coin_symbol_length": 1,
        "dim_coin_name_length": 1,
        "fact_price_coin_not_null": 1,
        "fact_price_coin_length": 1,
        "fact_price_date_not_null": 1,
        "fact_price_key_unique": 1,
        "fact_price_coin_in_dim": 2,
    }
    assert dict(rows(store.table_counts({"dim_coin": dim, "fact_price": stored}))) == {"dim_coin": 4, "fact_price": 4}


def test_a_small_batch_is_broadcast_so_stored_rows_stay_in_place(spark, tmp_path):
    from helpers import plan

    fact(spark, ("a", "2026-01-01", 1.0)).write.parquet(str(tmp_path / "stored"))
    fact(spark, ("a", "2026-01-01", 2.0)).write.parquet(str(tmp_path / "latest"))
    read = lambda name: spark.read.parquet(str(tmp_path / name))
    text = plan(store.replace_keys(read("stored"), read("latest"), ["coin_id", "date"]))
    assert "BroadcastHashJoin" in text and "hashpartitioning" not in text
    assert prices(spark).isEmpty()


def test_marks_remember_what_they_were_made_for(spark, warehouse):
    marks = spark.createDataFrame([("a", day("2026-01-05"))], "coin_id string, high_water_mark date")
    assert rows(warehouse.marks("one", marks, 2)) == rows(warehouse.marks("one", marks.limit(0), 2)) == rows(marks)
    with pytest.raises(ValueError, match="restate_days"):
        warehouse.marks("one", marks, 3)


def test_audit_reads_each_table_once(spark, tmp_path):
    from helpers import plan

    fact(spark, ("a", "2026-01-01", 1.0)).write.parquet(str(tmp_path / "fact"))
    spark.createDataFrame([("a", "x", "A")], "coin_id string, symbol string, name string").write.parquet(str(tmp_path / "dim"))
    read = lambda name: spark.read.parquet(str(tmp_path / name))
    assert plan(store.constraint_audit(read("fact"), read("dim"))).count("FileScan") == 2
