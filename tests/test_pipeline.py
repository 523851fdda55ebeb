import os

import pytest
from pyspark.errors import StreamingQueryException

from helpers import day, plan, rows
from payloads import coin, write_history, write_snapshot
from tidemark.operators import marts
from tidemark.operators.store import Warehouse
from tidemark.plans import pipeline, views
from tidemark.streaming.ingest import stream_history, stream_load

HOURS = ("03:00:00", "21:30:00")


def _days(first: int, last: int, price: float):
    return [(f"2026-08-{d:02d}T{h}", price + d + i / 10) for d in range(first, last + 1) for i, h in enumerate(HOURS)]


@pytest.fixture
def landed(tmp_path):
    folder = tmp_path / "raw"
    write_snapshot(folder, "20260826_070001", [coin("bitcoin", 100), coin("tron", 50.5)])
    write_history(folder, "bitcoin", "20260826_070002", _days(20, 25, 80.0))
    write_history(folder, "tron", "20260826_070003", _days(23, 26, 20.0))
    write_snapshot(folder, "20260828_070001", [coin("bitcoin", 101), coin("tron", -1)])
    write_history(folder, "bitcoin", "20260828_070002", _days(26, 28, 75.0))
    write_history(folder, "tron", "20260828_070003", [*_days(26, 27, 20.0), ("2026-08-28T01:00:00", 500.0)])
    return str(folder)


def _tables(spark, root):
    w = Warehouse(spark, root)
    quarantine = w.quarantine().drop("quarantined_at")
    return [rows(t) for t in (w.dim_coin(), w.fact_price(), quarantine, w.gaps())]


def test_two_runs_load_incrementally_and_reruns_change_nothing(spark, tmp_path, landed):
    root = str(tmp_path / "warehouse")
    first = pipeline.run(spark, landed, root, "first", until="20260826_235959")
    # tron's 26th is in both inputs: history is loaded last and wins.
    assert first.collect()[0].asDict() == {
        "rows_received": 12,
        "rows_passed": 12,
        "rows_quarantined": 0,
        "gaps_found": 0,
        "duplicates_found": 0,
    }
    stored = Warehouse(spark, root).fact_price()
    assert rows(stored.where("coin_id = 'tron'"), "date", "price")[-1] == (day("2026-08-26"), 46.1)
    assert rows(stored.where("coin_id = 'bitcoin'"), "date", "price")[-1] == (day("2026-08-26"), 100.0)
    before = _tables(spark, root)
    pipeline.run(spark, landed, root, "first", until="20260826_235959")
    assert _tables(spark, root) == before

    second = pipeline.run(spark, landed, root, "second", since="20260827_000000")
    # Mark is the 26th: two new days per coin; tron's snapshot and its last day are bad.
    assert second.collect()[0].asDict() == {
        "rows_received": 6,
        "rows_passed": 4,
        "rows_quarantined": 2,
        "gaps_found": 0,
        "duplicates_found": 0,
    }
    assert rows(Warehouse(spark, root).quarantine(), "coin_id", "date", "price", "reason", "run_id") == [
        ("tron", day("2026-08-28"), -1.0, "Schema validation failed: greater_than(0)", "second"),
        ("tron", day("2026-08-28"), 500.0, "Day-over-day price change > 50%", "second"),
    ]
    report = os.listdir(f"{root}/dq_report/run_id=second/text")
    text = next(f for f in report if f.endswith(".txt"))
    assert open(f"{root}/dq_report/run_id=second/text/{text}").read().splitlines() == [
        "DATA QUALITY REPORT",
        "===================",
        "Rows Received: 6",
        "Rows Passed: 4",
        "Rows Quarantined: 2",
        "Gaps Found: 0",
    ]
    before = _tables(spark, root)
    again = pipeline.run(spark, landed, root, "second", since="20260827_000000")
    assert _tables(spark, root) == before and rows(again) == rows(second)
    metrics = {(r.run_id, r.step, r.metric): r.value for r in Warehouse(spark, root).metrics().collect()}
    assert metrics["second", "batch", "historical_anomaly"] == metrics["second", "batch", "current_failed"] == 1
    assert [metrics[run, step, "rows"] for run in ("first", "second") for step in ("fact_price", "quarantine", "gaps")] == [11, 0, 0, 3, 2, 0]
    counted = spark.sql("SELECT count(*) AS n FROM volatility_ranking").first().n
    assert counted == 2
    direct = marts.max_drawdown(Warehouse(spark, root).fact_price())
    assert rows(spark.table("max_drawdown")) == rows(direct)


def test_restating_lowers_the_marks(spark, tmp_path, landed):
    root = str(tmp_path / "warehouse")
    pipeline.run(spark, landed, root, "first", until="20260826_235959")
    report = pipeline.run(spark, landed, root, "second", since="20260827_000000", restate_days=1)
    assert report.first().rows_received == 8
    kept = Warehouse(spark, root).fact_price().where("coin_id = 'bitcoin' and date = '2026-08-26'")
    assert rows(kept, "price") == [(101.1,)]


def test_tracked_coins_and_empty_landing(spark, tmp_path, landed):
    root = str(tmp_path / "warehouse")
    report = pipeline.run(spark, landed, root, "one", until="20260826_235959", tracked=["tron"])
    assert report.first().rows_received == 5
    report = pipeline.run(spark, landed, root, "two", since="20270101_000000")
    assert report.first().rows_received == 0
    assert Warehouse(spark, root).fact_price().count() == 4


def test_history_without_a_dimension_row_is_refused(spark, tmp_path):
    folder = tmp_path / "raw"
    write_snapshot(folder, "20260826_070001", [coin("bitcoin", 100)])
    write_history(folder, "tron", "20260826_070002", _days(20, 21, 5.0))
    with pytest.raises(ValueError, match="no dimension row for coin 'tron'"):
        pipeline.run(spark, str(folder), str(tmp_path / "warehouse"), "one")
    assert Warehouse(spark, str(tmp_path / "warehouse")).fact_price().isEmpty()


def test_missing_views_are_named(spark):
    for name in views.MARTS:
        spark.catalog.dropTempView(name)
    with pytest.raises(RuntimeError, match="mart views not registered: daily_return, max_drawdown"):
        views.check(spark)


def test_unknown_layout(spark, tmp_path):
    with pytest.raises(ValueError):
        pipeline.run(spark, str(tmp_path), str(tmp_path / "w"), "one", layout="csv")


def _known(spark, root, *coins):
    data = [(c, c[:3], c.title()) for c in coins]
    Warehouse(spark, root).upsert_dim(spark.createDataFrame(data, "coin_id string, symbol string, name string"), [])


def test_stream_loads_each_file_once(spark, tmp_path):
    raw, root, checkpoint = tmp_path / "raw", str(tmp_path / "w"), str(tmp_path / "checkpoint")
    _known(spark, root, "tron")
    write_history(raw, "tron", "20260826_070002", _days(20, 22, 5.0))
    stream_history(spark, str(raw), root, checkpoint).awaitTermination()
    warehouse = Warehouse(spark, root)
    assert rows(warehouse.fact_price(), "date", "price")[-1] == (day("2026-08-22"), 27.1)
    write_history(raw, "tron", "20260827_070002", [*_days(22, 23, 6.0), *_days(25, 25, 6.0)])
    stream_history(spark, str(raw), root, checkpoint).awaitTermination()
    assert rows(warehouse.fact_price(), "date", "price") == [
        (day("2026-08-20"), 25.1),
        (day("2026-08-21"), 26.1),
        (day("2026-08-22"), 27.1),
        (day("2026-08-23"), 29.1),
        (day("2026-08-25"), 31.1),
    ]
    assert rows(warehouse.gaps(), "coin_id", "missing_date") == [("tron", day("2026-08-24"))]


def test_streams_on_one_warehouse_keep_their_quarantine(spark, tmp_path):
    root = str(tmp_path / "w")
    _known(spark, root, "tron", "doge")
    for name in ("tron", "doge"):
        write_history(tmp_path / name, name, "20260826_070002", [*_days(20, 20, 5.0), ("2026-08-21T01:00:00", -1.0)])
        stream_history(spark, str(tmp_path / name), root, str(tmp_path / f"c-{name}")).awaitTermination()
    assert rows(Warehouse(spark, root).quarantine(), "coin_id", "price") == [("doge", -1.0), ("tron", -1.0)]


def test_stream_refuses_unknown_coins(spark, tmp_path):
    write_history(tmp_path / "raw", "tron", "20260826_070002", _days(20, 22, 5.0))
    with pytest.raises(StreamingQueryException, match="no dimension row"):
        stream_history(spark, str(tmp_path / "raw"), str(tmp_path / "w"), str(tmp_path / "c")).awaitTermination()


def test_a_stream_of_both_inputs_equals_runs(spark, tmp_path, landed):
    root, by_runs = str(tmp_path / "w"), str(tmp_path / "runs")
    for _ in range(2):
        stream_load(spark, landed, root, str(tmp_path / "c")).awaitTermination()
    pipeline.run(spark, landed, by_runs, "one")
    named = [t.drop("run_id") for t in (Warehouse(spark, root).quarantine(), Warehouse(spark, by_runs).quarantine())]
    assert [r[:2] for r in _tables(spark, root)[:2]] == [r[:2] for r in _tables(spark, by_runs)[:2]]
    assert rows(named[0].drop("quarantined_at")) == rows(named[1].drop("quarantined_at"))
    assert rows(Warehouse(spark, root).gaps().drop("run_id")) == rows(Warehouse(spark, by_runs).gaps().drop("run_id"))


def test_a_stream_drops_what_landed_before(spark, tmp_path):
    raw, root, checkpoint = tmp_path / "raw", str(tmp_path / "w"), str(tmp_path / "c")
    bad = [*_days(20, 21, 5.0), ("2026-08-22T01:00:00", -1.0)]
    write_snapshot(raw / "a", "20260820_070001", [coin("tron", 24.0)])
    write_history(raw / "a", "tron", "20260826_070002", bad)
    (raw / "a" / "history_tron_20260826_070009.json").write_text("{broken")
    stream_load(spark, f"{raw}/*", root, checkpoint).awaitTermination()
    before = _tables(spark, root)
    # The same payloads again elsewhere, and one that is new but stamped earlier.
    write_snapshot(raw / "b", "20260820_070001", [coin("tron", 24.0)])
    write_history(raw / "b", "tron", "20260826_070002", bad)
    (raw / "b" / "history_tron_20260826_070009.json").write_text("{broken")
    stream_load(spark, f"{raw}/*", root, checkpoint).awaitTermination()
    assert _tables(spark, root) == before and len(before[2]) == 2
    write_history(raw / "b", "tron", "20260825_070002", _days(23, 23, 5.0))
    stream_load(spark, f"{raw}/*", root, checkpoint).awaitTermination()
    assert rows(Warehouse(spark, root).fact_price(), "date")[-1] == (day("2026-08-23"),)


def test_a_run_leaves_no_copies_behind(spark, tmp_path, landed):
    shared = spark.conf.get("spark.checkpoint.dir")
    before = set(os.listdir(shared))
    pipeline.run(spark, landed, str(tmp_path / "warehouse"), "one")
    assert set(os.listdir(shared)) == before
    assert spark.table("volatility_ranking").count() == 2


def test_a_run_takes_what_landed_after_the_last(spark, tmp_path, landed):
    root = str(tmp_path / "warehouse")
    first = pipeline.run(spark, landed, root, "first", until="20260826_235959")
    second = pipeline.run(spark, landed, root, "second")
    assert (first.first().rows_received, second.first().rows_received) == (12, 6)
    before = _tables(spark, root)
    assert rows(pipeline.run(spark, landed, root, "second")) == rows(second) and _tables(spark, root) == before
    assert pipeline.run(spark, landed, root, "third").first().rows_received == 0
    with pytest.raises(ValueError, match="another window"):
        pipeline.run(spark, landed, root, "second", since="20260101_000000")
    with pytest.raises(ValueError, match="restate_days"):
        pipeline.run(spark, landed, root, "second", restate_days=4)


def _clean(spark, landed, root):
    pipeline.run(spark, landed, root, "one")
    return _tables(spark, root)[:2]


def test_the_next_run_loads_what_a_refused_run_left(spark, tmp_path):
    raw, root = tmp_path / "raw", str(tmp_path / "w")
    write_snapshot(raw, "20260826_070001", [coin("bitcoin", 100)])
    write_history(raw, "tron", "20260826_070002", _days(20, 21, 5.0))
    with pytest.raises(ValueError, match="no dimension row"):
        pipeline.run(spark, str(raw), root, "a")
    assert Warehouse(spark, root).pending() == ["a"]
    write_snapshot(raw, "20260827_070001", [coin("bitcoin", 101), coin("tron", 30)])
    report = pipeline.run(spark, str(raw), root, "b").first()
    assert (report.rows_received, report.rows_passed) == (5, 5)
    assert rows(Warehouse(spark, root).fact_price(), "coin_id", "date") == [
        ("bitcoin", day("2026-08-26")),
        ("bitcoin", day("2026-08-27")),
        ("tron", day("2026-08-20")),
        ("tron", day("2026-08-21")),
        ("tron", day("2026-08-27")),
    ]
    assert _tables(spark, root)[:2] == _clean(spark, str(raw), str(tmp_path / "clean"))
    with pytest.raises(ValueError, match="run 'a' was overtaken by run 'b'"):
        pipeline.run(spark, str(raw), root, "a")
    assert Warehouse(spark, root).pending() == []
    assert pipeline.run(spark, str(raw), root, "c").first().rows_received == 0


@pytest.mark.parametrize("step", ["load", "write_report"])
def test_a_run_may_end_anywhere(spark, tmp_path, landed, monkeypatch, step):
    """Before anything is stored, or with everything stored but the report: the next run gives the same tables."""
    root = str(tmp_path / "w")
    pipeline.run(spark, landed, root, "first", until="20260826_235959")

    def lost(*_, **__):
        raise RuntimeError("driver lost")

    with monkeypatch.context() as broken:
        broken.setattr(pipeline, step, lost)
        for name in ("second", "third"):
            with pytest.raises(RuntimeError, match="driver lost"):
                pipeline.run(spark, landed, root, name)
    assert Warehouse(spark, root).pending() == ["third"]
    report = pipeline.run(spark, landed, root, "fourth").first()
    assert (report.rows_received, report.rows_passed, report.rows_quarantined) == (6, 4, 2)
    clean = str(tmp_path / "clean")
    pipeline.run(spark, landed, clean, "first", until="20260826_235959")
    pipeline.run(spark, landed, clean, "fourth")
    assert _tables(spark, root) == _tables(spark, clean)


def test_a_failed_run_can_be_repeated_until_the_next(spark, tmp_path, landed, monkeypatch):
    root = str(tmp_path / "w")
    with monkeypatch.context() as broken:
        broken.setattr(pipeline, "write_report", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            pipeline.run(spark, landed, root, "a", until="20260826_235959")
    assert pipeline.run(spark, landed, root, "a", until="20260826_235959").first().rows_received == 12
    assert pipeline.run(spark, landed, root, "b").first().rows_received == 6


def test_a_window_given_by_hand_does_not_hide_failed_landings(spark, tmp_path, landed, monkeypatch):
    root = str(tmp_path / "w")
    _known(spark, root, "tron", "bitcoin")
    with monkeypatch.context() as broken:
        broken.setattr(pipeline, "load", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            pipeline.run(spark, landed, root, "a", until="20260826_235959")
    pipeline.run(spark, landed, root, "by hand", since="20260828_000000")
    pipeline.run(spark, landed, root, "b")
    assert _tables(spark, root)[1] == _clean(spark, landed, str(tmp_path / "clean"))[1]


def test_unreadable_payloads_are_quarantined_with_their_text(spark, tmp_path):
    folder = tmp_path / "raw"
    write_snapshot(folder, "20260826_070001", [coin("bitcoin", 100)])
    write_history(folder, "bitcoin", "20260826_070002", _days(20, 21, 80.0))
    (folder / "history_b_20260826_070003.json").write_text('{"prices": [[1, 2]], "market')
    (folder / "history_c_20260826_070004.json").write_text('{"error": "too many requests"}')
    (folder / "snapshot_markets_20260826_070005.json").write_text('[{"id": "bitcoin", "curr')
    write_snapshot(folder, "latest", [coin("tron", 7)])
    root = str(tmp_path / "w")
    report = pipeline.run(spark, str(folder), root, "one").first()
    assert (report.rows_received, report.rows_passed, report.rows_quarantined) == (7, 3, 4)
    assert rows(Warehouse(spark, root).quarantine(), "coin_id", "reason", "rejected") == sorted(
        [
            ("b", "Unreadable payload", 'history_b_20260826_070003.json: {"prices": [[1, 2]], "market'),
            ("c", "Unreadable payload", "history_c_20260826_070004.json: no prices"),
            (None, "Unreadable payload", 'snapshot_markets_20260826_070005.json: [{"id": "bitcoin", "curr'),
            ("tron", "Schema validation failed: not_nullable", None),
        ],
        key=repr,
    )


def test_only_an_input_with_unreadable_payloads_is_parsed_again(spark, tmp_path, landed, monkeypatch):
    again, read = [], pipeline.unreadable_rows

    def noted(payloads, source):
        again.append(source)
        return read(payloads, source)

    monkeypatch.setattr(pipeline, "unreadable_rows", noted)
    root = str(tmp_path / "w")
    pipeline.run(spark, landed, root, "one", until="20260826_235959")
    assert again == []
    for name in ("b", "c"):
        (tmp_path / "raw" / f"history_{name}_20260829_070003.json").write_text('{"prices": [[1, 2]], "market')
    report = pipeline.run(spark, landed, root, "two").first()
    assert again == [1]
    assert (report.rows_received, report.rows_passed, report.rows_quarantined) == (8, 4, 4)
    counted = dict(rows(Warehouse(spark, root).metrics().where("run_id = 'two' AND step = 'batch'"), "metric", "value"))
    assert (counted["historical_valid"], counted["historical_failed"], counted["current_failed"]) == (3, 2, 1)


def test_a_counter_of_an_empty_branch_is_no_zero(spark, tmp_path):
    from pyspark.sql import Observation
    from pyspark.sql import functions as F

    from tidemark.scale import none_counted

    path = str(tmp_path / "t")
    spark.range(9).write.parquet(path)
    for bound, many, expected in ((5, "id >= 0", False), (50, "id >= 0", True)):
        seen = Observation()
        watched = spark.read.parquet(path).where(many).observe(seen, F.count_if(F.col("id") > bound).alias("n"))
        watched.groupBy("id").count().write.parquet(f"{path}-{bound}")
        assert none_counted(seen, "n") is expected
    seen = Observation()
    watched = spark.read.parquet(path).where("id > 100").observe(seen, F.count_if(F.col("id") > 5).alias("n"))
    watched.groupBy("id").count().join(spark.read.parquet(path), "id").write.parquet(f"{path}-empty")
    assert none_counted(seen, "n") is False


def test_days_are_reduced_without_a_sort(spark, tmp_path):
    from tidemark.sources import landing

    write_history(tmp_path / "raw", "tron", "20260826_070002", _days(20, 22, 5.0))
    points = landing.history_points(landing.read_history_files(spark, str(tmp_path / "raw")))
    points.write.parquet(str(tmp_path / "points"))
    days = pipeline.history_days(spark.read.parquet(str(tmp_path / "points")))
    assert "SortAggregate" not in plan(days) and days.count() == 3


@pytest.mark.skipif("LANDED_RECORD" not in os.environ, reason="no recorded landing folder given")
def test_replay_of_a_recorded_landing(spark, tmp_path):
    """Row counts of recorded runs: (window, mark before, rows received).

    Fixed values: windows, marks, counts and the three rows are those of the record.
    """
    from pyspark.sql import functions as F

    from tidemark.operators import series
    from tidemark.sources import landing

    folder = os.environ["LANDED_RECORD"]
    runs = [
        ("20260828_1208", "20260828_1210", "2026-08-26", 12),
        ("20260831_1050", "20260831_1051", "2026-08-28", 16),
        ("20260831_1121", "20260831_1122", "2026-08-31", 4),
        ("20260902_0111", "20260902_0112", "2026-08-31", 8),
        ("20260902_1231", "20260902_1232", "2026-09-02", 4),
        ("20260906_2346", "20260906_2347", "2026-09-02", 20),
    ]
    for since, until, mark, received in runs:
        snapshot = landing.between(landing.read_snapshot_files(spark, folder), since, until)
        history = landing.between(landing.read_history_files(spark, folder), since, until)
        marks = snapshot.select(F.col("id").alias("coin_id"), F.lit(day(mark)).alias("high_water_mark"))
        batch = pipeline.ingest(snapshot, history, marks)
        flagged = pipeline.flag_batch(batch)
        assert flagged.count() == received and flagged.where("status != 'valid'").isEmpty()
    last = {(r.coin_id, str(r.date)): tuple(r)[2:5] for r in batch.historical.collect()}
    assert last["bitcoin", "2026-09-03"] == (81142.27254272846, 1629262506336.3384, 39226290737.77185)
    assert last["bitcoin", "2026-09-06"] == (79797.87269902077, 1602367457498.5823, 18719868248.031364)
    assert last["tether", "2026-09-06"] == (0.999936864689742, 183380804527.08908, 42660157202.86352)
    assert series.calendar_gaps(batch.historical).isEmpty()
