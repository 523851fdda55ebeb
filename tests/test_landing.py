import datetime as dt

import pytest
from pyspark.sql import functions as F

from helpers import day, plan, rows
from payloads import coin, millis, write_history, write_snapshot
from tidemark.operators import series
from tidemark.sources import landing
from tidemark.sources.tables import epoch_millis
from tidemark.streaming.compact import compact


def test_snapshot_mixes_ints_and_floats_and_nested_fields(spark, tmp_path):
    roi = {"times": 1.5, "currency": "btc", "percentage": 150}
    write_snapshot(tmp_path, "20310305_003010", [coin("bitcoin", 61), coin("ethereum", 7.25, roi=roi)])
    objects = landing.read_snapshot_files(spark, str(tmp_path))
    assert rows(objects, "id", "roi.times") == [("bitcoin", None), ("ethereum", 1.5)]
    got = landing.snapshot_rows(objects)
    assert got.columns == ["coin_id", "symbol", "name", "price", "market_cap", "volume", "date", "ingest_ts"]
    assert rows(got) == [
        ("bitcoin", "bit", "Bitcoin", 61.0, 4400.0, 320.0, day("2031-03-05"), "20310305_003010"),
        ("ethereum", "eth", "Ethereum", 7.25, 4400.0, 320.0, day("2031-03-05"), "20310305_003010"),
    ]


def test_snapshot_day_is_local_utc_or_given(spark, tmp_path):
    write_snapshot(tmp_path, "20310305_003010", [coin("bitcoin", 1)])
    objects = landing.read_snapshot_files(spark, str(tmp_path))
    days = [rows(landing.snapshot_rows(objects, a), "date")[0][0] for a in ("landed", "utc", day("2020-02-02"))]
    assert days == [day("2031-03-05"), day("2031-03-04"), day("2020-02-02")]
    with pytest.raises(ValueError):
        landing.snapshot_rows(objects, "tomorrow")


def test_history_points_align_and_name_their_coin(spark, tmp_path):
    points = [("2026-09-01T22:00:00", 10.0), ("2026-09-01T23:59:59.999", 11), ("2026-09-02T00:00:00", 12.5)]
    caps = [[millis("2026-09-01T22:00:00"), 7], [millis("2030-01-01T00:00:00"), 9.0]]
    write_history(tmp_path, "usd-coin_x", "20310305_003011", points, caps=caps, volumes=[])
    write_snapshot(tmp_path, "20310305_003010", [coin("bitcoin", 1)])
    payloads = landing.read_history_files(spark, str(tmp_path))
    got = landing.history_points(payloads)
    assert rows(got, "coin_id", "date", "price", "market_cap", "volume") == [
        ("usd-coin_x", day("2026-09-01"), 10.0, 7.0, None),
        ("usd-coin_x", day("2026-09-01"), 11.0, None, None),
        ("usd-coin_x", day("2026-09-02"), 12.5, None, None),
    ]
    daily = series.daily_last(got, ["timestamp", "ingest_ts"])
    assert rows(daily, "date", "price", "market_cap") == [
        (day("2026-09-01"), 11.0, 7.0),
        (day("2026-09-02"), 12.5, None),
    ]


def test_history_points_need_no_lambda_and_keep_odd_arrays(spark):
    schema = ", ".join(f"{c} array<array<double>>" for c in ("prices", "market_caps", "total_volumes"))
    payloads = spark.createDataFrame(
        [
            ("a", "20310305_003011", [[1.0, 5.0], None, [2.0], [3.0, 7.0], [3.0, 8.0], []], None, [[3.0, 1.0], [4.0, 9.0]]),
            ("b", "20310305_003011", None, [[1.0, 5.0]], []),
        ],
        f"coin_id string, ingest_ts string, {schema}",
    )
    points = landing.history_points(payloads)
    assert "lambda" not in plan(points)
    assert rows(points, "coin_id", "timestamp", "price", "market_cap", "volume") == [
        ("a", 1, 5.0, None, None),
        ("a", 2, None, None, None),
        ("a", 3, 8.0, None, 1.0),
    ]


def test_epoch_millis_of_any_time_without_decimals(spark):
    texts = ["1969-12-31T23:59:59.999999", "1970-01-01T00:00:00.000999", "1899-12-31T12:00:00.0015", "2024-02-29T23:59:59.9989", None]
    times = spark.createDataFrame([(t,) for t in texts], "t string").select("t", F.col("t").cast("timestamp_ntz").alias("ts"))
    got = times.select("t", epoch_millis(F.col("ts")).alias("ms"))
    assert "decimal" not in plan(got)
    start = dt.datetime(1970, 1, 1)
    wanted = [None if t is None else (dt.datetime.fromisoformat(t) - start) // dt.timedelta(milliseconds=1) for t in texts]
    assert rows(got) == sorted(zip(texts, wanted), key=repr)


def test_later_payload_wins_for_the_same_point(spark, tmp_path):
    write_history(tmp_path, "a", "20310305_003011", [("2026-09-01T22:00:00", 10.0)])
    write_history(tmp_path, "a", "20310306_003011", [("2026-09-01T22:00:00", 20.0)])
    points = landing.history_points(landing.read_history_files(spark, str(tmp_path)))
    assert rows(series.daily_last(points, ["timestamp", "ingest_ts"]), "price") == [(20.0,)]
    first = landing.between(landing.read_history_files(spark, str(tmp_path)), None, "20310305_235959")
    assert rows(landing.history_points(first), "price") == [(10.0,)]


def test_empty_payloads(spark, tmp_path):
    write_history(tmp_path, "a", "20310305_003011", [])
    write_snapshot(tmp_path, "20310305_003010", [])
    assert landing.history_points(landing.read_history_files(spark, str(tmp_path))).isEmpty()
    assert landing.snapshot_rows(landing.read_snapshot_files(spark, str(tmp_path))).isEmpty()


def test_landing_table_keeps_payloads_and_replaces_a_repeated_stamp(spark, tmp_path):
    files, table = tmp_path / "files", str(tmp_path / "table")
    write_snapshot(files, "20310305_003010", [coin("bitcoin", 1), coin("tron", 0.3)])
    write_history(files, "tron", "20310305_003011", [("2026-09-01T22:00:00", 0.25)])
    objects = landing.read_snapshot_files(spark, str(files))
    payloads = landing.read_history_files(spark, str(files))
    for _ in range(2):
        landing.land(objects, table, landing.SNAPSHOT_DATASET, "20310305_003010")
        landing.land(payloads, table, landing.HISTORY_DATASET, "20310305_003011")
    landing.land(objects, table, landing.SNAPSHOT_DATASET, "20310306_003010")
    again = landing.read_snapshot_table(spark, table)
    assert rows(again.groupBy("ingest_ts").count()) == [("20310305_003010", 2), ("20310306_003010", 2)]
    kept = again.where("ingest_ts = '20310305_003010'")
    assert rows(landing.snapshot_rows(kept)) == rows(landing.snapshot_rows(objects))
    stored = landing.read_history_table(spark, table)
    assert rows(landing.history_points(stored)) == rows(landing.history_points(payloads))
    pruned = again.where(F.col("ingest_ts") == "20310306_003010")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(dataset" in pruned and "ingest_ts" in pruned.split("PartitionFilters")[1]


def _files(folder):
    return [f for f in folder.rglob("part-*") if f.suffix == ".json"]


def test_compaction_loses_and_doubles_nothing(spark, tmp_path):
    raw, table, checkpoint = tmp_path / "raw", tmp_path / "table", str(tmp_path / "c")

    def compacted():
        compact(spark, str(raw), str(table), checkpoint).awaitTermination()
        snapshots, histories = (
            r(spark, str(table)) for r in (landing.read_snapshot_table, landing.read_history_table)
        )
        points = landing.history_points(histories).drop("ingest_ts")
        return rows(landing.snapshot_rows(snapshots)), rows(points), rows(landing.unreadable(histories))

    days = [("2026-08-20T03:00:00", 1.0), ("2026-08-20T21:00:00", None)]
    write_snapshot(raw, "20260820_070001", [coin("c0", 1.0), coin("c1", None)])
    for i in range(20):
        write_history(raw, f"c{i}", "20260826_070002", days, caps=[])
    (raw / "history_x_20260826_070002.json").write_text('{"prices":\n [[17')
    first = compacted()
    assert [len(part) for part in first] == [2, 40, 1] and len(_files(table)) <= 4
    assert first[2][0][2] == 'history_x_20260826_070002.json: {"prices":\n [[17'
    assert compacted() == first
    # The checkpoint loses its last commit: the batch is done again.
    (tmp_path / "c" / "commits" / "0").unlink()
    (tmp_path / "c" / "commits" / ".0.crc").unlink(missing_ok=True)
    assert compacted() == first
    write_history(raw, "late", "20260826_070002", days, caps=[])
    assert [len(part) for part in compacted()] == [2, 42, 1]


def test_compacted_files_are_compressed_and_written_once(spark, tmp_path):
    path, table = str(tmp_path / "landed"), str(tmp_path / "compacted")
    payloads = spark.range(3000).select(
        F.format_string("coin%d", "id").alias("coin_id"),
        F.array(F.array(F.col("id").cast("double"), F.lit(1.5))).alias("prices"),
    )
    landing.land(payloads.repartition(6), path, landing.HISTORY_DATASET, "20260826_070001")
    copies = set((tmp_path / "..").resolve().parent.rglob("payloads-*"))
    compact(spark, path, table, str(tmp_path / "checkpoint"), layout="table").awaitTermination()
    assert set((tmp_path / "..").resolve().parent.rglob("payloads-*")) == copies

    def files(folder):
        return [f for f in (tmp_path / folder).rglob("part-*.json*")]

    written, landed = (sum(f.stat().st_size for f in files(folder)) for folder in ("compacted", "landed"))
    assert all(f.name.endswith(".json.gz") for f in files("compacted")) and written < 0.5 * landed
    read = landing.read_history_table(spark, table)
    assert read.count() == 3000 and read.select("coin_id").distinct().count() == 3000
    landing.land(payloads.limit(5), path, landing.HISTORY_DATASET, "20260827_070001", "gzip")
    assert landing.read_history_table(spark, path).where("ingest_ts = '20260827_070001'").count() == 5
