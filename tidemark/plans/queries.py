"""Named queries: every operator applied to the whole of the given tables.

Floating results are rounded to 6 places for comparison across engines.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import mart_store, marts, quality, series, store
from tidemark.plans import catalogue, pipeline, views
from tidemark.scale import materialise, shared_dir
from tidemark.schemas import DIM_KEY, FACT_KEY, MEASURES
from tidemark.sources import landing, tables
from tidemark.sources.tables import TICK_ORDER
from tidemark.streaming import compact, ingest

Query = Callable[[SparkSession, str], DataFrame]

AS_OF = dt.date(2024, 2, 1)
_STAMP = "20240201_100000"
_FIVE = [*FACT_KEY, *MEASURES]
# The start of 16 January 2024: about half of the events are earlier.
_HALF_MS = 1_705_363_200_000


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in columns})


def _mart(mart: Callable[[DataFrame], DataFrame], *columns: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return rounded(mart(tables.supplier_daily(spark, sf_dir)), *columns)

    return query


def daily_last(spark, sf_dir):
    ticks = tables.corrupted_ticks(spark, sf_dir)
    return rounded(series.daily_last(ticks, TICK_ORDER), "market_cap")


def series_align(spark, sf_dir):
    ticks = tables.user_ticks(spark, sf_dir)
    hourly = ticks.select(
        "coin_id",
        "date",
        F.hour("timestamp").alias("hour"),
        F.col("timestamp").alias("at"),
        F.col("price").alias("value"),
        "event_type",
    ).withColumn("timestamp", F.unix_date("date").cast("long") * 24 + F.col("hour"))

    def of(*event_types: str) -> DataFrame:
        return hourly.where(F.col("event_type").isin(*event_types))

    rest = ~F.col("event_type").isin("view", "error", "purchase", "signup")
    keys = ["coin_id", "timestamp"]
    return series.align(of("view", "error"), of("purchase", "signup"), hourly.where(rest), keys, "at")


def duplicates(spark, sf_dir):
    ticks = tables.plain(tables.supplier_ticks(spark, sf_dir))
    return rounded(quality.duplicates(ticks), "market_cap")


def high_water_mark(spark, sf_dir):
    users = tables.user_daily(spark, sf_dir)
    tracked = tables.customer_dim(spark, sf_dir)
    return series.high_water_marks(users, tracked)


def _marks(spark, sf_dir):
    """Marks as left by a store that holds each user's purchases only."""
    bought = tables.user_ticks(spark, sf_dir).where(F.col("event_type") == "purchase")
    return series.high_water_marks(bought, tables.customer_dim(spark, sf_dir))


def incremental_batch(spark, sf_dir):
    marks = materialise(_marks(spark, sf_dir), "marks")
    return series.newer_than_marks(tables.user_daily(spark, sf_dir), marks)


def fetch_plan(spark, sf_dir):
    return series.fetch_plan(_marks(spark, sf_dir), AS_OF)


def tracked_filter(spark, sf_dir):
    return series.only_tracked(
        tables.user_daily(spark, sf_dir), tables.supplier_dim(spark, sf_dir)
    )


def gaps(spark, sf_dir):
    return series.calendar_gaps(tables.user_daily(spark, sf_dir))


def gaps_supplier(spark, sf_dir):
    return series.calendar_gaps(tables.supplier_ticks(spark, sf_dir))


def anomalies(spark, sf_dir):
    return quality.anomalies(tables.user_daily(spark, sf_dir), bounded=True)


def anomalies_with_history(spark, sf_dir):
    """Supplier days from 1998 on, judged against the stored days before."""
    daily = tables.supplier_daily(spark, sf_dir).select("coin_id", "date", "price")
    start = F.lit(dt.date(1998, 1, 1))
    return quality.anomalies(
        daily.where(F.col("date") >= start),
        history=daily.where(F.col("date") < start),
        bounded=True,
    )


def _current_ticks(spark, sf_dir):
    """Ticks with their dimension, and some of every column missing, negative or unreadable."""

    def every(n: int):
        return F.col("l_orderkey") % n == 0

    ticks = tables.corrupted_ticks(spark, sf_dir)
    dims = tables.supplier_dim(spark, sf_dir)
    price = F.when(every(71) & F.col("price").isNotNull(), "n/a").otherwise(F.col("price").cast("string"))
    return ticks.join(dims, "coin_id", "left").withColumns(
        {
            "price": price,
            "symbol": F.when(~every(89), F.col("symbol")),
            "name": F.when(~every(83), F.col("name")),
            "volume": F.when(every(79), -F.col("volume")).otherwise(F.col("volume")),
            "date": F.when(~every(73), F.col("date")),
            "coin_id": F.when(~every(67), F.col("coin_id")),
        }
    )


def schema_check_current(spark, sf_dir):
    checked = quality.schema_check(_current_ticks(spark, sf_dir), "current", TICK_ORDER)
    return _check_summary(checked)


def schema_check_history(spark, sf_dir):
    ticks = tables.corrupted_ticks(spark, sf_dir)
    return _check_summary(quality.schema_check(ticks, "historical", TICK_ORDER))


def _check_summary(checked):
    """Rows per coin, check count and first check."""
    first = F.get("failures", F.lit(0))
    return (
        checked.groupBy(
            "coin_id",
            F.size("failures").cast("long").alias("failed_checks"),
            F.concat_ws(":", first["column"], first["check"]).alias("first_check"),
        )
        .agg(F.count(F.lit(1)).alias("row_count"))
    )


def failure_cases(spark, sf_dir):
    cases = quality.failure_cases(tables.corrupted_ticks(spark, sf_dir), "historical", TICK_ORDER)
    value = F.round(F.col("value").cast("double"), 6)
    return cases.withColumn("value", value)


def _flagged(spark, sf_dir, reason_mode="row"):
    ticks = tables.corrupted_ticks(spark, sf_dir)
    return quality.flag(ticks, "historical", TICK_ORDER, reason_mode=reason_mode)


def valid_rows(spark, sf_dir):
    valid = quality.Split(_flagged(spark, sf_dir)).valid
    return rounded(valid.select(*_FIVE), "market_cap")


def quarantine_rows(spark, sf_dir):
    quarantined = quality.Split(_flagged(spark, sf_dir)).quarantined
    return rounded(store.quarantine_rows(quarantined), "market_cap")


def quarantine_batch_reason(spark, sf_dir):
    quarantined = quality.Split(_flagged(spark, sf_dir, "batch")).quarantined
    return quarantined.groupBy("reason").agg(F.count(F.lit(1)).alias("row_count"))


def dq_report(spark, sf_dir):
    flagged = materialise(_flagged(spark, sf_dir), "batch")
    parts = quality.Split(flagged)
    return quality.report(flagged, parts.gaps, quality.repeated_keys(parts.survivors))


def _halves(spark, sf_dir):
    """Shipped lines as the stored fact, open lines as the incoming batch."""
    ticks = tables.supplier_ticks(spark, sf_dir)
    shipped = ticks.where(F.col("l_linestatus") == "F")
    opened = ticks.where(F.col("l_linestatus") == "O")
    return series.daily_last(shipped, TICK_ORDER), opened.select(*_FIVE, *TICK_ORDER)


def upsert_fact(spark, sf_dir):
    stored, batch = _halves(spark, sf_dir)
    return rounded(store.merge_latest(stored, batch, FACT_KEY, TICK_ORDER), "market_cap")


def _dim_batch(spark, sf_dir):
    ticks = tables.supplier_ticks(spark, sf_dir)
    name = F.concat(F.lit("Part "), F.col("l_partkey").cast("string"))
    return ticks.withColumns({"symbol": F.lower("l_returnflag"), "name": name})


def upsert_dim(spark, sf_dir):
    batch = _dim_batch(spark, sf_dir).select("coin_id", "symbol", "name", "date", *TICK_ORDER)
    dim = tables.customer_dim(spark, sf_dir)
    return store.merge_latest(dim, batch, DIM_KEY, ["date", *TICK_ORDER])


def _scratch(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def load_snapshot(spark, sf_dir):
    """Stored tables after a snapshot load: every fact row with its dimension."""
    warehouse = store.Warehouse(spark, _scratch(spark, "warehouse"))
    stored, _ = _halves(spark, sf_dir)
    warehouse.upsert_fact(stored, [])
    opened = _dim_batch(spark, sf_dir).where(F.col("l_linestatus") == "O")
    warehouse.load_snapshot(opened, ["date", *TICK_ORDER])
    loaded = warehouse.fact_price().join(warehouse.dim_coin(), "coin_id", "left")
    return rounded(loaded, "market_cap")


def orphan_facts(spark, sf_dir):
    return store.orphan_facts(tables.user_daily(spark, sf_dir), tables.supplier_dim(spark, sf_dir))


def constraint_audit(spark, sf_dir):
    return store.constraint_audit(
        tables.user_ticks(spark, sf_dir), tables.supplier_dim(spark, sf_dir)
    )


def table_counts(spark, sf_dir):
    return store.table_counts(
        {
            "dim_coin": tables.supplier_dim(spark, sf_dir),
            "fact_price": tables.supplier_daily(spark, sf_dir),
            "quarantine": quality.Split(_flagged(spark, sf_dir)).quarantined,
        }
    )


def scan_snapshot(spark, sf_dir):
    path = _scratch(spark, "landing")
    landing.land(tables.snapshot_payloads(spark, sf_dir), path, landing.SNAPSHOT_DATASET, _STAMP)
    rows = landing.snapshot_rows(landing.read_snapshot_table(spark, path), as_of="utc")
    return rounded(rows.drop("ingest_ts"), "market_cap")


def history_flatten(spark, sf_dir):
    path = _scratch(spark, "landing")
    landing.land(tables.history_payloads(spark, sf_dir), path, landing.HISTORY_DATASET, _STAMP)
    points = landing.history_points(landing.read_history_table(spark, path))
    return rounded(pipeline.history_days(points), "market_cap")


def _land_both(spark, sf_dir, snapshot):
    path = _scratch(spark, "landing")
    landing.land(snapshot, path, landing.SNAPSHOT_DATASET, _STAMP)
    landing.land(tables.history_payloads(spark, sf_dir), path, landing.HISTORY_DATASET, _STAMP)
    return path


def raw_landing(spark, sf_dir):
    """Both stored datasets: rows, and the sum of what their payloads hold."""
    return _landed_sums(spark, _land_both(spark, sf_dir, tables.snapshot_payloads(spark, sf_dir)))


def _landed_sums(spark, path):
    first = F.lit(0)
    history = F.get(F.get("prices", first), F.lit(1)) + F.get(F.get("total_volumes", first), F.lit(1))
    history = history + F.coalesce(F.get(F.get("market_caps", first), F.lit(1)), F.lit(0.0))
    contents = {
        landing.SNAPSHOT_DATASET: (landing.read_snapshot_table(spark, path), F.col("current_price")),
        landing.HISTORY_DATASET: (landing.read_history_table(spark, path), history),
    }
    counted = [
        rows.groupBy(F.lit(name).alias("dataset"), "ingest_ts").agg(
            F.count(F.lit(1)).alias("row_count"), F.round(F.sum(value), 2).alias("value_sum")
        )
        for name, (rows, value) in contents.items()
    ]
    return counted[0].unionByName(counted[1])


def compacted_landing(spark, sf_dir):
    """The sums of ``raw_landing`` over landings in many small files, compacted in two runs and one in vain."""
    path, compacted, checkpoint = (_scratch(spark, label) for label in ("landing", "compacted", "compaction"))
    inputs = {
        landing.SNAPSHOT_DATASET: tables.snapshot_payloads(spark, sf_dir),
        landing.HISTORY_DATASET: tables.history_payloads(spark, sf_dir),
    }
    for dataset, payloads in inputs.items():
        landing.land(payloads.repartition(40), path, dataset, _STAMP, "gzip")
        compact.compact(spark, path, compacted, checkpoint, layout="table").awaitTermination()
    compact.compact(spark, path, compacted, checkpoint, layout="table").awaitTermination()
    return _landed_sums(spark, compacted)


def unreadable_payloads(spark, sf_dir):
    """What becomes of every event as a payload, when some are cut short and some hold no prices."""
    path = _scratch(spark, "landing")
    key = F.col("event_id")
    head = F.concat(F.lit('{"coin_id":"'), F.col("user_id").cast("string"), F.lit('",'))
    whole = F.concat(head, F.lit('"prices":[[1700000000000.0,1.5]],"market_caps":[],"total_volumes":[]}'))
    cut = F.concat(head, F.lit('"prices":[[1700000000000.0,'))
    text = F.when(key % 13 == 0, cut).when(key % 17 == 0, F.concat(head, F.lit('"error":"busy"}'))).otherwise(whole)
    lines = tables.table(spark, sf_dir, "events").select(text.alias("value"))
    lines.write.text(f"{path}/dataset={landing.HISTORY_DATASET}/ingest_ts={_STAMP}")
    payloads = landing.read_history_table(spark, path)
    rejected = F.regexp_replace("rejected", "^[^:]*: ", "")
    lost = pipeline.unreadable_rows(payloads, 1).select(rejected.alias("rejected"), "reason", "status")
    kept = landing.readable(payloads).select(
        F.lit(None).cast("string").alias("rejected"), F.lit(None).cast("string").alias("reason"), F.lit("read").alias("status")
    )
    return lost.unionByName(kept).groupBy("rejected", "reason", "status").agg(F.count(F.lit(1)).alias("row_count"))


# The computed columns of each mart view, and the digits to which their sums agree.
_MART_SUMS = {
    "daily_return": ("daily_return", 4),
    "moving_averages": ("moving_avg_7d + moving_avg_30d", 2),
    "rolling_volatility": ("volatility_30d", 3),
    "max_drawdown": ("running_peak + drawdown", 2),
    "volatility_ranking": ("volatility_rank", 0),
    "return_30d": ("return_30d", 4),
}


def mart_check(spark, sf_dir):
    """Rows and sums of the computed columns of each registered mart view, read by name."""
    fact = tables.supplier_daily(spark, sf_dir)
    flagged = quality.flag(fact, "historical", bounded=True)
    views.register(fact, tables.supplier_dim(spark, sf_dir), quality.Split(flagged).quarantined)
    views.check(spark)
    return spark.sql(_mart_sums(""))


def _mart_sums(database: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{view}' AS view_name, count(*) AS row_count, count({value}) AS filled, "
        f"round(sum(CAST({value} AS DOUBLE)), {digits}) AS total FROM {database}{view}"
        for view, (value, digits) in _MART_SUMS.items()
    )


def mart_check_catalogue(spark, sf_dir):
    """The same through the views of the catalogue, in a session that has built none of them."""
    warehouse = store.Warehouse(spark, _scratch(spark, "warehouse"))
    warehouse.upsert_dim(tables.supplier_dim(spark, sf_dir), [])
    warehouse.upsert_fact(tables.supplier_daily(spark, sf_dir), [])
    flagged = quality.Split(_flagged(spark, sf_dir))
    warehouse.append_quarantine(flagged.quarantined, "first")
    database = f"mart_{uuid.uuid4().hex}"
    catalogue.publish(warehouse, database)
    other = spark.newSession()
    catalogue.check(other, database, views.REQUIRED)
    return other.sql(_mart_sums(f"{database}."))


def pipeline_run(spark, sf_dir):
    """A whole run: customers as the snapshot, events as the history."""
    path = _land_both(spark, sf_dir, tables.customer_payloads(spark, sf_dir))
    return pipeline.run(
        spark, path, _scratch(spark, "warehouse"), "first", layout="table", as_of="utc"
    )


def run_metrics(spark, sf_dir):
    """What a whole run counted at each step, read from the table of metrics."""
    path, root = _land_both(spark, sf_dir, tables.customer_payloads(spark, sf_dir)), _scratch(spark, "warehouse")
    pipeline.run(spark, path, root, "first", layout="table", as_of="utc")
    return store.Warehouse(spark, root).metrics()


def coin_history(spark, sf_dir):
    """One supplier's days; the number is compared as a number, so the filter reaches the scan."""
    fact = tables.supplier_daily(spark, sf_dir, only=7)
    return rounded(marts.coin_history(fact, "7"), "market_cap")


def load_history(spark, sf_dir):
    """The stored fact after a history load over shipped lines."""
    warehouse = store.Warehouse(spark, _scratch(spark, "warehouse"))
    stored, opened = _halves(spark, sf_dir)
    warehouse.upsert_fact(stored, [])
    warehouse.load_history(opened, TICK_ORDER)
    return rounded(warehouse.fact_price(), "market_cap")


_SECOND_STAMP = "20240202_100000"


def pipeline_second_run(spark, sf_dir):
    """Stored facts after a run over the first half of the events, one over the rest, and its rerun."""
    path, root = _scratch(spark, "landing"), _scratch(spark, "warehouse")
    snapshot = tables.customer_payloads(spark, sf_dir)
    snapshot = snapshot.withColumn("last_updated", F.lit("2023-12-31T00:00:00.000Z"))
    landing.land(snapshot, path, landing.SNAPSHOT_DATASET, _STAMP)
    early = F.get(F.get("prices", F.lit(0)), F.lit(0)) < _HALF_MS
    history = tables.history_payloads(spark, sf_dir)
    landing.land(history.where(early), path, landing.HISTORY_DATASET, _STAMP)
    pipeline.run(spark, path, root, "first", layout="table", as_of="utc")
    landing.land(history.where(~early), path, landing.HISTORY_DATASET, _SECOND_STAMP)
    for _ in range(2):
        pipeline.run(spark, path, root, "second", layout="table", as_of="utc")
    return rounded(store.Warehouse(spark, root).fact_price(), "market_cap")


def pipeline_after_failure(spark, sf_dir):
    """Stored facts after a run that is refused (history of coins without a dimension row) and the next one."""
    path, root = _scratch(spark, "landing"), _scratch(spark, "warehouse")
    early = F.get(F.get("prices", F.lit(0)), F.lit(0)) < _HALF_MS
    history = tables.history_payloads(spark, sf_dir)
    landing.land(history.where(early), path, landing.HISTORY_DATASET, _STAMP)
    try:
        pipeline.run(spark, path, root, "first", layout="table", as_of="utc")
    except ValueError as refused:
        if "no dimension row" not in str(refused):
            raise
    landing.land(history.where(~early), path, landing.HISTORY_DATASET, _SECOND_STAMP)
    snapshot = tables.customer_payloads(spark, sf_dir)
    snapshot = snapshot.withColumn("last_updated", F.lit("2023-12-31T00:00:00.000Z"))
    landing.land(snapshot, path, landing.SNAPSHOT_DATASET, _SECOND_STAMP)
    pipeline.run(spark, path, root, "second", layout="table", as_of="utc")
    return rounded(store.Warehouse(spark, root).fact_price(), "market_cap")


def stream_load(spark, sf_dir):
    """Stored facts after a stream over both inputs ran twice, the second time over the rest and what landed again."""
    path, root, checkpoint = (_scratch(spark, label) for label in ("landing", "warehouse", "stream"))
    snapshot = tables.customer_payloads(spark, sf_dir)
    snapshot = snapshot.withColumn("last_updated", F.lit("2023-12-31T00:00:00.000Z"))
    early = F.get(F.get("prices", F.lit(0)), F.lit(0)) < _HALF_MS
    history = tables.history_payloads(spark, sf_dir)
    for stamp, half in ((_STAMP, early), (_SECOND_STAMP, ~early)):
        landing.land(snapshot, path, landing.SNAPSHOT_DATASET, _STAMP)
        landing.land(history.where(early), path, landing.HISTORY_DATASET, _STAMP)
        landing.land(history.where(half), path, landing.HISTORY_DATASET, stamp)
        ingest.stream_load(spark, path, root, checkpoint, layout="table", as_of="utc").awaitTermination()
    return rounded(store.Warehouse(spark, root).fact_price(), "market_cap")


def _ticks(spark, sf_dir):
    return tables.supplier_ticks(spark, sf_dir).select("coin_id", "date", "price", *TICK_ORDER)


def running_peak_ticks(spark, sf_dir):
    return rounded(marts.drawdown_ticks(_ticks(spark, sf_dir), ["date", *TICK_ORDER]), "drawdown")


def moving_averages_ticks(spark, sf_dir):
    found = marts.trailing_ticks(_ticks(spark, sf_dir), ["date", *TICK_ORDER])
    return rounded(found, "moving_avg_7d", "moving_avg_30d", "daily_return", "return_30d")


def _two_loads(warehouse, spark, sf_dir):
    """Load shipped lines, then open ones; what each load changed."""
    stored, opened = _halves(spark, sf_dir)
    yield warehouse.upsert_fact(stored, [])
    yield warehouse.upsert_fact(opened, TICK_ORDER)


def volatility_bucketed(spark, sf_dir):
    """Rolling volatility on the stored fact bucketed by coin, after two loads."""
    root = _scratch(spark, "warehouse")
    warehouse = store.BucketedWarehouse(spark, root, name=f"fact_{uuid.uuid4().hex}", buckets=8)
    for _ in _two_loads(warehouse, spark, sf_dir):
        pass
    return rounded(marts.rolling_volatility(warehouse.fact_price()), "daily_return")


def marts_incremental(spark, sf_dir):
    """All stored marts, brought up to date after each of two loads."""
    warehouse = store.Warehouse(spark, _scratch(spark, "warehouse"))
    for changed in _two_loads(warehouse, spark, sf_dir):
        mart_store.refresh(warehouse, changed)
    found = mart_store.stored_marts(warehouse)
    return rounded(found, "daily_return", "moving_avg_7d", "moving_avg_30d", "drawdown", "return_30d")


def coin_lookup(spark, sf_dir):
    """One supplier's days from the stored fact, whose row groups have a filter on the coin."""
    warehouse = store.Warehouse(spark, _scratch(spark, "warehouse"))
    warehouse.upsert_fact(tables.supplier_daily(spark, sf_dir), [])
    return rounded(marts.coin_history(warehouse.fact_price(), "7"), "market_cap")


QUERIES: dict[str, Query] = {
    "daily_last": daily_last,
    "series_align": series_align,
    "duplicates": duplicates,
    "high_water_mark": high_water_mark,
    "incremental_batch": incremental_batch,
    "fetch_plan": fetch_plan,
    "tracked_filter": tracked_filter,
    "gaps": gaps,
    "gaps_supplier": gaps_supplier,
    "anomalies": anomalies,
    "anomalies_with_history": anomalies_with_history,
    "daily_return": _mart(marts.daily_return, "daily_return"),
    "pct_change": _mart(marts.percent_change, "market_cap", "return"),
    "moving_averages": _mart(marts.moving_averages, "moving_avg_7d", "moving_avg_30d"),
    "moving_average_strict": _mart(marts.moving_average, "market_cap", "moving_average"),
    "rolling_volatility": _mart(marts.rolling_volatility, "daily_return"),
    "running_peak": _mart(marts.running_peak),
    "max_drawdown": _mart(marts.max_drawdown, "drawdown"),
    "worst_drawdown": _mart(marts.worst_drawdown, "worst_drawdown"),
    "latest_per_coin": _mart(marts.latest_per_coin, "daily_return"),
    "volatility_ranking": _mart(marts.volatility_ranking, "latest_return"),
    "return_30d": _mart(marts.return_30d, "return_30d"),
    "best_return_30d": _mart(marts.best_return_30d, "return_30d"),
    "worst_return_30d": _mart(marts.worst_return_30d, "return_30d"),
    "coverage": _mart(marts.coverage),
    "coin_history": coin_history,
    "schema_check_current": schema_check_current,
    "schema_check_history": schema_check_history,
    "failure_cases": failure_cases,
    "valid_rows": valid_rows,
    "quarantine_rows": quarantine_rows,
    "quarantine_batch_reason": quarantine_batch_reason,
    "dq_report": dq_report,
    "upsert_fact": upsert_fact,
    "upsert_dim": upsert_dim,
    "load_snapshot": load_snapshot,
    "orphan_facts": orphan_facts,
    "constraint_audit": constraint_audit,
    "table_counts": table_counts,
    "scan_snapshot": scan_snapshot,
    "history_flatten": history_flatten,
    "raw_landing": raw_landing,
    "mart_check": mart_check,
    "pipeline_run": pipeline_run,
    "unreadable_payloads": unreadable_payloads,
    "load_history": load_history,
    "pipeline_second_run": pipeline_second_run,
    "pipeline_after_failure": pipeline_after_failure,
    "stream_load": stream_load,
    "compacted_landing": compacted_landing,
    "mart_check_catalogue": mart_check_catalogue,
    "volatility_bucketed": volatility_bucketed,
    "marts_incremental": marts_incremental,
    "coin_lookup": coin_lookup,
    "run_metrics": run_metrics,
    "running_peak_ticks": running_peak_ticks,
    "moving_averages_ticks": moving_averages_ticks,
}
