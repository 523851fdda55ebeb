"""The whole run: marks, landed payloads, validation, keyed loads, marts, report."""

from __future__ import annotations

import datetime as dt
import logging
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.expressions import packed, stamp_number
from tidemark.operators import marts, quality, series
from tidemark.operators.store import DONE, OVERTAKEN, Warehouse, orphan_facts
from tidemark.plans import views
from tidemark.scale import materialise, none_counted, temporary
from tidemark.schemas import FACT_KEY, MEASURES
from tidemark.sources import landing

logger = logging.getLogger(__name__)

# Rows of one run are ordered by source: history comes after the snapshot and wins.
_SNAPSHOT, _HISTORY = 0, 1
_ORDER = ["source", "landed"]


class Ingested(NamedTuple):
    current: DataFrame
    historical: DataFrame


def ingest(
    snapshot_objects: DataFrame,
    history_payloads: DataFrame,
    marks: DataFrame,
    as_of: dt.date | str = "landed",
    tracked: Sequence[str] | None = None,
) -> Ingested:
    """Both inputs of a run: snapshot rows, and history days newer than the marks."""
    current = landing.snapshot_rows(snapshot_objects, as_of)
    if tracked is not None:
        current = series.only_tracked(current, tracked)
        history_payloads = series.only_tracked(history_payloads, tracked)
    points = landing.history_points(history_payloads)
    # Reduced to days first: what meets the marks then has few rows per coin.
    days = history_days(points.withColumn("landed", stamp_number(F.col("ingest_ts"))), ["landed"])
    landed = F.col("landed").cast("string")
    stamp = F.concat(F.substring(landed, 1, 8), F.lit("_"), F.substring(landed, 9, 6))
    return Ingested(
        current.withColumnRenamed("ingest_ts", "landed"),
        series.newer_than_marks(days, marks).withColumn("landed", stamp),
    )


def history_days(points: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """The last values of each day by timestamp, then by landing stamp."""
    order = packed(F.col("timestamp"), stamp_number(F.col("ingest_ts")))
    return series.daily_last(points, [order], [*MEASURES, *keep])


def unreadable_rows(payloads: DataFrame, source: int) -> DataFrame:
    """Payloads that cannot be read as failed rows of the batch, with their text."""
    return landing.unreadable(payloads).select(
        "coin_id",
        *[F.lit(None).cast(kind).alias(c) for c, kind in (("date", "date"), *((m, "double") for m in MEASURES))],
        F.col("ingest_ts").alias("landed"),
        F.lit("failed").alias("status"),
        F.lit(landing.UNREADABLE).alias("reason"),
        "rejected",
        F.lit(source).alias("source"),
    )


def flag_batch(batch: Ingested, reason_mode: str = "row") -> DataFrame:
    """Both inputs validated, in one frame ordered by ``source`` and ``landed``."""
    current = quality.flag(batch.current, "current", ["landed"], reason_mode=reason_mode)
    # History holds one row per coin and day, so no coin can have too many.
    historical = quality.flag(
        batch.historical, "historical", ["landed"], reason_mode=reason_mode, bounded=True
    )
    return current.withColumn("source", F.lit(_SNAPSHOT)).unionByName(
        historical.withColumn("source", F.lit(_HISTORY)), allowMissingColumns=True
    )


def flag_payloads(
    snapshots: DataFrame,
    histories: DataFrame,
    marks: DataFrame,
    as_of: dt.date | str = "landed",
    tracked: Sequence[str] | None = None,
    reason_mode: str = "row",
) -> DataFrame:
    """Landed payloads of both inputs as one validated batch, with those that cannot be read."""
    flagged = flag_batch(ingest(snapshots, histories, marks, as_of, tracked), reason_mode)
    for source, payloads in ((_SNAPSHOT, snapshots), (_HISTORY, histories)):
        flagged = flagged.unionByName(unreadable_rows(payloads, source), allowMissingColumns=True)
    return flagged


def write_batch(
    snapshots: DataFrame,
    histories: DataFrame,
    marks: DataFrame,
    as_of: dt.date | str = "landed",
    tracked: Sequence[str] | None = None,
    reason_mode: str = "row",
) -> tuple[DataFrame, dict[str, int]]:
    """``flag_payloads`` written where the loss of an executor cannot take it, and its counters.

    The scan that reads the rows counts the payloads that cannot be read, and
    only an input that has some is parsed again for their text.
    """
    unread, sources = "unread", ((_SNAPSHOT, snapshots), (_HISTORY, histories))
    seen = [Observation() for _ in sources]
    watched = [p.observe(o, F.count_if(landing.is_unreadable(p)).alias(unread)) for o, (_, p) in zip(seen, sources)]
    counted = Observation("batch")
    flagged = flag_batch(ingest(*watched, marks, as_of, tracked), reason_mode)
    flagged = materialise(flagged.observe(counted, *_counters()), "batch")
    counts = counted.get
    for observed, (source, payloads) in zip(seen, sources):
        if not none_counted(observed, unread):
            counted = Observation(f"unreadable-{source}")
            rows = materialise(unreadable_rows(payloads, source).observe(counted, *_counters()), "unreadable")
            counts = {name: (value or 0) + (counted.get[name] or 0) for name, value in counts.items()}
            flagged = flagged.unionByName(rows, allowMissingColumns=True)
    return flagged, counts


def _counters() -> list[Column]:
    """Row counts for the log, gathered while the batch is written."""
    return [
        F.count_if((F.col("source") == source) & (F.col("status") == status)).alias(f"{name}_{status}")
        for source, name in ((_SNAPSHOT, "current"), (_HISTORY, "historical"))
        for status in ("valid", "anomaly", "failed")
    ]


def _per_source(flagged: DataFrame, operator) -> DataFrame:
    """Apply an operator to each input on its own, as runs check them separately."""
    survived = quality.Split(flagged).survivors
    return operator(survived.where(F.col("source") == _SNAPSHOT)).unionByName(
        operator(survived.where(F.col("source") == _HISTORY))
    )


def append_gaps(warehouse: Warehouse, flagged: DataFrame, run_id: str) -> None:
    """Store the missing days of each input of a flagged batch."""
    warehouse.append_gaps(_per_source(flagged, series.calendar_gaps), run_id)


class Window(NamedTuple):
    """What a run takes of the landings, from which marks, and the failed runs whose landings it takes over."""

    since: str | None
    after: str | None
    until: str | None
    marks: DataFrame
    overtakes: list[str]


def _window(warehouse: Warehouse, run_id: str, since: str | None, until: str | None, restate_days: int) -> Window:
    """The window and marks of a run, as kept if the run was started before.

    A run counts as soon as its report is stored. Without ``since`` the next
    one goes on behind the landings of all runs that count; landings of runs
    that failed on the way are loaded again, from the marks these had.
    """
    kept = warehouse.windows().where(F.col("run_id") == run_id).first()
    marked = series.high_water_marks(warehouse.fact_price())
    if kept is not None:
        state = warehouse.states().where(F.col("run_id") == run_id).first()
        if state is not None and state.state == OVERTAKEN:
            raise ValueError(f"run {run_id!r} was overtaken by run {state.by!r}, which loads its landings")
        if since != kept.since or (until is not None and until != kept.until):
            raise ValueError(f"run {run_id!r} was started with another window")
        marks = warehouse.marks(run_id, series.restate(marked, restate_days), restate_days)
        return Window(kept.since, kept.after, kept.until, marks, [])
    pending = [] if since else warehouse.pending()
    after = None if since else warehouse.landed_until(pending)
    if pending:
        marked = warehouse.marks_of(pending[0])
    marks = warehouse.marks(run_id, series.restate(marked, restate_days), restate_days, anew=True)
    return Window(since, after, until, marks, pending)


def refuse_orphans(warehouse: Warehouse, rows: DataFrame) -> None:
    """Raise if a coin of ``rows`` has no dimension row."""
    orphan = orphan_facts(rows.select("coin_id").distinct(), warehouse.dim_coin()).first()
    if orphan is not None:
        raise ValueError(f"no dimension row for coin {orphan.coin_id!r}")


def load(warehouse: Warehouse, flagged: DataFrame, run_id: str) -> None:
    """Upsert valid rows and store quarantined ones; repeating it changes nothing."""
    valid = flagged.where(F.col("status") == "valid")
    warehouse.upsert_dim(valid.where(F.col("source") == _SNAPSHOT), _ORDER)
    refuse_orphans(warehouse, valid)
    merged = warehouse.upsert_fact(valid.select(*FACT_KEY, *MEASURES, *_ORDER), _ORDER)
    warehouse.keep_metrics(run_id, "fact_price", {"rows": merged.count()})
    warehouse.append_quarantine(flagged.where(F.col("status") != "valid"), run_id)


def run(
    spark: SparkSession,
    landed: str,
    warehouse_root: str,
    run_id: str,
    *,
    layout: str = "files",
    since: str | None = None,
    until: str | None = None,
    as_of: dt.date | str = "landed",
    tracked: Sequence[str] | None = None,
    restate_days: int = 0,
    reason_mode: str = "row",
) -> DataFrame:
    """Load what was landed in ``[since, until]`` and return the one-row report.

    Without ``since`` a run takes what landed after all earlier runs that stored
    their report, so the next run loads what a failed one should have; the failed
    one can be repeated until then. Repeating the last run with its ``run_id``
    leaves every table as it was: the window and the marks it started from are
    kept. Payloads that cannot be read are
    quarantined with their file and text.
    """
    if layout not in ("files", "table"):
        raise ValueError("layout must be 'files' or 'table'")
    with temporary(spark):
        report = _run(
            Warehouse(spark, warehouse_root), landed, run_id, layout, since, until, as_of, tracked, restate_days, reason_mode
        )
        # One row, kept without the copies it was counted from.
        return spark.createDataFrame(report.collect(), report.schema)


def _run(
    warehouse: Warehouse,
    landed: str,
    run_id: str,
    layout: str,
    since: str | None,
    until: str | None,
    as_of: dt.date | str,
    tracked: Sequence[str] | None,
    restate_days: int,
    reason_mode: str,
) -> DataFrame:
    spark = warehouse.spark
    since, after, until, marks, overtakes = _window(warehouse, run_id, since, until, restate_days)

    if layout == "files":
        snapshots = landing.read_snapshot_files(spark, landed)
        histories = landing.read_history_files(spark, landed)
    else:
        snapshots = landing.read_snapshot_table(spark, landed)
        histories = landing.read_history_table(spark, landed)
    snapshots = landing.between(snapshots, since, until, after)
    histories = landing.between(histories, since, until, after)

    # Feeds every sink and counter below, so it is evaluated once.
    flagged, counts = write_batch(snapshots, histories, marks, as_of, tracked, reason_mode)
    logger.info("run %s: %s", run_id, counts)
    warehouse.keep_metrics(run_id, "batch", counts)
    newest = flagged.agg(F.max("landed")).first()[0]
    warehouse.keep_window(run_id, since, after, until or newest or after)
    for other in overtakes:
        warehouse.overtake(other, run_id)
    load(warehouse, flagged, run_id)

    append_gaps(warehouse, flagged, run_id)
    ranking = warehouse.keep_ranking(marts.volatility_ranking(warehouse.fact_price()))
    views.register(warehouse.fact_price(), warehouse.dim_coin(), warehouse.quarantine(), ranking)
    views.check(spark)

    gaps = warehouse.gaps().where(F.col("run_id") == run_id)
    repeated = _per_source(flagged, quality.repeated_keys)
    report = materialise(quality.report(flagged, gaps, repeated), "report")
    write_report(warehouse, report, run_id)
    warehouse.keep_state(run_id, DONE)
    return report


def write_report(warehouse: Warehouse, report: DataFrame, run_id: str) -> None:
    """Store the counters as JSON and as the four-line text; both hold one row."""
    # The heading and the four labels.
    folder = f"{warehouse.path('dq_report')}/run_id={run_id}"
    report.coalesce(1).write.mode("overwrite").json(f"{folder}/json")
    lines = F.concat_ws(
        "\n",
        F.lit("DATA QUALITY REPORT"),
        F.lit("==================="),
        F.concat(F.lit("Rows Received: "), "rows_received"),
        F.concat(F.lit("Rows Passed: "), "rows_passed"),
        F.concat(F.lit("Rows Quarantined: "), "rows_quarantined"),
        F.concat(F.lit("Gaps Found: "), "gaps_found"),
    )
    report.select(lines.alias("value")).coalesce(1).write.mode("overwrite").text(f"{folder}/text")
    logger.info("report of run %s stored in %s", run_id, folder)
