"""Incremental loading as file streams: of histories alone, or of both inputs.

Each landed file is picked up once; the stream's checkpoint plays the part of
the run schedule, and the keyed upsert makes a repeated micro-batch harmless.
Late payloads restate days that are already stored. The stream of both inputs
also drops payloads that were landed before under another file name.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators import quality, series
from tidemark.operators.store import Warehouse
from tidemark.plans import pipeline
from tidemark.scale import materialise, temporary
from tidemark.schemas import FACT_KEY, HISTORY, MEASURES
from tidemark.sources import landing


def load_history_batch(warehouse: Warehouse, payloads: DataFrame, run_id: str, restate_days: int) -> None:
    """Reduce, filter, validate and upsert one set of history payloads, as a run does."""
    marks = series.restate(series.high_water_marks(warehouse.fact_price()), restate_days)
    marks = warehouse.marks(run_id, marks, restate_days)
    days = series.newer_than_marks(pipeline.history_days(landing.history_points(payloads)), marks)
    flagged = quality.flag(days, "historical", bounded=True)
    broken = pipeline.unreadable_rows(payloads, 1).drop("landed", "source")
    flagged = materialise(flagged.unionByName(broken), "batch")
    valid = flagged.where(F.col("status") == "valid").select(*FACT_KEY, *MEASURES)
    pipeline.refuse_orphans(warehouse, valid)
    warehouse.load_history(valid, [])
    warehouse.append_quarantine(flagged.where(F.col("status") != "valid"), run_id)
    warehouse.append_gaps(series.calendar_gaps(quality.Split(flagged).survivors), run_id)


def stream_history(
    spark: SparkSession, landed: str, warehouse_root: str, checkpoint: str, restate_days: int = 0
) -> StreamingQuery:
    """Load every history file not seen before, then stop.

    Runs are named after the stream, by its checkpoint's id, and the epoch, so
    that streams on one warehouse keep apart.
    """
    warehouse = Warehouse(spark, warehouse_root)
    files = (
        spark.readStream.schema(T.StructType([*HISTORY.fields, T.StructField(landing.CORRUPT, T.StringType())]))
        .option("multiLine", True)
        .option("columnNameOfCorruptRecord", landing.CORRUPT)
        .option("pathGlobFilter", landing.HISTORY_GLOB)
        .json(landed)
    )

    def load(payloads: DataFrame, epoch: int) -> None:
        stream = spark.read.json(f"{checkpoint.rstrip('/')}/metadata").first().id
        with temporary(spark):
            load_history_batch(warehouse, payloads, f"stream-{stream}-{epoch}", restate_days)

    return (
        landing.history_payloads(files)
        .writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def _once(payloads: DataFrame, within: str) -> DataFrame:
    """Payloads without repeats, by content and landing stamp, that arrive within ``within`` of the first.

    Time is when a payload arrived here, so none can be too late for the
    watermark and be lost; the state holds the digests of that span only.
    """
    digest = F.sha2(F.to_json(F.struct("snapshot", "history")), 256)
    dated = payloads.withColumn("digest", digest).withColumn("arrived", F.current_timestamp())
    return dated.withWatermark("arrived", within).dropDuplicatesWithinWatermark(["digest"]).drop("digest", "arrived")


def load_batch(
    warehouse: Warehouse,
    snapshots: DataFrame,
    histories: DataFrame,
    run_id: str,
    as_of: dt.date | str = "landed",
    restate_days: int = 0,
) -> None:
    """Validate and load one set of payloads of both inputs, as a run does; repeating it changes nothing."""
    marks = series.restate(series.high_water_marks(warehouse.fact_price()), restate_days)
    marks = warehouse.marks(run_id, marks, restate_days)
    flagged = materialise(pipeline.flag_payloads(snapshots, histories, marks, as_of), "batch")
    pipeline.load(warehouse, flagged, run_id)
    pipeline.append_gaps(warehouse, flagged, run_id)


def stream_load(
    spark: SparkSession,
    landed: str,
    warehouse_root: str,
    checkpoint: str,
    *,
    layout: str = "files",
    as_of: dt.date | str = "landed",
    restate_days: int = 0,
    repeats_within: str = "7 days",
) -> StreamingQuery:
    """Load every snapshot and history file not seen before, then stop.

    Both inputs are one stream, so a micro-batch holds the dimension rows that
    its histories need. A payload landed again with the same stamp and content
    is dropped if it arrives within ``repeats_within`` of the first; unreadable
    payloads are the same only if their text and file name are. Runs are named
    as those of ``stream_history``.
    """
    if layout not in ("files", "table"):
        raise ValueError("layout must be 'files' or 'table'")
    warehouse = Warehouse(spark, warehouse_root)
    snapshots = landing.stream_snapshots(spark, landed, layout)
    histories = landing.stream_histories(spark, landed, layout)

    def packed(payloads: DataFrame, name: str) -> DataFrame:
        # A file's name tells payloads apart only where nothing else can be read.
        file = F.when(landing.is_unreadable(payloads), F.col("file")).otherwise(F.lit("")).alias("file")
        fields = [file if c == "file" else F.col(c) for c in payloads.columns]
        return payloads.select(F.struct(*fields).alias(name))

    both = packed(snapshots, "snapshot").unionByName(packed(histories, "history"), allowMissingColumns=True)

    def load(payloads: DataFrame, epoch: int) -> None:
        stream = spark.read.json(f"{checkpoint.rstrip('/')}/metadata").first().id
        with temporary(spark):
            # Read once and in full: the state of all partitions must be stored.
            payloads = materialise(payloads, "payloads")
            if payloads.isEmpty():
                return
            inputs = [payloads.where(F.col(c).isNotNull()).select(f"{c}.*") for c in ("snapshot", "history")]
            load_batch(warehouse, *inputs, f"stream-{stream}-{epoch}", as_of, restate_days)

    return (
        _once(both, repeats_within)
        .writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
