"""Landed JSON payloads: readers for both layouts, and the landing sink.

File layout: one payload per file, ``snapshot_markets_<stamp>.json`` (array of
objects) and ``history_<coin_id>_<stamp>.json`` (three parallel arrays).
Table layout: JSON lines under ``dataset=.../ingest_ts=...``, splittable, for
volumes at which one file per payload no longer scales.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.expressions import file_stamp, stamp_day, utc_day
from tidemark.operators.series import align_long
from tidemark.schemas import HISTORY, SNAPSHOT

SNAPSHOT_DATASET = "snapshot_markets"
HISTORY_DATASET = "history"
SNAPSHOT_GLOB = "snapshot_markets_*.json"
HISTORY_GLOB = "history_*.json"

# Text of a payload that is no readable JSON.
CORRUPT = "_corrupt_record"
UNREADABLE = "Unreadable payload"

# What compacted rows keep of the small file they come from: its name, its text if unreadable; and their folder.
ORIGIN, BROKEN, BATCH = "origin", "broken", "batch"

# One stored payload row: the declared payload plus where it came from.
_SOURCE = [T.StructField(name, T.StringType()) for name in (ORIGIN, BROKEN, "dataset", "ingest_ts")]
STORED_SNAPSHOT = T.StructType([*SNAPSHOT.fields, *_SOURCE])
STORED_HISTORY = T.StructType([*HISTORY.fields, T.StructField("coin_id", T.StringType()), *_SOURCE])


def _from_file_name(raw: DataFrame, *extra: Column) -> DataFrame:
    """Payload columns plus what the landed file name says; works on streams too."""
    name = F.col("_metadata.file_name")
    return raw.select("*", name.alias("file"), file_stamp(name).alias("ingest_ts"), *extra)


def _with_corrupt(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])


def snapshot_objects(raw: DataFrame) -> DataFrame:
    """Add ``ingest_ts`` to a snapshot scan of the file layout."""
    return _from_file_name(raw)


def history_payloads(raw: DataFrame) -> DataFrame:
    """Add ``ingest_ts`` and ``coin_id`` to a history scan of the file layout.

    Coin ids may contain ``-`` or ``_``, so the stamp is cut from the right.
    """
    coin = F.regexp_extract(F.col("_metadata.file_name"), r"^history_(.+)_\d{8}_\d{6}\.json$", 1)
    return _from_file_name(raw, coin.alias("coin_id"))


def read_snapshot_files(spark: SparkSession, path: str) -> DataFrame:
    raw = spark.read.schema(_with_corrupt(SNAPSHOT)).option("multiLine", True)
    raw = raw.option("columnNameOfCorruptRecord", CORRUPT).option("pathGlobFilter", SNAPSHOT_GLOB)
    return snapshot_objects(raw.json(path))


def read_history_files(spark: SparkSession, path: str) -> DataFrame:
    raw = spark.read.schema(_with_corrupt(HISTORY)).option("multiLine", True)
    raw = raw.option("columnNameOfCorruptRecord", CORRUPT).option("pathGlobFilter", HISTORY_GLOB)
    return history_payloads(raw.json(path))


def _read_table(spark: SparkSession, path: str, schema: T.StructType, dataset: str) -> DataFrame:
    reader = spark.read.schema(_with_corrupt(schema)).option("columnNameOfCorruptRecord", CORRUPT)
    return _of_dataset(reader.json(path), dataset)


def _of_dataset(raw: DataFrame, dataset: str) -> DataFrame:
    stored = raw.where(F.col("dataset") == dataset)
    named = stored.withColumn("file", F.coalesce(F.col(ORIGIN), F.col("_metadata.file_name")))
    named = named.withColumn(CORRUPT, F.coalesce(F.col(CORRUPT), F.col(BROKEN)))
    return named.drop("dataset", ORIGIN, BROKEN, BATCH)


def read_snapshot_table(spark: SparkSession, path: str) -> DataFrame:
    """Snapshot objects of the table layout; filters on ``ingest_ts`` prune folders."""
    return _read_table(spark, path, STORED_SNAPSHOT, SNAPSHOT_DATASET)


def read_history_table(spark: SparkSession, path: str) -> DataFrame:
    return _read_table(spark, path, STORED_HISTORY, HISTORY_DATASET)


def _stream(spark: SparkSession, path: str, layout: str, schema: T.StructType, stored: T.StructType, glob: str) -> DataFrame:
    files = layout == "files"
    reader = spark.readStream.schema(_with_corrupt(schema if files else stored))
    reader = reader.option("columnNameOfCorruptRecord", CORRUPT).option("multiLine", files)
    return (reader.option("pathGlobFilter", glob) if files else reader).json(path)


def stream_snapshots(spark: SparkSession, path: str, layout: str = "files") -> DataFrame:
    """Snapshot objects of files not seen before, of either layout."""
    raw = _stream(spark, path, layout, SNAPSHOT, STORED_SNAPSHOT, SNAPSHOT_GLOB)
    return snapshot_objects(raw) if layout == "files" else _of_dataset(raw, SNAPSHOT_DATASET)


def stream_histories(spark: SparkSession, path: str, layout: str = "files") -> DataFrame:
    """History payloads of files not seen before, of either layout."""
    raw = _stream(spark, path, layout, HISTORY, STORED_HISTORY, HISTORY_GLOB)
    return history_payloads(raw) if layout == "files" else _of_dataset(raw, HISTORY_DATASET)


def is_unreadable(payloads: DataFrame) -> Column:
    """Whether a payload is no JSON, or a history without its prices."""
    broken = F.lit(False)
    if CORRUPT in payloads.columns:
        broken = F.col(CORRUPT).isNotNull()
    if CORRUPT in payloads.columns and "id" in payloads.columns:
        # Always true; Spark refuses to read nothing but the text of broken records.
        broken = broken & (F.col("id").isNull() | (F.length("id") >= 0))
    if "prices" in payloads.columns:
        broken = broken | F.col("prices").isNull()
    return broken


def readable(payloads: DataFrame) -> DataFrame:
    return payloads.where(~is_unreadable(payloads))


def unreadable(payloads: DataFrame) -> DataFrame:
    """(coin_id, ingest_ts, rejected) of payloads that cannot be read: the file's name and the text."""
    coin = F.col("coin_id") if "coin_id" in payloads.columns else F.lit(None).cast("string")
    text = F.col(CORRUPT) if CORRUPT in payloads.columns else F.lit(None).cast("string")
    file = F.col("file") if "file" in payloads.columns else F.lit("")
    rejected = F.concat(file, F.lit(": "), F.coalesce(text, F.lit("no prices")))
    return payloads.where(is_unreadable(payloads)).select(
        coin.alias("coin_id"), "ingest_ts", rejected.alias("rejected")
    )


def land(payloads: DataFrame, path: str, dataset: str, ingest_ts: str, compression: str = "none") -> None:
    """Landing sink: keep the accepted payload rows as JSON lines.

    ``compression`` may be ``gzip`` where files are small: readers take a
    compressed file whole.

    Writing the same ``ingest_ts`` again replaces it, so a retried job leaves
    one copy. ``ignoreNullFields`` is off to keep the payload's explicit nulls.
    """
    (
        payloads.drop("dataset", "ingest_ts", "file", CORRUPT)
        .withColumn("dataset", F.lit(dataset))
        .withColumn("ingest_ts", F.lit(ingest_ts))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("ignoreNullFields", False)
        .option("compression", compression)
        .partitionBy("dataset", "ingest_ts")
        .json(path)
    )


def between(
    payloads: DataFrame, since: str | None, until: str | None, after: str | None = None
) -> DataFrame:
    """Payloads landed in ``[since, until]`` and later than ``after``, all ``yyyymmdd_hhmmss``."""
    if since is not None:
        payloads = payloads.where(F.col("ingest_ts") >= since)
    if after is not None:
        payloads = payloads.where(F.col("ingest_ts") > after)
    if until is not None:
        payloads = payloads.where(F.col("ingest_ts") <= until)
    return payloads


def snapshot_rows(objects: DataFrame, as_of: dt.date | str = "landed") -> DataFrame:
    """Snapshot objects to the seven validated columns.

    ``as_of`` sets the day: a date, ``"landed"`` for the local calendar day in
    the landing stamp, or ``"utc"`` for the UTC day of ``last_updated``.
    """
    if isinstance(as_of, dt.date):
        day = F.lit(as_of)
    elif as_of == "landed":
        day = stamp_day(F.col("ingest_ts"))
    elif as_of == "utc":
        day = F.split_part(F.col("last_updated"), F.lit("T"), F.lit(1)).try_cast("date")
    else:
        raise ValueError(f"as_of must be a date, 'landed' or 'utc', not {as_of!r}")
    return readable(objects).select(
        F.col("id").alias("coin_id"),
        "symbol",
        "name",
        F.col("current_price").alias("price"),
        "market_cap",
        F.col("total_volume").alias("volume"),
        day.alias("date"),
        "ingest_ts",
    )


def history_points(payloads: DataFrame) -> DataFrame:
    """History payloads to aligned points ``(coin_id, ingest_ts, timestamp, date, measures)``.

    The three arrays become rows, then their points do, so each payload is
    parsed and scanned once, all in generated code, which a lambda over the
    points would leave. The points of a timestamp come from one payload row,
    which lets the alignment combine them before its single shuffle.
    """
    named = (("prices", "price"), ("market_caps", "market_cap"), ("total_volumes", "volume"))
    arrays = F.array(*[F.struct(F.lit(name).alias("series"), F.col(c).alias("points")) for c, name in named])
    long = readable(payloads).select("coin_id", "ingest_ts", F.inline(arrays))
    long = long.select("coin_id", "ingest_ts", "series", F.posexplode("points").alias("position", "point"))
    long = long.select(
        "coin_id",
        "ingest_ts",
        "series",
        F.col("position").cast("long").alias("position"),
        F.get("point", F.lit(0)).cast("long").alias("timestamp"),
        F.get("point", F.lit(1)).alias("value"),
    )
    aligned = align_long(long, ["coin_id", "ingest_ts", "timestamp"], order="position")
    return aligned.withColumn("date", utc_day(F.col("timestamp")))
