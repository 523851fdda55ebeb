"""Skew and fault tolerance helpers.

A key may hold a large share of all rows. Operators that only aggregate are
safe by map-side combining. The helpers here cover the rest:

* ``join_keyed`` brings a per-key result back to the rows by a plain join of
  two written or scanned sides, whose large partitions Spark splits;
* ``previous_value``, ``running`` and ``trailing`` find the preceding row's value,
  a running total and frames of preceding rows for keys of any size.

All keep every row and work alike at every size.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window, WindowSpec
from pyspark.sql import functions as F

from tidemark.functions.expressions import ordering

# Input bytes, as stored, for each slice of an ordered pass.
SLICE_BYTES = 64 << 20
# Spark gives what it cannot measure the largest long.
_UNKNOWN_BYTES = 1 << 62


# Folder of a local session that names none, by application.
_local: dict[str, str] = {}
# Copies made inside open ``temporary`` blocks.
_made: list[list[str]] = []


def shared_dir(spark: SparkSession) -> str:
    """Folder all executors can reach, as named by ``spark.checkpoint.dir``.

    Only a session on one machine may leave it out.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not context.master.startswith("local") or context.master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    if context.applicationId not in _local:
        _local[context.applicationId] = tempfile.mkdtemp(prefix="tidemark-")
    return _local[context.applicationId]


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    The copy outlives executors, is evaluated once however often it is used,
    and has a known size, so Catalyst broadcasts it only when it is small.
    """
    path = f"{shared_dir(df.sparkSession)}/{label}-{uuid.uuid4().hex}"
    for made in _made:
        made.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def none_counted(observed: Observation, name: str) -> bool:
    """Whether the counter ``name`` of a finished query stayed at zero.

    Spark may leave a counter out together with a branch it finds empty; that
    is no zero, and reading it fails.
    """
    try:
        return observed.get.get(name) == 0
    except Py4JJavaError:
        return False


@contextmanager
def temporary(spark: SparkSession) -> Iterator[None]:
    """Delete the copies that ``materialise`` writes inside the block when it ends."""
    made: list[str] = []
    _made.append(made)
    try:
        yield
    finally:
        _made[:] = [other for other in _made if other is not made]
        for path in made:
            target = spark._jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def _join(left: DataFrame, right: DataFrame, on: Sequence[str], how: str) -> DataFrame:
    """Join on null-safe equality of the key columns, an equi-join for Spark."""
    names = {name: f"_key_{i}" for i, name in enumerate(on)}
    renamed = right.withColumnsRenamed(names)
    condition = [F.col(name).eqNullSafe(F.col(other)) for name, other in names.items()]
    return left.join(renamed, condition, how).drop(*names.values())


def join_keyed(rows: DataFrame, keyed: DataFrame, on: Sequence[str]) -> DataFrame:
    """Inner join of ``rows`` with a table of one row per key; nulls in the key match.

    The keyed table is written first: Spark then knows its size, broadcasts it
    only when small, and otherwise meets two plain shuffles, of which it splits
    the partitions of hot keys.
    """
    return _join(rows, materialise(keyed, "keyed"), list(on), "inner")


def _slice_count(rows: DataFrame) -> int:
    """Slices for the stored size of what ``rows`` reads, at least the session's partitions.

    Frames that are not read from storage have no known size and add nothing.
    """
    leaves = rows._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(leaves.apply(i).stats().sizeInBytes()) for i in range(leaves.size())]
    stored = sum(size for size in sizes if size < _UNKNOWN_BYTES)
    least = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(least, -(-stored // SLICE_BYTES))


def sliced(rows: DataFrame, order: Sequence[str | Column]) -> DataFrame:
    """``rows`` in even slices of the whole order, written once, with ``_slice`` and ``_tie``.

    ``_tie`` is a number of its own for every row, so that copies of one row
    spread over slices as well.
    """
    numbered = rows.withColumn("_tie", F.monotonically_increasing_id())
    ranged = numbered.repartitionByRange(_slice_count(rows), *order, "_tie")
    return materialise(ranged.withColumn("_slice", F.spark_partition_id()), "slices")


def _spanning(parts: DataFrame, key: str) -> DataFrame:
    """The rows of keys that lie in more than one slice."""
    borders = parts.groupBy(key).agg(F.min("_slice").alias("_from"), F.max("_slice").alias("_to"))
    # Fewer keys than slices.
    return _join(parts, F.broadcast(borders.where("_from < _to").select(key)), [key], "left_semi")


def previous_value(
    rows: DataFrame,
    key: str,
    order: Sequence[str],
    value: str,
    out: str,
    among: Column | None = None,
    bounded: bool = False,
) -> DataFrame:
    """Add ``out``: ``value`` of the preceding row of the same ``key``.

    With ``among`` only rows for which it holds count as preceding. Rows are
    range-split on (key, order) into even slices, whatever the size of a key.
    A key that goes on from one slice to the next, and there is at most one at
    each border, carries its last value over. ``bounded`` says that rows per
    key are few by nature, as with one row per day: one window then does.
    """
    order = list(order)
    held = F.struct(F.col(value).alias("v"))
    held = held if among is None else F.when(among, held)

    def before(keys: Sequence[str], by: Sequence[str]) -> Column:
        window = Window.partitionBy(*keys).orderBy(*by)
        if among is None:
            return F.lag(held).over(window)
        return F.last(held, ignorenulls=True).over(window.rowsBetween(Window.unboundedPreceding, -1))

    if bounded:
        return rows.withColumn(out, before([key], order)["v"])
    parts = sliced(rows, [key, *order])
    position = [*order, "_tie"]
    last = ordering([F.col(c) for c in position])
    last = last if among is None else F.when(among, last)
    tails = _spanning(parts, key).groupBy(key, "_slice")
    tails = tails.agg(F.max_by(held, last).alias("_tail"))
    earlier = Window.partitionBy(key).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    carried = tails.select(key, "_slice", F.last("_tail", ignorenulls=True).over(earlier).alias("_carried"))
    # A row for each slice of each spanning key: under twice the slices.
    carried = F.broadcast(carried)
    inside = parts.withColumn("_inside", before(["_slice", key], position))
    joined = _join(inside, carried, [key, "_slice"], "left")
    found = F.coalesce("_inside", "_carried")["v"]
    return joined.select(*rows.columns, found.alias(out))


# How a running total adds up the rows of a slice, and the totals of slices.
RUNNING: dict[str, tuple[Callable[[Column], Column], Callable[[Column, Column], Column]]] = {
    "max": (F.max, F.greatest),
    "min": (F.min, F.least),
    "sum": (F.sum, lambda a, b: F.coalesce(a + b, a, b)),
}


def running(rows: DataFrame, key: str, order: Sequence[str], value: str, out: str, total: str = "max") -> DataFrame:
    """Add ``out``: the ``total`` (max, min or sum) of ``value`` over the rows of ``key`` up to each row.

    A segmented scan: rows are range-split on (key, order) into even slices,
    every slice adds up its own rows, and a key that goes on from one slice to
    the next carries the total of its earlier slices over. No task sees more
    of a key than a slice of it. Nulls count for nothing.
    """
    fold, merge = RUNNING[total]
    parts = sliced(rows, [key, *order])
    up_to = Window.partitionBy("_slice", key).orderBy(*order, "_tie").rowsBetween(Window.unboundedPreceding, 0)
    totals = _spanning(parts, key).groupBy(key, "_slice").agg(fold(F.col(value)).alias("_total"))
    earlier = Window.partitionBy(key).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    # A row for each slice of each spanning key: under twice the slices.
    carried = totals.select(key, "_slice", fold(F.col("_total")).over(earlier).alias("_carried"))
    inside = parts.withColumn("_inside", fold(F.col(value)).over(up_to))
    joined = _join(inside, F.broadcast(carried), [key, "_slice"], "left")
    return joined.select(*rows.columns, merge(F.col("_inside"), F.col("_carried")).alias(out))


def trailing(
    rows: DataFrame,
    key: str,
    order: Sequence[str],
    width: int,
    steps: Sequence[Callable[[WindowSpec], dict[str, Column]]],
) -> DataFrame:
    """Add columns that look at the current row of a key and at most ``width - 1`` rows before it.

    Each of ``steps`` takes the window of a key in order and gives columns over
    it; later ones may use earlier ones. Rows are range-split on (key, order)
    into even slices. Where a key goes on from earlier slices, its last
    ``width - 1`` rows there are added in front of the slice as a halo, by
    their number within the key, and taken away at the end.
    """
    parts = sliced(rows, [key, *order])
    halo = width - 1
    spanning = _spanning(parts, key)
    sizes = spanning.groupBy(key, "_slice").agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy(key).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    # A row for each slice of each spanning key: under twice the slices.
    starts = materialise(sizes.withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0))), "starts")
    from_end = F.row_number().over(Window.partitionBy("_slice", key).orderBy(*[F.col(c).desc() for c in (*order, "_tie")]))
    tails = spanning.withColumn("_from_end", from_end).where(F.col("_from_end") <= halo)
    tails = _join(tails, F.broadcast(starts), [key, "_slice"], "inner")
    tails = tails.withColumn("_number", F.col("_before") + F.col("_n") - F.col("_from_end") + 1)
    numbers = F.sequence(F.greatest(F.lit(1), F.col("_before") - halo + 1), F.col("_before"))
    wanted = starts.where(F.col("_before") > 0).select(key, F.col("_slice").alias("_into"), F.explode(numbers).alias("_number"))
    found = _join(tails.drop("_slice"), wanted, [key, "_number"], "inner")
    found = found.select(*rows.columns, "_tie", F.col("_into").alias("_slice"), F.lit(True).alias("_halo"))
    frame = parts.withColumn("_halo", F.lit(False)).unionByName(found)
    by = Window.partitionBy("_slice", key).orderBy(*order, "_tie")
    added: list[str] = []
    for step in steps:
        columns = step(by)
        frame = frame.withColumns(columns)
        added += columns
    return frame.where(~F.col("_halo")).select(*rows.columns, *added)
