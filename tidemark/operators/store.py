"""Keyed loads into Parquet tables, the quarantine sink and integrity audits."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.scale import materialise
from tidemark.schemas import (
    DIM,
    DIM_KEY,
    DIM_LENGTHS,
    FACT,
    FACT_KEY,
    GAPS,
    MARKS,
    MART_DAILY,
    MART_MONTHS,
    MEASURES,
    QUARANTINE,
)

# The landing window of each run, a row a run.
RUNS = T.StructType([T.StructField(c, T.StringType()) for c in ("run_id", "since", "after", "until")])
# What became of a started run: done, or overtaken by a later run that loads its landings.
STATES = T.StructType([T.StructField(c, T.StringType()) for c in ("run_id", "state", "by")])
DONE, OVERTAKEN = "done", "overtaken"
# What was counted while a step of a run wrote its rows.
METRICS = T.StructType(
    [*(T.StructField(c, T.StringType()) for c in ("run_id", "step", "metric")), T.StructField("value", T.LongType())]
)

# Stored layout of each table: declared columns plus the folder column, if any.
STORED = {
    "dim_coin": DIM,
    "fact_price": T.StructType([*FACT.fields, T.StructField("month", T.StringType())]),
    "quarantine": QUARANTINE,
    "gaps": T.StructType([*GAPS.fields, T.StructField("run_id", T.StringType())]),
    "mart_daily": MART_DAILY,
    "mart_months": MART_MONTHS,
}
# Tables in a folder for each month, of which a load replaces those it touches.
BY_MONTH = ("fact_price", "mart_daily", "mart_months")
# A look-up of one coin passes over the row groups whose filter does not hold it.
LOOKUP = {"parquet.bloom.filter.enabled#coin_id": "true"}


def last_per_key(rows: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the last by ``order``, ties settled by the other values.

    An aggregate with map-side combining, so copies of a key shrink before the
    shuffle. Rows stay whole: columns never mix.
    """
    values = [c for c in rows.columns if c not in keys and c not in order]
    ranked = F.struct(
        *[F.col(c).alias(f"o{i}") for i, c in enumerate(order)],
        *[F.col(c).alias(c) for c in values],
    )
    last = rows.groupBy(*keys).agg(F.max(ranked).alias("_last"))
    return last.select(*keys, *[F.col("_last")[c].alias(c) for c in values])


def merge_latest(
    stored: DataFrame, batch: DataFrame, keys: Sequence[str], order: Sequence[str]
) -> DataFrame:
    """Upsert: stored rows, with those the batch has a row for replaced by it.

    The batch is reduced to one row per key first. Stored rows are not
    shuffled when the reduced batch is small enough to broadcast.
    """
    return replace_keys(stored, last_per_key(batch, keys, order), keys)


def replace_keys(stored: DataFrame, latest: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Stored rows with those of ``latest``, one per key, in place of their own."""
    latest = latest.select(*stored.columns)
    return stored.join(latest, list(keys), "left_anti").unionByName(latest)


@dataclass(frozen=True)
class Warehouse:
    """Parquet tables below one folder that all executors can reach.

    ``options`` go to the Parquet writer of the tables by month, whose rows lie
    in order of coin and day, with a Bloom filter on the coin.
    """

    spark: SparkSession
    root: str
    options: tuple[tuple[str, str], ...] = ()

    def path(self, table: str) -> str:
        return f"{self.root.rstrip('/')}/{table}"

    def _hadoop(self, path: str):
        target = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return target.getFileSystem(self.spark._jsc.hadoopConfiguration()), target

    def exists(self, path: str) -> bool:
        fs, target = self._hadoop(path)
        return fs.exists(target)

    def read(self, table: str) -> DataFrame:
        """The table, or a typed empty frame before its first load."""
        if self.exists(self.path(table)):
            return self.spark.read.schema(STORED[table]).parquet(self.path(table))
        return self.spark.createDataFrame([], STORED[table])

    def dim_coin(self) -> DataFrame:
        self._finish("dim_coin")
        return self.read("dim_coin")

    def fact_price(self) -> DataFrame:
        """The fact without its partition column."""
        return self._fact_by_month().drop("month")

    def quarantine(self) -> DataFrame:
        return self.read("quarantine")

    def gaps(self) -> DataFrame:
        return self.read("gaps")

    def _fact_by_month(self) -> DataFrame:
        self._finish("fact_price")
        return self.read("fact_price")

    def upsert_fact(self, batch: DataFrame, order: Sequence[str]) -> DataFrame:
        """Merge a batch into the fact, rewriting only the months it touches, and return the rows merged.

        The reduced batch is written first: it is used twice, and its known
        size lets Spark broadcast it when small, so stored rows stay in place.
        """
        batch = batch.select(*FACT_KEY, *MEASURES, *order)
        latest = last_per_key(batch, FACT_KEY, order).withColumn(
            "month", F.date_format("date", "yyyy-MM")
        )
        latest = materialise(latest, "latest")
        if not latest.isEmpty():
            stored = self.in_months("fact_price", latest)
            self._replace("fact_price", replace_keys(stored, latest, FACT_KEY))
        return latest

    def in_months(self, table: str, batch: DataFrame) -> DataFrame:
        """Stored rows of the months that occur in ``batch``, a written frame.

        Spark prunes the folders while it runs, by the months it has broadcast:
        a row a calendar month. It only does so for a side with a filter.
        """
        self._finish(table)
        months = batch.where(F.col("month") >= "").select("month").distinct()
        return self.read(table).join(F.broadcast(months), "month", "left_semi").select(*STORED[table].names)

    def upsert_dim(self, batch: DataFrame, order: Sequence[str]) -> None:
        """Merge a batch into the dimension."""
        latest = last_per_key(batch.select(*DIM.names, *order), DIM_KEY, order)
        latest = materialise(latest, "latest")
        if not latest.isEmpty():
            self._replace("dim_coin", replace_keys(self.dim_coin(), latest, DIM_KEY))

    def load_snapshot(self, rows: DataFrame, order: Sequence[str]) -> None:
        """Load validated snapshot rows: first the dimension, then the fact."""
        self.upsert_dim(rows, order)
        self.upsert_fact(rows, order)

    def load_history(self, rows: DataFrame, order: Sequence[str]) -> None:
        """Load validated history rows."""
        self.upsert_fact(rows, order)

    def marks(self, run_id: str, marks: DataFrame, restate_days: int = 0, anew: bool = False) -> DataFrame:
        """Marks a run started from, kept so that a rerun selects the same rows; ``anew`` forgets kept ones."""
        folder = f"{self.path('marks')}/run_id={run_id}"
        path = f"{folder}/restate_days={restate_days}"
        if anew:
            self._delete(folder)
        if not self.exists(f"{path}/_SUCCESS"):
            if self.exists(folder) and self._names(folder) - {f"restate_days={restate_days}"}:
                raise ValueError(f"run {run_id!r} was started with another restate_days")
            marks.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(MARKS).parquet(path)

    def marks_of(self, run_id: str) -> DataFrame:
        """The marks that another run started from."""
        folder = f"{self.path('marks')}/run_id={run_id}"
        return self.spark.read.schema(MARKS).parquet(*(f"{folder}/{name}" for name in sorted(self._names(folder))))

    def _delete(self, path: str) -> None:
        fs, target = self._hadoop(path)
        fs.delete(target, True)

    def _names(self, folder: str) -> set[str]:
        fs, path = self._hadoop(folder)
        return {status.getPath().getName() for status in fs.listStatus(path)}

    def windows(self) -> DataFrame:
        """The landing stamps that each run covered: run_id, since, after, until."""
        path = self.path("runs")
        if not self.exists(path):
            return self.spark.createDataFrame([], RUNS)
        return self.spark.read.schema(RUNS).json(path)

    def keep_window(self, run_id: str, since: str | None, after: str | None, until: str | None) -> None:
        row = self.spark.createDataFrame([(run_id, since, after, until)], RUNS).drop("run_id")
        row.coalesce(1).write.mode("overwrite").json(f"{self.path('runs')}/run_id={run_id}")

    def states(self) -> DataFrame:
        """run_id, state and by of the runs that are done or overtaken."""
        path = self.path("run_states")
        if not self.exists(path):
            return self.spark.createDataFrame([], STATES)
        return self.spark.read.schema(STATES).json(path)

    def keep_state(self, run_id: str, state: str, by: str | None = None) -> None:
        row = self.spark.createDataFrame([(run_id, state, by)], STATES).drop("run_id")
        row.coalesce(1).write.mode("overwrite").json(f"{self.path('run_states')}/run_id={run_id}")

    def keep_metrics(self, run_id: str, step: str, counted: dict[str, int]) -> None:
        """Store what one step of a run has counted; a repeated step replaces it."""
        rows = [(run_id, step, metric, int(value or 0)) for metric, value in counted.items()]
        frame = self.spark.createDataFrame(rows, METRICS).drop("run_id", "step")
        frame.coalesce(1).write.mode("overwrite").json(f"{self.path('metrics')}/run_id={run_id}/step={step}")

    def metrics(self) -> DataFrame:
        """run_id, step, metric and value of every step of every run."""
        path = self.path("metrics")
        if not self.exists(path):
            return self.spark.createDataFrame([], METRICS)
        return self.spark.read.schema(METRICS).json(path).select(*METRICS.names)

    def pending(self) -> list[str]:
        """Runs that took what had landed since the last, were started and neither done nor overtaken; oldest first."""
        open_ = self.windows().where("since is null").join(self.states(), "run_id", "left_anti")
        return [r.run_id for r in open_.orderBy(F.col("after").asc_nulls_first(), "until", "run_id").collect()]

    def landed_until(self, pending: Sequence[str]) -> str | None:
        """The stamp up to which everything landed is loaded: by runs that are done, and before all ``pending`` ones."""
        done = self.windows().join(self.states().where(F.col("state") == DONE), "run_id", "left_semi")
        until = done.agg(F.max("until")).first()[0]
        if not pending:
            return until
        before = self.windows().where(F.col("run_id").isin(list(pending)))
        before = before.agg(F.min("after").alias("after"), F.count_if(F.col("after").isNull()).alias("whole")).first()
        return None if before.whole or until is None else min(until, before.after)

    def overtake(self, run_id: str, by: str) -> None:
        """Forget what a run that failed had set aside: the run ``by`` loads its landings again."""
        for table in ("quarantine", "gaps"):
            self._delete(f"{self.path(table)}/run_id={run_id}")
        self.keep_state(run_id, OVERTAKEN, by)

    def keep_ranking(self, ranking: DataFrame) -> DataFrame:
        """Store the ranking of the current fact, a row a coin, and read it back."""
        path = self.path("volatility_ranking")
        ranking.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(ranking.schema).parquet(path)

    def append_quarantine(self, rows: DataFrame, run_id: str) -> None:
        """Store quarantined rows of one run; a rerun replaces that run's rows."""
        rejected = F.col("rejected") if "rejected" in rows.columns else F.lit(None).cast("string")
        kept = rows.select(*FACT_KEY, *MEASURES, "reason", rejected.alias("rejected"))
        stamped = kept.withColumn("quarantined_at", F.current_timestamp())
        unread = F.count_if(F.col("rejected").isNotNull()).alias("rows_with_rejected_value")
        self._write_run("quarantine", stamped, run_id, unread)

    def append_gaps(self, gaps: DataFrame, run_id: str) -> None:
        self._write_run("gaps", gaps.select(*GAPS.names), run_id)

    def _write_run(self, table: str, rows: DataFrame, run_id: str, *counters: Column) -> None:
        """Replace one run's rows of a table, and count them on the way."""
        written = Observation(f"{table}-{uuid.uuid4().hex}")
        rows = rows.observe(written, F.count(F.lit(1)).alias("rows"), *counters)
        rows.write.mode("overwrite").parquet(f"{self.path(table)}/run_id={run_id}")
        self.keep_metrics(run_id, table, written.get)

    def _staged(self, table: str) -> str:
        return self.path(f"_staging/{table}")

    def _replace(self, table: str, rows: DataFrame) -> None:
        """Write aside in full, then publish: the result is safe before the table changes."""
        if table in BY_MONTH:
            # Rebalancing splits a month too large for one task and joins small ones.
            key = [c for c in FACT_KEY if c in rows.columns]
            arranged = rows.hint("rebalance", "month").sortWithinPartitions("month", *key)
            writer = arranged.write.options(**LOOKUP, **dict(self.options)).partitionBy("month")
        else:
            writer = rows.hint("rebalance").write
        writer.mode("overwrite").parquet(self._staged(table))
        self._finish(table)

    def _finish(self, table: str) -> None:
        """Publish a complete staged result, also one that a lost driver left half published.

        Of tables by month only the months it holds are replaced, by its files;
        tasks copy the others over the table. Doing it again gives the same
        table, and the staged result is deleted last.
        """
        staged = self._staged(table)
        if not self.exists(f"{staged}/_SUCCESS"):
            return
        self._publish(table, self.spark.read.schema(STORED[table]).parquet(staged))
        fs, folder = self._hadoop(staged)
        fs.delete(folder, True)

    def _publish(self, table: str, rows: DataFrame) -> None:
        if table in BY_MONTH:
            self._move_months(table)
        else:
            rows.write.mode("overwrite").parquet(self.path(table))

    def _move_months(self, table: str) -> None:
        """Move the staged files of each month to the table, in place of those it has there.

        The names of the files to delete are kept first, so an interrupted move
        that is done again deletes none of the files that it has moved.
        """
        staged, target, replaced = self._staged(table), self.path(table), f"{self._staged(table)}/_replaced"
        (fs, _), path = self._hadoop(staged), self.spark._jvm.org.apache.hadoop.fs.Path
        months = sorted(name for name in self._names(staged) if name.startswith("month="))
        if not self.exists(f"{replaced}/_SUCCESS"):
            stored = [m for m in months if fs.exists(path(f"{target}/{m}"))]
            names = [(f"{m}/{file.getPath().getName()}",) for m in stored for file in fs.listStatus(path(f"{target}/{m}"))]
            self.spark.createDataFrame(names, "value string").coalesce(1).write.mode("overwrite").text(replaced)
        for row in self.spark.read.text(replaced).collect():
            fs.delete(path(f"{target}/{row.value}"), False)
        for month in months:
            fs.mkdirs(path(f"{target}/{month}"))
            for file in fs.listStatus(path(f"{staged}/{month}")):
                to = path(f"{target}/{month}/{file.getPath().getName()}")
                # Where a move copies, a lost driver may have left a part of the file.
                fs.delete(to, False)
                if not fs.rename(file.getPath(), to):
                    raise OSError(f"cannot move {file.getPath()} to {to}")


@dataclass(frozen=True)
class BucketedWarehouse(Warehouse):
    """A warehouse whose fact is a catalogue table, bucketed by coin within each month.

    Windows and joins by coin on ``fact_price()`` then need no shuffle of the
    stored rows. ``name`` is the table's name in the catalogue; the files stay
    below ``root``, and a session with another catalogue finds them again.
    ``buckets`` is fixed with the table: take about one for each 128 MB of a
    month's rows, and no fewer than tasks that shall read it.
    """

    name: str = "stored_fact_price"
    buckets: int = 64

    def _declare(self) -> None:
        if self.spark.catalog.tableExists(self.name):
            return
        columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in STORED["fact_price"].fields)
        options = ", ".join(f"'{key}' '{value}'" for key, value in (*LOOKUP.items(), *self.options))
        self.spark.sql(
            f"CREATE TABLE {self.name} ({columns}) USING parquet OPTIONS ({options}) PARTITIONED BY (month) "
            f"CLUSTERED BY (coin_id) SORTED BY (coin_id, date) INTO {self.buckets} BUCKETS LOCATION '{self.path('fact_price')}'"
        )
        if self.exists(self.path("fact_price")):
            self.spark.catalog.recoverPartitions(self.name)

    def read(self, table: str) -> DataFrame:
        if table != "fact_price":
            return super().read(table)
        self._declare()
        return self.spark.table(self.name).select(*STORED[table].names)

    def _publish(self, table: str, rows: DataFrame) -> None:
        if table != "fact_price":
            return super()._publish(table, rows)
        self._declare()
        # The tasks hold whole buckets, so each writes one file a month and bucket.
        dealt = rows.select(*STORED[table].names).repartition(self.buckets, "coin_id")
        mode = "spark.sql.sources.partitionOverwriteMode"
        before = self.spark.conf.get(mode)
        self.spark.conf.set(mode, "dynamic")
        try:
            dealt.sortWithinPartitions("month", *FACT_KEY).write.insertInto(self.name, overwrite=True)
        finally:
            self.spark.conf.set(mode, before)


def quarantine_rows(rows: DataFrame) -> DataFrame:
    """The columns the quarantine keeps; load time and run id are added on write."""
    return rows.select(*FACT_KEY, *MEASURES, "reason")


def orphan_facts(fact: DataFrame, dim: DataFrame) -> DataFrame:
    """Fact rows whose coin has no dimension row."""
    return fact.join(dim.select("coin_id").distinct(), "coin_id", "left_anti")


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Row count per table."""
    counted = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counted)


def constraint_audit(fact: DataFrame, dim: DataFrame) -> DataFrame:
    """Violations of each declared constraint: rows for nulls, orphans and lengths, keys for uniqueness.

    Each table is read once: it shrinks to one counted row per key and coin,
    and the coins of both meet in one join.
    """
    n = F.count(F.lit(1))
    keys = fact.groupBy(*FACT_KEY).agg(n.alias("n"))
    facts = keys.groupBy("coin_id").agg(
        F.sum("n").alias("facts"),
        F.sum(F.when(F.col("date").isNull(), F.col("n"))).alias("dateless"),
        F.count_if(F.col("n") > 1).alias("repeated"),
    )
    lengths = {
        c: F.count_if(F.length(c) > most).alias(f"long_{c}") for c, most in DIM_LENGTHS.items() if c != "coin_id"
    }
    dims = dim.groupBy("coin_id").agg(n.alias("dims"), *lengths.values())
    coin, other = F.col("f.coin_id"), F.col("d.coin_id")
    coins = facts.alias("f").join(dims.alias("d"), coin.eqNullSafe(other), "full")
    null_fact, null_dim = coin.isNull() & F.col("facts").isNotNull(), other.isNull() & F.col("dims").isNotNull()
    orphan = F.col("facts").isNotNull() & (F.col("dims").isNull() | coin.isNull())
    too_long = F.length(coin) > DIM_LENGTHS["coin_id"]

    def total(value: Column) -> Column:
        return F.coalesce(F.sum(value), F.lit(0))

    found = {
        "dim_coin_key_not_null": total(F.when(null_dim, F.col("dims"))),
        "dim_coin_key_unique": total(F.when(F.col("dims") > 1, 1)),
        "dim_coin_key_length": total(F.when(F.length(other) > DIM_LENGTHS["coin_id"], F.col("dims"))),
        "dim_coin_symbol_length": total(F.col("long_symbol")),
        "dim_coin_name_length": total(F.col("long_name")),
        "fact_price_coin_not_null": total(F.when(null_fact, F.col("facts"))),
        "fact_price_coin_length": total(F.when(too_long, F.col("facts"))),
        "fact_price_date_not_null": total(F.col("dateless")),
        "fact_price_key_unique": total(F.col("repeated")),
        "fact_price_coin_in_dim": total(F.when(orphan, F.col("facts"))),
    }
    counted = coins.agg(*[value.cast("long").alias(name) for name, value in found.items()])
    rows = F.array(
        *[F.struct(F.lit(name).alias("constraint_name"), F.col(name).alias("violations")) for name in found]
    )
    return counted.select(F.inline(rows))
