"""Data-quality operators: schema rules, duplicates, jumps, and the full split."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.expressions import ratio_change
from tidemark.operators.series import calendar_gaps
from tidemark.scale import join_keyed, materialise, previous_value
from tidemark.schemas import FACT_KEY, MEASURES

# Texts stored with quarantined rows, and the jump limit.
ANOMALY_REASON = "Day-over-day price change > 50%"
SCHEMA_REASON = "Schema validation failed: "
JUMP_LIMIT = 0.5


@dataclass(frozen=True)
class Rule:
    """Type, nullability and lower bound of one column."""

    column: str
    dtype: str
    nullable: bool = False
    above: float | None = None
    at_least: float | None = None

    def typed(self) -> Column:
        """The value in its declared type; null where it cannot be read, or NaN."""
        value = F.col(self.column).try_cast(self.dtype)
        return F.when(~F.isnan(value), value) if self.dtype == "double" else value

    def checks(self, given: str) -> list[tuple[str, Column]]:
        """(check name, failed) pairs in the order they are reported.

        ``given`` is the column's type; a column of the declared type cannot
        fail to be read as it.
        """
        raw, typed = F.col(self.column), self.typed()
        missing = raw.isNull()
        if self.dtype == "double":
            missing = missing | F.isnan(raw.try_cast("double"))
        found = []
        if given != self.dtype:
            found.append((f"coerce_dtype('{self.dtype}')", ~missing & typed.isNull()))
        if not self.nullable:
            found.append(("not_nullable", missing))
        if self.above is not None:
            found.append((f"greater_than({self.above:g})", typed <= self.above))
        if self.at_least is not None:
            found.append((f"greater_than_or_equal_to({self.at_least:g})", typed < self.at_least))
        return found


_COIN = Rule("coin_id", "string")
_PRICE = Rule("price", "double", above=0)
_DATE = Rule("date", "date")
_VOLUME = Rule("volume", "double", nullable=True, at_least=0)
_MARKET_CAP = Rule("market_cap", "double", nullable=True, at_least=0)

CURRENT = (_COIN, _PRICE, Rule("symbol", "string"), _DATE, _VOLUME, _MARKET_CAP, Rule("name", "string"))
HISTORICAL = (_COIN, _PRICE, _DATE, _VOLUME, _MARKET_CAP)


def rules_for(data_type: str) -> tuple[Rule, ...]:
    if data_type == "current":
        return CURRENT
    if data_type == "historical":
        return HISTORICAL
    raise ValueError("data_type must be 'current' or 'historical'")


def _require_columns(df: DataFrame, rules: Sequence[Rule], order: Sequence[str]) -> None:
    expected = {rule.column for rule in rules}
    missing = expected - set(df.columns)
    extra = set(df.columns) - expected - set(order)
    if missing or extra:
        raise ValueError(f"columns missing: {sorted(missing)}, not in schema: {sorted(extra)}")


def _checks(df: DataFrame, rules: Sequence[Rule]) -> list[tuple[str, str, Column]]:
    """(column, check name, failed) of every check, in schema order."""
    given = dict(df.dtypes)
    return [
        (rule.column, name, failed)
        for rule in rules
        for name, failed in rule.checks(given[rule.column])
    ]


def _failures(checks: Sequence[tuple[str, str, Column]]) -> Column:
    """Array of ``(column, check, value)`` of every failed check, in schema order."""
    cases = [
        F.when(
            failed,
            F.struct(
                F.lit(column).alias("column"),
                F.lit(name).alias("check"),
                F.col(column).cast("string").alias("value"),
            ),
        )
        for column, name, failed in checks
    ]
    return F.array_compact(F.array(*cases))


def _first_failure(checks: Sequence[tuple[str, str, Column]]) -> Column:
    """Position of the first failed check; null if all pass.

    Plain conditionals, unlike the array of ``_failures``, stay in generated code.
    """
    return F.coalesce(*[F.when(failed, F.lit(i)) for i, (_, _, failed) in enumerate(checks)])


def schema_check(df: DataFrame, data_type: str, order: Sequence[str] = ()) -> DataFrame:
    """Input rows plus ``failures``: every check the row fails, empty if none.

    ``order`` names extra columns that fix the row order; any other column
    outside the schema, or a missing one, is an error.
    """
    rules = rules_for(data_type)
    _require_columns(df, rules, order)
    return df.withColumn("failures", _failures(_checks(df, rules)))


def failure_cases(df: DataFrame, data_type: str, order: Sequence[str] = ()) -> DataFrame:
    """One row per failed check: the row's key, column, check and offending value."""
    rules = rules_for(data_type)
    _require_columns(df, rules, order)
    checks = _checks(df, rules)
    # Only failing rows, usually few, pay for the array.
    return df.where(_first_failure(checks).isNotNull()).select(
        F.col("coin_id").cast("string").alias("coin_id"),
        F.col("date").cast("string").alias("date"),
        *order,
        F.inline(_failures(checks)),
    )


def duplicates(rows: DataFrame, keys: Sequence[str] = FACT_KEY) -> DataFrame:
    """All copies of rows whose key occurs more than once; nulls compare equal.

    Keys are counted with map-side combining and joined back, so a key with
    very many copies is neither buffered nor sent to one task.
    """
    return join_keyed(rows, repeated_keys(rows, keys).select(*keys), keys)


def repeated_keys(rows: DataFrame, keys: Sequence[str] = FACT_KEY) -> DataFrame:
    """Keys that occur more than once, with their number of ``copies``."""
    counted = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies"))
    return counted.where(F.col("copies") > 1)


def _with_jump(
    rows: DataFrame,
    order: Sequence[str],
    history: DataFrame | None,
    bounded: bool,
    among: Column | None = None,
) -> DataFrame:
    """``rows`` plus ``_jump``: price moved more than the limit from the row before it (``among``)."""
    ties = [c for c in MEASURES if c in rows.columns and c not in order]
    marked = rows.withColumn("_stored", F.lit(False))
    if history is not None:
        survived = rows if among is None else rows.where(among)
        stored = _stored_before(survived, history).withColumn("_stored", F.lit(True))
        marked = marked.unionByName(stored, allowMissingColumns=True)
    sequence = ["date", *order, *ties]
    marked = previous_value(marked, "coin_id", sequence, "price", "_previous", among, bounded)
    change = F.abs(ratio_change(F.col("price"), F.col("_previous")))
    jump = F.coalesce(change > JUMP_LIMIT, F.lit(False))
    return marked.where(~F.col("_stored")).select(*rows.columns, jump.alias("_jump"))


def _stored_before(rows: DataFrame, history: DataFrame) -> DataFrame:
    """The last stored row of each coin before its first day in ``rows``.

    It joins the sequence as one more row, so the rows themselves never join.
    """
    first_day = rows.groupBy("coin_id").agg(F.min("date").alias("_first"))
    earlier = history.join(first_day, "coin_id").where(F.col("date") < F.col("_first"))
    last = F.max(F.struct("date", "price")).alias("_last")
    return earlier.groupBy("coin_id").agg(last).select("coin_id", "_last.*")


def anomalies(
    rows: DataFrame,
    order: Sequence[str] = (),
    history: DataFrame | None = None,
    bounded: bool = False,
) -> DataFrame:
    """Rows whose price moved more than 50% from the coin's previous row, with the reason.

    The first row of a coin passes unless ``history`` holds earlier stored
    rows. Rows of a day are ordered by ``order``, then by their measures.
    ``bounded`` says that rows per coin are few, as with daily rows.
    """
    jumps = _with_jump(rows, order, history, bounded).where("_jump").drop("_jump")
    return jumps.withColumn("reason", F.lit(ANOMALY_REASON))


class Split:
    """Outcome of a validation. Each part is built when asked for; none is needed for another."""

    def __init__(self, flagged: DataFrame):
        self.flagged = flagged

    @property
    def survivors(self) -> DataFrame:
        """Rows that passed the schema, jumps included."""
        return self.flagged.where(F.col("status") != "failed").drop("status", "reason", "rejected")

    @property
    def valid(self) -> DataFrame:
        return self.flagged.where(F.col("status") == "valid").drop("status", "reason", "rejected")

    @property
    def quarantined(self) -> DataFrame:
        return self.flagged.where(F.col("status") != "valid").drop("status")

    @property
    def duplicates(self) -> DataFrame:
        return duplicates(self.survivors)

    @property
    def gaps(self) -> DataFrame:
        return calendar_gaps(self.survivors)


def flag(
    df: DataFrame,
    data_type: str,
    order: Sequence[str] = (),
    history: DataFrame | None = None,
    reason_mode: str = "row",
    bounded: bool = False,
) -> DataFrame:
    """Every input row once, typed, with ``status``, ``reason`` and ``rejected``.

    ``status`` is ``valid``, ``anomaly`` or ``failed``. Failed rows stay in the
    frame but count for no other row: a price is compared with the row that
    survived before it, so one pass over the input does. ``rejected`` is the
    given value that the first failing check refused, as text.
    ``reason_mode="batch"`` gives all failed rows the first failing check of
    the batch instead of their own.
    """
    if reason_mode not in ("row", "batch"):
        raise ValueError("reason_mode must be 'row' or 'batch'")
    rules = rules_for(data_type)
    _require_columns(df, rules, order)
    columns = [rule.column for rule in rules]
    checks = _checks(df, rules)
    rejected = [F.col(column).cast("string") for column, _, _ in checks]
    frame = df.select(
        *[rule.typed().alias(rule.column) for rule in rules],
        *order,
        _first_failure(checks).alias("_failed"),
        F.coalesce(*[F.when(failed, value) for (_, _, failed), value in zip(checks, rejected)]).alias("rejected"),
    )
    failed = F.col("_failed").isNotNull()
    position = F.col("_failed")
    if reason_mode == "batch":
        frame = materialise(frame, "typed")
        position = frame.agg(F.min("_failed")).scalar()
    names = F.array(*[F.lit(name) for _, name, _ in checks])
    judged = _with_jump(frame, order, history, bounded, among=F.col("_failed").isNull())
    jump = F.col("_jump") & ~failed
    return judged.select(
        *columns,
        *order,
        F.when(failed, "failed").when(jump, "anomaly").otherwise("valid").alias("status"),
        F.when(failed, F.concat(F.lit(SCHEMA_REASON), F.get(names, position)))
        .when(jump, F.lit(ANOMALY_REASON))
        .alias("reason"),
        "rejected",
    )


def validate(
    df: DataFrame,
    data_type: str,
    order: Sequence[str] = (),
    history: DataFrame | None = None,
    reason_mode: str = "row",
    bounded: bool = False,
) -> Split:
    """Check a batch and split it into valid rows, quarantined rows, duplicates and gaps."""
    return Split(flag(df, data_type, order, history, reason_mode, bounded))


def report(flagged: DataFrame, gaps: DataFrame, repeated: DataFrame | None = None) -> DataFrame:
    """One row: rows received, passed, quarantined, gaps found, and duplicate copies.

    One pass over the flagged rows; the other counts are scalar subqueries.
    ``repeated`` are the repeated keys with their ``copies``.
    """
    counters = flagged.agg(
        F.count(F.lit(1)).alias("rows_received"),
        F.count_if(F.col("status") == "valid").alias("rows_passed"),
        F.count_if(F.col("status") != "valid").alias("rows_quarantined"),
    ).withColumn("gaps_found", gaps.agg(F.count(F.lit(1))).scalar())
    if repeated is not None:
        copies = F.coalesce(F.sum("copies"), F.lit(0))
        counters = counters.withColumn("duplicates_found", repeated.agg(copies).scalar())
    return counters
