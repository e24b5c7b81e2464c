"""Data checks on published tables. Every check is a distributed query giving (check, passed, violations)."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierloom.operators.joins import available_rows, matching, missing_rows


@dataclass(frozen=True)
class Check:
    """A name and an aggregate over one table that gives the number of violations."""

    name: str
    violations: Column
    # The aggregate is taken over the groups of this column (with their number of rows ``n``) instead of the rows.
    key: str | None = None


def row_count_is(name: str, expected: int) -> Check:
    """Violations: distance from the expected number of rows."""
    return Check(name, F.abs(F.count(F.lit(1)) - F.lit(expected)))


def not_empty(name: str) -> Check:
    return Check(name, (F.count(F.lit(1)) == 0).cast("bigint"))


def has_columns(name: str, df: DataFrame, required: Sequence[str]) -> Check:
    """Violations: number of required columns that are absent. Only the schema is looked at."""
    return Check(name, F.lit(len(set(required) - set(df.columns))))


def unique_key(name: str, key: str) -> Check:
    """Violations: rows beyond one per distinct non-NULL key."""
    return Check(name, F.sum("n") - F.count(F.col(key)), key)


def no_row(name: str, condition: Column) -> Check:
    """Violations: rows for which the condition is true."""
    return Check(name, F.count_if(condition))


def every_row(name: str, condition: Column) -> Check:
    """Violations: rows for which the condition is not true, NULL included."""
    return no_row(name, ~F.coalesce(condition, F.lit(False)))


def is_missing(column: str) -> Column:
    return F.col(column).isNull()


def is_blank(column: str) -> Column:
    return F.col(column).isNull() | (F.col(column) == "")


def _verdict(name: str, violations: Column) -> list[Column]:
    counted = F.coalesce(violations, F.lit(0)).cast("bigint")
    return [F.lit(name).alias("check"), (counted == 0).alias("passed"), counted.alias("violations")]


def _judged(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    slots = [f"c{position}" for position in range(len(checks))]
    totals = df.agg(*[check.violations.alias(slot) for check, slot in zip(checks, slots)])
    verdicts = [F.struct(*_verdict(check.name, F.col(slot))) for check, slot in zip(checks, slots)]
    return totals.select(F.inline(F.array(*verdicts)))


def table_checks(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """Verdicts of all checks on one table: one pass over it, and one for each key that has to be unique.

    Keys are counted in two steps, which combine before the shuffle; several distinct counts in one aggregate would
    first multiply the rows by their number.
    """
    plain = [check for check in checks if check.key is None]
    parts = [_judged(df, plain)] if plain else []
    for check in checks:
        if check.key is not None:
            groups = df.select(check.key).groupBy(check.key).agg(F.count(F.lit(1)).alias("n"))
            parts.append(_judged(groups, [check]))
    return reduce(DataFrame.unionAll, parts)


def _offending(name: str, rows: DataFrame) -> DataFrame:
    return table_checks(rows, [Check(name, F.count(F.lit(1)))])


def selected_is_max(
    name: str, result: DataFrame, recomputed: DataFrame, key: str, value: str, expected: str, tolerance: float
) -> DataFrame:
    """The published value equals an independent recomputation per key; a NULL on either side is a violation.

    ``tolerance`` is relative to the larger of one and the expected value: sums of doubles taken in another order differ
    in their last digits, however large they are.
    """
    pairs = matching(result.select(key, value), recomputed.select(key, expected), key)
    close = F.abs(F.col(value) - F.col(expected)) <= F.lit(tolerance) * F.greatest(F.lit(1.0), F.abs(F.col(expected)))
    return table_checks(pairs, [every_row(name, close)])


def same_row_count(name: str, result: DataFrame, source: DataFrame) -> DataFrame:
    signed = result.select(F.lit(1).alias("s")).unionAll(source.select(F.lit(-1).alias("s")))
    return table_checks(signed, [Check(name, F.abs(F.sum("s")))])


def all_present(name: str, expected: DataFrame, result: DataFrame, keys: Sequence[str]) -> DataFrame:
    return _offending(name, missing_rows(expected, result, keys))


def present_when_available(
    name: str, result: DataFrame, reference: DataFrame, key: str, value: str
) -> DataFrame:
    """For keys the reference side knows, the joined value must not be NULL."""
    return _offending(name, available_rows(result.filter(F.col(value).isNull()), reference, key))


def suite(checks: Iterable[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionAll, checks)


def require(verdicts: DataFrame) -> None:
    """Raise when a check of a suite failed, naming each with its number of violations."""
    failed = [f"{row['check']} ({row['violations']})" for row in verdicts.filter(~F.col("passed")).collect()]
    if failed:
        raise AssertionError("checks failed: " + ", ".join(sorted(failed)))
