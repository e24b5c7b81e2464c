"""Lookup, reference and validation joins.

None of them carries an unconditional broadcast hint: Spark broadcasts a side when its statistics, or at run time
its measured shuffle size, stay under ``spark.sql.autoBroadcastJoinThreshold``; otherwise it sorts and merges, and
adaptive execution splits hot keys.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierloom.sources.files import LINEAGE


def without_lineage(df: DataFrame) -> DataFrame:
    return df.drop(LINEAGE)


def lookup(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Left outer join on one key; rows without a match keep NULLs. Lineage of the lookup side is dropped."""
    return left.join(without_lineage(right), on=key, how="left")


def left_join_where(left: DataFrame, right: DataFrame, key: str, condition: Column) -> DataFrame:
    """Left outer join on a key with a further condition on the right side inside ``ON``.

    In ``WHERE`` the condition would remove unmatched left rows. The right key column is not returned.
    """
    on = (left[key] == right[key]) & condition
    return left.join(right, on, "left").drop(right[key])


def matching(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    return left.join(right, on=key, how="inner")


def missing_rows(expected: DataFrame, actual: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``expected`` without a counterpart in ``actual``.

    The keys of ``actual`` are made distinct first: that combines before the shuffle, so a key repeated many times
    travels once per task, and the join reuses the partitioning.
    """
    return expected.join(actual.select(*keys).distinct(), on=list(keys), how="left_anti")


def available_rows(df: DataFrame, reference: DataFrame, key: str) -> DataFrame:
    """Rows whose key exists on the reference side, each once, however often the key stands there."""
    return df.join(reference.select(key).distinct(), on=key, how="left_semi")

