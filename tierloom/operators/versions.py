"""Corrections: the latest version per key, change application, and comparison of two snapshots."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tierloom.operators.ranking import top_per_group
from tierloom.workspace import fresh_folder


def latest_version(df: DataFrame, keys: Sequence[str], newest_first: Sequence[Column]) -> DataFrame:
    """The authoritative row per key: first in the given order, which should leave no ties."""
    return top_per_group(df, keys, newest_first)


def apply_changes(
    current: DataFrame,
    changes: DataFrame,
    keys: Sequence[str],
    sequence: str,
    deleted: str | None = None,
) -> DataFrame:
    """Upsert by explicit sequence, not by arrival: per key the row with the highest ``sequence`` stays.

    Rows of ``changes`` win over ``current`` at equal sequence. ``deleted`` names a boolean column of ``changes``
    that marks removals.
    """
    rank = "_from_changes"
    incoming = changes.withColumn(rank, F.lit(1))
    present = current.withColumn(rank, F.lit(0))
    if deleted:
        present = present.withColumn(deleted, F.lit(False))
    merged = top_per_group(
        present.unionByName(incoming), keys, [F.col(sequence).desc_nulls_last(), F.col(rank).desc()]
    ).drop(rank)
    return merged.filter(~F.coalesce(F.col(deleted), F.lit(False))).drop(deleted) if deleted else merged


def touched_partitions(current: DataFrame, changes: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Rows of ``current`` in partitions that have changes.

    The range of the changed values prunes the scan at plan time. Inside it the semi join does, at run time: a predicate
    on its right side is what Spark asks for to do so. NULLs equal nothing; their partitions are read if any change has
    one.
    """
    names = list(partition_by)
    bounds = changes.agg(*[f(name).alias(f"{i}{f.__name__}") for i, name in enumerate(names) for f in (F.min, F.max)]).first()
    within = reduce(
        and_, [F.col(name).between(F.lit(bounds[f"{i}min"]), F.lit(bounds[f"{i}max"])) for i, name in enumerate(names)]
    )
    touched = changes.select(*names).filter(within).distinct()
    same = current.filter(within).join(touched, on=names, how="left_semi")
    some_null = reduce(or_, [F.col(name).isNull() for name in names])
    if changes.filter(some_null).isEmpty():
        return same
    return same.unionByName(current.filter(some_null))


def upsert_partitions(
    folder: str, changes: DataFrame, keys: Sequence[str], sequence: str, partition_by: Sequence[str]
) -> None:
    """Upsert into a partitioned Parquet folder, rewriting only the partitions that have changes.

    The partition columns have to be part of the key, so that a correction stays in its partition. Partitions without
    changes are neither read nor written. Partitions are replaced one after the other: a reader may meet some of them
    renewed and others not; where that matters, publish the result as a new version instead.
    """
    outside = set(partition_by) - set(keys)
    if outside:
        raise ValueError(f"partition columns outside the key: {sorted(outside)}")
    spark = changes.sparkSession
    current = spark.read.parquet(folder)
    same = touched_partitions(current, changes, partition_by)
    merged = apply_changes(same, changes, keys, sequence)
    # Written elsewhere first: the partitions are read and replaced by the same job otherwise.
    staged = fresh_folder(spark, "upsert")
    merged.write.parquet(staged)
    (
        spark.read.parquet(staged)
        .select(*current.columns)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_by)
        .parquet(folder)
    )


def compare_snapshots(
    old: DataFrame, new: DataFrame, keys: Sequence[str], values: Sequence[str]
) -> DataFrame:
    """Keys that were added, removed or changed, with both versions of the values.

    One grouped pass over the union instead of a full outer join: it combines before the shuffle, treats NULL keys as
    equal, and a key repeated in a snapshot gives one row rather than all pairs (the greatest values count).
    """
    keys = list(keys)

    def tagged(df: DataFrame, side: str) -> DataFrame:
        return df.select(*keys, F.struct(*values).alias("v"), F.lit(side).alias("side"))

    def version(side: str) -> Column:
        return F.max(F.when(F.col("side") == side, F.col("v")))

    sides = tagged(old, "old").unionByName(tagged(new, "new"))
    paired = sides.groupBy(*keys).agg(version("old").alias("o"), version("new").alias("n"))
    status = (
        F.when(F.col("o").isNull(), "added")
        .when(F.col("n").isNull(), "removed")
        .when(~F.col("o").eqNullSafe(F.col("n")), "changed")
    )
    return (
        paired.withColumn("status", status)
        .filter(F.col("status").isNotNull())
        .select(
            *keys,
            "status",
            *[F.col(f"o.{name}").alias(f"old_{name}") for name in values],
            *[F.col(f"n.{name}").alias(f"new_{name}") for name in values],
        )
    )


def validity(history: DataFrame, keys: Sequence[str], values: Sequence[str], at: str) -> DataFrame:
    """(keys, values, valid_from, valid_to) over any number of extractions: one row per run of equal values of a key.

    ``at`` is the extraction of a row. An extraction that lacks a key ends its run; ``valid_to`` is the first extraction
    that no longer shows the values, NULL while the newest one does. A key that an extraction has several times counts
    with its greatest values. Rows of one key meet in one task, at most one per extraction.
    """
    keys, values = list(keys), list(values)
    state = F.struct(*[F.col(name) for name in values])
    once = history.groupBy(*keys, F.col(at).alias("_at")).agg(F.max(state).alias("_state"))
    # The extractions, of which there are few, say which one follows; an absence is a gap between two of them.
    times = history.select(F.col(at).alias("_at")).distinct()
    ordered = Window.orderBy("_at")
    numbered = times.select("_at", F.row_number().over(ordered).alias("_place"), F.lead("_at").over(ordered).alias("_next"))
    placed = once.join(numbered, "_at")
    of_key = Window.partitionBy(*keys).orderBy("_place")
    before = F.lag(F.struct("_place", "_state")).over(of_key)
    same = (before["_place"] == F.col("_place") - 1) & before["_state"].eqNullSafe(F.col("_state"))
    marked = placed.withColumn("_new", (~F.coalesce(same, F.lit(False))).cast("int"))
    runs = marked.withColumn("_run", F.sum("_new").over(of_key))
    intervals = runs.groupBy(*keys, "_run").agg(
        F.first("_state").alias("_state"), F.min("_at").alias("valid_from"), F.max(F.struct("_place", "_next")).alias("_end")
    )
    return intervals.select(*keys, *[F.col(f"_state.`{name}`") for name in values], "valid_from", F.col("_end._next").alias("valid_to"))
