"""Helpers shared by the operators: word splitting, hashes, Arrow steps and stored intermediate tables."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tierloom.workspace import release, stored  # noqa: F401 - the operators take them from here

# Words are runs of anything but these six control characters and the space.
SPACE_CLASS = r"[\x20\x09-\x0D]"


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def as_text(column: str | Column) -> Column:
    """A text column with null as the empty text."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def remainder(column: str, modulus: int) -> Column:
    """crc32 of an id as text, modulo a number; null for a null id."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % modulus


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores in front until no column of the table has it (in any case of letters)."""
    taken = {column.lower() for column in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def turns(rows: DataFrame, keys: list[str], name: str, label: str) -> DataFrame:
    """Add a running number from 0 to the rows of each key, in no special order, without bringing a key into one task.

    Rows are stored with their partition; the counts per key and partition say where each partition goes on, so a task
    numbers what one partition has of a key. Key columns may not be null.
    """
    part, place, before = (free_name(rows, n) for n in ("part", "place", "before"))
    kept = stored(rows.withColumns({part: F.spark_partition_id(), place: F.monotonically_increasing_id()}), label)
    counts = kept.groupBy(*keys, part).agg(F.count(F.lit(1)).alias(before))
    earlier = Window.partitionBy(*keys).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.withColumn(before, F.coalesce(F.sum(before).over(earlier), F.lit(0)))
    within = F.row_number().over(Window.partitionBy(*keys, part).orderBy(place)) - 1
    numbered = kept.withColumn(name, within).join(starts, [*keys, part])
    return numbered.withColumn(name, F.col(name) + F.col(before)).drop(part, place, before)


def arrow_step(function: Callable[[pa.RecordBatch], pa.RecordBatch | None]) -> Callable:
    """Turn a function of one Arrow batch into one of an iterator of batches, for ``mapInArrow``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                out = function(batch)
                if out is not None and out.num_rows:
                    yield out

    return run


def maximal_stretches(scores: Iterable[float]) -> Iterator[tuple[int, int]]:
    """(first, last) of all maximal scoring stretches, by Ruzzo and Tompa's linear scan."""
    total = 0.0
    # Candidates: first, last, total before and after, place of the nearest candidate below that starts lower.
    stack: list[tuple[int, int, float, float, int]] = []
    for i, score in enumerate(scores):
        left, total = total, total + score
        if score <= 0:
            continue
        first, j = i, len(stack) - 1
        while True:
            while j >= 0 and stack[j][2] >= left:
                j = stack[j][4]
            if j < 0:
                # Nothing before starts lower, so nothing later can reach into it.
                yield from ((s[0], s[1]) for s in stack)
                stack = [(first, i, left, total, -1)]
                break
            if stack[j][3] >= total:
                stack.append((first, i, left, total, j))
                break
            first, left, following = stack[j][0], stack[j][2], stack[j][4]
            del stack[j:]
            j = following
    yield from ((s[0], s[1]) for s in stack)
