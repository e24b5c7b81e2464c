"""Duplicates by business key and by whole row, in batches and across all runs of a stream."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StructType, VariantType

# Keys that a task remembers as repeating, over all its batches.
REMEMBERED = 4096


def first_arrival(df: DataFrame, keys: Sequence[str], thin: bool = True, remembered: int = REMEMBERED) -> DataFrame:
    """One row per key, the first that arrived; for a stream also across micro-batches and restarts.

    A batch combines copies on the map side before its shuffle. The stateful operator of a stream does not, and one
    key may hold a large part of all rows; there, every task first leaves out copies it can see itself, so that a hot
    key sends about one row per task to its state. State is kept per key, without a watermark. ``thin=False`` saves
    that step where no key repeats much; it may change between runs of a checkpoint. ``remembered`` bounds the keys a
    task keeps in mind from batch to batch; the result does not depend on it, only how many copies reach the state.
    """
    keys = list(keys)
    return (drop_copies_in_task(df, keys, remembered) if thin and df.isStreaming else df).dropDuplicates(keys)


def distinct_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct combinations of ``columns``: only exact copies go, a corrected value stays as a further row."""
    return first_arrival(df.select(*columns), columns)


def watermarked_first_arrival(df: DataFrame, keys: Sequence[str], event_time: str, delay: str) -> DataFrame:
    """Variant with bounded state: copies that arrive more than ``delay`` apart are not recognised as copies."""
    timed = df.withWatermark(event_time, delay)
    return drop_copies_in_task(timed, list(keys)).dropDuplicatesWithinWatermark(list(keys))


def drop_copies_in_task(df: DataFrame, keys: Sequence[str], remembered: int = REMEMBERED) -> DataFrame:
    """Leave out rows whose key an earlier row of the same Arrow batch has, or is known to repeat in the same task.

    Only certain copies go: hashes, computed by Spark, pick candidates, and the keys themselves are compared. What is
    left may still hold copies, so an exact step has to follow. Only the keys and their hash go through Arrow; the other
    columns stay where they are.
    """
    nested = (ArrayType, MapType, StructType, VariantType)
    if any(isinstance(df.schema[key].dataType, nested) for key in keys):
        return df
    first = F.arrow_udf(_first_seen(remembered), "boolean").asNondeterministic()
    return df.filter(first(F.xxhash64(*keys), *[F.col(key) for key in keys]))


def _first_seen(remembered: int) -> Callable[[Iterator[tuple[pa.Array, ...]]], Iterator[pa.Array]]:
    """The function for the tasks. It holds all it needs, so that workers do not have to import this package."""

    def same_keys(rows: pa.Table, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        same = np.ones(len(left), dtype=bool)
        for column in rows.columns[1:]:
            a, b = column.take(pa.array(left)), column.take(pa.array(right))
            equal = pc.or_(pc.fill_null(pc.equal(a, b), False), pc.and_(pc.is_null(a), pc.is_null(b)))
            same &= equal.to_numpy()
        return same

    def first_seen(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        # Keys that repeated in an earlier batch stand before the rows of the current one.
        repeating = None
        for columns in batches:
            rows = pa.table(list(columns), names=[str(i) for i in range(len(columns))])
            seen = rows if repeating is None else pa.concat_tables([repeating, rows])
            offset = seen.num_rows - rows.num_rows
            hashes = seen.column(0).to_numpy()
            _, first, group = np.unique(hashes, return_index=True, return_inverse=True)
            leader = first[group]
            candidates = np.flatnonzero(leader != np.arange(len(hashes)))
            copies = candidates[same_keys(seen, candidates, leader[candidates])]
            keep = np.ones(rows.num_rows, dtype=bool)
            if len(copies):
                keep[copies - offset] = False
                found = np.unique(leader[copies])
                found = found[found >= offset][: max(0, remembered - offset)]
                if len(found):
                    fresh = seen.take(pa.array(found))
                    repeating = fresh if repeating is None else pa.concat_tables([repeating, fresh])
            yield pa.array(keep)

    return first_seen
