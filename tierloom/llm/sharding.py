"""Reproducible shuffling into shards: a Feistel permutation with cycle walking over global row numbers.

Every row gets a number from 0 to N-1 that depends on the rows alone, not on partitions. A keyed permutation of those
numbers gives the place in the shuffled order; place modulo shards is the shard, place divided by shards the slot, so
shard sizes differ by one at most, slots have no gaps, and both can be computed, and inverted, without the table.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tierloom.llm.common import as_text, free_name, release, stored, turns

SHARDS = 40
SEED = 20240607
ROUNDS = 6
# Distinct rows are numbered in this many independent groups; a group is sorted by one task.
NUMBERING_GROUPS = 4096
# Equal rows that one step tells apart, and rows with texts that one task puts in order.
AT_ONCE = 1 << 16
SORTED = 1 << 12


def _mix(values: np.ndarray, key: int) -> np.ndarray:
    """A 64-bit finaliser (xor, shift, multiply) as the round function."""
    with np.errstate(over="ignore"):
        x = values + np.uint64(key)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _round_keys(seed: int) -> list[int]:
    return [int(_mix(np.array([seed * ROUNDS + r], dtype=np.uint64), 0x9E3779B97F4A7C15)[0]) for r in range(ROUNDS)]


def _half_bits(rows: int) -> int:
    """Bits of one half of the smallest domain 2**(2*bits) that holds all row numbers."""
    return max(1, math.ceil(max(rows - 1, 1).bit_length() / 2))


def _once(x: np.ndarray, bits: int, keys: list[int], inverse: bool) -> np.ndarray:
    mask, shift = np.uint64((1 << bits) - 1), np.uint64(bits)
    left, right = x >> shift, x & mask
    for key in reversed(keys) if inverse else keys:
        if inverse:
            left, right = right ^ (_mix(left, key) & mask), left
        else:
            left, right = right, left ^ (_mix(right, key) & mask)
    return (left << shift) | right


def permute(numbers: np.ndarray, rows: int, seed: int = SEED, inverse: bool = False) -> np.ndarray:
    """Permute row numbers 0..rows-1; a value outside the range walks its cycle until it is inside."""
    bits, keys = _half_bits(rows), _round_keys(seed)
    out = _once(np.asarray(numbers).astype(np.uint64), bits, keys, inverse)
    outside = out >= np.uint64(rows)
    while outside.any():
        out[outside] = _once(out[outside], bits, keys, inverse)
        outside = out >= np.uint64(rows)
    return out.astype(np.int64)


def row_at(shard: int, slot: int, rows: int, shards: int = SHARDS, seed: int = SEED) -> int:
    """The row number that sits in a shard's slot."""
    place = slot * shards + shard
    if not (0 <= shard < shards and 0 <= place < rows):
        raise ValueError("no such slot")
    return int(permute(np.array([place]), rows, seed, inverse=True)[0])


def numbered(counted: DataFrame, order: list[Column], group: Column, n: str, name: str) -> DataFrame:
    """Add to distinct rows that stand for ``n`` rows each the first of as many gapless global numbers.

    Rows are numbered inside each of ``NUMBERING_GROUPS`` groups; a table of group sizes (bounded by the number of
    groups) gives each group its offset.
    """
    bucket, before = (free_name(counted, column) for column in ("bucket", "before"))
    dealt = counted.withColumn(bucket, F.pmod(group, F.lit(NUMBERING_GROUPS)).cast("int"))
    sizes = dealt.groupBy(bucket).agg(F.sum(n).alias(before))
    earlier = Window.orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(bucket, F.coalesce(F.sum(before).over(earlier), F.lit(0)).alias(before))
    within = Window.partitionBy(bucket).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    placed = dealt.withColumn(name, F.coalesce(F.sum(n).over(within), F.lit(0)))
    # At most NUMBERING_GROUPS rows of two numbers each.
    joined = placed.join(F.broadcast(offsets), bucket)
    return joined.withColumn(name, F.col(before) + F.col(name)).drop(bucket, before)


def spread(counted: DataFrame, n: str, turn: str) -> DataFrame:
    """Each row ``n`` times, told apart by ``turn`` from 0. Rows that stand for many are dealt to several tasks first."""
    few = counted.filter(F.col(n) <= AT_ONCE).withColumn(turn, F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1)))
    starts = F.sequence(F.lit(0).cast("long"), F.col(n) - 1, F.lit(AT_ONCE).cast("long"))
    parts = counted.filter(F.col(n) > AT_ONCE).withColumn(turn, F.explode(starts))
    # A number given is kept by adaptive execution, which would join the few rows there are before they grow.
    tasks = int(counted.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = parts.repartition(tasks, *[F.col(c) for c in parts.columns])
    many = dealt.withColumn(turn, F.explode(F.sequence(F.col(turn), F.least(F.col(turn) + AT_ONCE, F.col(n)) - 1)))
    return few.unionByName(many)


def measures(text: str | Column) -> dict[str, Column]:
    """Size (UTF-8 bytes plus 16) and CRC-32 of a text; a null text counts as the empty one."""
    value = as_text(text)
    return {"size": (F.octet_length(value) + 16).cast("long"), "text_crc32": F.crc32(value.cast("binary"))}


def places(keys: DataFrame, shards: int = SHARDS, seed: int = SEED, turn: str | None = None) -> DataFrame:
    """Add ``shard`` and ``slot`` to a narrow table, numbered by all its columns.

    Equal rows are interchangeable: they are counted before anything is shuffled, numbered as one, and told apart again
    by a running number (the column ``turn``, if named). Nulls sort first; an empty table stays empty.
    """
    columns = [F.col(c) for c in keys.columns]
    n, first, again = (free_name(keys, name) for name in ("n", "first", "again"))
    counted = keys.groupBy(*columns).agg(F.count(F.lit(1)).alias(n))
    placed = stored(numbered(counted, [c.asc_nulls_first() for c in columns], F.xxhash64(*columns), n, first), "shard-numbers")
    rows = placed.agg(F.sum(n)).first()[0] or 0

    @F.pandas_udf("long")
    def shuffled(numbers: pd.Series) -> pd.Series:
        return pd.Series(permute(numbers.to_numpy(), rows, seed))

    turned = spread(placed, n, again)
    place = free_name(turned, "place")
    out = turned.withColumn(place, shuffled(F.col(first) + F.col(again)))
    return out.select(
        *columns, *([F.col(again).alias(turn)] if turn else []), (F.col(place) % shards).cast("int").alias("shard"),
        F.floor(F.col(place) / shards).cast("long").alias("slot"),
    )


def shard_documents(
    docs: DataFrame, id_column: str = "doc_id", text: str = "text", shards: int = SHARDS, seed: int = SEED
) -> DataFrame:
    """One row per document: id, size, text_crc32, law, shard, slot, grown_shard.

    Only ids, sizes and checksums are shuffled. Null and empty texts have size 16 and checksum 0; null ids are dealt
    like others; repeated rows each get a slot of their own; an empty table gives no rows. Rows are numbered by
    (id, checksum, size), so the result does not depend on files or partitions.
    """
    keys = docs.select(F.col(id_column).alias("doc_id"), *[c.alias(n) for n, c in measures(text).items()])
    placed = places(keys.select("doc_id", "text_crc32", "size"), shards, seed)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def with_places(docs: DataFrame, id_column: str = "doc_id", text: str = "text", shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """All columns of the documents plus ``shard`` and ``slot`` (columns of those names are replaced).

    The texts meet their places in one join on (id, checksum, size). Rows that repeat these three are told apart by a
    running number that is made only for them, so each keeps its own slot.
    """
    docs = docs.drop("shard", "slot")
    key, crc, size, turn = (free_name(docs, n) for n in ("key", "crc", "size", "turn"))
    made = measures(text)
    # The id travels as text, with null told apart from any id, so that one equality joins all of them.
    identity = F.concat_ws(":", F.col(id_column).cast("string"), F.when(F.col(id_column).isNull(), "null").otherwise("id"))
    marked = docs.select("*", identity.alias(key), made["text_crc32"].alias(crc), made["size"].alias(size))
    on = [key, crc, size]
    keys = stored(marked.select(*on), "shard-keys")
    placed = stored(places(keys, shards, seed, turn), "shard-places")
    many = free_name(marked, "many")
    repeated = stored(
        keys.groupBy(*on).agg(F.count(F.lit(1)).alias(many)).filter(F.col(many) > 1), "shard-repeats"
    )
    release(keys)
    if repeated.isEmpty():
        return marked.join(placed, on).drop(*on, turn)
    once = marked.join(repeated, on, "left_anti").join(placed, on)
    several = marked.join(repeated, on)
    few = several.filter(F.col(many) <= SORTED).withColumn(
        turn, F.row_number().over(Window.partitionBy(*on).orderBy(F.xxhash64(F.col(text)))) - 1
    )
    if repeated.filter(F.col(many) > SORTED).isEmpty():
        told = few
    else:
        told = few.unionByName(turns(several.filter(F.col(many) > SORTED), on, turn, "shard-hot"))
    return once.unionByName(told.drop(many).join(placed, [*on, turn]).select(once.columns)).drop(*on, turn)
