"""SimHash near-duplicates: 64-bit fingerprints of word shingles, linked when few bits differ.

Candidates share bits exactly: 64 bits are cut into ``radius + 2`` blocks, and two fingerprints within the radius agree
on at least two of them, so every pair of blocks is a key. Inside a key, fingerprints are compared bit-sliced: one bit
plane per position holds that bit of every fingerprint, distances of 64 fingerprints grow at once in carry-save
counters, and a block of them is abandoned as soon as all are beyond the radius.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierloom.llm.common import free_name, stored
from tierloom.llm.components import components

SHINGLE = 3
RADIUS = 2
SEED = 42
# Fingerprints of one key that a task compares; a key with more is divided by further blocks of bits.
BUCKET = 4096
# Queries whose distances to the fingerprints of a key are counted together.
QUERIES_AT_ONCE = 256


def fingerprint(text: str | None, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """Majority of the bits of the shingles' XXH64; 0 for no words, the whole sequence if words are few."""
    words = text.encode("utf-8", "replace").lower().split() if text else []
    if not words:
        return 0
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(b" ".join(words), seed)
    parts = map(b" ".join, zip(*(words[i:] for i in range(shingle)), strict=False))
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(part, seed) for part in parts), dtype=np.uint64, count=len(words) - shingle + 1)
    counts = np.zeros(64, dtype=np.int64)
    for start in range(0, len(hashes), 1 << 14):
        octets = hashes[start : start + (1 << 14)].astype("<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(octets, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return sum(1 << i for i in np.flatnonzero(2 * counts > len(hashes)).tolist())


def fingerprints(docs: DataFrame, text: str = "text", into: str = "fingerprint", shingle: int = SHINGLE) -> DataFrame:
    """Add the fingerprint of every whole text as a (signed) long; null and wordless texts have 0."""

    @F.arrow_udf("long")
    def computed(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            values = np.array([fingerprint(value.as_py(), shingle) for value in texts], dtype=np.uint64)
            yield pa.array(values.view(np.int64), pa.int64())

    return docs.withColumn(into, computed(F.col(text)))


def planes_of(values: np.ndarray) -> np.ndarray:
    """Bit planes: row i holds bit i of every value, 64 values to a word, filled up with zeros."""
    octets = np.ascontiguousarray(values.astype("<u8")).view(np.uint8).reshape(-1, 8)
    bits = np.unpackbits(octets, axis=1, bitorder="little").T
    padded = np.zeros((64, -(-len(values) // 64) * 64), dtype=np.uint8)
    padded[:, : len(values)] = bits
    return np.packbits(padded, axis=1, bitorder="little").view("<u8")


def within(planes: np.ndarray, queries: np.ndarray, radius: int) -> np.ndarray:
    """For every query, a bit per value of the planes: set if they differ in at most ``radius`` bits.

    ``counters[k]`` holds bit k of 64 distances to a word. They start with a bias, so that a distance beyond the radius
    carries out of the last counter; carries are kept, and words in which every distance has carried are abandoned.
    """
    width = (radius + 1).bit_length()
    # A distance d carries out of the counters at 2**width; from 2**width - 1 - radius on, that means d > radius.
    bias = (1 << width) - 1 - radius
    ones = np.uint64(0xFFFFFFFFFFFFFFFF)
    shape = (len(queries), planes.shape[1])
    live = np.arange(shape[1])
    near = np.zeros(shape, dtype=np.uint64)
    counters = [np.full(shape, ones if bias >> k & 1 else 0, dtype=np.uint64) for k in range(width)]
    beyond = np.zeros(shape, dtype=np.uint64)
    for i in range(64):
        flip = np.where(queries >> np.uint64(i) & np.uint64(1), ones, np.uint64(0))[:, None]
        carry = planes[i][None, :] ^ flip
        for k in range(width):
            counters[k], carry = counters[k] ^ carry, counters[k] & carry
        beyond |= carry
        if i % 8 == 7:
            kept = (beyond != ones).any(axis=0)
            if not kept.all():
                live, planes, beyond = live[kept], planes[:, kept], beyond[:, kept]
                counters = [c[:, kept] for c in counters]
                if not len(live):
                    return near
    near[:, live] = ~beyond
    return near


def links(values: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Star edges (position, smaller position) that connect all values within the radius, directly or by others."""
    count = len(values)
    planes = planes_of(values)
    near = np.empty((count, count), dtype=bool)
    for start in range(0, count, QUERIES_AT_ONCE):
        bits = within(planes, values[start : start + QUERIES_AT_ONCE], radius).astype("<u8").view(np.uint8)
        near[start : start + QUERIES_AT_ONCE] = np.unpackbits(bits, axis=1, bitorder="little")[:, :count]
    label = np.arange(count, dtype=np.int32)
    while True:
        least = label.copy()
        # The smallest label near each value, for some values at a time.
        for start in range(0, count, QUERIES_AT_ONCE):
            part = slice(start, start + QUERIES_AT_ONCE)
            least[part] = np.minimum(least[part], np.where(near[part], label[None, :], count).min(axis=1))
        least = least[least]
        if (least == label).all():
            return [(i, j) for i, j in enumerate(label.tolist()) if i != j]
        label = least


def _cut(bits: list[int], parts: int) -> list[list[int]]:
    """Bit positions in consecutive blocks of nearly equal length."""
    edges = [round(i * len(bits) / parts) for i in range(parts + 1)]
    return [bits[a:b] for a, b in zip(edges, edges[1:], strict=False) if b > a]


def _mask(bits: list[int]) -> int:
    value = sum(1 << b for b in bits)
    return value - (1 << 64) if value >> 63 else value


def _keys(value: Column, radius: int) -> tuple[Column, list[list[int]]]:
    """An array of (number, bits) keys, one per pair of blocks, and the bits that each key leaves open."""
    blocks = _cut(list(range(64)), radius + 2)
    pairs = list(combinations(range(len(blocks)), 2))
    shared = [blocks[a] + blocks[b] for a, b in pairs]
    array = F.array(
        *[F.struct(F.lit(n).alias("n"), value.bitwiseAND(F.lit(_mask(s))).alias("bits")) for n, s in enumerate(shared)]
    )
    return array, [[b for b in range(64) if b not in s] for s in shared]


def _compare(grouped: DataFrame, radius: int) -> DataFrame:
    """Edges (u, v) of the groups in an array column ``values``."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            us, vs = [], []
            for group in batch.column(0):
                signed = np.sort(np.asarray(group.as_py(), dtype=np.int64))
                for i, j in links(signed.view(np.uint64), radius):
                    us.append(int(signed[i]))
                    vs.append(int(signed[j]))
            if us:
                yield pa.RecordBatch.from_arrays([pa.array(us), pa.array(vs)], names=["u", "v"])

    return grouped.select("values").mapInArrow(step, "u long, v long")


def similar(prints: DataFrame, radius: int = RADIUS, bucket: int = BUCKET) -> DataFrame:
    """Edges (u, v) between distinct fingerprints (column ``value``) that connect all pairs within the radius.

    A key with more than ``bucket`` fingerprints is divided: of the bits it leaves open, cut into ``radius + 1`` blocks,
    one block must agree as well, which gives finer keys of which no pair within the radius escapes. This repeats until
    every key is small; a key that leaves b bits open holds 2**b distinct fingerprints at most, so it ends.
    """
    keys, open_bits = _keys(F.col("value"), radius)
    # A path of key numbers leads to the bits that are still open under it.
    paths = {str(n): bits for n, bits in enumerate(open_bits)}
    level = prints.select("value", F.explode(keys).alias("k")).select(
        "value", F.col("k.n").cast("string").alias("path"), "k.bits"
    )
    found = None
    while True:
        # Counting gathers nothing; keys of one fingerprint end here.
        # Stored before the join, so that adaptive execution can divide a key with many of them.
        sizes = stored(level.groupBy("path", "bits").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "simhash-sizes")
        shared = stored(level.join(sizes, ["path", "bits"]), "simhash-shared")
        small = shared.filter(F.col("n") <= bucket).groupBy("path", "bits").agg(F.collect_list("value").alias("values"))
        edges = stored(_compare(small, radius), "simhash-edges")
        found = edges if found is None else found.unionByName(edges)
        large = shared.filter(F.col("n") > bucket)
        wide = [row["path"] for row in large.select("path").distinct().collect()]  # paths, a few dozen at most
        if not wide:
            return found
        cuts, further = [], {}
        for path in wide:
            for n, part in enumerate(_cut(paths[path], radius + 1)):
                further[f"{path}.{n}"] = [b for b in paths[path] if b not in part]
                kept = _mask([b for b in range(64) if b not in further[f"{path}.{n}"]])
                finer_key = F.struct(
                    F.lit(f"{path}.{n}").alias("path"), F.col("value").bitwiseAND(F.lit(kept)).alias("bits")
                )
                cuts.append(F.when(F.col("path") == path, finer_key))
        finer = large.select("value", F.explode(F.array_compact(F.array(*cuts))).alias("k"))
        level, paths = finer.select("value", "k.path", "k.bits"), further


def classes(
    docs: DataFrame, id_column: str = "doc_id", text: str = "text", shingle: int = SHINGLE, radius: int = RADIUS,
    bucket: int = BUCKET,
) -> DataFrame:
    """doc_id, fingerprint (signed long), root (a fingerprint that names the component) and component_id for every row.

    Texts are read once; what is shuffled are ids and fingerprints, and equal fingerprints become one before anything is
    compared. Null and wordless texts share the fingerprint 0. A null id is never a component id unless a component
    has no other; repeated ids are rows of their own; an empty table gives no rows.
    """
    named = docs.select(F.col(id_column).alias("doc_id"), F.col(text).alias("text"))
    prints = stored(fingerprints(named, "text", "fingerprint", shingle).drop("text"), "simhash-prints")
    least = stored(
        prints.groupBy(F.col("fingerprint").alias("value")).agg(F.min("doc_id").alias("least")), "simhash-values"
    )
    linked = components(similar(least.select("value"), radius, bucket))
    rooted = least.join(linked.withColumnRenamed("node", "value"), "value", "left").select(
        "value", "least", F.coalesce("root", "value").alias("root")
    )
    ids = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    found = rooted.join(ids, "root").select(F.col("value").alias("fingerprint"), "root", "component_id")
    return prints.join(found, "fingerprint").select("doc_id", "fingerprint", "root", "component_id")


def simhash_report(docs: DataFrame, **options) -> DataFrame:
    """doc_id, fingerprint as 16 hexadecimal digits, component_id."""
    found = classes(docs, **options)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")


def keep_representatives(docs: DataFrame, id_column: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """One document of each component, that with the smallest id, with its own columns.

    Of several rows with that id one stays, and so does one row of a component without any id.
    """
    found = stored(classes(docs, id_column, text, **options), "simhash-classes")
    first = found.filter(F.col("doc_id").eqNullSafe(F.col("component_id")))
    # Ids that stand in several components may have rows that are not the first of theirs.
    roots = found.groupBy("doc_id").agg(F.min("root").alias("low"), F.max("root").alias("high"))
    spread = roots.filter("low <> high").select("doc_id", F.lit(True).alias("spread"))
    counted = first.groupBy("doc_id", "root").agg(F.count(F.lit(1)).alias("n"))
    chosen = stored(counted.join(spread, "doc_id", "left"), "simhash-chosen")
    key, mark, group = (free_name(docs, name) for name in ("chosen_id", "chosen_print", "chosen_root"))
    shared = "n > 1 or doc_id is null or spread is not null"
    plain = chosen.filter(f"not ({shared})").select(F.col("doc_id").alias(key))
    once = docs.join(plain, F.col(id_column) == F.col(key), "left_semi")
    several = chosen.filter(shared)
    if several.isEmpty():
        return once
    # Rows that share their id, in one component or over several, or have none: one row of each root, told by the fingerprint.
    wanted = several.select("root").join(found.select("fingerprint", "root", "component_id").distinct(), "root")
    prints = wanted.select(
        F.col("fingerprint").alias(mark), F.col("root").alias(group), F.col("component_id").alias(key)
    )
    marked = fingerprints(docs, text, mark).join(prints, mark)
    same = marked.filter(F.col(id_column).eqNullSafe(F.col(key))).dropDuplicates([group])
    return once.unionByName(same.select(docs.columns))
