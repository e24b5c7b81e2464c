"""Removal of long repeated byte strings by a distributed, sparse suffix array with deep-shallow sorting.

Bytes covered by a string of ``length`` bytes that starts anywhere else too are removed. Not every suffix is sorted:

1. Every string of ``length`` bytes belongs to an anchor, the position with the smallest hash of eight bytes among its
   first ``WINDOW`` ones. The choice depends on the string alone, so equal strings have their anchors at the same place,
   and all strings of an anchor hold the ``length - WINDOW + 1`` bytes from it on, its core. One anchor owns the strings
   that start in a short range before it; the bytes of all of them are its context.
2. Anchors whose core is met once end here. Those whose whole context is met again repeat entirely. Both come from
   counts that combine before the shuffle.
3. What is left are anchors at the edges of repeats. The distinct contexts of one core meet in a task, which sorts their
   suffixes from the anchor on, and their prefixes before it backwards: multikey quicksort to a shallow depth, then blind
   tries for what is still equal. From common prefixes in both orders follows which strings occur in two contexts.
4. A core with too many distinct contexts is divided: of the places a string can have relative to its anchor, each half
   shares more bytes, which make finer keys. Halving ends with single strings, so nothing is left out.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierloom.llm.common import as_text, release, stored

LENGTH = 400
# Places in a string where its anchor may be.
WINDOW = 300
GRAM = 8
# Distinct contexts of one core that a task sorts.
GROUP = 1024
# Multikey quicksort compares this many bytes at once, and hands over to blind tries after this many.
CHUNK, SHALLOW = 8, 32
# Strings whose anchors are found at once, which bounds the memory that a long text takes.
AT_ONCE = 1 << 21
# Rows of a batch that a task hands back; batches with texts are a tenth of it.
ROWS_AT_ONCE = 50_000


# Anchors


def anchors(data: bytes, length: int = LENGTH, window: int = WINDOW) -> Iterator[tuple[int, int, int]]:
    """(anchor, first start, last start) of the strings of ``length`` bytes that belong to each anchor."""
    count = len(data) - length + 1
    for begin in range(0, max(count, 0), AT_ONCE):
        part = min(AT_ONCE, count - begin)
        places = part + window - 1
        grams = np.empty(places, dtype=np.uint64)
        for r in range(min(GRAM, places)):
            grams[r::GRAM] = np.frombuffer(data, dtype="<u8", count=-(-(places - r) // GRAM), offset=begin + r)
        with np.errstate(over="ignore"):
            grams *= np.uint64(0x9E3779B97F4A7C15)
            grams ^= grams >> np.uint64(29)
            grams *= np.uint64(0xBF58476D1CE4E5B9)
        # The hash above, the place below: the minimum is the leftmost smallest hash.
        grams &= np.uint64(0xFFFFFFFF00000000)
        grams |= np.arange(places, dtype=np.uint64)
        blocks = np.full((-(-places // window), window), np.iinfo(np.uint64).max, dtype=np.uint64)
        blocks.reshape(-1)[:places] = grams
        upto = np.minimum.accumulate(blocks, axis=1).reshape(-1)
        onward = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].reshape(-1)
        least = np.minimum(onward[:part], upto[window - 1 : window - 1 + part]) & np.uint64(0xFFFFFFFF)
        starts = np.flatnonzero(np.concatenate(([True], least[1:] != least[:-1])))
        lasts = np.concatenate((starts[1:], [part])) - 1
        yield from zip(
            (least[starts].astype(np.int64) + begin).tolist(), (starts + begin).tolist(), (lasts + begin).tolist(), strict=True
        )


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def _hash(data: bytes, seed: int = 0) -> int:
    return _signed(xxhash.xxh3_64_intdigest(data, seed))


# Deep-shallow sorting


def common_prefix(x: bytes, y: bytes, known: int = 0) -> int:
    """Length of the common prefix, of which ``known`` bytes are known to be equal."""
    low, high = known, min(len(x), len(y))
    step = 16
    while low < high and x[low : low + step] == y[low : low + step]:
        low = min(low + step, high)
        step *= 2
    high = min(high, low + step)
    while low < high:
        middle = (low + high + 1) // 2
        if x[low:middle] == y[low:middle]:
            low = middle
        else:
            high = middle - 1
    return low


class _Node:
    """A branch of a blind trie: strings below agree on ``depth`` bytes and differ in the next (-1 for the end)."""

    __slots__ = ("children", "depth")

    def __init__(self, depth: int):
        self.depth = depth
        self.children: dict[int, object] = {}


def _byte(text: bytes, at: int) -> int:
    return text[at] if at < len(text) else -1


def blind_sort(texts: list[bytes], group: list[int], depth: int) -> list[int]:
    """Order strings that agree on ``depth`` bytes with a blind trie, comparing each with one other string only."""
    root: object = [group[0]]
    for i in group[1:]:
        text, path, node = texts[i], [], root
        while isinstance(node, _Node):
            path.append(node)
            node = node.children.get(_byte(text, node.depth)) or next(iter(node.children.values()))
        other = texts[node[0]]
        same = common_prefix(text, other, depth)
        if same == len(text) == len(other):
            node.append(i)
            continue
        above = max((step for step in path if step.depth < same), key=lambda step: step.depth, default=None)
        below = root if above is None else above.children[_byte(text, above.depth)]
        if isinstance(below, _Node) and below.depth == same:
            below.children[_byte(text, same)] = [i]
            continue
        branch = _Node(same)
        branch.children[_byte(other, same)] = below
        branch.children[_byte(text, same)] = [i]
        if above is None:
            root = branch
        else:
            above.children[_byte(text, above.depth)] = branch
    out: list[int] = []
    stack = [root]
    while stack:
        node = stack.pop()
        if isinstance(node, _Node):
            stack.extend(node.children[c] for c in sorted(node.children, reverse=True))
        else:
            out.extend(node)
    return out


def deep_shallow_sort(texts: list[bytes], known: int = 0) -> list[int]:
    """Order of strings of which the first ``known`` bytes are equal."""
    out: list[int] = []
    stack = [(list(range(len(texts))), known, False)]
    while stack:
        group, depth, equal = stack.pop()
        if equal or len(group) < 2:
            out.extend(group)
            continue
        if depth - known >= SHALLOW:
            out.extend(blind_sort(texts, group, depth))
            continue
        keys = {i: texts[i][depth : depth + CHUNK] for i in group}
        pivot = keys[group[len(group) // 2]]
        less, same, more = [], [], []
        for i in group:
            (same if keys[i] == pivot else less if keys[i] < pivot else more).append(i)
        # Strings that end inside the chunk are equal as a whole.
        stack += [(more, depth, False), (same, depth + CHUNK, len(pivot) < CHUNK), (less, depth, False)]
    return out


def _prefixes(texts: list[bytes], order: list[int], known: int) -> list[int]:
    return [common_prefix(texts[a], texts[b], known) for a, b in zip(order, order[1:], strict=False)]


def matches(heads: list[bytes], tails: list[bytes], length: int, known: int) -> Iterator[tuple[int, int, int, int]]:
    """(i, j, back, forth): contexts that agree on ``back`` bytes before and ``forth`` bytes from the anchor on.

    ``heads`` are the bytes before each anchor, backwards, ``tails`` those from it on, of which ``known`` are equal.
    Pairs are those that matter: contexts join in the order of their common heads, longest first, and each new one meets
    its neighbours in the order of tails, the smaller set being put into the larger. For every string that two contexts
    share, some pair shows it for either of them.
    """
    if len(tails) == 2:
        back, forth = common_prefix(*heads), common_prefix(*tails, known)
        if back + forth >= length:
            yield 0, 1, back, forth
        return
    by_tail = deep_shallow_sort(tails, known)
    forth_at = np.array(_prefixes(tails, by_tail, known))
    rank = {i: r for r, i in enumerate(by_tail)}
    by_head = deep_shallow_sort(heads)
    back_at = _prefixes(heads, by_head, 0)
    sets = {at: [rank[i]] for at, i in enumerate(by_head)}
    owner = list(range(len(by_head)))

    def find(at: int) -> int:
        while owner[at] != at:
            owner[at] = owner[owner[at]]
            at = owner[at]
        return at

    for at in sorted(range(len(back_at)), key=back_at.__getitem__, reverse=True):
        back = back_at[at]
        a, b = find(at), find(at + 1)
        if len(sets[a]) < len(sets[b]):
            a, b = b, a
        large, small = sets[a], sets.pop(b)
        owner[b] = a
        for r in small:
            place = bisect_left(large, r)
            for other in large[max(place - 1, 0) : place + 1]:
                low, high = min(r, other), max(r, other)
                forth = int(forth_at[low:high].min())
                if back + forth >= length:
                    yield by_tail[r], by_tail[other], back, forth
        for r in small:
            insort(large, r)


def shared_ranges(group: list[dict], length: int, known: int) -> list[tuple[int, int, int]]:
    """(context, first byte, end byte) in the texts of the contexts whose strings occur in another one, too.

    A context has ``at`` (its anchor), ``low`` and ``high`` (how far before it its strings start) and ``data``.
    """
    heads = [c["data"][: c["high"]][::-1] for c in group]
    tails = [c["data"][c["high"] :] for c in group]
    found = []
    for i, j, back, forth in matches(heads, tails, length, known):
        for one in (i, j):
            c = group[one]
            low, high = max(c["low"], length - forth), min(c["high"], back)
            if low <= high:
                found.append((one, c["at"] - high, c["at"] - low + length))
    return found


# On Spark

_KEYS = ["k1", "k2"]


def _keyed(docs: DataFrame, id_column: str, text: str) -> DataFrame:
    """k1, k2 (hashes of id and text, by which rows are found again) and text, null as empty."""
    value = as_text(text)
    return docs.select(*_row_keys(id_column, text), value.alias("text"))


def _row_keys(id_column: str, text: str) -> list[Column]:
    name = F.coalesce(F.col(id_column).cast("string"), F.lit(""))
    return [F.xxhash64(name).alias("k1"), F.xxhash64(as_text(text)).alias("k2")]


def _find_anchors(keyed: DataFrame, length: int, window: int) -> DataFrame:
    core = length - window + 1

    names = ["k1", "k2", "at", "low", "high", "core", "context"]

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], names=names)

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        for batch in batches:
            for k1, k2, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                data = bytes(value.as_buffer())
                rows += [
                    (k1, k2, at, at - last, at - first, _hash(data[at : at + core]), _hash(data[first : last + length], at - first))
                    for at, first, last in anchors(data, length, window)
                ]
                if len(rows) >= ROWS_AT_ONCE:
                    yield batch_of(rows)
                    rows = []
        if rows:
            yield batch_of(rows)

    return keyed.mapInArrow(step, "k1 long, k2 long, at long, low long, high long, core long, context long")


def _find_contexts(keyed: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """The bytes of the contexts in ``wanted`` (k1, k2, at, low, high, core, single)."""
    lists = wanted.groupBy(*_KEYS).agg(F.collect_list(F.struct("core", "single", "at", "low", "high")).alias("found"))
    joined = keyed.join(lists, _KEYS)

    names = ["core", "k1", "k2", "single", "at", "low", "high", "data"]
    types = [pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        columns = [pa.array(c, kind) for c, kind in zip(zip(*rows, strict=True), types, strict=True)]
        return pa.RecordBatch.from_arrays(columns, names=names)

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        for batch in batches:
            for k1, k2, value, found in zip(*batch.columns, strict=True):
                data, one, two = bytes(value.as_buffer()), k1.as_py(), k2.as_py()
                for c in found.as_py():
                    at, low, high = c["at"], c["low"], c["high"]
                    rows.append((c["core"], one, two, c["single"], at, low, high, data[at - high : at - low + length]))
                if len(rows) >= ROWS_AT_ONCE // 10:
                    yield batch_of(rows)
                    rows = []
        if rows:
            yield batch_of(rows)

    return joined.select(*_KEYS, "text", "found").mapInArrow(
        step, "core long, k1 long, k2 long, single boolean, at long, low long, high long, data binary"
    )


def _sort_groups(groups: DataFrame, length: int, known: int) -> DataFrame:
    """(k1, k2, start, end) of repeated ranges, from groups of contexts in an array column ``members``."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for members in batch.column(0):
                group = members.as_py()
                for i, start, end in shared_ranges(group, length, known):
                    if group[i]["single"]:
                        rows.append((group[i]["k1"], group[i]["k2"], start, end))
            if rows:
                columns = [pa.array(column, pa.int64()) for column in zip(*rows, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, names=["k1", "k2", "start", "end"])

    return groups.select("members").mapInArrow(step, "k1 long, k2 long, start long, end long")


def _halved(large: DataFrame, first: int, last: int, length: int) -> DataFrame:
    """Each context once per half of the places first..last that it has strings in, cut to them.

    The new key is made of the old one, the half, and the bytes that all strings of the half share.
    """
    middle = (first + last) // 2

    def half(a: int, b: int) -> Column:
        return F.struct(F.lit(a).cast("long").alias("x"), F.lit(b).cast("long").alias("y"))

    halves = F.array(half(first, middle), half(middle + 1, last))
    spread = large.withColumn("half", F.explode(halves))
    low, high = F.greatest("low", F.col("half.x")), F.least("high", F.col("half.y"))
    cut = spread.select(
        "core", *_KEYS, "single", "at", "data", F.col("high").alias("from"), low.alias("low"), high.alias("high"), "half"
    ).filter("low <= high")
    data, start = F.col("data"), F.col("from") - F.col("high") + 1
    x, y = F.col("half.x"), F.col("half.y")
    shared = F.substring(data, (F.col("from") - x + 1).cast("int"), (x + length - y).cast("int"))
    own = F.substring(data, start.cast("int"), (F.col("high") - F.col("low") + length).cast("int"))
    return cut.select(
        F.xxhash64("core", "half.x", shared).alias("core"), *_KEYS, "single", "at", "low", "high", own.alias("data"),
        F.col("half.x").alias("first"), F.col("half.y").alias("last"),
    )


def _edge_ranges(contexts: DataFrame, length: int, window: int, group: int, sources: tuple[DataFrame, ...]) -> DataFrame:
    """Repeated ranges of the single contexts, by sorting the contexts of each core; large groups are halved."""
    member = F.struct(*_KEYS, "single", "at", "low", "high", "data")
    # What the level is still to be made from; each table goes when its last reader has been written.
    found, before = None, sources
    # Halves of one round have the same width, one range of places each.
    level = contexts.withColumns({"first": F.lit(0).cast("long"), "last": F.lit(window - 1).cast("long")})
    while True:
        level = stored(level, "repeat-level")
        sizes = level.groupBy("core", "first", "last").agg(
            F.count(F.lit(1)).alias("n"), F.max("single").alias("asked")
        ).filter("n > 1 and asked")
        sizes = stored(sizes, "repeat-sizes")
        small = level.join(sizes.filter(F.col("n") <= group), ["core", "first", "last"])
        sets = small.groupBy("core", "first", "last").agg(F.collect_list(member).alias("members"))
        # All strings at places first..last share this many bytes from their anchor on.
        ranges = stored(_sort_groups(sets, length, length - window + 1), "repeat-ranges")
        found = ranges if found is None else found.unionByName(ranges)
        large = sizes.filter(F.col("n") > group)
        spans = [(row["first"], row["last"]) for row in large.select("first", "last").distinct().collect()]
        if not spans:
            release(level, sizes, *before)
            return found
        items = stored(level.join(large.select("core", "first", "last"), ["core", "first", "last"]), "repeat-large")
        release(level, sizes, *before)
        parts = []
        for first, last in spans:  # as many as there are halves, WINDOW at most
            mine = items.filter((F.col("first") == first) & (F.col("last") == last)).drop("first", "last")
            parts.append(_halved(mine, first, last, length))
        halves = parts[0]
        for part in parts[1:]:
            halves = halves.unionByName(part)
        halves = stored(halves, "repeat-halves")
        release(items)
        level, more, counts = _settled(halves, length)
        found = found.unionByName(stored(more, "repeat-ranges"))
        release(halves)
        before = (counts,)


def _settled(halves: DataFrame, length: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Cut contexts that are still distinct, once each, ranges of those that became equal to another, and the stored
    table that the former are made from."""
    named = halves.select("*", F.xxhash64("data").alias("h1"), F.md5("data").alias("h2"))
    keys = ["core", "first", "last", "low", "high", "h1", "h2"]
    counts = stored(
        named.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.min(F.struct(*_KEYS, "at", "single", "data")).alias("one")),
        "repeat-counts",
    )
    ranges = (
        named.filter("single").join(counts.filter("n > 1").select(*keys), keys)
        .select(*_KEYS, (F.col("at") - F.col("high")).alias("start"), (F.col("at") - F.col("low") + length).alias("end"))
    )
    one = F.col("one")
    left = counts.select(
        "core", *[one[k].alias(k) for k in _KEYS], (one["single"] & (F.col("n") == 1)).alias("single"), one["at"].alias("at"),
        "low", "high", one["data"].alias("data"), "first", "last",
    )
    return left, ranges, counts


def repeated_ranges(
    docs: DataFrame, id_column: str = "doc_id", text: str = "text", length: int = LENGTH, window: int = WINDOW, group: int = GROUP
) -> DataFrame:
    """(k1, k2, start, end): byte ranges to remove, which may overlap, by the keys of ``_keyed``."""
    keyed = _keyed(docs, id_column, text)
    marks = stored(_find_anchors(keyed, length, window), "repeat-anchors")
    cores = marks.groupBy("core").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("core")
    # Stored, not joined as it is: adaptive execution divides a hot core only where both sides of a join are shuffled
    # for the join alone, and not where one comes from an aggregate by the same key.
    cores = stored(cores, "repeat-cores")
    again = stored(marks.join(cores, "core"), "repeat-again")
    release(marks, cores)
    place = F.struct(*_KEYS, "at", "low", "high")
    contexts = stored(
        again.groupBy("core", "context").agg(F.count(F.lit(1)).alias("n"), F.min(place).alias("one")), "repeat-contexts"
    )
    whole = again.join(contexts.filter("n > 1").select("core", "context"), ["core", "context"]).select(
        *_KEYS, (F.col("at") - F.col("high")).alias("start"), (F.col("at") - F.col("low") + length).alias("end")
    )
    whole = stored(whole, "repeat-whole")
    release(again)
    mixed = contexts.groupBy("core").agg(F.count(F.lit(1)).alias("kinds"), F.min("n").alias("least"))
    mixed = mixed.filter("kinds > 1 and least = 1")
    mixed = stored(mixed.select("core"), "repeat-mixed")
    wanted = contexts.join(mixed, "core").select("core", (F.col("n") == 1).alias("single"), "one.*")
    data = _find_contexts(keyed, wanted, length)
    return whole.unionByName(_edge_ranges(data, length, window, group, (contexts, mixed)))


def _merged(ranges: list[tuple[int, int]]) -> list[list[int]]:
    out: list[list[int]] = []
    for start, end in sorted(ranges):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return out


def remove_repeats(
    docs: DataFrame, id_column: str = "doc_id", text: str = "text", length: int = LENGTH, window: int = WINDOW, group: int = GROUP,
    into: str = "repeats",
) -> DataFrame:
    """Add a column with the removed byte ranges (maximal runs) and the bytes that stay, for every row.

    Null texts count as empty; texts shorter than ``length`` lose nothing; rows that repeat id and text are documents
    that repeat each other; matches never cross documents. Columns other than id and text pass through; a column named
    like the result is replaced.
    """
    found = repeated_ranges(docs, id_column, text, length, window, group)
    lists = found.groupBy(*_KEYS).agg(F.collect_set(F.struct("start", "end")).alias("ranges"))
    span = pa.struct([("start", pa.int64()), ("end", pa.int64())])
    kind = pa.struct([("n_bytes", pa.int64()), ("spans", pa.list_(span)), ("kept", pa.binary())])

    @F.arrow_udf("n_bytes long, spans array<struct<start:long,end:long>>, kept binary")
    def cut(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, ranges in batches:
            out = []
            for value, gone in zip(texts, ranges, strict=True):
                data = bytes(value.as_buffer())
                spans = _merged([(r["start"], r["end"]) for r in gone.as_py() or []])
                edges = [0, *(edge for span in spans for edge in span), len(data)]
                kept = b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)) if spans else data
                out.append({"n_bytes": len(data), "spans": [{"start": a, "end": b} for a, b in spans], "kept": kept})
            yield pa.array(out, kind)

    plain = docs.drop(into)
    own = F.struct(*[F.col(f"`{c}`") for c in plain.columns]).alias("row")
    joined = plain.select(own, *_row_keys(id_column, text), as_text(text).alias("text")).join(lists, _KEYS, "left")
    result = cut.asNondeterministic()(F.col("text"), F.col("ranges"))
    return joined.select("row", result.alias("result")).select("row.*", F.col("result").alias(into))



def repeat_report(docs: DataFrame, **options) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    done = remove_repeats(docs.select("doc_id", "text"), **options)
    result = F.col("repeats")
    removed = F.aggregate(result["spans"], F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return done.select(
        "doc_id", result["n_bytes"].alias("n_bytes"), removed.alias("n_removed"),
        F.size(result["spans"]).cast("long").alias("n_spans"), F.sha2(result["kept"], 256).alias("kept_sha256"),
    )
