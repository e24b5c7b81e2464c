"""Benchmark decontamination: one Aho-Corasick automaton over normalised benchmark passages scans each text once.

Normalising lower-cases A-Z, turns every other ASCII character that is no digit into a word boundary and joins words by
one space. A window is ``window`` consecutive words of a benchmark item (or all of them, if there are fewer). Every
occurrence of a window is found and mapped back to the original text.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierloom.llm.common import free_name, release, stored

WINDOW = 10
# Trie nodes of an automaton, at most as many as its windows have bytes: some hundred megabytes in a worker. Benchmarks
# with more are split, and each part scans the texts in a pass of its own, one after the other.
AUTOMATON_NODES = 4 << 20

_KEPT = b"0123456789abcdefghijklmnopqrstuvwxyz" + bytes(range(128, 256))
_TO_WORDS = bytes(
    b if b in _KEPT else (b + 32 if 65 <= b <= 90 else 32) for b in range(256)
)
_WORD = regex.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def normal_words(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "replace").translate(_TO_WORDS).split() if text else []


def _joined(words: list[bytes]) -> str:
    """Words between single spaces, one character per byte, so that offsets are byte offsets."""
    return (b" " + b" ".join(words) + b" ").decode("latin-1")


def automaton(items: list[tuple[str, str | None]], window: int = WINDOW):
    """An automaton of all windows of the items, or None if there is none. A value holds the window's number of
    words, its length and the items that have it."""
    found: dict[str, tuple[int, set[str]]] = {}
    for item, text in items:
        words = normal_words(text)
        for i in range(max(1, len(words) - window + 1) if words else 0):
            part = words[i : i + window]
            found.setdefault(_joined(part), (len(part), set()))[1].add(item)
    if not found:
        return None
    machine = ahocorasick.Automaton()
    for pattern, (count, owners) in found.items():
        machine.add_word(pattern, (count, len(pattern), tuple(owners)))
    machine.make_automaton()
    return machine


def scan(machine, text: str | None) -> tuple[int, np.ndarray, set[str]]:
    """Number of words, a flag per word (covered by a window), and the items found."""
    words = normal_words(text)
    hit, owners = np.zeros(len(words), dtype=bool), set()
    if machine is None or not words:
        return len(words), hit, owners
    joined = _joined(words)
    spaces = None
    for end, (count, length, items) in machine.iter(joined):
        if spaces is None:
            spaces = np.flatnonzero(np.frombuffer(joined.encode("latin-1"), dtype=np.uint8) == 32)
        first = int(np.searchsorted(spaces, end - length + 1))
        hit[first : first + count] = True
        owners.update(items)
    return len(words), hit, owners


def original_spans(text: str, hit: np.ndarray) -> list[tuple[int, int]]:
    """Maximal runs of covered words as (start, end) code points of the original text, end exclusive."""
    spans: list[list[int]] = []
    before = -2
    for i, word in enumerate(_WORD.finditer(text)):
        if hit[i]:
            if before == i - 1:
                spans[-1][1] = word.end()
            else:
                spans.append([word.start(), word.end()])
            before = i
    return [tuple(span) for span in spans]


RESULT = "n_words long, words array<struct<first:long,last:long>>, items array<string>, spans array<struct<start:long,end:long>>"
_RUN = pa.struct([("first", pa.int64()), ("last", pa.int64())])
_SPAN = pa.struct([("start", pa.int64()), ("end", pa.int64())])
_TYPE = pa.struct(
    [("n_words", pa.int64()), ("words", pa.list_(_RUN)), ("items", pa.list_(pa.string())), ("spans", pa.list_(_SPAN))]
)


def _runs(hit: np.ndarray) -> list[dict]:
    """Maximal runs of covered words, by their first and last number."""
    edges = np.flatnonzero(np.diff(np.concatenate(([0], hit.astype(np.int8), [0]))))
    return [{"first": int(a), "last": int(b) - 1} for a, b in zip(edges[::2], edges[1::2], strict=True)]


def _scanner(items: list[tuple[str, str | None]], window: int):
    """An Arrow function that scans texts for some items, and adds to what an earlier scan has found."""

    @F.arrow_udf(RESULT)
    def scanned(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        machine = automaton(items, window)
        for texts, earlier in batches:
            out = []
            for value, former in zip(texts, earlier, strict=True):
                passage, past = value.as_py(), former.as_py()
                n, hit, found = scan(machine, passage)
                if past:
                    found.update(past["items"])
                    for run in past["words"]:
                        hit[run["first"] : run["last"] + 1] = True
                spans = [{"start": a, "end": b} for a, b in original_spans(passage, hit)] if found else []
                out.append({"n_words": n, "words": _runs(hit) if found else [], "items": sorted(found), "spans": spans})
            yield pa.array(out, _TYPE)

    return scanned.asNondeterministic()  # keeps filters on the result from running it again


def _blocks(benchmark: DataFrame, item_id: str, text: str, limit: int, window: int) -> Iterator[list[tuple[str, str | None]]]:
    """The benchmark in blocks whose windows have at most ``limit`` bytes (a longer window is a block of its own), one
    at least. An item with more windows than fit goes on in the next block."""
    rows = benchmark.select(F.col(item_id).cast("string"), F.col(text)).filter(F.col(text).isNotNull())
    block, used = [], 0
    for item, passage in rows.toLocalIterator():
        words = normal_words(passage)
        width = min(window, len(words))
        ends = np.cumsum([0, *(len(word) + 1 for word in words)])
        upto = np.cumsum(ends[width:] - ends[: len(ends) - width] + 1)  # bytes of all windows up to each
        at, last = 0, len(words) - width + 1 if words else 0
        while at < last:
            before = int(upto[at - 1]) if at else 0
            to = int(np.searchsorted(upto, before + limit - used, "right"))
            if to <= at and block:
                yield block
                block, used = [], 0
                continue
            to = max(to, at + 1)
            block.append(("" if item is None else item, b" ".join(words[at : to + width - 1]).decode("utf-8", "replace")))
            used += int(upto[to - 1]) - before
            at = to
    yield block


def mark_contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    automaton_nodes: int = AUTOMATON_NODES,
    into: str = "contamination",
) -> DataFrame:
    """Add one column to the documents: n_words, covered words (first and last of each run), items with an occurring
    window, and spans of the original text in code points. A column of that name is replaced.

    Null and empty texts have no words; null or wordless items match nothing; an empty benchmark finds nothing;
    repeated rows give repeated results. No shuffle. A benchmark is a list of test questions that goes to the executors
    as an automaton of at most ``automaton_nodes`` nodes. Beyond that, further blocks scan the texts in turn: the result
    of each is stored before the next block is read, so that one automaton is alive at a time, and each adds to what the
    former ones found, so the result does not depend on the limit.
    """
    empty = F.lit(None).cast(f"struct<{RESULT.replace(' long', ':long').replace(' array', ':array')}>")
    marked, held = docs.withColumn(into, empty), None
    blocks = _blocks(benchmark, item_id, item_text, automaton_nodes, window)
    items = next(blocks)
    for following in chain(blocks, [None]):
        marked = marked.withColumn(into, _scanner(items, window)(F.col(text), F.col(into)))
        if following is not None:
            marked = stored(marked, "contamination")
            if held is not None:
                release(held)
            held, items = marked, following
    return marked


def contamination_report(docs: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", **options) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256 (of the sorted items, comma-joined), contaminated, spans."""
    marked = mark_contamination(docs.select(F.col(id_column).alias("doc_id"), "text"), benchmark, **options)
    found = F.col("contamination")
    hit = F.aggregate(found["words"], F.lit(0).cast("long"), lambda n, run: n + run["last"] - run["first"] + 1)
    items = F.array_join(found["items"], ",")
    return marked.select(
        "doc_id",
        found["n_words"].alias("n_words"),
        hit.alias("n_hit"),
        F.size(found["items"]).cast("long").alias("n_items"),
        F.sha2(items.cast("binary"), 256).alias("items_sha256"),
        (F.size(found["words"]) > 0).alias("contaminated"),
        found["spans"].alias("spans"),
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents without any word inside an occurrence of a benchmark window, with their own columns."""
    mark = free_name(docs, "contamination")
    marked = mark_contamination(docs, benchmark, into=mark, **options)
    return marked.filter(F.size(F.col(mark)["words"]) == 0).select(docs.columns)
