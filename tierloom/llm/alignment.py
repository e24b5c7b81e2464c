"""Alignment of two tokenizers over a corpus: which tokens stand for the same bytes, how often, and in how many documents.

Every text is cut where tokens of both end at the same byte. Tokens of one group are linked. Links are kept as an inverted
index: for each pair of ids and each block of documents a compressed bitmap of the documents that hold the pair, and
planes for multiplicities (plane j has the documents whose further links have bit j). Counts of a pair are popcounts added
up over blocks; the postings then carry the pair's score back to their documents.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tierloom.llm.bpe import AT_ONCE, tokenizer_bytes
from tierloom.llm.common import stored

BYTE_TOKENIZER = "/opt/tokenizers/byte_bpe_50k.json"
PIECE_TOKENIZER = "/opt/tokenizers/piece_bpe_32k.model"
# A block of documents ends at whichever comes first: slots are 16-bit numbers, and its links are held in memory.
SLOTS = 1 << 16
BLOCK_CHARS = 1 << 23
# Beyond this many documents of a block a bitmap is shorter than a list of slots.
LISTED = SLOTS // 16
# Groups with more links than this are counted by distinct tokens before tokens are paired.
LARGE_GROUP = 64
# Characters of units that a task remembers from one block to the next.
REMEMBERED_CHARS = 1 << 22
# Pairs of distinct tokens made at once.
PAIRS_AT_ONCE = 1 << 22

ENCODED = "block long, slot int, pair long, plane int, n long, docs binary, about struct<{}>"
# The plane of the documents themselves; plane j, from 0, has those whose further links have bit j.
HOLDERS = -1


def byte_letters() -> dict[str, int]:
    """The printable stand-ins of byte-level vocabularies: bytes that print stand for themselves, others from 256 on."""
    printing = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(printing)]
    return {chr(b): b for b in printing} | {chr(256 + k): b for k, b in enumerate(others)}


class Pair:
    """Both tokenizers, with the bytes of every token, and where they allow a text to be cut."""

    def __init__(self, byte_level: bytes, pieces: bytes):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(byte_level.decode())
        self.a.encode_special_tokens = True
        self.a.no_truncation()
        self.a.no_padding()
        letters = byte_letters()
        entries = {i: bytes(letters[c] for c in token) for token, i in json.loads(byte_level)["model"]["vocab"].items()}
        self.a_bytes = [entries.get(i, b"") for i in range(max(entries) + 1)]
        self.b = sentencepiece.SentencePieceProcessor(model_proto=pieces)
        self.b_bytes = [self._piece(i) for i in range(self.b.get_piece_size())]
        self.a_length, self.b_length = (np.array([len(t) for t in side], np.int64) for side in (self.a_bytes, self.b_bytes))
        self.b_size = len(self.b_bytes)
        # A text may be cut before a space that follows a word: the rules of byte-level vocabularies end a piece there, and
        # no piece of the other side has the mark of a space behind another character. A space that ends the text stays with
        # its word, as the piece tokenizer has no token for an empty text. Other tokenizers take texts whole.
        rules = json.loads(byte_level)
        by_words = rules["pre_tokenizer"] == {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}
        inside = any(self.b.id_to_piece(i).lstrip("▁").count("▁") for i in range(self.b_size))
        self.unit = re.compile(r"(?<=\S)(?= [\s\S])") if by_words and rules["normalizer"] is None and not inside else None
        self.written = [f"{i}{end}" for size, ends in ((len(self.a_bytes), ",|"), (self.b_size, ",;")) for end in ends for i in range(size)]

    def _piece(self, i: int) -> bytes:
        piece = self.b.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode()

    def encode(self, units: list[str]) -> tuple[list[list[int]], list[list[int]], np.ndarray]:
        """Ids of both sides for units, which start with a space; none, and False, where the tokens do not spell the unit."""
        a_ids = [e.ids for e in self.a.encode_batch_fast(units, add_special_tokens=False)]
        # The piece tokenizer puts the space there itself.
        b_ids = self.b.encode([unit[1:] for unit in units], num_threads=1) if units else []
        spelt = np.ones(len(units), bool)
        for k, unit in enumerate(units):
            want = unit.encode()
            if any(b"".join(map(of.__getitem__, ids)) != want for of, ids in ((self.a_bytes, a_ids[k]), (self.b_bytes, b_ids[k]))):
                a_ids[k], b_ids[k], spelt[k] = [], [], False
        return a_ids, b_ids, spelt


class Groups:
    """The groups of some units, one after the other: tokens of both sides with the number of their group."""

    def __init__(self, pair: Pair, a_ids: list[list[int]], b_ids: list[list[int]]):
        self.a_counts, self.b_counts = (np.array([len(x) for x in ids], np.int64) for ids in (a_ids, b_ids))
        self.a, self.b = (np.fromiter((i for x in ids for i in x), np.int64, count=int(n.sum())) for ids, n in ((a_ids, self.a_counts), (b_ids, self.b_counts)))
        a_ends, b_ends = np.cumsum(pair.a_length[self.a]), np.cumsum(pair.b_length[self.b])
        # Both sides have a unit's bytes, so its end always cuts.
        cuts = np.intersect1d(a_ends, b_ends, assume_unique=True)
        self.a_group, self.b_group = np.searchsorted(cuts, a_ends), np.searchsorted(cuts, b_ends)
        self.a_size, self.b_size = (np.bincount(g, minlength=len(cuts)) for g in (self.a_group, self.b_group))
        self.a_start, self.b_start = np.cumsum(self.a_size) - self.a_size, np.cumsum(self.b_size) - self.b_size
        self.unit = np.repeat(np.arange(len(a_ids)), self.a_counts)[self.a_start]
        self.links_of_group = self.a_size * self.b_size

    def per_unit(self, values: np.ndarray) -> np.ndarray:
        return np.bincount(self.unit, values, len(self.a_counts)).astype(np.int64)

    def written(self, pair: Pair) -> Iterator[str]:
        """Per unit ``a1,a2|b1;a3|b2,b3``."""
        a_size = len(pair.a_bytes)
        ends_a = np.zeros(len(self.a), np.int64)
        ends_b = np.zeros(len(self.b), np.int64)
        ends_a[self.a_start + self.a_size - 1] = 1
        ends_b[self.b_start + self.b_size - 1] = 1
        codes = np.empty(len(self.a) + len(self.b), np.int64)
        codes[np.arange(len(self.a)) + self.b_start[self.a_group]] = self.a + ends_a * a_size
        b_place = np.arange(len(self.b)) + (self.a_start + self.a_size)[self.b_group]
        codes[b_place] = 2 * a_size + self.b + ends_b * pair.b_size
        at = 0
        for n in (self.a_counts + self.b_counts).tolist():
            yield "".join(map(pair.written.__getitem__, codes[at : at + n].tolist()))[:-1]
            at += n

    def links(self, pair: Pair) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(unit, pair of ids, number of links), in parts of bounded size; a pair may come several times."""
        large = self.links_of_group > LARGE_GROUP
        for chosen in (~large, large):
            a_of, b_of = chosen[self.a_group], chosen[self.b_group]
            a_group, a, a_times = self.a_group[a_of], self.a[a_of], None
            b_group, b, b_times = self.b_group[b_of], self.b[b_of], None
            if chosen is large:
                a_group, a, a_times = distinct(a_group, a, len(pair.a_bytes))
                b_group, b, b_times = distinct(b_group, b, pair.b_size)
            groups = len(chosen)
            b_size = np.bincount(b_group, minlength=groups)
            b_start = np.cumsum(b_size) - b_size
            made = np.cumsum(b_size[a_group])
            at = 0
            while at < len(a):
                before = made[at - 1] if at else 0
                to = max(at + 1, int(np.searchsorted(made, before + PAIRS_AT_ONCE, "right")))
                group = a_group[at:to]
                width = b_size[group]
                offset = np.arange(int(width.sum())) - np.repeat(np.cumsum(width) - width, width)
                place = np.repeat(b_start[group], width) + offset
                ids = np.repeat(a[at:to], width) * pair.b_size + b[place]
                times = np.ones(len(ids), np.int64) if a_times is None else np.repeat(a_times[at:to], width) * b_times[place]
                yield np.repeat(self.unit[group], width), ids, times
                at = to


def distinct(group: np.ndarray, ids: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    keys, times = np.unique(group * size + ids, return_counts=True)
    return keys // size, keys % size, times


class Units:
    """Stretches of text between which both tokenizers always cut, each encoded and aligned once while it is remembered."""

    def __init__(self, pair: Pair):
        self.pair = pair
        self.clear()

    def clear(self) -> None:
        self.number: dict[str, int] = {}
        self.written: list[str] = []
        self.chars = 0
        # Columns: tokens of both sides, groups, links, and whether the tokens spell the unit.
        self.counts = np.zeros((0, 5), np.int64)
        self.links: list[np.ndarray] = []

    def cut(self, text: str) -> list[str]:
        if not text:
            return []
        return self.pair.unit.split(" " + text) if self.pair.unit else [" " + text]

    def learn(self, texts: list[list[str]]) -> None:
        fresh = list({unit: None for units in texts for unit in units if unit not in self.number})
        at = 0
        while at < len(fresh):
            to, chars = at, 0
            while to < len(fresh) and chars < AT_ONCE:
                chars += len(fresh[to])
                to += 1
            self._add(fresh[at:to])
            self.chars += chars
            at = to

    def _add(self, units: list[str]) -> None:
        first = len(self.written)
        a_ids, b_ids, spelt = self.pair.encode(units)
        groups = Groups(self.pair, a_ids, b_ids)
        self.number.update(zip(units, range(first, first + len(units)), strict=True))
        self.written += groups.written(self.pair)
        columns = [groups.a_counts, groups.b_counts, groups.per_unit(np.ones(len(groups.unit))), groups.per_unit(groups.links_of_group), spelt]
        if len(self.written) > len(self.counts):
            self.counts = np.pad(self.counts, ((0, len(self.written)), (0, 0)))
        self.counts[first : len(self.written)] = np.column_stack(columns)
        for unit, ids, times in groups.links(self.pair):
            self.links.append(np.stack([unit + first, ids, times]))

    def numbers(self, units: list[str]) -> np.ndarray:
        """The numbers of a text's units; none if the tokens do not spell all of them."""
        found = np.fromiter(map(self.number.__getitem__, units), np.int64, len(units))
        return found if self.counts[found, 4].all() else found[:0]

    def expanded(self, units: np.ndarray, slots: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The links of units in slots, as keys (pair, slot) with their number."""
        links = np.hstack([np.zeros((3, 0), np.int64), *self.links])
        links = links[:, np.argsort(links[0], kind="stable")]
        sizes = np.bincount(links[0], minlength=len(self.written))
        starts = np.cumsum(sizes) - sizes
        width = sizes[units]
        place = np.repeat(starts[units] - np.cumsum(width) + width, width) + np.arange(int(width.sum()))
        return merged(links[1, place] * SLOTS + np.repeat(slots, width), links[2, place] * np.repeat(times, width))


class Block:
    """Documents in slots, with the units that each of them has."""

    def __init__(self, number: int):
        self.number, self.size, self.chars = number, 0, 0
        self.keys: list[np.ndarray] = []
        self.times: list[np.ndarray] = []

    def add(self, documents: list[np.ndarray]) -> None:
        sizes = [len(units) for units in documents]
        slots = np.repeat(np.arange(self.size, self.size + len(documents)), sizes)
        units = np.concatenate([np.zeros(0, np.int64), *documents])
        keys, times = merged(units * SLOTS + slots, np.ones(len(units), np.int64))
        self.keys.append(keys)
        self.times.append(times)
        self.size += len(documents)

    def postings(self, units: Units) -> Iterator[pa.RecordBatch]:
        """One row per pair with its documents, and one per pair and plane with those whose further links have that bit."""
        if not self.keys:
            return
        keys = np.concatenate(self.keys)
        keys, times = units.expanded(keys // SLOTS, keys % SLOTS, np.concatenate(self.times))
        self.keys, self.times = [], []
        yield from self._rows(keys, HOLDERS)
        further, plane = times - 1, 0
        while further.any():
            yield from self._rows(keys[further & 1 == 1], plane)
            further >>= 1
            plane += 1

    def _rows(self, keys: np.ndarray, plane: int) -> Iterator[pa.RecordBatch]:
        pairs = keys // SLOTS
        starts = np.flatnonzero(np.diff(pairs, prepend=-1))
        sizes = np.diff(starts, append=len(keys))
        slots = (keys % SLOTS).astype("<u2")
        step = 1 << 16
        for at in range(0, len(starts), step):
            part, n = starts[at : at + step], sizes[at : at + step]
            low, high = int(part[0]), int(part[-1] + n[-1])
            yield postings_batch(self.number, pairs[part], plane, n, bitmaps(slots[low:high], part - low, n))


def merged(keys: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted keys, each once, with the sums of their numbers."""
    order = np.argsort(keys)
    keys = keys[order]
    starts = np.flatnonzero(np.diff(keys, prepend=-1))
    return keys[starts], np.add.reduceat(times[order], starts) if len(starts) else times


def bitmaps(slots: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """Sorted slots of each row as a list of 16-bit numbers, or as SLOTS bits where that is shorter."""
    dense = np.flatnonzero(sizes > LISTED)
    chunks, at = [], 0
    for k in dense.tolist():
        low, high = int(starts[k]), int(starts[k] + sizes[k])
        bits = np.zeros(SLOTS, np.uint8)
        bits[slots[low:high]] = 1
        chunks += [slots[at:low].tobytes(), np.packbits(bits, bitorder="little").tobytes()]
        at = high
    chunks.append(slots[at:].tobytes())
    widths = np.where(sizes > LISTED, SLOTS // 8, 2 * sizes)
    offsets = np.concatenate([[0], np.cumsum(widths)]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(offsets), pa.py_buffer(b"".join(chunks))])


def slots_of(docs: pa.Array, sizes: np.ndarray) -> np.ndarray:
    """The slots of all rows of bitmaps, one after the other."""
    docs = pa.concat_arrays([docs])
    buffers = docs.buffers()
    offsets = np.frombuffer(buffers[1], np.int32)[docs.offset : docs.offset + len(docs) + 1]
    data = memoryview(buffers[2])
    parts, at = [], int(offsets[0])
    for k in np.flatnonzero(sizes > LISTED).tolist():
        parts.append(np.frombuffer(data[at : int(offsets[k])], "<u2"))
        bits = np.unpackbits(np.frombuffer(data[int(offsets[k]) : int(offsets[k + 1])], np.uint8), bitorder="little")
        parts.append(np.flatnonzero(bits))
        at = int(offsets[k + 1])
    parts.append(np.frombuffer(data[at : int(offsets[-1])], "<u2"))
    return np.concatenate(parts)


POSTING = [("block", pa.int64()), ("slot", pa.int32()), ("pair", pa.int64()), ("plane", pa.int32()), ("n", pa.int64()), ("docs", pa.binary())]


def postings_batch(block: int, pairs: np.ndarray, plane: int, sizes: np.ndarray, docs: pa.Array) -> pa.RecordBatch:
    n = len(pairs)
    blocks, planes = pa.array(np.full(n, block, np.int64)), pa.array(np.full(n, plane, np.int32))
    columns = [blocks, pa.nulls(n, pa.int32()), pa.array(pairs), planes, pa.array(sizes), docs]
    return pa.RecordBatch.from_arrays(columns, names=[name for name, _ in POSTING])


ABOUT = ["n_a", "n_b", "n_groups", "n_links", "groups"]


def digest(written: str) -> str:
    return hashlib.sha256(written.encode()).hexdigest() if written else ""


def plain(written: str) -> str:
    return written


def index_step(byte_level, pieces, id_type: pa.DataType, describe: Callable[[str], str]) -> Callable:
    """For ``mapInArrow`` over (doc_id, text): postings by block, and a row of its own for each document."""
    about = pa.struct([("doc_id", id_type), *[(name, pa.int64()) for name in ABOUT[:4]], ("groups", pa.string())])
    schema = pa.schema([*POSTING, ("about", about)])

    def filled(batch: pa.RecordBatch) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([*batch.columns, pa.nulls(batch.num_rows, about)], schema=schema)

    def documents(block: Block, ids: list, units: Units, found: list[np.ndarray]) -> pa.RecordBatch:
        n = len(ids)
        counts = np.array([units.counts[numbers, :4].sum(axis=0) for numbers in found], np.int64).reshape(n, 4)
        written = [describe(";".join(map(units.written.__getitem__, numbers.tolist()))) for numbers in found]
        fields = [pa.array(ids, id_type), *map(pa.array, counts.T.copy()), pa.array(written, pa.string())]
        numbers = pa.array(np.full(n, block.number, np.int64)), pa.array(np.arange(block.size, block.size + n, dtype=np.int32))
        empty = [pa.nulls(n, kind) for _, kind in POSTING[2:]]
        return pa.RecordBatch.from_arrays([*numbers, *empty, pa.StructArray.from_arrays(fields, fields=list(about))], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units = Units(Pair(byte_level.value, pieces.value))
        base, made = TaskContext.get().partitionId() << 32, 0
        block = Block(base)
        for batch in batches:
            texts = batch.column(1)
            at = 0
            while at < len(texts):
                cut, chars = [], 0
                while at + len(cut) < len(texts) and (not cut or (chars < AT_ONCE and block.size + len(cut) < SLOTS)):
                    text = texts[at + len(cut)].as_py() or ""
                    chars += len(text)
                    cut.append(units.cut(text))
                units.learn(cut)
                found = [units.numbers(part) for part in cut]
                yield documents(block, batch.column(0).slice(at, len(cut)).to_pylist(), units, found)
                block.add(found)
                block.chars += chars
                at += len(cut)
                if block.size >= SLOTS or block.chars >= BLOCK_CHARS:
                    yield from map(filled, block.postings(units))
                    made += 1
                    block = Block(base + made)
                    if units.chars >= REMEMBERED_CHARS:
                        units.clear()
        yield from map(filled, block.postings(units))

    return run


def index(docs: DataFrame, describe: Callable[[str], str], byte_path: str, piece_path: str) -> DataFrame:
    """The stored postings (about: null) and documents (about: the rest of their row), both with their block."""
    context = docs.sparkSession.sparkContext
    byte_level, pieces = (context.broadcast(tokenizer_bytes(path)) for path in (byte_path, piece_path))
    id_type = docs.schema["doc_id"].dataType
    about = f"doc_id {id_type.simpleString()}, " + ", ".join(f"{name} long" for name in ABOUT[:4]) + ", groups string"
    step = index_step(byte_level, pieces, to_arrow_type(id_type), describe)
    return stored(docs.mapInArrow(step, ENCODED.format(about)), "alignment-postings")


def pair_counts(postings: DataFrame, b_size: int) -> DataFrame:
    """(pair, a_id, b_id, n_docs, n_links, best): popcounts over all blocks; ``best``: no pair of its a_id has more documents."""
    holders = F.col("plane") == HOLDERS
    counted = postings.groupBy("pair").agg(
        F.sum(F.when(holders, F.col("n")).otherwise(0)).alias("n_docs"),
        F.sum(F.when(holders, F.col("n")).otherwise(F.col("n") * F.expr("shiftleft(1L, plane)"))).alias("n_links"),
    )
    a_id, b_id = F.floor(F.col("pair") / b_size).cast("int"), (F.col("pair") % b_size).cast("int")
    ids = counted.select("pair", a_id.alias("a_id"), b_id.alias("b_id"), "n_docs", "n_links")
    return ids.withColumn("best", F.col("n_docs") == F.max("n_docs").over(Window.partitionBy("a_id")))


def returned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For ``mapInArrow`` over scored postings and documents of the same blocks: documents with n_best and count_sum."""
    sums: dict[int, np.ndarray] = {}
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        is_posting = batch.column("pair").is_valid()
        documents, rows = batch.filter(pc.invert(is_posting)), batch.filter(is_posting)
        if documents.num_rows:
            held.append(documents.select(["block", "slot", "about"]))
        if rows.num_rows:
            add_scores(sums, rows)
    for documents in held:
        blocks, slots = documents.column("block").to_numpy(), documents.column("slot").to_numpy()
        out = np.zeros((2, len(blocks)), np.int64)
        for block in np.unique(blocks).tolist():
            if block in sums:
                mine = np.flatnonzero((blocks == block) & (slots < sums[block].shape[1]))
                out[:, mine] = sums[block][:, slots[mine]]
        about = documents.column("about").flatten()
        yield pa.RecordBatch.from_arrays([*about, *map(pa.array, out)], names=["doc_id", *ABOUT, "n_best", "count_sum"])


def add_scores(sums: dict[int, np.ndarray], rows: pa.RecordBatch) -> None:
    """Add each posting's links, and links times the pair's documents, to its documents' sums (n_best, count_sum)."""
    blocks, plane, n, score, best = (rows.column(c).to_numpy(zero_copy_only=False) for c in ("block", "plane", "n", "n_docs", "best"))
    slots = slots_of(rows.column("docs"), n)
    links = np.left_shift(np.int64(1), np.maximum(plane, 0).astype(np.int64))
    of_block = np.repeat(blocks, n)
    order = np.argsort(of_block, kind="stable")
    gains = [np.repeat(gain, n)[order] for gain in (links * best, links * score)]
    slots = slots[order].astype(np.int64)
    cuts = np.flatnonzero(np.diff(of_block[order])) + 1
    for low, high in zip([0, *cuts.tolist()], [*cuts.tolist(), len(slots)], strict=True):
        size = int(slots[low:high].max()) + 1
        block = int(of_block[order[low]])
        held = sums.get(block, np.zeros((2, 0), np.int64))
        if held.shape[1] < size:
            held = np.pad(held, ((0, 0), (0, size - held.shape[1])))
            sums[block] = held
        for row, gain in zip(held, gains, strict=True):
            np.add.at(row, slots[low:high], gain[low:high])


def align(
    docs: DataFrame, id_column: str = "doc_id", text: str = "text", byte_path: str = BYTE_TOKENIZER,
    piece_path: str = PIECE_TOKENIZER, describe: Callable[[str], str] = plain,
) -> tuple[DataFrame, DataFrame]:
    """Documents with their groups and scores, and the pairs of ids with their counts over all documents.

    Documents: doc_id, n_a, n_b, n_groups, n_links, groups (``describe`` of ``a1,a2|b1;a3|b2,b3``), n_best (links whose
    pair has as many documents as any of its a_id), count_sum (documents of the pair, over links). Pairs: pair, a_id,
    b_id, n_docs, n_links, best. Null and empty texts, and those that one of the tokenizers does not spell back, have no
    tokens and zeros. Rows are documents: repeated rows count each. An empty table gives two empty tables; other columns
    are not looked at.

    Texts are encoded in one pass, whose postings are stored; these meet their pair's counts by pair, and their documents
    by block. A block is bounded by text, so a pair that all documents have is one row per block.
    """
    narrow = docs.select(F.col(id_column).alias("doc_id"), F.col(text).cast("string").alias("text"))
    found = index(narrow, describe, byte_path, piece_path)
    postings = found.filter("about is null").select("block", "pair", "plane", "n", "docs")
    pairs = stored(pair_counts(postings, piece_count(piece_path)), "alignment-pairs")
    scored = postings.join(pairs.select("pair", "n_docs", "best"), "pair")
    documents = found.filter("about is not null").select("block", "slot", "about")
    together = scored.unionByName(documents, allowMissingColumns=True).repartition("block")
    kinds = f"doc_id {narrow.schema['doc_id'].dataType.simpleString()}"
    result = together.mapInArrow(returned, f"{kinds}, n_a long, n_b long, n_groups long, n_links long, groups string, n_best long, count_sum long")
    return result, pairs


def piece_count(path: str) -> int:
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_proto=tokenizer_bytes(path)).get_piece_size()


def alignment_report(docs: DataFrame, **options) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    documents, _ = align(docs, describe=digest, **options)
    return documents.select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", F.col("groups").alias("groups_sha256")
    )
