"""Byte-pair encoding and decoding with a word vocabulary, by tree concatenation.

A tokenizer's rules split a text into pieces, and byte pairs merge inside a piece. A piece of any length has no place
where it may be cut, since a merge can reach across every place. So the halves of a long piece are encoded on their own,
and at the join a window is encoded anew that starts and ends at tokens of the halves and grows until its first token is
the left half's token there and its last one the right half's. Then the result is exact: byte-pair merging keeps a
sequence of tokens if it keeps every two neighbours, and each two neighbours are now neighbours in some encoding.

Halves of very long pieces are rows of their own, so that tasks share the work of one text.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterable, Iterator, Sequence
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from tierloom.llm.common import as_text, free_name, stored

TOKENIZER = "/opt/tokenizers/word_bpe_49k.json"
# The tokenizer is broadcast; files beyond this size are refused.
TOKENIZER_BYTES = 64 << 20
# Symbols (bytes) that are encoded at once at a leaf of the tree.
LEAF = 16
# Characters without white space from which on a piece is dealt to several tasks, in parts of this size.
BLOCK = 1 << 16
# Characters given to a tokenizer at once; its working memory is some hundred bytes for each.
AT_ONCE = 1 << 18
# Runs without white space whose ids a task remembers.
REMEMBERED = 1 << 19
# Texts that are held as Python strings at once.
ROWS_AT_ONCE = 256
# White space that splits texts under every rule: nothing is composed, matched or merged across it.
GAP = r"\x09-\x0D\x20"


def tokenizer_bytes(path: str) -> bytes:
    if Path(path).stat().st_size > TOKENIZER_BYTES:
        raise ValueError(f"{path} has more than {TOKENIZER_BYTES} bytes")
    return Path(path).read_bytes()


def packed(ids: list[int]) -> bytes:
    return np.array(ids, np.int32).tobytes()


class Decoder:
    """The text of ids, special tokens included."""

    def __init__(self, content: bytes):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(content.decode())
        # Without a decoder the tokens are joined by spaces.
        self.written = None if self.tokenizer.decoder else {i: t for t, i in self.tokenizer.get_vocab(True).items()}

    def decode(self, ids: list[int]) -> str:
        if self.written:
            return " ".join(map(self.written.__getitem__, ids))
        return self.tokenizer.decode(ids, skip_special_tokens=False)


class Encoder:
    """The tokenizer of a file's content, with the tree for pieces longer than ``leaf`` symbols."""

    def __init__(self, content: bytes, leaf: int = LEAF):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, models

        self.tokenizer = Tokenizer.from_str(content.decode())
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        model = json.loads(content)["model"]
        self.suffix = model.get("end_of_word_suffix") or ""
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        # The same merges without the mark of a word's end, for windows that end before the word does.
        self.inner = models.BPE(vocab=model["vocab"], merges=merges)
        self.last = self.tokenizer.model
        self.lengths = {i: len(token) for token, i in model["vocab"].items()}
        special = sorted((t["content"] for t in json.loads(content)["added_tokens"]), key=len, reverse=True)
        self.special = re.compile("(" + "|".join(map(re.escape, special)) + ")") if special else None
        self.leaf = leaf
        # Ids as packed 32-bit numbers.
        self.runs: dict[bytes, bytes] = {}

    def at_once(self, part: str, final: bool) -> list[int]:
        return [token.id for token in (self.last if final else self.inner).tokenize(part)]

    def tree(self, part: str, final: bool = True) -> list[int]:
        """The tokens of a piece (``final``: it ends a word), by halves down to leaves."""
        if len(part) <= self.leaf:
            return self.at_once(part, final)
        middle = len(part) // 2
        left, right = self.tree(part[:middle], False), self.tree(part[middle:], final)
        return self.join(left, right, part, middle, final)

    def join(self, left: list[int], right: list[int], part: str, middle: int, final: bool) -> list[int]:
        """The tokens of ``part`` from those of ``part[:middle]`` and ``part[middle:]``."""
        lengths, width, low, high, i, j = self.lengths, 1, middle, middle, len(left), 0
        while True:
            start, stop = max(0, len(left) - width), min(len(right), width)
            low -= sum(lengths[t] for t in left[start:i])
            high = len(part) if stop == len(right) else high + sum(lengths[t] for t in right[j:stop])
            i, j = start, stop
            window = self.at_once(part[low:high], final and high == len(part))
            if (i == 0 or window[0] == left[i]) and (j == len(right) or window[-1] == right[j - 1]):
                return left[:i] + window + right[j:]
            width *= 2

    def pieces(self, run: str) -> Iterator[str | int]:
        """The pieces of a run without white space, as symbols; ids for special tokens."""
        for k, part in enumerate(self.special.split(run) if self.special else [run]):
            if k % 2:
                yield self.tokenizer.token_to_id(part)
            elif part:
                normal = self.tokenizer.normalizer.normalize_str(part) if self.tokenizer.normalizer else part
                yield from (piece for piece, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(normal))

    def run(self, run: str) -> list[int]:
        ids: list[int] = []
        for piece in self.pieces(run):
            ids += [piece] if isinstance(piece, int) else self.tree(piece)
        return ids

    def learn(self, runs: list[bytes]) -> None:
        """Remember the ids of runs: short ones from the tokenizer at once, longer ones piece by piece."""
        texts = [run.decode() for run in runs]
        short = [k for k, text in enumerate(texts) if len(text) <= self.leaf]
        at = 0
        while at < len(short):
            part = short[at : at + AT_ONCE // self.leaf]
            for k, found in zip(part, self.tokenizer.encode_batch_fast([texts[k] for k in part], add_special_tokens=False), strict=True):
                self.runs[runs[k]] = packed(found.ids)
            at += len(part)
        for k, text in enumerate(texts):
            if len(text) > self.leaf:
                self.runs[runs[k]] = packed(self.run(text))

    def encode(self, text: str) -> np.ndarray:
        """The ids of a text. White space between runs splits it under every rule."""
        runs = text.encode().split()
        fresh = [run for run in dict.fromkeys(runs) if run not in self.runs]
        if fresh:
            if len(self.runs) + len(fresh) > REMEMBERED:
                self.runs.clear()
                fresh = list(dict.fromkeys(runs))
            self.learn(fresh)
        return np.frombuffer(b"".join(map(self.runs.__getitem__, runs)), np.int32)

    def open_parts(self, text: str, block: int) -> Iterator[dict]:
        """A text as finished ids and, for pieces of over ``block`` symbols, as parts that are still to be encoded.

        ``joined`` says that a part goes on with the one before; ``final`` that it ends its piece.
        """
        ids: list[int] = []
        for run in text.encode().split():
            if len(run) <= block:
                ids += self.encode(run.decode()).tolist()
                continue
            for piece in self.pieces(run.decode()):
                if isinstance(piece, int):
                    ids.append(piece)
                elif len(piece) <= block:
                    ids += self.tree(piece)
                else:
                    if ids:
                        yield {"ids": ids, "part": None, "joined": False, "final": True}
                        ids = []
                    for at in range(0, len(piece), block):
                        yield {"ids": None, "part": piece[at : at + block], "joined": at > 0, "final": at + block >= len(piece)}
        if ids:
            yield {"ids": ids, "part": None, "joined": False, "final": True}

    def closed(self, parts: list[dict]) -> list[int]:
        """One text's ids from its parts in order, all of which have ids now."""
        ids: list[int] = []
        piece: list[tuple[str, list[int], bool]] = []
        for part in [*parts, None]:
            if piece and (part is None or not part["joined"]):
                ids += self.joined(piece)[1]
                piece = []
            if part is not None and part["part"] is None:
                ids += part["ids"]
            elif part is not None:
                piece.append((part["part"], list(part["ids"]), part["final"]))
        return ids

    def joined(self, piece: list[tuple[str, list[int], bool]]) -> tuple[str, list[int], bool]:
        """Neighbours are joined two by two until one is left."""
        while len(piece) > 1:
            above = []
            for k in range(0, len(piece) - 1, 2):
                (a, left, _), (b, right, final) = piece[k], piece[k + 1]
                above.append((a + b, self.join(left, right, a + b, len(a), final), final))
            piece = above + piece[len(piece) // 2 * 2 :]
        return piece[0]


def _lists(rows: Iterable[Sequence[int] | None]) -> pa.Array:
    """Lists of ids as one Arrow array; a list goes over to its packed form before the next one is made."""
    parts, ends, missing = [np.zeros(0, np.int32)], [0], []
    for row in rows:
        parts.append(np.array(() if row is None else row, np.int32))
        ends.append(ends[-1] + len(parts[-1]))
        missing.append(row is None)
    offsets = pa.array(ends, pa.int32(), mask=np.array([*missing, False]))
    return pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(parts)))


def _rows(lists: pa.Array) -> Iterator[list[int]]:
    """The lists of an array, one after the other; a null one is empty."""
    values, ends = lists.values.to_numpy(zero_copy_only=False), lists.offsets.to_numpy()
    for null, low, high in zip(lists.is_null().to_pylist(), ends[:-1], ends[1:], strict=True):
        yield [] if null else values[low:high].tolist()


def _in_slices(make: Callable[[], Callable[[pa.RecordBatch], list[pa.Array]]], schema: StructType) -> Callable:
    """For ``mapInArrow``: columns that ``make()`` adds to ROWS_AT_ONCE rows at a time, so that memory follows those."""
    names = schema.fieldNames()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        added = make()
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_AT_ONCE):
                part = batch.slice(at, ROWS_AT_ONCE)
                yield pa.RecordBatch.from_arrays([*part.columns, *added(part)], names=names)

    return run


def _step(result: str, start: Callable, function: Callable[[Encoder, pa.Array], pa.Array]) -> Callable[..., Column]:
    """An Arrow function of a column; ``start`` makes the encoder, once per task."""

    @F.arrow_udf(result)
    def step(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = start()
        for batch in batches:
            yield function(own, batch)

    return step.asNondeterministic()


PARTS = "array<struct<ids:array<int>,part:string,joined:boolean,final:boolean>>"
PARTS_ARROW = pa.list_(
    pa.struct([("ids", pa.list_(pa.int32())), ("part", pa.string()), ("joined", pa.bool_()), ("final", pa.bool_())])
)


def encode(
    docs: DataFrame, text: str = "text", into: str = "ids", tokenizer_path: str = TOKENIZER, leaf: int = LEAF,
    block: int = BLOCK, decoded: str | None = None,
) -> DataFrame:
    """Add the token ids of every whole text, as the tokenizer gives them without special tokens of its own.

    Strings of special tokens inside a text are those tokens. Null and empty texts have none; repeated rows are encoded
    alike; an empty table gives none; other columns are kept, but one named ``into`` is replaced. Texts without
    a run of over ``block`` characters take one pass and no shuffle. The parts of others are rows that are dealt to all
    tasks, and only their tokens come together again, per text. ``decoded`` names a column that takes the text of the
    ids again, in the same pass.
    """
    docs = docs.drop(into, *([decoded] if decoded else []))
    shared = docs.sparkSession.sparkContext.broadcast(tokenizer_bytes(tokenizer_path))

    def in_parts(encoder: Encoder, texts: pa.Array) -> pa.Array:
        return pa.array([list(encoder.open_parts(text.as_py() or "", block)) for text in texts], PARTS_ARROW)

    def one_part(encoder: Encoder, parts: pa.Array) -> pa.Array:
        return _lists(None if part is None else encoder.tree(part[1:], part[0] == "1") for part in (p.as_py() for p in parts))

    def joined(encoder: Encoder, texts: pa.Array) -> pa.Array:
        return _lists(encoder.closed(parts.as_py()) for parts in texts)

    def start() -> Encoder:
        return Encoder(shared.value, leaf)

    def both() -> Callable[[pa.RecordBatch], list[pa.Array]]:
        encoder, decoder = start(), Decoder(shared.value) if decoded else None

        def added(rows: pa.RecordBatch) -> list[pa.Array]:
            ids = _lists(encoder.encode(value.as_py() or "") for value in rows.column(text))
            return [ids, *([pa.array(map(decoder.decode, _rows(ids)), pa.string())] if decoder else [])]

        return added

    encoded, closed = (_step("array<int>", start, f) for f in (one_part, joined))
    opened = _step(PARTS, start, in_parts)
    runs = F.transform(F.split(as_text(text), f"[{GAP}]+"), F.length)
    giant = F.when(F.length(as_text(text)) > block, F.array_max(runs) > block).otherwise(False)
    fields = [StructField(into, ArrayType(IntegerType())), *([StructField(decoded, StringType())] if decoded else [])]
    schema = StructType([*docs.schema.fields, *fields])
    easy = docs.filter(~giant).mapInArrow(_in_slices(both, schema), schema)

    key, place, part, ids = (free_name(docs, name) for name in ("text_row", "part_place", "text_part", "part_ids"))
    rows = stored(docs.filter(giant).withColumn(key, F.monotonically_increasing_id()), "bpe-long-texts")
    parts = rows.select(key, opened(F.col(text)).alias(part)).select(key, F.posexplode(part).alias(place, part))
    dealt = stored(parts, "bpe-parts").repartition(F.col(key), F.col(place))
    marked = F.concat(F.when(F.col(part)["final"], "1").otherwise("0"), F.col(part)["part"])
    ready = dealt.withColumn(ids, encoded(marked)).select(
        key,
        F.struct(
            F.col(place).alias("place"), F.coalesce(F.col(ids), F.col(part)["ids"]).alias("ids"), F.col(part)["part"].alias("part"),
            F.col(part)["joined"].alias("joined"), F.col(part)["final"].alias("final"),
        ).alias(part),
    )
    together = ready.groupBy(key).agg(F.array_sort(F.collect_list(part)).alias(part))
    texts = together.select(
        key, F.transform(part, lambda p: F.struct(p["ids"], p["part"], p["joined"], p["final"])).alias(part)
    )
    hard = rows.join(texts.select(key, closed(F.col(part)).alias(ids)), key, "left")
    hard = hard.withColumn(into, F.coalesce(F.col(ids), F.array().cast("array<int>"))).drop(key, ids)
    return easy.unionByName(decode(hard, into, decoded, tokenizer_path) if decoded else hard)


def decode(encoded: DataFrame, ids: str = "ids", into: str = "decoded", tokenizer_path: str = TOKENIZER) -> DataFrame:
    """Add the text that the ids stand for, special tokens included. Null and empty lists give the empty text.

    A column named ``into`` is replaced; no shuffle.
    """
    shared = encoded.sparkSession.sparkContext.broadcast(tokenizer_bytes(tokenizer_path))
    encoded = encoded.drop(into)
    schema = StructType([*encoded.schema.fields, StructField(into, StringType())])

    def texts() -> Callable[[pa.RecordBatch], list[pa.Array]]:
        decoder = Decoder(shared.value)
        return lambda rows: [pa.array(map(decoder.decode, _rows(rows.column(ids))), pa.string())]

    return encoded.mapInArrow(_in_slices(texts, schema), schema)


def bpe_report(docs: DataFrame, **options) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256."""
    decoded = encode(docs.select("doc_id", "text"), decoded="decoded", **options)
    listed = F.concat_ws(" ", F.col("ids").cast("array<string>"))
    return decoded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(listed.cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )
