"""Language identification: multinomial naive Bayes over hashed character n-grams.

Texts become sequences of lower-case letters with one space between letter runs; n-grams of one to three characters are
hashed into a fixed number of columns. Training counts columns per language; scoring multiplies one sparse matrix of
counts, with a row for every text of a batch, by the broadcast log-probabilities.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierloom.llm.common import free_name, release, remainder, stored

COLUMNS = 1 << 15
ORDERS = (1, 2, 3)
SMOOTHING = 0.1
# Training takes about this many documents of each language, chosen by hashes of their ids.
DOCS_PER_LANGUAGE = 4000
HASHES = 1 << 20
# The model is broadcast in blocks of so many languages, 16 MiB each, one at a time.
LANGUAGES_A_BLOCK = 64
# A batch is one sparse matrix, or several of about this many counts.
COUNTS_A_PORTION = 1 << 20
UNKNOWN = "und"

_NO_LETTERS = re.compile(r"[\W\d_]+")
_FACTORS = (np.uint32(0x9E3779B1), np.uint32(0x85EBCA77), np.uint32(0xC2B2AE3D))


def letters(text: str | None) -> str:
    """Lower-case letter runs with one space around each; empty if the text has no letter."""
    if not text:
        return ""
    kept = _NO_LETTERS.sub(" ", text.lower()).strip()
    return f" {kept} " if any(map(str.isalpha, kept)) else ""


def columns_of(text: str, columns: int = COLUMNS) -> np.ndarray:
    """The hashed columns of all n-grams of a normalised text, repeats included."""
    points = np.frombuffer(text.encode("utf-32-le", "replace"), dtype=np.uint32)
    shift = np.uint32(32 - (columns.bit_length() - 1))
    found = []
    with np.errstate(over="ignore"):
        for n in ORDERS:
            if len(points) < n:
                break
            mixed = np.full(len(points) - n + 1, n, dtype=np.uint32)
            for i in range(n):
                mixed = (mixed ^ points[i : len(points) - n + 1 + i]) * _FACTORS[i]
                mixed ^= mixed >> np.uint32(15)
            found.append((mixed * _FACTORS[0]) >> shift)
    return np.concatenate(found) if found else np.empty(0, dtype=np.uint32)


# Names of languages and their log-probabilities (one row per language, the prior in a last column).
Block = tuple[list[str], np.ndarray]


def learn(
    docs: DataFrame, text: str, language: str, id_column: str, train: Column, docs_per_language: int
) -> Iterator[Block]:
    """The model of all languages, in blocks in the order of their names."""
    usable = docs.filter(train & F.col(language).isNotNull() & F.col(text).isNotNull()).select(
        F.col(language).alias("language"), F.col(text).alias("text"), F.xxhash64(F.col(id_column).cast("string")).alias("hash")
    )
    # The share of hashes that gives about docs_per_language documents, whatever the size of the table; languages with
    # no more than that are taken whole and need not be listed.
    large = usable.groupBy("language").count().filter(F.col("count") > docs_per_language).collect()
    share = {row["language"]: docs_per_language / row["count"] for row in large}
    limit = F.lit(HASHES)
    if share:
        listed = F.create_map(*[F.lit(x) for name, part in share.items() for x in (name, int(part * HASHES))])
        limit = F.coalesce(F.try_element_at(listed, F.col("language")), limit)
    sample = usable.filter(F.pmod(F.col("hash"), F.lit(HASHES)) < limit).select("language", "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, np.ndarray] = {}
        documents: dict[str, int] = {}

        def counted() -> Iterator[pa.RecordBatch]:
            for name, row in counts.items():
                used = np.flatnonzero(row)
                # Column -1 counts documents.
                columns = pa.array(np.concatenate(([-1], used)), pa.int32())
                values = pa.array(np.concatenate(([documents[name]], row[used])), pa.int64())
                names = pa.array([name] * len(columns))
                yield pa.RecordBatch.from_arrays([names, columns, values], names=["language", "column", "n"])
            counts.clear()
            documents.clear()

        for batch in batches:
            for name, passage in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                kept = letters(passage)
                if kept:
                    if name not in counts and len(counts) == LANGUAGES_A_BLOCK:
                        yield from counted()
                    row = counts.setdefault(name, np.zeros(COLUMNS, dtype=np.int64))
                    row += np.bincount(columns_of(kept), minlength=COLUMNS)
                    documents[name] = documents.get(name, 0) + 1
        yield from counted()

    partial = sample.mapInArrow(count, "language string, column int, n long")
    summed = stored(partial.groupBy("language", "column").agg(F.sum("n").alias("n")), "language-counts")
    documents = {row["language"]: row["n"] for row in summed.filter("column = -1").collect()}
    total = sum(documents.values())
    names = sorted(documents)
    for start in range(0, len(names), LANGUAGES_A_BLOCK):
        block = names[start : start + LANGUAGES_A_BLOCK]
        known = summed.filter(F.col("language").between(block[0], block[-1]) & (F.col("column") >= 0)).toArrow()
        places = pc.index_in(known["language"], value_set=pa.array(block)).to_numpy()
        matrix = np.zeros((len(block), COLUMNS + 1))
        matrix[places, known["column"].to_numpy()] = known["n"].to_numpy()
        matrix[:, :COLUMNS] += SMOOTHING
        for i, name in enumerate(block):
            matrix[i, :COLUMNS] = np.log(matrix[i, :COLUMNS] / matrix[i, :COLUMNS].sum())
            matrix[i, COLUMNS] = np.log(documents[name] / total)
        yield block, matrix


def sparse_counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """The columns of a normalised text, and how often each stands in it."""
    found = columns_of(text)
    if len(found) < COLUMNS // 16:
        return np.unique(found, return_counts=True)
    row = np.bincount(found, minlength=COLUMNS)
    used = np.flatnonzero(row)
    return used, row[used]


def sparse_matrices(texts: list[str | None]) -> Iterator[tuple[list[int], np.ndarray, np.ndarray, np.ndarray]]:
    """(places of the texts that have letters, where their rows start, columns, counts): compressed sparse rows."""
    places, rows, size = [], [], 0

    def matrix():
        starts = np.cumsum([0, *(len(columns) for columns, _ in rows[:-1])])
        return places, starts, np.concatenate([c for c, _ in rows]), np.concatenate([n for _, n in rows])

    for i, text in enumerate(texts):
        kept = letters(text)
        if kept:
            places.append(i)
            rows.append(sparse_counts(kept))
            size += len(rows[-1][0])
            if size >= COUNTS_A_PORTION:
                yield matrix()
                places, rows, size = [], [], 0
    if rows:
        yield matrix()


def score_batch(texts: list[str | None], block: Block, former: list[dict | None]) -> list[dict]:
    """Best language so far of each text, its log-probability, and the sum of all probabilities in units of it, from one
    product of the batch with a block and what earlier blocks gave (``former``)."""
    out = [state or {"language": UNKNOWN, "best": -math.inf, "total": 0.0} for state in former]
    names, matrix = block
    for places, starts, columns, counts in sparse_matrices(texts):
        logs = np.stack([np.add.reduceat(row[columns] * counts, starts) + row[COLUMNS] for row in matrix], axis=1)
        first = logs.argmax(axis=1)
        for i, name, values in zip(places, np.array(names, dtype=object)[first], logs, strict=True):
            past, top = out[i], float(values.max())
            higher = max(top, past["best"])
            total = past["total"] * math.exp(past["best"] - higher) + float(np.exp(values - higher).sum())
            out[i] = {"language": name if top > past["best"] else past["language"], "best": higher, "total": total}
    return out


STATE = "language string, best double, total double"


def _scorer(held: Broadcast) -> Callable[..., Column]:
    @F.arrow_udf(STATE)
    def scored(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        kind = pa.struct([("language", pa.string()), ("best", pa.float64()), ("total", pa.float64())])
        for texts, former in batches:
            yield pa.array(score_batch(texts.to_pylist(), held.value, former.to_pylist()), kind)

    return scored.asNondeterministic()


def predict(docs: DataFrame, model: Iterable[Block], text: str = "text", into: str = "language_id") -> DataFrame:
    """Add a column with the predicted language and its probability; a column of that name is replaced.

    Null texts, and texts without a letter, give ``und`` with probability 0; ties go to the first name. All languages
    of the model are compared, whatever their number: beyond one block, each block is a pass of its own whose result is
    stored before the next is broadcast, so that a worker holds one at a time.
    """
    context = docs.sparkSession.sparkContext
    nothing = F.lit(None).cast("struct<language:string,best:double,total:double>")
    scored, before = docs.withColumn(into, nothing), None
    blocks = iter(model)
    block = next(blocks, None)
    while block is not None:
        scored = scored.withColumn(into, _scorer(context.broadcast(block))(F.col(text), F.col(into)))
        block = next(blocks, None)
        if block is not None:
            scored = stored(scored, "language-scores")
            if before is not None:
                release(before)
            before = scored
    state = F.col(into)
    known = F.coalesce(state["total"] > 0, F.lit(False))
    score = F.when(known, F.try_divide(F.lit(1.0), state["total"])).otherwise(0.0)
    name = F.coalesce(state["language"], F.lit(UNKNOWN))
    return scored.withColumn(into, F.struct(name.alias("language"), score.alias("score")))


def identify(
    docs: DataFrame,
    text: str = "text",
    language: str = "lang",
    id_column: str = "doc_id",
    docs_per_language: int = DOCS_PER_LANGUAGE,
    into: str = "language_id",
) -> DataFrame:
    """Learn from documents whose id leaves another remainder than 2 when its CRC-32 is divided by 4, predict all.

    Neither language, source nor id enter a prediction. Rows with a null id, language or text are not learned from; a
    table without any such row gives ``und`` everywhere. Repeated ids are all learned from.
    """
    train = remainder(id_column, 4) != 2
    return predict(docs, learn(docs, text, language, id_column, train, docs_per_language), text, into)


def language_report(docs: DataFrame, **options) -> DataFrame:
    """doc_id, held_out, lang_pred, score."""
    found = identify(docs.select("doc_id", "text", "lang"), **options)
    return found.select(
        "doc_id",
        F.coalesce(remainder("doc_id", 4) == 2, F.lit(False)).alias("held_out"),
        F.col("language_id")["language"].alias("lang_pred"),
        F.col("language_id")["score"].alias("score"),
    )


def keep_identified(docs: DataFrame, least: float = 0.5, **options) -> DataFrame:
    """The documents whose language is known with probability ``least`` or more, with their own columns."""
    mark = free_name(docs, "language_id")
    found = identify(docs, into=mark, **options)
    sure = (F.col(mark)["language"] != UNKNOWN) & (F.col(mark)["score"] >= least)
    return found.filter(sure).select(docs.columns)
