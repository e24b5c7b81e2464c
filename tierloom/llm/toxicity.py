"""Toxic passages as maximum-scoring segments of token log-odds, calibrated by extreme-value statistics.

Tokens are lower-case letter runs. A token's score is its log-odds of coming from a toxic document, shrunk by a
Dirichlet prior, less a drift that makes ordinary text negative; tokens that were never seen have the drift alone. A
linear scan finds all maximal segments. By Karlin and Altschul, a segment of score S in n tokens of clean text has
expectation K n exp(-lambda S); the excess of significant segments is added up and turned into a probability.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierloom.llm.common import free_name, maximal_stretches, release, remainder, stored

# About this many labelled documents of each class are learned from, chosen by a hash of their ids.
DOCS_PER_CLASS = 10_000
# Imagined documents per token, with the usual share of toxic ones; and how far log-odds shrink that are within their
# own error: a score of z standard deviations keeps z^2 / (z^2 + ERROR) of itself.
IMAGINED = 2.0
ERROR = 9.0
# Tokens of fewer documents of the sample count as never seen.
LEAST_DOCS = 4
DRIFT = 0.5
# Segments with a higher probability in clean text are not significant.
SIGNIFICANCE = 0.05
PREDICT_FROM = 0.7

_TOKEN = re.compile(r"[^\W\d_]+")


def tokens(text: str | None) -> list[str]:
    return _TOKEN.findall(text.lower()) if text else []


def segments(found: list[str], scores: dict[str, float], drift: float) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (first token, last token, score), by Ruzzo and Tompa's linear scan.

    Only tokens with a positive score can begin or end one, so what is between them counts as one step.
    """
    hits: list[int] = []
    # Turn by turn the tokens before a hit and the hit itself.
    steps: list[float] = []
    between = 0.0
    for i, token in enumerate(found):
        score = scores.get(token, -drift)
        if score > 0:
            steps += (between, score)
            hits.append(i)
            between = 0.0
        else:
            between += score
    upto = list(accumulate(steps, initial=0.0))
    return [(hits[a // 2], hits[b // 2], upto[b + 1] - upto[a]) for a, b in maximal_stretches(steps)]


def lexicon(toxic: np.ndarray, clean: np.ndarray, names: list[str], all_toxic: int, all_clean: int) -> dict[str, float]:
    """Log-odds of every token from document frequencies, shrunk by their error, less the drift."""
    base = (all_toxic + 1) / (all_toxic + all_clean + 2)
    rate = (toxic + IMAGINED * base) / (toxic + clean + IMAGINED)
    score = np.log(rate / (1 - rate)) - math.log(base / (1 - base))
    squared = score**2 / (1 / (toxic + IMAGINED * base) + 1 / (clean + IMAGINED * (1 - base)))
    kept = score * squared / (squared + ERROR) - DRIFT
    return {name: float(s) for name, s, seen in zip(names, kept, toxic + clean, strict=True) if seen}


def _decay(scores: np.ndarray, chances: np.ndarray) -> float:
    """The positive lambda at which the expectation of exp(lambda * score) over clean tokens is one."""

    def excess(decay: float) -> float:
        return float((chances * np.exp(np.minimum(decay * scores, 700))).sum() - 1)

    low, high = 0.0, 1.0
    while excess(high) < 0 and high < 1e3:
        low, high = high, high * 2
    # Where clean text has a positive mean score there is no such lambda; a small one calls nothing significant.
    if low == 0.0 and excess(1e-3) >= 0:
        return 1e-3
    low = max(low, 1e-3)
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if excess(middle) < 0 else (low, middle)
    return high


def features(segment_scores: list[float], n: int, decay: float, scale: float) -> tuple[float, float]:
    """What the extreme-value statistics say of a text: the excess lambda S - ln(K n), added up over its significant
    segments, and minus the log-probability of its best segment in clean text; both as log(1 + x)."""
    if not segment_scores or n <= 0:
        return 0.0, 0.0
    rarity = math.log(max(scale * n, 1e-300))
    total = best = 0.0
    for score in segment_scores:
        excess = decay * score - rarity
        chance = max(-math.expm1(-math.exp(min(-excess, 700))), 1e-300)
        best = max(best, -math.log(chance))
        if chance < SIGNIFICANCE:
            total += excess
    return math.log1p(max(total, 0.0)), math.log1p(best)


def _logistic(x: np.ndarray, y: np.ndarray) -> list[float]:
    """Intercept and slopes by Newton steps, with a weak penalty on slopes so that separable data stay finite."""
    design = np.column_stack([np.ones(len(x)), x])
    penalty = np.diag([1e-6] + [0.01] * x.shape[1])
    beta = np.zeros(design.shape[1])
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        gradient = design.T @ (y - p) - penalty @ beta
        step = np.linalg.solve((design * (p * (1 - p) + 1e-9)[:, None]).T @ design + penalty, gradient)
        beta += np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return beta.tolist()


def _sample(docs: DataFrame, labels: DataFrame, docs_per_class: int) -> DataFrame:
    """text, toxic and fold of the documents to learn from. Several labels of one id count as toxic if any is."""
    known = labels.filter(F.col("toxic").isNotNull() & (remainder("doc_id", 3) != 1))
    one = stored(known.groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic")), "toxicity-labels")
    sizes = {row["toxic"]: row["count"] for row in one.groupBy("toxic").count().collect()}
    place = F.pmod(F.xxhash64(F.col("doc_id").cast("string"), F.lit("toxicity")), F.lit(1 << 20))
    share = F.when(F.col("toxic") == 1, min(1.0, docs_per_class / max(sizes.get(1, 0), 1))).otherwise(
        min(1.0, docs_per_class / max(sizes.get(0, 0), 1))
    )
    # About twice docs_per_class ids, whatever the size of the tables.
    chosen = one.filter(place < share * (1 << 20)).withColumn("fold", (place % 2).cast("int"))
    texts = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").filter("text is not null")
    return stored(texts.select("text", "toxic", "fold"), "toxicity-sample")


def _frequencies(sample: DataFrame) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Tokens in LEAST_DOCS documents or more, their document frequencies by class and fold (columns toxic in
    fold 0 and 1, clean in fold 0 and 1), and the numbers of documents alike."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, list[int]] = {}
        for batch in batches:
            for text, toxic, fold in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                where = (0 if toxic == 1 else 2) + fold
                for token in {"", *tokens(text)}:
                    counts.setdefault(token, [0, 0, 0, 0])[where] += 1
        if counts:
            columns = [pa.array(column, pa.int64()) for column in zip(*counts.values(), strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(list(counts)), *columns], names=["token", "t0", "t1", "c0", "c1"])

    partial = sample.mapInArrow(count, "token string, t0 long, t1 long, c0 long, c1 long")
    summed = partial.groupBy("token").agg(*[F.sum(c).alias(c) for c in ("t0", "t1", "c0", "c1")])
    # The empty token counts the documents themselves. The sample bounds the number of tokens.
    rows = summed.filter((F.col("t0") + F.col("t1") + F.col("c0") + F.col("c1") >= LEAST_DOCS) | (F.col("token") == "")).collect()
    names, values, documents = [], [], np.zeros(4)
    for token, *numbers in rows:
        if token:
            names.append(token)
            values.append(numbers)
        else:
            documents = np.array(numbers, dtype=float)
    return names, np.array(values, dtype=float).reshape(-1, 4), documents


def learn(docs: DataFrame, labels: DataFrame, docs_per_class: int = DOCS_PER_CLASS) -> dict:
    """Token scores, lambda and K, intercept and slopes.

    Each half of the sample is scored with token scores of the other half, so that the calibration sees text that the
    scores have not seen; the final scores come from both halves. What reaches the driver is bounded by the sample.
    """
    sample = _sample(docs, labels, docs_per_class)
    names, counts, documents = _frequencies(sample)
    toxic, clean = counts[:, :2], counts[:, 2:]
    all_toxic, all_clean = documents[:2], documents[2:]
    both = lexicon(toxic.sum(axis=1), clean.sum(axis=1), names, int(all_toxic.sum()), int(all_clean.sum()))
    other = [lexicon(toxic[:, f], clean[:, f], names, int(all_toxic[f]), int(all_clean[f])) for f in (1, 0)]
    halves = sample.sparkSession.sparkContext.broadcast(other)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drawn: Counter[float] = Counter()
        for batch in batches:
            sizes, found = [], []
            for toxic, text, fold in zip(*(batch.column(i).to_pylist() for i in (1, 0, 2)), strict=True):
                scores, words = halves.value[fold], tokens(text)
                sizes.append(len(words))
                found.append([s for _, _, s in segments(words, scores, DRIFT)])
                if toxic == 0:
                    drawn.update(round(scores.get(word, -DRIFT), 2) for word in words)
            yield _scored_batch(batch.column(1), sizes, found, [None] * len(sizes))
        if drawn:
            # How often clean text has a score, as rows without a label.
            yield _scored_batch(pa.nulls(len(drawn), pa.int32()), list(drawn.values()), [None] * len(drawn), list(drawn))

    table = stored(sample.mapInArrow(scored, "toxic int, n long, found array<double>, score double"), "toxicity-segments")
    times = table.filter("toxic is null").groupBy("score").agg(F.sum("n").alias("n")).orderBy("score").collect()
    values, counts = (np.array([row[name] for row in times], float) for name in ("score", "n"))
    all_tokens = counts.sum()
    # One imagined token with a high score keeps lambda finite where clean text has none.
    decay = _decay(np.append(values, 1.0), np.append(counts, 1.0) / (all_tokens + 1))
    tops = np.array([row[0] for row in table.filter("toxic = 0").select(F.array_max("found")).collect() if row[0] is not None])
    level = float(np.quantile(tops, 0.5)) if len(tops) else 1.0
    scale = (float((tops >= level).sum()) + 0.5) / ((all_tokens + 1) * math.exp(-decay * level))

    @F.arrow_udf("array<double>")
    def described(found: pa.Array, n: pa.Array) -> pa.Array:
        rows = zip(found.to_pylist(), n.to_pylist(), strict=True)
        return pa.array([list(features(scores or [], size, decay, scale)) for scores, size in rows], pa.list_(pa.float64()))

    # Three numbers for each document of the sample.
    labelled = table.filter("toxic is not null")
    rows = labelled.select("toxic", described(F.col("found"), F.col("n")).alias("x")).collect()
    release(table, sample)
    x = np.array([row["x"] for row in rows], float).reshape(-1, 2)
    y = np.array([row["toxic"] == 1 for row in rows], dtype=float)
    beta = _logistic(x, y) if len(rows) else [0.0, 0.0, 0.0]
    return {"scores": both, "decay": decay, "scale": scale, "beta": beta}


def _scored_batch(toxic: pa.Array, n: list[int], found: list[list[float] | None], score: list[float | None]) -> pa.RecordBatch:
    columns = [toxic, pa.array(n, pa.int64()), pa.array(found, pa.list_(pa.float64())), pa.array(score, pa.float64())]
    return pa.RecordBatch.from_arrays(columns, names=["toxic", "n", "found", "score"])


def apply_model(text: str | None, model: dict) -> tuple[float, list[tuple[int, int, float]]]:
    """Probability that a text is toxic, and its significant segments (first and last token, score)."""
    words = tokens(text)
    found = segments(words, model["scores"], DRIFT)
    known = model["decay"], model["scale"]
    total, best = features([s for _, _, s in found], len(words), *known)
    intercept, first, second = model["beta"]
    place = min(max(intercept + first * total + second * best, -700.0), 700.0)
    return 1 / (1 + math.exp(-place)), [s for s in found if features([s[2]], len(words), *known)[0] > 0]


def spans(text: str, found: list[tuple[int, int, float]]) -> list[tuple[int, int]]:
    """Code points (start, end) of token segments; lower-casing is done token by token, so offsets are those of the text."""
    places = [(m.start(), m.end()) for m in _TOKEN.finditer(text)]
    return [(places[a][0], places[b][1]) for a, b, _ in found if b < len(places)]


def score_texts(docs: DataFrame, model: dict, text: str = "text", into: str = "toxicity") -> DataFrame:
    """Add a column with score and the spans of significant passages; a column of that name is replaced.

    Null and empty texts have no passage and the score of clean text. No shuffle; the model is broadcast, and its size
    is bounded by the sample it was learned from.
    """
    held = docs.sparkSession.sparkContext.broadcast(model)
    span = pa.struct([("start", pa.int64()), ("end", pa.int64())])
    kind = pa.struct([("score", pa.float64()), ("spans", pa.list_(span))])

    @F.arrow_udf("score double, spans array<struct<start:long,end:long>>")
    def scored(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            out = []
            for value in texts:
                passage = value.as_py()
                score, found = apply_model(passage, held.value)
                places = spans(passage, found) if found else []
                out.append({"score": score, "spans": [{"start": a, "end": b} for a, b in places]})
            yield pa.array(out, kind)

    return docs.withColumn(into, scored.asNondeterministic()(F.col(text)))


def toxicity_report(docs: DataFrame, labels: DataFrame, docs_per_class: int = DOCS_PER_CLASS) -> DataFrame:
    """doc_id, held_out, score, predicted (1 from PREDICT_FROM on).

    Labels are learned from ids whose CRC-32 leaves another remainder than 1 when divided by 3. Null ids are neither
    learned from nor held out; without labels every text has the score one half.
    """
    mark = free_name(docs, "toxicity")
    found = score_texts(docs.select("doc_id", "text"), learn(docs, labels, docs_per_class), into=mark)
    return found.select(
        "doc_id",
        F.coalesce(remainder("doc_id", 3) == 1, F.lit(False)).alias("held_out"),
        F.col(mark)["score"].alias("score"),
    ).withColumn("predicted", (F.col("score") >= PREDICT_FROM).cast("int"))
