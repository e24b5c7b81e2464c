"""Whitening of embeddings: blockwise QR, then singular values and directions of the triangular factor.

Each task reduces its centred rows to a triangle, triangles are stacked and reduced in groups until one is left, and
``bidiagonal`` finds its singular values and right vectors. The covariance matrix is never formed, so small directions
keep their digits.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tierloom.llm.bidiagonal import leading_directions
from tierloom.llm.common import stored

SCALE, ORIGIN = 64, 1_000_000
COMPONENTS = 16
# Triangles that one task stacks.
FAN_IN = 16
# Entries beyond this many steps are refused, so that sums of a batch stay within 64 bits.
LARGEST = 1 << 40
EXACT = pa.decimal128(38, 0)


@dataclass(frozen=True)
class Centre:
    """Means of the fit list as whole parts and remainders: entry i is ``whole[i] + rest[i] / n``."""

    n: int
    whole: np.ndarray
    rest: np.ndarray

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (x - self.whole) - self.rest / self.n

    def deviations(self, x: np.ndarray) -> list[int]:
        """Sums of (n x - S)^2, exact: n^2 times squared steps, less 2 n times steps times remainders, plus their squares."""
        steps, last = x - self.whole, sum(int(r) ** 2 for r in self.rest)
        if self.n < 1 << 40 and x.shape[1] <= 1 << 12 and np.abs(steps).max(initial=0) < 1 << 25:
            # Remainders in two halves keep every sum within 64 bits.
            squares, high, low = (steps**2).sum(axis=1), steps @ (self.rest >> 20), steps @ (self.rest & 0xFFFFF)
            crossed = [(int(h) << 20) + int(part) for h, part in zip(high, low, strict=True)]
        else:
            squares = [sum(int(s) ** 2 for s in row) for row in steps]
            crossed = [sum(int(s) * int(r) for s, r in zip(row, self.rest, strict=True)) for row in steps]
        return [self.n**2 * int(a) - 2 * self.n * b + last for a, b in zip(squares, crossed, strict=True)]


def matrix(vectors: pa.Array, width: int) -> np.ndarray:
    return vectors.flatten().to_numpy(zero_copy_only=False).reshape(len(vectors), width)


def usable(vectors: DataFrame, id_column: str, embedding: str) -> DataFrame:
    """(vec_id, x) of rows whose vector has only finite entries, in whole steps."""
    c = F.col(embedding)
    finite = F.forall(c, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    step = F.transform(c, lambda v: F.floor(F.lit(float(SCALE)) * v.cast("double")))
    checked = F.transform(
        step,
        lambda s: F.when(F.abs(s) < LARGEST, s + ORIGIN).otherwise(F.raise_error(F.lit("an entry is too large")).cast("long")),
    )
    return vectors.filter(c.isNotNull() & finite).select(F.col(id_column).alias("vec_id"), checked.alias("x"))


def sums_step(width: int) -> Callable:
    """For ``mapInArrow`` over x: a task's sum per place, exact, and its number of rows at place -1."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, rows = np.zeros(width, object), 0
        for batch in batches:
            # At most 2^41 each, so a batch of 2^21 rows stays within 64 bits.
            total += matrix(batch.column(0), width).sum(axis=0).astype(object)
            rows += batch.num_rows
        values = [Decimal(rows), *(Decimal(int(t)) for t in total)]
        columns = [pa.array(range(-1, width), pa.int32()), pa.array(values, EXACT)]
        yield pa.RecordBatch.from_arrays(columns, names=["place", "total"])

    return run


def centre(fit: DataFrame, width: int) -> Centre:
    sums = fit.mapInArrow(sums_step(width), "place int, total decimal(38,0)").groupBy("place").agg(F.sum("total").alias("total"))
    total = {row["place"]: int(row["total"]) for row in sums.collect()}
    n = total[-1]
    parts = [divmod(total[i], n) for i in range(width)]
    return Centre(n, *(np.array(part, np.int64) for part in zip(*parts, strict=True)))


def triangle_batch(triangle: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(triangle), pa.list_(pa.float64()))], names=["r"])


def qr_step(width: int, middle: Centre | None) -> Callable:
    """For ``mapInArrow`` over rows, centred if ``middle`` is given: the triangle of all rows of a task, block by block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        triangle = np.zeros((0, width))
        for batch in batches:
            block = matrix(batch.column(0), width)
            triangle = np.linalg.qr(np.vstack([triangle, block if middle is None else middle.centred(block)]), mode="r")
        if len(triangle):
            yield triangle_batch(triangle)

    return run


def triangular_factor(fit: DataFrame, width: int, middle: Centre) -> np.ndarray:
    """R of the centred fit list: one triangle per task, then FAN_IN of them per task until one is left."""
    parts = fit.rdd.getNumPartitions()
    triangles = fit.mapInArrow(qr_step(width, middle), "r array<double>")
    while parts > 1:
        parts = -(-parts // FAN_IN)
        triangles = triangles.repartition(parts).mapInArrow(qr_step(width, None), "r array<double>")
    return np.array([row["r"] for row in triangles.collect()], float).reshape(-1, width)


@dataclass(frozen=True)
class Whitening:
    """What a fit gives: the centre, eigenvalues of the covariance, unit directions as columns, and the trace."""

    centre: Centre
    values: np.ndarray
    directions: np.ndarray
    trace: float

    def apply(self, x: np.ndarray) -> np.ndarray:
        return self.centre.centred(x) @ (self.directions / np.sqrt(self.values))


def fit_whitening(fit: DataFrame, width: int, components: int = COMPONENTS) -> Whitening:
    """From the distinct vectors ``x`` of one width."""
    middle = centre(fit, width)
    triangle = triangular_factor(fit, width, middle)
    squares, directions = leading_directions(triangle, components)
    return Whitening(middle, squares / middle.n, directions, float((triangle**2).sum()) / middle.n)


def products_step(model: Whitening, width: int) -> Callable:
    """For ``mapInArrow`` over x: a task's sums of whitened values (place i, -1) and of their products (i, j)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(model.values)
        sums, products = np.zeros(k), np.zeros((k, k))
        for batch in batches:
            y = model.apply(matrix(batch.column(0), width))
            sums += y.sum(axis=0)
            products += y.T @ y
        i, j = np.indices((k, k + 1)).reshape(2, -1)
        columns = [i, j - 1, np.hstack([sums[:, None], products]).ravel()]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["i", "j", "value"])

    return run


def identity_error(fit: DataFrame, width: int, model: Whitening) -> float:
    """The largest entry, by size, of the whitened fit list's covariance less the identity."""
    k, n = len(model.values), model.centre.n
    sums = fit.mapInArrow(products_step(model, width), "i long, j long, value double").groupBy("i", "j").agg(F.sum("value").alias("value"))
    table = np.zeros((k, k + 1))
    for row in sums.collect():
        table[row["i"], row["j"] + 1] = row["value"]
    means = table[:, 0] / n
    # Rows are centred before they are whitened, so the means are rounding and nothing cancels here.
    return float(np.abs(table[:, 1:] / n - np.outer(means, means) - np.eye(k)).max(initial=0.0))


OUTPUT = "component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"


def whitened_step(model: Whitening, width: int, error: float, id_type: pa.DataType) -> Callable:
    """For ``mapInArrow`` over (vec_id, x): a row for each vector and component."""
    k = len(model.values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix(batch.column(1), width)
            rows = len(x) * k
            deviations = pa.array([Decimal(d) for d in model.centre.deviations(x)], EXACT)
            columns = [
                batch.column(0).take(pa.array(np.repeat(np.arange(len(x)), k))),
                pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                pa.array(np.full(rows, model.centre.n, np.int64)),
                deviations.take(pa.array(np.repeat(np.arange(len(x)), k))),
                pa.array(model.apply(x).ravel()),
                pa.array(np.tile(model.values / model.trace, len(x))),
                pa.array(np.full(rows, error)),
            ]
            names = ["vec_id", *(part.split()[0] for part in OUTPUT.split(", "))]
            yield pa.RecordBatch.from_arrays([columns[0].cast(id_type), *columns[1:]], names=names)

    return run


def whiten(
    vectors: DataFrame, id_column: str = "vec_id", embedding: str = "embedding", components: int = COMPONENTS
) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained and identity_error, for every usable row and component.

    Rows whose vector is null or holds a null or non-finite entry are left out; so are those of another length than most
    usable rows have (of equally many, the longer), as they share no space, and empty vectors. Repeated rows come out
    alike, and equal vectors are fitted once. There are at most as many components as the fit list has directions, so a
    table of one distinct vector, as an empty one, gives no rows. Entries of a size above 2^40 / 64, and squared
    deviations of over 38 digits, raise an error. Other columns are not looked at.
    """
    rows = stored(usable(vectors, id_column, embedding), "whitening-rows")
    widths = rows.groupBy(F.size("x").alias("width")).count().filter("width > 0")
    commonest = widths.orderBy(F.desc("count"), F.desc("width")).first()
    id_type = rows.schema["vec_id"].dataType
    schema = f"vec_id {id_type.simpleString()}, {OUTPUT}"
    if commonest is None:
        return vectors.sparkSession.createDataFrame([], schema)
    width = commonest["width"]
    rows = rows.filter(F.size("x") == width)
    fit = stored(rows.select("x").distinct(), "whitening-fit")
    model = fit_whitening(fit, width, components)
    error = identity_error(fit, width, model)
    return rows.mapInArrow(whitened_step(model, width, error, to_arrow_type(id_type)), schema)
