"""Monitoring from small mergeable states, one row per dataset and batch, instead of from the tables themselves.

Row counts, null counts and sums are exact. Distinct keys are sketches (HyperLogLog): the relative standard error is about
1.04 / sqrt(2^LG_K), which is 1.6 % here; keys that come again in another batch count once, as sketches are united.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tierloom.operators.ranking import exact_units

LG_K = 12
EXACT = "decimal(38,0)"


def batch_states(
    df: DataFrame, dataset: str, batch: str | Column, keys: Sequence[str], value: str, scale: int = 2, lg_k: int = LG_K
) -> DataFrame:
    """(dataset, batch, rows, nulls, units, squares, sketch) of the rows of a batch, in one pass with partial aggregates.

    ``units`` and ``squares`` are sums of the value, and of its square, in whole units of ``scale`` decimals.
    """
    label = F.col(batch) if isinstance(batch, str) else batch
    unit = exact_units(value, scale).cast(EXACT)
    # Nulls are written apart from any text, and a length before each part keeps (a, bc) from (ab, c).
    parts = [F.coalesce(F.concat(F.length(F.col(k).cast("string")), F.lit(":"), F.col(k).cast("string")), F.lit("-")) for k in keys]
    rows = df.select(F.col(dataset).alias("dataset"), label.alias("batch"), unit.alias("u"), F.concat(*parts).alias("k"))
    return rows.groupBy("dataset", "batch").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("u").isNull()).alias("nulls"),
        F.sum("u").cast(EXACT).alias("units"),
        F.sum((F.col("u") * F.col("u")).cast(EXACT)).cast(EXACT).alias("squares"),
        F.hll_sketch_agg("k", F.lit(lg_k)).alias("sketch"),
    )


def united(states: DataFrame) -> DataFrame:
    """States of the same dataset and batch as one: what two refreshes saw of a batch."""
    return states.groupBy("dataset", "batch").agg(
        F.sum("rows").alias("rows"),
        F.sum("nulls").alias("nulls"),
        F.sum("units").cast(EXACT).alias("units"),
        F.sum("squares").cast(EXACT).alias("squares"),
        F.hll_union_agg("sketch").alias("sketch"),
    )


def dataset_summary(states: DataFrame, scale: int = 2) -> DataFrame:
    """(dataset, rows, null_rate, mean, deviation, distinct_keys, duplicate_rate) over all batches.

    The mean and the population deviation come from exact sums, distinct keys and duplicates from the united sketches.
    """
    sums = states.groupBy("dataset").agg(
        F.sum("rows").alias("rows"),
        F.sum("nulls").alias("nulls"),
        F.sum("units").cast(EXACT).alias("units"),
        F.sum("squares").cast(EXACT).alias("squares"),
        F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("distinct_keys"),
    )
    known, unit = F.col("rows") - F.col("nulls"), F.lit(float(10**scale))
    mean = F.try_divide(F.col("units").cast("double"), known.cast("double"))
    # n times the squares less the squared sum, before any division, would not fit; centred doubles do for a deviation.
    variance = F.try_divide(F.col("squares").cast("double"), known.cast("double")) - mean * mean
    return sums.select(
        "dataset",
        "rows",
        F.try_divide(F.col("nulls"), F.col("rows")).alias("null_rate"),
        (mean / unit).alias("mean"),
        (F.sqrt(F.greatest(variance, F.lit(0.0))) / unit).alias("deviation"),
        F.least("distinct_keys", "rows").alias("distinct_keys"),
        (1 - F.try_divide(F.least("distinct_keys", "rows"), F.col("rows"))).alias("duplicate_rate"),
    )


def batch_anomalies(states: DataFrame, history: int = 7, factor: float = 3.0) -> DataFrame:
    """Rows per batch against the mean and deviation of the batches before it, from states alone."""
    past = Window.partitionBy("dataset").orderBy("batch").rowsBetween(-history, -1)
    judged = states.select(
        "dataset",
        "batch",
        "rows",
        F.avg("rows").over(past).alias("expected"),
        F.stddev_pop("rows").over(past).alias("deviation"),
        F.count("rows").over(past).alias("known"),
    )
    far = F.abs(F.col("rows") - F.col("expected")) > factor * F.col("deviation")
    return judged.withColumn("anomalous", F.when(F.col("known") >= 2, far)).drop("known")
