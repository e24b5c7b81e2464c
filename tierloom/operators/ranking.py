"""Aggregates and ranking within groups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def summary(df: DataFrame, value: str, mean: str = "mean", deviation: str = "stddev") -> DataFrame:
    """Mean and population standard deviation of a column: always one row, NULLs for an empty input."""
    return df.agg(F.avg(value).alias(mean), F.stddev_pop(value).alias(deviation))


def exact_sum_sql(value: str, scale: int | None) -> str:
    """SQL text of ``exact_sum``, for both forms of a query."""
    if scale is None:
        return f"sum({value})"
    unit = f"1e{scale}D"
    scaled = f"{value} * {unit}"
    # A double holds a decimal number up to one part in 2^53; anything further off has more decimals.
    whole = f"abs({scaled} - rint({scaled})) <= abs({scaled}) * 1e-15D"
    units = f"try_cast(CASE WHEN {whole} THEN rint({scaled}) END AS bigint)"
    wrong = f"'a value of {value} has more than {scale} decimals, or the sum does not fit 64 bits'"
    return (
        f"CASE WHEN count({value}) = 0 THEN CAST(NULL AS double) "
        f"WHEN count({units}) = count({value}) AND try_sum({units}) IS NOT NULL THEN CAST(try_sum({units}) AS double) / {unit} "
        f"ELSE CAST(raise_error({wrong}) AS double) END"
    )


def exact_sum(value: str, scale: int | None) -> Column:
    """Sum of a double column; with ``scale`` added up in whole units of that many decimals.

    Adding integers gives the same total whatever the order of addition, so ties and retries cannot change a result,
    and it stays on primitive types, which sums of decimals do not. Nothing is rounded away: a value with more decimals,
    or a value or total that does not fit 64 bits, raises.
    """
    return F.expr(exact_sum_sql(value, scale))


def exact_units(value: str, scale: int) -> Column:
    """A double as whole units of ``scale`` decimals, to be added up in parts; more decimals than that raise."""
    scaled = F.col(value) * F.lit(float(10**scale))
    whole = F.abs(scaled - F.rint(scaled)) <= F.abs(scaled) * F.lit(1e-15)
    wrong = F.raise_error(F.concat(F.lit(f"a value of {value} has more than {scale} decimals: "), F.col(value).cast("string")))
    return F.when(scaled.isNull(), F.lit(None)).when(whole, F.rint(scaled)).otherwise(wrong.cast("double")).cast("bigint")


def grouped_sum(
    df: DataFrame, keys: Sequence[str], value: str, out: str, scale: int | None = None
) -> DataFrame:
    return df.groupBy(*keys).agg(exact_sum(value, scale).alias(out))


def grouped_max(df: DataFrame, keys: Sequence[str], value: str, out: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.max(value).alias(out))


def count_and_distinct(df: DataFrame, key: str) -> DataFrame:
    """Number of rows and exact number of distinct non-NULL keys."""
    return df.agg(F.count("*").alias("rows"), F.count_distinct(F.col(key)).alias("distinct_keys"))


def ranked(df: DataFrame, keys: Sequence[str], order: Sequence[Column], out: str = "row_num") -> DataFrame:
    """Position of every row within its group. Groups should be small (aggregate first)."""
    return df.withColumn(out, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))


def top_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int = 1) -> DataFrame:
    """First ``n`` rows of every group. Spark cuts each group to ``n`` rows per task before the shuffle."""
    position = "_position"
    return ranked(df, keys, order, position).filter(F.col(position) <= n).drop(position)
