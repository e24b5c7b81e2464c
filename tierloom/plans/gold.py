"""Analytical tables over the silver layer. Names, ranges and codes are arguments."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierloom.functions.columns import label
from tierloom.operators.joins import lookup
from tierloom.operators.ranking import exact_sum, summary, top_per_group

QUARTERS = ("Q01", "Q02", "Q03", "Q04")


def population_stats(population: DataFrame, nation: str, first_year: int, last_year: int) -> DataFrame:
    """Mean and population standard deviation over an inclusive range of years; exactly one row."""
    chosen = population.filter((F.col("nation") == nation) & F.col("year").between(first_year, last_year))
    return summary(chosen, "population", "mean_population", "stddev_population")


def yearly_totals(
    observations: DataFrame, periods: Sequence[str] = QUARTERS, scale: int | None = None
) -> DataFrame:
    """Sum of the given periods per series and year; years with fewer periods count too."""
    return (
        observations.filter(F.col("period").isin(*periods))
        .groupBy("series_id", "year")
        .agg(exact_sum("value", scale).alias("annual_value"))
    )


def series_labels(series: DataFrame, measures: DataFrame, sectors: DataFrame) -> DataFrame:
    """Readable label per series; a missing lookup leaves its part out."""
    coded = series.select("series_id", "measure_code", "sector_code")
    named = lookup(coded, measures.select("measure_code", "measure_text"), "measure_code")
    named = lookup(named, sectors.select("sector_code", "sector_name"), "sector_code")
    return named.select("series_id", label("sector_name", "measure_text").alias("series_label"))


def best_year_by_series(
    observations: DataFrame,
    series: DataFrame,
    measures: DataFrame,
    sectors: DataFrame,
    periods: Sequence[str] = QUARTERS,
    scale: int | None = None,
) -> DataFrame:
    """The year with the largest total per series; equal totals go to the earliest year."""
    best = top_per_group(
        yearly_totals(observations, periods, scale),
        ["series_id"],
        [F.col("annual_value").desc(), F.col("year").asc()],
    )
    return lookup(best, series_labels(series, measures, sectors), "series_id").select(
        "series_id",
        "series_label",
        F.col("year").alias("best_year"),
        F.col("annual_value").alias("best_year_value"),
    )


def series_population(
    observations: DataFrame, population: DataFrame, series_id: str, period: str, nation: str
) -> DataFrame:
    """One series and period by year beside the population of a nation, where that is known."""
    chosen = observations.filter((F.col("series_id") == series_id) & (F.col("period") == period))
    people = population.filter(F.col("nation") == nation).select("year", "population")
    return lookup(chosen.select("year", "value"), people, "year").select("year", "value", "population")


def metric_with_population(observations: DataFrame, population: DataFrame, nation: str) -> DataFrame:
    """All series and periods over time beside the population of a nation.

    The population should be a stored table: then Spark knows how small its rows of one nation are and broadcasts them
    below its own threshold. Beyond it the join goes by year, and adaptive execution splits the years.
    """
    people = population.filter(F.col("nation") == nation).select("year", "population")
    rows = observations.select("series_id", "year", "period", "value")
    return lookup(rows, people, "year").select(
        "series_id", "year", "period", "value", "population"
    )
