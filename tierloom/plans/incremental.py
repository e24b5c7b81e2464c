"""Gold tables brought up to date from what silver gained, by partial sums that are kept."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierloom.operators.joins import lookup
from tierloom.operators.ranking import exact_units, top_per_group
from tierloom.plans.gold import QUARTERS, series_labels
from tierloom.streaming.keyed import AddedTable, MergedTable, follow

TOTAL_KEYS = ("series_id", "year")


def partial_totals(observations: DataFrame, periods: Sequence[str] = QUARTERS, scale: int = 2) -> DataFrame:
    """(series_id, year, units, n): sums of values in whole units of ``scale`` decimals, which add up in any order."""
    chosen = observations.filter(F.col("period").isin(*periods))
    units = chosen.select(*TOTAL_KEYS, exact_units("value", scale).alias("units"))
    return units.groupBy(*TOTAL_KEYS).agg(F.sum("units").alias("units"), F.count("units").alias("n"))


def added_up(partial: DataFrame) -> DataFrame:
    return partial.groupBy(*TOTAL_KEYS).agg(F.sum("units").alias("units"), F.sum("n").alias("n"))


def refresh_totals(
    observations: AddedTable, totals: MergedTable, periods: Sequence[str] = QUARTERS, scale: int = 2
) -> bool:
    """Add what ``observations`` gained since the last refresh to the kept totals; False if it gained nothing.

    Only files of the new commits are read, and only buckets of totals that they touch are rewritten. The commit of the
    totals names the newest commit it has seen, so a refresh that is run again adds nothing twice.
    """

    def add(gained: DataFrame, source: str, batch: int) -> bool:
        return totals.merge(partial_totals(gained, periods, scale), source, batch, added_up)

    return follow(observations, totals, add)


def yearly_values(totals: DataFrame, scale: int = 2) -> DataFrame:
    """(series_id, year, annual_value) of kept totals; NULL where no value was there to add."""
    value = F.when(F.col("n") > 0, F.col("units").cast("double") / F.lit(float(10**scale)))
    return totals.select(*TOTAL_KEYS, value.alias("annual_value"))


def best_year_of_totals(
    totals: DataFrame, series: DataFrame, measures: DataFrame, sectors: DataFrame, scale: int = 2
) -> DataFrame:
    """The same table as ``gold.best_year_by_series``, from kept totals."""
    order = [F.col("annual_value").desc(), F.col("year").asc()]
    best = top_per_group(yearly_values(totals, scale), ["series_id"], order)
    return lookup(best, series_labels(series, measures, sectors), "series_id").select(
        "series_id", "series_label", F.col("year").alias("best_year"), F.col("annual_value").alias("best_year_value")
    )
