"""Check suites for the three analytical tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierloom.operators import checks
from tierloom.operators.ranking import grouped_max


def population_checks(stats: DataFrame) -> DataFrame:
    """One row, both columns there, not NULL and in range."""
    mean, deviation = "mean_population", "stddev_population"
    return checks.table_checks(
        stats,
        [
            checks.row_count_is("stats_one_row", 1),
            checks.has_columns("stats_columns", stats, [mean, deviation]),
            checks.no_row("stats_mean_present", checks.is_missing(mean)),
            checks.no_row("stats_stddev_present", checks.is_missing(deviation)),
            checks.every_row("stats_mean_positive", F.col(mean) > 0),
            checks.every_row("stats_stddev_not_negative", F.col(deviation) >= 0),
        ],
    )


def best_year_checks(best: DataFrame, yearly: DataFrame, tolerance: float = 1e-6) -> DataFrame:
    """One labelled row per series, holding the maximum of independently computed yearly totals."""
    required = ["series_id", "series_label", "best_year", "best_year_value"]
    shape = checks.table_checks(
        best,
        [
            checks.has_columns("best_columns", best, required),
            checks.not_empty("best_not_empty"),
            checks.unique_key("best_one_row_per_series", "series_id"),
            checks.no_row("best_series_present", checks.is_missing("series_id")),
            checks.no_row("best_year_present", checks.is_missing("best_year")),
            checks.no_row("best_value_present", checks.is_missing("best_year_value")),
            checks.no_row("best_label_present", checks.is_blank("series_label")),
        ],
    )
    maxima = grouped_max(yearly, ["series_id"], "annual_value", "expected_max_value")
    return checks.suite(
        [
            shape,
            checks.selected_is_max(
                "best_is_max", best, maxima, "series_id", "best_year_value", "expected_max_value", tolerance
            ),
        ]
    )


def series_population_checks(result: DataFrame, source: DataFrame, population: DataFrame) -> DataFrame:
    """All chosen observations are there, and the population wherever it is known for the year."""
    shape = checks.table_checks(
        result,
        [
            checks.has_columns("paired_columns", result, ["year", "value", "population"]),
            checks.not_empty("paired_not_empty"),
            checks.no_row("paired_year_present", checks.is_missing("year")),
            checks.no_row("paired_value_present", checks.is_missing("value")),
        ],
    )
    expected = source.select("year", "value")
    return checks.suite(
        [
            shape,
            checks.same_row_count("paired_same_count", result, source),
            checks.all_present("paired_all_present", expected, result, ["year", "value"]),
            checks.present_when_available("paired_population_present", result, population, "year", "population"),
        ]
    )
