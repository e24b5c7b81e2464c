"""The same tables written as Spark SQL over DataFrames; inputs are streams or stored tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tierloom.operators.dedup import distinct_rows
from tierloom.operators.expectations import enforce
from tierloom.operators.ranking import exact_sum_sql
from tierloom.plans.silver import Spec
from tierloom.sources.files import LINEAGE

BRONZE = "SELECT * FROM {raw}"


def bronze(spark: SparkSession, raw: DataFrame) -> DataFrame:
    """Star projection of landed files (S1 or S2 with lineage) through SQL; stays a stream for a stream."""
    return spark.sql(BRONZE, raw=raw)


def appended(spark: SparkSession, table: str) -> DataFrame:
    """Rows appended to a table, as a SQL stream."""
    return spark.sql(f"SELECT * FROM STREAM {table}")


def silver_text(spec: Spec, lineage: bool) -> str:
    """The projection of a silver table as SQL text over ``{{bronze}}``."""
    kept = [LINEAGE] if lineage else []
    columns = ",\n       ".join([f"{field.sql()} AS {field.name}" for field in spec.fields] + kept)
    source = "{bronze}"
    if spec.records:
        source = f"(SELECT {', '.join([f'explode({spec.records}) AS record', *kept])} FROM {source})"
    return f"SELECT {columns}\nFROM {source}"


def silver(spark: SparkSession, bronze: DataFrame, spec: Spec, observe_as: str | None = None) -> DataFrame:
    """SQL projection, constraints that drop rows, then whole-row distinct.

    Spark rejects ``SELECT DISTINCT`` on a stream, so the last step is the streaming operator.
    """
    rows = spark.sql(silver_text(spec, LINEAGE in bronze.columns), bronze=bronze)
    return distinct_rows(enforce(rows, spec.expectations, observe_as), spec.columns)


POPULATION_STATS = """
SELECT avg(population) AS mean_population, stddev_pop(population) AS stddev_population
FROM {population}
WHERE nation = :nation AND year BETWEEN :first_year AND :last_year
"""

# Spark cuts the ranked rows of a series to the first one in every task, before the shuffle.
BEST_YEAR = """
WITH yearly AS (
  SELECT series_id, year, {total} AS annual_value
  FROM {{observations}}
  WHERE period IN ('Q01', 'Q02', 'Q03', 'Q04')
  GROUP BY series_id, year
),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY annual_value DESC, year) AS row_num FROM yearly
),
best AS (SELECT * FROM ranked WHERE row_num = 1),
labels AS (
  SELECT series_id, concat_ws(' - ', sector_name, measure_text) AS series_label
  FROM {{series}}
  LEFT JOIN {{measures}} USING (measure_code)
  LEFT JOIN {{sectors}} USING (sector_code)
)
SELECT best.series_id, labels.series_label, best.year AS best_year, best.annual_value AS best_year_value
FROM best LEFT JOIN labels ON labels.series_id = best.series_id
"""

# The nation stands in ON: in WHERE it would remove the years without population.
SERIES_POPULATION = """
SELECT o.year, o.value, p.population
FROM {observations} o
LEFT JOIN {population} p ON p.year = o.year AND p.nation = :nation
WHERE o.series_id = :series_id AND o.period = :period
"""


def population_stats(
    spark: SparkSession, population: DataFrame, nation: str, first_year: int, last_year: int
) -> DataFrame:
    arguments = {"nation": nation, "first_year": first_year, "last_year": last_year}
    return spark.sql(POPULATION_STATS, args=arguments, population=population)


def best_year_by_series(
    spark: SparkSession,
    observations: DataFrame,
    series: DataFrame,
    measures: DataFrame,
    sectors: DataFrame,
    scale: int | None = None,
) -> DataFrame:
    total = exact_sum_sql("value", scale)
    return spark.sql(
        BEST_YEAR.format(total=total),
        observations=observations.select("series_id", "year", "period", "value"),
        series=series.select("series_id", "measure_code", "sector_code"),
        measures=measures.select("measure_code", "measure_text"),
        sectors=sectors.select("sector_code", "sector_name"),
    )


def series_population(
    spark: SparkSession,
    observations: DataFrame,
    population: DataFrame,
    series_id: str,
    period: str,
    nation: str,
) -> DataFrame:
    arguments = {"nation": nation, "series_id": series_id, "period": period}
    return spark.sql(SERIES_POPULATION, args=arguments, observations=observations, population=population)
