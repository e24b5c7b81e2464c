"""Observations, lookups, population and snapshots derived from the given tables.

Observations are shipped value per supplier and quarter (with yearly rows under period ``Q05``), a series is a
supplier with its nation as measure and sector code, and population is the number of ordering customers per nation
and year. Every function reads whole tables and stays lazy.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tierloom.operators.ranking import exact_sum

PAD = "      "
# Population of a year is published in the next one, so the first year of observations has none beside it.
PUBLISHED_AFTER = 1


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def text(column: str | Column) -> Column:
    return (F.col(column) if isinstance(column, str) else column).cast("string")


def shipped(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "lineitem").select(
        "l_suppkey",
        F.year("l_shipdate").alias("year"),
        F.quarter("l_shipdate").alias("quarter"),
        "l_extendedprice",
    )


def observations(spark: SparkSession, folder: str) -> DataFrame:
    """(series_id, year, period, value): quarters, and whole years added up from them, in one pass over the lines."""
    quarter = F.struct("period", "value")
    by_year = quarterly(spark, folder).groupBy("series_id", "year")
    # A year has four quarters at most.
    years = by_year.agg(F.collect_list(quarter).alias("quarters"), exact_sum("value", 2).alias("total"))
    whole = F.struct(F.lit("Q05").alias("period"), F.col("total").alias("value"))
    return years.select("series_id", "year", F.inline(F.array_append("quarters", whole)))


def quarterly(spark: SparkSession, folder: str) -> DataFrame:
    """The quarter rows alone."""
    totals = shipped(spark, folder).groupBy("l_suppkey", "year", "quarter")
    return totals.agg(exact_sum("l_extendedprice", 2).alias("value")).select(
        text("l_suppkey").alias("series_id"), "year", F.concat(F.lit("Q0"), text("quarter")).alias("period"), "value"
    )


def series(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "supplier").select(
        text("s_suppkey").alias("series_id"),
        F.lpad(text("s_nationkey"), 2, "0").alias("measure_code"),
        F.lpad(text("s_nationkey"), 2, "0").alias("sector_code"),
    )


def measures(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "nation").select(
        F.lpad(text("n_nationkey"), 2, "0").alias("measure_code"), F.col("n_name").alias("measure_text")
    )


def sectors(spark: SparkSession, folder: str) -> DataFrame:
    """Sector names exist for the codes of regions only, so most series have no sector."""
    return table(spark, folder, "region").select(
        F.lpad(text("r_regionkey"), 2, "0").alias("sector_code"), F.col("r_name").alias("sector_name")
    )


def population(spark: SparkSession, folder: str) -> DataFrame:
    """(nation_id, nation, year, population). Orders shrink to customer years before they meet the customers."""
    active = (
        table(spark, folder, "orders")
        .select(F.col("o_custkey").alias("c_custkey"), (F.year("o_orderdate") + PUBLISHED_AFTER).alias("year"))
        .distinct()
    )
    customers = table(spark, folder, "customer").select("c_custkey", F.col("c_nationkey").alias("n_nationkey"))
    counted = (
        active.join(customers, "c_custkey")
        .groupBy("n_nationkey", "year")
        .agg(F.count(F.lit(1)).alias("population"))
    )
    nations = table(spark, folder, "nation").select("n_nationkey", "n_name")
    return counted.join(nations, "n_nationkey").select(
        F.lpad(text("n_nationkey"), 2, "0").alias("nation_id"), F.col("n_name").alias("nation"), "year", "population"
    )


def raw_observations(spark: SparkSession, folder: str) -> DataFrame:
    """Observation lines as they would arrive: one per shipped item, all text, padded, with repeats.

    The business key is the order line; keys repeat because order lines repeat in the table.
    """
    return table(spark, folder, "lineitem").select(
        F.concat(text("l_orderkey"), F.lit("-"), text("l_linenumber"), F.lit(PAD)).alias("series_id"),
        F.concat(F.lit(" "), text(F.year("l_shipdate"))).alias("year"),
        F.concat(F.lit("Q0"), text(F.quarter("l_shipdate")), F.lit(" ")).alias("period"),
        # Returned items carry no value, so the expectation on the value has something to drop.
        F.when(F.col("l_returnflag") == "R", "-").otherwise(F.concat(F.lit(PAD), text("l_quantity"))).alias("value"),
        text("l_linestatus").alias("footnote_codes"),
    )


def document_snapshots(spark: SparkSession, folder: str) -> DataFrame:
    """One nested row per document: its attributes and an array with one record per line of the whole text."""
    lines = F.split("text", "\n")
    return table(spark, folder, "documents").select(
        "doc_id",
        "lang",
        F.transform(
            lines, lambda line, position: F.struct((position + 1).alias("Line No"), line.alias("Line"))
        ).alias("data"),
    )


def population_snapshots(spark: SparkSession, folder: str) -> DataFrame:
    """One response per nation with its yearly records under provider field names.

    The records are already one per nation and year, so an array holds as many as there are years.
    """
    record = F.struct(
        F.col("nation_id").alias("Nation ID"),
        F.col("nation").alias("Nation"),
        F.col("year").alias("Year"),
        F.col("population").cast("double").alias("Population"),
    )
    return (
        population(spark, folder)
        .groupBy("nation")
        .agg(F.sort_array(F.collect_list(record)).alias("data"))
        .select(F.lit("{}").alias("annotations"), F.lit("{}").alias("page"), "data")
    )
