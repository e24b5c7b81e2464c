"""Readers for stored tables: full contents, or only what was appended since the last run."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table_batch(spark: SparkSession, name: str) -> DataFrame:
    """Full current contents of a table."""
    return spark.table(name)


def table_stream(spark: SparkSession, name: str) -> DataFrame:
    """Rows appended to a table since the checkpoint of the reading query."""
    return spark.readStream.table(name)


def folder_stream(spark: SparkSession, path: str) -> DataFrame:
    """Rows appended to a Parquet folder since the checkpoint of the reading query."""
    return spark.readStream.schema(spark.read.parquet(path).schema).parquet(path)
