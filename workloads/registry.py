"""Collects the registered queries with the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None) -> Callable[[Query], Query]:
    """Register a function, under its own name unless given; ``sql`` gives the same rows from the given tables."""

    def register(function: Query) -> Query:
        key = name or function.__name__
        QUERIES[key] = function
        if sql:
            ORACLES[key] = sql
        return function

    return register


# Fragments shared by the checking SQL.
QUARTERLY = """quarterly AS (
  SELECT CAST(l_suppkey AS VARCHAR) AS series_id, CAST(year(l_shipdate) AS INTEGER) AS year,
         'Q0' || quarter(l_shipdate) AS period,
         CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS value
  FROM lineitem GROUP BY 1, 2, 3)"""
OBSERVATIONS = QUARTERLY + """,
observations AS (
  SELECT series_id, year, period, value FROM quarterly
  UNION ALL
  SELECT CAST(l_suppkey AS VARCHAR), CAST(year(l_shipdate) AS INTEGER), 'Q05',
         CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE)
  FROM lineitem GROUP BY 1, 2)"""
POPULATION = """population AS (
  SELECT lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS nation_id, n_name AS nation,
         CAST(year(o_orderdate) + 1 AS INTEGER) AS year, count(DISTINCT o_custkey) AS population
  FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey
  GROUP BY 1, 2, 3)"""
YEARLY = """yearly AS (
  SELECT series_id, year, CAST(sum(CAST(value AS DECIMAL(28,2))) AS DOUBLE) AS annual_value
  FROM observations WHERE period IN ('Q01', 'Q02', 'Q03', 'Q04') GROUP BY series_id, year)"""
