"""Named row expectations: rows that do not meet them are dropped and counted."""

from __future__ import annotations

import json
from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

REPORT = "name string, passed bigint, failed bigint"
_ROWS = "_rows"
# What a folder of counts holds.
COUNTS = "query string, batch bigint, observation string, counter string, value bigint"


@dataclass(frozen=True)
class Expectation:
    """A name and a SQL predicate. A row meets it only when the predicate is true (NULL does not pass)."""

    name: str
    predicate: str

    def failed(self) -> Column:
        return ~F.coalesce(F.expr(self.predicate), F.lit(False))


def not_null(*columns: str) -> tuple[Expectation, ...]:
    return tuple(Expectation(f"valid_{column}", f"{column} IS NOT NULL") for column in columns)


def _counters(expectations: Sequence[Expectation]) -> list[Column]:
    return [F.count_if(expectation.failed()).alias(expectation.name) for expectation in expectations]


def enforce(df: DataFrame, expectations: Sequence[Expectation], observe_as: str | None = None) -> DataFrame:
    """Keep the rows that meet all expectations, in batches and in streams.

    With ``observe_as`` the counts per name are taken in the same pass and come with the query's metrics.
    """
    if observe_as:
        df = df.observe(observe_as, F.count(F.lit(1)).alias(_ROWS), *_counters(expectations))
    for expectation in expectations:
        df = df.filter(F.expr(expectation.predicate))
    return df


def observed(df: DataFrame, expectations: Sequence[Expectation], seen: Observation) -> DataFrame:
    """``enforce`` for one batch whose counts ``seen`` has once it is written: all ``rows``, and failed ones by name."""
    df = df.observe(seen, F.count(F.lit(1)).alias("rows"), *_counters(expectations))
    for expectation in expectations:
        df = df.filter(F.expr(expectation.predicate))
    return df


def report(df: DataFrame, expectations: Sequence[Expectation]) -> DataFrame:
    """One row per expectation with passed and failed counts, from one pass over the table."""
    totals = df.agg(F.count(F.lit(1)).alias(_ROWS), *_counters(expectations))
    rows = [
        F.struct(
            F.lit(expectation.name).alias("name"),
            (F.col(_ROWS) - F.col(expectation.name)).alias("passed"),
            F.col(expectation.name).alias("failed"),
        )
        for expectation in expectations
    ]
    return totals.select(F.inline(F.array(*rows)))


def stream_report(
    spark: SparkSession,
    queries: StreamingQuery | Iterable[StreamingQuery],
    observe_as: str,
    expectations: Sequence[Expectation],
    counts: str | None = None,
) -> DataFrame:
    """The same report for finished stream runs, summed over their micro-batches.

    ``counts`` is the folder that ``finish`` wrote them to: then all runs that wrote there count, those before a restart
    too. Without it the progress that the queries still remember counts, which is a bounded number of micro-batches;
    more raise an error.
    """
    if counts is not None:
        return recorded_report(spark, counts, observe_as, expectations)
    rows = 0
    failed = dict.fromkeys((expectation.name for expectation in expectations), 0)
    for query in [queries] if isinstance(queries, StreamingQuery) else queries:
        kept = [progress_of(progress) for progress in query.recentProgress]
        if len(kept) >= int(spark.conf.get("spark.sql.streaming.numRecentProgressUpdates")):
            raise ValueError("more micro-batches than the query remembers: give finish() a folder for counts")
        for progress in kept:
            metrics = progress.get("observedMetrics", {}).get(observe_as)
            if metrics:
                rows += metrics[_ROWS]
                for name in failed:
                    failed[name] += metrics[name]
    return spark.createDataFrame([(name, rows - count, count) for name, count in failed.items()], REPORT)


def progress_of(progress) -> dict:
    return json.loads(progress.json) if hasattr(progress, "json") else progress


def recorded(progress: dict) -> list[tuple[str, int, str, str, int]]:
    """(query, batch, observation, counter, value) of one micro-batch."""
    return [
        (progress["id"], progress["batchId"], observation, counter, int(value))
        for observation, metrics in (progress.get("observedMetrics") or {}).items()
        for counter, value in metrics.items()
    ]


def json_or_nothing(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    """The rows of a folder of JSON; none if it does not exist."""
    try:
        return spark.read.schema(schema).json(folder)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def recorded_report(
    spark: SparkSession, counts: str, observe_as: str, expectations: Sequence[Expectation]
) -> DataFrame:
    """The report of everything in a folder of counts. A micro-batch that was run again after a failure counts once."""
    # Without the folder no micro-batch had any rows.
    batches = json_or_nothing(spark, counts, COUNTS)
    observed = batches.filter(F.col("observation") == observe_as)
    once = observed.groupBy("query", "batch", "counter").agg(F.max("value").alias("value"))

    def total(counter: str) -> Column:
        return F.coalesce(F.sum(F.when(F.col("counter") == counter, F.col("value"))), F.lit(0))

    totals = once.agg(total(_ROWS).alias(_ROWS), *[total(e.name).alias(e.name) for e in expectations])
    rows = [
        F.struct(F.lit(e.name).alias("name"), (F.col(_ROWS) - F.col(e.name)).alias("passed"), F.col(e.name).alias("failed"))
        for e in expectations
    ]
    return totals.select(F.inline(F.array(*rows)))
