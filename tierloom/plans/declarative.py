"""The same tables as a declarative pipeline (``pyspark.pipelines``), for sites that run one.

Call ``define`` from a pipeline source file with the session the runner provides. Expectations act as filters there;
their counts come from ``tierloom.operators.expectations.report``.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark import pipelines as dp
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from tierloom.functions.columns import trim_headers
from tierloom.plans import gold
from tierloom.plans.silver import MEASURES, OBSERVATIONS, POPULATION, SECTORS, SERIES, SPECS, Spec, refine
from tierloom.sources.files import json_stream, tsv_stream
from tierloom.streaming.flows import COMMENTS, GOLD_COMMENTS, Layout


def define(
    spark: SparkSession,
    layout: Layout,
    schemas: Mapping[str, StructType],
    *,
    nation: str = "United States",
    years: tuple[int, int] = (2013, 2018),
    series_id: str = "PRS30006032",
    period: str = "Q01",
) -> None:
    """Register five bronze and five silver streaming tables and three materialized views.

    ``schemas`` holds the raw schema of every bronze table, header padding included.
    """

    def stored(spec: Spec) -> DataFrame:
        return spark.read.table(layout.name(spec.table))

    def tsv(table: str) -> Callable[[], DataFrame]:
        return lambda: trim_headers(
            tsv_stream(spark, layout.productivity_raw, schemas[table], glob=layout.globs[table])
        )

    def cleaned(spec: Spec) -> Callable[[], DataFrame]:
        return lambda: refine(spark.readStream.table(layout.name(spec.source)), spec)

    for table in layout.globs:
        dp.table(name=layout.name(table), comment=COMMENTS[table])(tsv(table))
    dp.table(name=layout.name("bronze_population"), comment=COMMENTS["bronze_population"])(
        lambda: json_stream(spark, layout.population_raw, schemas["bronze_population"])
    )
    for spec in SPECS:
        dp.table(name=layout.name(spec.table), comment=spec.comment)(cleaned(spec))

    views = {
        "gold_population_stats": lambda: gold.population_stats(stored(POPULATION), nation, *years),
        "gold_best_year_by_series": lambda: gold.best_year_by_series(
            stored(OBSERVATIONS), stored(SERIES), stored(MEASURES), stored(SECTORS)
        ),
        "gold_series_population": lambda: gold.series_population(
            stored(OBSERVATIONS), stored(POPULATION), series_id, period, nation
        ),
    }
    for name, query in views.items():
        dp.materialized_view(name=layout.name(name), comment=GOLD_COMMENTS[name])(query)
