"""The whole refresh: landed files to bronze, silver and gold tables, then data checks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructField, StructType

from tierloom.functions.columns import trim_headers
from tierloom.operators.checks import suite
from tierloom.operators.expectations import json_or_nothing, recorded_report
from tierloom.plans import gold
from tierloom.plans.checks import best_year_checks, population_checks, series_population_checks
from tierloom.plans.silver import MEASURES, OBSERVATIONS, POPULATION, SECTORS, SERIES, SPECS, Spec, refine
from tierloom.sources.evolution import RESCUE, SchemaLog
from tierloom.sources.files import json_stream, tsv_stream
from tierloom.sources.tables import table_batch, table_stream
from tierloom.streaming.runs import describe, finish, publish, start_append

# Names of the four tab-separated datasets, of files or of the folders that ``land_snapshot`` makes.
GLOBS = {
    "bronze_bls_data": "pr.data.1.AllData*",
    "bronze_bls_series": "pr.series*",
    "bronze_bls_measure": "pr.measure*",
    "bronze_bls_sector": "pr.sector*",
}
COMMENTS = {
    "bronze_bls_data": "Observations as they arrived",
    "bronze_bls_series": "Series as they arrived",
    "bronze_bls_measure": "Measure names as they arrived",
    "bronze_bls_sector": "Sector names as they arrived",
    "bronze_population": "Population snapshots as they arrived, one row per response",
}
GOLD_COMMENTS = {
    "gold_population_stats": "Mean and standard deviation of the population over the chosen years",
    "gold_best_year_by_series": "Year with the largest sum of quarters for every series",
    "gold_series_population": "One series and period by year beside the population",
}
# Objects of a response that are kept as text, because an empty object has no fields to infer.
PINNED = StructType([StructField("annotations", StringType()), StructField("page", StringType())])


@dataclass(frozen=True)
class Layout:
    """Where raw files, checkpoints and tables are."""

    productivity_raw: str
    population_raw: str
    bronze_population_folder: str
    checkpoints: str
    productivity: str = "bls"
    population: str = "datausa"
    analytics: str = "population_analytics"
    # Partitions of the state of duplicates, fixed by the first run; None takes the session's shuffle partitions.
    state_partitions: int | None = None
    max_bytes: str | None = None
    partition_by: Mapping[str, Sequence[str]] = field(default_factory=dict)
    globs: Mapping[str, str] = field(default_factory=lambda: dict(GLOBS))
    # Raw schemas by bronze table, for datasets that may not have landed yet; others come from their header.
    schemas: Mapping[str, StructType] = field(default_factory=dict)

    def name(self, table: str) -> str:
        if table.startswith("gold_"):
            return f"{self.analytics}.{table}"
        return f"{self.population if table.endswith('population') else self.productivity}.{table}"

    def checkpoint(self, table: str) -> str:
        return f"{self.checkpoints}/{table}"


def create_schemas(spark: SparkSession, layout: Layout) -> None:
    for schema in (layout.productivity, layout.population, layout.analytics):
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS {schema}")


def ingest(spark: SparkSession, layout: Layout) -> None:
    """Bronze: all five sources at the same time, each file once."""
    queries = []
    for table, glob in layout.globs.items():
        landed = tsv_stream(
            spark, f"{layout.productivity_raw}/{glob}", layout.schemas.get(table), max_bytes=layout.max_bytes
        )
        queries.append(
            start_append(
                trim_headers(landed),
                layout.checkpoint(table),
                table=layout.name(table),
                partition_by=layout.partition_by.get(table, ()),
            )
        )
    table = "bronze_population"
    log = SchemaLog(spark, f"{layout.checkpoints}/{table}_schema")
    schema = log.refresh(layout.population_raw, pinned=PINNED)
    snapshots = json_stream(spark, layout.population_raw, schema, rescue=RESCUE, max_bytes=layout.max_bytes)
    queries.append(start_append(snapshots, layout.checkpoint(table), path=layout.bronze_population_folder))
    finish(queries)
    log.keep_late(layout.population_raw, schema, f"{layout.bronze_population_folder}_late", pinned=PINNED)
    define_over(spark, layout.name(table), layout.bronze_population_folder, snapshots.schema)
    for name, comment in COMMENTS.items():
        describe(spark, layout.name(name), comment)


def define_over(spark: SparkSession, name: str, folder: str, schema: StructType) -> None:
    """Make the stored definition of a table over ``folder`` follow a widened schema; the files stay as they are.

    New columns are added in place. Only a field added inside a column makes the definition anew, for which the catalog
    has no single step: a reader that asks for the table in that moment has to ask again.
    """
    if spark.catalog.tableExists(name):
        known = {field.name: field.dataType.simpleString() for field in spark.table(name).schema}
        wanted = {field.name: field.dataType for field in schema}
        if all(column in wanted and wanted[column].simpleString() == kind for column, kind in known.items()):
            added = [f"`{column}` {kind.simpleString()}" for column, kind in wanted.items() if column not in known]
            if added:
                spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({', '.join(added)})")
            spark.catalog.refreshTable(name)
            return
        spark.sql(f"DROP TABLE {name}")
    spark.catalog.createTable(name, folder, "parquet", schema=schema)


def clean(spark: SparkSession, layout: Layout, order: str = "expect_first") -> DataFrame:
    """Silver: what bronze gained since the last run. Returns (table, name, passed, failed) of every micro-batch since
    the last run that came to its end, those of runs that failed or lost their driver in between too."""
    number = unreported(spark, layout)
    reports = refined(spark, layout, number, order)
    mark_reported(spark, layout, number)
    return reports


def unreported(spark: SparkSession, layout: Layout) -> int:
    """The number of the folder of counts that no finished refresh has reported."""
    marks = json_or_nothing(spark, f"{layout.checkpoints}/expectation_reports", "number bigint")
    return marks.agg(F.coalesce(F.max("number") + 1, F.lit(0))).first()[0]


def mark_reported(spark: SparkSession, layout: Layout, number: int) -> None:
    marks = spark.createDataFrame([(number,)], "number bigint").coalesce(1)
    marks.write.mode("append").json(f"{layout.checkpoints}/expectation_reports")


def refined(spark: SparkSession, layout: Layout, number: int, order: str = "expect_first") -> DataFrame:
    """Silver, and the report of the folder of counts ``number``, which runs share until one is marked as reported."""
    counts = f"{layout.checkpoints}/expectation_counts/{number}"
    started: dict[str, tuple[Spec, StreamingQuery]] = {}
    try:
        for spec in SPECS:
            rows = refine(
                table_stream(spark, layout.name(spec.source)), spec, order=order, observe_as=spec.table
            )
            started[spec.table] = (
                spec,
                start_append(
                    rows,
                    layout.checkpoint(spec.table),
                    table=layout.name(spec.table),
                    state_partitions=layout.state_partitions,
                    partition_by=layout.partition_by.get(spec.table, ()),
                ),
            )
    finally:
        # Where one does not start, the others still end and are counted.
        finish([query for _, query in started.values()], counts)
    reports = None
    for table, (spec, _) in started.items():
        describe(spark, layout.name(table), spec.comment)
        rows = recorded_report(spark, counts, table, spec.expectations).selectExpr(f"'{table}' AS table", "*")
        reports = rows if reports is None else reports.unionAll(rows)
    return reports


def analyze(
    spark: SparkSession,
    layout: Layout,
    *,
    nation: str = "United States",
    years: tuple[int, int] = (2013, 2018),
    series_id: str = "PRS30006032",
    period: str = "Q01",
    scale: int | None = None,
) -> DataFrame:
    """Gold tables from the stored silver tables, and the verdicts of the checks on them."""

    def silver(spec: Spec) -> DataFrame:
        return table_batch(spark, layout.name(spec.table))

    observations, people = silver(OBSERVATIONS), silver(POPULATION)

    def keep(result: DataFrame, table: str) -> DataFrame:
        return publish(
            result, layout.name(table), GOLD_COMMENTS[table], partition_by=layout.partition_by.get(table, ())
        )

    stats = keep(gold.population_stats(people, nation, *years), "gold_population_stats")
    best = keep(
        gold.best_year_by_series(
            observations, silver(SERIES), silver(MEASURES), silver(SECTORS), scale=scale
        ),
        "gold_best_year_by_series",
    )
    paired = keep(
        gold.series_population(observations, people, series_id, period, nation), "gold_series_population"
    )
    chosen = observations.filter(
        (observations.series_id == series_id) & (observations.period == period)
    )
    return suite(
        [
            population_checks(stats),
            best_year_checks(best, gold.yearly_totals(observations, scale=scale)),
            series_population_checks(paired, chosen, people.filter(people.nation == nation)),
        ]
    )


def run_all(spark: SparkSession, layout: Layout, **options) -> tuple[DataFrame, DataFrame]:
    """One refresh of all layers: (expectation counts since the last finished refresh, verdicts of the checks)."""
    create_schemas(spark, layout)
    ingest(spark, layout)
    number = unreported(spark, layout)
    counts = refined(spark, layout, number)
    verdicts = analyze(spark, layout, **options)
    mark_reported(spark, layout, number)
    return counts, verdicts
