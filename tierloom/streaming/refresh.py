"""The whole refresh without state stores: every layer takes what the one before has committed since its last commit.

Columns and types of the raw files may change on the way. Silver is its own memory of the keys it has, gold totals are kept
as partial sums, and expectation counts are committed with their rows, so a driver that is lost loses nothing.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierloom.operators.checks import suite
from tierloom.plans import gold
from tierloom.plans.checks import best_year_checks, population_checks, series_population_checks
from tierloom.plans.incremental import TOTAL_KEYS, best_year_of_totals, partial_totals, refresh_totals, yearly_values
from tierloom.plans.silver import MEASURES, OBSERVATIONS, POPULATION, SECTORS, SERIES, SPECS, Spec, project
from tierloom.sources.evolving import json_into, lines, tsv_into
from tierloom.streaming.flows import GOLD_COMMENTS, PINNED, Layout
from tierloom.streaming.keyed import BUCKETS, AddedTable, AppendedTable, MergedTable, follow
from tierloom.streaming.runs import finish, publish


@dataclass(frozen=True)
class Store:
    """The tables below one folder. ``buckets`` is fixed by the first commit of a table."""

    spark: SparkSession
    folder: str
    buckets: int = BUCKETS

    def bronze(self, name: str) -> AppendedTable:
        return AppendedTable(self.spark, f"{self.folder}/{name}")

    def silver(self, spec: Spec) -> AddedTable:
        return AddedTable(self.spark, f"{self.folder}/{spec.table}", spec.key, self.buckets)

    def silver_rows(self, spec: Spec) -> DataFrame:
        """All rows of a silver table; none, with its columns, before its dataset has landed."""
        rows = self.silver(spec).read()
        if rows is not None:
            return rows
        types = {"verbatim": "string"}
        columns = ", ".join(f"`{f.name}` {types.get(f.type_name, f.type_name)}" for f in spec.fields)
        return self.spark.createDataFrame([], columns)

    def totals(self) -> MergedTable:
        return MergedTable(self.spark, f"{self.folder}/gold_yearly_totals", TOTAL_KEYS, self.buckets)


def land_in_bronze(store: Store, layout: Layout) -> None:
    """All five sources at the same time, each file once, with the columns of its own header or objects."""
    queries = [
        tsv_into(
            lines(store.spark, f"{layout.productivity_raw}/{glob}", max_bytes=layout.max_bytes),
            layout.checkpoint(f"{table}_lines"),
            store.bronze(table),
        )
        for table, glob in layout.globs.items()
    ]
    landed = lines(store.spark, layout.population_raw, max_bytes=layout.max_bytes)
    queries.append(json_into(landed, layout.checkpoint("bronze_population_lines"), store.bronze("bronze_population"), pinned=PINNED))
    finish(queries)


def gain_silver(store: Store) -> DataFrame:
    """Add what bronze gained to the silver tables. Returns (table, name, passed, failed) of what this run added."""
    reports = None
    for spec in SPECS:
        silver = store.silver(spec)
        before = silver.last()

        def add(gained: DataFrame, source: str, version: int, spec: Spec = spec, silver: AddedTable = silver) -> bool:
            return silver.insert_new(project(gained, spec), source, version, spec.expectations)

        follow(store.bronze(spec.source), silver, add)
        counts = silver.report(spec.expectations, before.version if before else 0)
        rows = counts.selectExpr(f"'{spec.table}' AS table", "*")
        reports = rows if reports is None else reports.unionAll(rows)
    return reports


def gain_gold(
    store: Store, layout: Layout, *, nation: str, years: tuple[int, int], series_id: str, period: str, scale: int = 2
) -> DataFrame:
    """Gold tables, the yearly totals from what silver gained, and the verdicts of the checks."""

    def keep(result: DataFrame, table: str) -> DataFrame:
        return publish(result, layout.name(table), GOLD_COMMENTS[table], partition_by=layout.partition_by.get(table, ()))

    refresh_totals(store.silver(OBSERVATIONS), store.totals(), scale=scale)
    observations, people = store.silver_rows(OBSERVATIONS), store.silver_rows(POPULATION)
    totals = store.totals().read()
    if totals is None:
        totals = partial_totals(observations, scale=scale)
    stats = keep(gold.population_stats(people, nation, *years), "gold_population_stats")
    best = keep(
        best_year_of_totals(totals, *map(store.silver_rows, (SERIES, MEASURES, SECTORS)), scale), "gold_best_year_by_series"
    )
    paired = keep(gold.series_population(observations, people, series_id, period, nation), "gold_series_population")
    chosen = observations.filter((F.col("series_id") == series_id) & (F.col("period") == period))
    return suite(
        [
            population_checks(stats),
            best_year_checks(best, yearly_values(totals, scale)),
            series_population_checks(paired, chosen, people.filter(F.col("nation") == nation)),
        ]
    )


def refresh(store: Store, layout: Layout, **options) -> tuple[DataFrame, DataFrame]:
    """One refresh of all layers: (expectation counts of what it added, verdicts of the checks).

    Datasets that have not landed yet are waited for: their tables are empty until a later refresh finds them.
    """
    land_in_bronze(store, layout)
    counts = gain_silver(store)
    return counts, gain_gold(store, layout, **options)
