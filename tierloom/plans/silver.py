"""Typed, validated and deduplicated tables, described by a small specification each."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierloom.functions.columns import extraction_time
from tierloom.operators.dedup import distinct_rows, first_arrival
from tierloom.operators.expectations import Expectation, enforce, not_null
from tierloom.operators.versions import latest_version
from tierloom.sources.files import LINEAGE


@dataclass(frozen=True)
class Field:
    """One output column: where it comes from, its type, and whether text is trimmed."""

    name: str
    source: str
    type_name: str = "string"

    def sql(self) -> str:
        if self.type_name == "string":
            return f"trim({self.source})"
        if self.type_name == "verbatim":
            return self.source
        return f"try_cast({self.source} AS {self.type_name})"

    def column(self) -> Column:
        return F.expr(self.sql()).alias(self.name)


@dataclass(frozen=True)
class Spec:
    """A silver table: its columns, business key and required columns; ``records`` is an array to unnest first."""

    table: str
    source: str
    comment: str
    fields: tuple[Field, ...]
    key: tuple[str, ...]
    required: tuple[str, ...]
    records: str | None = None

    @property
    def columns(self) -> list[str]:
        return [field.name for field in self.fields]

    @property
    def expectations(self) -> tuple[Expectation, ...]:
        return not_null(*self.required)


OBSERVATIONS = Spec(
    table="silver_bls_data",
    source="bronze_bls_data",
    comment="Observations with typed year and value, one row per series, year and period",
    fields=(
        Field("series_id", "series_id"),
        Field("year", "year", "int"),
        Field("period", "period"),
        Field("value", "value", "double"),
        Field("footnote_codes", "footnote_codes"),
    ),
    key=("series_id", "year", "period"),
    required=("series_id", "year", "period", "value"),
)
SERIES = Spec(
    table="silver_bls_series",
    source="bronze_bls_series",
    comment="Series with their sector and measure codes",
    fields=(
        Field("series_id", "series_id"),
        Field("sector_code", "sector_code"),
        Field("measure_code", "measure_code"),
    ),
    key=("series_id",),
    required=("series_id",),
)
MEASURES = Spec(
    table="silver_bls_measure",
    source="bronze_bls_measure",
    comment="Names of the measures",
    fields=(Field("measure_code", "measure_code"), Field("measure_text", "measure_text")),
    key=("measure_code",),
    required=("measure_code",),
)
SECTORS = Spec(
    table="silver_bls_sector",
    source="bronze_bls_sector",
    comment="Names of the sectors",
    fields=(Field("sector_code", "sector_code"), Field("sector_name", "sector_name")),
    key=("sector_code",),
    required=("sector_code",),
)
POPULATION = Spec(
    table="silver_population",
    source="bronze_population",
    comment="Population per nation and year",
    fields=(
        Field("nation_id", "record.`Nation ID`", "verbatim"),
        Field("nation", "record.Nation", "verbatim"),
        Field("year", "record.Year", "int"),
        Field("population", "record.Population", "bigint"),
    ),
    key=("nation_id", "year"),
    required=("nation_id", "year", "population"),
    records="data",
)
SPECS = (OBSERVATIONS, SERIES, MEASURES, SECTORS, POPULATION)


def project(bronze: DataFrame, spec: Spec) -> DataFrame:
    """The columns of the specification, plus file lineage where the input has it. NULL or empty arrays give no row."""
    kept = [LINEAGE] if LINEAGE in bronze.columns else []
    if spec.records:
        bronze = bronze.select(F.explode(spec.records).alias("record"), *kept)
    return bronze.select(*[field.column() for field in spec.fields], *kept)


def refine(
    bronze: DataFrame,
    spec: Spec,
    *,
    order: str = "expect_first",
    observe_as: str | None = None,
) -> DataFrame:
    """Silver rows from bronze rows, in batches and in streams.

    ``expect_first`` drops invalid rows before duplicates are removed, so that an invalid first arrival cannot take
    the key of a later good row. ``dedup_first`` is the order that follows from putting the expectations on the result
    of the deduplicating query.
    """
    if order not in ("expect_first", "dedup_first"):
        raise ValueError(f"unknown order: {order}")
    rows = project(bronze, spec)
    if order == "expect_first":
        return first_arrival(enforce(rows, spec.expectations, observe_as), spec.key)
    return enforce(first_arrival(rows, spec.key), spec.expectations, observe_as)


def refine_distinct(bronze: DataFrame, spec: Spec, *, observe_as: str | None = None) -> DataFrame:
    """Variant that removes only whole-row copies, without lineage: corrected values stay beside the first ones."""
    return distinct_rows(enforce(project(bronze, spec), spec.expectations, observe_as), spec.columns)


def refine_latest(bronze: DataFrame, spec: Spec) -> DataFrame:
    """Batch variant over the complete bronze history: per key the valid row of the newest extraction.

    Extraction time comes from the landed name; between equal stamps the later written file counts, then the values.
    """
    rows = enforce(project(bronze, spec), spec.expectations)
    newest_first = [
        extraction_time(F.col(f"{LINEAGE}.file_path")).desc_nulls_last(),
        F.col(f"{LINEAGE}.file_modification_time").desc_nulls_last(),
        *[F.col(name).desc_nulls_last() for name in spec.columns if name not in spec.key],
    ]
    return latest_version(rows, spec.key, newest_first)
