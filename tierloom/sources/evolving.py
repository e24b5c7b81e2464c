"""Landed text and JSON whose columns and types change from file to file, ingested in one checkpoint.

Lines are streamed as text. Every micro-batch takes the columns of its own files from these files, in the batch itself, so
a file that brings a new column widens the table whenever it lands, and nothing has to be listed or looked at beforehand.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import ArrayType, DataType, DoubleType, StringType, StructField, StructType

from tierloom.sources.evolution import RESCUE, widen
from tierloom.sources.files import LINEAGE
from tierloom.streaming.keyed import AppendedTable, start_batches
from tierloom.workspace import release, stored

# From narrow to wide: a column has the widest type that any value of any file needs.
TYPES = ("int", "bigint", "double", "string")
# Whole numbers written in their shortest form; a code such as 01 is no number, nor is one with more digits than fit.
WHOLE = r"^(0|-?[1-9][0-9]{0,17})$"
DECIMAL = r"^-?(0|[1-9][0-9]{0,14})(\.[0-9]{1,15})?([eE][+-]?[0-9]{1,2})?$"
INT = (1 << 31) - 1
# Distinct headers of one micro-batch; more are taken for data without a header.
MOST_HEADERS = 1000


def lines(
    spark: SparkSession, path: str, *, glob: str | None = None, max_files: int | None = None, max_bytes: str | None = None,
    whole: bool = False,
) -> DataFrame:
    """A stream of landed lines (``value``) with their file; with ``whole`` one row per file."""
    reader = spark.readStream.option("wholetext", whole)
    for name, value in (("pathGlobFilter", glob), ("maxFilesPerTrigger", max_files), ("maxBytesPerTrigger", max_bytes)):
        if value is not None:
            reader = reader.option(name, value)
    return reader.text(path).select("value", F.col(LINEAGE))


def type_rank(value: Column) -> Column:
    """The place in TYPES that a text needs, from 1; 0 for NULL and blank ones."""
    text = F.trim(value)
    whole = F.when(F.abs(text.try_cast("bigint")) <= INT, 1).otherwise(2)
    return (
        F.when(F.coalesce(text, F.lit("")) == "", 0)
        .when(text.rlike(WHOLE), whole)
        .when(text.rlike(DECIMAL) & text.try_cast("double").isNotNull() & (text != "-0"), 3)
        .otherwise(4)
    )


def wider(known: Mapping[str, str], found: Mapping[str, str]) -> dict[str, str]:
    """Per column the wider of both types."""
    merged = dict(known)
    for name, kind in found.items():
        merged[name] = max(merged.get(name, kind), kind, key=TYPES.index)
    return merged


def headers_of(batch: DataFrame) -> DataFrame:
    """(file, header): the first line of every file of a batch."""
    first = batch.filter(F.col(f"{LINEAGE}.file_block_start") == 0).select(
        F.col(f"{LINEAGE}.file_path").alias("file"), "value", F.monotonically_increasing_id().alias("at")
    )
    return first.groupBy("file").agg(F.min_by("value", "at").alias("header"))


def united_rows(batch: DataFrame, heads: DataFrame, headers: Sequence[str], known: Sequence[str], sep: str) -> DataFrame:
    """The lines of a batch under their files' own headers: columns by name, those of ``known`` first.

    A line with another number of fields than its header has goes to RESCUE as a whole too. Lines of a file's first part
    that equal its header are left out.
    """
    names = {header: [part.strip() for part in header.split(sep)] for header in headers}
    for header, columns in names.items():
        if len({c.lower() for c in columns}) < len(columns):
            raise ValueError(f"a header names a column twice: {header!r}")
    every = list(dict.fromkeys([*known, *(column for columns in names.values() for column in columns)]))
    width = max(map(len, names.values()))
    fields = ", ".join(f"c{i} string" for i in range(width))
    joined = batch.join(heads, F.col(f"{LINEAGE}.file_path") == F.col("file"))
    is_header = (F.col(f"{LINEAGE}.file_block_start") == 0) & (F.col("value") == F.col("header"))
    parsed = joined.filter(~is_header & (F.trim("value") != "")).select(
        "value", "header", LINEAGE, F.from_csv("value", fields, {"sep": sep, "mode": "PERMISSIVE"}).alias("f")
    )
    parts = F.array(*[F.col(f"f.c{i}") for i in range(width)])

    def at(column: str) -> Column:
        """The place of a column in the line, by header."""
        places = [x for header, columns in names.items() if column in columns for x in (F.lit(header), F.lit(columns.index(column)))]
        if not places:
            return F.lit(None).cast("string")
        return F.get(F.col("_parts"), F.try_element_at(F.create_map(*places), F.col("header")))

    widths = F.create_map(*[x for header, columns in names.items() for x in (F.lit(header), F.lit(len(columns)))])
    counted = F.size(F.split("value", sep, -1))
    odd = ~F.col("value").contains('"') & (counted != F.element_at(widths, F.col("header")))
    return parsed.withColumn("_parts", parts).select(
        *[at(column).alias(column) for column in every], F.when(odd, F.col("value")).alias(RESCUE), LINEAGE
    )


def append_tsv(
    batch: DataFrame, source: str, number: int, table: AppendedTable, sep: str = "\t", keep_text: Sequence[str] = ()
) -> bool:
    """Add a micro-batch of lines to a bronze table of text columns, and widen its columns and types.

    Columns in ``keep_text`` stay text whatever they hold. The types that all rows so far need are part of the commit.
    """
    if table.holds(source, number):
        return False
    before = table.last()
    known = [name for name in before.schema.fieldNames() if name not in (RESCUE, LINEAGE)] if before else []
    heads = stored(headers_of(batch), "headers")
    headers = [row["header"] for row in heads.select("header").distinct().limit(MOST_HEADERS + 1).collect()]
    if len(headers) > MOST_HEADERS:
        raise ValueError(f"more than {MOST_HEADERS} different headers in one batch")
    if not headers:
        return False
    rows = united_rows(batch, heads, sorted(headers), known, sep)
    columns = [name for name in rows.columns if name not in (RESCUE, LINEAGE)]
    seen = Observation()
    ranks = [F.max(type_rank(F.col(f"`{name}`"))).alias(f"c{i}") for i, name in enumerate(columns)]

    def types(found: Mapping[str, int | None]) -> dict[str, str]:
        needed = {name: TYPES[rank - 1] for i, name in enumerate(columns) if (rank := found.get(f"c{i}"))}
        kept = dict.fromkeys([name for name in columns if name in keep_text], "string")
        return wider(before.types if before else {}, {**needed, **kept})

    done = table.append(rows.observe(seen, *ranks), source, number, seen, types)
    release(heads)
    return done


def tsv_into(landed: DataFrame, checkpoint: str, table: AppendedTable, **options) -> StreamingQuery:
    """Start to add all lines that have landed since the last run of ``checkpoint``; ``landed`` comes from ``lines``."""
    return start_batches(landed, checkpoint, lambda batch, source, number: append_tsv(batch, source, number, table, **options))


def typed(rows: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Text columns in the types that a commit holds, blanks as NULL. Every value fits, since its file was looked at for the
    type; only a whole number of over 15 digits beside one with decimals loses digits, which its text keeps."""

    def column(name: str) -> Column:
        text = F.col(f"`{name}`")
        kind = types.get(name, "string")
        return text if kind == "string" or name in (RESCUE, LINEAGE) else F.nullif(F.trim(text), F.lit("")).cast(kind).alias(name)

    return rows.select(*[column(name) for name in rows.columns])


def read_typed(table: AppendedTable, after: int = 0) -> DataFrame | None:
    """All rows of a bronze table, or those after a version, in the types that all its rows together need."""
    last = table.last()
    return typed(table.read(after), last.types) if last else None


# JSON


def json_schema(batch: DataFrame) -> StructType | None:
    """The schema of a batch of JSON objects, from one aggregate; malformed lines are ignored, numbers with decimals are
    doubles, and fields without a value or of several types are text."""
    found = batch.select(F.schema_of_variant_agg(F.try_parse_json("value")).alias("s")).first()["s"]
    if found is None or not found.startswith("OBJECT<"):
        return None
    described = StructType.fromDDL(f"v {found.replace('OBJECT<', 'STRUCT<')}")["v"].dataType
    return usable(described)


def usable(found: DataType) -> DataType:
    if isinstance(found, StructType) and found.fields:
        return StructType([StructField(f.name, usable(f.dataType)) for f in found])
    if isinstance(found, ArrayType):
        return ArrayType(usable(found.elementType))
    kind = found.typeName()
    if kind.startswith("decimal"):
        return DoubleType()
    return StringType() if kind in ("void", "variant", "struct") else found


def append_json(
    batch: DataFrame, source: str, number: int, table: AppendedTable, pinned: StructType | None = None
) -> bool:
    """Add a micro-batch of JSON objects, one per row, to a bronze table whose schema gains the batch's new fields first.

    Known fields keep their type; a value that does not fit leaves its whole object in RESCUE.
    """
    if table.holds(source, number):
        return False
    before = table.last()
    known = StructType([f for f in before.schema if f.name not in (RESCUE, LINEAGE)]) if before else pinned
    found = json_schema(batch)
    if found is None and known is None:
        return False
    fields = widen(known, found) if known and found else known or found
    parsed = F.from_json("value", StructType([*fields, StructField(RESCUE, StringType())]), {"columnNameOfCorruptRecord": RESCUE})
    rows = batch.filter(F.trim("value") != "").select(parsed.alias("j"), LINEAGE).select("j.*", LINEAGE)
    return table.append(rows, source, number)


def json_into(landed: DataFrame, checkpoint: str, table: AppendedTable, **options) -> StreamingQuery:
    """Start to add all objects that have landed since the last run of ``checkpoint``; ``landed`` comes from ``lines``."""
    return start_batches(landed, checkpoint, lambda batch, source, number: append_json(batch, source, number, table, **options))
