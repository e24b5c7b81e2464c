"""Incremental and batch readers for tab-separated files and JSON snapshots."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

LINEAGE = "_metadata"


def header_schema(spark: SparkSession, path: str, glob: str | None = None, sep: str = "\t") -> StructType:
    """All-string schema with the column names as they stand in the files (padding included).

    Reads the first line of one file. Every column is text, so that a code such as ``01`` keeps its zero.
    """
    reader = spark.read.option("header", True).option("sep", sep)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return StructType([StructField(name, StringType()) for name in reader.csv(path).columns])


def with_lineage(df: DataFrame) -> DataFrame:
    """Keep the hidden file struct of a file source as a stored column."""
    return df.select("*", F.col(LINEAGE))


def _limits(reader, glob: str | None, max_files: int | None, max_bytes: str | None):
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if max_bytes:
        reader = reader.option("maxBytesPerTrigger", max_bytes)
    return reader


def tsv_stream(
    spark: SparkSession,
    path: str,
    schema: StructType | None = None,
    *,
    glob: str | None = None,
    sep: str = "\t",
    max_files: int | None = None,
    max_bytes: str | None = None,
) -> DataFrame:
    """Tab-separated files with a header row, each read once per checkpoint, with file lineage.

    ``schema`` names the columns as in the header; without it the header of a landed file is taken. A file whose
    header differs fails the query instead of shifting values into other columns.
    """
    schema = schema or header_schema(spark, path, glob, sep)
    reader = spark.readStream.schema(schema).option("sep", sep).option("header", True)
    reader = _limits(reader.option("enforceSchema", False), glob, max_files, max_bytes)
    return with_lineage(reader.csv(path))


def tsv_batch(
    spark: SparkSession,
    path: str,
    schema: StructType | None = None,
    *,
    glob: str | None = None,
    sep: str = "\t",
) -> DataFrame:
    """The same files as one bounded table."""
    schema = schema or header_schema(spark, path, glob, sep)
    reader = spark.read.schema(schema).option("sep", sep).option("header", True)
    return with_lineage(_limits(reader.option("enforceSchema", False), glob, None, None).csv(path))


def json_stream(
    spark: SparkSession,
    path: str,
    schema: StructType | str,
    *,
    glob: str | None = None,
    multi_line: bool = False,
    rescue: str | None = None,
    max_files: int | None = None,
    max_bytes: str | None = None,
) -> DataFrame:
    """JSON objects, each file read once per checkpoint, with file lineage.

    ``rescue`` names a string column of the schema that takes the whole record when a value does not fit its type.
    """
    reader = spark.readStream.schema(schema).option("multiLine", multi_line)
    if rescue:
        reader = reader.option("columnNameOfCorruptRecord", rescue)
    return with_lineage(_limits(reader, glob, max_files, max_bytes).json(path))


def json_batch(
    spark: SparkSession,
    path: str,
    schema: StructType | str,
    *,
    glob: str | None = None,
    multi_line: bool = False,
) -> DataFrame:
    """The same files as one bounded table."""
    reader = spark.read.schema(schema).option("multiLine", multi_line)
    return with_lineage(_limits(reader, glob, None, None).json(path))


def infer_types(
    spark: SparkSession,
    path: str,
    *,
    glob: str | None = None,
    sep: str = "\t",
    keep_text: tuple[str, ...] = (),
) -> StructType:
    """Column types of tab-separated files, taken from all rows of all files, so that every value fits.

    Columns in ``keep_text`` (codes and ids, by trimmed name) stay text whatever the files hold.
    """
    header = spark.read.option("header", True).option("sep", sep)
    if glob:
        header = header.option("pathGlobFilter", glob)
    found = (
        header.option("inferSchema", True)
        .option("ignoreLeadingWhiteSpace", True)
        .option("ignoreTrailingWhiteSpace", True)
        .csv(path)
        .schema
    )
    return StructType(
        [
            StructField(field.name, StringType() if field.name.strip() in keep_text else field.dataType)
            for field in found
        ]
    )
