"""Additive schema evolution for JSON sources: new fields are added, known fields keep their type."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from itertools import islice

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StringType, StructField, StructType

from tierloom.workspace import release, stored

RESCUE = "_rescued"
# New files that are named in one read.
AT_ONCE = 10_000


def widen(known: DataType, found: DataType) -> DataType:
    """``known`` plus the fields only ``found`` has, at every depth of structs and arrays."""
    if isinstance(known, StructType) and isinstance(found, StructType):
        new_types = {field.name: field.dataType for field in found}
        fields = [
            StructField(field.name, widen(field.dataType, new_types.get(field.name, field.dataType)))
            for field in known
        ]
        names = set(known.fieldNames())
        return StructType(fields + [StructField(f.name, f.dataType) for f in found if f.name not in names])
    if isinstance(known, ArrayType) and isinstance(found, ArrayType):
        return ArrayType(widen(known.elementType, found.elementType))
    return known


def infer_json(
    spark: SparkSession,
    paths: str | list[str],
    *,
    pinned: StructType | None = None,
    glob: str | None = None,
    multi_line: bool = False,
    recursive: bool = False,
) -> StructType | None:
    """Schema of the landed snapshots; ``pinned`` fields take the given type (e.g. ``{}`` kept as text).

    All rows count: a field seen once must not be lost. None when there are no files.
    """
    reader = spark.read.option("multiLine", multi_line).option("recursiveFileLookup", recursive)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if not paths:
        return None
    try:
        found = reader.json(paths).schema
    except AnalysisException as error:
        if error.getCondition() != "UNABLE_TO_INFER_SCHEMA":
            raise
        return None
    return widen(pinned, found) if pinned else found


class SchemaLog:
    """Versions of an evolving schema, kept as a small append-only folder beside the checkpoint."""

    COLUMNS = "version int, fields string"
    FILES = "file string, length bigint, changed string"

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def _latest(self) -> Row | None:
        try:
            log = self.spark.read.schema(self.COLUMNS).json(self.folder)
            return log.orderBy(F.desc("version")).first()
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return None

    def current(self) -> StructType | None:
        row = self._latest()
        return StructType.fromJson(json.loads(row["fields"])) if row else None

    def absorb(self, found: StructType | None) -> StructType:
        """Merge newly found fields into the saved schema and save the result.

        To be called before the read: a field unknown at read time would be lost. Every schema has the column that
        takes whole records with a value that does not fit.
        """
        row = self._latest()
        known = StructType.fromJson(json.loads(row["fields"])) if row else None
        if known is None and found is None:
            raise ValueError("no landed file to take a schema from")
        merged = widen(known, found) if known and found else known or found
        if RESCUE not in merged.fieldNames():
            merged = StructType([*merged.fields, StructField(RESCUE, StringType())])
        if merged != known:
            entry = (row["version"] + 1 if row else 1, merged.json())
            self.spark.createDataFrame([entry], self.COLUMNS).coalesce(1).write.mode("append").json(self.folder)
        return merged

    def _seen(self) -> DataFrame | None:
        try:
            return self.spark.read.schema(self.FILES).parquet(f"{self.folder}_files")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return None

    def _new_files(self, path: str, glob: str | None) -> DataFrame:
        """(file, length, changed) of landed files that no refresh has looked at: a listing, no content is read.

        A file counts by name, length and change together, whatever its date is.
        """
        reader = self.spark.read.format("binaryFile").option("recursiveFileLookup", "true")
        if glob:
            reader = reader.option("pathGlobFilter", glob)
        listed = reader.load(path).selectExpr("path AS file", "length", "CAST(modificationTime AS string) AS changed")
        listed = listed.filter(~F.substring_index("file", "/", -1).rlike(r"^[._]"))
        seen = self._seen()
        fresh = listed if seen is None else listed.join(seen, ["file", "length", "changed"], "left_anti")
        return stored(fresh, "new-files")

    def _parts(self, fresh: DataFrame) -> Iterator[list[str]]:
        """Names of new files as readers take them, AT_ONCE at a time."""
        names = (quoted(row["file"]) for row in fresh.select("file").toLocalIterator())
        while part := list(islice(names, AT_ONCE)):
            yield part

    def refresh(self, path: str, *, glob: str | None = None, **options) -> StructType:
        """Schema for the next run: what is known plus the fields of files no refresh has looked at.

        The first refresh reads all files by their folder; later ones name the new files, AT_ONCE in one read. The notes
        of files are written as a table, not from the driver.
        """
        first = self._seen() is None
        fresh = self._new_files(path, glob)
        found = infer_json(self.spark, path, glob=glob, recursive=True, **options) if first else None
        for part in [] if first else self._parts(fresh):
            more = infer_json(self.spark, part, **options)
            found = widen(found, more) if found and more else found or more
        schema = self.absorb(found)
        # Noted after the schema is saved: a failure in between only means that files are looked at again.
        if not fresh.isEmpty():
            fresh.write.mode("append").parquet(f"{self.folder}_files")
        release(fresh)
        return schema

    def keep_late(self, path: str, used: StructType, folder: str, *, glob: str | None = None, **options) -> StructType:
        """To be called after a run that read with ``used``: files that landed since may bring fields it did not know.

        Where they do, their whole records are stored in ``folder`` with the widened schema and their lineage, since
        the run may have read them already, without those fields. Later runs know the fields.
        """
        fresh = self._new_files(path, glob)
        schema = self.refresh(path, glob=glob, **options)
        if schema != used:
            for part in self._parts(fresh):
                late = self.spark.read.schema(schema).option("columnNameOfCorruptRecord", RESCUE).json(part)
                late.select("*", F.col("_metadata")).write.mode("append").parquet(folder)
        release(fresh)
        return schema


def quoted(path: str) -> str:
    """A path as a reader's pattern that stands for itself only."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", path)
