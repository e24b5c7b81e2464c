"""Monitoring of layered tables: drift, NULL rates, row counts, duplicates and freshness."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tierloom.workspace import release, stored

# Levels of nested values that are opened in one pass.
LEVELS = 4
LABELS = "array<struct<d: bigint, depth: int, path: string, found_type: string>>"


def schema_differences(contract: StructType, found: StructType) -> list[tuple[str, str]]:
    """(field, problem) for columns that are missing, retyped or unexpected. Schemas only, no data is read."""
    expected = {field.name: field.dataType for field in contract}
    actual = {field.name: field.dataType for field in found}
    missing = [(name, "missing") for name in expected if name not in actual]
    retyped = [(name, "retyped") for name in expected if name in actual and expected[name] != actual[name]]
    unexpected = [(name, "unexpected") for name in actual if name not in expected]
    return sorted(missing + retyped + unexpected)


def json_drift(df: DataFrame, document: str, contract: Mapping[str, str]) -> DataFrame:
    """(field, found_type, rows, problem) for the fields of a JSON text column against {field: type}.

    Types carry the names of ``schema_of_variant``. Fields of the contract that no row has come with zero rows.
    Fields in order have a NULL problem.
    """
    spark = df.sparkSession
    parsed = df.select(F.try_parse_json(F.col(document)).alias("v"))
    entries = parsed.lateralJoin(spark.tvf.variant_explode(F.col("v").outer())).select(
        F.col("key").alias("field"), F.schema_of_variant(F.col("value")).alias("found_type")
    )
    counted = entries.groupBy("field", "found_type").agg(F.count(F.lit(1)).alias("rows"))
    wanted = spark.createDataFrame(list(contract.items()), "field string, wanted_type string")
    problem = (
        F.when(F.col("found_type").isNull(), "missing")
        .when(F.col("wanted_type").isNull(), "unexpected")
        .when(F.col("wanted_type") != F.col("found_type"), "retyped")
    )
    return counted.join(wanted, "field", "full_outer").select(
        "field", "found_type", F.coalesce("rows", F.lit(0)).cast("bigint").alias("rows"), problem.alias("problem")
    )


def _kind(value: Column) -> Column:
    return F.regexp_extract(F.schema_of_variant(value), "^[A-Z]+", 0)


def _one_level(level: DataFrame, depth: int) -> DataFrame:
    """Open the values in ``v``: each row gives one for everything inside its value, or stays as it is without any.

    ``found`` lists (d, depth, path, found_type) of a row and, on the first of several rows, of what they come from, so
    that all rows together have everything once. ``many`` says that other values of the document may have the same path, as
    inside arrays; then ``d`` tells documents apart. Of an array's elements only the first of each type is listed, so
    those of an array that is alone on its path do not repeat.
    """
    kinds = F.transform(F.try_variant_get("v", "$", "array<variant>"), _kind)
    firsts = F.transform(F.array_distinct("kinds"), lambda kind: F.array_position("kinds", kind) - 1)
    before = level.withColumn("kinds", F.when(F.col("found_type") == "ARRAY", kinds)).withColumn("firsts", firsts)
    inside = before.lateralJoin(level.sparkSession.tvf.variant_explode_outer(F.col("v").outer()))
    pos, key = F.col("pos"), F.col("key")
    # A key that looks like a path may spell another one.
    odd = F.coalesce(key.contains(".") | key.contains("[]"), F.lit(False))
    opened = inside.select(
        "d",
        (F.col("many") | odd).alias("many"),
        F.when(key.isNotNull(), F.concat_ws(".", F.nullif("path", F.lit("")), key)).otherwise(F.concat("path", F.lit("[]"))).alias("path"),
        _kind(F.col("value")).alias("found_type"),
        F.col("value").alias("v"),
        key.isNull().alias("element"),
        F.when(F.coalesce(pos, F.lit(0)) == 0, F.col("found")).otherwise(F.array().cast(LABELS)).alias("found"),
        (pos.isNotNull() & (key.isNotNull() | F.array_contains("firsts", pos.cast("bigint")))).alias("listed"),
    )
    label = F.struct(F.when(F.col("many"), F.col("d")).alias("d"), F.lit(depth).alias("depth"), "path", "found_type")
    return opened.select(
        "d", (F.col("many") | F.col("element")).alias("many"), "path", "found_type",
        F.when(F.col("found_type").isin("OBJECT", "ARRAY"), F.col("v")).alias("v"),
        F.when(F.col("listed"), F.concat("found", F.array(label))).otherwise(F.col("found")).alias("found"),
    )


def nested_drift(df: DataFrame, document: str, contract: Mapping[str, str]) -> DataFrame:
    """(path, found_type, rows, problem) for every path of a JSON text column, at any depth, against {path: type}.

    Paths are written ``a.b`` for fields and ``a[]`` for the elements of arrays; types carry the names of
    ``schema_of_variant``, with OBJECT and ARRAY for nested ones. ``rows`` counts documents, so an array whose elements
    are of two types gives two rows. Paths of the contract that no document has come with zero rows; problems are as in
    ``json_drift``. Nested values are opened LEVELS at a time in one pass over the documents, in which paths and types are
    counted at once; only those that a document can have several times are counted by document. Only values nested
    deeper than LEVELS are stored, for the next pass.
    """
    spark = df.sparkSession
    # Below an empty key paths start anew, so documents that may have one are counted by document.
    text = F.col(document)
    many = text.contains('""') & text.rlike(r'""\s*:')
    parsed = df.select(F.monotonically_increasing_id().alias("d"), many.alias("many"), F.try_parse_json(text).alias("v")).filter("v IS NOT NULL")
    nothing = F.array().cast(LABELS)
    level = parsed.select("d", "many", F.lit("").alias("path"), _kind(F.col("v")).alias("found_type"), "v", nothing.alias("found"))
    counted, before, depth = None, None, 0
    while True:
        for step in range(LEVELS):
            level = _one_level(level, depth + step + 1)
        depth += LEVELS
        # A label without a path says that something is still to be opened.
        rest = F.when(F.col("v").isNotNull(), F.array(F.struct(*[F.lit(None)] * 4)).cast(LABELS)).otherwise(nothing)
        labels = level.select(F.inline(F.concat("found", rest)))
        per_document = labels.groupBy("depth", "path", "found_type", "d").agg(F.count(F.lit(1)).alias("n"))
        total = F.sum(F.when(F.col("d").isNull(), F.col("n")).otherwise(1)).alias("rows")
        found = stored(per_document.groupBy("depth", "path", "found_type").agg(total), "drift-paths")
        rows = found.filter("path IS NOT NULL").select("path", "found_type", "rows")
        counted = rows if counted is None else counted.unionAll(rows)
        deeper = None
        if not found.filter("path IS NULL").isEmpty():
            deeper = stored(level.filter("v IS NOT NULL").withColumn("found", nothing), "drift-level")
        if before is not None:
            release(before)
        if deeper is None:
            break
        before = level = deeper
    wanted = spark.createDataFrame(list(contract.items()), "path string, wanted_type string")
    problem = (
        F.when(F.col("found_type").isNull(), "missing")
        .when(F.col("wanted_type").isNull(), "unexpected")
        .when(F.col("wanted_type") != F.col("found_type"), "retyped")
    )
    return counted.join(wanted, "path", "full_outer").select(
        "path", "found_type", F.coalesce("rows", F.lit(0)).cast("bigint").alias("rows"), problem.alias("problem")
    )


def null_rates(df: DataFrame, batch: str | Column, columns: Sequence[str]) -> DataFrame:
    """(batch, column, null_rate, change): share of NULLs per batch and its change from the batch before."""
    key = F.col(batch) if isinstance(batch, str) else batch
    rates = df.groupBy(key.alias("batch")).agg(
        *[F.avg(F.col(name).isNull().cast("int")).alias(name) for name in columns]
    )
    long = rates.unpivot("batch", list(columns), "column", "null_rate")
    before = F.lag("null_rate").over(Window.partitionBy("column").orderBy("batch"))
    return long.withColumn("change", F.col("null_rate") - before)


def count_anomalies(
    df: DataFrame, dataset: str, batch: str | Column, history: int = 7, factor: float = 3.0
) -> DataFrame:
    """Row count per batch against the mean and deviation of the ``history`` batches before it.

    The window works on counts, one row per dataset and batch. A batch without at least two predecessors is not
    judged (``anomalous`` is NULL).
    """
    key = F.col(batch) if isinstance(batch, str) else batch
    counts = df.groupBy(dataset, key.alias("batch")).agg(F.count(F.lit(1)).alias("rows"))
    past = Window.partitionBy(dataset).orderBy("batch").rowsBetween(-history, -1)
    judged = counts.select(
        dataset,
        "batch",
        "rows",
        F.avg("rows").over(past).alias("expected"),
        F.stddev_pop("rows").over(past).alias("deviation"),
        F.count("rows").over(past).alias("known"),
    )
    far = F.abs(F.col("rows") - F.col("expected")) > factor * F.col("deviation")
    return judged.withColumn("anomalous", F.when(F.col("known") >= 2, far)).drop("known")


def duplicate_rates(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """One row: total rows and keys, rows beyond one per key, and keys with competing values (corrections)."""
    per_key = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("copies"), F.min(value).alias("low"), F.max(value).alias("high")
    )
    totals = per_key.agg(
        F.sum("copies").alias("rows"),
        F.count(F.lit(1)).alias("keys"),
        F.count_if(F.col("low") != F.col("high")).alias("corrected_keys"),
    )
    return totals.select(
        F.coalesce("rows", F.lit(0)).alias("rows"),
        "keys",
        (F.coalesce("rows", F.lit(0)) - F.col("keys")).alias("duplicate_rows"),
        "corrected_keys",
    )


def freshness(df: DataFrame, dataset: str, time: str, as_of: Column) -> DataFrame:
    """Newest time per dataset and its age in seconds at ``as_of``."""
    newest = df.groupBy(dataset).agg(F.max(time).alias("newest"))
    return newest.withColumn("age_seconds", F.timestamp_diff("SECOND", F.col("newest"), as_of))
