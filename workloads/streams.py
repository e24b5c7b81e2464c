"""Queries that land files or read streams, run them to their end, and return what was stored.

Files, checkpoints and tables go below the shared folder of the session.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tierloom.functions.columns import extraction_time, trim_headers
from tierloom.operators.checks import require
from tierloom.operators.dedup import distinct_rows, first_arrival
from tierloom.operators.expectations import enforce, stream_report
from tierloom.operators.states import LG_K, batch_anomalies, batch_states, dataset_summary, united
from tierloom.operators.versions import latest_version, upsert_partitions, validity
from tierloom.plans import gold, sql
from tierloom.plans.incremental import TOTAL_KEYS, best_year_of_totals, refresh_totals
from tierloom.plans.silver import MEASURES, OBSERVATIONS, POPULATION, SECTORS, SERIES, Spec, project, refine, refine_latest
from tierloom.sources.evolution import RESCUE, SchemaLog
from tierloom.sources.evolving import append_json, append_tsv, lines, read_typed, tsv_into
from tierloom.sources.files import LINEAGE, infer_types, json_stream, tsv_batch, tsv_stream, with_lineage
from tierloom.sources.landing import TSV, land_snapshot
from tierloom.sources.tables import folder_stream, table_stream
from tierloom.streaming.flows import GLOBS, Layout, run_all
from tierloom.streaming.keyed import (
    AddedTable, AppendedTable, MergedTable, first_arrival_stream, follow, newest, start_batches, upsert_stream, without_removed,
)
from tierloom.streaming.refresh import Store, refresh
from tierloom.streaming.runs import append_all, finish, publish, start_append
from tierloom.workspace import fresh_folder, release, stored
from workloads import inputs
from workloads.batch import BEST_SQL, NATION, PAIRED_SQL, RULES, best_year_inputs
from workloads.batch import SERIES as SERIES_ID
from workloads.registry import POPULATION as POPULATION_SQL
from workloads.registry import query

FIRST = datetime(2026, 8, 14, 12, 0, 0)
SECOND = datetime(2026, 8, 15, 12, 0, 0)
# Hash buckets of keyed tables.
BUCKETS = 8


def stored_stream(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A given table as a stream of files, with lineage.

    The path is a pattern, because a stream takes a pattern for one file as well as for a folder of part files.
    """
    schema = spark.read.parquet(f"{folder}/{name}.parquet").schema
    return with_lineage(spark.readStream.schema(schema).parquet(f"{folder}/{name}.parque[t]"))


def new_schema(spark: SparkSession, work: str) -> str:
    """A catalog schema of its own whose tables lie below ``work``."""
    schema = f"tierloom_{work.rsplit('-', 1)[1]}"
    spark.sql(f"CREATE SCHEMA {schema} LOCATION '{work}/tables'")
    return schema


def run(df: DataFrame, work: str, step: str) -> DataFrame:
    """Run a stream to its end and return the rows of its folder. State has the session's number of partitions."""
    append_all(df, f"{work}/checkpoint-{step}", path=f"{work}/{step}")
    return df.sparkSession.read.parquet(f"{work}/{step}")


def run_silver(clean: Callable[[DataFrame], DataFrame], spark: SparkSession, work: str) -> DataFrame:
    """Clean the bronze folder of ``work`` as a stream."""
    bronze = f"{work}/bronze"
    return run(clean(folder_stream(spark, bronze)), work, "silver")


def padded(df: DataFrame) -> DataFrame:
    """All columns as text with trailing padding, names too."""
    return df.select(
        *[F.concat(F.col(name).cast("string"), F.lit(inputs.PAD)).alias(f"{name}{inputs.PAD}") for name in df.columns]
    )


def land_tsv(df: DataFrame, raw: str, name: str, at: datetime = FIRST, extension: str = "csv") -> str:
    return land_snapshot(padded(df), raw, name, at, file_format="csv", extension=extension, **TSV)


# Sources


@query("SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders")
def scan_tsv_stream(spark: SparkSession, folder: str) -> DataFrame:
    work = fresh_folder(spark, "scan-tsv")
    orders = inputs.table(spark, folder, "orders")
    land_tsv(orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice"), work, "orders")
    bronze = run(trim_headers(tsv_stream(spark, f"{work}/orders*")), work, "bronze")
    return bronze.selectExpr(
        "try_cast(o_orderkey AS bigint) AS o_orderkey",
        "try_cast(o_custkey AS bigint) AS o_custkey",
        "trim(o_orderstatus) AS o_orderstatus",
        "try_cast(o_totalprice AS double) AS o_totalprice",
    )


@query("SELECT doc_id, lang, CAST(len(string_split(text, chr(10))) AS INTEGER) AS n_records FROM documents")
def scan_json_stream(spark: SparkSession, folder: str) -> DataFrame:
    work = fresh_folder(spark, "scan-json")
    snapshots = inputs.document_snapshots(spark, folder)
    land_snapshot(snapshots, work, "documents", FIRST)
    bronze = run(json_stream(spark, f"{work}/documents*", snapshots.schema), work, "bronze")
    return bronze.select("doc_id", "lang", F.size("data").alias("n_records"))


@query("SELECT c_custkey, c_name FROM customer")
def glob_select(spark: SparkSession, folder: str) -> DataFrame:
    """Two datasets in one folder, told apart by file name."""
    work = fresh_folder(spark, "glob")
    customers = inputs.table(spark, folder, "customer").select("c_custkey", "c_name")
    suppliers = inputs.table(spark, folder, "supplier").select("s_suppkey", "s_name")
    for df, extension in ((customers, "cus"), (suppliers, "sup")):
        padded(df).write.mode("append").options(**TSV, extension=extension).csv(f"{work}/raw")
    bronze = run(trim_headers(tsv_stream(spark, f"{work}/raw", glob="*.cus")), work, "bronze")
    return bronze.selectExpr("try_cast(c_custkey AS bigint) AS c_custkey", "trim(c_name) AS c_name")


@query(
    """SELECT 'parquet' AS extension, true AS in_folder, true AS sized, count(*) AS "rows" FROM lineitem"""
)
def file_lineage(spark: SparkSession, folder: str) -> DataFrame:
    work = fresh_folder(spark, "lineage")
    lines = stored_stream(spark, folder, "lineitem").select("l_orderkey", LINEAGE)
    return (
        run(lines, work, "bronze")
        .groupBy(
            F.substring_index(f"{LINEAGE}.file_name", ".", -1).alias("extension"),
            F.col(f"{LINEAGE}.file_path").contains("/lineitem.parquet").alias("in_folder"),
            (F.col(f"{LINEAGE}.file_size") > 0).alias("sized"),
        )
        .agg(F.count(F.lit(1)).alias("rows"))
    )


@query(
    """SELECT CAST(p_partkey AS INTEGER) AS part_key, p_name AS part_name, p_retailprice AS price,
              lpad(CAST(p_size AS VARCHAR), 3, '0') AS size_code
       FROM part"""
)
def type_inference(spark: SparkSession, folder: str) -> DataFrame:
    """Types come from the landed text; the code column stays text and keeps its zeros."""
    work = fresh_folder(spark, "types")
    parts = inputs.table(spark, folder, "part").select(
        F.col("p_partkey").alias("part_key"),
        F.col("p_name").alias("part_name"),
        F.col("p_retailprice").alias("price"),
        F.lpad(inputs.text("p_size"), 3, "0").alias("size_code"),
    )
    parts.write.options(**TSV).csv(f"{work}/raw")
    schema = infer_types(spark, f"{work}/raw", keep_text=("size_code",))
    return tsv_batch(spark, f"{work}/raw", schema).drop(LINEAGE)


@query(
    """SELECT event_id, event_type, CASE WHEN ts >= TIMESTAMP '2024-01-16' THEN value END AS value,
              CASE WHEN ts >= TIMESTAMP '2024-01-16' THEN CAST(json_extract_string(props, '$.k') AS BIGINT) END AS k
       FROM events"""
)
def schema_evolution(spark: SparkSession, folder: str) -> DataFrame:
    """The second snapshot brings a new column and a new field inside a struct; one checkpoint serves both runs."""
    work = fresh_folder(spark, "evolution")
    second_half = F.col("ts") >= F.lit("2024-01-16").cast("timestamp_ntz")
    events = inputs.table(spark, folder, "events").withColumn("late", second_half)
    kind = F.col("event_type").alias("event_type")
    field = F.get_json_object("props", "$.k").cast("bigint").alias("k")
    early = events.filter(~F.col("late")).select("event_id", F.struct(kind).alias("data"))
    late = events.filter("late").select("event_id", F.struct(kind, field).alias("data"), "value")
    log = SchemaLog(spark, f"{work}/schema")
    for snapshot, at in ((early, FIRST), (late, SECOND)):
        land_snapshot(snapshot, f"{work}/raw", "events", at)
        schema = log.refresh(f"{work}/raw/events*")
        stream = json_stream(spark, f"{work}/raw/events*", schema, rescue=RESCUE)
        append_all(stream, f"{work}/checkpoint", path=f"{work}/bronze")
        log.keep_late(f"{work}/raw/events*", schema, f"{work}/late")
    bronze = spark.read.option("mergeSchema", True).parquet(f"{work}/bronze")
    return bronze.select("event_id", "data.event_type", "value", "data.k")


@query(
    """SELECT o_orderkey, o_totalprice,
              CASE WHEN year(o_orderdate) < 1998 THEN '2026-08-14 12:00:00'
                   ELSE '2026-08-15 12:00:00' END AS extracted_at
       FROM orders"""
)
def snapshot_append(spark: SparkSession, folder: str) -> DataFrame:
    """Two extractions side by side, told apart by the stamp in their name."""
    work = fresh_folder(spark, "landing")
    orders = inputs.table(spark, folder, "orders")
    early = F.year("o_orderdate") < 1998
    for part, at in ((early, FIRST), (~early, SECOND)):
        snapshot = orders.filter(part).select("o_orderkey", "o_totalprice")
        land_snapshot(snapshot, work, "orders", at, file_format="parquet")
    landed = spark.read.parquet(f"{work}/orders.*")
    return landed.select(
        "o_orderkey",
        "o_totalprice",
        F.date_format(extraction_time(F.col("_metadata.file_path")), "yyyy-MM-dd HH:mm:ss").alias("extracted_at"),
    )


# Incremental tables


@query("SELECT o_orderkey, o_totalprice, CAST(1 AS BIGINT) AS copies FROM orders")
def incremental_refresh(spark: SparkSession, folder: str) -> DataFrame:
    """Bronze and silver run after each of two landings and once more with nothing new; no row is read twice."""
    work = fresh_folder(spark, "incremental")
    schema = new_schema(spark, work)
    orders = inputs.table(spark, folder, "orders").select("o_orderkey", "o_totalprice", "o_orderdate")
    early = F.year("o_orderdate") < 1998
    for part, at in ((early, FIRST), (~early, SECOND), (None, None)):
        if at:
            land_tsv(orders.filter(part).select("o_orderkey", "o_totalprice"), f"{work}/raw", "orders", at)
        landed = trim_headers(tsv_stream(spark, f"{work}/raw/orders*"))
        append_all(landed, f"{work}/checkpoint-bronze", table=f"{schema}.bronze")
        typed = table_stream(spark, f"{schema}.bronze").selectExpr(
            "try_cast(o_orderkey AS bigint) AS o_orderkey", "try_cast(o_totalprice AS double) AS o_totalprice"
        )
        append_all(typed, f"{work}/checkpoint-silver", table=f"{schema}.silver")
    return spark.table(f"{schema}.silver").groupBy("o_orderkey", "o_totalprice").agg(F.count("*").alias("copies"))


@query("SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem")
def stream_dedup_key(spark: SparkSession, folder: str) -> DataFrame:
    work = fresh_folder(spark, "dedup")
    lines = stored_stream(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    kept = run(first_arrival(lines, ["l_orderkey", "l_linenumber"]), work, "kept")
    return kept.select("l_orderkey", "l_linenumber")


@query("SELECT DISTINCT l_orderkey, l_linenumber, l_returnflag, l_linestatus FROM lineitem")
def stream_distinct(spark: SparkSession, folder: str) -> DataFrame:
    work = fresh_folder(spark, "distinct")
    columns = ["l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus"]
    lines = distinct_rows(stored_stream(spark, folder, "lineitem"), columns)
    return run(lines, work, "kept")


@query(
    """SELECT 'taxed' AS name, count(*) FILTER (nullif(l_tax, 0) > 0.02) AS passed,
              count(*) - count(*) FILTER (nullif(l_tax, 0) > 0.02) AS failed FROM lineitem
       UNION ALL
       SELECT 'not_returned', count(*) FILTER (l_returnflag <> 'R'),
              count(*) - count(*) FILTER (l_returnflag <> 'R') FROM lineitem
       UNION ALL
       SELECT 'shipped', count(l_shipdate), count(*) - count(l_shipdate) FROM lineitem"""
)
def expect_metrics_stream(spark: SparkSession, folder: str) -> DataFrame:
    """Counts observed while the stream drops its rows, without a second pass."""
    work = fresh_folder(spark, "metrics")
    kept = enforce(stored_stream(spark, folder, "lineitem").drop(LINEAGE), RULES, observe_as="rules")
    counts = f"{work}/counts"
    done = append_all(kept, f"{work}/checkpoint", counts, path=f"{work}/kept")
    return stream_report(spark, done, "rules", RULES, counts)


@query(
    """SELECT doc_id, unnest(range(1, len(lines) + 1)) AS line_no, unnest(lines) AS line
       FROM (SELECT doc_id, string_split(text, chr(10)) AS lines FROM documents)"""
)
def explode_records(spark: SparkSession, folder: str) -> DataFrame:
    """Nested snapshots become one row per record while they stream in."""
    work = fresh_folder(spark, "explode")
    snapshots = inputs.document_snapshots(spark, folder)
    land_snapshot(snapshots, work, "documents", FIRST)
    stream = json_stream(spark, f"{work}/documents*", snapshots.schema)
    records = stream.select("doc_id", F.explode("data").alias("record"))
    return run(
        records.select(
            "doc_id", F.col("record.`Line No`").cast("bigint").alias("line_no"), F.col("record.Line").alias("line")
        ),
        work,
        "records",
    )


@query("SELECT o_orderkey, o_totalprice * 2 AS doubled FROM orders")
def sql_table_stream(spark: SparkSession, folder: str) -> DataFrame:
    """A stored table read as a SQL stream and appended to another one."""
    work = fresh_folder(spark, "sql-stream")
    schema = new_schema(spark, work)
    orders = inputs.table(spark, folder, "orders").select("o_orderkey", "o_totalprice")
    orders.write.saveAsTable(f"{schema}.bronze")
    rows = sql.appended(spark, f"{schema}.bronze").selectExpr("o_orderkey", "o_totalprice * 2 AS doubled")
    append_all(rows, f"{work}/checkpoint", table=f"{schema}.silver")
    return spark.table(f"{schema}.silver")


# Bronze and silver tables


@query(
    """SELECT CAST(l_orderkey AS VARCHAR) || '-' || l_linenumber || '      ' AS series_id,
              ' ' || year(l_shipdate) AS year, 'Q0' || quarter(l_shipdate) || ' ' AS period,
              CASE WHEN l_returnflag = 'R' THEN '-' ELSE '      ' || CAST(l_quantity AS VARCHAR) END AS value,
              l_linestatus AS footnote_codes
       FROM lineitem"""
)
def bronze_observations(spark: SparkSession, folder: str) -> DataFrame:
    """Observations as they arrived: text with its padding, repeats included."""
    work = fresh_folder(spark, "bronze")
    land_snapshot(inputs.raw_observations(spark, folder), work, "data", FIRST, file_format="csv", **TSV)
    return run(trim_headers(tsv_stream(spark, f"{work}/data*")), work, "bronze").drop(LINEAGE)


@query(
    f"""WITH {POPULATION_SQL}
        SELECT '{{}}' AS annotations, nation, count(*) AS records, sum(population)::DOUBLE AS total
        FROM population GROUP BY nation"""
)
def bronze_population(spark: SparkSession, folder: str) -> DataFrame:
    """One row per response, its records still nested under their provider names."""
    work = fresh_folder(spark, "responses")
    schema = land_population(spark, folder, work, (FIRST,))
    bronze = run(json_stream(spark, f"{work}/raw/population*", schema), work, "bronze")
    return bronze.select(
        "annotations",
        F.col("data")[0]["Nation"].alias("nation"),
        F.size("data").cast("bigint").alias("records"),
        F.aggregate("data", F.lit(0.0), lambda total, r: total + r["Population"]).alias("total"),
    )



@query(
    """SELECT DISTINCT CAST(l_orderkey AS VARCHAR) || '-' || l_linenumber AS series_id,
              CAST(year(l_shipdate) AS INTEGER) AS year, 'Q0' || quarter(l_shipdate) AS period
       FROM lineitem WHERE l_returnflag <> 'R'"""
)
def silver_observations(spark: SparkSession, folder: str) -> DataFrame:
    """Landed text to typed rows; only the key is returned, other columns depend on which copy came first."""
    work = fresh_folder(spark, "observations")
    land_snapshot(inputs.raw_observations(spark, folder), work, "data", FIRST, file_format="csv", **TSV)
    run(trim_headers(tsv_stream(spark, f"{work}/data*")), work, "bronze")
    silver = run_silver(lambda bronze: refine(bronze, OBSERVATIONS), spark, work)
    return silver.select("series_id", "year", "period")


FIRST_ARRIVAL_SQL = """SELECT CAST(o_orderkey AS VARCHAR) AS series_id, CAST(year(o_orderdate) AS INTEGER) AS year,
       'Q0' || quarter(o_orderdate) AS period,
       CASE WHEN year(o_orderdate) < 1998 THEN o_totalprice ELSE o_totalprice + 1 END AS value,
       CASE WHEN year(o_orderdate) < 1998 THEN 'first' ELSE 'second' END AS footnote_codes
    FROM orders"""


@query(FIRST_ARRIVAL_SQL)
def silver_first_arrival(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as observations, one row per key in each landing. The second landing brings all of them with corrected
    values, of which only the keys that the first one lacked are taken; all columns are returned."""
    work = fresh_folder(spark, "first-arrival")
    orders = inputs.table(spark, folder, "orders")
    text = [
        F.concat(inputs.text("o_orderkey"), F.lit(inputs.PAD)).alias("series_id"),
        inputs.text(F.year("o_orderdate")).alias("year"),
        F.concat(F.lit("Q0"), inputs.text(F.quarter("o_orderdate"))).alias("period"),
    ]
    first = orders.filter(F.year("o_orderdate") < 1998).select(
        *text, inputs.text("o_totalprice").alias("value"), F.lit("first").alias("footnote_codes")
    )
    second = orders.select(
        *text, inputs.text(F.col("o_totalprice") + 1).alias("value"), F.lit("second").alias("footnote_codes")
    )
    for snapshot, at in ((first, FIRST), (second, SECOND)):
        land_snapshot(snapshot, work, "data", at, file_format="csv", **TSV)
        run(trim_headers(tsv_stream(spark, f"{work}/data*")), work, "bronze")
        silver = run_silver(lambda bronze: refine(bronze, OBSERVATIONS), spark, work)
    return silver.drop(LINEAGE)


@query(
    """SELECT DISTINCT CAST(l_orderkey AS VARCHAR) || '-' || l_linenumber AS series_id,
              CAST(year(l_shipdate) AS INTEGER) AS year, 'Q0' || quarter(l_shipdate) AS period,
              l_quantity AS value, l_linestatus AS footnote_codes
       FROM lineitem WHERE l_returnflag <> 'R'"""
)
def silver_observations_sql(spark: SparkSession, folder: str) -> DataFrame:
    """The SQL form keeps every distinct row, so a corrected value stays beside the first."""
    work = fresh_folder(spark, "observations-sql")
    land_snapshot(inputs.raw_observations(spark, folder), work, "data", FIRST, file_format="csv", **TSV)
    run(sql.bronze(spark, trim_headers(tsv_stream(spark, f"{work}/data*"))), work, "bronze")
    return run_silver(lambda bronze: sql.silver(spark, bronze, OBSERVATIONS), spark, work)


LOOKUPS = """SELECT 'series' AS lookup, CAST(s_suppkey AS VARCHAR) AS code,
              lpad(CAST(s_nationkey AS VARCHAR), 2, '0') AS meaning
       FROM supplier
       UNION ALL SELECT 'measure', lpad(CAST(n_nationkey AS VARCHAR), 2, '0'), n_name FROM nation
       UNION ALL SELECT 'sector', lpad(CAST(r_regionkey AS VARCHAR), 2, '0'), r_name FROM region"""


def clean_lookups(
    spark: SparkSession, folder: str, work: str, clean: Callable[[DataFrame, Spec], DataFrame]
) -> DataFrame:
    """Three lookup tables, landed twice and cleaned at the same time."""
    sources = {
        "series": (SERIES, inputs.series(spark, folder), ("series_id", "measure_code")),
        "measure": (MEASURES, inputs.measures(spark, folder), ("measure_code", "measure_text")),
        "sector": (SECTORS, inputs.sectors(spark, folder), ("sector_code", "sector_name")),
    }
    started = []
    for name, (spec, df, _) in sources.items():
        for at in (FIRST, SECOND):
            land_tsv(df, f"{work}/raw", name, at)
        rows = clean(trim_headers(tsv_stream(spark, f"{work}/raw/{name}.*")), spec)
        started.append(start_append(rows, f"{work}/checkpoint-{name}", path=f"{work}/{name}"))
    finish(started)
    parts = [
        spark.read.parquet(f"{work}/{name}").select(
            F.lit(name).alias("lookup"), F.col(code).alias("code"), F.col(meaning).alias("meaning")
        )
        for name, (_, _, (code, meaning)) in sources.items()
    ]
    return parts[0].unionAll(parts[1]).unionAll(parts[2])


BRONZE_LOOKUPS = """SELECT 'series' AS lookup, CAST(s_suppkey AS VARCHAR) || '      ' AS code,
              lpad(CAST(s_nationkey AS VARCHAR), 2, '0') || '      ' AS meaning FROM supplier
       UNION ALL SELECT 'measure', lpad(CAST(n_nationkey AS VARCHAR), 2, '0') || '      ', n_name || '      ' FROM nation
       UNION ALL SELECT 'sector', lpad(CAST(r_regionkey AS VARCHAR), 2, '0') || '      ', r_name || '      ' FROM region"""


def store_lookups(spark: SparkSession, folder: str, work: str, land: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The three lookups landed under their own names and stored as bronze tables: text with its padding."""
    schema = new_schema(spark, work)
    sources = {
        "series": ("bronze_bls_series", inputs.series(spark, folder), ("series_id", "measure_code")),
        "measure": ("bronze_bls_measure", inputs.measures(spark, folder), ("measure_code", "measure_text")),
        "sector": ("bronze_bls_sector", inputs.sectors(spark, folder), ("sector_code", "sector_name")),
    }
    started = []
    for name, (table, df, _) in sources.items():
        land_tsv(df, f"{work}/raw", f"pr.{name}")
        landed = trim_headers(tsv_stream(spark, f"{work}/raw/{GLOBS[table]}"))
        started.append(start_append(land(landed), f"{work}/checkpoint-{name}", table=f"{schema}.{table}"))
    finish(started)
    parts = [
        spark.table(f"{schema}.{table}").select(
            F.lit(name).alias("lookup"), F.col(code).alias("code"), F.col(meaning).alias("meaning")
        )
        for name, (table, _, (code, meaning)) in sources.items()
    ]
    return parts[0].unionAll(parts[1]).unionAll(parts[2])


@query(BRONZE_LOOKUPS)
def bronze_lookups(spark: SparkSession, folder: str) -> DataFrame:
    return store_lookups(spark, folder, fresh_folder(spark, "bronze-lookups"), lambda landed: landed)


@query(BRONZE_LOOKUPS)
def bronze_lookups_sql(spark: SparkSession, folder: str) -> DataFrame:
    work = fresh_folder(spark, "bronze-lookups-sql")
    return store_lookups(spark, folder, work, lambda landed: sql.bronze(spark, landed))


@query(LOOKUPS)
def silver_lookups(spark: SparkSession, folder: str) -> DataFrame:
    return clean_lookups(spark, folder, fresh_folder(spark, "lookups"), refine)


@query(LOOKUPS)
def silver_lookups_sql(spark: SparkSession, folder: str) -> DataFrame:
    work = fresh_folder(spark, "lookups-sql")
    return clean_lookups(spark, folder, work, lambda bronze, spec: sql.silver(spark, bronze, spec))


def land_population(
    spark: SparkSession, folder: str, work: str, times: tuple[datetime, ...] = (FIRST, SECOND)
) -> StructType:
    """The same snapshots under each of the given stamps."""
    snapshots = inputs.population_snapshots(spark, folder)
    for at in times:
        land_snapshot(snapshots, f"{work}/raw", "population", at)
    return snapshots.schema


POPULATION_ROWS = f"WITH {POPULATION_SQL} SELECT nation_id, nation, year, population FROM population"


@query(POPULATION_ROWS)
def silver_population(spark: SparkSession, folder: str) -> DataFrame:
    work = fresh_folder(spark, "population")
    schema = land_population(spark, folder, work)
    run(json_stream(spark, f"{work}/raw/population*", schema), work, "bronze")
    return run_silver(lambda bronze: refine(bronze, POPULATION), spark, work).drop(LINEAGE)


@query(POPULATION_ROWS)
def silver_population_sql(spark: SparkSession, folder: str) -> DataFrame:
    work = fresh_folder(spark, "population-sql")
    schema = land_population(spark, folder, work)
    run(sql.bronze(spark, json_stream(spark, f"{work}/raw/population*", schema)), work, "bronze")
    return run_silver(lambda bronze: sql.silver(spark, bronze, POPULATION), spark, work)


@query(
    f"WITH {POPULATION_SQL} SELECT nation_id, nation, year, population + 1000 AS population FROM population"
)
def silver_population_latest(spark: SparkSession, folder: str) -> DataFrame:
    """The second extraction corrects every value; the newest version of each key is taken from the whole history."""
    work = fresh_folder(spark, "population-latest")
    snapshots = inputs.population_snapshots(spark, folder)
    corrected = F.transform("data", lambda r: r.withField("Population", r["Population"] + 1000))
    land_snapshot(snapshots, f"{work}/raw", "population", FIRST)
    land_snapshot(snapshots.withColumn("data", corrected), f"{work}/raw", "population", SECOND)
    bronze = run(json_stream(spark, f"{work}/raw/population*", snapshots.schema), work, "bronze")
    return refine_latest(bronze, POPULATION).drop(LINEAGE)


# Tables kept up to date by key, without a state store


@query(
    """WITH changes AS (
         SELECT o_custkey, CAST(year(o_orderdate) AS INTEGER) AS year, o_orderkey, o_totalprice, o_orderstatus FROM orders)
       SELECT o_custkey, year, o_orderkey, o_totalprice FROM (
         SELECT * FROM changes
         QUALIFY row_number() OVER (PARTITION BY o_custkey, year ORDER BY o_orderkey DESC) = 1)
       WHERE o_orderstatus <> 'P'"""
)
def stream_upsert(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as corrections of one row per customer and year, the order number as sequence. Three landings bring them
    out of order, the first one lands once more, and the last batch is run again; a pending order removes its key."""
    work = fresh_folder(spark, "stream-upsert")
    changes = inputs.table(spark, folder, "orders").select(
        "o_custkey", F.year("o_orderdate").alias("year"), "o_orderkey", "o_totalprice",
        (F.col("o_orderstatus") == "P").alias("removed"),
    )
    target = MergedTable(spark, f"{work}/target", ["o_custkey", "year"], BUCKETS)
    for third in (2, 0, 1, 2):
        landed = changes.filter(F.pmod(F.xxhash64("o_orderkey"), F.lit(3)) == third)
        landed.write.mode("append").parquet(f"{work}/landed")
        stream = spark.readStream.schema(changes.schema).parquet(f"{work}/landed")
        finish([upsert_stream(stream, f"{work}/checkpoint", target, "o_orderkey")])
    last = target.last()
    target.merge(landed, last.source, last.batch, newest(target.keys, "o_orderkey"))
    return without_removed(target.read(), "removed")


def land_orders(spark: SparkSession, folder: str, work: str) -> Iterator[DataFrame]:
    """Orders as observations in two landings, the second with corrected values of all keys; bronze after each."""
    orders = inputs.table(spark, folder, "orders")
    text = [
        F.concat(inputs.text("o_orderkey"), F.lit(inputs.PAD)).alias("series_id"),
        inputs.text(F.year("o_orderdate")).alias("year"),
        F.concat(F.lit("Q0"), inputs.text(F.quarter("o_orderdate"))).alias("period"),
    ]
    first = orders.filter(F.year("o_orderdate") < 1998).select(
        *text, inputs.text("o_totalprice").alias("value"), F.lit("first").alias("footnote_codes")
    )
    second = orders.select(
        *text, inputs.text(F.col("o_totalprice") + 1).alias("value"), F.lit("second").alias("footnote_codes")
    )
    for snapshot, at in ((first, FIRST), (second, SECOND)):
        land_snapshot(snapshot, work, "data", at, file_format="csv", **TSV)
        yield run(trim_headers(tsv_stream(spark, f"{work}/data*")), work, "bronze")


@query(FIRST_ARRIVAL_SQL)
def dedup_against_table(spark: SparkSession, folder: str) -> DataFrame:
    """``silver_first_arrival`` without a state store: the silver table itself says which keys have been seen."""
    work = fresh_folder(spark, "dedup-table")
    for _ in land_orders(spark, folder, work):
        silver = AddedTable(spark, f"{work}/silver", OBSERVATIONS.key, BUCKETS)
        rows = project(folder_stream(spark, f"{work}/bronze"), OBSERVATIONS)
        finish([first_arrival_stream(rows, f"{work}/checkpoint-silver", silver, OBSERVATIONS.expectations)])
    return silver.read().drop(LINEAGE)


@query(
    """SELECT 'taxed' AS name, count(*) FILTER (nullif(l_tax, 0) > 0.02) AS passed,
              count(*) - count(*) FILTER (nullif(l_tax, 0) > 0.02) AS failed FROM lineitem
       UNION ALL
       SELECT 'not_returned', count(*) FILTER (l_returnflag <> 'R'),
              count(*) - count(*) FILTER (l_returnflag <> 'R') FROM lineitem
       UNION ALL
       SELECT 'shipped', count(l_shipdate), count(*) - count(l_shipdate) FROM lineitem"""
)
def expect_metrics_commit(spark: SparkSession, folder: str) -> DataFrame:
    """Counts that are committed together with the rows they belong to."""
    work = fresh_folder(spark, "metrics-commit")
    kept = AddedTable(spark, f"{work}/kept", ["l_orderkey", "l_linenumber"], BUCKETS)
    finish([first_arrival_stream(stored_stream(spark, folder, "lineitem").drop(LINEAGE), f"{work}/checkpoint", kept, RULES)])
    return kept.report(RULES)


@query(BEST_SQL)
def incremental_best_year(spark: SparkSession, folder: str) -> DataFrame:
    """Observations land in three parts by period; after each the kept totals gain what silver gained."""
    work = fresh_folder(spark, "incremental-gold")
    observed = stored(inputs.observations(spark, folder).withColumn("footnote_codes", F.lit("R")), "observations")
    silver = AddedTable(spark, f"{work}/silver", OBSERVATIONS.key, BUCKETS)
    totals = MergedTable(spark, f"{work}/totals", TOTAL_KEYS, BUCKETS)
    for batch, periods in enumerate((("Q02", "Q05"), ("Q01", "Q04"), ("Q03",))):
        silver.insert_new(observed.filter(F.col("period").isin(*periods)), "landed", batch, OBSERVATIONS.expectations)
        refresh_totals(silver, totals, scale=2)
    release(observed)
    lookups = [source(spark, folder) for source in (inputs.series, inputs.measures, inputs.sectors)]
    return best_year_of_totals(totals.read(), *lookups, scale=2)


# Columns and types that change from file to file


@query(
    """WITH steps AS (
         SELECT o_orderkey, o_custkey, o_totalprice, CASE WHEN year(o_orderdate) < 1995 THEN 1 WHEN year(o_orderdate) < 1997 THEN 2 ELSE 3 END AS landed
         FROM orders)
       SELECT step, kind, o_orderkey, lpad(CAST(o_custkey AS VARCHAR), 12, '0') AS code,
              CASE landed WHEN 1 THEN CAST(floor(o_totalprice) AS DOUBLE) WHEN 2 THEN o_totalprice END AS number,
              CASE WHEN landed = 3 THEN 'x' || o_orderkey END AS word
       FROM steps JOIN (VALUES (1, 'int'), (2, 'double'), (3, 'string')) t(step, kind) ON landed <= step"""
)
def typed_ingestion(spark: SparkSession, folder: str) -> DataFrame:
    """Whole numbers, then numbers with decimals, then words land in the same column, in one checkpoint. After each
    landing all rows are read in the type that they need together; the codes stay text with their zeros."""
    work = fresh_folder(spark, "typed")
    orders = inputs.table(spark, folder, "orders")
    price, year = F.col("o_totalprice"), F.year("o_orderdate")
    parts = [
        (year < 1995, inputs.text(F.floor(price))),
        (year.between(1995, 1996), inputs.text(price.cast("decimal(18,2)"))),
        (year >= 1997, F.concat(F.lit("x"), inputs.text("o_orderkey"))),
    ]
    bronze = AppendedTable(spark, f"{work}/bronze")
    seen = []
    for step, (chosen, value) in enumerate(parts, 1):
        code = F.lpad(inputs.text("o_custkey"), 12, "0").alias("code")
        landed = orders.filter(chosen).select(inputs.text("o_orderkey").alias("o_orderkey"), code, value.alias("value"))
        land_snapshot(landed, f"{work}/raw", "orders", FIRST + timedelta(days=step), file_format="csv", **TSV)
        finish([tsv_into(lines(spark, f"{work}/raw/orders*"), f"{work}/checkpoint", bronze, keep_text=("code",))])
        rows = read_typed(bronze)
        seen.append(
            rows.select(
                F.lit(step).alias("step"), F.lit(dict(rows.dtypes)["value"]).alias("kind"), F.col("o_orderkey").cast("bigint"), "code",
                F.col("value").try_cast("double").alias("number"),
                F.when(F.col("value").try_cast("double").isNull(), F.col("value").cast("string")).alias("word"),
            )
        )
    return seen[0].unionAll(seen[1]).unionAll(seen[2])


def gained_orders(bronze: AppendedTable, silver: AddedTable, columns: dict[str, str]) -> None:
    """Typed rows of what bronze gained, into silver. Columns that no file has brought yet are NULL."""

    def add(gained: DataFrame, source: str, version: int) -> bool:
        present = [F.col(f"`{name}`") if name in gained.columns else F.lit(None).alias(name) for name in columns]
        rows = gained.select(*present).select(*[F.trim(F.col(n).cast("string")).try_cast(t).alias(n) for n, t in columns.items()])
        return silver.insert_new(rows, source, version)

    follow(bronze, silver, add)


@query(
    """SELECT o_orderkey, o_totalprice, CASE WHEN o_orderkey % 3 > 0 THEN o_orderpriority END AS o_orderpriority,
              CASE WHEN o_orderkey % 3 = 2 THEN o_custkey END AS o_custkey, CAST(1 AS BIGINT) AS copies FROM orders"""
)
def tsv_evolution(spark: SparkSession, folder: str) -> DataFrame:
    """The second landing has another column, the third, which lands while the first run is still busy, one more in front.
    All are read from silver, each row once."""
    work = fresh_folder(spark, "tsv-evolution")
    orders = inputs.table(spark, folder, "orders")
    columns = {"o_orderkey": "bigint", "o_totalprice": "double", "o_orderpriority": "string", "o_custkey": "bigint"}

    def land(third: int) -> None:
        names = [["o_orderkey", "o_totalprice"], ["o_orderkey", "o_totalprice", "o_orderpriority"], ["o_custkey", "o_orderpriority", "o_totalprice", "o_orderkey"]]
        part = orders.filter(F.col("o_orderkey") % 3 == third).select(*names[third])
        land_tsv(part, f"{work}/raw", "orders", FIRST + timedelta(days=third))

    bronze = AppendedTable(spark, f"{work}/bronze")
    silver = AddedTable(spark, f"{work}/silver", ["o_orderkey"], BUCKETS)

    def busy(batch: DataFrame, source: str, number: int) -> None:
        if number == 0:
            land(2)
        append_tsv(batch, source, number, bronze)

    land(0)
    for third in (None, 1, None):
        if third is not None:
            land(third)
        finish([start_batches(lines(spark, f"{work}/raw/orders*"), f"{work}/checkpoint", busy)])
        gained_orders(bronze, silver, columns)
    return silver.read().groupBy(*columns).agg(F.count(F.lit(1)).alias("copies"))


@query(
    """SELECT event_id, event_type, CASE WHEN event_id % 2 = 1 THEN value END AS value,
              CASE WHEN event_id % 2 = 1 THEN CAST(json_extract_string(props, '$.k') AS BIGINT) END AS k, CAST(1 AS BIGINT) AS copies
       FROM events"""
)
def json_evolution(spark: SparkSession, folder: str) -> DataFrame:
    """Objects with a new column and a new field inside a struct land while the first run is busy; all are read from
    silver, each once."""
    work = fresh_folder(spark, "json-evolution")
    events = inputs.table(spark, folder, "events")
    kind, k = F.col("event_type").alias("event_type"), F.get_json_object("props", "$.k").cast("bigint").alias("k")

    def land(half: int) -> None:
        part = events.filter(F.col("event_id") % 2 == half)
        data = F.struct(kind, k) if half else F.struct(kind)
        land_snapshot(part.select("event_id", data.alias("data"), *(["value"] if half else [])), f"{work}/raw", "events", FIRST + timedelta(days=half))

    bronze = AppendedTable(spark, f"{work}/bronze")
    silver = AddedTable(spark, f"{work}/silver", ["event_id"], BUCKETS)

    def busy(batch: DataFrame, source: str, number: int) -> None:
        if number == 0:
            land(1)
        append_json(batch, source, number, bronze)

    def add(gained: DataFrame, source: str, version: int) -> bool:
        late = {"value": "double", "k": "bigint"}
        fields = {name: F.col(name if name == "value" else "data.k") for name in late if name in gained.columns + gained.schema["data"].dataType.names}
        columns = [fields.get(name, F.lit(None)).cast(kind).alias(name) for name, kind in late.items()]
        return silver.insert_new(gained.select("event_id", "data.event_type", *columns), source, version)

    land(0)
    for _ in range(2):
        finish([start_batches(lines(spark, f"{work}/raw/events*"), f"{work}/checkpoint", busy)])
        follow(bronze, silver, add)
    return silver.read().groupBy("event_id", "event_type", "value", "k").agg(F.count(F.lit(1)).alias("copies"))


@query(BEST_SQL)
def refresh_without_state(spark: SparkSession, folder: str) -> DataFrame:
    """Landed text and JSON through all layers in two refreshes, each layer taking what the one before has gained."""
    work = fresh_folder(spark, "stateless")
    schema = new_schema(spark, work)
    layout = Layout(
        productivity_raw=f"{work}/files", population_raw=f"{work}/raw/*", bronze_population_folder=f"{work}/unused",
        checkpoints=f"{work}/checkpoints", analytics=schema,
    )
    store = Store(spark, f"{work}/store", BUCKETS)
    observed = stored(inputs.observations(spark, folder).withColumn("footnote_codes", F.lit("R")), "observations")
    land_tsv(inputs.series(spark, folder), f"{work}/files", "pr.series")
    land_tsv(inputs.measures(spark, folder), f"{work}/files", "pr.measure")
    land_tsv(inputs.sectors(spark, folder), f"{work}/files", "pr.sector")
    early = F.col("period").isin("Q01", "Q02", "Q05")
    for part, at in ((early, FIRST), (~early, SECOND)):
        land_tsv(observed.filter(part), f"{work}/files", "pr.data.1.AllData", at)
        land_population(spark, folder, work, (at,))
        _, verdicts = refresh(store, layout, nation=NATION, years=(1996, 1998), series_id=SERIES_ID, period="Q01", scale=2)
        require(verdicts)
    release(observed)
    return spark.table(layout.name("gold_best_year_by_series"))


# Four extractions of the same customers; balances and names change on the way, and some are missing in between.
HISTORY_SQL = """WITH history AS (
         SELECT c_custkey, day, CASE WHEN day >= 3 AND c_custkey % 3 = 0 THEN c_acctbal + 1 ELSE c_acctbal END AS balance,
                CASE WHEN day = 2 AND c_custkey % 5 = 0 THEN NULL ELSE c_mktsegment END AS segment
         FROM customer, (VALUES (1), (2), (3), (4)) t(day) WHERE NOT (day = 2 AND c_custkey % 7 = 0) AND NOT (day = 4 AND c_custkey % 11 = 0)),
       marked AS (
         SELECT *, CASE WHEN lag(day) OVER w = day - 1 AND lag(balance) OVER w IS NOT DISTINCT FROM balance
                             AND lag(segment) OVER w IS NOT DISTINCT FROM segment THEN 0 ELSE 1 END AS fresh
         FROM history WINDOW w AS (PARTITION BY c_custkey ORDER BY day)),
       runs AS (SELECT *, sum(fresh) OVER (PARTITION BY c_custkey ORDER BY day) AS run FROM marked)
       SELECT c_custkey, any_value(balance) AS balance, any_value(segment) AS segment, CAST(min(day) AS INTEGER) AS valid_from,
              CAST(CASE WHEN max(day) < 4 THEN max(day) + 1 END AS INTEGER) AS valid_to
       FROM runs GROUP BY c_custkey, run"""


@query(HISTORY_SQL)
def validity_intervals(spark: SparkSession, folder: str) -> DataFrame:
    """From when to when every customer had its values, over four landed extractions."""
    work = fresh_folder(spark, "history")
    customers = inputs.table(spark, folder, "customer").select("c_custkey", "c_acctbal", "c_mktsegment")
    key = F.col("c_custkey")
    for at in (1, 2, 3, 4):
        present = ~((F.lit(at) == 2) & (key % 7 == 0)) & ~((F.lit(at) == 4) & (key % 11 == 0))
        raised = F.when((F.lit(at) >= 3) & (key % 3 == 0), F.col("c_acctbal") + 1).otherwise(F.col("c_acctbal"))
        segment = F.when((F.lit(at) == 2) & (key % 5 == 0), F.lit(None)).otherwise(F.col("c_mktsegment"))
        snapshot = customers.filter(present).select("c_custkey", raised.alias("balance"), segment.alias("segment"))
        land_snapshot(snapshot, work, "customers", FIRST + timedelta(days=at), file_format="parquet")
    landed = spark.read.parquet(f"{work}/customers.*")
    extracted = extraction_time(F.col(f"{LINEAGE}.file_path"))
    history = landed.withColumn("at", F.datediff(extracted, F.lit(FIRST.date())))
    return validity(history, ["c_custkey"], ["balance", "segment"], "at")


# What the states say exactly; their sketches are held against the exact number with the stated error.
STATES_SQL = """SELECT l_shipmode AS dataset, count(*) AS "rows", CAST(0 AS DOUBLE) AS null_rate,
              round(avg(l_extendedprice), 6) AS mean, round(stddev_pop(l_extendedprice), 4) AS deviation, true AS near
       FROM lineitem GROUP BY 1"""


@query(STATES_SQL.replace("l_shipmode", "l_returnflag"))
def monitoring_states(spark: SparkSession, folder: str) -> DataFrame:
    """States per flag and year are appended in three refreshes; the summary reads them alone. ``near``: the distinct
    orders are within four standard errors of the exact number."""
    work = fresh_folder(spark, "states")
    lines = inputs.table(spark, folder, "lineitem")
    states = MergedTable(spark, f"{work}/states", ["dataset", "batch"], BUCKETS)
    for third in range(3):
        part = lines.filter(F.pmod("l_linenumber", F.lit(3)) == third)
        gained = batch_states(part, "l_returnflag", F.year("l_shipdate"), ["l_orderkey"], "l_extendedprice")
        states.merge(gained, "lines", third, united)
    summary = dataset_summary(states.read())
    exact = lines.groupBy(F.col("l_returnflag").alias("dataset")).agg(F.count_distinct("l_orderkey").alias("orders"))
    error = 4 * 1.04 / (1 << LG_K) ** 0.5
    near = F.abs(F.col("distinct_keys") - F.col("orders")) <= error * F.col("orders")
    return summary.join(exact, "dataset").select(
        "dataset", "rows", F.col("null_rate").cast("double").alias("null_rate"), F.round("mean", 6).alias("mean"),
        F.round("deviation", 4).alias("deviation"), near.alias("near"),
    )


@query(
    """WITH counts AS (SELECT event_type AS dataset, strftime(ts, '%Y-%m-%d') AS batch, count(*) AS "rows" FROM events GROUP BY 1, 2),
       judged AS (
         SELECT *, avg("rows") OVER w AS expected, stddev_pop("rows") OVER w AS deviation, count(*) OVER w AS known
         FROM counts WINDOW w AS (PARTITION BY dataset ORDER BY batch ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING))
       SELECT dataset, batch, "rows", round(expected, 6) AS expected, round(deviation, 6) AS deviation,
              CASE WHEN known >= 2 THEN abs("rows" - expected) > 1.5 * deviation END AS anomalous
       FROM judged"""
)
def state_anomalies(spark: SparkSession, folder: str) -> DataFrame:
    """``count_anomaly`` from states that two refreshes left, not from the events."""
    work = fresh_folder(spark, "state-anomalies")
    events = inputs.table(spark, folder, "events")
    states = MergedTable(spark, f"{work}/states", ["dataset", "batch"], BUCKETS)
    for half in range(2):
        part = events.filter(F.pmod("event_id", F.lit(2)) == half)
        gained = batch_states(part, "event_type", F.date_format("ts", "yyyy-MM-dd"), ["user_id"], "user_id", scale=0)
        states.merge(gained, "events", half, united)
    judged = batch_anomalies(states.read(), 7, 1.5)
    return judged.select(
        "dataset", "batch", "rows", F.round("expected", 6).alias("expected"), F.round("deviation", 6).alias("deviation"), "anomalous"
    )


# Stored results


@query(
    """SELECT o_custkey, CAST(year(o_orderdate) AS INTEGER) AS year, o_orderkey, o_totalprice FROM orders
       QUALIFY row_number() OVER (PARTITION BY o_custkey, year(o_orderdate) ORDER BY o_orderkey DESC) = 1"""
)
def partition_upsert(spark: SparkSession, folder: str) -> DataFrame:
    """The latest open order per customer and year, stored by year, then upserted with all other orders."""
    target = fresh_folder(spark, "upsert-target")
    orders = inputs.table(spark, folder, "orders").select(
        "o_custkey", F.year("o_orderdate").alias("year"), "o_orderkey", "o_totalprice", "o_orderstatus"
    )
    keys = ["o_custkey", "year"]
    is_open = F.col("o_orderstatus") == "O"
    opened = latest_version(orders.filter(is_open).drop("o_orderstatus"), keys, [F.col("o_orderkey").desc()])
    opened.write.partitionBy("year").parquet(target)
    others = orders.filter(~is_open).drop("o_orderstatus")
    upsert_partitions(target, others, keys, "o_orderkey", ["year"])
    return spark.read.parquet(target)


@query(BEST_SQL)
def materialized_table(spark: SparkSession, folder: str) -> DataFrame:
    """The best-year table stored with comment and properties, then refreshed in place."""
    schema = new_schema(spark, fresh_folder(spark, "published"))
    result = gold.best_year_by_series(*best_year_inputs(spark, folder), scale=2)
    publish(result, f"{schema}.best_year", "Best year per series", {"layer": "gold"})
    return publish(result, f"{schema}.best_year", "Best year per series", {"layer": "gold"})


@query(
    """SELECT 'Customers per nation' AS comment, 'gold' AS layer, count(DISTINCT c_nationkey) AS nations,
              count(*) AS customers FROM customer"""
)
def table_description(spark: SparkSession, folder: str) -> DataFrame:
    """Comment and properties of a published table, read back from the catalog beside its rows; column names hold spaces."""
    schema = new_schema(spark, fresh_folder(spark, "described"))
    nations = inputs.table(spark, folder, "customer").groupBy(F.col("c_nationkey").alias("Nation ID"))
    counted = nations.agg(F.count(F.lit(1)).alias("Customers (all)"))
    stored = publish(counted, f"{schema}.customers", "Customers per nation", {"layer": "gold"})
    properties = spark.sql(f"SHOW TBLPROPERTIES {schema}.customers").filter("key = 'layer'").first()
    comment = spark.catalog.getTable(f"{schema}.customers").description
    return stored.agg(
        F.lit(comment).alias("comment"), F.lit(properties["value"]).alias("layer"),
        F.count("`Nation ID`").alias("nations"), F.sum("`Customers (all)`").alias("customers"),
    )


@query(PAIRED_SQL)
def materialized_sql_table(spark: SparkSession, folder: str) -> DataFrame:
    """The result of a SQL text stored as a table."""
    schema = new_schema(spark, fresh_folder(spark, "published-sql"))
    observations, people = inputs.observations(spark, folder), inputs.population(spark, folder)
    result = sql.series_population(spark, observations, people, SERIES_ID, "Q01", NATION)
    return publish(result, f"{schema}.paired", "One series beside the population")


@query(BEST_SQL)
def full_refresh(spark: SparkSession, folder: str) -> DataFrame:
    """Landed text and JSON through all layers, with checks."""
    work = fresh_folder(spark, "refresh")
    token = work.rsplit("-", 1)[1]
    layout = Layout(
        productivity_raw=f"{work}/files",
        population_raw=f"{work}/raw/*",
        bronze_population_folder=f"{work}/bronze_population",
        checkpoints=f"{work}/checkpoints",
        productivity=f"bls_{token}",
        population=f"datausa_{token}",
        analytics=f"analytics_{token}",
    )
    for schema in (layout.productivity, layout.population, layout.analytics):
        spark.sql(f"CREATE SCHEMA {schema} LOCATION '{work}/{schema}'")
    data = inputs.observations(spark, folder).withColumn("footnote_codes", F.lit("R"))
    land_tsv(data, f"{work}/files", "pr.data.1.AllData")
    land_tsv(inputs.series(spark, folder), f"{work}/files", "pr.series")
    land_tsv(inputs.measures(spark, folder), f"{work}/files", "pr.measure")
    land_tsv(inputs.sectors(spark, folder), f"{work}/files", "pr.sector")
    land_population(spark, folder, work)
    _, verdicts = run_all(
        spark, layout, nation=NATION, years=(1996, 1998), series_id=SERIES_ID, period="Q01", scale=2
    )
    require(verdicts)
    return spark.table(layout.name("gold_best_year_by_series"))
