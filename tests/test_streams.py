"""Duplicates and expectations across micro-batches and restarts, with a hot key."""

import json
import os
import random
import subprocess
import sys

import pyarrow as pa
import pytest
from conftest import DATA, rows
from pyspark import cloudpickle
from pyspark.sql import functions as F

from tierloom.operators.dedup import _first_seen, distinct_rows, first_arrival, watermarked_first_arrival
from tierloom.operators.expectations import enforce, not_null, stream_report
from tierloom.plans import sql
from tierloom.plans.silver import MEASURES, OBSERVATIONS, POPULATION, refine, refine_distinct, refine_latest
from tierloom.sources.files import with_lineage
from tierloom.sources.tables import folder_stream
from tierloom.streaming import runs
from tierloom.streaming.runs import append_all
from tierloom.workspace import fresh_folder, settings, shared_root
from workloads import inputs


def hot_table(spark, path, first, last):
    """A third of the rows share the key 'hot' and are equal in every column; the others repeat once."""
    ids = spark.range(first, last, 1, 6)
    key = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), (F.col("id") / 6).cast("int")))
    ids.select(key.alias("k"), F.lit(1).alias("v")).write.mode("append").parquet(path)


def state_metrics(query):
    """(new keys, copies dropped by the state) of the last micro-batch with data."""
    states = [json.loads(p.json)["stateOperators"] for p in query.recentProgress if p.numInputRows]
    ((state,),) = states
    return state["numRowsUpdated"], state["customMetrics"]["numDroppedDuplicateRows"]


def test_hot_key_is_thinned_before_the_state(spark, tmp_path):
    source, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "c"))

    def run():
        kept = first_arrival(with_lineage(folder_stream(spark, source)), ["k"])
        return append_all(kept, checkpoint, path=out)

    hot_table(spark, source, 0, 6000)
    with settings(spark, {"spark.sql.execution.arrow.maxRecordsPerBatch": "100"}):
        new, copies = state_metrics(run())
    assert new == 1001
    # 2,000 rows have the hot key; no task sends more than it holds before it knows the key repeats.
    assert copies <= 6 + 1000
    run()
    assert spark.read.parquet(out).count() == 1001
    hot_table(spark, source, 6000, 9000)
    new, _ = state_metrics(run())
    got = spark.read.parquet(out)
    assert new == 500 and got.count() == got.select("k").distinct().count() == 1501


def batches_of(rows, size):
    table = pa.Table.from_pylist([{"h": h, "k": k, "n": n} for k, n, h in rows])
    return (tuple(batch.columns) for batch in table.to_batches(max_chunksize=size))


@pytest.mark.parametrize("remembered", [0, 1, 100])
@pytest.mark.parametrize("size", [1, 7, 1000])
def test_pruning_is_exact(remembered, size):
    rng = random.Random(size)
    data = []
    for _ in range(500):
        key = rng.choice(["hot", "hot", "a", "b", None, f"x{rng.randrange(60)}"])
        number = rng.choice([None, 1])
        # Few hash values, so that different keys collide.
        data.append((key, number, (sum(map(ord, key or "")) + (number or 0)) % 5))
    flags = [flag for batch in _first_seen(remembered)(batches_of(data, size)) for flag in batch.to_pylist()]
    first = {}
    for position, (key, number, _) in enumerate(data):
        first.setdefault((key, number), position)
    kept = [position for position, flag in enumerate(flags) if flag]
    assert len(flags) == len(data) and set(first.values()) <= set(kept)
    if size == 1000:
        assert len(kept) >= len(first)


def test_workers_need_not_import_the_package(tmp_path):
    (tmp_path / "f.bin").write_bytes(cloudpickle.dumps(_first_seen(10)))
    program = (
        "import pickle, sys, pyarrow as pa\n"
        "f = pickle.load(open(sys.argv[1], 'rb'))\n"
        "columns = (pa.array([5, 5]), pa.array(['a', 'a']), pa.array([1, 1]))\n"
        "assert next(f(iter([columns]))).to_pylist() == [True, False] and 'tierloom' not in sys.modules\n"
    )
    environment = {**os.environ, "PYTHONPATH": ""}
    command = [sys.executable, "-c", program, str(tmp_path / "f.bin")]
    subprocess.run(command, check=True, cwd=tmp_path, env=environment)


def test_null_keys_count_as_equal(spark, tmp_path):
    source = str(tmp_path / "in")
    spark.createDataFrame([(None, 1), (None, 1), ("a", 1)], "k string, v int").write.parquet(source)
    append_all(first_arrival(folder_stream(spark, source), ["k"]), str(tmp_path / "c"), path=str(tmp_path / "o"))
    assert rows(spark.read.parquet(str(tmp_path / "o")), "k") == [("a",), (None,)]


def test_distinct_keeps_corrections(spark, tmp_path):
    source = str(tmp_path / "in")
    data = [("a", 1, "x"), ("a", 1, "y"), ("a", 2, "x")]
    spark.createDataFrame(data, "k string, v int, z string").repartition(3).write.parquet(source)
    kept = distinct_rows(with_lineage(folder_stream(spark, source)), ["k", "v"])
    append_all(kept, str(tmp_path / "c"), path=str(tmp_path / "o"))
    assert rows(spark.read.parquet(str(tmp_path / "o"))) == [("a", 1), ("a", 2)]


def test_bounded_state_variant(spark, tmp_path):
    source = str(tmp_path / "in")
    spark.sql("SELECT 'a' AS k, timestamp'2024-01-01' AS t UNION ALL SELECT 'a', timestamp'2024-01-01 00:00:05'"
              ).write.parquet(source)
    kept = watermarked_first_arrival(folder_stream(spark, source), ["k"], "t", "1 hour")
    append_all(kept, str(tmp_path / "c"), path=str(tmp_path / "o"))
    assert spark.read.parquet(str(tmp_path / "o")).count() == 1


def test_report_sums_micro_batches(spark, tmp_path):
    source = str(tmp_path / "in")
    for part in range(3):
        spark.createDataFrame([(1,), (None,), (part,)], "x int").coalesce(1).write.mode("append").parquet(source)
    schema = spark.read.parquet(source).schema
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(source)
    rules = not_null("x")
    query = append_all(enforce(stream, rules, "m"), str(tmp_path / "c"), path=str(tmp_path / "o"))
    assert len([p for p in query.recentProgress if p.numInputRows]) >= 3
    assert rows(stream_report(spark, query, "m", rules)) == [("valid_x", 6, 3)]


def test_counts_outlast_what_a_query_remembers(spark, tmp_path, monkeypatch):
    """More micro-batches than progress entries, in two runs of one checkpoint."""
    source, counts = str(tmp_path / "in"), str(tmp_path / "counts")
    rules = not_null("x")
    monkeypatch.setattr(runs, "POLL_SECONDS", 0.01)
    for _ in range(2):
        for part in range(12):
            spark.createDataFrame([(1,), (None,), (part,)], "x int").coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema("x int").option("maxFilesPerTrigger", 1).parquet(source)
        with settings(spark, {"spark.sql.streaming.numRecentProgressUpdates": "4"}):
            query = append_all(enforce(stream, rules, "m"), str(tmp_path / "c"), counts, path=str(tmp_path / "o"))
            assert len(query.recentProgress) <= 4
    assert rows(stream_report(spark, query, "m", rules, counts)) == [("valid_x", 48, 24)]
    with settings(spark, {"spark.sql.streaming.numRecentProgressUpdates": "1"}):
        with pytest.raises(ValueError, match="micro-batches"):
            stream_report(spark, query, "m", rules)


RAW = [
    ("S1  ", " 2013", "Q01", "  1.5", "", "f1"), ("S1", "2013", "Q01", "1.5", "", "f2"),
    ("S1", "2013", "Q01", "9.5", "C", "f2"), (" S2", "2013", "Q02", "-", "", "f1"),
    ("S2", "2013", "Q02", "2", "", "f2"),
]
RAW_SCHEMA = "series_id string, year string, period string, value string, footnote_codes string, f string"


def raw_bronze(spark):
    df = spark.createDataFrame(RAW, RAW_SCHEMA).repartition(3)
    lineage = F.struct(F.col("f").alias("file_path"), F.lit(0).cast("bigint").alias("file_block_start"))
    return df.withColumn("_metadata", lineage).drop("f")


def test_silver_forms_agree(spark, tmp_path):
    raw_bronze(spark).write.parquet(str(tmp_path / "b"))
    batch = refine(spark.read.parquet(str(tmp_path / "b")), OBSERVATIONS)
    key = ["series_id", "year", "period"]
    assert rows(batch, *key) == [("S1", 2013, "Q01"), ("S2", 2013, "Q02")]
    for order, expected in (("expect_first", 2), ("dedup_first", (1, 2))):
        stream = refine(folder_stream(spark, str(tmp_path / "b")), OBSERVATIONS, order=order)
        append_all(stream, str(tmp_path / f"c{order}"), path=str(tmp_path / order))
        count = spark.read.parquet(str(tmp_path / order)).count()
        assert count in (expected if isinstance(expected, tuple) else (expected,))
    whole = [("S1", 2013, "Q01", 1.5, ""), ("S1", 2013, "Q01", 9.5, "C"), ("S2", 2013, "Q02", 2.0, "")]
    assert rows(refine_distinct(spark.read.parquet(str(tmp_path / "b")), OBSERVATIONS)) == whole
    assert rows(sql.silver(spark, spark.read.parquet(str(tmp_path / "b")), OBSERVATIONS)) == whole
    streamed = sql.silver(spark, folder_stream(spark, str(tmp_path / "b")), OBSERVATIONS, "counts")
    query = append_all(streamed, str(tmp_path / "cs"), path=str(tmp_path / "s"))
    assert rows(spark.read.parquet(str(tmp_path / "s"))) == whole
    counts = stream_report(spark, query, "counts", OBSERVATIONS.expectations)
    assert ("valid_value", 4, 1) in rows(counts)


def test_latest_extraction_wins(spark):
    ddl = (
        "data array<struct<`Nation ID`: string, Nation: string, Year: bigint, Population: double>>,"
        "_metadata struct<file_path: string, file_modification_time: timestamp>"
    )

    def snapshot(population, name):
        return [("01", "US", 2023, population)], (f"/raw/{name}", None)

    history = [
        snapshot(335000000.0, "population.20260815120000.json"),
        snapshot(334914895.0, "population.20260814120000.json"),
        snapshot(None, "population.20260816120000.json"),
        snapshot(1.0, "unstamped.json"),
        snapshot(2.0, "archive.20300101000000/population.20260813120000.json"),
    ]
    latest = refine_latest(spark.createDataFrame(history, ddl), POPULATION)
    assert rows(latest, "year", "population") == [(2023, 335000000)]


def test_nested_silver_forms_agree(spark):
    ddl = "data array<struct<`Nation ID`: string, Nation: string, Year: bigint, Population: double>>"
    record = ("01", "United States", 2013, 5.0)
    bronze = spark.createDataFrame([([record, ("01", "United States", None, 5.0)],), ([record],), ([],), (None,)], ddl)
    expected = [("01", "United States", 2013, 5)]
    assert rows(refine(bronze, POPULATION)) == expected
    assert rows(sql.silver(spark, bronze, POPULATION)) == expected


def test_sql_over_a_table_stream(spark, tmp_path):
    spark.sql("CREATE SCHEMA IF NOT EXISTS sqlforms")
    raw = spark.createDataFrame([(" 01", "x "), ("01", "x")], "measure_code string, measure_text string")
    raw.write.mode("overwrite").saveAsTable("sqlforms.bronze")
    bronze = sql.appended(spark, "sqlforms.bronze")
    assert bronze.isStreaming
    append_all(sql.silver(spark, bronze, MEASURES), str(tmp_path / "c"), table="sqlforms.silver")
    assert rows(spark.table("sqlforms.silver")) == [("01", "x")]


def test_reading_a_table_changes_no_setting(spark):
    before = spark.sql("SET").collect()
    inputs.observations(spark, DATA).count()
    assert spark.sql("SET").collect() == before


def test_the_first_run_fixes_state_partitions(spark, tmp_path):
    source, checkpoint = str(tmp_path / "in"), tmp_path / "c"
    for number in (3, 5):
        spark.range(4).write.mode("append").parquet(source)
        append_all(first_arrival(folder_stream(spark, source), ["id"]), str(checkpoint), path=str(tmp_path / "o"), state_partitions=number)
        assert len([d for d in (checkpoint / "state" / "0").iterdir() if d.name.isdigit()]) == 3
    assert spark.read.parquet(str(tmp_path / "o")).count() == 4


def test_workspace_follows_the_session(spark):
    assert shared_root(spark) == spark.conf.get("spark.checkpoint.dir")
    assert fresh_folder(spark, "x") != fresh_folder(spark, "x")
    with settings(spark, {"spark.sql.shuffle.partitions": "3"}):
        assert spark.conf.get("spark.sql.shuffle.partitions") == "3"
    assert spark.conf.get("spark.sql.shuffle.partitions") == "4"
