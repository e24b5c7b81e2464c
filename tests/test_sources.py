"""Landing, incremental reading, type inference and schema evolution."""

import json
import os
import time
from datetime import datetime, timedelta

import pytest
from conftest import rows
from fixtures import PAD, write_tsv
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructType

from tierloom.functions.columns import trim_headers
from tierloom.sources.evolution import RESCUE, SchemaLog, infer_json, widen
from tierloom.sources.files import header_schema, infer_types, json_batch, json_stream, tsv_batch, tsv_stream
from tierloom.sources.landing import land_snapshot
from tierloom.sources.tables import folder_stream
from tierloom.streaming.runs import append_all


def test_glob_picks_one_dataset(spark, tmp_path):
    write_tsv(tmp_path / "pr.series.20260814120000", ["id" + PAD, "code"], [["S1", "01"]])
    write_tsv(tmp_path / "pr.sector.20260814120000", ["code", "name"], [["01", "x"], ["02", "y"]])
    stream = trim_headers(tsv_stream(spark, str(tmp_path), glob="pr.series*"))
    append_all(stream, str(tmp_path / "_c"), path=str(tmp_path / "_o"))
    got = spark.read.parquet(str(tmp_path / "_o"))
    assert rows(got, "id", "code", "_metadata.file_name") == [("S1", "01", "pr.series.20260814120000")]


def test_a_file_with_another_header_fails(spark, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    write_tsv(raw / "a.20260814120000", ["id", "code"], [["S1", "01"]])
    schema = header_schema(spark, str(raw))
    write_tsv(raw / "a.20260815120000", ["code", "id"], [["01", "S1"]])
    with pytest.raises(Exception, match="FAILED_READ_FILE"):
        append_all(tsv_stream(spark, str(raw), schema), str(tmp_path / "c"), path=str(tmp_path / "o"))


def test_bronze_keeps_values_as_they_arrived(spark, tmp_path):
    write_tsv(tmp_path / "a.tsv", ["id" + PAD, "v"], [["S1" + PAD, "   -"], ["01", ""]])
    got = trim_headers(tsv_batch(spark, str(tmp_path)).drop("_metadata"))
    assert rows(got) == sorted([("S1" + PAD, "   -"), ("01", None)], key=repr)


def test_types_from_a_sample(spark, tmp_path):
    write_tsv(tmp_path / "a.tsv", ["code ", "year", "value", "text"], [["01", " 2013", "  1.5", "x"]])
    schema = infer_types(spark, str(tmp_path), keep_text=("code",))
    assert [f.dataType.simpleString() for f in schema] == ["string", "int", "double", "string"]


def test_landing_never_overwrites(spark, tmp_path):
    df = spark.range(5)
    at = datetime(2026, 8, 14, 12)
    assert land_snapshot(df, str(tmp_path), "n", at).endswith("/n.20260814120000")
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS|already exists"):
        land_snapshot(df, str(tmp_path), "n", at)
    land_snapshot(df, str(tmp_path), "n", at + timedelta(seconds=1))
    assert spark.read.json(f"{tmp_path}/n.*").count() == 10


def test_empty_and_null_arrays(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"data": []}\n{"data": null}\n{"data": [{"x": 1}], "page": {}}\n')
    df = json_batch(spark, str(tmp_path), "data array<struct<x: int>>, page string")
    assert df.select(F.explode("data")).count() == 1
    assert rows(df, "page") == [("{}",), (None,), (None,)]


def test_widen(spark):
    a = StructType.fromDDL("x bigint, s struct<p: int>, l array<struct<q: int>>")
    b = StructType.fromDDL("x string, s struct<p: string, r: int>, l array<struct<q: int, t: int>>, n double")
    merged = widen(a, b)
    assert merged.simpleString() == (
        "struct<x:bigint,s:struct<p:int,r:int>,l:array<struct<q:int,t:int>>,n:double>"
    )
    assert widen(merged, a) == merged


def test_schema_log_and_rescue(spark, tmp_path):
    raw, log = tmp_path / "raw", SchemaLog(spark, str(tmp_path / "log"))
    raw.mkdir()
    assert log.current() is None
    (raw / "1.json").write_text(json.dumps({"a": 1}) + "\n")
    first = log.refresh(str(raw))
    assert first["a"].dataType == LongType() and first[RESCUE].dataType == StringType()
    stream = json_stream(spark, str(raw), first, rescue=RESCUE)
    append_all(stream, str(tmp_path / "c"), path=str(tmp_path / "o"))
    (raw / "2.json").write_text(json.dumps({"a": "not a number", "b": True}) + "\n")
    second = log.refresh(str(raw))
    assert second.fieldNames() == ["a", RESCUE, "b"] and second["a"].dataType == LongType()
    assert log.current() == second
    stream = json_stream(spark, str(raw), second, rescue=RESCUE)
    append_all(stream, str(tmp_path / "c"), path=str(tmp_path / "o"))
    got = spark.read.option("mergeSchema", True).parquet(str(tmp_path / "o")).orderBy("_metadata.file_name")
    assert [(r["a"], r["b"]) for r in got.collect()] == [(1, None), (None, True)]
    assert json.loads(got.collect()[1][RESCUE]) == {"a": "not a number", "b": True}


def test_every_file_is_looked_at_once_whatever_its_date(spark, tmp_path):
    raw, log = tmp_path / "raw [1]", SchemaLog(spark, str(tmp_path / "log"))
    raw.mkdir()
    pattern = str(raw).replace("[", "\\[").replace("]", "\\]")
    (raw / "1.json").write_text('{"a": 1}\n')
    assert log.refresh(pattern).fieldNames() == ["a", RESCUE]
    (raw / "old file+1.json").write_text('{"b": 1}\n')
    os.utime(raw / "old file+1.json", (0, time.time() - 2 * 86400))
    assert log.refresh(pattern).fieldNames() == ["a", RESCUE, "b"]
    assert log._new_files(pattern, None).isEmpty()
    assert infer_json(spark, []) is None


def test_a_file_that_lands_during_a_run_keeps_its_fields(spark, tmp_path):
    raw, log = tmp_path / "raw", SchemaLog(spark, str(tmp_path / "log"))
    raw.mkdir()
    (raw / "1.json").write_text('{"a": 1}\n')
    used = log.refresh(str(raw))
    (raw / "2.json").write_text('{"a": 2, "new": "x"}\n')
    stream = json_stream(spark, str(raw), used, rescue=RESCUE)
    append_all(stream, str(tmp_path / "c"), path=str(tmp_path / "o"))
    assert log.keep_late(str(raw), used, str(tmp_path / "late")).fieldNames() == ["a", RESCUE, "new"]
    assert rows(spark.read.parquet(str(tmp_path / "late")), "a", "new", "_metadata.file_name") == [(2, "x", "2.json")]
    again = log.refresh(str(raw))
    assert log.keep_late(str(raw), again, str(tmp_path / "late")) == again
    assert spark.read.parquet(str(tmp_path / "late")).count() == 1


def test_types_come_from_all_files(spark, tmp_path):
    for i in range(30):
        (tmp_path / f"{i:02}.tsv").write_text("v\n" + ("1.5" if i == 29 else str(i)) + "\n")
    assert infer_types(spark, str(tmp_path)).simpleString() == "struct<v:double>"


def test_folder_stream_reads_only_new_rows(spark, tmp_path):
    source, out = str(tmp_path / "s"), str(tmp_path / "o")

    def stored():
        append_all(folder_stream(spark, source), str(tmp_path / "c"), path=out)
        return spark.read.parquet(out).count()

    spark.range(3).write.parquet(source)
    assert stored() == 3
    assert stored() == 3
    spark.range(3, 5).write.mode("append").parquet(source)
    assert stored() == 5
