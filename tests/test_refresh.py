"""The refresh without state stores: datasets that land late, changing files, and nothing taken twice."""

import json

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tierloom.sources.evolving import lines, read_typed, tsv_into, type_rank, wider
from tierloom.streaming.flows import Layout
from tierloom.streaming.keyed import AppendedTable
from tierloom.streaming.refresh import Store, refresh
from tierloom.streaming.runs import finish

OPTIONS = {"nation": "United States", "years": (2013, 2018), "series_id": "S1", "period": "Q01"}


@pytest.fixture
def place(spark, tmp_path):
    schema = f"late_{abs(hash(str(tmp_path))) % 10**9}"
    spark.sql(f"CREATE SCHEMA {schema} LOCATION '{tmp_path / 'gold'}'")
    (tmp_path / "raw" / "bls").mkdir(parents=True)
    (tmp_path / "raw" / "people").mkdir()
    layout = Layout(
        productivity_raw=str(tmp_path / "raw" / "bls"), population_raw=str(tmp_path / "raw" / "people"),
        bronze_population_folder="", checkpoints=str(tmp_path / "checkpoints"), analytics=schema,
    )
    return tmp_path, layout, Store(spark, str(tmp_path / "store"), 2)


def put(folder, name, *written):
    (folder / name).write_text("\n".join("\t".join(line) for line in written) + "\n")


def test_datasets_that_have_not_landed_are_waited_for(spark, place):
    base, layout, store = place
    bls = base / "raw" / "bls"
    best = layout.name("gold_best_year_by_series")
    refresh(store, layout, **OPTIONS)
    assert spark.table(best).count() == 0
    put(bls, "pr.data.1.AllData.20260101", ("series_id   ", "year", "period", "value", "footnote_codes"), ("S1 ", "2013", "Q01", "1.5", ""), ("S1", "2013", "Q02", "-", ""))
    counts, _ = refresh(store, layout, **OPTIONS)
    assert ("silver_bls_data", "valid_value", 1, 1) in rows(counts)
    assert rows(spark.table(best)) == [("S1", None, 2013, 1.5)] or rows(spark.table(best)) == [("S1", "", 2013, 1.5)]
    put(bls, "pr.series.20260102", ("series_id", "sector_code", "measure_code"), ("S1", "01", "02"))
    put(bls, "pr.sector.20260102", ("sector_code", "sector_name"), ("01", "Business"))
    put(bls, "pr.measure.20260102", ("measure_code", "measure_text"), ("02", "Output"))
    response = {"annotations": {}, "page": {}, "data": [{"Nation ID": "01000US", "Nation": "United States", "Year": y, "Population": 1.0 * y} for y in (2013, 2014)]}
    (base / "raw" / "people" / "population.1.json").write_text(json.dumps(response) + "\n")
    # A file with a column more, in another order, and a value again.
    put(bls, "pr.data.1.AllData.20260103", ("note", "value", "period", "year", "series_id", "footnote_codes"), ("n", "2", "Q01", "2014", "S1", "R"), ("n", "9", "Q01", "2013", "S1", "R"))
    counts, verdicts = refresh(store, layout, **OPTIONS)
    assert ("silver_bls_data", "valid_value", 2, 0) in rows(counts)
    assert rows(spark.table(best)) == [("S1", "Business - Output", 2014, 2.0)]
    assert not rows(verdicts.filter("NOT passed"))
    assert rows(spark.table(layout.name("gold_series_population"))) == [(2013, 1.5, 2013), (2014, 2.0, 2014)]
    assert "note" in store.bronze("bronze_bls_data").read().columns
    counts, _ = refresh(store, layout, **OPTIONS)
    assert {(r["passed"], r["failed"]) for r in counts.collect()} == {(0, 0)}


def test_types_widen_and_never_narrow():
    assert wider({"a": "int", "b": "string"}, {"a": "double", "b": "int", "c": "int"}) == {"a": "double", "b": "string", "c": "int"}
    assert wider({"a": "double"}, {"a": "bigint"}) == {"a": "double"}


def test_what_a_text_needs(spark):
    cases = {
        "": 0, "  ": 0, None: 0, "0": 1, "-7": 1, " 12 ": 1, "2147483647": 1, "2147483648": 2, "-999999999999999999": 2,
        "1.50": 3, "-0.5": 3, "1e5": 3, "01": 4, "-0": 4, "+1": 4, "1234567890123456789": 4, ".5": 4, "x": 4, "1,5": 4, "NaN": 4,
    }
    table = spark.createDataFrame(list(cases.items()), "v string, want int")
    assert table.filter(type_rank(F.col("v")) != F.col("want")).collect() == []


def test_headers_of_one_batch_are_united(spark, tmp_path):
    landed = tmp_path / "in"
    landed.mkdir()
    put(landed, "a.txt", ("id", "code ", "v"), ("1", "01", "12"), ("2", "02", ""))
    put(landed, "b.txt", ("v", "id"), ("12.5", "3"), ("1", "4", "odd"))
    put(landed, "empty.txt", ("id", "v"))
    table = AppendedTable(spark, str(tmp_path / "t"))
    finish([tsv_into(lines(spark, str(landed)), str(tmp_path / "c"), table)])
    assert table.last().types == {"id": "int", "code": "string", "v": "double"}
    assert rows(read_typed(table), "id", "code", "v", "_rescued") == [
        (1, "01", 12.0, None), (2, "02", None, None), (3, None, 12.5, None), (4, None, 1.0, "1\t4\todd"),
    ]
    put(landed, "twice.txt", ("id", "ID"), ("1", "2"))
    with pytest.raises(Exception, match="twice"):
        finish([tsv_into(lines(spark, str(landed)), str(tmp_path / "c"), table)])
    assert read_typed(table).count() == 4
