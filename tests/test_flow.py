"""The whole refresh over small landed files, twice."""

import pytest
from conftest import rows
from fixtures import land_first, land_second

from tierloom.operators.checks import require
from tierloom.plans.silver import SPECS
from tierloom.sources.tables import table_stream
from tierloom.streaming import flows
from tierloom.streaming.flows import Layout, analyze, clean, create_schemas, ingest, run_all


@pytest.fixture(scope="module")
def refreshed(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("flow")
    raw = base / "raw"
    layout = Layout(
        productivity_raw=str(raw / "bls"),
        population_raw=str(raw / "people"),
        bronze_population_folder=str(base / "bronze_population"),
        checkpoints=str(base / "checkpoints"),
    )
    results = {}

    def keep(label):
        names = [
            "silver_bls_data", "silver_population", "gold_population_stats",
            "gold_best_year_by_series", "gold_series_population", "bronze_population", "bronze_bls_data",
        ]
        results[label] = {
            name: [r.asDict(recursive=True) for r in spark.table(layout.name(name)).collect()] for name in names
        }

    land_first(raw)
    counts, verdicts = run_all(spark, layout)
    results["counts1"], results["verdicts1"] = counts.collect(), verdicts.collect()
    keep("first")
    counts, _ = run_all(spark, layout)
    results["counts_again"] = counts.collect()
    keep("again")
    land_second(raw)
    counts, verdicts = run_all(spark, layout)
    results["counts2"], results["verdicts2"] = counts.collect(), verdicts.collect()
    keep("second")
    results["layout"] = layout
    return results


def values(table, *columns):
    return sorted((tuple(row[c] for c in columns) for row in table), key=repr)


def test_silver_observations(refreshed):
    table = refreshed["first"]["silver_bls_data"]
    assert len(table) == 13
    assert ("S1", 2012, "Q01", 1.5) in values(table, "series_id", "year", "period", "value")
    assert all(row["_metadata"]["file_name"].startswith("pr.data.1.AllData") for row in table)


def test_expectation_counts(refreshed):
    counts = {(r["table"], r["name"]): (r["passed"], r["failed"]) for r in refreshed["counts1"]}
    assert counts["silver_bls_data", "valid_value"] == (13, 2)
    assert counts["silver_bls_data", "valid_series_id"] == (15, 0)
    assert counts["silver_population", "valid_year"] == (6, 1)
    assert counts["silver_bls_series", "valid_series_id"] == (4, 0)


def test_second_run_without_new_files_changes_nothing(refreshed):
    for table in refreshed["first"]:
        assert values(refreshed["again"][table], *list(refreshed["first"][table][0])) == values(
            refreshed["first"][table], *list(refreshed["first"][table][0])
        )
    assert sum(r["passed"] + r["failed"] for r in refreshed["counts_again"]) == 0


def test_best_year(refreshed):
    best = values(
        refreshed["first"]["gold_best_year_by_series"],
        "series_id", "series_label", "best_year", "best_year_value",
    )
    assert best == sorted(
        [
            ("S1", "Nonfarm - Output per hour", 2012, 4.0),
            ("S2", "One - Output per hour", 2013, 3.0),
            ("S3", "Nonfarm", 2014, 0.5),
            ("S4", None, 2015, -2.0),
            ("PRS30006032", "", 2014, 0.7),
        ],
        key=repr,
    )


def test_statistics_over_inclusive_years(refreshed):
    (row,) = refreshed["first"]["gold_population_stats"]
    assert row["mean_population"] == pytest.approx(130.0)
    assert row["stddev_population"] == pytest.approx((800 / 3) ** 0.5)


def test_series_beside_population(refreshed):
    table = refreshed["first"]["gold_series_population"]
    assert values(table, "year", "value", "population") == [(1990, 0.1, None), (2013, 0.2, 110), (2014, 0.3, 130)]


def test_second_landing(refreshed):
    table = refreshed["second"]["silver_bls_data"]
    got = values(table, "series_id", "year", "period", "value")
    assert len(got) == 14
    assert ("S1", 2012, "Q02", 2.5) in got, "the first arrival keeps its key"
    assert ("S3", 2013, "Q01", 2.5) in got, "an invalid first arrival does not take the key"
    people = values(refreshed["second"]["silver_population"], "nation", "year", "population")
    assert ("United States", 2014, 130) in people and ("United States", 2015, 140) in people


def test_bronze_takes_new_fields(refreshed):
    table = sorted(refreshed["second"]["bronze_population"], key=lambda r: r["_metadata"]["file_name"])
    assert [row["source"] for row in table] == [None, "census"]
    assert table[0]["data"][0]["Margin"] is None and table[1]["data"][0]["Margin"] == 0.5
    assert table[0]["annotations"] == "{}" and table[0]["_rescued"] is None
    assert "source" not in refreshed["first"]["bronze_population"][0]


def test_checks(refreshed):
    failed = {r["check"]: r["violations"] for r in refreshed["verdicts1"] if not r["passed"]}
    assert failed == {"best_label_present": 2}
    assert len(refreshed["verdicts1"]) == 21


def test_require_raises(spark, refreshed):
    verdicts = spark.createDataFrame(refreshed["verdicts1"])
    with pytest.raises(AssertionError, match=r"best_label_present \(2\)"):
        require(verdicts)


def test_comments(spark, refreshed):
    name = refreshed["layout"].name("gold_population_stats")
    described = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE EXTENDED {name}").collect()}
    assert described["Comment"].startswith("Mean and standard deviation")


def test_counts_of_failed_refreshes_are_reported_by_the_next(spark, tmp_path, monkeypatch):
    raw = tmp_path / "raw"
    layout = Layout(
        str(raw / "bls"), str(raw / "people"), str(tmp_path / "bp"), str(tmp_path / "cp"),
        productivity="bls3", population="datausa3", analytics="pa3",
    )

    def fails(*_, **__):
        raise RuntimeError("ended")

    def counted(report):
        return {(r["table"], r["name"]): (r["passed"], r["failed"]) for r in report.collect()}

    def refused(spark, name):
        return fails() if name.endswith(SPECS[-1].source) else table_stream(spark, name)

    land_first(raw)
    create_schemas(spark, layout)
    ingest(spark, layout)
    for name, instead in (("table_stream", refused), ("describe", fails)):
        with monkeypatch.context() as patch, pytest.raises(RuntimeError, match="ended"):
            patch.setattr(flows, name, instead)
            clean(spark, layout)
    with monkeypatch.context() as patch, pytest.raises(RuntimeError, match="ended"):
        patch.setattr(flows, "analyze", fails)
        run_all(spark, layout)
    first, _ = run_all(spark, layout)
    assert counted(first)["silver_bls_data", "valid_value"] == (13, 2)
    assert counted(first)["silver_population", "valid_year"] == (6, 1)
    land_second(raw)
    ingest(spark, layout)
    second = counted(clean(spark, layout))
    assert 0 < sum(second["silver_bls_data", "valid_value"]) < 15
    assert set(counted(clean(spark, layout)).values()) == {(0, 0)}
    assert counted(first)["silver_bls_data", "valid_value"] == (13, 2)


def test_dedup_first_order_loses_the_repaired_row(spark, tmp_path):
    raw = tmp_path / "raw"
    layout = Layout(
        str(raw / "bls"), str(raw / "people"), str(tmp_path / "bp"), str(tmp_path / "cp"),
        productivity="bls2", population="datausa2", analytics="pa2",
    )
    create_schemas(spark, layout)
    land_first(raw)
    ingest(spark, layout)
    clean(spark, layout, order="dedup_first")
    land_second(raw)
    ingest(spark, layout)
    clean(spark, layout, order="dedup_first")
    got = rows(spark.table("bls2.silver_bls_data"), "series_id", "year", "period")
    assert ("S3", 2013, "Q01") not in got
    assert len(got) == 13
    assert analyze(spark, layout, scale=4).count() == 21
