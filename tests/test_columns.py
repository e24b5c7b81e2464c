"""Column expressions on edge values."""

from datetime import datetime

import pytest

from tierloom.functions.columns import extraction_time, label, safe_cast, source_name, trim_headers, trimmed


@pytest.mark.parametrize(
    ("name", "stamp", "source"),
    [
        ("pr.data.1.AllData.20260814120000", datetime(2026, 8, 14, 12), "pr.data.1.AllData"),
        ("population.20260814120001.json", datetime(2026, 8, 14, 12, 0, 1), "population"),
        ("population_20260814T120000.json", datetime(2026, 8, 14, 12), "population"),
        ("pr.series", None, "pr.series"),
        ("x.20261399999999", None, "x"),
        ("x.2026081412", None, "x.2026081412"),
    ],
)
def test_stamped_names(spark, name, stamp, source):
    df = spark.createDataFrame([(name,)], "f string")
    (row,) = df.select(extraction_time("f").alias("t"), source_name("f").alias("s")).collect()
    assert (row["t"], row["s"]) == (stamp, source)


def test_stamp_in_a_folder_name(spark):
    path = "file:/raw/orders.20260814120000/part-00000-12345678-1234-c000.json"
    (row,) = spark.createDataFrame([(path,)], "f string").select(extraction_time("f").alias("t")).collect()
    assert row["t"] == datetime(2026, 8, 14, 12)


def test_safe_cast(spark):
    df = spark.createDataFrame([("      1.5",), ("-",), ("",), (None,), (" 2013 ",), ("1e3",)], "v string")
    got = [r[0] for r in df.select(safe_cast("v", "double")).collect()]
    assert got == [1.5, None, None, None, 2013.0, 1000.0]
    whole = [r[0] for r in df.select(safe_cast("v", "int")).collect()]
    assert whole == [None, None, None, None, 2013, None]


def test_trim_takes_spaces_only(spark):
    (row,) = spark.createDataFrame([("  a\t ",)], "v string").select(trimmed("v").alias("v")).collect()
    assert row["v"] == "a\t"


def test_label_parts(spark):
    df = spark.createDataFrame([("A", "B"), ("A", None), (None, "B"), (None, None)], "x string, y string")
    assert [r[0] for r in df.select(label("x", "y")).collect()] == ["A - B", "A", "B", ""]


def test_headers(spark):
    df = spark.createDataFrame([(1, 2)], ["  a  ", "b\t"])
    assert trim_headers(df).columns == ["a", "b"]
    with pytest.raises(ValueError, match="equal once trimmed"):
        trim_headers(spark.createDataFrame([(1, 2)], ["a", "A "]))
