"""Operators against brute force on small random tables with hot keys."""

import json
import random
from collections import Counter, defaultdict

import pytest
from conftest import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tierloom.operators import checks, joins, profile, ranking, versions
from tierloom.operators.checks import (
    every_row,
    no_row,
    not_empty,
    row_count_is,
    same_row_count,
    selected_is_max,
    table_checks,
    unique_key,
)
from tierloom.operators.expectations import Expectation, enforce, not_null, report
from tierloom.plans import gold, sql
from tierloom.workspace import stored

QUICK = settings(
    max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)


def hot_rows(n=600, seed=3):
    """(key, value, order): a third of the rows share one key."""
    rng = random.Random(seed)
    return [
        ("hot" if rng.random() < 0.34 else f"k{rng.randrange(40)}", rng.randrange(50), position)
        for position in range(n)
    ]


def test_top_per_group(spark):
    data = hot_rows()
    df = spark.createDataFrame(data, "k string, v int, o int").repartition(8)
    got = rows(ranking.top_per_group(df, ["k"], [F.col("v").desc(), F.col("o").asc()], 2))
    groups = defaultdict(list)
    for row in data:
        groups[row[0]].append(row)
    expected = [r for g in groups.values() for r in sorted(g, key=lambda r: (-r[1], r[2]))[:2]]
    assert got == sorted(expected, key=repr)


def test_ties_and_nulls_in_ranking(spark):
    data = [("a", 2014, 3.0), ("a", 2013, 3.0), ("a", 2012, None), ("b", 1, float("nan")), ("b", 2, 9.0)]
    df = spark.createDataFrame(data, "k string, y int, v double")
    best = ranking.top_per_group(df, ["k"], [F.col("v").desc(), F.col("y").asc()])
    assert rows(best, "k", "y") == [("a", 2013), ("b", 1)]


def test_latest_version_replaces_a_correction(spark):
    data = [("US", 2023, 334914895, "20260814"), ("US", 2023, 335000000, "20260815"), ("US", 2022, 1, "20260814")]
    df = spark.createDataFrame(data, "n string, y int, p bigint, e string")
    latest = versions.latest_version(df, ["n", "y"], [F.col("e").desc()])
    assert rows(latest, "y", "p") == [(2022, 1), (2023, 335000000)]


@QUICK
@given(
    st.lists(st.tuples(st.sampled_from("abc"), st.integers(0, 3), st.integers(0, 30), st.booleans()), max_size=25),
    st.lists(st.tuples(st.sampled_from("abc"), st.integers(0, 3), st.integers(0, 30)), max_size=10),
)
def test_apply_changes(spark, changes, current):
    changes = list({(k, s): (k, v, s, d) for k, v, s, d in changes}.values())
    current = list({k: (k, v, s) for k, v, s in current}.values())
    state = {k: (s, 0, v, False) for k, v, s in current}
    for k, v, s, d in changes:
        state[k] = max(state.get(k, (-1, 0, 0, False)), (s, 1, v, d), key=lambda x: x[:2])
    expected = sorted(((k, v, s) for k, (s, _, v, d) in state.items() if not d), key=repr)
    got = versions.apply_changes(
        spark.createDataFrame(current, "k string, v int, s int"),
        spark.createDataFrame(changes, "k string, v int, s int, gone boolean"),
        ["k"], "s", deleted="gone",
    )
    assert rows(got, "k", "v", "s") == expected


@QUICK
@given(
    st.dictionaries(st.integers(0, 8), st.one_of(st.none(), st.integers(0, 2)), max_size=9),
    st.dictionaries(st.integers(0, 8), st.one_of(st.none(), st.integers(0, 2)), max_size=9),
)
def test_compare_snapshots(spark, old, new):
    got = versions.compare_snapshots(
        spark.createDataFrame(list(old.items()), "k int, v int"),
        spark.createDataFrame(list(new.items()), "k int, v int"),
        ["k"], ["v"],
    )
    expected = []
    for k in old.keys() | new.keys():
        if k not in old:
            expected.append((k, "added", None, new[k]))
        elif k not in new:
            expected.append((k, "removed", old[k], None))
        elif old[k] != new[k]:
            expected.append((k, "changed", old[k], new[k]))
    assert rows(got) == sorted(expected, key=repr)


def test_upsert_rewrites_only_touched_partitions(spark, tmp_path):
    folder = str(tmp_path / "t")
    schema = "k string, y int, v int, s int"
    old = [("a", 1, 10, 1), ("b", 1, 20, 1), ("a", 2, 30, 1), ("c", 3, 40, 5)]
    spark.createDataFrame(old, schema).write.partitionBy("y").parquet(folder)
    untouched = {p: p.stat().st_mtime_ns for p in (tmp_path / "t" / "y=2").iterdir()}
    changes = spark.createDataFrame([("a", 1, 11, 2), ("c", 3, 41, 4), ("n", 4, 50, 1)], schema)
    versions.upsert_partitions(folder, changes, ["k", "y"], "s", ["y"])
    assert rows(spark.read.parquet(folder), "k", "y", "v") == [
        ("a", 1, 11), ("a", 2, 30), ("b", 1, 20), ("c", 3, 40), ("n", 4, 50),
    ]
    assert untouched == {p: p.stat().st_mtime_ns for p in (tmp_path / "t" / "y=2").iterdir()}
    versions.upsert_partitions(folder, changes.limit(0), ["k", "y"], "s", ["y"])
    with pytest.raises(ValueError, match="outside the key"):
        versions.upsert_partitions(folder, changes, ["k"], "s", ["y"])


def test_exact_sum_does_not_depend_on_order(spark):
    values = [0.1, 0.2, 0.3, 1e9 + 0.01, -1e9] * 40
    schema = "v double"
    for seed in range(3):
        random.Random(seed).shuffle(values)
        df = spark.createDataFrame([(v,) for v in values], schema).repartition(1 + seed * 3)
        (row,) = df.agg(ranking.exact_sum("v", 2).alias("s")).collect()
        assert row["s"] == 24.4
    empty = spark.createDataFrame([], schema).agg(ranking.exact_sum("v", 2).alias("s")).first()
    assert empty["s"] is None


@pytest.mark.parametrize("bad", [1e30, float("nan"), 0.004, 1.005])
def test_exact_sum_is_exact_or_fails(spark, bad):
    df = spark.createDataFrame([(1.0,), (bad,)], "v double")
    for total in (ranking.exact_sum("v", 2), F.expr(ranking.exact_sum_sql("v", 2))):
        with pytest.raises(Exception, match="more than 2 decimals"):
            df.agg(total).collect()
    assert df.filter("v = 1.0").agg(ranking.exact_sum("v", 2).alias("s")).first()["s"] == 1.0


def test_exact_sums_of_small_values_make_no_ties(spark):
    observations = spark.createDataFrame(
        [("S", year, period, value) for year, value in ((2013, 0.004), (2014, 0.003)) for period in ("Q01", "Q02")],
        "series_id string, year int, period string, value double",
    )
    empty = spark.createDataFrame([], "series_id string, measure_code string, sector_code string, measure_text string, sector_name string")
    tables = (observations, empty, empty, empty)
    for best in (gold.best_year_by_series(*tables, scale=3), sql.best_year_by_series(spark, *tables, scale=3)):
        assert rows(best, "best_year", "best_year_value") == [(2013, 0.008)]
    for best in (gold.best_year_by_series(*tables, scale=2), sql.best_year_by_series(spark, *tables, scale=2)):
        with pytest.raises(Exception, match="more than 2 decimals"):
            best.collect()


def test_tied_years_go_to_a_missing_year_first_in_both_forms(spark):
    observations = spark.createDataFrame(
        [("S", None, "Q01", 1.0), ("S", 2013, "Q01", 1.0)], "series_id string, year int, period string, value double"
    )
    empty = spark.createDataFrame([], "series_id string, measure_code string, sector_code string, measure_text string, sector_name string")
    tables = (observations, empty, empty, empty)
    forms = gold.best_year_by_series(*tables), sql.best_year_by_series(spark, *tables)
    assert [rows(form, "best_year") for form in forms] == [[(None,)], [(None,)]]


def test_tolerance_is_relative(spark):
    result = spark.createDataFrame([("a", 1e11 + 0.01), ("b", 1.5)], "k string, v double")
    again = spark.createDataFrame([("a", 1e11), ("b", 1.0)], "k string, e double")
    (row,) = checks.selected_is_max("m", result, again, "k", "v", "e", 1e-6).collect()
    assert row["violations"] == 1


def test_summary_edges(spark):
    df = spark.createDataFrame([(5,)], "v int")
    assert tuple(ranking.summary(df, "v").first()) == (5.0, 0.0)
    assert tuple(ranking.summary(df.filter("v > 9"), "v").first()) == (None, None)


def test_condition_in_on_keeps_unmatched_rows(spark):
    left = spark.createDataFrame([(2012, 1.0), (2013, 2.0)], "year int, value double")
    right = spark.createDataFrame([(2013, "US", 5), (2012, "XX", 6)], "year int, nation string, p int")
    got = joins.left_join_where(left, right, "year", right["nation"] == "US").select("year", "value", "p")
    assert rows(got) == [(2012, 1.0, None), (2013, 2.0, 5)]


def test_lookup_drops_its_lineage(spark):
    left = spark.createDataFrame([("a", 1)], "k string, _metadata int")
    right = spark.createDataFrame([("a", 2, 3)], "k string, _metadata int, v int")
    assert rows(joins.lookup(left, right, "k")) == [("a", 1, 3)]


def test_anti_and_semi_with_repeated_keys(spark):
    left = spark.createDataFrame([(1, 1), (1, 1), (2, 2)], "k int, v int")
    right = spark.createDataFrame([(1, 1)] * 50, "k int, v int")
    assert rows(joins.missing_rows(left, right, ["k", "v"])) == [(2, 2)]
    assert rows(joins.available_rows(left, right, "k")) == [(1, 1), (1, 1)]


def test_expectations(spark):
    df = spark.createDataFrame([(1, "a"), (None, "b"), (3, None), (None, None)], "x int, y string")
    rules = (*not_null("x", "y"), Expectation("small", "x < 2"))
    assert rows(enforce(df, rules)) == [(1, "a")]
    assert rows(report(df, rules)) == [("small", 1, 3), ("valid_x", 2, 2), ("valid_y", 2, 2)]


def test_table_checks(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", None), (None, -2.0)], "k string, v double")
    verdicts = table_checks(
        df,
        [
            row_count_is("three", 3), row_count_is("one", 1), not_empty("filled"), unique_key("unique", "k"),
            no_row("present", F.col("k").isNull()), every_row("positive", F.col("v") > 0),
        ],
    )
    assert {r["check"]: (r["passed"], r["violations"]) for r in verdicts.collect()} == {
        "three": (True, 0), "one": (False, 2), "filled": (True, 0), "unique": (False, 2),
        "present": (False, 1), "positive": (False, 2),
    }
    empty = table_checks(df.limit(0), [not_empty("filled"), row_count_is("none", 0)]).collect()
    assert [(r["passed"], r["violations"]) for r in empty] == [(False, 1), (True, 0)]


def test_recomputed_value_and_counts(spark):
    result = spark.createDataFrame([("a", 1.0), ("b", 2.0), ("c", None)], "k string, v double")
    again = spark.createDataFrame([("a", 1.0 + 1e-9), ("b", 3.0), ("c", 1.0)], "k string, e double")
    verdict = selected_is_max("m", result, again, "k", "v", "e", 1e-6).first()
    assert (verdict["passed"], verdict["violations"]) == (False, 2)
    assert same_row_count("n", result, again).first()["passed"]
    assert same_row_count("n", result, again.limit(1)).first()["violations"] == 2


def test_duplicate_rates(spark):
    data = hot_rows()
    df = spark.createDataFrame(data, "k string, v int, o int").repartition(8)
    row = profile.duplicate_rates(df, ["k"], "v").first()
    copies = Counter(k for k, _, _ in data)
    values = defaultdict(set)
    for k, v, _ in data:
        values[k].add(v)
    assert tuple(row) == (
        len(data), len(copies), len(data) - len(copies), sum(len(v) > 1 for v in values.values())
    )
    assert tuple(profile.duplicate_rates(df.limit(0), ["k"], "v").first()) == (0, 0, 0, 0)


def test_null_rates_and_anomalies(spark):
    data = [("d1", None), ("d1", 1), ("d2", 1), ("d2", 1)]
    rates = profile.null_rates(spark.createDataFrame(data, "b string, v int"), "b", ["v"])
    assert rows(rates) == [("d1", "v", 0.5, None), ("d2", "v", 0.0, -0.5)]
    counts = [("s", day) for day, n in enumerate([10, 12, 11, 50]) for _ in range(n)]
    judged = profile.count_anomalies(spark.createDataFrame(counts, "s string, d int"), "s", "d")
    assert [r["anomalous"] for r in judged.orderBy("batch").collect()] == [None, None, False, True]


def test_schema_differences(spark):
    contract = spark.createDataFrame([], "a int, b string, c double").schema
    found = spark.createDataFrame([], "a bigint, c double, d int").schema
    assert profile.schema_differences(contract, found) == [
        ("a", "retyped"), ("b", "missing"), ("d", "unexpected"),
    ]


def test_json_drift(spark):
    docs = [('{"a": 1, "b": "x"}',), ('{"a": "y"}',), ("broken",), (None,)]
    got = profile.json_drift(spark.createDataFrame(docs, "j string"), "j", {"a": "BIGINT", "c": "STRING"})
    assert rows(got) == sorted(
        [
            ("a", "BIGINT", 1, None), ("a", "STRING", 1, "retyped"),
            ("b", "STRING", 1, "unexpected"), ("c", None, 0, "missing"),
        ],
        key=repr,
    )


DEEP = '{"a":' * 9 + "[1, 1, \"x\"]" + "}" * 9
NESTED = [
    '{"a": [{"b": 1}, {"b": 2}, {"b": "x"}], "c": {}, "e": []}',
    '{"a": [1, 1, "x", null, [1], [1, "y"]]}',
    '{"a.b": {"c": 1}, "a": {"b.c": 1}}',
    '{"": {"a.b": 1}, "a": {"b": 1}}',
    "5", "{bad", "", None, "[]", "[[1], [2]]", DEEP, DEEP,
]


def plain_drift(documents):
    """Documents by depth, path and type."""
    kinds, found = {dict: "OBJECT", list: "ARRAY", int: "BIGINT", str: "STRING", type(None): "VOID"}, Counter()
    for text in documents:
        try:
            level, depth, seen = [("", json.loads(text or "{"))], 0, set()
        except ValueError:
            continue
        while level:
            fields = [(f"{path}.{k}" if path else k, v) for path, value in level if isinstance(value, dict) for k, v in value.items()]
            level = fields + [(f"{path}[]", v) for path, value in level if isinstance(value, list) for v in value]
            depth += 1
            seen |= {(depth, path, kinds[type(v)]) for path, v in level}
        found.update(seen)
    return Counter((path, kind, n) for (_, path, kind), n in found.items())


@pytest.mark.parametrize("documents, passes", [(NESTED[:-2], 0), (NESTED, 2)])
def test_nested_drift_counts_in_one_pass(spark, monkeypatch, documents, passes):
    """Values are stored only where they are nested deeper than one pass opens, and all paths count documents."""
    kept = []
    monkeypatch.setattr(profile, "stored", lambda df, label: kept.append(label) or stored(df, label))
    table = spark.createDataFrame([(d,) for d in documents], "document string").repartition(3)
    drift = profile.nested_drift(table, "document", {"a": "ARRAY", "z": "STRING"}).collect()
    assert Counter((r["path"], r["found_type"], r["rows"]) for r in drift if r["rows"]) == plain_drift(documents)
    assert [(r["path"], r["problem"]) for r in drift if not r["rows"]] == [("z", "missing")]
    assert kept.count("drift-level") == passes
