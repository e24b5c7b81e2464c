"""Physical plans: what is read, what is shuffled, and what is never done."""

import re

import pytest
from conftest import DATA

from tierloom.operators import joins
from tierloom.operators.versions import touched_partitions
from tierloom.plans import gold, sql
from tierloom.workspace import settings
from workloads import inputs, streams
from workloads.registry import QUERIES


def batch_names():
    import workloads.batch as batch

    own = {function for function in vars(batch).values() if callable(function)}
    return [name for name, function in QUERIES.items() if function in own]


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def silver(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("silver")
    sources = {
        "observations": inputs.observations,
        "series": inputs.series,
        "measures": inputs.measures,
        "sectors": inputs.sectors,
        "population": inputs.population,
    }
    tables = {}
    for name, source in sources.items():
        source(spark, DATA).write.parquet(str(base / name))
        tables[name] = spark.read.parquet(str(base / name))
    return tables


def test_filters_and_columns_reach_the_scan(silver):
    text = plan(gold.population_stats(silver["population"], "NATION_7", 1996, 1998))
    assert "EqualTo(nation,NATION_7)" in text and "GreaterThanOrEqual(year,1996)" in text
    assert "ReadSchema: struct<nation:string,year:int,population:bigint>" in text
    text = plan(gold.series_population(silver["observations"], silver["population"], "7", "Q01", "NATION_7"))
    assert "EqualTo(series_id,7)" in text and "EqualTo(period,Q01)" in text
    assert "EqualTo(nation,NATION_7)" in text


def test_constant_in_on_reaches_the_right_scan(spark, silver):
    text = plan(sql.series_population(spark, silver["observations"], silver["population"], "7", "Q01", "NATION_7"))
    assert "EqualTo(nation,NATION_7)" in text and "LeftOuter" in text


def test_lines_are_scanned_once_and_a_series_is_chosen_in_the_scan(spark):
    for name in ("metric_with_reference", "gold_best_year", "gold_series_reference"):
        text = plan(QUERIES[name](spark, DATA))
        assert text.count("l_extendedprice") and len(re.findall(r"FileScan parquet \[l_suppkey[^\n]*lineitem", text)) == 1
    assert "(cast(l_suppkey" in text and "= 7)]" in text


def test_best_year_plan(silver):
    best = gold.best_year_by_series(
        silver["observations"], silver["series"], silver["measures"], silver["sectors"], scale=2
    )
    text = plan(best)
    assert text.count("WindowGroupLimit") == 2, "groups are cut before and after the shuffle"
    assert "partial_try_sum" in text or "partial_sum" in text
    assert re.search(r"PushedFilters: \[In\(period", text)
    assert "Cartesian" not in text and "NestedLoop" not in text


def test_lookups_are_not_broadcast_without_a_size_check(spark, silver):
    with settings(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        labels = gold.series_labels(silver["series"], silver["measures"], silver["sectors"])
        assert "Broadcast" not in plan(labels) and plan(labels).count("SortMergeJoin") == 2
        joined = joins.missing_rows(silver["observations"], silver["observations"], ["series_id", "year"])
        text = plan(joined)
        assert "Broadcast" not in text and text.count("Exchange hashpartitioning") == 2


def test_metric_beside_population_shuffles_no_observation(silver):
    text = plan(gold.metric_with_population(silver["observations"], silver["population"], "NATION_7"))
    assert "BroadcastHashJoin" in text and "Exchange hashpartitioning" not in text


def test_no_row_is_multiplied_before_an_aggregate(spark):
    for name in ("gold_best_year", "gold_best_year_sql", "row_number_rank", "check_table_rules"):
        assert "Expand" not in plan(QUERIES[name](spark, DATA))


def test_one_series_is_chosen_before_anything_is_added_up(spark):
    """Nothing is written to read one series: its filter reaches the scan of the lines, below the aggregates."""
    for name in ("gold_series_reference", "gold_series_reference_sql"):
        assert re.search(r"cast\(l_suppkey#\d+L? as string\) = 7\)\], Format", plan(QUERIES[name](spark, DATA)))


def test_sql_ranking_cuts_groups_before_the_shuffle(spark):
    assert plan(QUERIES["gold_best_year_sql"](spark, DATA)).count("WindowGroupLimit") == 2


@pytest.mark.parametrize("name", ["stream_dedup_key", "silver_observations", "silver_population"])
def test_streams_shuffle_once_and_keep_their_state_by_key(spark, name, monkeypatch):
    """Plans of the stateful streams: one exchange by the key below the state, copies thinned before it."""
    seen = []
    original = streams.append_all

    def watched(df, *args, **options):
        query = original(df, *args, **options)
        seen.append(query._jsq.explainInternal(False))
        return query

    monkeypatch.setattr(streams, "append_all", watched)
    QUERIES[name](spark, DATA)
    stateful = [text for text in seen if "StreamingDeduplicate" in text]
    assert stateful
    for text in stateful:
        assert text.count("Exchange ") == 1 and "Exchange hashpartitioning" in text
        assert text.index("StreamingDeduplicate") < text.index("Exchange ") < text.index("ArrowEvalPython")


def test_upserts_prune_partitions(spark, tmp_path):
    folder = str(tmp_path / "t")
    rows = spark.createDataFrame([(i, i % 3, 0) for i in range(9)], "k int, y int, s int")
    rows.write.partitionBy("y").parquet(folder)
    changes = spark.read.parquet(folder).filter("k in (1, 4)").select("k", "y", "s")
    changes.write.parquet(str(tmp_path / "c"))
    text = plan(touched_partitions(spark.read.parquet(folder), spark.read.parquet(str(tmp_path / "c")), ["y"]))
    assert "dynamicpruning" in text and "(y#" in text


def test_forms_agree(spark, silver):
    tables = [silver[name] for name in ("observations", "series", "measures", "sectors")]
    pairs = [
        (gold.best_year_by_series(*tables, scale=2), sql.best_year_by_series(spark, *tables, scale=2)),
        (
            gold.series_population(silver["observations"], silver["population"], "7", "Q01", "NATION_7"),
            sql.series_population(spark, silver["observations"], silver["population"], "7", "Q01", "NATION_7"),
        ),
        (
            gold.population_stats(silver["population"], "NATION_7", 1996, 1998),
            sql.population_stats(spark, silver["population"], "NATION_7", 1996, 1998),
        ),
    ]
    for left, right in pairs:
        assert left.dtypes == right.dtypes
        assert left.exceptAll(right).isEmpty() and right.exceptAll(left).isEmpty()


@pytest.mark.parametrize("name", sorted(batch_names()))
def test_no_query_has_a_plan_that_cannot_scale(spark, name):
    text = plan(QUERIES[name](spark, DATA))
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "EvalPython", "MapInArrow"):
        assert node not in text
    lines = text.splitlines()
    for position, line in enumerate(lines):
        if "Window [" in line:
            exchange = next(below for below in lines[position:] if "Exchange " in below)
            assert "hashpartitioning" in exchange, "a window never runs over all rows in one task"
