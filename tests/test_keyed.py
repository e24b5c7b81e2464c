"""Tables kept by key: replays, restarts, what is read, and totals and states that are brought up to date."""

import os
import subprocess
import sys
import textwrap

import pytest
from conftest import ROOT, rows
from pyspark.sql import functions as F

from tierloom.operators.expectations import Expectation, not_null
from tierloom.operators.states import batch_states, dataset_summary, united
from tierloom.operators.versions import validity
from tierloom.plans.incremental import added_up, partial_totals, refresh_totals
from tierloom.streaming.keyed import AddedTable, MergedTable, first_arrival_stream, follow, newest, upsert_stream, without_removed
from tierloom.streaming.runs import finish

CHANGES = "k long, v string, seq long, removed boolean"


def land(spark, folder, changes, schema=CHANGES):
    spark.createDataFrame(changes, schema).coalesce(1).write.mode("append").parquet(folder)


def stream(spark, folder, schema=CHANGES):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)


def test_corrections_out_of_order_and_removals(spark, tmp_path):
    table = MergedTable(spark, str(tmp_path / "t"), ["k"], 4)
    landed, checkpoint = str(tmp_path / "in"), str(tmp_path / "c")
    for changes in (
        [(1, "a", 1, False), (2, "b", 1, False), (1, "a2", 2, False), (None, "n", 1, None)],
        [(2, None, 5, True), (3, "c", 1, False)],
        [(2, "late", 3, False), (1, "old", 0, False), (3, "c9", 9, False)],
    ):
        land(spark, landed, changes)
        finish([upsert_stream(stream(spark, landed), checkpoint, table, "seq")])
    now = rows(without_removed(table.read(), "removed"), "k", "v", "seq")
    assert now == [(1, "a2", 2), (3, "c9", 9), (None, "n", 1)]
    # A key that was removed comes back with a later row only.
    land(spark, landed, [(2, "again", 6, False)])
    finish([upsert_stream(stream(spark, landed), checkpoint, table, "seq")])
    assert (2, "again", 6) in rows(without_removed(table.read(), "removed"), "k", "v", "seq")


def test_a_batch_that_is_run_again_changes_nothing(spark, tmp_path):
    table = MergedTable(spark, str(tmp_path / "t"), ["k"], 4)
    total = lambda df: df.groupBy("k").agg(F.sum("n").alias("n"))
    part = spark.createDataFrame([(1, 2), (1, 3), (2, 4)], "k long, n long")
    assert table.merge(part, "s", 0, total) and not table.merge(part, "s", 0, total)
    assert table.merge(part, "s", 1, total) and table.merge(part, "other", 1, total)
    assert rows(table.read()) == [(1, 15), (2, 12)]


def test_leftovers_of_a_failed_batch_are_never_read(spark, tmp_path, monkeypatch):
    """The rows are written, the commit is not: readers see the state before, and the next attempt gives the right one."""
    kinds = (MergedTable, lambda t, part, b: t.merge(part, "s", b, newest(["k"], "n"))), (AddedTable, lambda t, part, b: t.insert_new(part, "s", b))
    for kind, apply in kinds:
        table = kind(spark, str(tmp_path / kind.__name__), ["k"], 4)
        first = spark.createDataFrame([(1, 1)], "k long, n long")
        second = spark.createDataFrame([(2, 2), (1, 9)], "k long, n long")
        apply(table, first, 0)
        with monkeypatch.context() as patch, pytest.raises(RuntimeError):
            patch.setattr(kind, "_commit", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
            apply(table, second, 1)
        assert rows(table.read()) == [(1, 1)]
        apply(table, second, 1)
        assert rows(table.read()) == ([(1, 9), (2, 2)] if kind is MergedTable else [(1, 1), (2, 2)])


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_only_touched_buckets_are_read_and_rewritten(spark, tmp_path):
    table = MergedTable(spark, str(tmp_path / "t"), ["k"], 16)
    keep = newest(["k"], "n")
    table.merge(spark.range(200).selectExpr("id AS k", "0 AS n"), "s", 0, keep)
    table.merge(spark.createDataFrame([(5, 1)], "k long, n int"), "s", 1, keep)
    first, second = table.commits()
    changed = [b for b in first.live if first.live[b] != second.live[b]]
    assert len(first.live) == 16 and len(changed) == 1
    written = os.listdir(tmp_path / "t" / "rows" / "_v=2")
    assert [name for name in written if name.startswith("_bucket")] == [f"_bucket={changed[0]}"]
    assert table.read(changed).inputFiles() and all(f"_bucket={changed[0]}/" in f for f in table.read(changed).inputFiles())
    # Versions that neither of the last two commits shows are gone.
    table.merge(spark.range(200).selectExpr("id AS k", "2 AS n"), "s", 2, keep)
    table.merge(spark.range(200).selectExpr("id AS k", "3 AS n"), "s", 3, keep)
    assert sorted(os.listdir(tmp_path / "t" / "rows")) == ["_v=3", "_v=4"]
    assert table.read().filter("n = 3").count() == 200


def test_known_keys_are_found_without_shuffling_the_table(spark, tmp_path):
    table = AddedTable(spark, str(tmp_path / "t"), ["k"], 4)
    table.insert_new(spark.range(1000).selectExpr("id AS k", "repeat('x', 50) AS v"), "s", 0)
    batch = spark.createDataFrame([(1, "a"), (None, "b"), (5000, "c")], "k long, v string")
    fresh = table.unseen(batch.withColumn("_bucket", table.bucket()))
    assert rows(fresh, "k") == [(5000,), (None,)]
    text = plan(fresh)
    known = [line for line in text.splitlines() if "FileScan" in line]
    # Of the table only the keys are read, and only buckets of the batch.
    assert len(known) == 1 and "ReadSchema: struct<k:bigint>" in known[0] and "_bucket" in known[0]
    assert text.index("LeftSemi") < text.index("FileScan") and "Exchange hashpartitioning(k" not in text[text.index("LeftSemi") : text.index("FileScan")]
    table.insert_new(batch, "s", 1)
    table.insert_new(batch, "s", 2)
    assert table.read().count() == 1002


def test_counts_are_committed_with_the_rows(spark, tmp_path):
    rules = (*not_null("v"), Expectation("small", "k < 100"))
    table = AddedTable(spark, str(tmp_path / "t"), ["k"], 4)
    landed, checkpoint = str(tmp_path / "in"), str(tmp_path / "c")
    for part in ([(1, "a", 1, None), (1, "b", 1, None), (2, None, 1, None)], [(200, None, 1, None), (3, "c", 1, None)]):
        land(spark, landed, part)
        finish([first_arrival_stream(stream(spark, landed), checkpoint, table, rules)])
    assert rows(table.report(rules)) == [("small", 4, 1), ("valid_v", 3, 2)]
    assert rows(table.report(rules, after=1)) == [("small", 1, 1), ("valid_v", 1, 1)]
    assert rows(table.read(), "k") == [(1,), (3,)]


def test_counts_outlive_a_driver_that_is_killed(spark, tmp_path):
    """A process ends itself right after the commit of its second batch, before the stream notes that batch."""
    landed = str(tmp_path / "in")
    for i in range(4):
        land(spark, landed, [(i, "a" if i % 2 else None, i, False), (i + 10, "b", i, False)])
    script = textwrap.dedent(
        f"""
        import os, sys
        sys.path.insert(0, {str(ROOT)!r})
        from pyspark.sql import SparkSession
        from tierloom.operators.expectations import not_null
        from tierloom.streaming import keyed
        from tierloom.streaming.runs import finish
        spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
                 .config("spark.sql.shuffle.partitions", "2").config("spark.checkpoint.dir", {str(tmp_path / "shared")!r}).getOrCreate())
        table = keyed.AddedTable(spark, {str(tmp_path / "t")!r}, ["k"], 2)
        commit = table._commit
        def committed(entry):
            commit(entry)
            if entry.batch == 1:
                os._exit(9)
        table._commit = committed
        stream = spark.readStream.schema({CHANGES!r}).option("maxFilesPerTrigger", 1).parquet({landed!r})
        finish([keyed.first_arrival_stream(stream, {str(tmp_path / "c")!r}, table, not_null("v"))])
        """
    )
    done = subprocess.run([sys.executable, "-c", script], capture_output=True, timeout=300)
    assert done.returncode == 9, done.stderr.decode()[-2000:]
    table = AddedTable(spark, str(tmp_path / "t"), ["k"], 2)
    assert [c.batch for c in table.commits()] == [0, 1]
    finish([first_arrival_stream(stream(spark, landed), str(tmp_path / "c"), table, not_null("v"))])
    assert [c.batch for c in table.commits()] == [0, 1, 2, 3]
    assert rows(table.report(not_null("v"))) == [("valid_v", 6, 2)]
    assert table.read().count() == 6


def test_totals_read_only_what_silver_gained(spark, tmp_path):
    schema = "series_id string, year int, period string, value double"
    silver = AddedTable(spark, str(tmp_path / "s"), ["series_id", "year", "period"], 4)
    totals = MergedTable(spark, str(tmp_path / "t"), ["series_id", "year"], 4)
    assert not refresh_totals(silver, totals)
    parts = [[("a", 1, "Q01", 0.1), ("a", 1, "Q05", 9.0)], [("a", 1, "Q02", 0.2), ("b", 1, "Q01", None)], [("a", 2, "Q01", 0.7)]]
    for batch, part in enumerate(parts):
        silver.insert_new(spark.createDataFrame(part, schema), "in", batch)
        gained = silver.read(after=batch)
        assert all(f"_v={batch + 1}/" in path for path in gained.inputFiles())
        assert refresh_totals(silver, totals) and not refresh_totals(silver, totals)
    everything = added_up(partial_totals(silver.read()))
    assert rows(totals.read(), "series_id", "year", "units", "n") == rows(everything, "series_id", "year", "units", "n")
    assert ("a", 1, 30, 2) in rows(totals.read(), "series_id", "year", "units", "n")
    with pytest.raises(Exception, match="more than 2 decimals"):
        partial_totals(spark.createDataFrame([("a", 1, "Q01", 0.123)], schema)).collect()


def test_a_changed_type_is_refused_and_a_new_column_is_added(spark, tmp_path):
    table = AddedTable(spark, str(tmp_path / "t"), ["k"], 2)
    table.insert_new(spark.createDataFrame([(1,)], "k long"), "s", 0)
    table.insert_new(spark.createDataFrame([(2, "x")], "k long, more string"), "s", 1)
    assert rows(table.read()) == [(1, None), (2, "x")]
    with pytest.raises(ValueError, match="more"):
        table.insert_new(spark.createDataFrame([(3, 4)], "k long, more int"), "s", 2)


def test_states_are_exact_where_they_say_so(spark):
    lines = spark.createDataFrame([("a", d, i % 50, float(i) / 4 if i % 9 else None) for d in (1, 2) for i in range(400)], "s string, d int, k int, v double")
    parts = [batch_states(lines.filter(f"k % 2 = {half}"), "s", "d", ["k"], "v") for half in (0, 1)]
    whole, merged = batch_states(lines, "s", "d", ["k"], "v"), united(parts[0].unionByName(parts[1]))
    exact = ["dataset", "batch", "rows", "nulls", "units", "squares"]
    assert rows(whole, *exact) == rows(merged, *exact)
    found = dataset_summary(merged).first()
    want = lines.agg(F.avg("v").alias("m"), F.stddev_pop("v").alias("d")).first()
    assert (found["rows"], found["distinct_keys"]) == (800, 50)
    assert found["mean"] == pytest.approx(want["m"]) and found["deviation"] == pytest.approx(want["d"])
    assert dataset_summary(merged.limit(0)).collect() == []


def test_validity_of_rare_cases(spark):
    history = [(1, "x", None), (1, "x", "a"), (2, "x", "a"), (4, "x", "a"), (1, None, "n"), (2, None, "n"), (3, "y", None), (4, "y", None)]
    table = spark.createDataFrame(history, "at int, k string, v string").unionByName(spark.createDataFrame([(3, "z", "q")], "at int, k string, v string"))
    assert rows(validity(table, ["k"], ["v"], "at")) == sorted(
        [("x", "a", 1, 3), ("x", "a", 4, None), (None, "n", 1, 3), ("y", None, 3, None), ("z", "q", 3, 4)], key=repr
    )
    assert validity(table.limit(0), ["k"], ["v"], "at").collect() == []


def test_small_versions_are_put_together(spark, tmp_path):
    table = AddedTable(spark, str(tmp_path / "t"), ["k"], 2)
    totals = MergedTable(spark, str(tmp_path / "n"), ["p"], 2)

    def take(gained, source, version):
        counted = gained.groupBy((F.col("k") % 2).alias("p")).agg(F.count(F.lit(1)).alias("n"))
        totals.merge(counted, source, version, lambda df: df.groupBy("p").agg(F.sum("n").alias("n")))

    def add(batch):
        table.insert_new(spark.range(batch * 5, batch * 5 + 10).selectExpr("id AS k", f"{batch} AS b"), "in", batch)

    for batch in range(4):
        add(batch)
    follow(table, totals, take)
    before = rows(table.read())
    assert table.compact(taken=3) and not table.compact(taken=3)
    assert rows(table.read()) == before and len({f.split("/rows/")[1].split("/")[0] for f in table.read().inputFiles()}) == 2
    assert rows(table.read(after=3)) == [r for r in before if r[1] == 3]
    # Nothing new to follow, no key comes twice, and reports still count every batch.
    assert not follow(table, totals, take)
    add(4)
    add(5)
    assert follow(table, totals, take) and not follow(table, totals, take)
    assert rows(totals.read(), "p", "n") == [(0, 18), (1, 17)]
    assert rows(table.read(), "k") == [(k,) for k in sorted(range(35), key=lambda k: repr((k,)))]
    assert rows(table.report(not_null("b"))) == [("valid_b", 60, 0)]
    # The second compaction removes what the first one covered; who is still there is told.
    assert table.compact(taken=7) and rows(table.read(), "k") == [(k,) for k in sorted(range(35), key=lambda k: repr((k,)))]
    assert sorted(os.listdir(tmp_path / "t" / "rows")) == ["_v=4", "_v=5", "_v=6", "_v=7", "_v=8"]
    assert table.read(after=6).count() == 5
    with pytest.raises(ValueError, match="together"):
        table.read(after=1)
