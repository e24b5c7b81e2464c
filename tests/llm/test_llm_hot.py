"""Hot keys: many equal rows, low weights, large benchmarks. Results stay whole, and no task gets a hot group."""

import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tierloom.llm import common, mixing, sharding


def equal_rows(spark, n, text="same text here", extra=0):
    hot = spark.range(n).select(F.lit(7).cast("long").alias("doc_id"), F.lit(text).alias("text"), F.lit("a").alias("source"))
    others = spark.range(extra).select(
        (F.col("id") + 100).alias("doc_id"), F.concat(F.lit("text no "), F.col("id").cast("string")).alias("text"),
        F.when(F.col("id") % 2 == 0, "a").otherwise("b").alias("source"),
    )
    return hot.unionByName(others).repartition(8)


def captured(monkeypatch, module):
    tables = {}
    write = module.stored

    def stored(df, label):
        tables[label] = write(df, label)
        return tables[label]

    monkeypatch.setattr(module, "stored", stored)
    return tables


def shards_are_even(rows, total, shards=40):
    counts = Counter(shard for shard, _ in rows)
    assert sum(counts.values()) == total and max(counts.values()) - min(counts.get(s, 0) for s in range(shards)) <= 1
    assert len(set(rows)) == total and all(slot < counts[shard] for shard, slot in rows)


def test_equal_rows_are_numbered_as_one(spark, monkeypatch):
    tables = captured(monkeypatch, sharding)
    docs = equal_rows(spark, 100_000, extra=50)
    report = sharding.shard_documents(docs)
    rows = report.collect()
    assert tables["shard-numbers"].count() == 51
    shards_are_even([(r["shard"], r["slot"]) for r in rows], 100_050)
    # Those that stand for more than AT_ONCE rows are told apart in parts, by several tasks.
    monkeypatch.setattr(sharding, "AT_ONCE", 1000)
    told = sharding.spread(tables["shard-numbers"], "n", "again")
    per_task = told.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
    assert told.count() == 100_050 and per_task < 90_000


def test_texts_of_equal_rows_keep_a_slot_each(spark, monkeypatch):
    monkeypatch.setattr(sharding, "SORTED", 16)
    docs = equal_rows(spark, 5000, extra=30).withColumn("extra", F.monotonically_increasing_id())
    twice = docs.unionByName(docs.filter("doc_id > 100"))
    placed = sharding.with_places(twice).collect()
    shards_are_even([(r["shard"], r["slot"]) for r in placed], 5000 + 30 + 29)
    assert Counter(r["extra"] for r in placed) == Counter(r["extra"] for r in twice.collect())


def test_running_numbers_have_no_gaps(spark):
    rows = spark.range(3000).select((F.col("id") % 2).alias("k"), F.col("id").alias("part")).repartition(7)
    told = common.turns(rows, ["k"], "turn", "turns").collect()
    for key in (0, 1):
        assert sorted(r["turn"] for r in told if r["k"] == key) == list(range(1500))
    assert {r["part"] for r in told} == set(range(3000))


def test_checksums(spark):
    texts = ["", None, "abc", "Grüße 😀", "x" * 100_000]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r["doc_id"]: (r["text_crc32"], r["size"]) for r in sharding.shard_documents(docs).collect()}
    assert found == {i: (zlib.crc32((t or "").encode()), len((t or "").encode()) + 16) for i, t in enumerate(texts)}


def targets_are_met(rows, source_of):
    for source in set(source_of.values()):
        mine = [r for r in rows if source_of[r["doc_id"]] == source]
        assert abs(sum(r["taken"] for r in mine) - mine[0]["target"]) <= max(r["size"] for r in mine) / 2 + 1


def test_low_weights_and_small_edges(spark, monkeypatch):
    """Digits have the least weight, so almost all keys lie beyond the even ranges; the edge is divided until it is small."""
    docs = spark.range(20_000).select(
        F.col("id").alias("doc_id"), F.concat_ws(" ", F.lit("12 34 56"), F.col("id").cast("string")).alias("text"),
        F.when(F.col("id") % 3 == 0, "a").when(F.col("id") % 3 == 1, "b").otherwise("c").alias("source"),
    )
    tables = captured(monkeypatch, mixing)
    usual = {tuple(r) for r in mixing.mix_documents(docs).collect()}
    monkeypatch.setattr(mixing, "EDGE_ROWS", 32)
    rows = mixing.mix_documents(docs).collect()
    assert {tuple(r) for r in rows} == usual
    assert max(r["rows"] for r in tables["mix-edges"].collect()) <= 32
    targets_are_met(rows, {r["doc_id"]: r["source"] for r in rows})


@pytest.mark.parametrize("copies", [30, 100_000])
def test_of_equal_rows_as_many_are_taken_as_fit(spark, copies):
    docs = equal_rows(spark, copies, extra=400).withColumn("extra", F.monotonically_increasing_id())
    rows = mixing.mix_documents(docs).collect()
    assert len(rows) == copies + 400
    targets_are_met(rows, {r["doc_id"]: r["source"] for r in rows})
    hot = Counter(r["copies"] for r in rows if r["doc_id"] == 7)
    assert len(hot) <= 2 and max(hot) - min(hot) <= 1
    taken = mixing.take(docs)
    want = Counter()
    for r in rows:
        want[r["doc_id"]] += r["copies"]
    assert Counter(r["doc_id"] for r in taken.select("doc_id").collect()) == +want


def test_quality_as_the_weight(spark):
    docs = spark.range(2000).select(
        F.col("id").alias("doc_id"), F.concat_ws(" ", F.lit("some words of"), F.col("id").cast("string")).alias("text"),
        F.when(F.col("id") % 2 == 0, "a").otherwise("b").alias("source"), F.when(F.col("id") % 4 < 2, 0.1).otherwise(1.0).alias("quality"),
    )
    rows = mixing.mix_documents(docs, weights=(1, 3), weight="quality").collect()
    chosen = Counter((r["doc_id"] % 4 < 2) for r in rows if r["source"] == "a" and r["copies"])
    assert chosen[False] > 2 * chosen[True] > 0

