"""The pipeline, stage by stage, against plain versions of what each stage decides."""

import os
from collections import Counter

import brute
import pytest
from conftest import DATA

import corpus_pipeline
from tierloom import workspace
from tierloom.llm import language
from tierloom.llm.common import read, stored
from tierloom.llm.queries import QUERIES


@pytest.fixture(scope="module")
def stages(spark):
    """Rows after every stage, the documents first."""
    docs = read(spark, DATA, "documents")
    out = {"documents": docs.collect()}
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, DATA), f"test-{name}")
        out[name] = docs.collect()
    return out


def ids(rows):
    return Counter(row["doc_id"] for row in rows)


def test_order_and_columns(stages):
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["language", "near_copies", "decontamination", "mixture", "shards"]
    columns = set(stages["documents"][0].asDict())
    assert all(set(stages[name][0].asDict()) == columns for name in names[:-1])
    assert set(stages["shards"][0].asDict()) == columns | {"shard", "slot"}


def test_rows_are_unchanged(stages):
    given = {row["doc_id"]: row.asDict() for row in stages["documents"]}
    for name in ("language", "near_copies", "decontamination", "mixture"):
        assert all(row.asDict() == given[row["doc_id"]] for row in stages[name])


def test_language(spark, stages):
    docs = spark.createDataFrame(stages["documents"])
    found = {row["doc_id"]: row for row in language.language_report(docs).collect()}
    want = Counter(i for i, row in found.items() if row["lang_pred"] != "und" and row["score"] >= 0.5)
    assert ids(stages["language"]) == want and len(want) >= 0.99 * len(found)


def test_near_copies(stages):
    rows = sorted(stages["language"], key=lambda row: row["doc_id"])
    roots = brute.components([brute.simhash(row["text"]) for row in rows])
    assert ids(stages["near_copies"]) == Counter(rows[root]["doc_id"] for root in set(roots))


def test_decontamination(spark, stages):
    items = [row["text"] for row in read(spark, DATA, "benchmark").collect()]
    clean = [row["doc_id"] for row in stages["near_copies"] if not brute.contaminated_words(row["text"], items)]
    assert ids(stages["decontamination"]) == Counter(clean)
    assert len(clean) < len(stages["near_copies"])


def test_mixture(stages):
    copies = brute.mixture([(row["doc_id"], row["text"], row["source"]) for row in stages["decontamination"]])
    assert ids(stages["mixture"]) == Counter({i: n for i, n in copies.items() if n})


def test_shards(stages):
    assert ids(stages["shards"]) == ids(stages["mixture"])
    counts = Counter(row["shard"] for row in stages["shards"])
    assert max(counts.values()) - min(counts.values()) <= 1
    places = {(row["shard"], row["slot"]) for row in stages["shards"]}
    assert places == {(shard, slot) for shard, n in counts.items() for slot in range(n)}


def test_run_gives_the_last_stage(spark, stages):
    found = corpus_pipeline.run(spark, DATA)
    assert found.columns == corpus_pipeline.run(spark, DATA).columns
    assert Counter(map(repr, found.select(sorted(found.columns)).collect())) == Counter(
        repr(row) for row in spark.createDataFrame(stages["shards"], found.schema).select(sorted(found.columns)).collect()
    )


def test_a_run_leaves_its_result_only(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(workspace, "shared_root", lambda spark: str(tmp_path))
    with workspace.scratch():
        result = corpus_pipeline.run(spark, DATA)
        left = os.listdir(tmp_path)
        assert [name.rsplit("-", 1)[0] for name in left] == ["pipeline-shards"] and result.count() > 0
    assert os.listdir(tmp_path) == []


@pytest.mark.parametrize("name", ["op1_quality", "op5_simhash", "op7_repeated_bytes", "op11_whitening", "op12_alignment"])
def test_nothing_is_left_of_a_query_whose_result_is_written(spark, tmp_path, monkeypatch, name):
    monkeypatch.setattr(workspace, "shared_root", lambda spark: str(tmp_path))
    with workspace.scratch():
        QUERIES[name](spark, DATA).write.format("noop").mode("overwrite").save()
        assert os.listdir(tmp_path)
    assert os.listdir(tmp_path) == []
