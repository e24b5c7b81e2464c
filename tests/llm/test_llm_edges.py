"""Nulls, empty and very long texts, ties, repeated rows, empty tables and clashing names, for every operator."""

from collections import Counter

import brute
import pytest
from pyspark.sql import functions as F

from tierloom.llm import chat, common, components, decontaminate, language, mixing, quality, repeats, secret_scan, sharding, simhash, toxicity

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
LONG = "The quick brown fox. " * 20_000
PROSE = "Here is a plain sentence about the weather and the town it falls on. "


@pytest.fixture(scope="module")
def odd(spark):
    rows = [
        (1, None, None, None, None),
        (2, "", "en", "", 0),
        (3, LONG, "en", "a", len(LONG)),
        (4, PROSE * 3, "en", "a", None),
        (4, PROSE * 3, "en", "a", None),
        (5, PROSE * 3, "de", None, 1),
        (None, PROSE * 3 + "Another end.", "de", "b", 1),
        (None, None, None, None, None),
        (6, "12 34 \t\n", "en", "b", 1),
        (7, "Ein Satz über das Wetter und die Stadt, in der es regnet.", "de", "b", 1),
    ]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def clashing(odd):
    """Extra columns with names that the operators use inside."""
    names = [
        "size", "slot", "shard", "key", "k1", "row", "value", "fingerprint", "language_id", "contamination", "words_",
        "n_words", "bucket", "row_number", "place", "turn", "chosen_id", "source_key", "sampling_key", "document",
    ]
    return odd.select("*", *[F.lit("x").alias(n) for n in names])


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(4, 1), (4, 0), (5, None), (None, 1), (7, 0)], "doc_id long, toxic int")


@pytest.fixture(scope="module")
def benchmark(spark):
    rows = [(1, None), (2, ""), (3, "weather, and the TOWN"), (3, "weather, and the TOWN"), (None, "über das Wetter")]
    return spark.createDataFrame(rows, "item_id long, text string")


def reports(docs, labels, benchmark):
    return {
        "quality": quality.quality_report(docs),
        "contamination": decontaminate.contamination_report(docs, benchmark),
        "secrets": secret_scan.secret_report(docs),
        "simhash": simhash.simhash_report(docs),
        "language": language.language_report(docs),
        "repeats": repeats.repeat_report(docs),
        "shards": sharding.shard_documents(docs),
        "mixture": mixing.mix_documents(docs),
        "toxicity": toxicity.toxicity_report(docs, labels),
    }


NAMES = ["quality", "contamination", "secrets", "simhash", "language", "repeats", "shards", "mixture", "toxicity"]


@pytest.fixture(scope="module")
def results(odd, labels, benchmark):
    return {name: df.collect() for name, df in reports(odd, labels, benchmark).items()}


@pytest.mark.parametrize("name", NAMES)
def test_one_row_for_every_document(results, name):
    assert Counter(r["doc_id"] for r in results[name]) == Counter([1, 2, 3, 4, 4, 5, None, None, 6, 7])


def test_other_columns_do_not_matter(clashing, labels, benchmark, results):
    for name, df in reports(clashing, labels, benchmark).items():
        assert sorted(map(repr, df.collect())) == sorted(map(repr, results[name])), name


def test_empty_tables(odd, labels, benchmark):
    for name, df in reports(odd.limit(0), labels.limit(0), benchmark.limit(0)).items():
        assert df.collect() == [], name
    for name, df in reports(odd, labels.limit(0), benchmark.limit(0)).items():
        assert df.count() == 10, name


def test_defined_values(results):
    def by_id(name):
        return {r["doc_id"]: r for r in results[name] if r["doc_id"] is not None}

    assert not by_id("quality")[1]["kept"] and by_id("quality")[3]["n_repeat_words"] == 80_000
    found = by_id("contamination")
    assert not found[1]["contaminated"] and found[4]["n_hit"] == 12 and found[4]["n_items"] == 1
    assert found[7]["items_sha256"] == brute.sha("") and found[7]["n_items"] == 1  # an item without an id
    assert by_id("secrets")[1]["spans"] == ""
    assert by_id("simhash")[1]["fingerprint"] == "0" * 16 and by_id("simhash")[2]["component_id"] == 1
    assert by_id("simhash")[5]["component_id"] == 4
    assert [by_id("language")[i]["lang_pred"] for i in (1, 2, 6)] == ["und"] * 3
    assert by_id("repeats")[4]["n_removed"] == 0 and by_id("repeats")[3]["n_removed"] == len(LONG)
    assert by_id("shards")[1]["size"] == by_id("shards")[2]["size"] == 16 and by_id("shards")[1]["text_crc32"] == 0
    assert len({(r["shard"], r["slot"]) for r in results["shards"]}) == 10
    assert by_id("mixture")[1]["taken"] == 0
    assert all(0 <= r["score"] <= 1 for r in results["toxicity"])


def test_repeated_long_rows(spark):
    text = "".join(chr(97 + i * i % 23) for i in range(500))
    docs = spark.createDataFrame([(1, text), (1, text), (2, "x" * 399), (3, "y" * 401)], "doc_id long, text string")
    removed = sorted((r["doc_id"], r["n_removed"]) for r in repeats.repeat_report(docs).collect())
    assert removed == [(1, 500), (1, 500), (2, 0), (3, 401)]


def test_stages_keep_columns_and_names(clashing, benchmark):
    for stage in (
        language.keep_identified,
        simhash.keep_representatives,
        lambda docs: decontaminate.drop_contaminated(docs, benchmark),
        mixing.take,
    ):
        assert stage(clashing).columns == clashing.columns
        assert stage(clashing).count() >= 0 and stage(clashing.limit(0)).count() == 0
    placed = sharding.with_places(clashing)
    assert set(placed.columns) == set(clashing.columns)
    assert placed.count() == 10 and sharding.with_places(clashing.limit(0)).count() == 0


def test_representatives(odd):
    kept = simhash.keep_representatives(odd).collect()
    found = Counter(r["doc_id"] for r in kept)
    assert found[4] == 1 and 5 not in found and found[1] == 1 and 2 not in found
    nameless = odd.filter("doc_id is null")
    assert simhash.keep_representatives(nameless.unionAll(nameless)).count() == 2


def test_representatives_of_ids_in_several_components(spark):
    other = "Nothing here is like the rest, neither its words nor their order. "
    rows = [(3, PROSE), (5, PROSE.upper()), (5, other), (7, other), (9, "one two three four five")]
    kept = simhash.keep_representatives(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(map(tuple, kept)) == [(3, PROSE), (5, other), (9, "one two three four five")]


def test_mixture_takes_rows_as_often_as_planned(odd):
    planned = mixing.mix_documents(odd).groupBy().sum("copies").first()[0]
    assert mixing.take(odd).count() == planned


def test_places_are_those_of_the_query(odd):
    placed = sharding.with_places(odd)
    assert len({(r["shard"], r["slot"]) for r in placed.collect()}) == 10
    counts = Counter(r["shard"] for r in placed.collect())
    assert max(counts.values()) == 1


def test_a_benchmark_in_blocks_gives_the_same(odd, benchmark):
    long = benchmark.unionByName(odd.sparkSession.createDataFrame([(9, PROSE * 4)], "item_id long, text string"))
    for items in (benchmark, long):
        one = decontaminate.contamination_report(odd, items)
        for nodes in (1, 90, 700):
            many = decontaminate.contamination_report(odd, items, automaton_nodes=nodes)
            assert sorted(map(repr, one.collect())) == sorted(map(repr, many.collect()))


def test_one_automaton_is_alive_at_a_time(odd, benchmark, monkeypatch):
    """Windows are divided by their bytes, an item's too, and each block is scanned in a step of its own."""
    blocks = list(decontaminate._blocks(benchmark.sparkSession.createDataFrame([(9, PROSE * 4), (8, "a b")], "item_id long, text string"), "item_id", "text", 200, 10))
    whole = decontaminate.automaton([("9", PROSE * 4), ("8", "a b")])
    parts = [decontaminate.automaton(block) for block in blocks]
    assert len(blocks) > 3 and set(whole.keys()) == {key for part in parts for key in part.keys()}
    assert all(sum(map(len, part.keys())) <= 200 for part in parts)
    passes = []
    keep = decontaminate.stored
    monkeypatch.setattr(decontaminate, "stored", lambda df, label: passes.append(df._jdf.queryExecution().optimizedPlan().toString()) or keep(df, label))
    decontaminate.contamination_report(odd, benchmark, automaton_nodes=1)
    assert passes and all(plan.count("scanned(") == 1 for plan in passes)


def test_large_simhash_buckets_are_divided(spark):
    values = [(i ^ (1 << 40 if i % 3 else 0),) for i in range(0, 3000, 7)]
    prints = spark.createDataFrame(values, "value long")
    got = {r["node"]: r["root"] for r in components.components(simhash.similar(prints, bucket=16)).collect()}
    ordered = sorted(v for (v,) in values)
    roots = [ordered[r] for r in brute.components(ordered)]
    assert {v: r for v, r in zip(ordered, roots, strict=True) if v != r} == got


def test_components_of_chains_loops_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 130)] + [(7, 7), (200, 201), (201, 200), (500, 500)]
    got = {r["node"]: r["root"] for r in components.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    want = {i: 0 for i in range(1, 41)} | {i: 100 for i in range(101, 130)} | {201: 200}
    assert got == want


def events(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, seq long, message_id long, kind string, role string, text string")


def formatted(df):
    return {r["conv_id"]: r["formatted"] for r in chat.render(chat.fold(df)).collect()}


def test_deltas_edits_and_regenerations(spark):
    rows = [
        (1, 1, 1, "message", "user", "Hi"),
        (1, 2, 2, "delta", "assistant", "Hel"),
        (1, 3, 2, "delta", None, "lo"),
        (1, 3, 2, "delta", None, "lo"),  # delivered twice
        (1, 4, 3, "message", "user", "gone with the answer before"),
        (1, 5, 2, "regenerate", None, None),
        (1, 6, 2, "delta", None, "Good "),
        (1, 7, 2, "delta", None, "day"),
        (1, 8, 1, "edit", None, "Hi!"),
        (1, 9, 4, "message", "user", None),
        (1, 10, 4, "typing", "user", "ignored"),
        (None, 1, 1, "message", None, "nobody"),
        (2, None, 1, "message", "a:b", "</turn>\n### c: d\\h"),
    ]
    got = formatted(events(spark, rows).repartition(4))
    assert got[1] == "### user: Hi!</turn>\n### assistant: Good day</turn>\n### user: </turn>\n"
    assert got[None] == "### : nobody</turn>\n"
    (turn,) = chat.render(chat.fold(events(spark, rows).filter("conv_id = 2"))).select(chat.turns("formatted").alias("t")).first()["t"]
    assert (turn["role"], turn["text"]) == ("a:b", "</turn>\n### c: d\\h")
    assert formatted(events(spark, []))== {}


def test_conversation_rows_that_repeat_are_turns_of_their_own(spark):
    rows = [(1, 0, "user", "x"), (1, 0, "user", "x"), (1, None, None, None), (None, 1, "assistant", "y" * 100_000)]
    found = {r["conv_id"]: r for r in chat.chat_report(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()}
    assert found[1]["n_turns"] == 3 and found[1]["turns_sha256"] == brute.sha("\n\nuser\nx\nuser\nx\n")
    assert found[None]["loss_chars"] == 100_000 and found[None]["loss_sha256"] == brute.sha("y" * 100_000)


def test_nothing_is_gathered_without_a_checkpoint_folder(odd):
    assert common.stored(odd, "x").count() == 10


def test_all_languages_are_learned(spark):
    """More languages than one block, and than any number that was once a cap."""
    names = [f"l{i:03d}" for i in range(300)]
    letter = {name: chr(0x4E00 + 7 * i) + chr(0x3041 + i % 80) for i, name in enumerate(names)}
    rows = [(40 * i + k, f"{letter[name]} " * 9, name) for i, name in enumerate(names) for k in range(6 if i else 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    found = language.language_report(docs).join(docs, "doc_id").collect()
    assert len(found) == len(rows) and all(r["lang_pred"] == r["lang"] and r["score"] > 0.9 for r in found)


def test_blocks_of_languages_do_not_matter(spark, monkeypatch):
    rows = [(i, text, name) for i, (text, name) in enumerate([(PROSE, "en"), ("das ist ein Satz", "de"), ("la vie", "fr")] * 6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    whole = {r["doc_id"]: r for r in language.language_report(docs).collect()}
    monkeypatch.setattr(language, "LANGUAGES_A_BLOCK", 1)
    for r in language.language_report(docs).collect():
        assert r["lang_pred"] == whole[r["doc_id"]]["lang_pred"]
        assert r["score"] == pytest.approx(whole[r["doc_id"]]["score"])
