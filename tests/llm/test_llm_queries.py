"""The registered queries against their SQL, plain versions, or held-out labels."""

import math
import random
import string
import zlib
from collections import Counter

import brute
import oracle
import pytest
from conftest import DATA

import __spark_entry__ as contract
from tierloom.llm import language, quality, secret_scan, toxicity
from tierloom.llm.queries import ORACLES, QUERIES

LARGER = "/root/testdata/sf0.01"


def run(spark, number, folder=DATA):
    (name,) = [n for n in QUERIES if n.startswith(f"op{number}_")]
    return QUERIES[name](spark, folder)


@pytest.fixture(scope="module")
def texts(spark):
    rows = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text").collect()
    return {row["doc_id"]: row["text"] for row in rows}


def test_contract():
    assert {f"op{i}" for i in range(1, 14)} == {name.split("_")[0] for name in QUERIES}
    assert set(QUERIES) | {"pipeline"} <= set(contract.queries())
    assert set(ORACLES) <= set(contract.oracle_sql())


def rounded(rows: Counter) -> Counter:
    out = Counter()
    for row, n in rows.items():
        out[tuple(float(f"{v:.9g}") if isinstance(v, float) and math.isfinite(v) else v for v in row)] += n
    return out


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_sql(spark, name):
    cursor = oracle.connect(DATA).execute(ORACLES[name])
    names = [column[0] for column in cursor.description]
    found = QUERIES[name](spark, DATA)
    assert sorted(names) == sorted(found.columns)
    expected = rounded(oracle.multiset(names, cursor.fetchall()))
    assert rounded(oracle.multiset(found.columns, found.collect())) == expected


def test_quality_base(spark, texts):
    columns = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    rows = run(spark, 1).collect()
    assert {r["doc_id"]: tuple(r[c] for c in columns) for r in rows} == {
        i: brute.base_quality(t) for i, t in texts.items()
    }
    assert not any(r["kept"] and r["base_failed"] for r in rows)


def test_quality_finds_what_labels_call_bad(spark):
    labels = spark.read.parquet(f"{LARGER}/labels.parquet").withColumnRenamed("quality", "label")
    rows = run(spark, 1, LARGER).filter("not base_failed").join(labels, "doc_id").collect()
    right = sum(r["kept"] == (r["label"] == 1) for r in rows)
    assert right >= 0.98 * len(rows)


def test_quality_follows_plain_expectation_maximisation(spark):
    docs = spark.read.parquet(f"{LARGER}/documents.parquet")
    for rounds in (0, 3, quality.ROUNDS):
        rows = quality.judge(docs, rounds=rounds).filter("not base_failed").select("votes", "quality").collect()
        want = brute.weak_supervision([r["votes"] for r in rows], rounds)
        assert all(math.isclose(r["quality"], w, rel_tol=1e-6, abs_tol=1e-9) for r, w in zip(rows, want, strict=True))


def test_quality_is_neither_a_filter_that_all_must_pass_nor_its_starting_point(spark):
    folder = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{folder}/labels.parquet").withColumnRenamed("quality", "label")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    rows = quality.judge(docs).join(labels, "doc_id", "left").select("doc_id", "votes", "base_failed", "kept", "label").collect()
    kept = {r["doc_id"] for r in rows if r["kept"]}
    all_pass = {r["doc_id"] for r in rows if not r["base_failed"] and -1 not in r["votes"]}
    start = {r["doc_id"] for r in quality.judge(docs, rounds=0).filter("kept").select("doc_id").collect()}
    assert kept != all_pass and len(kept ^ start) > 100
    judged = [r for r in rows if not r["base_failed"] and r["label"] is not None]

    def right(chosen):
        return sum((r["doc_id"] in chosen) == (r["label"] == 1) for r in judged)

    assert right(kept) >= right(all_pass) and right(kept) > right(start)
    assert right(kept) >= 0.999 * len(judged)


def test_secret_base(spark, texts):
    for r in run(spark, 4).collect():
        want = brute.base_secrets(texts[r["doc_id"]])
        listed = [f"{kind}:{a}:{b}" for kind, a, b in want]
        assert r["base_sha256"] == brute.sha(",".join(listed))
        assert (r["n_assign"], r["n_access"], r["n_hex"]) == tuple(
            sum(kind == k for kind, _, _ in want) for k in ("assign", "access", "hex")
        )
        assert [s for s in r["spans"].split(",") if s and not s.startswith("random")] == listed


def test_simhash(spark, texts):
    ids = sorted(texts)
    prints = [brute.simhash(texts[i]) for i in ids]
    want = {i: (f"{p:016x}", ids[c]) for i, p, c in zip(ids, prints, brute.components(prints), strict=True)}
    assert {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in run(spark, 5).collect()} == want


def test_language_on_held_out_documents(spark):
    docs = spark.read.parquet(f"{LARGER}/documents.parquet").select("doc_id", "lang")
    rows = run(spark, 6, LARGER).join(docs, "doc_id").filter("held_out and lang is not null").collect()
    assert len(rows) > 200 and sum(r["lang"] == r["lang_pred"] for r in rows) >= 0.98 * len(rows)
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_language_scores_are_plain_naive_bayes(spark):
    """The same counts and the same formula, text by text, without batches, blocks or Spark."""
    docs = spark.read.parquet(f"{LARGER}/documents.parquet").select("doc_id", "text", "lang").collect()
    counts, seen = {}, Counter()
    for r in docs:
        if zlib.crc32(str(r["doc_id"]).encode()) % 4 != 2 and r["lang"] and r["text"] and language.letters(r["text"]):
            counts.setdefault(r["lang"], Counter()).update(language.columns_of(language.letters(r["text"])).tolist())
            seen[r["lang"]] += 1
    sizes = {name: sum(c.values()) + language.SMOOTHING * language.COLUMNS for name, c in counts.items()}
    found = {r["doc_id"]: r for r in run(spark, 6, LARGER).collect()}
    for r in docs[:150]:
        kept = language.letters(r["text"])
        if not kept:
            assert (found[r["doc_id"]]["lang_pred"], found[r["doc_id"]]["score"]) == ("und", 0)
            continue
        grams = language.columns_of(kept).tolist()
        logs = {
            name: math.log(seen[name] / sum(seen.values())) + sum(math.log((c[g] + language.SMOOTHING) / sizes[name]) for g in grams)
            for name, c in counts.items()
        }
        best = max(logs, key=logs.get)
        assert found[r["doc_id"]]["lang_pred"] == best
        assert math.isclose(found[r["doc_id"]]["score"], 1 / sum(math.exp(x - logs[best]) for x in logs.values()), rel_tol=1e-6)


def test_repeated_bytes(spark, texts):
    ids = list(texts)
    want = dict(zip(ids, brute.repeats([texts[i] for i in ids], 400), strict=True))
    columns = ["n_bytes", "n_removed", "n_spans", "kept_sha256"]
    assert {r["doc_id"]: tuple(r[c] for c in columns) for r in run(spark, 7).collect()} == want
    assert any(removed for _, removed, _, _ in want.values())


def test_shards(spark, texts):
    rows = run(spark, 8).collect()
    assert {r["doc_id"] for r in rows} == set(texts)
    counts = Counter(r["shard"] for r in rows)
    assert set(counts) == set(range(40)) and max(counts.values()) - min(counts.values()) <= 1
    for shard in counts:
        assert sorted(r["slot"] for r in rows if r["shard"] == shard) == list(range(counts[shard]))
    assert all(r["size"] == len((texts[r["doc_id"]] or "").encode()) + 16 for r in rows)
    assert {r["law"] for r in rows} == {"rows"}


def test_mixture_comes_near_its_targets(spark):
    rows = run(spark, 9, LARGER).join(spark.read.parquet(f"{LARGER}/documents.parquet").select("doc_id", "source"), "doc_id").collect()
    for source in {r["source"] for r in rows}:
        mine = [r for r in rows if r["source"] == source]
        assert abs(sum(r["taken"] for r in mine) - mine[0]["target"]) <= max(r["size"] for r in mine) / 2 + 1
    assert all(r["taken"] <= 3 * r["size"] for r in rows)
    assert sum({r["source"]: r["target"] for r in rows}.values()) == pytest.approx(sum(r["size"] for r in rows))


def test_toxicity_is_the_plain_scan_of_its_model(spark):
    """Counts of tokens by class, and every score from all stretches of a text, without the linear scan."""
    docs, labels = (spark.read.parquet(f"{LARGER}/{name}.parquet") for name in ("documents", "labels"))
    model = toxicity.learn(docs, labels)
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    known = {r["doc_id"]: r["toxic"] for r in labels.collect() if r["toxic"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 3 != 1}
    by_class, seen = {0: Counter(), 1: Counter()}, Counter(known[i] for i in known if texts.get(i) is not None)
    for i, toxic in known.items():
        by_class[toxic].update(set(toxicity.tokens(texts.get(i))))
    base = (seen[1] + 1) / (seen[0] + seen[1] + 2)
    for token, score in model["scores"].items():
        t, c = by_class[1][token], by_class[0][token]
        rate = (t + 2 * base) / (t + c + 2)
        odds = math.log(rate / (1 - rate)) - math.log(base / (1 - base))
        z = odds**2 / (1 / (t + 2 * base) + 1 / (c + 2 * (1 - base)))
        assert t + c >= 4 and math.isclose(score, odds * z / (z + 9) - 0.5, rel_tol=1e-9)
    found = {r["doc_id"]: r["score"] for r in run(spark, 10, LARGER).collect()}
    short = [i for i in texts if len(toxicity.tokens(texts[i])) < 90][:60]
    for i in short:
        values = [model["scores"].get(word, -0.5) for word in toxicity.tokens(texts[i])]
        total, best = toxicity.features([s for _, _, s in brute.stretches(values)], len(values), model["decay"], model["scale"])
        place = model["beta"][0] + model["beta"][1] * total + model["beta"][2] * best
        assert math.isclose(found[i], 1 / (1 + math.exp(-place)), rel_tol=1e-6)


def test_random_keys_are_found_and_identifiers_are_not(spark):
    """Keys and ordinary names planted into given texts: what the token test finds beside the patterns."""
    dealt = random.Random(5)
    rows = spark.read.parquet(f"{LARGER}/documents.parquet").filter("text is not null").orderBy("doc_id").limit(300).collect()
    mixed = string.ascii_letters + string.digits
    words = "user account service payment request handler internal message config provider session manager order value".split()
    planted = []
    for k, r in enumerate(rows):
        if k % 2:
            value = "".join(dealt.choices(mixed, k=dealt.choice((24, 32, 40))))
        else:
            value = dealt.choice("_-/").join(dealt.choices(words, k=4))
        cut = len(r["text"]) // 2
        planted.append((k, f"{r['text'][:cut]} {value} {r['text'][cut:]}", cut + 1, len(value)))
    docs = spark.createDataFrame(planted, "doc_id long, text string, at long, n long")
    found = {r["doc_id"]: r["spans"] for r in secret_scan.secret_report(docs).collect()}
    before = {r["doc_id"]: r["spans"] for r in secret_scan.secret_report(spark.createDataFrame(rows)).collect()}
    caught = sum(f"random:{at}:{at + n}" in found[k].split(",") for k, _, at, n in planted if k % 2)
    false = sum("random" in found[k] for k, _, _, _ in planted if not k % 2)
    assert caught >= 0.98 * 150 and false == 0
    assert not any("random" in spans for spans in before.values())


def test_toxicity_on_held_out_documents(spark):
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    rows = run(spark, 10, "/root/testdata/sf0.1").join(labels, "doc_id").filter("held_out").collect()
    bad, good = ([r["score"] for r in rows if r["toxic"] == label] for label in (1, 0))
    above = sum((b > g) + (b == g) / 2 for b in bad for g in good) / (len(bad) * len(good))
    assert above >= 0.93
    named = [r for r in rows if r["predicted"] == 1]
    assert sum(r["toxic"] for r in named) >= 0.9 * len(named) >= 0.9 * 0.7 * len(bad)
    assert all(r["predicted"] == int(r["score"] >= 0.7) for r in rows)

