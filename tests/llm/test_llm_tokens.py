"""Encoding by tree concatenation and the alignment of two tokenizers, against plain versions."""

import random
from collections import Counter

import brute
import pytest
from conftest import DATA
from hypothesis import given, settings
from hypothesis import strategies as st

from tierloom.llm import alignment, bpe
from tierloom.llm.queries import QUERIES

ODD = [
    (-1, None),
    (-2, ""),
    (-3, "<|endoftext|> and <|startoftext|>x </w> <s>hi</s>"),
    (-3, "<|endoftext|> and <|startoftext|>x </w> <s>hi</s>"),
    (None, "two  spaces, a tab\t, lines\n\n and ▁ its own mark"),
    (-4, "a" * 3000 + "日本語" * 300 + "\x00\x01 é é Ünd ÇA 😀😀 I'll can't"),
    (-5, "x" * 40 + " " + "#" * 90 + "aeiou" * 50),
]


@pytest.fixture(scope="module")
def encoder():
    return bpe.Encoder(bpe.tokenizer_bytes(bpe.TOKENIZER))


@pytest.fixture(scope="module")
def texts(spark):
    rows = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text").collect()
    return [tuple(r) for r in rows]


def whole(encoder, text):
    return encoder.tokenizer.encode(text, add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from("abeint'<|>/w #é̂日\t\x1c\x85İ5"), max_size=120), st.integers(1, 9))
def test_every_way_of_halving_gives_the_tokenizers_ids(encoder, text, leaf):
    encoder.leaf, kept = leaf, encoder.leaf
    encoder.runs.clear()
    try:
        parts = [p if p["ids"] is not None else {**p, "ids": encoder.tree(p["part"], p["final"])} for p in encoder.open_parts(text, 2 * leaf)]
        assert encoder.encode(text).tolist() == encoder.closed(parts) == whole(encoder, text)
    finally:
        encoder.leaf = kept
        encoder.runs.clear()


@pytest.mark.parametrize("letters", ["a", "ab", "aaab", "etaoin", "haha!?", "é日"])
def test_long_pieces(encoder, letters):
    text = "".join(random.Random(letters).choices(letters, k=20_000))
    assert encoder.encode(text).tolist() == whole(encoder, text)


def test_a_window_grows_as_far_as_it_must(encoder):
    widths = []
    at_once = encoder.at_once
    encoder.at_once = lambda part, final: widths.append(len(part)) or at_once(part, final)
    try:
        piece = "a" * 64
        assert encoder.join(at_once(piece[:31], False), at_once(piece[31:], True), piece, 31, True) == at_once(piece, True)
    finally:
        del encoder.at_once
    assert len(widths) > 1 and widths == sorted(widths)


def test_bpe_query(spark, texts, encoder):
    def want(i, text):
        ids = whole(encoder, text or "")
        return i, len(ids), brute.sha(" ".join(map(str, ids))), brute.sha(encoder.tokenizer.decode(ids, skip_special_tokens=False))

    found = Counter(tuple(r) for r in QUERIES["op13_bpe"](spark, DATA).collect())
    assert found == Counter(want(*row) for row in texts)
    odd = spark.createDataFrame(ODD, "doc_id long, text string").repartition(3)
    for block in (bpe.BLOCK, 64):
        assert Counter(tuple(r) for r in bpe.bpe_report(odd, block=block).collect()) == Counter(want(*row) for row in ODD)


def test_long_texts_keep_their_columns(spark, encoder):
    names = "ids long, text_row string, text_part int, part_ids int, part_place int"
    docs = spark.createDataFrame([("y" * 500, 7, "kept", 1, 2, 3), (None, 8, None, 4, 5, 6)], f"text string, {names}")
    rows = bpe.encode(docs, block=100).collect()
    assert {r["text_row"] for r in rows} == {"kept", None}
    assert {tuple(r["ids"]) for r in rows} == {tuple(whole(encoder, "y" * 500)), ()}
    tasks = bpe.encode(docs, block=100).select("ids")
    assert bpe.decode(tasks).filter("decoded != ''").count() == 1
    assert bpe.bpe_report(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_alignment_query(spark, texts):
    columns = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]

    def check(report, rows):
        found = Counter((r["doc_id"], *[r[c] for c in columns]) for r in report.collect())
        assert found == Counter((i, *row) for (i, _), row in zip(rows, brute.alignment([t for _, t in rows])[0], strict=True))

    check(QUERIES["op12_alignment"](spark, DATA), texts)
    odd = spark.createDataFrame([(*row, 1, 2) for row in ODD], "doc_id long, text string, block int, pair int").repartition(3)
    check(alignment.alignment_report(odd), ODD)
    assert alignment.alignment_report(odd.limit(0)).collect() == []


def test_alignment_of_spaces_at_the_ends(spark):
    """A space that ends a text is a token of both sides, and no reason to leave the text out."""
    texts = ["a ", "the cat ", "the cat  ", " ", "  ", " a ", "a \n", "a\n ", "a\t ", "<s> ", "日本 ", "▁ ", "the cat"]
    rows = list(enumerate(texts))
    report = alignment.alignment_report(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))
    columns = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    found = {r["doc_id"]: tuple(r[c] for c in columns) for r in report.collect()}
    assert found == dict(enumerate(brute.alignment(texts)[0]))
    assert found[0][:4] == (2, 2, 2, 2)


def test_alignment_pairs(spark):
    odd = spark.createDataFrame(ODD, "doc_id long, text string").repartition(2)
    documents, pairs = alignment.align(odd)
    _, held, links = brute.alignment([t for _, t in ODD])
    found = {(r["a_id"], r["b_id"]): (r["n_docs"], r["n_links"]) for r in pairs.collect()}
    assert found == {key: (held[key], links[key]) for key in held}
    written = {r["doc_id"]: r["groups"] for r in documents.collect()}
    assert written[-1] == "" and "|" in written[-5]


def test_bitmaps_of_many_documents(spark):
    """One block with more documents than a list of slots may have, and links that repeat inside a text."""
    rows = [(i, "the cat the cat the" if i % 2 else "the dog") for i in range(9000)]
    report = alignment.alignment_report(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1))
    found = Counter((r["n_links"], r["n_best"], r["count_sum"]) for r in report.collect())
    plain = brute.alignment([t for _, t in rows])[0]
    assert found == Counter((row[3], row[4], row[5]) for row in plain)
