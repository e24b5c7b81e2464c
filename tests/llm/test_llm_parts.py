"""The parts of the operators that run without Spark, against plain versions."""

import random
import string
import time

import brute
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tierloom.llm import common, decontaminate, language, repeats, secret_scan, sharding, simhash, toxicity


@pytest.mark.parametrize("rows", [1, 2, 3, 40, 41, 1000, 4097])
def test_permutation_is_a_bijection_with_an_inverse(rows):
    there = sharding.permute(np.arange(rows), rows)
    assert sorted(there.tolist()) == list(range(rows))
    assert sharding.permute(there, rows, inverse=True).tolist() == list(range(rows))
    if rows >= 40:
        place = int(there[7])
        assert sharding.row_at(place % 40, place // 40, rows) == 7
    with pytest.raises(ValueError, match="slot"):
        sharding.row_at(0, rows, rows)


def test_permutation_depends_on_the_seed():
    assert sharding.permute(np.arange(500), 500, 1).tolist() != sharding.permute(np.arange(500), 500, 2).tolist()


@given(st.text(alphabet="aB é\n\x0b-", max_size=60))
def test_fingerprint(text):
    assert simhash.fingerprint(text) == brute.simhash(text)


@pytest.mark.parametrize("radius", [0, 1, 2, 3, 5])
def test_bit_sliced_distances(radius):
    rng = np.random.default_rng(radius)
    values = rng.integers(0, 1 << 63, 150, dtype=np.uint64)
    values[50:100] = values[:50] ^ (np.uint64(1) << rng.integers(0, 64, 50).astype(np.uint64))
    values[100:] = values[50:100] ^ (np.uint64(1) << rng.integers(0, 64, 50).astype(np.uint64))
    near = simhash.within(simhash.planes_of(values), values, radius).astype("<u8").view(np.uint8)
    got = np.unpackbits(near, axis=1, bitorder="little")[:, :150].astype(bool)
    want = np.array([[(int(a) ^ int(b)).bit_count() <= radius for b in values] for a in values])
    assert (got == want).all()
    roots = dict(simhash.links(values, radius))
    assert [roots.get(i, i) for i in range(150)] == brute.components(values.tolist(), radius)


@settings(max_examples=200)
@given(st.lists(st.text(alphabet="ab", max_size=70).map(str.encode), min_size=1, max_size=30))
def test_deep_shallow_sort(texts):
    order = repeats.deep_shallow_sort(texts)
    assert sorted(order) == list(range(len(texts))) and [texts[i] for i in order] == sorted(texts)


@given(st.binary(max_size=80), st.binary(max_size=80), st.binary(max_size=80))
def test_common_prefix(head, x, y):
    a, b = head + x, head + y
    same = next((i for i, (p, q) in enumerate(zip(a, b, strict=False)) if p != q), min(len(a), len(b)))
    assert repeats.common_prefix(a, b) == same == repeats.common_prefix(a, b, len(head))


def test_every_string_has_one_anchor(monkeypatch):
    data = random.Random(1).randbytes(900) + b"a" * 300
    whole = list(repeats.anchors(data, 40, 30))
    assert [p for _, a, b in whole for p in range(a, b + 1)] == list(range(len(data) - 39))
    assert all(b <= at < a + 30 for at, a, b in whole)
    monkeypatch.setattr(repeats, "AT_ONCE", 64)
    pieces = {p: at for at, a, b in repeats.anchors(data, 40, 30) for p in range(a, b + 1)}
    assert pieces == {p: at for at, a, b in whole for p in range(a, b + 1)}


@given(st.lists(st.sampled_from("abx"), max_size=40))
def test_segments_are_the_maximal_ones(words):
    scores, drift = {"a": 2.0, "b": 0.7}, 0.5
    value = [scores.get(w, -drift) for w in words]

    def maximal(low, high):
        """Ruzzo and Tompa's definition: the best segment, then the same to its left and right."""
        best = max(((sum(value[i:j]), -(j - i), i, j) for i in range(low, high) for j in range(i + 1, high + 1)), default=None)
        if best is None or best[0] <= 0:
            return []
        _, _, i, j = best
        return [*maximal(low, i), (i, j - 1), *maximal(j, high)]

    found = toxicity.segments(words, scores, drift)
    for a, b, score in found:
        assert score == pytest.approx(sum(value[a : b + 1])) and score > 0
    assert sorted(round(s, 6) for _, _, s in found) == sorted(round(sum(value[a : b + 1]), 6) for a, b in maximal(0, len(words)))


def test_segments_of_a_long_text_take_linear_time():
    """100,000 hits in a falling sum: every hit a segment, where a walk over all candidates takes 5e9 steps."""
    words = ["bad", *["plain"] * 9] * 100_000
    start = time.process_time()
    found = toxicity.segments(words, {"bad": 1.0}, 0.5)
    assert time.process_time() - start < 20
    assert [a for a, _, _ in found] == list(range(0, len(words), 10)) and {s for _, _, s in found} == {1.0}


@given(st.text(alphabet="tTokKeEnN=:'\" aAKIA0123fKſ", max_size=60))
def test_secret_patterns(text):
    assert [(kind, a, b) for a, b, kind in secret_scan.base_spans(text)] == brute.base_secrets(text)


def test_random_strings_and_what_is_known():
    encode = secret_scan.encoder(secret_scan.vocabulary(secret_scan.VOCABULARY))
    text = "see xK9vQ2mZ7pL4wR8tB3nY6cJ1 and internationalization_of_documents d41d8cd98f00b204e9800998ecf8427e"
    found = secret_scan.random_spans(text, encode, secret_scan.CHARS_PER_TOKEN, [])
    assert [text[a:b] for a, b, _ in found] == ["xK9vQ2mZ7pL4wR8tB3nY6cJ1"]
    assert secret_scan.random_spans(text, encode, secret_scan.CHARS_PER_TOKEN, [(4, 6, "assign")]) == []
    assert secret_scan.is_known("6ba7b810-9dad-11d1-80b4-00c04fd430c8") and not secret_scan.is_known("a1-b2c3d4")


def test_random_letters_and_random_parts():
    encode = secret_scan.encoder(secret_scan.vocabulary(secret_scan.VOCABULARY))
    key = "xK9vQ2mZ7pL4wR8tB3nY6cJ1"

    def found(text):
        return [text[a:b] for a, b, _ in secret_scan.random_spans(text, encode, 2.0, secret_scan.base_spans(text))]

    chosen = random.Random(4)
    for n in (20, 32, 40):
        words = ["".join(chosen.choices(string.ascii_letters, k=n)) for _ in range(100)]
        assert all(found(w) == [w] for w in words if n < 2.0 * len(encode(w)))
        assert sum(n < 2.0 * len(encode(w)) for w in words) > 95
    words = ["".join(chosen.choices(string.ascii_letters + string.digits, k=24)) for _ in range(200)]
    assert all(any(w in span for span in found(f"deploy/production/credentials/{w}")) for w in words)
    long = "/deployment/production/credentials/of/the/company/"
    assert found(f"see{long}{key}{long}end") == [key]
    assert found(f"{key}/password=hunter22 then AKIA{'Z' * 16}/{key}") == [key, key]
    assert found(f"6ba7b810-9dad-11d1-80b4-00c04fd430c8/{key}") == [key]
    for name in ("MAXIMUM_CONNECTION_TIMEOUT", "getElementsByTagNameNS", "2024-01-05-13-22-11-0001", long * 9, "83910" * 9):
        assert found(name) == []


@given(st.lists(st.integers(-3, 3), max_size=14))
def test_maximal_stretches(scores):
    found = list(common.maximal_stretches(scores))
    sums = [sum(scores[a : b + 1]) for a, b in found]
    assert all(s > 0 for s in sums) and found == sorted(found) and all(a[1] < b[0] for a, b in zip(found, found[1:]))
    every = [sum(scores[i:j]) for i in range(len(scores)) for j in range(i + 1, len(scores) + 1)]
    assert max(sums, default=0) == max([0, *every])
    covered = {i for a, b in found for i in range(a, b + 1)}
    assert all(i in covered for i, s in enumerate(scores) if s > 0)


def test_a_batch_is_one_product(monkeypatch):
    made = np.random.default_rng(1).random((3, language.COLUMNS + 1))
    matrix = np.log(made / made[:, :-1].sum(axis=1, keepdims=True))
    texts = ["Ein Satz.", None, "", "12 34", "a", "many different words " * 200, "été"] * 3
    products = []
    kept = language.sparse_matrices
    monkeypatch.setattr(language, "sparse_matrices", lambda t: (products.append(m) or m for m in kept(t)))
    found = language.score_batch(texts, (["x", "y", "z"], matrix), [None] * len(texts))
    assert len(products) == 1 and len(products[0][0]) == 12
    for text, got in zip(texts, found, strict=True):
        plain = language.letters(text)
        if not plain:
            assert got["language"] == "und" and got["total"] == 0
            continue
        logs = [row[language.columns_of(plain)].sum() + row[-1] for row in matrix]
        assert got["language"] == "xyz"[int(np.argmax(logs))]
        assert got["best"] == pytest.approx(max(logs))
        assert got["total"] == pytest.approx(np.exp(np.array(logs) - max(logs)).sum())


@given(st.text(alphabet="aB1-é ", max_size=40), st.lists(st.text(alphabet="aB1 é", max_size=12), max_size=3))
def test_contaminated_words(text, items):
    machine = decontaminate.automaton([(str(i), item) for i, item in enumerate(items)], 3)
    _, hit, _ = decontaminate.scan(machine, text)
    assert set(np.flatnonzero(hit).tolist()) == brute.contaminated_words(text, items, 3)


def test_spans_point_into_the_original():
    machine = decontaminate.automaton([("7", "Is IT öde?")], 10)
    text = "¿…  yes: is-IT, öde!"
    n, hit, items = decontaminate.scan(machine, text)
    (span,) = decontaminate.original_spans(text, hit)
    assert items == {"7"} and text[slice(*span)] == "is-IT, öde"
