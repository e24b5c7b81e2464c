"""Secret scanning: patterns of known kinds, and a token-efficiency test that exposes random strings.

A byte-pair vocabulary spends few tokens on words it has seen and many on random text. A run of token characters whose
characters per token are below a threshold is reported as ``random``; of a run above it, the stretches of parts that are
below. Digests, UUIDs and parts that a pattern matches are left out, the rest of their run is tested.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from itertools import islice
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierloom.llm.common import as_text, maximal_stretches

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# The vocabulary is broadcast; files beyond this size are refused.
VOCABULARY_BYTES = 16 << 20
# How texts are cut before byte pairs merge: the same pieces that the vocabulary was made for.
PIECES = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
LEAST_CHARS = 20
CHARS_PER_TOKEN = 2.0

# The order of kinds at the same start.
KINDS = ("assign", "access", "hex", "random")
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{%d,}" % LEAST_CHARS)
# Lengths of MD5, SHA-1, SHA-224, SHA-256, SHA-384 and SHA-512 in hexadecimal digits.
DIGEST = re.compile(r"(?:[0-9a-fA-F]{32}|[0-9a-fA-F]{40}|[0-9a-fA-F]{56}|[0-9a-fA-F]{64}|[0-9a-fA-F]{96}|[0-9a-fA-F]{128})")
UUID = re.compile(r"[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}")
KNOWN = re.compile(rf"(?<![0-9A-Za-z])(?:{UUID.pattern}|{DIGEST.pattern})(?![0-9A-Za-z])")
# The shape of names: words and numbers joined by one separator. Their ratio does not count separators, each a token.
IDENTIFIER = re.compile(r"(?:[A-Za-z]+|[0-9]+)(?:[+/_=-](?:[A-Za-z]+|[0-9]+))*")
# What separators stand between; padding belongs to the part before.
PART = re.compile(r"[A-Za-z0-9]+(?:={1,2}(?![A-Za-z0-9+/_=-]))?")


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the patterns; leftmost matches of each kind, those too short are dropped."""
    found = [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    if "AKIA" in text:
        found += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    found += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2])))


def is_known(value: str) -> bool:
    """Digests and UUIDs: random or not, they are no secrets."""
    return bool(DIGEST.fullmatch(value) or UUID.fullmatch(value))


def is_random(value: str, encode, least: float) -> bool:
    pieces = PART.findall(value) if IDENTIFIER.fullmatch(value) else [value]
    return sum(map(len, pieces)) < least * sum(len(encode(piece)) for piece in pieces)


def stretches(
    text: str, start: int, end: int, blocked: list[tuple[int, int]]
) -> Iterator[tuple[int, int, list[tuple[int, int]]]]:
    """(start, end, parts) of what is left of a run without the parts that touch a blocked span."""
    blocked = sorted(blocked)
    left, kept, reach, i = start, [], -1, 0
    for match in PART.finditer(text, start, end):
        a, b = match.span()
        while i < len(blocked) and blocked[i][0] < b:
            reach = max(reach, blocked[i][1])
            i += 1
        if reach <= a:
            left = a if left is None else left
            kept.append((a, b))
            continue
        if kept:
            yield left, kept[-1][1], kept
        left, kept = None, []
    if kept:
        yield left, end, kept


def random_spans(text: str, encode, least: float, taken: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    """Runs with few characters per token, or else the stretches of their parts with few, outside matches of patterns.

    A part is what stands between separators; one that a pattern's match touches belongs to the pattern.
    """
    found = []
    passed = 0
    for match in CANDIDATE.finditer(text):
        start, end = match.span()
        while passed < len(taken) and taken[passed][1] <= start:
            passed += 1
        blocked = [m.span() for m in KNOWN.finditer(text, start, end)]
        for a, b, _ in islice(taken, passed, None):
            if a >= end:
                break
            if b > start:
                blocked.append((a, b))
        for low, high, parts in stretches(text, start, end, blocked) if blocked else [(start, end, None)]:
            if high - low < LEAST_CHARS:
                continue
            if is_random(text[low:high], encode, least):
                found.append((low, high, "random"))
                continue
            parts = parts or [m.span() for m in PART.finditer(text, low, high)]
            if len(parts) > 1:
                excess = [least * len(encode(text[a:b])) - (b - a) for a, b in parts]
                for i, j in maximal_stretches(excess):
                    if parts[j][1] - parts[i][0] >= LEAST_CHARS:
                        found.append((parts[i][0], parts[j][1], "random"))
    return found


def encoder(ranks: bytes):
    """The encoding function of a vocabulary given as lines of base64 and rank."""
    import tiktoken

    merges = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, ranks.splitlines())}
    return tiktoken.Encoding("secret-scan", pat_str=PIECES, mergeable_ranks=merges, special_tokens={}).encode_ordinary


def vocabulary(path: str) -> bytes:
    if Path(path).stat().st_size > VOCABULARY_BYTES:
        raise ValueError(f"{path} has more than {VOCABULARY_BYTES} bytes")
    return Path(path).read_bytes()


RESULT = "base array<struct<kind:string,start:long,end:long>>, random array<struct<kind:string,start:long,end:long>>"


def scan(
    docs: DataFrame, text: str = "text", vocabulary_path: str = VOCABULARY, chars_per_token: float = CHARS_PER_TOKEN,
    into: str = "secrets",
) -> DataFrame:
    """Add a column with the spans (kind, start, end in code points, end exclusive): ``base`` of the patterns, in order
    of start and kind, and ``random`` of the token test. A column of that name is replaced.

    Null and empty texts have none; texts are searched whole; no shuffle. The driver reads the vocabulary and broadcasts
    it, so executors need no copy of the file.
    """
    spark: SparkSession = docs.sparkSession
    ranks = spark.sparkContext.broadcast(vocabulary(vocabulary_path))
    span = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
    kind = pa.struct([("base", pa.list_(span)), ("random", pa.list_(span))])

    @F.arrow_udf(RESULT)
    def scanned(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encode = encoder(ranks.value)
        for texts in batches:
            out = []
            for value in texts:
                passage = value.as_py() or ""
                base = base_spans(passage)
                more = random_spans(passage, encode, chars_per_token, base)
                out.append(
                    {
                        "base": [{"kind": k, "start": a, "end": b} for a, b, k in base],
                        "random": [{"kind": k, "start": a, "end": b} for a, b, k in more],
                    }
                )
            yield pa.array(out, kind)

    return docs.withColumn(into, scanned.asNondeterministic()(F.col(text)))


def secret_report(docs: DataFrame, **options) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans."""
    found = scan(docs.select("doc_id", as_text("text").alias("text")), **options)
    base, random = F.col("secrets")["base"], F.col("secrets")["random"]

    def listed(spans):
        place = {kind: F.lit(i) for i, kind in enumerate(KINDS)}
        order = F.create_map(*[x for kind, i in place.items() for x in (F.lit(kind), i)])
        sortable = F.transform(
            spans, lambda s: F.struct(s["start"], F.element_at(order, s["kind"]).alias("place"), s["end"], s["kind"])
        )

        def written(s):
            return F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))

        return F.array_join(F.transform(F.array_sort(sortable), written), ",")

    def count(kind):
        return F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long")

    return found.select(
        "doc_id", *[count(kind).alias(f"n_{kind}") for kind in KINDS[:3]],
        F.sha2(listed(base).cast("binary"), 256).alias("base_sha256"), listed(F.concat(base, random)).alias("spans"),
    )
