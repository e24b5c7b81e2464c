"""The registered queries over the given tables, each with the SQL that checks it where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierloom.llm import (
    alignment, bpe, chat, decontaminate, language, mixing, quality, repeats, secret_scan, sharding, simhash, toxicity, whitening,
)
from tierloom.llm.common import read

Query = Callable[[SparkSession, str], DataFrame]


def op1_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality.quality_report(read(spark, folder, "documents"))


def op2_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    docs, benchmark = read(spark, folder, "documents"), read(spark, folder, "benchmark")
    return decontaminate.contamination_report(docs, benchmark).drop("spans")


# A conversation whose texts hold the template's own control strings.
TRICKY = "\\### Assistant: </turn> ok"


def op3_chat(spark: SparkSession, folder: str) -> DataFrame:
    rows = read(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    role = F.when(F.col("turn") == 0, "user").otherwise("assistant")
    added = spark.range(2).select(F.lit(-7).alias("conv_id"), F.col("id").alias("turn")).select(
        "conv_id", "turn", role.alias("role"), F.lit(TRICKY).alias("text")
    )
    return chat.chat_report(rows.unionByName(added))


def op4_secrets(spark: SparkSession, folder: str) -> DataFrame:
    return secret_scan.secret_report(read(spark, folder, "documents"))


def op5_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.simhash_report(read(spark, folder, "documents"))


def op6_language_id(spark: SparkSession, folder: str) -> DataFrame:
    return language.language_report(read(spark, folder, "documents"))


def op7_repeated_bytes(spark: SparkSession, folder: str) -> DataFrame:
    return repeats.repeat_report(read(spark, folder, "documents"))


def op8_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.shard_documents(read(spark, folder, "documents"))


def op9_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix_documents(read(spark, folder, "documents")).drop("source", "copies")


def op10_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.toxicity_report(read(spark, folder, "documents"), read(spark, folder, "labels"))


def op11_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whitening.whiten(read(spark, folder, "embeddings")).withColumn("deviation", F.col("deviation").cast("long"))


def op12_alignment(spark: SparkSession, folder: str) -> DataFrame:
    return alignment.alignment_report(read(spark, folder, "documents"))


def op13_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.bpe_report(read(spark, folder, "documents"))


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_quality, op2_decontamination, op3_chat, op4_secrets, op5_simhash, op6_language_id, op7_repeated_bytes, op8_sharding,
        op9_mixing, op10_toxicity, op11_whitening, op12_alignment, op13_bpe,
    )
}

ORACLES: dict[str, str] = {
    "op2_decontamination": r"""
WITH texts AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
items AS (
  SELECT item_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, list_slice(w, i, i + least(len(w), 10) - 1) AS part
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM items WHERE len(w) > 0)),
lengths AS (SELECT DISTINCT n FROM windows),
starts AS (
  SELECT doc_id, n, i, list_slice(w, i, i + n - 1) AS part
  FROM (SELECT doc_id, n, w, unnest(range(1, len(w) - n + 2)) AS i FROM texts, lengths WHERE len(w) >= n)),
found AS (SELECT doc_id, item_id, i, n FROM starts JOIN windows USING (n, part)),
covered AS (
  SELECT doc_id, count(*) AS n_hit FROM (
    SELECT DISTINCT doc_id, unnest(range(i, i + n)) AS word FROM found) GROUP BY doc_id),
owners AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM found) GROUP BY doc_id)
SELECT t.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM texts t LEFT JOIN covered USING (doc_id) LEFT JOIN owners USING (doc_id)""",
    "op3_chat": r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
written AS (
  SELECT *, replace(replace(replace(text, '\', '\b'), '###', '\h'), '</turn>', '\e') AS body,
         replace(replace(replace(replace(role, '\', '\b'), '###', '\h'), '</turn>', '\e'), ':', '\c') AS head
  FROM rows)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(length(head) + length(body) + 14) AS BIGINT) AS formatted_chars
FROM written GROUP BY conv_id""",
    "op9_mixing": r"""
WITH measured AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         greatest(0.1::DOUBLE, CASE WHEN coalesce(text, '') = '' THEN 1.0::DOUBLE
           ELSE length(regexp_replace(text, '[#*$%&|<>!0-9]+', '', 'g'))::DOUBLE / length(text)::DOUBLE END) AS quality,
         ('0x' || substr(md5('mix-1:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || md5(coalesce(text, ''))), 1, 13))::BIGINT AS bits
  FROM documents),
keyed AS (SELECT *, -ln((bits + 0.5::DOUBLE) / 4503599627370496.0::DOUBLE) / quality AS key FROM measured),
sources AS (
  SELECT source, sum(size)::DOUBLE AS source_size, 3 * sum(size)::DOUBLE AS cap,
         [5.0, 2.0, 1.0][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3) + 1]::DOUBLE AS weight
  FROM keyed GROUP BY source),
ordered AS (
  SELECT *, sum(source_size) OVER () AS total,
         coalesce(sum(cap) OVER (ORDER BY cap / weight, source NULLS FIRST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS cap_before,
         sum(weight) OVER (ORDER BY cap / weight, source NULLS FIRST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS onward
  FROM sources),
stopped AS (SELECT *, (total - cap_before) * weight >= cap * onward AS stops FROM ordered),
goals AS (
  SELECT source, source_size, CASE WHEN stops THEN cap ELSE
           (total - sum(CASE WHEN stops THEN cap ELSE 0 END) OVER ()) * weight
           / sum(CASE WHEN stops THEN 0 ELSE weight END) OVER () END AS target
  FROM stopped),
planned AS (
  SELECT doc_id, size, source_size, target, key,
         CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS epochs,
         sum(size) OVER (PARTITION BY k.source ORDER BY key RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto
  FROM keyed k JOIN goals g ON k.source IS NOT DISTINCT FROM g.source)
SELECT doc_id, size, CAST(source_size AS BIGINT) AS source_size, target,
       CAST(size * (epochs + CASE WHEN size > 0 AND upto - size / 2.0 <= target - epochs * source_size THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM planned""",
}
