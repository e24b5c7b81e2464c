"""From raw documents to shards: language, near copies, benchmark passages, mixture, shards.

Every stage takes (spark, docs, sf_dir), works on all rows of ``docs`` and returns a table that is written and read
again as the next one's input.
"""

from __future__ import annotations

import sys
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))

from tierloom.llm import decontaminate, language, mixing, sharding, simhash  # noqa: E402
from tierloom.llm.common import read, release, stored  # noqa: E402
from tierloom.workspace import keep, scratch  # noqa: E402


def identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a known language. Null texts and texts without a letter go."""
    return language.keep_identified(docs)


def deduplicated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near copies."""
    return simhash.keep_representatives(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage."""
    return decontaminate.drop_contaminated(docs, read(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mixture takes them: repeats are rows, and documents it leaves out go."""
    return mixing.take(docs)


def sharded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their shard and their slot in it."""
    return sharding.with_places(docs)


STAGES = [
    ("language", identified),
    ("near_copies", deduplicated),
    ("decontamination", decontaminated),
    ("mixture", mixed),
    ("shards", sharded),
]

# Trained models and 64-bit hashes are beyond SQL; tests/llm/test_llm_pipeline.py holds a brute-force version against it.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages. What a stage stores on the way is deleted with its end, its input with the end of the next one."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        with scratch():
            result = keep(stored(stage(spark, docs, sf_dir), f"pipeline-{name}"))
        release(docs)
        docs = result
    return docs
