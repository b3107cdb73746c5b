"""A corpus pipeline: language ID, near-duplicates, decontamination, mixing, token files.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept. All but the last return the columns of
docs; each result is written to the shared folder and read again as the next stage's docs. Empty input gives empty output at
every stage; null texts go with language ID, which finds no letter in them.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from quillgate.llm import decontaminate, langid, mixing, simhash, token_files
from quillgate.llm.common import stored, table
from quillgate.llm.queries import WORD_BPE

#: Near-duplicate stage: words of a shingle, differing bits, least similarity of shingle sets.
SHINGLE, RADIUS, SIMILARITY = 5, 4, 0.8


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no language's model accepts go."""
    return langid.kept(docs, langid.fit(docs))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays: the one of the smallest doc_id."""
    return simhash.deduplicated(docs, SHINGLE, RADIUS, SIMILARITY)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A draw whose tokens meet the target margins of source, language and topic."""
    return mixing.sampled(docs)


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What the token files say of each document."""
    return token_files.digests(spark, token_files.write(docs, public_tokenizers.path(WORD_BPE)))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language_id),
    ("simhash_near_dedup", near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("source_mixing", source_mixing),
    ("token_output", token_output),
]

#: Language models, raking and subword ids are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
