"""A corpus pipeline: language ID, near-duplicate removal, decontamination, mixing, token output.

Every stage takes (spark, docs, sf_dir) and works on all documents that the stage before kept.
All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from taxarium.llm import decontaminate, language, mixing, neardup, tokens
from taxarium.llm.common import Scratch
from taxarium.llm.queries import table


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of undetermined language or of a score below 0.5 go."""
    return language.keep_known(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of smallest id stays of each group that five-word Jaccard similarities of 0.8 or more connect."""
    return neardup.keep_first(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that repeat a benchmark item go."""
    return decontaminate.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.mixed_rows(docs)


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids in binary containers, read back: where each document stands and its digest."""
    return tokens.read_tokens(tokens.write_tokens(docs))


STAGES = [("language_id", language_id), ("near_dedup", near_dedup), ("decontamination", decontamination), ("mixture", mixture), ("token_output", token_output)]

#: The classifier and the tokenizer have no SQL form; tests compare the rows with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; each result is written and read again."""
    scratch = Scratch(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = scratch.save(stage(spark, docs, sf_dir))
    return docs
