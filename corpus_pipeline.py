"""From raw documents to token ids: five stages, each written and read again as the next one's input.

All stages but the last return whole rows of their input, with its columns, whatever these are
called. Null texts count as empty; rows with a null doc_id, and rows that share one, are rows of
their own. An empty table goes through all stages. Stages that hand texts to Python lower the
session's rows of an Arrow batch.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from farescope.llm import decontam, mixing, ngram_join, quality, token_output
from farescope.llm.common import small_batches, stored
from farescope.llm.queries import TOKENIZER, quality_labels, table
from farescope.session import shared_dir


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality model accepts; empty texts are scored like any other."""
    small_batches(spark)
    model = quality.fit(docs, quality_labels(table(spark, sf_dir, "labels")))
    return quality.accepted(docs, model)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates; all documents without words."""
    small_batches(spark)
    return ngram_join.representatives(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark text to speak of; all of them if the benchmark is empty."""
    small_batches(spark)
    return decontam.remove_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's target asks for; a null source is one of its own."""
    return mixing.mixed_documents(docs)


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids in files, and what the files hold for each document, null doc_id first."""
    small_batches(spark)
    path = shared_dir(spark)
    token_output.write_tokens(docs, path, public_tokenizers.path(TOKENIZER))
    return token_output.read_tokens(spark, path)


STAGES = [
    ("quality", quality_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("mixing", mixing_stage),
    ("tokens", token_stage),
]

#: The quality model is fitted, so SQL can't express the rows; tests compare them stage by stage.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir))
    return docs
