"""The corpus pipeline: raw documents to token ids, in five stages.

Each stage works on all that its predecessor kept.  `run` writes every stage
as Parquet to the shared checkpoint folder and reads it again as the next
one's documents, so a lost executor never goes back further than one stage.
A stage's input is written, so when it begins it deletes what the operators of
earlier stages have left in the shared folder, but for files its input reads.
"""

from __future__ import annotations

import functools

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tessera.llm import exact_dedup, mixing, ngram_join, piece_bpe, quality
from tessera.llm.common import delete_scratch, written
from tessera.sources.tables import table

PIECE_MODEL = "piece_bpe_32k.model"


def _stage(function):
    @functools.wraps(function)
    def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        delete_scratch(spark, docs)
        return function(spark, docs, sf_dir)
    return stage


@_stage
def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return quality.drop_low_quality(docs)


@_stage
def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One of each group of equal texts stays, the longest."""
    return exact_dedup.drop_copies(docs)


@_stage
def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return ngram_join.drop_near_copies(docs)


@_stage
def target_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are kept at their rate, at most once: clean ones stay, toxic
    and low ones are thinned to their target weights."""
    return mixing.mixed(docs, table(spark, sf_dir, "labels"))


@_stage
def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts become ids; digests of the ids and of the decoded text go along."""
    return piece_bpe.tokenised(docs, public_tokenizers.path(PIECE_MODEL))


STAGES = [
    ("quality_rules", quality_rules),
    ("exact_copies", exact_copies),
    ("near_copies", near_copies),
    ("target_weights", target_weights),
    ("token_ids", token_ids),
]

# The label model, the mixing rates and the encoder are beyond SQL; the tests
# hold the operators against brute force and the stages' kept rows to each other.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
