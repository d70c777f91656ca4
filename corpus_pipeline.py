"""From raw documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before it kept. All but the last return the
columns of ``documents``. Between stages the table is written as Parquet and read again, so a lost executor
costs one stage's tasks and not the chain behind them.

Every stage takes nulls in any column, empty and long texts, ties, repeated rows, an empty table and extra columns of any
name as its operator does; what becomes of them is said at the stage.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from arealis.llm import exact_dedup, mixing, near_dedup, packing, quality
from arealis.sources import scratch

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def own_scratch(function: Stage) -> Stage:
    """Give a stage its own intermediate tables; they go when the next stage begins, its result being written."""

    @functools.wraps(function)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        with scratch.stage(spark):
            return function(spark, docs, sf_dir)

    return run_stage


@own_scratch
def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts, with all their columns.

    Null and empty texts are scored by their statistics, keys do not matter, repeated rows are judged alike.
    """
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


@own_scratch
def exact_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts, that with the greatest key.

    Null and empty texts are one group; a null key stays only if no copy has a key; of rows that repeat key and text one
    stays.
    """
    return exact_dedup.drop_copies(docs)


@own_scratch
def near_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates, that with the least key.

    Null and empty texts are one class and near to nothing else; documents without a key are not compared and stay.
    """
    return near_dedup.drop_near_duplicates(docs)


@own_scratch
def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as often as the mix takes them, in its order.

    Null sources are one source, the last; null and empty texts weigh nothing; repeated rows are documents of their own.
    """
    return mixing.mix(docs)


@own_scratch
def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their places in the packed sequences.

    Null texts are empty, an empty text is one separator, long ones are cut; null keys stay null; extra columns go.
    """
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [
    ("quality classifier", quality_classifier),
    ("exact dedup", exact_deduplication),
    ("MinHash near-dedup", near_deduplication),
    ("mixing sources", source_mixing),
    ("best-fit packing", best_fit_packing),
]

# A trained classifier and a tokenizer: SQL cannot express the rows; tests/llm compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``; an empty table of documents gives no pieces."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = scratch.materialize(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
