"""Stages of the corpus pipeline: (spark, docs, sf_dir) -> rows of ``docs`` that stay, or what the last stage makes of them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from arealis.llm import toxicity
from arealis.llm.bpe import encoded
from arealis.llm.exact_dedup import without_duplicates
from arealis.llm.mixing import mixed_rows
from arealis.llm.near_join import without_near_duplicates
from arealis.llm.queries import vocabulary_path
from arealis.llm.text import table


def not_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the classifier, learnt from the labelled rows of ``docs``, does not call toxic."""
    return toxicity.without_toxic(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return without_duplicates(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates."""
    return without_near_duplicates(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows as often as the mix takes them."""
    return mixed_rows(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Number of tokens of each row, and digests of its ids and of the text they decode to."""
    return encoded(docs, vocabulary_path(), digests=True)
