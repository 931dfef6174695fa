"""A corpus pipeline: toxic documents go, copies and near copies go, sources are mixed to weights, texts become tokens."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from arealis.llm import stages
from arealis.llm.text import table
from arealis.session import stored

#: (name, function); each function takes (spark, docs, sf_dir) and works on all rows its predecessor kept.
STAGES = [
    ("toxicity", stages.not_toxic),
    ("exact_dedup", stages.without_copies),
    ("near_duplicates", stages.without_near_copies),
    ("mixing", stages.mixed),
    ("bpe", stages.tokens),
]

#: None: training, Bayesian pruning and merges by rank are beyond SQL; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each stage's rows stored as Parquet and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
