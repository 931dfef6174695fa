"""The batch job from raw observations to the anomaly table, with its tables on shared storage.

Every stage reads what the stage before has written. A lost executor therefore costs one stage's tasks at most,
and the filled panel, which baseline and distances both need, is computed once.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from arealis.functions.columns import require_columns
from arealis.operators.anomaly import anomaly_table
from arealis.operators.clean import clean_long
from arealis.operators.fill import fill_panel, seasonal_store
from arealis.operators.merge import merge_long
from arealis.registry import PANEL_KEYS, PANEL_VARIABLES
from arealis.session import scratch_run
from arealis.sources.files import scan_partitioned, write_table


@dataclass(frozen=True)
class Tables:
    """Where a run keeps its tables."""

    root: str

    @property
    def clean(self) -> str:
        return f"{self.root}/clean"

    @property
    def merged(self) -> str:
        return f"{self.root}/merged"

    @property
    def filled(self) -> str:
        return f"{self.root}/filled"

    @property
    def anomalies(self) -> str:
        return f"{self.root}/anomalies"


def run_batch(spark: SparkSession, raw: DataFrame, tables: Tables, arrow: bool = True) -> DataFrame:
    """Clean, merge, fill and score ``raw`` (long form); returns the anomaly table read back.

    ``raw`` should be a stored table: the cleaning reads it for the values and for the outlier bounds.
    """
    require_columns(raw, ["variable", *PANEL_KEYS, "value"])
    with scratch_run(spark):
        write_table(clean_long(raw), tables.clean, ["variable", "year"])
        merge_tables(spark, tables)
        return score_tables(spark, tables, arrow)


def merge_tables(spark: SparkSession, tables: Tables) -> None:
    """Clean table -> merged panel."""
    clean = scan_partitioned(spark, tables.clean)
    write_table(merge_long(clean), tables.merged, ["year"])


def score_tables(spark: SparkSession, tables: Tables, arrow: bool = True) -> DataFrame:
    """Merged panel -> filled panel -> anomaly table."""
    write_table(fill_panel(spark.read.parquet(tables.merged), PANEL_VARIABLES, keep=seasonal_store), tables.filled, ["year"])
    write_table(anomaly_table(spark.read.parquet(tables.filled), arrow=arrow), tables.anomalies)
    return spark.read.parquet(tables.anomalies)
