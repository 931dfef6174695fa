"""Incremental ingest: new files once each, cleaned and added without repeats.

Writers only append rows whose key is not there yet, so repeating a micro-batch after a failure adds nothing.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from arealis.functions.columns import month_number
from arealis.operators.clean import drop_incomplete, iqr_mask, mask_rows, uses_iqr
from arealis.operators.merge import keep_first, unseen
from arealis.registry import PANEL_KEYS, TIME_KEYS
from arealis.sources.files import write_table


def new_files(
    spark: SparkSession, folder: str, schema: StructType | str, glob: str = "*.parquet", max_files: int | None = None
) -> DataFrame:
    """Stream of the files of a folder; the query's checkpoint remembers which were read."""
    reader = spark.readStream.schema(schema).option("recursiveFileLookup", "true").option("pathGlobFilter", glob)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", str(max_files))
    return reader.parquet(folder)


def clean_stream(raw: DataFrame) -> DataFrame:
    """The row-local cleaning rules on a stream. Outlier bounds need whole months: see ``release_months``."""
    return mask_rows(raw)


def append_unseen(
    folder: str, keys: list[str], order: list[str], partitions: list[str]
) -> Callable[[DataFrame, int], None]:
    """Batch writer: the first row per key within the batch (nulls last), unless the table has the key already.

    Existing rows win and are never rewritten. Only partitions the batch touches are looked at.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        fresh = keep_first(batch, keys, order)
        known = existing(spark, folder, batch.schema)
        if known is not None:
            touched = batch.select(*partitions).distinct()
            fresh = unseen(fresh, known.join(touched, partitions, "left_semi"), keys)
        write_table(fresh, folder, partitions, mode="append")

    return write


def existing(spark: SparkSession, folder: str, schema: StructType | str) -> DataFrame | None:
    """The table so far, or none before the first batch."""
    try:
        return spark.read.schema(schema).option("basePath", folder).parquet(folder)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def run_available(
    stream: DataFrame, checkpoint: str, write: Callable[[DataFrame, int], None]
) -> StreamingQuery:
    """Process what has arrived so far and stop."""
    query = (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def ingest(
    spark: SparkSession, source: str, schema: StructType | str, target: str, checkpoint: str, order: list[str] | None = None
) -> StreamingQuery:
    """New raw files -> cleaned long table partitioned by variable and year, one row per key.

    Rows the rules leave without a value go before they can take a key, so a later good value still enters.
    """
    keys = ["variable", *PANEL_KEYS]
    cleaned = drop_incomplete(clean_stream(new_files(spark, source, schema)), ["value"])
    return run_available(
        cleaned, checkpoint, append_unseen(target, keys, order or ["value"], ["variable", "year"])
    )


def release_months(cleaned: DataFrame, as_of_year: int, as_of_month: int, state: DataFrame | None = None) -> DataFrame:
    """Rows of the months before the running one, with outliers masked: their months are complete.

    ``state`` is the merged quantile state of those months' values, where one is kept.
    """
    closed = cleaned.where(month_number() < F.lit(as_of_year * 12 + as_of_month - 1))
    return iqr_mask(closed, ["variable", *TIME_KEYS], only=uses_iqr(), state=state)
