"""Schema audit of a folder of parquet files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arealis.registry import PANEL_KEYS


def file_schemas(
    spark: SparkSession, folder: str, glob: str = "*.parquet", expected: list[str] = PANEL_KEYS
) -> DataFrame:
    """Columns of every file, the expected ones it lacks, the ones beyond, and why a file cannot be read.

    Tasks read footers only; file names are spread over the cluster.
    """
    paths = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", glob)
        .option("recursiveFileLookup", "true")
        .load(folder)
        .select("path")
    )
    wanted = F.array(*[F.lit(c) for c in expected])
    found = paths.mapInPandas(_read_footers(), "path string, columns array<string>, error string")
    return found.select(
        "path",
        "columns",
        F.array_except(wanted, "columns").alias("missing"),
        F.array_except("columns", wanted).alias("extra"),
        "error",
    )


def schema_summary(files: DataFrame) -> DataFrame:
    """Files per column set; a set lists its columns in name order."""
    readable = files.where(F.col("error").isNull())
    return readable.groupBy(F.array_join(F.array_sort("columns"), ",").alias("schema")).agg(
        F.count(F.lit(1)).alias("n_files"), F.min("path").alias("example")
    )


def _read_footers():
    def run(batches):
        import pandas as pd
        import pyarrow.parquet as pq
        from pyarrow import fs

        for batch in batches:
            rows = []
            for uri in batch["path"]:
                try:
                    system, path = fs.FileSystem.from_uri(uri)
                    with system.open_input_file(path) as handle:
                        rows.append((uri, list(pq.read_schema(handle).names), None))
                except Exception as e:  # an unreadable file is a finding, not a failure
                    rows.append((uri, None, f"{type(e).__name__}: {e}"))
            yield pd.DataFrame(rows, columns=["path", "columns", "error"])

    return run
