"""Folder scans, input listings, outputs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from arealis.functions.columns import nan_to_null, normalize_columns
from arealis.operators.merge import concat_all
from arealis.registry import PANEL_KEYS, VARIABLES, canonical_variable


def scan_parquet(
    spark: SparkSession, folder: str, glob: str = "*.parquet", schema: StructType | str | None = None
) -> DataFrame:
    """All parquet files below a folder as one table.

    With a schema given no footer is read ahead; without one the files' schemas are merged.
    """
    reader = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", glob)
    reader = reader.schema(schema) if schema is not None else reader.option("mergeSchema", "true")
    return reader.parquet(folder)


def scan_partitioned(spark: SparkSession, folder: str, variables: list[str] | None = None) -> DataFrame:
    """A table written by ``write_table``; the variable filter prunes folders."""
    df = spark.read.option("basePath", folder).parquet(folder)
    return df.where(F.col("variable").isin(variables)) if variables else df


def path_segment(path: Column, position: int) -> Column:
    """Segment of a path by position; negative counts from the end."""
    return F.try_element_at(F.split(path, "/"), F.lit(position))


def variable_from_path(path: Column | None = None) -> Column:
    """Upper-cased name of the folder a file lies in."""
    path = F.col("_metadata.file_path") if path is None else path
    return F.upper(path_segment(path, -2))


def read_variable_folders(spark: SparkSession, folder: str, schema: StructType | str) -> DataFrame:
    """Files ``<folder>/.../<variable>/<file>.parquet`` as a long table ``(variable, area keys, year, month, value)``.

    ``schema`` lists the columns the files may have; the value column of a variable is its reducer's.
    """
    raw = scan_parquet(spark, folder, schema=schema).withColumn("_variable", variable_from_path())
    named = raw.drop("variable").withColumnRenamed("_variable", "variable").where(F.col("variable").isin(list(VARIABLES)))
    summed = F.col("variable").isin([v.name for v in VARIABLES.values() if v.reducer == "sum"])
    tidy = _single_subdistrict(named)
    long = tidy.withColumn("value", F.when(summed, F.col("sum")).otherwise(F.col("mean")))
    return nan_to_null(long.select("variable", *PANEL_KEYS, "value"), ["value"])


def _single_subdistrict(df: DataFrame) -> DataFrame:
    """Files spelling the column in either way give one column."""
    if "subdistric" in df.columns and "subdistrict" in df.columns:
        return df.withColumn("subdistrict", F.coalesce("subdistrict", "subdistric")).drop("subdistric")
    return normalize_columns(df)


def list_inputs(
    spark: SparkSession,
    folder: str,
    glob: str = "*.geojson",
    variable: str | None = None,
    limit: int | None = None,
    min_depth: int = 0,
) -> DataFrame:
    """Input files with variable and stem, in path order; contents are not read.

    ``min_depth`` is the least number of folders between ``folder`` and the file; ``limit`` of 0 or None lists all.
    """
    found = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", glob)
        .option("recursiveFileLookup", "true")
        .load(folder)
        .select("path", "length")
    )
    below = F.substring_index(F.col("path"), folder.rstrip("/") + "/", -1)
    listed = found.where(F.size(F.split(below, "/")) > min_depth).select(
        "path",
        "length",
        variable_from_path(F.col("path")).alias("variable"),
        F.regexp_extract("path", r"([^/]+)\.[^./]+$", 1).alias("stem"),
    )
    if variable:
        listed = listed.where(F.col("variable") == canonical_variable(variable))
    listed = listed.orderBy("path")
    return listed.limit(limit) if limit else listed


def pending(inputs: DataFrame, finished: DataFrame, name: str = "stem") -> DataFrame:
    """Inputs whose output does not exist yet."""
    return inputs.join(finished.select(name), name, "left_anti")


def write_table(
    df: DataFrame, folder: str, partitions: list[str] | None = None, mode: str = "overwrite", only_present: bool = False
) -> None:
    """Write parquet. An overwrite replaces the table, or ``only_present`` the partitions that ``df`` has rows for.

    Rows are first brought together per partition with a few files each: AQE splits a partition that is
    too large for one task, so a dominant partition does not end up in a single file.
    """
    if not partitions:
        df.write.mode(mode).parquet(folder)
        return
    spread = df.hint("rebalance", *partitions)
    kept = "dynamic" if only_present else "static"
    spread.write.mode(mode).option("partitionOverwriteMode", kept).partitionBy(*partitions).parquet(folder)


def write_bucketed(df: DataFrame, name: str, folder: str, by: list[str], buckets: int) -> DataFrame:
    """Save a table hash-partitioned on ``by``, so that grouping or joining on these columns needs no shuffle.

    Meant for the pixel series: composites by pixel and month then run within the buckets.
    """
    writer = df.write.mode("overwrite").format("parquet").option("path", folder)
    writer.bucketBy(buckets, *by).sortBy(*by).saveAsTable(name)
    return df.sparkSession.table(name)


def read_attributes(spark: SparkSession, path: str, schema: StructType | str, fmt: str = "csv") -> DataFrame:
    """Attribute table with a stated schema: CSV with a header, or parquet."""
    reader = spark.read.schema(schema)
    df = reader.option("header", "true").csv(path) if fmt == "csv" else reader.format(fmt).load(path)
    return normalize_columns(df)
