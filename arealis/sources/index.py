"""File index: the least and greatest month and area of each file, so that a scan opens only the files that can match.

For tables that are not partitioned by what is asked for, such as a panel whose files hold runs of areas and months.
``write_indexed`` orders the rows so that files cover narrow ranges, and writes the index from the files themselves, one short row
per file; ``read_indexed`` chooses files by it before the scan, and the filter itself runs on what they hold. The index may
leave a file in for nothing, it never leaves out one with a matching row.

The index belongs to the files it names: a file it does not know is read as well, so rows appended without a new index are found
too. A row without month or area matches no filter on it.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from arealis.functions.columns import month_number
from arealis.operators.explore import filter_area, filter_range
from arealis.registry import AREA_KEYS, TIME_KEYS

INDEX = "file string, n_rows long, first int, last int, " + ", ".join(f"least_{k} string, greatest_{k} string" for k in AREA_KEYS)


@dataclass(frozen=True)
class Wanted:
    """What a reader asks for; None leaves a side open."""

    start: dt.date | None = None
    end: dt.date | None = None
    province: str | None = None
    district: str | None = None
    subdistrict: str | None = None

    def months(self) -> tuple[int | None, int | None]:
        return tuple(None if d is None else d.year * 12 + d.month - 1 for d in (self.start, self.end))


def index_folder(folder: str) -> str:
    return f"{folder.rstrip('/')}-index"


def file_ranges(spark: SparkSession, folder: str) -> DataFrame:
    """One row per file of a table: its rows, months and areas (``INDEX``). Reads the key columns only."""
    rows = spark.read.parquet(folder).select(F.col("_metadata.file_path").alias("file"), month_number().alias("at"), *AREA_KEYS)
    sides = [s for k in AREA_KEYS for s in (F.min(k).alias(f"least_{k}"), F.max(k).alias(f"greatest_{k}"))]
    return rows.groupBy("file").agg(F.count(F.lit(1)).alias("n_rows"), F.min("at").alias("first"), F.max("at").alias("last"), *sides)


def write_index(spark: SparkSession, folder: str) -> None:
    """Write the index of a table anew."""
    file_ranges(spark, folder).write.mode("overwrite").parquet(index_folder(folder))


def write_indexed(df: DataFrame, folder: str, files: int, order: list[str] | None = None) -> None:
    """Write a table in about ``files`` files of neighbouring rows, and its index.

    ``order`` says which neighbours: by default province and month first, so that a file covers a span of months of few provinces.
    """
    order = order or ["province", *TIME_KEYS, "district", "subdistrict"]
    df.repartitionByRange(files, *order).sortWithinPartitions(*order).write.mode("overwrite").parquet(folder)
    write_index(df.sparkSession, folder)


def may_match(wanted: Wanted) -> Column:
    """Whether a file of the index can hold a wanted row."""
    low, high = wanted.months()
    if low is not None and high is not None and low > high:
        return F.lit(False)
    out = F.lit(True)
    if low is not None:
        out = out & (F.col("last") >= low)
    if high is not None:
        out = out & (F.col("first") <= high)
    for k in AREA_KEYS:
        value = getattr(wanted, k)
        if value is not None:
            out = out & F.lit(value).between(F.col(f"least_{k}"), F.col(f"greatest_{k}"))
    return F.coalesce(out, F.lit(False))


def matching_files(spark: SparkSession, folder: str, wanted: Wanted) -> list[str]:
    """Files to read: those of the index that may match, and those it does not know. Their names are what a scan lists anyway."""
    there = [r.file for r in spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(folder).select(F.col("path").alias("file")).collect()]
    try:
        found = spark.read.schema(INDEX).parquet(index_folder(folder)).select("file", may_match(wanted).alias("may"))
        may = {r.file: r.may for r in found.collect()}
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        may = {}
    return [f for f in there if may.get(f, True)]


def read_indexed(spark: SparkSession, folder: str, wanted: Wanted) -> DataFrame:
    """The wanted rows of a table, read from the files that may hold some."""
    files = matching_files(spark, folder, wanted)
    schema = spark.read.parquet(folder).schema
    rows = spark.read.schema(schema).parquet(*files) if files else spark.createDataFrame([], schema)
    first, last = wanted.start or dt.date(1, 1, 1), wanted.end or dt.date(9999, 12, 1)
    if wanted.start or wanted.end:
        rows = filter_range(rows, first, last)
    rows = filter_area(rows, wanted.province, wanted.district)
    return rows.where(F.col("subdistrict") == wanted.subdistrict) if wanted.subdistrict else rows
