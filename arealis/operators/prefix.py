"""Range means from running totals: any span of months costs two of them.

The table has one row per area and month, from the panel's first to its last month, with the running sum and number of values of
each variable. A mean over a span is the difference of two months' rows, at any level of areas, as sums and counts add up.
Months are folders, so a query reads two, whatever the span. A month that is built again changes the totals from there on:
``repair`` starts from the month before it.

Rows lacking an area key belong to no area. Sums are of doubles: a mean agrees with the plain one
up to the rounding of the running sum.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from arealis.functions.columns import month_number, month_of, year_of
from arealis.operators.explore import filter_area, join_zones
from arealis.operators.fill import without_null_keys
from arealis.registry import AREA_KEYS, PANEL_VARIABLES, TIME_KEYS, map_level_keys
from arealis.sources.files import write_table

BOUNDS = "first int, last int"


def _columns(values: Iterable[str]) -> list[str]:
    return [f"{kind}_{v}" for v in values for kind in ("sum", "n")]


def running_totals(
    panel: DataFrame, last: int, values: list[str] = PANEL_VARIABLES, keys: list[str] = AREA_KEYS,
    base: DataFrame | None = None, after: int = -1,
) -> DataFrame:
    """Area keys, ``sum_v`` and ``n_v`` of each variable, year and month, of every month from an area's first row up to month ``last``.

    ``base`` holds the totals of the month ``after``, which all rows of ``panel`` follow; that month is not among the result's.
    """
    rows = without_null_keys(panel, keys).select(
        *keys, month_number().alias("_at"), *[c for v in values for c in (F.coalesce(v, F.lit(0.0)).alias(f"sum_{v}"), F.col(v).isNotNull().cast("long").alias(f"n_{v}"))]
    )
    if base is not None:
        rows = rows.unionByName(base.select(*keys, month_number().alias("_at"), *_columns(values)))
    in_area = W.partitionBy(*keys).orderBy("_at")
    added = rows.select(
        *keys, "_at", F.lead("_at").over(in_area).alias("_next"),
        *[F.sum(c).over(in_area.rowsBetween(W.unboundedPreceding, W.currentRow)).alias(c) for c in _columns(values)],
    )
    # a row stands for the months up to the area's next one
    stop = F.coalesce(F.col("_next") - 1, F.lit(last))
    spread = added.withColumn("_month", F.explode(F.sequence("_at", F.greatest(stop, F.col("_at"))))).where(F.col("_month") > after)
    return spread.select(*keys, *_columns(values), year_of(F.col("_month")).alias("year"), month_of(F.col("_month")).alias("month"))


def bounds(spark: SparkSession, folder: str) -> tuple[int, int] | None:
    """First and last month of a stored table."""
    try:
        row = spark.read.schema(BOUNDS).parquet(f"{folder}/bounds").first()
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return (row["first"], row["last"]) if row else None


def _note(spark: SparkSession, folder: str, first: int, last: int) -> None:
    spark.createDataFrame([(first, last)], BOUNDS).coalesce(1).write.mode("overwrite").parquet(f"{folder}/bounds")


def write_prefix(panel: DataFrame, folder: str, values: list[str] = PANEL_VARIABLES, keys: list[str] = AREA_KEYS) -> None:
    """Store the running totals of a panel, one folder per month."""
    ends = without_null_keys(panel, keys).agg(F.min(month_number()).alias("first"), F.max(month_number()).alias("last")).first()
    if ends["first"] is None:
        return
    write_table(running_totals(panel, ends["last"], values, keys), f"{folder}/months", TIME_KEYS)
    _note(panel.sparkSession, folder, ends["first"], ends["last"])


def _months(spark: SparkSession, folder: str, schema: StructType, months: list[int]) -> DataFrame:
    paths = [f"{folder}/months/year={m // 12}/month={m % 12 + 1}" for m in months]
    if not paths:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", f"{folder}/months").parquet(*paths)


def _schema(keys: list[str], values: list[str]) -> StructType:
    columns = [f"{k} string" for k in keys] + [f"{c} {'double' if c.startswith('sum_') else 'long'}" for c in _columns(values)]
    return StructType.fromDDL(", ".join([*columns, "year int", "month int"]))


def repair(
    later: DataFrame, folder: str, first: int, values: list[str] = PANEL_VARIABLES, keys: list[str] = AREA_KEYS
) -> None:
    """Replace the totals from month ``first`` on; ``later`` holds all rows of the panel from there on.

    Reads the totals of the month before and the rows given, and writes the months from ``first`` on.
    """
    spark = later.sparkSession
    known = bounds(spark, folder)
    if known is None or first <= known[0]:
        # nothing before stays: what is given is the whole panel
        write_prefix(later, folder, values, keys)
        return
    ends = without_null_keys(later, keys).agg(F.max(month_number()).alias("last")).first()
    # months that have lost all their rows still hold the totals
    last = max(ends["last"] or 0, known[1])
    from_month = min(first - 1, known[1])
    base = _months(spark, folder, _schema(keys, values), [from_month])
    write_table(running_totals(later, last, values, keys, base, from_month), f"{folder}/months", TIME_KEYS, only_present=True)
    _note(spark, folder, known[0], last)


def range_totals(
    spark: SparkSession, folder: str, start: dt.date, end: dt.date, values: list[str] = PANEL_VARIABLES, keys: list[str] = AREA_KEYS
) -> DataFrame:
    """Sum and number of values per area from ``start`` to ``end``, both included. Reads two months at most."""
    schema, known = _schema(keys, values), bounds(spark, folder)
    a, b = start.year * 12 + start.month - 1, end.year * 12 + end.month - 1
    if known is None or a > b or a > known[1] or b < known[0]:
        return spark.createDataFrame([], schema).drop(*TIME_KEYS)
    plus, minus = min(b, known[1]), a - 1
    rows = _months(spark, folder, schema, [plus] + ([minus] if minus >= known[0] else []))

    def signed(c: str) -> Column:
        return F.sum(F.when(month_number() == plus, F.col(c)).otherwise(-F.col(c))).alias(c)

    return rows.groupBy(*keys).agg(*[signed(c) for c in _columns(values)])


def range_mean(
    spark: SparkSession, folder: str, variable: str, start: dt.date, end: dt.date, level: str = "Subdistrict",
    province: str | None = None, district: str | None = None, values: list[str] = PANEL_VARIABLES,
) -> DataFrame:
    """Mean of a variable per area of a map level over a span of months; areas without a value there have none."""
    totals = filter_area(range_totals(spark, folder, start, end, values), province, district)
    keys = map_level_keys(level)
    found = totals.groupBy(*keys).agg(F.sum(f"sum_{variable}").alias("s"), F.sum(f"n_{variable}").alias("n"))
    return found.select(*keys, F.when(F.col("n") > 0, F.col("s") / F.col("n")).alias(variable))


def map_data(
    spark: SparkSession, folder: str, zones: DataFrame, variable: str, start: dt.date, end: dt.date, level: str = "Subdistrict",
    province: str | None = None, district: str | None = None, values: list[str] = PANEL_VARIABLES,
) -> DataFrame:
    """Every zone with the mean of its area over a span of months, as ``dashboard.map_data`` gives it from the panel."""
    return join_zones(zones, range_mean(spark, folder, variable, start, end, level, province, district, values), map_level_keys(level))


def frames(
    spark: SparkSession, folder: str, variable: str, spans: list[tuple[dt.date, dt.date]], level: str = "Subdistrict",
    values: list[str] = PANEL_VARIABLES,
) -> DataFrame:
    """The means of several spans, such as the frames of an animation, with the number of the span as ``frame``."""
    out = None
    for k, (start, end) in enumerate(spans):
        one = range_mean(spark, folder, variable, start, end, level, values=values).withColumn("frame", F.lit(k))
        out = one if out is None else out.unionByName(one)
    return out
