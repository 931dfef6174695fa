"""Filters, area means, rankings and selector lists behind the map, trend and KPI views."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arealis.functions.columns import join_names, month_label, month_number, month_start
from arealis.registry import AREA_KEYS, SLIDER_STEP, map_level_keys


def filter_range(panel: DataFrame, start: dt.date, end: dt.date) -> DataFrame:
    """Months from ``start`` to ``end``, both included. The bounds on ``year`` reach the scan."""
    if start > end:
        return panel.where(F.lit(False))
    within = month_number().between(start.year * 12 + start.month - 1, end.year * 12 + end.month - 1)
    return panel.where(F.col("year").between(start.year, end.year) & within)


def filter_month(images: DataFrame, year: int, month: int, ts: str = "image_ts") -> DataFrame:
    """Images of one month: from its first instant up to, not including, the next month's."""
    # Without a zone, so that a plain timestamp compares as is and a zoned one in the session's zone.
    first = F.make_timestamp_ntz(F.lit(year), F.lit(month), F.lit(1), F.lit(0), F.lit(0), F.lit(0))
    after = F.make_timestamp_ntz(F.lit(year + month // 12), F.lit(month % 12 + 1), F.lit(1), F.lit(0), F.lit(0), F.lit(0))
    return images.where((F.col(ts) >= first) & (F.col(ts) < after))


def filter_area(
    panel: DataFrame, province: str | None = None, district: str | None = None, nested: bool = False
) -> DataFrame:
    """Keep one province and/or district. ``nested`` ignores the district unless a province is chosen."""
    if province:
        panel = panel.where(F.col("province") == province)
    if district and (province or not nested):
        panel = panel.where(F.col("district") == district)
    return panel


def area_mean(panel: DataFrame, variable: str, level: str = "Subdistrict") -> DataFrame:
    """Mean of a variable per area of the map level; rows lacking an area name belong to no area."""
    keys = map_level_keys(level)
    return panel.na.drop("any", subset=keys).groupBy(*keys).agg(F.avg(variable).alias(variable))


def monthly_trend(panel: DataFrame, variable: str) -> DataFrame:
    """Mean over all rows of each month."""
    return panel.groupBy("year", "month").agg(F.avg(variable).alias(variable)).select(
        month_start().alias("month_start"), variable
    )


def join_zones(zones: DataFrame, values: DataFrame, keys: list[str] = AREA_KEYS) -> DataFrame:
    """All zones, with values where there are any; values without a zone are left out.

    Aggregate first: the value side then has one row per area, and Spark broadcasts it when it is small.
    """
    return zones.join(values, keys, "left").select(*zones.columns, *[c for c in values.columns if c not in keys])


def value_range(joined: DataFrame, variable: str, digits: int = 3, weight: str | None = None) -> DataFrame:
    """Least, greatest and mean value on the map, rounded; no row when there is no value.

    Every zone counts once in the mean, or by the column ``weight``, such as its area.
    """
    mean = F.avg(variable)
    if weight:
        share = F.when(F.col(variable).isNotNull(), F.col(weight))
        mean = F.try_divide(F.sum(F.col(variable) * share), F.sum(share))
    stats = joined.agg(
        F.round(F.min(variable), digits).alias("min_value"),
        F.round(F.max(variable), digits).alias("max_value"),
        F.round(mean, digits).alias("mean_value"),
    )
    return stats.where(F.col("min_value").isNotNull())


def _extremes(variable: str, keys: list[str]) -> tuple[Column, Column]:
    """Aggregates for the least value and the negated greatest one, each with its area."""
    place = F.struct(*[F.col(k) for k in keys])
    lowest = F.min(F.struct(F.col(variable).alias("v"), place.alias("at")))
    # Largest value first, then smallest key: order by the negated value.
    return lowest, F.min(F.struct((-F.col(variable)).alias("v"), place.alias("at")))


def area_extremes(values: DataFrame, variable: str, keys: list[str] = AREA_KEYS) -> DataFrame:
    """Least and greatest value with their areas; among equals the area first in key order."""
    lowest, highest = _extremes(variable, keys)
    found = values.where(F.col(variable).isNotNull()).agg(lowest.alias("lo"), highest.alias("hi"))
    return found.where(F.col("lo").isNotNull()).select(
        F.col("lo.v").alias("min_value"),
        join_names(*[F.col(f"lo.at.{k}") for k in keys]).alias("min_area"),
        (-F.col("hi.v")).alias("max_value"),
        join_names(*[F.col(f"hi.at.{k}") for k in keys]).alias("max_area"),
    )


def top_areas(values: DataFrame, variable: str, n: int, ascending: bool = False) -> DataFrame:
    """The ``n`` areas with the greatest (or least) value; key order among equals."""
    present = values.where(F.col(variable).isNotNull())
    by = F.col(variable).asc() if ascending else F.col(variable).desc()
    return present.orderBy(by, *[k for k in AREA_KEYS if k in values.columns]).limit(n)


def kpi_row(panel: DataFrame, variable: str, start: dt.date) -> DataFrame:
    """Mean of the area means, greatest and least area mean with their places, and the first month shown."""
    order = ["subdistrict", "district", "province"]
    means = area_mean(panel, variable).where(F.col(variable).isNotNull())
    # one row, also without values: the extremes are then null
    lowest, highest = _extremes(variable, order)
    found = means.agg(F.avg(variable).alias("avg"), lowest.alias("lo"), highest.alias("hi"))

    def place(end: str) -> Column:
        return join_names(F.col(f"{end}.at.subdistrict"), F.col(f"{end}.at.district"))

    return found.where(F.col("avg").isNotNull()).select(
        F.format_number("avg", 4).alias("avg_value"),
        F.format_number(-F.col("hi.v"), 4).alias("max_value"),
        place("hi").alias("max_place"),
        F.format_number("lo.v", 4).alias("min_value"),
        place("lo").alias("min_place"),
        F.lit(start.strftime("%b %Y")).alias("observation"),
    )


def distinct_areas(panel: DataFrame, keys: list[str] = AREA_KEYS) -> DataFrame:
    return panel.select(*keys).distinct().orderBy(*keys)


def distinct_months(panel: DataFrame) -> DataFrame:
    months = panel.select("year", "month").distinct()
    return months.select(month_start().alias("month_start")).orderBy("month_start")


def district_options(panel: DataFrame) -> DataFrame:
    """Sorted district names of each province."""
    pairs = panel.select("province", "district").distinct()
    return pairs.groupBy("province").agg(F.array_sort(F.collect_list("district")).alias("districts"))


def slider_index(panel: DataFrame, step: int = SLIDER_STEP) -> DataFrame:
    """Months present with position and tick label; only each ``step``-th and the last carry a label."""
    months = panel.select("year", "month").distinct()
    labels = months.agg(F.array_sort(F.collect_list(month_label(month_start()))).alias("labels"))
    ticks = labels.select(F.size("labels").alias("n"), F.posexplode("labels").alias("position", "month_label"))
    shown = (F.col("position") % step == 0) | (F.col("position") == F.col("n") - 1)
    return ticks.select(
        "position", "month_label", F.when(shown, F.col("month_label")).otherwise("").alias("tick_label")
    )


def map_frames(panel: DataFrame, variable: str) -> DataFrame:
    """All animation frames in one job: area means of every single month, with frame number and the next one."""
    frames = panel.na.drop("any", subset=AREA_KEYS).groupBy("year", "month", *AREA_KEYS).agg(F.avg(variable).alias(variable))
    months = panel.select(month_number().alias("m")).distinct()
    ordered = months.agg(F.array_sort(F.collect_list("m")).alias("ms")).scalar()
    frame = (F.array_position(ordered, month_number()) - 1).cast("int")
    return frames.select(
        frame.alias("frame"),
        F.pmod(frame + 1, F.size(ordered)).alias("next_frame"),
        month_start().alias("month_start"),
        *AREA_KEYS,
        variable,
    )


def next_month(panel: DataFrame, as_of: dt.date) -> DataFrame:
    """The month after the panel's last one; no row unless it lies before the month of ``as_of``."""
    last = panel.agg(F.max(month_number()).alias("last"))
    due = last.select((F.col("last") + 1).alias("due")).where(
        F.col("due") < as_of.year * 12 + as_of.month - 1
    )
    return due.select(
        F.floor(F.col("due") / 12).cast("int").alias("year"), (F.col("due") % 12 + 1).cast("int").alias("month")
    )
