"""The queries behind the map, the trend line, the summary table and the KPI row."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arealis.functions.columns import normalize_columns, parse_month
from arealis.operators.explore import (
    area_extremes,
    area_mean,
    filter_area,
    filter_range,
    join_zones,
    kpi_row,
    monthly_trend,
    value_range,
)
from arealis.operators.zones import map_points
from arealis.registry import AREA_KEYS, canonical_variable, map_level_keys


@dataclass(frozen=True)
class MapQuery:
    """One choice of the dashboard's controls; the variable may go by another of its names."""

    variable: str
    start: dt.date
    end: dt.date
    province: str | None = None
    district: str | None = None
    level: str = "Subdistrict"

    def __post_init__(self) -> None:
        object.__setattr__(self, "variable", canonical_variable(self.variable))


@dataclass(frozen=True)
class Refresh:
    """What one dashboard refresh shows."""

    map: DataFrame
    trend: DataFrame
    summary: DataFrame
    extremes: DataFrame


def panel_of(table: DataFrame) -> DataFrame:
    """A dashboard table (text months, names in any case, aliases of variables) as a panel."""
    tidy = normalize_columns(table)
    month = parse_month("year_month")
    names = [c for c in tidy.columns if c not in (*AREA_KEYS, "year_month")]
    return tidy.select(
        *AREA_KEYS, F.year(month).alias("year"), F.month(month).alias("month"), *[F.col(c).alias(canonical_variable(c)) for c in names]
    )


def selected(panel: DataFrame, q: MapQuery, nested: bool = False) -> DataFrame:
    """Rows of the chosen months and area, with only the columns the views need."""
    rows = filter_area(filter_range(panel, q.start, q.end), q.province, q.district, nested)
    return rows.select(*AREA_KEYS, "year", "month", q.variable)


def map_data(panel: DataFrame, zones: DataFrame, q: MapQuery) -> DataFrame:
    """Every zone with the mean of its area; at district level all its zones show the district's mean."""
    return join_zones(zones, area_mean(selected(panel, q), q.variable, q.level), map_level_keys(q.level))


def heatmap(panel: DataFrame, zones: DataFrame, q: MapQuery) -> DataFrame:
    """Zone centroids with the mean of their area."""
    return map_points(zones, area_mean(selected(panel, q), q.variable, "Heatmap"), q.variable)


def refresh(panel: DataFrame, zones: DataFrame, q: MapQuery) -> Refresh:
    """Map, trend and summary for one choice. Cache ``panel`` if all of them are to be collected.

    The mean in the summary runs over zones, so at district level a district counts once per zone.
    """
    rows = selected(panel, q)
    keys = map_level_keys(q.level)
    on_map = join_zones(zones, area_mean(rows, q.variable, q.level), keys)
    shown = heatmap(panel, zones, q) if q.level == "Heatmap" else on_map
    return Refresh(
        map=shown,
        trend=monthly_trend(rows, q.variable),
        summary=value_range(on_map, q.variable),
        extremes=area_extremes(on_map, q.variable, keys),
    )


@dataclass(frozen=True)
class KpiView:
    """What the KPI page shows; its numbers ignore the zone layer."""

    kpi: DataFrame
    map: DataFrame
    trend: DataFrame


def kpi_dashboard(panel: DataFrame, zones: DataFrame, q: MapQuery) -> KpiView:
    """KPI row, map and trend; the district only counts within a chosen province."""
    rows = selected(panel, q, nested=True)
    return KpiView(
        kpi=kpi_row(rows, q.variable, q.start),
        map=join_zones(zones, area_mean(rows, q.variable)),
        trend=monthly_trend(rows, q.variable),
    )


def static_map(panel: DataFrame, zones: DataFrame, variable: str) -> DataFrame:
    """Zones joined to the monthly rows as they are: one row per zone and month."""
    return join_zones(zones, panel.select(*AREA_KEYS, "year", "month", variable))
