"""Full month grid and gap filling of a panel with one row per area and month.

All steps up to the climatology group by area, whose rows are bounded by the number of months, and share one
shuffle. The wider means go through a table with one row per district.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from arealis.functions.columns import month_number, month_of, year_of
from arealis.registry import AREA_KEYS, INTERPOLATION_LIMIT, PANEL_VARIABLES
from arealis.session import stored


def without_null_keys(panel: DataFrame, keys: list[str] = AREA_KEYS) -> DataFrame:
    """Rows lacking an area key belong to no area and are left out."""
    return panel.na.drop("any", subset=keys)


def count_null_keys(panel: DataFrame, keys: list[str] = AREA_KEYS) -> DataFrame:
    """How many rows ``without_null_keys`` leaves out."""
    missing = ~F.forall(F.array(*[F.col(k).isNotNull() for k in keys]), lambda k: k)
    return panel.agg(F.count_if(missing).alias("n_dropped"))


def time_bounds(panel: DataFrame) -> DataFrame:
    """First and last month of the panel as month numbers."""
    return panel.agg(F.min(month_number()).alias("first"), F.max(month_number()).alias("last"))


def month_grid(
    panel: DataFrame, values: list[str] = PANEL_VARIABLES, keys: list[str] = AREA_KEYS
) -> DataFrame:
    """Every area at every month between the panel's first and last month; absent months hold nulls.

    Each observed row spreads itself over the months up to the area's next row, the first row also
    backwards to the start. That replaces areas x months and the join back by one window per area.
    """
    dated = without_null_keys(panel, keys).withColumn("_at", month_number())
    ends = time_bounds(without_null_keys(panel, keys)).select(F.struct("first", "last").alias("b")).scalar()
    in_area = W.partitionBy(*keys).orderBy("_at")
    spread = dated.withColumns({"_prev": F.lag("_at").over(in_area), "_next": F.lead("_at").over(in_area)})
    start = F.when(F.col("_prev").isNull(), ends["first"]).otherwise(F.col("_at"))
    stop = F.greatest(F.coalesce(F.col("_next") - 1, ends["last"]), F.col("_at"))
    grid = spread.select(*keys, "_at", *values, F.explode(F.sequence(start, stop)).alias("_month"))
    here = F.col("_month") == F.col("_at")
    return grid.select(
        *keys,
        year_of(F.col("_month")).alias("year"),
        month_of(F.col("_month")).alias("month"),
        *[F.when(here, F.col(v)).alias(v) for v in values],
    )


def interpolate_gaps(
    grid: DataFrame,
    values: list[str] = PANEL_VARIABLES,
    limit: int = INTERPOLATION_LIMIT,
    keys: list[str] = AREA_KEYS,
) -> DataFrame:
    """Fill the first ``limit`` months after a known value on the line to the next known one.

    With no later value the last one is carried on, within the same limit; leading gaps stay.
    """
    spec = f"(PARTITION BY {', '.join(_quoted(keys))} ORDER BY _at)"
    at = F.col("_at")

    def known(name: str, v: str) -> Column:
        point = f"IF(`{v}` IS NULL, NULL, named_struct('at', _at, 'v', CAST(`{v}` AS DOUBLE)))"
        return F.expr(f"{name}({point}, 1) IGNORE NULLS OVER {spec}")

    dated = grid.withColumn("_at", month_number())
    near = dated.select(
        "*",
        *[known("lag", v).alias(f"_p_{v}") for v in values],
        *[known("lead", v).alias(f"_n_{v}") for v in values],
    )

    def filled(v: str) -> Column:
        before, after = F.col(f"_p_{v}"), F.col(f"_n_{v}")
        slope = (after["v"] - before["v"]) / (after["at"] - before["at"])
        on_line = F.when(after.isNull(), before["v"]).otherwise(before["v"] + slope * (at - before["at"]))
        return F.coalesce(F.col(v), F.when(at - before["at"] <= limit, on_line)).alias(v)

    return near.select(*[filled(c) if c in values else F.col(c) for c in grid.columns])


def fill_climatology(
    grid: DataFrame, values: list[str] = PANEL_VARIABLES, keys: list[str] = AREA_KEYS
) -> DataFrame:
    """Remaining nulls take the area's mean of that calendar month."""
    same_month = W.partitionBy(*keys, "month")
    return grid.withColumns({v: F.coalesce(F.col(v), F.avg(v).over(same_month)) for v in values})


def area_level_means(
    grid: DataFrame, values: list[str] = PANEL_VARIABLES, levels: list[str] = AREA_KEYS[:2]
) -> DataFrame:
    """One row per district with its own, its province's and the global mean of every variable.

    Each level averages what the level below has already filled. A district with mean ``m`` fills its gaps
    with ``m``, after which its sum is ``m * rows``; so the next level's mean follows from district totals and the
    panel itself is aggregated once. A district or province without any value adds nothing above it.
    """
    outer, inner = levels
    totals = [F.count(F.lit(1)).alias("_rows")]
    totals += [F.avg(v).alias(f"_d_{v}") for v in values]
    district = grid.groupBy(outer, inner).agg(*totals)

    def pooled(mean: str, rows: str) -> Column:
        weight = F.when(F.col(mean).isNotNull(), F.col(rows))
        return F.try_divide(F.sum(F.col(mean) * weight), F.sum(weight))

    province = district.groupBy(F.col(outer).alias("_outer")).agg(
        F.sum("_rows").alias("_all"), *[pooled(f"_d_{v}", "_rows").alias(f"_p_{v}") for v in values]
    )
    everywhere = province.agg(
        F.struct(*[pooled(f"_p_{v}", "_all").alias(v) for v in values]).alias("g")
    ).scalar()
    return district.join(province, F.col(outer) == F.col("_outer"), "inner").select(
        F.col(outer).alias("_province"),
        F.col(inner).alias("_district"),
        *[F.coalesce(f"_d_{v}", f"_p_{v}", everywhere[v]).alias(f"_fill_{v}") for v in values],
    )


def fill_hierarchical(
    grid: DataFrame, values: list[str] = PANEL_VARIABLES, levels: list[str] = AREA_KEYS[:2]
) -> DataFrame:
    """Remaining nulls take the district's mean, failing that the province's, failing that the global one."""
    outer, inner = levels
    means = area_level_means(grid, values, levels)
    same = (F.col(outer) == F.col("_province")) & (F.col(inner) == F.col("_district"))
    return grid.join(means, same, "left").select(
        *[F.coalesce(F.col(c), F.col(f"_fill_{c}")).alias(c) if c in values else F.col(c) for c in grid.columns]
    )


def fill_panel(
    panel: DataFrame,
    values: list[str] = PANEL_VARIABLES,
    limit: int = INTERPOLATION_LIMIT,
    keep: Callable[[DataFrame], DataFrame] = lambda seasonal: seasonal,
) -> DataFrame:
    """Month grid, interpolation, climatology, then wider means.

    The wider means and the rows they fill both need the panel as it stands after the climatology. A job passes as
    ``keep`` how to store it (``seasonal_store``); without it the per-area windows run once for each.
    """
    values = [v for v in values if v in panel.columns]
    seasonal = fill_climatology(interpolate_gaps(month_grid(panel, values), values, limit), values)
    return fill_hierarchical(keep(seasonal), values)


def seasonal_store(seasonal: DataFrame) -> DataFrame:
    """Keep the half-filled panel in the shared folder."""
    return stored(seasonal, "seasonal")


def fill_forward_backward(
    df: DataFrame,
    group: list[str],
    order: list[str],
    columns: list[str],
    chunk: list[str] | None = None,
    backward: bool = True,
) -> DataFrame:
    """Carry the last known value forward, then (unless ``backward`` is off) the first known value backward, in every column.

    Without ``chunk`` a group is one window, right for groups bounded by the number of months. With
    ``chunk`` (leading columns of ``order``, such as the month) each chunk is filled by itself and only one
    summary row per chunk travels along the group, so a group of any size is spread over its chunks.
    ``order`` must put the rows of a group in one definite order.
    """
    if not chunk:
        ways = ("lag", "lead") if backward else ("lag",)
        return df.withColumns({c: F.coalesce(F.col(c), *[_near(way, c, group, order) for way in ways]) for c in columns})

    part = [*group, *chunk]
    place = F.struct(*[F.col(o) for o in order])
    ends = df.groupBy(*part).agg(
        *[F.max_by(c, F.when(F.col(c).isNotNull(), place)).alias(f"_l_{c}") for c in columns],
        *[F.min_by(c, F.when(F.col(c).isNotNull(), place)).alias(f"_f_{c}") for c in columns],
    )
    carried = ends.select(
        *[F.col(k).alias(f"_k_{k}") for k in part],
        *[_near("lag", f"_l_{c}", group, chunk).alias(f"_before_{c}") for c in columns],
        *[_near("lead", f"_f_{c}", group, chunk).alias(f"_after_{c}") for c in columns],
    )
    inside = df.select(
        "*",
        *[_near("lag", c, part, order).alias(f"_p_{c}") for c in columns],
        *[_near("lead", c, part, order).alias(f"_n_{c}") for c in columns],
    )
    same = [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in part]
    near = ("_p_", "_before_", "_n_", "_after_") if backward else ("_p_", "_before_")
    return inside.join(carried, same, "left").select(
        *[F.coalesce(c, *[f"{n}{c}" for n in near]).alias(c) if c in columns else F.col(c) for c in df.columns]
    )


def _near(name: str, column: str, group: list[str], order: list[str]) -> Column:
    spec = f"PARTITION BY {', '.join(_quoted(group))} ORDER BY {', '.join(_quoted(order))}"
    return F.expr(f"{name}(`{column}`, 1) IGNORE NULLS OVER ({spec})")


def _quoted(names: list[str]) -> list[str]:
    return [f"`{n}`" for n in names]
