"""Seasonal baseline, DTW distance of each year to it, z-scores and flags.

Input is a panel with one row per area and month. Everything per area runs on one partitioning by area:
months -> one row per area and year -> one row per area holding its years -> back to years.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from arealis.functions.dtw import dtw_arrow, dtw_column, is_complete
from arealis.registry import (
    AREA_KEYS,
    LOCAL_SIGMAS,
    MONTHS_PER_YEAR,
    PANEL_VARIABLES,
    TRIM_RATIO,
    Z_THRESHOLD,
)

MONTHS = range(1, MONTHS_PER_YEAR + 1)
# A standard deviation this small beside the mean is rounding noise of equal distances, not spread.
RELATIVE_SPREAD = 1e-12


def year_vectors(
    panel: DataFrame, variables: list[str] = PANEL_VARIABLES, keys: list[str] = AREA_KEYS
) -> DataFrame:
    """One row per area and year: the 12 monthly values of each variable as an array, and the row count.

    A missing month is a null element; rows lacking an area key belong to no area. Twelve conditional
    aggregates keep the state per group fixed.
    """
    def vector(v: str) -> Column:
        months = [f"max(CASE WHEN month = {m} THEN CAST(`{v}` AS DOUBLE) END)" for m in MONTHS]
        return F.expr(f"array({', '.join(months)})").alias(v)

    grouped = panel.na.drop("any", subset=keys).groupBy(*keys, "year")
    return grouped.agg(F.count(F.lit(1)).alias("n_months"), *[vector(v) for v in variables])


def _seasonal(variable: str, ratio: float) -> Column:
    """Twelve trimmed means over the column ``years``: per month, sort, cut ``floor(ratio * n)`` off each end, average."""
    last = MONTHS_PER_YEAR - 1
    known = f"filter(transform(years, y -> get(y.`{variable}`, m)), v -> v IS NOT NULL)"
    cut = f"CAST(floor({float(ratio)}D * size(s)) AS INT)"
    kept = f"slice(s, {cut} + 1, size(s) - 2 * {cut})"
    mean = f"CASE WHEN size(s) > 0 THEN aggregate({kept}, 0D, (a, v) -> a + v) / (size(s) - 2 * {cut}) END"
    return F.expr(f"transform(transform(sequence(0, {last}), m -> array_sort({known})), s -> {mean})")


def area_histories(
    panel: DataFrame,
    variables: list[str] = PANEL_VARIABLES,
    ratio: float = TRIM_RATIO,
    keys: list[str] = AREA_KEYS,
) -> DataFrame:
    """One row per area: its year vectors and, per variable, the 12-month trimmed-mean baseline.

    The collected list holds one element per year, since ``year_vectors`` has one row per area and year.
    """
    yearly = year_vectors(panel, variables, keys)
    gathered = yearly.groupBy(*keys).agg(
        F.collect_list(F.struct("year", "n_months", *variables)).alias("years")
    )
    return gathered.select(
        *keys, "years", *[_seasonal(v, ratio).alias(f"baseline_{v}") for v in variables]
    )


def trimmed_baseline(
    panel: DataFrame,
    variables: list[str] = PANEL_VARIABLES,
    ratio: float = TRIM_RATIO,
    keys: list[str] = AREA_KEYS,
) -> DataFrame:
    """Baseline as rows: one per area and calendar month, one column per variable."""
    histories = area_histories(panel, variables, ratio, keys)
    month = F.explode(F.sequence(F.lit(1), F.lit(MONTHS_PER_YEAR))).alias("month")
    return histories.select(*keys, month, *[f"baseline_{v}" for v in variables]).select(
        *keys, "month", *[F.get(F.col(f"baseline_{v}"), F.col("month") - 1).alias(v) for v in variables]
    )


def baseline_columns(variables: list[str] = PANEL_VARIABLES) -> list[Column]:
    """``baseline_<variable>_m01 .. m12`` out of the baseline arrays."""
    return [
        F.expr(f"get(`baseline_{v}`, {m - 1}) AS baseline_{v.lower()}_m{m:02d}")
        for v in variables
        for m in MONTHS
    ]


def baseline_wide(
    panel: DataFrame,
    variables: list[str] = PANEL_VARIABLES,
    ratio: float = TRIM_RATIO,
    keys: list[str] = AREA_KEYS,
) -> DataFrame:
    """One row per area with all baseline months as columns."""
    return area_histories(panel, variables, ratio, keys).select(*keys, *baseline_columns(variables))


def dtw_area_years(
    panel: DataFrame,
    variables: list[str] = PANEL_VARIABLES,
    ratio: float = TRIM_RATIO,
    keys: list[str] = AREA_KEYS,
    arrow: bool = True,
    with_baseline: bool = False,
) -> DataFrame:
    """Distance of each area-year to the area's baseline, ``dtw_<variable>``; ``with_baseline`` keeps the baseline arrays.

    Null unless the year has twelve rows, one per calendar month, and neither side holds a null.
    ``arrow`` runs whole batches of pairs through the Arrow kernel; otherwise the distance is a built-in
    expression evaluated pair by pair, which needs no Python worker but takes many times as long.
    """
    histories = area_histories(panel, variables, ratio, keys)
    yearly = histories.select(
        *keys, F.explode("years").alias("y"), *[f"baseline_{v}" for v in variables]
    )
    measure = dtw_arrow() if arrow else dtw_column

    def distance(v: str) -> Column:
        x, y = F.col(f"y.{v}"), F.col(f"baseline_{v}")
        usable = (F.col("y.n_months") == MONTHS_PER_YEAR) & is_complete(x) & is_complete(y)
        # Unusable pairs reach the kernel as null, so it never warps them.
        return measure(F.when(usable, x), F.when(usable, y)).alias(f"dtw_{v.lower()}")

    extra = [f"baseline_{v}" for v in variables] if with_baseline else []
    return yearly.select(*keys, F.col("y.year").alias("year"), *extra, *[distance(v) for v in variables])


def local_stats(
    distances: DataFrame, variables: list[str] = PANEL_VARIABLES, stats_keys: list[str] = AREA_KEYS[1:]
) -> DataFrame:
    """Mean and sample standard deviation of the distances over all years of an area.

    The grouping leaves the province out by default: places sharing district and subdistrict name share
    their statistics. Distances have one row per area and year, so a group has provinces x years rows at most.
    """
    w = W.partitionBy(*stats_keys)
    columns = {}
    for v in variables:
        d = f"dtw_{v.lower()}"
        columns[f"{d}_local_mean"] = F.avg(d).over(w)
        columns[f"{d}_local_std"] = F.stddev_samp(d).over(w)
    return distances.withColumns(columns)


def z_scores(stats: DataFrame, variables: list[str] = PANEL_VARIABLES) -> DataFrame:
    """``(distance - mean) / std``; null where there is no spread."""

    def z(d: str) -> Column:
        std, mean = F.col(f"{d}_local_std"), F.col(f"{d}_local_mean")
        return F.try_divide(F.col(d) - mean, F.when(std > F.abs(mean) * RELATIVE_SPREAD, std))

    return stats.withColumns({f"dtw_{v.lower()}_z": z(f"dtw_{v.lower()}") for v in variables})


def z_flags(
    scored: DataFrame, variables: list[str] = PANEL_VARIABLES, threshold: float = Z_THRESHOLD
) -> DataFrame:
    """1 where the z-score exceeds the threshold, else 0; a null z-score gives 0."""
    return scored.withColumns(
        {
            f"dtw_{v.lower()}_z_flag": F.coalesce(F.col(f"dtw_{v.lower()}_z") > threshold, F.lit(False)).cast("int")
            for v in variables
        }
    )


def local_flags(
    stats: DataFrame, variables: list[str] = PANEL_VARIABLES, sigmas: float = LOCAL_SIGMAS
) -> DataFrame:
    """Threshold ``mean + sigmas * std`` of each area and whether the distance exceeds it."""
    columns = {}
    for v in variables:
        d = f"dtw_{v.lower()}"
        limit = F.col(f"{d}_local_mean") + sigmas * F.col(f"{d}_local_std")
        columns[f"{d}_local_threshold"] = limit
        columns[f"{d}_flag"] = F.coalesce(F.col(d) > limit, F.lit(False)).cast("int")
    return stats.withColumns(columns)


def composite_index(flagged: DataFrame, variables: list[str] = PANEL_VARIABLES) -> DataFrame:
    """Mean of the z-scores present and the number of flags set, over all variables of an area-year."""
    zs = [F.col(f"dtw_{v.lower()}_z") for v in variables]
    present = sum((z.isNotNull().cast("int") for z in zs), F.lit(0))
    total = sum((F.coalesce(z, F.lit(0.0)) for z in zs), F.lit(0.0))
    flags = sum((F.col(f"dtw_{v.lower()}_z_flag") for v in variables), F.lit(0))
    return flagged.withColumns(
        {"anomaly_index": F.when(present > 0, total / present), "anomaly_flags": flags}
    )


def anomaly_table(
    panel: DataFrame,
    variables: list[str] = PANEL_VARIABLES,
    ratio: float = TRIM_RATIO,
    threshold: float = Z_THRESHOLD,
    stats_keys: list[str] = AREA_KEYS[1:],
    arrow: bool = True,
    keep_stats: bool = False,
) -> DataFrame:
    """One row per area and year: keys, 60 baseline columns, distances, z-scores and flags.

    ``keep_stats`` adds the local mean, deviation, threshold and flag. The panel is shuffled once, by ``stats_keys``: years
    and histories group by these keys and more. So do the local statistics, but behind the Arrow kernel Spark does not know
    and shuffles the distances too. Baselines become columns after the window.
    """
    used = panel.select(*AREA_KEYS, "year", "month", *variables).na.drop("any", subset=AREA_KEYS)
    distances = dtw_area_years(used.repartition(*stats_keys), variables, ratio, arrow=arrow, with_baseline=True)
    flagged = z_flags(z_scores(local_stats(distances, variables, stats_keys), variables), variables, threshold)
    if keep_stats:
        flagged = local_flags(flagged, variables)
    stats = [] if keep_stats else [f"dtw_{v.lower()}_local_{s}" for v in variables for s in ("mean", "std")]
    left_out = {*AREA_KEYS, "year", *stats, *[f"baseline_{v}" for v in variables]}
    scores = [c for c in flagged.columns if c not in left_out]
    return flagged.select(*AREA_KEYS, "year", *baseline_columns(variables), *scores)
