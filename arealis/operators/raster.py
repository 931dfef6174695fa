"""Monthly composites of pixel series and their reduction to zones."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arealis.registry import FIRE_MASK_MIN, VARIABLES, Variable

REDUCERS = {"mean": F.avg, "sum": F.sum}


def fire_indicator(mask: Column | str, threshold: int = FIRE_MASK_MIN) -> Column:
    """1 for a fire pixel, 0 otherwise; a masked pixel stays null."""
    mask = F.col(mask) if isinstance(mask, str) else mask
    return (mask >= threshold).cast("int")


def select_band(images: DataFrame, band: str) -> DataFrame:
    """One band of a long image table."""
    return images.where(F.col("band") == band)


def composite(
    images: DataFrame, pixel: list[str], bands: dict[str, str], ts: str = "image_ts"
) -> DataFrame:
    """One value per pixel, month and band; ``bands`` names ``mean`` or ``sum`` for each. Nulls are skipped.

    Bands of one grid share the shuffle. Partial sums are formed per map task, so the shuffle carries one row
    per task, pixel and month however often a pixel was seen.
    """
    return images.groupBy(*pixel, F.year(ts).alias("year"), F.month(ts).alias("month")).agg(
        *[REDUCERS[how](band).alias(band) for band, how in bands.items()]
    )


def zonal(
    composites: DataFrame, zone: list[str], bands: dict[str, str], weight: str | dict[str, str] | None = None
) -> DataFrame:
    """One value per zone, month and band over the zone's pixels.

    ``weight`` names a column with the share of the pixel that lies in the zone, or one for each band; without it a pixel
    counts fully in the zone of its centre.
    """

    def reduced(band: str, how: str) -> Column:
        if not weight:
            return REDUCERS[how](band)
        share = F.when(F.col(band).isNotNull(), F.col(weight if isinstance(weight, str) else weight[band]))
        total = F.sum(F.col(band) * share)
        return total if how == "sum" else F.try_divide(total, F.sum(share))

    return composites.groupBy(*zone, "year", "month").agg(
        *[reduced(band, how).alias(band) for band, how in bands.items()]
    )


def zonal_month_sum(images: DataFrame, zone: list[str], band: str, ts: str = "image_ts") -> DataFrame:
    """Sum composite followed by zonal sum. The two sums are one, so the per-pixel shuffle is left out."""
    return images.groupBy(*zone, F.year(ts).alias("year"), F.month(ts).alias("month")).agg(F.sum(band).alias(band))


def zonal_monthly(
    images: DataFrame,
    pixel: list[str],
    zone: list[str],
    zone_of,
    variables: list[Variable] | None = None,
    ts: str = "image_ts",
) -> DataFrame:
    """All variables of all months as the export table: zone, year, month, variable, ``mean``, ``sum``.

    ``images`` has one column per variable; ``zone_of`` maps composites to zones (a join on a pixel key or
    a polygon join) and runs after the composite, on one row per pixel and month. The reducer of a
    variable decides which of the two value columns is filled.
    """
    variables = variables or list(VARIABLES.values())
    monthly = composite(images, pixel, {v.name: v.composite for v in variables}, ts)
    reduced = zonal(zone_of(monthly), zone, {v.name: v.reducer for v in variables})
    keys = [*zone, "year", "month"]
    long = reduced.withColumns({v.name: F.col(v.name).cast("double") for v in variables}).unpivot(
        keys, [v.name for v in variables], "variable", "value"
    )
    summed = F.col("variable").isin([v.name for v in variables if v.reducer == "sum"])
    return long.select(
        *keys, "variable", F.when(~summed, F.col("value")).alias("mean"), F.when(summed, F.col("value")).alias("sum")
    )
