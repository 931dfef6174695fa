"""Shares of pixel squares in zones: how much of each pixel lies in each zone it touches.

The area of a polygon inside a rectangle is the sum over its edges, all rings running the same way round, of the integral of
the edge's x, held between the rectangle's left and right side, over the part of the edge between its lower and upper side. So a
pixel needs no clipped polygon, and the edges that ``zone_cells`` keeps for a grid cell are enough for a pixel that begins in
that cell, where cells reach beyond their own area by a pixel's size.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from arealis.functions.geometry import bounding_box, ring_edges
from arealis.operators.zones import zone_cells, zone_level
from arealis.session import stored

#: A share below this is a touch or a rounding error and no share.
LEAST_SHARE = 1e-12
#: Pairs of a pixel and a zone in one cell that one task looks at; a cell with more is dealt out by a salt.
CROWD = 4_000_000
#: Shares of the pixels of one place that one task multiplies; a place with more is cut, also one with a larger part of all
#: shares than one in ``PARTS``, if these are more than ``FEW``.
GATHERED, PARTS, FEW = 2_000_000, 64, 50_000
#: A place is cut into ``4 ** DEPTH`` parts at most before its pixels are dealt out by their keys.
DEPTH = 6
#: Numbers of a block of shares, zones by pixels.
BLOCK = 4_000_000


def oriented(rings: Column) -> Column:
    """The rings with outer ones counter-clockwise and holes clockwise."""

    def twice_area(points: Column) -> Column:
        return F.aggregate(ring_edges(points), F.lit(0.0), lambda acc, e: acc + e["x1"] * e["y2"] - e["x2"] * e["y1"])

    return F.transform(
        rings,
        lambda r: F.struct(
            r["hole"].alias("hole"),
            F.when((twice_area(r["points"]) < 0) != r["hole"], F.reverse(r["points"])).otherwise(r["points"]).alias("points"),
        ),
    )


def _held(v: Column, low: Column | float, high: Column | float) -> Column:
    return F.least(F.greatest(v, low if isinstance(low, Column) else F.lit(low)), high if isinstance(high, Column) else F.lit(high))


#: An edge's ends held between the lower and upper side, and what the rectangle's sides cut off: each step reads the one before.
def _within_height(e: Column, y0: Column, y1: Column) -> dict[str, Column]:
    slope = F.try_divide(e["x2"] - e["x1"], e["y2"] - e["y1"])
    return {"_ya": _held(e["y1"], y0, y1), "_yb": _held(e["y2"], y0, y1), "_slope": slope}


def _ends(e: Column, s: Callable[[str], Column]) -> dict[str, Column]:
    # an end that stays keeps its x to the last bit
    return {
        "_xa": F.when(s("_ya") == e["y1"], e["x1"]).otherwise(e["x1"] + s("_slope") * (s("_ya") - e["y1"])),
        "_xb": F.when(s("_yb") == e["y2"], e["x2"]).otherwise(e["x1"] + s("_slope") * (s("_yb") - e["y1"])),
    }


def _passes(x0: Column, x1: Column, s: Callable[[str], Column]) -> dict[str, Column]:
    # shares of the part's way at which it passes the left and the right side
    sides = {"_left": x0, "_right": x1}
    return {k: F.coalesce(_held(F.try_divide(v - s("_xa"), s("_xb") - s("_xa")), 0.0, 1.0), F.lit(0.0)) for k, v in sides.items()}


def _turns(s: Callable[[str], Column]) -> dict[str, Column]:
    return {"_enters": F.least(s("_left"), s("_right")), "_leaves": F.greatest(s("_left"), s("_right"))}


def _beside(x0: Column, x1: Column, s: Callable[[str], Column]) -> Column:
    """What the edge adds to the area."""
    run, enters, leaves = s("_xb") - s("_xa"), s("_enters"), s("_leaves")
    middle = (_held(s("_xa") + enters * run, x0, x1) + _held(s("_xa") + leaves * run, x0, x1)) / 2
    mean = enters * _held(s("_xa"), x0, x1) + (leaves - enters) * middle + (1 - leaves) * _held(s("_xb"), x0, x1)
    return F.when(s("_ya") == s("_yb"), 0.0).otherwise((s("_yb") - s("_ya")) * (mean - x0))


def area_within(edges: Column, x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    """Area of the polygon with these edges inside a rectangle, with ``oriented`` rings; edges left of it may be missing."""

    def part(e: Column) -> Column:
        known: dict[str, Column] = {}
        known |= _within_height(e, y0, y1)
        known |= _ends(e, known.__getitem__)
        known |= _passes(x0, x1, known.__getitem__)
        known |= _turns(known.__getitem__)
        return _beside(x0, x1, known.__getitem__)

    return F.aggregate(edges, F.lit(0.0), lambda acc, e: acc + part(e))


def _with_area(rows: DataFrame, e: Column, x0: Column, y0: Column, x1: Column, y1: Column) -> DataFrame:
    """``area_within`` of single edges as column ``_beside``, step by step: one expression of it all is too long to be compiled."""
    rows = rows.withColumns(_within_height(e, y0, y1))
    rows = rows.withColumns(_ends(e, F.col))
    rows = rows.withColumns(_passes(x0, x1, F.col))
    return rows.withColumns(_turns(F.col)).withColumn("_beside", _beside(x0, x1, F.col))


def area_around(edges: Column, x: Column, y: Column) -> Column:
    """Area of the polygon with these edges, all of them; ``x`` and ``y`` are a point near them."""
    cross = lambda e: (e["x1"] - x) * (e["y2"] - y) - (e["x2"] - x) * (e["y1"] - y)
    return F.aggregate(edges, F.lit(0.0), lambda acc, e: acc + cross(e)) / 2


def _dealt(placed: DataFrame, cells: DataFrame, crowd: int) -> tuple[DataFrame, DataFrame]:
    """Pixels and zones by cell with ``_salt``, in as many partitions as their pairs ask for, not their bytes."""
    spark, place = placed.sparkSession, ["_level", "_cx", "_cy"]
    pixels, zones = (df.groupBy(*place).agg(F.count(F.lit(1)).alias(n)) for df, n in ((placed, "_p"), (cells, "_z")))
    pairs = F.col("_p").cast("double") * F.col("_z")
    salts = F.least(F.ceil(pairs / crowd), F.col("_p")).cast("int")
    counts = stored(pixels.join(zones, place).select(*place, pairs.alias("_pairs"), salts.alias("_salts")), "pairs")
    total = counts.agg(F.sum("_pairs")).first()[0] or 0.0
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism, int(4 * total / crowd))
    crowded = counts.where(F.col("_salts") > 1).select(*place, "_salts")
    salt = F.col("_salts")
    if crowded.isEmpty():
        pixels, zones = (df.withColumn("_salt", F.lit(0)) for df in (placed, cells))
    else:
        pixels = placed.join(crowded, place, "left").withColumn("_salt", F.floor(F.rand(5) * F.coalesce(salt, F.lit(1))).cast("int"))
        zones = cells.join(crowded, place, "left").withColumn("_salt", F.explode(F.sequence(F.lit(0), F.coalesce(salt, F.lit(1)) - 1)))
    return tuple(df.drop("_salts").repartition(parts, *place, "_salt") for df in (pixels, zones))


def pixel_shares(
    pixels: DataFrame, zones: DataFrame, names: list[str], keys: list[str], width: float, height: float, x: str = "x", y: str = "y",
    crowd: int = CROWD,
) -> DataFrame:
    """Keys of each pixel, names of each zone it touches and ``share``, the part of the pixel's area that lies in the zone.

    Pixels are ``width`` by ``height`` around ``x`` and ``y``. Rows without a centre touch nothing. Where zones tile the plane the
    shares of a pixel add up to one; where they overlap, to more.

    Zones lie on grids whose cells suit their size but are no smaller than a pixel. A pixel lies in the cell of its lower left
    corner, so it meets a zone once. Pairs are found by an equi-join on cells; where their boxes overlap and neither holds the
    other, the zone's edges near the cell are looked at as rows, which add up before the shuffle to one row per pair.
    """
    least = F.ceil(F.log2(F.lit(float(max(width, height))))).cast("int")
    level = F.greatest(zone_level(F.col("rings")), least)
    turned = zones.select(*names, oriented(F.col("rings")).alias("rings"), bounding_box(F.col("rings")).alias("_box"))
    cells = zone_cells(turned, [*names, "_box"], F.pow(F.lit(2.0), level), level, (width, height))
    # where an edge lacks a coordinate no area is known
    gap = F.exists("edges", lambda e: (e["x1"] + e["y1"] + e["x2"] + e["y2"]).isNull())
    found = cells.where(~F.coalesce(gap, F.lit(False))).select(
        *names, F.col("level").alias("_level"), F.col("cx").alias("_cx"), F.col("cy").alias("_cy"), "_box", "edges",
        area_around(F.col("edges"), F.col("_box.x0"), F.col("_box.y0")).alias("_area"),
    )
    found = stored(found, "cells")
    levels = zones.agg(F.collect_set(level).alias("levels")).scalar()

    cell = F.pow(F.lit(2.0), F.col("_level"))
    sides = {"_x0": F.col(x) - width / 2, "_y0": F.col(y) - height / 2, "_x1": F.col(x) + width / 2, "_y1": F.col(y) + height / 2}
    placed = pixels.select(*keys, *[v.alias(k) for k, v in sides.items()]).withColumn("_level", F.explode(levels))
    placed = placed.withColumns({f"_c{c}": F.floor(F.col(f"_{c}0") / cell) for c in "xy"}).where("_cx is not null and _cy is not null")
    placed, found = _dealt(placed, found, crowd)
    x0, y0, x1, y1 = (F.col(k) for k in sides)
    meet = (x0 < F.col("_box.x1")) & (x1 > F.col("_box.x0")) & (y0 < F.col("_box.y1")) & (y1 > F.col("_box.y0"))
    pairs = placed.join(found, ["_level", "_cx", "_cy", "_salt"]).where(meet)
    # a pixel that holds the zone has all its edges near its cell
    held = (x0 <= F.col("_box.x0")) & (x1 >= F.col("_box.x1")) & (y0 <= F.col("_box.y0")) & (y1 >= F.col("_box.y1"))
    known = F.when(F.col("edges").isNull(), (x1 - x0) * (y1 - y0)).when(held, F.col("_area"))
    pairs = pairs.select(*keys, *names, *sides, "edges", known.alias("_known"))
    pieces = pairs.select(*keys, *names, *sides, "_known", F.explode_outer(F.when(F.col("_known").isNull(), F.col("edges"))).alias("_e"))
    e = F.col("_e")
    # edges below, above or left of the pixel add nothing
    near = (F.greatest(e["y1"], e["y2"]) > y0) & (F.least(e["y1"], e["y2"]) < y1) & (F.greatest(e["x1"], e["x2"]) > x0)
    parts = _with_area(pieces.where(F.col("_known").isNotNull() | near), e, x0, y0, x1, y1)
    shares = parts.groupBy(*keys, *names).agg((F.sum(F.coalesce("_known", "_beside")) / F.lit(width * height)).alias("share"))
    return shares.where(F.col("share") > LEAST_SHARE)


def _gathering(shares: DataFrame, places: DataFrame, pixel: list[str], cell: tuple[float, float], x: str, y: str, crowd: int) -> DataFrame:
    """Keys of each pixel that has shares and ``_place``, a number shared by neighbours; which pixels share it decides no result."""
    at = places.groupBy(*pixel).agg(F.min(F.struct(F.col(x).alias("x"), F.col(y).alias("y"))).alias("_at"))
    counts = stored(shares.groupBy(*pixel).agg(F.count(F.lit(1)).alias("_n")).join(at, pixel, "left"), "pixels")
    crowd = min(crowd, max(FEW, (counts.agg(F.sum("_n")).first()[0] or 0) // PARTS))
    within = lambda size: [F.floor(F.col(f"_at.{c}") / (F.lit(float(w)) * size)) for c, w in zip("xy", cell, strict=True)]
    by = lambda place: Window.partitionBy(place)
    whole = counts.withColumn("_place", F.xxhash64(*within(F.lit(1.0))))
    depth = F.least(F.greatest(F.ceil(F.log(4.0, F.sum("_n").over(by("_place")) / crowd)), F.lit(0)), F.lit(DEPTH)).cast("int")
    cut = whole.withColumn("_depth", depth)
    cut = cut.withColumn("_place", F.xxhash64("_depth", *within(F.pow(F.lit(2.0), -F.col("_depth")))))
    # what still crowds a place lies on one spot
    salts = F.ceil(F.sum("_n").over(by("_place")) / (2 * crowd))
    dealt = cut.withColumn("_salt", F.pmod(F.xxhash64(*pixel), salts))
    return stored(dealt.select(*pixel, F.xxhash64("_place", "_salt").alias("_place")), "places")


def _numbered(rows: pa.Table, columns: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Number of each row's values, nulls being equal, and for each number a row that has it."""
    code = np.zeros(len(rows), np.int64)
    for name in columns:
        coded = pa.concat_arrays(rows[name].chunks).dictionary_encode("encode")
        code = code * len(coded.dictionary) + coded.indices.to_numpy()
    _, first, number = np.unique(code, return_index=True, return_inverse=True)
    return number.ravel(), first


def _summed(share: np.ndarray, values: np.ndarray, known: np.ndarray) -> np.ndarray:
    """``share @ values`` in which a number that is not finite counts only where the other is there."""
    odd = ~(np.isfinite(share).all(axis=0) & np.isfinite(values).all(axis=1))
    total = np.where(odd, 0.0, share) @ np.where(odd[:, None], 0.0, values)
    for p in np.flatnonzero(odd):
        met, seen = np.flatnonzero(share[:, p]), np.flatnonzero(known[p])
        total[np.ix_(met, seen)] += share[met, p][:, None] * values[p, seen]
    return total


def gathered(
    composites: DataFrame, shares: DataFrame, places: DataFrame, pixel: list[str], zone: list[str], bands: list[str], cell: tuple[float, float],
    weight: str = "share", x: str = "x", y: str = "y", crowd: int = GATHERED,
) -> DataFrame:
    """Composites of the pixels of a zone, those of one place taken together: zone, year, month, the bands' means weighted by
    the shares, and the sum of shares ``<band>_share`` of each. ``zonal`` reduces these to what it makes of all single pairs.

    A row for every pixel, month and zone that meet would be shuffled almost whole, as few pixels of a task share a zone. Here
    composites and shares of neighbours meet in one task, where sums over pixels are matrix products, and a zone leaves few
    rows a month. Places are ``cell`` wide and high and are cut where they have more than ``crowd`` shares. Shares are above 0.
    """
    kinds = dict(shares.dtypes)
    schema = ", ".join([*(f"`{c}` {kinds[c]}" for c in zone), "year int, month int", *(f"`{b}` double, `{b}_share` double" for b in bands)])
    month = ["year", "month"]

    def gather(met: pa.Table, seen: pa.Table) -> pa.Table:
        target = pa.schema([(c, met.schema.field(c).type) for c in zone] + [(c, pa.int32()) for c in month]
                           + [(n, pa.float64()) for b in bands for n in (b, f"{b}_share")])
        if not len(met) or not len(seen):
            return target.empty_table()
        number, _ = _numbered(pa.concat_tables([met.select(pixel), seen.select(pixel)], promote_options="permissive"), pixel)
        of_share, of_value = number[: len(met)], number[len(met) :]
        in_zone, zone_row = _numbered(met, zone)
        in_month, month_row = _numbered(seen, month)
        size, months, share = int(number.max()) + 1, len(month_row), met[weight].to_numpy()

        def table(values: np.ndarray) -> np.ndarray:
            out = np.zeros((size, months))
            np.add.at(out, (of_value, in_month), values)
            return out

        there = table(np.ones(len(seen)))
        known = [seen[b].is_valid().to_numpy() for b in bands]
        counts = [there if k.all() else table(k.astype(float)) for k in known]
        values = [table(seen[b].fill_null(0.0).to_numpy()) for b in bands]
        order = np.argsort(in_zone, kind="stable")
        start = np.searchsorted(in_zone[order], np.arange(len(zone_row) + 1))
        step, parts = max(1, BLOCK // max(size, months)), []
        for z in range(0, len(zone_row), step):
            end = min(z + step, len(zone_row))
            rows = order[start[z] : start[end]]
            block = np.zeros((end - z, size))
            np.add.at(block, (in_zone[rows] - z, of_share[rows]), share[rows])
            touched = (block != 0).astype(float)
            i, m = np.nonzero(touched @ there)
            whole = _summed(block, there, there)
            columns = [met[c].take(zone_row[z + i]) for c in zone] + [seen[c].take(month_row[m]) for c in month]
            for count, value, k in zip(counts, values, known, strict=True):
                weights = (whole if count is there else _summed(block, count, count))[i, m]
                none = np.zeros(len(i), bool) if k.all() else (touched @ count)[i, m] == 0
                with np.errstate(all="ignore"):
                    means = _summed(block, value, count)[i, m] / weights
                columns += [pa.array(means, mask=none, from_pandas=False), pa.array(weights, mask=none, from_pandas=False)]
            parts.append(pa.Table.from_arrays(columns, schema=target))
        return pa.concat_tables(parts)

    at = _gathering(shares, places, pixel, cell, x, y, crowd)
    # columns of their own: both sides may come from one table
    seen = composites.select(*[F.col(c).alias(c) for c in [*pixel, *month]], *[F.col(b).cast("double").alias(b) for b in bands])
    met = shares.select(*pixel, *zone, weight).join(at, pixel).groupBy("_place")
    return met.cogroup(seen.join(at.withColumnRenamed("_place", "_there"), pixel).groupBy("_there")).applyInArrow(gather, schema)
