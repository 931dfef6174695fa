"""Shares of pixels in zones against clipped polygons, tilings and known areas."""

import math
import random

import pytest
from pyspark.sql import functions as F

from arealis.functions.geometry import RINGS_TYPE, zone_edges
from arealis.operators import raster, shares, zones
from arealis.plans import catalog


def ring(points, hole=False):
    return (hole, [(float(x), float(y)) for x, y in [*points, points[0]]])


def layer(spark, shapes):
    return spark.createDataFrame([(n, rings) for n, rings in shapes.items()], f"name string, rings {RINGS_TYPE}")


def clipped_area(points, box):
    """Area of a simple polygon inside a rectangle: clipped by one side after the other."""
    x0, y0, x1, y1 = box
    for axis, bound, keep in ((0, x0, 1), (0, x1, -1), (1, y0, 1), (1, y1, -1)):
        out = []
        for a, b in zip(points, [*points[1:], points[0]]):
            ina, inb = (keep * (p[axis] - bound) >= 0 for p in (a, b))
            if ina:
                out.append(a)
            if ina != inb:
                t = (bound - a[axis]) / (b[axis] - a[axis])
                out.append((a[0] + t * (b[0] - a[0]), a[1] + t * (b[1] - a[1])))
        points = out
        if not points:
            return 0.0
    return abs(sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(points, [*points[1:], points[0]]))) / 2


def plain_shares(shapes, pixels, width, height):
    out = {}
    for p, x, y in pixels:
        box = (x - width / 2, y - height / 2, x + width / 2, y + height / 2)
        for n, rings in shapes.items():
            area = sum((-1 if hole else 1) * clipped_area(points[:-1], box) for hole, points in rings)
            if area > 1e-12 * width * height:
                out[p, n] = area / (width * height)
    return out


def star(draw, x, y, low, high, corners=9):
    at = sorted(draw.uniform(0, 2 * math.pi) for _ in range(corners))
    return [(x + r * math.cos(k), y + r * math.sin(k)) for k, r in ((k, draw.uniform(low, high)) for k in at)]


@pytest.mark.parametrize("width, height", [(0.05, 0.05), (0.7, 0.4), (3.0, 5.0)])
def test_shares_equal_clipped_polygons(spark, width, height):
    """Stars of very different sizes, some turned round, some with holes, pixels smaller and larger than zones."""
    draw = random.Random(3)
    shapes = {}
    for k in range(14):
        x, y, size = draw.uniform(-2, 2), draw.uniform(-2, 2), 10 ** draw.uniform(-2, 0.3)
        points = star(draw, x, y, size * 0.6, size)
        shapes[f"z{k}"] = [ring(points[:: draw.choice([1, -1])])]
        if k % 3 == 0:
            hole = [(x + dx * size * 0.05, y + dy * size * 0.05) for dx, dy in ((-1, -1), (1, -1), (1, 1), (-1, 1))]
            if min(math.hypot(*(a - b for a, b in zip(p, (x, y)))) for p in points) > size * 0.3 and _holds(points, hole):
                shapes[f"z{k}"].append(ring(hole[:: draw.choice([1, -1])], True))
    shapes["box"] = [ring([(-1, -1), (1, -1), (1, 1), (-1, 1)])]
    shapes["two"] = [ring([(-3, -3), (-2, -3), (-2, -2)]), ring([(2, 2), (3, 2), (3, 3), (2, 3)])]
    pixels = [(k, draw.uniform(-3, 3), draw.uniform(-3, 3)) for k in range(150)] + [(900, 0.0, 0.0), (901, 1.0, 1.0), (902, 50.0, 50.0)]
    df = spark.createDataFrame([*pixels, (903, None, 1.0)], "p int, x double, y double")
    found = shares.pixel_shares(df, layer(spark, shapes), ["name"], ["p"], width, height).collect()
    want = plain_shares(shapes, pixels, width, height)
    got = {(r.p, r.name): r.share for r in found}
    assert len(got) == len(found) and set(got) == set(want)
    assert max(abs(got[k] - want[k]) for k in want) < 1e-9


def _holds(points, inner):
    """Whether all inner points lie in the polygon."""
    def inside(x, y):
        return sum((a[1] > y) != (b[1] > y) and x < (b[0] - a[0]) * (y - a[1]) / (b[1] - a[1]) + a[0] for a, b in zip(points, [*points[1:], points[0]])) % 2
    return all(inside(*p) for p in inner)


def test_shares_over_a_tiling_add_up_to_one(spark):
    draw, n = random.Random(5), 6
    corner = {(i, j): (i + draw.uniform(-0.3, 0.3) * (0 < i < n), j + draw.uniform(-0.3, 0.3) * (0 < j < n)) for i in range(n + 1) for j in range(n + 1)}
    shapes = {f"{i},{j}": [ring([corner[i, j], corner[i + 1, j], corner[i + 1, j + 1], corner[i, j + 1]])] for i in range(n) for j in range(n)}
    pixels = spark.range(400).selectExpr("id AS p", "0.5 + 5 * rand(7) AS x", "0.5 + 5 * rand(8) AS y")
    for width in (0.01, 0.33, 1.0):
        sums = shares.pixel_shares(pixels, layer(spark, shapes), ["name"], ["p"], width, width).groupBy("p").agg(F.sum("share").alias("s"))
        assert sums.count() == 400
        assert sums.agg(F.max(F.abs(F.col("s") - 1))).first()[0] < 1e-9


def test_known_areas(spark):
    shapes = layer(spark, {"tri": [ring([(0, 0), (2, 0), (0, 2)])], "flat": [ring([(0, 0), (1, 1), (2, 2)])]})
    edges = zone_edges(shares.oriented(F.col("rings")))
    at = lambda *box: shares.area_within(edges, *map(F.lit, map(float, box)))
    r = shapes.where("name = 'tri'").select(at(0, 0, 2, 2).alias("a"), at(0, 0, 1, 1).alias("b"), at(1, 1, 2, 2).alias("c"), at(0.5, 0.5, 1, 1).alias("d")).first()
    assert (r.a, r.b, r.c, r.d) == (2.0, 1.0, 0.0, 0.25)
    assert shapes.where("name = 'flat'").select(at(0, 0, 2, 2).alias("a")).first().a == 0
    pixel = spark.createDataFrame([(1, 1.0, 1.0)], "p int, x double, y double")
    assert shares.pixel_shares(pixel, shapes.limit(0), ["name"], ["p"], 1.0, 1.0).count() == 0


def test_a_pixel_falls_into_few_cells(spark):
    """Tiny zones under a large pixel do not multiply it: their cells are no smaller than the pixel."""
    tiny = {f"t{k}": [ring([(k / 100, 0), (k / 100 + 1e-3, 0), (k / 100, 1e-3)])] for k in range(50)}
    pixel = spark.createDataFrame([(1, 0.25, 0.0)], "p int, x double, y double")
    found = shares.pixel_shares(pixel, layer(spark, tiny), ["name"], ["p"], 1.0, 1.0)
    assert found.count() == 50 and abs(found.agg(F.sum("share")).first()[0] - 50 * 5e-7) < 1e-12
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan and "Python" not in plan


def test_pairs_are_dealt_out_and_compiled(spark):
    """Pixels on one spot under many zones are dealt out by a salt, and no pair's edges are walked by an interpreted fold."""
    draw = random.Random(9)
    shapes = {f"z{k}": [ring(star(draw, draw.uniform(0.4, 0.6), draw.uniform(0.4, 0.6), 0.02, 0.3))] for k in range(20)}
    shapes["dot"] = [ring([(0.5, 0.5), (0.51, 0.5), (0.5, 0.51)])]
    pixels = [(k, 0.5 + (k % 7) * 1e-3, 0.5) for k in range(120)]
    df = spark.createDataFrame([*pixels, (0, 0.5, 0.5), (500, None, 0.5)], "p int, x double, y double")
    found = shares.pixel_shares(df, layer(spark, shapes), ["name"], ["p"], 0.1, 0.07, crowd=300)
    want = plain_shares(shapes, pixels, 0.1, 0.07)
    got = {(r.p, r.name): r.share for r in found.collect()}
    # a pixel that comes twice counts twice
    assert set(got) == set(want) and max(abs(got[k] - want[k] * (1 + (k[0] == 0))) for k in want) < 1e-9
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "aggregate(" not in plan and "_salt" in plan


def test_points_in_zones_have_shares(spark):
    """The centre of a small pixel decides where its whole share goes."""
    draw = random.Random(6)
    shapes = {f"z{k}": [ring(star(draw, draw.uniform(0, 4), draw.uniform(0, 4), 0.3, 0.9))] for k in range(8)}
    df = spark.createDataFrame([(k, draw.uniform(0, 4), draw.uniform(0, 4)) for k in range(300)], "p int, x double, y double")
    centre = {(r.p, r.name) for r in zones.zonal_join(df, layer(spark, shapes), ["name"]).collect()}
    part = {(r.p, r.name): r.share for r in shares.pixel_shares(df, layer(spark, shapes), ["name"], ["p"], 1e-7, 1e-7).collect()}
    assert {k for k, s in part.items() if s > 0.5} == centre


def _crowd_of_pixels(spark):
    """Composites with gaps, shares and places of pixels on a few spots; one pixel has no place, some keys are null or come twice."""
    draw, nan = random.Random(4), float("nan")
    values = [(p, y, m, *(draw.choice([None, draw.uniform(-5, 5)]) for _ in "ab")) for p in range(90) for y, m in [(2000, 1), (2000, 2), (2001, 1)] if draw.random() < 0.8]
    values += [(3, 2000, 1, 1.0, None), (5, None, None, 2.0, 2.0), (7, 2002, 1, None, None), (8, 2002, 2, nan, 0.0), (9, 2002, 3, math.inf, 1.0), (None, 2000, 1, 9.0, 9.0), (500, 2000, 1, 9.0, 9.0)]
    met = [(p, draw.choice(["u", "v", "w", None]), z, draw.uniform(0.1, 1)) for p in range(90) for z in range(12) if draw.random() < 0.5]
    met += [(p, "only", p, 0.5) for p in (7, 8, 9)] + [(None, "u", 1, 0.5), (600, "u", 1, 0.5)]
    places = [(p, float(p % 3), 0.5) for p in range(89)] + [(4, 2.0, 2.0), (None, 1.0, 1.0), (6, None, nan)]
    return (
        spark.createDataFrame(values, "p long, year int, month int, a double, b double"),
        spark.createDataFrame(met, "p long, zone string, part int, share double"),
        spark.createDataFrame(places, "p int, x double, y double"),
    )


def test_a_crowded_spot_is_dealt_out(spark, monkeypatch):
    """Also one below the largest number, where it holds a good part of all shares."""
    monkeypatch.setattr(shares, "FEW", 30)
    places = spark.range(200).selectExpr("id AS p", "0.5 AS x", "0.5 AS y")
    met = places.selectExpr("p", "explode(sequence(1, 20)) AS zone", "0.25D AS share")
    dealt = shares._gathering(met, places, ["p"], (1.0, 1.0), "x", "y", shares.GATHERED)
    assert dealt.count() == 200
    most = dealt.groupBy("_place").count().agg(F.max("count")).first()[0]
    assert most * 20 < 200 * 20 / 8


@pytest.mark.parametrize("crowd, block", [(shares.GATHERED, shares.BLOCK), (40, 100)])
def test_gathered_pixels_give_what_single_pairs_give(spark, monkeypatch, crowd, block):
    monkeypatch.setattr(shares, "BLOCK", block)
    values, met, places = _crowd_of_pixels(spark)
    bands = {"a": "mean", "b": "sum"}
    want = raster.zonal(values.join(met, "p"), ["zone", "part"], bands, weight="share")
    near = shares.gathered(values, met, places, ["p"], ["zone", "part"], list(bands), (1.0, 1.0), crowd=crowd)
    got = raster.zonal(near, ["zone", "part"], bands, weight={v: f"{v}_share" for v in bands})
    assert got.schema.simpleString() == want.schema.simpleString()
    keys = ["zone", "part", "year", "month"]
    found, plain = ({tuple(r[k] for k in keys): (r.a, r.b) for r in df.collect()} for df in (got, want))
    assert set(found) == set(plain) and len(found) == got.count()
    for key, pair in plain.items():
        assert found[key] == pytest.approx(pair, rel=1e-9, abs=1e-9, nan_ok=True) if None not in pair else (
            [v is None for v in found[key]] == [v is None for v in pair] and all(v is None or v == pytest.approx(w, nan_ok=True) for v, w in zip(found[key], pair)))
    assert got.where("year is null").count() == want.where("year is null").count() > 0


def test_neighbours_leave_one_row_a_zone_and_month(spark):
    """No row for every pixel, month and zone that meet is shuffled for the weighted polygons."""
    pixels = spark.range(300).selectExpr("id AS p", "id / 1000 AS x", "0.5 AS y")
    values = pixels.selectExpr("p", "2000 AS year", "explode(sequence(1, 4)) AS month", "x AS a")
    met = pixels.selectExpr("p", "explode(sequence(1, 20)) AS zone", "0.25D AS share")
    assert shares.gathered(values, met, pixels, ["p"], ["zone"], ["a"], (1.0, 1.0)).count() == 20 * 4
    plan = shares.gathered(values, met.limit(0), pixels, ["p"], ["zone"], ["a"], (1.0, 1.0))
    assert plan.count() == 0


def test_weighted_polygons_gather_their_pixels(spark, sf_dir):
    plan = catalog.zonal_weighted_polygons(spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    assert "FlatMapCoGroupsInArrow" in plan
