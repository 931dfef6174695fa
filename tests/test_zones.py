import json
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from arealis.functions.geometry import RINGS_TYPE, centroid, covers, rings_from_geojson, rings_from_wkt, zone_area, zone_edges
from arealis.operators import raster, zones
from arealis.sources import geojson

SQUARE = [(0, 0), (4, 0), (4, 4), (0, 4)]
ELL = [(0, 0), (3, 0), (3, 1), (1, 1), (1, 3), (0, 3)]
HOLE = [(1, 1), (1, 2), (2, 2), (2, 1)]


def ring(points, hole=False):
    return (hole, [(float(x), float(y)) for x, y in [*points, points[0]]])


def layer(spark, shapes):
    return spark.createDataFrame([(n, rings) for n, rings in shapes.items()], f"name string, rings {RINGS_TYPE}")


@pytest.fixture(scope="module")
def shapes(spark):
    return layer(spark, {"square": [ring(SQUARE), ring(HOLE, True)], "ell": [ring(list(reversed(ELL)))], "flat": [ring([(0, 0), (1, 1), (2, 2)])]})


def test_areas_and_centroids(shapes):
    rows = {r.name: r for r in shapes.select("name", zone_area(F.col("rings")).alias("a"), centroid(F.col("rings")).alias("c")).collect()}
    assert rows["square"].a == 15 and rows["ell"].a == 5
    assert rows["square"].c.x == pytest.approx((16 * 2 - 1.5) / 15) and rows["square"].c.y == rows["square"].c.x
    assert rows["ell"].c.x == pytest.approx((3 * 1.5 + 2 * 0.5) / 5)
    assert rows["flat"].c is None


def test_covers_hole_and_border(spark, shapes):
    points = spark.createDataFrame([(0.5, 0.5), (1.5, 1.5), (3.0, 3.0), (5.0, 1.0), (2.0, 2.9)], "x double, y double")
    inside = covers(zone_edges(F.col("rings")), F.col("x"), F.col("y"))
    got = {(r.name, r.x) for r in shapes.join(points, inside).collect()}
    assert got == {("square", 0.5), ("square", 3.0), ("square", 2.0), ("ell", 0.5)}


def test_neighbours_share_no_point(spark):
    grid = {f"{i},{j}": [ring([(i, j), (i + 1, j), (i + 1, j + 1), (i, j + 1)])] for i in range(3) for j in range(3)}
    points = spark.createDataFrame([(float(x), float(y)) for x in range(3) for y in range(3)], "x double, y double")
    found = zones.zonal_join(points, layer(spark, grid), ["name"]).collect()
    assert len(found) == 9


@pytest.mark.parametrize("cell", [None, 0.05, 0.7, 10.0])
@pytest.mark.parametrize("broadcast", [True, False])
def test_polygon_join_like_brute_force(spark, cell, broadcast):
    rnd = random.Random(4)

    def star(x, y):
        return [(x + r * math.cos(k), y + r * math.sin(k)) for k, r in ((i * math.pi / 4, rnd.uniform(0.05, 0.5)) for i in range(8))]

    shapes = {f"z{i}": star(rnd.uniform(-1, 1), rnd.uniform(-1, 1)) for i in range(25)}
    points = [(i, rnd.uniform(-1.5, 1.5), rnd.uniform(-1.5, 1.5)) for i in range(400)]

    def within(poly, x, y):
        odd = False
        for (ax, ay), (bx, by) in zip(poly, poly[1:] + poly[:1]):
            if (ay > y) != (by > y) and x < (bx - ax) * (y - ay) / (by - ay) + ax:
                odd = not odd
        return odd

    expected = {(i, n) for i, x, y in points for n, poly in shapes.items() if within(poly, x, y)}
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old if broadcast else "-1")
    try:
        df = zones.zonal_join(spark.createDataFrame(points, "i int, x double, y double"), layer(spark, {n: [ring(s)] for n, s in shapes.items()}), ["name"], cell=cell)
        got = [(r.i, r.name) for r in df.collect()]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert len(got) == len(set(got)) and set(got) == expected


def segment_gap(p, a, b):
    dx, dy = b[0] - a[0], b[1] - a[1]
    t = 0 if dx == dy == 0 else max(0, min(1, ((p[0] - a[0]) * dx + (p[1] - a[1]) * dy) / (dx * dx + dy * dy)))
    return math.hypot(p[0] - a[0] - t * dx, p[1] - a[1] - t * dy)


def test_simplify_stays_within_tolerance(spark):
    rnd = random.Random(9)
    wavy = [((2 + rnd.uniform(-0.02, 0.02)) * math.cos(k / 60 * math.tau), 2 * math.sin(k / 60 * math.tau)) for k in range(60)]
    df = layer(spark, {"wavy": [ring(wavy)], "square": [ring(SQUARE)], "thin": [ring([(0, 0), (1, 1e-5), (2, 0), (1, -1e-5)])]})
    got = {r.name: [(p.x, p.y) for p in r.rings[0].points] for r in zones.simplify_zones(df, 0.05).collect()}
    assert got["square"] == [(float(x), float(y)) for x, y in [*SQUARE, SQUARE[0]]]
    kept = got["wavy"]
    assert kept[0] == kept[-1] and 4 <= len(kept) < 60 and set(kept) <= set(wavy)
    assert all(min(segment_gap(p, a, b) for a, b in zip(kept, kept[1:])) <= 0.05 for p in wavy)
    assert len(got["thin"]) >= 4 and got["thin"][0] == got["thin"][-1]
    exact = zones.simplify_zones(df, 0.0).collect()
    assert {r.name: len(r.rings[0].points) for r in exact}["wavy"] == 61


def test_geojson_collection(spark, tmp_path):
    def feature(name, kind, coordinates):
        return {"type": "Feature", "geometry": {"type": kind, "coordinates": coordinates}, "properties": {"Province": "P", "District": "D", "Subdistric": name}}

    square = [[0, 0], [4, 0], [4, 4], [0, 4], [0, 0]]
    hole = [[1, 1], [1, 2], [2, 2], [2, 1], [1, 1]]
    other = [[10, 0], [11, 0], [11, 1], [10, 1], [10, 0]]
    body = {"type": "FeatureCollection", "features": [feature("a", "Polygon", [square, hole]), feature("b", "MultiPolygon", [[square, hole], [other]]), feature("c", "Point", [1, 2])]}
    (tmp_path / "NDVI").mkdir()
    (tmp_path / "NDVI" / "z.geojson").write_text(json.dumps(body, indent=1))
    back = geojson.read_zones(spark, str(tmp_path))
    assert back.columns == ["province", "district", "subdistrict", "rings"]
    got = {r.subdistrict: r.a for r in back.select("subdistrict", zone_area(F.col("rings")).alias("a")).collect()}
    assert got == {"a": 15.0, "b": 16.0, "c": None}
    names = geojson.read_features(spark, str(tmp_path), "Province string, District string, Subdistric string")
    assert sorted(r.subdistrict for r in names.collect()) == ["a", "b", "c"]

    geojson.write_features(back.where("rings IS NOT NULL"), str(tmp_path / "out"), ["province", "district", "subdistrict"])
    again = geojson.read_zones(spark, str(tmp_path / "out"), "province string, district string, subdistrict string", lines=True)
    assert {r.subdistrict: r.rings for r in again.collect()} == {r.subdistrict: r.rings for r in back.where("rings IS NOT NULL").collect()}


def test_wkt(spark):
    texts = ["POLYGON ((0 0, 4 0, 4 4, 0 4, 0 0), (1 1, 1 2, 2 2, 2 1, 1 1))", "MULTIPOLYGON (((0 0, 1 0, 1 1, 0 0)), ((5 5, 6 5, 6 6, 5 5)))", "POINT (1 2)", "polygon((-1.5 0,1e1 0,0 2,-1.5 0))"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").select("i", rings_from_wkt(F.col("t")).alias("r"))
    got = [r.a for r in df.select(zone_area(F.col("r")).alias("a"), "i").orderBy("i").collect()]
    assert got == [15.0, 1.0, None, 11.5]
    assert spark.range(1).select(rings_from_geojson(F.lit(None).cast("string")).alias("r")).first().r is None


def test_points_without_value_or_centre_are_left_out(spark):
    df = layer(spark, {"square": [ring(SQUARE)], "flat": [ring([(0, 0), (1, 1), (2, 2)])], "none": [ring(SQUARE)]})
    values = spark.createDataFrame([("square", 1.0), ("flat", 2.0), ("none", None)], "name string, v double")
    assert [r.name for r in zones.map_points(df, values, "v", ["name"]).collect()] == ["square"]


def test_composites_skip_masked_pixels(spark):
    df = spark.createDataFrame([(1, "2020-01-05", 2.0, 8), (1, "2020-01-09", None, None), (1, "2020-02-01", 9.0, 3)], "p int, t string, v double, m int")
    df = df.select("p", F.to_timestamp("t").alias("image_ts"), "v", raster.fire_indicator("m").alias("f"))
    got = {r.month: (r.v, r.f) for r in raster.composite(df, ["p"], {"v": "mean", "f": "sum"}).collect()}
    assert got == {1: (2.0, 1), 2: (9.0, 0)}


def test_sum_of_sums_equals_two_steps(spark):
    df = spark.range(2000).select((F.col("id") % 17).alias("p"), (F.col("id") % 3).alias("z"), F.timestamp_seconds(F.col("id") * 9000).alias("image_ts"), (F.col("id") % 5 == 0).cast("int").alias("f"))
    two = raster.zonal(raster.composite(df, ["p", "z"], {"f": "sum"}), ["z"], {"f": "sum"})
    assert sorted(two.collect()) == sorted(raster.zonal_month_sum(df, ["z"], "f").collect())


def test_one_huge_zone_among_small_ones_stays_small(spark):
    square = lambda x, y, w: ring([(x, y), (x + w, y), (x + w, y + w), (x, y + w)])
    shapes = {f"s{i}": [square(i % 50 * 0.4, i // 50 * 0.4, 0.01)] for i in range(200)} | {"huge": [square(-1, -1, 22.0)]}
    rows = layer(spark, shapes)
    level = zones.zone_level(F.col("rings"))
    cells = zones.zone_cells(rows, ["name"], F.pow(F.lit(2.0), level), level)
    assert cells.where("name = 'huge'").count() <= (2 * zones.CELLS_ACROSS + 1) ** 2
    points = spark.createDataFrame([(i, i % 50 * 0.4 + 0.004, i // 50 * 0.4 + 0.006) for i in range(200)], "i int, x double, y double")
    assert zones.zonal_join(points, rows, ["name"]).groupBy("i").count().where("count = 2").count() == 200


def test_simplified_rings_do_not_cross(spark):
    # a narrow bay whose mouth would be cut across by the far bank
    bay = [(0, 0), (10, 0), (10, 10), (5.2, 10), (5.2, 1.0), (5.1, 0.4), (5.0, 1.0), (5.0, 10), (0, 10)]
    tooth = [(4.9, 9.0), (5.05, 0.6), (4.95, 9.0)]
    shapes = {"bay": [ring(bay)], "spike": [ring([(0, 0), (4, 0.2), (8, 0), (8, 4), (4.2, 0.25), (0, 4)])], "tooth": [ring(tooth)]}
    for tolerance in (0.1, 0.7, 3.0):
        for r in zones.simplify_zones(layer(spark, shapes), tolerance).collect():
            assert not zones.edges_cross([np.array([(p.x, p.y) for p in x.points]) for x in r.rings])
            assert all(len(x.points) >= 4 for x in r.rings)
    assert zones.edges_cross([np.array([(0, 0), (2, 2), (2, 0), (0, 2), (0, 0)], float)])
    empty = spark.createDataFrame([("none", None), ("bare", [])], f"name string, rings {RINGS_TYPE}")
    assert {r.name: r.rings for r in zones.simplify_zones(empty, 0.1).collect()} == {"none": None, "bare": []}


@pytest.mark.parametrize("crowd", [20, 300])
def test_crowded_cells_are_cut_before_the_join(spark, crowd):
    """All points in one zone, most of them near one of its corners and many on one spot; same hits as without cutting."""
    rnd = random.Random(9)
    shapes = {"big": [ring([(0, 0), (100, 0), (100, 90), (50, 40), (0, 100)]), ring([(20, 20), (30, 20), (30, 30), (20, 30)], True)]}
    shapes |= {f"s{k}": [ring([(k, 1), (k + 1.5, 1), (k + 0.5, 2 + k)])] for k in range(6)} | {"corner": [ring([(0, 0), (0.4, 0), (0.2, 0.3)])]}
    at = [(rnd.uniform(0, 100), rnd.uniform(0, 100)) for _ in range(300)] + [(rnd.random() ** 4, rnd.random() ** 4) for _ in range(1500)]
    at += [(0.125, 0.0625)] * 700 + [(25.0, 25.0)] * 500
    points = spark.createDataFrame([(k, x, y, "n") for k, (x, y) in enumerate(at)], "p int, x double, y double, base string").repartition(3)
    zones_ = layer(spark, shapes)
    plain = zones.zonal_join(points, zones_, ["name"], crowd=None).collect()
    found = zones.zonal_join(points, zones_, ["name"], crowd=crowd)
    assert found.columns == ["p", "x", "y", "base", "name"]
    assert sorted((r.p, r.name) for r in found.collect()) == sorted((r.p, r.name) for r in plain)
    assert len(plain) > 2000

    level = zones.zone_level(F.col("rings"))
    cells = zones.zone_cells(zones_, ["name"], F.pow(F.lit(2.0), level), level).withColumn("_base", F.col("level"))
    levels = [r.level for r in zones_.select(level.alias("level")).distinct().collect()]
    placed = points.select("*", F.explode(F.array(*[F.lit(v) for v in levels])).alias("level"))
    for c in "xy":
        placed = placed.withColumn(f"c{c}", F.floor(F.col(c) / F.pow(F.lit(2.0), F.col("level"))))
    cut, parts = zones.cut_places(placed.withColumn("_base", F.col("level")), "x", "y", cells, crowd)
    met = cut.join(parts.select(*zones.PLACE, "_salt").distinct(), [*zones.PLACE, "_salt"], "left_semi")
    assert met.groupBy(*zones.PLACE, "_salt").count().agg(F.max("count")).first()[0] <= 1.3 * crowd
    assert cut.count() == placed.count() and parts.groupBy("name", *zones.PLACE, "_salt").count().where("count > 1").count() == 0
