"""Polygon expressions over arrays of rings.

A zone is an array of rings, each ``struct<hole: boolean, points: array<struct<x, y>>>`` with its first point
repeated at the end. Everything here is row-local: a zone never needs a shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

POINT_TYPE = "struct<x:double,y:double>"
RINGS_TYPE = f"array<struct<hole:boolean,points:array<{POINT_TYPE}>>>"


def ring_edges(points: Column) -> Column:
    """Directed edges of one closed ring."""
    return F.transform(
        F.sequence(F.lit(0), F.size(points) - 2),
        lambda i: F.struct(
            F.get(points, i)["x"].alias("x1"), F.get(points, i)["y"].alias("y1"),
            F.get(points, i + 1)["x"].alias("x2"), F.get(points, i + 1)["y"].alias("y2"),
        ),
    )


def zone_edges(rings: Column) -> Column:
    """Edges of all rings of a zone."""
    return F.flatten(F.transform(rings, lambda r: ring_edges(r["points"])))


def bounding_box(rings: Column) -> Column:
    """``struct<x0, y0, x1, y1>`` around all points."""
    points = F.flatten(F.transform(rings, lambda r: r["points"]))
    xs = F.transform(points, lambda p: p["x"])
    ys = F.transform(points, lambda p: p["y"])
    return F.struct(
        F.array_min(xs).alias("x0"), F.array_min(ys).alias("y0"),
        F.array_max(xs).alias("x1"), F.array_max(ys).alias("y1"),
    )


def covers(edges: Column, x: Column, y: Column) -> Column:
    """Even-odd rule: a ray to the right crosses the edges an odd number of times.

    An edge counts when exactly one end lies above ``y``, so a point on a shared border falls in one zone only.
    """
    crossed = F.filter(
        edges,
        lambda e: ((e["y1"] > y) != (e["y2"] > y))
        & (x < (e["x2"] - e["x1"]) * (y - e["y1"]) / F.nullif(e["y2"] - e["y1"], F.lit(0.0)) + e["x1"]),
    )
    return F.size(crossed) % 2 == 1


def centroid(rings: Column) -> Column:
    """Planar centroid ``struct<x, y>``: area-weighted over rings, holes subtracted."""

    def moments(points: Column) -> Column:
        zero = F.struct(F.lit(0.0).alias("a"), F.lit(0.0).alias("mx"), F.lit(0.0).alias("my"))

        def add(total: Column, e: Column) -> Column:
            cross = e["x1"] * e["y2"] - e["x2"] * e["y1"]
            return F.struct(
                (total["a"] + cross).alias("a"),
                (total["mx"] + (e["x1"] + e["x2"]) * cross).alias("mx"),
                (total["my"] + (e["y1"] + e["y2"]) * cross).alias("my"),
            )

        return F.aggregate(ring_edges(points), zero, add)

    # The ring's own orientation cancels: outer rings count positive, holes negative.
    signed = F.transform(
        rings,
        lambda r: F.struct(
            (F.when(r["hole"], -1.0).otherwise(1.0) * F.signum(moments(r["points"])["a"])).alias("sign"),
            moments(r["points"]).alias("m"),
        ),
    )

    def total(part: str) -> Column:
        return F.aggregate(signed, F.lit(0.0), lambda acc, s: acc + s["sign"] * s["m"][part])

    area = total("a")
    return F.when(
        area != 0, F.struct((total("mx") / (area * 3)).alias("x"), (total("my") / (area * 3)).alias("y"))
    )


def zone_area(rings: Column) -> Column:
    """Planar area, holes subtracted."""

    def ring_area(points: Column) -> Column:
        doubled = F.aggregate(
            ring_edges(points), F.lit(0.0), lambda acc, e: acc + e["x1"] * e["y2"] - e["x2"] * e["y1"]
        )
        return F.abs(doubled) / 2

    return F.aggregate(
        rings, F.lit(0.0),
        lambda acc, r: acc + F.when(r["hole"], -1.0).otherwise(1.0) * ring_area(r["points"]),
    )


def rings_from_geojson(geometry: Column) -> Column:
    """Rings of a GeoJSON Polygon or MultiPolygon given as text; other types give null."""
    kind = F.get_json_object(geometry, "$.type")
    body = F.get_json_object(geometry, "$.coordinates")
    many = F.when(kind == "MultiPolygon", F.from_json(body, "array<array<array<array<double>>>>")).when(
        kind == "Polygon", F.array(F.from_json(body, "array<array<array<double>>>"))
    )
    ringed = F.transform(
        many,
        lambda polygon: F.transform(
            polygon,
            lambda ring, i: F.struct(
                (i > 0).alias("hole"),
                F.transform(ring, lambda p: F.struct(F.get(p, F.lit(0)).alias("x"), F.get(p, F.lit(1)).alias("y"))).alias(
                    "points"
                ),
            ),
        ),
    )
    return F.flatten(ringed)


def rings_from_wkt(wkt: Column) -> Column:
    """Rings of a WKT POLYGON or MULTIPOLYGON; other types give null."""
    kind = F.upper(F.trim(F.regexp_extract(wkt, r"^\s*([A-Za-z]+)", 1)))
    # Coordinates in brackets, commas between numbers: the text becomes a GeoJSON coordinate list.
    body = F.regexp_extract(wkt, r"(?s)(\(.*\))", 1)
    pairs = F.regexp_replace(body, r"([-+0-9.eE]+)\s+([-+0-9.eE]+)", "[$1,$2]")
    listed = F.translate(pairs, "()", "[]")
    name = F.when(kind == "POLYGON", "Polygon").when(kind == "MULTIPOLYGON", "MultiPolygon")
    return rings_from_geojson(F.concat(F.lit('{"type":"'), name, F.lit('","coordinates":'), listed, F.lit("}")))


def rings_to_geojson(rings: Column) -> Column:
    """``struct<type, coordinates>``: an outer ring opens a polygon, the holes after it belong to it."""

    def coordinates(ring: Column) -> Column:
        return F.transform(ring["points"], lambda p: F.array(p["x"], p["y"]))

    outers = F.filter(
        F.transform(rings, lambda r, i: F.struct((i + 1).alias("at"), r["hole"].alias("hole"))),
        lambda r: ~r["hole"],
    )
    starts = F.transform(outers, lambda r: r["at"])
    ends = F.concat(F.slice(starts, 2, F.size(starts)), F.array(F.size(rings) + 1))
    polygons = F.zip_with(
        starts, ends, lambda a, b: F.transform(F.slice(rings, a, b - a), coordinates)
    )
    return F.struct(F.lit("MultiPolygon").alias("type"), polygons.alias("coordinates"))
