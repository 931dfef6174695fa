"""Simplified layers: shared borders stay shared, nothing crosses, areas of a tiling add up."""

import math
import random
import time
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from arealis.functions.geometry import RINGS_TYPE, zone_area
from arealis.operators import arcs, zones


def ring(points, hole=False):
    return (hole, [(float(x), float(y)) for x, y in [*points, points[0]]])


def layer(spark, shapes):
    return spark.createDataFrame([(n, rings) for n, rings in shapes.items()], f"name string, rings {RINGS_TYPE}")


def border(a, b, draw, n=20, wild=0.06):
    """A crooked line from a to b; the ends are a and b themselves."""
    dx, dy = b[0] - a[0], b[1] - a[1]
    out = [a]
    for k in range(1, n):
        t, off = k / n, draw.uniform(-wild, wild) * min(1, 4 * k / n, 4 * (1 - k / n))
        out.append((a[0] + t * dx - off * dy, a[1] + t * dy + off * dx))
    return [*out, b]


def tiling(n, seed=1, turn=True):
    """n x n zones; neighbours have the same border vertices, some rings run the other way round."""
    draw = random.Random(seed)
    corner = {(i, j): (i + draw.uniform(-0.1, 0.1), j + draw.uniform(-0.1, 0.1)) for i in range(n + 1) for j in range(n + 1)}
    flat = {(i, j): border(corner[i, j], corner[i + 1, j], draw) for i in range(n) for j in range(n + 1)}
    up = {(i, j): border(corner[i, j], corner[i, j + 1], draw) for i in range(n + 1) for j in range(n)}
    shapes = {}
    for i in range(n):
        for j in range(n):
            points = flat[i, j][:-1] + up[i + 1, j][:-1] + flat[i, j + 1][::-1][:-1] + up[i, j][::-1][:-1]
            k = draw.randrange(len(points))
            points = points[k:] + points[:k]
            shapes[f"{i},{j}"] = [ring(points[::-1] if turn and draw.random() < 0.5 else points)]
    return shapes


def found(df):
    return {r.name: [(x.hole, [(p.x, p.y) for p in x.points]) for x in r.rings] for r in df.collect()}


def undirected(rings):
    return [tuple(sorted(e)) for _, p in rings for e in zip(p[:-1], p[1:])]


def distance(p, points):
    best = math.inf
    for a, b in zip(points[:-1], points[1:]):
        dx, dy = b[0] - a[0], b[1] - a[1]
        t = max(0, min(1, ((p[0] - a[0]) * dx + (p[1] - a[1]) * dy) / (dx * dx + dy * dy)))
        best = min(best, math.hypot(p[0] - a[0] - t * dx, p[1] - a[1] - t * dy))
    return best


@pytest.mark.parametrize("tolerance", [0.02, 0.3, 5.0])
def test_a_tiling_stays_a_tiling(spark, tolerance):
    n, shapes = 4, tiling(4)
    thin = found(arcs.simplify_layer(layer(spark, shapes), tolerance))
    uses = Counter(e for rings in thin.values() for e in undirected(rings))
    before = Counter(e for rings in shapes.values() for e in undirected(rings))
    assert set(uses.values()) == {1, 2} and sum(uses.values()) < 0.6 * sum(before.values())
    outer = [e for e, k in uses.items() if k == 1]
    assert Counter(Counter(p for e in outer for p in e).values()) == {2: len(outer)}  # one closed line around all
    area = lambda p: sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(p[:-1], p[1:])) / 2
    total = sum(abs(area(rings[0][1])) for rings in thin.values())
    line, left = [outer[0][0], outer[0][1]], outer[1:]
    while left:
        e = next(e for e in left if line[-1] in e)
        left.remove(e)
        line.append(e[1] if e[0] == line[-1] else e[0])
    assert total == pytest.approx(abs(area(line)), rel=1e-12)
    every = [np.array(p) for rings in thin.values() for _, p in rings]
    assert not zones.edges_cross([np.array(e) for e in set(uses)]) and all(len(p) >= 4 for p in every)
    for name, rings in shapes.items():
        assert max(distance(p, thin[name][0][1]) for p in rings[0][1]) <= tolerance + 1e-12
        assert set(thin[name][0][1]) <= set(rings[0][1])
    corners = {p for p, k in Counter(p for e in before for p in e).items() if k > 2}
    assert corners <= {p for e in uses for p in e}


def test_islands_lakes_and_touching_rings(spark):
    draw = random.Random(4)
    circle = lambda x, y, r, n=60: [(x + r * math.cos(2 * math.pi * k / n), y + r * math.sin(2 * math.pi * k / n)) for k in range(n)]
    lake = circle(0, 0, 1)
    shapes = {
        "land": [ring(circle(0, 0, 3)), ring(lake[::-1], True)], "lake": [ring(lake[17:] + lake[:17])], "isle": [ring(circle(9, 9, 0.5))],
        "two": [ring(circle(20, 0, 1)), ring(circle(23, 0, 1))], "tri": [ring([(30, 0), (31, 0), (30, 1)])], "none": [],
    }
    left = circle(40, 0, 1)
    touch = [(80 - x, y) for x, y in left]  # the two rings share one vertex
    touch = [(x + 2, y) for x, y in touch]
    shapes |= {"left": [ring(left)], "right": [ring([(41.0, 0.0) if math.hypot(x - 41, y) < 1e-9 else (x, y) for x, y in touch])]}
    shapes["left"] = [ring([(41.0, 0.0) if math.hypot(x - 41, y) < 1e-9 else (x, y) for x, y in left])]
    assert draw and shapes
    thin = found(arcs.simplify_layer(layer(spark, shapes), 0.05))
    assert thin["none"] == [] and thin["tri"][0][1][:-1] != [] and len(thin["tri"][0][1]) == 4
    lakes = [set(undirected([thin["land"][1]])), set(undirected(thin["lake"]))]
    assert lakes[0] == lakes[1] and len(lakes[0]) < 30 and thin["land"][1][0]
    assert len(thin["two"]) == 2 and all(len(p) >= 4 for rings in thin.values() for _, p in rings)
    assert (41.0, 0.0) in thin["left"][0][1] and (41.0, 0.0) in thin["right"][0][1]
    gone = found(arcs.simplify_layer(layer(spark, shapes), 1000.0))  # rings never collapse
    assert all(len(set(p)) >= 3 for rings in gone.values() for _, p in rings)


def test_crossings_between_zones_are_mended(spark):
    """Two borders that run close together without sharing a vertex: the tolerance alone would make them cross."""
    low = [(0, 0), (10, 0), (10, 2), (5, 0.9), (0, 2)]
    high = [(0, 2.2), (5, 1.0), (10, 2.2), (10, 5), (0, 5)]
    plain = {k: v[0][1] for k, v in found(zones.simplify_zones(layer(spark, {"low": [ring(low)], "high": [ring(high)]}), 1.15)).items()}
    thin = found(arcs.simplify_layer(layer(spark, {"low": [ring(low)], "high": [ring(high)]}), 1.15))
    assert not zones.edges_cross([np.array(p) for rings in thin.values() for _, p in rings])
    assert set(plain) == set(thin)


def test_columns_and_odd_rows_stay(spark):
    rows = [("a", [ring([(0, 0), (1, 0), (1, 1), (0, 1)])], 1), ("b", None, 2), ("c", [], 3), ("d", [(False, [])], 4), ("e", [(None, [(0.0, 0.0), (0.0, 0.0)])], 5)]
    df = spark.createDataFrame(rows, f"name string, rings {RINGS_TYPE}, n int")
    out = arcs.simplify_layer(df, 0.1)
    assert out.columns == df.columns and {r.name: r.n for r in out.collect()} == {r[0]: r[2] for r in rows}
    assert arcs.simplify_layer(df.limit(0), 0.1).count() == 0
    area = {r.name: r.a for r in out.where("name = 'a'").select("name", zone_area(F.col("rings")).alias("a")).collect()}
    assert area == {"a": 1.0}


def test_arcs_are_named_alike_from_both_sides():
    line = np.array([(0.0, 0.0), (1.0, 0.5), (2.0, 0.0)])
    (a, turned, own), (b, back, same) = arcs.named_arc(line), arcs.named_arc(line[::-1])
    assert a == b and turned != back and (own == same).all()
    square = np.array([(0.0, 0.0), (1.0, 0.0), (1.0, 1.0), (0.0, 1.0)])
    names = [sorted(arcs.named_arc(x)[0] for x in arcs.cut_ring(np.roll(s, k, axis=0), np.zeros(4, bool))) for s in (square, square[::-1]) for k in range(4)]
    assert all(n == names[0] for n in names)


def plain_cross(rings):
    edges = [(a, b) for r in rings for a, b in zip(r[:-1], r[1:])]
    side = lambda p, q, r: np.sign((q[0] - p[0]) * (r[1] - p[1]) - (q[1] - p[1]) * (r[0] - p[0]))
    return any(side(*e, f[0]) * side(*e, f[1]) < 0 and side(*f, e[0]) * side(*f, e[1]) < 0 for i, e in enumerate(edges) for f in edges[:i])


def test_crossings_equal_a_test_of_all_pairs():
    draw = np.random.default_rng(2)
    seen = Counter()
    for k in range(300):
        n, size = int(draw.integers(3, 14)), 10.0 ** draw.uniform(-3, 3)
        at = np.sort(draw.uniform(0, 2 * np.pi, n))
        xy = np.stack([np.cos(at), np.sin(at)], axis=1) * draw.uniform(0.3, 1, n)[:, None] * size
        if k % 2:
            i, j = draw.integers(0, n, 2)
            xy[[i, j]] = xy[[j, i]]
        closed = [np.concatenate([xy, xy[:1]]), np.zeros((0, 2)), np.repeat(xy[:1], 3, axis=0)]
        want = plain_cross(closed)
        assert zones.edges_cross(closed) == want
        seen[want] += 1
    assert min(seen.values()) > 20


def test_a_ring_of_many_vertices_is_tested_in_seconds(monkeypatch):
    n = 100_000
    at = np.linspace(0, 2 * np.pi, n, endpoint=False)
    radius = 1 + 0.2 * np.sin(37 * at) + 1e-5 * np.random.default_rng(1).uniform(-1, 1, n)
    xy = np.stack([radius * np.cos(at), radius * np.sin(at)], axis=1)
    closed = np.concatenate([xy, xy[:1]])
    start = time.time()
    assert not zones.edges_cross([closed])
    closed[[50_000, 50_002]] = closed[[50_002, 50_000]]
    crossed = zones.edges_cross([closed])
    assert time.time() - start < 20 and crossed == plain_cross([closed[49_990:50_010]])
    monkeypatch.setattr(zones, "PAIRS", 1000)  # in many parts
    assert zones.edges_cross([closed[49_000:51_000]]) == crossed
