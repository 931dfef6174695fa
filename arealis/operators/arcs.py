"""Simplification of a whole zone layer that keeps shared borders shared.

1. All edges of all zones make one graph: an edge is keyed by its two end points without order. A vertex where other than two
   edges meet is a node; between nodes every zone that uses an edge uses the next one too.
2. Rings are cut at their nodes into arcs. An arc is written in one of its two directions, by its coordinates alone, so that both
   neighbours name the same arc; a closed arc is cut at the vertex farthest from its start, a ring without nodes starts at its
   least vertex.
3. Each distinct arc is simplified once, and rings are put together again from the simplified arcs.
4. Where simplified edges of the layer cross, or two arcs have become one line, the arcs concerned get half the tolerance, and
   so on down to their own vertices. Crossings are found over all zones, by an equi-join of edges on grid cells of their size.

Neighbours share a border if they have its vertices in common, to the last bit. Zones without rings stay as they are.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arealis.functions.geometry import POINT_TYPE, RINGS_TYPE
from arealis.operators.zones import kept_on_line
from arealis.registry import SIMPLIFY_TOLERANCE
from arealis.session import stored

#: After so many halvings an arc keeps all its vertices.
HALVINGS = 40


def _vertices(zones: DataFrame) -> DataFrame:
    """zone, ring, hole, place, x, y of all ring vertices, the closing one left out."""
    rings = zones.select("_zone", F.posexplode("rings").alias("_ring", "r"))
    open_ = F.slice(F.col("r.points"), F.lit(1), F.greatest(F.size("r.points") - 1, F.lit(0)))
    return rings.select("_zone", "_ring", F.col("r.hole").alias("hole"), F.posexplode(open_).alias("place", "p")).select(
        "_zone", "_ring", "hole", "place", (F.col("p.x") + 0.0).alias("x"), (F.col("p.y") + 0.0).alias("y")
    )


def _nodes(zones: DataFrame) -> DataFrame:
    """x, y of the vertices where other than two edges of the layer meet."""
    rings = zones.select(F.explode("rings").alias("r")).select(F.col("r.points").alias("points"))
    ends = F.transform(
        F.sequence(F.lit(0), F.size("points") - 2),
        lambda i: F.struct(F.get("points", i).alias("a"), F.get("points", i + 1).alias("b")),
    )
    edges = rings.where(F.size("points") > 1).select(F.explode(ends).alias("e")).where("e.a <> e.b")

    def at(p: Column) -> Column:
        return F.struct((p["x"] + 0.0).alias("x"), (p["y"] + 0.0).alias("y"))

    a, b = at(F.col("e.a")), at(F.col("e.b"))
    once = edges.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).distinct()
    degree = once.select(F.explode(F.array("a", "b")).alias("v")).groupBy("v").agg(F.count(F.lit(1)).alias("n"))
    return degree.where("n <> 2").select(F.col("v.x").alias("x"), F.col("v.y").alias("y"))


def cut_ring(xy: np.ndarray, is_node: np.ndarray) -> list[np.ndarray]:
    """Arcs of an open ring of vertices in its direction, each with both its ends; two at least."""
    if not len(xy):
        return []
    start = int(np.flatnonzero(is_node)[0]) if is_node.any() else int(np.lexsort((xy[:, 1], xy[:, 0]))[0])
    xy, is_node = np.roll(xy, -start, axis=0), np.roll(is_node, -start)
    closed = np.concatenate([xy, xy[:1]])
    cuts = sorted({0, len(xy), *np.flatnonzero(is_node).tolist()})
    out = []
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        arc = closed[a : b + 1]
        if (arc[0] == arc[-1]).all() and len(arc) > 2:
            gap = ((arc - arc[0]) ** 2).sum(axis=1)
            far = int(np.lexsort((arc[:, 1], arc[:, 0], -gap))[0])
            out += [arc[: far + 1], arc[far:]] if far else [arc]
        else:
            out.append(arc)
    return out


def named_arc(arc: np.ndarray) -> tuple[str, bool, np.ndarray]:
    """Name by coordinates, whether the ring runs against the arc's own direction, and the arc in that direction."""
    back = arc[::-1]
    turned = tuple(map(tuple, back.tolist())) < tuple(map(tuple, arc.tolist()))
    own = np.ascontiguousarray(back if turned else arc)
    return hashlib.sha256(own.tobytes()).hexdigest(), turned, own


def _point_lists(arcs: list[np.ndarray]) -> pa.ListArray:
    flat = np.concatenate([np.zeros((0, 2)), *arcs])
    stops = np.r_[0, np.cumsum([len(a) for a in arcs])].astype(np.int32)
    points = pa.StructArray.from_arrays([pa.array(flat[:, 0]), pa.array(flat[:, 1])], names=["x", "y"])
    return pa.ListArray.from_arrays(pa.array(stops), points)


def _points(column: pa.ListArray) -> list[np.ndarray]:
    stops = column.offsets.to_numpy()
    xy = np.stack([column.values.field(c).to_numpy(zero_copy_only=False) for c in "xy"], axis=1)
    return [xy[a:b] for a, b in zip(stops[:-1], stops[1:], strict=True)]


def ring_arcs(zones: DataFrame) -> DataFrame:
    """_zone, _ring, hole, seq, arc, turned, points: the arcs of each ring in its order."""
    nodes = _nodes(zones).withColumn("is_node", F.lit(True))
    marked = _vertices(zones).join(nodes, ["x", "y"], "left")
    order = F.sort_array(F.collect_list(F.struct("place", "x", "y", F.coalesce("is_node", F.lit(False)).alias("is_node"))))
    rings = marked.groupBy("_zone", "_ring", "hole").agg(order.alias("v"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = batch.column("v")
            flags, stops = v.values.field("is_node").to_numpy(zero_copy_only=False), v.offsets.to_numpy()
            rows, arcs = [], []
            for k, xy in enumerate(_points(v)):
                for seq, arc in enumerate(cut_ring(xy, flags[stops[k] : stops[k + 1]].astype(bool))):
                    name, turned, own = named_arc(arc)
                    rows.append((k, seq, name, turned))
                    arcs.append(own)
            of = batch.take(pa.array([r[0] for r in rows], pa.int64()))
            arrays = [*of.columns[:3], *(pa.array([r[i] for r in rows], t) for i, t in ((1, pa.int32()), (2, pa.string()), (3, pa.bool_())))]
            yield pa.RecordBatch.from_arrays([*arrays, _point_lists(arcs)], names=["_zone", "_ring", "hole", "seq", "arc", "turned", "points"])

    return rings.mapInArrow(run, f"_zone long, _ring int, hole boolean, seq int, arc string, turned boolean, points array<{POINT_TYPE}>")


def simplified(arcs: DataFrame, tolerance: float) -> DataFrame:
    """Arcs (arc, halvings, points) with the points that stay at ``tolerance / 2 ** halvings``."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            thin = []
            for xy, h in zip(_points(batch.column("points")), batch.column("halvings").to_pylist(), strict=True):
                thin.append(xy if h >= HALVINGS else xy[kept_on_line(xy, tolerance / 2**h)])
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], _point_lists(thin)], names=["arc", "halvings", "points"])

    return arcs.select("arc", "halvings", "points").mapInArrow(run, f"arc string, halvings int, points array<{POINT_TYPE}>")


def arc_edges(arcs: DataFrame) -> DataFrame:
    """arc, place, x1, y1, x2, y2 of every edge that has a length."""
    ends = F.transform(
        F.sequence(F.lit(0), F.size("points") - 2),
        lambda i: F.struct(i.alias("place"), F.get("points", i).alias("a"), F.get("points", i + 1).alias("b")),
    )
    edges = arcs.where(F.size("points") > 1).select("arc", F.explode(ends).alias("e")).where("e.a <> e.b")
    return edges.select(
        "arc", "e.place", F.col("e.a.x").alias("x1"), F.col("e.a.y").alias("y1"), F.col("e.b.x").alias("x2"), F.col("e.b.y").alias("y2")
    )


def conflicting(edges: DataFrame) -> DataFrame:
    """arc: those with an edge that crosses another edge inside both, or that is an edge of another arc too.

    An edge owns up to four cells of the grid whose cells are as wide as it is long, and visits the cells it touches in coarser
    grids in use. Two edges that cross meet in a cell that the longer one owns.
    """
    width = F.greatest(F.abs(F.col("x2") - F.col("x1")), F.abs(F.col("y2") - F.col("y1")))
    sized = edges.withColumn("level", F.ceil(F.log2(width)).cast("int"))
    levels = sized.agg(F.array_sort(F.collect_set("level")).alias("levels")).first()["levels"]
    if not levels:
        return edges.select("arc").limit(0)
    every = F.array(*[F.lit(int(v)) for v in levels])

    def placed(df: DataFrame, at: Column) -> DataFrame:
        out = df.withColumn("at", at)
        cell = F.pow(F.lit(2.0), F.col("at"))
        for c in "xy":
            low, high = F.least(f"{c}1", f"{c}2"), F.greatest(f"{c}1", f"{c}2")
            out = out.withColumn(f"c{c}", F.explode(F.sequence(F.floor(low / cell), F.floor(high / cell))))
        return out

    visitors = placed(sized, F.explode(F.filter(every, lambda v: v >= F.col("level"))))
    names = ["arc", "place", "x1", "y1", "x2", "y2", "level"]
    owners = placed(sized, F.col("level")).select("at", "cx", "cy", *[F.col(c).alias(f"o_{c}") for c in names])
    met = visitors.join(owners, ["at", "cx", "cy"])
    # of two edges of one level each meets the other: once is enough
    first = (F.col("level") < F.col("o_level")) | (F.struct("arc", "place") < F.struct("o_arc", "o_place"))

    def side(p: str, q: str, x: str, y: str) -> Column:
        """On which side of the edge p1-p2 a point lies."""
        ax, ay, bx, by = (F.col(f"{p}{c}{k}") for k in (1, 2) for c in "xy")
        return F.signum((bx - ax) * (F.col(y) - ay) - (by - ay) * (F.col(x) - ax))

    apart = (side("o_", "", "x1", "y1") * side("o_", "", "x2", "y2") < 0) & (side("", "o_", "o_x1", "o_y1") * side("", "o_", "o_x2", "o_y2") < 0)
    crossing = met.where(first & apart).select(F.explode(F.array("arc", "o_arc")).alias("arc"))
    a, b = F.struct(F.col("x1").alias("x"), F.col("y1").alias("y")), F.struct(F.col("x2").alias("x"), F.col("y2").alias("y"))
    same = edges.groupBy(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).agg(F.collect_set("arc").alias("arcs")).where(F.size("arcs") > 1)
    return crossing.unionByName(same.select(F.explode("arcs").alias("arc"))).distinct()


def simplify_layer(zones: DataFrame, tolerance: float = SIMPLIFY_TOLERANCE) -> DataFrame:
    """Zones with simplified rings; borders that neighbours share stay shared, vertex for vertex, and no edges cross.

    Every vertex dropped lies within ``tolerance`` of the new border. Rows keep all their columns.
    """
    numbered = stored(zones.withColumn("_zone", F.monotonically_increasing_id()), "arcs-zones")
    cut = stored(ring_arcs(numbered), "arcs-rings")
    arcs = cut.groupBy("arc").agg(F.first("points").alias("points")).withColumn("halvings", F.lit(0))
    arcs = stored(arcs, "arcs-arcs")
    while True:
        thin = stored(simplified(arcs, tolerance), "arcs-thin")
        # an arc that has kept all its vertices is not to blame
        wrong = conflicting(arc_edges(thin)).join(arcs.where(F.col("halvings") < HALVINGS), "arc", "left_semi")
        wrong = stored(wrong.withColumn("wrong", F.lit(1)), "arcs-wrong")
        if wrong.isEmpty():
            break
        arcs = arcs.join(wrong, "arc", "left").select("arc", "points", (F.col("halvings") + F.coalesce("wrong", F.lit(0))).alias("halvings"))
        arcs = stored(arcs, "arcs-arcs")
    parts = cut.select("_zone", "_ring", "hole", "seq", "arc", "turned").join(thin.select("arc", "points"), "arc")
    way = F.when(F.col("turned"), F.reverse("points")).otherwise(F.col("points"))
    # the end of an arc is the start of the next one, and of the last the ring's first point
    begun = F.slice(way, F.lit(1), F.size(way) - 1)
    joined = F.flatten(F.transform(F.sort_array(F.collect_list(F.struct("seq", begun.alias("points")))), lambda a: a["points"]))
    rings = parts.groupBy("_zone", "_ring", "hole").agg(joined.alias("points"))
    closed = F.struct("hole", F.concat("points", F.slice("points", 1, 1)).alias("points"))
    whole = F.transform(F.sort_array(F.collect_list(F.struct("_ring", closed.alias("r")))), lambda r: r["r"])
    new = rings.groupBy("_zone").agg(whole.cast(RINGS_TYPE).alias("_rings"))
    others = [F.coalesce("_rings", "rings").alias("rings") if c == "rings" else F.col(c) for c in zones.columns]
    return numbered.join(new, "_zone", "left").select(*others)
