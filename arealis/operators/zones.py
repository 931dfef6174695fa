"""Zone layers: polygon join, centroids, simplification, GeoJSON output.

Zones carry ``rings`` (see ``functions.geometry``) beside their name columns.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arealis.functions.geometry import (
    RINGS_TYPE,
    bounding_box,
    centroid,
    covers,
    rings_to_geojson,
    zone_area,
    zone_edges,
)
from arealis.registry import AREA_KEYS, SIMPLIFY_TOLERANCE
from arealis.session import stored


#: A zone spans so many cells of its own grid, at most twice as many.
CELLS_ACROSS = 8


def zone_level(rings: Column) -> Column:
    """Level of a zone's grid, whose cells are ``2 ** level`` wide: a large zone has large cells, not many."""
    box = bounding_box(rings)
    extent = F.greatest(box["x1"] - box["x0"], box["y1"] - box["y0"])
    return F.when(extent > 0, F.floor(F.log2(extent / CELLS_ACROSS))).otherwise(F.lit(0)).cast("int")


def zone_cells(zones: DataFrame, names: list[str], cell: Column, level: Column, beyond: tuple[float, float] = (0.0, 0.0)) -> DataFrame:
    """Grid cells touched by each zone: its level, cell numbers and edges.

    A cell no edge comes near lies wholly inside or outside: outside cells are dropped, inside cells carry
    no edges. A cell on a border keeps the edges a ray to the right can meet from within it, which is all
    the exact test looks at. Cells reach ``beyond`` their right and upper side, for things of that width and height
    that are placed by their lower left corner.
    """
    boxed = zones.select(
        *names, zone_edges(F.col("rings")).alias("edges"), bounding_box(F.col("rings")).alias("box"),
        cell.alias("cell"), level.alias("level"),
    )
    cell = F.col("cell")
    margin = cell * 1e-6
    more = dict(zip("xy", map(float, beyond), strict=True))

    def span(axis: str) -> Column:
        return F.explode(F.sequence(F.floor((F.col(f"box.{axis}0") - more[axis]) / cell), F.floor(F.col(f"box.{axis}1") / cell)))

    def reaches(e: Column, axis: str, start: Column) -> Column:
        return F.greatest(e[f"{axis}1"], e[f"{axis}2"]) >= start - margin

    def begins(e: Column, axis: str, start: Column) -> Column:
        return F.least(e[f"{axis}1"], e[f"{axis}2"]) <= start + cell + more[axis] + margin

    # Row of cells first: a cell then looks at the edges of its row only.
    rows = boxed.select(*names, "edges", "box", "cell", "level", span("y").alias("cy"))
    y0 = F.col("cy") * cell
    banded = rows.withColumn("edges", F.filter("edges", lambda e: reaches(e, "y", y0) & begins(e, "y", y0)))
    cells = banded.select(*names, "edges", "cell", "level", "cy", span("x").alias("cx"))
    x0 = F.col("cx") * cell
    on_border = F.exists("edges", lambda e: reaches(e, "x", x0) & begins(e, "x", x0))
    marked = cells.select(
        "*", on_border.alias("on_border"), covers(F.col("edges"), x0 + cell / 2, y0 + cell / 2).alias("inside")
    )
    return marked.where(F.col("on_border") | F.col("inside")).select(
        *names, "level", "cx", "cy", F.when(F.col("on_border"), F.filter("edges", lambda e: reaches(e, "x", x0))).alias("edges")
    )


#: Points of a cell that one task compares with its zones; a cell with more is cut before the join.
CROWD = 500_000
#: A crowded cell is cut into ``4 ** DEPTH`` parts at most.
DEPTH = 6
PLACE = ["_base", "level", "cx", "cy"]


def _cell_of(x: Column, level: Column) -> Column:
    return F.floor(x / F.pow(F.lit(2.0), level))


def cut_places(placed: DataFrame, x: str, y: str, cells: DataFrame, crowd: int) -> tuple[DataFrame, DataFrame]:
    """Points and cells with ``_salt``, no cell and salt of which has many more than ``crowd`` points.

    A crowded cell becomes cells of a finer level, as a quadtree would cut it, in one go: its count says how deep. Of these only
    the occupied ones are made, with the edges that are near them. Points that still crowd one, as they lie on one spot, are
    dealt out by a salt, for each of which the cell is repeated.
    """
    counts = placed.join(cells.select(*PLACE).distinct(), PLACE, "left_semi").groupBy(*PLACE).agg(F.count(F.lit(1)).alias("_n"))
    depth = F.least(F.ceil(F.log(4.0, F.col("_n") / crowd)), F.lit(DEPTH)).cast("int")
    crowded = stored(counts.where(F.col("_n") > crowd).select(*PLACE, depth.alias("_depth")), "crowded")
    if crowded.isEmpty():
        return placed.withColumn("_salt", F.lit(0)), cells.withColumn("_salt", F.lit(0))

    def by_place(df: DataFrame, few: DataFrame, columns: list[str]) -> DataFrame:
        """``few`` holds crowded cells, at most one for every ``crowd`` points; where it is large, it is repeated for salts of the many."""
        if few.count() <= 100_000:
            return df.join(F.broadcast(few), columns, "left")
        salted = few.withColumn("_s", F.explode(F.sequence(F.lit(0), F.lit(63))))
        return df.withColumn("_s", F.floor(F.rand(7) * 64).cast("int")).join(salted, [*columns, "_s"], "left").drop("_s")

    finer = F.col("level") - F.coalesce("_depth", F.lit(0))
    cut = by_place(placed, crowded, PLACE).withColumns({
        "level": finer, "cx": F.when(F.col("_depth").isNull(), F.col("cx")).otherwise(_cell_of(F.col(x), finer)),
        "cy": F.when(F.col("_depth").isNull(), F.col("cy")).otherwise(_cell_of(F.col(y), finer)),
    })
    occupied = stored(cut.groupBy(*PLACE, "_depth").agg(F.count(F.lit(1)).alias("_n")), "occupied")
    salts = F.ceil(F.when(F.col("_n") > crowd, F.lit(2.0) * F.col("_n") / crowd).otherwise(1)).cast("int")
    many = stored(occupied.where(F.col("_n") > crowd).select(*PLACE, salts.alias("_salts")), "_salts")
    salt = F.floor(F.rand(11) * F.coalesce("_salts", F.lit(1))).cast("int")
    points = by_place(cut.drop("_depth"), many, PLACE).withColumn("_salt", salt).drop("_salts")

    parent = F.pow(F.lit(2.0), F.col("_depth")).cast("long")
    children = occupied.where("_depth is not null").select(
        "_base", (F.col("level") + F.col("_depth")).alias("p_level"), F.floor(F.col("cx") / parent).alias("p_cx"), F.floor(F.col("cy") / parent).alias("p_cy"),
        "level", "cx", "cy",
    )
    whole = cells.join(crowded.select(*PLACE), PLACE, "left_anti")
    parents = cells.withColumnsRenamed({"level": "p_level", "cx": "p_cx", "cy": "p_cy"})
    near = _near_edges(parents.join(children, ["_base", "p_level", "p_cx", "p_cy"]).drop("p_level", "p_cx", "p_cy"))
    return points, by_place(whole.unionByName(near), many, PLACE).withColumn(
        "_salt", F.explode(F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1))
    ).drop("_salts")


def _near_edges(cells: DataFrame) -> DataFrame:
    """Cells with the edges a ray to the right can meet from within them; those no edge comes near are wholly in or out."""
    size = F.pow(F.lit(2.0), F.col("level"))
    x0, y0, margin = F.col("cx") * size, F.col("cy") * size, size * 1e-6

    def within(e: Column, axis: str, start: Column) -> Column:
        low, high = F.least(e[f"{axis}1"], e[f"{axis}2"]), F.greatest(e[f"{axis}1"], e[f"{axis}2"])
        return (high >= start - margin) & (low <= start + size + margin)

    on_border = F.exists("edges", lambda e: within(e, "x", x0) & within(e, "y", y0))
    kept = F.filter("edges", lambda e: within(e, "y", y0) & (F.greatest(e["x1"], e["x2"]) >= x0 - margin))
    marked = cells.select("*", F.col("edges").isNull().alias("_all"), on_border.alias("_border"), covers(F.col("edges"), x0 + size / 2, y0 + size / 2).alias("_in"))
    return marked.where(F.col("_all") | F.col("_border") | F.col("_in")).withColumn("edges", F.when(F.col("_border"), kept)).drop("_all", "_border", "_in")


def zonal_join(
    points: DataFrame,
    zones: DataFrame,
    names: list[str],
    x: str = "x",
    y: str = "y",
    cell: float | None = None,
    crowd: int | None = CROWD,
) -> DataFrame:
    """Points with the names of every zone that contains them; a point outside all zones is left out.

    An equi-join on the cells of the zones' grids with the exact test on top. Each zone has the grid that suits its
    size, so its cells are a few hundred at most whatever the sizes of others; a point is placed in the grids in
    use, which are as many as there are powers of two between the smallest and the largest zone. ``cell`` sets one grid
    for all. Spark broadcasts the cells when they are small enough and otherwise joins by shuffle. Cells with more than ``crowd``
    points, which one count finds, are cut before that (not with ``cell`` or without ``crowd``).
    """
    level = F.lit(0) if cell else zone_level(F.col("rings"))
    size = (lambda at: F.lit(float(cell))) if cell else (lambda at: F.pow(F.lit(2.0), at))
    cells = zone_cells(zones, names, size(level), level)
    levels = zones.agg(F.collect_set(level).alias("levels")).scalar()
    placed = points.select("*", F.explode(levels).alias("level"))
    placed = placed.withColumns({"cx": F.floor(F.col(x) / size(F.col("level"))), "cy": F.floor(F.col(y) / size(F.col("level")))})
    on = ["level", "cx", "cy"]
    if crowd and not cell:
        on = [*PLACE, "_salt"]
        placed, cells = cut_places(placed.withColumn("_base", F.col("level")), x, y, cells.withColumn("_base", F.col("level")), crowd)
    hit = F.col("edges").isNull() | covers(F.col("edges"), F.col(x), F.col(y))
    return placed.join(cells, on, "inner").where(hit).drop(*on, "edges")


def with_centroids(zones: DataFrame) -> DataFrame:
    """Centroid as ``lat`` and ``lon``, in layer units."""
    at = centroid(F.col("rings"))
    return zones.select("*", at.alias("_at")).select(*zones.columns, F.col("_at.y").alias("lat"), F.col("_at.x").alias("lon"))


def map_center(zones: DataFrame) -> DataFrame:
    """Mean of the zone centroids."""
    return with_centroids(zones).agg(F.avg("lat").alias("lat"), F.avg("lon").alias("lon"))


def with_areas(zones: DataFrame) -> DataFrame:
    return zones.withColumn("area", zone_area(F.col("rings")))


def to_geojson(df: DataFrame, properties: list[str]) -> DataFrame:
    """One GeoJSON feature per row, as text in column ``value``."""
    feature = F.struct(
        F.lit("Feature").alias("type"),
        rings_to_geojson(F.col("rings")).alias("geometry"),
        F.struct(*properties).alias("properties"),
    )
    return df.select(F.to_json(feature, {"ignoreNullFields": "false"}).alias("value"))


def simplify_zones(zones: DataFrame, tolerance: float = SIMPLIFY_TOLERANCE) -> DataFrame:
    """Drop ring vertices closer than ``tolerance`` to the simplified line; a ring keeps four points at least.

    No edges of a simplified zone cross: where they would, the zone is simplified with half the tolerance, and so on down
    to its own vertices. Borders shared by two zones may part by up to the tolerance. A zone without rings stays as it is.
    """
    others = [c for c in zones.columns if c != "rings"]
    kinds = dict(zones.dtypes)
    schema = ", ".join([*(f"`{c}` {kinds[c]}" for c in others), f"rings {RINGS_TYPE}"])
    return zones.select(*others, "rings").mapInArrow(_simplifier(tolerance), schema)


def _line_distances(xy: np.ndarray, spans: list[tuple[int, int]], keep: np.ndarray, tolerance: float) -> np.ndarray:
    """Mark in ``keep`` the vertices that divide each span until all lie within the tolerance; distances from the last line each lay by."""
    distances = np.zeros(len(xy))
    while spans:
        a, b = spans.pop()
        if b - a < 2:
            continue
        chord, inner = xy[b] - xy[a], xy[a + 1 : b] - xy[a]
        square = float(chord @ chord)
        along = np.clip(inner @ chord / square, 0, 1) if square else np.zeros(len(inner))
        gap = np.sqrt(((inner - np.outer(along, chord)) ** 2).sum(axis=1))
        distances[a + 1 : b] = gap
        far = a + 1 + int(np.argmax(gap))
        if distances[far] > tolerance:
            keep[far] = True
            spans += [(a, far), (far, b)]
    return distances


def kept_on_line(xy: np.ndarray, tolerance: float) -> np.ndarray:
    """Which vertices of a line stay; its ends always do."""
    keep = np.zeros(len(xy), bool)
    keep[[0, -1]] = True
    _line_distances(xy, [(0, len(xy) - 1)], keep, tolerance)
    return keep


def kept_vertices(xy: np.ndarray, tolerance: float) -> np.ndarray:
    """Which vertices of a closed ring (first point repeated at its end) stay."""
    n = len(xy)
    keep = np.zeros(n, bool)
    if n <= 4:
        return ~keep
    # A closed ring has no end points of its own: split it at the vertex farthest from the first.
    split = int(np.argmax(((xy - xy[0]) ** 2).sum(axis=1)))
    keep[[0, split, n - 1]] = True
    distances = _line_distances(xy, [(0, split), (split, n - 1)], keep, tolerance)
    spare = np.flatnonzero(~keep)
    keep[spare[np.argsort(-distances[spare], kind="stable")][: max(0, 4 - int(keep.sum()))]] = True
    return keep


#: Pairs of edges that are tested at once.
PAIRS = 1_000_000


def edges_cross(rings: list[np.ndarray]) -> bool:
    """Whether two edges of the rings cross in a point inside both.

    Each edge owns up to four cells of a grid whose cells are as wide as it is long. Edges that cross meet in a cell that the
    longer one owns, so an edge is compared with those of its neighbourhood, not with all.
    """
    a = np.concatenate([np.zeros((0, 2)), *[r[:-1] for r in rings if len(r)]])
    b = np.concatenate([np.zeros((0, 2)), *[r[1:] for r in rings if len(r)]])
    long = (a != b).any(axis=1)
    a, b = a[long], b[long]
    if not len(a):
        return False
    low, high = np.minimum(a, b), np.maximum(a, b)
    origin, extent = low.min(axis=0), (high - low).max(axis=1)
    level = np.ceil(np.log2(extent)).astype(np.int64)

    def side(p: np.ndarray, q: np.ndarray, r: np.ndarray) -> np.ndarray:
        return np.sign((q[:, 0] - p[:, 0]) * (r[:, 1] - p[:, 1]) - (q[:, 1] - p[:, 1]) * (r[:, 0] - p[:, 0]))

    for v in np.unique(level):
        edge, cell = _cells_of(np.flatnonzero(level <= v), low, high, origin, 2.0 ** float(v))
        order = np.argsort(cell, kind="stable")
        edge, cell = edge[order], cell[order]
        owned = np.flatnonzero(level[edge] == v)  # each owner's place meets all edges of its cell
        first, last = np.searchsorted(cell, cell[owned], "left"), np.searchsorted(cell, cell[owned], "right")
        done = np.r_[0, np.cumsum(last - first)]
        start = 0
        while start < len(owned):
            end = max(start + 1, int(np.searchsorted(done, done[start] + PAIRS, "right")) - 1)
            n = (last - first)[start:end]
            i = np.repeat(edge[owned[start:end]], n)
            j = edge[np.repeat(first[start:end], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)]
            if ((side(a[i], b[i], a[j]) * side(a[i], b[i], b[j]) < 0) & (side(a[j], b[j], a[i]) * side(a[j], b[j], b[i]) < 0)).any():
                return True
            start = end
    return False


def _cells_of(edges: np.ndarray, low: np.ndarray, high: np.ndarray, origin: np.ndarray, cell: float) -> tuple[np.ndarray, np.ndarray]:
    """Edges no longer than a cell with the number of each cell they touch."""
    c0, c1 = (np.floor((p[edges] - origin) / cell).astype(np.int64) for p in (low, high))
    columns = int(c1[:, 0].max()) + 2
    found = [(edges, c0[:, 0] + c0[:, 1] * columns)]
    wide, tall = c1[:, 0] > c0[:, 0], c1[:, 1] > c0[:, 1]
    for there, dx, dy in ((wide, 1, 0), (tall, 0, 1), (wide & tall, 1, 1)):
        found.append((edges[there], c0[there, 0] + dx + (c0[there, 1] + dy) * columns))
    return np.concatenate([e for e, _ in found]), np.concatenate([c for _, c in found])


def _zone_mask(rings: list[np.ndarray], tolerance: float) -> np.ndarray:
    """Vertices of all rings of a zone that stay, one after the other."""
    while True:
        masks = [kept_vertices(r, tolerance) for r in rings]
        whole = all(m.all() for m in masks)
        if whole or not edges_cross([r[m] for r, m in zip(rings, masks, strict=True) if len(r)]):
            return np.concatenate([np.zeros(0, bool), *masks])
        # a tolerance below the coordinates' resolution keeps every bend
        tolerance = tolerance / 2 if tolerance > 1e-300 else -1.0


def _simplifier(tolerance: float) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Works on the flat coordinates of a batch; only the offsets of its lists change."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index("rings")
            zone = batch.column(at)
            if not len(zone.values):
                yield batch
                continue
            points = zone.values.field("points")
            of_zone, of_ring = zone.offsets.to_numpy(), points.offsets.to_numpy()
            xy = np.stack([points.values.field(c).to_numpy(zero_copy_only=False) for c in "xy"], axis=1)
            keep = np.zeros(len(xy), bool)
            for first, end in zip(of_zone[:-1], of_zone[1:], strict=True):
                cuts = of_ring[first : end + 1]
                if end > first and cuts[-1] > cuts[0]:
                    keep[cuts[0] : cuts[-1]] = _zone_mask([xy[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)], tolerance)
            before = np.r_[0, np.cumsum(keep)].astype(np.int32)
            flat = pa.StructArray.from_arrays([pa.array(xy[keep, 0]), pa.array(xy[keep, 1])], names=["x", "y"])
            thin = pa.ListArray.from_arrays(pa.array(before[of_ring], pa.int32()), flat)
            rings = pa.StructArray.from_arrays([zone.values.field("hole"), thin], names=["hole", "points"])
            out = pa.ListArray.from_arrays(zone.offsets, rings, mask=zone.is_null())
            yield pa.RecordBatch.from_arrays([*batch.columns[:at], out, *batch.columns[at + 1 :]], names=batch.schema.names)

    return run


def map_points(zones: DataFrame, values: DataFrame, variable: str, keys: list[str] = AREA_KEYS) -> DataFrame:
    """Centroid and value per zone; zones lacking either are left out."""
    joined = with_centroids(zones).join(values, keys, "left")
    return joined.select(*keys, "lat", "lon", variable).na.drop("any", subset=["lat", "lon", variable])
