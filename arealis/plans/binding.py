"""The supplied tables read as observations, areas, pixels and zones.

Area = region, nation, market segment and thousand of the customer; time = month of the order. Each order line counts as one
observation of five raw variables. Money and quantities have two decimals and are added as whole hundredths, so
that a cell's value does not depend on the order of addition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from arealis.functions.geometry import POINT_TYPE, RINGS_TYPE
from arealis.operators.clean import clean_long
from arealis.operators.fill import fill_panel, seasonal_store
from arealis.operators.merge import merge_long, to_long
from arealis.registry import AREA_KEYS, FIRE_MASK_MIN, PANEL_KEYS
from arealis.session import stored

# The directions of a star-shaped zone's vertices, counter-clockwise.
STAR = [(1.0, 0.0), (0.75, 0.75), (0.0, 1.0), (-0.75, 0.75), (-1.0, 0.0), (-0.75, -0.75), (0.0, -1.0), (0.75, -0.75)]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _hundredths(name: str) -> Column:
    return F.floor(F.col(name) * 100 + 0.5)


def areas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nation key with province and district name."""
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    joined = nation.join(region, nation.n_regionkey == region.r_regionkey)
    return joined.select(
        F.col("n_nationkey").alias("nationkey"), F.col("r_name").alias("province"), F.col("n_name").alias("district")
    )


def subdistrict() -> Column:
    """Market segment and thousand of the customer, so that the areas grow with the customers."""
    return F.concat_ws(" ", "c_mktsegment", F.floor(F.col("c_custkey") / 1000).cast("string"))


def raw_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw values per area and month, one column per variable.

    Lines are summed per order before any join: every measure is a sum over lines, so the joins carry one row
    per order.
    """
    lines = (
        table(spark, sf_dir, "lineitem")
        .groupBy("l_orderkey")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum(_hundredths("l_quantity")).alias("quantity"),
            F.sum(_hundredths("l_discount")).alias("discount"),
            F.sum((F.col("l_linenumber") >= FIRE_MASK_MIN).cast("int")).alias("fires"),
        )
    )
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        "o_custkey",
        F.year("o_orderdate").alias("year"),
        F.month("o_orderdate").alias("month"),
        _hundredths("o_totalprice").alias("price"),
    )
    customer = table(spark, sf_dir, "customer").select(
        "c_custkey", "c_nationkey", _hundredths("c_acctbal").alias("balance"),
        subdistrict().alias("subdistrict"),
    )
    observed = (
        orders.join(lines, F.col("o_orderkey") == F.col("l_orderkey"))
        .join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(areas(spark, sf_dir), F.col("c_nationkey") == F.col("nationkey"))
    )
    n = F.sum("n").cast("double")

    def total(hundredths: Column) -> Column:
        return F.sum(hundredths).cast("double") / 100

    return observed.groupBy(*PANEL_KEYS).agg(
        (total(F.col("price") * F.col("n")) / n / 45).alias("NDVI"),
        (total(F.col("quantity")) / n * 65 + 13500).alias("LST"),
        total(F.col("balance") * F.col("n")).alias("RAINFALL"),
        (total(F.col("discount")) / n * 12).alias("SOILMOISTURE"),
        F.sum("fires").cast("double").alias("FIRECOUNT"),
    )


def raw_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw values as rows per variable."""
    return to_long(raw_cells(spark, sf_dir))


def clean_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned rows; the raw ones are stored first, as values and outlier bounds both read them."""
    return clean_long(stored(raw_long(spark, sf_dir), "raw"))


def merged_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge_long(clean_cells(spark, sf_dir))


def filled_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The filled panel; the merged one is stored first, as grid, bounds and wider means all read it."""
    return fill_panel(stored(merged_panel(spark, sf_dir), "merged"), keep=seasonal_store)


def observed_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The uncleaned cells as a panel, for the views that only need some values per area and month."""
    return raw_cells(spark, sf_dir)


def pixel_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as a pixel series: pixel = supplier and part, time = ship date, one column per band."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("tile"),
        F.col("l_partkey").alias("pixel"),
        F.col("l_shipdate").alias("image_ts"),
        (F.col("l_extendedprice") / 10).alias("NDVI"),
        (F.col("l_quantity") * 65 + 13500).alias("LST"),
        (F.col("l_discount") * 12).alias("SOILMOISTURE"),
        (F.col("l_tax") * 100).alias("RAINFALL"),
        F.col("l_linenumber").alias("FireMask"),
    )


def tile_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zone of each tile: the supplier's nation."""
    supplier = table(spark, sf_dir, "supplier")
    zoned = supplier.join(areas(spark, sf_dir), F.col("s_nationkey") == F.col("nationkey"))
    return zoned.select(F.col("s_suppkey").alias("tile"), "province", "district")


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors as points in the plane of their first two dimensions."""
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("point_id"),
        F.get("embedding", F.lit(0)).cast("double").alias("x"),
        F.get("embedding", F.lit(1)).cast("double").alias("y"),
        F.col("label").cast("double").alias("value"),
    )


def _ring(vertices: list[tuple[Column, Column]], hole: bool = False) -> Column:
    closed = [*vertices, vertices[0]]
    return F.struct(
        F.lit(hole).alias("hole"),
        F.array(*[F.struct(x.alias("x"), y.alias("y")) for x, y in closed]).cast(f"array<{POINT_TYPE}>").alias("points"),
    )


def star_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One star-shaped zone per vector: centre from dimensions 1 and 2, eight radii from the next eight.

    Every fourth zone has a square hole around its centre. Zones shrink as they become more, so that a point lies
    in as many of them at any size of the table.
    """
    vectors = table(spark, sf_dir, "embeddings")
    scale = vectors.agg(F.sqrt(F.lit(500.0) / F.count(F.lit(1))).alias("scale")).scalar()
    dim = [F.get("embedding", F.lit(i)).cast("double") for i in range(10)]
    radius = [(F.abs(d) * 0.3 + 0.02) * F.col("scale") for d in dim[2:]]
    star = [(dim[0] + r * ux, dim[1] + r * uy) for r, (ux, uy) in zip(radius, STAR)]
    side = F.lit(0.005) * F.col("scale")
    square = [(dim[0] + dx * side, dim[1] + dy * side) for dx, dy in [(-1, -1), (1, -1), (1, 1), (-1, 1)]]
    holed = F.array(_ring(star), _ring(square, hole=True))
    rings = F.when(F.col("vec_id") % 4 == 0, holed).otherwise(F.array(_ring(star)))
    return vectors.withColumn("scale", scale).select(
        F.col("vec_id").alias("zone_id"), F.col("label").alias("zone_label"), rings.alias("rings")
    )


def tiling_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A lattice of zones without gaps: ``zone_id``, column ``i``, row ``j``, whether it is ``interior``, ``rings``.

    The vector numbered ``i + j * (m + 1)`` bends the lower and the left border of lattice cell (i, j): seven vertices each, moved
    sideways by its dimensions. Neighbours have the vertices of their border in common.
    """
    vectors = table(spark, sf_dir, "embeddings")
    side = F.floor(F.sqrt(F.count(F.lit(1)))).cast("int")
    vectors = vectors.withColumn("side", vectors.agg(side.alias("side")).scalar())
    i, j = (F.col("vec_id") % F.col("side")).cast("int"), F.floor(F.col("vec_id") / F.col("side")).cast("int")
    placed = vectors.where(F.col("vec_id") < F.col("side") * F.col("side")).withColumns({"i": i, "j": j})

    def bend(k: int, d: int) -> Column:
        return F.get("embedding", F.lit(d)).cast("double") * F.lit(1.2 * k / 8 * (1 - k / 8))

    def point(x: Column, y: Column) -> Column:
        return F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))

    x, y = F.col("i"), F.col("j")
    flat = F.array(point(x, y), *[point(x + k / 8, y + bend(k, k - 1)) for k in range(1, 8)], point(x + 1, y))
    up = F.array(point(x, y), *[point(x + bend(k, k + 7), y + k / 8) for k in range(1, 8)], point(x, y + 1))
    lines = placed.select("vec_id", "side", "i", "j", flat.alias("flat"), up.alias("up"))
    right = lines.select((F.col("i") - 1).alias("i"), "j", F.col("up").alias("right"))
    above = lines.select("i", (F.col("j") - 1).alias("j"), F.col("flat").alias("above"))
    # the last point of a line is the first of the next
    begun = lambda line: F.slice(line, 1, 8)
    ring = F.concat(begun(F.col("flat")), begun(F.col("right")), begun(F.reverse("above")), begun(F.reverse("up")), F.slice("flat", 1, 1))
    inner = (F.col("i") > 0) & (F.col("j") > 0) & (F.col("i") < F.col("side") - 2) & (F.col("j") < F.col("side") - 2)
    return lines.join(right, ["i", "j"]).join(above, ["i", "j"]).select(
        F.col("vec_id").alias("zone_id"), "i", "j", inner.alias("interior"),
        F.array(F.struct(F.lit(False).alias("hole"), ring.alias("points"))).cast(RINGS_TYPE).alias("rings"),
    )


def zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One box per area of the customers plus one per nation of the suppliers, which no panel row belongs to.

    The box spans the least and greatest balance in x (thousands), nation key and row count in y.
    """
    customers = table(spark, sf_dir, "customer").select(
        F.col("c_nationkey").alias("nationkey"), subdistrict().alias("subdistrict"), F.col("c_acctbal").alias("balance")
    )
    suppliers = table(spark, sf_dir, "supplier").select(
        F.col("s_nationkey").alias("nationkey"), F.lit("SUPPLIERS").alias("subdistrict"), F.col("s_acctbal").alias("balance")
    )
    extent = (
        customers.unionByName(suppliers)
        .groupBy("nationkey", "subdistrict")
        .agg(F.min("balance").alias("lo"), F.max("balance").alias("hi"), F.count(F.lit(1)).alias("n"))
    )
    x0, x1 = F.col("lo") / 1000, F.col("hi") / 1000 + 1
    y0 = F.col("nationkey").cast("double")
    y1 = y0 + F.col("n") / 100
    box = _ring([(x0, y0), (x1, y0), (x1, y1), (x0, y1)])
    return extent.join(areas(spark, sf_dir), "nationkey").select(*AREA_KEYS, F.array(box).alias("rings"))


