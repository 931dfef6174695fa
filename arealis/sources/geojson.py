"""GeoJSON in and out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from arealis.functions.columns import normalize_columns
from arealis.functions.geometry import rings_from_geojson, rings_from_wkt
from arealis.operators.zones import to_geojson
from arealis.sources.features import feature_texts

PROPERTIES = "province string, district string, subdistric string, year int, month int, variable string, mean double, sum double"


def read_features(
    spark: SparkSession, path: str, properties: str = PROPERTIES, geometry: bool = False, lines: bool = False
) -> DataFrame:
    """Features as rows: properties with normalised names and, if asked for, the geometry as text.

    Files are feature collections, or with ``lines`` have a feature on each line. Either way many tasks parse a large file.
    """
    feature = f"struct<type:string, geometry:string, properties:struct<{_as_struct(properties)}>>"
    if lines:
        texts = spark.read.text(path).where(F.length(F.trim("value")) > 0)
    else:
        texts = feature_texts(spark, path)
    found = texts.select(F.from_json("value", feature).alias("f")).select("f.*")
    if not lines:
        found = found.where("type = 'Feature'")
    rows = found.select("properties.*", *(["geometry"] if geometry else []))
    return normalize_columns(rows)


def read_zones(
    spark: SparkSession, path: str, properties: str = "Province string, District string, Subdistric string", lines: bool = False
) -> DataFrame:
    """Zone layer from GeoJSON: name columns and ``rings``."""
    zones = read_features(spark, path, properties, geometry=True, lines=lines)
    return zones.withColumn("rings", rings_from_geojson(F.col("geometry"))).drop("geometry")


def zones_from_wkt(df: DataFrame, wkt: str = "wkt") -> DataFrame:
    """Zone layer from a table with polygons as WKT text."""
    return normalize_columns(df.withColumn("rings", rings_from_wkt(F.col(wkt))).drop(wkt))


def write_features(df: DataFrame, path: str, properties: list[str]) -> None:
    """One feature per line, so that writing and reading both split."""
    to_geojson(df, properties).write.mode("overwrite").text(path)


def _as_struct(ddl: str) -> str:
    """``a string, b decimal(10,2)`` as the inside of ``struct<...>``."""
    return StructType.fromDDL(ddl).simpleString().removeprefix("struct<").removesuffix(">")
