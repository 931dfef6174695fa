"""Versions of a set of tables that change together: one small manifest names the folders of each.

A tick writes new folders beside the old ones, numbered by itself, and then one manifest: a single file, which the file system
shows whole or not at all. That file is the commit. Until it is there readers find the version before, whatever else was
written; a tick that failed is run again under the same number and replaces what it had left. A reader keeps the version it
has taken and is not touched by later ones, as no folder is ever rewritten.

A manifest grows with the number of months, not with the rows.
"""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

MANIFEST = "manifest string, version int"


@dataclass(frozen=True)
class Version:
    """What belongs to a version. Months are month numbers; a folder is named by the batch or tick that wrote it."""

    number: int = 0
    #: last batch of the stream that is taken in
    batch: int = -1
    #: month -> batches with rows for it
    clean: dict[int, list[int]] = field(default_factory=dict)
    #: month -> tick that merged it, and the batches it was made of
    merged: dict[int, int] = field(default_factory=dict)
    built_from: dict[int, list[int]] = field(default_factory=dict)
    #: month -> tick that filled it
    filled: dict[int, int] = field(default_factory=dict)
    #: last month a snapshot covers -> tick that wrote it
    snapshots: dict[int, int] = field(default_factory=dict)
    #: table -> schema as JSON
    schemas: dict[str, str] = field(default_factory=dict)


def manifests(root: str) -> str:
    return f"{root}/versions"


def current(spark: SparkSession, root: str, number: int | None = None) -> Version:
    """The newest version, or an earlier one by its number; version 0 is empty."""
    try:
        found = spark.read.schema(MANIFEST).option("basePath", manifests(root)).text(manifests(root))
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return Version()
    found = found if number is None else found.where(found.version == number)
    row = found.orderBy(found.version.desc()).first()
    if row is None:
        return Version()
    kept = json.loads(row.manifest)
    by_month = {k: {int(m): v for m, v in kept[k].items()} for k in ("clean", "merged", "built_from", "filled", "snapshots")}
    return Version(**kept | by_month)


def commit(spark: SparkSession, root: str, version: Version) -> Version:
    """Make a version the newest one. What an interrupted commit of the same number has left is replaced."""
    row = spark.createDataFrame([(json.dumps(asdict(version)),)], "manifest string")
    row.coalesce(1).write.mode("overwrite").text(f"{manifests(root)}/version={version.number}")
    return version


def read_folders(spark: SparkSession, base: str, folders: list[str], schema: StructType) -> DataFrame:
    """Some partition folders of a table, no others are listed."""
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", base).parquet(*[f"{base}/{f}" for f in folders])
