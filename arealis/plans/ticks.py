"""The incremental job in versions: a tick costs the months it touches, and shows all its tables at once or not at all.

Tables below the root, all written in folders of their own per batch or tick (``sources.versions``):

* ``clean``: cleaned rows by batch of the stream, year and month. ``arrivals`` notes the variables and months each batch has rows
  for, with a mergeable sketch of the values: those of a month's batches merged replace the first read for its outlier bounds.
* ``merged``: the panel by tick, year and month. A month is merged from its cleaned rows, whole, when they have changed and the
  month is over. Which months have changed follows from the manifest; no table is read or counted for it.
* ``filled``: the panel with the last known value carried forward, by tick, year and month.
* ``snapshots``: per group the first and the last known value of each variable up to a month: at the end of each year and at
  the newest month. A tick starts from the last snapshot before the first month that has changed, so it reads that snapshot
  and the months behind it: one month if months arrive in order, up to twelve more if one arrives late.

Values before a group's first known one are filled from the newest snapshot when the panel is read (``filled_panel``): the first
known value of a group may change with every tick, and no month has to be written again for it.

One tick runs at a time; the stream's checkpoint does not let two run. Rows without year or month are kept in ``clean`` as they come
and enter no month.
"""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Callable
from dataclasses import replace
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from arealis.functions.columns import month_number
from arealis.operators.clean import drop_incomplete, uses_iqr
from arealis.operators.fill import fill_forward_backward
from arealis.operators.merge import keep_first, merge_long, unseen
from arealis.operators.ranks import merged_state, state_columns
from arealis.registry import AREA_KEYS, PANEL_KEYS, PANEL_VARIABLES, TIME_KEYS
from arealis.sources.files import write_table
from arealis.sources.versions import Version, commit, current, read_folders
from arealis.streaming.ingest import clean_stream, new_files, release_months, run_available

ARRIVALS = "variable string, year int, month int, n_rows long, n long, sketch binary, batch int"
ROW_KEYS = ["variable", *PANEL_KEYS]


def _folder(writer: str, number: int, month: int) -> str:
    return f"{writer}={number}/year={month // 12}/month={month % 12 + 1}"


def _notes(spark: SparkSession, root: str) -> DataFrame | None:
    """One row per batch, variable and month."""
    try:
        return spark.read.schema(ARRIVALS).option("basePath", f"{root}/arrivals").parquet(f"{root}/arrivals")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def _arrivals(spark: SparkSession, root: str, wanted: Column) -> dict[int, list[int]]:
    """Month -> batches with rows for it, of the batches wanted."""
    found, out = _notes(spark, root), {}
    if found is not None:
        for r in found.where(wanted).select("batch", month_number().alias("at")).distinct().orderBy("batch").collect():
            out.setdefault(r["at"], []).append(r.batch)
    return out


def month_state(spark: SparkSession, root: str, months: list[int], last: int) -> DataFrame:
    """Quantile state of the values of some months, merged from that of their batches up to the last one."""
    mine = (F.col("batch") <= last) & month_number().isin(months)
    return merged_state(_notes(spark, root).where(mine), ["variable", *TIME_KEYS])


def _clean(spark: SparkSession, root: str, batches: dict[int, list[int]], schema: StructType) -> DataFrame:
    return read_folders(spark, f"{root}/clean", [_folder("batch", b, m) for m in sorted(batches) for b in batches[m]], schema)


def add_batch(root: str, order: list[str]) -> Callable[[DataFrame, int], None]:
    """Batch writer: rows whose key has not come before, by month, then the note of the months. A repeated batch replaces itself."""

    def write(batch: DataFrame, batch_id: int) -> None:
        spark, folder = batch.sparkSession, f"{root}/clean/batch={batch_id}"
        months = {r.at for r in batch.select(month_number().alias("at")).distinct().collect()}
        earlier = _arrivals(spark, root, F.col("batch") < batch_id)
        known = _clean(spark, root, {m: b for m, b in earlier.items() if m in months}, batch.schema)
        fresh = unseen(keep_first(batch, ROW_KEYS, order), known, ROW_KEYS)
        write_table(fresh, folder, TIME_KEYS)
        written = spark.read.schema(batch.schema).parquet(folder).where(month_number().isNotNull())
        bounded = F.when(uses_iqr(), F.col("value"))
        noted = written.groupBy("variable", *TIME_KEYS).agg(F.count(F.lit(1)).alias("n_rows"), *state_columns(bounded))
        noted.coalesce(1).write.mode("overwrite").parquet(f"{root}/arrivals/batch={batch_id}")

    return write


def take_in(spark: SparkSession, source: str, schema: StructType | str, root: str, order: list[str] | None = None) -> StructType:
    """New raw files -> cleaned rows in ``clean``; returns the schema of these."""
    cleaned = drop_incomplete(clean_stream(new_files(spark, source, schema)), ["value"])
    run_available(cleaned, f"{root}/checkpoint", add_batch(root, order or ["value"]))
    return cleaned.schema


def _place(keys: list[str]) -> Column:
    return F.struct(*[F.col(k) for k in keys])


def refill(
    spark: SparkSession, root: str, version: Version, first: int, tick: int,
    keys: list[str] = PANEL_KEYS, group: list[str] = AREA_KEYS, values: list[str] = PANEL_VARIABLES,
) -> Version:
    """Fill the months from ``first`` on from the snapshot before; ``version`` names merged months that are written already."""
    before = [m for m in version.snapshots if m < first]
    base = max(before, default=-1)
    span = [m for m in sorted(version.merged) if m > base]
    merged_schema = StructType.fromJson(json.loads(version.schemas["merged"]))
    rows = read_folders(spark, f"{root}/merged", [_folder("tick", version.merged[m], m) for m in span], merged_schema)
    rows = rows.select(*keys, *values)
    within = [k for k in keys if k not in (*TIME_KEYS, *group)]
    order = [*TIME_KEYS, *within]
    if before:
        snapshot = _snapshot(spark, root, version, base).withColumns({k: F.lit(0).cast("int") for k in TIME_KEYS})
        known = snapshot.withColumns({k: F.lit(None).cast(merged_schema[k].dataType) for k in within})
    else:
        known = rows.limit(0).withColumns({f"_{end}_{v}": F.col(v) for v in values for end in ("first", "last")})
    carried = known.select(*keys, *[F.col(f"_last_{v}").alias(v) for v in values])
    filled = fill_forward_backward(rows.unionByName(carried), group, order, values, TIME_KEYS if within else None, backward=False)
    write_table(filled.where((F.col("year") > 0) & (month_number() >= first)), f"{root}/filled/tick={tick}", TIME_KEYS)

    newest = max(version.merged)
    points = sorted({m for m in range(first, newest) if m % 12 == 11} | {newest})
    ends = rows.withColumns({f"_{end}_{v}": F.col(v) for v in values for end in ("first", "last")}).drop(*values)
    ends = ends.unionByName(known.select(*ends.columns))
    reached = F.filter(F.array(*[F.lit(p) for p in points]), lambda p: p >= month_number())
    spread = ends.withColumn("point", F.explode(reached))
    at = _place(order)
    picked = [
        f(F.col(f"_{end}_{v}"), F.when(F.col(f"_{end}_{v}").isNotNull(), at)).alias(f"_{end}_{v}")
        for v in values for end, f in (("first", F.min_by), ("last", F.max_by))
    ]
    snapshots = spread.groupBy(*group, "point").agg(*picked)
    write_table(snapshots, f"{root}/snapshots/tick={tick}", ["point"])
    kept = {m: t for m, t in version.snapshots.items() if m < first and m % 12 == 11}
    return replace(
        version,
        filled={m: t for m, t in version.filled.items() if m < first} | {m: tick for m in version.merged if m >= first},
        snapshots=kept | {p: tick for p in points},
        schemas=version.schemas | {"filled": filled.schema.json(), "snapshots": snapshots.schema.json()},
    )


def _snapshot(spark: SparkSession, root: str, version: Version, point: int) -> DataFrame:
    schema = StructType.fromJson(json.loads(version.schemas["snapshots"]))
    return read_folders(spark, f"{root}/snapshots", [f"tick={version.snapshots[point]}/point={point}"], schema).drop("tick", "point")


def run_tick(
    spark: SparkSession, source: str, schema: StructType | str, root: str, as_of: dt.date,
    keys: list[str] = PANEL_KEYS, group: list[str] = AREA_KEYS, values: list[str] = PANEL_VARIABLES,
) -> Version:
    """New raw files of ``source`` -> clean, merged and filled tables of a new version, which is returned.

    A month enters the panel when it is over at ``as_of``. ``keys`` are what the panel has one row for, year and month among them;
    of several areas under one key the first in area order counts. ``group`` is what values are carried within.
    """
    cleaned = take_in(spark, source, schema, root)
    old = current(spark, root)
    arrived = _arrivals(spark, root, F.col("batch") > old.batch)
    clean = {m: [*old.clean.get(m, []), *arrived.get(m, [])] for m in {*old.clean, *arrived}}
    changed = sorted(m for m, b in clean.items() if m < as_of.year * 12 + as_of.month - 1 and old.built_from.get(m) != b)
    if not arrived and not changed:
        return old
    tick = old.number + 1
    last = max((b[-1] for b in arrived.values()), default=old.batch)
    new = replace(old, number=tick, batch=last, clean=clean, schemas=old.schemas | {"clean": cleaned.json()})
    if changed:
        touched = {m: clean[m] for m in changed}
        found = release_months(_clean(spark, root, touched, cleaned), as_of.year, as_of.month, month_state(spark, root, changed, last))
        if set(keys) != set(PANEL_KEYS):
            rest = [k for k in PANEL_KEYS if k not in keys]
            found = keep_first(found.select("variable", *PANEL_KEYS, "value"), ["variable", *keys], rest).drop(*rest)
        merged = merge_long(found, values, keys)
        write_table(merged, f"{root}/merged/tick={tick}", TIME_KEYS)
        new = replace(
            new, merged=old.merged | dict.fromkeys(changed, tick), built_from=old.built_from | touched,
            schemas=new.schemas | {"merged": merged.schema.json()},
        )
        new = refill(spark, root, new, changed[0], tick, keys, group, values)
    return commit(spark, root, new)


def _panel(spark: SparkSession, root: str, version: Version, table: str, folders: dict[int, int]) -> DataFrame:
    schema = StructType.fromJson(json.loads(version.schemas[table]))
    return read_folders(spark, f"{root}/{table}", [_folder("tick", folders[m], m) for m in sorted(folders)], schema).select(*schema.names)


def clean_table(spark: SparkSession, root: str, version: Version) -> DataFrame:
    """The cleaned rows of a version."""
    schema = StructType.fromJson(json.loads(version.schemas["clean"]))
    return _clean(spark, root, version.clean, schema).select(*schema.names)


def merged_panel(spark: SparkSession, root: str, version: Version) -> DataFrame:
    """The panel of a version as observed."""
    return _panel(spark, root, version, "merged", version.merged)


def filled_panel(
    spark: SparkSession, root: str, version: Version, group: list[str] = AREA_KEYS, values: list[str] = PANEL_VARIABLES,
    months: range | None = None,
) -> DataFrame:
    """The filled panel of a version, or some of its months (month numbers): values carried forward, and before a group's first one that."""
    folders = {m: t for m, t in version.filled.items() if months is None or m in months}
    rows = _panel(spark, root, version, "filled", folders)
    first = _snapshot(spark, root, version, max(version.snapshots)).select(
        *[F.col(k).alias(f"_k_{k}") for k in group], *[F.col(f"_first_{v}") for v in values]
    )
    same = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in group])
    return rows.join(first, same, "left").select(
        *[F.coalesce(c, f"_first_{c}").alias(c) if c in values else F.col(c) for c in rows.columns]
    )
