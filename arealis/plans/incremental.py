"""One tick of the incremental job: take in new files, build the months they touch anew, fill the panel.

The cleaned table only grows, one row per variable and key. A month of the panel is a function of its cleaned rows, so a
tick replaces whole months: a variable that arrives late completes its rows, and running a tick again changes nothing.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from arealis.functions.columns import month_number
from arealis.operators.explore import next_month
from arealis.operators.fill import fill_forward_backward
from arealis.operators.merge import keep_first, merge_long
from arealis.plans.batch import Tables
from arealis.registry import AREA_KEYS, PANEL_KEYS, PANEL_VARIABLES, TIME_KEYS
from arealis.session import stored
from arealis.sources.files import scan_partitioned, write_table
from arealis.streaming.ingest import existing, ingest, release_months

MONTH_STATE = "year int, month int, n_rows long"


def due_month(panel: DataFrame, as_of: dt.date) -> tuple[int, int] | None:
    """Year and month to fetch next, or none while that month is still running."""
    row = next_month(panel, as_of).first()
    return (row["year"], row["month"]) if row else None


def changed_months(cleaned: DataFrame, state: DataFrame | None) -> DataFrame:
    """Months whose cleaned rows are not those the panel was built from, with their number of rows.

    Cleaned rows are only ever added, so a month has changed if it has more of them.
    """
    now = cleaned.groupBy(*TIME_KEYS).agg(F.count(F.lit(1)).alias("n_rows"))
    return now if state is None else now.join(state, [*TIME_KEYS, "n_rows"], "left_anti")


def run_tick(
    spark: SparkSession,
    source: str,
    schema: StructType | str,
    tables: Tables,
    as_of: dt.date,
    keys: list[str] = PANEL_KEYS,
    fill_group: list[str] = AREA_KEYS,
) -> DataFrame:
    """New raw files of ``source`` -> cleaned rows -> merged panel; returns the panel filled per ``fill_group``.

    A month enters the panel when it is over; its outlier bounds then come from all its files. It is built again
    whenever files for it arrive later. ``keys`` are what the panel has one row for, year and month among them;
    of several areas under one key the first in area order counts.
    """
    ingest(spark, source, schema, tables.clean, f"{tables.root}/checkpoint")
    released = scan_partitioned(spark, tables.clean).where(month_number() < as_of.year * 12 + as_of.month - 1)
    state_folder = f"{tables.root}/months"
    state = existing(spark, state_folder, MONTH_STATE)
    changed = stored(changed_months(released, state), "changed")
    touched = released.join(changed.select(*TIME_KEYS), TIME_KEYS, "left_semi")
    values = release_months(touched, as_of.year, as_of.month)
    if set(keys) != set(PANEL_KEYS):
        rest = [k for k in PANEL_KEYS if k not in keys]
        values = keep_first(values.select("variable", *PANEL_KEYS, "value"), ["variable", *keys], rest).drop(*rest)
    fresh = merge_long(values, keys=keys)
    write_table(fresh, tables.merged, TIME_KEYS, only_present=True)
    # the months are noted after their rows: a tick that fails in between builds them again
    write_table(changed, state_folder, TIME_KEYS, only_present=True)
    panel = spark.read.schema(fresh.schema).parquet(tables.merged)
    within = [k for k in keys if k not in (*TIME_KEYS, *fill_group)]
    # a group with several rows a month has no bound on its rows: filled month by month
    return fill_forward_backward(panel, fill_group, [*TIME_KEYS, *within], PANEL_VARIABLES, TIME_KEYS if within else None)


def unfinished(panel: DataFrame, as_of: dt.date) -> DataFrame:
    """Rows of the running month or later ones, which a panel of released months never holds."""
    return panel.where(month_number() >= as_of.year * 12 + as_of.month - 1)
