"""Bringing variables, files and runs together."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arealis.registry import PANEL_KEYS, PANEL_VARIABLES


def project_value(df: DataFrame, reducer: str, variable: str, keys: list[str] = PANEL_KEYS) -> DataFrame:
    """Keys and the reducer column, renamed to the variable."""
    return df.select(*keys, F.col(reducer).alias(variable))


def to_long(wide: DataFrame, variables: list[str] = PANEL_VARIABLES, keys: list[str] = PANEL_KEYS) -> DataFrame:
    """One row per key and variable."""
    return wide.unpivot(keys, variables, "variable", "value")


def concat_all(frames: list[DataFrame]) -> DataFrame:
    """UNION ALL by column name; a column missing in one part is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def outer_merge(frames: list[DataFrame], keys: list[str] = PANEL_KEYS, unique: bool = True) -> DataFrame:
    """Full outer join of any number of tables on ``keys``; null keys match each other.

    With unique keys, as cleaned tables have, the join is a union grouped by key: one shuffle for all
    tables, and a frequent key cannot multiply. A repeated key in one table then fails the job.
    ``unique=False`` joins the tables pair by pair, where repeated keys multiply.
    """
    return _merge_grouped(frames, keys) if unique else _merge_joined(frames, keys)


def _merge_grouped(frames: list[DataFrame], keys: list[str]) -> DataFrame:
    tagged = concat_all([f.withColumn("_source", F.lit(i)) for i, f in enumerate(frames)])
    columns = []
    for i, frame in enumerate(frames):
        here = F.col("_source") == i
        for name in frame.columns:
            if name not in keys:
                columns.append(_single(here, F.col(name), name, keys))
    return tagged.groupBy(*keys).agg(*columns)


def _single(here: Column, value: Column, name: str, keys: list[str]) -> Column:
    """The group's value where ``here`` holds; a second row there is an error."""
    message = F.concat(F.lit(f"{name}: repeated key "), F.to_json(F.struct(*keys)))
    only = F.max(F.when(here, value))
    return F.when(F.count_if(here) <= 1, only).otherwise(F.raise_error(message)).alias(name)


def _merge_joined(frames: list[DataFrame], keys: list[str]) -> DataFrame:
    def pair(left: DataFrame, right: DataFrame) -> DataFrame:
        same = reduce(
            lambda a, b: a & b, [F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}")) for k in keys]
        )
        joined = left.alias("l").join(right.alias("r"), same, "full_outer")
        return joined.select(
            *[F.coalesce(f"l.{k}", f"r.{k}").alias(k) for k in keys],
            *[F.col(f"l.{c}") for c in left.columns if c not in keys],
            *[F.col(f"r.{c}") for c in right.columns if c not in keys],
        )

    return reduce(pair, frames)


def merge_long(
    long: DataFrame, variables: list[str] = PANEL_VARIABLES, keys: list[str] = PANEL_KEYS
) -> DataFrame:
    """Long table -> one row per key and one column per variable, in one shuffle.

    A repeated (key, variable) has no single value, so the job fails on it; the result is unique per key. Partial aggregation keeps a frequent key to one row per map task.
    """

    return long.groupBy(*keys).agg(*[_single(F.col("variable") == v, F.col("value"), v, keys) for v in variables])


def variable_counts(long: DataFrame) -> DataFrame:
    """Rows per variable."""
    return long.groupBy("variable").agg(F.count(F.lit(1)).alias("n_rows"))


def keep_first(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per key: the first by ``order``, nulls last.

    An aggregate rather than a ranking window, so that a frequent key shrinks before the shuffle.
    """
    rest = [c for c in df.columns if c not in keys]
    if rest == order and len(order) == 1:  # its least value: numbers are then kept in a hash table, not sorted as structs are
        return df.groupBy(*keys).agg(F.min(order[0]).alias(order[0])).select(*df.columns)
    payload = F.struct(*[F.col(c) for c in rest])
    picked = df.groupBy(*keys).agg(F.min_by(payload, F.struct(*[f for c in order for f in (F.col(c).isNull(), F.col(c))])).alias("_first"))
    return picked.select(*keys, "_first.*").select(*df.columns)


def upsert_keep_first(
    old: DataFrame, new: DataFrame, keys: list[str], order: list[str], old_is_unique: bool = False
) -> DataFrame:
    """Old and new rows together, one row per key; an old row beats a new one, then ``order`` decides.

    A table kept by this operator is unique already. ``old_is_unique`` then leaves its rows where they are:
    only its keys are read to find out which new rows to add.
    """
    if old_is_unique:
        return concat_all([old, unseen(keep_first(new, keys, order), old, keys)])
    both = concat_all([old.withColumn("_source", F.lit(0)), new.withColumn("_source", F.lit(1))])
    return keep_first(both, keys, ["_source", *order]).drop("_source")


def unseen(new: DataFrame, old: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``new`` whose key is not in ``old``; null keys match each other."""
    known = old.select(*keys).alias("o")
    same = reduce(lambda a, b: a & b, [F.col(f"n.{k}").eqNullSafe(F.col(f"o.{k}")) for k in keys])
    return new.alias("n").join(known, same, "left_anti")
