"""Exact order statistics of groups that may be far larger than one task.

A whole group is never sorted in one place. A first read sketches each group's quantiles, which gives for every wanted
rank a narrow window of values that holds it, whatever the distribution. A second read counts and adds up the values
outside the windows by the gap they lie in and collapses those inside to ``(value, count)``; both shrink before the
shuffle. What is left of a group is sorted: its few gaps and the distinct values of its windows, a share of the group of
about ``2 * MARGIN / accuracy`` per wanted rank. A rank its window does not hold, which the sketch's error bound rules out, fails the job.

The first read can be had from storage: ``quantile_state`` keeps a mergeable sketch per group, and the sketches of a table's parts
merged (``merged_state``) give the windows of the whole without reading it. The state must be that of the rows given; where the
numbers of values differ the job fails.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from arealis.session import stored

ACCURACY = 10_000
#: Half a window in units of the sketch's rank error.
MARGIN = 4
#: Size of a mergeable sketch; a group of fewer values is kept as it is.
SKETCH_K = 4096


def rank_error(k: int) -> float:
    """Error of a rank in a mergeable sketch as a share of the group, exceeded once in a hundred times."""
    return 2.296 / k**0.9723


def state_columns(value: Column, k: int = SKETCH_K) -> list[Column]:
    """Aggregates that make a group's mergeable state: number of values ``n``, ``sketch``."""
    return [F.count(value).alias("n"), F.kll_sketch_agg_double(value.cast("double"), k).alias("sketch")]


def quantile_state(df: DataFrame, keys: list[str], value: str, k: int = SKETCH_K) -> DataFrame:
    """Mergeable state per group."""
    return df.groupBy(*keys).agg(*state_columns(F.col(value), k))


def merged_state(states: DataFrame, keys: list[str], k: int = SKETCH_K) -> DataFrame:
    """One state per group out of those of its parts."""
    filled = states.where(F.col("n") > 0)
    return filled.groupBy(*keys).agg(F.sum("n").alias("n"), F.kll_merge_agg_double("sketch", k).alias("sketch"))


def _state_windows(state: DataFrame, keys: list[str], probabilities: list[float], k: int) -> DataFrame:
    """As ``_windows``, from a merged state."""
    half = MARGIN * rank_error(k)
    whole = F.col("n") <= 4 * k

    def edge(p: float) -> Column:
        return F.kll_sketch_get_quantile_double("sketch", F.lit(p))

    windows = [
        F.struct(
            F.when(whole | F.lit(p <= half), F.lit(float("-inf"))).otherwise(edge(max(p - half, 0.0))).alias("low"),
            F.when(whole | F.lit(p + half >= 1), F.lit(float("inf"))).otherwise(edge(min(p + half, 1.0))).alias("high"),
        )
        for p in probabilities
    ]
    return state.select(*[F.col(c).alias(f"_w_{c}") for c in keys], F.col("n").alias("_n"), F.array(*windows).alias("_windows"))


def _windows(values: DataFrame, keys: list[str], probabilities: list[float], accuracy: int) -> DataFrame:
    """Per group its number of values and a window of values around each probability; a small group is one window."""
    at = [min(max(p + side * MARGIN / accuracy, 0.0), 1.0) for p in probabilities for side in (-1, 1)]
    sketch = values.groupBy(*keys).agg(F.percentile_approx("_v", at, accuracy).alias("_e"), F.count("_v").alias("_n"))
    whole = F.col("_n") <= 2 * accuracy
    low, high = F.lit(float("-inf")), F.lit(float("inf"))
    windows = [
        F.struct(
            F.when(whole | F.lit(at[i] <= 0), low).otherwise(F.get("_e", F.lit(i))).alias("low"),
            F.when(whole | F.lit(at[i + 1] >= 1), high).otherwise(F.get("_e", F.lit(i + 1))).alias("high"),
        )
        for i in range(0, len(at), 2)
    ]
    return sketch.select(*[F.col(k).alias(f"_w_{k}") for k in keys], "_n", F.array(*windows).alias("_windows"))


def windows_store(windows: DataFrame) -> DataFrame:
    """Keep the windows in the shared folder: their size is known before the join, so few are broadcast and no values move."""
    return stored(windows, "windows")


def ranked_values(
    df: DataFrame, keys: list[str], value: str, probabilities: list[float], accuracy: int = ACCURACY,
    state: DataFrame | None = None, k: int = SKETCH_K, keep: Callable[[DataFrame], DataFrame] = lambda windows: windows,
) -> DataFrame:
    """What is left of each group, in order: ``_v`` (null for a gap), count ``_c``, sum ``_sum``, rows before ``_from``, ``_n``."""
    values = df.where(F.col(value).isNotNull()).select(*keys, F.col(value).cast("double").alias("_v"))
    windows = _windows(values, keys, probabilities, accuracy) if state is None else _state_windows(state, keys, probabilities, k)
    windows = keep(windows)
    same = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"_w_{k}")) for k in keys])
    each = [F.get("_windows", F.lit(i)) for i in range(len(probabilities))]
    inside = reduce(Column.__or__, [F.col("_v").between(w["low"], w["high"]) for w in each])
    gap = reduce(Column.__add__, [F.when(F.col("_v") > w["high"], 1).otherwise(0) for w in each])
    placed = values.join(windows, same, "inner" if state is None else "left").select(
        *keys, "_n", F.when(inside, F.col("_v")).alias("_inside"), F.when(~inside, gap).alias("_gap"), "_v"
    )
    left = placed.groupBy(*keys, "_n", "_inside", "_gap").agg(
        F.count(F.lit(1)).alias("_c"), F.sum("_v").alias("_sum"), F.min("_v").alias("_at")
    )
    if state is not None:
        whole = W.partitionBy(*keys)
        known = F.col("_n").eqNullSafe(F.sum("_c").over(whole))
        left = left.withColumn("_n", F.when(known, F.col("_n")).otherwise(F.raise_error(F.lit("state of other rows")).cast("long")))
    before = W.partitionBy(*keys).orderBy("_at").rowsBetween(W.unboundedPreceding, -1)
    return left.select(
        *keys, F.col("_inside").alias("_v"), "_c", "_sum", F.coalesce(F.sum("_c").over(before), F.lit(0)).alias("_from"), "_n"
    )


def _found(value: Column) -> Column:
    return F.coalesce(value, F.raise_error(F.lit("rank outside its window")).cast("double"))


def exact_quantiles(
    df: DataFrame, keys: list[str], value: str, probabilities: dict[str, float], accuracy: int = ACCURACY,
    state: DataFrame | None = None, k: int = SKETCH_K, keep: Callable[[DataFrame], DataFrame] = lambda windows: windows,
) -> DataFrame:
    """Quantiles per group by linear interpolation, one output column per entry of ``probabilities``.

    With the merged ``state`` of the rows (sketches of size ``k``) they are read once instead of twice. A job passes as ``keep``
    how to store the windows (``windows_store``); without it the join with them may shuffle and sort the values by group.
    """
    ranked = ranked_values(df, keys, value, list(probabilities.values()), accuracy, state, k, keep)
    position = {name: F.lit(float(p)) * (F.col("_n") - 1) for name, p in probabilities.items()}

    def at(rank: Column) -> Column:
        return F.max(F.when((rank >= F.col("_from")) & (rank < F.col("_from") + F.col("_c")), F.col("_v")))

    picks = []
    for name, pos in position.items():
        picks += [at(F.floor(pos)).alias(f"_{name}_lo"), at(F.ceil(pos)).alias(f"_{name}_hi")]
    picked = ranked.groupBy(*keys).agg(F.max("_n").alias("_n"), *picks)

    def between(name: str) -> Column:
        low, high, pos = _found(F.col(f"_{name}_lo")), _found(F.col(f"_{name}_hi")), position[name]
        return (low + (high - low) * (pos - F.floor(pos))).alias(name)

    return picked.select(*keys, *[between(n) for n in probabilities])


def trimmed_mean(
    df: DataFrame, keys: list[str], value: str, ratio: float, name: str | None = None, accuracy: int = ACCURACY
) -> DataFrame:
    """Mean per group after cutting ``floor(ratio * n)`` values from each end; nulls are not counted.

    Gaps lying wholly between the cuts add their sum; values are looked at singly around the two cuts only.
    """
    if not 0 <= ratio < 0.5:
        raise ValueError("ratio must be at least 0 and below 0.5")
    ranked = ranked_values(df, keys, value, [ratio, 1 - ratio], accuracy, keep=windows_store)
    cut = F.floor(F.lit(float(ratio)) * F.col("_n"))
    end = F.col("_n") - cut
    kept = F.greatest(F.lit(0), F.least(F.col("_from") + F.col("_c"), end) - F.greatest(F.col("_from"), cut))
    part = (
        F.when(kept == F.col("_c"), F.col("_sum")).when(kept == 0, F.lit(0.0)).otherwise(_found(F.col("_v") * kept))
    )
    total = ranked.groupBy(*keys).agg(F.sum(part).alias("_sum"), F.max("_n").alias("_n"))
    return total.select(*keys, (F.col("_sum") / (F.col("_n") - 2 * cut)).alias(name or value))
