"""Unit scaling, range masks and outlier masks. A masked value becomes null; its row stays."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arealis.functions.columns import nan_to_null
from arealis.operators.ranks import exact_quantiles, windows_store
from arealis.registry import IQR_FACTOR, TIME_KEYS, VARIABLES, Variable
from arealis.session import stored


def rescaled(rule: Variable, value: Column) -> Column:
    """Stored number -> physical unit."""
    return rule.rescale(value) if rule.rescale else value


def in_range(rule: Variable, value: Column) -> Column:
    """Null outside the inclusive valid range and at the sentinel."""
    ok = value >= rule.low
    if rule.high is not None:
        ok = ok & (value <= rule.high)
    if rule.sentinel is not None:
        ok = ok & (value != rule.sentinel)
    return F.when(ok, value)


def by_variable(apply, variable: str = "variable", value: str = "value") -> Column:
    """One CASE over the variable name, so all variables are handled in one scan."""
    cases = [(F.col(variable) == name, apply(rule, F.col(value))) for name, rule in VARIABLES.items()]
    first, rest = cases[0], cases[1:]
    return reduce(lambda acc, case: acc.when(*case), rest, F.when(*first))


def known_variables(df: DataFrame, variable: str = "variable") -> DataFrame:
    """Only registered variables; on a table partitioned by variable this prunes partitions."""
    return df.where(F.col(variable).isin(list(VARIABLES)))


def mask_rows(df: DataFrame) -> DataFrame:
    """The row-local rules over a long table: scale, valid range, sentinel. Also valid on a stream."""
    known = known_variables(nan_to_null(df, ["value"]))
    return known.withColumn("value", by_variable(lambda rule, value: in_range(rule, rescaled(rule, value))))


def iqr_mask(
    df: DataFrame, scope: list[str], value: str = "value", factor: float = IQR_FACTOR, only: Column | None = None,
    state: DataFrame | None = None,
) -> DataFrame:
    """Null outside ``[q1 - factor * iqr, q3 + factor * iqr]``, quartiles taken over each scope.

    ``state``, the merged quantile state of the scopes, saves one of the reads for the quartiles. Rows for which ``only`` is false keep their value. The bounds have one row per scope and are stored, so that
    they are joined by size: broadcast when small, and the values stay where they are, otherwise a shuffle join with skew splitting.
    """
    considered = df if only is None else df.where(only)
    bounds = exact_quantiles(considered, scope, value, {"_q1": 0.25, "_q3": 0.75}, state=state, keep=windows_store).select(
        *[F.col(k).alias(f"_s_{k}") for k in scope],
        (F.col("_q1") - factor * (F.col("_q3") - F.col("_q1"))).alias("_low"),
        (F.col("_q3") + factor * (F.col("_q3") - F.col("_q1"))).alias("_high"),
    )
    bounds = stored(bounds, "bounds")
    same = [F.col(k).eqNullSafe(F.col(f"_s_{k}")) for k in scope]
    inside = F.col(value).between(F.col("_low"), F.col("_high"))
    if only is not None:
        inside = ~only | inside
    joined = df.join(bounds, same, "left")
    return joined.withColumn(value, F.when(inside, F.col(value))).select(*df.columns)


def uses_iqr(variable: str = "variable") -> Column:
    return F.col(variable).isin([name for name, rule in VARIABLES.items() if rule.iqr])


def clean_long(df: DataFrame) -> DataFrame:
    """All rules over a long table ``(variable, area keys, year, month, value)``.

    The outlier scope is one variable and month over all areas.
    """
    return iqr_mask(mask_rows(df), ["variable", *TIME_KEYS], only=uses_iqr())


def clean_variable(df: DataFrame, name: str, value: str) -> DataFrame:
    """All rules over one variable's wide column."""
    rule = VARIABLES[name]
    masked = nan_to_null(df, [value]).withColumn(value, in_range(rule, rescaled(rule, F.col(value))))
    return iqr_mask(masked, TIME_KEYS, value) if rule.iqr else masked


def drop_incomplete(df: DataFrame, subset: list[str] | None = None) -> DataFrame:
    """Drop rows with a null in any column, or in any of ``subset``."""
    return df.na.drop("any", subset=subset)
