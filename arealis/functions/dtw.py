"""Dynamic time warping between two numeric arrays."""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

INFINITY = float("inf")


def dtw_column(x: Column | str, y: Column | str) -> Column:
    """DTW distance as a built-in expression: no Python worker, usable inside any plan.

    One row of the cumulative-cost table is the accumulator. Step ``v`` of ``x`` turns row ``i - 1`` into row
    ``i``: its first cell is infinite, cell ``j`` adds ``|v - y[j]|`` to the cheapest of left, upper and
    diagonal neighbour. Null when either array is null, empty or holds a null.
    """
    x = F.col(x) if isinstance(x, str) else x
    y = F.col(y) if isinstance(y, str) else y
    columns = F.sequence(F.lit(1), F.size(y))
    first = F.concat(F.array(F.lit(0.0)), F.array_repeat(F.lit(INFINITY), F.size(y)))

    def next_row(row: Column, v: Column) -> Column:
        def next_cell(cells: Column, j: Column) -> Column:
            cheapest = F.least(F.element_at(cells, -1), F.get(row, j), F.get(row, j - 1))
            return F.concat(cells, F.array(F.abs(v - F.get(y, j - 1)) + cheapest))

        return F.aggregate(columns, F.array(F.lit(INFINITY)), next_cell)

    distance = F.element_at(F.aggregate(x, first, next_row), -1)
    return F.when(is_complete(x) & is_complete(y), distance)


def is_complete(values: Column) -> Column:
    """Non-empty array without nulls."""
    return (F.size(values) > 0) & ~F.exists(values, lambda v: v.isNull())


def dtw_arrow() -> Callable[..., Column]:
    """DTW distance as an Arrow UDF: each step of the recurrence runs over a whole batch of pairs.

    The kernel is a closure so that workers need no copy of this package.
    """

    def kernel(x: pa.Array, y: pa.Array) -> pa.Array:
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        def lengths(lists):
            return pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)

        def matrix(lists, width):
            return lists.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(-1, width)

        out = np.full(len(x), np.nan)
        n_x, n_y = lengths(x), lengths(y)
        # Pairs of one shape are warped together; monthly vectors have a single shape.
        for n, m in {(int(n), int(m)) for n, m in zip(n_x, n_y)}:
            if n == 0 or m == 0:
                continue
            rows = np.flatnonzero((n_x == n) & (n_y == m))
            a, b = matrix(x.take(pa.array(rows)), n), matrix(y.take(pa.array(rows)), m)
            before = np.full((m + 1, len(rows)), np.inf)
            before[0] = 0.0
            for i in range(n):
                now = np.full_like(before, np.inf)
                step = np.abs(a[:, i] - b.T)
                for j in range(m):
                    now[j + 1] = step[j] + np.minimum(np.minimum(before[j], before[j + 1]), now[j])
                before = now
            out[rows] = np.where(np.isnan(a).any(axis=1) | np.isnan(b).any(axis=1), np.nan, before[m])
        return pa.array(out, mask=np.isnan(out))

    return F.arrow_udf(kernel, DoubleType())


def register_dtw(spark: SparkSession, name: str = "dtw_distance") -> None:
    """Make the Arrow UDF callable from SQL."""
    spark.udf.register(name, dtw_arrow())
