"""Vectors as integers: scaled and floored components, packed row by row into the narrowest type that holds them.

A vector takes no part if it is null or holds a null or a component that is not finite. A component beyond 62 bits fails
the job. An empty vector takes part; beside longer ones a short vector counts as zero beyond its end.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def floored(vectors: pa.ListArray, factor: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Which rows take part, the lengths of those, and their integer components one after the other."""
    sizes = pc.list_value_length(vectors)
    counts = sizes.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    parts = np.asarray(sizes.is_valid())
    x = np.asarray(vectors.flatten().to_numpy(zero_copy_only=False), np.float64)
    row = np.repeat(np.arange(len(counts)), counts)
    parts &= np.bincount(row[~np.isfinite(x)], minlength=len(counts)) == 0
    with np.errstate(over="ignore"):
        x = np.floor(x[parts[row]] * factor)
    if len(x) and np.abs(x).max() >= 2.0**62:
        raise ArithmeticError("a component is beyond 62 bits")
    return parts, counts[parts], x.astype(np.int64)


def packed_array(counts: np.ndarray, values: np.ndarray) -> pa.Array:
    """Components as one binary value for each row, in the narrowest integer type for all of them."""
    kind = next(t for t in (np.int8, np.int16, np.int32, np.int64) if not len(values) or (np.iinfo(t).min <= values.min() and values.max() <= np.iinfo(t).max))
    stops = np.r_[0, np.cumsum(counts)] * np.dtype(kind).itemsize
    data = pa.py_buffer(values.astype(kind).tobytes())
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(counts), [None, pa.py_buffer(stops.astype(np.int64)), data]).cast(pa.binary())


def matrix(dims: pa.Array, packed: pa.Array, width: int) -> np.ndarray:
    """Packed vectors as rows of ``width`` integers; what lies beyond is cut, what is missing is zero."""
    dims = dims.to_numpy(zero_copy_only=False)
    sizes = pc.binary_length(packed).to_numpy(zero_copy_only=False)
    out = np.zeros((len(dims), width), np.int64)
    for d, size in np.unique(np.stack([dims, sizes]), axis=1).T:
        if d:
            at = np.flatnonzero((dims == d) & (sizes == size))
            values = np.frombuffer(b"".join(packed.take(pa.array(at)).to_pylist()), f"i{size // d}").reshape(-1, d)
            out[at, : min(d, width)] = values[:, :width]
    return out


def integer_rows(vectors: DataFrame, factor: int, vector: Column, **carried: Column) -> DataFrame:
    """Rows whose vector takes part: a number of its own as ``row``, the carried columns, ``dims`` and ``packed``."""
    names = ["row", *carried, "dims", "packed"]
    rows = vectors.select(F.monotonically_increasing_id().alias("row"), *[c.alias(k) for k, c in carried.items()], vector.alias("vector"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts, counts, values = floored(batch.column(batch.num_columns - 1), factor)
            kept = batch.filter(pa.array(parts))
            columns = [*kept.columns[:-1], pa.array(counts, pa.int32()), packed_array(counts, values)]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    kinds = dict(rows.dtypes)
    return rows.mapInArrow(run, ", ".join(f"{k} {kinds[k]}" for k in ("row", *carried)) + ", dims int, packed binary")
