"""Vector code compression: product quantisation on integers, exact at every step.

1. Components become integers, ``floor(factor * x)``; a vector is cut into ``parts`` equal consecutive parts.
2. A part's codebook starts as that part of the ``entries`` first vectors (smallest id, nulls last; of equal ids the row with
   the smaller components first). Fewer vectors make fewer entries.
3. ``rounds`` times every part goes to its nearest entry and every entry becomes the floor of its parts' mean; unused entries
   stay. A task sums what it has read and sends one row for each component of an entry.
4. Parts are assigned once more; an index becomes two hex digits.

Dot products are float64 matrix products of limbs (``limbs``) that are narrow enough to stay below 2^53, put together again in
64-bit integers; of equal distances the first index counts. Distances must stay below 2^62, else the job fails.

Rows whose vector is null or holds null or non-finite components are dropped. Vectors are brought to one length, the longest
rounded up to a multiple of ``parts`` (at least one component a part), shorter ones with zeros. Repeated rows each count. Null
ids are kept, null labels are one label. An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arealis.llm.text import quoted, small_enough
from arealis.llm.vectors import integer_rows, matrix
from arealis.session import stored

PARTS, ENTRIES, ROUNDS, FACTOR = 16, 64, 2, 256
#: Vectors that are compared with a codebook at once.
ROWS = 4096


def limb_bits(width: int) -> int:
    """Bits of a limb: ``width`` products of two limbs add up to less than 2^53."""
    return (52 - max(width - 1, 0).bit_length()) // 2


def limbs(x: np.ndarray, bits: int) -> list[np.ndarray]:
    """Float64 arrays with ``x == sum(limb << (bits * k))``: low limbs hold ``bits`` bits, the last one the rest with the sign."""
    out = []
    while x.size and max(-int(x.min()), int(x.max())) >= 1 << bits:
        out.append((x & ((1 << bits) - 1)).astype(np.float64))
        x = x >> bits
    return [*out, x.astype(np.float64)]


def dots(a: np.ndarray, b: np.ndarray, bits: int | None = None) -> np.ndarray:
    """Inner products of the rows of two integer matrices, exact as long as they fit 64 bits."""
    bits = bits or limb_bits(a.shape[1])
    out = np.zeros((len(a), len(b)), np.int64)
    high = limbs(b, bits)
    for i, x in enumerate(limbs(a, bits)):
        for j, y in enumerate(high):
            if bits * (i + j) < 64:  # whole multiples of 2^64 do not change the sum
                out += (x @ y.T).astype(np.int64) << (bits * (i + j))
    return out


def nearest(parts: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First index with the least squared distance for each row of ``parts``, and that distance."""
    for x in (parts, entries):
        if x.size and 4 * x.shape[1] * max(-int(x.min()), int(x.max())) ** 2 >= 1 << 62:
            raise ArithmeticError("distances are beyond 62 bits")
    gap = (entries * entries).sum(axis=1) - 2 * dots(parts, entries)
    index = gap.argmin(axis=1)
    return index, (parts * parts).sum(axis=1) + gap[np.arange(len(parts)), index]


def assigned(batches: Iterable[pa.RecordBatch], codebooks: np.ndarray) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray, np.ndarray]]:
    """Runs of rows with their parts (row, part, component), indexes (row, part) and summed distances."""
    parts, _, width = codebooks.shape
    for batch in batches:
        for start in range(0, batch.num_rows, ROWS):
            rows = batch.slice(start, ROWS)
            x = matrix(rows.column("dims"), rows.column("packed"), parts * width).reshape(-1, parts, width)
            found = [nearest(x[:, p], codebooks[p]) for p in range(parts)]
            yield rows, x, np.stack([i for i, _ in found], axis=1), sum(e for _, e in found)


def first_codebooks(rows: DataFrame, parts: int, entries: int) -> np.ndarray:
    """(part, entry, component); at most ``entries`` vectors come to the driver."""
    longest = rows.agg(F.max("dims")).first()[0]
    width = max(1, -(-(longest or 0) // parts))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix(batch.column("dims"), batch.column("packed"), parts * width)
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(list(x), pa.list_(pa.int64()))], names=["vec_id", "x"])

    # all rows up to the last id that can count, ties by their components
    ids = rows.select("vec_id").filter("vec_id is not null").orderBy("vec_id").limit(entries)
    last = ids.agg(F.max("vec_id").alias("most"), F.count("*").alias("n")).first()
    wanted = F.lit(True) if last["n"] < entries else F.col("vec_id") <= F.lit(last["most"])
    wide = rows.filter(wanted).select("vec_id", "dims", "packed").mapInArrow(run, f"vec_id {dict(rows.dtypes)['vec_id']}, x array<bigint>")
    first = wide.orderBy(F.col("vec_id").asc_nulls_last(), "x").limit(entries).select("x").collect()
    x = np.array([r.x for r in first], np.int64).reshape(-1, parts, width)
    return np.ascontiguousarray(x.transpose(1, 0, 2))


def moved(rows: DataFrame, codebooks: np.ndarray) -> np.ndarray:
    """Codebooks after one round. ``parts * entries * width`` sums come to the driver, whatever the number of rows."""
    parts, entries, width = codebooks.shape

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = np.zeros((parts, entries), np.int64), np.zeros((parts, entries, width), np.int64)
        for _, x, index, _ in assigned(batches, codebooks):
            for p in range(parts):
                order = np.argsort(index[:, p], kind="stable")
                used, starts = np.unique(index[order, p], return_index=True)
                n[p] += np.bincount(index[:, p], minlength=entries)
                total[p, used] += np.add.reduceat(x[order, p], starts, axis=0)
        part, entry, place = np.nonzero(np.repeat(n[:, :, None] > 0, width, axis=2))
        arrays = [part.astype(np.int32), entry.astype(np.int32), place.astype(np.int32), n[part, entry], total[part, entry, place]]
        yield pa.RecordBatch.from_arrays([pa.array(a) for a in arrays], names=["part", "entry", "place", "n", "total"])

    sums = rows.select("dims", "packed").mapInArrow(run, "part int, entry int, place int, n long, total long")
    sums = sums.groupBy("part", "entry", "place").agg(F.sum("n").alias("n"), F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))
    out = codebooks.copy()
    for r in sums.collect():
        out[r.part, r.entry, r.place] = int(r.total) // r.n
    return out


def train(rows: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> np.ndarray:
    """Codebooks of stored integer rows."""
    codebooks = first_codebooks(rows, parts, entries)
    for _ in range(rounds if codebooks.size else 0):
        codebooks = moved(rows, codebooks)
    return codebooks


def encoded(rows: DataFrame, codebooks: np.ndarray) -> DataFrame:
    """Integer rows with ``code`` and ``error``, the sum of a vector's squared distances."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for found, _, index, error in assigned(batches, codebooks):
            text, size = index.astype(np.uint8).tobytes().hex(), 2 * index.shape[1]
            code = pa.array([text[k : k + size] for k in range(0, len(text), size)], pa.string())
            yield pa.RecordBatch.from_arrays([*found.columns[:-2], code, pa.array(error, pa.int64())], names=[*carried, "code", "error"])

    carried = rows.columns[:-2]
    if not codebooks.size:  # no rows
        return rows.select(*carried, F.lit("").alias("code"), F.lit(0).cast("long").alias("error"))
    kinds = dict(rows.dtypes)
    return rows.mapInArrow(run, ", ".join(f"{c} {kinds[c]}" for c in carried) + ", code string, error long")


def digest(codebooks: np.ndarray) -> str:
    """SHA-256 of all entries' components in decimal, by part, entry and place, joined by commas."""
    return hashlib.sha256(",".join(map(str, codebooks.ravel().tolist())).encode()).hexdigest()


def compressed(
    vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label",
    parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, factor: int = FACTOR,
) -> DataFrame:
    """One row per vector that takes part: vec_id, label, code, error, label_error (summed over the label), codebooks_sha256."""
    if not 0 < entries <= 256:
        raise ValueError("an index has two hex digits")
    rows = stored(integer_rows(vectors, factor, quoted(vector), vec_id=quoted(vec_id), label=quoted(label)), "codes-rows")
    codebooks = train(rows, parts, entries, rounds)
    found = stored(encoded(rows, codebooks).drop("row"), "codes-found")
    sums = stored(found.groupBy("label").agg(F.sum("error").alias("label_error")), "codes-labels").withColumnRenamed("label", "same")
    sums = F.broadcast(sums) if small_enough(sums) else sums
    return found.join(sums, F.col("label").eqNullSafe(F.col("same"))).select(
        "vec_id", "label", "code", "error", "label_error", F.lit(digest(codebooks)).alias("codebooks_sha256")
    )
