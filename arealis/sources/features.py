"""Features of GeoJSON collections of any size: many tasks parse one file.

A file is read as text records that end at a closing brace, so the reader cuts it by bytes like any text. Whether a brace stands
inside a string, and how deep, follows from what comes before it; two reads tell:

1. Each block of a file is summarised for both cases, that it begins inside a string or outside: whether its end is inside,
   by how much the depth changes, and the least depth on the way. The summaries of a file's blocks, in order, give the state in
   which each block really begins, and in which block the object open there has begun.
2. With that state each block yields the texts of the objects that stand directly in the collection. One that
   lies in one block is whole; the pieces of one that runs over a border are put together by the block it began in.

Objects whose ``type`` is ``Feature`` are the features; other members of a collection, such as a reference system, are not.
A file with one feature per line is no collection; see ``geojson.read_features(lines=True)``.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A string, the start of one that does not end here, or an opening brace.
TOKEN = re.compile(r'"(?:[^"\\]|\\.)*+"|"|\{', re.DOTALL)
#: The rest of a string and its closing quote.
REST = re.compile(r'(?:[^"\\]|\\.)*+"', re.DOTALL)

SUMMARY = "path string, start long, inside boolean, ends_inside boolean, change long, least long"


def steps(record: str, inside: bool) -> tuple[list[int], bool]:
    """Places of the braces that open objects in a record, and whether the brace that ends it is inside a string."""
    at, opened = 0, []
    if inside:
        m = REST.match(record)
        if m is None:
            return opened, True
        at = m.end()
    for m in TOKEN.finditer(record, at):
        if m.group() == "{":
            opened.append(m.start())
        elif m.group() == '"':
            return opened, True
    return opened, False


def records(spark: SparkSession, path: str) -> DataFrame:
    """path, start of the block, text up to the next closing brace; the rows of a block follow each other."""
    text = spark.read.option("lineSep", "}").option("recursiveFileLookup", "true").text(path)
    return text.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start"), "value")


def _blocks(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[str, int, str]]:
    for batch in batches:
        yield from zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True)


def summaries(rows: DataFrame) -> DataFrame:
    """Two rows per block (``SUMMARY``): what it does to the depth if it begins inside a string, or outside."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, state = None, []

        def done() -> Iterator[pa.RecordBatch]:
            if block is not None:
                arrays = [[block[0]] * 2, [block[1]] * 2, [False, True], *([s[k] for s in state] for k in range(3))]
                kinds = [pa.string(), pa.int64(), pa.bool_(), pa.bool_(), pa.int64(), pa.int64()]
                names = ["path", "start", "inside", "ends_inside", "change", "least"]
                yield pa.RecordBatch.from_arrays([pa.array(a, k) for a, k in zip(arrays, kinds, strict=True)], names=names)

        for path, start, record in _blocks(batches):
            if (path, start) != block:
                yield from done()
                block, state = (path, start), [[False, 0, 0], [True, 0, 0]]
            for s in state:
                opened, s[0] = steps(record, s[0])
                s[1] += len(opened)
                if not s[0]:
                    s[1] -= 1
                    s[2] = min(s[2], s[1])
        yield from done()

    return rows.mapInArrow(run, SUMMARY)


def beginnings(found: DataFrame) -> dict[tuple[str, int], tuple[bool, int, int]]:
    """For each block whether it begins inside a string, its depth, and the start of the block its open object began in.

    Two short rows per block of a file come to the driver, which lists the files' blocks anyway.
    """
    by: dict[tuple[str, int], dict[bool, tuple]] = {}
    for r in found.collect():
        by.setdefault((r.path, r.start), {})[r.inside] = (r.ends_inside, r.change, r.least)
    out, path = {}, None
    for key in sorted(by):
        if key[0] != path:
            path, inside, depth, began = key[0], False, 0, -1
        out[key] = (inside, depth, began)
        ends_inside, change, least = by[key][inside]
        if depth + least <= 1:
            began = key[1]
        inside, depth = ends_inside, depth + change
    return out


def objects(rows: DataFrame, begin: dict[tuple[str, int], tuple[bool, int, int]]) -> DataFrame:
    """path, began (start of the block an object begins in), start, whole, value: texts of the collection's objects, or pieces of them."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        block, began, pieces = None, -1, []

        def flushed() -> pa.RecordBatch:
            kinds = [pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.string()]
            arrays = [pa.array([r[k] for r in out], kind) for k, kind in enumerate(kinds)]
            out.clear()
            return pa.RecordBatch.from_arrays(arrays, names=["path", "began", "start", "whole", "value"])

        def piece() -> None:
            """What is open when a block ends."""
            if pieces:
                out.append((*block[:1], began, block[1], False, "".join(pieces)))

        for path, start, record in _blocks(batches):
            if (path, start) != block:
                piece()
                block, (inside, depth, began), pieces = (path, start), begin[path, start], []
                open_ = depth >= 2
            opened, inside = steps(record, inside)
            at = 0
            for place in opened:
                depth += 1
                if depth == 2:  # the record's first object of this depth; it cannot have another
                    open_, began, at, pieces = True, start, place, []
            if open_:
                pieces.append(record[at:] + "}")
            if not inside:
                depth -= 1
                if open_ and depth == 1:
                    out.append((path, began, start, began == start, "".join(pieces)))
                    open_, pieces = False, []
            if len(out) >= 1000:
                yield flushed()
        piece()
        yield flushed()

    return rows.mapInArrow(run, "path string, began long, start long, whole boolean, value string")


def feature_texts(spark: SparkSession, path: str) -> DataFrame:
    """One row per object of the collections below ``path``, as text in ``value``."""
    rows = records(spark, path)
    found = objects(rows, beginnings(summaries(rows)))
    whole = found.where("whole").select("value")
    # one piece per block border at most
    order = F.sort_array(F.collect_list(F.struct("start", "value")))
    parts = found.where("not whole").groupBy("path", "began").agg(order.alias("p"))
    return whole.unionByName(parts.select(F.array_join(F.transform("p", lambda p: p["value"]), "").alias("value")))
