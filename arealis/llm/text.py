"""Helpers the text operators share: words, bounded slices of Arrow batches, table reading."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator
from functools import reduce
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: What separates words and is ignored between them; the same class in Python and Java regular expressions.
SPACE = r"[\x20\x09-\x0D]"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
#: Characters of text that are worked on at once inside a task.
SLICE_CHARS = 1_000_000
#: Largest number of short rows a broadcast may hold; a larger side is joined by shuffle.
BROADCAST_ROWS = 200_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def quoted(name: str) -> Column:
    """A column by its name, whatever characters the name has."""
    return F.col("`" + name.replace("`", "``") + "`")


def filled(text: str = "text") -> Column:
    """The text, null as empty."""
    return F.coalesce(quoted(text), F.lit(""))


def slices(batches: Iterable[pa.RecordBatch], text: str = "text") -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Arrow batches cut into runs of rows with about ``SLICE_CHARS`` characters, with their texts (null as empty)."""
    for batch in batches:
        column = batch.column(batch.schema.get_field_index(text))
        for start, end in cuts(pc.utf8_length(column).fill_null(0).to_pylist()):
            yield batch.slice(start, end - start), [t or "" for t in column.slice(start, end - start).to_pylist()]


def cuts(sizes: list[int]) -> Iterator[tuple[int, int]]:
    """Start and end of runs with about ``SLICE_CHARS`` characters, from the texts' numbers of characters."""
    start = size = 0
    for i, n in enumerate(sizes):
        size += n
        if size >= SLICE_CHARS or i == len(sizes) - 1:
            yield start, i + 1
            start, size = i + 1, 0


def scores_of(series: pd.Series, score: Callable[[list[str]], np.ndarray]) -> pd.Series:
    """Scores of a batch of texts (null as empty), run by run."""
    texts = [t if isinstance(t, str) else "" for t in series]
    return pd.Series(np.concatenate([np.zeros(0), *(score(texts[a:b]) for a, b in cuts([len(t) for t in texts]))]))


def word_lists(texts: list[str]) -> tuple[np.ndarray, list[str]]:
    """Number of words of each text, and all words one after the other."""
    words = [WORD.findall(t) for t in texts]
    return np.fromiter(map(len, words), np.int64, len(words)), list(chain.from_iterable(words))


def word_codes(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """An integer for each word, equal for equal words, and the distinct words by that integer."""
    values = np.empty(len(words), object)
    values[:] = words
    return pd.factorize(values)


def hashed(words: Iterable[str], seed: int = 0) -> np.ndarray:
    return np.fromiter((xxhash.xxh64_intdigest(w.encode("utf-8", "surrogatepass"), seed) for w in words), np.uint64)


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (two multiply and shift rounds)."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def heldout(doc_id: Column) -> Column:
    """Rows that no model learns from: crc32 of the id as text leaves no remainder by 5. A null id is never held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def small_enough(df: DataFrame, rows: int = BROADCAST_ROWS) -> bool:
    """Whether a stored table of short rows may be broadcast; reads no more than ``rows`` + 1 of its rows."""
    return df.limit(rows + 1).count() <= rows


def only_kept(docs: DataFrame, keys: dict[str, Column], verdicts: DataFrame) -> DataFrame:
    """The rows of ``docs`` that a stored table of verdicts keeps, with all their columns.

    ``keys`` are expressions over ``docs``; ``verdicts`` has their values under the same names, each once, with ``kept`` and
    the number ``n`` of rows. Of kept rows with equal keys one stays. Few columns of the dropped rows are joined, not texts.
    """
    rows = docs.select(F.struct(*[quoted(c) for c in docs.columns]).alias("whole"), *[c.alias(f"_{k}") for k, c in keys.items()])

    def matched(rows: DataFrame, found: DataFrame, how: str) -> DataFrame:
        found = found.select(*[F.col(k).alias(f"_v_{k}") for k in keys])
        same = [F.col(f"_{k}").eqNullSafe(F.col(f"_v_{k}")) for k in keys]
        return rows.join(F.broadcast(found) if small_enough(found) else found, reduce(Column.__and__, same), how)

    gone, twice = verdicts.filter("not kept"), verdicts.filter("kept and n > 1")
    left = matched(rows, gone, "left_anti")
    if not twice.isEmpty():
        by_key = matched(left, twice, "left_semi").groupBy(*[f"_{k}" for k in keys])
        once = by_key.agg(F.first("whole").alias("whole")).select("whole")
        left = matched(left, twice, "left_anti").select("whole").unionByName(once)
    return left.select("whole.*")
