"""Exact top-k search by inner product: MaxScore over shards.

A dimension is a term, a component its weight. In a shard candidates come in blocks; a block bounds what a term can add to a
query's score (from the largest and the smallest weight of the term's postings, zero for a vector without it).

1. A query's terms are put in the order of their bounds. Those at the end whose bounds together reach at most ``SHARE`` of the
   query's threshold (its k-th best score so far) are non-essential: by them alone no candidate gets in.
2. The postings of the essential terms are traversed, for many queries at once, as one matrix product.
3. Other terms are probed in the order of their bounds, for candidates that are still competitive: score so far plus bounds
   of what is left reaches the threshold. What remains is exact, and the k best are kept.
4. The k best of each shard are merged.

A task holds one group of at most ``GROUP`` queries and streams the candidates of one shard past them. Scores are exact: the type
of a block is float32, float64 or int64, whichever holds every sum; beyond 62 bits the job fails.

Rows whose vector is null or holds null or non-finite components take no part. A short vector counts as zero beyond its
end, so an empty one scores 0 with all. A query's own row is no candidate, other rows of its id are. A null id is no query;
as a candidate it comes last among ties. Of repeated query rows each gets its own result. With fewer than k candidates all are
returned. An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from arealis.llm.text import quoted
from arealis.llm.vectors import integer_rows, matrix
from arealis.session import stored

K, EVERY, FACTOR = 20, 20, 64
#: Queries of a task, and candidates of a shard at most; a shard is streamed, queries are held.
GROUP, SHARD = 16_384, 262_144
#: Candidates of a shard at least, where there would be fewer shards than tasks.
LEAST = 2048
#: Queries and candidates of one matrix product.
QUERIES, BLOCK = 1024, 4096
#: What non-essential terms may reach of the threshold, and terms probed between two tests.
SHARE, STEP = 0.5, 4


def kind_for(queries: np.ndarray, candidates: np.ndarray) -> type:
    """The fastest type that holds every partial sum and bound exactly."""
    most = [max(-int(x.min()), int(x.max())) if x.size else 0 for x in (queries, candidates)]
    limit = 2 * queries.shape[1] * most[0] * most[1]
    if limit >= 1 << 62:
        raise ArithmeticError("scores are beyond 62 bits")
    return np.float32 if limit < 1 << 24 else np.float64 if limit < 1 << 53 else np.int64


def competitive(queries: np.ndarray, candidates: np.ndarray, threshold: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, candidate, score) of all pairs that reach their query's threshold, and perhaps some more where it is unknown.

    ``threshold`` holds the least 64-bit integer where fewer than k candidates are known: there a pair stays if k + 1 others of the block do not beat it.
    """
    kind, width = kind_for(queries, candidates), queries.shape[1]
    known = threshold > np.iinfo(np.int64).min
    # bounds stay below 2^61, so a threshold beyond that says no more than 2^61 does
    floor = np.where(known, threshold, -(1 << 61)).astype(kind if kind is np.int64 else np.float64)
    q, x = queries.astype(kind), candidates.astype(kind)
    bound = np.maximum(np.maximum(q * x.max(axis=0), q * x.min(axis=0)), 0)
    order = np.argsort(-bound, axis=1, kind="stable")
    rest = np.zeros((len(q), width + 1), kind)
    rest[:, :width] = np.cumsum(np.take_along_axis(bound, order, 1)[:, ::-1], axis=1)[:, ::-1]
    essential = (rest[:, :width] > SHARE * floor[:, None]).sum(axis=1)
    rank = np.empty_like(order)
    np.put_along_axis(rank, order, np.broadcast_to(np.arange(width), order.shape), 1)
    score = np.where(rank < essential[:, None], q, 0) @ x.T
    if not known.all() and len(x) > k + 1:  # all their terms are essential: scores are exact
        fresh = np.flatnonzero(~known)
        floor[fresh] = np.maximum(floor[fresh], np.partition(score[fresh], len(x) - k - 1, axis=1)[:, len(x) - k - 1])
    needed = floor - rest[np.arange(len(q)), essential]
    qi, ci = np.nonzero(score >= needed[:, None])
    found = score[qi, ci]
    # one more term that is zero stands for those past a query's last
    order = np.c_[order, np.full(len(q), width)]
    q, x = (np.c_[m, np.zeros(len(m), kind)] for m in (q, x))
    for start in range(0, width - int(essential.min(initial=width)), STEP):
        at = essential[qi] + start
        for j in range(STEP):
            term = order[qi, np.minimum(at + j, width)]
            found = found + q[qi, term] * x[ci, term]
        stays = found + rest[qi, np.minimum(at + STEP, width)] >= floor[qi]
        qi, ci, found = qi[stays], ci[stays], found[stays]
    return qi, ci, found.astype(np.int64)


class Best:
    """The k best candidates so far for some queries."""

    def __init__(self, rows: np.ndarray, vectors: np.ndarray, k: int) -> None:
        self.rows, self.vectors, self.k = rows, vectors, k
        self.query, self.score, self.ids = (np.zeros(0, np.int64) for _ in range(3))
        self.unnamed = np.zeros(0, bool)  # whether the id is null
        self.threshold = np.full(len(rows), np.iinfo(np.int64).min)

    def add(self, rows: np.ndarray, ids: np.ndarray, unnamed: np.ndarray, vectors: np.ndarray) -> None:
        qi, ci, score = competitive(self.vectors, vectors, self.threshold, self.k)
        other = self.rows[qi] != rows[ci]
        qi, ci, score = qi[other], ci[other], score[other]
        if not len(qi):
            return
        query, score = np.r_[self.query, qi], np.r_[self.score, score]
        ids, unnamed = np.r_[self.ids, ids[ci]], np.r_[self.unnamed, unnamed[ci]]
        order = np.lexsort((ids, unnamed, -score, query))
        query = query[order]
        place = np.arange(len(query)) - np.searchsorted(query, query)
        kept = order[place < self.k]
        last = order[place == self.k - 1]
        self.query, self.score, self.ids, self.unnamed = query[place < self.k], score[kept], ids[kept], unnamed[kept]
        self.threshold[query[place == self.k - 1]] = score[last]


def streamed(batches: Iterable[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """Rows (cell, is_query, row, vec_id, dims, packed) sorted by cell, queries first -> the k best of a cell."""
    cell, held, bests = None, [], []

    def results() -> Iterator[pa.RecordBatch]:
        for best, ids in bests:
            names = ["q_row", "query_id", "vec_id", "score"]
            vec_ids = pa.array(best.ids, mask=best.unnamed)
            yield pa.RecordBatch.from_arrays([pa.array(best.rows[best.query]), pa.array(ids[best.query]), vec_ids, pa.array(best.score)], names=names)

    for batch in batches:
        if not batch.num_rows:
            continue
        cells, asks = batch.column("cell").to_numpy(), batch.column("is_query").to_numpy(zero_copy_only=False)
        edges = np.flatnonzero((cells[1:] != cells[:-1]) | (asks[1:] != asks[:-1])) + 1
        for start, end in zip(np.r_[0, edges], np.r_[edges, len(cells)], strict=True):
            if cells[start] != cell:
                yield from results()
                cell, held, bests = cells[start], [], []
            run = batch.slice(start, end - start)
            if asks[start]:
                held.append(run)
                continue
            if held:
                all_queries, held = pa.Table.from_batches(held).combine_chunks(), []
                for at in range(0, all_queries.num_rows, QUERIES):
                    q = all_queries.slice(at, QUERIES).combine_chunks().to_batches()[0]
                    width = int(q.column("dims").to_numpy().max())
                    bests.append((Best(q.column("row").to_numpy(), matrix(q.column("dims"), q.column("packed"), width), k), q.column("vec_id").to_numpy()))
            for at in range(0, run.num_rows, BLOCK):
                c = run.slice(at, BLOCK)
                width = max((b.vectors.shape[1] for b, _ in bests), default=0)
                x = matrix(c.column("dims"), c.column("packed"), width)
                ids, unnamed = c.column("vec_id").fill_null(0).to_numpy(), np.asarray(c.column("vec_id").is_null())
                for best, _ in bests:
                    best.add(c.column("row").to_numpy(), ids, unnamed, x[:, : best.vectors.shape[1]])
    yield from results()


def search(rows: DataFrame, is_query: Column, k: int = K, group: int = GROUP, shard: int = SHARD) -> DataFrame:
    """The k best rows for each query row among stored integer rows: query_id, rank, vec_id, score.

    Queries go to every shard, candidates to every group of queries, so what is shuffled is ``rows * queries * (1 / group + 1 / shard)``.
    """
    rows = rows.select("row", F.col("vec_id").cast("long").alias("vec_id"), "dims", "packed")
    queries = rows.filter(is_query)
    counts = rows.agg(F.count("*").alias("n"), F.count(F.when(is_query, 1)).alias("q")).first()
    tasks = 2 * rows.sparkSession.sparkContext.defaultParallelism
    shards = max(math.ceil(counts["n"] / shard), min(tasks, math.ceil(counts["n"] / LEAST)), 1)
    groups = max(math.ceil(counts["q"] / group), 1)

    def dealt(df: DataFrame, own: Column, others: int, cell: Column, asks: bool) -> DataFrame:
        every = F.explode(F.sequence(F.lit(0), F.lit(others - 1)))
        spread = df.withColumn("own", own).withColumn("other", every)
        return spread.select(cell.cast("int").alias("cell"), F.lit(asks).alias("is_query"), "row", "vec_id", "dims", "packed")

    of_query = F.pmod(F.xxhash64("row", F.lit("group")), F.lit(groups))
    of_row = F.pmod(F.xxhash64("row", F.lit("shard")), F.lit(shards))
    asked = dealt(queries, of_query, shards, F.col("own") * shards + F.col("other"), True)
    offered = dealt(rows, of_row, groups, F.col("other") * shards + F.col("own"), False)
    cells = asked.unionByName(offered).repartition(shards * groups, "cell").sortWithinPartitions("cell", F.desc("is_query"))
    best = cells.mapInArrow(lambda batches: streamed(batches, k), "q_row long, query_id long, vec_id long, score long")
    place = F.row_number().over(Window.partitionBy("q_row").orderBy(F.desc("score"), F.col("vec_id").asc_nulls_last()))
    return best.withColumn("rank", place).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def top_k(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", every: int = EVERY, k: int = K, factor: int = FACTOR) -> DataFrame:
    """The k highest inner products of ``floor(factor * x)`` for every row whose id is divisible by ``every``."""
    rows = stored(integer_rows(vectors, factor, quoted(vector), vec_id=quoted(vec_id)), "topk-rows")
    return search(rows, F.coalesce(F.col("vec_id") % every == 0, F.lit(False)), k)
