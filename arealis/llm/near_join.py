"""Near-duplicate join: texts whose sets of five-word shingles have a Jaccard similarity of ``THRESHOLD`` or more.

1. Texts with the same words in the same order are one class (SHA-256 of the words); only its first row takes part in the join.
2. A class has ``BANDS * ROWS`` MinHash values. Classes that agree in a whole band share a bucket. Two texts at the threshold
   miss each other in all bands with a probability below 4e-7, more similar ones still less often.
3. In a bucket, pairs are compared in memory: a pair is looked at in the first band it shares only, its MinHash values are
   compared ``STEP`` at a time, and it is dropped as soon as the posterior probability (uniform prior, binomial matches)
   that its similarity reaches the threshold is below ``TOLERANCE``. No pair becomes a row: a member lists its partners.
4. Shingle sets are brought to the members that still have partners, and pairs are verified exactly until the members of a
   bucket are connected. Stars are merged into groups by alternating large and small stars over the whole table.
5. Links are counted inside the groups, exactly and for all pairs, as matrix products of shingle incidences.

Crowded buckets, of more than ``BLOCK`` members: a first block leads, other members are compared with its members only and verified
against the ``TRIED`` most similar, until one link is found. So a large group of near copies costs each member a fixed amount of
work. Members that are in another group than the most frequent one of their bucket are then compared with all members
of other groups, block by block; no pair that could join two groups is left out.

Counting links takes all pairs of a group, in blocks of ``BLOCK``; where the groups are enough (``without_near_duplicates``) it is left
out. Groups are connected by links; a group's id is its smallest document id.

A text of fewer than five words is one shingle; a null text counts as empty; texts without words are copies of each other
and have no links. Null ids come last; repeated rows are copies. An empty table gives an empty result. Columns other than id
and text are not read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arealis.llm.text import SPACE, filled, hashed, mixed, only_kept, quoted, slices, small_enough, word_codes, word_lists
from arealis.session import stored

SHINGLE = 5
THRESHOLD = 0.8
BANDS, ROWS = 28, 4
STEP = 16
TOLERANCE = 1e-6
BLOCK, TRIED = 512, 8
#: Shingles of one matrix product.
WIDTH = 4096
HASHES = BANDS * ROWS


def normalized(text: str) -> Column:
    """Words joined by one space."""
    return F.trim(F.regexp_replace(filled(text), f"{SPACE}+", " "))


def word_digest(text: str) -> Column:
    return F.unhex(F.sha2(normalized(text).cast("binary"), 256))


def shingles(texts: list[str], size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all shingles of the texts in order, with repetitions, and how many each text has."""
    sizes, words = word_lists(texts)
    if not words:
        return np.zeros(0, np.uint64), np.zeros(len(texts), np.int64)
    codes, distinct = word_codes(words)
    word = mixed(hashed(distinct))[codes]
    first = np.repeat(np.cumsum(sizes) - sizes, sizes)
    place = np.arange(len(word)) - first
    left = np.repeat(sizes, sizes) - place  # words from here to the end
    found = np.zeros(len(word), np.uint64)
    with np.errstate(over="ignore"):
        for k in range(size):
            following = np.zeros_like(word)
            following[: max(len(word) - k, 0)] = word[k:]
            following[left <= k] = 0  # past the end of a short text
            found = found * np.uint64(0x9E3779B97F4A7C15) + following
    starts = (left >= size) | (place == 0)
    counts = np.where(sizes >= size, sizes - size + 1, np.minimum(sizes, 1))
    return mixed(found[starts]), counts


@lru_cache(maxsize=1)
def _permutations() -> tuple[np.ndarray, np.ndarray]:
    draw = np.random.default_rng(20)
    return draw.integers(0, 2**32, HASHES, np.uint32), draw.integers(0, 2**31, HASHES, np.uint32) * np.uint32(2) + np.uint32(1)


def signatures(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """16 bits of each MinHash value, one row per text; rows of texts without shingles are 0."""
    out = np.zeros((len(counts), HASHES), np.uint16)
    has = np.flatnonzero(counts)
    if not len(has):
        return out
    starts = (np.cumsum(counts) - counts)[has]
    x = (hashes >> np.uint64(32)).astype(np.uint32)
    least = np.empty((HASHES, len(has)), np.uint32)
    for k, (flip, factor) in enumerate(zip(*_permutations(), strict=True)):
        least[k] = np.minimum.reduceat((x ^ flip) * factor, starts)
    out[has] = ((least * np.uint32(0x9E3779B1)) >> np.uint32(16)).astype(np.uint16).T
    return out


@lru_cache(maxsize=4)
def least_matches(threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> np.ndarray:
    """For each number of compared values the fewest matches with which a pair is still worth comparing on.

    With m matches of n and a uniform prior the similarity is Beta(m + 1, n - m + 1) distributed; its probability of
    reaching the threshold is the probability of at most m successes in n + 1 trials that succeed with the threshold.
    """
    out = np.zeros(HASHES + 1, np.int64)
    for n in range(1, HASHES + 1):
        pmf = [1.0 * (1 - threshold) ** (n + 1)]
        for m in range(n + 1):
            pmf.append(pmf[-1] * (n + 1 - m) / (m + 1) * threshold / (1 - threshold))
        out[n] = int(np.searchsorted(np.cumsum(pmf), tolerance))
    return out


def surviving_pairs(
    bands: np.ndarray, band: np.ndarray, group: np.ndarray, side: np.ndarray, apart: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Positions of the pairs of each group that stay after incremental comparison, and their matching values.

    ``bands``: 64 bits for each band and member; members of a group stand together; ``side``: 0 if all members of the group
    are to be compared with each other, else 1 or 2, and only members of different sides are compared; of members with equal
    values in ``apart`` no pair is.
    """
    values, floor = bands.view(np.uint16).reshape(len(bands), HASHES), least_matches()
    found = [(np.zeros(0, np.int64),) * 3]
    for distance in range(1, len(group)):
        together = group[distance:] == group[:-distance]
        if not together.any():
            break
        together &= (side[distance:] != side[:-distance]) | (side[distance:] == 0)
        if apart is not None:
            together &= apart[distance:] != apart[:-distance]
        at = np.flatnonzero(together)
        for part in np.array_split(at, len(at) // 50_000 + 1):
            a, b = part, part + distance
            equal = bands[a] == bands[b]
            shared = equal.argmax(axis=1)
            own = equal[np.arange(len(a)), shared] & (shared == band[a])
            a, b = a[own], b[own]
            matches = np.zeros(len(a), np.int64)
            for n in range(0, HASHES, STEP):
                matches += (values[a, n : n + STEP] == values[b, n : n + STEP]).sum(axis=1)
                stays = matches >= floor[n + STEP]
                a, b, matches = a[stays], b[stays], matches[stays]
            found.append((a, b, matches))
    a, b, matches = (np.concatenate(x) for x in zip(*found, strict=True))
    return a, b, matches


def most_similar(a: np.ndarray, b: np.ndarray, matches: np.ndarray, side: np.ndarray, tried: int = TRIED) -> np.ndarray:
    """Which pairs stay if each member of side 2 keeps its ``tried`` most similar partners; all pairs of side 0 stay."""
    member = np.where(side[a] == 2, a, b)
    order = np.lexsort((-matches, member))
    sorted_members = member[order]
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order)) - np.searchsorted(sorted_members, sorted_members)
    return (side[member] == 0) | (place < tried)


def whole_groups(batches: Iterable[pa.RecordBatch], keys: list[str], rows: int = 20_000) -> Iterator[pa.Table]:
    """Tables of whole groups from batches in which the rows of a group follow each other."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        if sum(b.num_rows for b in held) < rows:
            continue
        all_rows = pa.Table.from_batches(held)
        change = np.flatnonzero(_changes(all_rows, keys))
        if not len(change):
            continue
        yield all_rows.slice(0, int(change[-1]))
        held = all_rows.slice(int(change[-1])).combine_chunks().to_batches()
    if held:
        yield pa.Table.from_batches(held)


def _changes(rows: pa.Table, keys: list[str]) -> np.ndarray:
    """Whether a row begins a group (the first row is not counted)."""
    out = np.zeros(rows.num_rows, bool)
    for k in keys:
        v = rows.column(k).to_numpy()
        out[1:] |= v[1:] != v[:-1]
    return out


def _matrix(column: pa.ChunkedArray, width: int, kind: type) -> np.ndarray:
    flat = column.combine_chunks().flatten().to_numpy(zero_copy_only=False)
    return np.ascontiguousarray(flat.astype(kind, copy=False)).reshape(-1, width)


def _lists(at: np.ndarray, values: np.ndarray, n: int, kind: pa.DataType) -> pa.ListArray:
    """A list for each of n places from (place, value) pairs."""
    order = np.argsort(at, kind="stable")
    stops = np.r_[0, np.cumsum(np.bincount(at, minlength=n))]
    return pa.ListArray.from_arrays(pa.array(stops, pa.int32()), pa.array(values[order], kind))


def sketches(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: a number of its own, id, digest of its words, and its bands (none for a text without words)."""
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"), quoted(doc_id).alias("doc_id"),
        word_digest(text).alias("digest"), quoted(text).alias("text"),
    )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in slices(batches):
            hashes, counts = shingles(texts)
            bands = signatures(hashes, counts).view(np.int64)
            stops = np.r_[0, np.cumsum(np.where(counts > 0, BANDS, 0))]
            lists = pa.ListArray.from_arrays(pa.array(stops, pa.int32()), pa.array(bands[counts > 0].ravel(), pa.int64()))
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(3)), lists], names=["row", "doc_id", "digest", "bands"])

    return rows.mapInArrow(run, f"row long, doc_id {dict(rows.dtypes)['doc_id']}, digest binary, bands array<bigint>")


def banded_members(classes: DataFrame) -> DataFrame:
    """Members of buckets with two classes or more: band, value, node, members."""
    banded = classes.select("node", F.posexplode("bands").alias("band", "value"))
    counts = banded.groupBy("band", "value").agg(F.count("*").alias("members")).filter("members > 1")
    return banded.join(counts, ["band", "value"])


def block_of(node: Column, blocks: Column) -> Column:
    return F.pmod(F.xxhash64(node), blocks).cast("int")


def _cell(i: Column, j: Column, side: Column) -> Column:
    return F.struct(i.alias("i"), j.alias("j"), side.alias("side"))


def bucket_members(classes: DataFrame, block: int = BLOCK) -> DataFrame:
    """The cells that the members of all buckets are compared in first."""
    return first_cells(banded_members(classes), block)


def first_cells(members: DataFrame, block: int = BLOCK) -> DataFrame:
    """Cells of all buckets: band, value, i, j, side, node. A crowded bucket's first block meets itself and each other block once.

    A member has one row, one of a first block as many as there are blocks, so about two rows a member at any size.
    """
    blocks = F.ceil(F.col("members") / F.lit(block)).cast("int")
    own = members.select("band", "value", "node", blocks.alias("blocks")).withColumn("own", block_of(F.col("node"), F.col("blocks")))
    first = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda o: _cell(F.lit(0), o, F.when(o == 0, 0).otherwise(1)))
    cells = F.when(F.col("own") == 0, first).otherwise(F.array(_cell(F.lit(0), F.col("own"), F.lit(2))))
    return own.select("band", "value", "node", F.explode(cells).alias("cell")).select("band", "value", "cell.*", "node")


def divided_members(members: DataFrame, groups: DataFrame, block: int = BLOCK) -> DataFrame:
    """Cells of the crowded buckets whose members are in several groups: band, value, i, j, side, node, root.

    Members outside the bucket's most frequent group, in blocks, meet each other and all blocks of that group.
    """
    crowded = members.filter(F.col("members") > block).select("band", "value", "node")
    rooted = crowded.join(groups, "node", "left").withColumn("root", F.coalesce("root", "node"))
    sizes = rooted.groupBy("band", "value", "root").agg(F.count("*").alias("n"))
    main = F.max(F.struct("n", F.col("root").alias("main"))).alias("most")
    buckets = sizes.groupBy("band", "value").agg(main, F.sum("n").alias("all")).filter("all > most.n")
    counts = {"others": F.col("all") - F.col("most.n"), "mains": F.col("most.n")}
    blocks = {k: F.ceil(n / F.lit(block)).cast("int") for k, n in counts.items()}
    buckets = buckets.select("band", "value", F.col("most.main").alias("main"), *[n.alias(k) for k, n in blocks.items()])
    placed = rooted.join(buckets, ["band", "value"]).withColumn("is_main", F.col("root") == F.col("main"))
    placed = placed.withColumn("own", block_of(F.col("node"), F.when(F.col("is_main"), F.col("mains")).otherwise(F.col("others"))))
    among = F.transform(F.sequence(F.lit(0), F.col("others") - 1), lambda o: _cell(
        F.least(o, F.col("own")), F.greatest(o, F.col("own")), F.when(o == F.col("own"), 0).when(o > F.col("own"), 1).otherwise(2)
    ))
    across = F.transform(F.sequence(F.lit(0), F.col("mains") - 1), lambda d: _cell(F.col("own"), F.col("others") + d, F.lit(1)))
    of_main = F.transform(F.sequence(F.lit(0), F.col("others") - 1), lambda o: _cell(o, F.col("others") + F.col("own"), F.lit(2)))
    cells = F.when(F.col("is_main"), of_main).otherwise(F.concat(among, across))
    return placed.select("band", "value", "node", "root", F.explode(cells).alias("cell")).select("band", "value", "cell.*", "node", "root")


CELL = ["band", "value", "i", "j"]


def candidate_members(members: DataFrame, classes: DataFrame, tried: int | None = TRIED) -> DataFrame:
    """Members with a surviving partner in their cell: the cell, side, node, and the partners listed at the earlier of a pair.

    Where ``members`` has a ``root``, members of one root are no partners. ``tried`` bounds the partners of a member of side 2.
    """
    rooted = ["root"] if "root" in members.columns else []
    rows = members.join(classes.select("node", "bands"), "node").select(*CELL, "side", "node", "bands", *rooted)
    rows = rows.repartition(*CELL).sortWithinPartitions(*CELL, "node")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in whole_groups(batches, CELL):
            node, side = t.column("node").to_numpy(), t.column("side").to_numpy()
            bands = _matrix(t.column("bands"), BANDS, np.int64).view(np.uint64)
            group = np.cumsum(_changes(t, CELL))
            apart = t.column("root").to_numpy() if rooted else None
            a, b, matches = surviving_pairs(bands, t.column("band").to_numpy(), group, side, apart)
            if tried:
                stays = most_similar(a, b, matches, side, tried)
                a, b = a[stays], b[stays]
            used = np.unique(np.r_[a, b])
            partners = _lists(np.searchsorted(used, a), node[b], len(used), pa.int64())
            kept = t.select([*CELL, "side", "node"]).take(pa.array(used)).append_column("partners", partners)
            yield from kept.combine_chunks().to_batches()

    return rows.mapInArrow(run, "band int, value long, i int, j int, side int, node long, partners array<bigint>")


def shingle_sets(docs: DataFrame, nodes: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The shingle set of each wanted class (node, doc_id, digest): sorted 64-bit hashes."""
    rows = docs.select(quoted(doc_id).alias("doc_id"), word_digest(text).alias("digest"), quoted(text).alias("text"))
    n = nodes.select("node", F.col("doc_id").alias("n_id"), F.col("digest").alias("n_digest"))
    n = F.broadcast(n) if small_enough(n) else n
    same = (F.col("digest") == F.col("n_digest")) & F.col("doc_id").eqNullSafe(F.col("n_id"))
    rows = rows.join(n, same).select("node", "text")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in slices(batches):
            hashes, counts = shingles(texts)
            stops = np.cumsum(counts)
            sets = [np.unique(hashes[b - c : b]).tobytes() for b, c in zip(stops, counts, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.binary())], names=["node", "shingles"])

    # repeated rows of a class's first document have the same set
    return rows.mapInArrow(run, "node long, shingles binary").groupBy("node").agg(F.first("shingles").alias("shingles"))


def _similarity(a: np.ndarray, b: np.ndarray) -> float:
    both = np.intersect1d(a, b, assume_unique=True).size
    return both / (a.size + b.size - both)


def star_edges(candidates: DataFrame, sets: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Stars (a, b), b the smallest member, of what exact links connect in each cell. Pairs connected already are not verified.

    A member of side 2 has a side 1 whose links are found elsewhere: its first link is enough.
    """
    rows = candidates.join(sets, "node").select(*CELL, "side", "node", "partners", "shingles")
    rows = rows.repartition(*CELL).sortWithinPartitions(*CELL, "node")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in whole_groups(batches, CELL, rows=2_000):
            node, group, side = t.column("node").to_numpy(), np.cumsum(_changes(t, CELL)), t.column("side").to_numpy()
            partners = t.column("partners").to_pylist()
            sets_ = [np.frombuffer(x.as_buffer(), np.uint64) for x in t.column("shingles")]
            place = {(g, v): k for k, (g, v) in enumerate(zip(group.tolist(), node.tolist(), strict=True))}
            root, linked = list(range(len(node))), np.zeros(len(node), bool)

            def top(k: int, root: list[int] = root) -> int:
                while root[k] != k:
                    root[k] = root[root[k]]
                    k = root[k]
                return k

            for k, listed in enumerate(partners):
                for v in listed:
                    other = place[group[k], v]
                    member = k if side[k] == 2 else other
                    if side[member] == 2 and linked[member]:
                        continue
                    x, y = top(k), top(other)
                    if x != y and _similarity(sets_[k], sets_[other]) >= threshold - 1e-12:
                        linked[member] = True
                        root[max(x, y)] = min(x, y)  # the earlier of a group is the smaller node
            tops = np.fromiter(map(top, range(len(node))), np.int64, len(node))
            stars = np.flatnonzero(tops != np.arange(len(node)))
            yield pa.RecordBatch.from_arrays([pa.array(node[stars]), pa.array(node[tops[stars]])], names=["a", "b"])

    return rows.mapInArrow(run, "a long, b long")


def link_counts(groups: DataFrame, sets: DataFrame, threshold: float = THRESHOLD, block: int = BLOCK) -> DataFrame:
    """node, n_links: links to other nodes of its group (node, root), every pair looked at once, in cells of two blocks."""
    blocks = F.ceil(F.col("n") / F.lit(block)).cast("int")
    sizes = groups.groupBy("root").agg(F.count("*").alias("n")).filter("n > 1").select("root", blocks.alias("blocks"))
    own = groups.join(sizes, "root").withColumn("own", block_of(F.col("node"), F.col("blocks")))
    cells = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda o: _cell(
        F.least(o, F.col("own")), F.greatest(o, F.col("own")), F.when(o == F.col("own"), 0).when(o > F.col("own"), 1).otherwise(2)
    ))
    members = own.select("root", "node", F.explode(cells).alias("cell")).select("root", "cell.*", "node")
    keys = ["root", "i", "j"]
    rows = members.join(sets, "node").select(*keys, "side", "node", "shingles").repartition(*keys).sortWithinPartitions(*keys, "node")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in whole_groups(batches, keys, rows=2_000):
            sets_ = [np.frombuffer(x.as_buffer(), np.uint64) for x in t.column("shingles")]
            side, edges = t.column("side").to_numpy(), np.flatnonzero(_changes(t, keys))
            counts = [links_within(sets_[a:b], side[a:b], threshold) for a, b in zip(np.r_[0, edges], np.r_[edges, len(side)], strict=True)]
            yield pa.RecordBatch.from_arrays([t.column("node").combine_chunks(), pa.array(np.concatenate(counts))], names=["node", "n"])

    return rows.mapInArrow(run, "node long, n long").groupBy("node").agg(F.sum("n").alias("n_links"))


def links_within(sets: list[np.ndarray], side: np.ndarray, threshold: float) -> np.ndarray:
    """Links of each set: with all others where the side is 0, else with those of the other side."""
    left = np.flatnonzero(side != 2)
    right = np.flatnonzero(side != 1) if (side == 0).any() else np.flatnonzero(side == 2)
    sizes = np.fromiter(map(len, sets), np.int64, len(sets))
    _, codes, uses = np.unique(np.concatenate([np.zeros(0, np.uint64), *sets]), return_inverse=True, return_counts=True)
    shared = np.cumsum(uses > 1) - 1  # shingles of one set only meet no other
    row = np.repeat(np.arange(len(sets)), sizes)[uses[codes] > 1]
    codes = shared[codes[uses[codes] > 1]]
    order = np.argsort(codes, kind="stable")
    row, codes = row[order], codes[order]
    both = np.zeros((len(left), len(right)), np.float32)
    for start in range(0, int(codes[-1]) + 1 if len(codes) else 0, WIDTH):
        a, b = np.searchsorted(codes, (start, start + WIDTH))
        holds = np.zeros((len(sets), WIDTH), np.float32)
        holds[row[a:b], codes[a:b] - start] = 1
        both += holds[left] @ holds[right].T
    linked = both >= (threshold - 1e-12) * (sizes[left][:, None] + sizes[right] - both.astype(np.float64))
    linked[left[:, None] == right] = False
    out = np.zeros(len(sets), np.int64)
    out[left] += linked.sum(axis=1)
    if (side != 0).any():
        out[right] += linked.sum(axis=0)
    return out


def connected(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """Groups of nodes joined by edges (a, b): node, smallest node of its group; nodes without edges are left out.

    Alternating star contraction: every node links its larger neighbours, then its smaller ones, to the smallest
    it knows, until nothing changes. Each round is stored, so a lost executor costs a round at most.
    """
    pairs = stored(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a > b").distinct(), "near-star")

    def state(p: DataFrame) -> tuple:
        return tuple(p.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())

    seen = state(pairs)
    for _ in range(rounds):
        if not seen[0]:
            break
        both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("least")).withColumn("least", F.least("least", "a"))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("least").alias("b"))
        large = large.unionByName(least.select("a", F.col("least").alias("b"))).filter("a > b").distinct()
        large = stored(large, "near-star")
        least = large.groupBy("a").agg(F.min("b").alias("least"))
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b")).filter("a > b")
        pairs = stored(small.unionByName(least.select("a", F.col("least").alias("b"))).distinct(), "near-star")
        now = state(pairs)
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError("star contraction has not ended")
    return pairs.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        pairs.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )


def near_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: float = THRESHOLD, block: int = BLOCK, count_links: bool = True
) -> DataFrame:
    """One row per row of ``docs``: doc_id, class_id (of its group), copy_id (of texts with the same words), n_copies,
    n_links (classes of other texts linked to its class; left out unless ``count_links``), kept (the first row of the group), digest."""
    rows = stored(sketches(docs, doc_id, text), "near-rows")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "row")).alias("first")
    classes = rows.groupBy("digest").agg(first, F.first("bands").alias("bands"), F.count("*").alias("n_copies"))
    classes = stored(classes.select("digest", F.col("first.row").alias("node"), F.col("first.doc_id").alias("doc_id"), "bands", "n_copies"), "near-classes")

    def sets_of(nodes: DataFrame) -> DataFrame:
        wanted = classes.join(nodes.select("node").distinct(), "node").select("node", "doc_id", "digest")
        return stored(shingle_sets(docs, stored(wanted, "near-wanted"), doc_id, text), "near-sets")

    members = stored(banded_members(classes), "near-members")
    candidates = stored(candidate_members(first_cells(members, block), classes), "near-candidates")
    sets = sets_of(candidates)
    edges = stored(star_edges(candidates, sets, threshold), "near-edges")
    groups = connected(edges)
    if not members.filter(F.col("members") > block).isEmpty():
        divided = candidate_members(divided_members(members, groups, block), classes, tried=None)
        divided = stored(divided, "near-candidates")
        if not divided.isEmpty():
            more = sets_of(divided.join(sets, "node", "left_anti"))
            sets = sets.unionByName(more)
            # every link counts here: a group may hang on any of them
            found = stored(star_edges(divided.withColumn("side", F.lit(0)), sets, threshold), "near-edges")
            if not found.isEmpty():
                groups = connected(groups.select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(found))
    groups = stored(groups, "near-roots")
    grouped = classes.select("digest", "node", F.col("doc_id").alias("copy_id"), "n_copies").join(groups, "node", "left")
    counted = []
    if count_links:
        grouped = grouped.join(link_counts(groups, sets, threshold, block), "node", "left")
        counted = [F.coalesce("n_links", F.lit(0)).alias("n_links")]
    grouped = grouped.withColumn("root", F.coalesce("root", "node"))
    best = F.min(F.struct(F.col("copy_id").isNull().alias("last"), "copy_id", "node")).alias("best")
    named = grouped.groupBy("root").agg(best).select("root", F.col("best.copy_id").alias("class_id"), F.col("best.node").alias("keep_row"))
    grouped = grouped.join(named, "root").select("digest", "copy_id", "n_copies", *counted, "class_id", "keep_row")
    links = ["n_links"] if count_links else []
    return rows.select("row", "doc_id", "digest").join(stored(grouped, "near-groups"), "digest").select(
        "doc_id", "class_id", "copy_id", "n_copies", *links, (F.col("row") == F.col("keep_row")).alias("kept"), "digest"
    )


def without_near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, one of each group, with all their columns."""
    found = near_duplicates(docs, doc_id, text, count_links=False)
    per_key = found.groupBy("doc_id", "digest").agg(F.max("kept").alias("kept"), F.count("*").alias("n"))
    keys = {"doc_id": quoted(doc_id), "digest": word_digest(text)}
    return only_kept(docs, keys, stored(per_key, "near-keys"))
