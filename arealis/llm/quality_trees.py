"""Quality: histogram gradient-boosted trees over statistics of a document, traversed as flat arrays.

Each text gives ``STATISTICS``. Their values are put into at most ``BINS`` bins by quantiles of the training rows; a tree
is grown level by level from histograms of gradients and curvatures per node, statistic and bin, and is kept as three
arrays (statistic, threshold, value) of a complete binary tree: children of node i are 2 i + 1 and 2 i + 2. All texts of
a slice walk down a tree together, one array step per level.

Training rows are at most ``SAMPLE`` labelled ids, those with the smallest hashes, never a held-out one; the bound holds
for any size of the tables, so the matrix of statistics is small wherever it is. Scoring reads every whole text.

A null text counts as empty and has statistics of its own (all 0); an empty table gives an empty result. Null labels are
no labels, an id labelled twice counts as good only if all its labels say so, of repeated ids the text with the smallest
SHA-256 is learnt from. Without any training row every score is 0.5. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arealis.llm.text import filled, heldout, mixed, scores_of, slices, word_codes, word_lists
from arealis.session import stored

SAMPLE = 12_000
BINS, TREES, DEPTH = 48, 60, 4
RATE, MIN_CURVATURE, RIDGE = 0.15, 2.0, 1.0
THRESHOLD = 0.3

STATISTICS = [
    "log_words", "word_length", "word_length_spread", "longest_word", "symbols", "digits", "capitals", "stops", "exclamations",
    "bars", "other_bytes", "lines_per_word", "repeated_lines", "distinct_words", "top_word", "repeated_pairs", "repeated_fives",
    "short_words", "same_as_previous", "mean_line",
]


def _share_of(bytes_: np.ndarray, chars: str) -> int:
    return int(bytes_[np.frombuffer(chars.encode(), np.uint8)].sum())


def _repeated(keys: np.ndarray, text_of: np.ndarray, n: int) -> np.ndarray:
    """Share of each text's keys that occurred before in the same text."""
    # numbers of texts are moved out of the range of word codes, whose mixed values may be among the keys
    both = mixed(keys + mixed(text_of.astype(np.uint64) + np.uint64(1 << 48)))
    _, first = np.unique(both, return_index=True)
    total, distinct = np.bincount(text_of, minlength=n), np.bincount(text_of[first], minlength=n)
    return 1 - distinct / np.maximum(total, 1)


def statistics(texts: list[str]) -> np.ndarray:
    """One row of ``STATISTICS`` per text."""
    n = len(texts)
    sizes, words = word_lists(texts)
    out = np.zeros((n, len(STATISTICS)))
    if not words:
        return out
    codes, distinct = word_codes(words)
    text_of = np.repeat(np.arange(n), sizes)
    lengths = np.fromiter(map(len, distinct), np.int64, len(distinct))[codes]
    per = np.maximum(sizes, 1)
    total = lambda x: np.bincount(text_of, weights=x, minlength=n)
    mean = total(lengths) / per
    longest = np.zeros(n)
    np.maximum.at(longest, text_of, lengths)
    column = {
        "log_words": np.log1p(sizes), "word_length": mean, "longest_word": longest,
        "word_length_spread": np.sqrt(np.maximum(total(lengths * lengths) / per - mean * mean, 0)),
        "short_words": total(lengths <= 3) / per,
    }
    keys = mixed(codes.astype(np.uint64))
    column["distinct_words"] = 1 - _repeated(keys, text_of, n)
    pair_codes, pair_of = text_of * len(distinct) + codes, None
    values, counts = np.unique(pair_codes, return_counts=True)
    top = np.zeros(n)
    np.maximum.at(top, values // len(distinct), counts)
    column["top_word"] = top / per
    gram = keys
    for k in range(1, 5):
        gram = mixed(gram[:-1] * np.uint64(0x9E3779B97F4A7C15) + keys[k:]) if len(gram) > 1 else gram[:0]
        inside = text_of[: len(gram)] == text_of[len(text_of) - len(gram) :]
        if k in (1, 4):
            pair_of = text_of[: len(gram)][inside]
            column["repeated_pairs" if k == 1 else "repeated_fives"] = _repeated(gram[inside], pair_of, n)
    same = (codes[1:] == codes[:-1]) & (text_of[1:] == text_of[:-1])
    column["same_as_previous"] = np.bincount(text_of[1:][same], minlength=n) / per
    rows = {k: np.zeros(n) for k in STATISTICS if k not in column}
    for i, t in enumerate(texts):
        found = np.bincount(np.frombuffer(t.encode("utf-8", "replace"), np.uint8), minlength=256)
        size = max(int(found.sum()), 1)
        lines = [x for x in t.split("\n") if x.strip()]
        rows["symbols"][i] = _share_of(found, "#*$%&<>") / size
        rows["bars"][i] = _share_of(found, "|") / size
        rows["digits"][i] = found[48:58].sum() / size
        rows["capitals"][i] = found[65:91].sum() / size
        rows["stops"][i] = _share_of(found, ".,;:?") / size
        rows["exclamations"][i] = _share_of(found, "!") / size
        rows["other_bytes"][i] = found[128:].sum() / size
        rows["lines_per_word"][i] = len(lines) / per[i]
        rows["repeated_lines"][i] = 1 - len(set(lines)) / max(len(lines), 1)
        rows["mean_line"][i] = len(t) / max(len(lines), 1)
    column |= rows
    for j, name in enumerate(STATISTICS):
        out[:, j] = column[name]
    out[sizes == 0] = 0
    return out


@dataclass(frozen=True)
class Trees:
    """All trees as arrays (tree, node); ``feature`` is -1 where a node does not divide."""

    feature: np.ndarray
    threshold: np.ndarray
    value: np.ndarray
    base: float

    def scores(self, x: np.ndarray) -> np.ndarray:
        margin = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for feature, threshold, value in zip(self.feature, self.threshold, self.value, strict=True):
            node = np.zeros(len(x), np.int64)
            for _ in range(DEPTH):
                f = feature[node]
                right = x[rows, np.maximum(f, 0)] > threshold[node]
                node = np.where(f < 0, node, 2 * node + 1 + right)
            margin += value[node]
        return 1 / (1 + np.exp(-np.clip(margin, -35, 35)))


def boost(x: np.ndarray, y: np.ndarray, trees: int = TREES) -> Trees:
    """Grow trees on a matrix of statistics for labels 0 and 1 (log loss)."""
    n, width = x.shape
    nodes = 2 ** (DEPTH + 1) - 1
    if not n:
        return Trees(np.zeros((0, nodes), np.int64), np.zeros((0, nodes)), np.zeros((0, nodes)), 0.0)
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1])) for j in range(width)]
    binned = np.stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(edges)], axis=1)
    rate = np.clip(y.mean(), 0.001, 0.999)
    base = float(np.log(rate / (1 - rate)))
    margin = np.full(n, base)
    features, thresholds, values = [], [], []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-margin))
        g, h = p - y, p * (1 - p)
        node = np.zeros(n, np.int64)
        feature, threshold, value = np.full(nodes, -1), np.zeros(nodes), np.zeros(nodes)
        for depth in range(DEPTH + 1):
            first, count = 2**depth - 1, 2**depth
            live = np.flatnonzero(node >= first)
            place = node[live] - first
            gs, hs = np.bincount(place, g[live], count), np.bincount(place, h[live], count)
            value[first : first + count] = -RATE * gs / (hs + RIDGE)
            if depth == DEPTH:
                break
            best = np.full(count, 1e-6)
            for j, e in enumerate(edges):
                slot = place * BINS + binned[live, j]
                left_g = np.cumsum(np.bincount(slot, g[live], count * BINS).reshape(count, BINS), axis=1)[:, : len(e)]
                left_h = np.cumsum(np.bincount(slot, h[live], count * BINS).reshape(count, BINS), axis=1)[:, : len(e)]
                if not len(e):
                    continue
                right_g, right_h = gs[:, None] - left_g, hs[:, None] - left_h
                gain = left_g**2 / (left_h + RIDGE) + right_g**2 / (right_h + RIDGE) - (gs**2 / (hs + RIDGE))[:, None]
                gain = np.where((left_h >= MIN_CURVATURE) & (right_h >= MIN_CURVATURE), gain, 0)
                at = gain.argmax(axis=1)
                better = gain[np.arange(count), at] > best
                best = np.where(better, gain[np.arange(count), at], best)
                feature[first : first + count] = np.where(better, j, feature[first : first + count])
                threshold[first : first + count] = np.where(better, e[at], threshold[first : first + count])
            split = feature[node[live]]
            goes = split >= 0
            rows = live[goes]
            node[rows] = 2 * node[rows] + 1 + (x[rows, split[goes]] > threshold[node[rows]])
        margin += value[node]
        features.append(feature)
        thresholds.append(threshold)
        values.append(value)
    return Trees(np.array(features), np.array(thresholds), np.array(values), base)


def training_ids(labels: DataFrame, label: str, sample: int) -> DataFrame:
    known = labels.filter(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & ~heldout(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.min(label).cast("double").alias("label"))
    return known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", sample: int = SAMPLE) -> Trees:
    """Learn from the bounded sample; only its statistics, ``sample`` rows of numbers at most, reach the driver.

    Of several texts of an id the one with the smallest SHA-256 counts.
    """
    ids = stored(training_ids(labels.select("doc_id", label), label, sample), "quality-ids")
    digest = F.sha2(filled().cast("binary"), 256).alias("digest")
    rows = docs.select("doc_id", digest, "text").join(F.broadcast(ids), "doc_id").select("label", "doc_id", "digest", "text")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in slices(batches):
            x = statistics(texts)
            lists = pa.ListArray.from_arrays(
                pa.array(np.arange(len(texts) + 1) * x.shape[1], pa.int32()), pa.array(x.ravel(), pa.float64())
            )
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], lists], names=["label", "doc_id", "digest", "x"])

    found = rows.mapInArrow(run, f"label double, doc_id {dict(rows.dtypes)['doc_id']}, digest string, x array<double>")
    one = found.groupBy("doc_id").agg(F.min_by(F.struct("label", "x"), "digest").alias("own")).select("doc_id", "own.*")
    sample_rows = one.toPandas().sort_values("doc_id")
    if sample_rows.empty:
        return boost(np.zeros((0, len(STATISTICS))), np.zeros(0))
    return boost(np.stack(sample_rows["x"].to_list()), sample_rows["label"].to_numpy())


def scored(docs: DataFrame, trees: Trees, threshold: float = THRESHOLD) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score, predicted."""
    score = _score_column(trees)
    return docs.select("doc_id", heldout(F.col("doc_id")).alias("held_out"), score("text").alias("score")).withColumn(
        "predicted", F.when(F.col("score") >= threshold, 1).otherwise(0)
    )


def _score_column(trees: Trees) -> Callable:
    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield scores_of(texts, lambda t: trees.scores(statistics(t)))

    return score
