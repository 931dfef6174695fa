"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

A text's features are the distinct hashes, in ``2 ** BITS`` cells, of its words, of their first ``STEM`` letters, of
neighbouring word pairs and of pairs with one word between. Learning is follow-the-regularised-leader with a learning rate
per coordinate; its L1 term keeps most weights at exactly zero, so the model is a short list of cells and weights that
every task gets. Training rows are at most ``SAMPLE`` labelled ids, those with the smallest hashes, never a held-out one;
the bound holds for any size of the tables and, by ``SAMPLE_CELLS``, of texts; one task learns from it. Scoring reads every whole text.

A null text counts as empty and gets the score of the bias alone; an empty table gives an empty result. Null labels
are no labels, an id labelled twice counts as toxic if one of its labels says so, and of repeated ids the text with the
smallest SHA-256 is learnt from. Without any training row every score is 0. Other columns are not read.
"""

from __future__ import annotations

import string
from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from arealis.llm.text import filled, hashed, heldout, mixed, quoted, scores_of, slices, word_codes, word_lists
from arealis.session import stored

BITS = 20
STEM = 5
SAMPLE = 12_000
#: Features of all sampled texts together (of 4 bytes).
SAMPLE_CELLS = 64_000_000
EPOCHS = 4
#: L1 is a share of the training rows, as the gradients it competes with add up over them.
ALPHA, BETA, L1_SHARE, L2 = 1.0, 1.0, 0.002, 1.0
POSITIVE_WEIGHT = 3.0
EDGES = string.punctuation + "«»“”„‘’…–—¡¿"


def text_features(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """All features of the texts, with repetitions: the number of the text and the hash cell."""
    sizes, words = word_lists([t.lower() for t in texts])
    if not words:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    codes, distinct = word_codes(words)
    bare = [w.strip(EDGES) for w in distinct]
    word, stem = hashed(bare)[codes], hashed((w[:STEM] for w in bare), seed=1)[codes]
    text_of = np.repeat(np.arange(len(texts)), sizes)
    found = [(text_of, mixed(word)), (text_of, mixed(stem))]
    for gap, odd in ((1, 0x9E3779B97F4A7C15), (2, 0xC2B2AE3D27D4EB4F)):
        same = text_of[gap:] == text_of[:-gap]
        pair = mixed(word[:-gap] * np.uint64(odd) + word[gap:])
        found.append((text_of[gap:][same], pair[same]))
    cells = np.concatenate([h for _, h in found]) >> np.uint64(64 - BITS)
    return np.concatenate([t for t, _ in found]), cells.astype(np.int64)


def _distinct(text_of: np.ndarray, cells: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    keys = np.unique((text_of << BITS) | cells)
    return keys >> BITS, keys & ((1 << BITS) - 1)


@dataclass(frozen=True)
class Weights:
    """The non-zero cells and their weights; ``bias`` None means that nothing was learnt."""

    cells: np.ndarray
    values: np.ndarray
    bias: float | None

    def scorer(self) -> Callable[[list[str]], np.ndarray]:
        dense = np.zeros(1 << BITS, np.float64)
        dense[self.cells] = self.values

        def score(texts: list[str]) -> np.ndarray:
            if self.bias is None:
                return np.zeros(len(texts))
            text_of, cells = text_features(texts)
            used = dense[cells] != 0
            text_of, cells = _distinct(text_of[used], cells[used])
            margin = self.bias + np.bincount(text_of, weights=dense[cells], minlength=len(texts))
            return 1 / (1 + np.exp(-np.clip(margin, -35, 35)))

        return score


def ftrl(rows: Sequence[np.ndarray], labels: np.ndarray, epochs: int = EPOCHS) -> Weights:
    """Learn from rows of distinct cells; the bias is one more coordinate, without L1."""
    bias_cell, l1 = 1 << BITS, L1_SHARE * len(rows)
    z, n = np.zeros(bias_cell + 1), np.zeros(bias_cell + 1)

    def weight(c: np.ndarray) -> np.ndarray:
        shrunk = np.abs(z[c]) - l1
        w = -np.sign(z[c]) * np.maximum(shrunk, 0) / ((BETA + np.sqrt(n[c])) / ALPHA + L2)
        w[-1] = -z[bias_cell] / ((BETA + np.sqrt(n[bias_cell])) / ALPHA)
        return w

    order = np.random.default_rng(7)
    for _ in range(epochs):
        for i in order.permutation(len(rows)):
            c, y = np.r_[rows[i], bias_cell], labels[i]
            w = weight(c)
            p = 1 / (1 + np.exp(-np.clip(w.sum(), -35, 35)))
            g = (p - y) * (POSITIVE_WEIGHT if y else 1.0)
            total = n[c] + g * g
            z[c] += g - (np.sqrt(total) - np.sqrt(n[c])) / ALPHA * w
            n[c] = total
    learnt = np.flatnonzero(np.abs(z[:bias_cell]) > l1)
    w = weight(np.r_[learnt, bias_cell])
    return Weights(learnt, w[:-1], float(w[-1]))


def training_ids(labels: DataFrame, label: str, sample: int) -> DataFrame:
    """At most ``sample`` labelled ids that are not held out, those with the smallest hashes: doc_id, label."""
    known = labels.filter(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & ~heldout(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.max(label).cast("double").alias("label"))
    return known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", sample: int = SAMPLE, sample_cells: int = SAMPLE_CELLS) -> Weights:
    """Learn from the bounded sample: features are made where the texts are, one task learns from them.

    Of several texts of an id the one with the smallest SHA-256 counts. Sampled texts count in the order of their ids' hashes
    until they have ``sample_cells`` features together (the first one always), which bounds that task's memory.
    """
    ids = stored(training_ids(labels.select("doc_id", label), label, sample), "toxicity-ids")
    digest = F.sha2(filled().cast("binary"), 256).alias("digest")
    rows = docs.select("doc_id", digest, "text").join(F.broadcast(ids), "doc_id").select("label", "doc_id", "digest", "text")

    def features(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in slices(batches):
            text_of, cells = _distinct(*text_features(texts))
            stops = np.searchsorted(text_of, np.arange(len(texts) + 1))
            lists = pa.ListArray.from_arrays(pa.array(stops, pa.int32()), pa.array(cells, pa.int32()))
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], lists], names=["label", "doc_id", "digest", "cells"])

    found = rows.mapInArrow(features, f"label double, doc_id {dict(rows.dtypes)['doc_id']}, digest string, cells array<int>")
    one = found.groupBy("doc_id").agg(F.min_by(F.struct("label", "cells"), "digest").alias("own")).select("doc_id", "own.*")
    one = stored(one, "toxicity-sample")
    # the window's rows are the sample's ids and sizes
    sizes = one.select("doc_id", F.size("cells").alias("n"))
    before = F.sum("n").over(Window.orderBy(F.xxhash64("doc_id"), "doc_id").rowsBetween(Window.unboundedPreceding, -1))
    taken = sizes.withColumn("before", F.coalesce(before, F.lit(0))).filter((F.col("before") == 0) | (F.col("before") + F.col("n") <= sample_cells))
    one = one.join(F.broadcast(taken.select("doc_id")), "doc_id")

    def learn(sample: pa.Table) -> pa.Table:
        by_id = np.argsort(sample.column("doc_id").to_numpy(), kind="stable")
        cells = []  # views, not copies
        for chunk in sample.column("cells").chunks:
            flat, stops = chunk.values.to_numpy(), chunk.offsets.to_numpy()
            cells += [flat[a:b] for a, b in zip(stops[:-1], stops[1:], strict=True)]
        w = ftrl([cells[i] for i in by_id], sample.column("label").to_numpy()[by_id])
        return pa.table({"cell": np.r_[w.cells, -1], "value": np.r_[w.values, w.bias]})

    learnt = one.withColumn("model", F.lit(0)).groupBy("model").applyInArrow(learn, "cell long, value double").toPandas()
    if learnt.empty:
        return Weights(np.zeros(0, np.int64), np.zeros(0), None)
    own = learnt["cell"] >= 0
    return Weights(learnt["cell"][own].to_numpy(), learnt["value"][own].to_numpy(), float(learnt["value"][~own].iloc[0]))


def scored(docs: DataFrame, weights: Weights, threshold: float = 0.5) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score, predicted."""
    score = _score_column(weights)
    return docs.select("doc_id", heldout(F.col("doc_id")).alias("held_out"), score("text").alias("score")).withColumn(
        "predicted", F.when(F.col("score") >= threshold, 1).otherwise(0)
    )


def without_toxic(docs: DataFrame, weights: Weights, threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` scored below the threshold, with their columns."""
    rows = docs.select(F.struct(*[quoted(c) for c in docs.columns]).alias("whole"), F.col("text").alias("own_text"))
    marked = rows.select("whole", _score_column(weights)("own_text").alias("own_score"))
    return marked.filter(F.col("own_score") < threshold).select("whole.*")


def _score_column(weights: Weights) -> Callable:
    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        of = weights.scorer()
        for texts in batches:
            yield scores_of(texts, of)

    return score
