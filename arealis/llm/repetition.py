"""Quality rule: repeated passages inside a text, found from its suffix array.

The words of a slice of texts are numbered and their suffixes sorted by prefix doubling, all texts of the slice at once:
a suffix never runs past the end of its text, so each text has a suffix array of its own. Ranks of the doubling steps give
the longest common prefix of neighbouring suffixes. The innermost common-prefix interval of a suffix (the longer of the
prefixes it shares with its two neighbours) is the longest repeated substring that starts there; those that cannot be
extended to the left either are the maximal repeats. Their spans are united, and a text is rejected if repeats of
``MIN_WORDS`` words or more cover more than ``MAX_COVERED`` of its words or if one repeat has more than ``MAX_LONGEST`` words.

A null text counts as empty: it has no words, no spans, and fails the base rule. Whole texts are read, whatever their
length. Memory follows the longest text of a slice: words are numbered piece by piece, and above ``STACKED`` words the common
prefixes come from the sorted suffixes by one walk over the words, without the ranks of all doubling steps. Repeated rows give repeated results. An empty table gives an empty result.
Columns other than id and text are not read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arealis.llm.text import SLICE_CHARS, WORD, quoted, slices, word_codes, word_lists

WINDOW = 8
MIN_WORDS = 4
MAX_COVERED = 0.3
MAX_LONGEST = 60
SYMBOLS = "#*$%&|<>"
#: Words of a slice up to which the ranks of all doubling steps are kept.
STACKED = 600_000


@dataclass
class Suffixes:
    """Sorted suffixes of all texts of a slice, with what repeats."""

    order: np.ndarray
    prefix: np.ndarray  # common words of a suffix and the one before it in order
    repeated_window: np.ndarray  # whether the window that starts here occurs twice or more


def sorted_suffixes(codes: np.ndarray, text_of: np.ndarray, ends: np.ndarray, window: int = WINDOW) -> Suffixes:
    """``codes``: word numbers; ``text_of``: number of each word's text; ``ends``: the end of each word's text."""
    n = len(codes)
    place = np.arange(n, dtype=np.int32)
    key = text_of.astype(np.int64) * (int(codes.max(initial=0)) + 1) + codes
    order = np.argsort(key, kind="stable").astype(np.int32)
    starts = np.r_[True, key[order[1:]] != key[order[:-1]]][:n]
    del key
    rank = np.empty(n, np.int32)
    rank[order] = np.maximum.accumulate(np.where(starts, place, 0))
    keep = n <= STACKED
    ranks, step, same_window = [rank], 1, np.zeros(n, bool)
    while True:
        if step == window:
            whole = place + window <= ends
            count = np.bincount(rank[whole], minlength=n)
            same_window[whole] = count[rank[whole]] > 1
        # only suffixes that share their rank with a neighbour move
        shared = np.r_[~starts[1:], False] | ~starts
        at = np.flatnonzero(shared).astype(np.int32)
        if not len(at):
            break
        suffix = order[at]
        following = suffix + np.int32(step)
        inside = following < ends[suffix]
        second = np.where(inside, rank[np.minimum(following, n - 1)] + np.int32(1), np.int32(0))
        del following, inside
        by = np.lexsort((second, rank[suffix])).astype(np.int32)
        order[at] = suffix[by]
        first, second = rank[suffix][by], second[by]
        new = np.r_[True, (first[1:] != first[:-1]) | (second[1:] != second[:-1])]
        starts[at] = new
        del first, second, suffix, by
        rank = rank.copy() if keep else rank
        rank[order[at]] = np.maximum.accumulate(np.where(new, at, 0))
        if keep:
            ranks.append(rank)
        step *= 2
    if not keep:
        del rank, ranks
        return Suffixes(order, walked_prefixes(codes, order, ends), same_window)
    # the common prefix of neighbours, from the longest step down
    a, b = order[:-1].copy(), order[1:].copy()
    common = np.zeros(max(n - 1, 0), np.int64)
    live = np.flatnonzero(ranks[0][a] == ranks[0][b])
    a, b = a[live], b[live]
    got = np.zeros(len(live), np.int64)
    for k in range(len(ranks) - 1, -1, -1):
        x, y = a + got, b + got
        fits = (x + (1 << k) <= ends[a]) & (y + (1 << k) <= ends[b])
        equal = fits & (ranks[k][np.minimum(x, n - 1)] == ranks[k][np.minimum(y, n - 1)])
        got += np.where(equal, 1 << k, 0)
    common[live] = got
    return Suffixes(order, np.r_[0, common][:n], same_window)


def walked_prefixes(codes: np.ndarray, order: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Common words of each suffix and the one before it in order, from left to right: the next suffix shares one word less at least."""
    n = len(codes)
    before = np.full(n, -1, np.int32)
    before[order[1:]] = order[:-1]
    before[before >= 0] = np.where(ends[before[before >= 0]] == ends[before >= 0], before[before >= 0], -1)  # of another text
    out = np.zeros(n, np.int32)
    word, end, other, got = (memoryview(np.ascontiguousarray(x, np.int32)) for x in (codes, ends, before, out))
    common = 0
    for i in range(n):
        j = other[i]
        if j < 0:
            common = 0
            continue
        most = end[i] - max(i, j)
        while common < most and word[i + common] == word[j + common]:
            common += 1
        got[i] = common
        common = common - 1 if common and i + 1 < end[i] else 0
    return out[order].astype(np.int64)


def numbered_words(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Number of words of each text, an integer for each word, and the characters of each distinct word by that integer."""
    if max(map(len, texts), default=0) <= 2 * SLICE_CHARS:
        sizes, words = word_lists(texts)
        codes, distinct = word_codes(words) if words else (np.zeros(0, np.int64), [])
        return sizes, codes.astype(np.int32), np.fromiter(map(len, distinct), np.int64, len(distinct))
    numbers: dict[str, int] = {}
    sizes, parts = np.zeros(len(texts), np.int64), [np.zeros(0, np.int32)]
    for k, t in enumerate(texts):
        start = 0
        while start < len(t):
            end = start + SLICE_CHARS
            last = WORD.match(t, end) if end < len(t) else None  # a word over the border belongs to this piece
            end = last.end() if last else end
            codes, distinct = word_codes(WORD.findall(t, start, end))
            own = np.fromiter((numbers.setdefault(w, len(numbers)) for w in distinct), np.int32, len(distinct))
            sizes[k] += len(codes)
            parts.append(own[codes])
            start = end
    return sizes, np.concatenate(parts), np.fromiter(map(len, numbers), np.int64, len(numbers))


def longest_repeats(found: Suffixes) -> np.ndarray:
    """Words of the longest repeated substring that starts at each word."""
    n = len(found.order)
    out = np.zeros(n, np.int64)
    out[found.order] = np.maximum(found.prefix, np.r_[found.prefix[1:], 0][:n])
    return out


def covered(starts: np.ndarray, lengths: np.ndarray, n: int) -> np.ndarray:
    """Which of n places the spans cover."""
    delta = np.bincount(starts, minlength=n + 1)[: n + 1] - np.bincount(starts + lengths, minlength=n + 1)[: n + 1]
    return np.cumsum(delta)[:n] > 0


def repetition(texts: list[str], min_words: int = MIN_WORDS) -> dict[str, np.ndarray | list]:
    """Counts of each text, and the united spans of its maximal repeats as (first word, number of words)."""
    sizes, codes, chars = numbered_words(texts)
    n = len(codes)
    text_of = np.repeat(np.arange(len(texts), dtype=np.int32), sizes)
    ends_of = np.cumsum(sizes)
    first = ends_of - sizes
    if n:
        found = sorted_suffixes(codes, text_of, ends_of[text_of].astype(np.int32))
        longest = longest_repeats(found)
        # what the word before extends is not maximal
        inner = np.r_[False, (longest[:-1] > longest[1:]) & (text_of[:-1] == text_of[1:])]
        maximal = np.flatnonzero((longest >= min_words) & ~inner)
        in_repeat = covered(maximal, longest[maximal], n)
        windows = np.flatnonzero(found.repeated_window)
        in_window = covered(windows, np.full(len(windows), WINDOW), n)
    else:
        longest, in_repeat, in_window = np.zeros(0, np.int64), np.zeros(0, bool), np.zeros(0, bool)
    total = lambda x: np.bincount(text_of, weights=x, minlength=len(texts)).astype(np.int64)
    top = np.zeros(len(texts), np.int64)
    np.maximum.at(top, text_of, np.where(longest >= min_words, longest, 0))
    begins = np.flatnonzero(in_repeat & ~(np.r_[False, in_repeat[:-1]] & np.r_[False, text_of[:-1] == text_of[1:]][:n]))
    stops = np.flatnonzero(in_repeat & ~(np.r_[in_repeat[1:], False] & np.r_[text_of[:-1] == text_of[1:], False][:n])) + 1
    spans: list[list] = [[] for _ in texts]
    for b, e in zip(begins.tolist(), stops.tolist(), strict=True):
        t = text_of[b]
        spans[t].append({"start": b - int(first[t]), "words": e - b})
    return {
        "n_words": sizes, "n_repeat_words": total(in_window), "n_covered": total(in_repeat), "longest_repeat": top,
        "spans": spans,
        "word_chars": total(chars[codes]) if n else np.zeros(len(texts), np.int64),
    }


def duplicate_lines(text: str) -> int:
    """Lines that hold a word and equal an earlier line."""
    lines = [x for x in text.split("\n") if x.strip(" \t\n\x0b\x0c\r")]
    return len(lines) - len(set(lines))


SCHEMA = (
    "doc_id {id}, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, kept boolean, n_covered long, longest_repeat long, spans array<struct<start:long, words:long>>"
)


def repetition_rules(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
    min_words: int = MIN_WORDS, max_covered: float = MAX_COVERED, max_longest: int = MAX_LONGEST,
) -> DataFrame:
    """One row per row of ``docs``: the counts, the verdict, and the united spans of repeats in words."""
    columns = docs.select(quoted(doc_id).alias("doc_id"), quoted(text).alias("text"))
    span_type = pa.list_(pa.struct([("start", pa.int64()), ("words", pa.int64())]))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in slices(batches):
            r = repetition(texts, min_words)
            n_words = r["n_words"]
            base = (n_words < 20) | (100 * r["n_repeat_words"] > 30 * n_words)
            kept = ~base & (r["n_covered"] <= max_covered * n_words) & (r["longest_repeat"] <= max_longest)
            values = {
                "doc_id": batch.column(0), "n_words": n_words, "word_chars": r["word_chars"],
                "n_symbols": [sum(map(t.count, SYMBOLS)) for t in texts],
                "n_dup_lines": [duplicate_lines(t) for t in texts],
                "n_repeat_words": r["n_repeat_words"], "base_failed": base, "kept": kept,
                "n_covered": r["n_covered"], "longest_repeat": r["longest_repeat"],
                "spans": pa.array(r["spans"], span_type),
            }
            arrays = [x if isinstance(x, pa.Array) else pa.array(x) for x in values.values()]
            yield pa.RecordBatch.from_arrays(arrays, names=list(values))

    return columns.mapInArrow(run, SCHEMA.format(id=dict(columns.dtypes)["doc_id"]))
