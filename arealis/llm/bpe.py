"""Byte-pair encoding and decoding with a vocabulary file of merges.

Text is normalised (NFC, runs of white space to one space, lower case), cut into pieces by a pattern, and the bytes of each
piece, written in printable characters, are merged: a priority queue holds the ranks of neighbouring pairs of a doubly
linked symbol list; the lowest rank, leftmost first, is merged, its neighbours queue their new pairs, and entries whose
symbols have changed since are skipped as stale. Decoding joins vocabulary strings with a space.

Special tokens found in a text become their ids and part the text around them. A null text counts as empty: no tokens,
and it decodes to an empty string. Whole texts are read. Recently used pieces and
their ids are remembered, two generations of ``MEMORY`` pieces. An empty table gives an empty result; repeated rows give repeated
results. Columns other than id and text are not read.

The vocabulary file is distributed by its path, which every executor must be able to read, or by ``SparkContext.addFile``.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import unicodedata
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arealis.llm.text import quoted, slices

#: Pieces of one generation that a task remembers with their ids, and the longest piece it remembers.
MEMORY, MEMORY_CHARS = 100_000, 64


def byte_characters() -> list[str]:
    """A printable character for each byte: printable Latin-1 ones stand for themselves, the others follow from 256 on."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    others = {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in set(own))}
    return [others.get(b, chr(b)) for b in range(256)]


def merge(symbols: list[str], ranks: dict[tuple[str, str], int]) -> list[str]:
    """Merge neighbouring symbols, lowest rank first and leftmost among equals, until no pair has a rank.

    A queue entry is ``rank * n + place of the left symbol``; it is stale when that place's pair has another rank by now.
    """
    n = len(symbols)
    value: list[str | None] = list(symbols)
    before, after = list(range(-1, n - 1)), list(range(1, n + 1))
    queue = []
    for left in range(n - 1):
        rank = ranks.get((value[left], value[left + 1]))
        if rank is not None:
            queue.append(rank * n + left)
    heapq.heapify(queue)
    while queue:
        rank, left = divmod(heapq.heappop(queue), n)
        right = after[left]
        if value[left] is None or right == n or ranks.get((value[left], value[right])) != rank:
            continue  # stale: one of the two has been merged meanwhile
        merged = value[left] = value[left] + value[right]
        value[right] = None
        following = after[left] = after[right]
        if following < n:
            before[following] = left
            rank = ranks.get((merged, value[following]))
            if rank is not None:
                heapq.heappush(queue, rank * n + left)
        previous = before[left]
        if previous >= 0:
            rank = ranks.get((value[previous], merged))
            if rank is not None:
                heapq.heappush(queue, rank * n + previous)
    return [v for v in value if v is not None]


@dataclass
class Tokenizer:
    """Vocabulary, merges and rules of one tokenizer file."""

    ids: dict[str, int]
    ranks: dict[tuple[str, str], int]
    suffix: str
    pieces: regex.Pattern
    special: dict[str, int]
    bytes_as: list[str] = field(default_factory=byte_characters)
    memory: dict[str, tuple[int, ...]] = field(default_factory=dict)
    older: dict[str, tuple[int, ...]] = field(default_factory=dict)

    def __post_init__(self) -> None:
        names = sorted(self.special, key=len, reverse=True)
        self.special_at = regex.compile("|".join(map(regex.escape, names))) if names else None
        self.words = {i: w for w, i in self.ids.items()} | {i: w for w, i in self.special.items()}

    def piece_ids(self, piece: str) -> tuple[int, ...]:
        """Ids of a piece; recently used pieces are remembered in two generations, of which the older one goes."""
        found = self.memory.get(piece)
        if found is None:
            found = self.older.get(piece)
            if found is None:
                symbols = [self.bytes_as[b] for b in piece.encode("utf-8", "surrogatepass")]
                symbols[-1] += self.suffix
                found = tuple([self.ids[s] for s in merge(symbols, self.ranks) if s in self.ids])
            if len(piece) <= MEMORY_CHARS:
                if len(self.memory) >= MEMORY:
                    self.older, self.memory = self.memory, {}
                self.memory[piece] = found
        return found

    def plain_ids(self, text: str) -> list[int]:
        if not text.isascii():
            text = unicodedata.normalize("NFC", text)
        out: list[int] = []
        for chunk in chunks(lowered(text)):
            found = self.memory.get(chunk)  # what is remembered is one piece
            if found is not None:
                out += found
            elif chunk[:-1].isalpha() and chunk[-1].isascii() and not chunk[-1].isalpha():  # a word and its punctuation: two pieces
                out += self.piece_ids(chunk[:-1])
                out += self.piece_ids(chunk[-1])
            else:
                for piece in (chunk,) if chunk.isalpha() else self.pieces.findall(chunk):
                    out += self.piece_ids(piece)
        return out

    def encode(self, text: str) -> list[int]:
        if self.special_at is None or not self.special_at.search(text):
            return self.plain_ids(text)
        out, start = [], 0
        for m in self.special_at.finditer(text):
            out += self.plain_ids(text[start : m.start()])
            out.append(self.special[m.group()])
            start = m.end()
        return out + self.plain_ids(text[start:])

    def decode(self, ids: list[int]) -> str:
        return " ".join([self.words[i] for i in ids])


#: White space of the normaliser's pattern: Unicode's White_Space property.
SPACES = regex.compile(r"\p{White_Space}+")


#: What Python's split takes for white space too.
SEPARATORS = regex.compile("[\x1c-\x1f]")


def chunks(text: str) -> list[str]:
    """The parts of a text between white space."""
    return [x for x in SPACES.split(text) if x] if SEPARATORS.search(text) else text.split()


# Upper-case letters of Unicode 16.0 and 17.0 and what to add for lower case; Python 3.13's tables lack them.
LOWER_17 = {
    "1C89-1C89": 1, "A7CB-A7CB": 0x264 - 0xA7CB, "A7CC-A7CC": 1, "A7CE-A7CE": 1, "A7D2-A7D2": 1, "A7D4-A7D4": 1, "A7DA-A7DA": 1,
    "A7DC-A7DC": 0x19B - 0xA7DC, "10D50-10D65": 0x20, "16EA0-16EB8": 0x1B,
}
UPPER_17 = {c: c + add for r, add in LOWER_17.items() for a, b in [r.split("-")] for c in range(int(a, 16), int(b, 16) + 1)}
UPPER_17_AT = regex.compile("[" + "".join(map(chr, UPPER_17)) + "]")


def lowered(text: str) -> str:
    """Lower case, each character for itself: a final sigma is no special case."""
    if not text.isascii() and UPPER_17_AT.search(text):
        text = text.translate(UPPER_17)
    return text.lower() if text.isascii() or "Σ" not in text else "σ".join(x.lower() for x in text.split("Σ"))


# Letters and numbers that Unicode 16.0 added to 15.1, the version of Python 3.13's tables.
LETTERS_16 = (
    "1C89-1C8A A7CB-A7CD A7DA-A7DC 105C0-105F3 10D4A-10D65 10D6F-10D85 10EC2-10EC4 11380-11389 1138B-1138B 1138E-1138E 11390-113B5 "
    "113B7-113B7 113D1-113D1 113D3-113D3 11BC0-11BE0 13460-143FA 16100-1611D 16D40-16D6C 18CFF-18CFF 1E5D0-1E5ED 1E5F0-1E5F0"
)
NUMBERS_16 = "10D40-10D49 116D0-116E3 11BF0-11BF9 16130-16139 16D70-16D79 1CCF0-1CCF9 1E5F1-1E5FA"


def _ranges(listed: str) -> list[tuple[int, int]]:
    return [(int(a, 16), int(b, 16)) for a, b in (r.split("-") for r in listed.split())]


def _as_set(ranges: list[tuple[int, int]]) -> str:
    return "[" + "".join(f"\\U{a:08X}-\\U{b:08X}" for a, b in ranges) + "]"


@lru_cache(maxsize=2)
def character_class(kind: str) -> str:
    """Set expression of the library's letters (``L``) or numbers (``N``), those of Unicode 16.0; ``regex`` knows younger ones too."""
    known = regex.compile(rf"\p{{{kind}}}")
    new = [c for c in range(0x110000) if unicodedata.category(chr(c)) == "Cn" and known.match(chr(c))]
    starts = [c for k, c in enumerate(new) if not k or new[k - 1] != c - 1]
    ends = [c for k, c in enumerate(new) if k == len(new) - 1 or new[k + 1] != c + 1]
    own = _as_set(_ranges({"L": LETTERS_16, "N": NUMBERS_16}[kind]))
    return rf"[[\p{{{kind}}}--{_as_set(list(zip(starts, ends, strict=True)))}]{own}]" if new else rf"[\p{{{kind}}}{own}]"


def piece_pattern(pattern: str) -> regex.Pattern:
    """The file's pattern with the library's classes of letters and numbers."""
    for kind in "LN":
        pattern = pattern.replace(rf"\p{{{kind}}}", character_class(kind))
    return regex.compile(pattern, regex.V1)


@lru_cache(maxsize=4)
def load(path: str) -> Tokenizer:
    """Read a tokenizer file; a rule that this module does not follow is an error."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model = spec["model"]
    kinds = [x["type"] for x in spec["normalizer"]["normalizers"]]
    cut = spec["pre_tokenizer"]["pretokenizers"]
    if kinds != ["NFC", "Replace", "Lowercase"] or [x["type"] for x in cut] != ["Split", "ByteLevel"]:
        raise ValueError(f"normaliser or pre-tokenizer of {path} not supported")
    merges = [tuple(m if isinstance(m, list) else m.split(" ")) for m in model["merges"]]
    return Tokenizer(
        ids=model["vocab"], ranks={m: i for i, m in enumerate(merges)}, suffix=model["end_of_word_suffix"] or "",
        pieces=piece_pattern(cut[0]["pattern"]["Regex"]), special={t["content"]: t["id"] for t in spec["added_tokens"]},
    )


SCHEMA = "doc_id {id}, n_tokens long, ids array<int>, decoded string"
DIGESTS = "doc_id {id}, n_tokens long, ids_sha256 string, decoded_sha256 string"


def _sha(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()


def encoded(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text", digests: bool = False) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_tokens, ids and the decoded text, or the SHA-256 of both."""
    columns = docs.select(quoted(doc_id).alias("doc_id"), quoted(text).alias("text"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = load(path)
        for batch, texts in slices(batches):
            ids = [tokenizer.encode(t) for t in texts]
            decoded = [tokenizer.decode(x) for x in ids]
            sizes = pa.array(map(len, ids), pa.int64())
            if digests:
                out = [pa.array([_sha(" ".join(map(str, x))) for x in ids], pa.string()), pa.array(map(_sha, decoded), pa.string())]
                names = ["ids_sha256", "decoded_sha256"]
            else:
                out, names = [pa.array(ids, pa.list_(pa.int32())), pa.array(decoded, pa.string())], ["ids", "decoded"]
            yield pa.RecordBatch.from_arrays([batch.column(0), sizes, *out], names=["doc_id", "n_tokens", *names])

    return columns.mapInArrow(run, (DIGESTS if digests else SCHEMA).format(id=dict(columns.dtypes)["doc_id"]))
