"""Fill-in-middle transformation: a text is cut into prefix, middle and suffix between lines, and its parts change places.

``regexp_count`` gives the number n of units (lines with their end). Hashes of seed and id draw two cuts a <= b. One match of a
pattern of the row's own captures the parts: ``unit{a}`` and ``unit{b-a}``, both possessive, and the rest. Possessive counted groups
are matched in a loop, neither by recursion nor with a way back, so texts may have any number of lines. Everything runs in
built-in functions.

Outputs: plain, the text; psm, ``<P>`` prefix ``<S>`` suffix ``<M>`` middle; spm, ``<S>`` suffix ``<P>`` prefix ``<M>`` middle. A text that is
empty or contains a mark stays plain, so an output can always be read back (``restored``).

A null text counts as empty; a null id draws as the word null. Repeated rows are each transformed, rows of equal id alike. An
empty table gives an empty result. Of other columns the result has those asked for by ``carried``.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arealis.llm.text import filled, quoted

UNIT = r"[^\n]*+\n|[^\n]++"
MARKS = ("<P>", "<S>", "<M>")
SEED = 7


def draws(doc_id: Column, seed: int = SEED) -> list[Column]:
    """Four unsigned 32-bit numbers from the SHA-256 of seed and id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("null"))).cast("binary"), 256)
    return [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long") for k in range(4)]


def _literal(mark: str) -> str:
    """A mark inside a replacement, where $ and \\ have a meaning."""
    return re.sub(r"([\\$])", r"\\\1", mark)


def _order(form: str, marks: tuple[str, str, str]) -> list[tuple[str, int]]:
    """Marks and the numbers of their parts (1 prefix, 2 middle, 3 suffix) in the order of an output."""
    before, after, inner = zip(marks, (1, 3, 2), strict=True)
    return [before, after, inner] if form == "psm" else [after, before, inner]


def fill_in_middle(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", unit: str = UNIT, marks: tuple[str, str, str] = MARKS,
    seed: int = SEED, percent: int = 100, percent_spm: int = 50, carried: tuple[str, ...] = (),
) -> DataFrame:
    """doc_id, n, form (plain, spm, psm), output, prefix_chars, middle_chars (code points; null if plain), carried columns.

    ``percent`` of the texts that can be cut are, ``percent_spm`` of those begin with their suffix.
    """
    given = docs.select(quoted(doc_id).alias("doc_id"), filled(text).alias("text"), *[quoted(c).alias(f"_c_{k}") for k, c in enumerate(carried)])
    h1, h2, h3, h4 = draws(F.col("doc_id"), seed)
    n = F.regexp_count("text", F.lit(unit)).cast("long")
    marked = F.lit(False)
    for m in marks:
        marked = marked | F.contains("text", F.lit(m))
    form = F.when((F.col("text") == "") | marked | (h3 % 100 >= percent), "plain").when(h4 % 100 < percent_spm, "spm").otherwise("psm")
    cut = given.withColumns({"n": n, "form": form}).withColumns({"first": h1 % (F.col("n") + 1), "second": h2 % (F.col("n") + 1)})
    a, b = F.least("first", "second"), F.greatest("first", "second")
    group = [F.lit(rf"\A((?:{unit}){{"), a.cast("string"), F.lit(rf"}}+)((?:{unit}){{"), (b - a).cast("string"), F.lit(r"}+)((?s:.*))\z")]
    parts = {f: "".join(f"{_literal(m)}${k}" for m, k in _order(f, marks)) for f in ("psm", "spm")}
    order = F.when(F.col("form") == "psm", parts["psm"]).otherwise(parts["spm"])
    output = F.when(F.col("form") == "plain", F.col("text")).otherwise(F.regexp_replace("text", F.concat(*group), order))
    made = cut.withColumn("output", output)

    def chars(mark: str, end: Column) -> Column:
        """Code points between a mark and ``end``; marks stand once each, as no text with a mark is cut."""
        return (end - F.instr("output", mark) - len(mark)).cast("long")

    end, whole = (lambda mark: F.instr("output", mark)), F.char_length("output") + 1
    prefix = F.when(F.col("form") == "psm", chars(marks[0], end(marks[1]))).when(F.col("form") == "spm", chars(marks[0], end(marks[2])))
    middle = F.when(F.col("form") != "plain", chars(marks[2], whole))
    return made.select(
        "doc_id", "n", "form", "output", prefix.alias("prefix_chars"), middle.alias("middle_chars"), *[F.col(f"_c_{k}").alias(c) for k, c in enumerate(carried)]
    )


def restored(output: Column, form: Column, marks: tuple[str, str, str] = MARKS) -> Column:
    """The text an output was made of."""
    text = output
    for f in ("psm", "spm"):
        order = _order(f, marks)
        place = {part: k + 1 for k, (_, part) in enumerate(order)}
        pattern = r"(?s)\A" + "".join(rf"\Q{m}\E(.*{'?' if k < 2 else ''})" for k, (m, _) in enumerate(order)) + r"\z"
        text = F.when(form == f, F.regexp_replace(output, F.lit(pattern), F.lit("".join(f"${place[p]}" for p in (1, 2, 3))))).otherwise(text)
    return text
