"""Licence scan by canonical digests, in DataFrame operations only.

A text is normalised once: lower case, lines that state a copyright taken out, equivalent spellings made one, punctuation
and white space between words turned into one space; line ends stay. Its units are the whole text, its paragraphs (parted by empty lines)
and its lines. The SHA-256 of each unit is joined with the digests of the known licences, normalised alike: whole
units are compared, so a text that merely mentions a licence does not match. Of a licence of several paragraphs all must be
found in a text, or the text as a whole must be the licence.

The known table is a fixed list of some thousand digests and is broadcast; the texts are never shuffled, only a narrow row per
text is. A null text counts as empty; empty units match nothing. Repeated rows give repeated results. An empty table gives
an empty result. Columns other than id and text are not read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from arealis.llm.license_texts import LICENSES, SPELLINGS
from arealis.llm.text import filled, quoted

_MARKS = r"[ \t*#/;-]*"
#: A line that states a copyright, at its start after marks: a sign or the word, with a year; the word and a sign; or the word
#: in a short line, where all lines between two empty ones are such lines. A line ends at a line feed, nothing else.
COPYRIGHT_LINE = (
    rf"(?md)^{_MARKS}(?:portions )?(?:(?:copyright|\(c\)|©)[^\n]*[0-9]{{4}}[^\n]*|©[^\n]*|copyright[ :]*(?:\(c\)|©|by )[^\n]*)$"
    rf"|^(?={_MARKS}copyright[ :])(?<![\p{{L}}\p{{N}}][^\p{{L}}\p{{N}}\n]{{0,40}}\n)"
    rf"{_MARKS}copyright[ :][^\n]{{1,100}}(?:\n{_MARKS}copyright[ :][^\n]{{1,100}})*$(?!\n[^\p{{L}}\p{{N}}\n]*[\p{{L}}\p{{N}}])"
)
BETWEEN_WORDS = r"[^\p{L}\p{N}\n]+"
WHOLE, PARAGRAPH, LINE = "whole", "paragraph", "line"


def normalized(text: Column) -> Column:
    """Canonical words with the line ends of the text."""
    lines = F.regexp_replace(F.replace(F.lower(text), F.lit("\r\n"), F.lit("\n")), COPYRIGHT_LINE, "")
    spelled = reduce(lambda c, s: F.replace(c, F.lit(s[0]), F.lit(s[1])), SPELLINGS, lines)
    return F.regexp_replace(spelled, BETWEEN_WORDS, " ")


def _flat(text: Column) -> Column:
    """Line ends as spaces, one space between words."""
    return F.trim(F.regexp_replace(text, r"[ \n]+", " "))


def _digests(units: Column) -> Column:
    return F.transform(F.filter(units, lambda u: u != ""), lambda u: F.unhex(F.sha2(u, 256)))


def _paragraphs(canonical: Column) -> Column:
    return F.transform(F.split(canonical, r"\n[ \n]*\n"), _flat)


def known_licenses(spark: SparkSession, licenses: list[tuple[str, str]] = LICENSES) -> DataFrame:
    """Digest of each unit of the known texts: name, part (0: the whole text), parts."""
    texts = spark.createDataFrame(licenses, "name string, text string").withColumn("canonical", normalized(F.col("text")))
    whole = texts.select("name", F.array(_flat(F.col("canonical"))).alias("units"), F.lit(0).alias("first"))
    parts = texts.select("name", _paragraphs(F.col("canonical")).alias("units"), F.lit(1).alias("first")).filter(F.size("units") > 1)
    units = whole.unionByName(parts).select("name", "first", F.size("units").alias("parts"), F.posexplode("units").alias("at", "unit"))
    return units.select("name", (F.col("at") + F.col("first")).alias("part"), "parts", F.unhex(F.sha2("unit", 256)).alias("digest"))


def licenses(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", known: DataFrame | None = None) -> DataFrame:
    """One row per row of ``docs``: doc_id, license (of the text as a whole, else null), found (names by code point, joined by
    commas), n_units (paragraphs and lines that are a known unit)."""
    given, known = known, known_licenses(docs.sparkSession) if known is None else known
    rows = docs.select(F.monotonically_increasing_id().alias("row"), quoted(doc_id).alias("doc_id"), normalized(filled(text)).alias("canonical"))
    kinds = F.map_from_arrays(
        F.array(F.lit(WHOLE), F.lit(PARAGRAPH), F.lit(LINE)),
        F.array(
            _digests(F.array(_flat(F.col("canonical")))), _digests(_paragraphs(F.col("canonical"))),
            _digests(F.transform(F.split("canonical", "\n"), lambda u: F.trim(u))),
        ),
    )
    by_digest = known.groupBy("digest").agg(F.collect_set(F.struct("name", "part", "parts")).alias("of"))
    units = rows.select("row", "doc_id", F.explode(kinds).alias("kind", "digests"))
    units = units.select("row", "doc_id", "kind", F.explode_outer("digests").alias("digest"))
    # the built-in table is a fixed list; how a caller's own is joined is left to Spark
    matched = units.join(F.broadcast(by_digest) if given is None else by_digest, "digest", "left")
    hit = F.col("of").isNotNull()
    whole = F.array_min(F.transform(F.filter("of", lambda o: o["part"] == 0), lambda o: o["name"]))
    per_row = matched.groupBy("row", "doc_id").agg(
        F.min(F.when(F.col("kind") == WHOLE, whole)).alias("license"),
        F.array_distinct(F.flatten(F.collect_set("of"))).alias("hits"), F.count_if(hit & (F.col("kind") != WHOLE)).alias("n_units"),
    )
    texts = F.array_distinct(F.transform("hits", lambda h: F.struct(h["name"], h["parts"], (h["part"] == 0).alias("whole"))))
    complete = F.filter(texts, lambda t: t["whole"] | (
        F.size(F.filter("hits", lambda o: (o["name"] == t["name"]) & (o["parts"] == t["parts"]) & (o["part"] > 0))) == t["parts"]
    ))
    names = F.array_sort(F.array_distinct(F.transform(complete, lambda t: t["name"])))
    return per_row.select("doc_id", "license", F.array_join(names, ",").alias("found"), "n_units")
