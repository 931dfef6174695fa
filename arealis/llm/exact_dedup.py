"""Exact deduplication by salted groups of whole contents, in DataFrame operations only.

Texts are equal when they are identical after white space is deleted. Digests only find candidates; what decides is
the content, which is a grouping key of every stage:

1. local: map-side aggregation merges equal contents of a task before anything is shuffled;
2. salted: contents are merged per (digest, salt), so a group of any size is spread over ``salts`` tasks;
3. global: at most ``salts`` winners of a content meet and are merged.

Of a group the row with the most code points in its original text stays, then the smallest id (null last). Rows that
agree in both are repetitions of one row: the first one stored stays.

Null texts count as empty; all empty texts are one group. An empty table gives an empty result. Columns other than id and
text are not read. A digest shared by different contents is handled by joining those rows by content.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arealis.llm.text import SPACE, filled, only_kept, quoted, small_enough
from arealis.session import stored

SALTS = 64


def normalized(text: Column) -> Column:
    return F.regexp_replace(text, f"{SPACE}+", "")


def _marked(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """Id, code points, content and its digest of every row."""
    rows = docs.select(quoted(doc_id).alias("doc_id"), filled(text).alias("raw"))
    rows = rows.select("doc_id", F.length("raw").cast("long").alias("n_chars"), normalized(F.col("raw")).alias("content"))
    return rows.withColumn("digest", F.unhex(F.sha2("content", 256)))


def _matching(rows: DataFrame, keys: DataFrame, how: str, on: list[str]) -> DataFrame:
    """Join with a stored key table, which is broadcast where its size allows."""
    return rows.join(F.broadcast(keys) if small_enough(keys) else keys, on, how)


def _best() -> Column:
    # bitwise not turns the smallest id into the largest; null stays the lowest
    return F.max(F.struct("n_chars", F.bitwise_not("doc_id").alias("rev_id")))


def content_groups(rows: DataFrame, salts: int = SALTS) -> DataFrame:
    """One row per content of ``rows`` (doc_id, n_chars, content, digest): its winner and its number of rows."""
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("doc_id", "n_chars"), F.lit(salts)))
    local = salted.groupBy("digest", "salt", "content").agg(_best().alias("best"), F.count("*").alias("n"))
    merged = local.groupBy("digest", "content").agg(F.max("best").alias("best"), F.sum("n").alias("group_size"))
    return merged.select(
        "digest", "content", F.bitwise_not("best.rev_id").alias("keep_id"),
        F.col("best.n_chars").alias("keep_chars"), "group_size",
    )


def exact_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", salts: int = SALTS) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256, n_chars."""
    marked = _marked(docs, doc_id, text)
    slim = stored(marked.select(F.monotonically_increasing_id().alias("row"), "doc_id", "n_chars", "digest"), "dedup-rows")
    repeated = stored(slim.groupBy("digest").count().filter("count > 1").select("digest"), "dedup-digests")
    groups = content_groups(_matching(marked, repeated, "left_semi", ["digest"]), salts)
    groups = groups.withColumn("content", F.col("content").cast("binary"))
    per_digest = groups.groupBy("digest").agg(
        F.count("*").alias("contents"), F.first("keep_id").alias("keep_id"),
        F.first("keep_chars").alias("keep_chars"), F.first("group_size").alias("group_size"),
    )
    winners = stored(per_digest, "dedup-winners")
    clashing = stored(winners.filter("contents > 1").select("digest"), "dedup-clashes")

    first_rows = slim.groupBy("digest", "n_chars", "doc_id").agg(F.min("row").alias("keep_row"))
    w, f = winners.filter("contents = 1").alias("w"), first_rows.alias("f")
    chosen = w.join(
        f,
        (F.col("w.digest") == F.col("f.digest"))
        & (F.col("w.keep_chars") == F.col("f.n_chars"))
        & F.col("w.keep_id").eqNullSafe(F.col("f.doc_id")),
    ).select("w.digest", "w.keep_id", "w.group_size", "f.keep_row")
    result = slim.join(chosen, "digest", "left").select(
        "doc_id",
        F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        (F.col("group_size").isNull() | (F.col("row") == F.col("keep_row"))).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
        "n_chars",
        "digest",
    )
    if not clashing.isEmpty():
        result = result.join(clashing, "digest", "left_anti").unionByName(_by_content(marked, clashing, salts))
    return result.drop("digest")


def _by_content(marked: DataFrame, digests: DataFrame, salts: int) -> DataFrame:
    """The same result for rows whose digest stands for several contents."""
    rows = stored(
        marked.join(digests, "digest", "left_semi").withColumn("row", F.monotonically_increasing_id()), "dedup-clash-rows"
    )
    groups = content_groups(rows, salts)
    first_rows = rows.groupBy("digest", "content", "n_chars", "doc_id").agg(F.min("row").alias("keep_row"))
    g, f = groups.alias("g"), first_rows.alias("f")
    chosen = g.join(
        f,
        (F.col("g.digest") == F.col("f.digest"))
        & (F.col("g.content") == F.col("f.content"))
        & (F.col("g.keep_chars") == F.col("f.n_chars"))
        & F.col("g.keep_id").eqNullSafe(F.col("f.doc_id")),
    ).select("g.digest", "g.content", "g.keep_id", "g.group_size", "f.keep_row")
    return rows.join(chosen, ["digest", "content"]).select(
        "doc_id", "keep_id", "group_size", (F.col("row") == F.col("keep_row")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"), "n_chars", "digest",
    )


def without_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", salts: int = SALTS) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns; repetitions of a staying row go as well.

    Dropped rows are found by id, digest and length, so only these few columns of the dropped rows are joined.
    """
    found = exact_duplicates(docs, doc_id, text, salts)
    per_key = found.groupBy("doc_id", "text_sha256", "n_chars").agg(F.max("kept").alias("kept"), F.count("*").alias("n"))
    keys = {
        "doc_id": quoted(doc_id), "text_sha256": F.sha2(normalized(filled(text)), 256),
        "n_chars": F.length(filled(text)).cast("long"),
    }
    return only_kept(docs, keys, stored(per_key, "dedup-keys"))
