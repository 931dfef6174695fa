"""Mix sources to target weights with nested hash thresholds; nothing is sorted but buckets' sums.

Every row has a fixed hash of its id. A source whose target is at most its size keeps the rows with the smallest hashes,
just enough of them; one whose target is larger keeps all rows once and repeats the rows with the smallest hashes. The
threshold is found from histograms: words are summed per source and hash bucket, running sums tell the bucket in which
the target is met, only that bucket's rows are divided again into finer buckets, and the last, finest bucket is resolved
hash by hash. Thresholds of larger budgets contain those of smaller ones, and reruns take the same rows.

Sources are ordered by code point, null last, and weigh ``weights`` in turn. Targets share ``share`` of all words by
weight, stop at ``repeats`` times the source's size, and the excess is shared again by weight until none is above. The
words taken differ from the target by half of the row at the threshold at most. Where the threshold falls on rows of the same
hash (repeated or null ids), a hash of their texts divides them in the same way; only rows equal in id and text are taken
together. Null texts have size 0, as have empty ones; they are taken 0 words. A null id has a hash of its own. An
empty table gives an empty result; a corpus without words has targets 0. Other columns than id, text and source are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from arealis.llm.text import filled, quoted, small_enough
from arealis.session import stored

WEIGHTS = (5.0, 2.0, 1.0)
SHARE = 1.5
REPEATS = 2
#: Bits of the hash that one histogram resolves, and the number of histograms.
BITS, LEVELS, HASH_BITS = 12, 2, 60


def row_hash(doc_id: Column, seed: str = "mix") -> Column:
    """60 bits of MD5 over seed and id."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("null"))).cast("binary"))
    return F.conv(F.substring(digest, 1, HASH_BITS // 4), 16, 10).cast("long")


def text_hash(text: Column, seed: str = "mix") -> Column:
    """60 bits of MD5 over seed and text, which part rows of the same id."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), text).cast("binary"))
    return F.conv(F.substring(digest, 1, HASH_BITS // 4), 16, 10).cast("long")


def n_words(text: Column) -> Column:
    """Words, counted as the places where white space, or the start, is followed by something else."""
    return F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]++")).cast("long")


def source_targets(
    sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, repeats: float = REPEATS
) -> DataFrame:
    """Target words of each source (s_null, s_key, source_size).

    Sources are numbered by a range-partitioned sort, and each round of sharing is one aggregate over the sources; a round
    caps at least one more source, in practice a handful of rounds end it.
    """
    spark = sizes.sparkSession
    ordered = sizes.repartitionByRange("s_null", "s_key").sortWithinPartitions("s_null", "s_key")
    numbered = ordered.rdd.zipWithIndex().map(lambda x: (*x[0], x[1]))
    numbered = spark.createDataFrame(numbered, "s_null boolean, s_key string, source_size long, place long")
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("place") % len(weights) + 1).cast("int"))
    sources = stored(
        numbered.withColumn("weight", weight).withColumn("cap", F.col("source_size") * F.lit(float(repeats))), "mix-sources"
    )
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    rate, capped = None, -1
    while True:
        full = F.lit(False) if rate is None else F.col("weight") * rate >= F.col("cap")
        room = sources.agg(
            F.sum(F.when(full, F.col("cap"))).alias("cap"), F.sum(F.when(~full, F.col("weight"))).alias("weight"),
            F.count_if(full).alias("capped"),
        ).first()
        if room.capped == capped or not room.weight:
            break
        rate, capped = (share * total - (room.cap or 0.0)) / room.weight, room.capped
    open_target = F.lit(0.0) if rate is None else F.col("weight") * rate
    return sources.select("s_null", "s_key", "source_size", F.least("cap", open_target).alias("target"))


def _keyed(rows: DataFrame, keys: DataFrame) -> DataFrame:
    """Join rows with a stored table of one row per source."""
    return rows.join(F.broadcast(keys) if small_enough(keys) else keys, ["s_null", "s_key"])


def thresholds(rows: DataFrame, budgets: DataFrame) -> DataFrame:
    """Per source the bounds of what is taken so that its words come nearest to ``budget``: hashes less than ``below``, and of hash
    ``below`` the ties less than ``tie_below`` (null: none).

    ``rows`` holds s_null, s_key, hash, tie, size; ``budgets`` s_null, s_key, budget. Only where several ties share the hash at
    the threshold are these divided, by their ties.
    """
    source = ["s_null", "s_key"]
    start = budgets.select(*source, "budget", F.lit(0).cast("long").alias("before"))
    found = stored(_edge(rows, start, "hash"), "mix-edge")
    single = found.filter("ties = 1").select(*source, _bound("value").alias("below"), F.lit(None).cast("long").alias("tie_below"))
    shared = found.filter("ties > 1")
    if shared.isEmpty():
        return single
    at = shared.select(*source, F.col("value").alias("hash"), "budget", F.col("sum_before").alias("before"))
    inside = _keyed(rows, at.select(*source, F.col("hash").alias("at"))).filter(F.col("hash") == F.col("at")).drop("at")
    tied = _edge(inside, at.select(*source, "budget", "before"), "tie")
    tied = tied.select(*source, _bound("value").alias("tie_below"))
    return single.unionByName(at.join(tied, source).select(*source, F.col("hash").alias("below"), "tie_below"))


def _bound(value: str) -> Column:
    """The exclusive bound that leaves the words nearest to the budget."""
    nearer = F.col("budget") - F.col("sum_before") < F.col("sum_before") + F.col("size") - F.col("budget")
    return F.when(nearer, F.col(value)).otherwise(F.col(value) + 1)


def _edge(rows: DataFrame, budgets: DataFrame, by: str) -> DataFrame:
    """Per source the value of ``by`` at which the running sum passes the budget, with its words, those before and its ties.

    Level by level the bucket where the running sum passes the budget is kept as (prefix, words before it).
    """
    source = ["s_null", "s_key"]
    edge = stored(budgets.select(*source, "budget", F.lit(0).cast("long").alias("prefix"), "before"), "mix-edge")
    for level in range(1, LEVELS + 1):
        shift = HASH_BITS - BITS * level
        inside = _keyed(rows, edge).filter(F.shiftright(by, shift + BITS) == F.col("prefix"))
        counts = inside.groupBy(*source, "budget", "before", F.shiftright(by, shift).alias("bucket")).agg(F.sum("size").alias("size"))
        edge = stored(_passing(counts, "bucket").select(*source, "budget", F.col("bucket").alias("prefix"), F.col("sum_before").alias("before")), "mix-edge")
    rest = HASH_BITS - BITS * LEVELS
    inside = _keyed(rows, edge).filter(F.shiftright(by, rest) == F.col("prefix"))
    value = F.col(by).alias("value")
    counts = inside.groupBy(*source, "budget", "before", value).agg(
        F.sum("size").alias("size"), F.when(F.min("tie") == F.max("tie"), 1).otherwise(2).alias("ties")
    )
    return _passing(counts, "value", "ties")


def _passing(counts: DataFrame, bucket: str, *others: str) -> DataFrame:
    """The first bucket of each source whose running sum reaches the budget (its last bucket if none does)."""
    by_source = Window.partitionBy("s_null", "s_key").orderBy(bucket)
    running = counts.withColumn("running", F.sum("size").over(by_source) + F.col("before"))
    reached = (F.col("running") >= F.col("budget")) | F.lead(bucket).over(by_source).isNull()
    first = running.withColumn("reached", reached).filter("reached").groupBy("s_null", "s_key").agg(
        F.min(F.struct(bucket, "budget", "size", *others, (F.col("running") - F.col("size")).alias("sum_before"))).alias("first")
    )
    return first.select("s_null", "s_key", "first.*")


def _source_keys(source: str) -> list[Column]:
    return [quoted(source).isNull().alias("s_null"), F.coalesce(quoted(source).cast("string"), F.lit("")).alias("s_key")]


def _planned(
    docs: DataFrame, doc_id: str, text: str, source: str, weights: tuple[float, ...], share: float, repeats: float
) -> tuple[DataFrame, DataFrame]:
    """The stored sizes and hashes of the rows, and per source its target, whole passes and threshold."""
    rows = stored(
        docs.select(
            quoted(doc_id).alias("doc_id"), *_source_keys(source),
            row_hash(quoted(doc_id)).alias("hash"), text_hash(filled(text)).alias("tie"), n_words(filled(text)).alias("size"),
        ),
        "mix-rows",
    )
    sizes = rows.groupBy("s_null", "s_key").agg(F.sum("size").alias("source_size"))
    targets = stored(source_targets(sizes, weights, share, repeats), "mix-targets")
    # whole passes over the source, then the part of one more pass
    passes = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    plan = targets.withColumn("passes", passes)
    budgets = plan.withColumn("budget", F.col("target") - F.col("passes") * F.col("source_size"))
    limits = thresholds(rows.filter("size > 0"), budgets.filter("budget > 0").select("s_null", "s_key", "budget"))
    return rows, stored(plan.join(limits, ["s_null", "s_key"], "left"), "mix-plan")


def _copies() -> Column:
    taken = (F.col("hash") < F.col("below")) | (F.col("hash") == F.col("below")) & (F.col("tie") < F.col("tie_below"))
    return (F.col("passes") + F.when(taken, F.lit(1)).otherwise(F.lit(0))).cast("int")


def mix(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source",
    weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, repeats: float = REPEATS,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, size, source_size, target, taken (words, repeats counted)."""
    rows, plan = _planned(docs, doc_id, text, source, weights, share, repeats)
    return _keyed(rows, plan).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * _copies()).cast("long").alias("taken")
    )


def mixed_rows(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source",
    weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, repeats: float = REPEATS,
) -> DataFrame:
    """The rows of ``docs`` with all their columns, each as often as the mix takes it. Rows without words go."""
    _, plan = _planned(docs, doc_id, text, source, weights, share, repeats)
    whole = F.struct(*[quoted(c) for c in docs.columns]).alias("whole")
    has_words = filled(text).rlike(r"[^\x20\x09-\x0D]")
    rows = docs.filter(has_words).select(whole, *_source_keys(source), row_hash(quoted(doc_id)).alias("hash"), text_hash(filled(text)).alias("tie"))
    taken = _keyed(rows, plan).withColumn("copies", _copies())
    return taken.select("whole", F.explode(F.array_repeat(F.lit(True), F.col("copies")))).select("whole.*")
