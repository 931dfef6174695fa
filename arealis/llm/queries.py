"""Queries over the supplied tables, one per operator, and their DuckDB SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arealis.llm import fill_middle, quality_trees, toxicity, vector_codes
from arealis.llm.bpe import encoded
from arealis.llm.exact_dedup import exact_duplicates
from arealis.llm.exact_topk import top_k
from arealis.llm.html_text import extracted
from arealis.llm.license_scan import licenses
from arealis.llm.license_texts import LICENSES, SPELLINGS
from arealis.llm.mixing import mix
from arealis.llm.near_join import near_duplicates
from arealis.llm.repetition import repetition_rules
from arealis.llm.secret_scan import secrets
from arealis.llm.text import table

#: Tokenizer file of the encoding queries, one of the installed public ones.
VOCABULARY = "word_bpe_49k.json"


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_repetition(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repetition_rules(table(spark, sf_dir, "documents")).drop("spans")


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.scored(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = mix(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "size", "source_size", "target", "taken")


def op3_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extracted(table(spark, sf_dir, "pages"))


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encoded(table(spark, sf_dir, "documents"), vocabulary_path(), digests=True)


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets(table(spark, sf_dir, "documents"))


def op7_near_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents")).drop("digest")


def op8_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses(table(spark, sf_dir, "documents"))


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality_trees.scored(docs, quality_trees.train(docs, table(spark, sf_dir, "labels")))


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.compressed(table(spark, sf_dir, "embeddings")).drop("label")


def op12_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fill_middle.fill_in_middle(table(spark, sf_dir, "documents"))
    digests = {"output_sha256": F.col("output"), "restored_sha256": fill_middle.restored(F.col("output"), F.col("form"))}
    return made.withColumns({k: F.sha2(c.cast("binary"), 256) for k, c in digests.items()}).drop("output")


def op13_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_repetition": op1_repetition,
    "op2_toxicity": op2_toxicity,
    "op3_html_text": op3_html_text,
    "op4_mixing": op4_mixing,
    "op5_bpe": op5_bpe,
    "op6_secrets": op6_secrets,
    "op7_near_join": op7_near_join,
    "op8_licenses": op8_licenses,
    "op9_exact_dedup": op9_exact_dedup,
    "op10_quality": op10_quality,
    "op11_vector_codes": op11_vector_codes,
    "op12_fill_middle": op12_fill_middle,
    "op13_topk": op13_topk,
}


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _canonical_ctes(name: str, source: str) -> str:
    """Normalisation of the licence scan in DuckDB: ``name`` has the columns ``id`` and ``c`` for those of ``source``, ``id`` and ``text``.

    Line by line where the operator has one pattern: a line goes if it states a copyright by itself, or if it belongs to a block of
    short copyright lines between lines without words whose first one does not.
    """
    marks = r"[ \t*#/;-]*"
    own = rf"^{marks}(?:portions )?(?:(?:copyright|\(c\)|©).*[0-9]{{4}}.*|©.*|copyright[ :]*(?:\(c\)|©|by ).*)$"
    spelled = "string_agg(CASE WHEN own OR gone THEN '' ELSE line END, chr(10) ORDER BY i)"
    for old, new in SPELLINGS:
        spelled = f"replace({spelled}, {_quoted(old)}, {_quoted(new)})"
    return rf"""
        {name}_lines AS (
            SELECT id, unnest(ls) AS line, generate_subscripts(ls, 1) AS i
            FROM (SELECT id, string_split(replace(lower(text), chr(13) || chr(10), chr(10)), chr(10)) AS ls FROM {source})),
        {name}_kinds AS (
            SELECT *, regexp_matches(line, {_quoted(own)}) AS own, regexp_matches(line, '^{marks}copyright[ :].{{1,100}}$') AS short,
                   regexp_matches(line, '[\p{{L}}\p{{N}}]') AS word, regexp_matches(line, '[\p{{L}}\p{{N}}][^\p{{L}}\p{{N}}]{{0,40}}$') AS tail
            FROM {name}_lines),
        {name}_runs AS (
            SELECT *, sum(CASE WHEN short THEN 0 ELSE 1 END) OVER w AS run, lag(tail) OVER w AS before, lead(word) OVER w AS behind
            FROM {name}_kinds WINDOW w AS (PARTITION BY id ORDER BY i)),
        {name}_blocks AS (
            SELECT id, run, NOT coalesce(arg_min(struct_pack(b := before), i).b, FALSE) AND NOT arg_min(own, i)
                   AND NOT coalesce(arg_max(struct_pack(b := behind), i).b, FALSE) AS gone
            FROM {name}_runs WHERE short GROUP BY ALL),
        {name} AS (
            SELECT id, regexp_replace({spelled}, '[^\p{{L}}\p{{N}}\n]+', ' ', 'g') AS c
            FROM (SELECT r.*, r.short AND coalesce(b.gone, FALSE) AS gone FROM {name}_runs r LEFT JOIN {name}_blocks b USING (id, run)) GROUP BY id)"""


def _licenses_sql() -> str:
    flat = r"trim(regexp_replace({}, '[ \n]+', ' ', 'g'))"
    paragraphs = r"list_transform(regexp_split_to_array(c, '\n[ \n]*\n'), lambda u: {})".format(flat.format("u"))
    known = ", ".join(f"({i}, {_quoted(name)}, {_quoted(text)})" for i, (name, text) in enumerate(LICENSES))
    return rf"""
        WITH listed(id, name, text) AS (VALUES {known}), {_canonical_ctes("k_text", "listed")},
        k AS (SELECT name, c FROM listed JOIN k_text USING (id)),
        parts AS (SELECT name, {paragraphs} AS units FROM k),
        known AS MATERIALIZED (
            SELECT name, 0 AS part, 1 AS parts, {flat.format("c")} AS unit FROM k
            UNION ALL SELECT name, generate_subscripts(units, 1) AS part, len(units) AS parts, unnest(units) AS unit
            FROM parts WHERE len(units) > 1),
        numbered AS MATERIALIZED (SELECT row_number() OVER () AS id, doc_id, coalesce(text, '') AS text FROM documents),
        {_canonical_ctes("d_text", "numbered")},
        d AS MATERIALIZED (SELECT id AS row, doc_id, c FROM numbered JOIN d_text USING (id)),
        units AS (
            SELECT row, 'whole' AS kind, {flat.format("c")} AS unit FROM d
            UNION ALL SELECT row, 'paragraph', unnest({paragraphs}) FROM d
            UNION ALL SELECT row, 'line', trim(unnest(string_split(c, chr(10)))) FROM d),
        hits AS (SELECT row, kind, name, part, parts FROM units JOIN known USING (unit) WHERE unit <> ''),
        whole AS (SELECT row, min(name) AS license FROM hits WHERE kind = 'whole' AND part = 0 GROUP BY row),
        complete AS (
            SELECT row, name FROM hits GROUP BY row, name, parts, (part = 0)
            HAVING (part = 0) OR count(DISTINCT part) = parts),
        names AS (SELECT row, string_agg(DISTINCT name, ',' ORDER BY name) AS found FROM complete GROUP BY row),
        n AS (SELECT row, count(*) AS n_units FROM units WHERE kind <> 'whole' AND unit <> '' AND unit IN (SELECT unit FROM known) GROUP BY row)
        SELECT doc_id, license, coalesce(found, '') AS found, coalesce(n_units, 0) AS n_units
        FROM d LEFT JOIN whole USING (row) LEFT JOIN names USING (row) LEFT JOIN n USING (row)
    """


def _codes_sql() -> str:
    def nearest(name: str, books: str) -> str:
        """For each part its nearest entry: (squared distance, index)."""
        return f"""
        {name} AS (
            SELECT r, p, min(struct_pack(gap := list_sum(list_transform(range(1, w + 1), lambda i: (x[i] - c[i]) * (x[i] - c[i])))::BIGINT, e := e))
                       AS best
            FROM parts JOIN {books} USING (p) GROUP BY r, p)"""

    def moved(name: str, books: str, found: str) -> str:
        return f"""
        {name}_sums AS (
            SELECT p, best.e AS e, i, sum(x[i])::BIGINT AS s, count(*) AS n
            FROM {found} JOIN parts USING (r, p), range(1, 1000) AS t(i) WHERE i <= w GROUP BY p, best.e, i),
        {name}_lists AS (SELECT p, e, list((s - ((s % n) + n) % n) // n ORDER BY i) AS c FROM {name}_sums GROUP BY p, e),
        {name} AS (SELECT b.p, b.e, coalesce(l.c, b.c) AS c FROM {books} b LEFT JOIN {name}_lists l ON b.p = l.p AND b.e = l.e)"""

    steps = ",".join([
        nearest("found0", "books0"), moved("books1", "books0", "found0"),
        nearest("found1", "books1"), moved("books2", "books1", "found1"), nearest("found2", "books2"),
    ])
    return f"""
        WITH v AS MATERIALIZED (
            SELECT row_number() OVER (ORDER BY vec_id) AS r, vec_id, label,
                   list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS x, len(embedding) // 16 AS w
            FROM embeddings WHERE len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        parts AS MATERIALIZED (SELECT r, p, w, x[p * w + 1 : p * w + w] AS x FROM v, range(16) AS t(p)),
        books0 AS (SELECT p, r - 1 AS e, x AS c FROM parts WHERE r <= 64), {steps},
        coded AS (
            SELECT r, string_agg(printf('%02x', best.e), '' ORDER BY p) AS code, sum(best.gap)::BIGINT AS error
            FROM found2 GROUP BY r),
        books AS (
            SELECT sha256(string_agg(c[i]::VARCHAR, ',' ORDER BY p, e, i)) AS codebooks_sha256
            FROM books2, range(1, 1000) AS t(i) WHERE i <= len(c))
        SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error, codebooks_sha256
        FROM coded JOIN v USING (r), books
    """


ORACLE: dict[str, str] = {
    "op4_mixing": r"""
        WITH d AS (
            SELECT doc_id, source, ('0x' || substr(md5('mix:' || coalesce(doc_id::VARCHAR, 'null')), 1, 15))::BIGINT AS h,
                   len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size
            FROM documents),
        s AS (
            SELECT source, sum(size)::BIGINT AS source_size, sum(size)::DOUBLE * 2 AS cap,
                   [5.0, 2.0, 1.0][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1]::DOUBLE AS w
            FROM d GROUP BY source),
        c AS (
            SELECT *, cap / w AS ratio, coalesce(sum(cap) OVER before, 0) AS cap_before, sum(w) OVER (ORDER BY cap / w, source
                ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS w_left,
                row_number() OVER (ORDER BY cap / w, source) AS k
            FROM s WINDOW before AS (ORDER BY cap / w, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
        rate AS (
            SELECT coalesce(
                (SELECT ((SELECT 1.5 * sum(size)::DOUBLE FROM d) - cap_before) / w_left FROM c
                 WHERE ((SELECT 1.5 * sum(size)::DOUBLE FROM d) - cap_before) / w_left < ratio ORDER BY k LIMIT 1),
                'inf'::DOUBLE) AS rate),
        t AS (
            SELECT source, source_size, least(cap, w * rate) AS target,
                   CASE WHEN source_size > 0 THEN floor(least(cap, w * rate) / source_size)::BIGINT ELSE 0 END AS passes
            FROM c, rate),
        hashes AS (
            SELECT source, h, sum(size) AS size, sum(sum(size)) OVER (PARTITION BY source ORDER BY h) AS running
            FROM d WHERE size > 0 GROUP BY source, h),
        edge AS (
            SELECT t.source, arg_min(CASE WHEN target - passes * source_size - (running - size)
                        < running - (target - passes * source_size) THEN h ELSE h + 1 END, h) AS below
            FROM hashes JOIN t ON hashes.source IS NOT DISTINCT FROM t.source
            WHERE target - passes * source_size > 0 AND running >= target - passes * source_size GROUP BY t.source)
        SELECT d.doc_id, d.size, t.source_size, t.target,
               d.size * (t.passes + CASE WHEN d.h < edge.below THEN 1 ELSE 0 END)::BIGINT AS taken
        FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source LEFT JOIN edge ON d.source IS NOT DISTINCT FROM edge.source
    """,
    "op9_exact_dedup": r"""
        WITH d AS (
            SELECT doc_id, length(coalesce(text, '')) AS n,
                   sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g')) AS h
            FROM documents)
        SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY h) AS group_size,
               row_number() OVER w = 1 AS kept, h AS text_sha256
        FROM d WINDOW w AS (PARTITION BY h ORDER BY n DESC, doc_id)
    """,
    "op8_licenses": _licenses_sql(),
    "op11_vector_codes": _codes_sql(),
    "op12_fill_middle": r"""
        WITH d AS (
            SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS units,
                   sha256('7:' || coalesce(doc_id::VARCHAR, 'null')) AS h
            FROM documents),
        h AS (SELECT *, len(units) AS n, list_transform(range(4), lambda k: ('0x' || substr(h, 8 * k + 1, 8))::BIGINT) AS h4 FROM d),
        cuts AS (
            SELECT *, least(h4[1] % (n + 1), h4[2] % (n + 1)) AS a, greatest(h4[1] % (n + 1), h4[2] % (n + 1)) AS b,
                   CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h4[3] % 100 >= 100
                        THEN 'plain' WHEN h4[4] % 100 < 50 THEN 'spm' ELSE 'psm' END AS form
            FROM h),
        parts AS (
            SELECT *, array_to_string(units[1:a], '') AS prefix, array_to_string(units[a + 1 : b], '') AS middle,
                   array_to_string(units[b + 1 :], '') AS suffix
            FROM cuts)
        SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
               CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
               sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                      ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
               sha256(text) AS restored_sha256
        FROM parts
    """,
    "op13_topk": r"""
        WITH v AS (
            SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS x
            FROM embeddings WHERE len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        scored AS (
            SELECT q.r, q.vec_id AS query_id, c.vec_id, list_inner_product(q.x, c.x)::BIGINT AS score
            FROM v q JOIN v c ON q.r <> c.r WHERE q.vec_id % 20 = 0),
        ranked AS (SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id NULLS LAST)::INTEGER AS rank FROM scored)
        SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20
    """,
}
