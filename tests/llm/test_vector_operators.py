"""Vector codes, exact search and fill-in-middle against plain Python and on odd rows."""

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from arealis.llm import exact_topk, fill_middle, queries, vector_codes, vectors
from arealis.llm.text import table
from pyspark.sql import functions as F

VECTORS = "vec_id long, embedding array<float>, label int"
CLASHES = "row dims packed code error same label_error rank score cell own other is_query q_row vector a.b".split()
NAN, INF = float("nan"), float("inf")


def made(n, width=32, seed=1, scale=1.0):
    draw = np.random.default_rng(seed)
    return [(int(i), [float(np.float32(v)) for v in draw.normal(0, scale / 8, width)], int(i) % 3) for i in draw.permutation(n)]


def odd_rows():
    rows = made(90)
    rows += [(200, None, 1), (201, [None] * 32, 1), (202, [NAN] + [0.0] * 31, 1), (203, [0.1, INF] + [0.0] * 30, None)]
    rows += [(None, rows[3][1], None), (None, rows[3][1], 2), (40, rows[5][1], None), (40, rows[6][1], 1), (40, rows[6][1], 1)]
    return [*rows, (60, [], 2), (61, [0.5, -0.5], None), (-20, rows[0][1], 0)]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(odd_rows(), VECTORS).repartition(5).select("*", *[F.lit("x").alias(c) for c in CLASHES if c != "label"])


def integers(rows, factor, width):
    """(vec_id, label, components) of the rows that take part."""
    out = []
    for i, v, label in rows:
        if v is not None and all(x is not None and np.isfinite(x) for x in v):
            x = [int(np.floor(float(np.float32(y)) * factor)) for y in v]
            out.append((i, label, x + [0] * (width - len(x))))
    return out


# --- 11 vector codes


def plain_codes(rows, parts=16, entries=64, rounds=2, factor=256, width=32):
    """Rows of the result by loops over Python integers."""
    kept = integers(rows, factor, width)
    w = width // parts
    first = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[2]))[:entries]
    books = [[r[2][p * w : p * w + w] for r in first] for p in range(parts)]

    def nearest(x, p):
        return min((sum((a - b) ** 2 for a, b in zip(x[p * w : p * w + w], c, strict=True)), e) for e, c in enumerate(books[p]))

    for _ in range(rounds):
        found = [[nearest(r[2], p)[1] for p in range(parts)] for r in kept]
        new = []
        for p in range(parts):
            new.append([])
            for e, c in enumerate(books[p]):
                own = [r[2][p * w : p * w + w] for r, f in zip(kept, found, strict=True) if f[p] == e]
                new[p].append([sum(v) // len(own) for v in zip(*own, strict=True)] if own else c)
        books = new
    best = [[nearest(r[2], p) for p in range(parts)] for r in kept]
    errors = [sum(g for g, _ in b) for b in best]
    sums = {label: sum(e for e, r in zip(errors, kept, strict=True) if r[1] == label) for label in {r[1] for r in kept}}
    sha = hashlib.sha256(",".join(str(x) for b in books for c in b for x in c).encode()).hexdigest()
    return sorted(str((r[0], "".join(f"{e:02x}" for _, e in b), g, sums[r[1]], sha)) for r, b, g in zip(kept, best, errors, strict=True))


def result(df, *columns):
    return sorted(str(tuple(r)) for r in df.select(*columns).collect())


CODES = ["vec_id", "code", "error", "label_error", "codebooks_sha256"]


def test_codes_equal_plain_loops(spark, odd):
    assert result(vector_codes.compressed(odd), *CODES) == plain_codes(odd_rows())
    few = odd.filter("vec_id < 20")
    assert result(vector_codes.compressed(few), *CODES) == plain_codes([r for r in odd_rows() if r[0] is not None and r[0] < 20])
    large = [(i, [x * 1e6 for x in v], k) for i, v, k in made(80, seed=3)]  # two limbs a component
    assert result(vector_codes.compressed(spark.createDataFrame(large, VECTORS)), *CODES) == plain_codes(large)


def test_codes_of_nothing(spark, odd):
    for rows in (odd.limit(0), odd.filter("vec_id between 200 and 203")):
        assert vector_codes.compressed(rows).count() == 0
    assert [r.code for r in vector_codes.compressed(odd.filter("size(embedding) = 0")).collect()] == ["00" * 16]
    with pytest.raises(Exception, match="beyond 62 bits"):
        vector_codes.compressed(spark.createDataFrame([(1, [1e30] * 16, 0)], VECTORS)).count()


def test_limb_products_are_exact():
    draw = random.Random(2)
    for bits, size in ((None, 2**20), (None, 2**29), (7, 2**29), (3, 50), (25, 2**29)):
        a = np.array([[draw.randint(-size, size) for _ in range(5)] for _ in range(9)] + [[-size] * 5, [size] * 5, [0] * 5])
        b = np.array([[draw.randint(-size, size) for _ in range(5)] for _ in range(7)] + [[size] * 5, [-size] * 5])
        want = [[sum(int(x) * int(y) for x, y in zip(r, c, strict=True)) for c in b] for r in a]
        assert vector_codes.dots(a, b, bits).tolist() == want
        width = bits or vector_codes.limb_bits(5)
        pieces = vector_codes.limbs(a, width)
        assert (sum(p.astype(np.int64) << (width * k) for k, p in enumerate(pieces)) == a).all()
        assert all(np.abs(p).max() <= 2**width for p in pieces) and (size < 2**width or len(pieces) > 1)
    assert all(w * 2 ** (2 * vector_codes.limb_bits(w)) < 2**53 for w in range(1, 5000))


def test_first_index_wins_ties():
    index, gap = vector_codes.nearest(np.array([[0, 0], [5, 5]]), np.array([[1, 0], [0, 1], [-1, 0], [5, 5], [5, 5]]))
    assert index.tolist() == [0, 3] and gap.tolist() == [1, 0]


def test_packed_vectors_come_back():
    lists = [[0.5, -0.25], [], None, [300.0, -70000.0, 2.0**40], [None], [NAN]]
    parts, counts, values = vectors.floored(pa.array(lists, pa.list_(pa.float64())), 4)
    assert parts.tolist() == [True, True, False, True, False, False] and counts.tolist() == [2, 0, 3]
    packed = vectors.packed_array(counts, values)
    assert vectors.matrix(pa.array(counts), packed, 3).tolist() == [[2, -1, 0], [0, 0, 0], [1200, -280000, 2**42]]
    small = vectors.packed_array(np.array([2]), np.array([127, -128]))
    assert small.to_pylist() == [bytes([127, 128])] and vectors.matrix(pa.array([2]), small, 1).tolist() == [[127]]


# --- 13 exact search


def plain_search(rows, every=20, k=20, factor=64, width=32):
    kept = integers(rows, factor, width)
    out = []
    for a, q in enumerate(kept):
        if q[0] is not None and q[0] % every == 0:
            scored = [(-sum(x * y for x, y in zip(q[2], c[2], strict=True)), c[0] is None, c[0] or 0) for b, c in enumerate(kept) if a != b]
            out += [str((q[0], n + 1, None if none else i, -s)) for n, (s, none, i) in enumerate(sorted(scored)[:k])]
    return sorted(out)


FOUND = ["query_id", "rank", "vec_id", "score"]


def test_search_equals_plain_loops(spark, odd):
    assert result(exact_topk.top_k(odd), *FOUND) == plain_search(odd_rows())
    few = odd.filter("vec_id in (20, 21, 40)")
    assert result(exact_topk.top_k(few), *FOUND) == plain_search([r for r in odd_rows() if r[0] in (20, 21, 40)])
    for rows in (odd.limit(0), odd.filter("vec_id % 20 <> 0"), odd.filter("vec_id = 20")):
        assert exact_topk.top_k(rows).count() == 0


def test_search_in_many_groups_and_shards(spark):
    rows = made(700, 8, seed=5) + [(1000 + i, [0.25] * 8, 0) for i in range(200)]  # ties
    df = spark.createDataFrame(rows, VECTORS).repartition(3)
    stored = exact_topk.stored(vectors.integer_rows(df, 64, F.col("embedding"), vec_id=F.col("vec_id")), "test-rows")
    found = exact_topk.search(stored, F.col("vec_id") % 5 == 0, 7, group=30, shard=40)
    assert result(found, *FOUND) == plain_search(rows, 5, 7, width=8)


def test_competitive_pairs_are_all_that_reach():
    draw = np.random.default_rng(4)
    for size, kind in ((30, np.float32), (2**20, np.float64), (2**27, np.int64)):
        q, x = draw.integers(-size, size, (13, 16)), draw.integers(-size, size, (300, 16))
        assert exact_topk.kind_for(q, x) is kind
        scores = q @ x.T
        for at in (295, 150, 20):
            least = np.sort(scores, axis=1)[:, at]
            qi, ci, found = exact_topk.competitive(q, x, least, 5)
            assert sorted(zip(qi.tolist(), ci.tolist(), strict=True)) == sorted(zip(*(v.tolist() for v in np.nonzero(scores >= least[:, None])), strict=True))
            assert (found == scores[qi, ci]).all()
    with pytest.raises(ArithmeticError):
        exact_topk.kind_for(np.full((1, 4), 2**40), np.full((1, 4), 2**40))


def test_non_essential_terms_are_probed_for_competitive_candidates_only(monkeypatch):
    """The matrix product leaves out terms that cannot matter alone; without them a wrong bound would lose pairs."""
    draw = np.random.default_rng(6)
    q, x = draw.integers(-9, 9, (4, 24)), draw.integers(-9, 9, (500, 24))
    scores = q @ x.T
    least = np.sort(scores, axis=1)[:, -6]
    seen = []
    monkeypatch.setattr(exact_topk.np, "nonzero", lambda m, f=np.nonzero: seen.append(int(m.sum())) or f(m))
    qi, ci, found = exact_topk.competitive(q, x, least, 5)
    assert len(qi) == (scores >= least[:, None]).sum() and (found == scores[qi, ci]).all()
    assert len(qi) < seen[0] < 0.2 * scores.size


# --- 12 fill in middle


def plain_fim(doc_id, text):
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    n = len(units)
    h = hashlib.sha256(f"7:{'null' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * k : 8 * k + 8], 16) for k in range(4))
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    pre, mid, suf = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")):
        return doc_id, n, "plain", text, None, None
    if h4 % 100 < 50:
        return doc_id, n, "spm", f"<S>{suf}<P>{pre}<M>{mid}", len(pre), len(mid)
    return doc_id, n, "psm", f"<P>{pre}<S>{suf}<M>{mid}", len(pre), len(mid)


def fim_rows():
    draw = random.Random(8)
    texts = [None, "", "\n", "\n\n", "a", "a\nb", "a\r\nb\n", "x <P> y\nz", "<S", "<S\n>", "<\n<S\n<P", "$1 \\E \\Q ${x}\n$2", "é🙂\n🙂 \x85\n", "M>\n<M"]
    texts += ["".join(draw.choice(["a", "\n", "🙂", "<", "P>", "$", "\\", " ", "\r"]) for _ in range(draw.randrange(60))) for _ in range(150)]
    texts += ["line\n" * 60_000, "no end " * 300_000, "\n" * 100_000]
    return [(k, t) for k, t in enumerate(texts)] + [(None, "a\nb\nc"), (5, "a\nb"), (5, "a\nb"), (-3, "u\nv\nw")]


def test_fill_in_middle_equals_plain_slicing(spark):
    df = spark.createDataFrame(fim_rows(), "doc_id long, text string").repartition(4)
    df = df.select("*", *[F.lit("x").alias(c) for c in ("n", "form", "output", "first", "second", "a.b", "_c_0")])
    made = fill_middle.fill_in_middle(df, carried=("text", "a.b"))
    rows = made.withColumn("back", fill_middle.restored(F.col("output"), F.col("form"))).collect()
    assert sorted(map(str, (r[:6] for r in rows))) == sorted(str(plain_fim(i, t)) for i, t in fim_rows())
    assert all(r.back == (r.text or "") and r["a.b"] == "x" for r in rows)
    assert {r.form for r in rows} == {"plain", "psm", "spm"}
    assert fill_middle.fill_in_middle(df.limit(0)).count() == 0
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_fill_in_middle_parameters(spark):
    df = spark.createDataFrame([(k, f"a{k} b c d. e f") for k in range(400)], "id long, body string")
    made = fill_middle.fill_in_middle(df, "id", "body", r"[^ ]*+ |[^ ]++", ("$p\\", "[s]", "{m}"), 3, 60, 0, ("body",))
    rows = made.withColumn("back", fill_middle.restored(F.col("output"), F.col("form"), ("$p\\", "[s]", "{m}"))).collect()
    assert all(r.back == r.body and r.n == 6 for r in rows)
    plain = sum(r.form == "plain" for r in rows)
    assert 100 < plain < 220 and not [r for r in rows if r.form == "spm"]
    assert all(r.output.startswith("$p\\") and r.output.count("[s]") == r.output.count("{m}") == 1 for r in rows if r.form == "psm")


def test_queries_on_the_tables(spark, sf_dir):
    n = table(spark, sf_dir, "documents").count()
    rows = queries.op12_fill_middle(spark, sf_dir).collect()
    assert len(rows) == n and {r.form for r in rows} >= {"psm", "spm"}
    texts = {r.doc_id: r.text or "" for r in table(spark, sf_dir, "documents").collect()}
    assert all(r.restored_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest() for r in rows)
