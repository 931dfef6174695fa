"""Text operators against plain Python, SQL, libraries and held-out labels."""

import hashlib
import itertools
import math
import os
import random
import re
import subprocess
import sys
import time
import zlib
from collections import defaultdict

import brute
import corpus_pipeline
import numpy as np
import pytest
from arealis.llm import bpe, html_text, near_join, quality_trees, queries, repetition, secret_scan, stages, toxicity
from arealis.llm.exact_dedup import content_groups, exact_duplicates, without_duplicates
from arealis.llm.license_scan import licenses, normalized
from arealis.llm.license_texts import LICENSES
from arealis.llm.mixing import mix, mixed_rows
from arealis.llm.text import table
from compare import difference
from pyspark.sql import functions as F

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
CLASHES = "row digest kept score size whole node band label hash bands contents s_key _doc_id n taken a.b a`b".split()


def prose(seed, n, pool=400):
    draw = random.Random(seed)
    return " ".join(f"w{draw.randrange(pool)}" for _ in range(n))


def edge_rows():
    base, long = prose(1, 60), prose(2, 30_000, 3000)
    near = base.split()
    near[3] = "changed"
    texts = [
        (1, base), (2, base), (3, "  " + base.replace(" ", "\n")), (4, " ".join(near)), (5, None), (6, ""), (7, " \t\n"),
        (8, long), (9, long + " end"), (None, "no id here at all"), (10, "a b"), (11, "a b"), (12, "same " * 50), (12, "same " * 50),
        (13, "İstanbul ΑΣ   ſ K \x1c ok 🙂" * 5), (14, "password = hunter2hunter2 and token: abc"),
    ]
    return [(i, t, "en", (None, "", "é", "a")[k % 4], None if t is None else len(t)) for k, (i, t) in enumerate(texts)]


@pytest.fixture(scope="module")
def edge(spark):
    """Odd rows, with columns whose names operators use inside."""
    return spark.createDataFrame(edge_rows(), DOCS).select("*", *[F.lit("x").alias(c) for c in CLASHES])


@pytest.fixture(scope="module")
def none(edge):
    return edge.limit(0)


@pytest.fixture(scope="module")
def docs(spark, sf_dir):
    return table(spark, sf_dir, "documents")


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_equals_sql(spark, sf_dir, duck, name):
    df = queries.QUERIES[name](spark, sf_dir)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert difference(df, duck, queries.ORACLE[name]) is None


# --- 1 repetition


def test_repeats_equal_brute_force():
    draw = random.Random(3)
    texts = ["", " ", "a", "a a a a a a a a a a a a", "a b " * 30, prose(4, 200, 3), prose(5, 200, 12), prose(6, 150, 60)]
    texts += [" ".join(draw.choice("ab") for _ in range(draw.randrange(60))) for _ in range(30)]
    found = repetition.repetition(texts, 3)
    for k, t in enumerate(texts):
        covered, longest, window = brute.repeats(t, 3)
        assert (found["n_covered"][k], found["longest_repeat"][k], found["n_repeat_words"][k]) == (covered, longest, window)
        assert sum(s["words"] for s in found["spans"][k]) == covered


def test_long_texts_give_the_same_repeats(monkeypatch):
    """Without kept ranks and with words numbered piece by piece: the same counts and spans."""
    draw = random.Random(13)
    texts = ["", " x ", "a a a a a a a a", prose(4, 300, 3), prose(5, 900, 12), prose(5, 900, 12), "  ".join(["same"] * 700), prose(6, 2000, 500) + " " + prose(6, 400, 500)]
    texts += [draw.choice([" ", "\n", ""]) + " ".join(draw.choice("ab") for _ in range(draw.randrange(80))) for _ in range(20)]
    want = repetition.repetition(texts)
    monkeypatch.setattr(repetition, "STACKED", 0)
    monkeypatch.setattr(repetition, "SLICE_CHARS", 50)
    got = repetition.repetition(texts)
    assert all((got[k] == want[k]).all() if k != "spans" else got[k] == want[k] for k in want)
    sizes, codes, chars = repetition.numbered_words(texts)
    words = [w for t in texts for w in brute.words(t)]
    assert sizes.tolist() == [len(brute.words(t)) for t in texts] and chars[codes].tolist() == [len(w) for w in words]


def test_memory_of_a_text_of_equal_words():
    """Three million equal words in a process of its own: below half a gigabyte more than the imports."""
    code = (
        "import resource\nfrom arealis.llm import repetition\n"
        "before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss\n"
        "r = repetition.repetition(['same ' * 3_000_000])\n"
        "assert r['longest_repeat'][0] == 2_999_999 and r['n_covered'][0] == 3_000_000\n"
        "print((resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before) / 1024)"
    )
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, cwd=os.path.dirname(os.path.abspath(corpus_pipeline.__file__)), check=True)
    assert float(out.stdout) < 500


def test_repetition_rules(spark, edge, none):
    rows = {r.doc_id: r for r in repetition.repetition_rules(edge).collect()}
    assert (rows[5].n_words, rows[5].base_failed, rows[5].kept, rows[5].spans) == (0, True, False, [])
    assert rows[1].kept and rows[8].kept and rows[8].n_words == 30_000
    assert rows[12].n_repeat_words == 50 and not rows[12].kept and rows[12].longest_repeat == 49
    one = spark.createDataFrame([(1, "x | <y>\nl1 w\n\nl1 w\n \nl1  w\nl1 w")], "doc_id long, text string")
    r = repetition.repetition_rules(one).first()
    assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines) == (11, 17, 3, 2)
    assert repetition.repetition_rules(none).count() == 0


# --- 2 toxicity and 10 quality


def test_models_on_held_out_rows(spark, sf_dir):
    folder = os.path.join(os.path.dirname(sf_dir.rstrip("/")), "sf0.1")
    labels = {r.doc_id: r for r in table(spark, folder, "labels").collect()}
    for query, label, threshold in (("op2_toxicity", "toxic", 0.5), ("op10_quality", "quality", 0.3)):
        rows = queries.QUERIES[query](spark, folder).collect()
        assert len(rows) == table(spark, folder, "documents").count()
        held = [(r.score, labels[r.doc_id][label]) for r in rows if r.held_out and r.doc_id in labels]
        assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
        assert all(0 <= r.score <= 1 and r.predicted == (r.score >= threshold) for r in rows)
        ones, zeros = [s for s, y in held if y], [s for s, y in held if not y]
        right = sum((a > b) + 0.5 * (a == b) for a in ones for b in zeros) / (len(ones) * len(zeros))
        assert right > 0.9, (query, right)


def test_models_on_odd_rows(spark, edge, none):
    labels = spark.createDataFrame([(1, 1, 0), (4, 0, 1), (4, 1, 1), (8, None, None), (None, 1, 1), (99, 1, 0)], "doc_id long, quality int, toxic int")
    for model, label in ((toxicity, "toxic"), (quality_trees, "quality")):
        learnt = model.train(edge, labels, label)
        assert model.scored(edge, learnt).count() == edge.count()
        assert model.scored(none, learnt).count() == 0
        empty = model.train(edge, labels.limit(0), label)
        scores = {r.score for r in model.scored(edge, empty).collect()}
        assert scores == ({0.0} if model is toxicity else {0.5})
        assert model.training_ids(labels, label, 1).count() == 1
        assert not [r for r in model.training_ids(labels, label, 10).collect() if zlib.crc32(str(r.doc_id).encode()) % 5 == 0]


def test_toxic_words_decide():
    texts = [f"{prose(k, 40)} {'vile filth' if k % 4 == 0 else 'kind words'}" for k in range(400)]
    text_of, cells = toxicity._distinct(*toxicity.text_features(texts))
    rows = [cells[text_of == k] for k in range(400)]
    weights = toxicity.ftrl(rows, np.array([float(k % 4 == 0) for k in range(400)]))
    scores = weights.scorer()([prose(900, 40) + " vile filth", prose(901, 40) + " kind words"])
    assert scores[0] > 0.5 > scores[1]
    assert len(weights.cells) < len(set(cells.tolist())) / 4


def plain_ftrl(rows, labels, epochs):
    """FTRL-proximal with a dict for each coordinate."""
    z, n, l1, bias = defaultdict(float), defaultdict(float), toxicity.L1_SHARE * len(rows), "bias"

    def weight(c):
        if c != bias and abs(z[c]) <= l1:
            return 0.0
        shrunk = z[c] if c == bias else z[c] - math.copysign(l1, z[c])
        return -shrunk / ((toxicity.BETA + math.sqrt(n[c])) / toxicity.ALPHA + (0.0 if c == bias else toxicity.L2))

    order = np.random.default_rng(7)
    for _ in range(epochs):
        for i in order.permutation(len(rows)):
            cells = [*rows[i].tolist(), bias]
            w = [weight(c) for c in cells]
            g = (1 / (1 + math.exp(-max(-35, min(35, sum(w))))) - labels[i]) * (toxicity.POSITIVE_WEIGHT if labels[i] else 1.0)
            for c, v in zip(cells, w, strict=True):
                z[c] += g - (math.sqrt(n[c] + g * g) - math.sqrt(n[c])) / toxicity.ALPHA * v
                n[c] += g * g
    return {c: weight(c) for c in z if c != bias and abs(z[c]) > l1}, weight(bias)


def test_ftrl_equals_a_loop_over_coordinates():
    draw = np.random.default_rng(3)
    rows = [np.unique(draw.integers(0, 300, draw.integers(0, 25))) for _ in range(250)]
    labels = np.array([float(7 in r or 11 in r) for r in rows])
    learnt = toxicity.ftrl(rows, labels, 3)
    weights, bias = plain_ftrl(rows, labels, 3)
    assert set(weights) == set(learnt.cells.tolist()) and 0 < len(weights) < 300
    assert max(abs(weights[c] - v) for c, v in zip(learnt.cells.tolist(), learnt.values, strict=True)) < 1e-9
    assert abs(bias - learnt.bias) < 1e-9


def plain_tree(x, y):
    """One tree grown by trying every split of every node; margins of the rows."""
    rate = min(max(y.mean(), 0.001), 0.999)
    base = math.log(rate / (1 - rate))
    p = 1 / (1 + math.exp(-base))
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, quality_trees.BINS + 1)[1:-1])) for j in range(x.shape[1])]
    out = np.zeros(len(x))

    def grow(rows, depth):
        g, h = sum(p - y[i] for i in rows), len(rows) * p * (1 - p)
        best = (1e-6, None, None)
        for j in range(x.shape[1]) if depth < quality_trees.DEPTH else ():
            for e in edges[j]:
                left = [i for i in rows if x[i, j] <= e]
                lg, lh = sum(p - y[i] for i in left), len(left) * p * (1 - p)
                if min(lh, h - lh) >= quality_trees.MIN_CURVATURE:
                    r = quality_trees.RIDGE
                    gain = lg**2 / (lh + r) + (g - lg) ** 2 / (h - lh + r) - g**2 / (h + r)
                    if gain > best[0] + 1e-9:
                        best = (gain, j, e)
        if best[1] is None:
            out[rows] = base - quality_trees.RATE * g / (h + quality_trees.RIDGE)
            return
        grow([i for i in rows if x[i, best[1]] <= best[2]], depth + 1)
        grow([i for i in rows if x[i, best[1]] > best[2]], depth + 1)

    grow(list(range(len(x))), 0)
    return 1 / (1 + np.exp(-out))


def test_a_tree_equals_trying_every_split():
    draw = np.random.default_rng(8)
    x = np.round(draw.normal(size=(160, 4)), 1)
    y = ((x[:, 0] + x[:, 2] > 0.2) ^ (draw.random(160) < 0.1)).astype(float)
    assert np.allclose(quality_trees.boost(x, y, trees=1).scores(x), plain_tree(x, y), atol=1e-12)


def test_statistics_do_not_depend_on_the_slice():
    texts = [prose(k, 30, 40) + " fine" * (k % 4) for k in range(300)] + ["", "a", "a\na", "x " * 2000]
    alone = np.concatenate([quality_trees.statistics([t]) for t in texts])
    assert (quality_trees.statistics(texts) == alone).all()
    words = [t.split() for t in texts]
    assert np.allclose(alone[:, quality_trees.STATISTICS.index("distinct_words")], [len(set(w)) / max(len(w), 1) for w in words])


def test_models_do_not_depend_on_the_order_of_rows(spark):
    """Repeated ids with different texts, in three orders and partitionings."""
    draw = random.Random(12)
    texts = [(k % 120, prose(k, 30) + (" vile filth" if k % 3 == 0 else " fine") * (k % 4)) for k in range(360)] + [(5, None), (6, "")]
    labels = spark.createDataFrame([(k, k % 2, int(k % 3 == 0)) for k in range(120)], "doc_id long, quality int, toxic int")
    learnt = []
    for parts in (1, 4, 7):
        draw.shuffle(texts)
        df = spark.createDataFrame(texts, "doc_id long, text string").repartition(parts)
        w, t = toxicity.train(df, labels), quality_trees.train(df, labels)
        learnt.append((w.cells.tolist(), w.values.tolist(), w.bias, t.threshold.tolist(), t.value.tolist()))
    assert learnt[0] == learnt[1] == learnt[2] and learnt[0][0]


def test_sampled_texts_are_bounded_by_their_features(spark):
    df = spark.createDataFrame([(k, prose(k, 50) + " vile" * (k % 2)) for k in range(200)], "doc_id long, text string")
    labels = spark.createDataFrame([(k, 0, k % 2) for k in range(200)], "doc_id long, quality int, toxic int")
    whole, none = toxicity.train(df, labels), toxicity.train(df, labels, sample_cells=0)
    assert whole.cells.size and none.bias is not None  # the first text is always learnt from
    assert toxicity.train(df, labels, sample_cells=10**9).values.tolist() == whole.values.tolist()


def test_trees_find_a_rule():
    draw = np.random.default_rng(1)
    x = draw.normal(size=(600, len(quality_trees.STATISTICS)))
    y = ((x[:, 2] > 0.3) ^ (x[:, 5] > 0)).astype(float)
    trees = quality_trees.boost(x[:400], y[:400])
    assert ((trees.scores(x[400:]) > 0.5) == y[400:]).mean() > 0.9
    assert quality_trees.statistics(["", " "]).sum() == 0


# --- 3 main text


def page(body):
    return f"<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var a='</p>';</script></head><body>{body}</body></html>"


LONG = prose(7, 80)


@pytest.mark.parametrize(
    "body, text",
    [
        (f"<nav><a href=/>Home</a></nav><article><h1>A &amp; B</h1><p>{LONG}<br>x\n y<p>No.</p></article><footer>&copy; f</footer>", f"A & B\n\n{LONG} x y\n\nNo."),
        (f"<div class='side-bar ad'><p>{LONG}</p></div><main><p><b>{LONG}</b></p><form>f</form><p>z</p></main>", f"{LONG}\n\nz"),
        (f"<div id=menu><ul><li><a href=1>One</a><li><a href=2>Two</a></ul></div><div class=content><p>{LONG}</p><p>s</p></div><div class=comments>{LONG}</div>", f"{LONG}\n\ns"),
        (f"<article><p>{LONG}<div class=comment><article><p>{LONG}</article></div><p>end</article><aside>{LONG}</aside>", f"{LONG}\n\nend"),
        (f"<p>{LONG}", LONG),
        (f"<div id=top><a href=1>Home</a></div><div class='post with-sidebar'><div>{LONG}</div><div>tiny</div><div>{LONG}</div></div><div>Imprint</div>", f"{LONG}\n\ntiny\n\n{LONG}"),
        (f"<article><div class=article-header><h1>T</h1></div><p>{LONG}</p><div class=cookie-notice>{LONG}</div></article>", f"T\n\n{LONG}"),
        (f"<article><p>{LONG}</b></i><p>open", f"{LONG}\n\nopen"),
        ("<article><p>short</p></article>", "short"),
        ("", ""),
    ],
)
def test_main_text(body, text):
    assert html_text.main_text(page(body)) == text


@pytest.mark.parametrize(
    "body, text",
    [
        (f"<div class=post><h1>Title</h1><div class=entry>{LONG}</div></div>", f"Title\n\n{LONG}"),
        (f"<div id=top><a href=/>Home</a></div><div><div>{prose(8, 14)}</div><div>{LONG}</div></div><div>Imprint</div>", f"{prose(8, 14)}\n\n{LONG}"),
        (f"<div><h3>Archive</h3><ul><li><a href=1>One</a></ul></div><div><div class=title><h1><a href=x>T</a></h1></div><div>By X</div><div class=entry><h2>I</h2><p>{LONG}</div></div>", f"T\n\nBy X\n\nI\n\n{LONG}"),
        (f"<div><h1><a href=/>Site</a></h1></div><div><h2>T</h2><div><p>{LONG}<div><h3>More</h3></div><div><p>{LONG}</div></div></div><div>Imprint</div>", f"T\n\n{LONG}\n\nMore\n\n{LONG}"),
    ],
)
def test_main_text_without_landmarks(body, text):
    assert html_text.main_text(page(body)) == text


@pytest.mark.parametrize(
    "body, text",
    [
        (f"<article><h1>T</h1><h2 id='related-work'>Related work</h2><p>{LONG}</p></article>", f"T\n\nRelated work\n\n{LONG}"),
        (f"<article><section id='search-methods'><h2>Search</h2><p>{LONG}</p></section><section id=search><p>{LONG}</p></section></article>", f"Search\n\n{LONG}\n\n{LONG}"),
        (f"<article><p>{LONG}</p><p class='notice-period'>Thirty days.</p><div id='social-history'><p>{LONG}</div></article>", f"{LONG}\n\nThirty days.\n\n{LONG}"),
        (f"<article><p>{LONG}</p><div class='social-history'><a href=1>One</a> <a href=2>Two</a></div><div class='related-posts'><p>{LONG}</div></article>", LONG),
        (f"<div class=entry><h2 id='related-work'>Related work</h2><p>{LONG}</p><p class='job-search'>{LONG}</p></div>", f"Related work\n\n{LONG}\n\n{LONG}"),
        (f"<article><p>{LONG}</article><div class='related-reading'><article><p>{LONG}</article></div>", LONG),
    ],
)
def test_names_hide_only_boilerplate(body, text):
    assert html_text.main_text(page(body)) == text


LINKS = "".join(f"<li><a href={k}>More of this {k}</a></li>" for k in range(7))


@pytest.mark.parametrize(
    "body, text",
    [
        (f"<article><h1 class='form'>Title</h1><p>{LONG}</p></article>", f"Title\n\n{LONG}"),
        (f"<main><div class='banner'><h1>Title</h1></div><p>{LONG}</p></main>", f"Title\n\n{LONG}"),
        (f"<article><p>{LONG}</p><p class='notice'>Important notice to all.</p><p>{LONG}</p></article>", f"{LONG}\n\nImportant notice to all.\n\n{LONG}"),
        (f"<article><p>{LONG}</p><div class='share'><p>{LONG}</p></div></article>", f"{LONG}\n\n{LONG}"),
        (f"<article><p>{LONG}</p><div class='share'><a href=1>One</a> <a href=2>Two</a></div></article>", LONG),
        (f"<article><p>{LONG}</p><p>{LONG}</p><ul>{LINKS}</ul><p>{LONG}</p></article>", f"{LONG}\n\n{LONG}\n\n{LONG}"),
        (f"<article><p>{LONG}</p><p><a href=x>The paper</a></p><p>{LONG}</p></article>", f"{LONG}\n\nThe paper\n\n{LONG}"),
    ],
)
def test_names_inside_articles_only_shift_the_limit(body, text):
    assert html_text.main_text(page(body)) == text


def test_ratios_decide_inside_articles(monkeypatch):
    """Without the smoothed ratios menus stay, and suspects go by chance."""
    pages = [page(f"<article><p>{prose(k, 60)}</p><p class='notice'>Note {k}.</p><p>{prose(k + 1, 60)}</p><ul>{LINKS}</ul><p>{prose(k + 2, 60)}</p></article>") for k in range(30)]
    real = [html_text.main_text(p) for p in pages]
    assert all(t.count("\n\n") == 3 and "Note" in t and "More" not in t for t in real)
    monkeypatch.setattr(html_text, "smoothed", lambda r: np.zeros(len(r)))
    assert all("More" in html_text.main_text(p) for p in pages)
    draw = np.random.default_rng(4)
    monkeypatch.setattr(html_text, "smoothed", lambda r: draw.exponential(size=len(r)))
    assert sum(html_text.main_text(p) != t for p, t in zip(pages, real, strict=True)) > 10


@pytest.mark.parametrize("piece", ['<a href="', "<!--", "<a ", "</p ", "<", "<!", "<?", "<![CDATA[", '<a href="x', "<p>", "<b><i>", "<!-- x -->", "&", "<li><a href=1>x"])
@pytest.mark.parametrize("end", ["", ">", '">', "-->"])
def test_broken_pages_take_no_longer(piece, end):
    """A megabyte of one broken piece, alone or closed at the very end."""
    start = time.time()
    n = 1_000_000 // len(piece) if piece not in ("<p>", "<b><i>", "<li><a href=1>x") else 30_000
    text = html_text.main_text(f"<p>{LONG}</p>" + piece * n + end)
    assert isinstance(text, str) and time.time() - start < 5


def test_main_text_of_pages(spark, sf_dir):
    rows = html_text.extracted(table(spark, sf_dir, "pages")).collect()
    pages = {r.page_id: r.html for r in table(spark, sf_dir, "pages").collect()}
    from html import unescape

    for r in rows:
        inside = re.search(r"<article>(.*?)</article>", pages[r.page_id], re.S).group(1)
        blocks = (re.sub(r"\s+", " ", unescape(re.sub("<[^>]+>", "", b.replace("<br>", " ")))).strip() for b in re.split(r"</?(?:p|h1)>", inside))
        assert r.text == "\n\n".join(b for b in blocks if b) and r.n_chars == len(r.text)
    odd = spark.createDataFrame([(1, None, None, "x"), (None, "u", "", "x"), (2, "u", "<" * 5000, "x"), (2, "u", "<" * 5000, "x")], "page_id long, url string, html string, text string")
    assert html_text.extracted(odd).count() == 4 and html_text.extracted(odd.limit(0)).count() == 0


# --- 4 mixing


def test_mix_equals_brute_force(spark, docs):
    rows = docs.select("doc_id", "text", "source").collect()
    rows = [(r.doc_id, r.text, None if r.source == "src3" else r.source) for r in rows] + [(10**9, None, "only null")]
    got = mix(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    want = brute.mix(rows)
    assert {r.doc_id: (r["size"], r.source_size, r.taken) for r in got} == {i: (a, b, d) for i, (a, b, _, d) in want.items()}
    assert {r.doc_id: r.target for r in got} == pytest.approx({i: x[2] for i, x in want.items()})


def test_mix_on_odd_rows(edge, none):
    rows = mix(edge).collect()
    assert len(rows) == edge.count() and all(r.taken <= 2 * r["size"] for r in rows)
    assert mix(none).count() == 0 and mixed_rows(none).columns == none.columns
    out = mixed_rows(edge)
    assert out.columns == edge.columns and out.count() == sum(r.taken // r["size"] for r in rows if r["size"])


def test_rows_without_id_meet_the_target(spark):
    rows = [(None, prose(k, 20), "a") for k in range(400)] + [(k % 3, prose(1000 + k, 20), "b") for k in range(400)] + [(9, "one two", "c")] * 9
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    by_target = mix(docs, share=0.3).groupBy("target", "source_size").agg(F.sum("taken").alias("taken")).collect()
    assert len(by_target) == 3 and all(abs(r.target - r.taken) <= 10 for r in by_target if r.source_size == 8000)
    assert mixed_rows(docs, share=0.3).select("text").count() == sum(r.taken // r["size"] for r in mix(docs, share=0.3).collect())


# --- 5 tokens


def test_tokens_equal_the_library(spark, docs, edge, none):
    tokenizers = pytest.importorskip("tokenizers")
    path = queries.vocabulary_path()
    library = tokenizers.Tokenizer.from_file(path)
    library.no_truncation()
    library.no_padding()
    own = bpe.load(path)
    draw = random.Random(5)
    alphabet = [*"abcdeéß  \t\n\r\x0b\x1c\x1f\x85　 ​ΣσςİſK'0٣²½Ⅷ!?#日本🙂́ΑΣ\x00", "'s", "'ll", "<|endoftext|>", "the", "don't"]
    texts = ["".join(draw.choice(alphabet) for _ in range(draw.randrange(30))) for _ in range(2000)]
    texts += [r.text or "" for r in docs.collect()] + [t or "" for _, t, *_ in edge_rows()]
    for t in texts:
        ids = library.encode(t, add_special_tokens=False).ids
        assert own.encode(t) == ids
        assert own.decode(ids) == library.decode(ids, skip_special_tokens=False)
    for start in range(0, 0x110000, 0x4000):  # every code point, inside, at the end of and between words
        every = [f"ab{c}cd {c} ab{c} x'{c}{c}" for c in map(chr, range(start, start + 0x4000)) if not "\ud800" <= c <= "\udfff"]
        assert [own.encode(t) for t in every] == [e.ids for e in library.encode_batch(every, add_special_tokens=False)]
    rows = bpe.encoded(edge, path, digests=True).collect()
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = [library.encode(t or "", add_special_tokens=False).ids for _, t, *_ in edge_rows()]
    assert sorted((r.n_tokens, r.ids_sha256) for r in rows) == sorted((len(x), sha(" ".join(map(str, x)))) for x in want)
    assert bpe.encoded(none, path).count() == 0


# --- 6 secrets


def test_secrets(spark, edge, none):
    key = "AKIA" + "Q1" * 10
    copied = [(k, f"see {key} or password='example1' {'ab12' * 8}", f"s{k}") for k in range(6)]
    own = [(90, "api_key: zzzz9999 Token=short1 secret=abc Authorization: Bearer " + "Qx7" * 9, "s1"), (91, None, None), (92, "", "s2")]
    rows = {r.doc_id: r for r in secret_scan.secrets(spark.createDataFrame(copied + own, "doc_id long, text string, source string")).collect()}
    assert (rows[0].n_assign, rows[0].n_access, rows[0].n_hex, rows[0].n_live, rows[0].n_copied) == (1, 1, 1, 0, 3)
    assert (rows[90].n_assign, rows[90].n_live) == (2, 3) and "bearer:" in rows[90].spans and rows[90].most_owners == 1
    for i in (91, 92):
        assert rows[i].spans == "" and rows[i].base_sha256 == hashlib.sha256(b"").hexdigest()
    assert secret_scan.secrets(edge).count() == edge.count() and secret_scan.secrets(none).count() == 0


def test_copied_spans_of_every_kind_are_reported(spark):
    key = "-----BEGIN PRIVATE KEY-----" + "Qx7/" * 9 + "-----END PRIVATE KEY-----"
    texts = [f"{key} Bearer {'Qx7' * 9} ftp://u:pass{'w' * 6}@h token=only{k}{k}{k}" for k in range(5)]
    for r in secret_scan.secrets(spark.createDataFrame([(k, t, f"s{k}") for k, t in enumerate(texts)], "doc_id long, text string, source string")).collect():
        assert [s.split(":")[0] for s in r.spans.split(",")] == ["private", "bearer", "address", "assign"]
        assert r.marks == "copied,copied,copied,live" and (r.n_live, r.n_copied, r.n_assign) == (1, 3, 1)


def test_values_in_many_repositories_of_one_owner_are_copied(spark):
    rows = [(k, "password=example1", "hot") for k in range(11)] + [(k, f"password=inuse{k % 2}234", "hot") for k in range(20, 40)] + [(20, "token=twice99", "a")] * 30
    got = {(r.doc_id, r.marks): r for r in secret_scan.secrets(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    assert (got[0, "copied"].n_live, got[0, "copied"].most_owners, got[0, "copied"].most_repositories) == (0, 1, 11)
    assert got[21, "live"].most_repositories == 10 and {m for (i, m) in got if i >= 20} == {"live"}


def test_base_spans_equal_plain_patterns(docs):
    assign = re.compile(r"""(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
    for (t,) in docs.select(F.coalesce("text", F.lit(""))).collect():
        want = [("assign", *m.span()) for m in assign.finditer(t) if len(m.group(1)) >= 6]
        want += [("access", *m.span()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m.group()) >= 20]
        want += [("hex", *m.span()) for m in re.finditer("[0-9a-f]+", t) if len(m.group()) >= 24]
        want.sort(key=lambda x: (x[1], secret_scan.KINDS.index(x[0])))
        assert [x[:3] for x in secret_scan.candidates(t) if x[0] in secret_scan.BASE_KINDS] == want


def test_verdicts_equal_a_count_of_owners(spark, sf_dir):
    docs = table(spark, os.path.join(os.path.dirname(sf_dir.rstrip("/")), "sf0.1"), "documents")  # the small tables hold few
    rows = [(r.doc_id, r.source, secret_scan.candidates(r.text or "")) for r in docs.collect()]
    owners, repositories = defaultdict(set), defaultdict(set)
    for doc_id, source, found in rows:
        for *_, value in found:
            owners[value].add(source)
            repositories[value, source].add(doc_id)
    per_owner = defaultdict(int)
    for (value, _), ids in repositories.items():
        per_owner[value] = max(per_owner[value], len(ids))
    copied = {v: len(owners[v]) > secret_scan.COPIED_OWNERS or per_owner[v] > secret_scan.COPIED_REPOSITORIES for v in owners}
    want = sorted((i, ",".join("copied" if copied[x[3]] else "live" for x in found), sum(copied[x[3]] for x in found), max((len(owners[x[3]]) for x in found), default=0)) for i, _, found in rows)
    got = sorted((r.doc_id, r.marks, r.n_copied, r.most_owners) for r in secret_scan.secrets(docs).collect())
    assert got == want and any(found for *_, found in rows)


def test_long_credentials_in_addresses():
    text = f"see ftp://{'u' * 100}:{'p' * 400}@host and http://a:b@c and x://y:" + "z" * 50_000
    assert [x[:3] for x in secret_scan.candidates(text)] == [("address", 4, 4 + 6 + 100 + 1 + 400 + 1)]


# --- 7 near duplicates


def near_texts():
    """Chains and cliques of near copies, copies, and texts that share a passage only."""
    draw, rows = random.Random(11), []
    for group in range(12):
        base = prose(100 + group, 90).split()
        for k in range(group):
            w = list(base)
            for _ in range(draw.randrange(4)):
                w[draw.randrange(90)] = f"x{draw.randrange(99)}"
            rows.append(" ".join(w))
    passage = prose(55, 30)
    rows += [f"{passage} {prose(200 + k, 40)}" for k in range(25)] + ["a b c", "a b c", "a b", "", " "]
    return list(enumerate(rows))


@pytest.mark.parametrize("block", [2, 512])
def test_near_duplicates_equal_brute_force(spark, block):
    rows = near_texts()
    found = near_join.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), block=block).collect()
    assert {r.doc_id: (r.class_id, r.copy_id, r.n_copies, r.n_links) for r in found} == brute.near(rows)
    assert {r.doc_id for r in found if r.kept} == {r.class_id for r in found}


def test_near_duplicates_of_documents(docs):
    found = near_join.near_duplicates(docs).collect()
    want = brute.near([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])
    assert {r.doc_id: (r.class_id, r.copy_id, r.n_copies, r.n_links) for r in found} == want


def test_near_duplicates_of_odd_rows(edge, none):
    rows = near_join.near_duplicates(edge).collect()
    by = {r.doc_id: r for r in rows}
    assert len(rows) == edge.count() and by[3].class_id == 1 and by[4].class_id == 1 and by[9].class_id == 8
    assert by[5].class_id == by[6].class_id == by[7].class_id == 5 and by[5].n_links == 0
    assert sum(r.kept for r in rows if r.doc_id == 12) == 1
    out = near_join.without_near_duplicates(edge)
    assert out.columns == edge.columns and sorted(r.doc_id or 0 for r in out.collect()) == [0, 1, 5, 8, 10, 12, 13, 14]
    assert near_join.near_duplicates(none).count() == 0 and near_join.without_near_duplicates(none).count() == 0


WORDS = ["", "a", "a b", "a b c", "a b c d e f", " "]


def test_shingles_of_slices_with_few_words():
    """Every slice of up to four short texts: as many hashes as counted, equal to those of each text alone."""
    for n in range(5):
        for texts in itertools.product(WORDS, repeat=n):
            hashes, counts = near_join.shingles(list(texts))
            assert counts.tolist() == [len(brute.shingles(t)) for t in texts]
            alone = [near_join.shingles([t])[0] for t in texts]
            assert hashes.tolist() == [h for x in alone for h in x.tolist()]


def test_slice_functions_take_few_words():
    learnt = toxicity.Weights(np.zeros(0, np.int64), np.zeros(0), 0.5)
    for n in range(4):
        for texts in itertools.product(WORDS, repeat=n):
            texts = list(texts)
            assert len(quality_trees.statistics(texts)) == n
            assert len(repetition.repetition(texts, 3)["n_covered"]) == n
            assert len(learnt.scorer()(texts)) == n
            assert len(near_join.signatures(*near_join.shingles(texts))) == n


@pytest.mark.parametrize("rows", [["a b"], ["a b", "x y z", None], ["a b c d e f", "a b c d e f", "x y"]])
def test_few_short_rows_in_many_partitions(spark, rows, tmp_path):
    """Each row in a file of its own, through the registered queries and the pipeline."""
    docs = spark.createDataFrame([(k + 1, t, "en", "s", len(t or "")) for k, t in enumerate(rows)], DOCS)
    docs.repartition(len(rows) + 2, "doc_id").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    every = sorted(n for n in queries.QUERIES if n not in ("op3_html_text", "op11_vector_codes", "op13_topk"))
    for name in every if None in rows else ["op7_near_join"]:
        assert queries.QUERIES[name](spark, str(tmp_path)).count() == len(rows), name
    assert corpus_pipeline.run(spark, str(tmp_path)).count() <= 2 * len(rows)


def near_copies(n, words=300, edits=2, seed=31):
    """Variants of one text, each with its own words at some places."""
    draw, base, out = random.Random(seed), prose(seed, words).split(), []
    for k in range(n):
        w = list(base)
        for _ in range(edits):
            w[draw.randrange(words)] = f"v{k}x{draw.randrange(9)}"
        out.append((k, " ".join(w)))
    return out


def test_member_rows_stay_in_proportion(spark):
    """Cells of a large group of near copies: about two rows a member and band, whatever the group's size."""
    for n in (1_000, 16_000, 64_000):
        band = F.expr("transform(sequence(1, 28), x -> cast(1 as bigint))")
        classes = spark.range(n).select(F.col("id").alias("node"), band.alias("bands"))
        cells = near_join.bucket_members(classes).groupBy("band", "i", "j").count().agg(F.sum("count"), F.max("count")).first()
        assert cells[0] < 28 * 2.5 * n and cells[1] < 2.5 * near_join.BLOCK


def test_large_groups_of_near_copies(spark):
    rows = near_copies(900) + [(1000 + k, t) for k, t in near_copies(300, seed=33)] + [(2000 + k, prose(500 + k, 80)) for k in range(50)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute.near(rows)
    for block in (40, 512):
        found = near_join.near_duplicates(df, block=block).collect()
        assert {r.doc_id: (r.class_id, r.copy_id, r.n_copies, r.n_links) for r in found} == want
    kept = near_join.without_near_duplicates(df).collect()
    assert sorted(r.doc_id for r in kept) == sorted({c for c, *_ in want.values()})


def test_links_within_equal_plain_counts():
    draw = random.Random(9)
    sets = [np.unique(np.array([draw.randrange(60) for _ in range(draw.choice([0, 1, 30, 200]))], np.uint64)) for _ in range(40)]
    sets += sets[:5]
    plain = lambda a, b: len(set(a) & set(b)) / max(len(set(a) | set(b)), 1) >= 0.8 - 1e-12
    for side in (np.zeros(45, int), np.array([1 + k % 2 for k in range(45)])):
        pairs = [(i, j) for i in range(45) for j in range(45) if i != j and (side[i] == 0 or side[i] != side[j])]
        want = [sum(plain(sets[i], sets[j]) for i, j in pairs if i == k and len(sets[i]) + len(sets[j])) for k in range(45)]
        got = near_join.links_within(sets, side, 0.8)
        assert [g for g, s in zip(got, sets) if len(s)] == [w for w, s in zip(want, sets) if len(s)]


def test_pruning_keeps_similar_pairs():
    floor = near_join.least_matches()
    assert floor[near_join.HASHES] < 0.8 * near_join.HASHES and (np.diff(floor) >= 0).all()


# --- 8 licences


def test_licences(spark, edge, none):
    mit = dict(LICENSES)["MIT"]
    known = {name: text for name, text in LICENSES}
    rows = [
        (1, "Copyright (c) 2020 Someone\n\n" + mit.replace("software", "SOFTWARE").replace('"', "“") + "\n"),
        (2, "before\n\n" + known["Zlib"].replace("acknowledgment", "acknowledgement") + "\n\nafter"),
        (3, "x\n * Licensed under the Apache Licence, Version 2.0\ny"), (4, "It is licensed under the Apache License, Version 2.0, they say."),
        (5, known["BSD-2-Clause"] + "\n\nand more"), (6, None), (7, ""),
    ]
    got = {r.doc_id: r for r in licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1].license == "MIT" and got[1].found == "MIT"
    assert (got[2].license, got[2].found) == (None, "Zlib")
    assert (got[3].found, got[4].found, got[5].found) == ("Apache-2.0-notice", "", "BSD-2-Clause")
    assert (got[6].found, got[6].n_units, got[7].license) == ("", 0, None)
    assert licenses(edge).count() == edge.count() and licenses(none).count() == 0


def test_licences_by_whole_text_title_and_copyright_line(spark):
    from pathlib import Path

    import arealis.llm

    whole = {f.stem: f.read_text() for f in (Path(arealis.llm.__file__).parent / "license_files").glob("*.txt")}
    bare = dict(LICENSES)["MIT"].split("\n\n", 1)[1]
    apache = whole["Apache-2.0"]
    rows = [
        ("GPL-2.0", whole["GPL-2"]), ("GPL-3.0", whole["GPL-3"]), ("LGPL-2.1", whole["LGPL-2.1"]), ("LGPL-3.0", whole["LGPL-3"]),
        ("MPL-2.0", whole["MPL-2.0"]), ("CC0-1.0", whole["CC0-1.0"]), ("Unlicense", "The Unlicense\n\n" + whole["Unlicense"]),
        ("Apache-2.0", apache.replace("[yyyy] [name of copyright owner]", "2020 Someone")), ("Apache-2.0", apache[: apache.index("APPENDIX")]),
        ("MIT", bare), ("MIT", "The MIT License (MIT)\n\nCopyright (c) Some One\n\n" + bare), ("MIT", "Copyright Some One\nCopyright Another\n\n" + bare),
        ("MIT", bare.replace(" OR\nCOPYRIGHT HOLDERS", "\nOR COPYRIGHT HOLDERS").replace("AUTHORS OR COPYRIGHT", "AUTHORS OR\nCOPYRIGHT")),
        ("MIT", "/*\n * © Some One\n *\n" + bare.replace("\n", "\n * ") + "\n */"),
    ]
    docs = spark.createDataFrame([(k, t) for k, (_, t) in enumerate(rows)], "doc_id long, text string")
    for r in licenses(docs.unionByName(docs.select((F.col("doc_id") + 100).alias("doc_id"), F.concat(F.lit("before\n\n"), "text").alias("text")))).collect():
        name = rows[r.doc_id % 100][0]
        assert (r.license == name or r.doc_id >= 100) and name in r.found.split(","), (name, r)
    lines = ["(c) You must keep it", "copyright license to use", "Copyright Some One", "x"]
    text = "\n".join(lines[:2]) + "\n\n" + lines[2] + "\n\n" + lines[3]
    kept = spark.createDataFrame([(text,)], "text string").select(normalized(F.col("text"))).first()[0]
    assert kept.split() == "c you must keep it copyright license to use x".split()


def test_licences_equal_sql_on_made_texts(spark, tmp_path):
    """Licence texts and copyright lines in all sorts of company; carriage returns, marks, blocks of short lines."""
    import duckdb

    draw, known = random.Random(21), [t for _, t in LICENSES]
    lines = [
        "", " ", " *", "copyright some one", "Copyright (c) 2020 X", "© y", "copyright: by z", "(c) you must keep it", "word", "// portions copyright 1999 q",
        "copyright " + "long " * 30, "# Copyright A and B", "; copyright (c) me", "copyright", "the end of a line ....", "** copyright holders and others", "(C) 1999",
    ]
    rows = []
    for k in range(400):
        parts = []
        for _ in range(draw.randrange(1, 6)):
            if draw.random() < 0.5:
                parts.append("\n".join(draw.choice(lines) for _ in range(draw.randrange(1, 7))))
            else:
                text = draw.choice(known)
                parts.append(text if draw.random() < 0.6 else text.split("\n\n")[0])
        joint = draw.choice(["\n", "\n\n", "\n \n", "\r\n\r\n"])
        rows.append((k % 390, draw.choice([None, "", joint.join(parts), joint.join(parts), joint.join(parts).upper()]), "en", "s", 0))
    df = spark.createDataFrame(rows, DOCS)
    df.write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    found = licenses(df)
    assert difference(found, con, queries.ORACLE["op8_licenses"]) is None
    assert found.filter("license is not null").count() > 10 and found.filter("n_units > 0").count() > 100


def test_native_operators_run_no_python(spark, docs):
    for df in (licenses(docs), exact_duplicates(docs)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Pandas|Arrow", plan)


# --- 9 exact duplicates


def test_exact_duplicates_of_odd_rows(edge, none):
    rows = exact_duplicates(edge).collect()
    by = {r.doc_id: r for r in rows}
    assert len(rows) == edge.count() and (by[1].keep_id, by[1].group_size) == (3, 3)
    assert by[5].keep_id == 7 and by[10].kept and not by[11].kept and by[None].kept and by[None].keep_id is None
    assert [r.group_size for r in rows if r.doc_id == 12] == [2, 2] and sum(r.kept for r in rows if r.doc_id == 12) == 1
    out = without_duplicates(edge)
    assert out.columns == edge.columns and out.count() == sum(r.kept for r in rows)
    assert exact_duplicates(none).count() == 0 and without_duplicates(none).count() == 0


def test_contents_decide_not_digests(spark):
    rows = [(1, 3, "abc", b"d"), (2, 3, "abd", b"d"), (3, 4, "abc", b"d")]
    groups = content_groups(spark.createDataFrame(rows, "doc_id long, n_chars long, content string, digest binary"), salts=2)
    assert {(r.content, r.keep_id, r.group_size) for r in groups.collect()} == {("abc", 3, 2), ("abd", 2, 1)}


# --- pipeline


def test_pipeline_equals_brute_force(spark, sf_dir):
    tokenizers = pytest.importorskip("tokenizers")
    rows = table(spark, sf_dir, "documents")
    weights = toxicity.train(rows, table(spark, sf_dir, "labels"))
    left = stages.not_toxic(spark, rows, sf_dir)
    assert left.columns == rows.columns
    assert {r.doc_id for r in left.collect()} == {r.doc_id for r in toxicity.scored(rows, weights).collect() if r.predicted == 0}
    left = {r.doc_id: (r.text, r.source) for r in left.collect()}
    kept = brute.exact([(i, t) for i, (t, _) in left.items()])
    left = {i: x for i, x in left.items() if kept[i][2]}
    classes = brute.near([(i, t) for i, (t, _) in left.items()])
    left = {i: x for i, x in left.items() if classes[i][0] == i}
    taken = brute.mix([(i, t, s) for i, (t, s) in left.items()])
    library = tokenizers.Tokenizer.from_file(queries.vocabulary_path())
    library.no_truncation()
    want = sorted(
        (i, len(library.encode(t, add_special_tokens=False).ids))
        for i, (t, _) in left.items() if taken[i][0] for _ in range(taken[i][3] // taken[i][0])
    )
    assert sorted((r.doc_id, r.n_tokens) for r in corpus_pipeline.run(spark, sf_dir).collect()) == want
