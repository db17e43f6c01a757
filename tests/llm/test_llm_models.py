"""Neighbours, toxicity, main text, and the pipeline."""

import random
import zlib

import numpy as np
import pytest
from llm_cases import DOCS, empty_docs, odd_docs, pairs, words

from lexis.llm import mainpage, neighbours, toxicity


@pytest.mark.parametrize("kind", ["random", "clustered", "hot"])
def test_neighbours_equal_brute_force(spark, monkeypatch, kind):
    from pyspark.sql import functions as F
    monkeypatch.setattr(neighbours, "ROW_BLOCK", 100)
    monkeypatch.setattr(neighbours, "QUERY_BLOCK", 7)
    rng = np.random.default_rng(1)
    x = rng.normal(size=(700, 16)).astype(np.float32)
    if kind == "clustered":
        x = np.repeat(x[:70], 10, axis=0) + rng.normal(size=x.shape).astype(np.float32) * 1e-4
    if kind == "hot":
        x[:300] = x[0]
    rows = [(i, v.tolist(), 0) for i, v in enumerate(x)]
    odd = [(1000, None, 0), (1100, [0.0] * 16, 0), (1200, [float("nan")] * 16, 0), (1300, [float("inf")] + [1.0] * 15, 0),
           (1400, [None] + [1.0] * 15, 0), (1500, [], 0), (1600, [1.0, 2.0], 0), (None, [1.0] * 16, 0), rows[100], rows[3]]
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>, label int").withColumn("rank", F.lit(1)).withColumn("id", F.lit(0))
    got = pairs(neighbours.nearest(df, df.where("vec_id % 100 = 0"), k=10), "query_id", "rank", "vec_id", "score")
    want = []
    y = x.astype(np.float64)
    for q in range(0, 700, 100):
        d = np.sqrt(((y - y[q]) ** 2).sum(axis=1))
        best = sorted((d[i], i) for i in range(700) if i != q)[:10]
        want += [(q, r + 1, i, s) for r, (s, i) in enumerate(best)]
    assert [g[:3] for g in got] == [w[:3] for w in want]
    assert np.allclose([g[3] for g in got], [w[3] for w in want], rtol=1e-12, atol=0)
    assert neighbours.nearest(df.limit(0), df).count() == 0 and neighbours.nearest(df, df.limit(0)).count() == 0


def toxic_corpus(n=900):
    rng = random.Random(5)
    bad = ["idiotic", "scumbag", "worthless", "vermin"]
    rows, labels = [], []
    for i in range(n):
        w = words(rng, 60, "aeiorstnl").split()
        toxic = i % 6 == 0
        if toxic:
            for _ in range(3):
                w[rng.randrange(len(w))] = rng.choice(bad)
        rows.append((i, " ".join(w), "en", "s", 0))
        labels.append((i, 1, int(toxic)))
    return rows, labels


def test_toxicity_on_held_out_rows(spark):
    rows, labels = toxic_corpus()
    docs = spark.createDataFrame(rows, DOCS)
    lab = spark.createDataFrame([x for x in labels if zlib.crc32(str(x[0]).encode()) % 5], "doc_id long, quality int, toxic int")
    model = toxicity.fit(docs, lab)
    got = {r["doc_id"]: r["toxicity"] for r in toxicity.score(docs, model).collect()}
    held = [x for x in labels if zlib.crc32(str(x[0]).encode()) % 5 == 0]
    right = sum((got[i] >= 0.5) == bool(t) for i, _, t in held)
    assert right >= 0.95 * len(held)
    odd = toxicity.score(odd_docs(spark), model)
    assert odd.count() == odd_docs(spark).count() and odd.where("toxicity is null or toxicity < 0 or toxicity > 1").count() == 0
    assert toxicity.score(empty_docs(spark), model).count() == 0
    kept = docs.where(toxicity.scorer(model)("text") < 0.5)
    assert kept.count() == sum(s < 0.5 for s in got.values())


def test_toxicity_without_labels(spark):
    docs = odd_docs(spark)
    model = toxicity.fit(docs, spark.createDataFrame([], "doc_id long, quality int, toxic int"))
    assert {r["toxicity"] for r in toxicity.score(docs, model).collect()} == {0.0}


PAGES = {
    "<body><nav><a href=x>menu</a></nav><article><h1>T&amp;T</h1><p>One\n two<br>three<p>four</article><footer>foot</footer></body>":
        "T&T\nOne two three\nfour",
    "<div class=ad>buy</div><main><p>a &lt;b&gt; c</p><aside>no</aside><form><p>no</p></form><p>d</p></main>": "a <b> c\nd",
    "<div id='comments'><p>no</p></div><article><script>var t='</p>';</script><style>p{}</style><p>x<!-- no --> y</p></article>": "x y",
    "<nav><ul><li><a href=1>a</a></li></ul></nav><div><p>" + "long text " * 20 + "</p><p>short.</p></div><div class=footer>no</div>":
        ("long text " * 20).strip() + "\nshort.",
    "<article><p>unclosed <b>bold<p>next": "unclosed bold\nnext",
    "": "", "<html></html>": "", "<article></article>": "", "no markup": "no markup", "a < b <3": "a < b <3",
    "<article><p>x</p>" + "<p></p>" * 10 + "<p>y</p></article>": "x\ny",
}


def test_main_text(spark):
    rows = [(i, f"u{i}", h) for i, h in enumerate(PAGES)] + [(99, None, None), (0, "u0", next(iter(PAGES)))]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    from pyspark.sql import functions as F
    got = sorted((r["page_id"], r["main"]) for r in mainpage.extract(df.withColumn("text", F.lit(1)).withColumn("main", F.lit(2))).collect())
    assert got == sorted([(i, t) for i, t in enumerate(PAGES.values())] + [(99, ""), (0, next(iter(PAGES.values())))])
    assert mainpage.extract(df.limit(0)).count() == 0


def test_main_text_of_every_test_page(spark):
    """Independent reading of the pages' own layout: blocks of the article element."""
    import html
    import re

    from conftest import SF_SMALL
    df = spark.read.parquet(f"{SF_SMALL}/pages.parquet")
    got = {r["page_id"]: r["main"] for r in mainpage.extract(df).collect()}
    for r in df.collect():
        body = re.search(r"<article>(.*)</article>", r["html"], re.S)[1]
        blocks = [" ".join(html.unescape(re.sub(r"<[^>]+>", " ", b)).split()) for b in re.split(r"</?(?:p|h1)>", body)]
        assert got[r["page_id"]] == "\n".join(b for b in blocks if b)
    assert len(got) == df.count()


def test_main_text_of_interrupted_unmarked_pages():
    long, menu = "A long part of the text. " * 40, "<ul>" + "<li><a href=x>Some title</a> 3 min</li>" * 5 + "</ul>"
    cases = {
        f"{menu}<div><p>{long}</p></div>{menu}<p>A short close.</p>{menu}": f"{long.strip()}\nA short close.",
        f"<p>{long}</p><div class=ad><p>buy</p><p>now</p><p>here</p></div><p>One.</p>{menu}<p>End.</p>": f"{long.strip()}\nOne.\nEnd.",
        f"<p>{long}</p><p>See <a href=1>this long title</a> and <a href=2>that one</a>.</p>": f"{long.strip()}\nSee this long title and that one.",
    }
    assert {h: mainpage.main_text(h) for h in cases} == cases


def test_block_sums_decide_on_unmarked_pages(monkeypatch):
    long = "A long part of the text. " * 10
    title, foot = "<div>Example Site</div>", "<div>Copyright 2024 Example Corp</div>"
    far = "".join(f"<div>Notice {i}.</div>" for i in range(12))
    page = f"{title}<h1>The heading</h1><p>{long}</p><h2>Part</h2><p>{long}</p><p>So it ends.</p>{foot}"
    text = f"The heading\n{long.strip()}\nPart\n{long.strip()}\nSo it ends."
    assert mainpage.main_text(page) == text
    # short lines far from the text: below the dive level, although each ends as a sentence
    assert "Notice 9" not in mainpage.main_text(page + far) and mainpage.main_text(page + far).startswith(text)
    huge = f"<p>{long * 200}</p>" + f"<p>{long}</p>" * 3
    assert mainpage.main_text(huge).count("\n") == 3
    monkeypatch.setattr(mainpage, "block_sums", lambda weight: [10**6] * len(weight))
    assert "Notice 9" in mainpage.main_text(page + far)


def test_text_after_scripts_and_characters_that_grow_when_lower_cased():
    page = f"<article><p>{'İ' * 20}</p><script>x</script><p>hello world</p><p>tail</p></article>"
    for pad in (0, 5000):
        assert mainpage.main_text(page + " " * pad) == f"{'İ' * 20}\nhello world\ntail"


def test_hostile_pages_take_linear_time():
    import time
    n = 100_000
    for page in ("<b>" * n + "</i>" * n, "<b>" * n + "<div></div>" * n, "<b><div>" + "<i>" * n + "</b>" * n, "<p>" * n + "x"):
        began = time.process_time()
        mainpage.main_text(page)
        assert time.process_time() - began < 5


def test_neighbours_of_huge_and_tiny_vectors(spark):
    rows = [(0, [1e160, 2e160]), (1, [1e160, 2e160]), (2, [1.0, 2.0]), (3, [1e-200, 0.0]), (4, [2e-200, 0.0]),
            (5, [3e160, 2e160]), (6, [1.7e308, 1.0]), (7, [-1.7e308, 1.0]), (8, [1e-320, 0.0]), (9, [5e-200, 1e-210])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    from fractions import Fraction
    from math import isqrt
    got = {}
    for r in neighbours.nearest(df, df, k=3).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    assert sorted(got) == list(range(10))
    scale = 10**400
    for i, v in rows:
        exact = [(isqrt(int(sum((Fraction(a) - Fraction(b))**2 for a, b in zip(v, w)) * scale**2)), j) for j, w in rows if j != i]
        held = float(np.finfo(float).max)
        d = sorted((x / scale if x <= int(held) * scale else float("inf"), j) for x, j in exact)
        near = sorted(got[i])
        for (_, j, s), (x, _) in zip(near, d):
            assert s == x or abs(s - x) <= 1e-12 * x
            assert abs(s - dict((j, x) for x, j in d)[j]) <= 1e-12 * s or s == float("inf")
        assert all(a[2] < b[2] or a[1] < b[1] for a, b in zip(near, near[1:]))    # ties to the smaller id
