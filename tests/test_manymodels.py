"""Top models by inverted lists against scoring every model."""

import random

import pytest
from pyspark.sql import functions as F

from lexis.operators import langmodel as lm
from lexis.operators import manymodels


def corpus(spark, n_models, seed=1):
    """Models of a few alphabets, some tiny, some without bigrams, two equal ones."""
    rng = random.Random(seed)
    kinds = ["etaoin shrdlu", "enisr atdhul", "aeosr nidlc", "кажд оелитн"]
    text = lambda kind, n: "".join(rng.choice(kinds[kind]) for _ in range(n))
    rows = [(f"m{i:05d}", text(i % 4, rng.choice([1, 5, 60, 300]))) for i in range(n_models)]
    rows.append(("m_same", rows[3][1]))
    docs = [(i, text(i % 4, rng.choice([1, 2, 40, 150]))) for i in range(25)] + [(90, ""), (91, "zzz")]
    return spark.createDataFrame(rows, "model string, text string"), spark.createDataFrame(docs, "doc_id long, text string")


@pytest.mark.parametrize("mode, block", [("laplace", 7), ("interpolation", 1000)])
def test_top_models_equal_all_scores(spark, mode, block):
    train, docs = corpus(spark, 40)
    model = lm.fit_ngram_model(train)
    found = manymodels.identify_top(model, docs, mode, k=3, block=block)
    best = {}
    for r in lm.perplexity(model, docs, mode).where("perplexity is not null").collect():
        best.setdefault(r["doc_id"], []).append((round(r["perplexity"], 4), r["model"]))
    want = {d: sorted(v)[:3] for d, v in best.items()}
    got = {}
    for r in found.orderBy("doc_id", "rank").collect():
        got.setdefault(r["doc_id"], []).append((round(r["perplexity"], 4), r["model"]))
    assert got == want


def test_few_blocks_are_scored(spark, monkeypatch):
    """Pruning: with models of four alphabets, most blocks are never scored exactly."""
    asked = []
    exact = manymodels._exact
    monkeypatch.setattr(manymodels, "_exact", lambda a, *rest: (asked.append(a), exact(a, *rest))[1])
    rng = random.Random(5)
    kinds = ["etaoin shrdlu", "кажд оелитн", "αβγδ εζηθικ", "אבגד הוזחט"]
    text = lambda kind, n: "".join(rng.choice(kinds[kind]) for _ in range(n))
    train = spark.createDataFrame([(f"m{i:04d}", text(i % 4, 400)) for i in range(120)], "model string, text string")
    docs = spark.createDataFrame([(i, text(i % 4, 120)) for i in range(20)], "doc_id long, text string")
    model = lm.fit_ngram_model(train)
    found = manymodels.identify_top(model, docs, "laplace", k=1, block=5)
    best = lm.identify_best(model, docs, "laplace")
    same = found.join(best.select("doc_id", F.col("model").alias("other")), "doc_id").where("model = other")
    assert same.count() == 20
    assert sum(a.count() for a in asked) < 20 * 24 / 2      # 24 blocks


def test_no_documents_and_no_models(spark):
    train, docs = corpus(spark, 5)
    model = lm.fit_ngram_model(train)
    assert manymodels.identify_top(model, docs.limit(0), "laplace").collect() == []
    none = lm.fit_ngram_model(train.limit(0))
    assert manymodels.identify_top(none, docs, "laplace").collect() == []
