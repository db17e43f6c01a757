"""Folds by subtraction against folds that are counted one by one."""

import random

import pytest

from lexis.operators import classify as nb


@pytest.mark.parametrize("k, n, n_labels, skip, top", [(3, 40, 3, 2, 9), (5, 23, 12, 0, 4), (2, 6, 2, 0, 500), (4, 30, 30, 1, 6)])
def test_equals_folds_counted_one_by_one(spark, k, n, n_labels, skip, top):
    rng = random.Random(k * n)
    vocab = [f"t{i}" for i in range(25)]
    samples = [(10 * i, rng.choice([f"L{j}" for j in range(n_labels)])) for i in range(n)]
    toks = [(s, p, rng.choice(vocab[:rng.randint(1, 25)])) for s, _ in samples for p in range(rng.choice([0, 1, 5, 20]))]
    labels = spark.createDataFrame(samples, "sample_id long, label string")
    tokens = spark.createDataFrame(toks, "sample_id long, pos int, term string")
    got = nb.cross_validate(tokens, labels, k, skip, top)
    assign = nb.cv_assignment(labels, k)
    want = nb.run_folds(tokens, labels, assign, skip, top)
    rows = lambda df, *c: sorted(tuple(r) for r in df.select(*c).collect())
    assert rows(got["vocab"], "fold_id", "term", "rank") == rows(want["vocab"], "fold_id", "term", "rank")
    for name, cols in (("terms", ["fold_id", "label", "term", "n_lt"]), ("labels", ["fold_id", "label", "n_l", "label_ord", "T_l", "N", "T"])):
        assert rows(got["model"][name], *cols) == rows(want["model"][name], *cols)
    # every label met, as the paired scores do it
    paired = nb.predict(want["scores"])
    cols = ["fold_id", "sample_id", "predicted"]
    assert rows(got["predictions"], *cols) == rows(paired, *cols) == rows(want["predictions"], *cols)
