"""Steps whose tasks must stay small as their input grows, and their results."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from lexis.operators import classify as nb
from lexis.operators import langmodel as lm
from lexis.operators import sequences as sq
from lexis.plans import classify_jobs as cj
from lexis.plans import sizing

TEXTS = [("a", "xyzxyz"), ("a", "xy"), ("b", "z"), ("b", "h\U0001f600llo \U0001f600l"), (None, "xyz"), ("a", None), ("b", ""), ("a", "x\ny")]


@pytest.mark.parametrize("held", [4_000_000, 1])
def test_trigrams_are_counted_in_tasks(spark, monkeypatch, held):
    monkeypatch.setattr(lm, "HELD_CHARS", held)
    model = lm.fit_ngram_model(spark.createDataFrame(TEXTS, "model string, text string").coalesce(1))
    want = Counter()
    for m, t in TEXTS:
        t = (t or "").replace("\n", "")
        want.update((m, n, t[i:i + n]) for n in (1, 2, 3) for i in range(len(t) - n + 1))
    assert {(r["model"], r["n"], r["gram"]): r["cnt"] for r in model.grams.collect()} == dict(want)
    src = spark.createDataFrame(TEXTS, "model string, t string").coalesce(1)
    assert "Generate" not in lm._counted_trigrams(src)._jdf.queryExecution().executedPlan().toString()


def test_scoring_tasks_grow_in_number_not_in_size(spark, monkeypatch):
    monkeypatch.setattr(lm, "UNITS_PER_TASK", 10)
    docs = spark.range(40).select(F.col("id").alias("doc_id"), F.lit("xyzxyz").alias("t"), F.lit(6).alias("m"))
    assert lm._tasks_for(docs) == 24
    assert lm._tasks_for(docs.where("false")) >= 1
    weights = spark.createDataFrame([("a", "xyz", 1.5)], "model string, gram string, w double")
    sums = lm._score_sums(docs, lm.char_ngrams(F.col("t"), 3), weights, ["a"])
    assert "hashpartitioning(doc_id" in (plan := sums._jdf.queryExecution().executedPlan().toString()) and ", 24)" in plan
    assert {r["s0"] for r in sums.collect()} == {3.0}


def test_frequent_words_are_not_moved_to_one_task(spark, monkeypatch):
    monkeypatch.setattr(sizing, "HEAD_KEYS", 2)
    words = ["the"] * 9 + ["new"] * 8 + ["a", "b", "a", "c", None]
    rows = spark.createDataFrame([(i, w) for i, w in enumerate(words)], "n int, word string")
    table = spark.createDataFrame([("the", 5), ("a", 2), ("a", 3), ("b", 1), (None, 7)], "word string, x int")
    want = sorted(map(str, rows.join(table, "word", "left").select("n", "word", "x").collect()))
    out = sizing.lookup_join(rows, table, "word", max_bytes=0)
    assert sorted(map(str, out.select("n", "word", "x").collect())) == want
    assert sizing.lookup_join(rows, table, "word").columns == out.columns
    moved = rows.join(out.where("word in ('the', 'new')").select("n"), "n", "left_anti")
    assert moved.count() == 5


def aligned(spark, truth, pred):
    kind = "sent_id long, pos int, word string, tag string"
    counts = spark.createDataFrame([("w", 3)], "word string, cnt long")
    out = sq.align_tags(spark.createDataFrame(truth, kind), spark.createDataFrame(pred, kind), counts)
    return out, sorted(map(tuple, out.select("idx", "truth_word", "truth_tag", "pred_word", "pred_tag", "train_count").collect()), key=str)


def test_sentences_at_the_same_place_are_zipped_and_others_joined(spark):
    truth = [(1, 1, "w", "A"), (1, 2, "v", None), (3, 1, "u", "B"), (5, 1, "t", "C"), (5, 2, "s", "C")]
    out, rows = aligned(spark, truth, truth)
    assert rows == [(1, "w", "A", "w", "A", 3), (2, "v", None, "v", None, 0), (3, "u", "B", "u", "B", 0),
                    (4, "t", "C", "t", "C", 0), (5, "s", "C", "s", "C", 0)]
    # one sentence at the same place, then other ids and lengths, cut to the shorter
    _, rows = aligned(spark, truth, [(1, 1, "w", "B"), (1, 2, "w", "A"), (2, 1, "x", "D"), (2, 2, "y", "E")])
    assert rows == [(1, "w", "A", "w", "B", 3), (2, "v", None, "w", "A", 3), (3, "u", "B", "x", "D", 0), (4, "t", "C", "y", "E", 0)]
    # positions that come twice meet as often as they come
    _, rows = aligned(spark, [(1, 1, "w", "A")] * 2, [(1, 1, "w", "B"), (1, 2, "q", "B")])
    assert rows == [(1, "w", "A", "w", "B", 3)] * 2


def test_terms_of_a_sample_are_not_moved_to_be_joined(spark):
    from conftest import SF_SMALL
    assert not cj.raw_tokens(spark, SF_SMALL).storageLevel.useMemory
    samples = spark.createDataFrame([(1, "x", "a b b", True), (2, "y", "b c", True), (3, "x", "a c", False), (3, "z", "a c", False)],
                                    "sample_id long, label string, text string, is_train boolean")
    toks = nb.tokenise(samples)
    run = nb.run_folds(toks, samples, nb.holdout_assignment(samples), 0, 10)
    per, assign = nb.sample_terms(toks), nb.holdout_assignment(samples)
    freqs = nb.term_frequencies(per, assign)
    plan = freqs._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan
    vocab = nb.vocab_band(freqs, 0, 10)
    assert sorted(map(tuple, run["vocab"].collect())) == sorted(map(tuple, vocab.collect()))
    pres = nb.presence(per, assign, vocab)
    rows = lambda df: sorted(map(str, df.select("fold_id", "sample_id", "term", "is_test").collect()))
    assert rows(run["presence"]) == rows(pres)
    model = nb.fit_nb(pres, assign, samples)
    for k, cols in (("labels", ["fold_id", "label", "n_l", "label_ord", "T_l", "N", "T"]), ("terms", ["fold_id", "label", "term", "n_lt"])):
        assert sorted(map(str, run["model"][k].select(cols).collect())) == sorted(map(str, model[k].select(cols).collect()))


def test_hmm_counts_words_before_they_are_replaced(spark):
    from lexis.operators import hmm
    from lexis.plans import tagging_jobs as tj
    gold = spark.createDataFrame([(1, ["a", "b"], ["X", "Y"]), (1, ["a", "b"], ["X", "Y"]), (2, ["b", "c", "a"], ["Y", "X", "X"]),
                                  (3, ["d"], ["X"]), (4, ["e", "b"], ["Y", "X"])], "sent_id long, words array<string>, tags array<string>")
    t = sq.unpack(gold)
    r = sq.replace_rare(t, sq.word_counts(t), 1).select("sent_id", "pos", F.col("model_word").alias("word"), "tag")
    want, got = hmm.fit_hmm(sq.pack(r)), tj._replaced_hmm(gold)
    for k in want:
        assert got[k].columns == want[k].columns
        assert sorted(map(tuple, got[k].collect())) == sorted(map(tuple, want[k].collect()))
    plan = got["emission"]._jdf.queryExecution().executedPlan().toString()
    assert "collect_list" not in plan
