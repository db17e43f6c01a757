"""Steps whose work must not grow faster than their input, and their results."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from lexis.operators import backoff, phrases, rules, suffixgrams
from lexis.operators import sequences as sq
from lexis.operators.rules import positions
from lexis.plans import tagging_jobs as tj


def exchanges(df):
    return df._jdf.queryExecution().sparkPlan().toString().count("RepartitionByExpression") + \
        df._jdf.queryExecution().executedPlan().toString().count("Exchange ")


LINES = [("a", 1, "x A"), ("a", 2, "\ty B\t"), ("a", 3, ""), ("a", 4, "  "), ("a", 5, "z mid C"), ("a", 6, ""),
         ("a", 7, "open D"), ("b", 1, "u E"), ("b", 2, ""), ("c", 1, "never F")]


@pytest.mark.parametrize("most", [1_000_000, 3, 0])
def test_sentences_of_files_of_any_size(spark, monkeypatch, most):
    monkeypatch.setattr(sq, "MAX_FILE_LINES", most)
    df = spark.createDataFrame(LINES, "file string, line_no int, line string").repartition(3)
    out = sq.sentences_from_lines(df)
    assert sorted(map(tuple, out.collect())) == [
        ("a", 0, 1, "x", "A"), ("a", 0, 2, "y", "B"), ("a", 2, 1, "z", "C"), ("b", 0, 1, "u", "E")]


def test_lines_travel_once_and_repeated_ones_are_not_multiplied(spark):
    df = spark.createDataFrame(LINES * 2, "file string, line_no int, line string")
    out = sq.sentences_from_lines(df)
    assert exchanges(out) == 1
    assert Counter(r["word"] for r in out.collect()) == {"x": 2, "y": 2, "z": 2, "u": 2}


def state(spark):
    rows = [(1, ["the", "dog", "ran"], ["DT", "NN", "VB"], ["DT", "VB", "VB"]),
            (2, ["a", "b c", None], ["DT", "NN", None], ["DT", "NN", "NN"]), (3, ["the"], ["DT"], ["NN"])]
    return spark.createDataFrame(rows, "sent_id long, words array<string>, gold array<string>, cur array<string>")


def test_rule_counts_equal_those_of_all_positions_from_fewer_rows(spark):
    st = state(spark)
    cols = ["tpl", "key", "cur", "gold", "cnt"]
    want = positions(st).groupBy("tpl", "key", "cur", "gold").agg(F.count(F.lit(1)).alias("cnt")).select(cols)
    assert sorted(map(str, rules.rule_counts(st).select(cols).collect())) == sorted(map(str, want.collect()))
    assert len(rules._shared()) < len(rules.TEMPLATES)


def test_backoff_model_is_counted_without_sorting(spark):
    packed = spark.createDataFrame([(2, ["x", "x"], ["A", "B"]), (1, ["x", "y"], ["B", "A"])],
                                   "sent_id long, words array<string>, tags array<string>")
    model = backoff.fit_backoff(packed)
    plan = model._jdf.queryExecution().executedPlan().toString().splitlines()
    # tokens are counted by hash; only the counted contexts are ordered, for the most frequent tag
    assert not [row for row in plan if "SortAggregate" in row and "count(1)" in row]
    got = {(r["order"], r["ctx"], r["word"]): r["tag"] for r in model.collect()}
    # two tags of "x" once in each sentence: the tie goes to the one seen first
    assert got[(1, "", "x")] == "B" and got[(2, "^", "x")] == "B" and got[(3, "^ A", "x")] == "B" and got[(2, "B", "y")] == "A"


def test_packed_sentences_hold_no_cached_blocks(spark):
    from conftest import SF_SMALL
    level = tj.packed(spark, SF_SMALL).storageLevel
    assert not (level.useMemory or level.useDisk)


def test_backoff_model_holds_no_cached_blocks(spark):
    from conftest import SF_SMALL
    level = tj.backoff_model_df(spark, SF_SMALL).storageLevel
    assert not (level.useMemory or level.useDisk)


def test_tokens_are_counted_with_their_tags_once(spark, monkeypatch):
    monkeypatch.setattr(tj, "UNK_THRESHOLD", 1)
    gold = spark.createDataFrame([(1, ["a", "a", "b"], ["X", "X", "Y"]), (2, ["a"], ["Y"])], "sent_id long, words array<string>, tags array<string>")
    emission = tj._replaced_hmm(gold)["emission"]
    assert "Generate" not in emission._jdf.queryExecution().optimizedPlan().toString()
    got = {(r["tag"], r["word"]): r["logp"] for r in emission.collect()}
    assert got == {("X", "a"): 0.0, ("Y", "a"): -1.0, ("Y", "<UNK>"): -1.0}


def test_grams_below_the_cutoff_are_not_written(spark, monkeypatch):
    seen = {}
    real = suffixgrams.written
    monkeypatch.setattr(suffixgrams, "written", lambda df, name: seen.setdefault(name, real(df, name)))
    df = spark.createDataFrame([(" ".join(f"w{i}" for i in range(200)) + " w7 w7",)], "text string").coalesce(1)
    out = suffixgrams.ngram_counts(df, [], F.split("text", " "), 2, " ", min_count=2).collect()
    assert [(r["gram"], r["cnt"]) for r in out] == [("w7", 3)]
    assert seen["grams"].where("not edge and cnt < 2").count() == 0


def test_many_phrases_do_not_meet_in_one_task(spark, monkeypatch):
    def none(_):
        raise AssertionError("an automaton of all phrases")
    monkeypatch.setattr(phrases, "_scan", none)
    known = spark.createDataFrame([("a b",), ("c",), ("b c",), ("x y",)], "phrase string")
    toks = spark.createDataFrame([(1, i, w) for i, w in enumerate(["a", "b", "c", None, "x y", "a b"], 1)], "sent_id long, i int, text string")
    out = phrases.find_phrases(known, toks, segment=2, block_bytes=4)
    assert sorted(map(tuple, out.collect())) == [(1, "a b", 1), (1, "b c", 2), (1, "c", 3)]
