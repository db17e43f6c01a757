"""Decoding by segments against plain decoding in whole numbers."""

import random

import pytest
from pyspark.sql import functions as F

from lexis.operators import longviterbi as lv

LOW = -10**15


def make_model(spark, rng, tags, words, digits):
    """Some log probabilities missing; few digits make ties."""
    p = lambda: -round(rng.random() * 9, digits)
    start = [(t, p()) for t in tags if rng.random() < 0.7]
    trans = [(a, b, p()) for a in tags for b in tags if rng.random() < 0.7]
    emit = [(t, w, p()) for t in tags for w in words if rng.random() < 0.4] + [(tags[0], "w", -1.0)]
    return {"start": spark.createDataFrame(start, "tag string, logp double"),
            "transition": spark.createDataFrame(trans, "prev string, tag string, logp double"),
            "emission": spark.createDataFrame(emit, "tag string, word string, logp double")}, (start, trans, emit)


def plain(tags, tables, words):
    unit = lambda x: round(x * 10**9)
    start, trans, emit = ({r[:-1]: unit(r[-1]) for r in t} for t in tables)
    v = [start.get((t,), LOW) + emit.get((t, words[0]), LOW) for t in tags]
    back = []
    for w in words[1:]:
        step = [[v[i] + trans.get((a, b), LOW) for i, a in enumerate(tags)] for b in tags]
        back.append([s.index(max(s)) for s in step])
        v = [max(s) + emit.get((b, w), LOW) for s, b in zip(step, tags)]
    path = [v.index(max(v))]
    for b in reversed(back):
        path.append(b[path[-1]])
    return [tags[k] for k in reversed(path)], max(v)


@pytest.mark.parametrize("tags, segment, fan, digits", [
    (["A", "B|A", "C"], 3, 2, 0), (["A", "B", "C", "D"], 5, 3, 9), (["only"], 4, 2, 1), (["A", "B"], 512, 64, 0)])
def test_equals_plain_decoding(spark, tags, segment, fan, digits):
    rng = random.Random(len(tags) * 10 + segment)
    vocab = ["w", "x", "y", "z"]
    model, tables = make_model(spark, rng, tags, vocab, digits)
    texts = {i: [rng.choice([*vocab, "unseen", None]) for _ in range(n)]
             for i, n in enumerate([1, segment, segment + 1, 2 * segment, 37, 90, 3, segment * fan, segment * fan * fan % 700 + 1])}
    rows = [(i, p, w) for i, ws in texts.items() for p, w in enumerate(ws, 1)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "sent_id long, pos int, word string").repartition(5)
    got = {}
    for r in lv.tag_long(df, model, keep="word", segment=segment, fan=fan).collect():
        got.setdefault(r["sent_id"], []).append((r["pos"], r["word"], r["tag"], int(r["score"] * 10**9)))
    assert set(got) == set(texts)
    for i, ws in texts.items():
        want, score = plain(tags, tables, ws)
        assert sorted(got[i]) == [(p, w, t, score) for p, (w, t) in enumerate(zip(ws, want), 1)], i


def test_scores_beyond_64_bits_and_empty_input(spark):
    rng = random.Random(5)
    model, tables = make_model(spark, rng, ["A", "B"], ["w"], 3)
    words = ["unseen"] * 12000   # every token costs a floor and more: 1.2e19 units
    df = spark.createDataFrame([(7, p, w) for p, w in enumerate(words, 1)], "sent_id long, pos int, word string")
    out = lv.tag_long(df, model).orderBy("pos").collect()
    want, score = plain(["A", "B"], tables, words)
    assert score < -2**63 and [r["tag"] for r in out] == want
    assert {int(r["score"] * 10**9) for r in out} == {score}
    assert lv.tag_long(df.where("false"), model).collect() == []
    none = {k: v.where("false") for k, v in model.items()}
    assert lv.tag_long(df, none).collect() == []
    nulls = df.limit(2).unionByName(df.limit(1).withColumn("pos", F.lit(None).cast("int")))
    assert lv.tag_long(nulls, model).count() == 2
    with pytest.raises(ValueError):
        lv.tag_long(df, model, segment=5000)
