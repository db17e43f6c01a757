"""The token automaton against comparing every span."""

import random

import pytest

from conftest import SF_SMALL
from lexis.operators import mentions as mn
from lexis.operators import phrases
from lexis.plans import relations_jobs as rj


@pytest.mark.parametrize("segment, block", [(3, 1 << 20), (1000, 40), (1, 1 << 20)])
def test_equals_comparing_spans(spark, segment, block):
    rng = random.Random(segment)
    words = ["a", "b", "ab", "", "ü"]
    known = [" ".join(rng.choice(words) for _ in range(rng.randint(1, 4))) for _ in range(40)] + [None, "never seen"]
    sents = {s: [rng.choice([*words, "other", None]) for _ in range(n)] for s, n in enumerate([1, 2, 3, 9, 60, 200])}
    rows = [(s, i, w) for s, ws in sents.items() for i, w in enumerate(ws, 1)] + [(None, 1, "a"), (1, None, "a")]
    rng.shuffle(rows)
    out = phrases.find_phrases(spark.createDataFrame([(p,) for p in known], "phrase string"),
                               spark.createDataFrame(rows, "sent_id long, i int, text string").repartition(3), segment, block)
    got = [tuple(r) for r in out.select("sent_id", "phrase", "start").collect()]
    want = {(s, p, i + 1) for p in set(known) - {None} for s, ws in sents.items()
            for i in range(len(ws)) if ws[i:i + len(p.split(" "))] == p.split(" ")}
    assert len(got) == len(set(got)) and set(got) == want


def test_no_phrases_or_no_tokens(spark):
    none = spark.createDataFrame([], "phrase string")
    toks = spark.createDataFrame([(1, 1, "a")], "sent_id long, i int, text string")
    assert phrases.find_phrases(none, toks).count() == 0
    assert phrases.find_phrases(spark.createDataFrame([("a",)], "phrase string"), toks.where("false")).count() == 0


def test_first_spans_are_those_of_span_matches(spark):
    rel, toks = rj.relations(spark, SF_SMALL), rj.relation_tokens(spark, SF_SMALL)
    cols = ["sent_id", "ord", "phrase", "start", "tags"]
    rows = lambda df: sorted(map(str, df.select(*cols).collect()))
    want = rows(mn.span_matches(rel, toks).withColumn("start", mn.F.col("start").cast("int")))
    assert want and rows(phrases.first_spans(rel, toks)) == want
