"""Hand-sized cases for the rules of SURVEY section 2.10."""

import itertools
import math

import pytest
from pyspark.sql import functions as F

from lexis.operators import classify as nb
from lexis.operators import hmm, langmodel as lm, mentions as mn, ordering, sequences as sq, trees
from lexis.sources import files


# ---------------------------------------------------------------- language models

def _corpus(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, lang string, text string")


# Worked by hand for the model "ab", "aab" (units a a a b b: T = 5, c(a)=3, c(b)=2; bigrams
# ab 2, aa 1: V = 2; trigram aab 1) and the model "bb" (T = 2, c(b)=2; bigram bb 1; V = 1).
#
# unsmoothed: p(u) = c(u)/(T+1), an unseen unit counts 1; text "ab": model 1
# 3/6 * 2/6 = 1/6 -> 6^(1/2); model 2 a is unseen 1/3 * 2/3 = 2/9 -> (9/2)^(1/2).
# laplace: p(b|a) = (c(ab)+1)/(c(a)+V) = 3/5 over M = 2 units -> (5/3)^(1/2); in model 2
# <UNK> is unseen: (0+1)/(0+1) = 1 -> 1.
HAND = {
    ("unsmoothed", "ab", "one"): 6 ** 0.5, ("unsmoothed", "ab", "two"): 4.5 ** 0.5,
    ("unsmoothed", "b", "one"): 3.0, ("unsmoothed", "b", "two"): 1.5,
    ("unsmoothed", "b\na", "one"): 6 ** 0.5,
    ("laplace", "ab", "one"): (5 / 3) ** 0.5, ("laplace", "ab", "two"): 1.0,
    ("laplace", "bb", "one"): 4 ** 0.5, ("laplace", "bb", "two"): (3 / 2) ** 0.5,
    # p(a|a) p(b|a) = 2/5 * 3/5 = 6/25 over 3 units
    ("laplace", "aab", "one"): (25 / 6) ** (1 / 3),
}


def test_perplexity_of_hand_worked_cases(spark):
    model = lm.fit_ngram_model(_corpus(spark, [(1, "one", "ab"), (2, "one", "aab"), (3, "two", "bb")]), "lang", "text")
    texts = sorted({t for _, t, _ in HAND})
    ev = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for mode in ("unsmoothed", "laplace"):
        got = {(texts[r.doc_id], r.model): r.perplexity for r in lm.perplexity(model, ev, mode).collect()}
        for (m, t, name), want in HAND.items():
            if m == mode:
                assert got[t, name] == pytest.approx(want, rel=1e-9), (m, t, name)


def test_interpolation_of_a_hand_worked_case(spark):
    """Model "aab": T = 3; one trigram aab with c1 = c(b) = 1, c2 = c(ab) = 1, c3 = 1.
    p1 = 0/2 = 0; p2 = 0/(2-1) = 0; p3 = 0/(1-1) = 0: all tie in every vote.  With the running
    vote order 1 wins 3 times... L1 = 1*(1+1+1) = 3, L2 = 1*(1+1) = 2, L3 = 1: 1/2, 1/3, 1/6.
    p(b|aa) = 1/2 * 1/4 + 1/3 * 1/2 + 1/6 * 1 = 11/24 over 3 units."""
    model = lm.fit_ngram_model(_corpus(spark, [(1, "m", "aab")]), "lang", "text")
    r = model.lambdas().collect()[0]
    assert (r.l1, r.l2, r.l3) == pytest.approx((1 / 2, 1 / 3, 1 / 6))
    ev = spark.createDataFrame([(1, "aab")], "doc_id long, text string")
    assert lm.perplexity(model, ev, "interpolation").collect()[0].perplexity == pytest.approx((24 / 11) ** (1 / 3))


def test_more_models_than_a_block(spark, monkeypatch):
    monkeypatch.setattr(lm, "MODEL_BLOCK", 3)
    rows = [(i, f"m{i}", "ab" * (i % 7 + 1) + "c" * (i % 5)) for i in range(8)]
    model = lm.fit_ngram_model(_corpus(spark, rows), "lang", "text")
    ev = spark.createDataFrame([(1, "abab"), (2, "cc")], "doc_id long, text string")
    blocks = [tuple(r) for r in lm.identify_best(model, ev, "laplace").orderBy("doc_id").collect()]
    long = lm.identify(lm.perplexity(model, ev, "laplace"), "laplace").orderBy("doc_id").collect()
    assert blocks == [tuple(r) for r in long]
    assert lm.perplexity(model, ev, "unsmoothed").count() == 16


def test_short_texts_score_one(spark):
    model = lm.fit_ngram_model(_corpus(spark, [(1, "x", "abcab")]), "lang", "text")
    ev = spark.createDataFrame([(1, "a"), (2, "ab")], "doc_id long, text string")
    lap = {r.doc_id: r.perplexity for r in lm.score_laplace(model, ev).collect()}
    itp = {r.doc_id: r.perplexity for r in lm.score_interpolation(model, ev).collect()}
    assert lap[1] == 1.0 and itp[1] == 1.0 and itp[2] == 1.0


def test_lambdas_sum_to_one_and_ties_go_to_first_model(spark):
    model = lm.fit_ngram_model(_corpus(spark, [(1, "m1", "abcabd"), (2, "m2", "abcabd")]), "lang", "text")
    for r in model.lambdas().collect():
        assert r.l1 + r.l2 + r.l3 == pytest.approx(1.0)
    ev = spark.createDataFrame([(1, "abd")], "doc_id long, text string")
    best = lm.identify(lm.perplexity(model, ev, "laplace"), "laplace").collect()
    assert best[0].model == "m1"
    direct = lm.identify_best(model, ev, "laplace").collect()
    assert [tuple(r) for r in direct] == [tuple(r) for r in best]


# ---------------------------------------------------------------- ordering / folds

def test_global_row_number_and_folds(spark):
    df = spark.range(0, 1000, 7, numPartitions=13).withColumnRenamed("id", "k")
    ranked = ordering.global_row_number(df, "k", "rn").orderBy("k").collect()
    assert [r.rn for r in ranked] == list(range(1, len(ranked) + 1))
    ten = spark.range(10).withColumnRenamed("id", "sample_id")
    sizes = sorted(((r.fold, r["count"]) for r in ordering.contiguous_folds(ten, "sample_id", 3)
                    .groupBy("fold").count().collect()))
    assert sizes == [(0, 4), (1, 3), (2, 3)]


def test_label_tie_goes_to_first_seen_label(spark):
    scores = spark.createDataFrame([(0, 1, "b", 5, -1.0), (0, 1, "a", 9, -1.0)],
                                   "fold_id int, sample_id long, label string, label_ord long, score double")
    assert nb.predict(scores).collect()[0].predicted == "b"


# ---------------------------------------------------------------- files

def test_tagged_file_blank_lines(spark, tmp_path):
    (tmp_path / "closed.txt").write_text("The DT\nfox NN\n\nruns VBZ\n\n\nfast RB\n")
    (tmp_path / "open.txt").write_text("a DT\nb NN\n")
    s = files.read_tagged_columns(spark, str(tmp_path / "closed.txt")).orderBy("sent_no", "pos").collect()
    assert [(r.sent_no, r.pos, r.word, r.tag) for r in s] == [(0, 1, "The", "DT"), (0, 2, "fox", "NN"),
                                                               (1, 1, "runs", "VBZ")]
    assert files.read_tagged_columns(spark, str(tmp_path / "open.txt")).count() == 0


def test_tabs_at_line_ends(spark, tmp_path):
    (tmp_path / "t.txt").write_text("The\tDT\t\n\tfox NN\n\n")
    s = files.read_tagged_columns(spark, str(tmp_path / "t.txt")).orderBy("pos").collect()
    assert [(r.word, r.tag) for r in s] == [("The", "DT"), ("fox", "NN")]
    (tmp_path / "s.txt").write_text("one two\n\t\n\u00a0three\u2003four\n", encoding="utf-8")
    s = files.read_sentences(spark, str(tmp_path / "s.txt")).orderBy("_block", "_row").collect()
    assert [r.words for r in s] == [["one", "two"], ["three", "four"]]


def test_mention_without_id_hides_no_entity(spark):
    rel = spark.createDataFrame([(1, "[[ Ann | /m/a ]] x [[ Paris ]] y [[ Bob | /m/b ]] z [[ Cy | /m/c ]]",
                                  (("Ann", "/m/a"), ("Bob", "/m/b")))],
                                "sent_id long, sentence string, pair struct<subject:struct<name:string,mid:string>,"
                                "object:struct<name:string,mid:string>>")
    assert [(r.role, r.mid) for r in mn.entity_roles(rel).orderBy("ord").collect()] == [
        ("SUBJECT", "/m/a"), ("OBJECT", "/m/b"), ("ENTITY1", "/m/c")]


def test_slash_tags_with_underscore_in_word(spark, tmp_path):
    (tmp_path / "t.txt").write_text("new_york_NNP is_VBZ\n\nok_JJ\n")
    r = files.read_slash_tags(spark, str(tmp_path / "t.txt")).orderBy("_block", "_row", "pos").collect()
    assert [(x.word, x.tag) for x in r] == [("new", "NNP"), ("is", "VBZ"), ("ok", "JJ")]


def test_csv_samples(spark, tmp_path):
    p = tmp_path / "s.csv"
    p.write_text('type,text\nsport,"a, b"\nbiz,"he said ""hi"""\ntech,"two\nlines"\n', encoding="utf-8")
    r = files.read_samples(spark, str(p)).orderBy("sample_id").collect()
    assert [(x.label, x.text) for x in r] == [("sport", "a, b"), ("biz", 'he said "hi"'), ("tech", "two\nlines")]
    bad = tmp_path / "bad.csv"
    bad.write_text("type,text\nsport,a,b\n")
    with pytest.raises(Exception):
        files.read_samples(spark, str(bad)).collect()


def test_relations_json(spark, tmp_path):
    p = tmp_path / "r.json"
    p.write_text('[{"sentence": "[[ Ann | /m/a ]] met [[ Bob | /m/b ]] near [[ Paris ]]",'
                 ' "pair": {"subject": {"name": "Ann", "mid": "/m/a"}, "object": {"name": "Bob", "mid": "/m/b"}}},'
                 ' {"sentence": "[[ Ann | /m/a ]] is [[ Ann | /m/a ]] /m/q",'
                 ' "pair": {"subject": {"name": "Ann", "mid": "/m/a"}, "object": {"name": "Ann", "mid": "/m/a"}}}]')
    rel = files.read_relations(spark, str(p))
    rw = {r.sent_id: r.text for r in mn.role_rewrite(rel).collect()}
    texts = sorted(rw.values())
    assert texts == ["SUBJECT is SUBJECT", "SUBJECT met OBJECT near"]
    ok = sorted(r.ok for r in rel.select(mn.entity_validity(rel).alias("ok")).collect())
    assert ok == [False, True]


# ---------------------------------------------------------------- HMM / trees

def test_viterbi_equals_brute_force(spark):
    train = spark.createDataFrame([
        (1, ["a", "b", "a"], ["X", "Y", "X"]), (2, ["b", "b"], ["Y", "Y"]),
        (3, ["a", "c", "b"], ["X", "Z", "Y"]), (4, ["c", "a"], ["Z", "X"])],
        "sent_id long, words array<string>, tags array<string>")
    model = hmm.fit_hmm(train)
    start = {r.tag: r.logp for r in model["start"].collect()}
    trans = {(r.prev, r.tag): r.logp for r in model["transition"].collect()}
    emit = {(r.tag, r.word): r.logp for r in model["emission"].collect()}
    states = sorted({"X", "Y", "Z"})
    sents = [["a"], ["a", "b"], ["b", "a", "c"], ["c", "c", "b", "a"], ["q", "a"]]
    toks = spark.createDataFrame([(i, p + 1, w) for i, s in enumerate(sents) for p, w in enumerate(s)],
                                 "sent_id long, pos int, word string")
    got = {}
    for r in hmm.tag_hmm(toks, model).collect():
        got.setdefault(r.sent_id, (r.score, {}))[1][r.pos] = r.tag
    for i, s in enumerate(sents):
        best = max(sum([start.get(p[0], hmm.FLOOR) + emit.get((p[0], s[0]), hmm.FLOOR)]
                       + [trans.get((p[k - 1], p[k]), hmm.FLOOR) + emit.get((p[k], s[k]), hmm.FLOOR)
                          for k in range(1, len(s))])
                   for p in itertools.product(states, repeat=len(s)))
        assert got[i][0] == pytest.approx(best, abs=1e-6)


def test_paths_and_lca(spark):
    toks = spark.createDataFrame([
        (1, 1, "SUBJECT", 0), (1, 2, "x", 1), (1, 3, "OBJECT", 2),
        (2, 1, "SUBJECT", 0), (2, 2, "OBJECT", 0)],
        "sent_id long, i int, text string, head int")
    r = {x.sent_id: x for x in trees.path_report(toks).collect()}
    assert r[1].object_path == "OBJECT -> x -> SUBJECT" and r[1].lca == "SUBJECT"
    assert r[2].lca == "-None-"


def test_unk_replacement(spark):
    t = spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (2, 1, "a")], "sent_id long, pos int, word string")
    counts = sq.word_counts(t)
    ev = spark.createDataFrame([(9, 1, "a"), (9, 2, "b"), (9, 3, "zz")], "sent_id long, pos int, word string")
    out = {r.pos: r.model_word for r in sq.replace_rare(ev, counts, 1, unseen_too=True).collect()}
    assert out == {1: "a", 2: "<UNK>", 3: "<UNK>"}


def test_hmm_tags_with_bars_stay_apart(spark):
    """``JJ|VBG`` after nothing and ``VBG|NN`` after ``JJ``: joined names would collide."""
    from lexis.operators import hmm
    rows = [(1, ["a", "b", "c"], ["JJ|VBG", "NN", "NN"]), (2, ["d", "e", "c"], ["JJ", "VBG|NN", "NN"]),
            (3, ["a", "e"], ["JJ|VBG", "NN"])]
    packed = spark.createDataFrame(rows, "sent_id long, words array<string>, tags array<string>")
    model = hmm.fit_hmm(packed)
    sents = spark.createDataFrame([(9, 1, "a"), (9, 2, "b"), (8, 1, "d"), (8, 2, "e"), (8, 3, "c")],
                                  "sent_id long, pos int, word string")
    got = {(r["sent_id"], r["pos"]): r["tag"] for r in hmm.tag_hmm(sents, model).collect()}
    assert got == {(9, 1): "JJ|VBG", (9, 2): "NN", (8, 1): "JJ", (8, 2): "VBG|NN", (8, 3): "NN"}
