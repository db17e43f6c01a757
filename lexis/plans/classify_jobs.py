"""Classification queries over fixture F5 (documents joined to labels)."""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import functions as F

from lexis.operators import classify as nb
from lexis.operators import topterms
from lexis.sources import fixtures as fx
from lexis.sources.tables import table


def samples(spark, sf_dir, label="quality"):
    return fx.labelled_samples(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), label)


@lru_cache(maxsize=8)
def raw_tokens(spark, sf_dir):
    """Not cached: the lemma table reads it once and the terms once, and only an uncached
    plan keeps a sample's tokens together up to its counted terms."""
    return nb.raw_tokens(samples(spark, sf_dir))


def lemmas(spark, sf_dir):
    return fx.lemma_table(raw_tokens(spark, sf_dir).select(F.col("token").alias("term")))


@lru_cache(maxsize=8)
def tokens(spark, sf_dir, label="quality"):
    return nb.tokenise(None, lemmas(spark, sf_dir), toks=raw_tokens(spark, sf_dir))


@lru_cache(maxsize=8)
def holdout(spark, sf_dir, label="quality"):
    s = samples(spark, sf_dir, label)
    return nb.run_folds(tokens(spark, sf_dir, label), s, nb.holdout_assignment(s))


@lru_cache(maxsize=8)
def cross_validation(spark, sf_dir, label="quality", k=3):
    s = samples(spark, sf_dir, label).where("is_train")
    return nb.cross_validate(tokens(spark, sf_dir, label), s, k)


def digit_normalise(spark, sf_dir):
    return nb.normalise(samples(spark, sf_dir)).select("sample_id", "text")


def lemma_map(spark, sf_dir):
    return lemmas(spark, sf_dir)


def term_freq(spark, sf_dir):
    s = samples(spark, sf_dir)
    per = nb.sample_terms(tokens(spark, sf_dir))
    f = nb.term_frequencies(per, nb.holdout_assignment(s))
    return f.select("term", F.col("cnt").cast("bigint").alias("cnt"))


def vocab_band(spark, sf_dir):
    return holdout(spark, sf_dir)["vocab"].select("term", "rank")


def vocab_band_bounds(spark, sf_dir):
    """The same band from local counts and bounds, without moving the vocabulary."""
    train = samples(spark, sf_dir).where("is_train")
    toks = nb.tokenise(None, lemmas(spark, sf_dir), toks=nb.raw_tokens(train))
    return topterms.top_terms(toks, nb.MAX_FEATURES, nb.SKIP_N_FEATURES).select("term", "rank")


def doc_term_presence(spark, sf_dir):
    return holdout(spark, sf_dir)["presence"].select("sample_id", "term")


def nb_counts(spark, sf_dir):
    lab = holdout(spark, sf_dir)["model"]["labels"]
    return lab.select("label", F.col("n_l").cast("bigint").alias("n_docs"),
                      F.col("T_l").cast("bigint").alias("n_present"))


def nb_term_counts(spark, sf_dir):
    t = holdout(spark, sf_dir)["model"]["terms"]
    return t.select("label", "term", F.col("n_lt").cast("bigint").alias("cnt"))


def nb_classify(spark, sf_dir):
    s = holdout(spark, sf_dir)["scores"]
    return s.select("sample_id", "label", F.round("score", 4).alias("score"))


def nb_holdout(spark, sf_dir):
    p = holdout(spark, sf_dir)["predictions"]
    return p.select("sample_id", F.col("label").alias("original_label"), F.col("predicted").alias("classifier_label"))


def nb_holdout_accuracy(spark, sf_dir):
    acc = nb.accuracy(holdout(spark, sf_dir)["predictions"])
    return acc.select("n", "correct", F.round("accuracy", 6).alias("accuracy"))


def nb_holdout_lang_accuracy(spark, sf_dir):
    acc = nb.accuracy(holdout(spark, sf_dir, "lang")["predictions"])
    return acc.select("n", "correct", F.round("accuracy", 6).alias("accuracy"))


def nb_folds(spark, sf_dir):
    s = samples(spark, sf_dir).where("is_train")
    a = nb.cv_assignment(s, 3)
    return a.where("is_test").select("sample_id", F.col("fold_id").alias("fold"))


def nb_cv(spark, sf_dir):
    acc = nb.accuracy(cross_validation(spark, sf_dir)["predictions"])
    return acc.select(F.col("fold_id").alias("fold"), "n", "correct", F.round("accuracy", 6).alias("accuracy"))


def nb_cv_mean(spark, sf_dir):
    acc = nb.accuracy(cross_validation(spark, sf_dir)["predictions"])
    return nb.mean_accuracy(acc).select(F.round("mean_accuracy", 6).alias("mean_accuracy"), "folds")


QUERIES = {
    "digit_normalise": digit_normalise,
    "lemma_map": lemma_map,
    "term_freq": term_freq,
    "vocab_band": vocab_band,
    "vocab_band_bounds": vocab_band_bounds,
    "doc_term_presence": doc_term_presence,
    "nb_counts": nb_counts,
    "nb_term_counts": nb_term_counts,
    "nb_classify": nb_classify,
    "nb_holdout": nb_holdout,
    "nb_holdout_accuracy": nb_holdout_accuracy,
    "nb_holdout_lang_accuracy": nb_holdout_lang_accuracy,
    "nb_folds": nb_folds,
    "nb_cv": nb_cv,
    "nb_cv_mean": nb_cv_mean,
}
