"""Language-identification queries over fixture F1 (documents, model = lang)."""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexis.functions.text import char_text, word_units
from lexis.operators import langmodel as lm
from lexis.operators import manymodels, suffixgrams
from lexis.operators.ngrams import WORD_SEP
from lexis.sources import fixtures as fx
from lexis.sources.tables import table


def corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.language_corpus(table(spark, sf_dir, "documents"))


def _train(spark, sf_dir):
    return corpus(spark, sf_dir).where("is_train")


def _eval(spark, sf_dir):
    return corpus(spark, sf_dir).where("not is_train")


@lru_cache(maxsize=8)
def _model_cached(spark, sf_dir, unit, orders):
    return lm.fit_ngram_model(_train(spark, sf_dir), "lang", "text", orders, unit)


def char_model(spark: SparkSession, sf_dir: str) -> lm.NgramModel:
    return _model_cached(spark, sf_dir, "char", (1, 2, 3))


def char_ngram_counts(spark, sf_dir):
    return char_model(spark, sf_dir).grams.select(
        "model", F.col("n").cast("int").alias("n"), "gram", F.col("cnt").cast("bigint").alias("cnt"))


def model_stats(spark, sf_dir):
    s = char_model(spark, sf_dir).stats
    return s.select("model", (F.col("n_units") + 1).alias("n_tokens"), "n_types", "n_bigrams", "n_trigrams")


def oov_rate(spark, sf_dir):
    return lm.oov_rate(char_model(spark, sf_dir), _eval(spark, sf_dir)).select(
        "doc_id", "model", F.col("m").cast("bigint").alias("m"), "n_oov")


def _ppl(mode):
    def q(spark, sf_dir):
        s = lm.perplexity(char_model(spark, sf_dir), _eval(spark, sf_dir), mode)
        return s.select("doc_id", "model", F.round("perplexity", 4).alias("perplexity"))
    q.__name__ = f"lm_ppl_{mode}"
    return q


def interp_lambdas(spark, sf_dir):
    lam = char_model(spark, sf_dir).lambdas("running")
    return lam.select("model", *[F.round(f"l{i}", 6).alias(f"l{i}") for i in (1, 2, 3)])


def interp_lambdas_final(spark, sf_dir):
    lam = char_model(spark, sf_dir).lambdas("final")
    return lam.select("model", *[F.round(f"l{i}", 6).alias(f"l{i}") for i in (1, 2, 3)])


def best(spark, sf_dir, mode):
    return lm.identify_best(char_model(spark, sf_dir), _eval(spark, sf_dir), mode)


def _best(mode):
    def q(spark, sf_dir):
        return best(spark, sf_dir, mode).select("doc_id", "model", "perplexity", F.col("n").cast("int").alias("n"))
    q.__name__ = f"langid_best_{mode}"
    return q


def langid_confusion(spark, sf_dir):
    truth = _eval(spark, sf_dir).select("doc_id", F.col("lang").alias("label"))
    parts = [lm.identification_report(best(spark, sf_dir, m), truth).withColumn("mode", F.lit(m))
             for m in ("unsmoothed", "laplace", "interpolation")]
    out = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return out.select("mode", "label", "predicted", "cnt")


def word_ngram_counts(spark, sf_dir):
    """Word n-grams with <S> / </S> per line (orders 1 and 2)."""
    m = _model_cached(spark, sf_dir, "word_padded", (1, 2))
    return m.grams.select("model", F.col("n").cast("int").alias("n"), "gram", F.col("cnt").cast("bigint").alias("cnt"))


def lm_ppl_word_laplace(spark, sf_dir):
    """C10 + C3: word-level add-one bigram model, unpadded evaluation text."""
    m = _model_cached(spark, sf_dir, "word_padded", (1, 2))
    s = lm.score_laplace(m, _eval(spark, sf_dir))
    return s.select("doc_id", "model", F.round("perplexity", 4).alias("perplexity"))


def rare_words(spark, sf_dir):
    """C11: per training document, words and words replaced by <UNK>."""
    r = lm.rare_word_replace(_train(spark, sf_dir), "lang", "text", threshold=1)
    return (r.groupBy("doc_id", "model")
            .agg(F.count(F.lit(1)).cast("bigint").alias("n_words"),
                 F.sum((F.col("out") == "<UNK>").cast("int")).cast("bigint").alias("n_unk")))


def ngram_counts_1_to_6(spark, sf_dir):
    """C1 / W1 beyond trigrams: n-grams of 1 to 6 characters and words that occur twice and more, per language."""
    docs = table(spark, sf_dir, "documents")
    found = [suffixgrams.ngram_counts(docs, ["lang"], units(F.col("text")), 6, sep, min_count=2)
             .select(F.lit(unit).alias("unit"), F.col("lang").alias("model"), "n", "gram", "cnt")
             for unit, units, sep in (("char", char_text, ""), ("word", word_units, WORD_SEP))]
    return found[0].unionByName(found[1])


def langid_topk(spark, sf_dir):
    """C8 over many models: one per language and source, the 3 best of each evaluation document."""
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", "text", F.concat_ws("/", "lang", "source").alias("model"), fx.is_eval().alias("is_eval"))
    fitted = lm.fit_ngram_model(docs.where("not is_eval"), "model", "text", (1, 2, 3))
    found = manymodels.identify_top(fitted, docs.where("is_eval"), "laplace", k=3, block=8)
    return found.select("doc_id", "rank", "model", F.round("perplexity", 4).alias("perplexity"))


QUERIES = {
    "char_ngram_counts": char_ngram_counts,
    "model_stats": model_stats,
    "oov_rate": oov_rate,
    "lm_ppl_unsmoothed": _ppl("unsmoothed"),
    "lm_ppl_laplace": _ppl("laplace"),
    "interp_lambdas": interp_lambdas,
    "interp_lambdas_final": interp_lambdas_final,
    "lm_ppl_interpolation": _ppl("interpolation"),
    "langid_best_unsmoothed": _best("unsmoothed"),
    "langid_best_laplace": _best("laplace"),
    "langid_best_interpolation": _best("interpolation"),
    "langid_topk": langid_topk,
    "ngram_counts_1_to_6": ngram_counts_1_to_6,
    "langid_confusion": langid_confusion,
    "word_ngram_counts": word_ngram_counts,
    "lm_ppl_word_laplace": lm_ppl_word_laplace,
    "rare_words": rare_words,
}
