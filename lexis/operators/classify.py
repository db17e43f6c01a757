"""Naive Bayes document classification over a frequency-band vocabulary
(C24-C31).

A hold-out run is the one-fold case of ``run_folds``: rows carry a ``fold_id`` and
every aggregate groups by it.  ``cross_validate`` counts each fold once and takes a
training set as all folds without the one it tests.

Tables
------
``tokens(sample_id, pos, term)``          tokenised, lemma-mapped text
``assign(sample_id, fold_id, is_test)``   which samples train / test each fold
``vocab(fold_id, term, rank)``            ranks ``skip+1 .. max`` by count
``presence(fold_id, sample_id, term)``    distinct vocabulary terms per sample
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexis.functions.text import normalise_digits, word_tokens
from lexis.operators.ordering import contiguous_folds
from lexis.plans.sizing import bounded_broadcast

# Vocabulary band.
SKIP_N_FEATURES = 100
MAX_FEATURES = 600

PLACES = 1 << 31  # tokens of a sample are fewer


def normalise(samples: DataFrame, text_col: str = "text") -> DataFrame:
    """Digit runs -> 'D'."""
    return samples.withColumn(text_col, normalise_digits(F.col(text_col)))


def raw_tokens(samples: DataFrame, text_col: str = "text") -> DataFrame:
    """``sample_id, pos, token`` from digit-normalised text.

    Texts travel once, to their sample's task; counting its terms and joining its label
    or fold then move no tokens (a given number of tasks keeps them there)."""
    n = int(samples.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return samples.repartition(n, "sample_id").select("sample_id", F.posexplode_outer(word_tokens(normalise_digits(F.col(text_col))))
                          .alias("pos", "token")).where(F.col("token").isNotNull())


def tokenise(samples: DataFrame, lemmas: DataFrame | None = None, text_col: str = "text",
             toks: DataFrame | None = None) -> DataFrame:
    """``sample_id, pos, term`` from normalised text; with a lemma table
    ``(token, lemma)`` each token is replaced by its lemma (J14)."""
    if toks is None:
        toks = raw_tokens(samples, text_col)
    if lemmas is None:
        return toks.select("sample_id", F.col("pos").cast("int").alias("pos"), F.col("token").alias("term"))
    lem, _ = bounded_broadcast(lemmas.select("token", "lemma"))
    return (toks.join(lem, "token", "left")
            .select("sample_id", F.col("pos").cast("int").alias("pos"),
                    F.coalesce("lemma", "token").alias("term")))


def sample_terms(tokens: DataFrame) -> DataFrame:
    """Per sample and term: occurrences and first position (pre-aggregation
    that every fold reuses)."""
    return tokens.groupBy("sample_id", "term").agg(
        F.count(F.lit(1)).alias("cnt"), F.min("pos").alias("first_pos"))


def term_frequencies(per_sample: DataFrame, assign: DataFrame) -> DataFrame:
    """A7 per fold over its training samples: ``fold_id, term, cnt, first``
    where ``first`` = (sample_id, pos) of the first occurrence."""
    train = assign.where(~F.col("is_test")).select("sample_id", "fold_id")
    return (per_sample.join(train, "sample_id")
            .groupBy("fold_id", "term")
            .agg(F.sum("cnt").alias("cnt"), _first_seen(per_sample).alias("first")))


def _first_seen(per_sample: DataFrame):
    """The smallest (sample_id, first_pos): of whole numbers as one number, which a hash
    aggregate can keep."""
    if isinstance(per_sample.schema["sample_id"].dataType, T.IntegralType):
        place = F.col("sample_id").cast("decimal(38,0)") * F.lit(PLACES) + F.col("first_pos")
        return F.min(place.cast("decimal(38,0)"))
    return F.min(F.struct("sample_id", "first_pos"))


def vocab_band(freqs: DataFrame, skip: int = SKIP_N_FEATURES, max_features: int = MAX_FEATURES) -> DataFrame:
    """Rank by count, ties by first appearance; keep
    ``skip+1 .. max_features``.  The ``rank <= max`` filter on a row_number
    window lets Spark keep only the top rows per fold on the map side
    (window group limit) before the shuffle."""
    w = Window.partitionBy("fold_id").orderBy(F.col("cnt").desc(), F.col("first").asc())
    ranked = freqs.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= max_features)
    return ranked.where(F.col("rank") > skip).select("fold_id", "term", F.col("rank").cast("int").alias("rank"))


def presence(per_sample: DataFrame, assign: DataFrame, vocab: DataFrame) -> DataFrame:
    """Distinct vocabulary terms per sample and fold.  The
    vocabulary is at most ``max_features - skip`` rows per fold."""
    v = F.broadcast(vocab.select("fold_id", "term"))
    return (per_sample.select("sample_id", "term")
            .join(assign.select("sample_id", "fold_id", "is_test"), "sample_id")
            .join(v, ["fold_id", "term"], "left_semi"))


def fit_nb(pres: DataFrame, assign: DataFrame, labels: DataFrame) -> dict:
    """Per fold ``n_l`` (documents per label), ``n_lt`` (presence count),
    ``T_l`` (sum of n_lt), ``T`` and ``N``; ``label_ord`` = first training
    sample of the label (the tie-break order)."""
    train = assign.where(~F.col("is_test")).join(labels.select("sample_id", "label"), "sample_id")
    label_counts = _label_counts(train)
    term_counts = (pres.where(~F.col("is_test")).join(labels.select("sample_id", "label"), "sample_id")
                   .groupBy("fold_id", "label", "term").agg(F.count(F.lit(1)).alias("n_lt")))
    return _model(label_counts, term_counts)


def _label_counts(train: DataFrame) -> DataFrame:
    return train.groupBy("fold_id", "label").agg(
        F.count(F.lit(1)).alias("n_l"), F.min("sample_id").alias("label_ord"))


def _model(label_counts: DataFrame, term_counts: DataFrame) -> dict:
    """Both tables are read several times; they hold at most the band's terms of each label."""
    term_counts = term_counts.cache()
    return {"labels": label_table(label_counts, term_counts).cache(), "terms": term_counts}


def label_table(label_counts: DataFrame, term_counts: DataFrame) -> DataFrame:
    """``fold_id, label, n_l, label_ord, T_l, N, T`` from documents and presences per label."""
    label_totals = term_counts.groupBy("fold_id", "label").agg(F.sum("n_lt").alias("T_l"))
    # per-fold totals as window sums over the (label-sized) table: no joins
    fold = Window.partitionBy("fold_id")
    return (label_counts.join(label_totals, ["fold_id", "label"], "left")
            .withColumn("T_l", F.coalesce("T_l", F.lit(0)))
            .withColumn("N", F.sum("n_l").over(fold))
            .withColumn("T", F.sum("T_l").over(fold)))


def _weights(model: dict) -> DataFrame:
    """What a present term adds to a label beyond log2(1/T); at least 1."""
    return (model["terms"].join(model["labels"].select("fold_id", "label", "T_l", "T"), ["fold_id", "label"])
            .select("fold_id", "label", "term",
                    (F.log2(F.col("n_lt") / F.col("T_l") + 1.0 / F.col("T")) - F.log2(1.0 / F.col("T"))).alias("w")))


def classify_nb(pres: DataFrame, assign: DataFrame, model: dict, digits: int = 4) -> DataFrame:
    """score(l,d) = log2(n_l/N + 1/N) + sum_{t in d} log2(n_lt/T_l + 1/T);
    argmax, ties to the label seen first in training.

    Terms with n_lt = 0 contribute log2(1/T) for every label, so the sum is
    (terms d has with n_lt > 0, via an equi-join) + |d| * log2(1/T).  A label
    with T_l = 0 and any present term has no score (the reference divides by
    zero there)."""
    per_label = model["labels"]
    test = assign.where(F.col("is_test")).select("fold_id", "sample_id")
    doc_sizes = (pres.where(F.col("is_test")).groupBy("fold_id", "sample_id")
                 .agg(F.count(F.lit(1)).alias("d")))
    docs = test.join(doc_sizes, ["fold_id", "sample_id"], "left").withColumn("d", F.coalesce("d", F.lit(0)))
    weights = _weights(model)
    # Spark picks the join by the measured size of the labels and weights
    labels = per_label
    seen = (pres.where(F.col("is_test")).select("fold_id", "sample_id", "term")
            .join(weights, ["fold_id", "term"])
            .groupBy("fold_id", "sample_id", "label").agg(F.sum("w").alias("seen")))
    scored = (docs.join(labels, "fold_id")  # label dimension per fold: result shape
              .join(seen, ["fold_id", "sample_id", "label"], "left"))
    prior = F.log2(F.col("n_l") / F.col("N") + 1.0 / F.col("N"))
    body = F.when(F.col("d") == 0, F.lit(0.0)).when(
        (F.col("T_l") > 0) & (F.col("T") > 0),
        F.coalesce(F.col("seen"), F.lit(0.0)) + F.col("d") * F.log2(1.0 / F.col("T")))
    return scored.select("fold_id", "sample_id", "label", "label_ord", (prior + body).alias("score"))


def best_labels(test: DataFrame, pres: DataFrame, model: dict, digits: int = 4) -> DataFrame:
    """``predict(classify_nb(...))`` without meeting every label: ``test(fold_id, sample_id)``,
    ``pres(fold_id, sample_id, term)`` of the test samples.

    A present term adds 1 or more to the labels that have it, so of the labels that share no
    term with a sample only those of the highest prior can win: a short list per fold.  The
    list holds every prior that rounding could make equal to the highest."""
    labels = model["labels"].withColumn("prior", F.log2(F.col("n_l") / F.col("N") + 1.0 / F.col("N")))
    seen = (pres.join(_weights(model), ["fold_id", "term"])
            .groupBy("fold_id", "sample_id", "label").agg(F.sum("w").alias("seen")))
    sizes = pres.groupBy("fold_id", "sample_id").agg(F.count(F.lit(1)).alias("d"))

    def choice(score, order, label):
        return F.struct(F.round(score, digits).alias("s"), (-order).alias("o"), label.alias("label"), score.alias("score"))

    score = F.col("prior") + (F.col("seen") + F.col("d") * F.log2(1.0 / F.col("T")))
    of_seen = (seen.join(labels, ["fold_id", "label"]).join(sizes, ["fold_id", "sample_id"])
               .groupBy("fold_id", "sample_id").agg(F.max(choice(score, F.col("label_ord"), F.col("label"))).alias("top")))
    near = 2 * 10.0 ** -digits

    def tops(name, which):
        x = labels.where(which)
        x = x.withColumn("_max", F.max("prior").over(Window.partitionBy("fold_id"))).where(F.col("prior") >= F.col("_max") - near)
        x = x.groupBy("fold_id", "prior", "T").agg(F.min_by(F.struct("label", "label_ord"), "label_ord").alias("l"))
        return x.groupBy("fold_id").agg(F.collect_list(F.struct("prior", "T", "l")).alias(name))

    info = tops("of_all", F.lit(True)).join(tops("of_used", (F.col("T_l") > 0) & (F.col("T") > 0)), "fold_id", "left")
    docs = (test.join(sizes, ["fold_id", "sample_id"], "left").withColumn("d", F.coalesce("d", F.lit(0)))
            .join(info, "fold_id").join(of_seen, ["fold_id", "sample_id"], "left"))
    rest = F.when(F.col("d") == 0, F.transform("of_all", lambda c: choice(c["prior"], c["l"]["label_ord"], c["l"]["label"]))) \
        .otherwise(F.transform("of_used", lambda c: choice(c["prior"] + F.col("d") * F.log2(1.0 / c["T"]),
                                                           c["l"]["label_ord"], c["l"]["label"])))
    best = F.array_max(F.concat(rest, F.array("top")))
    return (docs.select("fold_id", "sample_id", best.alias("best")).where(F.col("best").isNotNull())
            .select("fold_id", "sample_id", F.col("best.label").alias("predicted"), F.col("best.score").alias("score")))


def predict(scores: DataFrame, digits: int = 4) -> DataFrame:
    """Argmax label per sample; a tie goes to the first-seen label."""
    key = F.struct(F.round("score", digits).alias("s"), (-F.col("label_ord")).alias("o"))
    return (scores.where(F.col("score").isNotNull())
            .groupBy("fold_id", "sample_id")
            .agg(F.max_by(F.struct("label", "score"), key).alias("best"))
            .select("fold_id", "sample_id", F.col("best.label").alias("predicted"),
                    F.col("best.score").alias("score")))


def run_folds(tokens: DataFrame, labels: DataFrame, assign: DataFrame,
              skip: int = SKIP_N_FEATURES, max_features: int = MAX_FEATURES) -> dict:
    """Fit vocabulary + model per fold and predict the fold's test samples."""
    # a sample's folds and labels come to its terms once, where they are counted: nothing
    # of a row for each sample and term is moved to be joined
    folds = assign.groupBy("sample_id").agg(F.collect_list(F.struct("fold_id", "is_test")).alias("folds"))
    of_sample = labels.groupBy("sample_id").agg(F.collect_list(F.struct("label")).alias("labels"))
    per_sample = sample_terms(tokens).join(folds, "sample_id").join(of_sample, "sample_id", "left").cache()
    each = per_sample.select("sample_id", "term", "cnt", "first_pos", "labels", F.inline("folds"))
    freqs = (each.where(~F.col("is_test")).groupBy("fold_id", "term")
             .agg(F.sum("cnt").alias("cnt"), _first_seen(per_sample).alias("first")))
    vocab = vocab_band(freqs, skip, max_features).cache()
    in_band = each.join(F.broadcast(vocab.select("fold_id", "term")), ["fold_id", "term"], "left_semi")
    pres = in_band.select("fold_id", "term", "sample_id", "is_test")
    term_counts = (in_band.where(~F.col("is_test")).select("fold_id", "term", F.inline("labels"))
                   .groupBy("fold_id", "label", "term").agg(F.count(F.lit(1)).alias("n_lt")))
    train = assign.where(~F.col("is_test")).join(labels.select("sample_id", "label"), "sample_id")
    model = _model(_label_counts(train), term_counts)
    scores = classify_nb(pres, assign, model)
    of_test = best_labels(assign.where("is_test").select("fold_id", "sample_id"),
                          pres.where("is_test").select("fold_id", "sample_id", "term"), model)
    preds = of_test.join(labels.select("sample_id", "label"), "sample_id")
    return {"vocab": vocab, "presence": pres, "model": model, "scores": scores, "predictions": preds}


def holdout_assignment(samples: DataFrame, train_col: str = "is_train") -> DataFrame:
    """One fold: training rows train, the rest test.

    The fold id is computed from the row (always 0) rather than a literal: a
    literal key lets the optimizer fold the fold-keyed equi-joins into
    nested-loop joins; computed, they stay (broadcast) hash joins as in the
    k-fold case."""
    fold0 = (F.col("sample_id") * 0).cast("int")
    return samples.select("sample_id", fold0.alias("fold_id"), (~F.col(train_col)).alias("is_test"))


def cv_assignment(samples: DataFrame, k: int = 3) -> DataFrame:
    """Contiguous folds by ``sample_id``; each sample tests in
    its own fold and trains in the other k-1 (k copies, no union)."""
    folds = contiguous_folds(samples.select("sample_id"), "sample_id", k, "own_fold")
    return (folds.select("sample_id", "own_fold", F.explode(F.sequence(F.lit(0), F.lit(k - 1))).alias("fold_id"))
            .select("sample_id", F.col("fold_id").cast("int").alias("fold_id"),
                    (F.col("fold_id") == F.col("own_fold")).alias("is_test")))


def _without(folds: str, part, k: int):
    """Over the other folds, for each fold 0..k-1: ``(fold_id, parts of the others)``."""
    return F.explode(F.transform(F.sequence(F.lit(0), F.lit(k - 1)), lambda f: F.struct(
        f.cast("int").alias("fold_id"), F.transform(F.filter(folds, lambda x: x["own"] != f), part).alias("rest"))))


def cross_validate(tokens: DataFrame, labels: DataFrame, k: int = 3,
                   skip: int = SKIP_N_FEATURES, max_features: int = MAX_FEATURES) -> dict:
    """C30 with every statistic counted once per fold of its own: a training set's statistic is
    that of the other folds together.  Results are those of ``run_folds`` on ``cv_assignment``.

    A fold's count of a term lies between total - largest own count and total, so only terms
    whose total reaches the ``max_features``-th largest lower bound can be among the first
    ``max_features`` of any fold; only they are ranked."""
    own = contiguous_folds(labels.select("sample_id"), "sample_id", k, "own")
    known = labels.select("sample_id", "label").join(own, "sample_id").cache()
    per_sample = sample_terms(tokens).join(known, "sample_id").cache()

    per_fold = per_sample.groupBy("term", "own").agg(
        F.sum("cnt").alias("cnt"), _first_seen(per_sample).alias("first"))
    per_term = per_fold.groupBy("term").agg(
        F.sum("cnt").alias("total"), F.max("cnt").alias("most"),
        F.collect_list(F.struct("own", "cnt", "first")).alias("folds")).cache()
    lower = per_term.select((F.col("total") - F.col("most")).alias("low")).orderBy(F.desc("low")).limit(max_features)
    reach = lower.agg(F.when(F.count(F.lit(1)) < max_features, 0).otherwise(F.min("low"))).scalar()
    freqs = (per_term.where(F.col("total") >= reach).select("term", _without("folds", lambda x: x, k).alias("f"))
             .where(F.size("f.rest") > 0)
             .select("f.fold_id", "term", F.aggregate("f.rest", F.lit(0).cast("long"), lambda a, x: a + x["cnt"]).alias("cnt"),
                     F.array_min("f.rest.first").alias("first")))
    vocab = vocab_band(freqs, skip, max_features).cache()

    # at most (max_features - skip) terms a fold
    in_folds = F.broadcast(vocab.groupBy("term").agg(F.collect_list("fold_id").alias("in_folds")))
    pres = per_sample.select("sample_id", "own", "label", "term").join(in_folds, "term")
    by_label = (pres.groupBy("term", "label", "own").agg(F.count(F.lit(1)).alias("n"))
                .groupBy("term", "label").agg(F.collect_list(F.struct("own", "n")).alias("folds")).join(in_folds, "term"))
    term_counts = (by_label.select("term", "label", "in_folds", _without("folds", lambda x: x["n"], k).alias("f"))
                   .where(F.array_contains("in_folds", F.col("f.fold_id")) & (F.size("f.rest") > 0))
                   .select("f.fold_id", "label", "term", F.aggregate("f.rest", F.lit(0).cast("long"), lambda a, x: a + x).alias("n_lt")))
    per_own = known.groupBy("label", "own").agg(F.count(F.lit(1)).alias("n"), F.min("sample_id").alias("first"))
    label_counts = (per_own.groupBy("label").agg(F.collect_list(F.struct("own", "n", "first")).alias("folds"))
                    .select("label", _without("folds", lambda x: x, k).alias("f")).where(F.size("f.rest") > 0)
                    .select("f.fold_id", "label", F.aggregate("f.rest", F.lit(0).cast("long"), lambda a, x: a + x["n"]).alias("n_l"),
                            F.array_min("f.rest.first").alias("label_ord")))
    model = _model(label_counts, term_counts)
    mine = pres.where(F.array_contains("in_folds", F.col("own"))).select(F.col("own").alias("fold_id"), "sample_id", "term")
    preds = best_labels(known.select(F.col("own").alias("fold_id"), "sample_id"), mine, model)
    return {"vocab": vocab, "model": model, "predictions": preds.join(labels.select("sample_id", "label"), "sample_id")}


def accuracy(predictions: DataFrame) -> DataFrame:
    """A10 per fold: ``fold_id, n, correct, accuracy``."""
    return predictions.groupBy("fold_id").agg(
        F.count(F.lit(1)).cast("bigint").alias("n"),
        F.sum((F.col("predicted") == F.col("label")).cast("int")).cast("bigint").alias("correct"),
        F.avg((F.col("predicted") == F.col("label")).cast("double")).alias("accuracy"))


def mean_accuracy(per_fold: DataFrame) -> DataFrame:
    """Macro mean over folds."""
    return per_fold.agg(F.avg("accuracy").alias("mean_accuracy"), F.count(F.lit(1)).cast("bigint").alias("folds"))
