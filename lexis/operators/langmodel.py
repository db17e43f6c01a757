"""Character / word n-gram language models and perplexity scoring.

Data layout
-----------
``grams(model, n, gram, cnt)``   one row per distinct n-gram of a model (cached)
``stats(model, n_units, n_types, n_bigrams, n_trigrams)``

Scoring never pairs every evaluation n-gram with every model.  Each score is
split into (a) a sum over the n-grams a model has *seen* and (b) a per-model
constant for everything unseen, multiplied by the number of n-gram occurrences
of the document.  (a) is one equi-join of the document's gram occurrences with
the weight table pivoted to one row per gram and one column per model
(broadcast after a row-count check, else a shuffle join on ``gram`` with AQE's
skew split for hot grams such as the space character), followed by K ``sum``
columns per document; (b) is an equi-join with the K-row model table.  No
cross join: the model dimension (in blocks of MODEL_BLOCK) is carried as
columns.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexis.functions.numeric import log2_or_null, perplexity_from
from lexis.functions.text import char_units, padded_word_units, word_units
from lexis.operators.ngrams import (WORD_SEP, char_ngrams, count_ngrams, explode_grams, gram_middle, gram_prefix,
                                    gram_suffix, grams_array)

# N per smoothing mode.
MODE_ORDER = {"unsmoothed": 1, "laplace": 2, "interpolation": 3}
UNITS_PER_TASK = 2_000_000  # units (characters or words) whose grams one task counts by document
HELD_CHARS = 4_000_000  # characters of texts that a task counts at once
MODEL_BLOCK = 256  # models scored side by side in columns; more models are scored in several blocks


class ScoreTerms(NamedTuple):
    """log p(document | model) = sum over the document's ``grams`` of the model's ``w`` (0 if the
    model has not seen the gram) + ``n_occ`` * the model's ``log_unseen``."""

    docs: DataFrame        # doc_id, m, and the units that ``grams`` reads
    grams: Column
    weights: DataFrame     # model, gram, w
    per_model: DataFrame   # model, log_unseen
    n_occ: Column


@dataclass
class NgramModel:
    grams: DataFrame
    stats: DataFrame
    unit: str = "char"
    orders: tuple = (1, 2, 3)
    _lambdas: dict = field(default_factory=dict)

    @property
    def sep(self) -> str:
        return "" if self.unit == "char" else WORD_SEP

    def eval_grams(self, n: int) -> Column:
        """n-gram array of a prepared evaluation row (see ``_doc_units``)."""
        if self.unit == "char":
            return char_ngrams(F.col("t"), n)
        return grams_array(None, F.col("u"), [n], self.sep)

    def lambdas(self, vote: str = "running") -> DataFrame:
        if vote not in self._lambdas:
            self._lambdas[vote] = interpolation_weights(self, vote).cache()
        return self._lambdas[vote]


def units_for(unit: str, text: Column, training: bool = True) -> Column:
    if unit == "char":
        return char_units(text)
    if unit == "word":
        return word_units(text)
    if unit == "word_padded":
        # Training lines get <S> .. </S>; evaluation text is not padded
        return padded_word_units(text) if training else word_units(text)
    raise ValueError(f"unknown unit {unit!r}")


def _no_breaks(text: Column) -> Column:
    return F.regexp_replace(text, "\n", "")


def fit_ngram_model(corpus: DataFrame, model_col: str = "model", text_col: str = "text",
                    orders=(1, 2, 3), unit: str = "char") -> NgramModel:
    """Count every order for every model."""
    sep = "" if unit == "char" else WORD_SEP
    if unit == "char" and tuple(orders) == (1, 2, 3):
        src = corpus.select(F.col(model_col).alias("model"), _no_breaks(F.col(text_col)).alias("t"))
        grams = _char_counts_from_trigrams(src).cache()
    elif unit == "char":
        src = corpus.select(F.col(model_col).alias("model"), _no_breaks(F.col(text_col)).alias("t"))
        grams = count_ngrams(src, ["model"], grams_array(F.col("t"), None, orders), sep).cache()
    else:
        src = corpus.select(F.col(model_col).alias("model"), units_for(unit, F.col(text_col)).alias("u"))
        grams = count_ngrams(src, ["model"], grams_array(None, F.col("u"), orders, sep), sep).cache()
    stats = (grams.groupBy("model").agg(
        F.sum(F.when(F.col("n") == 1, F.col("cnt"))).cast("bigint").alias("n_units"),
        F.count(F.when(F.col("n") == 1, 1)).cast("bigint").alias("n_types"),
        F.count(F.when(F.col("n") == 2, 1)).cast("bigint").alias("n_bigrams"),
        F.count(F.when(F.col("n") == 3, 1)).cast("bigint").alias("n_trigrams"),
    )).cache()
    return NgramModel(grams, stats, unit, tuple(orders))


def _counted_trigrams(src: DataFrame) -> DataFrame:
    """``model, gram, cnt`` of some texts at a time: trigrams, and each text's last bigram and unit."""
    schema = T.StructType([src.schema["model"], T.StructField("gram", T.StringType()), T.StructField("cnt", T.LongType())])
    held = HELD_CHARS

    def run(batches):
        import numpy as np
        import pyarrow as pa

        def count(texts):
            """(gram, count) of texts of one model."""
            cp = np.frombuffer("".join(texts).encode("utf-32-le"), "uint32").astype("int64")
            alphabet = np.unique(cp)
            place = np.zeros(int(alphabet[-1]) + 1, "int64")
            place[alphabet] = np.arange(len(alphabet))
            ids, size = place[cp], len(alphabet)
            ends = np.cumsum([len(x) for x in texts])
            begins = ends - [len(x) for x in texts]
            whole = np.ones(len(cp), bool)
            whole[ends - 1] = False
            whole[np.maximum(ends - 2, begins)] = False
            at = np.flatnonzero(whole)
            two = ends[ends - begins >= 2] - 2
            for at, n in ((at, 3), (two, 2), (ends - 1, 1)):
                code = ids[at]
                for k in range(1, n):
                    code = code * size + ids[at + k]
                if size ** n <= 1 << 24:
                    counts = np.bincount(code)
                    found = np.flatnonzero(counts)
                    counts = counts[found]
                else:
                    found, counts = np.unique(code, return_counts=True)
                grams = np.empty((len(found), n), "<u4")
                for k in reversed(range(n)):
                    found, unit = np.divmod(found, size)
                    grams[:, k] = alphabet[unit]
                chars = grams.tobytes().decode("utf-32-le")
                yield [chars[i:i + n] for i in range(0, len(chars), n)], counts

        def rows(by_model):
            for model, texts in by_model.items():
                for grams, counts in count(texts):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([model] * len(grams), kind), pa.array(grams, pa.string()), pa.array(counts, pa.int64())], schema.names)

        by_model, n = {}, 0
        for batch in batches:
            kind = batch.schema.field("model").type
            for model, text in zip(batch.column("model").to_pylist(), batch.column("t").to_pylist()):
                if text:
                    by_model.setdefault(model, []).append(text)
                    n += len(text)
                if n >= held:
                    yield from rows(by_model)
                    by_model, n = {}, 0
        if n:
            yield from rows(by_model)

    return src.select("model", "t").mapInArrow(run, schema)


def _char_counts_from_trigrams(src: DataFrame) -> DataFrame:
    """Char uni/bi/trigram counts from one pass over the texts.

    Tasks count trigrams and send a row for each that some texts have.  Every
    bigram occurrence but a text's last one is the prefix of a trigram
    occurrence, and every unit but the last is the prefix of a bigram, so
      c2(xy) = sum_z c3(xyz) + [xy ends a text],  c1(x) = sum_y c2(xy) + [x ends a text];
    the prefix sums run on the (small) aggregated tables.  A text's last two grams
    are counted beside its trigrams and are told by their length, so the texts
    are read once."""
    base = _counted_trigrams(src).groupBy("model", "gram").agg(F.sum("cnt").alias("cnt")).cache()
    tri, end2, end1 = (base.where(F.length("gram") == n) for n in (3, 2, 1))
    bi = (tri.select("model", F.substring("gram", 1, 2).alias("gram"), "cnt").unionByName(end2)
          .groupBy("model", "gram").agg(F.sum("cnt").alias("cnt")))
    uni = (bi.select("model", F.substring("gram", 1, 1).alias("gram"), "cnt").unionByName(end1)
           .groupBy("model", "gram").agg(F.sum("cnt").alias("cnt")))
    parts = [d.select("model", F.lit(n).alias("n"), "gram", F.col("cnt").cast("bigint").alias("cnt"))
             for n, d in ((1, uni), (2, bi), (3, tri))]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def _gram_table(model: NgramModel, n: int, name: str, cnt_name: str) -> DataFrame:
    return (model.grams.where(F.col("n") == n)
            .select("model", F.col("gram").alias(name), F.col("cnt").alias(cnt_name)))


def _doc_units(eval_df: DataFrame, model: NgramModel, doc_col: str, text_col: str) -> DataFrame:
    """``doc_id, t|u, m``: the text without line breaks (chars) or the word
    array (words), and M = number of units."""
    if model.unit == "char":
        return (eval_df.select(F.col(doc_col).alias("doc_id"), _no_breaks(F.col(text_col)).alias("t"))
                .withColumn("m", F.length("t")))
    return (eval_df.select(F.col(doc_col).alias("doc_id"), units_for(model.unit, F.col(text_col), False).alias("u"))
            .withColumn("m", F.size("u")))


def _model_names(model: NgramModel) -> list[str]:
    """The model dimension (one short name per training file), sorted."""
    return sorted(r.model for r in model.stats.select("model").collect())


def _blocks(names: list[str]) -> list[list[str]]:
    return [names[i:i + MODEL_BLOCK] for i in range(0, len(names), MODEL_BLOCK)]


def _score_rows(docs: DataFrame, grams: Column, weights: DataFrame, names: list[str]) -> DataFrame:
    """Long form of ``_score_sums``: ``doc_id, m, model, seen``."""
    rows = None
    for block in _blocks(names):
        sums = _score_sums(docs, grams, weights, block)
        z = F.arrays_zip(F.array(*[F.lit(n) for n in block]).alias("model"),
                         F.array(*[F.col(f"s{i}").cast("double") for i in range(len(block))]).alias("seen"))
        part = sums.select("doc_id", "m", F.explode(z).alias("x")).select("doc_id", "m", "x.model", "x.seen")
        rows = part if rows is None else rows.union(part)
    return rows


def _tasks_for(docs: DataFrame) -> int:
    units = docs.agg(F.sum(F.col("m").cast("bigint"))).first()[0] or 0
    return max(docs.sparkSession.sparkContext.defaultParallelism, -(-units // UNITS_PER_TASK))


def _score_sums(docs: DataFrame, grams: Column, weights: DataFrame, names: list[str]) -> DataFrame:
    """``doc_id, m, s0 .. s{K-1}`` for every document and every model, where
    ``seen`` = sum over the document's gram occurrences of the model's weight
    (0 for a gram the model has not seen).

    The weight table is pivoted to one row per gram with one column per model,
    so the join emits one row per occurrence (not per occurrence and model) and
    the per-document sums are K plain ``sum`` columns in one hash aggregate.
    ``explode_outer`` keeps documents without any gram, so every document gets
    every model without pairing tables."""
    k = len(names)
    wide = weights.where(F.col("model").isin(names)).groupBy("gram").pivot("model", names).agg(F.first("w"))
    wide = wide.toDF("gram", *[f"w{i}" for i in range(k)])
    # one shuffle of the texts by document; counting a document's grams, and their
    # sums after a broadcast join, then need no further one.  Tasks are sized by the
    # units that they count (a given number is not coalesced by the size of the texts)
    occ = (docs.repartition(_tasks_for(docs), "doc_id").select("doc_id", "m", F.explode_outer(grams).alias("gram"))
           .groupBy("doc_id", "m", "gram").agg(F.count(F.lit(1)).alias("k")))
    return (occ.join(wide, "gram", "left")
            .groupBy("doc_id", "m")
            .agg(*[F.sum(F.coalesce(F.col(f"w{i}") * F.col("k"), F.lit(0.0))).cast("double").alias(f"s{i}")
                   for i in range(k)]))


def _best_in_row(sums: DataFrame, names: list[str], per_model: DataFrame, n_occ: Column, mode: str,
                 digits: int = 4) -> DataFrame:
    """C8 without a second aggregation: the K scores of a document sit in one
    row, so the lowest (rounded) perplexity, ties to the first model name, is a
    ``least`` over K structs.  The K per-model constants arrive as one scalar
    subquery (an array sorted by model name, like ``names``)."""
    consts = (per_model.where(F.col("model").isin(names))
              .agg(F.sort_array(F.collect_list(F.struct("model", "log_unseen")))).scalar())
    cands = []
    for i in range(len(names)):
        lp = F.col(f"s{i}") + n_occ * F.element_at(consts, i + 1)["log_unseen"]
        ppl = perplexity_from(lp, F.col("m"))
        cands.append(F.when(ppl.isNotNull(), F.struct(F.round(ppl, digits).alias("p"), F.lit(i).alias("k"),
                                                      ppl.alias("v"))))
    best = cands[0] if len(cands) == 1 else F.least(*cands)
    name = F.element_at(F.array(*[F.lit(n) for n in names]), F.col("b.k") + 1)
    return (sums.select("doc_id", best.alias("b")).where(F.col("b").isNotNull())
            .select("doc_id", F.struct("b.p", name.alias("model"), "b.v").alias("b")))


def _finish(rows: DataFrame, per_model: DataFrame, n_occ: Column) -> DataFrame:
    """log p = seen + n_occ * log_unseen; per_model has one row per model."""
    out = rows.join(per_model, "model")
    logprob = F.col("seen") + n_occ * F.col("log_unseen")
    return out.select("doc_id", "model", "m", logprob.alias("logprob"),
                      perplexity_from(logprob, F.col("m")).alias("perplexity"))


def _score(model: NgramModel, terms: ScoreTerms, best: str | None):
    docs, grams, weights, per_model, n_occ = terms
    names = _model_names(model)
    if not best:
        return _finish(_score_rows(docs, grams, weights, names), per_model, n_occ)
    found = [_best_in_row(_score_sums(docs, grams, weights, block), block, per_model, n_occ, best)
             for block in _blocks(names)]
    out = found[0]
    if len(found) > 1:   # the best of each block's best; ties still go to the first name
        for f in found[1:]:
            out = out.union(f)
        out = out.groupBy("doc_id").agg(F.min("b").alias("b"))
    return out.select("doc_id", "b.model", F.round("b.v", 2).alias("perplexity"), F.lit(MODE_ORDER[best]).alias("n"))


def score_unsmoothed(model: NgramModel, eval_df: DataFrame, doc_col="doc_id", text_col="text",
                     best: str | None = None) -> DataFrame:
    """C2 + C4 + C7: p(u) = c(u)/(T+1); an unseen unit counts 1 (``<UNK>``)."""
    return _score(model, _unsmoothed_terms(model, eval_df, doc_col, text_col), best)


def _unsmoothed_terms(model, eval_df, doc_col, text_col) -> ScoreTerms:
    docs = _doc_units(eval_df, model, doc_col, text_col)
    weights = _gram_table(model, 1, "gram", "cnt").select("model", "gram", F.log2("cnt").alias("w"))
    per_model = model.stats.select("model", (-F.log2(F.col("n_units") + 1)).alias("log_unseen"))
    return ScoreTerms(docs, model.eval_grams(1), weights, per_model, F.col("m"))


def score_laplace(model: NgramModel, eval_df: DataFrame, doc_col="doc_id", text_col="text", n: int = 2,
                  best: str | None = None) -> DataFrame:
    """C3 + C7: p(u|h) = (c(h,u)+1) / (c(h)+V), V = number of distinct n-grams.

    log p summed over occurrences = sum_seen log2(c(h,u)+1)
        - sum_{h seen} (log2(c(h)+V) - log2 V) - n_occ * log2 V."""
    return _score(model, _laplace_terms(model, eval_df, doc_col, text_col, n), best)


def _laplace_terms(model, eval_df, doc_col, text_col, n: int = 2) -> ScoreTerms:
    docs = _doc_units(eval_df, model, doc_col, text_col)
    v = model.stats.select("model", F.col({2: "n_bigrams", 3: "n_trigrams"}[n]).alias("v"))
    g = model.grams.where(F.col("n").isin(n, n - 1)).join(v, "model")
    weights = g.select("model", "gram", F.when(
        F.col("n") == n, F.log2(F.col("cnt") + 1)
    ).otherwise(-(F.log2(F.col("cnt") + F.col("v")) - log2_or_null(F.col("v")))).alias("w"))
    # every n-gram occurrence, plus its history: the (n-1)-grams but the last
    hist = model.eval_grams(n - 1)
    grams = F.concat(model.eval_grams(n), F.slice(hist, 1, F.greatest(F.size(hist) - 1, F.lit(0))))
    per_model = v.select("model", (-log2_or_null(F.col("v"))).alias("log_unseen"))
    return ScoreTerms(docs, grams, weights, per_model, F.greatest(F.col("m") - (n - 1), F.lit(0)))


def interpolation_weights(model: NgramModel, vote: str = "running") -> DataFrame:
    """Deleted-interpolation weights per model -> ``model, l1, l2, l3``.

    For every distinct trigram xyz: c1=c(z), c2=c(yz), c3=c(xyz),
    p1=(c1-1)/(T-1), p2=(c2-1)/(c(y)-1), p3=(c3-1)/(c(xy)-1) (0 on a zero
    denominator).  ``running`` takes the vote after each order (later orders
    still 0), which in closed form is
      L1 += c1*(1 + [p1>=p2] + [p1>=p2 and p1>=p3])
      L2 += c2*([p2>=p1] + [p2>=p1 and p2>=p3])
      L3 += c3*[p3>=p1 and p3>=p2];
    ``final`` is the single textbook vote where all tied maxima win (its p1
    denominator is T, the unigram total including ``<UNK>``, minus 1)."""
    sep = model.sep
    tri = _gram_table(model, 3, "xyz", "c3")
    bi = _gram_table(model, 2, "bg", "cb")
    uni = _gram_table(model, 1, "ug", "cu")
    t = model.stats.select("model", F.col("n_units").alias("t"))
    x = (tri.withColumn("yz", gram_suffix(F.col("xyz"), 2, 3, sep))
         .withColumn("xy", gram_prefix(F.col("xyz"), 2, 3, sep))
         .withColumn("y", gram_middle(F.col("xyz"), 3, sep))
         .withColumn("z", gram_suffix(F.col("xyz"), 1, 3, sep))
         .join(bi.select("model", F.col("bg").alias("yz"), F.col("cb").alias("c2")), ["model", "yz"])
         .join(bi.select("model", F.col("bg").alias("xy"), F.col("cb").alias("cxy")), ["model", "xy"])
         .join(uni.select("model", F.col("ug").alias("y"), F.col("cu").alias("cy")), ["model", "y"])
         .join(uni.select("model", F.col("ug").alias("z"), F.col("cu").alias("c1")), ["model", "z"])
         .join(t, "model"))

    def ratio(num, den):
        return F.when(den != 0, num.cast("double") / den).otherwise(F.lit(0.0))

    t_den = F.col("t") - 1 if vote == "running" else F.col("t")
    p1 = ratio(F.col("c1") - 1, t_den)
    p2 = ratio(F.col("c2") - 1, F.col("cy") - 1)
    p3 = ratio(F.col("c3") - 1, F.col("cxy") - 1)
    x = x.select("model", "c1", "c2", "c3", p1.alias("p1"), p2.alias("p2"), p3.alias("p3"))
    ge12, ge13 = F.col("p1") >= F.col("p2"), F.col("p1") >= F.col("p3")
    ge21, ge23 = F.col("p2") >= F.col("p1"), F.col("p2") >= F.col("p3")
    ge31, ge32 = F.col("p3") >= F.col("p1"), F.col("p3") >= F.col("p2")
    ind = lambda c: c.cast("int")
    if vote == "running":
        v1 = F.col("c1") * (1 + ind(ge12) + ind(ge12 & ge13))
        v2 = F.col("c2") * (ind(ge21) + ind(ge21 & ge23))
        v3 = F.col("c3") * ind(ge31 & ge32)
    elif vote == "final":
        v1 = F.col("c1") * ind(ge12 & ge13)
        v2 = F.col("c2") * ind(ge21 & ge23)
        v3 = F.col("c3") * ind(ge31 & ge32)
    else:
        raise ValueError(f"unknown vote {vote!r}")
    sums = x.groupBy("model").agg(F.sum(v1).alias("L1"), F.sum(v2).alias("L2"), F.sum(v3).alias("L3"))
    total = F.col("L1") + F.col("L2") + F.col("L3")
    return sums.select("model", *[F.try_divide(F.col(f"L{i}").cast("double"), total).alias(f"l{i}")
                                  for i in (1, 2, 3)])


def interpolated_probability_table(model: NgramModel, trigrams: DataFrame, vote: str = "running") -> DataFrame:
    """log p(xyz) per model for the given distinct trigram keys (``gram``),
    restricted to models that have seen z; ``w`` is relative to the unseen
    constant log2(l1/(T+1))."""
    sep = model.sep
    lam = model.lambdas(vote)
    t = model.stats.select("model", "n_units")
    uni = _gram_table(model, 1, "z", "cz")
    bi = _gram_table(model, 2, "yz", "cyz")
    tri = _gram_table(model, 3, "gram", "cxyz")
    a = (uni.join(t, "model").join(lam, "model")
         .select("model", "z", (F.col("l1") * F.col("cz") / (F.col("n_units") + 1)).alias("a"),
                 log2_or_null(F.col("l1") / (F.col("n_units") + 1)).alias("log_unseen")))
    b = (bi.withColumn("y", gram_prefix(F.col("yz"), 1, 2, sep))
         .join(_gram_table(model, 1, "y", "cy"), ["model", "y"]).join(lam, "model")
         .select("model", "yz", (F.col("l2") * F.col("cyz") / F.col("cy")).alias("b")))
    c = (tri.withColumn("xy", gram_prefix(F.col("gram"), 2, 3, sep))
         .join(_gram_table(model, 2, "xy", "cxy"), ["model", "xy"]).join(lam, "model")
         .select("model", "gram", (F.col("l3") * F.col("cxyz") / F.col("cxy")).alias("c")))
    keys = trigrams.select("gram", gram_suffix(F.col("gram"), 1, 3, sep).alias("z"),
                           gram_suffix(F.col("gram"), 2, 3, sep).alias("yz"))
    p = F.col("a") + F.coalesce(F.col("b"), F.lit(0.0)) + F.coalesce(F.col("c"), F.lit(0.0))
    return (keys.join(a, "z").join(b, ["model", "yz"], "left").join(c, ["model", "gram"], "left")
            .select("model", "gram", (log2_or_null(p) - F.col("log_unseen")).alias("w")))


def score_interpolation(model: NgramModel, eval_df: DataFrame, doc_col="doc_id", text_col="text",
                        vote: str = "running", best: str | None = None) -> DataFrame:
    """C6 + C7: p = l1*u(z)/(T+1) + l2*c(yz)/c(y) + l3*c(xyz)/c(xy), log base 2.

    If z is unseen, so are yz and xyz, and p = l1/(T+1): a per-model constant.
    The probability table is built once for the distinct evaluation trigrams."""
    return _score(model, _interpolation_terms(model, eval_df, doc_col, text_col, vote), best)


def _interpolation_terms(model, eval_df, doc_col, text_col, vote: str = "running") -> ScoreTerms:
    docs = _doc_units(eval_df, model, doc_col, text_col)
    distinct_keys = explode_grams(docs, ["doc_id"], model.eval_grams(3)).select("gram").distinct()
    weights = interpolated_probability_table(model, distinct_keys, vote)
    lam = model.lambdas(vote)
    per_model = (model.stats.join(lam, "model")
                 .select("model", log2_or_null(F.col("l1") / (F.col("n_units") + 1)).alias("log_unseen")))
    return ScoreTerms(docs, model.eval_grams(3), weights, per_model, F.greatest(F.col("m") - 2, F.lit(0)))


def score_terms(model: NgramModel, eval_df: DataFrame, mode: str, doc_col="doc_id", text_col="text") -> ScoreTerms:
    """What a smoothing mode's score is made of."""
    terms = {"unsmoothed": _unsmoothed_terms, "laplace": _laplace_terms, "interpolation": _interpolation_terms}
    if mode not in terms:
        raise ValueError(f"unknown mode {mode!r}")
    return terms[mode](model, eval_df, doc_col, text_col)


def perplexity(model: NgramModel, eval_df: DataFrame, mode: str, doc_col="doc_id", text_col="text") -> DataFrame:
    """``doc_id, model, m, logprob, perplexity`` for every (document, model)."""
    if mode == "unsmoothed":
        return score_unsmoothed(model, eval_df, doc_col, text_col)
    if mode == "laplace":
        return score_laplace(model, eval_df, doc_col, text_col)
    if mode == "interpolation":
        return score_interpolation(model, eval_df, doc_col, text_col)
    raise ValueError(f"unknown mode {mode!r}")


def identify_best(model: NgramModel, eval_df: DataFrame, mode: str, doc_col="doc_id", text_col="text") -> DataFrame:
    """C8 straight from the per-document score row (no long form, no second
    aggregation); same result as ``identify(perplexity(...))``."""
    if mode == "unsmoothed":
        return score_unsmoothed(model, eval_df, doc_col, text_col, best=mode)
    if mode == "laplace":
        return score_laplace(model, eval_df, doc_col, text_col, best=mode)
    if mode == "interpolation":
        return score_interpolation(model, eval_df, doc_col, text_col, best=mode)
    raise ValueError(f"unknown mode {mode!r}")


def identify(scores: DataFrame, mode: str, digits: int = 4) -> DataFrame:
    """Best (lowest perplexity) model per document; a tie goes to the
    first model in name order.  Scores are compared after rounding to
    ``digits`` so that the choice is stable under floating summation order."""
    key = F.struct(F.round("perplexity", digits).alias("p"), F.col("model").alias("m"))
    return (scores.where(F.col("perplexity").isNotNull())
            .groupBy("doc_id")
            .agg(F.min_by(F.struct("model", "perplexity"), key).alias("best"))
            .select("doc_id", F.col("best.model").alias("model"),
                    F.round("best.perplexity", 2).alias("perplexity"),
                    F.lit(MODE_ORDER[mode]).alias("n")))


def identification_report(best: DataFrame, truth: DataFrame, doc_col: str = "doc_id",
                          label_col: str = "label") -> DataFrame:
    """Confusion counts ``label, predicted, cnt``."""
    return (best.join(truth.select(F.col(doc_col).alias("doc_id"), F.col(label_col).alias("label")), "doc_id")
            .groupBy("label", F.col("model").alias("predicted"))
            .agg(F.count(F.lit(1)).cast("bigint").alias("cnt")))


def identification_accuracy(best: DataFrame, truth: DataFrame, doc_col: str = "doc_id",
                            label_col: str = "label") -> DataFrame:
    return (best.join(truth.select(F.col(doc_col).alias("doc_id"), F.col(label_col).alias("label")), "doc_id")
            .agg(F.count(F.lit(1)).cast("bigint").alias("n"),
                 F.avg((F.col("model") == F.col("label")).cast("double")).alias("accuracy")))


def oov_rate(model: NgramModel, eval_df: DataFrame, doc_col="doc_id", text_col="text") -> DataFrame:
    """C4: share of evaluation units each model would mask as ``<UNK>``."""
    docs = _doc_units(eval_df, model, doc_col, text_col)
    vocab = _gram_table(model, 1, "gram", "cnt").select("model", "gram", F.lit(1.0).alias("w"))
    rows = _score_rows(docs, model.eval_grams(1), vocab, _model_names(model))
    return rows.select("doc_id", "model", "m", (F.col("m") - F.col("seen")).cast("bigint").alias("n_oov"))


def rare_word_replace(corpus: DataFrame, model_col: str = "model", text_col: str = "text",
                      threshold: int = 1, doc_col: str = "doc_id") -> DataFrame:
    """C11: words seen at most ``threshold`` times in their model's corpus become
    ``<UNK>``; one row per word occurrence ``doc_id, model, pos, word, out``."""
    words = corpus.select(F.col(doc_col).alias("doc_id"), F.col(model_col).alias("model"),
                          F.posexplode(word_units(F.col(text_col))).alias("pos", "word"))
    counts = words.groupBy("model", "word").agg(F.count(F.lit(1)).alias("cnt"))
    return (words.join(counts, ["model", "word"])
            .select("doc_id", "model", "pos", "word",
                    F.when(F.col("cnt") <= threshold, F.lit("<UNK>")).otherwise(F.col("word")).alias("out")))


__all__ = [
    "NgramModel", "fit_ngram_model", "score_unsmoothed", "score_laplace", "score_interpolation",
    "interpolation_weights", "perplexity", "identify", "identification_report", "identification_accuracy",
    "oov_rate", "rare_word_replace", "ScoreTerms", "score_terms",
]
