"""The best of very many language models per document (C8 / A12), by inverted lists.

Models are dealt into blocks of similar ones.  Two inverted lists hold the weights:
gram -> blocks with the highest weight of each, and (gram, block) -> the block's models.
A document first sums the block bounds; no model of a block scores above its
block's sum.  The block with the best bound is scored exactly, its k-th best model
is the threshold, and only blocks whose bound reaches it are scored as well.  The
result is that of scoring every model: bounds only decide what need not be looked at.

A row of the bound pass stands for BLOCK models, so its joins carry one row per
gram and block instead of one per gram and model, and no table has a column per model.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lexis.functions.numeric import perplexity_from
from lexis.operators.langmodel import NgramModel, score_terms
from lexis.operators.ordering import global_row_number
from lexis.session import written

BLOCK = 64        # models of a block
SIDES = 12        # random directions that models are told apart by
MARGIN = 1e-9     # relative; sums of the same terms in another order differ by less


def model_blocks(weights: DataFrame, per_model: DataFrame, block: int = BLOCK) -> DataFrame:
    """``model, log_unseen, block``: models on the same sides of random directions stand together.

    A side is the sign of a random sum of the model's weights, relative to their size and to the
    mean of all models; which blocks come out changes the work, never the result."""
    signed = lambda i: F.when(F.shiftright(F.xxhash64("gram"), i).bitwiseAND(F.lit(1)) == 1, F.col("w")).otherwise(-F.col("w"))
    sums = weights.groupBy("model").agg(F.sum(F.abs("w")).alias("size"), *[F.sum(signed(i)).alias(f"s{i}") for i in range(SIDES)])
    sides = sums.select("model", *[F.try_divide(f"s{i}", "size").alias(f"s{i}") for i in range(SIDES)])
    mean = sides.agg(F.array(*[F.avg(f"s{i}") for i in range(SIDES)])).scalar()
    code = F.concat(*[F.when(F.col(f"s{i}") > F.get("mean", F.lit(i)), F.lit("1")).otherwise(F.lit("0")) for i in range(SIDES)])
    coded = sides.withColumn("mean", mean).select("model", code.alias("code"))
    placed = per_model.where(F.col("log_unseen").isNotNull()).join(coded, "model", "left").select(
        "model", "log_unseen", F.coalesce("code", F.lit("")).alias("code"))
    ranked = global_row_number(placed, ["code", "log_unseen", "model"], "rank")
    return ranked.select("model", "log_unseen", F.floor((F.col("rank") - 1) / block).cast("int").alias("block"))


def inverted_lists(weights: DataFrame, blocks: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Bounds ``gram, b: [(block, bound)]`` and postings ``gram, block, p: [(model, w)]``.

    A list holds the blocks of one gram, a posting list at most the models of one block."""
    size = blocks.groupBy("block").agg(F.count(F.lit(1)).alias("size"))
    postings = (weights.where(F.col("w").isNotNull()).join(blocks.select("model", "block"), "model")
                .groupBy("gram", "block").agg(F.collect_list(F.struct("model", "w")).alias("p")))
    top = F.array_max(F.transform("p", lambda x: x["w"]))
    # a model outside the list has weight 0
    bound = F.when(F.size("p") == F.col("size"), top).otherwise(F.greatest(top, F.lit(0.0)))
    bounds = (postings.join(size, "block").select("gram", F.struct("block", bound.alias("bound")).alias("x"))
              .groupBy("gram").agg(F.collect_list("x").alias("b")))
    return bounds, postings


def _exact(asked: DataFrame, occ: DataFrame, postings: DataFrame, members: DataFrame) -> DataFrame:
    """``doc_id, model, perplexity`` of every model of the asked blocks (``doc_id, m, n_occ, block``)."""
    seen = (occ.join(asked.select("doc_id", "block"), "doc_id").join(postings, ["gram", "block"])
            .select("doc_id", "k", F.inline("p")).groupBy("doc_id", "model").agg(F.sum(F.col("k") * F.col("w")).alias("seen")))
    every = asked.join(members, "block")     # BLOCK models of each asked block
    logprob = F.coalesce("seen", F.lit(0.0)) + F.col("n_occ") * F.col("log_unseen")
    return every.join(seen, ["doc_id", "model"], "left").select(
        "doc_id", "model", perplexity_from(logprob, F.col("m")).alias("perplexity"))


def identify_top(model: NgramModel, eval_df: DataFrame, mode: str, k: int = 1, doc_col: str = "doc_id",
                 text_col: str = "text", block: int = BLOCK, digits: int = 4) -> DataFrame:
    """``doc_id, rank, model, perplexity``: the k models of lowest perplexity (rounded to ``digits``,
    ties by name) of every document that has units; fewer if there are fewer models."""
    terms = score_terms(model, eval_df, mode, doc_col, text_col)
    per_model = written(terms.per_model, "per-model")
    weights = written(terms.weights, "weights")
    members = written(model_blocks(weights, per_model, block), "blocks")
    bounds, postings = inverted_lists(weights, members)
    postings = written(postings.repartition("gram"), "postings")
    docs = terms.docs.where(F.col("m") > 0)
    sizes = docs.select("doc_id", "m", terms.n_occ.alias("n_occ"))
    occ = written(docs.select("doc_id", F.explode(terms.grams).alias("gram")).groupBy("doc_id", "gram")
                  .agg(F.count(F.lit(1)).alias("k")), "occurrences")
    sums = (occ.join(bounds, "gram").select("doc_id", "k", F.inline("b")).groupBy("doc_id", "block")
            .agg(F.sum(F.col("k") * F.col("bound")).alias("s"))
            .groupBy("doc_id").agg(F.map_from_entries(F.collect_list(F.struct("block", "s"))).alias("s")))
    # every block has a bound, also those that share no gram with the document
    tops = (members.groupBy("block").agg(F.max("log_unseen").alias("top"))
            .agg(F.collect_list(F.struct("block", "top"))).scalar())
    empty = F.create_map().cast("map<int,double>")
    low = F.transform("tops", lambda b: F.struct(
        perplexity_from(F.coalesce(F.try_element_at(F.coalesce("s", empty), b["block"]), F.lit(0.0))
                        + F.col("n_occ") * b["top"], F.col("m")).alias("low"), b["block"].alias("block")))
    bounded = written(sizes.join(sums, "doc_id", "left").withColumn("tops", tops).select("doc_id", "m", "n_occ", low.alias("low")), "bounds")
    best = F.array_min("low")
    first = written(_exact(bounded.select("doc_id", "m", "n_occ", best["block"].alias("block")), occ, postings, members), "first")
    order = Window.partitionBy("doc_id").orderBy("p", "model")
    ranked = lambda df: (df.withColumn("p", F.round("perplexity", digits)).withColumn("rank", F.row_number().over(order))
                         .where(F.col("rank") <= k))
    threshold = ranked(first).where(F.col("rank") == k).select("doc_id", F.col("p").alias("least"))
    reach = F.filter("low", lambda x: (x["block"] != best["block"]) & (
        F.col("least").isNull() | (F.round(x["low"] * (1 - MARGIN), digits) <= F.col("least"))))
    rest = (bounded.join(threshold, "doc_id", "left").select("doc_id", "m", "n_occ", F.explode(reach).alias("x"))
            .select("doc_id", "m", "n_occ", "x.block"))
    return ranked(first.unionByName(_exact(rest, occ, postings, members))).select(
        "doc_id", F.col("rank").cast("int").alias("rank"), "model", "perplexity")
