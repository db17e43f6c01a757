"""Part-of-speech tagging queries over fixture F2 (all documents)."""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import functions as F

from lexis.functions.text import whitespace_split
from lexis.operators import backoff, hmm, longviterbi, rules
from lexis.operators import sequences as sq
from lexis.plans.sizing import bounded_broadcast
from lexis.session import written
from lexis.sources import fixtures as fx
from lexis.sources.tables import table

UNK_THRESHOLD = 1


@lru_cache(maxsize=8)
def packed(spark, sf_dir):
    """Written, not cached: readers take the columns they need in splits of bounded
    size, where cached blocks grow with the input."""
    return written(fx.tagged_sentence_arrays(table(spark, sf_dir, "documents")), "tagged")


def train_packed(spark, sf_dir):
    return packed(spark, sf_dir).where("is_train")


def eval_tokens(spark, sf_dir):
    """Evaluation sentences in long form with their gold tags."""
    return sq.unpack(packed(spark, sf_dir).where("not is_train"))


def train_tokens(spark, sf_dir):
    return sq.unpack(train_packed(spark, sf_dir))


def tagged_sentences(spark, sf_dir):
    lines = fx.tagged_lines(table(spark, sf_dir, "documents"))
    s = sq.sentences_from_lines(lines, "file", ["sent_id", "p"], "line")
    return s.select("file", "sent_no", "pos", "word", "tag")


def word_counts(spark, sf_dir):
    return sq.word_counts(train_tokens(spark, sf_dir))


def unk_replace(spark, sf_dir):
    t = train_tokens(spark, sf_dir)
    r = sq.replace_rare(t, sq.word_counts(t), UNK_THRESHOLD)
    return r.select("sent_id", "pos", F.col("model_word").alias("word"), "tag")


def _eval_replaced(spark, sf_dir):
    counts = sq.word_counts(train_tokens(spark, sf_dir))
    return sq.replace_rare(eval_tokens(spark, sf_dir), counts, UNK_THRESHOLD, unseen_too=True)


def unk_restore(spark, sf_dir):
    return _eval_replaced(spark, sf_dir).select("sent_id", "pos", "word", "model_word")


def slash_tag_encode(spark, sf_dir):
    return sq.encode_slash(packed(spark, sf_dir))


def slash_tag_decode(spark, sf_dir):
    return sq.decode_slash(sq.encode_slash(packed(spark, sf_dir)))


@lru_cache(maxsize=8)
def backoff_model_df(spark, sf_dir):
    return written(backoff.fit_backoff(train_packed(spark, sf_dir)), "backoff")


def backoff_model(spark, sf_dir):
    return backoff.fit_backoff(train_packed(spark, sf_dir))


def backoff_tag(spark, sf_dir):
    ev = eval_tokens(spark, sf_dir).select("sent_id", "pos", "word")
    return backoff.tag_backoff(ev, backoff_model_df(spark, sf_dir))


@lru_cache(maxsize=8)
def hmm_model(spark, sf_dir):
    """HMM trained on words with count <= 1 replaced by <UNK>."""
    m = _replaced_hmm(train_packed(spark, sf_dir))
    return {k: v.cache() for k, v in m.items()}


def _replaced_hmm(gold):
    """HMM of packed sentences ``sent_id, words, tags`` after rare words are replaced.

    Words are counted with their tags before they are replaced, so no token moves.  Only
    rows that share a ``sent_id`` are packed again, as one sentence."""
    t = sq.unpack(gold)
    counts = sq.word_counts(t).cache()
    pairs = sq.replace_rare(t.groupBy("tag", "word").agg(F.count(F.lit(1)).alias("n")), counts, UNK_THRESHOLD)
    # read twice by the model; written, so that tokens are counted with their tags once
    pairs = written(pairs.groupBy("tag", F.col("model_word").alias("word")).agg(F.sum("n").alias("c")), "pairs")
    shared = bounded_broadcast(gold.groupBy("sent_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("sent_id"))[0]
    r = sq.replace_rare(sq.unpack(gold.join(shared, "sent_id", "left_semi")), counts, UNK_THRESHOLD)
    again = sq.pack(r.select("sent_id", "pos", F.col("model_word").alias("word"), "tag"))
    tags = gold.join(shared, "sent_id", "left_anti").select("tags").unionByName(again.select("tags"))
    return hmm.fit_hmm(tags, counted=pairs)


def hmm_start(spark, sf_dir):
    return hmm_model(spark, sf_dir)["start"]


def hmm_transition(spark, sf_dir):
    return hmm_model(spark, sf_dir)["transition"]


def hmm_emission(spark, sf_dir):
    return hmm_model(spark, sf_dir)["emission"]


def hmm_predictions(spark, sf_dir):
    ev = _eval_replaced(spark, sf_dir)
    # the original words stay packed beside the replaced ones
    return hmm.tag_hmm(ev, hmm_model(spark, sf_dir), word_col="model_word", keep="word")


def hmm_tag_plain(spark, sf_dir):
    """HMM without rare-word replacement."""
    model = {k: v.cache() for k, v in hmm.fit_hmm(train_packed(spark, sf_dir)).items()}
    return hmm.tag_hmm(eval_tokens(spark, sf_dir), model, keep="word").select("sent_id", "pos", "word", "tag")


def hmm_tag(spark, sf_dir):
    return hmm_predictions(spark, sf_dir).select("sent_id", "pos", "word", "tag")


def hmm_tag_documents(spark, sf_dir):
    """Every evaluation document decoded as one sequence of all its words, by segments."""
    docs = table(spark, sf_dir, "documents").where(fx.is_eval())
    toks = docs.select(F.col("doc_id").alias("sent_id"), F.posexplode(whitespace_split(F.lower("text"))).alias("p", "word")) \
        .select("sent_id", (F.col("p") + 1).alias("pos"), "word")
    replaced = sq.replace_rare(toks, sq.word_counts(train_tokens(spark, sf_dir)), UNK_THRESHOLD, unseen_too=True)
    out = longviterbi.tag_long(replaced, hmm_model(spark, sf_dir), word_col="model_word", keep="word")
    return out.select(F.col("sent_id").alias("doc_id"), "pos", "word", "tag",
                      F.floor(F.col("score") * 1000).cast("long").alias("score_milli"))


def tag_alignment(spark, sf_dir):
    pred = hmm_predictions(spark, sf_dir).select("sent_id", "pos", "word", "tag")
    return sq.align_tags(eval_tokens(spark, sf_dir), pred, sq.word_counts(train_tokens(spark, sf_dir)))


def _accuracy(spark, sf_dir, pred):
    aligned = sq.align_tags(eval_tokens(spark, sf_dir), pred.select("sent_id", "pos", "word", "tag"),
                            sq.word_counts(train_tokens(spark, sf_dir)))
    return sq.tag_accuracy(aligned).select("known", "n", F.round("accuracy", 6).alias("accuracy"))


def tag_accuracy(spark, sf_dir):
    return _accuracy(spark, sf_dir, hmm_predictions(spark, sf_dir))


def backoff_accuracy(spark, sf_dir):
    return _accuracy(spark, sf_dir, backoff_tag(spark, sf_dir))


@lru_cache(maxsize=8)
def brill_state(spark, sf_dir):
    """Training sentences with gold tags and the backoff tagger's tags."""
    return written(_brill_state(train_packed(spark, sf_dir), backoff_model_df(spark, sf_dir)), "state")


def _brill_state(gold, model):
    """``sent_id, words, gold, cur`` of packed sentences ``sent_id, words, tags``; rows of one
    ``sent_id`` are tagged as one sentence, their words in the order of their places."""
    gold = gold.where("sent_id IS NOT NULL").select("sent_id", "words", "tags")
    shared = bounded_broadcast(gold.groupBy("sent_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("sent_id"))[0]
    # only rows that share a sent_id move
    again = (gold.join(shared, "sent_id", "left_semi").groupBy("sent_id").agg(F.collect_list(F.struct("words", "tags")).alias("rows")))
    places = F.flatten(F.transform("rows", lambda r: F.transform(r["words"], lambda w, i: F.struct(i.alias("i"), w.alias("w")))))
    again = again.select("sent_id", F.sort_array(places)["w"].alias("words"),
                         F.transform("rows", lambda r: F.struct(r["words"].alias("words"), r["tags"].alias("gold"))).alias("rows"))
    kept = F.array(F.struct(F.lit(None).cast("array<string>").alias("words"), F.col("tags").alias("gold")))
    rows = gold.join(shared, "sent_id", "left_anti").select("sent_id", "words", kept.alias("rows")).unionByName(again)
    tagged = backoff.tag_packed(rows, model)
    return (tagged.select("sent_id", "words", F.col("tags").alias("cur"), F.explode("rows").alias("r"))
            .select("sent_id", F.coalesce("r.words", "words").alias("words"), "r.gold", "cur"))


def brill_rule_scores(spark, sf_dir):
    s = rules.score_rules(brill_state(spark, sf_dir))
    names = F.element_at(F.array(*[F.lit(rules.template_name(t)) for t in rules.TEMPLATES]), F.col("tpl") + 1)
    return s.select(names.alias("template"), "from_tag", "to_tag", "key", "fixes", "breaks", "score")


def brill_apply(spark, sf_dir):
    """The first learned rule applied to the training data: changed positions."""
    st = brill_state(spark, sf_dir)
    best = rules._best(rules.score_rules(st))[0]
    return _changed_places(st, best)


def _changed_places(st, rule):
    """``sent_id, pos, word, old_tag, new_tag`` where the rule changes a tag; rows that share a
    ``sent_id`` share their tags, and each of them meets all."""
    hit = rules.changes(st, {k: rule[k] for k in ("tpl", "from_tag", "to_tag", "key")}).withColumn("old", F.col("cur"))
    after = rules.apply_rule(hit, rule["tpl"], rule["from_tag"], rule["to_tag"], rule["key"], "cur")
    shared = bounded_broadcast(st.groupBy("sent_id").agg(F.count(F.lit(1)).cast("int").alias("n")).where("n > 1"))[0]
    z = F.arrays_zip(F.col("words").alias("word"), F.col("old").alias("old_tag"), F.col("cur").alias("new_tag"))
    return (after.join(shared, "sent_id", "left")
            .select("sent_id", "n", F.posexplode(z).alias("p0", "x"))
            .where(F.col("x.old_tag") != F.col("x.new_tag"))
            .select("sent_id", (F.col("p0") + 1).cast("int").alias("pos"), "x.word", "x.old_tag", "x.new_tag",
                    F.explode(F.array_repeat(F.lit(1), F.coalesce("n", F.lit(1)))).alias("_copy")).drop("_copy"))


@lru_cache(maxsize=8)
def learned(spark, sf_dir):
    return rules.fit_rules(_brill_state(train_packed(spark, sf_dir), backoff_model_df(spark, sf_dir)))


def brill_train(spark, sf_dir):
    """The learned rule list."""
    schema = "rule_no int, template string, from_tag string, to_tag string, key string, score bigint"
    return spark.createDataFrame([(r["rule_no"], r["template"], r["from_tag"], r["to_tag"], r["key"], r["score"])
                                  for r in learned(spark, sf_dir)], schema)


def _apply_to(tagged, rule_list):
    """Learned rules over a base tagger's ``sent_id, pos, word, tag``."""
    state = sq.pack(tagged).select("sent_id", "words", F.col("tags").alias("cur"))
    return sq.unpack(rules.apply_rules(state, rule_list).withColumnRenamed("cur", "tags"))


def brill_tag(spark, sf_dir):
    """Evaluation sentences tagged by the backoff tagger and the learned rules."""
    return _apply_to(backoff_tag(spark, sf_dir), learned(spark, sf_dir))


def brill_accuracy(spark, sf_dir):
    return _accuracy(spark, sf_dir, brill_tag(spark, sf_dir))


def brill_tag_unk(spark, sf_dir):
    """The same with rare and unseen words replaced by ``<UNK>`` for both taggers and
    restored in the result."""
    t = train_tokens(spark, sf_dir)
    train = sq.replace_rare(t, sq.word_counts(t), UNK_THRESHOLD).select("sent_id", "pos", F.col("model_word").alias("word"), "tag")
    gold = written(sq.pack(train), "replaced")
    model = written(backoff.fit_backoff(gold), "backoff")
    rule_list = rules.fit_rules(_brill_state(gold, model))
    ev = _eval_replaced(spark, sf_dir)
    tags = _apply_to(backoff.tag_backoff(ev.select("sent_id", "pos", F.col("model_word").alias("word")), model), rule_list)
    return ev.select("sent_id", "pos", "word").join(tags.select("sent_id", "pos", "tag"), ["sent_id", "pos"])


QUERIES = {
    "tagged_sentences": tagged_sentences,
    "word_counts": word_counts,
    "unk_replace": unk_replace,
    "unk_restore": unk_restore,
    "slash_tag_encode": slash_tag_encode,
    "slash_tag_decode": slash_tag_decode,
    "backoff_model": backoff_model,
    "backoff_tag": backoff_tag,
    "hmm_start": hmm_start,
    "hmm_transition": hmm_transition,
    "hmm_emission": hmm_emission,
    "hmm_tag": hmm_tag,
    "tag_alignment": tag_alignment,
    "tag_accuracy": tag_accuracy,
    "brill_rule_scores": brill_rule_scores,
    "brill_apply": brill_apply,
    "brill_train": brill_train,
    "brill_tag": brill_tag,
    "brill_tag_unk": brill_tag_unk,
    "brill_accuracy": brill_accuracy,
    "backoff_accuracy": backoff_accuracy,
    "hmm_tag_plain": hmm_tag_plain,
    "hmm_tag_documents": hmm_tag_documents,
}
