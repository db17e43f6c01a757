"""Fixtures F1-F6: the reference's inputs re-derived from the driver tables.

Every fixture is a lazy DataFrame over the *whole* table (no id subsets, no
prefixes).  The evaluation split ``doc_id % 5 = 0`` is a split, not a filter:
every row is used on one side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexis.functions.text import MENTION_PATTERN, whitespace_split

# sent_id = doc_id * LINE_STRIDE + line number.  A text has fewer than 2^31 bytes and
# so fewer lines; an id of 2^32 or more overflows the product, which fails loudly.
LINE_STRIDE = 1 << 31


def is_eval(doc_col: str = "doc_id"):
    return F.col(doc_col) % 5 == 0


def language_corpus(documents: DataFrame) -> DataFrame:
    """F1 ``doc_id, lang, is_train, text``: model = language."""
    return documents.select("doc_id", "lang", (~is_eval()).alias("is_train"), "text")


def _lines(documents: DataFrame) -> DataFrame:
    return documents.select("doc_id", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))


def tag_rule(word, prev):
    """F2 tag rule (fixed values): first match of
    after 'the' -> NN; ends in 'ing' -> VB; of/in/on -> IN; length <= 3 -> DT; else JJ."""
    return (F.when(prev == "the", "NN")
            .when(word.endswith("ing"), "VB")
            .when(word.isin("of", "in", "on"), "IN")
            .when(F.length(word) <= 3, "DT")
            .otherwise("JJ"))


def tagged_sentences(documents: DataFrame) -> DataFrame:
    """F2 ``sent_id, pos, word, tag, is_train``: all documents, one sentence
    per non-empty line, lower-cased whitespace words, rule tags."""
    s = tagged_sentence_arrays(documents)
    return (s.select("sent_id", "is_train", F.posexplode(F.arrays_zip("words", "tags")).alias("p0", "wt"))
            .select("sent_id", (F.col("p0") + 1).cast("int").alias("pos"), F.col("wt.words").alias("word"),
                    F.col("wt.tags").alias("tag"), "is_train"))


def tagged_sentence_arrays(documents: DataFrame) -> DataFrame:
    """F2 in packed form ``sent_id, is_train, words array, tags array`` computed
    without a shuffle (the previous word is read from the same array)."""
    # exploding a one-element array keeps the filter above the split: words are split once
    lines = (_lines(documents)
             .select((F.col("doc_id") * LINE_STRIDE + F.col("line_no")).alias("sent_id"), (~is_eval()).alias("is_train"),
                     F.explode(F.array(whitespace_split(F.lower("line")))).alias("words"))
             .where(F.size("words") > 0))
    tags = F.transform("words", lambda w, i: tag_rule(w, F.when(i > 0, F.get(F.col("words"), i - 1))))
    return lines.select("sent_id", "is_train", "words", tags.alias("tags"))


def tagged_lines(documents: DataFrame) -> DataFrame:
    """F2 written as the two-column format: ``file, line_no, line`` where each
    document is one file, sentences end with a blank line."""
    s = tagged_sentence_arrays(documents)
    body = s.select(F.col("sent_id"), F.posexplode(F.arrays_zip("words", "tags")).alias("p", "wt"))
    file = F.shiftright("sent_id", 31).alias("file")
    # every fourth line is padded with tabs
    line = F.when(F.col("p") % 4 == 0, F.concat(F.lit("\t"), "wt.words", F.lit("\t"), "wt.tags", F.lit("\t"))) \
        .otherwise(F.concat_ws(" ", "wt.words", "wt.tags"))
    rows = body.select(file, "sent_id", F.col("p").cast("int").alias("p"), line.alias("line"))
    blanks = s.select(file, "sent_id",
                      F.size("words").cast("int").alias("p"), F.lit("").alias("line"))
    return rows.unionByName(blanks)


def relations(customer: DataFrame, nation: DataFrame, region: DataFrame) -> DataFrame:
    """F3 ``sent_id, sentence, pair`` (subject = customer, object = nation).

    Variants (fixed rules on c_custkey): %7 repeats the nation mention, %11 adds
    a known /m/ word outside brackets, %13 an unknown one, %17 makes the object
    id equal to the subject id, %19 writes the region mention without ``|``, %5
    ends with a new entity."""
    k = F.col("c_custkey")
    cm = F.concat(F.lit("/m/c"), k.cast("string"))
    nm = F.concat(F.lit("/m/n"), F.col("n_nationkey").cast("string"))
    rm = F.concat(F.lit("/m/r"), F.col("r_regionkey").cast("string"))
    subj_name = F.concat_ws(" ", "c_name", "c_mktsegment")
    region_mention = F.when(k % 19 == 0, F.concat(F.lit("[[ "), F.col("r_name"), F.lit(" ]]"))) \
        .otherwise(F.concat(F.lit("[[ "), F.col("r_name"), F.lit(" | "), rm, F.lit(" ]]")))
    sentence = F.concat_ws(
        " ",
        F.concat(F.lit("[[ "), subj_name, F.lit(" | "), cm, F.lit(" ]]")),
        F.lit("trades from"),
        F.concat(F.lit("[[ "), F.col("n_name"), F.lit(" | "), nm, F.lit(" ]]")),
        F.lit("in"), region_mention,
        F.when(k % 7 == 0, F.concat(F.lit("near [[ "), F.col("n_name"), F.lit(" | "), nm, F.lit(" ]]"))),
        F.when(k % 11 == 0, F.concat(F.lit("via "), rm)),
        F.when(k % 13 == 0, F.concat(F.lit("via /m/z"), k.cast("string"))),
        F.when(k % 5 == 0, F.concat(F.lit("for [[ AGENT | /m/a"), k.cast("string"), F.lit(" ]]"))),
    )
    pair = F.struct(
        F.struct(subj_name.alias("name"), cm.alias("mid")).alias("subject"),
        F.struct(F.col("n_name").alias("name"), F.when(k % 17 == 0, cm).otherwise(nm).alias("mid")).alias("object"),
    )
    return (customer.select("c_custkey", "c_name", "c_mktsegment", "c_nationkey")
            .join(nation.select("n_nationkey", "n_name", "n_regionkey"), F.col("c_nationkey") == F.col("n_nationkey"))
            .join(region.select("r_regionkey", "r_name"), F.col("n_regionkey") == F.col("r_regionkey"))
            .select(k.cast("bigint").alias("sent_id"), sentence.alias("sentence"), pair.alias("pair")))


def relation_tokens(rel: DataFrame) -> DataFrame:
    """F3t ``sent_id, i, text, tag`` for the cleaned sentence (tagger stand-in).

    Tag rule (fixed): word after a ``Customer#`` word -> JJ; ``Customer#..`` ->
    NNP; ``NATION_k`` -> JJ if k % 3 = 0 else NNP; ``trades`` -> VBZ; other
    lower-case words -> IN; anything else -> NNP."""
    from lexis.operators.mentions import clean_sentence
    words = F.col("ws")

    def tag(w, i):
        prev = F.when(i > 0, F.get(words, i - 1))
        nation_no = F.regexp_extract(w, r"^NATION_([0-9]+)$", 1)
        return (F.when(F.coalesce(prev.startswith("Customer#"), F.lit(False)), "JJ")
                .when(w.startswith("Customer#"), "NNP")
                .when(nation_no != "", F.when(nation_no.cast("int") % 3 == 0, "JJ").otherwise("NNP"))
                .when(w == "trades", "VBZ")
                .when(w == F.lower(w), "IN")
                .otherwise("NNP"))

    z = F.transform(words, lambda w, i: F.struct((i + 1).cast("int").alias("i"), w.alias("text"), tag(w, i).alias("tag")))
    # a sentence is cleaned and split once, not for every word's neighbour
    split = rel.select("sent_id", F.explode(F.array(F.split(clean_sentence(F.col("sentence")), " "))).alias("ws"))
    return split.select("sent_id", F.inline(z))


def parsed_tokens(rel: DataFrame) -> DataFrame:
    """F4 ``sent_id, i, text, tag, head``: words of the role-rewritten sentence,
    ``head = floor(i/2)`` (root i = 1); when sent_id % 4 = 0 the last OBJECT
    token is a second root."""
    from lexis.operators.mentions import rewrite_words, role_array
    words = rewrite_words(F.col("sentence"), role_array(rel))
    x = rel.select("sent_id", words.alias("w"))
    last_obj = F.size("w") - F.array_position(F.reverse("w"), "OBJECT") + 1
    has_obj = F.array_position(F.reverse("w"), "OBJECT") > 0

    def tok(w, i):
        k = (i + 1).cast("int")
        second_root = (F.col("sent_id") % 4 == 0) & has_obj & (k == last_obj)
        head = F.when(second_root, F.lit(0)).otherwise(F.floor(k / 2).cast("int"))
        tag = F.when(w.isin("SUBJECT", "OBJECT") | w.startswith("ENTITY"), "NNP").otherwise("X")
        return F.struct(k.alias("i"), w.alias("text"), tag.alias("tag"), head.alias("head"))

    return x.select("sent_id", F.inline(F.transform("w", tok)))


def labelled_samples(documents: DataFrame, labels: DataFrame, label: str = "quality") -> DataFrame:
    """F5 ``sample_id, label, text, is_train``: documents joined to labels."""
    lab = F.col("quality").cast("string") if label == "quality" else F.col("lang")
    return (documents.select("doc_id", "text", "lang")
            .join(labels.select("doc_id", "quality"), "doc_id")
            .select(F.col("doc_id").alias("sample_id"), lab.alias("label"), "text", (~is_eval()).alias("is_train")))


def lemma_table(tokens: DataFrame) -> DataFrame:
    """F6 ``token, lemma``: tokens ending in ing / ed / s map to the stem
    (first match; the stem keeps at least two characters)."""
    t = F.col("term")
    lemma = (F.when(t.endswith("ing") & (F.length(t) > 4), F.expr("substring(term, 1, length(term) - 3)"))
             .when(t.endswith("ed") & (F.length(t) > 3), F.expr("substring(term, 1, length(term) - 2)"))
             .when(t.endswith("s") & (F.length(t) > 2), F.expr("substring(term, 1, length(term) - 1)")))
    return (tokens.select("term").distinct().where(lemma.isNotNull())
            .select(t.alias("token"), lemma.alias("lemma")))


__all__ = ["language_corpus", "tagged_sentences", "tagged_sentence_arrays", "tagged_lines", "relations",
           "relation_tokens", "parsed_tokens", "labelled_samples", "lemma_table", "MENTION_PATTERN"]
