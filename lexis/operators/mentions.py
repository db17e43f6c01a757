"""Entity mentions in ``[[ name | /m/id ]]`` markup.

Every operator works on one sentence row at a time with array functions, so
nothing shuffles except the join with the token table (on ``sent_id``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexis.functions.text import MARKUP_WORDS, MENTION_PATTERN, MID_PREFIX, NOUN_TAGS


def clean_sentence(sentence: Column) -> Column:
    """Drop the words ``[[``, ``]]``, ``|`` and any word starting ``/m/``
    (inside or outside brackets); single-space split and join."""
    words = F.split(sentence, " ")
    keep = F.filter(words, lambda w: ~(w.isin(*MARKUP_WORDS) | w.startswith(MID_PREFIX)))
    return F.array_join(keep, " ")


def raw_mentions(sentence: Column) -> Column:
    """Bracketed mention bodies in order (non-greedy)."""
    return F.regexp_extract_all(sentence, F.lit(MENTION_PATTERN), 1)


def mention_phrases(sentence: Column) -> Column:
    """Ordered distinct phrases: text before the first ``|``, trimmed."""
    return F.array_distinct(F.transform(raw_mentions(sentence), lambda m: F.trim(F.substring_index(m, "|", 1))))


def mentions(rel: DataFrame) -> DataFrame:
    """``sent_id, ord, phrase`` (W6: first occurrence wins)."""
    return (rel.select("sent_id", F.posexplode(mention_phrases(F.col("sentence"))).alias("o", "phrase"))
            .select("sent_id", (F.col("o") + 1).cast("int").alias("ord"), "phrase"))


def token_arrays(tokens: DataFrame, cols=("text", "tag")) -> DataFrame:
    """``sent_id, texts, tags`` ordered by ``i`` (one shuffle on sent_id)."""
    s = F.array_sort(F.collect_list(F.struct("i", *cols)), lambda a, b: a["i"] - b["i"])
    return tokens.groupBy("sent_id").agg(s.alias("_s")).select(
        "sent_id", *[F.col(f"_s.{c}").alias(f"{c}s") for c in cols])


def span_matches(rel: DataFrame, tokens: DataFrame) -> DataFrame:
    """First token span equal to each phrase -> ``sent_id, ord, phrase,
    start, tags`` (no row when the phrase never matches).  The length guard
    avoids ``sequence(1, 0)`` = [1, 0]."""
    toks = token_arrays(tokens)
    m = mentions(rel).join(toks, "sent_id")
    p = F.split("phrase", " ")
    n, k = F.size("texts"), F.size(p)
    starts = F.when(n >= k, F.filter(F.sequence(F.lit(1), n - k + 1),
                                     lambda s: F.slice("texts", s, k) == p)).otherwise(F.array().cast("array<int>"))
    return (m.select("sent_id", "ord", "phrase", "tags", F.try_element_at(starts, F.lit(1)).alias("start"))
            .where(F.col("start").isNotNull())
            .select("sent_id", "ord", "phrase", "start", F.slice("tags", F.col("start"), F.size(F.split("phrase", " ")))
                    .alias("tags")))


def noun_mismatch(rel: DataFrame, tokens: DataFrame) -> DataFrame:
    """Matched phrases whose tags contain no noun tag."""
    nouns = F.array(*[F.lit(t) for t in NOUN_TAGS])
    return span_matches(rel, tokens).where(~F.arrays_overlap("tags", nouns))


def mention_consistency(rel: DataFrame, tokens: DataFrame) -> DataFrame:
    """Number of mentions = number of matched spans (a consistency flag)."""
    n_m = rel.select("sent_id", F.size(mention_phrases(F.col("sentence"))).alias("n_mentions"))
    n_x = span_matches(rel, tokens).groupBy("sent_id").agg(F.count(F.lit(1)).alias("n_matched"))
    return (n_m.join(n_x, "sent_id", "left")
            .select("sent_id", "n_mentions", F.coalesce("n_matched", F.lit(0)).alias("n_matched")))


def _entity_struct(m: Column) -> Column:
    parts = F.split(m, r"\|")
    return F.struct(F.upper(F.trim(F.get(parts, 0))).alias("name"), F.trim(F.get(parts, 1)).alias("mid"))


def role_array(rel: DataFrame) -> Column:
    """``array<struct<role, name, mid>>``: SUBJECT, OBJECT, then each new
    bracketed mid in order as ENTITY1, ENTITY2, ..."""
    subj = F.struct(F.lit("SUBJECT").alias("role"), F.upper("pair.subject.name").alias("name"),
                    F.col("pair.subject.mid").alias("mid"))
    obj = F.struct(F.lit("OBJECT").alias("role"), F.upper("pair.object.name").alias("name"),
                   F.col("pair.object.mid").alias("mid"))
    ents = F.transform(raw_mentions(F.col("sentence")), _entity_struct)
    # keep a mention if its mid is not a pair mid and not seen earlier; a mention
    # without an id is no entity and hides none
    ents = F.filter(ents, lambda e: e["mid"].isNotNull())
    fresh = F.filter(ents, lambda e, i: ~(
        e["mid"].eqNullSafe(F.col("pair.subject.mid")) | e["mid"].eqNullSafe(F.col("pair.object.mid"))
        | F.exists(F.slice(ents, 1, i), lambda x: x["mid"] == e["mid"])))
    numbered = F.transform(fresh, lambda e, i: F.struct(
        F.concat(F.lit("ENTITY"), (i + 1).cast("string")).alias("role"), e["name"].alias("name"),
        e["mid"].alias("mid")))
    return F.concat(F.array(subj, obj), numbered)


def entity_roles(rel: DataFrame) -> DataFrame:
    """``sent_id, ord, role, name, mid``."""
    return (rel.select("sent_id", F.posexplode(role_array(rel)).alias("o", "r"))
            .select("sent_id", (F.col("o") + 1).cast("int").alias("ord"), "r.role", "r.name", "r.mid"))


def entity_validity(rel: DataFrame) -> Column:
    """Every bracketed mention has an id part (the reference fails otherwise)."""
    return F.forall(raw_mentions(F.col("sentence")), lambda m: F.size(F.split(m, r"\|")) >= 2)


def rewrite_words(sentence: Column, roles: Column) -> Column:
    """``[[`` and ``]]`` open and close a bracket; a ``/m/`` word
    becomes the first role with that mid (or is dropped); other words inside
    brackets are dropped; everything else (``|`` included) is kept."""
    words = F.split(sentence, " ")

    def inside(i):
        marks = F.filter(F.slice(words, 1, i), lambda w: w.isin("[[", "]]"))
        return F.coalesce(F.try_element_at(marks, F.lit(-1)) == "[[", F.lit(False))

    def out(w, i):
        role = F.try_element_at(F.filter(roles, lambda r: r["mid"] == w), F.lit(1))["role"]
        return (F.when(w.isin("[[", "]]"), F.lit(None))
                .when(w.startswith(MID_PREFIX), role)
                .when(inside(i), F.lit(None))
                .otherwise(w))

    return F.filter(F.transform(words, out), lambda w: w.isNotNull())


def role_rewrite(rel: DataFrame) -> DataFrame:
    """``sent_id, text``: the sentence with mentions replaced by role words."""
    return rel.select("sent_id", F.array_join(rewrite_words(F.col("sentence"), role_array(rel)), " ").alias("text"))
