"""Dependency-path queries over parsed tokens.

Input ``tokens(sent_id, i, text, tag, head)`` with 1-based ``i`` and
``head = 0`` at a root.  Each sentence is packed once (one shuffle on
``sent_id``) and the walk to the root is an ``aggregate`` over at most
``size`` steps, so a cyclic head table stops and is flagged instead of looping.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexis.operators.mentions import token_arrays

NONE = "-None-"  # fixed value printed when the two paths share no ancestor


def pack_trees(tokens: DataFrame) -> DataFrame:
    """``sent_id, texts, heads`` ordered by i."""
    return token_arrays(tokens, ("text", "head"))


def last_index(texts: Column, word: str) -> Column:
    """1-based index of the last token equal to ``word`` (NULL if none)."""
    pos = F.array_position(F.reverse(texts), word)
    return F.when(pos > 0, F.size(texts) - pos + 1)


def walk(heads: Column, start: Column) -> Column:
    """``struct<path array<int>, done boolean>`` -- token, then its
    ancestors up to a root (head 0)."""
    init = F.struct(F.array(start).alias("path"), F.lit(False).alias("done"))

    def step(acc, _):
        cur = F.element_at(acc["path"], -1)
        nxt = F.get(heads, cur - 1)
        stop = acc["done"] | (nxt == 0) | nxt.isNull()
        return F.when(stop, F.struct(acc["path"].alias("path"), F.lit(True).alias("done"))) \
            .otherwise(F.struct(F.array_append(acc["path"], nxt).alias("path"), F.lit(False).alias("done")))

    return F.when(start.isNotNull(), F.aggregate(F.sequence(F.lit(1), F.size(heads)), init, step))


def paths(tokens: DataFrame, roles=("SUBJECT", "OBJECT")) -> DataFrame:
    """``sent_id, texts, <role>_path array<int>, <role>_ok`` per role."""
    t = pack_trees(tokens)
    cols = []
    for r in roles:
        w = walk(F.col("heads"), last_index(F.col("texts"), r))
        cols += [w["path"].alias(f"{r.lower()}_path"), w["done"].alias(f"{r.lower()}_ok")]
    return t.select("sent_id", "texts", *cols)


def path_text(texts: Column, path: Column) -> Column:
    return F.array_join(F.transform(path, lambda k: F.get(texts, k - 1)), " -> ")


def lca(texts: Column, a: Column, b: Column) -> Column:
    """Align both paths from the root; the deepest equal token
    *position* is the answer (its text), ``-None-`` if the roots differ."""
    ra, rb = F.reverse(a), F.reverse(b)
    n = F.least(F.size(ra), F.size(rb))
    common = F.aggregate(
        F.sequence(F.lit(1), F.greatest(n, F.lit(1))),
        F.struct(F.lit(0).cast("bigint").alias("k"), F.lit(True).alias("same")),
        lambda acc, j: F.when(acc["same"] & (j <= n) & (F.element_at(ra, j) == F.element_at(rb, j)),
                              F.struct(F.element_at(ra, j).cast("bigint").alias("k"), F.lit(True).alias("same")))
        .otherwise(F.struct(acc["k"].alias("k"), F.lit(False).alias("same"))))
    return F.when(common["k"] > 0, F.get(texts, common["k"] - 1)).otherwise(F.lit(NONE))


def path_report(tokens: DataFrame) -> DataFrame:
    """``sent_id, subject_path, object_path, lca, valid`` (text form)."""
    p = paths(tokens)
    ok = F.col("subject_path").isNotNull() & F.col("object_path").isNotNull() & F.col("subject_ok") & F.col("object_ok")
    # lca first: the text columns below reuse the path names
    x = p.select("sent_id", "texts", "subject_path", "object_path", ok.alias("valid"),
                 F.when(ok, lca(F.col("texts"), F.col("subject_path"), F.col("object_path"))).alias("lca"))
    return x.select(
        "sent_id",
        path_text(F.col("texts"), F.col("subject_path")).alias("subject_path"),
        path_text(F.col("texts"), F.col("object_path")).alias("object_path"),
        "lca", "valid")
