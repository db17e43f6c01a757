"""Ancestors in trees larger than a row (C21, C22, J12, J13): pointer doubling.

``trees`` packs a sentence into a row and walks inside it.  Here a tree stays
long rows ``(sent_id, i, head)`` and every step is a join: level r of the lifting
tables holds each node's ancestor 2^r steps up, level r + 1 is level r joined with
itself, and a path or a common ancestor of depth d takes log2(d) joins.

A head of 0, null, or of no token of the tree marks a root.  Nodes that still have an
ancestor as many steps up as the largest tree has nodes lead into a cycle; they are
flagged and have no path.  Of rows that repeat ``(sent_id, i)`` the one with the smallest
head, then text, counts; rows without ``sent_id`` or ``i`` are no nodes; no rows, no levels.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexis.operators.trees import NONE
from lexis.session import written


@dataclass
class Forest:
    nodes: DataFrame          # sent_id, i, text
    levels: list[DataFrame]   # sent_id, i, up: the ancestor 2^r steps up, where there is one
    endless: DataFrame        # sent_id, i of the nodes that lead into a cycle


def build(tokens: DataFrame) -> Forest:
    """Lifting tables of ``tokens(sent_id, i, text, head)``, each written once."""
    first = F.min(F.struct("head", "text"))
    nodes = written(tokens.where(F.col("sent_id").isNotNull() & F.col("i").isNotNull())
                    .groupBy("sent_id", "i").agg(first.alias("t")).select("sent_id", "i", "t.text", "t.head"), "nodes")
    largest = nodes.groupBy("sent_id").count().agg(F.max("count")).first()[0] or 0
    above = nodes.select("sent_id", F.col("i").alias("head"))
    levels = [written(nodes.select("sent_id", "i", "head").join(above, ["sent_id", "head"], "left_semi")
                      .select("sent_id", "i", F.col("head").alias("up")), "up")]
    while levels[-1].limit(1).count() and 1 << (len(levels) - 1) < largest:
        levels.append(written(_lift(levels[-1], levels[-1], "up").select("sent_id", "i", F.col("_up").alias("up")), "up"))
    return Forest(nodes.select("sent_id", "i", "text"), levels, levels[-1].select("sent_id", "i"))


def _lift(df: DataFrame, level: DataFrame, node: str, how: str = "inner") -> DataFrame:
    """``df`` + ``_up``: what ``level`` has above the node in column ``node``."""
    return df.join(level.select("sent_id", F.col("i").alias(node), F.col("up").alias("_up")), ["sent_id", node], how)


def starts(forest: Forest, roles=("SUBJECT", "OBJECT")) -> DataFrame:
    """``sent_id, role, i, cyclic``: the last token equal to each role."""
    last = (forest.nodes.where(F.col("text").isin(*roles)).groupBy("sent_id", F.col("text").alias("role"))
            .agg(F.max("i").alias("i")))
    return last.join(forest.endless.withColumn("cyclic", F.lit(True)), ["sent_id", "i"], "left") \
        .withColumn("cyclic", F.coalesce("cyclic", F.lit(False)))


def path_steps(forest: Forest, begin: DataFrame) -> DataFrame:
    """``sent_id, role, step, i, text``: the start (step 0) and its ancestors, a row each.

    Steps 0..2^r - 1 joined with level r give steps 2^r..2^(r+1) - 1."""
    out = begin.where(~F.col("cyclic")).select("sent_id", "role", F.lit(0).alias("step"), "i")
    for r, level in enumerate(forest.levels):
        more = _lift(out, level, "i").select("sent_id", "role", (F.col("step") + (1 << r)).alias("step"), F.col("_up").alias("i"))
        out = out.unionByName(more)
        if r % 4 == 3:
            out = written(out, "steps")
    return out.join(forest.nodes, ["sent_id", "i"])


def depths(forest: Forest, begin: DataFrame) -> DataFrame:
    """``begin`` + ``depth``, the steps up to the root; null where they never end."""
    x = begin.withColumns({"_at": F.col("i"), "depth": F.lit(0)})
    for r, level in reversed(list(enumerate(forest.levels))):
        x = _lift(x, level, "_at", "left")
        x = x.select(*begin.columns, F.coalesce("_up", "_at").alias("_at"),
                     (F.col("depth") + F.when(F.col("_up").isNotNull(), 1 << r).otherwise(0)).alias("depth"))
    return x.select(*begin.columns, F.when(~F.col("cyclic"), F.col("depth")).alias("depth"))


def common_ancestor(forest: Forest, begin: DataFrame, a: str = "SUBJECT", b: str = "OBJECT") -> DataFrame:
    """``sent_id, i, lca`` of the trees that have both roles and no cycle above them:
    the deepest common ancestor (null) and its text (``-None-``) if there is none."""
    d = depths(forest, begin).where("depth is not null")
    one, two = ([F.col("i").alias(f"_{s}"), F.col("depth").alias(f"_{s}d")] for s in ("a", "b"))
    x = (d.where(F.col("role") == a).select("sent_id", *one)
         .join(d.where(F.col("role") == b).select("sent_id", *two), "sent_id"))
    low, high = F.col("_ad") >= F.col("_bd"), F.col("_bd") > F.col("_ad")
    # the deeper one first; then only the difference of depths matters
    x = x.select("sent_id", F.when(low, F.col("_a")).otherwise(F.col("_b")).alias("_a"),
                 F.when(high, F.col("_a")).otherwise(F.col("_b")).alias("_b"), F.abs(F.col("_ad") - F.col("_bd")).alias("_d"))
    rounds = list(reversed(list(enumerate(forest.levels))))
    for r, level in rounds:
        x = _lift(x, level, "_a", "left")
        due = F.col("_d") >= (1 << r)
        x = x.select("sent_id", F.when(due, F.col("_up")).otherwise(F.col("_a")).alias("_a"), "_b",
                     F.when(due, F.col("_d") - (1 << r)).otherwise(F.col("_d")).alias("_d"))
    x = written(x.drop("_d"), "level")
    for _, level in rounds:
        # both go up as long as their ancestors differ
        x = _lift(_lift(x, level, "_a", "left").withColumnRenamed("_up", "_ua"), level, "_b", "left")
        move = F.col("_ua") != F.col("_up")
        x = x.select("sent_id", F.when(move, F.col("_ua")).otherwise(F.col("_a")).alias("_a"),
                     F.when(move, F.col("_up")).otherwise(F.col("_b")).alias("_b"))
    x = _lift(_lift(x, forest.levels[0], "_a", "left").withColumnRenamed("_up", "_ua"), forest.levels[0], "_b", "left")
    top = F.when(F.col("_a") == F.col("_b"), F.col("_a")).when(F.col("_ua") == F.col("_up"), F.col("_ua"))
    found = x.select("sent_id", top.alias("i")).join(forest.nodes, ["sent_id", "i"], "left")
    return found.select("sent_id", "i", F.when(F.col("i").isNull(), F.lit(NONE)).otherwise(F.col("text")).alias("lca"))
