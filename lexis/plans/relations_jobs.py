"""Entity / relation queries over fixtures F3, F3t and F4 (customer x nation
x region sentences)."""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import functions as F

from lexis.operators import forest, phrases, trees
from lexis.operators import mentions as mn
from lexis.sources import fixtures as fx
from lexis.sources.tables import spread, table


@lru_cache(maxsize=8)
def relations(spark, sf_dir):
    # one file of customers is one task's scan; the regular expressions on its sentences are not
    return fx.relations(spread(table(spark, sf_dir, "customer")), table(spark, sf_dir, "nation"),
                        table(spark, sf_dir, "region")).cache()


def relation_tokens(spark, sf_dir):
    return fx.relation_tokens(relations(spark, sf_dir))


def parsed_tokens(spark, sf_dir):
    return fx.parsed_tokens(relations(spark, sf_dir))


def mention_extract(spark, sf_dir):
    return mn.mentions(relations(spark, sf_dir))


def mention_clean(spark, sf_dir):
    return relations(spark, sf_dir).select("sent_id", mn.clean_sentence(F.col("sentence")).alias("text"))


def mention_span_match(spark, sf_dir):
    m = mn.span_matches(relations(spark, sf_dir), relation_tokens(spark, sf_dir))
    return m.select("sent_id", "phrase", F.col("start").cast("int").alias("start"),
                    F.array_join("tags", " ").alias("tags"))


def phrase_matches(spark, sf_dir):
    """Every mention phrase of the table against every sentence."""
    found = phrases.find_phrases(mn.mentions(relations(spark, sf_dir)), relation_tokens(spark, sf_dir))
    return found.select("sent_id", "phrase", F.col("start").cast("int").alias("start"))


def noun_mismatch(spark, sf_dir):
    m = mn.noun_mismatch(relations(spark, sf_dir), relation_tokens(spark, sf_dir))
    return m.select("sent_id", "phrase", F.array_join("tags", " ").alias("tags"))


def entity_roles(spark, sf_dir):
    return mn.entity_roles(relations(spark, sf_dir))


def role_rewrite(spark, sf_dir):
    return mn.role_rewrite(relations(spark, sf_dir))


def relation_validity(spark, sf_dir):
    rel = relations(spark, sf_dir)
    cons = mn.mention_consistency(rel, relation_tokens(spark, sf_dir))
    ent = rel.select("sent_id", mn.entity_validity(rel).alias("entities_ok"))
    pr = trees.path_report(parsed_tokens(spark, sf_dir)).select("sent_id", F.col("valid").alias("paths_ok"))
    return (cons.join(ent, "sent_id").join(pr, "sent_id", "left")
            .select("sent_id", F.col("n_mentions").cast("int").alias("n_mentions"),
                    F.col("n_matched").cast("int").alias("n_matched"),
                    (F.col("n_mentions") == F.col("n_matched")).alias("mentions_ok"), "entities_ok",
                    F.coalesce("paths_ok", F.lit(False)).alias("paths_ok")))


def path_to_root(spark, sf_dir):
    r = trees.path_report(parsed_tokens(spark, sf_dir))
    return r.select("sent_id", "subject_path", "object_path")


def lca(spark, sf_dir):
    r = trees.path_report(parsed_tokens(spark, sf_dir))
    return r.where("valid").select("sent_id", "lca")


def ancestor_steps(spark, sf_dir):
    """Paths to the root as rows, by pointer doubling."""
    f = forest.build(parsed_tokens(spark, sf_dir))
    return forest.path_steps(f, forest.starts(f)).select("sent_id", "role", "step", "i", "text")


def lca_lifted(spark, sf_dir):
    """The lowest common ancestor by lifting tables."""
    f = forest.build(parsed_tokens(spark, sf_dir))
    return forest.common_ancestor(f, forest.starts(f)).select("sent_id", "lca")


def relation_report(spark, sf_dir):
    """C23 / K6 in table form: rewritten sentence, role lines, paths, LCA."""
    rel = relations(spark, sf_dir)
    roles = mn.entity_roles(rel)
    lines = (roles.groupBy("sent_id")
             .agg(F.array_sort(F.collect_list(F.struct("ord", F.concat(
                 F.col("role"), F.lit(":\t[[ "), F.col("name"), F.lit(" | "), F.col("mid"), F.lit(" ]]")).alias("l"))))
                  .alias("ls"))
             .select("sent_id", F.array_join(F.col("ls.l"), "\n").alias("entities")))
    pr = trees.path_report(parsed_tokens(spark, sf_dir)).where("valid")
    return (mn.role_rewrite(rel).join(lines, "sent_id").join(pr, "sent_id")
            .select("sent_id", "text", "entities", "subject_path", "object_path", "lca"))


QUERIES = {
    "mention_extract": mention_extract,
    "mention_clean": mention_clean,
    "mention_span_match": mention_span_match,
    "phrase_matches": phrase_matches,
    "noun_mismatch": noun_mismatch,
    "entity_roles": entity_roles,
    "role_rewrite": role_rewrite,
    "relation_validity": relation_validity,
    "path_to_root": path_to_root,
    "lca": lca,
    "ancestor_steps": ancestor_steps,
    "lca_lifted": lca_lifted,
    "relation_report": relation_report,
}
