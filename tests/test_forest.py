"""Pointer doubling against walks, on trees of all shapes and on cycles."""

import random

from pyspark.sql import functions as F

from lexis.operators import forest


def walk(heads, i):
    path = [i]
    while heads.get(path[-1]) in heads:
        path.append(heads[path[-1]])
        if len(path) > len(heads):
            return None
    return path


def test_equals_walking(spark):
    rng = random.Random(4)
    rows, want_steps, want_lca, cyclic = [], set(), {}, set()
    for s in range(60):
        n = rng.choice([1, 2, 3, 8, 33, 64])
        kind = s % 4   # chains, random trees, forests with roots anywhere, cycles and heads of no token
        heads = {i: {0: i - 1, 1: rng.randrange(i), 2: rng.choice([0, rng.randrange(i)])}.get(kind, rng.randint(0, n + 1))
                 for i in range(1, n + 1)}
        texts = {i: rng.choice(["SUBJECT", "OBJECT", "x", None]) for i in heads}
        rows += [(s, i, texts[i], heads[i] if heads[i] else rng.choice([0, None])) for i in heads]
        paths = {}
        for role in ("SUBJECT", "OBJECT"):
            at = max((i for i in heads if texts[i] == role), default=None)
            if at is None:
                continue
            paths[role] = walk(heads, at)
            if paths[role] is None:
                cyclic.add((s, role))
            else:
                want_steps |= {(s, role, k, i, texts[i]) for k, i in enumerate(paths[role])}
        if len(paths) == 2 and None not in paths.values():
            common = [i for i in paths["SUBJECT"] if i in paths["OBJECT"]]
            want_lca[s] = (common[0], texts[common[0]]) if common else (None, "-None-")
    rng.shuffle(rows)
    df = spark.createDataFrame(rows + rows[:5] + [(None, 1, "x", 0), (3, None, "SUBJECT", 0)], "sent_id long, i int, text string, head int")
    f = forest.build(df.repartition(4))
    begin = forest.starts(f)
    assert {(r["sent_id"], r["role"]) for r in begin.where("cyclic").collect()} == cyclic and cyclic
    steps = [tuple(r) for r in forest.path_steps(f, begin).select("sent_id", "role", "step", "i", "text").collect()]
    assert len(steps) == len(set(steps)) and set(steps) == want_steps
    assert {r["sent_id"]: (r["i"], r["lca"]) for r in forest.common_ancestor(f, begin).collect()} == want_lca


def test_empty_and_one_long_chain(spark):
    empty = forest.build(spark.createDataFrame([], "sent_id long, i int, text string, head int"))
    begin = forest.starts(empty)
    assert forest.path_steps(empty, begin).count() == 0 and forest.common_ancestor(empty, begin).count() == 0
    n = 20000
    text = F.when(F.col("i") == n, "SUBJECT").when(F.col("i") == 12345, "OBJECT").otherwise("x")
    chain = spark.range(1, n + 1).select(F.lit(1).alias("sent_id"), F.col("id").cast("int").alias("i")) \
        .select("sent_id", "i", text.alias("text"), (F.col("i") - 1).alias("head"))
    f = forest.build(chain)
    begin = forest.starts(f)
    assert forest.depths(f, begin).where("role = 'SUBJECT'").first()["depth"] == n - 1
    assert forest.path_steps(f, begin.where("role = 'SUBJECT'")).agg(F.count("*"), F.sum("i")).first() == (n, n * (n + 1) // 2)
    assert forest.common_ancestor(f, begin).first()["i"] == 12345
