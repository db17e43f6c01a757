"""Inputs that every text operator must stand, and small helpers."""

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def words(rng, n, alphabet="abcdefgh"):
    return " ".join("".join(rng.choice(alphabet) for _ in range(rng.randint(1, 7))) for _ in range(n))


def odd_texts():
    rng = random.Random(7)
    long = "\n".join(words(rng, 40) for _ in range(400))
    return [None, "", " ", "\n\n", "a", "a b", "É É É", "x\x00y", "日本語 テキスト 😀 ok", "A" * 3000, long, long,
            words(rng, 80), words(rng, 80).upper(), "same text here", "same text here", "İ ſ K ß"]


def odd_docs(spark, extra=()):
    """Odd texts, repeated rows, a null id, and extra columns named like outputs."""
    texts = [*odd_texts(), *extra]
    rows = [(i, t, "en", "s", len(t or "")) for i, t in enumerate(texts)]
    rows += [rows[5], rows[10], (None, "no id", "en", "s", 5)]
    df = spark.createDataFrame(rows, DOCS)
    from pyspark.sql import functions as F
    return df.withColumn("spans", F.lit("x")).withColumn("fp", F.lit(1)).withColumn("row", F.lit(2)).withColumn(
        "k1", F.lit(3)).withColumn("_n", F.lit(4)).withColumn("ids", F.lit(5))


def empty_docs(spark):
    return spark.createDataFrame([], DOCS)


def pairs(df, *cols):
    """Sorted rows as tuples, nulls first."""
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=lambda t: tuple((x is not None, x) for x in t))


def expect(rows):
    return sorted(rows, key=lambda t: tuple((x is not None, x) for x in t))
