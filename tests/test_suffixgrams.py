"""N-grams of all orders against plain counting."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from lexis.functions.text import char_text, char_units, word_units
from lexis.operators import suffixgrams


def plain(rows, split, n, sep):
    out = Counter()
    for key, text in rows:
        u = split(text or "")
        out.update((key, k, sep.join(u[i:i + k])) for k in range(1, n + 1) for i in range(len(u) - k + 1))
    return dict(out)


def rows(seed):
    rng = random.Random(seed)
    text = lambda: "".join(rng.choice("ab \n\x01é😀-") for _ in range(rng.randint(0, 60)))
    out = [(rng.choice(["x", "y", None]), text()) for _ in range(120)]
    return [*out, ("x", None), ("x", ""), ("hot", "aaaa " * 300), ("hot", "aaaa " * 300), ("z", "a"), ("z", "a\x01 a b")]


@pytest.mark.parametrize("unit", ["char", "word"])
@pytest.mark.parametrize("held, parts", [(500_000, 3), (50, 40)])
def test_counts_equal_plain_version(spark, monkeypatch, unit, held, parts):
    monkeypatch.setattr(suffixgrams, "HELD_ROWS", held)
    data = rows(held)
    df = spark.createDataFrame(data, "k string, text string")
    units, sep, split = ((char_units, "", lambda t: list(t.replace("\n", ""))) if unit == "char"
                         else (word_units, " ", str.split))
    before = {c: spark.conf.get(c) for c in ("spark.sql.shuffle.partitions", "spark.sql.execution.arrow.maxRecordsPerBatch")}
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", held)
    try:
        found = suffixgrams.ngram_counts(df, ["k"], units(F.col("text")), 4, sep)
        assert found.columns == ["k", "n", "gram", "cnt"]
        got = [tuple(r) for r in found.collect()]
    finally:
        for c, v in before.items():
            spark.conf.set(c, v)
    want = plain(data, split, 4, sep)
    assert len(got) == len(want) and {g[:3]: g[3] for g in got} == want


def test_cutoff_and_empty_table(spark):
    df = spark.createDataFrame([("k", "a b a b c")], "k string, text string")
    got = suffixgrams.ngram_counts(df, ["k"], word_units(F.col("text")), 3, " ", min_count=2)
    assert sorted((r["n"], r["gram"], r["cnt"]) for r in got.collect()) == [(1, "a", 2), (1, "b", 2), (2, "a b", 2)]
    assert suffixgrams.ngram_counts(df.limit(0), ["k"], word_units(F.col("text")), 3, " ").collect() == []


@pytest.mark.parametrize("held", [1_000_000, 50])
def test_texts_are_their_characters(spark, monkeypatch, held):
    monkeypatch.setattr(suffixgrams, "HELD_ROWS", held)
    many = "".join(chr(0x4E00 + i) for i in range(1200))       # more characters than a code has room for
    data = [*rows(7), ("x", many), ("y", many[::-1] + "ab")]
    df = spark.createDataFrame(data, "k string, text string").coalesce(2)
    got = suffixgrams.ngram_counts(df, ["k"], char_text(F.col("text")), 4).collect()
    want = plain(data, lambda t: list(t.replace("\n", "")), 4, "")
    assert len(got) == len(want) and {tuple(r)[:3]: r["cnt"] for r in got} == want


def test_words_with_any_character(spark):
    words = ["a", "a\x00", "a\x01", "\x00\x01", "\x01\x02", "b"]
    rng = random.Random(1)
    data = [("k", [rng.choice(words) for _ in range(40)]) for _ in range(20)]
    df = spark.createDataFrame(data, "k string, u array<string>")
    got = suffixgrams.ngram_counts(df, ["k"], F.col("u"), 3, " ").collect()
    want = Counter(("k", n, " ".join(u[i:i + n])) for _, u in data for n in (1, 2, 3) for i in range(len(u) - n + 1))
    assert len(got) == len(want) and {tuple(r)[:3]: r["cnt"] for r in got} == want


def test_a_task_counts_equal_windows_as_one_row(spark):
    """One row of a window for all batches of a task, not one for each batch or place."""
    df = spark.createDataFrame([("k", "abcab" * 400)] * 50, "k0 string, u string").coalesce(1).withColumn("n", F.length("u"))
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 5)
    try:
        got = {r["suffix"]: r["cnt"] for r in suffixgrams._counted(df, ["k0"], 3, "").collect()}
        assert suffixgrams._counted(df, ["k0"], 3, "").count() == len(got) == 7
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert sum(got.values()) == 50 * 2000 and got["ab"] == got["b"] == 50


def test_numbers_are_made_of_a_part_of_a_batch(monkeypatch):
    import pyarrow as pa
    monkeypatch.setattr(suffixgrams, "HELD_ROWS", 100)
    texts = ["ab\u4e00é" * 10] * 9 + ["x" * 1000, "y"]
    batch = pa.RecordBatch.from_arrays([pa.array(texts), pa.array([len(t) for t in texts], pa.int32())], ["u", "n"])
    parts = suffixgrams._parts(batch)
    assert max(p.num_rows for p in parts) == 3 and sum(p.num_rows for p in parts) == 11
    assert "".join(chr(c) for p in parts for c in suffixgrams._code_points(p.column("u"))) == "".join(texts)
