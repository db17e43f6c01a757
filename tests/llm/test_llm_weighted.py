"""Consistent weighted sampling: samples by the definition, likeness against generalised
Jaccard similarity, edited texts over range borders."""

import hashlib
import math
import random
from collections import Counter

import numpy as np
import pytest
import xxhash
from llm_cases import empty_docs, odd_docs, odd_texts, words
from pyspark.sql import functions as F

from lexis.llm import queries, weighted


def plain_winners(text):
    """(word, t) of every place, by the definition."""
    counts = Counter(text.encode().lower().split())
    best = []
    for k in range(weighted.SAMPLES):
        found = []
        for w, n in counts.items():
            r, b, c = (float(x[0][k]) for x in weighted._draw(np.array([xxhash.xxh64_intdigest(w, weighted.SEED)], np.uint64)))
            t = math.floor(math.log(n) / r + b)
            found.append((c - r * (t - b) - r, w, t))
        best.append(min(found)[1:])
    return best


def test_samples_follow_the_definition():
    rng = random.Random(4)
    texts = [words(rng, 40, "abc") for _ in range(30)]
    sampler, winners = weighted.Sampler(), [plain_winners(t) for t in texts]
    prints = [sampler.sample(t) for t in texts]
    for i, x in enumerate(prints):
        for j in range(i):
            same = [a == b for a, b in zip(winners[i], winners[j])]
            assert (x == prints[j]).tolist() == same


def test_likeness_is_generalised_jaccard():
    rng = random.Random(3)
    gaps, sampler = [], weighted.Sampler()
    for trial in range(150):
        vocab = [f"w{trial}_{i}" for i in range(60)]
        a = [rng.choice(vocab) for _ in range(150)]
        b = a[:rng.randint(0, 150)] + [rng.choice(vocab) for _ in range(80)]
        x, y = Counter(a), Counter(b)
        true = sum((x & y).values()) / sum((x | y).values())
        gaps.append(weighted._like(sampler.sample(" ".join(a)), sampler.sample(" ".join(b))) - true)
    assert abs(np.mean(gaps)) < 0.02 and np.std(gaps) < 0.08


def test_small_slices_and_tables_give_the_same(monkeypatch):
    rng = random.Random(9)
    texts = [words(rng, rng.choice([0, 1, 50, 3000]), "abcdefghij") for _ in range(30)]
    want = [weighted._text(weighted.Sampler().sample(t)) for t in texts]
    monkeypatch.setattr(weighted, "SLICE", 7)
    monkeypatch.setattr(weighted, "ONCE", 20)
    monkeypatch.setattr(weighted, "OFTEN", 8)
    small = weighted.Sampler()
    assert [weighted._text(small.sample(t)) for t in texts] == want


def plain_edited(rows):
    """{(id, n, sha of the edited text, print, edited print, likeness, likeness of the next)} of (id, text)."""
    sampler = weighted.Sampler()
    out = []
    for (i, text), (_, following) in zip(rows, rows[1:] + rows[:1]):
        half = len(text) // 2
        new = text[:len(text) - half] + following[:half]
        x, y, z = (weighted._text(sampler.sample(t)) for t in (text, new, following))
        like = lambda a, b: (1.0 if a == b else 0.0) if not a or not b else sum(
            a[k:k + 4] == b[k:k + 4] for k in range(0, len(a), 4)) / weighted.SAMPLES
        out.append((i, len(text), hashlib.sha256(new.encode()).hexdigest(), x, y, like(x, y), like(x, z)))
    return out


COLUMNS = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]


@pytest.mark.parametrize("parts", [1, 7, 200])
def test_query_equals_plain_version(spark, tmp_path, parts):
    rng = random.Random(parts)
    rows = [(7 * i - 20, t) for i, t in enumerate([*odd_texts(), *[words(rng, rng.randint(0, 80)) for _ in range(60)]])]
    mixed = rng.sample(rows, len(rows))
    spark.createDataFrame(mixed, "doc_id long, text string").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        got = queries.op11_weighted_fingerprints(spark, str(tmp_path))
        assert got.columns == COLUMNS
        assert sorted(map(tuple, got.collect())) == plain_edited([(i, t or "") for i, t in rows])
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_repeated_rows_null_ids_and_clashing_columns(spark):
    df = odd_docs(spark).withColumn("tie", F.lit(1)).withColumn("range", F.lit(1)).withColumn("first", F.lit(1))
    got = weighted.edited(df)
    assert got.columns == ["doc_id", "n_chars", "edited", *COLUMNS[3:]]
    rows = got.collect()
    assert len(rows) == df.count()
    prints = {}
    for r in rows:   # equal texts have equal fingerprints
        prints.setdefault(r["doc_id"], set()).add(r["fingerprint"])
    assert prints[10] == prints[11] and prints[14] == prints[15] and all(len(v) == 1 for v in prints.values())
    single = {(r["doc_id"], r["fingerprint"]) for r in weighted.fingerprints(df).collect()}
    assert single == {(r["doc_id"], r["fingerprint"]) for r in rows}


def test_one_row_and_none(spark):
    one = spark.createDataFrame([(3, "ab cd e")], "doc_id long, text string")
    r = weighted.edited(one).first()
    assert r["edited"] == "ab cab " and r["near_next"] == 1.0
    assert weighted.edited(empty_docs(spark)).collect() == []
