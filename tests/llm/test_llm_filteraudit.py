"""The filter audit against a plain version: orders, masks, copies, tries."""

import random
import re
from itertools import permutations

from llm_cases import empty_docs, odd_docs, odd_texts, pairs, words
from pyspark.sql import functions as F

from lexis.llm import filteraudit, queries
from lexis.llm.sql import SQL

COUNTS = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def plain_masks(rows):
    """(id, part, mask) of (id, text, part)."""
    least = {}
    for d, t, _ in rows:
        if d is not None:
            least[t or ""] = min(d, least.get(t or "", d))
    out = []
    for d, t, part in rows:
        t = t or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = [len(w) < 100, 100 * len(set(w)) < 80 * len(w), 100 * len(re.findall("[A-Z]", t)) > 10 * len(t),
                 re.search("[#$%&*|]", t) is not None, d is not None and d > least[t]]
        out.append((d, part or "", sum(1 << k for k, f in enumerate(fails) if f)))
    return out


def plain_audit(masks, labels):
    good = {d for d, q, _ in labels if q == 1 and d is not None}
    bad = {d for d, _, t in labels if t == 1 and d is not None}
    out = {}
    for part in {p for _, p, _ in masks}:
        mine = [(d, m) for d, p, m in masks if p == part]
        total = {}
        for order in permutations("ABCDE"):
            left = mine
            for step, f in enumerate(order, 1):
                bit = 1 << "ABCDE".index(f)
                lost = [(d, m) for d, m in left if m & bit]
                left = [(d, m) for d, m in left if not m & bit]
                all_fail = sum(1 for _, m in mine if m & bit)
                total[f] = total.get(f, 0) + len(lost)
                out[part, "".join(order), step] = [len(left), len(lost), all_fail - len(lost),
                                                   sum(m == bit for _, m in mine), sum(d in good for d, _ in lost),
                                                   sum(d in bad for d, _ in lost)]
        for (p, order, step), row in out.items():
            if p == part:
                row.append(total[order[step - 1]])
    return sorted((*k, *v) for k, v in out.items())


def copies(seed=5):
    """Texts with shared prefixes, copies of copies, prefixes of others, and all filters."""
    rng = random.Random(seed)
    base = [words(rng, rng.choice([3, 99, 100, 150]), rng.choice(["ab", "abcdefghij", "ABc", "x#$é"])) for _ in range(40)]
    out = [rng.choice(base)[:rng.choice([5, 400, 10_000])] + rng.choice(["", "", " z", "é"]) for _ in range(160)]
    head = words(rng, 600)   # longer than the characters that choose a range
    return out + [head + str(rng.randint(0, 5)) for _ in range(40)] + ["hot copy"] * 60


def table(spark, extra):
    texts = [*odd_texts(), *extra]
    langs = [None, "", "en", "de", "en"]
    rows = [(i, t, langs[i % 5]) for i, t in enumerate(texts)]
    rows += [rows[5], rows[10], (None, "no id", "en"), (None, "hot copy", "en")]
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(5)
    return rows, df.withColumn("mask", F.lit(1)).withColumn("part", F.lit("x")).withColumn("range", F.lit(1))


LABELS = [(i, i % 3 % 2, i % 2) for i in range(0, 200, 2)] + [(3, None, 1), (3, 1, None), (None, 1, 1), (10**6, 1, 1)]


def test_masks_and_audit_equal_plain_version(spark):
    rows, df = table(spark, copies())
    found = filteraudit.flags(df)
    masks = plain_masks(rows)
    assert pairs(found, "doc_id", "part", "mask") == sorted(masks, key=lambda t: tuple((x is not None, x) for x in t))
    labels = spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int")
    got = filteraudit.audit(found, labels)
    assert got.columns == ["part", "filter_order", "step", *COUNTS]
    assert sorted(map(tuple, got.collect())) == plain_audit(masks, LABELS)


def test_small_tries_and_short_keys(spark, monkeypatch):
    monkeypatch.setattr(filteraudit, "TRIE_CHARS", 300)
    monkeypatch.setattr(filteraudit, "KEY_CHARS", 4)
    rows, df = table(spark, copies(6))
    want = sorted(plain_masks(rows), key=lambda t: tuple((x is not None, x) for x in t))
    assert pairs(filteraudit.flags(df), "doc_id", "part", "mask") == want


def test_trie_holds_smallest_ids():
    rng = random.Random(2)
    for _ in range(50):
        trie, seen, back = filteraudit.Trie(), {}, []
        for i in range(200):
            t, k = "".join(rng.choice("ab") for _ in range(rng.randint(0, 8))), rng.randint(0, 30)
            seen.setdefault(t, []).append((k, i))
            back += trie.insert(t, k, (k, i)) or []
        first = {t: [r for r in rows if r[0] == min(rows)[0]] for t, rows in seen.items()}
        assert dict(trie.texts()) == first
        assert sorted(back) == sorted(r for t, rows in seen.items() for r in rows if r not in first[t])


def test_ranges_keep_equal_texts_together_and_split_long_prefixes(spark, monkeypatch):
    monkeypatch.setattr(filteraudit, "KEY_CHARS", 8)
    texts = ["samestart" + str(i) for i in range(500)] + ["other" + str(i) for i in range(100)]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    bounds = filteraudit._bounds(df, 12)
    assert bounds == sorted(bounds) and len(bounds) < 12
    spread = {}
    for t in texts:
        spread.setdefault(filteraudit._range_of(t, bounds), []).append(t)
    assert max(map(len, spread.values())) < 200


def test_empty_tables(spark):
    assert filteraudit.flags(empty_docs(spark)).collect() == []
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filteraudit.audit(filteraudit.flags(empty_docs(spark)), none).collect() == []
    got = filteraudit.audit(filteraudit.flags(odd_docs(spark)), none)
    assert got.count() == 600 and got.agg(F.sum("good_lost")).first()[0] == 0


def test_query_equals_sql(spark, tmp_path):
    import duckdb
    _, df = table(spark, copies(8))
    df.select("doc_id", "text", "lang").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    con = duckdb.connect()
    for t in ("documents", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{tmp_path}/{t}.parquet/*.parquet')")
    res = con.execute(SQL["op13_filter_audit"])
    names = [d[0] for d in res.description]
    got = queries.op13_filter_audit(spark, str(tmp_path)).select(*names)
    assert sorted(map(tuple, got.collect())) == sorted(res.fetchall())
