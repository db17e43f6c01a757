"""SimHash groups, line runs and benchmark windows against brute force."""

import random
import re

import pytest
import xxhash
from llm_cases import DOCS, empty_docs, expect, odd_docs, odd_texts, pairs, words

from lexis.llm import decontaminate, linededup, simhash
from lexis.llm.components import connected_components


def plain_print(t, k=3):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    sh = [" ".join(w[i:i + k]) for i in range(len(w) - k + 1)] or ([" ".join(w)] if w else [])
    hs = [xxhash.xxh64_intdigest(s.encode(), 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def plain_groups(rows, bits=2):
    prints = [plain_print(t) for _, t in rows]
    up = list(range(len(rows)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i
    for i in range(len(rows)):
        for j in range(i):
            if bin(prints[i] ^ prints[j]).count("1") <= bits:
                up[root(i)] = root(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[root(i)] = min(d, least.get(root(i), d))
    return [(d, f"{p:016x}", least.get(root(i))) for i, ((d, _), p) in enumerate(zip(rows, prints))]


def near_texts(seed=1):
    """Chains of texts that differ in a few words."""
    rng = random.Random(seed)
    out = []
    for _ in range(12):
        w = words(rng, rng.choice([60, 200, 600])).split()
        for _ in range(6):
            out.append(" ".join(w))
            w[rng.randrange(len(w))] = "new" + str(rng.random())[2:6]
    return out


@pytest.mark.parametrize("bits", [1, 2, 3])
def test_simhash_equals_brute_force(spark, bits):
    from pyspark.sql import functions as F
    extra = near_texts()
    rows = list(enumerate([*odd_texts(), *extra]))
    rows += [rows[5], rows[10], (None, "no id")]
    found = simhash.near_duplicates(odd_docs(spark, extra), max_bits=bits)
    found = found.withColumn("h", F.lpad(F.lower(F.hex("fp")), 16, "0"))
    want = plain_groups(rows, bits)
    assert pairs(found, "doc_id", "h", "component_id") == expect(want)
    assert len({c for _, _, c in want}) < len(rows) - 20


def test_simhash_keeps_one_of_each_group(spark):
    extra = near_texts(2)
    rows = list(enumerate([*odd_texts(), *extra]))
    docs = odd_docs(spark, extra)
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    want = {c for _, _, c in plain_groups(rows + [(None, "no id")])} - {None}
    got = [r["doc_id"] for r in kept.collect()]
    assert sorted(x for x in got if x is not None) == sorted(want) and got.count(None) == 1
    assert simhash.keep_one(empty_docs(spark)).count() == 0
    assert simhash.near_duplicates(empty_docs(spark)).count() == 0


def test_simhash_tells_rows_that_share_an_id_apart(spark):
    rng = random.Random(5)
    a, b, c, d = (words(rng, 60) for _ in range(4))
    # 5 is the smallest of group a and not of group b; c is clean; both copies of d share an id
    rows = [(3, b), (5, a), (5, b), (5, c), (6, a), (7, a), (8, d), (8, d.upper()), (8, d), (None, d), (None, a)]
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], DOCS)
    got = [(r["doc_id"], r["text"].lower()) for r in simhash.keep_one(docs).collect()]
    assert expect(got) == expect([(3, b), (5, a), (5, c), (8, d), (None, a), (None, d)])


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(1, x) for x in range(2, 40)] + [(500, 501), (501, 502), (7, 7)]
    got = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = {i: 100 for i in range(100, 161)} | {x: 1 for x in range(1, 40)} | {500: 500, 501: 500, 502: 500}
    assert got == want


def plain_lines(rows, least):
    """Deleted line numbers by comparing all pairs of runs."""
    docs = []
    for _, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        every = (t or "").split("\n")
        docs.append((every, [i for i, x in enumerate(every) if x.encode().split()]))
    where, out = {}, []
    for d, (every, idx) in enumerate(docs):
        for a in range(len(idx)):
            for b in range(a + 1, len(idx) + 1):
                run = tuple(every[i] for i in idx[a:b])
                if sum(len(x.encode().split()) for x in run) >= least:
                    where.setdefault(run, []).append((d, a, b))
    gone = [set() for _ in docs]
    for spots in where.values():
        for d, a, b in sorted(spots)[1:]:
            gone[d].update(docs[d][1][a:b])
    for (i, _), g, (every, _) in zip(sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)), gone, docs):
        out.append((i, ",".join(map(str, sorted(g))), "\n".join(x for k, x in enumerate(every) if k not in g)))
    return out


@pytest.mark.parametrize("seed,least", [(1, 6), (2, 3), (3, 12)])
def test_line_runs_equal_brute_force(spark, seed, least):
    from pyspark.sql import functions as F
    rng = random.Random(seed)
    pool = [words(rng, n) for n in (1, 1, 2, 3, 5, 8)] + ["", "  ", "tab\tline\r"]
    rows = [(i, "\n".join(rng.choice(pool) if rng.random() < 0.8 else words(rng, 4) for _ in range(rng.randint(0, 14))))
            for i in range(40)]
    rows += [(40, None), (41, ""), (3, rows[3][1]), (7, rows[7][1]), (42, rows[9][1])]
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], DOCS).withColumn("k1", F.lit(0)).withColumn("_n", F.lit(0))
    out = linededup.dedup_lines(docs, min_words=least, drop_empty=False)
    got = out.select("doc_id", F.array_join(F.col("deleted_lines").cast("array<string>"), ","), F.coalesce("text", F.lit("")))
    assert sorted(map(tuple, got.collect())) == sorted(plain_lines(rows, least))
    assert out.columns == [*docs.columns, "deleted_lines"]
    kept = {r["doc_id"] for r in linededup.dedup_lines(docs, min_words=least).collect()}
    assert kept == {i for i, g, t in plain_lines(rows, least) if not g or t.split()}


def test_line_dedup_on_odd_documents(spark):
    docs = odd_docs(spark)
    rows = list(enumerate(odd_texts()))
    out = linededup.dedup_lines(docs, min_words=50)
    long = [r for r in out.collect() if r["doc_id"] in (10, 11)]
    assert [(r["doc_id"], r["text"] == rows[10][1]) for r in long] == [(10, True)]   # copies by id and by row are gone
    assert out.count() == docs.count() - 2
    assert linededup.dedup_lines(empty_docs(spark)).count() == 0


def word_list(t):
    t = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", t)


def plain_hits(rows, items, window):
    out = []
    tests = {}
    for item, t in items:
        w = word_list(t)
        if item is not None:
            for i in range(max(1, len(w) - window + 1) if w else 0):
                tests.setdefault(tuple(w[i:i + window]), set()).add(item)
    for d, t in rows:
        w = word_list(t)
        hit, got = set(), set()
        for n in {len(k) for k in tests}:
            for i in range(len(w) - n + 1):
                if (ids := tests.get(tuple(w[i:i + n]))):
                    hit.update(range(i, i + n))
                    got |= ids
        out.append((d, len(w), len(hit), ",".join(sorted(map(str, got)))))
    return out


@pytest.mark.parametrize("block", [16_000_000, 300])
def test_decontamination_equals_brute_force(spark, monkeypatch, block):
    from pyspark.sql import functions as F
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", block)
    monkeypatch.setattr(decontaminate, "SHARD_BYTES", 5000)
    rng = random.Random(4)
    items = [(i, words(rng, rng.choice([1, 2, 4, 5, 9]), "abc")) for i in range(30)] + [(3, "Q r, s-t"), (90, None), (91, ""), (None, "aa")]
    extra = [words(rng, 40, "abc") for _ in range(30)] + [f"x {t} y" for _, t in items if t] + ["q R s t"]
    rows = list(enumerate([*odd_texts(), *extra]))
    rows += [rows[5], rows[10], (None, "no id")]
    index = decontaminate.build_index(odd_docs(spark, extra), window=4)
    bench = spark.createDataFrame(items + items[:3], "item_id long, text string").withColumn("doc_id", F.lit(1))
    found = decontaminate.find(index, bench, window=4)
    got = found.select("doc_id", "n_words", "n_hit", F.array_join("items", ","))
    assert expect(map(tuple, got.collect())) == expect(plain_hits(rows, items, 4))
    nobody = decontaminate.find(index, bench.limit(0), window=4)
    assert nobody.where("n_hit > 0").count() == 0 and nobody.count() == len(rows)
    assert decontaminate.find(decontaminate.build_index(empty_docs(spark)), bench).count() == 0


def test_proximity(spark):
    docs = spark.createDataFrame([(1, "one two filler three four five"), (2, "one two " + "z " * 100 + "three four five")],
                                 "doc_id long, text string")
    bench = spark.createDataFrame([(9, "five four three two one")], "item_id long, text string")
    got = {r["doc_id"]: (r["n_hit"], r["near_items"])
           for r in decontaminate.find(decontaminate.build_index(docs, window=5), bench, window=5, slop=20).collect()}
    assert got == {1: (0, ["9"]), 2: (0, [])}
