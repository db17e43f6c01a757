"""The pipeline against plain versions of its stages, on planted rows."""

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from llm_cases import DOCS, words
from test_llm_dedup import plain_groups, plain_hits, plain_lines
from tokenizers import Tokenizer

import corpus_pipeline
from lexis.llm import toxicity

BAD = ["vilescum", "dreckling", "rotbrain"]


def planted(seed=3):
    """(documents, labels, benchmark): toxic rows, copies, near copies, shared passages, benchmark text, odd rows."""
    rng = random.Random(seed)
    vocab = ["".join(rng.choice("abcdefghijklm") for _ in range(rng.randint(2, 8))) for _ in range(400)]
    text = lambda n: " ".join(rng.choice(vocab) for _ in range(n))
    lines = lambda k: "\n".join(text(12) for _ in range(k))
    rows, labels = [], []
    for i in range(160):
        toxic = i % 4 == 0
        w = lines(rng.randint(2, 6)).split(" ")
        if toxic:
            for b in BAD:
                w.insert(rng.randrange(len(w)), b)
        rows.append((i, " ".join(w)))
        labels.append((i, 1, int(toxic)))
    passage, item = lines(5), text(14)
    rows += [(200, lines(2) + "\n" + passage), (201, passage + "\n" + lines(2)), (202, passage)]
    rows += [(300, rows[1][1]), (301, rows[1][1]), (302, "Lead " + rows[2][1])]
    rows += [(400, text(30) + " " + item.upper() + " " + text(30)), (401, item)]
    rows += [(500, None), (501, ""), (502, "  \n"), (None, text(40)), (503, text(3)), rows[5], rows[6]]
    return rows, labels, [("b1", item), ("b2", None), (None, text(20)), ("b3", "")]


def count(rows):
    return Counter((i, t) for i, t in rows)


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    at = str(tmp_path_factory.mktemp("pipeline"))
    rows, labels, items = planted()
    docs = spark.createDataFrame([(i, t, "en", "s", None if t is None else len(t)) for i, t in rows], DOCS)
    docs.repartition(3).write.parquet(f"{at}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{at}/labels.parquet")
    spark.createDataFrame(items, "item_id string, text string").write.parquet(f"{at}/benchmark.parquet")
    return at, rows, items


def test_run_equals_plain_stages(spark, tables):
    at, rows, items = tables
    docs = spark.read.parquet(f"{at}/documents.parquet")
    model = toxicity.fit(docs, spark.read.parquet(f"{at}/labels.parquet").where("crc32(cast(doc_id as string)) % 5 != 0"))
    judge = toxicity._judge(model)
    left = [(i, t) for i, t in rows if judge(t or "")[0] < 0.5]
    toxic = {i for i, _ in rows} - {i for i, _ in left}
    assert {i for i in range(160) if i % 4 == 0} - toxic == set() and len(toxic) < 50
    # later copies of runs go; documents without words left go, those that had none stay
    before = dict(enumerate(sorted(left, key=lambda r: (r[0] is not None, r[0] or 0))))
    left = [(i, t if g else before[k][1]) for k, (i, g, t) in enumerate(plain_lines(left, 50)) if not g or t.split()]
    assert {200, 201}.issubset({i for i, _ in left}) and 202 not in {i for i, _ in left}
    # one row of each component; rows with null ids stay
    kept, seen = [], set()
    for (i, t), (_, _, c) in zip(left, plain_groups(left)):
        if i is None or i == c and (i, t) not in seen:
            kept.append((i, t))
            seen.add((i, t))
    assert {300, 301} & {i for i, _ in kept} == set()
    clean = [(r[0], r[1]) for r, hit in zip(kept, plain_hits(kept, items, 10)) if not hit[2]]
    assert {400, 401} & {i for i, _ in clean} == set() and len(clean) > 90
    lib = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = Counter()
    for i, t in clean:
        ids = lib.encode(t or "", add_special_tokens=False).ids
        want[i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
             hashlib.sha256(lib.decode(ids, skip_special_tokens=False).encode()).hexdigest()] += 1
    got = corpus_pipeline.run(spark, at)
    assert got.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert Counter(map(tuple, got.collect())) == want


def test_stages_keep_columns_and_stand_odd_tables(spark, tables):
    from pyspark.sql import functions as F
    at, *_ = tables
    docs = spark.read.parquet(f"{at}/documents.parquet")
    wide = docs.where("doc_id >= 200 or doc_id is null").withColumn("_key", F.lit(1)).withColumn("k1", F.lit(2))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs.limit(0), at).collect() == [], name
        out = stage(spark, wide, at)
        assert out.columns == wide.columns, name
        assert not count((r["doc_id"], r["_key"]) for r in out.collect()) - count((r["doc_id"], r["_key"]) for r in wide.collect())
    assert corpus_pipeline.STAGES[-1][1](spark, docs.limit(0), at).collect() == []
    cut = corpus_pipeline.line_dedup(spark, docs, at).where("doc_id = 201").first()
    assert cut["n_chars"] == len(cut["text"]) < docs.where("doc_id = 201").first()["n_chars"]
