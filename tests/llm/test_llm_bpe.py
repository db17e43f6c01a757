"""BPE ids, token files and their round trips against the tokenizers library."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from llm_cases import empty_docs, expect, odd_docs, odd_texts, pairs
from tokenizers import Tokenizer

from lexis.llm import bpe, bytelevel, queries, tokenfiles

WORD, BYTE = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")
ODD = ["don't 's 're 'tre 'll''s !!'s '' '", "1 22 333a4", "Σίσυφος ΣΑΣ", "<|endoftext|>x<|startoftext|> <|endoftext|",
       "éa", "x\x85y\x1cz\xa0", "aaaa aaa aa a" * 30, "ȺȾ ǅ ß ﬁ", " \n the\n\n\tend \n", "a  b   'll  's\n's"]


def texts(seed, n=1500):
    rng = random.Random(seed)
    near = "aabbeet'ns ll rev\n.,!1 2éÉ Xx\t"
    out = ["".join(rng.choice(near) for _ in range(rng.randint(0, 60))) for _ in range(n)]
    out += ["".join(chr(rng.randint(0, 0x2FF)) for _ in range(40)) for _ in range(n // 3)]
    return out + ["".join(chr(rng.choice([rng.randint(0, 0xD7FF), rng.randint(0xE000, 0x10FFFF)])) for _ in range(30))
                  for _ in range(n // 6)]


@pytest.fixture(scope="module")
def words_bpe():
    return bpe.Bpe(open(WORD, encoding="utf-8").read())


def test_word_bpe_equals_library(words_bpe):
    lib = Tokenizer.from_file(WORD)
    every = ODD + texts(1) + [chr(i) + "a" + chr(i) for i in range(0x300)]
    for t, ids, e in zip(every, words_bpe.encode(every), lib.encode_batch(every, add_special_tokens=False)):
        assert ids.tolist() == e.ids, t
        assert words_bpe.decode(ids) == lib.decode(e.ids, skip_special_tokens=False)


def test_speculation_is_mended(words_bpe):
    """Some greedy proposals are wrong, the checks find all of them."""
    rng = random.Random(3)
    words = list({"".join(rng.choice("aeinorstlh") for _ in range(rng.randint(1, 14))).encode() for _ in range(20_000)})
    exact = [words_bpe.merge(w) for w in words]
    assert words_bpe.encode_words(words) == exact
    assert any(words_bpe.propose(w) != e for w, e in zip(words, exact))


def test_both_ways_of_merging_agree(words_bpe, monkeypatch):
    rng = random.Random(9)
    words = ["".join(rng.choice("aab'e") for _ in range(rng.randint(1, 40))).encode() for _ in range(3000)]
    short = [words_bpe.merge(w) for w in words]
    monkeypatch.setattr(bpe, "SHORT", 0)
    assert [words_bpe.merge(w) for w in words] == short


def test_byte_bpe_equals_library():
    coder = bytelevel.ByteLevel(open(BYTE, encoding="utf-8").read())
    lib = Tokenizer.from_file(BYTE)
    every = ODD + texts(2) + [f"a{chr(i)} {chr(i)}{chr(i)}b" for i in range(0x300)]
    for t, e in zip(every, lib.encode_batch(every, add_special_tokens=False)):
        assert coder.array(t).tolist() == coder.ids(t) == e.ids, repr(t)


def test_long_text_is_cut_safely(words_bpe):
    rng = random.Random(5)
    t = " ".join("".join(rng.choice("abcde'!1\n") for _ in range(rng.randint(1, 9))) for _ in range(300_000))
    assert len(t) > 1_100_000
    want = Tokenizer.from_file(WORD).encode(t, add_special_tokens=False).ids
    assert words_bpe.encode(["x", t, "y"])[1].tolist() == want
    want = Tokenizer.from_file(BYTE).encode(t, add_special_tokens=False).ids
    assert bytelevel.ByteLevel(open(BYTE, encoding="utf-8").read()).array(t).tolist() == want


def rows_of_odd(extra):
    want = list(enumerate([*odd_texts(), *extra]))
    return want + [want[5], want[10], (None, "no id")]


def test_round_trip_operator(spark):
    out = bpe.round_trip(odd_docs(spark, ODD), WORD)
    lib = Tokenizer.from_file(WORD)
    want = []
    for i, t in rows_of_odd(ODD):
        ids = lib.encode(t or "", add_special_tokens=False).ids
        want.append((i, len(ids), bytes(np.array(ids, "<u4").tobytes()), lib.decode(ids, skip_special_tokens=False)))
    got = [(a, b, bytes(c), d) for a, b, c, d in pairs(out, "doc_id", "n_tokens", "ids", "decoded")]
    assert got == expect(want)
    again = bpe.decode(out, WORD)
    assert all(r["text"] == r["decoded"] for r in again.collect())
    assert pairs(bpe.round_trip(empty_docs(spark), WORD), "doc_id") == []


def test_token_files(spark, tmp_path):
    path = str(tmp_path / "tokens")
    tokenfiles.write_tokens(odd_docs(spark, ODD), BYTE, path, end_id=2)
    lib = Tokenizer.from_file(BYTE)
    want, start = [], 0
    rows = [(i, [*lib.encode(t or "", add_special_tokens=False).ids, 2]) for i, t in rows_of_odd(ODD)]
    for i, ids in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        want.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert pairs(tokenfiles.documents_of(spark, path), "doc_id", "start", "n_tokens", "ids_crc32") == expect(want)
    back = {r["doc_id"]: r["ids"] for r in tokenfiles.read_tokens(spark, path).collect()}
    assert all(back[i] == ids for i, ids in rows)
    one = tokenfiles.read_tokens(spark, path).where("doc_id = 12")
    assert "PushedFilters: [IsNotNull(doc_id), EqualTo(doc_id,12)]" in one._jdf.queryExecution().toString() and one.count() == 1
    tokenfiles.write_tokens(empty_docs(spark), BYTE, path + "-empty")
    assert pairs(tokenfiles.documents_of(spark, path + "-empty"), "doc_id") == []


def test_rows_of_one_id_start_where_the_files_have_them(spark, tmp_path):
    """Six texts under one id, among others, over several files."""
    rng = random.Random(4)
    rows = [(5, "w " * n) for n in (2, 10, 3, 31, 8, 4)] + [(i, "x " * rng.randint(0, 9)) for i in range(40)]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", 12)
    try:
        tokenfiles.write_tokens(spark.createDataFrame(rows, "doc_id long, text string"), BYTE, f"{tmp_path}/t")
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    files = sorted({r[0] for r in spark.read.orc(f"{tmp_path}/t").select("_metadata.file_path").collect()})
    stream, want = [], []
    for f in files:
        for r in spark.read.orc(f).collect():
            want.append((r["doc_id"], len(stream), r["n_tokens"], zlib.crc32(np.array(r["ids"], "<u4").tobytes())))
            stream += r["ids"]
    assert len(files) > 1 and len(want) == len(rows)
    assert pairs(tokenfiles.documents_of(spark, f"{tmp_path}/t"), "doc_id", "start", "n_tokens", "ids_crc32") == sorted(want)


def test_a_few_odd_characters_leave_the_rest_to_the_fast_way(words_bpe, monkeypatch):
    seen = []
    monkeypatch.setattr(words_bpe, "_whole", lambda t, f=words_bpe._whole: (seen.append(t), f(t))[1])
    text = "plain words of a text, “quoted once” and more — plain words <|endoftext|> to the end"
    lib = Tokenizer.from_file(WORD)
    for t in (text, text * 3, "“" + text, text + "”", "“ ” —"):
        assert words_bpe.encode([t])[0].tolist() == lib.encode(t, add_special_tokens=False).ids
    assert max(map(len, seen)) < 20


def test_queries(spark, tmp_path):
    import hashlib
    rows = [(i, t) for i, t in enumerate([*odd_texts(), *ODD])]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    word, byte = Tokenizer.from_file(WORD), Tokenizer.from_file(BYTE)
    sha = lambda b: hashlib.sha256(b).hexdigest()
    want, files, start = [], [], 0
    for i, t in rows:
        ids = word.encode(t or "", add_special_tokens=False).ids
        want.append((i, len(ids), sha(np.array(ids, "<u4").tobytes()), sha(word.decode(ids, skip_special_tokens=False).encode())))
        ids = [*byte.encode(t or "", add_special_tokens=False).ids, 2]
        files.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    got = queries.op2_bpe(spark, str(tmp_path))
    assert pairs(got, "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == want
    assert pairs(queries.op4_token_files(spark, str(tmp_path)), "doc_id", "start", "n_tokens", "ids_crc32") == files
