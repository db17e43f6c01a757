"""Cross-tokenizer alignment against a plain version over whole texts."""

import base64
import bisect
import hashlib
from collections import Counter, defaultdict

import public_tokenizers
import pytest
import sentencepiece
from llm_cases import empty_docs, odd_docs, odd_texts, pairs, words
from tokenizers import Tokenizer

from lexis.llm import alignment, bytelevel, queries

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
ODD = ["a ", " a", "  ", "a\n b  \n\n c \t d", "▁x", "<s> <|endoftext|> a </s>", "  x 　 y", "\x1c b \x1c  c", "a\r\nb \r c",
       "it's we'll 'S don't", "co-operate 12345 3.14 naïve ﬁ", "tab\tspace  two   three", "good ▁ bad good"]
NUMBERS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]


def tokens():
    ranks = {int(i): base64.b64decode(w) for w, i in
             map(bytes.split, open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb"))}
    sp = sentencepiece.SentencePieceProcessor(model_file=B)
    lib = Tokenizer.from_file(A)
    lib.encode_special_tokens = True

    def a(text):
        return [(i, ranks[i]) for i in lib.encode(" " + text, add_special_tokens=False).ids]

    def b(text):
        return [(i, bytes([int(sp.id_to_piece(i)[3:5], 16)]) if sp.is_byte(i) else
                 sp.id_to_piece(i).replace("▁", " ").encode()) for i in sp.encode(text)]
    return a, b


def spans(toks):
    out, at = [], 0
    for i, raw in toks:
        out.append((i, at, at + len(raw)))
        at += len(raw)
    return out


def plain(texts):
    """Rows (numbers, groups) of all texts, by the definition."""
    of_a, of_b = tokens()
    rows, held = [], Counter()
    for t in texts:
        a, b = (of_a(t), of_b(t)) if t else ([], [])
        raw = (" " + t).encode() if t else b""
        if b"".join(x for _, x in a) != raw or b"".join(x for _, x in b) != raw:
            a, b = [], []
        a, b = spans(a), spans(b)
        ends = sorted({e for *_, e in a} & {e for *_, e in b})
        groups = [([], []) for _ in ends]
        for k, side in enumerate((a, b)):
            for i, s, _ in side:
                groups[bisect.bisect_right(ends, s)][k].append(i)
        near = defaultdict(list)
        for y, u, v in b:
            for p in range(u, v):
                near[p].append((y, u))
        links = [(x, y) for x, s, e in a for y, _ in dict.fromkeys(z for p in range(s, e) for z in near[p])]
        held.update(set(links))
        rows.append((len(a), len(b), groups, links))
    most = defaultdict(int)
    for (x, _), n in held.items():
        most[x] = max(most[x], n)
    return [(na, nb, len(g), len(ls), sum(held[p] == most[p[0]] for p in ls), sum(held[p] for p in ls),
             ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in g)) for na, nb, g, ls in rows]


def corpus():
    import random
    rng = random.Random(11)
    return [*odd_texts(), *ODD, *[words(rng, rng.randint(1, 60), "abcdeéñ'.,日\n ") for _ in range(40)]]


@pytest.mark.parametrize("head", [alignment.HEAD, 40, 0])
def test_alignment_equals_plain_version(spark, head):
    extra = corpus()[len(odd_texts()):]
    df = odd_docs(spark, extra)
    rows = [(i, t) for i, t in enumerate([*odd_texts(), *extra])]
    rows += [rows[5], rows[10], (None, "no id")]
    found = alignment.align(df, A, B, head=head)
    assert found.columns == ["doc_id", *NUMBERS, "groups"]
    want = [(d, *r) for (d, _), r in zip(rows, plain([t or "" for _, t in rows]))]
    key = lambda t: tuple((x is not None, x) for x in t)
    assert pairs(found, "doc_id", *NUMBERS, "groups") == sorted(want, key=key)


def test_a_long_text_and_small_chunks(spark, monkeypatch):
    monkeypatch.setattr(alignment, "TEXT_BYTES", 500)
    monkeypatch.setattr(alignment, "RUN", 3)
    texts = corpus() + [("word\n " * 3000) + "end "]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = [tuple(r)[1:] for r in alignment.align(df, A, B).orderBy("doc_id").collect()]
    assert got == plain([t or "" for t in texts])


def test_other_byte_level_files_take_the_library():
    import json
    spec = json.loads(open(A, encoding="utf-8").read())
    spec["pre_tokenizer"]["add_prefix_space"] = True
    other = bytelevel.ByteLevel(json.dumps(spec), special=False)
    assert b"".join(other.bytes[i] for i in other.ids("one two")) == b" one two"
    assert other.array("one two").tolist() == other.ids("one two")
    usual = bytelevel.ByteLevel(open(A, encoding="utf-8").read(), special=False)
    lib = Tokenizer.from_file(A)
    lib.encode_special_tokens = True
    for t in corpus():
        assert usual.ids(t or "") == lib.encode(t or "", add_special_tokens=False).ids


def test_empty_table(spark):
    assert alignment.align(empty_docs(spark), A, B).collect() == []


def test_query(spark, tmp_path):
    texts = corpus()
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.op12_token_alignment(spark, str(tmp_path)).orderBy("doc_id")
    assert got.columns == ["doc_id", *NUMBERS, "groups_sha256"]
    want = [(i, *r[:6], hashlib.sha256(r[6].encode()).hexdigest() if r[6] else "")
            for i, r in enumerate(plain([t or "" for t in texts]))]
    assert [tuple(r) for r in got.collect()] == want
