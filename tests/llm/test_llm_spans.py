"""Secrets and personal data against plain regular expressions over whole texts."""

import random
import re
import zlib

import pytest
from llm_cases import empty_docs, expect, odd_docs, odd_texts, pairs

from lexis.llm import pii, secrets


def plain_secrets(t):
    out = []
    for m in re.finditer(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", t, re.I | re.A):
        if len(m[2]) >= 6:
            out.append((m.start(), m.end(), "assign"))
    out += [(m.start(), m.end(), "access") for m in re.finditer(r"AKIA[A-Z0-9]+", t) if len(m[0]) >= 20]
    out += [(m.start(), m.end(), "hex") for m in re.finditer(r"[0-9a-f]+", t) if len(m[0]) >= 24]
    return sorted(out, key=lambda s: (s[0], secrets.KINDS.index(s[2])))


def plain_pii(t):
    out = [(m.start(), m.end(), "email") for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t):
        if all(int(p) <= 255 for p in m[0].split(".")):
            out.append((m.start(), m.end(), "ip"))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        d = [int(c) for c in m[0] if c in "0123456789"]
        if 12 <= len(d) <= 19 and sum(sum(divmod(x * 2, 10)) if i % 2 else x for i, x in enumerate(reversed(d))) % 10 == 0:
            out.append((m.start(), m.end(), "card"))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t):
        if 9 <= len(re.findall("[0-9]", m[0])) <= 15:
            out.append((m.start(), m.end(), "phone"))
    return sorted(out, key=lambda s: (s[0], pii.KINDS.index(s[2])))


SECRET_BITS = ["password", "Secret", "TOKEN", "apikey", "api_key", "=", ":", " ", "'", '"', "AKIA", "ABCDEFGH12345678", "deadbeef",
               "0123456789abcdef", "abc.def-1", "x", "é", "\n", "akia", "FACE"]
PII_BITS = ["a.b", "@", "mail", ".", "com", "1", "255", "256", "4111111111111111", "4111 1111-1111 1111", "+1 (456) 555-2186", "+", "(",
            ")", " ", "-", "é", "\n", "00012", "9"]


@pytest.mark.parametrize("seed", range(4))
def test_secret_spans_equal_plain_search(seed):
    rng = random.Random(seed)
    find = secrets.automaton().iter
    for _ in range(1500):
        t = "".join(rng.choice(SECRET_BITS) for _ in range(rng.randint(0, 12)))
        assert [s for s in secrets.scan(t, find) if s[2] != "checksum"] == plain_secrets(t), t


def test_secret_checksum():
    find = secrets.automaton().iter
    body = "abcdefghijklmnopqrstuvwxyz0123"
    n, check = zlib.crc32(body.encode()), ""
    for _ in range(6):
        n, r = divmod(n, 62)
        check = secrets.BASE62[r] + check
    good = f"x ghp_{body}{check} y"
    assert secrets.scan(good, find) == [(2, 42, "checksum")]
    assert secrets.scan(good.replace("a", "b", 1), find) == []


@pytest.mark.parametrize("seed", range(4))
def test_pii_spans_equal_plain_search(seed):
    rng = random.Random(seed)
    for _ in range(1500):
        t = "".join(rng.choice(PII_BITS) for _ in range(rng.randint(0, 12)))
        assert pii.base_spans(t) == plain_pii(t), t


def test_pii_is_linear_on_long_runs():
    for t in ("a" * 200_000, "1" * 200_000, "1." * 100_000, "@" * 100_000, "+1 " * 60_000, "a@" * 100_000):
        pii.base_spans(t)


EXTRA = ["mail bob.1@x.example.com now", "password=abcdef1234567", "call +1 (456) 555-2186 or 10.0.0.1"]


def test_operators_on_odd_documents(spark):
    docs = odd_docs(spark, EXTRA)
    texts = [*odd_texts(), *EXTRA]
    want = [(i, t) for i, t in enumerate(texts)]
    want += [want[5], want[10], (None, "no id")]
    for found, plain in ((secrets.find_secrets(docs), plain_secrets), (pii.find_pii(docs), plain_pii)):
        got = [(r["doc_id"], [(s["start"], s["end"], s["kind"]) for s in r["spans"]]) for r in found.collect()]
        assert expect((i, str(s)) for i, s in got) == expect((i, str(plain(t or ""))) for i, t in want)
    assert pairs(secrets.find_secrets(empty_docs(spark)), "doc_id") == []
    assert pairs(pii.find_pii(empty_docs(spark)), "doc_id") == []


def test_contexts_find_unseen_identifiers(spark):
    known = [f"please write to user{i}@mail.example.com today" for i in range(8)]
    unseen = ["please write to user77@intranet today", "nothing here 12345678 at all"]
    rows = [(i, t, "en", "s", 0) for i, t in enumerate(known + unseen)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    found = {r["doc_id"]: r["found"] for r in pii.find_pii(df, threshold=0.7).collect()}
    assert [(s["start"], s["end"], s["kind"]) for s in found[8]] == [(16, 31, "email_ctx")]
    assert all(not found[i] for i in range(10) if i != 8)


def contextual(spark, texts, **options):
    """{row number: found parts of the text} of the rows that have any."""
    rows = [(i, t, "en", "s", 0) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    return {r["doc_id"]: [(texts[r["doc_id"]][s["start"]:s["end"]], s["kind"]) for s in r["found"]]
            for r in pii.find_pii(df, **options).collect() if r["found"]}


def test_found_identifiers_induce_patterns(spark):
    known = [f"please write to user{i}@mail.example.com today" for i in range(60)]
    first = [f"please write to nick{i}@corp today" for i in range(20)]
    second = [f"ask our desk nick{i}@corp soon" for i in range(20)] + ["ask our desk zed5@corp soon"]   # no seed stands here
    other = [f"see the page item{i}@9 there" for i in range(20)]
    found = contextual(spark, known + first + second + other)
    assert found == {60 + i: [(f"nick{i % 20}@corp", "email_ctx")] for i in range(40)} | {100: [("zed5@corp", "email_ctx")]}


def test_pattern_with_as_many_unseen_as_seeds(spark):
    known = [f"please write to user{i}@mail.example.com today" for i in range(10)]
    unseen = [f"please write to nick{i}@corp today" for i in range(10)]
    assert contextual(spark, known + unseen) == {10 + i: [(f"nick{i}@corp", "email_ctx")] for i in range(10)}
    few = [f"ask our desk user{i}@mail.example.com soon" for i in range(4)] + [f"ask our desk nick{i}@corp soon" for i in range(8)]
    assert contextual(spark, few) == {}


def test_spaced_identifiers_have_lexical_contexts(spark):
    phones = [f"you can call us at +1 ({100 + i}) 555-77{i + 10} now" for i in range(12)]
    cards = [f"paid with visa card {4000 + i} 1111 1111 {c:04} then" for i in range(12) for c in range(10)
             if pii.luhn(f"{4000 + i}11111111{c:04}")]
    unseen = ["you can call us at (212) 555-7713, ok", "us at 212 555 77 13", "paid with visa card 4111 1111 1111 1112 then",
              "there are 212 555 77 14 of it"]
    assert contextual(spark, phones + cards + unseen) == {
        24: [("(212) 555-7713", "phone_ctx")], 25: [("212 555 77 13", "phone_ctx")], 26: [("4111 1111 1111 1112", "card_ctx")]}


def test_contexts_at_the_start_and_glued_labels(spark):
    known = [f"user{i}@mail.example.com wrote" for i in range(10)] + [f"so tel:+1 ({100 + i}) 555-77{i + 10}" for i in range(10)]
    assert contextual(spark, known + ["nick1@corp wrote", "so tel:555-7713."]) == {
        20: [("nick1@corp", "email_ctx")], 21: [("555-7713", "phone_ctx")]}


def test_candidates():
    def parts(t):
        return [(t[a:b], kind) for a, b, _, _, kind in pii.candidates(t, pii.base_spans(t))]
    assert parts("call +1 (017) 555-7713, 4111 12") == [("+1 (017) 555-7713", "phone"), ("4111 12", None)]
    assert parts("at 10.0.0.1, a@b.c; 12 34 56\n78") == [("10.0.0.1", "ip"), ("a@b.c", "email"), ("12 34 56", None)]
    assert parts("x 12345678 87654321 y") == [("12345678", None), ("87654321", None), ("12345678 87654321", None)]
    assert parts("<a@b.c,d@e.f> id=1234567 (12) 345") == [("a@b.c", "email"), ("d@e.f", "email"), ("1234567", None), ("1234567 (12) 345", None)]
    for t in ("1 " * 100_000, "a@b.c," * 30_000, "(" * 100_000 + "1", "a:" * 100_000 + "1", "1" * 200_000, "+1 " * 60_000):
        pii.candidates(t, pii.base_spans(t))


def test_candidates_cover_the_base_spans():
    rng = random.Random(9)
    for _ in range(3000):
        t = "".join(rng.choice(PII_BITS) for _ in range(rng.randint(0, 12)))
        found = pii.candidates(t, base := pii.base_spans(t))
        assert [(a, b, k) for a, b, _, _, k in found if k] == base
        assert all(e <= a or s >= b for a, b, _, _, k in found if not k for s, e, _ in base), t


def test_a_chain_of_contexts_is_followed_to_its_end(spark):
    """Each context holds the identifiers of the one before and fewer new ones; long identifiers count too."""
    names, sizes = ["alpha", "beta", "gamma", "delta", "epsilon"], [24, 16, 10, 6, 3]
    ids = [[f"{w}{i}x{'0' * 70}@host" for i in range(k)] for w, k in zip(names, sizes)]
    ids[0] = [f"u{i}@mail.example.com" for i in range(sizes[0])]
    rows = [f"context {names[k]} number {x} end" for k in range(4) for x in ids[k] + ids[k + 1]]
    df = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    found = [{rows[r["doc_id"]][s["start"]:s["end"]] for r in pii.find_pii(df, threshold=0.5, **o).collect() for s in r["found"]}
             for o in ({"rounds": 0}, {"rounds": 1}, {})]
    assert found[0] == set() and found[1] <= set(ids[1])
    assert found[2] == {x for i in ids[1:] for x in i}
