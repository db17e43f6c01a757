"""Rule learning by posting lists against a plain greedy learner."""

import random

import pytest

from lexis.operators import ruleindex
from lexis.operators.rules import OUTSIDE, TEMPLATES

SCHEMA = "sent_id bigint, words array<string>, gold array<string>, cur array<string>, extra int"


def _state(seed, n=40):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        k = rnd.randint(1, 9)
        words = [rnd.choice(["a", "b", "c", "d"]) for _ in range(k)]
        gold = [rnd.choice("XYZ") if w == "d" else "X" if w in "ab" else "Y" for w in words]
        cur = [g if rnd.random() < 0.6 else rnd.choice("XYZ") for g in gold]
        rows.append((i, words, gold, cur, i))
    return rows + [(n, [], [], [], 0), (n + 1, ["a", "b"], [None, "X"], ["X", None], 0)]


def _keys(words, tags, i):
    at = lambda xs, j: OUTSIDE if not 0 <= j < len(xs) else xs[j] if xs[j] is not None else OUTSIDE
    return [(t, " ".join(at(words if kind == "word" else tags, i + off) for kind, off in tpl))
            for t, tpl in enumerate(TEMPLATES)]


def _learn(rows, min_score, max_rules):
    rows = [(w, g, list(c)) for _, w, g, c, _ in rows]
    rules = []
    while len(rules) < max_rules:
        fixes, breaks = {}, {}
        for w, g, c in rows:
            for i in range(len(w)):
                if c[i] is None or g[i] is None:
                    continue
                for t, key in _keys(w, c, i):
                    if c[i] == g[i]:
                        breaks[t, key, c[i]] = breaks.get((t, key, c[i]), 0) + 1
                    else:
                        fixes[t, c[i], g[i], key] = fixes.get((t, c[i], g[i], key), 0) + 1
        scored = [(-(n - breaks.get((t, key, a), 0)), t, a, b, key) for (t, a, b, key), n in fixes.items()]
        best = min(scored, default=(0,))
        if -best[0] < min_score:
            break
        s, t, a, b, key = best
        rules.append((t, a, b, key, -s))
        for w, _, c in rows:
            c[:] = [b if tag == a and _keys(w, c, i)[t][1] == key else tag for i, tag in enumerate(c)]
    return rules


# (limits of the module): as they are; a heap of few conditions, changes beyond its limit and early merges
@pytest.mark.parametrize("seed,limits", [
    (1, {}),
    (2, {"HEAP": 3, "LOOK": 2, "TIER": 2}),
    (3, {"HEAP": 5, "DELTA_ROWS": 30, "TIER": 3}),
])
def test_rules_are_those_of_a_plain_learner(spark, monkeypatch, seed, limits):
    for name, value in limits.items():
        monkeypatch.setattr(ruleindex, name, value)
    rows = _state(seed)
    want = _learn(rows, 2, 4)
    got = ruleindex.fit_rules_indexed(spark.createDataFrame(rows, SCHEMA), 2, 4)
    assert len(want) == 4
    assert [(r["tpl"], r["from_tag"], r["to_tag"], r["key"], r["score"]) for r in got] == want


def test_an_empty_state_has_no_rules(spark):
    assert ruleindex.fit_rules_indexed(spark.createDataFrame([], SCHEMA)) == []
