"""Top terms by bounds against counting everything."""

import random
from collections import Counter

import pytest

from lexis.operators import topterms
from lexis.session import written


def plain(rows, n, skip):
    counts, first = Counter(), {}
    for s, p, t in rows:
        counts[t] += 1
        first[t] = min(first.get(t, (s, p)), (s, p))
    order = sorted(counts, key=lambda t: (-counts[t], first[t]))
    return [(t, counts[t], k) for k, t in enumerate(order[:n], 1) if k > skip]


@pytest.mark.parametrize("parts, vocab, n, skip", [(1, 30, 5, 0), (7, 200, 20, 5), (16, 3000, 10, 2), (4, 5, 50, 1)])
def test_equals_counting_everything(spark, parts, vocab, n, skip):
    rng = random.Random(vocab)
    # many ties, and terms that lead in no partition
    rows = [(s, p, f"t{min(rng.randrange(vocab), rng.randrange(vocab))}") for s in range(150) for p in range(rng.randint(0, 40))]
    mixed = rows[:]
    rng.shuffle(mixed)
    df = spark.createDataFrame(mixed + [(1, 1, None), (None, 1, "t0")], "sample_id long, pos int, term string").repartition(parts)
    out = topterms.top_terms(df, n, skip).orderBy("rank").collect()
    assert [tuple(r) for r in out] == plain(rows, n, skip)


def test_most_terms_are_never_summed(spark):
    rng = random.Random(2)
    rows = [(s, p, f"t{int(rng.paretovariate(0.7))}") for s in range(300) for p in range(60)]
    df = spark.createDataFrame(rows, "sample_id long, pos int, term string").repartition(6)
    local = written(topterms.local_counts(df, 10))
    assert topterms.candidates(local, 10).count() * 20 < local.select("term").distinct().count()


def test_empty(spark):
    assert topterms.top_terms(spark.createDataFrame([], "sample_id long, pos int, term string"), 3).count() == 0
