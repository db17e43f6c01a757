"""Exact nearest neighbours by a block matrix join.

Rows and queries are dealt into blocks of bounded size; each pair of a query
block and a row block is a tile, made by one co-group.  In a tile the product of
int8-quantised vectors gives all distances at once with an error bound: a
vector and its quantised form are ``e`` apart, so the true distance differs from
the quantised one by at most the sum of the two ``e``.  Pairs whose lower bound
is above the k-th smallest upper bound can not be among the tile's k nearest;
the others are computed again in double precision and merged by a heap.  A
window over the tiles' results, pre-limited before the shuffle, keeps k.

The result is exact: the bounds never drop a neighbour.  A tile's vectors are scaled
by a power of two before the bounds are computed and every distance by one of its own, so
finite components of any size neither overflow nor vanish in a square; a distance that
a double can not hold is infinite.

Results for odd inputs: vectors that are null, empty, zero, or hold nulls, NaN
or infinities take no part; vectors of another length are no candidates; rows
that repeat id and vector count once; a row is no candidate of a query with its
own id; equal distances go to the smaller id; columns beside id and vector are
ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lexis.llm.common import col

ROW_BLOCK = 4096
QUERY_BLOCK = 1024


def clean(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """``id, v`` (array of double), ``dim`` of the vectors that take part."""
    v = col(vec_col).cast("array<double>")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return (vectors.select(col(id_col).cast("long").alias("id"), v.alias("v"))
            .where(F.col("id").isNotNull() & finite & F.exists(v, lambda x: x != 0))
            .select("id", "v", F.size("v").alias("dim")))


def _quantised(x):
    """(int8 values as float32, scale, distance of each row to its quantised form)."""
    import numpy as np

    scale = float(np.abs(x).max()) / 127 or 1.0
    q = np.rint(x / scale).astype(np.int8).astype(np.float32 if x.shape[1] <= 1024 else np.float64)
    # squares below 1e-300 vanish, hence the last summand
    return q, scale, np.sqrt(((x - q.astype(np.float64) * scale) ** 2).sum(axis=1)) * (1 + 1e-9) + 1e-150


def _scaled(q, r):
    """Both matrices times the power of two that brings their largest component to 1 at most."""
    import numpy as np

    _, e = np.frexp(max(np.abs(q).max(initial=0), np.abs(r).max(initial=0)))
    return np.ldexp(q, -e), np.ldexp(r, -e)


def _distances(r, q):
    """Euclidean distances of the rows of ``r`` to ``q``; a power of two taken out and put back
    changes no digit."""
    import numpy as np

    with np.errstate(over="ignore", invalid="ignore"):
        gap = r - q
        _, e = np.frexp(np.abs(gap).max(axis=1, initial=0))
        return np.ldexp(np.sqrt((np.ldexp(gap, -e[:, None]) ** 2).sum(axis=1)), e)


def tile(qid, q, rid, r, k: int) -> list[tuple[int, int, float]]:
    """(query, row, distance) of each query's k nearest rows of one tile."""
    import heapq

    import numpy as np

    out = []
    small_q, small_r = _scaled(q, r)
    qq, qs, qe = _quantised(small_q)
    rq, rs, re = _quantised(small_r)
    q2 = (qq.astype(np.float64) ** 2).sum(axis=1) * qs * qs
    r2 = (rq.astype(np.float64) ** 2).sum(axis=1) * rs * rs
    dot = (qq @ rq.T).astype(np.float64) * (qs * rs)
    square = q2[:, None] + r2[None, :] - 2 * dot
    # rounding of the three terms, in the square and so also in the root
    slack = 1e-12 * (q2[:, None] + r2[None, :])
    low = np.sqrt(np.maximum(square - slack, 0)) - (qe[:, None] + re[None, :])
    high = np.sqrt(np.maximum(square, 0) + slack) + (qe[:, None] + re[None, :])
    own = qid[:, None] == rid[None, :]
    low[own], high[own] = np.inf, np.inf
    limit = np.partition(high, k - 1, axis=1)[:, k - 1] if high.shape[1] > k else np.full(len(q), np.inf)
    for i in range(len(q)):
        near = np.flatnonzero(~(low[i] > limit[i] * (1 + 1e-12)) & ~own[i])
        exact = _distances(r[near], q[i])
        out += [(int(qid[i]), n, d) for d, n in heapq.nsmallest(k, zip(exact.tolist(), rid[near].tolist()))]
    return out


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 10, id_col: str = "vec_id",
            vec_col: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score``: the k nearest rows of ``vectors`` to every row
    of ``queries`` by Euclidean distance."""
    rows, asked = clean(vectors, id_col, vec_col), clean(queries, id_col, vec_col)
    n_rows = max(1, -(-rows.count() // ROW_BLOCK))
    n_asked = max(1, -(-asked.count() // QUERY_BLOCK))
    part = lambda n: F.pmod(F.xxhash64("id"), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = asked.select("id", "v", "dim", part(n_asked).alias("qb"), every(n_rows).alias("rb"))
    right = rows.select("id", "v", "dim", part(n_rows).alias("rb"), every(n_asked).alias("qb"))

    def run(a, b):
        import numpy as np
        import pyarrow as pa

        def arrays(t):
            ids = t.column("id").to_numpy()
            flat = t.column("v").combine_chunks().flatten().to_numpy(zero_copy_only=False)
            x = flat.reshape(len(ids), -1)
            _, first = np.unique(np.column_stack((ids.view(np.float64)[:, None], x)).view(np.int64), axis=0, return_index=True)
            return ids[np.sort(first)], x[np.sort(first)]

        got = tile(*arrays(a), *arrays(b), k) if a.num_rows and b.num_rows else []
        cols = list(zip(*got)) or [(), (), ()]
        return pa.table({"query_id": pa.array(cols[0], pa.int64()), "vec_id": pa.array(cols[1], pa.int64()),
                         "score": pa.array(cols[2], pa.float64())})

    keys = ("dim", "rb", "qb")
    near = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(run, "query_id long, vec_id long, score double")
    best = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return (near.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
