"""Size-checked broadcast.

A side is broadcast only after its size in bytes has been measured against a bound;
above the bound the plain DataFrame is returned and Spark plans a shuffle join
(with AQE's skew-join split for hot keys).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DEFAULT_MAX_BROADCAST_BYTES = 64 << 20
HEAD_KEYS = 1 << 15  # most frequent keys whose entries travel where a table is too large to


def bounded_broadcast(df: DataFrame, max_bytes: int = DEFAULT_MAX_BROADCAST_BYTES) -> tuple[DataFrame, bool]:
    """Return ``(df_or_hinted_df, broadcast?)``.  ``df`` is cached first, so the
    measuring job also materialises what the join then reads; its size is that
    of the cached columns."""
    df = df.cache()
    df.count()
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return (F.broadcast(df), True) if size <= max_bytes else (df, False)


def lookup_join(rows: DataFrame, table: DataFrame, key: str, max_bytes: int = DEFAULT_MAX_BROADCAST_BYTES) -> DataFrame:
    """``rows`` left-joined with ``table`` on ``key``, for rows whose keys are words: few of
    them make up most rows.

    Beyond ``max_bytes`` of table the entries of the most frequent keys travel, and only the
    other rows are moved to be joined, so no task gets all rows of a frequent key."""
    side, small = bounded_broadcast(table, max_bytes)
    if small:
        return rows.join(side, key, "left")
    top = (rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
           .orderBy(F.desc("_n"), key).limit(HEAD_KEYS).select(key, F.lit(True).alias("_head")))
    found = rows.join(F.broadcast(top.join(side, key, "left").cache()), key, "left")
    of_head = found.where("_head").drop("_head")
    rest = found.where("_head IS NULL").select(*rows.columns).join(side, key, "left")
    return of_head.unionByName(rest)
