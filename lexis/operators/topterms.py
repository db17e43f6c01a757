"""The most frequent terms without moving the whole vocabulary.

Every partition counts its own terms, with no exchange, into a written table.
Then three small exchanges: the sums of the partitions' own leading terms give a
lower bound of the last place; the sums of all local counts that a term needs
somewhere to reach it give a better bound and an upper bound for every term; only
terms whose upper bound reaches the better one are summed in full.  Ties at the
last place go to the term seen first, so the result is exact.
"""

from __future__ import annotations

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lexis.plans.sizing import bounded_broadcast
from lexis.session import written

MERGE_ROWS = 1 << 20  # counted rows that wait to be merged in a task


def _merge(parts: list[pd.DataFrame]) -> pd.DataFrame:
    x = pd.concat(parts, ignore_index=True).sort_values(["sample_id", "pos"], kind="stable")
    firsts = x.drop_duplicates("term").set_index("term")[["sample_id", "pos"]]
    return firsts.join(x.groupby("term", sort=False)["cnt"].sum()).reset_index()


def local_counts(tokens: DataFrame, n: int) -> DataFrame:
    """``part, term, cnt, first, lead`` of every partition; ``lead``: among its ``n`` highest
    counts, equal ones included.  A task holds its own vocabulary."""
    def run(batches):
        done, waiting = [], 0
        for b in batches:
            if b.num_rows:
                done.append(_merge([b.to_pandas().assign(cnt=1)]))
                waiting += len(done[-1])
                if waiting > max(MERGE_ROWS, 2 * len(done[0])):
                    done = [_merge(done)]
                    waiting = 0
        if done:
            x = _merge(done)
            least = x["cnt"].nlargest(n).min()
            x = x.assign(part=TaskContext.get().partitionId(), lead=x["cnt"] >= least)
            yield pa.RecordBatch.from_pandas(x[["part", "term", "cnt", "sample_id", "pos", "lead"]], preserve_index=False,
                                             schema=pa.schema([("part", pa.int32()), ("term", pa.string()), ("cnt", pa.int64()),
                                                               ("sample_id", pa.int64()), ("pos", pa.int64()), ("lead", pa.bool_())]))
    x = tokens.select(F.col("sample_id").cast("long").alias("sample_id"), F.col("pos").cast("long").alias("pos"), "term")
    x = x.where("term is not null and sample_id is not null and pos is not null")
    out = x.mapInArrow(run, "part int, term string, cnt long, sample_id long, pos long, lead boolean")
    return out.select("part", "term", "cnt", F.struct("sample_id", "pos").alias("first"), "lead")


def _last_place(sums: DataFrame, n: int) -> int:
    """The n-th highest ``s``, 0 where there are fewer."""
    rows, least = sums.select("s").orderBy(F.desc("s")).limit(n).agg(F.count(F.lit(1)), F.min("s")).first()
    return least if rows == n else 0


def candidates(local: DataFrame, n: int) -> DataFrame:
    """``term``: every term that can be among the ``n`` most frequent, ties at the last place included."""
    m = max(1, local.select("part").distinct().count())
    low = _last_place(local.where("lead").groupBy("term").agg(F.sum("cnt").alias("s")), n)
    # a term with ``low`` occurrences has low / m in some partition, and less wherever it is not counted here
    sums = written(local.where(F.col("cnt") * m >= low).groupBy("term")
                   .agg(F.sum("cnt").alias("s"), F.count(F.lit(1)).alias("parts")), "sums")
    better = _last_place(sums, n)
    return sums.where(F.col("s") * m + (m - F.col("parts")) * low >= better * m).select("term")


def top_terms(tokens: DataFrame, n: int, skip: int = 0) -> DataFrame:
    """``term, cnt, rank`` for ranks ``skip + 1 .. n`` of ``tokens(sample_id, pos, term)``: by count,
    ties by first appearance (``sample_id``, ``pos``).  Rows with a null in any of the three do not
    count; fewer terms give fewer rows, none give none."""
    local = written(local_counts(tokens, n), "local-counts")
    few, _ = bounded_broadcast(candidates(local, n))
    exact = (local.join(few, "term", "left_semi").groupBy("term")
             .agg(F.sum("cnt").alias("cnt"), F.min("first").alias("first")))
    # n rows at most reach the one window that numbers them
    last = exact.orderBy(F.desc("cnt"), "first").limit(n)
    rank = F.row_number().over(Window.orderBy(F.desc("cnt"), "first"))
    return last.select("term", "cnt", rank.cast("int").alias("rank")).where(F.col("rank") > skip)
