"""SimHash near-duplicates by meet-in-the-middle ball hashing.

A document's fingerprint has bit b set if more than half of its shingle hashes
do.  To link all fingerprints within ``2r`` bits, every distinct fingerprint
emits itself and all variants within ``r`` bits; two fingerprints at distance
2r or less share the variant half way between them.  The shuffle groups by
variant, so a group is a Hamming ball of radius r (65 fingerprints at most for
r = 1, however hot the data), because equal fingerprints are collapsed first.

Within a ball every member is linked to the ball's smallest member instead of
to every other; collisions are deduplicated and each link is verified by its
bit distance.  For an odd maximal distance ``2r + 1`` variants within r + 1
bits are emitted, and a ball's members are compared with each other.

Results for odd inputs: null and empty texts (and texts of white space) have no
shingle, fingerprint zero, and link like any other; texts with fewer words than
a shingle have one shingle of all their words; repeated rows and repeated ids
each get their row, with the component of their fingerprint; rows with a null
id keep their fingerprint and can not be a component's smallest id (the
component is null only if all its ids are).  Columns other than the id and the
text are ignored.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexis.llm.common import col, free_name, id_and_text, map_texts
from lexis.llm.components import connected_components
from lexis.session import written

BITS = 64
SLICE = 1 << 16   # shingles whose bits are counted at once


def _fingerprints(texts: list[str], words: int, seed: int) -> list[int]:
    """Signed 64-bit fingerprints."""
    import numpy as np
    from xxhash import xxh64_intdigest

    out = []
    for text in texts:
        w = text.encode().lower().split()   # bytes: only A-Z change, only ASCII white space splits
        n = len(w) - words + 1
        if not w:
            out.append(0)
            continue
        joined = b" ".join(w)
        if n <= 1:
            hashes = [xxh64_intdigest(joined, seed)]
        else:
            ends = np.cumsum(np.fromiter(map(len, w), np.int64, len(w)) + 1)
            starts = (ends - np.fromiter(map(len, w), np.int64, len(w)) - 1)[:n].tolist()
            ends = (ends[words - 1:] - 1).tolist()
            hashes = [xxh64_intdigest(joined[a:b], seed) for a, b in zip(starts, ends)]
        count = np.zeros(BITS, np.int64)
        h = np.array(hashes, np.uint64)
        for i in range(0, len(h), SLICE):
            bits = np.unpackbits(h[i:i + SLICE].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            count += bits.sum(axis=0, dtype=np.int64)
        on = np.packbits((2 * count > len(h)).astype(np.uint8), bitorder="little")
        out.append(int(on.view(np.int64)[0]))
    return out


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3,
                 seed: int = 42) -> DataFrame:
    """``doc_id, fp`` (signed 64 bits), a row per input row."""
    return _printed(id_and_text(docs, id_col, text_col), words, seed)


def _printed(src: DataFrame, words: int, seed: int) -> DataFrame:
    return map_texts(src, [T.StructField("fp", T.LongType())], lambda: lambda texts: [_fingerprints(texts, words, seed)])


def _masks(radius: int) -> list[int]:
    """All bit masks of up to ``radius`` bits, as signed 64-bit integers."""
    out = []
    for r in range(radius + 1):
        for bits in combinations(range(BITS), r):
            m = sum(1 << b for b in bits)
            out.append(m - (1 << 64) if m >> 63 else m)
    return out


def links(prints: DataFrame, max_bits: int = 2) -> DataFrame:
    """``a, b``: verified links between distinct fingerprints of column ``fp`` that
    connect everything within ``max_bits`` (a star per ball, not all pairs)."""
    radius = (max_bits + 1) // 2
    each = (prints.select("fp").distinct()
            .select("fp", F.explode(F.array(*[F.lit(m) for m in _masks(radius)])).alias("_mask"))
            .select("fp", F.col("fp").bitwiseXOR(F.col("_mask")).alias("variant")))
    if max_bits % 2 == 0:
        least = F.min("fp").over(Window.partitionBy("variant"))   # a ball: 65 rows at most for radius 1
        pairs = each.select(least.alias("a"), F.col("fp").alias("b"))
    else:   # members of a ball can be max_bits + 1 apart: compare them (a ball is bounded)
        ball = each.groupBy("variant").agg(F.sort_array(F.collect_set("fp")).alias("m")).where(F.size("m") > 1)
        pairs = (ball.select("m", F.posexplode("m").alias("i", "a"))
                 .select("a", F.explode(F.slice("m", F.col("i") + 2, F.size("m"))).alias("b")))
    return (pairs.where("a < b").distinct()
            .where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits))


def _with_least(prints: DataFrame, max_bits: int, least) -> DataFrame:
    """``prints`` (a written table) with ``component_id``: the smallest of the aggregate ``least``
    of all fingerprints reachable over links."""
    joined = connected_components(links(prints, max_bits)).select(
        F.col("node").alias("fp"), F.col("component").alias("group"))
    classes = prints.groupBy("fp").agg(least.alias("least"))
    classes = classes.join(joined, "fp", "left").select("fp", "least", F.coalesce("group", "fp").alias("group"))
    smallest = classes.groupBy("group").agg(F.min("least").alias("component_id"))
    # one row per distinct fingerprint; a hot fingerprint is hot on one side only
    by_print = classes.join(smallest, "group").select("fp", "component_id")
    return prints.join(by_print, "fp")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3,
                    max_bits: int = 2, seed: int = 42) -> DataFrame:
    """``doc_id, fp, component_id`` (the smallest id reachable over links)."""
    prints = written(fingerprints(docs, id_col, text_col, words, seed), "simhash")
    return _with_least(prints, max_bits, F.min("doc_id")).select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3,
             max_bits: int = 2, seed: int = 42) -> DataFrame:
    """One row of ``docs`` per component: the one with its smallest id, and of rows
    that share this id and differ in text the one with the smallest key; rows that
    repeat id and text count once.  Rows with a null id are kept."""
    k1, k2, n = (free_name(docs, x) for x in ("_k1", "_k2", "_copy"))
    # a row's key is a hash of id and text: an id can stand at several texts
    keyed = docs.select("*", F.xxhash64(col(id_col), col(text_col)).alias(k1),
                        F.xxhash64(F.lit(1), col(id_col), col(text_col)).alias(k2))
    src = keyed.select(col(id_col).alias("doc_id"), F.col(k1).alias("k1"), F.col(k2).alias("k2"),
                       F.coalesce(col(text_col).cast("string"), F.lit("")).alias("text"))
    prints = written(_printed(src, words, seed), "simhash")
    row = F.struct("doc_id", "k1", "k2")
    found = _with_least(prints, max_bits, F.min(F.when(F.col("doc_id").isNotNull(), row)))
    gone = found.where(F.col("doc_id").isNotNull() & (row != F.col("component_id"))).select(
        F.col("k1").alias(k1), F.col("k2").alias(k2)).distinct()
    kept = keyed.join(gone, [k1, k2], "left_anti")
    same = Window.partitionBy(k1, k2).orderBy(k1)
    return kept.withColumn(n, F.row_number().over(same)).where(F.col(n) == 1).drop(n, k1, k2)
