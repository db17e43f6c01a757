"""Line deduplication with a suffix array over line-ID sequences.

Every line that has a word is a symbol (a 128-bit id of its text); every
document is a sequence of symbols.  Suffixes are sorted by distributed prefix
doubling: ranks of prefixes of 2^k lines are paired with the ranks 2^k lines
further on, the distinct pairs are range-partitioned and sorted, and their
places are the ranks of prefixes of 2^(k+1) lines.  Suffixes with a common
prefix of L lines are an LCP interval of that order; two overlapping prefixes
of 2^k lines name it for any L.

A run of consecutive lines that stands earlier in the corpus too (at a smaller
document id, or further up in the same document) and has ``min_words`` words
or more is a later copy; all lines of such runs are deleted, the first copy
stays.  Shorter repeats (a greeting, a heading) stay everywhere.  A later copy
may overlap the first: periodic lines of one document collapse, and what is left
of the first copy is what stands before the second one's start.

Two kinds of runs suffice to find every line of every maximal run: for each
line, the shortest run of ``min_words`` words that starts there, and the
shortest that ends there.  (Let p be a line of a maximal run that starts at a.
Either the run from a that reaches the words covers p, or the words from a to p
suffice, and then the shortest run ending at p lies inside.)  These have
``min_words`` lines at most, so doubling ends after log2(min_words) rounds
whatever the length of the documents.

Lines that occur once can not be part of a repeat and leave before the first
round.  Hot lines are counted with partial sums, the sort splits between pairs,
and joins that put ranks back have one row per key on one side, so adaptive
execution can split hot keys.

Results for odd inputs: null and empty texts have no lines and stay as they are;
lines without words are no symbols and stay, unless a text keeps no word at
all, then nothing of it stays; of rows that repeat id and text the first is the
earlier copy; columns beside id and text stay as they are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexis.llm.common import col, free_name, map_texts
from lexis.session import written

IDX_BITS = 26    # of a line's number in its document; the other 37 number documents; more of either is an error
LINES = [T.StructField(n, T.ArrayType(t)) for n, t in (
    ("idx", T.IntegerType()), ("h1", T.LongType()), ("h2", T.LongType()), ("words", T.IntegerType()),
    ("ahead", T.IntegerType()), ("back", T.IntegerType()))]


def _reach(words, least: int):
    """For each line the number of lines that the shortest run of ``least`` words
    has that starts there, and that ends there (0: none)."""
    import numpy as np

    total = np.concatenate(([0], np.cumsum(words)))
    n = len(words)
    at = np.searchsorted(total, total[:-1] + least)            # first end with enough words
    ahead = np.where(at <= n, at - np.arange(n), 0)
    at = np.searchsorted(total, total[1:] - least, "right") - 1   # last start with enough words
    back = np.where(at >= 0, np.arange(n) - at + 1, 0)
    return ahead, back


def _line_arrays(texts: list[str], least: int) -> list:
    import numpy as np
    from xxhash import xxh64_intdigest, xxh3_64_intdigest

    out = [[] for _ in LINES]
    for t in texts:
        lines = t.encode().split(b"\n")
        words = np.array([len(x.split()) for x in lines], np.int64)
        idx = np.flatnonzero(words)
        kept = [lines[i] for i in idx]
        ahead, back = _reach(words[idx], least)
        h1 = np.array([xxh64_intdigest(x) for x in kept], np.uint64).view(np.int64)
        h2 = np.array([xxh3_64_intdigest(x) for x in kept], np.uint64).view(np.int64)
        for o, v in zip(out, (idx, h1, h2, words[idx], ahead, back)):
            o.append(v)
    return out


def _ordered(df: DataFrame, cols: list[str], name: str, out: str) -> DataFrame:
    """``df`` with increasing numbers in the order of ``cols`` (not dense), written once."""
    return written(df.repartitionByRange(*cols).sortWithinPartitions(*cols)
                   .withColumn(out, F.monotonically_increasing_id()), name)


def _dense(df: DataFrame, number: str) -> DataFrame:
    """Makes ``number`` of ``_ordered`` dense: one offset per partition is broadcast."""
    part = F.shiftright(number, 33)
    sizes = df.groupBy(part.alias("_p")).count()
    off = sizes.select("_p", (F.sum("count").over(Window.orderBy("_p")) - F.col("count")).alias("_off"))
    return (df.join(F.broadcast(off), part == F.col("_p"))
            .withColumn(number, F.col("_off") + F.col(number).bitwiseAND((1 << 33) - 1)).drop("_p", "_off"))


def repeated_runs(docs: DataFrame, min_words: int = 50, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``k1, k2`` (key of id and text), ``copies`` (rows with it), ``words``, ``lines`` (sorted
    numbers of the lines of later copies), and ``every`` (those of all lines with
    words, if there are several copies).  A row per document that has any."""
    src = docs.select(col(id_col).alias("doc_id"), F.xxhash64(col(id_col), col(text_col)).alias("k1"),
                      F.xxhash64(F.lit(1), col(id_col), col(text_col)).alias("k2"),
                      F.coalesce(col(text_col), F.lit("")).alias("text"))
    arrays = map_texts(src, LINES, lambda: lambda texts: _line_arrays(texts, min_words))
    first = [F.first(f.name).alias(f.name) for f in LINES]
    one = arrays.groupBy("k1", "k2").agg(F.min("doc_id").alias("doc_id"), F.count(F.lit(1)).alias("copies"), *first)
    one = _dense(_ordered(one, ["doc_id", "k1", "k2"], "lines", "ord"), "ord")

    # a line's number among the lines with words: runs do not see blank lines
    fits = (F.col("ord") < 1 << 63 - IDX_BITS) & (F.col("i") < 1 << IDX_BITS)
    place = F.when(fits, F.shiftleft("ord", IDX_BITS) + F.col("i")).otherwise(
        F.raise_error(F.lit("more documents or lines in one than a line's number holds")))
    line = one.select("ord", F.posexplode(F.arrays_zip(*[f.name for f in LINES])).alias("i", "x")).select(
        place.cast("long").alias("pos"), "x.h1", "x.h2", "x.ahead", "x.back")
    keys = line.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    keys = _ordered(keys, ["h1", "h2"], "ids", "rank")
    rows = written(line.join(keys, ["h1", "h2"]).select("pos", "ahead", "back", F.array("rank").alias("ranks")), "rank0")

    longest = rows.agg(F.max(F.greatest("ahead", "back"))).first()[0] or 0
    order = Window.partitionBy(F.shiftright("pos", IDX_BITS)).orderBy("pos")
    k = 0
    while 2 << k <= longest:   # ranks of 2^(k+1) lines
        step = 1 << k
        a, nxt = F.col("ranks")[k], F.lead(F.struct("pos", F.col("ranks")[k].alias("r")), step).over(order)
        paired = rows.select("*", a.alias("a"), nxt.alias("n")).select(
            "pos", "ahead", "back", "ranks", "a",
            F.when(F.col("n.pos") == F.col("pos") + step, F.col("n.r")).otherwise(F.lit(-1)).alias("b"))
        pairs = _ordered(paired.select("a", "b").distinct(), ["a", "b"], "pairs", "rank")
        rows = written(paired.join(pairs, ["a", "b"]).select(
            "pos", "ahead", "back", F.concat("ranks", F.array("rank")).alias("ranks")), f"rank{k + 1}")
        k += 1

    # stretches of repeated lines; shortest runs of enough words inside them
    stretch = rows.withColumn("s", F.col("pos") - F.row_number().over(order))
    within = Window.partitionBy(F.shiftright("pos", IDX_BITS), "s")
    stretch = stretch.select("*", F.min("pos").over(within).alias("lo"), F.max("pos").over(within).alias("hi"))
    fore = stretch.where("ahead > 0 and pos + ahead - 1 <= hi").select("pos", F.col("ahead").alias("len"))
    aft = stretch.where("back > 0 and pos - back + 1 >= lo").select(
        (F.col("pos") - F.col("back") + 1).alias("pos"), F.col("back").alias("len"))
    runs = fore.union(aft).distinct().withColumn("k", F.floor(F.log2(F.col("len") + F.lit(0.5))).cast("int"))
    rank = rows.select(F.col("pos").alias("at"), "ranks")
    runs = (runs.join(rank, F.col("pos") == F.col("at")).select("pos", "len", "k", F.col("ranks")[F.col("k")].alias("x"))
            .withColumn("then", F.expr("pos + len - shiftleft(1, k)"))
            .join(rank, F.col("then") == F.col("at")).select("pos", "len", "x", F.col("ranks")[F.col("k")].alias("y")))
    runs = written(runs, "runs")
    # written, so that the join below deals out its sides anew and a run with very many copies can be split
    interval = written(runs.groupBy("len", "x", "y").agg(F.min("pos").alias("least"), F.count(F.lit(1)).alias("n"))
                       .where("n > 1").drop("n"), "intervals")
    later = (runs.join(interval, ["len", "x", "y"]).where("pos > least")
             .select(F.shiftright("pos", IDX_BITS).alias("ord"), "pos", (F.col("pos") + F.col("len") - 1).alias("last")))
    spans = later.groupBy("ord").agg(F.collect_set(F.struct("pos", "last")).alias("spans"))
    low = (1 << IDX_BITS) - 1
    covered = F.array_distinct(F.flatten(F.transform("spans", lambda s: F.sequence(
        s["pos"].bitwiseAND(low), s["last"].bitwiseAND(low)))))
    hit = one.join(spans, "ord", "left").where("spans is not null or copies > 1")
    return hit.select("k1", "k2", "copies", F.aggregate("words", F.lit(0).cast("long"), lambda s, x: s + x).alias("words"),
                      F.transform(F.array_sort(F.coalesce(covered, F.array().cast("array<bigint>"))),
                                  lambda i: F.col("idx")[i.cast("int")]).alias("lines"),
                      F.when(F.col("copies") > 1, F.col("idx")).alias("every"))


def _without(text, gone):
    if text is None:
        return None
    gone = set(gone.tolist() if hasattr(gone, "tolist") else gone)
    return "\n".join(x for i, x in enumerate(text.split("\n")) if i not in gone)


def dedup_lines(docs: DataFrame, min_words: int = 50, id_col: str = "doc_id", text_col: str = "text",
                drop_empty: bool = True) -> DataFrame:
    """``docs`` without the lines of later copies, plus ``deleted_lines`` (their
    numbers).  ``drop_empty`` leaves out rows that lost all their words."""
    k1, k2, n = (free_name(docs, x) for x in ("_k1", "_k2", "_n"))
    found = repeated_runs(docs, min_words, id_col, text_col).select(
        F.col("k1").alias(k1), F.col("k2").alias(k2), F.struct("words", "lines", "every").alias(n + "found"))
    keyed = docs.select("*", F.xxhash64(col(id_col), col(text_col)).alias(k1),
                        F.xxhash64(F.lit(1), col(id_col), col(text_col)).alias(k2))
    both = keyed.join(found, [k1, k2], "left")
    both = both.withColumn(n, F.row_number().over(Window.partitionBy(k1, k2).orderBy(k1)))
    f = F.col(n + "found")
    whole = (F.col(n) > 1) & (f["words"] >= min_words)   # a second copy of the whole row
    gone = F.when(whole, f["every"]).otherwise(F.coalesce(f["lines"], F.array().cast("array<int>")))
    out = both.withColumn(n + "gone", gone)
    cut = F.udf(_without, "string", useArrow=True)   # sees the texts that lose lines only
    edited = cut(F.when(F.size(n + "gone") > 0, col(text_col)), F.col(n + "gone"))
    out = out.withColumn(n + "text", F.coalesce(edited, col(text_col)))
    if drop_empty:
        out = out.where((F.size(n + "gone") == 0) | F.col(n + "text").rlike("[^\\x20\\x09-\\x0D]"))
    return out.select(*[F.col(n + "text").alias(c) if c == text_col else col(c) for c in docs.columns],
                      F.col(n + "gone").alias(free_name(docs, "deleted_lines")))
