"""How document filters overlap: what each removes, in every order they could be applied.

Five filters are fixed: A under 100 words; B fewer than 80 distinct words in 100; C over
10 upper-case letters A-Z in 100 code points; D any of ``#$%&*|``; E the text of a
document with a smaller id.  ``flags`` gives every document the mask of the filters it
fails, ``audit`` reduces the masks to counts per part, order and step.

Copies are found with radix tries.  Each task inserts its whole texts into compressed
tries whose terminals hold the smallest id; a row with a larger id is a copy at once and
goes on without its text, so of a text with very many copies a task sends one row.  The
rest is range-partitioned by text prefixes that are as long as it takes to tell sampled
neighbours apart (texts that agree in more than ``KEY_CHARS`` characters are dealt by
a hash on top), inserted into tries again in the order of the texts, and the
traversal tells copies from firsts.  A trie that has grown beyond ``TRIE_CHARS``
is traversed and dropped: before the shuffle at any place, after it between two
different texts, so no copy is missed and memory is bounded.

Results for odd inputs: null texts are empty; an empty text fails A, and E if a smaller
id has one; the rows that share the smallest id of a text are all firsts; rows with a
null id neither are copies nor make any; a null part is the empty string; labels that
repeat an id hold if one of the rows does, null labels and labels of unknown ids do
not count; repeated documents each count; other columns are ignored; an empty table
gives no rows.
"""

from __future__ import annotations

import json
import math
from itertools import permutations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexis.llm.common import col, give_back, text_chunks

# the filters, their thresholds and their letters are fixed
FILTERS = "ABCDE"
MIN_WORDS, MIN_DISTINCT, MAX_UPPER, SYMBOLS = 100, 80, 10, b"#$%&*|"
COPY = 1 << FILTERS.index("E")

KEY_CHARS = 1024            # characters of a text that choose its range
SAMPLED = 16                # sampled texts a range
MOST_RANGES = 1 << 14       # ranges; their tries stay bounded however long they are
TRIE_CHARS = 16_000_000     # characters of texts in one trie
UPPER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"


class Trie:
    """A compressed trie of texts; a terminal holds the smallest id and its rows."""

    def __init__(self):
        self.root = ["", {}, None]   # label, children by first character, terminal
        self.chars = 0

    def insert(self, text: str, key, row) -> list | None:
        """Add a row; rows that are now known to be copies come back."""
        node, i, n = self.root, 0, len(text)
        while i < n:
            child = node[1].get(text[i])
            if child is None:
                leaf = [text[i:], {}, None]
                node[1][text[i]] = leaf
                self.chars += n - i
                node, i = leaf, n
            elif text.startswith(child[0], i):
                node, i = child, i + len(child[0])
            else:      # the text leaves the label inside: split it there
                at = _agree(child[0], text, i)
                top = [child[0][:at], {child[0][at]: child}, None]
                node[1][text[i]] = top
                child[0] = child[0][at:]
                node, i = top, i + at
        held = node[2]
        if held is None:
            node[2] = (key, [row])
        elif key > held[0]:
            return [row]
        elif key == held[0]:
            held[1].append(row)
        else:
            node[2] = (key, [row])
            return held[1]
        return None

    def texts(self):
        """(text, rows of its smallest id) of every terminal."""
        stack = [(self.root, "")]
        while stack:
            (label, children, held), before = stack.pop()
            text = before + label
            if held:
                yield text, held[1]
            stack += [(c, text) for c in children.values()]


def _agree(label: str, text: str, i: int) -> int:
    """How many characters of ``label`` stand in ``text`` at ``i`` (not all of them)."""
    low, high = 0, len(label)
    while high - low > 1:
        mid = (low + high) // 2
        if text.startswith(label[low:mid], i + low):
            low = mid
        else:
            high = mid
    return low


def own_mask(text: str) -> int:
    """Filters A to D."""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    n = len(words)
    upper = len(raw) - len(raw.translate(None, UPPER))
    return ((n < MIN_WORDS) | (100 * len(set(words)) < MIN_DISTINCT * n) << 1
            | (100 * upper > MAX_UPPER * len(text)) << 2 | (len(raw.translate(None, SYMBOLS)) < len(raw)) << 3)


def _bounds(src: DataFrame, ranges: int) -> list[str]:
    """Lower ends of all ranges but the first, from a sample of at most some ``SAMPLED`` x
    ``ranges`` distinct texts; each is the shortest prefix that parts it from its neighbour."""
    every = max(1, src.count() // (SAMPLED * ranges))
    h = F.xxhash64("text")
    sample = (src.where(F.pmod(h, F.lit(every)) == 0)
              .select(h.alias("h"), F.substring("text", 1, KEY_CHARS).alias("p"), F.length("text").alias("n"))
              .groupBy("h").agg(F.first("p").alias("p"), F.first("n").alias("n")))
    kept = sorted((r["p"], r["n"] + 500) for r in sample.orderBy("h").limit(4 * SAMPLED * ranges).collect())
    total, weight, out, last = sum(w for _, w in kept), 0, [], ""
    for p, w in kept:
        if weight * ranges >= total * (len(out) + 1):   # a range is full
            out.append(p if p == last else p[:len(_shared(last, p)) + 1])
        weight += w
        last = p
    return out


def _shared(a: str, b: str) -> str:
    k = next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
    return a[:k]


def _range_of(text: str, bounds: list[str]) -> int:
    from bisect import bisect_left, bisect_right
    from zlib import crc32

    key = text[:KEY_CHARS]
    low, high = bisect_left(bounds, key), bisect_right(bounds, key)
    if high - low > 1:    # several ranges begin with this very key: the rest of the text decides
        return low + 1 + crc32(text.encode("utf-8", "surrogatepass")) % (high - low)
    return high


def flags(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """``doc_id, part, mask`` of every document: bit i is set if it fails filter i."""
    src = docs.select(col(id_col).cast("long").alias("doc_id"), F.coalesce(col(part_col).cast("string"), F.lit("")).alias("part"),
                      F.coalesce(col(text_col).cast("string"), F.lit("")).alias("text"))
    spark = docs.sparkSession
    ranges = min(MOST_RANGES, max(int(spark.conf.get("spark.sql.shuffle.partitions")), src.rdd.getNumPartitions()))
    bounds = _bounds(src, ranges)
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("part", T.StringType()),
                           T.StructField("mask", T.IntegerType()), T.StructField("text", T.StringType()),
                           T.StructField("range", T.IntegerType())])

    def arrow(rows, fields):
        import pyarrow as pa
        from pyspark.sql.pandas.types import to_arrow_schema

        kinds = to_arrow_schema(fields)
        return pa.RecordBatch.from_arrays([pa.array(c, k.type) for c, k in zip(zip(*rows), kinds)], names=kinds.names)

    def before(batches):
        """One row per document: with its text and range while it can be a first, else without."""
        trie, out, turn = Trie(), [], 0

        def drop():
            for text, rows in trie.texts():
                where = _range_of(text, bounds)
                out.extend((*r, text, where) for r in rows)

        for batch in batches:
            ids, parts = batch.column(0), batch.column(1)
            for a, b, texts in text_chunks(batch.column(2)):
                for i, part, text in zip(ids.slice(a, b - a).to_pylist(), parts.slice(a, b - a).to_pylist(), texts):
                    row = (i, part, own_mask(text))
                    known = [row] if i is None else trie.insert(text, i, row)
                    for r in known or ():
                        turn += 1
                        out.append((r[0], r[1], r[2] | (COPY if i is not None else 0), None, turn % ranges))
                if trie.chars > TRIE_CHARS:
                    drop()
                    trie = Trie()
                if out:
                    yield arrow(out, schema)
                    out.clear()
        drop()
        if out:
            yield arrow(out, schema)
        give_back()

    def after(batches):
        """Rows in the order of their texts, those without first."""
        trie, out, last = Trie(), [], None
        for batch in batches:
            for a, b, texts in text_chunks(batch.column(3)):
                ids, parts, masks = (batch.column(k).slice(a, b - a).to_pylist() for k in range(3))
                for row, text in zip(zip(ids, parts, masks), texts):
                    if text is None:
                        out.append(row)
                        continue
                    if trie.chars > TRIE_CHARS and text != last:
                        out.extend(r for _, rows in trie.texts() for r in rows)
                        trie = Trie()
                    last = text
                    out.extend((r[0], r[1], r[2] | COPY) for r in trie.insert(text, row[0], row) or ())
                if out:
                    yield arrow(out, result)
                    out = []
        out.extend(r for _, rows in trie.texts() for r in rows)
        if out:
            yield arrow(out, result)
        give_back()

    result = T.StructType(schema.fields[:3])
    return (src.mapInArrow(before, schema).repartitionById(ranges, F.col("range")).sortWithinPartitions("text")
            .mapInArrow(after, result))


def audit(flagged: DataFrame, labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Per part, order of the filters and step: ``kept, removed, redundant, unique_fails,
    good_lost, toxic_lost, shapley``."""
    one = lambda c: F.max(F.coalesce(F.col(c).cast("int") == 1, F.lit(False)).cast("int"))
    known = (labels.select(col(id_col).alias("doc_id"), "quality", "toxic").where("doc_id is not null")
             .groupBy("doc_id").agg(one("quality").alias("good"), one("toxic").alias("bad")))
    masks = (flagged.join(known, "doc_id", "left").groupBy("part", "mask")
             .agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("good"), F.lit(0)).alias("good"),
                  F.coalesce(F.sum("bad"), F.lit(0)).alias("bad"))
             .groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "bad")).alias("m")))   # 32 masks at most
    steps = [{"filter_order": "".join(p), "step": k + 1, "bit": 1 << FILTERS.index(f),
              "earlier": sum(1 << FILTERS.index(x) for x in p[:k])} for p in permutations(FILTERS) for k, f in enumerate(p)]
    # the 600 steps are fixed: a literal
    table = F.from_json(F.lit(json.dumps(steps)), "array<struct<filter_order string, step int, bit int, earlier int>>")
    rows = masks.select("part", "m", F.inline(table))
    bit, earlier = F.col("bit"), F.col("earlier")

    def total(what, test):
        return F.aggregate("m", F.lit(0).cast("long"), lambda s, x: s + F.when(test(x["mask"]), what(x)).otherwise(0))

    hit = lambda m: m.bitwiseAND(bit) != 0
    gone = lambda m: m.bitwiseAND(earlier) != 0
    n = lambda x: x["n"]
    # of the orders of m failed filters, one in m has this one first
    share = lambda x: (x["n"] * math.factorial(len(FILTERS)) / F.bit_count(x["mask"])).cast("long")
    return rows.select(
        "part", "filter_order", "step",
        total(n, lambda m: ~hit(m) & ~gone(m)).alias("kept"), total(n, lambda m: hit(m) & ~gone(m)).alias("removed"),
        total(n, lambda m: hit(m) & gone(m)).alias("redundant"), total(n, lambda m: m == bit).alias("unique_fails"),
        total(lambda x: x["good"], lambda m: hit(m) & ~gone(m)).alias("good_lost"),
        total(lambda x: x["bad"], lambda m: hit(m) & ~gone(m)).alias("toxic_lost"),
        total(share, hit).alias("shapley"))
