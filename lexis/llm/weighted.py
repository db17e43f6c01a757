"""Document fingerprints by consistent weighted sampling.

The terms of a text are its words (``A-Z`` lower-cased, between ASCII white space),
weighted by how often they occur.  For each term and each of ``SAMPLES`` places two
gamma(2, 1) variables r, c and a uniform b follow from the term's hash alone.  A
term of weight S is quantised to ``y = exp(r (t - b))``, ``t = floor(ln S / r + b)``,
and stands at ``a = c / (y exp(r))``; the place samples the term with the smallest a,
together with its t.  Two texts agree in a place with probability equal to their
generalised Jaccard similarity, the sum of smaller weights over the sum of larger
ones (plus 2^-16 of the rest: a sample is kept as a hash of 16 bits).  Likeness is the
share of places that agree; its standard error is below 0.063.

``edited`` compares each text with itself after its last half was replaced by the
beginning of the next one.  Rows are range-partitioned by id once; the next row
is the following one of the same task, and the last row of a range meets the first
one of the next range in a small join.

Results for odd inputs: null texts are empty; texts without words have the empty
fingerprint, which is like itself only (likeness 1, else 0); rows with a null id
come first; rows that share an id are ordered by a hash of their text; a single
document is its own next one; long texts are sampled whole, some words at a time;
columns beside id and text are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexis.llm.common import give_back, id_and_text, map_texts, per_worker, range_count, text_chunks
from lexis.session import written

SAMPLES = 64
SEED = 42
SLICE = 4096        # words whose samples are compared at once
BLOCK = 256         # words whose variables are drawn at once: they stay in the processor's cache
ONCE, OFTEN = 200_000, 16_000   # words a worker keeps: ln a at weight 1 (256 bytes), all variables (768 bytes)
STEP, MIX_A, MIX_B = 0x9E3779B9, 0x85EBCA6B, 0xC2B2AE35   # odd constants of a 32-bit mixer
MIX64 = 0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9


def _draw(hashes):
    """r, b and ln c of every place, for each 64-bit word hash."""
    import numpy as np

    low, high = (hashes & np.uint64(0xFFFFFFFF)).astype(np.uint32), (hashes >> np.uint64(32)).astype(np.uint32)
    x = low[:, None] + np.arange(1, 3 * SAMPLES + 1, dtype=np.uint32) * np.uint32(STEP)
    x ^= x >> np.uint32(16)
    x *= np.uint32(MIX_A)
    x ^= high[:, None]
    x ^= x >> np.uint32(13)
    x *= np.uint32(MIX_B)
    x ^= x >> np.uint32(16)
    pair = x[:, :2 * SAMPLES]     # two uniforms of 16 bits each, never 0 nor 1
    half = np.float32(0.5)
    both = ((pair & np.uint32(0xFFFF)).astype(np.float32) + half) * ((pair >> np.uint32(16)).astype(np.float32) + half)
    gamma = -np.log(both * np.float32(2.0**-32))     # gamma(2, 1): a product of two uniforms
    b = ((x[:, 2 * SAMPLES:] >> np.uint32(9)).astype(np.float32) + half) * np.float32(2.0**-23)
    return gamma[:, :SAMPLES], b, np.log(gamma[:, SAMPLES:])


class Kept:
    """Arrays computed from words seen lately, up to ``size`` words; full, it starts anew."""

    def __init__(self, size: int, arrays: int, make):
        import numpy as np

        self.make, self.size, self.known = make, max(size, SLICE), {}
        self.table = np.empty((arrays, self.size, SAMPLES), np.float32)
        self.hash = np.empty(self.size, np.uint64)

    def rows(self, words: list[bytes]):
        """Places of the words (at most SLICE of them)."""
        import numpy as np
        from xxhash import xxh64_intdigest

        known = self.known
        missing = [w for w in words if w not in known]
        if missing:
            if len(known) + len(missing) > self.size:
                known.clear()
                missing = words
            for i in range(0, len(missing), BLOCK):
                part = missing[i:i + BLOCK]
                h = np.array([xxh64_intdigest(w, SEED) for w in part], np.uint64)
                at = len(known)
                for t, v in zip(self.table, self.make(h)):
                    t[at:at + len(part)] = v
                self.hash[at:at + len(part)] = h
                known.update(zip(part, range(at, at + len(part))))
        return np.array(list(map(known.__getitem__, words)), np.int64)


def _at_weight_one(hashes):
    r, b, c = _draw(hashes)
    return [c - r * (1 - b)]      # t is 0


class Sampler:
    """Fingerprints of texts."""

    def __init__(self):
        self.once, self.often = Kept(ONCE, 1, _at_weight_one), Kept(OFTEN, 3, _draw)

    def _least(self, words, weights):
        """ln a, word hash and t of every place's sample, among words of one kind: all of weight 1, or none."""
        import numpy as np

        kept = self.once if weights is None else self.often
        places = np.arange(SAMPLES)
        for i in range(0, len(words), SLICE):
            rows = kept.rows(words[i:i + SLICE])
            if weights is None:
                a = kept.table[0][rows]
            else:
                r, b, c = (t[rows] for t in kept.table)
                t = np.floor(np.log(np.array(weights[i:i + SLICE], np.float32))[:, None] / r + b)
                a = c - r * (t - b + 1)
            first = a.argmin(axis=0)
            yield a[first, places], kept.hash[rows[first]], 0 if weights is None else t[first, places].astype(np.int64)

    def sample(self, text: str):
        """SAMPLES hashes of 16 bits; none for a text without words."""
        from collections import Counter
        from itertools import chain

        import numpy as np

        counts = Counter(text.encode("utf-8", "surrogatepass").lower().split())
        if not counts:
            return np.zeros(0, np.uint16)
        single = [w for w, n in counts.items() if n == 1]
        more = [w for w, n in counts.items() if n > 1]
        least, out = np.full(SAMPLES, np.inf, np.float32), np.zeros(SAMPLES, np.uint64)
        for a, h, t in chain(self._least(single, None), self._least(more, [counts[w] for w in more])):
            found = h + np.multiply(t, MIX64[0] - (1 << 64), dtype=np.int64).view(np.uint64)
            out = np.where(a < least, found, out)
            least = np.minimum(a, least)
        out = (out ^ (out >> np.uint64(31)) ^ np.arange(SAMPLES, dtype=np.uint64)) * np.uint64(MIX64[1])
        return (out >> np.uint64(48)).astype(np.uint16)


def _like(x, y) -> float:
    """Share of places in which two fingerprints agree."""
    if len(x) != len(y):
        return 0.0
    return float((x == y).mean()) if len(x) else 1.0


def _text(x) -> str:
    return x.astype(">u2").tobytes().hex()


def _spliced(text: str, following: str) -> str:
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, fingerprint`` (four hexadecimal digits a sample) of every document."""
    def setup():
        sampler = per_worker("weighted", Sampler)
        return lambda texts: [[_text(sampler.sample(t)) for t in texts]]

    return map_texts(id_and_text(docs, id_col, text_col), [T.StructField("fingerprint", T.StringType())], setup)


def edited(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
           derive: dict[str, Column] | None = None) -> DataFrame:
    """Every document with its edited text: ``doc_id, n_chars, edited, fingerprint, edited_fingerprint,
    near_edited, near_next``.  ``derive`` replaces ``edited`` by columns computed from it, so
    that the texts need not be stored."""
    derive = derive or {"edited": F.col("edited")}
    src = id_and_text(docs, id_col, text_col)
    ranges = range_count(src)
    src = src.withColumn("tie", F.xxhash64("text"))
    src = src.repartitionByRange(ranges, "doc_id", "tie").sortWithinPartitions("doc_id", "tie").select("doc_id", "text")
    results = [T.StructField("edited", T.StringType()), T.StructField("edited_fingerprint", T.StringType()),
               T.StructField("near_edited", T.DoubleType()), T.StructField("near_next", T.DoubleType())]
    own = [src.schema["doc_id"], T.StructField("n_chars", T.LongType()), T.StructField("fingerprint", T.StringType())]
    # range, is it its first row, its last one, and the texts of these
    edge = [T.StructField("range", T.IntegerType()), T.StructField("first", T.BooleanType()),
            T.StructField("last", T.BooleanType()), T.StructField("edge_text", T.StringType())]
    schema = T.StructType([*own, *edge, *results])

    def compared(sampler, text, prints, following, next_prints):
        new = _spliced(text, following)
        of_new = prints if new == text else sampler.sample(new)
        return new, _text(of_new), _like(prints, of_new), _like(prints, next_prints)

    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext
        from pyspark.sql.pandas.types import to_arrow_schema

        kinds = to_arrow_schema(schema)
        sampler = per_worker("weighted", Sampler)
        where = TaskContext.get().partitionId()

        def arrow(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, k.type) for c, k in zip(zip(*rows), kinds)], names=kinds.names)

        held, first = None, True   # the row that waits for its next one
        for batch in batches:
            for a, b, texts in text_chunks(batch.column(1)):
                out = []
                for i, text in zip(batch.column(0).slice(a, b - a).to_pylist(), texts):
                    prints = sampler.sample(text)
                    if held:
                        out.append((held[0], len(held[1]), _text(held[2]), where, first, False, held[1] if first else None,
                                    *compared(sampler, held[1], held[2], text, prints)))
                        first = False
                    held = i, text, prints
                if out:
                    yield arrow(out)
        if held:
            yield arrow([(held[0], len(held[1]), _text(held[2]), where, first, True, held[1], None, None, None, None)])
        give_back()

    keep = ["doc_id", "n_chars", *derive, "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    rows = written(src.mapInArrow(run, schema).select(
        *[f.name for f in (*own, *edge)], *[c.alias(k) for k, c in derive.items()],
        "edited_fingerprint", "near_edited", "near_next"), "weighted")
    # the last row of each range and the first of the next one that has rows: two rows a range
    heads = rows.where("first").select("range", F.col("edge_text").alias("next_text"), F.col("fingerprint").alias("next_print"))
    by_range = Window.orderBy("range")   # as many rows as ranges
    after = heads.select("range", F.coalesce(F.lead("range").over(by_range), F.min("range").over(by_range)).alias("next"))
    ends = (rows.where("last").select(*[f.name for f in own], "range", "edge_text").join(after, "range")
            .join(heads.withColumnRenamed("range", "next"), "next"))
    closing = T.StructType([*own, *results])

    def close(batches):
        import numpy as np
        import pyarrow as pa
        from pyspark.sql.pandas.types import to_arrow_schema

        kinds = to_arrow_schema(closing)
        sampler = per_worker("weighted", Sampler)
        read = lambda x: np.frombuffer(bytes.fromhex(x), ">u2")
        for batch in batches:
            col = lambda k: batch.column(batch.schema.get_field_index(k)).to_pylist()
            out = [(i, n, mine, *compared(sampler, text, read(mine), following, read(other)))
                   for i, n, mine, text, following, other in zip(
                       *map(col, ("doc_id", "n_chars", "fingerprint", "edge_text", "next_text", "next_print")))]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, k.type) for c, k in zip(zip(*out), kinds)], names=kinds.names)

    closed = ends.select(*[f.name for f in own], "edge_text", "next_text", "next_print").mapInArrow(close, closing)
    closed = closed.select(*[f.name for f in own], *[c.alias(k) for k, c in derive.items()],
                           "edited_fingerprint", "near_edited", "near_next")
    return rows.where(~F.col("last")).select(*keep).unionByName(closed.select(*keep))
