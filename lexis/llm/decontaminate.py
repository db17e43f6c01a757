"""Benchmark decontamination with a positional inverted index.

``build_index`` stores the postings of all training tokens: each row of the
written table is a shard of whole documents with its sorted terms (64-bit word
hashes) and, per term, the positions of its occurrences.  Documents stand in a
shard one after the other with a gap longer than any phrase, so a phrase can
not run from one into the next.

``find`` answers phrase queries: test windows (10 consecutive words of a
benchmark item; an item of fewer words is one window) whose terms are all in
the shard start from the posting list of their rarest term, shifted by its
place in the window, and intersect it with the shifted lists of the others in
order of growing frequency.  What remains is exactly the places of the phrase.
Proximity matches are items whose rarest terms stand close together.

The index is built and read shard by shard, without a shuffle; hot terms are
long arrays, never a group.  The benchmark is sent to the tasks in blocks of
measured size, however large it is; matches of several blocks are merged.

Words count as equal if their 64-bit hashes are (see ``words``): a wrong hit needs ten of
them in a row.

Results for odd inputs: null and empty texts have no words and no hits; items
without words and items with a null id have no windows; items that repeat an
id count once; repeated documents each get their row; columns beside id and
text are ignored; an empty benchmark leaves every document clean.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexis.llm.common import col, give_back, id_and_text, text_chunks
from lexis.llm.words import byte_tables, word_hashes
from lexis.session import ensure_checkpoint_dir, written

SHARD_BYTES = 2_000_000          # text of a shard; a longer document is a shard of its own
BLOCK_BYTES = 16_000_000         # benchmark text sent to the tasks at once
NEAR_TERMS = 5                   # rarest terms of an item that a proximity match needs
SLOP = 60                        # words within which they stand

INDEX = T.StructType([
    T.StructField("shard", T.LongType()), T.StructField("doc_ids", T.ArrayType(T.LongType())),
    T.StructField("n_words", T.ArrayType(T.LongType())), T.StructField("terms", T.BinaryType()),
    T.StructField("ends", T.BinaryType()), T.StructField("places", T.BinaryType())])


def build_index(docs: DataFrame, window: int = 10, id_col: str = "doc_id", text_col: str = "text",
                path: str | None = None) -> DataFrame:
    """The written index of ``docs`` (under the shared checkpoint folder unless
    ``path`` says otherwise), read back."""
    import uuid

    spark = docs.sparkSession
    kind = docs.schema[id_col].dataType
    schema = T.StructType([T.StructField("doc_ids", T.ArrayType(kind)) if f.name == "doc_ids" else f for f in INDEX])

    def run(batches):
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        tables = byte_tables()
        shard = TaskContext.get().partitionId() << 32
        for batch in batches:
            ids = batch.column(0)
            for a, b, texts in text_chunks(batch.column(1), SHARD_BYTES):
                words = [word_hashes(t.encode().lower(), tables) for t in texts]
                n = np.array([len(w) for w in words], np.int64)
                first = np.cumsum(n + window) - n - window
                where = np.repeat(first - (np.cumsum(n) - n), n) + np.arange(n.sum())
                flat = np.concatenate(words)
                order = np.argsort(flat, kind="stable")
                terms, counts = np.unique(flat, return_counts=True)
                row = (shard, None, n.tolist(), terms.tobytes(), np.cumsum(counts).astype(np.int64).tobytes(),
                       where[order].astype(np.int64 if len(where) and where[-1] > 2**32 - 1 else np.uint32).tobytes())
                cols = [pa.array([x]) for x in row]
                cols[1] = pa.ListArray.from_arrays(pa.array([0, b - a], pa.int32()), ids.slice(a, b - a))
                cols[2] = pa.array([row[2]], pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays(cols, names=[f.name for f in schema])
                shard += 1
        give_back()

    path = path or f"{ensure_checkpoint_dir(spark).rstrip('/')}/lexis-index-{uuid.uuid4().hex}"
    (id_and_text(docs, id_col, text_col).mapInArrow(run, schema)
     .write.option("parquet.block.size", 16 << 20).option("parquet.enable.dictionary", "false").parquet(path))
    return spark.read.schema(schema).parquet(path)


def _open(row):
    """(terms, list ends, places) of an index row."""
    import numpy as np

    terms = np.frombuffer(row["terms"], np.uint64)
    ends = np.frombuffer(row["ends"], np.int64)
    total = int(ends[-1]) if len(ends) else 0
    return terms, ends, np.frombuffer(row["places"], np.uint32 if len(row["places"]) == 4 * total else np.int64)


def _blocks(benchmark: DataFrame, id_col: str, text_col: str):
    """The benchmark in lists of (id, text), each of about BLOCK_BYTES at most (but
    for a single longer item), and whether a list is the last: the number of blocks
    follows from the measured size."""
    items = (benchmark.select(col(id_col).alias("item"), col(text_col).cast("string").alias("text"))
             .where("item is not null and text is not null").distinct())
    size = items.agg(F.sum(F.octet_length("text") + 64)).first()[0] or 0
    n = size // BLOCK_BYTES + 1
    part = F.pmod(F.xxhash64("item", "text"), F.lit(n))
    for k in range(n):
        yield [(r["item"], r["text"]) for r in items.where(part == k).collect()], k == n - 1


def _windows(block, window: int):
    """Distinct windows: matrix of terms (0-padded), their lengths, the items of
    each; and the distinct terms of every item text."""
    import numpy as np

    tables = byte_tables()
    found: dict[tuple, set] = {}
    of_item = []
    for item, text in block:
        w = word_hashes(text.encode().lower(), tables).tolist()
        if w:
            of_item.append((item, list(dict.fromkeys(w))))
        for i in range(max(1, len(w) - window + 1) if w else 0):
            found.setdefault(tuple(w[i:i + window]), set()).add(item)
    size = np.array([len(k) for k in found], np.int64)
    grid = np.zeros((len(found), window), np.uint64)
    for i, k in enumerate(found):
        grid[i, :len(k)] = k
    return grid, size, [sorted(v) for v in found.values()], of_item


def _frequencies(index: DataFrame, terms) -> dict:
    """Corpus frequency of the given terms (their number is bounded by the block)."""
    def run(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            rows = batch.to_pylist()
            total = np.zeros(len(terms), np.int64)
            for r in rows:
                t, ends = np.frombuffer(r["terms"], np.uint64), np.frombuffer(r["ends"], np.int64)
                if len(t):
                    at = np.minimum(np.searchsorted(t, terms), len(t) - 1)
                    total += np.where(t[at] == terms, np.diff(ends, prepend=0)[at], 0)
            yield pa.RecordBatch.from_arrays([pa.array(terms.view(np.int64)), pa.array(total)], names=["term", "n"])

    import numpy as np

    got = index.select("terms", "ends").mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n")).collect()
    n = {r[0]: r[1] for r in got}
    return {int(t): n.get(int(s), 0) for t, s in zip(terms, terms.view(np.int64))}


def _has(sorted_values, values):
    import numpy as np

    at = np.minimum(np.searchsorted(sorted_values, values), len(sorted_values) - 1)
    return sorted_values[at] == values


def _match(index: DataFrame, block, window: int, slop: int, near_terms: int) -> DataFrame:
    """A row per document: its key, word count, hit intervals, items hit, items near."""
    import numpy as np

    grid, size, items, of_item = _windows(block, window)
    terms = np.unique(grid[grid != 0])
    freq = _frequencies(index, terms) if len(terms) else {}
    rarest_first = [sorted(range(int(n)), key=lambda k, row=row: (freq.get(int(row[k]), 0), k))
                    for row, n in zip(grid, size)]
    rare_terms = [(item, np.array(sorted(w, key=lambda t: (freq.get(t, 0), t))[:near_terms], np.uint64))
                  for item, w in of_item]
    id_kind = index.schema["doc_ids"].dataType.elementType
    item_kind = T.StringType()
    schema = T.StructType([
        T.StructField("shard", T.LongType()), T.StructField("place", T.LongType()), T.StructField("doc_id", id_kind),
        T.StructField("n_words", T.LongType()), T.StructField("hits", T.ArrayType(T.ArrayType(T.LongType()))),
        T.StructField("items", T.ArrayType(item_kind)), T.StructField("near", T.ArrayType(item_kind))])

    def shard_rows(row):
        t, ends, places = _open(row)
        n = np.array(row["n_words"], np.int64)
        first = np.cumsum(n + window) - n - window
        hits = [[] for _ in n]
        got = [set() for _ in n]
        close = [set() for _ in n]

        def postings(k):
            return places[ends[k - 1] if k else 0:ends[k]].astype(np.int64)

        if len(t) and len(grid):
            at = np.minimum(np.searchsorted(t, grid), len(t) - 1)
            there = (t[at] == grid) | (grid == 0)
            for i in np.flatnonzero(there.all(axis=1)):
                order = rarest_first[i]
                starts = postings(at[i, order[0]]) - order[0]
                for k in order[1:]:
                    if not len(starts):
                        break
                    starts = starts[_has(postings(at[i, k]), starts + k)]
                for s, d in zip(starts.tolist(), (np.searchsorted(first, starts, "right") - 1).tolist()):
                    s -= int(first[d])
                    hits[d].append((s, s + int(size[i])))
                    got[d].update(items[i])
            for item, want in rare_terms:
                k = np.minimum(np.searchsorted(t, want), len(t) - 1)
                if not (t[k] == want).all():
                    continue
                centre = postings(k[0])
                doc = np.searchsorted(first, centre, "right") - 1
                ok = np.ones(len(centre), bool)
                for j in k[1:]:
                    p = postings(j)
                    lo = np.searchsorted(p, np.maximum(centre - slop, first[doc]))
                    hi = np.searchsorted(p, np.minimum(centre + slop, first[doc] + n[doc] - 1), "right")
                    ok &= hi > lo
                for d in np.unique(doc[ok]).tolist():
                    close[d].add(item)
        for d, doc_id in enumerate(row["doc_ids"]):
            yield (row["shard"], d, doc_id, int(n[d]), _merged(hits[d]), sorted(map(str, got[d])),
                   sorted(map(str, close[d] - got[d])))

    def run(batches):
        import pyarrow as pa
        from pyspark.sql.pandas.types import to_arrow_schema

        kinds = to_arrow_schema(schema)
        for batch in batches:
            for i in range(batch.num_rows):
                rows = list(shard_rows(batch.slice(i, 1).to_pylist()[0]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k.type) for c, k in zip(zip(*rows), kinds)], names=kinds.names)

    return index.mapInArrow(run, schema)


def _merged(spans):
    out = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(b, out[-1][1])
        else:
            out.append([a, b])
    return out


def find(index: DataFrame, benchmark: DataFrame, window: int = 10, item_col: str = "item_id",
         text_col: str = "text", slop: int = SLOP, near_terms: int = NEAR_TERMS) -> DataFrame:
    """``doc_id, n_words, n_hit, hits`` (word intervals ``[start, end)``), ``items`` and
    ``near_items`` (ids as strings, sorted) for every document of the index."""
    found, several = None, False
    for block, last in _blocks(benchmark, item_col, text_col):
        part = _match(index, block, window, slop, near_terms)
        if not (last and found is None):   # written, so that the driver holds one block at a time
            part = written(part, "matches")
        several, found = found is not None, part if found is None else found.union(part)
    if several:   # the same documents once per block: merge what each block found
        merge = F.udf(lambda lists: _merged([x for y in lists for x in y]), T.ArrayType(T.ArrayType(T.LongType())))
        found = (found.groupBy("shard", "place")
                 .agg(F.first("doc_id").alias("doc_id"), F.first("n_words").alias("n_words"),
                      merge(F.collect_list("hits")).alias("hits"),
                      F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
                      F.array_distinct(F.flatten(F.collect_list("near"))).alias("near"))
                 .withColumn("near", F.array_sort(F.array_except("near", "items"))))
    n_hit = F.aggregate("hits", F.lit(0).cast("long"), lambda s, x: s + x[1] - x[0])
    return found.select("doc_id", "n_words", n_hit.alias("n_hit"), "hits", "items", F.col("near").alias("near_items"))
