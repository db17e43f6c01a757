"""Alignment of two tokenizations of one text, and how often token pairs are linked.

A text with one space before it is encoded by a byte-level BPE file (A) and a
SentencePiece model (B).  Two dictionaries map the byte offset where a token ends
to its place, one for each side; the keys that both hang on to, sorted, cut both
id lists into groups that cover the same bytes.  Inside a group every A token is
linked to the B tokens whose bytes it overlaps.

Neither side has a token that runs from a character that is not white space into
a space (for A by its pre-tokenizer, for B by its vocabulary, which is looked
through), so texts are cut there first; each distinct segment of some megabytes of
text is aligned once, and what holds for a text is put together from its segments.

The count of an id pair is the number of documents that hold it linked.  Tasks
count the pairs of their documents before the shuffle.  Counts go back to the
documents in two ways: the most frequent pairs, ``HEAD`` at most whatever the
corpus, travel to the tasks; documents with other pairs join those by a shuffle.

Results for odd inputs: texts that are null, empty, or that one side does not
give back byte by byte (say a text with U+2581, which B reads as a space) have no
tokens: zeros and empty groups.  Strings of special tokens are plain text.  Long
texts are aligned whole.  Each row is a document of its own, so repeated rows and
repeated ids count as often as they stand there; columns beside id and text are
ignored; an empty table gives no rows.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexis.llm.bytelevel import ByteLevel
from lexis.llm.common import give_back, id_and_text, per_worker, text_chunks
from lexis.session import ensure_checkpoint_dir, written

HEAD = 1 << 20       # most frequent pairs that travel to the tasks, at most
TEXT_BYTES = 3_000_000   # text aligned at once
RUN = 500            # segments encoded in one call
PENDING = 1 << 21    # pairs a task counts before it merges them

NO_CUT = re.compile(r"\s ")            # a space that does not follow a visible character
CUT = re.compile(r"(?<=\S)(?= )")


class Aligner:
    """Both tokenizers, and the alignment of many segments at once."""

    def __init__(self, a_spec: str, b_model: bytes):
        import numpy as np
        import sentencepiece

        a = ByteLevel(a_spec, special=False)
        self.encode_a, self.bytes_a = a.ids, a.bytes
        self.b = sentencepiece.SentencePieceProcessor(model_proto=b_model)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()
                        for i, p in enumerate(pieces)]
        self.space = pieces.index("▁") if "▁" in pieces else None
        # a piece that runs from a character into a space forbids cuts
        self.cuts = self.space is not None and not any(re.search("[^▁]▁", p) for p in pieces)
        self.size_a = np.array([len(x) for x in self.bytes_a])
        self.size_b = np.array([len(x) for x in self.bytes_b])
        self.names = [f"{i}{end}" for i in range(max(len(self.bytes_a), len(self.bytes_b))) for end in ",|;"]
        self.name_size = np.array([len(x) for x in self.names])

    def segments(self, text: str) -> list[str]:
        """Parts of space + text without their first space."""
        if not text:
            return []
        if not self.cuts:
            return [text]
        if NO_CUT.search(" " + text) is None:
            return text.split(" ")
        return [s[1:] for s in CUT.split(" " + text)]

    def _encode(self, runs: list[list[str]]) -> tuple[list, list, list[bool]]:
        """Ids of A and of B of each run of segments, and whether both give its bytes back."""
        texts = [" ".join(r) for r in runs]
        ids_a = [self.encode_a(" " + t) for t in texts]
        ids_b = self.b.encode(texts, out_type=int, num_threads=1)
        ids_b = [b if t else [self.space] for t, b in zip(texts, ids_b, strict=True)]
        good = []
        for t, a, b in zip(texts, ids_a, ids_b):
            raw = (" " + t).encode()
            good.append(b"".join(map(self.bytes_a.__getitem__, a)) == raw
                        and b"".join(map(self.bytes_b.__getitem__, b)) == raw)
        return ids_a, ids_b, good

    def align(self, parts: list[str]):
        """Of distinct segments: those that a side does not give back; the others in their order
        here, and for each of them numbers of ids of A, of B, groups; texts of the groups; codes of its links, and
        where those of each segment end."""
        from itertools import chain

        import numpy as np

        # segments are encoded in runs; one that ends with white space would meet the next one's space
        plain = [p for p in parts if self.cuts and p and not p[-1].isspace()]
        runs = [plain[i:i + RUN] for i in range(0, len(plain), RUN)]
        if len(plain) < len(parts):
            runs += [[p] for p in parts if not (self.cuts and p and not p[-1].isspace())]
        ids_a, ids_b, good = self._encode(runs)
        bad: set[str] = set()
        if not all(good):
            again = [[p] for r, g in zip(runs, good) if not g for p in r]
            single = self._encode(again)
            bad = {p for (p,), g in zip(again, single[2]) if not g}
            keep = [[x for x, g in zip(k, good) if g] + [x for x, g in zip(m, single[2]) if g]
                    for k, m in ((ids_a, single[0]), (ids_b, single[1]))]
            (ids_a, ids_b), runs = keep, [r for r, g in zip(runs, good) if g] + [r for r, g in zip(again, single[2]) if g]
        order = list(chain.from_iterable(runs))
        a, b = (np.fromiter(chain.from_iterable(ids), np.int64, sum(map(len, ids))) for ids in (ids_a, ids_b))
        end_a, end_b = np.cumsum(self.size_a[a]), np.cumsum(self.size_b[b])
        place_a = dict(zip(end_a.tolist(), range(1, len(a) + 1)))
        place_b = dict(zip(end_b.tolist(), range(1, len(b) + 1)))
        shared = sorted(place_a.keys() & place_b.keys())
        upto_a = np.fromiter(map(place_a.__getitem__, shared), np.int64, len(shared))   # tokens up to a group's end
        upto_b = np.fromiter(map(place_b.__getitem__, shared), np.int64, len(shared))
        seg_end = np.cumsum([len(p.encode()) + 1 for p in order], dtype=np.int64)
        last = np.searchsorted(shared, seg_end, "right")           # groups up to a segment's end
        # groups as text: ids of A, then of B, each with the character that follows it
        from_a, from_b = np.append(0, upto_a[:-1])[:len(shared)], np.append(0, upto_b[:-1])[:len(shared)]
        token = np.zeros(len(a) + len(b), np.int64)
        token[np.arange(len(a)) + np.repeat(from_b, upto_a - from_a)] = 3 * a
        token[np.arange(len(b)) + np.repeat(upto_a, upto_b - from_b)] = 3 * b
        token[upto_a + from_b - 1] += 1
        token[upto_a + upto_b - 1] += 2
        text = "".join(map(self.names.__getitem__, token.tolist()))
        chars = np.append(0, np.cumsum(self.name_size[token]))
        done = (upto_a + upto_b)[last - 1] if len(shared) else np.zeros(0, np.int64)
        cut = chars[np.append(0, done)].tolist()
        texts = [text[x:y - 1] for x, y in zip(cut, cut[1:])]
        # the ends of both sides cut each group into stretches, and each stretch is one link
        stretch = np.sort(np.concatenate((end_a, end_b)), kind="stable")   # two ascending runs
        stretch = stretch[np.diff(stretch, prepend=0) > 0]
        codes = (a[np.searchsorted(end_a, stretch)] * len(self.bytes_b) + b[np.searchsorted(end_b, stretch)]
                 if len(stretch) else stretch.astype(np.int64))
        counts = [np.diff(x, prepend=0) for x in (upto_a[last - 1], upto_b[last - 1], last)] if len(shared) else [last] * 3
        return bad, order, counts, texts, codes, np.searchsorted(stretch, seg_end, "right")


def _put_together(aligner: Aligner, texts: list[str]):
    """Per text: numbers of ids, groups and links, and groups; its distinct pairs and how often
    each is linked (flat arrays and their ends)."""
    from itertools import chain

    import numpy as np

    segs = [aligner.segments(t) for t in texts]
    bad, order, counts, groups, codes, link_end = aligner.align(list(dict.fromkeys(chain.from_iterable(segs))))
    if bad:   # a side does not give the whole text back: no tokens
        segs = [[] if not bad.isdisjoint(s) else s for s in segs]
    place = dict(zip(order, range(len(order))))
    n = np.fromiter(map(len, segs), np.int64, len(segs))
    at = np.fromiter(map(place.__getitem__, chain.from_iterable(segs)), np.int64, int(n.sum()))
    ends = np.append(0, np.cumsum(n))

    def per_text(values):
        upto = np.append(0, np.cumsum(values[at]))
        return upto[ends[1:]] - upto[ends[:-1]]

    joined = [";".join([groups[i] for i in at[x:y].tolist()]) for x, y in zip(ends.tolist(), ends[1:].tolist())]
    own = np.diff(link_end, prepend=0)
    size = own[at]
    upto = np.append(0, np.cumsum(size))
    code = codes[np.repeat((link_end - own)[at] - upto[:-1], size) + np.arange(upto[-1])]
    links = per_text(own)
    pairs = len(aligner.bytes_a) * len(aligner.bytes_b)   # below 2^63 / documents of a chunk
    key, times = np.unique(np.repeat(np.arange(len(texts)), links) * pairs + code, return_counts=True)
    bound = np.searchsorted(key, np.arange(len(texts) + 1) * pairs)
    return [*map(per_text, counts), links, joined], key % pairs, times, bound


def _aligned(docs: DataFrame, a_spec: str, b_model: bytes, id_col: str, text_col: str) -> DataFrame:
    """A row per document: key, id, numbers, groups, distinct codes of its pairs and their times
    (little-endian unsigned integers of 64 and 32 bits)."""
    src = id_and_text(docs, id_col, text_col)
    schema = T.StructType([T.StructField("key", T.LongType()), src.schema["doc_id"],
                           *[T.StructField(c, T.LongType()) for c in ("n_a", "n_b", "n_groups", "n_links")],
                           T.StructField("groups", T.StringType()), T.StructField("codes", T.BinaryType()),
                           T.StructField("times", T.BinaryType())])

    def run(batches):
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        aligner = per_worker(("align", hash(a_spec), hash(b_model)), lambda: Aligner(a_spec, b_model))
        key = TaskContext.get().partitionId() << 40
        for batch in batches:
            ids = batch.column(0)
            for a, b, texts in text_chunks(batch.column(1), TEXT_BYTES):
                columns, code, times, bound = _put_together(aligner, texts)
                raw, often = code.astype("<u8").tobytes(), times.astype("<u4").tobytes()
                cut = bound.tolist()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(key, key + b - a)), ids.slice(a, b - a), *map(pa.array, columns),
                     pa.array([raw[8 * x:8 * y] for x, y in zip(cut, cut[1:])], pa.binary()),
                     pa.array([often[4 * x:4 * y] for x, y in zip(cut, cut[1:])], pa.binary())],
                    names=schema.names)
                key += b - a
        give_back()

    return src.mapInArrow(run, schema)


def _pair_counts(rows: DataFrame, n_b: int) -> DataFrame:
    """``code, n, best``: documents that hold the pair, and whether no pair of its A id has more."""
    def run(batches):
        import numpy as np
        import pyarrow as pa

        held, waiting = [], 0

        def merged():
            code, where = np.unique(np.concatenate([c for c, _ in held]), return_inverse=True)
            return code, np.bincount(where, np.concatenate([n for _, n in held]), len(code)).astype(np.int64)

        for batch in batches:
            blobs = batch.column(0)
            if not len(blobs):
                continue
            code, n = np.unique(np.frombuffer(b"".join(blobs.to_pylist()), "<u8").astype(np.int64), return_counts=True)
            held.append((code, n))
            waiting += len(code)
            if waiting > PENDING:
                held = [merged()]
                waiting = len(held[0][0])
                if waiting > PENDING // 2:   # distinct ones alone fill the memory: hand them on
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in held[0]], names=["code", "n"])
                    held, waiting = [], 0
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in merged()], names=["code", "n"])

    n = (rows.select("codes").mapInArrow(run, "code long, n long").groupBy("code").agg(F.sum("n").alias("n"))
         .withColumn("a", F.expr(f"code div {n_b}")))
    n = written(n, "pairs")
    most = n.groupBy("a").agg(F.max("n").alias("most"))
    return n.join(most, "a").select("code", "n", (F.col("n") == F.col("most")).alias("best"))


def _least_of_head(counts: DataFrame, head: int) -> int:
    """The smallest power of two such that at most ``head`` pairs have so high a count."""
    by_size = counts.groupBy(F.floor(F.log2("n")).cast("int").alias("p")).agg(F.count(F.lit(1)).alias("c"))
    total, least = 0, 62
    for p, c in sorted(map(tuple, by_size.collect()), reverse=True):   # 63 rows at most
        total += c
        if total > head:
            break
        least = p
    return 1 << least


def align(docs: DataFrame, a_tokenizer: str, b_tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
          derive: dict[str, Column] | None = None, head: int = HEAD) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum`` and ``groups``
    (``a1,a2|b1;a3|b2,b3``) of every document.

    ``a_tokenizer`` and ``b_tokenizer`` are paths on the driver.  ``derive`` replaces
    ``groups`` by columns computed from it, so that long groups need not be stored.
    ``n_best``: links whose pair no other pair of their A id exceeds; ``count_sum``: the
    counts of all links, added up."""
    import uuid

    import sentencepiece

    spark = docs.sparkSession
    a_spec = open(a_tokenizer, encoding="utf-8").read()    # 2 MB and 0.5 MB: travel with the tasks
    b_model = open(b_tokenizer, "rb").read()
    n_b = sentencepiece.SentencePieceProcessor(model_proto=b_model).get_piece_size()
    derive = derive or {"groups": F.col("groups")}
    numbers = ["n_a", "n_b", "n_groups", "n_links"]
    rows = _aligned(docs, a_spec, b_model, id_col, text_col).select(
        "key", "doc_id", *numbers, *[c.alias(name) for name, c in derive.items()], "codes", "times")
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/lexis-aligned-{uuid.uuid4().hex}"
    rows.write.option("compression", "zstd").parquet(path)
    rows = spark.read.schema(rows.schema).parquet(path)
    counts = written(_pair_counts(rows, n_b), "counts")
    least = _least_of_head(counts, head)
    top = counts.where(F.col("n") >= least).orderBy("code").toArrow()   # ``head`` rows at most
    code, n, best = (top.column(k).to_numpy() for k in range(3))
    out = rows.select("key", "doc_id", *numbers, *derive, "codes", "times")
    schema = T.StructType([*[f for f in out.schema if f.name not in ("codes", "times")],
                           T.StructField("n_best", T.LongType()), T.StructField("count_sum", T.LongType())])

    def opened(batch):
        """(document of each pair, code, times) of a batch."""
        import numpy as np

        column = lambda k: batch.column(batch.schema.get_field_index(k)).to_pylist()
        codes, times = column("codes"), column("times")
        where = np.repeat(np.arange(len(codes)), np.fromiter((len(x) // 8 for x in codes), np.int64, len(codes)))
        return (where, np.frombuffer(b"".join(codes), "<u8").astype(np.int64),
                np.frombuffer(b"".join(times), "<u4").astype(np.int64))

    def look_up(wanted):
        """(place in the head, is it there)"""
        import numpy as np

        if not len(code):
            return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
        at = np.minimum(np.searchsorted(code, wanted), len(code) - 1)
        return at, code[at] == wanted

    def from_head(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            where, wanted, times = opened(batch)
            at, there = look_up(wanted)
            at, there, times = at[there], where[there], times[there]
            sums = []
            for value in (best.astype(np.int64), n):
                total = np.zeros(batch.num_rows, np.int64)
                np.add.at(total, there, times * value[at])
                sums.append(total)
            yield pa.RecordBatch.from_arrays(
                [batch.column(batch.schema.get_field_index(k)) for k in schema.names[:-2]] + [pa.array(s) for s in sums],
                names=schema.names)

    found = out.mapInArrow(from_head, schema)
    if least > 1:   # pairs outside the head
        def outside(batches):
            import pyarrow as pa

            for batch in batches:
                where, wanted, times = opened(batch)
                rest = ~look_up(wanted)[1]
                keys = batch.column(batch.schema.get_field_index("key")).to_numpy()
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (keys[where[rest]], wanted[rest], times[rest])],
                                                 names=["key", "code", "times"])

        tail = (out.select("key", "codes", "times").mapInArrow(outside, "key long, code long, times long")
                .join(counts.where(F.col("n") < least), "code").groupBy("key")
                .agg(F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("more_best"),
                     F.sum(F.col("times") * F.col("n")).alias("more_sum")))
        found = found.join(tail, "key", "left").withColumns({
            "n_best": F.col("n_best") + F.coalesce("more_best", F.lit(0)),
            "count_sum": F.col("count_sum") + F.coalesce("more_sum", F.lit(0))})
    return found.select("doc_id", *numbers, "n_best", "count_sum", *derive)
