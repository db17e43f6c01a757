"""Viterbi decoding of sequences longer than a row (C14): segments as matrices.

A sequence is cut into segments of ``segment`` tokens, each a row.  In the
(max, +) semiring a segment is a K x K matrix: the best score of entering it
after state i and leaving it in state j.  Matrices are multiplied in blocks of
``fan`` up a tree and the scores at each segment's entry are handed down again,
so every segment is then decoded on its own with exact entry scores.  Decoding
gives a map from a segment's last state to the state before its first token;
the maps compose up and down the same tree, which fixes every segment's last
state, and a last pass follows the back-pointers.  No task ever holds more than
a segment, or a running product.

Scores are whole numbers of 1e-9, the precision of the model's log
probabilities, so that additions in any order agree and the path is that of
decoding from left to right; ties go to the smallest tag name, as in ``hmm``.
"""

from __future__ import annotations

from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexis.operators.hmm import DIGITS, FLOOR
from lexis.plans.sizing import bounded_broadcast
from lexis.session import written

UNIT = 10 ** DIGITS
LOW = int(FLOOR) * UNIT
MAX_SEGMENT = 4096   # a segment's score stays within 64 bits
MAX_STATES = 64      # a matrix stays within 32 KB
CELLS = 1 << 21      # emission cells, and products, held at once in a task


def _units(c):
    return F.round(c * UNIT).cast("long")


def _states(model: dict) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Sorted tag names, start vector and transition matrix; at most MAX_STATES are read."""
    tags = (model["emission"].select("tag").union(model["start"].select("tag"))
            .union(model["transition"].select("prev")).union(model["transition"].select("tag")).distinct())
    names = sorted(r[0] for r in tags.limit(MAX_STATES + 1).collect())
    if len(names) > MAX_STATES:
        raise ValueError(f"more than {MAX_STATES} tags")
    at = {t: k for k, t in enumerate(names)}
    start = np.full(len(names), LOW, np.int64)
    for r in model["start"].select("tag", _units(F.col("logp"))).collect():
        start[at[r[0]]] = r[1]
    trans = np.full((len(names), len(names)), LOW, np.int64)
    for r in model["transition"].select("prev", "tag", _units(F.col("logp"))).collect():
        trans[at[r[0]], at[r[1]]] = r[2]
    return names, start, trans


def _emissions(batch: pa.RecordBatch, k: int) -> tuple[np.ndarray, np.ndarray]:
    """All tokens' emission rows one below the other, and each segment's bounds."""
    col = batch.column("codes")
    bounds, tokens = col.offsets.to_numpy() - col.offsets[0].as_py(), col.flatten()
    of_token = np.diff(tokens.offsets.to_numpy())
    rows = np.full((bounds[-1], k), LOW, np.int64)
    where = np.repeat(np.arange(len(of_token)), of_token)
    codes = tokens.flatten().to_numpy()
    rows[where, codes % MAX_STATES] = codes // MAX_STATES
    return rows, bounds


def _chunks(bounds: np.ndarray, cells: int):
    """Segment numbers by falling length, in groups whose padded rows stay within ``cells``."""
    order = np.argsort(-np.diff(bounds), kind="stable")
    i = 0
    while i < len(order):
        longest = max(1, int(bounds[order[i] + 1] - bounds[order[i]]))
        n = max(1, cells // longest)
        yield order[i:i + n]
        i += n


def _forward(enter, first, rows, bounds, chunk, start, trans, pointers=False):
    """Scores after the last token of each segment of ``chunk`` (falling lengths).

    ``enter`` is (segments, rows, K): scores before the first token, ignored where
    ``first``.  With ``pointers`` also the best predecessors, per token and state."""
    sizes = (bounds[1:] - bounds[:-1])[chunk]
    v = enter.copy()
    back = np.zeros((int(sizes[0]), len(chunk), len(start)), np.int16) if pointers else None
    for t in range(int(sizes[0])):
        n = int(np.searchsorted(-sizes, -t, side="left"))   # segments longer than t
        e = rows[bounds[:-1][chunk[:n]] + t][:, None, :]
        step = v[:n, :, :, None] + trans
        if pointers:
            back[t, :n] = step[:, 0].argmax(axis=1)
        v[:n] = step.max(axis=2) + e
        if t == 0:
            v[:n][first[:n]] = (start + e)[first[:n]]
    return v, back


def _level(v: np.ndarray) -> bytes:
    return (v - v.max()).tobytes()


def _product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a[:, :, None] + b[None]).max(axis=1)


def _matrices(segments: DataFrame, start, trans) -> DataFrame:
    """``sent_id, idx, m``: every segment's matrix, its largest entry at 0."""
    k = len(start)

    def run(batches):
        for b in batches:
            if not b.num_rows:
                continue
            rows, bounds = _emissions(b, k)
            first = b.column("idx").to_numpy() == 0
            out = [None] * b.num_rows
            for c in _chunks(bounds, max(1, CELLS // k ** 3)):
                # before the first token: state i is certain, so only row i of trans counts
                same = np.where(np.eye(k, dtype=bool), 0, 4 * LOW)[None].repeat(len(c), axis=0)
                v, _ = _forward(same, first[c], rows, bounds, c, start, trans)
                for i, s in enumerate(c):
                    out[s] = _level(v[i])
            yield pa.RecordBatch.from_arrays([b.column("sent_id"), b.column("idx"), pa.array(out, pa.binary())],
                                             ["sent_id", "idx", "m"])
    return segments.select("sent_id", "idx", "codes").mapInArrow(run, "sent_id long, idx long, m binary")


def _in_blocks(df: DataFrame, fan: int) -> DataFrame:
    """Rows of one block of ``fan`` together and in order."""
    return (df.withColumn("blk", F.floor(F.col("idx") / fan)).repartition("sent_id", "blk")
            .sortWithinPartitions("sent_id", "blk", "idx"))


def _products(mats: DataFrame, fan: int, k: int) -> DataFrame:
    """One level up: a matrix per block."""
    def run(batches):
        key, acc = None, None
        for b in batches:
            done = []
            for sent, blk, m in zip(*(b.column(c).to_pylist() for c in ("sent_id", "blk", "m"))):
                m = np.frombuffer(m, np.int64).reshape(k, k)
                if (sent, blk) == key:
                    acc = _product(acc, m)
                    acc = acc - acc.max()
                else:
                    if key is not None:
                        done.append((*key, acc.tobytes()))
                    key, acc = (sent, blk), m
            yield _rows(done, ["sent_id", "idx", "m"])
        if key is not None:
            yield _rows([(*key, acc.tobytes())], ["sent_id", "idx", "m"])
    return _in_blocks(mats, fan).mapInArrow(run, "sent_id long, idx long, m binary")


def _rows(rows: list, names: list) -> pa.RecordBatch:
    cols = list(zip(*rows)) if rows else [[], [], []]
    return pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()),
                                       pa.array(cols[2], pa.binary())], names)


def _entries(mats: DataFrame, blocks: DataFrame, fan: int, k: int) -> DataFrame:
    """One level down: ``sent_id, idx, v`` from the entry vectors ``v`` of the blocks."""
    def run(batches):
        key, v = None, None
        for b in batches:
            out = []
            for sent, blk, idx, m, enter in zip(*(b.column(c).to_pylist() for c in ("sent_id", "blk", "idx", "m", "v"))):
                if (sent, blk) != key:
                    key, v = (sent, blk), np.frombuffer(enter, np.int64)
                out.append((sent, idx, v.tobytes()))
                v = (v[:, None] + np.frombuffer(m, np.int64).reshape(k, k)).max(axis=0)
                v = v - v.max()
            yield _rows(out, ["sent_id", "idx", "v"])
    above = blocks.select("sent_id", F.col("idx").alias("blk"), "v")
    x = mats.withColumn("blk", F.floor(F.col("idx") / fan)).join(above, ["sent_id", "blk"])
    return _in_blocks(x, fan).mapInArrow(run, "sent_id long, idx long, v binary")


def _entry_scores(mats: DataFrame, last: int, fan: int, k: int) -> DataFrame:
    """Scores at every segment's entry: products up the tree, vectors down."""
    levels = [mats]
    while last >= fan:
        levels.append(_products(levels[-1], fan, k))
        last //= fan
    # before a sequence's first token no state counts: its matrix has equal rows
    top = mats.where("idx = 0").select("sent_id", "idx", F.lit(np.zeros(k, np.int64).tobytes()).alias("v"))
    for level in reversed(levels):
        top = _entries(level, top, fan, k)
    return top


def _decode(segments: DataFrame, start, trans, follow: bool) -> DataFrame:
    """Decode segments from their entry scores ``v``.

    ``follow=False``: ``sent_id, idx, gain, best, before``: the highest score, its state, and the
    state before the segment for every last state.  ``follow=True``: ``sent_id, idx, gain, path``,
    the states up to the last state ``out`` (null: the best one)."""
    k = len(start)

    def run(batches):
        for b in batches:
            if not b.num_rows:
                continue
            rows, bounds = _emissions(b, k)
            first = b.column("idx").to_numpy() == 0
            enter = b.column("v").to_pylist()
            outs = b.column("out").to_pylist()
            gain, best, lists = ([None] * b.num_rows for _ in range(3))
            for c in _chunks(bounds, max(1, CELLS // k)):
                v0 = np.stack([np.zeros(k, np.int64) if enter[s] is None else np.frombuffer(enter[s], np.int64) for s in c])
                v, back = _forward(v0[:, None, :], first[c], rows, bounds, c, start, trans, pointers=True)
                for i, s in enumerate(c):
                    end, ptr = v[i, 0], back[:bounds[s + 1] - bounds[s], i]
                    gain[s], best[s] = int(end.max()), int(end.argmax())
                    if follow:
                        path = [best[s] if outs[s] is None else outs[s]]
                        for t in range(len(ptr) - 1, 0, -1):
                            path.append(int(ptr[t, path[-1]]))
                        lists[s] = path[::-1]
                    else:
                        cur = np.arange(k)
                        for t in range(len(ptr) - 1, -1, -1):
                            cur = ptr[t, cur]
                        lists[s] = cur
            cols = [b.column("sent_id"), b.column("idx"), pa.array(gain, pa.int64())]
            cols += [] if follow else [pa.array(best, pa.int32())]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(lists, pa.list_(pa.int32()))], schema)
    schema = ["sent_id", "idx", "gain", "path"] if follow else ["sent_id", "idx", "gain", "best", "before"]
    types = "sent_id long, idx long, gain long, " + ("path array<int>" if follow else "best int, before array<int>")
    return segments.select("sent_id", "idx", "codes", "v", "out").mapInArrow(run, types)


def _last_states(maps: DataFrame, last: int, fan: int) -> DataFrame:
    """``sent_id, idx, out``: every segment's last state on the best path."""
    def blocks(level):
        return (level.groupBy("sent_id", F.floor(F.col("idx") / fan).alias("blk"))
                .agg(F.array_sort(F.collect_list(F.struct("idx", "before"))).alias("s")))

    levels, n = [maps.select("sent_id", "idx", "before")], last
    while n >= fan:
        levels.append(blocks(levels[-1]).select("sent_id", F.col("blk").alias("idx"), F.aggregate(
            F.reverse("s.before"), F.transform(F.element_at("s.before", 1), lambda _, i: i),
            lambda acc, m: F.transform(acc, lambda x: F.get(m, x))).alias("before")))
        n //= fan
    out = maps.groupBy("sent_id").agg(F.max_by("best", "idx").alias("out")).select("sent_id", F.lit(0).cast("long").alias("idx"), "out")
    for level in reversed(levels):
        x = blocks(level).join(out.select("sent_id", F.col("idx").alias("blk"), "out"), ["sent_id", "blk"])
        # the block's last state first, then the state before each of its segments, last one first
        chain = F.aggregate(F.reverse("s.before"), F.array("out"),
                            lambda acc, m: F.array_append(acc, F.get(m, F.element_at(acc, -1))))
        x = x.select("sent_id", "s", F.reverse(F.slice(chain, 1, F.size("s"))).alias("outs"))
        out = (x.select("sent_id", F.explode(F.arrays_zip(F.col("s.idx").alias("idx"), "outs")).alias("z"))
               .select("sent_id", F.col("z.idx").alias("idx"), F.col("z.outs").alias("out")))
    return out


def tag_long(sequences: DataFrame, model: dict, word_col: str = "word", keep: str | None = None,
             segment: int = 512, fan: int = 64) -> DataFrame:
    """``sent_id, pos, tag, score`` (and ``keep``) from ``sent_id, pos, <word_col>``.

    ``sent_id`` is a long and ``pos`` counts 1, 2, ... within it; a sequence may have any number
    of tokens.  ``score`` is the exact log2 probability, decimal(38, 9), a zero probability
    counting -1e6.  A null word is one that the model does not know; rows without ``sent_id`` or
    ``pos`` have no place and are left out; an empty table, or a model without tags, gives no rows."""
    if not 1 <= segment <= MAX_SEGMENT or fan < 2:
        raise ValueError(f"segment must lie in 1..{MAX_SEGMENT} and fan be 2 or more")
    names, start, trans = _states(model)
    kept = keep or word_col
    at = F.create_map(*[F.lit(x) for k, t in enumerate(names) for x in (t, k)]) if names else F.create_map().cast("map<string,int>")
    by_word = (model["emission"].groupBy("word")
               .agg(F.collect_list(_units(F.col("logp")) * MAX_STATES + F.try_element_at(at, F.col("tag"))).alias("em")))
    nothing = F.array().cast("array<bigint>")   # an emission is one number: units * MAX_STATES + state
    toks = (sequences.where(F.col("sent_id").isNotNull() & F.col("pos").isNotNull())
            .select(F.col("sent_id").cast("long").alias("sent_id"), F.col("pos").cast("long").alias("pos"),
                    F.col(word_col).alias("_word"), F.col(kept).alias("kept"))
            .join(bounded_broadcast(by_word.withColumnRenamed("word", "_word"))[0], "_word", "left")
            .withColumn("em", F.coalesce("em", nothing)))
    grouped = toks.groupBy("sent_id", F.floor((F.col("pos") - 1) / segment).alias("idx")).agg(F.array_sort(
        F.collect_list(F.struct("pos", "em", "kept")), lambda a, b: F.when(a["pos"] < b["pos"], -1).otherwise(1)).alias("s"))
    segments = written(grouped.select("sent_id", "idx", F.col("s.kept").alias("kept"),
                                      F.col("s.em").alias("codes")), "viterbi-segments")
    last = segments.agg(F.max("idx")).first()[0]
    total = F.col("gain").cast("decimal(38,0)")
    no_entry, no_exit = F.lit(None).cast("binary"), F.lit(None).cast("int")
    if not names or last is None:
        tagged = segments.select("sent_id", "idx", "kept", no_exit.cast("long").alias("gain"), F.array().cast("array<int>").alias("path"),
                                 F.lit(None).cast("decimal(38,0)").alias("total")).where("false")
    elif last == 0:
        paths = _decode(segments.withColumns({"v": no_entry, "out": no_exit}), start, trans, True)
        tagged = segments.join(paths, ["sent_id", "idx"]).withColumn("total", total)
    else:
        # only sequences of several segments climb the tree
        long_ids = segments.where("idx = 1").select("sent_id")
        several = segments.join(long_ids, "sent_id", "left_semi")
        mats = written(_matrices(several, start, trans), "viterbi-matrices")
        entries = written(_entry_scores(mats, last, fan, len(names)), "viterbi-entries")
        maps = written(_decode(several.join(entries, ["sent_id", "idx"]).withColumn("out", no_exit), start, trans, False),
                       "viterbi-maps")
        outs = entries.join(_last_states(maps, last, fan), ["sent_id", "idx"])
        paths = _decode(segments.join(outs, ["sent_id", "idx"], "left"), start, trans, True)
        totals = maps.groupBy("sent_id").agg(F.sum(total).alias("sum"))
        tagged = (segments.join(paths, ["sent_id", "idx"]).join(totals, "sent_id", "left")
                  .withColumn("total", F.coalesce("sum", total)))
    # 28 + 9 digits and one more: a product that Spark does not round
    score = (F.col("total").cast("decimal(28,0)") * F.lit(str(Decimal(1).scaleb(-DIGITS))).cast("decimal(9,9)")).alias("score")
    name_of = F.array(*[F.lit(t) for t in names]).cast("array<string>")
    out = tagged.select("sent_id", "idx", score, F.posexplode(F.arrays_zip("path", "kept")).alias("p", "z"))
    cols = [F.col("z.kept").alias(keep)] if keep else []
    return out.select("sent_id", (F.col("idx") * segment + F.col("p") + 1).cast("int").alias("pos"),
                      F.get(name_of, F.col("z.path")).alias("tag"), "score", *cols)
