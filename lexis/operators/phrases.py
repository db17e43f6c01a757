"""Many phrases against every sentence (J8, C18): one automaton over token ids.

Phrases of at most ``block_bytes`` form one trie with failure links, built in each
task, and every token stream runs through it once.  More phrases never meet in one
task: the streams' runs of tokens are joined to them.  Streams are cut into segments
that overlap by the longest phrase, so a stream of any length spreads over tasks; a
match belongs to the segment in which it starts.
"""

from __future__ import annotations

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexis.operators.mentions import mentions
from lexis.session import written

BLOCK_BYTES = 2 << 20  # phrases of one automaton, which every task builds


def _automaton(phrases: list[str]):
    """The automaton over token ids, and the tokens whose ids count from 1."""
    import ahocorasick
    split = [p.split(" ") for p in phrases]
    ids = {w: k for k, w in enumerate(sorted({w for ws in split for w in ws}), 1)}
    found = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
    for n, ws in enumerate(split):
        found.add_word(tuple(ids[w] for w in ws), (n, len(ws)))
    found.make_automaton()
    return found, pa.array(list(ids), pa.string())


def _scan(phrases: list[str]):
    def run(batches):
        found, vocabulary = _automaton(phrases)
        names = pa.array(phrases, pa.string())
        for b in batches:
            texts = b.column("texts")
            # a token that no phrase has gets 0 and sends the automaton to its root
            ids = pc.fill_null(pc.add(pc.index_in(texts.flatten(), value_set=vocabulary), 1), 0).to_pylist()
            bounds = texts.offsets.to_numpy() - texts.offsets[0].as_py()
            begin, own = b.column("begin").to_pylist(), b.column("own").to_pylist()
            rows, which, starts = [], [], []
            for r in range(b.num_rows):
                for end, (n, size) in found.iter(tuple(ids[bounds[r]:bounds[r + 1]])):
                    at = end - size + 1
                    if at < own[r]:
                        rows.append(r)
                        which.append(n)
                        starts.append(begin[r] + at)
            yield pa.RecordBatch.from_arrays(
                [b.column("sent_id").take(pa.array(rows, pa.int64())), names.take(pa.array(which, pa.int64())),
                 pa.array(starts, pa.int64())], ["sent_id", "phrase", "start"])
    return run


def find_phrases(phrases: DataFrame, tokens: DataFrame, segment: int = 1024, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """All places of all phrases: ``sent_id, phrase, start``, overlapping ones too.

    ``phrases(phrase)`` are words with one space between them, repeats count once, nulls are
    none; ``tokens(sent_id, i, text)`` count ``i`` = 1, 2, ... within a sentence, ``sent_id``
    is a long; a null token matches nothing; tokens without ``sent_id`` or ``i`` are left out; without
    phrases or tokens there are no rows."""
    schema = "sent_id long, phrase string, start long"
    known = written(phrases.select("phrase").where("phrase is not null").distinct(), "phrases")
    total, longest = known.agg(F.sum(F.octet_length("phrase") + 1), F.max(F.size(F.split("phrase", " ")))).first()
    if total is None:
        return tokens.sparkSession.createDataFrame([], schema)
    segment = max(segment, longest)
    at = F.col("i") - 1
    own = F.floor(at / segment)
    # a segment's first tokens end the matches that start in the one before
    into = F.when((own > 0) & (at - own * segment < longest - 1), F.array(own, own - 1)).otherwise(F.array(own))
    packed = (tokens.where(F.col("sent_id").isNotNull() & F.col("i").isNotNull())
              .select(F.col("sent_id").cast("long").alias("sent_id"), "i", "text", F.explode(into).alias("seg"))
              .groupBy("sent_id", "seg").agg(F.sort_array(F.collect_list(F.struct("i", "text"))).alias("s"))
              .select("sent_id", (F.col("seg") * segment + 1).alias("begin"), F.lit(segment).alias("own"), F.col("s.text").alias("texts")))
    if total <= block_bytes:
        block = [r[0] for r in known.collect()]
        return packed.mapInArrow(_scan(sorted(block)), schema)
    return _joined(known, packed)


def _joined(known: DataFrame, packed: DataFrame) -> DataFrame:
    """More phrases than one task should hold: each segment's runs of as many tokens as
    some phrase has, joined to the phrases.  The number of tokens is part of the key, so
    a token with a space in it equals no two words."""
    keyed = known.select("phrase", F.size(F.split("phrase", " ")).alias("n"))
    sizes = F.array([F.lit(r[0]) for r in keyed.select("n").distinct().orderBy("n").collect()])
    starts = F.sequence(F.lit(1), F.least(F.col("own"), F.size("texts")).cast("int"))
    # a null token becomes a space, which makes more words of the run
    run = lambda at, n: F.struct(at.alias("at"), n.alias("n"), F.when(
        at + n - 1 <= F.size("texts"), F.array_join(F.slice("texts", at, n), " ", " ")).alias("phrase"))
    runs = (packed.select("sent_id", "begin", F.inline(F.flatten(F.transform(
        starts, lambda at: F.transform(sizes, lambda n: run(at, n))))))
            .where(F.col("phrase").isNotNull())
            .select("sent_id", (F.col("begin") + F.col("at") - 1).cast("long").alias("start"), "n", "phrase"))
    return runs.join(keyed, ["n", "phrase"]).select("sent_id", "phrase", "start")


def first_spans(rel: DataFrame, tokens: DataFrame) -> DataFrame:
    """J8 as ``mentions.span_matches`` finds it: ``sent_id, ord, phrase, start, tags`` of the
    first span equal to each of a sentence's own phrases."""
    own = mentions(rel)
    first = (find_phrases(own, tokens).join(own, ["sent_id", "phrase"])
             .groupBy("sent_id", "ord", "phrase").agg(F.min("start").alias("start")))
    covered = first.withColumn("i", F.explode(F.sequence("start", F.col("start") + F.size(F.split("phrase", " ")) - 1)))
    tags = tokens.select("sent_id", F.col("i").cast("long").alias("i"), "tag")
    return (covered.join(tags, ["sent_id", "i"]).groupBy("sent_id", "ord", "phrase", "start")
            .agg(F.sort_array(F.collect_list(F.struct("i", "tag"))).alias("s"))
            .select("sent_id", "ord", "phrase", F.col("start").cast("int").alias("start"), F.col("s.tag").alias("tags")))
