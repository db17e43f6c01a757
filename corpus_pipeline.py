"""The training-data pipeline: five stages, each one operator of ``lexis.llm``.

Every stage takes the documents its predecessor kept and returns the columns of
documents; the last returns the encoded corpus.  ``run`` writes what a stage
returns as Parquet in the shared folder and hands the written table on.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexis.llm import bpe as bpe_operator
from lexis.llm import decontaminate as decontaminate_operator
from lexis.llm import linededup, simhash
from lexis.llm import toxicity as toxicity_operator
from lexis.llm.common import free_name, read
from lexis.llm.queries import tokenizer_path
from lexis.session import written


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below 0.5 (labels with crc32(doc_id) mod 5 = 0 never teach).

    Rows are judged by their text alone: repeated rows share their fate, a null text is scored as an
    empty one, rows with null ids stay or go by their score; without labels of both classes
    all rows score the share of toxic labels; an empty table stays empty."""
    part = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5
    model = toxicity_operator.fit(docs, read(spark, sf_dir, "labels").where(part != 0))
    return docs.where(toxicity_operator.scorer(model)(F.coalesce("text", F.lit(""))) < 0.5)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without later copies of line runs of 50 words and more.

    Documents that lose all their words go, others that lose lines get their new n_chars; the
    earlier copy is that of the smaller id, then of the smaller hash of id and text, then the
    earlier line; of rows that repeat id and text the first keeps its lines; null and empty
    texts stay; an empty table stays empty."""
    out = linededup.dedup_lines(docs, min_words=50)
    return out.select(*[F.when(F.size(out.columns[-1]) > 0, F.length("text")).otherwise(F.col(c)).cast("long").alias(c)
                        if c == "n_chars" else F.col(c) for c in docs.columns])


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the one with the smallest id.

    Of rows that share this id and differ in text the one with the smaller hash stays, repeated
    rows stay once, rows with a null id always; null, empty and white-space texts are one
    group; an empty table stays empty."""
    return simhash.keep_one(docs, words=3, max_bits=2, seed=42)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a 10-word window of a benchmark item.

    Rows are told apart by id and text, so of rows that share an id only those with a hit go,
    and repeated rows share their fate; null and empty texts stay; items that are null or without
    words test nothing; an empty table, or an empty benchmark, changes nothing."""
    key = free_name(docs, "_key")   # 128 bits of id and text
    keyed = docs.withColumn(key, F.concat_ws(":", F.xxhash64("doc_id", "text"), F.xxhash64(F.lit(1), "doc_id", "text")))
    index = decontaminate_operator.build_index(keyed, window=10, id_col=key)
    found = decontaminate_operator.find(index, read(spark, sf_dir, "benchmark"), window=10)
    hit = found.where("n_hit > 0").select(F.col("doc_id").alias(key)).distinct()
    return keyed.join(hit, key, "left_anti").drop(key)


def bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids and decoded text of every document that is left, as digests.

    A row per row: null and empty texts have no tokens, repeated rows each get theirs; an
    empty table gives no rows."""
    out = bpe_operator.round_trip(docs, tokenizer_path("word_bpe_49k.json"))
    return out.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                      F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [("toxicity", toxicity), ("line_dedup", line_dedup), ("simhash_dedup", simhash_dedup),
          ("decontaminate", decontaminate), ("bpe", bpe)]

# XXH64 fingerprints, compression distances and BPE are no SQL: tests/llm/test_llm_pipeline.py compares
# run() with plain versions of the stages
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
