"""One registered query per operator: the operator over its whole table, with
production parameters; digest columns are derived from its outputs here."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexis.llm.common import count_kind, read, span_text


def tokenizer_path(name: str) -> str:
    """The place of a public tokenizer file."""
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op1_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document."""
    from lexis.llm import secrets

    found = secrets.find_secrets(read(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["kind"] != "checksum")
    return found.select("doc_id", *[count_kind(F.col("spans"), k).alias(f"n_{k}") for k in ("assign", "access", "hex")],
                        F.sha2(span_text(base), 256).alias("base_sha256"), span_text(F.col("spans")).alias("spans"))


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded with the word-end BPE vocabulary, and decoded."""
    from lexis.llm import bpe

    out = bpe.round_trip(read(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"))
    return out.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                      F.sha2("decoded", 256).alias("decoded_sha256"))


def op3_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 nearest rows of each row whose id is divisible by 100."""
    from lexis.llm import neighbours

    rows = read(spark, sf_dir, "embeddings")
    return neighbours.nearest(rows, rows.where("vec_id % 100 = 0"), k=10)


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's byte-level token ids, written to ORC files and read back."""
    import uuid

    from lexis.llm import tokenfiles
    from lexis.session import ensure_checkpoint_dir

    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/lexis-tokens-{uuid.uuid4().hex}"
    tokenfiles.write_tokens(read(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"), path, end_id=2)
    return tokenfiles.documents_of(spark, path)


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document."""
    from lexis.llm import pii

    found = pii.find_pii(read(spark, sf_dir, "documents"))
    order = F.array(*[F.lit(k) for k in (*pii.KINDS, *(k + "_ctx" for k in pii.KINDS))])
    place = lambda s: F.struct(s["start"].alias("start"), F.array_position(order, s["kind"]).alias("place"),
                               s["end"].alias("end"), s["kind"].alias("kind"))
    every = F.array_sort(F.transform(F.concat("spans", "found"), place))
    return found.select("doc_id", *[count_kind(F.col("spans"), k).alias(f"n_{k}") for k in pii.KINDS],
                        F.sha2(span_text(F.col("spans")), 256).alias("base_sha256"), span_text(every).alias("spans"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's toxicity; rows with crc32(doc_id) mod 5 = 0 never teach."""
    from lexis.llm import toxicity

    part = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5
    docs = read(spark, sf_dir, "documents")
    model = toxicity.fit(docs, read(spark, sf_dir, "labels").where(part != 0))
    return toxicity.score(docs, model).select(
        "doc_id", F.coalesce(part == 0, F.lit(False)).alias("held_out"), F.col("toxicity").alias("score"),
        (F.col("toxicity") >= 0.5).cast("int").alias("predicted"), F.col("worst").alias("worst_window"))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of 3-word shingles, linked at 2 or fewer differing bits."""
    from lexis.llm import simhash

    found = simhash.near_duplicates(read(spark, sf_dir, "documents"), words=3, max_bits=2, seed=42)
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document inside a 10-word window of a benchmark item."""
    from lexis.llm import decontaminate

    index = decontaminate.build_index(read(spark, sf_dir, "documents"), window=10)
    found = decontaminate.find(index, read(spark, sf_dir, "benchmark"), window=10)
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
                        (F.col("n_hit") > 0).alias("contaminated"))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document after deleting later copies of line runs of 50+ words; a later copy may
    overlap the first, so lines that repeat in place collapse."""
    from lexis.llm import linededup

    out = linededup.dedup_lines(read(spark, sf_dir, "documents"), min_words=50, drop_empty=False)
    return out.select("doc_id", F.size("deleted_lines").cast("long").alias("n_deleted"),
                      F.array_join(F.transform("deleted_lines", lambda i: i.cast("string")), ",").alias("deleted"),
                      F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256"))


def op10_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    from lexis.llm import mainpage

    return mainpage.extract(read(spark, sf_dir, "pages")).select(
        "page_id", "url", F.col("main").alias("text"), F.length("main").cast("long").alias("n_chars"))


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's groups and links between two tokenizers' ids."""
    from lexis.llm import alignment

    digest = F.when(F.col("groups") == "", F.lit("")).otherwise(F.sha2("groups", 256))
    return alignment.align(read(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"),
                           tokenizer_path("piece_bpe_32k.model"), derive={"groups_sha256": digest})


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What five filters remove, per language, in all orders."""
    from lexis.llm import filteraudit

    return filteraudit.audit(filteraudit.flags(read(spark, sf_dir, "documents")), read(spark, sf_dir, "labels"))


def op11_weighted_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and of its edited text, and their likeness."""
    from lexis.llm import weighted

    found = weighted.edited(read(spark, sf_dir, "documents"), derive={"edited_sha256": F.sha2("edited", 256)})
    return found.select("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next")
