"""File sources S1-S8: the reference's on-disk formats read as DataFrames.

Line order inside a file is kept with ``(_metadata.file_block_start,
monotonically_increasing_id())``: a split is read by one task in order, and
splits of one file are ordered by their start offset, so no row ever has to
pass through a single task to be numbered.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexis.functions.text import file_stem, slash_tag, slash_word, whitespace_split
from lexis.operators.ordering import global_row_number
from lexis.operators.sequences import sentences_from_lines

ORDER = ["_block", "_row"]


def read_corpus(spark: SparkSession, paths) -> DataFrame:
    """Each file whole -> ``doc, path, text``; CRLF becomes LF (text mode)."""
    df = spark.read.text(paths, wholetext=True)
    return df.select(file_stem(F.col("_metadata.file_path")).alias("doc"),
                     F.col("_metadata.file_path").alias("path"),
                     F.regexp_replace("value", "\r\n", "\n").alias("text"))


def read_path_list(spark: SparkSession, path: str) -> list[str]:
    """Newline-separated path list (small metadata, so it is collected to
    the driver to become the ``paths`` argument of S1).  Empty lines are
    skipped instead of failing as the reference does."""
    rows = spark.read.text(path).where(F.trim("value") != "").select(F.trim("value").alias("p")).collect()
    return [r.p for r in rows]


def read_lines(spark: SparkSession, paths) -> DataFrame:
    """``file, _block, _row, line`` in file order."""
    df = spark.read.text(paths)
    return df.select(F.col("_metadata.file_path").alias("file"),
                     F.col("_metadata.file_block_start").alias("_block"),
                     F.monotonically_increasing_id().alias("_row"),
                     F.regexp_replace("value", "\r$", "").alias("line"))


def read_tagged_columns(spark: SparkSession, paths) -> DataFrame:
    """S3: ``word ... tag`` lines, blank line ends a sentence ->
    ``file, sent_no, pos, word, tag`` (an unterminated final sentence is
    dropped, as in the reference)."""
    return sentences_from_lines(read_lines(spark, paths), "file", ORDER, "line")


def read_tagged_flat(spark: SparkSession, paths) -> DataFrame:
    """The same file as one flat token stream ``idx, word, tag``, ``idx`` its 1-based
    position over all lines of all files."""
    lines = read_lines(spark, paths).withColumn("f", whitespace_split(F.col("line"))).where(F.size("f") > 0)
    return _positions(lines.select("file", *ORDER, F.element_at("f", 1).alias("word"), F.element_at("f", -1).alias("tag")),
                      ["file", *ORDER])


def read_slash_flat(spark: SparkSession, paths) -> DataFrame:
    """S6 as one flat token stream ``idx, word, tag``."""
    return _positions(read_slash_tags(spark, paths), ["file", *ORDER, "pos"])


def _positions(tokens: DataFrame, order: list[str]) -> DataFrame:
    return global_row_number(tokens, order, "idx").select("idx", "word", "tag")


def read_sentences(spark: SparkSession, paths) -> DataFrame:
    """One pre-tokenised sentence per line -> ``file, _block, _row,
    words``; empty lines are skipped."""
    lines = read_lines(spark, paths)
    return (lines.select("file", *ORDER, whitespace_split(F.col("line")).alias("words"))
            .where(F.size("words") > 0))


def read_slash_tags(spark: SparkSession, paths) -> DataFrame:
    """``word_tag`` terms -> ``file, _block, _row, pos, word, tag`` (word
    before the first ``_``, tag after the last)."""
    lines = read_lines(spark, paths)
    terms = lines.select("file", *ORDER, F.posexplode(whitespace_split(F.col("line"))).alias("p0", "term"))
    return terms.select("file", *ORDER, (F.col("p0") + 1).cast("int").alias("pos"),
                        slash_word(F.col("term")).alias("word"), slash_tag(F.col("term")).alias("tag"))


RELATION_SCHEMA = T.StructType([
    T.StructField("sentence", T.StringType()),
    T.StructField("pair", T.StructType([
        T.StructField("subject", T.StructType([T.StructField("name", T.StringType()),
                                               T.StructField("mid", T.StringType())])),
        T.StructField("object", T.StructType([T.StructField("name", T.StringType()),
                                              T.StructField("mid", T.StringType())])),
    ])),
])


def read_relations(spark: SparkSession, paths) -> DataFrame:
    """JSON array of relation objects -> ``sent_id, sentence, pair``
    (a top-level array gives one row per element)."""
    df = spark.read.schema(RELATION_SCHEMA).json(paths, multiLine=True)
    return df.select(F.monotonically_increasing_id().alias("sent_id"), "sentence", "pair")


SAMPLE_SCHEMA = T.StructType([T.StructField("label", T.StringType()), T.StructField("text", T.StringType())])


def read_samples(spark: SparkSession, paths) -> DataFrame:
    """UTF-8 CSV, header skipped, double-quote quoting (doubled quotes and
    line breaks inside fields), exactly two fields or the read fails ->
    ``sample_id, label, text`` with ``sample_id`` in file order."""
    df = (spark.read.schema(SAMPLE_SCHEMA)
          .option("header", True).option("multiLine", True)
          .option("quote", '"').option("escape", '"')
          .option("mode", "FAILFAST")
          .option("encoding", "UTF-8")
          .csv(paths))
    return df.select(F.monotonically_increasing_id().alias("sample_id"), "label", "text")
