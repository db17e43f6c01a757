"""Tagged-sequence tables: readers' row logic (S3-S6), word counts (A6), rare
word replacement and restoration (C12), format converters (K2, K3) and tag
alignment / accuracy (C16, C17).

Long form: ``(sent_id, pos, word, tag)``, ``pos`` 1-based.
Packed form: ``(sent_id, words array, tags array)``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lexis.functions.text import UNK, slash_encode, slash_tag, slash_word, whitespace_split
from lexis.operators.ordering import global_running_sum
from lexis.plans.sizing import lookup_join
from lexis.session import written

MAX_FILE_LINES = 1_000_000  # lines of one file that one task numbers


def sentences_from_lines(lines: DataFrame, file_col: str = "file", line_col="line_no",
                         text_col: str = "line") -> DataFrame:
    """S3: two-column lines -> ``file, sent_no, pos, word, tag``.

    A blank line ends a sentence; words after the last blank line of a file are
    dropped (the reference never appends the open sentence); consecutive blanks
    make empty sentences, which have no rows in long form.  The first
    whitespace field is the word, the last the tag.

    Lines travel once, to their file, and are numbered there; files of more than
    ``MAX_FILE_LINES`` lines are numbered over all tasks instead."""
    order = [file_col, *([line_col] if isinstance(line_col, str) else line_col)]
    x = (lines.select(*order, text_col).dropna(subset=order)
         .withColumn("_blank", (~F.col(text_col).rlike(r"\S")).cast("bigint")))
    large = x.groupBy(file_col).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > MAX_FILE_LINES).select(file_col).cache()
    n_large = large.count()  # at most one in MAX_FILE_LINES lines
    few = F.broadcast(large)
    toks = _numbered_by_file(x.join(few, file_col, "left_anti") if n_large else x, order)
    if n_large:
        toks = toks.unionByName(_numbered_by_range(x.join(few, file_col, "left_semi"), order))
    fields = whitespace_split(F.col(text_col))
    return toks.select(file_col, F.col("sent_no").cast("bigint").alias("sent_no"), F.col("pos").cast("int").alias("pos"),
                       F.element_at(fields, 1).alias("word"), F.element_at(fields, -1).alias("tag"))


def _numbered_by_file(x: DataFrame, order: list[str]) -> DataFrame:
    """``sent_no`` and ``pos`` of the closed sentences' lines: one sort per file."""
    w = Window.partitionBy(order[0]).orderBy(*order[1:])
    running = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    x = (x.withColumn("_line", F.row_number().over(w))
         .withColumn("sent_no", F.sum("_blank").over(running))
         .withColumn("_closed", F.sum("_blank").over(whole)))
    x = x.withColumn("_begin", F.max(F.when(F.col("_blank") == 1, F.col("_line"))).over(running))
    return (x.where("_blank = 0 and sent_no < _closed")
            .withColumn("pos", F.col("_line") - F.coalesce("_begin", F.lit(0)))
            .drop("_blank", "_line", "_closed", "_begin"))


def _numbered_by_range(x: DataFrame, order: list[str]) -> DataFrame:
    """The same for files of any size: lines are numbered, and blank lines counted,
    over all files at once, spread over the range partitions."""
    x = global_running_sum(x, order, "_blank", "_ended")
    x = global_running_sum(x, order, None, "_line").cache()
    per_file = x.groupBy(order[0]).agg(F.min("_ended").alias("_first"), F.sum("_blank").alias("_closed"))
    toks = (x.where("_blank = 0").join(per_file, order[0])
            .withColumn("sent_no", F.col("_ended") - F.col("_first")).where("sent_no < _closed"))
    begins = toks.groupBy("_ended").agg(F.min("_line").alias("_begin"))
    return (toks.join(begins, "_ended").withColumn("pos", F.col("_line") - F.col("_begin") + 1)
            .drop("_ended", "_blank", "_line", "_first", "_closed", "_begin"))


def pack(tokens: DataFrame, cols=("word", "tag")) -> DataFrame:
    """Long form -> packed arrays per sentence (one shuffle on sent_id)."""
    agg = F.sort_array(F.collect_list(F.struct("pos", *cols)))
    return (tokens.groupBy("sent_id").agg(agg.alias("_s"))
            .select("sent_id", *[F.col(f"_s.{c}").alias(f"{c}s") for c in cols]))


def unpack(packed: DataFrame, cols=("word", "tag"), keep=()) -> DataFrame:
    """Packed arrays -> long form (no shuffle)."""
    z = F.arrays_zip(*[F.col(f"{c}s").alias(c) for c in cols])
    return (packed.select("sent_id", *keep, F.posexplode(z).alias("_p", "_z"))
            .select("sent_id", (F.col("_p") + 1).cast("int").alias("pos"), *keep,
                    *[F.col(f"_z.{c}").alias(c) for c in cols]))


def word_counts(tokens: DataFrame) -> DataFrame:
    """``word, cnt``."""
    return tokens.groupBy("word").agg(F.count(F.lit(1)).cast("bigint").alias("cnt"))


def replace_rare(tokens: DataFrame, counts: DataFrame, threshold: int = 1, unseen_too: bool = False) -> DataFrame:
    """``model_word`` = ``<UNK>`` where count <= threshold (and, on the
    tagging side, where the word is unseen).  threshold 0 = off."""
    if threshold <= 0:
        return tokens.withColumn("model_word", F.col("word"))
    rare = F.col("_cnt") <= threshold
    if unseen_too:
        rare = rare | F.col("_cnt").isNull()
    else:
        rare = F.coalesce(rare, F.lit(False))
    return (lookup_join(tokens, counts.select("word", F.col("cnt").alias("_cnt")), "word")
            .withColumn("model_word", F.when(rare, F.lit(UNK)).otherwise(F.col("word"))).drop("_cnt"))


def encode_slash(packed: DataFrame) -> DataFrame:
    """K2: ``sent_id, line`` = ``word_tag`` terms joined by one space."""
    return packed.select("sent_id", F.array_join(F.zip_with("words", "tags", slash_encode), " ").alias("line"))


def encode_words(packed: DataFrame) -> DataFrame:
    """K3: ``sent_id, line`` = words joined by one space."""
    return packed.select("sent_id", F.array_join("words", " ").alias("line"))


def decode_slash(lines: DataFrame, id_col: str = "sent_id", line_col: str = "line") -> DataFrame:
    """word = text before the first ``_``, tag = text after the last."""
    return (lines.select(F.col(id_col).alias("sent_id"), F.posexplode(whitespace_split(F.col(line_col)))
                         .alias("p0", "term"))
            .select("sent_id", (F.col("p0") + 1).cast("int").alias("pos"),
                    slash_word(F.col("term")).alias("word"), slash_tag(F.col("term")).alias("tag")))


def align_tags(truth: DataFrame, predicted: DataFrame, train_counts: DataFrame) -> DataFrame:
    """Zip truth and prediction by global position (cut to the shorter),
    look the training count up by the *predicted-side* word (0 if unseen).
    Global position = tokens of all earlier sentences + ``pos``; the running
    sum runs over the per-sentence lengths (one row per sentence), not over
    tokens, and never in a single task.

    Both sides are written once, a row for each sentence.  Sentences that stand at the same
    place on both sides are zipped as they are; only tokens of the others are joined by
    their global position."""
    def packed(df):
        row = F.sort_array(F.collect_list(F.struct("pos", "word", "tag")))
        return written(df.groupBy("sent_id").agg(row.alias("s")), "sentences")

    def placed(df, prefix):
        lens = df.select("sent_id", F.size("s").cast("bigint").alias("_len"), (
            F.col("s.pos") == F.sequence(F.lit(1), F.size("s"))).alias("_whole"))
        off = global_running_sum(lens, "sent_id", "_len", "_off")
        return off.select("sent_id", *[F.col(f"_{c}").alias(f"{prefix}_{c}") for c in ("len", "whole", "off")])

    def tokens(df, places, prefix):
        """Of the sentences that the other side has not at the same place."""
        x = df.join(places.where(~F.col("same")).where(F.col(f"{prefix}_off").isNotNull()).select("sent_id", f"{prefix}_off"), "sent_id")
        x = x.select(F.col(f"{prefix}_off").alias("_off"), F.inline("s"))
        return x.select((F.col("_off") + F.col("pos")).alias("idx"), F.col("word").alias(f"{prefix}_word"),
                        F.col("tag").alias(f"{prefix}_tag"))

    t, p = packed(truth), packed(predicted)
    same = (F.col("t_off") == F.col("p_off")) & (F.col("t_len") == F.col("p_len")) & F.col("t_whole") & F.col("p_whole")
    places = written(placed(t, "t").join(placed(p, "p"), "sent_id", "full")
                     .withColumn("same", F.coalesce(same, F.lit(False))), "places")
    pair = F.arrays_zip(F.col("t").alias("t"), F.col("p").alias("p"))
    zipped = (places.where("same").select("sent_id", F.col("t_off").alias("_off"))
              .join(t.withColumnRenamed("s", "t"), "sent_id").join(p.withColumnRenamed("s", "p"), "sent_id")
              .select("_off", F.explode(pair).alias("x"))
              .select((F.col("_off") + F.col("x.t.pos")).alias("idx"), F.col("x.t.word").alias("t_word"), F.col("x.t.tag").alias("t_tag"),
                      F.col("x.p.word").alias("p_word"), F.col("x.p.tag").alias("p_tag")))
    rows = zipped.unionByName(tokens(t, places, "t").join(tokens(p, places, "p"), "idx"))
    rows = rows.select("idx", F.col("t_word").alias("truth_word"), F.col("t_tag").alias("truth_tag"),
                       F.col("p_word").alias("pred_word"), F.col("p_tag").alias("pred_tag"))
    return _with_counts(rows, train_counts)


def _with_counts(rows: DataFrame, train_counts: DataFrame) -> DataFrame:
    counts = train_counts.select(F.col("word").alias("pred_word"), F.col("cnt").alias("_c"))
    return (lookup_join(rows, counts, "pred_word")
            .select("idx", "truth_word", "truth_tag", "pred_word", "pred_tag",
                    F.coalesce("_c", F.lit(0)).cast("bigint").alias("train_count")))


def align_files(truth: DataFrame, predicted: DataFrame, train_counts: DataFrame) -> DataFrame:
    """C16 for flat token streams ``idx, word, tag``."""
    t = truth.select("idx", F.col("word").alias("truth_word"), F.col("tag").alias("truth_tag"))
    p = predicted.select("idx", F.col("word").alias("pred_word"), F.col("tag").alias("pred_tag"))
    return _with_counts(t.join(p, "idx"), train_counts)


def tag_accuracy(aligned: DataFrame) -> DataFrame:
    """C17: accuracy split by known (train_count > 0) / unknown words."""
    return (aligned.groupBy((F.col("train_count") > 0).alias("known"))
            .agg(F.count(F.lit(1)).cast("bigint").alias("n"),
                 F.avg((F.col("truth_tag") == F.col("pred_tag")).cast("double")).alias("accuracy")))
