"""File sinks K1-K8.  Every writer takes a DataFrame and a target folder and
lets Spark write part files in parallel; ordered outputs are range-partitioned
by ``orderBy`` so part files concatenate in order."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexis.functions.text import normalise_digits
from lexis.operators import sequences as sq

# Sample listing truncation, labels of the path report.
PREVIEW_CHARS = 125
SUBJECT_LABEL = "SUBJECT PATH: "
OBJECT_LABEL = "OBJECT  PATH: "


def write_identification(best: DataFrame, path: str, mode: str = "overwrite") -> None:
    """K1: ``eval_file \\t model_file \\t score \\t n``, sorted by eval file, no
    header."""
    (best.select(F.col("doc_id").cast("string").alias("eval_file"), F.col("model").alias("model_file"),
                 F.col("perplexity").cast("string"), F.col("n").cast("string"))
     .orderBy("eval_file").write.mode(mode).option("sep", "\t").option("header", False).csv(path))


def write_tagged_text(packed: DataFrame, path: str, mode: str = "overwrite") -> None:
    """K2: one sentence per line, ``word_tag`` terms joined by one space."""
    sq.encode_slash(packed).orderBy("sent_id").select("line").write.mode(mode).text(path)


def write_untagged_text(packed: DataFrame, path: str, mode: str = "overwrite") -> None:
    """K3: one sentence per line, words joined by one space."""
    sq.encode_words(packed).orderBy("sent_id").select("line").write.mode(mode).text(path)


def write_alignment(aligned: DataFrame, path: str, mode: str = "overwrite") -> None:
    """K4: truth word, truth tag, predicted word, predicted tag, train count."""
    (aligned.orderBy("idx")
     .select("truth_word", "truth_tag", "pred_word", "pred_tag", F.col("train_count").cast("string"))
     .write.mode(mode).option("sep", "\t").option("header", False).option("quote", "").csv(path))


def noun_check_report(rel: DataFrame, tokens: DataFrame, mismatches: DataFrame) -> DataFrame:
    """K5 as rows ``sent_id, report``: raw sentence, ``token\\ttag`` lines,
    mismatched phrases, then two blank lines."""
    toks = (tokens.groupBy("sent_id")
            .agg(F.array_sort(F.collect_list(F.struct("i", F.concat_ws("\t", "text", "tag").alias("l"))))
                 .alias("ts"))
            .select("sent_id", F.array_join("ts.l", "\n").alias("tok_lines")))
    mm = (mismatches.groupBy("sent_id")
          .agg(F.array_sort(F.collect_list(F.struct("ord", "phrase"))).alias("ps"))
          .select("sent_id", F.array_join("ps.phrase", "\n").alias("mm_lines")))
    body = F.concat_ws("\n", F.col("sentence"), F.col("tok_lines"), F.col("mm_lines"))
    return (rel.join(toks, "sent_id", "left").join(mm, "sent_id", "left")
            .select("sent_id", F.concat(body, F.lit("\n\n")).alias("report")))


def write_report(report: DataFrame, path: str, mode: str = "overwrite") -> None:
    """K5 / K6: report rows in sentence order as text."""
    report.orderBy("sent_id").select("report").write.mode(mode).text(path)


def path_report_text(report: DataFrame) -> DataFrame:
    """K6 as rows: rewritten sentence, role lines, both paths, LCA."""
    body = F.concat_ws("\n", F.col("text"), F.col("entities"),
                       F.concat(F.lit(SUBJECT_LABEL), F.col("subject_path")),
                       F.concat(F.lit(OBJECT_LABEL), F.col("object_path")),
                       F.col("lca"))
    return report.select("sent_id", F.concat(body, F.lit("\n\n")).alias("report"))


def write_predictions(pred: DataFrame, samples: DataFrame, path: str, mode: str = "overwrite") -> None:
    """K7: ``original_label, classifier_label, text`` with a header; text is
    quoted (the reference wrote it raw, which breaks on commas)."""
    (pred.join(samples.select("sample_id", "text"), "sample_id").orderBy("sample_id")
     .select(F.col("label").alias("original_label"), F.col("predicted").alias("classifier_label"), "text")
     .write.mode(mode).option("header", True).option("quoteAll", True).option("escape", '"').csv(path))


def sample_preview(samples: DataFrame) -> DataFrame:
    """K8 sample listing: first 125 characters of the normalised text + '...'."""
    text = normalise_digits("text")
    return samples.select("sample_id", F.concat(F.substring(text, 1, PREVIEW_CHARS), F.lit("...")).alias("preview"))


def fold_listing(samples: DataFrame, assign: DataFrame) -> DataFrame:
    """K8 listing of each fold's samples: ``fold_id, part, sample_id, label, preview``."""
    part = F.when(F.col("is_test"), "test").otherwise("train")
    return (assign.select("fold_id", "sample_id", part.alias("part"))
            .join(sample_preview(samples).join(samples.select("sample_id", "label"), "sample_id"), "sample_id")
            .select("fold_id", "part", "sample_id", "label", "preview"))


def write_fold_report(per_fold: DataFrame, path: str, mode: str = "overwrite") -> None:
    """K8: per-fold accuracy rows plus the macro mean as a last row."""
    mean = per_fold.agg(F.lit(-1).alias("fold_id"), F.sum("n").alias("n"), F.sum("correct").alias("correct"),
                        F.avg("accuracy").alias("accuracy"))
    out = per_fold.select("fold_id", "n", "correct", "accuracy").unionByName(mean)
    out.orderBy(F.col("fold_id") < 0, "fold_id").coalesce(1).write.mode(mode).option("header", True).csv(path)
