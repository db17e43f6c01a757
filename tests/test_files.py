"""Readers and sinks: round trips over files."""

from pyspark.sql import functions as F

from lexis.sinks import files as sink
from lexis.sources import files as source

TAGGED = "sent_id long, words array<string>, tags array<string>"


def lines(path):
    return [x for p in sorted(path.glob("part-*")) for x in p.read_text(encoding="utf-8").splitlines()]


def test_corpus_and_path_list(spark, tmp_path):
    (tmp_path / "a.txt").write_bytes(b"one\r\ntwo\n")
    (tmp_path / "list.txt").write_text(f"{tmp_path}/a.txt\n\n  \n")
    paths = source.read_path_list(spark, str(tmp_path / "list.txt"))
    assert paths == [f"{tmp_path}/a.txt"]
    assert [(r.doc, r.text) for r in source.read_corpus(spark, paths).collect()] == [("a.txt", "one\ntwo\n")]


def test_flat_tokens(spark, tmp_path):
    (tmp_path / "t.txt").write_text("The DT\nfox x NN\n\n\truns VBZ\n")
    flat = source.read_tagged_flat(spark, str(tmp_path / "t.txt")).orderBy("idx").collect()
    assert [(r.idx, r.word, r.tag) for r in flat] == [(1, "The", "DT"), (2, "fox", "NN"), (3, "runs", "VBZ")]


def test_identification(spark, tmp_path):
    df = spark.createDataFrame([("b", "fr", 2.5, 2), ("a", "en", 1.25, 2)], "doc_id string, model string, perplexity double, n int")
    sink.write_identification(df, str(tmp_path / "o"))
    assert lines(tmp_path / "o") == ["a\ten\t1.25\t2", "b\tfr\t2.5\t2"]


def test_tagged_and_untagged_text(spark, tmp_path):
    df = spark.createDataFrame([(2, ["x_y", "z"], ["A", "B"]), (1, ["The"], ["DT"])], TAGGED)
    sink.write_tagged_text(df, str(tmp_path / "t"))
    sink.write_untagged_text(df, str(tmp_path / "u"))
    assert lines(tmp_path / "t") == ["The_DT", "x_y_A z_B"] and lines(tmp_path / "u") == ["The", "x_y z"]
    back = source.read_slash_tags(spark, str(tmp_path / "t")).where("tag = 'DT'").collect()
    assert [(r.word, r.tag) for r in back] == [("The", "DT")]


def test_alignment_and_file_alignment(spark, tmp_path):
    from lexis.operators import sequences as sq
    (tmp_path / "truth.txt").write_text('The DT\n"q\\ NN\n\nend NN\n')
    (tmp_path / "pred.txt").write_text('The_DT "q\\_VB\nend_NN\n')
    counts = spark.createDataFrame([("The", 7)], "word string, cnt long")
    al = sq.align_files(source.read_tagged_flat(spark, str(tmp_path / "truth.txt")),
                        source.read_slash_flat(spark, str(tmp_path / "pred.txt")), counts)
    sink.write_alignment(al, str(tmp_path / "o"))
    assert lines(tmp_path / "o") == ["The\tDT\tThe\tDT\t7", '"q\\\tNN\t"q\\\tVB\t0', "end\tNN\tend\tNN\t0"]


def test_reports(spark, tmp_path):
    rel = spark.createDataFrame([(1, "[[ A b | /m/a ]] runs")], "sent_id long, sentence string")
    toks = spark.createDataFrame([(1, 2, "b", "JJ"), (1, 1, "A", "NN")], "sent_id long, i int, text string, tag string")
    bad = spark.createDataFrame([(1, 1, "A b")], "sent_id long, ord int, phrase string")
    sink.write_report(sink.noun_check_report(rel, toks, bad), str(tmp_path / "n"))
    assert lines(tmp_path / "n") == ["[[ A b | /m/a ]] runs", "A\tNN", "b\tJJ", "A b", "", ""]
    rep = spark.createDataFrame([(1, "SUBJECT is", "SUBJECT: A", "a -> b", "c", "b")],
                                "sent_id long, text string, entities string, subject_path string, object_path string, lca string")
    sink.write_report(sink.path_report_text(rep), str(tmp_path / "p"))
    assert lines(tmp_path / "p") == ["SUBJECT is", "SUBJECT: A", "SUBJECT PATH: a -> b", "OBJECT  PATH: c", "b", "", ""]


def test_predictions(spark, tmp_path):
    pred = spark.createDataFrame([(2, "x", "y"), (1, "x", "x")], "sample_id long, label string, predicted string")
    samples = spark.createDataFrame([(1, 'a, "b"'), (2, "c")], "sample_id long, text string")
    sink.write_predictions(pred, samples, str(tmp_path / "o"))
    back = spark.read.option("header", True).option("escape", '"').csv(str(tmp_path / "o")).collect()
    assert [tuple(r) for r in back] == [("x", "x", 'a, "b"'), ("x", "y", "c")]


def test_fold_report(spark, tmp_path):
    folds = spark.createDataFrame([(1, 2, 1, 0.5), (0, 2, 2, 1.0)], "fold_id int, n long, correct long, accuracy double")
    sink.write_fold_report(folds, str(tmp_path / "o"))
    assert lines(tmp_path / "o") == ["fold_id,n,correct,accuracy", "0,2,2,1.0", "1,2,1,0.5", "-1,4,3,0.75"]
    samples = spark.createDataFrame([(1, "tel 12345 and " + "x" * 200)], "sample_id long, text string")
    assert sink.sample_preview(samples).collect()[0].preview == ("tel D and " + "x" * 200)[:125] + "..."
    listing = sink.fold_listing(samples.withColumn("label", F.lit("l")), spark.createDataFrame(
        [(1, 0, True), (1, 1, False)], "sample_id long, fold_id int, is_test boolean"))
    assert [(r.fold_id, r.part, r.sample_id) for r in listing.orderBy("fold_id").collect()] == [(0, "test", 1), (1, "train", 1)]
