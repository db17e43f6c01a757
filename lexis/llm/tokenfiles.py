"""Token ids in ORC files.

Documents are range-partitioned by id, encoded where they arrive, and written
in ascending order of id: integer columns are run-length encoded in stripes,
row indexes and Bloom filters on the id let a reader skip stripes and row
groups, and stripes are read in parallel.  Ranges balance rows; a document's
ids stay in one row.

Each row has the document id, its ids with the end id, their number, and the number
of ids before it in its file; the place of a document in the whole stream follows
from that and the sums of the files before (one row per file is broadcast), so
starts are those of the files' own order.

Results for odd inputs: null and empty texts have the end id only; rows with a
null id come first; rows that repeat an id stand in the order of their text's
hash; columns beside id and text are ignored; an empty table writes no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexis.llm.bytelevel import ByteLevel
from lexis.llm.common import give_back, id_and_text, per_worker, range_count, text_chunks

NAMES = ["doc_id", "before", "n_tokens", "ids"]


def write_tokens(docs: DataFrame, tokenizer: str, path: str, end_id: int | None = 2, id_col: str = "doc_id",
                 text_col: str = "text", stripe_bytes: int = 64 << 20) -> None:
    """Write ``doc_id, before, n_tokens, ids`` of every document to ORC files under ``path``."""
    spec = open(tokenizer, encoding="utf-8").read()   # 2 MB; travels with the task

    def run(batches):
        import numpy as np
        import pyarrow as pa

        coder = per_worker(("bytes", hash(spec)), lambda: ByteLevel(spec))
        end = np.array([] if end_id is None else [end_id], np.uint32)
        before = 0                                     # a task writes one file
        for batch in batches:
            for a, b, texts in text_chunks(batch.column(1)):
                ids = [x for t in texts for x in (coder.array(t), end)]
                n = np.fromiter(map(len, ids), np.int64, len(ids)).reshape(-1, 2).sum(axis=1)
                ends = np.concatenate(([0], np.cumsum(n)))
                flat = pa.array(np.concatenate(ids).view(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.array(before + ends[:-1]), pa.array(n),
                     pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), flat)], names=NAMES)
                before += int(ends[-1])
        give_back()

    src = id_and_text(docs, id_col, text_col)
    parts = range_count(src)
    src = src.withColumn("tie", F.xxhash64("text"))
    src = src.repartitionByRange(parts, "doc_id", "tie").sortWithinPartitions("doc_id", "tie").select("doc_id", "text")
    schema = T.StructType([src.schema["doc_id"], T.StructField("before", T.LongType()), T.StructField("n_tokens", T.LongType()),
                           T.StructField("ids", T.ArrayType(T.IntegerType()))])
    (src.mapInArrow(run, schema)
     .write.option("orc.compress", "ZSTD").option("orc.stripe.size", stripe_bytes).option("orc.row.index.stride", 1000)
     .option("orc.bloom.filter.columns", "doc_id").option("orc.bloom.filter.fpp", 0.01).orc(path))


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """The written rows; a filter on ``doc_id`` prunes by statistics and Bloom filters."""
    return spark.read.schema("doc_id long, before long, n_tokens long, ids array<int>").orc(path)


def documents_of(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document, from the files."""
    # files are numbered in the order of their ranges
    number = F.regexp_extract(F.col("_metadata.file_name"), r"part-(\d+)", 1).cast("int")
    rows = read_tokens(spark, path).select("doc_id", "before", "ids", number.alias("file"))

    def run(batches):
        import zlib

        import numpy as np
        import pyarrow as pa

        for b in batches:
            ids = b.column(2)
            ends, flat = ids.offsets.to_numpy(), ids.values.to_numpy(zero_copy_only=False).astype("<u4", copy=False)
            crc = [zlib.crc32(flat[x:y].tobytes()) for x, y in zip(ends[:-1], ends[1:])]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(3), b.column(1), pa.array(np.diff(ends).astype(np.int64)),
                                              pa.array(crc, pa.int64())], names=["doc_id", "file", "before", "n_tokens", "ids_crc32"])

    docs = rows.mapInArrow(run, "doc_id long, file int, before long, n_tokens long, ids_crc32 long")
    files = read_tokens(spark, path).select("n_tokens", number.alias("file")).groupBy("file").agg(F.sum("n_tokens").alias("n"))
    sums = files.select("file", (F.sum("n").over(Window.orderBy("file")) - F.col("n")).alias("earlier"))   # a row per file
    return docs.join(F.broadcast(sums), "file").select(
        "doc_id", (F.col("earlier") + F.col("before")).alias("start"), "n_tokens", "ids_crc32")
