"""Shared pieces of the text operators: reading a table, and running a
function over texts in Arrow batches whose size is bounded in bytes."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# texts handed to one call of a batch function: closed at this many bytes
CHUNK_BYTES = 1_000_000


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def col(name: str) -> Column:
    """A column by its literal name (dots and spaces included)."""
    return F.col("`" + name.replace("`", "``") + "`")


def free_name(df: DataFrame, base: str) -> str:
    """``base``, lengthened until no column of ``df`` has that name."""
    taken = {c.lower() for c in df.columns}
    while base.lower() in taken:
        base += "_"
    return base


def id_and_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Exactly two columns ``doc_id`` and ``text`` (null text: empty); whatever
    else the input carries stays out, so no name can clash."""
    return docs.select(col(id_col).alias("doc_id"),
                       F.coalesce(col(text_col).cast("string"), F.lit("")).alias("text"))


def range_count(df: DataFrame) -> int:
    """Partitions for a shuffle of the whole of ``df``: as many as the session asks for, but
    twice the splits it is read in at least, so their size does not grow with the input."""
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), 2 * df.rdd.getNumPartitions())


def text_chunks(column, limit: int = CHUNK_BYTES):
    """``(a, b, texts)``: slices of an Arrow string column of about ``limit`` bytes as lists;
    a longer text is a slice of its own."""
    import numpy as np
    import pyarrow.compute as pc

    upto = np.cumsum(pc.binary_length(column).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64))
    a = 0
    while a < len(column):
        b = max(a + 1, int(np.searchsorted(upto, (upto[a - 1] if a else 0) + limit, "right")))
        yield a, b, column.slice(a, b - a).to_pylist()
        a = b


def give_back() -> None:
    """Return what a task has freed to the system: workers are reused, and what they
    once needed would else stay with them."""
    import ctypes

    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):   # another C library
        pass


def map_texts(df: DataFrame, fields: list[T.StructField], setup: Callable[[], Callable[[list[str]], list]],
              chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Every column of ``df`` but ``text``, plus ``fields`` computed from it.

    ``setup()`` runs once per task and returns ``f(texts) -> one list (or
    Arrow array) per field``, row for row."""
    from pyspark.sql.pandas.types import to_arrow_type

    keep = [f for f in df.schema.fields if f.name != "text"]
    schema = T.StructType(keep + fields)
    kinds = [to_arrow_type(f.dataType) for f in fields]

    def run(batches):
        import pyarrow as pa

        f = setup()
        for batch in batches:
            for a, b, texts in text_chunks(batch.column(batch.schema.get_field_index("text")), chunk_bytes):
                out = f(texts)
                arrays = [batch.column(batch.schema.get_field_index(k.name)).slice(a, b - a) for k in keep]
                arrays += [v if isinstance(v, pa.Array) else pa.array(v, t) for v, t in zip(out, kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, names=[x.name for x in schema.fields])
        give_back()

    return df.mapInArrow(run, schema)


def per_worker(key, make: Callable):
    """``make()`` once per Python worker process and key: tasks that follow in the
    same worker find it again.  Only the last key is kept, so memory stays bounded."""
    import pyspark

    held = pyspark.__dict__.setdefault("_lexis_held", {})
    if key not in held:
        held.clear()
        held[key] = make()
    return held[key]


SPAN = T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType()),
                     T.StructField("kind", T.StringType())])


def span_text(spans: Column) -> Column:
    """``kind:start:end`` of an array of spans, comma-joined in array order."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def count_kind(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")
