"""N-grams of all orders up to a maximum from one exchange.

A position's window holds the next ``max_n`` units (fewer at a text's end); every
n-gram that starts there is a prefix of it.  Tasks count equal windows first, by numbers;
the counted rows are range-partitioned and sorted, so the rows of a prefix stand
together, and one pass over Arrow batches adds up every order's prefixes.  The
first and the last prefix of each order of a batch may go on in the next one: these
``2 * max_n`` rows a batch are finished by a small sum.
"""

from __future__ import annotations

import sys
from collections.abc import Sequence

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexis.session import written

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # tasks need no copy of this package

HELD_ROWS = 2_000_000  # positions a task counts at once, and counted rows it holds
PIECE = 500            # positions of a row of units on its way to Python
KEY_BITS = 9           # of a code that holds a whole window; the rest is its units'


def unit_pieces(units: Column, max_n: int) -> Column:
    """A unit array in pieces ``u, n``: windows begin at the first ``n`` units of a piece, the
    others are their ends."""
    size = F.size(units)
    begins = F.when(size > 0, F.sequence(F.lit(0), size - 1, F.lit(PIECE)))
    return F.transform(begins, lambda i: F.struct(
        F.slice(units, i + 1, PIECE + max_n - 1).alias("u"), F.least(F.lit(PIECE), size - i).alias("n")))


def _ranked(columns: list, sizes: list[int]):
    """One number for each row of columns of numbers below ``sizes``, equal where the rows are equal."""
    import numpy as np
    while True:
        packs, done = [], 0
        while done < len(columns):
            code, size = columns[done].astype("int64"), sizes[done]
            done += 1
            while done < len(columns) and size * sizes[done] < 1 << 62:
                code, size = code * sizes[done] + columns[done], size * sizes[done]
                done += 1
            packs.append(code)
        if len(packs) == 1:
            return packs[0]
        found = [np.unique(x, return_inverse=True) for x in packs]
        columns, sizes = [x[1] for x in found], [max(1, len(x[0])) for x in found]


class _Windows:
    """Counts of the windows of a task's units.

    Where the units met so far are few (characters) a window is one number, and equal ones are
    held as one row until they are many; else (words) the windows of a batch are counted."""

    def __init__(self, names: list[str], max_n: int, sep: str, schema):
        import pyarrow as pa
        self.names, self.max_n, self.sep, self.schema = names, max_n, sep, schema
        self.bits = (63 - KEY_BITS) // max_n
        self.kinds = [pa.string() for _ in names]
        self._clear()

    def _clear(self):
        import numpy as np
        import pyarrow as pa
        self.units, self.keys, self.key_rows = pa.array([], pa.string()), {}, []
        self.codes, self.counts = np.empty(0, "int64"), np.empty(0, "int64")

    def add(self, heads: list, units, starts):
        """Rows of units (a list column, or texts as their characters) with their keys; windows
        begin at a row's first ``starts`` units."""
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc
        if pa.types.is_list(units.type):
            n, flat = units.value_lengths().to_numpy(zero_copy_only=False).astype("int64"), pc.fill_null(units.flatten(), "")
        else:
            n, flat = pc.utf8_length(units).to_numpy(zero_copy_only=False).astype("int64"), _code_points(units)
        ends = np.cumsum(n)
        groups = [pc.dictionary_encode(h, null_encoding="encode") for h in heads]
        most = HELD_ROWS if isinstance(flat, np.ndarray) else max(1, HELD_ROWS // 4)   # words take more memory each
        for a in range(0, len(flat), most):
            b = min(len(flat), a + most)
            row = np.searchsorted(ends, np.arange(a, b), "right") if len(n) > b - a else np.repeat(
                np.arange(len(n)), np.clip(ends, a, b) - np.clip(ends - n, a, b))
            left = ends[row] - np.arange(a, b)
            mine = left > (n - starts)[row]
            yield from self._chunk(*_numbered(flat[a:b + self.max_n - 1]), left, mine, row, groups)

    def _chunk(self, vocab, ids, left, mine, row, groups):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc
        m, row = len(left), row[mine]
        ids = np.append(ids.astype("int64") + 1, np.zeros(self.max_n, "int64"))
        one = [g.indices.to_numpy(zero_copy_only=False)[row] for g in groups]
        head = _ranked(one, [max(1, len(g.dictionary)) for g in groups]) if one else np.zeros(len(row), "int64")
        _, first, head = np.unique(head, return_index=True, return_inverse=True)
        rows = [tuple(g.dictionary[int(k[i])].as_py() for g, k in zip(groups, one)) for i in first] if len(first) < 1 << KEY_BITS else None
        if rows is not None and self._fits(vocab, rows):
            new = np.append(0, pc.index_in(vocab, value_set=self.units).to_numpy(zero_copy_only=False) + 1).astype("int64")
            ids, code = new[ids], np.zeros(m, "int64")
            for k in range(self.max_n):
                code <<= self.bits
                code |= np.where(left > k, ids[k:m + k], 0)
            code = code[mine]
            code |= np.array([self.keys[r] for r in rows], "int64")[head] << (self.bits * self.max_n)
            yield from self._hold(code)
            return
        at, left = np.flatnonzero(mine), left[mine]
        window = [np.where(left > k, ids[at + k], 0) for k in range(self.max_n)]
        code = _ranked([head, *window], [max(1, len(first)), *[len(vocab) + 1] * self.max_n])
        _, where, cnt = np.unique(code, return_index=True, return_counts=True)
        size = np.minimum(left[where], self.max_n)
        ends = np.append(0, np.cumsum(size))
        flat_at = np.repeat(at[where] - ends[:-1], size) + np.arange(ends[-1])
        units = (_escaped(vocab) if self.sep else vocab).take(pa.array(ids[flat_at] - 1))
        suffix = pc.binary_join(pa.ListArray.from_arrays(pa.array(ends.astype("int32")), units), _between(self.sep))
        heads = [g.dictionary.take(pa.array(k[where])) for g, k in zip(groups, one)]
        yield pa.RecordBatch.from_arrays([*heads, suffix, pa.array(cnt.astype("int64"))], self.schema)

    def _fits(self, vocab, rows) -> bool:
        """Take new units and keys in, if codes have room for all."""
        import pyarrow as pa
        import pyarrow.compute as pc
        if len(vocab) >= 1 << self.bits:
            return False
        units = pc.unique(pa.concat_arrays([self.units, vocab]))
        keys = dict.fromkeys([*self.key_rows, *rows])
        if len(units) >= 1 << self.bits or len(keys) >= 1 << KEY_BITS:
            return False
        self.units, self.key_rows = units, list(keys)
        self.keys = {r: i for i, r in enumerate(self.key_rows)}
        return True

    def _hold(self, code):
        import numpy as np
        code.sort()
        begins = np.flatnonzero(np.append(True, code[1:] != code[:-1])[:len(code)])
        cnt = np.diff(np.append(begins, len(code)))
        both, counts = np.concatenate([self.codes, code[begins]]), np.concatenate([self.counts, cnt])
        order = np.argsort(both, kind="stable")
        both, counts = both[order], counts[order]
        begins = np.flatnonzero(np.append(True, both[1:] != both[:-1])[:len(both)])
        self.codes = both[begins]
        self.counts = np.add.reduceat(counts, begins) if len(begins) else counts
        if len(self.codes) > HELD_ROWS:
            yield from self.rest()

    def rest(self):
        """What is held, as rows."""
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc
        units = _escaped(self.units) if self.sep else self.units
        for a in range(0, len(self.codes), 500_000):
            code, cnt = self.codes[a:a + 500_000], self.counts[a:a + 500_000]
            parts = []
            for k in reversed(range(self.max_n)):
                x = (code >> (self.bits * k)) & ((1 << self.bits) - 1)
                parts.append(units.take(pa.array(x - 1, mask=x == 0)))
            suffix = pc.binary_join_element_wise(*parts, _between(self.sep), null_handling="skip")
            head = (code >> (self.bits * self.max_n)).tolist()
            heads = [pa.array([self.key_rows[h][i] for h in head], kind) for i, kind in enumerate(self.kinds)]
            yield pa.RecordBatch.from_arrays([*heads, suffix, pa.array(cnt.astype("int64"))], self.schema)
        self._clear()


def _parts(batch):
    """Slices of a batch of about ``HELD_ROWS`` positions: numbers are made of one at a time."""
    import numpy as np
    n = np.cumsum(batch.column("n").to_numpy(zero_copy_only=False), dtype="int64") // HELD_ROWS
    cuts = [0, *(np.flatnonzero(np.diff(n)) + 1).tolist(), batch.num_rows]
    return [batch.slice(a, b - a) for a, b in zip(cuts, cuts[1:]) if b > a]


def _code_points(texts):
    """The characters of all texts, one after the other, as numbers."""
    import numpy as np
    import pyarrow as pa
    texts = pa.concat_arrays([texts])
    _, ends, data = texts.buffers()
    ends = np.frombuffer(ends, "int32")[texts.offset:texts.offset + len(texts) + 1]
    flat = data.slice(int(ends[0]), int(ends[-1] - ends[0])).to_pybytes() if data else b""
    return np.frombuffer(flat.decode("utf-8").encode("utf-32-le"), "uint32")


def _numbered(flat):
    """Distinct units, and every unit's place among them."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc
    if isinstance(flat, np.ndarray):
        known = np.flatnonzero(np.bincount(flat))
        places = np.zeros(int(known[-1]) + 1 if len(known) else 1, "int32")
        places[known] = np.arange(len(known))
        return pa.array([chr(c) for c in known.tolist()], pa.string()), places[flat]
    coded = pc.dictionary_encode(flat)
    return pa.concat_arrays([coded.dictionary]), coded.indices.to_numpy(zero_copy_only=False)


def _between(sep: str) -> str:
    """What stands between the units of a sorted row: less than all bytes of a unit, so rows
    that share their first units stand together."""
    return "\0" if sep else ""


def _escaped(units):
    """Units without ``\\0``."""
    import pyarrow.compute as pc
    return pc.replace_substring(pc.replace_substring(units, "\1", "\1\2"), "\0", "\1\1")


def _unescaped(units):
    import pyarrow.compute as pc
    return pc.replace_substring(pc.replace_substring(units, "\1\1", "\0"), "\1\2", "\1")


def _grams(rows, n: int, sep: str):
    """The first ``n`` units of rows of escaped units, joined."""
    import pyarrow as pa
    import pyarrow.compute as pc
    units = pc.list_slice(rows, 0, n)
    flat = units.flatten()
    if pc.any(pc.match_substring(flat, "\1")).as_py():
        units = pa.ListArray.from_arrays(pa.array([0, *pc.cumulative_sum(pc.list_value_length(units)).to_pylist()], pa.int32()), _unescaped(flat))
    return pc.binary_join(units, sep)


def _counted(pieces: DataFrame, names: list[str], max_n: int, sep: str) -> DataFrame:
    """Equal windows of a task (or of a part of it) as one row with their number; units of more
    than a character are joined by ``\\0``."""
    schema = T.StructType([*[pieces.schema[k] for k in names], T.StructField("suffix", T.StringType()), T.StructField("cnt", T.LongType())])

    def run(batches):
        windows = _Windows(names, max_n, sep, [*names, "suffix", "cnt"])
        for batch in batches:
            for b in _parts(batch):
                starts = b.column("n").to_numpy(zero_copy_only=False)
                yield from windows.add([b.column(k) for k in names], b.column("u"), starts)
        yield from windows.rest()

    return pieces.mapInArrow(run, schema)


def ngram_counts(df: DataFrame, keys: Sequence[str], units: Column, max_n: int, sep: str = "",
                 min_count: int = 1) -> DataFrame:
    """``keys.., n, gram, cnt`` of all orders 1 to ``max_n`` (grams of ``min_count`` occurrences and more).

    ``units`` is an array of single characters (``sep`` empty) or of words without ``sep``, or a
    text whose characters are the units; n-grams never cross a row.  Null and empty ones have
    none; keys may be null."""
    keys = list(keys)
    names = [f"k{i}" for i in range(len(keys))]
    rows = df.select(*[F.col(k).cast("string").alias(c) for k, c in zip(keys, names)], units.alias("u"))
    if isinstance(rows.schema["u"].dataType, T.StringType):
        rows = rows.where("u <> ''").withColumn("n", F.length("u"))
    else:
        # outer: else Spark filters by the size of the pieces first, and makes them twice
        rows = rows.select(*names, F.explode_outer(unit_pieces(F.col("u"), max_n)).alias("p")).where("p IS NOT NULL").select(*names, "p.u", "p.n")
    counted = written(_counted(rows, names, max_n, sep), "suffixes")
    parts = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), counted.rdd.getNumPartitions())
    ordered = counted.repartitionByRange(parts, *names, "suffix").sortWithinPartitions(*names, "suffix")
    schema = T.StructType([*[T.StructField(c, T.StringType()) for c in names], T.StructField("n", T.IntegerType()),
                           T.StructField("gram", T.StringType()), T.StructField("cnt", T.LongType()),
                           T.StructField("edge", T.BooleanType())])

    def run(batches):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        def differs(x):
            """Is a row's value another one than the row's before?"""
            same = pc.fill_null(pc.equal(x[1:], x[:-1]), False).to_numpy(zero_copy_only=False)
            none = pc.and_(pc.is_null(x[1:]), pc.is_null(x[:-1])).to_numpy(zero_copy_only=False)
            return ~(same | none)

        for batch in batches:
            heads, suffix = batch.columns[:len(names)], batch.column(len(names))
            if sep:
                suffix = pc.split_pattern(suffix, _between(sep))
            cnt = batch.column(len(names) + 1).to_numpy()
            if sep:
                size = pc.list_value_length(suffix).to_numpy(zero_copy_only=False)
                first, flat = suffix.offsets.to_numpy()[:-1], suffix.values
            else:
                size = pc.utf8_length(suffix).to_numpy(zero_copy_only=False)
            change = np.zeros(batch.num_rows, bool)      # does another prefix of this order begin?
            change[:1] = True
            for h in heads:
                change[1:] |= differs(h)
            for n in range(1, max_n + 1):
                unit = (flat.take(pa.array(first + n - 1, mask=size < n)) if sep
                        else pc.if_else(pa.array(size >= n), pc.utf8_slice_codeunits(suffix, n - 1, n), None))
                change[1:] |= differs(unit)
                starts = np.flatnonzero(change & (size >= n))
                if not len(starts):
                    continue
                sums = np.add.reduceat(np.where(size >= n, cnt, 0), starts)
                edge = np.zeros(len(starts), bool)
                edge[[0, -1]] = True
                kept = edge | (sums >= min_count)    # a prefix that ends within the batch is whole
                starts, sums, edge = starts[kept], sums[kept], edge[kept]
                at = pa.array(starts)
                rows_at = suffix.take(at)
                gram = (_grams(rows_at, n, sep) if sep
                        else pc.utf8_slice_codeunits(rows_at, 0, n))
                yield pa.RecordBatch.from_arrays(
                    [*[h.take(at) for h in heads], pa.array(np.full(len(starts), n, np.int32)), gram, pa.array(sums),
                     pa.array(edge)], names=schema.names)

    found = written(ordered.mapInArrow(run, schema), "grams")
    over = found.where("edge").groupBy(*names, "n", "gram").agg(F.sum("cnt").alias("cnt"))   # 2 max_n rows a batch
    out = found.where("not edge").select(*names, "n", "gram", "cnt").unionByName(over)
    return out.where(F.col("cnt") >= min_count).toDF(*keys, "n", "gram", "cnt")

