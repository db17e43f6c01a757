"""N-gram counting.

Character n-grams come straight from one regular expression per order: a
lookahead ``(?=(.{n}))`` matches at every position and captures the next n
code points, so all overlapping, unpadded n-grams of a text are produced by one
native expression -- no per-position ``substring`` (quadratic on long texts)
and no interpreted higher-order function.  Word n-grams are built from the
word array.  Grams of different orders never collide as strings (a char
n-gram has n code points; word units contain no separator), so one ``gram``
column serves every order and ``n`` is derived after aggregation.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexis.functions.text import ngram_keys

# separator used when units are words; chars are concatenated without one
WORD_SEP = " "


def char_ngrams(text: Column, n: int) -> Column:
    """All overlapping char n-grams of ``text`` (line breaks already removed);
    single code points come from ``split`` (faster than the regex)."""
    if n == 1:
        return F.when(F.length(text) == 0, F.array().cast("array<string>")).otherwise(F.split(text, ""))
    return F.regexp_extract_all(text, F.lit(f"(?s)(?=(.{{{n}}}))"), 1)


def gram_order(gram: Column, sep: str = "") -> Column:
    """Order of a gram key (code points for chars, words for word grams)."""
    if sep:
        return F.size(F.split(gram, sep)).cast("int")
    return F.length(gram).cast("int")


def grams_array(text: Column | None, units: Column | None, orders: Sequence[int], sep: str = "") -> Column:
    """One array holding the grams of every order (char: from ``text``;
    word: from the ``units`` array)."""
    if sep:
        parts = [ngram_keys(units, n, sep) for n in orders]
    else:
        parts = [char_ngrams(text, n) for n in orders]
    return parts[0] if len(parts) == 1 else F.concat(*parts)


def explode_grams(df: DataFrame, keys: Sequence[str], grams: Column) -> DataFrame:
    """One row per gram occurrence: ``keys.., gram``.

    ``explode_outer`` + a null filter instead of ``explode``: the latter makes
    Spark infer ``size(array) > 0`` and build the gram array twice."""
    return df.select(*keys, F.explode_outer(grams).alias("gram")).where(F.col("gram").isNotNull())


def count_ngrams(df: DataFrame, keys: Sequence[str], grams: Column, sep: str = "") -> DataFrame:
    """``keys.., n, gram, cnt`` -- n-grams never cross a row (document)
    boundary; map-side partial aggregation collapses repeats before the shuffle."""
    counted = explode_grams(df, keys, grams).groupBy(*keys, "gram").agg(F.count(F.lit(1)).alias("cnt"))
    return counted.select(*keys, gram_order(F.col("gram"), sep).alias("n"), "gram", "cnt")


def gram_suffix(gram: Column, k: int, n: int, sep: str = "") -> Column:
    """Last ``k`` units of an n-gram key."""
    if k == n:
        return gram
    if sep:
        return F.substring_index(gram, sep, -k)
    return F.substring(gram, n - k + 1, k)


def gram_prefix(gram: Column, k: int, n: int, sep: str = "") -> Column:
    """First ``k`` units of an n-gram key."""
    if k == n:
        return gram
    if sep:
        return F.substring_index(gram, sep, k)
    return F.substring(gram, 1, k)


def gram_middle(gram: Column, n: int, sep: str = "") -> Column:
    """Second unit of a trigram key."""
    assert n == 3
    if sep:
        return F.substring_index(F.substring_index(gram, sep, 2), sep, -1)
    return F.substring(gram, 2, 1)
