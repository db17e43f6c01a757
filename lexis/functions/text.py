"""Column-level text functions (all JVM-side, no Python UDF)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that the results depend on.
NOUN_TAGS = ["NN", "NNS", "NNP", "NNPS"]
MARKUP_WORDS = ["[[", "]]", "|"]
MID_PREFIX = "/m/"
UNK = "<UNK>"
SENT_START = "<S>"
SENT_END = "</S>"
# Word tokeniser: runs of letters/digits, or any single other non-space character.
TOKEN_PATTERN = r"[\p{L}\p{N}]+|[^\s\p{L}\p{N}]"
# A word: no white space, by Unicode.
WORD_PATTERN = r"[^\s\x1C-\x1F\x85\p{Z}]+"
# Non-greedy bracketed mention.
MENTION_PATTERN = r"\[\[ (.*?) \]\]"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def char_text(text) -> Column:
    """A text without line breaks."""
    return F.regexp_replace(_c(text), "\n", "")


def char_units(text) -> Column:
    """Characters (code points) of a text, line breaks dropped; ``[]`` for ''."""
    t = char_text(text)
    return F.when(F.length(t) == 0, F.array().cast("array<string>")).otherwise(F.split(t, ""))


def whitespace_split(text) -> Column:
    """Maximal runs of characters that are not Unicode white space."""
    return F.regexp_extract_all(_c(text), F.lit(WORD_PATTERN), 0)


def word_units(text) -> Column:
    """Whitespace words of the whole text, lines concatenated."""
    return whitespace_split(text)


def padded_word_units(text) -> Column:
    """Each line becomes ``<S> w1 .. wk </S>``, all lines concatenated."""
    lines = F.split(_c(text), "\n")
    return F.flatten(F.transform(lines, lambda ln: F.concat(
        F.array(F.lit(SENT_START)), whitespace_split(ln), F.array(F.lit(SENT_END)))))


def ngram_keys(units: Column, n: int, sep: str = "") -> Column:
    """Unpadded sliding n-grams of an array, joined with ``sep``.

    ``get`` returns NULL past the end, so the last n-1 windows drop out and a
    too-short array yields ``[]`` without the ``sequence(1,0)`` trap."""
    if n == 1:
        return units

    def window(x, i):
        parts = [x] + [F.get(units, i + k) for k in range(1, n)]
        return F.concat_ws(sep, *parts) if sep else F.concat(*parts)

    if sep:
        # concat_ws skips NULLs, so test the last element explicitly
        return F.filter(
            F.transform(units, lambda x, i: F.when(F.get(units, i + n - 1).isNotNull(), window(x, i))),
            lambda g: g.isNotNull())
    return F.filter(F.transform(units, window), lambda g: g.isNotNull())


def normalise_digits(text) -> Column:
    """Digit runs become ``D`` (no case folding)."""
    return F.regexp_replace(_c(text), "[0-9]+", "D")


def word_tokens(text) -> Column:
    """Regex word tokeniser used by the classifier."""
    return F.regexp_extract_all(_c(text), F.lit(TOKEN_PATTERN), 0)


def slash_encode(word, tag) -> Column:
    return F.concat(_c(word), F.lit("_"), _c(tag))


def slash_word(term) -> Column:
    """Text before the first underscore."""
    return F.substring_index(_c(term), "_", 1)


def slash_tag(term) -> Column:
    """Text after the last underscore."""
    return F.substring_index(_c(term), "_", -1)


def file_stem(path) -> Column:
    """Last path component, either slash."""
    return F.regexp_extract(_c(path), r"([^/\\]+)$", 1)
