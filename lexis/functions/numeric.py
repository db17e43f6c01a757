"""Null-safe numeric helpers (ANSI mode: division by zero raises)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def safe_div(a: Column, b: Column) -> Column:
    return F.try_divide(a, b)


def log2_or_null(x: Column) -> Column:
    """log2 for positive input, NULL otherwise (never evaluates log2(0))."""
    return F.when(x > 0, F.log2(x))


def perplexity_from(logprob: Column, units: Column) -> Column:
    """``2 ** (-(1/M) * logprob)``; M = 0 -> NULL (the reference fails there)."""
    return F.when(units > 0, F.pow(F.lit(2.0), -logprob / units))
