"""Rounding and hash-derived numbers shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_exact(value: Column, digits: int) -> Column:
    """Round a double the way Python does: half-even on its exact binary value."""
    pattern = "0." + "0" * digits
    return F.call_function("format_number", value, F.lit(pattern)).cast("double")


def hash_digits(*parts: Column) -> Column:
    """32 hex digits that depend only on the given columns."""
    return F.md5(F.concat_ws("|", *[p.cast("string") for p in parts]))


def digits_to_int(digest: Column, start: int) -> Column:
    """Eight hex digits of a digest, from 1-based ``start``, as a BIGINT."""
    return F.conv(F.substring(digest, start, 8), 16, 10).cast("bigint")


def digits_to_unit(digest: Column, start: int = 1) -> Column:
    """Eight hex digits as a double in [0, 1)."""
    return digits_to_int(digest, start) / F.lit(4294967296.0)


def safe_ratio(num: Column, den: Column) -> Column:
    """num / den, and 0 where the denominator is 0."""
    return F.when(den == 0, F.lit(0.0)).otherwise(num / den)
