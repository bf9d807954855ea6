"""Reproducible pseudo-random numbers derived from row keys."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# 13 hex digits = 52 bits, exactly representable in a double.
_HEX_DIGITS = 13
_SCALE = float(16**_HEX_DIGITS)


def hash_rank(key: Column, seed) -> Column:
    """A 52-bit integer from md5(key|seed); the same in any SQL engine with md5."""
    text = F.concat(key.cast("string"), F.lit("|"), F.lit(str(seed)) if not isinstance(seed, Column) else seed.cast("string"))
    return F.conv(F.substring(F.md5(text), 1, _HEX_DIGITS), 16, 10).cast("bigint")


def hash_uniform(key: Column, seed) -> Column:
    """``hash_rank`` scaled to [0, 1)."""
    return hash_rank(key, seed).cast("double") / F.lit(_SCALE)
