"""Cleaning of messy text exports."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from riskspark.functions.numeric import text_to_double

# Patterns of the cleaning rules.
ID_NOISE = r"[^0-9.,\-]"
TRAILING_ZERO = r"\.0$"
ID_SEPARATORS = r"[,.]"
NUMERIC_LIKE = r"^[\d\s.,\-]+$"

# Unicode spaces that Python counts as white space and Java's \\s does not.
WIDE_SPACES = "[\\u00A0\\u1680\\u2000-\\u200A\\u2028\\u2029\\u202F\\u205F\\u3000]"


def plain_spaces(text: Column) -> Column:
    return F.regexp_replace(text, WIDE_SPACES, " ")


def strip(text: Column) -> Column:
    return F.regexp_replace(plain_spaces(text), r"^\s+|\s+$", "")


def clean_id(text: Column) -> Column:
    """An id as bigint: only digits and a sign survive, a trailing ``.0`` is dropped first."""
    kept = F.regexp_replace(text.cast("string"), ID_NOISE, "")
    whole = F.regexp_replace(F.regexp_replace(kept, TRAILING_ZERO, ""), ID_SEPARATORS, "")
    return F.when(whole.rlike(r"^-?\d+$"), whole.try_cast("bigint"))


def clean_numeric(text: Column) -> Column:
    """A decimal number as double; quotes removed, decimal comma accepted, anything else NULL."""
    unquoted = F.regexp_replace(strip(text.cast("string")), '"', "")
    pointed = F.regexp_replace(F.regexp_replace(unquoted, TRAILING_ZERO, ""), ",", ".")
    return text_to_double(pointed)


def numeric_like(text: Column) -> Column:
    """Whether a cell consists of digits, spaces, separators and signs; a missing cell does not."""
    return F.coalesce(plain_spaces(text).rlike(NUMERIC_LIKE), F.lit(False))
