"""Helpers shared by the operators: byte-exact text rules, row keys and Arrow batches of bounded size."""

from __future__ import annotations

import string
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: ``[\x20\x09-\x0D]``, which is also what ``bytes.split()`` takes as white space.
SPACE = " \t\n\x0b\x0c\r"
BATCH_BYTES = 16 << 20

#: Bytes of words ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` after lower-casing A-Z; every other byte becomes a space.
_WORD_BYTES = bytes(
    ord(chr(b).lower()) if chr(b) in string.ascii_letters else b if b >= 0x80 or chr(b) in string.digits else 0x20 for b in range(256)
)


#: What operators keep in a worker beyond a task, by operator: functions that let go of it.
_KEPT: dict[str, Callable[[], None]] = {}


def keep_in_worker(name: str, release: Callable[[], None]) -> None:
    """``release`` is called when a task of another operator begins in this worker, which calls ``begin_task``."""
    _KEPT[name] = release


def begin_task() -> None:
    """Let go of what earlier tasks of other operators have left in this worker, so that it doesn't add to the memory of this one."""
    while _KEPT:
        _KEPT.popitem()[1]()
    pa.default_memory_pool().release_unused()


def ascii_lower(col: Column) -> Column:
    """Lower-case A-Z and nothing else (pure ASCII takes the fast built-in)."""
    ascii_only = F.octet_length(col) == F.char_length(col)
    return F.when(ascii_only, F.lower(col)).otherwise(F.translate(col, string.ascii_uppercase, string.ascii_lowercase))


def row_key(id_col: Column, text: Column) -> Column:
    """16 bytes that stand for a row's id and text; equal rows share it, a NULL id is a value of its own."""
    return F.unhex(F.md5(F.concat(F.coalesce(id_col.cast("string"), F.lit("\x00")), F.lit("\x1f"), text)))


def space_words(text: bytes) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text with A-Z lower-cased."""
    return text.lower().split()


def letter_words(text: bytes) -> list[bytes]:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of a text with A-Z lower-cased."""
    return text.translate(_WORD_BYTES).split()


def bounded_batches(spark: SparkSession) -> None:
    """Arrow batches hold at most BATCH_BYTES, however long the texts are; a user's own setting stands."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if name not in spark.conf.getAll:
        spark.conf.set(name, str(BATCH_BYTES))


def id_and_text(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Only (id, text) of the input, under these names, whatever other columns it has."""
    bounded_batches(docs.sparkSession)
    return docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
