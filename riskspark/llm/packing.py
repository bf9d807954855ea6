"""Packing of documents into training sequences by power-of-two pieces."""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from riskspark.llm.text import id_and_text
from riskspark.llm.tokens import Encoder


def binary_lengths(n: int, longest: int) -> list[int]:
    """Lengths of the pieces of ``n`` tokens: as many of ``longest`` as fit, then the powers of two of the rest."""
    rest = n % longest
    return [longest] * (n // longest) + [1 << k for k in range(longest.bit_length() - 2, -1, -1) if rest >> k & 1]


def pack(docs: DataFrame, path: str, longest: int = 2048, end_id: int = 1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Cut every document's ids (its text's, then ``end_id``) into pieces whose lengths are powers of two.

    A piece is a sequence of its own, so none crosses documents and none is padded; pieces of one length share a
    ``bucket`` (the exponent), from which batches of equal shape can be drawn, for instance by writing
    ``partitionBy("bucket")``. ``longest`` is a power of two. Returns (id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset, bucket, ids); ``ids_crc32`` is the CRC of ``ids`` as little-endian 4-byte numbers. Sequence ids are unique: the task's number in the upper bits, a
    running number in the lower 36. There is no shuffle.

    A NULL or empty text is ``end_id`` alone; repeated rows and NULL ids are packed as they come.
    """
    assert longest > 0 and longest & (longest - 1) == 0, "longest must be a power of two"
    rows = id_and_text(docs, id_col, text_col).select("id", F.coalesce("text", F.lit("")).alias("text"))
    names = ["id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "bucket", "ids"]
    schema = f"id {rows.schema['id'].dataType.simpleString()}, " + ", ".join(f"{n} long" for n in names[1:7]) + ", bucket int, ids array<int>"
    tail = int(end_id).to_bytes(4, "little")

    def packed(batches):
        encoder, number = Encoder.of(path), TaskContext.get().partitionId() << 36
        for batch in batches:
            row, start, length, total, ids = [], [], [], [], []
            for i, text in enumerate(batch.column(1).to_pylist()):
                encoded, at = encoder.ids(text) + tail, 0
                ids.append(encoded)
                for n in binary_lengths(len(encoded) // 4, longest):
                    row.append(i)
                    start.append(at)
                    length.append(n)
                    total.append(len(encoded) // 4)
                    at += n
            count = len(row)
            # The pieces follow one another, so all of a batch share one buffer.
            ends, raw = np.concatenate([[0], np.cumsum(length, dtype=np.int64)]), b"".join(ids)
            crc = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]
            columns = [batch.column(0).take(pa.array(row, pa.int64())), *[pa.array(x, pa.int64()) for x in (start, length, crc, total)]]
            columns += [pa.array(np.arange(number, number + count)), pa.array(np.zeros(count, np.int64))]
            columns.append(pa.array([n.bit_length() - 1 for n in length], pa.int32()))
            columns.append(pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(np.frombuffer(raw, "<i4"))))
            number += count
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return rows.mapInArrow(packed, schema)
