"""Token ids and token counts by a tokenizer of the ``tokenizers`` library."""

from __future__ import annotations

import os
import struct
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from riskspark.llm.text import SPACE, id_and_text, keep_in_worker, row_key
from riskspark.session import cut_lineage

#: A worker's memo of pieces between ASCII white space, per tokenizer file.
MEMO_PIECES = 1_200_000
MEMO_PIECE_BYTES = 64
#: Below it, all versions of Unicode agree on what is a letter.
LATIN_END = "\u0250"


def _packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


class Encoder:
    """One tokenizer with a memo of the pieces it has seen.

    White space of ASCII ends every token of these vocabularies: normalisation does not compose across it, no
    pre-token and no special token holds it. So a text's ids are those of its pieces, one after the other, and
    such a place is a proven boundary. ``space_splits`` says whether that holds for the vocabulary.
    """

    _held: dict[str, "Encoder"] = {}

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.memo: dict[bytes, bytes] = {}
        # The text on either side of white space gives the same ids alone as together.
        both = [self._ids(x) for x in ("ab cd", "ab", "cd")]
        self.space_splits = both[0] == both[1] + both[2]
        # Case does not count, and a stop after letters is a token of its own.
        self.folds = all(self._ids(f"Ab{x}") == self._ids("ab") + self._ids(x) for x in ("", ",", "."))

    @classmethod
    def of(cls, path: str) -> "Encoder":
        if path not in cls._held:
            cls._held[path] = cls(path)
        keep_in_worker("tokens", cls._held.clear)
        return cls._held[path]

    def _ids(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _parts(self, piece: bytes) -> tuple[bytes, ...]:
        """What a piece of letters with one stop after them is encoded as: the letters (of ASCII in lower case), then the stop."""
        if self.folds and piece.isascii():
            if piece.isalpha():
                return (piece.lower(),)
            if piece[-1:] in (b",", b".") and piece[:-1].isalpha():
                return (piece[:-1].lower(), piece[-1:])
        elif self.folds and piece[-1:] in (b",", b".") and (word := piece[:-1].decode()).isalpha() and max(word) < LATIN_END:
            return (piece[:-1], piece[-1:])
        return (piece,)

    def ids(self, text: str) -> bytes:
        """The ids of the text as little-endian unsigned 32-bit numbers."""
        if not self.space_splits:
            return _packed(self._ids(text))
        if len(self.memo) > MEMO_PIECES:
            self.memo.clear()
        memo, pieces = self.memo, text.encode().split()
        unseen = [p for p in dict.fromkeys(pieces) if p not in memo]
        if unseen:
            parts = {p: self._parts(p) for p in unseen}
            fresh = [c for c in dict.fromkeys(c for cs in parts.values() for c in cs) if c not in memo]
            encoded = self.tokenizer.encode_batch([c.decode() for c in fresh], add_special_tokens=False)
            memo.update((c, _packed(e.ids)) for c, e in zip(fresh, encoded))
            memo.update((p, b"".join([memo[c] for c in cs])) for p, cs in parts.items() if cs != (p,))
        ids = b"".join([memo[p] for p in pieces])
        for p in unseen:
            if len(p) > MEMO_PIECE_BYTES:
                memo.pop(p, None)
        return ids

    def count(self, text: str) -> int:
        return len(self.ids(text)) // 4


def _marks(text: str, start: int, encoding, low: int, high: int) -> tuple[list[tuple[int, int]], list[int]]:
    """Boundaries of a chunk's encoding at white space in ``low`` to ``high`` (offsets in the document).

    A boundary is where a token ends before white space that the next token comes after. Its mark holds the
    place and a checksum of the tokens on both sides with their places; beside it stands how many tokens of the
    chunk come before it.
    """
    marks, before = [], []
    offsets, ids = encoding.offsets, encoding.ids
    for i in range(1, len(ids)):
        end, begin = offsets[i - 1][1], offsets[i][0]
        at = start + end
        if low <= at < high and begin > end and text[end] in SPACE:
            sides = (ids[i - 1], start + offsets[i - 1][0], at, ids[i], start + begin, start + offsets[i][1])
            marks.append((at, zlib.crc32(repr(sides).encode())))
            before.append(i)
    return marks, before


_MARKS = "array<struct<at:long,sum:long>>"
_ENCODED = f"key binary, chunk int, n long, head {_MARKS}, head_before array<long>, tail {_MARKS}, tail_before array<long>"


def _encoded(path: str, overlap: int):
    """mapInArrow function: chunk rows to their token counts and the boundaries in both overlaps."""

    def run(batches):
        encoder = Encoder.of(path)
        for batch in batches:
            out = {name.split()[0]: [] for name in ("key", "chunk", "n", "head", "head_before", "tail", "tail_before")}
            for row in batch.to_pylist():
                text, start = row["piece"], row["start"]
                e = encoder.tokenizer.encode(text, add_special_tokens=False)
                end = start + len(text)
                # The first and last tokens of a chunk may be cut, so its rim is no place to splice.
                head = _marks(text, start, e, start + 1, start + overlap) if row["chunk"] else ([], [])
                tail = ([], []) if row["last"] else _marks(text, start, e, end - overlap, end - 1)
                values = (row["key"], row["chunk"], len(e.ids), *[([{"at": a, "sum": s} for a, s in m], b) for m, b in (head, tail)])
                for name, value in zip(("key", "chunk", "n"), values[:3]):
                    out[name].append(value)
                for side, (m, b) in zip(("head", "tail"), values[3:]):
                    out[side].append(m)
                    out[f"{side}_before"].append(b)
            marks = pa.list_(pa.struct([("at", pa.int64()), ("sum", pa.int64())]))
            kinds = [pa.binary(), pa.int32(), pa.int64(), marks, pa.list_(pa.int64()), marks, pa.list_(pa.int64())]
            yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(out.values(), kinds)], names=list(out))

    return run


def _spliced(huge: DataFrame, path: str, chunk_chars: int, overlap: int) -> DataFrame:
    """(key, n_tokens) of huge texts; n_tokens is NULL where two neighbours have no boundary in common."""
    step = chunk_chars - overlap
    last = F.greatest(F.ceil((F.col("n_chars") - overlap) / step) - 1, F.lit(0)).cast("int")
    chunks = huge.select("key", "text", F.posexplode(F.sequence(F.lit(0), last)).alias("chunk", "_c"), last.alias("_last")).select(
        "key",
        "chunk",
        (F.col("chunk") * step).cast("long").alias("start"),
        (F.col("chunk") == F.col("_last")).alias("last"),
        F.substring("text", F.col("chunk") * step + 1, F.lit(chunk_chars)).alias("piece"),
    )
    encoded = chunks.repartition("key", "chunk").mapInArrow(_encoded(path, overlap), _ENCODED)
    order = Window.partitionBy("key").orderBy("chunk")
    seams = encoded.select("*", F.lag("tail").over(order).alias("left"), F.lag("tail_before").over(order).alias("left_before"))
    # The leftmost boundary that both encodings show with the same tokens around it.
    seam = F.array_min(F.array_intersect("left", "head"))
    seams = seams.withColumn("seam", seam)
    n_left = F.get("left_before", F.array_position("left", F.col("seam")).cast("int") - 1)
    n_right = F.get("head_before", F.array_position("head", F.col("seam")).cast("int") - 1)
    # Tokens of the left chunk before the seam count, and those of the right one after it.
    change = F.when(F.col("chunk") == 0, F.lit(0)).otherwise(n_left - n_right - F.lag("n").over(order))
    parts = seams.select("key", (F.col("n") + change).alias("part"))
    return parts.groupBy("key").agg(F.when(F.count("part") == F.count("*"), F.sum("part")).alias("n_tokens"))


def token_counts(
    docs: DataFrame,
    path: str,
    limit: int = 2048,
    id_col: str = "doc_id",
    text_col: str = "text",
    chunk_chars: int = 32_768,
    overlap: int = 512,
) -> DataFrame:
    """Tokens of every whole text: (id, n_bytes, n_tokens, over_limit).

    Texts of up to ``chunk_chars`` are encoded where they lie. Longer ones are cut into overlapping chunks that are
    dealt over all tasks and encoded with offsets; neighbours are spliced at the first boundary at white space
    that both show with the same tokens around it. Where there is none, the texts concerned go through again with
    chunks and overlap four times as long, until a chunk holds the whole text. Only token counts and the boundaries in
    the overlaps are shuffled after encoding.

    A NULL text is an empty one with no tokens; a NULL id is allowed and repeated rows each get their row.
    """
    rows = id_and_text(docs, id_col, text_col).select("id", F.coalesce("text", F.lit("")).alias("text")).withColumn("n_chars", F.char_length("text"))
    keyed = rows.select("id", F.octet_length("text").cast("long").alias("n_bytes"), "text", "n_chars")

    def counted(batches):
        encoder = Encoder.of(path)
        for batch in batches:
            counts = [encoder.count(t) for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(counts, pa.int64())], names=["id", "n_bytes", "n_tokens"])

    id_type = rows.schema["id"].dataType.simpleString()
    small = keyed.where(F.col("n_chars") <= chunk_chars).select("id", "n_bytes", "text")
    small = small.mapInArrow(counted, f"id {id_type}, n_bytes long, n_tokens long")

    huge = keyed.where(F.col("n_chars") > chunk_chars).select("id", "n_bytes", row_key(F.col("id"), F.col("text")).alias("key"), "text", "n_chars")
    texts = huge.dropDuplicates(["key"]).select("key", "text", "n_chars")
    done, chunk, width = [], chunk_chars, overlap
    while True:
        tried = cut_lineage(_spliced(texts, path, chunk, width), "token-counts")
        done.append(tried.where("n_tokens is not null"))
        failed = tried.where("n_tokens is null").select("key")
        if failed.isEmpty():
            break
        chunk, width = chunk * 4, width * 4
        texts = texts.join(failed, "key", "left_semi")
    found = done[0]
    for more in done[1:]:
        found = found.unionByName(more)
    large = huge.select("id", "n_bytes", "key").join(found, "key").select("id", "n_bytes", "n_tokens")
    return small.unionByName(large).withColumn("over_limit", F.col("n_tokens") > limit)
