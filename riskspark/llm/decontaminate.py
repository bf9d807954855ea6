"""Finding benchmark passages in documents by a prefix-filtered set join."""

from __future__ import annotations

from collections import defaultdict
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from riskspark.llm.text import id_and_text, letter_words
from riskspark.session import cut_lineage

SHINGLE = 3
#: Words of one block of items; a block's index is what is broadcast, and more items make more blocks.
BLOCK_WORDS = 2_000_000
_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9))


@dataclass
class Index:
    """Windows of a block of items.

    ``word``: number of each item word, from 1 (0 is any other word). ``windows``: the windows as tuples of numbers.
    ``items``: the items of each window. ``prefix``: per shingle size, from a shingle to the (window, place in it) for which it is the
    rarest shingle, and so the prefix token: when all of a window has to be found, a prefix of one is enough.
    """

    word: dict[bytes, int] = field(default_factory=dict)
    windows: list[tuple[int, ...]] = field(default_factory=list)
    items: list[list[int]] = field(default_factory=list)
    prefix: dict[int, dict[int, list[tuple[int, int]]]] = field(default_factory=dict)


def shingles(numbers: np.ndarray, size: int) -> np.ndarray:
    """64-bit codes of runs of ``size`` word numbers; 0 where a word of the run is no item word."""
    if len(numbers) < size:
        return np.empty(0, np.uint64)
    code, known = np.zeros(len(numbers) - size + 1, np.uint64), np.ones(len(numbers) - size + 1, bool)
    for k in range(size):
        part = numbers[k : len(numbers) - size + 1 + k]
        code = (code ^ part.astype(np.uint64)) * _MIX[k]
        code ^= code >> np.uint64(29)
        known &= part > 0
    code[code == 0] = 1
    code[~known] = 0
    return code


def _windows(items: list[tuple[int, str]], window: int) -> Index:
    index, seen = Index(), {}
    for number, text in items:
        words = letter_words((text or "").encode())
        ids = [index.word.setdefault(w, len(index.word) + 1) for w in words]
        for at in range(max(1, len(ids) - window + 1)) if ids else ():
            key = tuple(ids[at : at + window])
            w = seen.setdefault(key, len(seen))
            if w == len(index.windows):
                index.windows.append(key)
                index.items.append([])
            if number not in index.items[w]:
                index.items[w].append(number)
    return index


def _numbers(index: Index, text: str | None) -> np.ndarray:
    get = index.word.get
    return np.array([get(w, 0) for w in letter_words((text or "").encode())], np.int64)


def _rarities(docs: DataFrame, index: Index) -> dict[tuple[int, int], int]:
    """How often each item shingle occurs in all documents."""
    sizes = sorted({min(SHINGLE, len(w)) for w in index.windows})
    wanted = {s: np.unique(np.concatenate([shingles(np.array(w), s) for w in index.windows if min(SHINGLE, len(w)) == s])) for s in sizes}
    held = docs.sparkSession.sparkContext.broadcast((index.word, wanted))

    def counted(batches):
        word, known = held.value
        words = Index(word=word)
        sums = {s: np.zeros(len(v), np.int64) for s, v in known.items()}
        for batch in batches:
            for text in batch.column(0).to_pylist():
                numbers = _numbers(words, text)
                for s, v in known.items():
                    codes = shingles(numbers, s)
                    codes = codes[codes != 0]
                    at = np.minimum(np.searchsorted(v, codes), len(v) - 1)
                    np.add.at(sums[s], at[v[at] == codes], 1)
        for s, total in sums.items():
            at = np.flatnonzero(total)
            columns = [pa.array(np.full(len(at), s, np.int32)), pa.array(known[s][at].view(np.int64)), pa.array(total[at])]
            yield pa.RecordBatch.from_arrays(columns, names=["size", "shingle", "n"])

    counts = docs.select("text").mapInArrow(counted, "size int, shingle long, n long").groupBy("size", "shingle").agg(F.sum("n").alias("n"))
    found = {(r["size"], r["shingle"] % (1 << 64)): r["n"] for r in counts.collect()}
    held.unpersist()
    return found


def _build(docs: DataFrame, items: list[tuple[int, str]], window: int) -> Index:
    """The index of a block: shingles in the order of rarity, of which every window contributes the first."""
    index = _windows(items, window)
    if index.windows:
        rarity = _rarities(docs, index)
        prefix: dict[int, dict[int, list]] = defaultdict(lambda: defaultdict(list))
        for w, words in enumerate(index.windows):
            size = min(SHINGLE, len(words))
            codes = shingles(np.array(words), size).tolist()
            rarest = min(range(len(codes)), key=lambda i: (rarity.get((size, codes[i]), 0), codes[i], i))
            prefix[size][codes[rarest]].append((w, rarest))
        index.prefix = {s: dict(p) for s, p in prefix.items()}
    return index


def find(numbers: np.ndarray, index: Index, keys: dict[int, np.ndarray]) -> list[tuple[int, int]]:
    """(start, window) of every occurrence in a document of which the word numbers are given."""
    out = []
    for size, prefix in index.prefix.items():
        codes = shingles(numbers, size)
        at = np.flatnonzero(codes)
        known = keys[size]
        near = np.minimum(np.searchsorted(known, codes[at]), len(known) - 1)
        for p in at[known[near] == codes[at]].tolist():
            for w, place in prefix[int(codes[p])]:
                words, start = index.windows[w], p - place
                # Position and length bounds, then the words themselves.
                if start >= 0 and start + len(words) <= len(numbers) and tuple(numbers[start : start + len(words)].tolist()) == words:
                    out.append((start, w))
    return out


def _searched(docs: DataFrame, index: Index) -> DataFrame:
    held = docs.sparkSession.sparkContext.broadcast(index)

    def run(batches):
        block = held.value
        keys = {s: np.array(sorted(p), np.uint64) for s, p in block.prefix.items()}
        for batch in batches:
            n_words, spans, items = [], [], []
            for text in batch.column(1).to_pylist():
                numbers = _numbers(block, text)
                hits = find(numbers, block, keys) if block.prefix else []
                merged: list[list[int]] = []
                for start, w in sorted(hits):
                    end = start + len(block.windows[w])
                    if merged and start <= merged[-1][1]:
                        merged[-1][1] = max(merged[-1][1], end)
                    else:
                        merged.append([start, end])
                n_words.append(len(numbers))
                spans.append([{"start": a, "end": b} for a, b in merged])
                items.append(sorted({i for _, w in hits for i in block.items[w]}))
            kinds = [pa.int64(), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])), pa.list_(pa.int64())]
            columns = [batch.column(0), *[pa.array(v, k) for v, k in zip((n_words, spans, items), kinds)]]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "n_words", "spans", "items"])

    kind = docs.schema["id"].dataType.simpleString()
    return docs.select("id", "text").mapInArrow(run, f"id {kind}, n_words long, spans array<struct<start:long,end:long>>, items array<long>")


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, window: int = 10, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text"
) -> DataFrame:
    """Words of documents that lie in a benchmark window: (id, n_words, n_hit, spans, items, contaminated).

    A window is ``window`` consecutive words of an item, or the whole of a shorter one. Every window joins by its rarest
    shingle in the corpus, then passes position and length bounds, then is compared word by word. ``spans`` are the
    merged hit ranges in words, ``items`` the items with an occurring window. Item ids are integers.

    Items come in blocks of at most BLOCK_WORDS words or so, and only a block's index is broadcast; all documents are
    searched for every block. With one block, which is the usual case, there is no shuffle of documents at all.
    A NULL text has no words; an item of NULL text or id is ignored; repeated items are one; repeated rows get a row
    each. Without any item nothing is hit.
    """
    rows = id_and_text(docs, id_col, text_col)
    items = benchmark.select(F.col(f"`{item_col}`").cast("long").alias("item"), F.col(f"`{item_text_col}`").alias("words")).where("item is not null and words is not null").distinct()
    total = items.agg(F.sum(F.octet_length("words"))).first()[0] or 0
    blocks = 1 + int(total) // (6 * BLOCK_WORDS)
    block_of = F.pmod(F.xxhash64("item"), F.lit(blocks))
    load = lambda b: sorted((r["item"], r["words"]) for r in items.where(block_of == b).collect())
    if blocks == 1:
        found = _searched(rows, _build(rows, load(0), window))
    else:
        keyed = cut_lineage(rows.withColumn("_row", F.monotonically_increasing_id()), "decontaminate")
        kind = rows.schema["id"].dataType
        packed = keyed.select(F.struct("_row", "id").alias("id"), "text")
        parts = [cut_lineage(_searched(packed, _build(packed, load(b), window)).where((F.size("spans") > 0) | F.lit(b == 0)), "decontaminate-block") for b in range(blocks)]
        every = parts[0]
        for part in parts[1:]:
            every = every.unionByName(part)
        merged = every.groupBy("id").agg(F.max("n_words").alias("n_words"), F.flatten(F.collect_list("spans")).alias("spans"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
        found = merged.select(F.col("id.id").cast(kind).alias("id"), "n_words", merge_spans("spans").alias("spans"), "items")
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda acc, s: acc + s["end"] - s["start"])
    return found.select("id", "n_words", hit.alias("n_hit"), "spans", "items", (hit > 0).alias("contaminated"))


def merge_spans(spans):
    """Sorted, disjoint spans that cover the same words."""
    kind = "array<struct<start:long,end:long>>"

    def step(acc, s):
        last = F.try_element_at(acc, F.lit(-1))
        longer = F.struct(last["start"].alias("start"), F.greatest(last["end"], s["end"]).alias("end"))
        joined = F.concat(F.slice(acc, F.lit(1), F.greatest(F.size(acc) - 1, F.lit(0))), F.array(longer))
        return F.when((F.size(acc) > 0) & (s["start"] <= F.try_element_at(acc, F.lit(-1))["end"]), joined).otherwise(F.concat(acc, F.array(s)))

    return F.aggregate(F.array_sort(spans), F.array().cast(kind), step)
