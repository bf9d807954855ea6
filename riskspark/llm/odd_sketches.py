"""Near duplicates by MinHash bands whose candidates are verified by odd sketches, then by whole sets."""

from __future__ import annotations

from math import log, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from riskspark.llm.components import connected_components
from riskspark.llm.differences import LEADER_ROUNDS, open_pairs, size_class
from riskspark.llm.jaccard_join import blocks, mix, shingle_set, stored_set
from riskspark.llm.text import id_and_text
from riskspark.session import cut_lineage

#: A link of similarity 0.8 shares no band with a chance of (1 - 0.8^4)^32 = 5e-8.
BANDS, ROWS = 32, 4
SAMPLES = BANDS * ROWS
#: Bits of an odd sketch, into which SAMPLES samples are folded.
BITS = 1_024
#: Standard deviations by which the estimate may fall short of the threshold before a pair is ruled out.
MARGIN = 6
#: Words of a table of bits that tells which ids may be wanted; false alarms only cost work.
FILTER_WORDS = 1 << 16
_STEP = np.uint64(0x9E3779B97F4A7C15)
_SEEDS = mix(np.arange(1, 2 * SAMPLES + 1, dtype=np.uint64) * _STEP)
_MULTIPLY, _ADD = _SEEDS[:SAMPLES] | np.uint64(1), _SEEDS[SAMPLES:]


def min_hashes(sets: list[np.ndarray]) -> np.ndarray:
    """One row of SAMPLES least hash values for each set; an empty set has the greatest value everywhere."""
    out = np.full((len(sets), SAMPLES), np.iinfo(np.uint64).max, np.uint64)
    full = [i for i, s in enumerate(sets) if len(s)]
    if full:
        tokens = np.concatenate([sets[i] for i in full])
        begins = np.concatenate([[0], np.cumsum([len(sets[i]) for i in full])[:-1]])
        for k in range(SAMPLES):
            out[full, k] = np.minimum.reduceat((tokens ^ _ADD[k]) * _MULTIPLY[k], begins)
    return out


def band_hashes(samples: np.ndarray) -> np.ndarray:
    """One hash for each band of ROWS samples; different bands never mean the same."""
    code = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64) * _STEP, (len(samples), BANDS))
    for k in range(ROWS):
        code = mix(code + samples[:, k::ROWS])
    return code


def odd_sketches(samples: np.ndarray) -> np.ndarray:
    """For each row a bitmap: whether an odd number of its samples falls on each bit."""
    place = mix(samples + np.arange(1, SAMPLES + 1, dtype=np.uint64) * _STEP) & np.uint64(BITS - 1)
    flat = place.astype(np.int64) + BITS * np.arange(len(samples))[:, None]
    counts = np.bincount(flat.ravel(), minlength=BITS * len(samples)).reshape(len(samples), BITS)
    return np.packbits((counts & 1).astype(np.uint8), axis=1)


def differing_samples(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Estimated number of samples in which pairs of sketches differ; each such sample flips two places of their XOR."""
    odd = np.bitwise_count(x ^ y).sum(axis=1)
    left = np.clip(1 - 2 * odd / BITS, 1e-12, None)
    return np.log(left) / (2 * log(1 - 2 / BITS))


def most_differing(percent: int) -> float:
    """Differing samples that a pair of the threshold's similarity exceeds with a chance of about 1e-9."""
    t = percent / 100
    return SAMPLES * (1 - t) + MARGIN * sqrt(SAMPLES * t * (1 - t) + 4)


def _names(sets: list[np.ndarray]) -> list[bytes]:
    """16 bytes that stand for a whole set."""
    import xxhash

    return [xxhash.xxh3_128_digest(s.tobytes()) for s in sets]


def _sketched(n: int):
    memo: dict[bytes, int] = {}
    names = ["id", "s", "n", "odd", "bands"]

    def run(batches):
        for batch in batches:
            for block in blocks(batch):
                sets = [shingle_set(t, n, memo) for t in block.column(1).to_pylist()]
                samples = min_hashes(sets)
                odd, bands = odd_sketches(samples), band_hashes(samples)
                offsets = pa.array(np.arange(0, BANDS * len(sets) + 1, BANDS, dtype=np.int32))
                columns = [block.column(0), pa.array(_names(sets), pa.binary()), pa.array([len(s) for s in sets], pa.int64())]
                columns += [pa.array([o.tobytes() for o in odd], pa.binary()), pa.ListArray.from_arrays(offsets, pa.array(bands.ravel().view(np.int64)))]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return run


def _whole_sets(n: int):
    """mapInArrow function over (s, text): (s, n, tokens) of those texts whose set has the name ``s``."""
    memo: dict[bytes, int] = {}

    def run(batches):
        for batch in batches:
            for block in blocks(batch):
                sets = [shingle_set(t, n, memo) for t in block.column(1).to_pylist()]
                keep = pa.array([a == b for a, b in zip(block.column(0).to_pylist(), _names(sets))], pa.bool_())
                columns = [block.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array([s.tobytes() for s in sets], pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=["id", "n", "tokens"]).filter(keep)

    return run


def _estimated(percent: int):
    """mapInArrow function over (a, b, odd_a, odd_b): the pairs whose sketches leave a link possible."""
    most = most_differing(percent)

    def run(batches):
        for batch in batches:
            x, y = (np.array([np.frombuffer(v.as_buffer(), np.uint8) for v in batch.column(c)]).reshape(-1, BITS // 8) for c in (2, 3))
            keep = pa.array(differing_samples(x, y) <= most)
            yield pa.RecordBatch.from_arrays([c.filter(keep) for c in batch.columns[:2]], names=["a", "b"])

    return run


def _confirmed(percent: int):
    """mapInArrow function over (a, b, tokens_a, tokens_b): the pairs of similar sets."""

    def run(batches):
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3)):
                a, b = stored_set(x), stored_set(y)
                both = len(np.intersect1d(a, b, assume_unique=True))
                keep.append(100 * both >= percent * (len(a) + len(b) - both))
            yield pa.RecordBatch.from_arrays([c.filter(pa.array(keep, pa.bool_())) for c in batch.columns[:2]], names=["a", "b"])

    return run


def _perhaps(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """Rows whose id may be in ``wanted``: a broadcast table of FILTER_WORDS words keeps most others from a shuffle."""
    place, bit = F.pmod(F.xxhash64("id"), F.lit(FILTER_WORDS)), F.shiftrightunsigned(F.xxhash64("id"), 40).bitwiseAND(63).cast("int")
    bits = wanted.groupBy(place.alias("_place")).agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), bit)).alias("_bits"))
    maybe = rows.withColumn("_place", place).join(F.broadcast(bits), "_place")
    return maybe.where(F.call_function("shiftright", "_bits", bit).bitwiseAND(1) == 1).drop("_place", "_bits")


class _Sets:
    """Different sets that share a band with another one, by name."""

    def __init__(self, sketches: DataFrame, rows: DataFrame, n: int, percent: int):
        self.percent = percent
        one = lambda c: F.first(c).alias(c)
        unique = sketches.where("id is not null and n > 0").groupBy("s").agg(F.min("id").alias("id"), one("n"), one("odd"), one("bands"))
        unique = cut_lineage(unique, "unique-sketches")
        every = unique.select(F.explode("bands").alias("sig"), F.col("s").alias("id"))
        shared = every.groupBy("sig").agg(F.count("*").alias("count")).where("count > 1")
        self.postings = cut_lineage(every.join(cut_lineage(shared, "shared-bands"), "sig"), "band-postings")
        weights = self.postings.groupBy("id").agg(F.sum("count").alias("weight"))
        self.weights = cut_lineage(weights.join(unique.select(F.col("s").alias("id"), "n"), "id"), "band-weights")
        candidates = cut_lineage(unique.join(self.weights.select(F.col("id").alias("s")), "s").select("id", "s", "odd"), "candidates")
        self.odd = candidates.select(F.col("s").alias("id"), "odd")
        texts = _perhaps(rows, candidates.select("id")).join(candidates.select("id", "s"), "id").select("s", "text")
        whole = texts.mapInArrow(_whole_sets(n), "id binary, n long, tokens binary")
        # Repeated rows give the same set several times.
        self.sets = cut_lineage(whole.groupBy("id").agg(one("n"), one("tokens")), "whole-sets")

    def confirm(self, pairs: DataFrame) -> DataFrame:
        """Similar pairs among (a, b): odd sketches rule out most others, whole sets decide."""

        def both(left: DataFrame, table: DataFrame, column: str) -> DataFrame:
            side = lambda name: table.select(F.col("id").alias(name), F.col(column).alias(f"{column}_{name}"))
            return left.join(side("a"), "a").join(side("b"), "b").select("a", "b", f"{column}_a", f"{column}_b")

        near = both(cut_lineage(pairs.distinct(), "band-pairs"), self.odd, "odd").mapInArrow(_estimated(self.percent), "a binary, b binary")
        near = cut_lineage(near, "estimated")
        return cut_lineage(both(near, self.sets, "tokens").mapInArrow(_confirmed(self.percent), "a binary, b binary"), "confirmed")

    def open_postings(self, links: DataFrame) -> DataFrame:
        """Postings of bands that sets of several components share."""
        labels = connected_components(links).withColumnRenamed("node", "id")
        labelled = cut_lineage(self.postings.select("sig", "id").join(labels, "id", "left").withColumn("label", F.coalesce("label", "id")), "labelled")
        several = labelled.groupBy("sig").agg(F.min("label").alias("x"), F.max("label").alias("y")).where("x < y").select("sig")
        return cut_lineage(labelled.join(cut_lineage(several, "several"), "sig", "left_semi"), "open-bands")

    def links(self) -> DataFrame:
        """Links enough to connect all that are connected.

        Every set is compared with leaders of its bands, heavy sets that meet most others, one in each of LEADER_ROUNDS. Sets of different
        components that still share a band are compared if their differences from a common leader leave a link possible.
        """
        found = tried = None
        for shift in LEADER_ROUNDS:
            still = self.postings.select("sig", "id", F.col("id").alias("label")) if found is None else self.open_postings(found).select("sig", "id", "label")
            weighed = cut_lineage(still.join(self.weights, "id").withColumn("cls", size_class(F.col("n"), self.percent, shift)), "weighed-bands")
            leaders = cut_lineage(weighed.groupBy("sig", "cls").agg(F.max(F.struct("weight", "id", "label")).alias("lead")), "band-leaders")
            pairs = weighed.join(leaders, ["sig", "cls"]).where(F.col("label") != F.col("lead.label")).select("id", F.col("lead.id").alias("lead"))
            counts = pairs.groupBy("id", "lead").count()
            if tried is not None:
                counts = counts.join(tried, ["id", "lead"], "left_anti")
            best = cut_lineage(counts.groupBy("id").agg(F.max_by("lead", F.struct("count", "lead")).alias("lead")), "best-leaders")
            tried = best if tried is None else tried.unionByName(best)
            more = self.confirm(best.select(F.least("id", "lead").alias("a"), F.greatest("id", "lead").alias("b")))
            found = more if found is None else found.unionByName(more)
        near, pairs = open_pairs(self.open_postings(found).select("sig", "id", "label"), self.weights.select("id", "weight"), self.sets, self.percent)
        return found.unionByName(near).unionByName(self.confirm(pairs))


def near_duplicates(docs: DataFrame, n: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Components of documents whose sets of ``n``-word shingles have a Jaccard similarity of ``percent`` / 100 or more.

    Returns (id, n_shingles, component_id, kept), one row per input row; a component is named by its smallest id, and kept are the
    rows of that id. Words are runs without white space, with A-Z lower-cased; a text of fewer words is one
    shingle; one without words is linked with nothing.

    Sets that agree in one of BANDS bands of MinHash samples are candidates. The samples of a set, folded into a bitmap of
    parities (an odd sketch), tell by the bits of two bitmaps' XOR in how many samples the sets differ; pairs too far apart are ruled
    out, the others are decided by their whole sets. A link at 0.8 is missed by all bands with a chance of 5e-8; ``percent`` is at least 75.

    A NULL text has no words. A row with a NULL id is linked with nothing, its component is NULL, and it is kept. Rows that
    share an id are one document: what one is linked with, the others are too.
    """
    assert 75 <= percent <= 100
    rows = id_and_text(docs, id_col, text_col)
    kind = rows.schema["id"].dataType.simpleString()
    sketches = cut_lineage(rows.mapInArrow(_sketched(n), f"id {kind}, s binary, n long, odd binary, bands array<long>"), "sketches")
    links = _Sets(sketches, rows.where("id is not null and text is not null"), n, percent).links()

    named = sketches.where("id is not null and n > 0").select("id", "s")
    # Different sets of one id belong together.
    spread = named.groupBy("id").agg(F.min("s").alias("a"), F.max("s").alias("z")).where("a < z").select("id", "a")
    bridges = named.join(cut_lineage(spread, "shared-ids"), "id").where("s <> a").select("a", F.col("s").alias("b")).distinct()
    labels = connected_components(links.unionByName(bridges)).withColumnRenamed("node", "s")
    placed = cut_lineage(sketches.select("id", "s", "n").join(labels, "s", "left").withColumn("label", F.coalesce("label", "s")), "placed")
    first = placed.where("id is not null and n > 0").groupBy("label").agg(F.min("id").alias("first"))
    # A text without words shares its set's name with others like it, but is linked only with its own id's other rows.
    own = placed.where("id is not null and n > 0").join(first, "label").groupBy("id").agg(F.min("first").alias("first"))
    out = placed.select("id", "n").join(own, "id", "left")
    component = F.coalesce("first", "id")
    return out.select("id", F.col("n").alias("n_shingles"), component.alias("component_id"), F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"))
