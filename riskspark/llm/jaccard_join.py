"""Near duplicates by the Jaccard similarity of word n-grams, with token-combination prefixes."""

from __future__ import annotations

from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from riskspark.llm.components import connected_components
from riskspark.llm.differences import LEADER_ROUNDS, open_pairs, size_class
from riskspark.llm.text import begin_task, id_and_text, space_words
from riskspark.session import cut_lineage

#: The share of all hash values that the counted part of a document's tokens lies in.
LOW_SHARE = 1 / 3
#: A token in more than so many prefixes is frequent and is indexed in combinations.
FREQUENT = 32
#: At most so many tokens, the commonest, are of the frequent class, so that the table of them has a bounded size.
MOST_FREQUENT = 1 << 20
#: Words of a fixed table of bits that tells which ids may be wanted; false alarms only cost work.
FILTER_WORDS = 1 << 16
#: Words of which a task remembers the hashes, and bytes of text whose sets are held at once.
MEMO_WORDS, BLOCK_BYTES = 200_000, 2 << 20
_A, _B, _C = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * _A
    x = (x ^ (x >> np.uint64(27))) * _B
    return x ^ (x >> np.uint64(31))


def shingle_set(text: str | None, n: int, memo: dict[bytes, int]) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's ``n``-word shingles; of a shorter text the whole is the one."""
    import xxhash

    words = space_words((text or "").encode())
    if not words:
        return np.empty(0, np.uint64)
    if len(memo) > MEMO_WORDS:
        memo.clear()
    for w in set(words).difference(memo):
        memo[w] = xxhash.xxh3_64_intdigest(w)
    ids = np.fromiter(map(memo.__getitem__, words), np.uint64, len(words))
    n = min(n, len(ids))
    code = np.full(len(ids) - n + 1, n, np.uint64)
    for k in range(n):
        code = mix(code + ids[k : len(ids) - n + 1 + k] + _C)
    return np.unique(code)


class Threshold:
    """Bounds that follow from ``|x and y| >= t |x or y|``, in whole numbers."""

    def __init__(self, percent: int):
        self.t = Fraction(percent, 100)

    def missing(self, n: int) -> int:
        """Most tokens of a set of ``n`` that a partner lacks."""
        return int(n * (1 - self.t))

    def differing(self, n: int) -> int:
        """Most tokens that are in only one of a set of ``n`` and a partner."""
        return int(n * (1 - self.t) / self.t)


def low_part(tokens: np.ndarray) -> np.ndarray:
    return tokens[: np.searchsorted(tokens, np.uint64(int(LOW_SHARE * (1 << 64))))]


def signatures(tokens: np.ndarray, frequent: np.ndarray, limit: Threshold) -> np.ndarray:
    """Signatures of a set of which two similar ones have at least one in common.

    Tokens are in the order rare, then frequent, each by hash; ``missing + 1`` of them make the plain prefix. Its rare
    tokens are signatures. Where the rare ones do not fill it, all of them may be missing from a partner, and the prefix is extended:
    a token in only one of both sets breaks at most two pairs of neighbours among the frequent tokens, so of the first
    ``2 (differing - rare) + 1`` pairs one is a pair of neighbours in a partner too, and within its extended prefix. These pairs
    are signatures.
    """
    at = np.minimum(np.searchsorted(frequent, tokens), max(len(frequent) - 1, 0))
    common = frequent[at] == tokens if len(frequent) else np.zeros(len(tokens), bool)
    rare, often = tokens[~common], tokens[common]
    need = limit.missing(len(tokens)) + 1
    single = rare[:need]
    if len(single) == need or not len(often):
        return single
    often = often[: 2 * max(limit.differing(len(tokens)) - len(rare), 0) + 1]
    # A mark for the beginning stands before the first frequent token, in every set alike.
    pairs = mix(mix(np.concatenate([np.zeros(1, np.uint64), often[:-1]]) + _C) + often)
    return np.concatenate([single, pairs])


def _batch(columns: dict[str, np.ndarray | pa.Array]) -> pa.RecordBatch:
    arrays = [pa.array(v.view(np.int64)) if isinstance(v, np.ndarray) and v.dtype == np.uint64 else v if isinstance(v, pa.Array) else pa.array(v) for v in columns.values()]
    return pa.RecordBatch.from_arrays(arrays, names=list(columns))


def blocks(batch: pa.RecordBatch):
    """Slices of a batch (id, text or tokens, ...) with about BLOCK_BYTES each; a longer row is one by itself or ends one."""
    begin, size = 0, 0
    for at, value in enumerate(batch.column(1)):
        size += len(value.as_buffer()) if value.is_valid else 0
        if size >= BLOCK_BYTES:
            yield batch.slice(begin, at + 1 - begin)
            begin, size = at + 1, 0
    if begin < batch.num_rows:
        yield batch.slice(begin)


def _per_text(n: int, make):
    """mapInArrow function over (id, text): calls ``make(ids, sets)`` for every block with the shingle sets."""
    memo: dict[bytes, int] = {}

    def run(batches):
        begin_task()
        for batch in batches:
            for block in blocks(batch):
                yield make(block.column(0), [shingle_set(t, n, memo) for t in block.column(1).to_pylist()])

    return run


def stored_set(tokens: pa.BinaryScalar) -> np.ndarray:
    return np.frombuffer(tokens.as_buffer(), np.uint64)


def _per_set(make):
    """The same over (id, tokens) of stored sets."""

    def run(batches):
        for batch in batches:
            for block in blocks(batch):
                yield make(block.column(0), [stored_set(t) for t in block.column(1)])

    return run


def _flat(ids: pa.Array, parts: list[np.ndarray]) -> tuple[np.ndarray, pa.Array]:
    owner = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
    return (np.concatenate(parts) if parts else np.empty(0, np.uint64)), ids.take(pa.array(owner, pa.int64()))


def _set_hashes(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Two hashes of each whole set, which stand for it."""
    return np.array([np.bitwise_xor.reduce(mix(s + _C)) for s in sets], np.uint64), np.array([mix(s + _A).sum(dtype=np.uint64) for s in sets], np.uint64)


def _sizes(ids, sets):
    h1, h2 = _set_hashes(sets)
    return _batch({"id": ids, "n": np.array([len(s) for s in sets], np.int64), "h1": h1, "h2": h2})


def _tokens(ids, sets):
    """(token, id); a token of several texts of the batch comes once, without id."""
    tokens, owners = _flat(ids, sets)
    values, first, times = np.unique(tokens, return_index=True, return_counts=True)
    owner = owners.take(pa.array(first[times == 1], pa.int64()))
    alone, shared = values[times == 1], values[times > 1]
    return _batch({"token": np.concatenate([alone, shared]), "id": pa.concat_arrays([owner, pa.nulls(len(shared), owners.type)])})


def _low_tokens(ids, sets):
    return _tokens(ids, [low_part(s) for s in sets])


def _unique(tokens: DataFrame) -> DataFrame:
    """(id, unique): how many tokens only the one text has."""
    alone = tokens.groupBy("token").agg(F.count("*").alias("c"), F.min("id").alias("id")).where("c = 1 and id is not null")
    return alone.groupBy("id").agg(F.count("*").alias("unique"))


def parities(tokens: np.ndarray) -> bytes:
    """For two to four classes of hash values per token: whether the set has an odd number of tokens in each."""
    size = max(64, 1 << max(2 * len(tokens) - 1, 0).bit_length())
    counts = np.bincount((tokens & np.uint64(size - 1)).astype(np.int64), minlength=size)
    return np.packbits((counts & 1).astype(np.uint8), bitorder="little").tobytes()


def least_differing(x: bytes, y: bytes) -> int:
    """A lower bound of the number of tokens in only one of two sets: classes of which one has an odd number and the other not.

    The longer table is folded to the classes of the shorter one.
    """
    a, b = np.frombuffer(x, np.uint8), np.frombuffer(y, np.uint8)
    if len(a) < len(b):
        a, b = b, a
    while len(a) > len(b):
        a = a[: len(a) // 2] ^ a[len(a) // 2 :]
    return int(np.bitwise_count(a ^ b).sum())


def _possible(percent: int):
    """mapInArrow function over (a, b, n_a, n_b, odd_a, odd_b): the pairs (a, b) that parities do not rule out."""

    def run(batches):
        for batch in batches:
            columns = [c.to_pylist() for c in batch.columns[2:]]
            keep = [(n + m) * (100 - percent) >= (100 + percent) * least_differing(x, y) for n, m, x, y in zip(*columns)]
            yield pa.RecordBatch.from_arrays([c.filter(pa.array(keep, pa.bool_())) for c in batch.columns[:2]], names=["a", "b"])

    return run


def _leading_sets(n: int):
    """mapInArrow function over (id, text, h1, h2): the sets of those texts whose set has these hashes, with size and parities."""
    memo: dict[bytes, int] = {}

    def run(batches):
        begin_task()
        for batch in batches:
            for block in blocks(batch):
                sets = [shingle_set(t, n, memo) for t in block.column(1).to_pylist()]
                h1, h2 = _set_hashes(sets)
                asked1, asked2 = (block.column(c).to_numpy(zero_copy_only=False).view(np.uint64) for c in (2, 3))
                keep = pa.array((h1 == asked1) & (h2 == asked2))
                odd, tokens = pa.array([parities(s) for s in sets], pa.binary()), pa.array([s.tobytes() for s in sets], pa.binary())
                found = _batch({"id": block.column(0), "n": np.array([len(s) for s in sets], np.int64), "odd": odd, "tokens": tokens})
                yield found.filter(keep)

    return run


def _verified(percent: int):
    """mapInArrow function over (a, b, tokens_a, tokens_b): the pairs (a, b) of similar sets."""

    def run(batches):
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3)):
                a, b = stored_set(x), stored_set(y)
                both = len(np.intersect1d(a, b, assume_unique=True))
                keep.append(100 * both >= percent * (len(a) + len(b) - both))
            yield pa.RecordBatch.from_arrays([c.filter(pa.array(keep, pa.bool_())) for c in batch.columns[:2]], names=["a", "b"])

    return run


class _Join:
    """The steps of the join over different sets."""

    def __init__(self, percent: int, sets: DataFrame):
        self.percent, self.sets, self.limit = percent, sets, Threshold(percent)
        self.kind = sets.schema["id"].dataType.simpleString()
        self.facts = cut_lineage(self._facts(), "facts")

    def _facts(self) -> DataFrame:
        """(id, n, differing, unique, light) of sets that can have a partner at all.

        Unique tokens of both sets of a pair are in only one of them, so their number is at most ``differing``. Where both
        sets have more than half of that, the pair is none: only a light set with another needs a look. Changed copies
        of one text that are not similar enough to each other are heavy, however many there are.
        """
        unique = _unique(self.sets.select("id", "tokens").mapInArrow(_per_set(_tokens), f"token long, id {self.kind}"))
        sizes = self.sets.select("id", "n", F.expr(f"n * {100 - self.percent} div {self.percent}").alias("differing"))
        facts = sizes.join(unique, "id", "left").withColumn("unique", F.coalesce("unique", F.lit(0)))
        return facts.where(F.expr(f"unique <= n * {100 - self.percent} div 100")).withColumn("light", F.col("unique") * 2 <= F.col("differing"))

    def verify(self, pairs: DataFrame) -> DataFrame:
        """Those of the pairs (a, b) that are similar enough, by their whole sets.

        Sets move only for pairs that the parities of both sets, a small part of a set's size, leave possible.
        """

        def side(name: str, *columns: str) -> DataFrame:
            return self.sets.select(F.col("id").alias(name), *[F.col(c).alias(f"{c}_{name}") for c in columns])

        facts = cut_lineage(pairs, "pairs").join(side("a", "n", "odd"), "a").join(side("b", "n", "odd"), "b")
        possible = facts.select("a", "b", "n_a", "n_b", "odd_a", "odd_b").mapInArrow(_possible(self.percent), f"a {self.kind}, b {self.kind}")
        both = cut_lineage(possible, "possible").join(side("a", "tokens"), "a").join(side("b", "tokens"), "b").select("a", "b", "tokens_a", "tokens_b")
        return cut_lineage(both.mapInArrow(_verified(self.percent), f"a {self.kind}, b {self.kind}"), "links")

    def frequent(self) -> np.ndarray:
        """Tokens of the frequent class: in more than FREQUENT prefixes of one and a half times the plain length."""
        limit = self.limit

        def make(ids, sets):
            tokens, times = np.unique(np.concatenate([s[: limit.missing(len(s)) * 3 // 2 + 2] for s in sets] or [np.empty(0, np.uint64)]), return_counts=True)
            return _batch({"token": tokens, "times": times.astype(np.int64)})

        counts = self.sets.select("id", "tokens").mapInArrow(_per_set(make), "token long, times long").groupBy("token").agg(F.sum("times").alias("times"))
        top = counts.where(F.col("times") > FREQUENT).orderBy(F.desc("times"), "token").limit(MOST_FREQUENT)
        return np.sort(np.array([r["token"] for r in top.collect()], np.int64).view(np.uint64))

    def postings(self) -> DataFrame:
        """(sig, id, n) for signatures that at least two sets have, with the leader of each signature.

        The leader is the set that meets the most others in all its signatures: where copies of one text were
        changed here and there, that is the text itself or what is nearest to it.
        """
        limit, held = self.limit, self.sets.sparkSession.sparkContext.broadcast(self.frequent())

        def make(ids, sets):
            sigs, owners = _flat(ids, [np.unique(signatures(s, held.value, limit)) for s in sets])
            return _batch({"sig": sigs, "id": owners})

        every = self.sets.select("id", "tokens").mapInArrow(_per_set(make), f"sig long, id {self.kind}")
        every = cut_lineage(every.join(self.facts.select("id"), "id", "left_semi"), "signatures")
        shared = cut_lineage(every.groupBy("sig").count().where("count > 1"), "shared-signatures")
        return cut_lineage(every.join(shared, "sig"), "postings")

    def links(self) -> DataFrame:
        """Links enough to connect all that are connected by similarity.

        First every set is compared with leaders of its signatures, one in each round (see ``LEADER_ROUNDS``). Of the sets of different components that still share a
        signature, those are compared whose differences from a common leader share a token of their prefixes
        (see ``open_pairs``). What is connected already needs no further link, so that a group of
        copies of any size takes a number of comparisons in proportion to it.
        """
        postings = self.postings()
        weights = cut_lineage(postings.groupBy("id").agg(F.sum("count").alias("weight")).join(self.facts, "id"), "weights")
        rank = F.struct("weight", "id", "unique", "differing", "label")
        # What has fewest unique tokens leaves most room for links with it.
        near = F.struct((-F.col("unique")).alias("few"), "weight", "id", "unique", "differing", "label")
        found = tried = None
        for shift in LEADER_ROUNDS:
            still = postings.select("sig", "id", F.col("id").alias("label")) if found is None else self._open(postings, found).select("sig", "id", "label")
            weighed = cut_lineage(still.join(weights, "id").withColumn("cls", size_class(F.col("n"), self.percent, shift)), "weighed")
            leaders = cut_lineage(weighed.where("light").groupBy("sig", "cls").agg(F.max(rank if shift is None else near).alias("lead")), "leaders")
            room = F.least("differing", "lead.differing") >= F.col("unique") + F.col("lead.unique")
            pairs = weighed.join(leaders, ["sig", "cls"]).where(room & (F.col("label") != F.col("lead.label"))).select("id", F.col("lead.id").alias("lead"))
            counts = pairs.groupBy("id", "lead").count()
            if tried is not None:
                counts = counts.join(tried, ["id", "lead"], "left_anti")
            best = cut_lineage(counts.groupBy("id").agg(F.max_by("lead", F.struct("count", "lead")).alias("lead")), "best-leaders")
            tried = best if tried is None else tried.unionByName(best)
            more = self.verify(best.select(F.least("id", "lead").alias("a"), F.greatest("id", "lead").alias("b")).distinct())
            found = more if found is None else found.unionByName(more)
        left = cut_lineage(self._open(postings, found).select("sig", "id", "label"), "open-postings")
        near, pairs = open_pairs(left, weights.select("id", "weight"), self.sets, self.percent)
        side = lambda s: weights.select(F.col("id").alias(s), *[F.col(c).alias(f"{c}_{s}") for c in ("unique", "differing", "light")])
        room = (F.least("differing_a", "differing_b") >= F.col("unique_a") + F.col("unique_b")) & (F.col("light_a") | F.col("light_b"))
        rest = pairs.join(side("a"), "a").join(side("b"), "b").where(room).select("a", "b")
        return found.unionByName(near).unionByName(self.verify(rest))

    def _open(self, postings: DataFrame, links: DataFrame) -> DataFrame:
        """Postings of signatures that sets of several components share, with size and component."""
        labels = connected_components(links).withColumnRenamed("node", "id")
        labelled = postings.select("sig", "id").join(self.facts, "id").join(labels, "id", "left")
        labelled = cut_lineage(labelled.withColumn("label", F.coalesce("label", "id")), "labelled")
        several = cut_lineage(labelled.groupBy("sig").agg(F.min("label").alias("x"), F.max("label").alias("y")).where("x < y").select("sig"), "several")
        return labelled.join(several, "sig", "left_semi")


def near_duplicates(docs: DataFrame, n: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Components of documents whose sets of ``n``-word shingles have a Jaccard similarity of ``percent`` / 100 or more.

    Returns (id, n_shingles, component_id), one row per input row; the component is named by its smallest id. Words are
    runs without white space, with A-Z lower-cased; a text of fewer words is one shingle; one without words is linked with
    nothing. ``percent`` is at least 75, which the extended prefixes need.

    A document with more unique shingles than a partner may lack has no partner; counting a third of the hash space tells so for
    nearly all that have none. The others, one for each set, are joined by their signatures (see ``signatures``); pairs that
    parities (see ``least_differing``) leave possible are verified by their whole sets.

    A NULL text has no words. A row with a NULL id is linked with nothing and its component is NULL. Rows that share an id are
    one document: what one is linked with, the others are too.
    """
    assert percent >= 75
    limit = Threshold(percent)
    rows = id_and_text(docs, id_col, text_col)
    kind = rows.schema["id"].dataType.simpleString()
    sizes = cut_lineage(rows.mapInArrow(_per_text(n, _sizes), f"id {kind}, n long, h1 long, h2 long"), "sizes")
    named = rows.where("id is not null and text is not null")

    unique = _unique(named.mapInArrow(_per_text(n, _low_tokens), f"token long, id {kind}"))
    missing = F.expr(f"n * {100 - percent} div 100")
    candidates = sizes.where("id is not null and n > 0").join(unique, "id", "left").where(F.coalesce("unique", F.lit(0)) <= missing)
    candidates = cut_lineage(candidates.select("id").distinct(), "candidates")

    # Of equal sets one leads; only texts of leaders move, once, and become stored sets.
    sets = cut_lineage(sizes.where("id is not null and n > 0").join(candidates, "id").select("id", "h1", "h2").distinct(), "sets")
    firsts = cut_lineage(sets.groupBy("h1", "h2").agg(F.min("id").alias("first")), "firsts")
    copies = cut_lineage(sets.join(firsts, ["h1", "h2"]).select("id", "first").distinct(), "copies")

    # A fixed table of bits keeps most other texts from moving to the exact join. That one is no semi join, since Spark
    # would push it below the table of bits.
    place, bit = F.pmod(F.xxhash64("id"), F.lit(FILTER_WORDS)), F.shiftrightunsigned(F.xxhash64("id"), 40).bitwiseAND(63).cast("int")
    leaders = firsts.select(F.col("first").alias("id"), "h1", "h2")
    bits = leaders.groupBy(place.alias("place")).agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), bit)).alias("bits"))
    maybe = named.withColumn("place", place).join(F.broadcast(bits), "place").where(F.call_function("shiftright", "bits", bit).bitwiseAND(1) == 1)
    wanted = maybe.select("id", "text").join(leaders, "id").select("id", "text", "h1", "h2")
    leading = cut_lineage(wanted.mapInArrow(_leading_sets(n), f"id {kind}, n long, odd binary, tokens binary"), "leading-sets")

    between = _Join(percent, leading).links()
    same = copies.where("id <> first").select(F.col("first").alias("a"), F.col("id").alias("b"))
    labels = connected_components(between.unionByName(same)).withColumnRenamed("node", "id")
    out = sizes.join(labels, "id", "left")
    return out.select("id", F.col("n").alias("n_shingles"), F.coalesce("label", "id").alias("component_id"))
