"""Exact candidate pairs among sets that resemble one set without being similar to each other, as changed copies of one text do."""

from __future__ import annotations

from math import log

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from riskspark.session import cut_lineage

#: Classes of a set's excess over what a link allows: so many for each doubling, and for sets that are linked with their leader.
CLASSES = 4
_LINKED_BELOW = 50
#: So many sets of a signature are paired without a look at their differences; more are not, whose result is the same.
FEW = 16


def _from_leader(kind: str):
    """mapInArrow function over (id, lead, tokens, lead_tokens): places of the leader's tokens that a set lacks, and what only the set has."""

    def run(batches):
        for batch in batches:
            out = []
            for x, y in zip(batch.column(2), batch.column(3)):
                a, b = (np.frombuffer(v.as_buffer(), np.int64).view(np.uint64) for v in (x, y))
                lacks = np.flatnonzero(~np.isin(b, a, assume_unique=True)).astype(np.int32)
                out.append((len(a), len(b), lacks, np.setdiff1d(a, b, assume_unique=True).view(np.int64)))
            columns = [batch.column(0), batch.column(1), pa.array([o[0] for o in out], pa.int64()), pa.array([o[1] for o in out], pa.int64())]
            columns += [pa.array([o[2] for o in out], pa.list_(pa.int32())), pa.array([o[3] for o in out], pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "lead", "n", "m", "lacks", "own"])

    return run, f"id {kind}, lead {kind}, n long, m long, lacks array<int>, own array<long>"


def _list(cell: pa.ListScalar) -> np.ndarray:
    return cell.values.to_numpy(zero_copy_only=False) if cell.is_valid else np.empty(0, np.int64)


def _prefixes(kind: str):
    """mapInArrow function over (id, lead, label, n, cls, e, nd, lacks, own, own_times, place, times, other, length): what is indexed of a set.

    ``own`` are the set's own tokens that others of the leader have too, ``lacks`` the places of the leader's tokens that it lacks, ``times``
    how many lack the token at ``place``. A place stands for its token: for all sets of a leader a token is of the same kind.
    ``reach`` tells how much of the difference is left from the token on, itself included.
    """
    names = ["id", "lead", "label", "n", "cls", "e", "token", "other", "reach"]

    def run(batches):
        for batch in batches:
            rows, tokens, others, reaches = [], [], [], []
            for row, (nd, *lists) in enumerate(zip(batch.column(6).to_pylist(), *batch.columns[7:])):
                lacks, own, own_times, place, times, other, length = map(_list, lists)
                order = np.argsort(place)
                lacked = times[order][np.searchsorted(place, lacks, sorter=order)] if len(lacks) else np.empty(0, np.int64)
                token, often = np.concatenate([own, lacks[lacked > 1].astype(np.int64)]), np.concatenate([own_times, lacked[lacked > 1]])
                token, rest = token[np.lexsort((token, often))], nd - len(token)
                # What no other set has stands first and is not indexed.
                for which, long in zip(other, np.clip(length - rest, 0, len(token))):
                    if long:
                        rows.append(np.full(long, row))
                        tokens.append(token[:long])
                        others.append(np.full(long, which, np.int32))
                        reaches.append(nd - rest - np.arange(long))
            flat = lambda parts, kind: pa.array(np.concatenate(parts) if parts else [], kind)
            taken = [c.take(flat(rows, pa.int64())) for c in batch.columns[:6]]
            yield pa.RecordBatch.from_arrays([*taken, flat(tokens, pa.int64()), flat(others, pa.int32()), flat(reaches, pa.int64())], names=names)

    return run, f"id {kind}, lead {kind}, label {kind}, n long, cls int, e long, token long, other int, reach long"


def difference_pairs(members: DataFrame, sets: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """Links of sets with their leaders, and candidate pairs of sets that have a leader in common: both (a, b).

    ``members``: distinct (id, lead, label), sets with one ``label`` being connected already; ``sets``: (id, tokens), the
    sorted 64-bit tokens as bytes. A candidate pair has one leader and two labels; no similar pair of that kind is lost.

    With D the difference of a set to its leader, two sets x and y differ in as many tokens as D(x) and D(y) do. They link
    just when |D(x) and D(y)| >= (e(x) + e(y)) / 2 for e(x) = |D(x)| - |x| (1 - t) / (1 + t). A set that does not link with its
    leader has an e above |leader| (1 - t) / (1 + t), one that links has one above minus that, so that the bound is positive for
    all pairs but those of two that link. So a prefix of D in order of rarity finds the pairs; its length follows from
    e and the least e of a partner's class. What no other set has in its difference stands first and is never indexed.
    The first token that a pair has in common leaves room for the overlap that both their e ask for; other meetings are none.

    Most of what differences share are tokens that the leader has and the sets lack. How many lack each comes with the leader, in
    one row of at most its own size, so that only tokens that the leader lacks are counted and joined one by one.
    """
    kind = sets.schema["id"].dataType.simpleString()
    side = lambda name, tokens: sets.select(F.col("id").alias(name), F.col("tokens").alias(tokens))
    both = members.where("id <> lead").select("id", "lead").join(side("id", "x"), "id").join(side("lead", "y"), "lead").select("id", "lead", "x", "y")
    run, schema = _from_leader(kind)
    found = cut_lineage(both.mapInArrow(run, schema), "differences")
    labels = members.select("id", "lead", "label")

    size = (F.size("lacks") + F.size("own")).cast("long")
    excess = size * (100 + percent) - (100 - percent) * F.col("n")
    allowed = (100 - percent) * F.col("m")
    unit = F.greatest(allowed, F.lit(1))
    near = F.floor(CLASSES * excess / unit)
    far = 2 * _LINKED_BELOW + F.floor(CLASSES * F.log2(F.greatest(excess, F.lit(1)) / unit))
    facts = found.join(labels, ["id", "lead"]).select(
        "id", "lead", "label", "n", size.alias("nd"), excess.alias("e"), F.when(excess <= allowed, near).otherwise(far).cast("int").alias("cls")
    )
    facts = cut_lineage(facts, "difference-facts")
    links = facts.where(F.col("cls") < _LINKED_BELOW).select(F.least("id", "lead").alias("a"), F.greatest("id", "lead").alias("b"))

    classes = facts.groupBy("lead", F.col("cls").alias("other")).agg(
        F.min("e").alias("least"), F.min("n").alias("n_low"), F.max("n").alias("n_high"), F.min("label").alias("l_low"), F.max("label").alias("l_high")
    )
    # One row for each leader: it has at most some dozens of classes, which double in width.
    partners = cut_lineage(classes.groupBy("lead").agg(F.collect_list(F.struct("other", "least", "n_low", "n_high", "l_low", "l_high")).alias("partners")), "difference-classes")

    def possible(p: Column) -> Column:
        sized = (p["n_high"] * 100 >= F.col("n") * percent) & (F.col("n") * 100 >= p["n_low"] * percent)
        unlike = (p["l_low"] != F.col("label")) | (p["l_high"] != F.col("label"))
        return sized & unlike & ((F.col("cls") >= _LINKED_BELOW) | (p["other"] >= _LINKED_BELOW))

    def prefix_of(p: Column) -> Column:
        overlap = F.greatest(F.ceil((F.col("e") + p["least"]) / F.lit(2.0 * (100 + percent)) - 1e-9), F.lit(1))
        return F.struct(p["other"].alias("other"), (F.col("nd") - overlap + 1).alias("prefix"))

    asked = F.filter(F.transform(F.filter("partners", possible), prefix_of), lambda p: p["prefix"] > 0)
    wanted = facts.join(partners, "lead").select("id", "lead", "label", "n", "cls", "e", "nd", asked.alias("asked")).where(F.size("asked") > 0)
    wanted = cut_lineage(wanted, "difference-wanted")

    # Only sets that have a partner class are looked at further.
    active = found.join(wanted.select("id", "lead"), ["id", "lead"])
    lacking = active.select("lead", F.explode("lacks").alias("place")).groupBy("lead", "place").agg(F.count("*").alias("times"))
    lacking = cut_lineage(lacking.groupBy("lead").agg(F.collect_list(F.struct("place", "times")).alias("lacking")), "difference-lacking")
    tokens = cut_lineage(active.select("id", "lead", F.explode("own").alias("token")), "difference-tokens")
    shared = tokens.groupBy("lead", "token").agg(F.count("*").alias("times")).where("times > 1")
    own = tokens.join(shared, ["lead", "token"]).groupBy("id", "lead").agg(F.collect_list(F.struct("token", "times")).alias("own"))
    placed = wanted.join(found.select("id", "lead", "lacks"), ["id", "lead"]).join(own, ["id", "lead"], "left").join(lacking, "lead", "left")
    lists = [F.col(c).alias(c.replace(".", "_")) for c in ("own.token", "own.times", "lacking.place", "lacking.times", "asked.other", "asked.prefix")]
    placed = placed.select("id", "lead", "label", "n", "cls", "e", "nd", "lacks", *lists)
    run, schema = _prefixes(kind)
    prefix = cut_lineage(placed.mapInArrow(run, schema), "difference-prefixes")

    sides = ("id", "label", "n", "e", "reach")
    one = prefix.select("lead", "token", "cls", "other", *[F.col(c).alias(f"{c}_a") for c in sides])
    two = prefix.select("lead", "token", F.col("other").alias("cls"), F.col("cls").alias("other"), *[F.col(c).alias(f"{c}_b") for c in sides])
    fits = (F.col("n_a") * 100 >= F.col("n_b") * percent) & (F.col("n_b") * 100 >= F.col("n_a") * percent)
    fits &= F.col("e_a") + F.col("e_b") <= 2 * (100 + percent) * F.least("reach_a", "reach_b")
    pairs = one.join(two, ["lead", "token", "cls", "other"]).where((F.col("id_a") < F.col("id_b")) & (F.col("label_a") != F.col("label_b")) & fits)
    return links, pairs.select(F.col("id_a").alias("a"), F.col("id_b").alias("b")).distinct()


#: Ways of choosing leaders, one after the other: the heaviest set of a signature, then the heaviest of each class of sizes.
LEADER_ROUNDS = (None, 0.0, 0.5)


def size_class(n: Column, percent: int, shift: float | None) -> Column:
    """Sets whose sizes allow a link are in one class or in neighbouring ones; by another ``shift`` in one. Without a shift all are in one."""
    if shift is None or percent >= 100:
        return F.lit(0)
    return F.floor(F.log(n.cast("double")) / F.lit(log(100 / percent)) + F.lit(shift)).cast("int")


def open_pairs(postings: DataFrame, weights: DataFrame, sets: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """Links and candidate pairs, both (a, b), of sets with different labels that share a signature.

    ``postings``: (sig, id, label); ``weights``: (id, weight). Where at most FEW sets share a signature they are all paired, which
    gives at most FEW pairs a posting. In larger groups the heaviest set leads, and pairs come from differences.
    """
    counted = cut_lineage(postings.groupBy("sig").agg(F.count("*").alias("n")), "open-counts")
    small = cut_lineage(postings.join(counted.where(F.col("n") <= FEW).select("sig"), "sig", "left_semi"), "small-groups")
    one, two = (small.select("sig", F.col("id").alias(i), F.col("label").alias(f"label_{i}")) for i in "ab")
    near = one.join(two, "sig").where((F.col("a") < F.col("b")) & (F.col("label_a") != F.col("label_b"))).select("a", "b").distinct()

    large = postings.join(counted.where(F.col("n") > FEW).select("sig"), "sig", "left_semi")
    large = cut_lineage(large.join(weights, "id"), "large-groups")
    lead = cut_lineage(large.groupBy("sig").agg(F.max(F.struct("weight", "id")).alias("top")), "group-leaders")
    members = cut_lineage(large.join(lead, "sig").select("id", F.col("top.id").alias("lead"), "label").distinct(), "members")
    links, pairs = difference_pairs(members, sets, percent)
    return links, near.unionByName(pairs)
