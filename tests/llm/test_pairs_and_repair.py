"""Conversation repair, hard negatives, odd sketches and difference prefixes against plain Python."""

import hashlib
import random
import re
import zlib
from collections import defaultdict
from itertools import product

import numpy as np
import pyarrow.parquet as pq
import pytest
from oracle_check import compare, connect
from pyspark.sql import functions as F
from test_operators import SF, brute_components

from riskspark.llm import conversations, hard_negatives as mining, jaccard_join, odd_sketches, queries
from riskspark.llm.text import SPACE

NEXT = {0: 2, 1: 2, 2: 3, 3: 2}
KEEP = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (3, "u"): 2, (2, "a"): 3}


def faults(rows):
    """For each row (turn, role, text) its first fault."""
    seen, out = set(), []
    for _, role, text in rows:
        body = text.strip(SPACE)
        out.append("blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def brute_repair(rows):
    """The least (cost, audit, lines) from every node of the lattice, relaxed until nothing changes."""
    found = faults(rows)
    best = {(len(rows), 0): (0, "", ()), (len(rows), 3): (0, "", ())}
    changed = True
    while changed:
        changed = False
        for i, s in product(range(len(rows), -1, -1), range(4)):
            name = {2: "user", 3: "assistant"}[NEXT[s]]
            steps = [((i, NEXT[s]), 3, "I", (name + ":",))]
            if i < len(rows):
                _, role, text = rows[i]
                steps.append(((i + 1, s), 4, "D", ()))
                if found[i] not in ("blank", "duplicate"):
                    more = 3 if found[i] == "truncated" else 0
                    steps.append(((i + 1, NEXT[s]), 3 + more, "R", (f"{name}:{text}",)))
                    if (s, role[:1]) in KEEP:
                        steps.append(((i + 1, KEEP[s, role[:1]]), more, "K", (f"{role}:{text}",)))
            ways = [(best[to][0] + c, letter + best[to][1], line + best[to][2]) for to, c, letter, line in steps if to in best]
            if (i, s) in best:
                ways.append(best[i, s])
            if ways and min(ways) != best.get((i, s)):
                best[i, s] = min(ways)
                changed = True
    cost, audit, lines = best[0, 0]
    turns = {t for t, _, _ in rows if t is not None}
    return {
        "gaps": max(turns) - min(turns) + 1 - len(turns) if turns else 0,
        **{name: found.count(name) for name in ("blank", "duplicate", "truncated")},
        "illegal": sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:])),
        "cost": cost, "audit": audit, "repaired_sha256": hashlib.sha256("\n".join(lines).encode()).hexdigest(),
    }


def damaged(rows):
    out = defaultdict(list)
    said = lambda x: " " if x is None else x
    for conv, turn, role, text in rows:
        role, text = said(role), said(text)
        kind = zlib.crc32(f"{said(conv)}:{said(turn)}".encode()) % 20
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out[conv] += [] if kind == 0 else [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    mark = lambda r: hashlib.md5(f"{len(r[1])}|{r[1]}|{r[2]}".encode()).digest()
    return {c: sorted(v, key=lambda r: (r[0] is not None, r[0] or 0, r[1], mark(r))) for c, v in out.items()}


def repaired(df):
    rows = conversations.repair(conversations.damage(df), df.select(F.col("conv_id").alias("conv"))).collect()
    return {r["conv"]: {k: v for k, v in r.asDict().items() if k != "conv"} for r in rows}


def test_repair_equals_brute_force(spark):
    rows = [tuple(r.values()) for r in pq.read_table(f"{SF}/conversations.parquet", columns=["conv_id", "turn", "role", "text"]).to_pylist()]
    got = {r["conv_id"]: {k: v for k, v in r.asDict().items() if k != "conv_id"} for r in queries.op11_conversation_repair(spark, SF).collect()}
    assert got == {c: brute_repair(v) for c, v in damaged(rows).items()}
    assert len({v["audit"] for v in got.values()}) > 20


@pytest.mark.parametrize("bits", [(8, 10), (2, 1)])
def test_repair_of_long_conversations_in_segments(spark, monkeypatch, bits):
    """NULLs in every column, repeated rows, ties, an empty conversation, foreign roles, a clashing column; runs of four rows, folded in twos."""
    monkeypatch.setattr(conversations, "SEGMENT_BITS", bits[0])
    monkeypatch.setattr(conversations, "FOLD_BITS", bits[1])
    rng, rows = random.Random(5), []
    words = lambda: rng.choice(["a.", "b.", "c", "", " ", None, *[f"x{rng.randrange(99)}." for _ in range(6)]])
    for conv in (None, 1, 2, 3, 4, 5):
        for turn in range(40 if conv != 4 else 3):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", None])
            rows += [(conv, rng.choice([turn, turn, turn, None]), role, words())] * rng.choice([1, 1, 2, 5]) if conv != 5 else []
    rows += [(5, None, "user", None), (5, None, None, "é" * 100_000)]
    df = spark.createDataFrame([(*r, 7) for r in rows], "conv_id long, turn long, role string, text string, c int").repartition(3)
    assert repaired(df) == {c: brute_repair(v) for c, v in damaged(rows).items()}
    assert repaired(df.where("false")) == {}


def test_both_heaps_find_all_least_ways():
    """Every audit of small lattices is tried."""
    rng = random.Random(3)
    for _ in range(60):
        rows = [(rng.randrange(4) + rng.choice([0, 0, 4, 8]), rng.choice([1, 1, 2])) for _ in range(rng.randrange(4))]
        ahead, back = conversations.edges(rows, trailing=True)
        goals, ways = [4 * len(rows) + s for s in conversations.ACCEPTING], []
        stack = [(0, 0, "")]
        while stack:
            node, cost, audit = stack.pop()
            if node in goals:
                ways.append((cost, audit))
            stack += [(to, cost + c, audit + letter) for to, c, letter in ahead[node] if cost + c <= 24 and len(audit) < 9]
        assert conversations.cheapest(ahead, back, 0, goals) == min(ways)
    assert conversations.cheapest(*conversations.edges([], trailing=False), 0, [1]) is None


def brute_negatives(rows):
    """rows: (vec_id, embedding, label)."""
    usable = {}
    for i, v, label in rows:
        if label is not None and v is not None and all(x is not None and np.isfinite(x) for x in v):
            label = (label + 1) % 10 if i is not None and i % 7 == 0 else label
            usable[i, label, tuple(int(np.floor(256 * float(x))) for x in v)] = None
    score = lambda a, b: sum(x * y for x, y in zip(a, b))
    out = []
    for i, label, v in usable:
        if i is None or i % 50:
            continue
        scored = sorted((-score(v, w), j is None, j or 0, j, other) for j, other, w in usable if j != i)
        same = [(-s, j) for s, _, _, j, other in scored if other == label][:5]
        for ps, p in same:
            fits = [(-s, j) for s, _, _, j, other in scored if other != label and 50 * ps <= -100 * s <= 95 * ps][:3]
            out += [(i, p, rank, j, ps, s) for rank, (s, j) in enumerate(fits, 1)]
    return out


COLUMNS = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def test_hard_negatives_equal_sql(spark):
    assert compare(queries.op12_hard_negatives(spark, SF), connect(SF), queries.OP12_SQL) == ""


@pytest.mark.parametrize("sizes", [(8_192, 128, 8), (40, 4, 2)])
def test_hard_negatives_on_edge_cases(spark, monkeypatch, sizes):
    """NULLs in every column, components that are not finite, ties, repeated rows, short vectors, one very common vector, a clashing column."""
    for name, size in zip(("TILE_ROWS", "LEAF_ROWS", "FANOUT"), sizes):
        monkeypatch.setattr(mining, name, size)
    monkeypatch.setattr(mining, "BLOCK_BYTES", 600)
    rng = random.Random(1)
    vector = lambda n=3: [rng.choice([-1.0, -0.5, 0.0, 0.25, 0.5, 1.0, rng.random()]) for _ in range(n)]
    rows = [(i, vector() if i % 3 else [0.5, 0.5, 0.5], rng.randrange(4)) for i in range(300)]
    rows += rows[:20] + [(50, None, 1), (51, [0.1, None, 0.2], 1), (52, [float("nan")] * 3, 1), (100, [float("inf"), 0.0, 0.0], 2), (150, vector(), None)]
    rows += [(None, [1.0, 1.0, 1.0], 1), (None, [0.5, 0.5, 0.5], 2), (400, [0.5], 1), (450, [], 2), (500, [9.0, 0.0, 0.0], 1)]
    df = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<float>, label int, tile int").repartition(3)
    rows = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v], label) for i, v, label in rows]
    got = [tuple(r[c] for c in COLUMNS) for r in mining.hard_negatives(df).collect()]
    assert sorted(got, key=str) == sorted(brute_negatives(rows), key=str) and len(got) > 30
    assert mining.hard_negatives(df.where("false")).count() == 0
    with pytest.raises(ValueError, match="exact scores"):
        mining.hard_negatives(spark.createDataFrame([(1, [1e12, 0.0], 1)], "vec_id long, embedding array<float>, label int"))


def test_boxes_hold_all_products():
    rng = np.random.default_rng(0)
    values = rng.integers(-256, 257, (1_000, 6))
    order = mining.str_order(values, mining.LEAF_ROWS)
    assert sorted(order) == list(range(1_000))
    tree, q = mining.Tree(np.arange(1_000), np.ones(1_000, bool), np.zeros(1_000), values[order]), rng.integers(-256, 257, (9, 6)).astype(float)
    least, most = tree.bounds(q)
    for leaf in range(tree.leaves):
        products = q @ tree.values[leaf * mining.LEAF_ROWS : (leaf + 1) * mining.LEAF_ROWS].T
        assert (least[:, leaf] <= products.min(axis=1)).all() and (products.max(axis=1) <= most[:, leaf]).all()


def test_odd_sketch_join_equals_brute_force(spark):
    texts = {r["doc_id"]: r["text"] for r in pq.read_table(f"{SF}/documents.parquet", columns=["doc_id", "text"]).to_pylist()}
    got = queries.op13_minhash_odd_sketch(spark, SF).collect()
    want = brute_components(texts, 4, 80)
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == want and len(got) == len(texts)
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)


def changed_copies(n, swaps, seed, with_base):
    """Copies of one text with ``swaps`` words changed; most are similar to the text but not to each other."""
    rng = random.Random(seed)
    base = [f"w{rng.randrange(5_000)}" for _ in range(200)]
    out = [" ".join(base)] if with_base else []
    for i in range(n):
        words = list(base)
        for at in rng.sample(range(200), rng.choice(swaps)):
            words[at] = f"n{rng.randrange(100_000)}"
        out.append(" ".join(words))
        if i % 9 == 0:  # a near copy of the copy
            words[rng.randrange(200)] = "other"
            out.append(" ".join(words))
    return {i: t for i, t in enumerate(out)}


@pytest.mark.parametrize("join", [jaccard_join.near_duplicates, odd_sketches.near_duplicates])
@pytest.mark.parametrize("with_base", [True, False])
def test_large_group_of_unlike_copies(spark, join, with_base):
    texts = changed_copies(250, [4, 6, 7, 8, 9, 10], 7, with_base)
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(3)
    got = {r["id"]: (r["n_shingles"], r["component_id"]) for r in join(df, 4, 80).collect()}
    assert got == brute_components(texts, 4, 80)
    if not with_base:
        assert len({c for _, c in got.values()}) > 100


def test_differences_leave_few_pairs(spark, tmp_path):
    """Of copies that are all too unlike each other, hardly any pair is looked at."""
    from riskspark.llm.differences import difference_pairs

    texts = changed_copies(200, [12, 14], 3, False)
    sets = {i: jaccard_join.shingle_set(t, 4, {}) for i, t in texts.items()}
    table = spark.createDataFrame([(i, bytearray(s.tobytes())) for i, s in sets.items()], "id long, tokens binary")
    members = spark.createDataFrame([(i, 0, i) for i in sets], "id long, lead long, label long")
    links, pairs = difference_pairs(members, table, 80)
    found = {(r["a"], r["b"]) for r in links.unionByName(pairs).collect()}
    similar = {(i, j) for i in sets for j in sets if i < j and 100 * len(np.intersect1d(sets[i], sets[j])) >= 80 * len(np.union1d(sets[i], sets[j]))}
    assert similar <= found and len(similar) > 10
    assert len(found) < 0.1 * len(sets) * (len(sets) - 1) / 2


def test_differences_join_only_tokens_that_the_leader_lacks(spark, monkeypatch):
    """What the leader has and sets lack is counted in one row of the leader, however many sets lack it."""
    from riskspark.llm import differences

    texts = changed_copies(200, [12, 14], 3, False)
    sets = {i: jaccard_join.shingle_set(t, 4, {}) for i, t in texts.items()}
    table = spark.createDataFrame([(i, bytearray(s.tobytes())) for i, s in sets.items()], "id long, tokens binary")
    members = spark.createDataFrame([(i, 0, i) for i in sets], "id long, lead long, label long")
    stored, store = {}, differences.cut_lineage
    monkeypatch.setattr(differences, "cut_lineage", lambda df, name: stored.setdefault(name, store(df, name)))
    differences.difference_pairs(members, table, 80)[1].collect()
    own = {i: len(np.setdiff1d(s, sets[0])) for i, s in sets.items()}
    assert 0 < stored["difference-tokens"].count() <= sum(own.values())
    assert stored["difference-lacking"].count() == 1


def test_odd_sketch_edges(spark):
    rows = [(1, "a b c d e f"), (1, "a b c d e f"), (2, "A b c d e f"), (None, "x y"), (None, None), (3, None), (4, ""), (5, "long words " * 40_000), (6, " ")]
    rows += [(7, "one two three four five six"), (7, "p q r s t u v"), (8, "P q r s t u v"), (9, "one two three four five six")]
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id long, text string, s int, sig int")
    got = sorted(((r["id"], r["n_shingles"], r["component_id"], r["kept"]) for r in odd_sketches.near_duplicates(df).collect()), key=str)
    want = [(1, 2, 1, True)] * 2 + [(2, 2, 1, False), (None, 1, None, True), (None, 0, None, True), (3, 0, 3, True), (4, 0, 4, True), (6, 0, 6, True)]
    want += [(5, 2, 5, True)]
    want += [(7, 2, 7, True), (7, 3, 7, True), (8, 3, 7, False), (9, 2, 7, False)]
    assert got == sorted(want, key=str)
    assert odd_sketches.near_duplicates(df.where("false")).count() == 0


def test_odd_sketches_estimate_differing_samples():
    rng = np.random.default_rng(2)
    samples = rng.integers(0, 1 << 63, (400, odd_sketches.SAMPLES), dtype=np.uint64)
    for differing in (0, 5, 25, 50):
        other = samples.copy()
        for row in other:
            row[rng.choice(odd_sketches.SAMPLES, differing, replace=False)] += np.uint64(1)
        found = odd_sketches.differing_samples(odd_sketches.odd_sketches(samples), odd_sketches.odd_sketches(other))
        assert abs(found.mean() - differing) < 1 and found.std() < 5
    assert odd_sketches.most_differing(80) < 0.45 * odd_sketches.SAMPLES
