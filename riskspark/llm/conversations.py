"""Repair of conversation structure by bidirectional Dijkstra over the edit lattice."""

from __future__ import annotations

import hashlib
import heapq

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from riskspark.llm.text import SPACE, bounded_batches
from riskspark.session import cut_lineage

#: Edit costs. A truncated row that stays costs TRUNCATED more.
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
#: Rows of a segment, and nodes that are folded into one, as powers of two.
SEGMENT_BITS, FOLD_BITS = 8, 10
#: Codes of a row: the initial of its role, and what is wrong with it.
SYSTEM, USER, ASSISTANT, OTHER, MUST_GO, CUT_OFF = 0, 1, 2, 3, 4, 8
#: States of the role grammar ``(s?(ua)+)?``: start, behind s, behind u, behind a.
STATES, ACCEPTING = 4, (0, 3)
_KEEP = {(0, SYSTEM): 1, (0, USER): 2, (1, USER): 2, (3, USER): 2, (2, ASSISTANT): 3}
#: The only user or assistant turn that a state allows, by the state behind it.
_NEXT = (2, 2, 3, 2)
_PAIRS = {(SYSTEM, USER), (USER, ASSISTANT), (ASSISTANT, USER)}


def damage(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Made-up damage by crc32("conv:turn") % 20: (conv, turn, role, text, copies). NULL roles and texts become one space."""
    conv, turn = F.col(f"`{conv_col}`"), F.col(f"`{turn_col}`")
    role, text = (F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(" ")) for c in (role_col, text_col))
    named = F.concat(F.coalesce(conv.cast("string"), F.lit(" ")), F.lit(":"), F.coalesce(turn.cast("string"), F.lit(" ")))
    kind = F.crc32(named.cast("binary")) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.translate(text, ".!?", "")).otherwise(text)
    role = F.when(kind == 4, "user").otherwise(role)
    copies = F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1)
    return df.select(conv.alias("conv"), turn.alias("turn"), role.alias("role"), text.alias("text"), copies.alias("copies"))


def edges(rows: list[tuple[int, int]], trailing: bool):
    """Forward and backward edges of the lattice: node (i, state) as 4 i + state -> [(node, cost, letter)].

    ``rows`` are (code, copies): all copies behind the first are deleted, which costs DELETE each. Inserts stand
    before a row, behind the last one only where ``trailing``.
    """
    ahead: list[list] = [[] for _ in range(STATES * (len(rows) + 1))]
    back: list[list] = [[] for _ in ahead]

    def edge(a: int, b: int, cost: int, letter: str) -> None:
        ahead[a].append((b, cost, letter))
        back[b].append((a, cost, letter))

    for i in range(len(rows) + 1):
        for s in range(STATES):
            at, step = STATES * i + s, STATES * (i + 1)
            if i < len(rows) or trailing:
                edge(at, STATES * i + _NEXT[s], INSERT, "I")
            if i < len(rows):
                code, copies = rows[i]
                more = DELETE * (copies - 1)
                edge(at, step + s, DELETE + more, "D")
                if not code & MUST_GO:
                    more += TRUNCATED if code & CUT_OFF else 0
                    edge(at, step + _NEXT[s], REROLE + more, "R")
                    if (s, code & 3) in _KEEP:
                        edge(at, step + _KEEP[s, code & 3], more, "K")
    return ahead, back


def cheapest(ahead: list, back: list, start: int, goals: list[int]) -> tuple[int, str] | None:
    """(cost, audit) of the cheapest way from ``start`` to a goal, the least audit of all such ways; None without a way.

    A forward and a reverse heap settle nodes until their least costs add up to more than the best way found, so that all
    crossings of that cost are done. Every best way has an edge from a node settled ahead to one settled in reverse, or is settled ahead as a whole; the
    least concatenation is the answer. Two ways of equal cost to one node never begin with one another, because the letters
    decide the node, so that a least way consists of least parts. Edges without cost lead to the next row; nodes of
    one cost are settled in row order, which makes their audits final.
    """
    inf = 1 << 62
    cost, audit = ({start: 0}, {g: 0 for g in goals}), ({start: ""}, {g: "" for g in goals})
    done: tuple[set, set] = (set(), set())
    heaps = [[(0, start // STATES, start)], [(0, -(g // STATES), g) for g in goals]]
    heapq.heapify(heaps[1])
    best = 0 if start in goals else inf

    def top(side: int) -> int:
        while heaps[side] and (heaps[side][0][2] in done[side] or heaps[side][0][0] > cost[side][heaps[side][0][2]]):
            heapq.heappop(heaps[side])
        return heaps[side][0][0] if heaps[side] else inf

    while True:
        tops = top(0), top(1)
        # A side that has settled all its nodes waits for the other one.
        if min(tops) == inf or sum(t for t in tops if t < inf) > best:
            break
        side = 0 if tops[0] <= tops[1] else 1
        here, _, node = heapq.heappop(heaps[side])
        done[side].add(node)
        for other, c, letter in (ahead, back)[side][node]:
            known = cost[side].get(other, inf)
            if here + c <= known:
                way = audit[side][node] + letter if side == 0 else letter + audit[side][node]
                if here + c < known or way < audit[side][other]:
                    cost[side][other], audit[side][other] = here + c, way
                if here + c < known:
                    heapq.heappush(heaps[side], (here + c, other // STATES if side == 0 else -(other // STATES), other))
            best = min(best, here + c + cost[1 - side].get(other, inf))
    if best == inf:
        return None
    ways = [audit[0][g] for g in goals if g in done[0] and cost[0][g] == best]
    for u in done[0]:
        ways += [audit[0][u] + letter + audit[1][w] for w, c, letter in ahead[u] if w in done[1] and cost[0][u] + c + cost[1][w] == best]
    return best, min(ways)


def table_of(rows: list[tuple[int, int]], first: bool, last: bool) -> tuple[list[int], list[str | None], list[int]]:
    """For every state before a segment and behind it: cost (-1: no way), audit, and the audit's place among the exits.

    The last segment has one exit, number 0: an accepting state behind any inserts.
    """
    ahead, back = edges(rows, trailing=last)
    end = STATES * len(rows)
    exits = [[end + s for s in ACCEPTING]] if last else [[end + s] for s in range(STATES)]
    costs, audits, order = [-1] * STATES**2, [None] * STATES**2, [0] * STATES**2
    for e in range(1 if first else STATES):
        for x, goals in enumerate(exits):
            if (way := cheapest(ahead, back, e, goals)) is not None:
                costs[STATES * e + x], audits[STATES * e + x] = way
        there = sorted((a, x) for x in range(STATES) if (a := audits[STATES * e + x]) is not None)
        for place, (_, x) in enumerate(there):
            order[STATES * e + x] = place
    return costs, audits, order


def fold(a: tuple[list[int], list[int]], b: tuple[list[int], list[int]]) -> tuple[list[int], list[int]]:
    """(costs, order) of two neighbours as one."""
    costs, order = [-1] * STATES**2, [0] * STATES**2
    for e in range(STATES):
        places = []
        for x in range(STATES):
            ways = [
                (a[0][STATES * e + m] + b[0][STATES * m + x], a[1][STATES * e + m], m)
                for m in range(STATES)
                if a[0][STATES * e + m] >= 0 and b[0][STATES * m + x] >= 0
            ]
            if ways:
                cost, place, m = min(ways)
                costs[STATES * e + x] = cost
                places.append((place, b[1][STATES * m + x], x))
        for place, (_, _, x) in enumerate(sorted(places)):
            order[STATES * e + x] = place
    return costs, order


def route(nodes: list[tuple[list[int], list[int]]], entry: int, leave: int) -> list[tuple[int, int]]:
    """States before and behind each of a run of neighbours on the cheapest way, the least one of all."""
    inf = 1 << 62
    rest = [[inf] * STATES for _ in range(len(nodes) + 1)]
    rest[-1][leave] = 0
    for j in range(len(nodes) - 1, -1, -1):
        costs = nodes[j][0]
        for e in range(STATES):
            rest[j][e] = min((costs[STATES * e + x] + rest[j + 1][x] for x in range(STATES) if costs[STATES * e + x] >= 0), default=inf)
    out = []
    for j, (costs, order) in enumerate(nodes):
        ways = [(order[STATES * entry + x], x) for x in range(STATES) if costs[STATES * entry + x] >= 0 and costs[STATES * entry + x] + rest[j + 1][x] == rest[j][entry]]
        out.append((entry, min(ways)[1]))
        entry = out[-1][1]
    return out


def _record(rows: list[tuple], fields: list[tuple[str, pa.DataType]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, (_, t) in enumerate(fields)], names=[n for n, _ in fields])


_LONGS, _TEXTS = pa.list_(pa.int64()), pa.list_(pa.string())
_TABLE = [("c", pa.string()), ("node", pa.int64()), ("costs", _LONGS), ("audits", _TEXTS), ("order", _LONGS), ("illegal", pa.int64()), ("head", pa.int64()), ("tail", pa.int64())]
_NODE = [f for f in _TABLE if f[0] != "audits"]
_SQL = {pa.string(): "string", pa.int64(): "long", _LONGS: "array<long>", _TEXTS: "array<string>"}


def _schema(fields) -> str:
    return ", ".join(f"{n} {_SQL[t]}" for n, t in fields)


def _tables(batches):
    for batch in batches:
        out = []
        for r in batch.to_pylist():
            rows = [(x["code"], x["copies"]) for x in r["rows"]]
            codes = [c & 3 for c, _ in rows]
            illegal = sum(n - 1 for _, n in rows) + sum(p not in _PAIRS for p in zip(codes, codes[1:]))
            costs, audits, order = table_of(rows, r["first"], r["last"])
            out.append((r["c"], r["node"], costs, audits, order, illegal, codes[0], codes[-1]))
        yield _record(out, _TABLE)


def _folded(batches):
    for batch in batches:
        out = []
        for r in batch.to_pylist():
            nodes = r["nodes"]
            both, illegal = (nodes[0]["costs"], nodes[0]["order"]), nodes[0]["illegal"]
            for before, node in zip(nodes, nodes[1:]):
                both = fold(both, (node["costs"], node["order"]))
                illegal += node["illegal"] + ((before["tail"], node["head"]) not in _PAIRS)
            out.append((r["c"], r["up"], *both, illegal, nodes[0]["head"], nodes[-1]["tail"]))
        yield _record(out, _NODE)


_CHOSEN = [("c", pa.string()), ("node", pa.int64()), ("entry", pa.int64()), ("leave", pa.int64())]


def _routed(batches):
    for batch in batches:
        out = []
        for r in batch.to_pylist():
            ways = route([(n["costs"], n["order"]) for n in r["nodes"]], r["entry"], r["leave"])
            out += [(r["c"], n["node"], *way) for n, way in zip(r["nodes"], ways)]
        yield _record(out, _CHOSEN)


def _groups(nodes: DataFrame) -> DataFrame:
    """Neighbouring nodes of a conversation, at most 2^FOLD_BITS of them in a list."""
    up = F.shiftright("node", FOLD_BITS)
    item = F.struct("node", "costs", "order", "illegal", "head", "tail")
    return nodes.groupBy("c", up.alias("up")).agg(F.sort_array(F.collect_list(item)).alias("nodes"))


_ACTION = [("c", pa.string()), ("pos", pa.int64()), ("sub", pa.int64()), ("letter", pa.string()), ("role", pa.string())]


def _actions(batches):
    """What becomes of each row that stays (its first copy), and the inserted ones: (c, pos, sub, letter, role)."""
    names = {2: "user", 3: "assistant"}
    for batch in batches:
        out = []
        for r in batch.to_pylist():
            state, at, sub = r["entry"], 0, 0
            rows = r["rows"]
            for letter in r["way"]:
                # An inserted row stands before the row of the next place, or behind the last one.
                place = rows[min(at, len(rows) - 1)]["pos"]
                if letter in "IR":
                    state = _NEXT[state]
                elif letter == "K":
                    state = _KEEP[state, rows[at]["code"] & 3]
                if letter != "D":
                    out.append((r["c"], place, sub, letter, names[state] if letter in "IR" else None))
                sub += 1
                if letter != "I":
                    at += 1
                    sub = 0 if at < len(rows) else sub
        yield _record(out, _ACTION)


def _digests(batches):
    """Rows come by conversation and in order; one running hash at a time, however long the conversation is."""
    now, running, n = None, None, 0
    for batch in batches:
        out = []
        for c, role, text in zip(*(batch.column(i).to_pylist() for i in range(3))):
            if c != now:
                if running is not None:
                    out.append((now, running.hexdigest()))
                now, running, n = c, hashlib.sha256(), 0
            running.update(("\n" if n else "").encode() + f"{role}:{text}".encode())
            n = 1
        yield _record(out, [("c", pa.string()), ("sha", pa.string())])
    if running is not None:
        yield _record([(now, running.hexdigest())], [("c", pa.string()), ("sha", pa.string())])


def _place(batches):
    number, at = TaskContext.get().partitionId() << 40, 0
    for batch in batches:
        yield batch.append_column("pos", pa.array(range(number + at, number + at + batch.num_rows), pa.int64()))
        at += batch.num_rows


class Repair:
    """The cheapest repair of every conversation, of which the least audit.

    ``rows``: (conv, turn, role, text, copies). Rows stand in the order of turn (NULL first), role, and a hash of role and text. Keeping
    a row costs nothing, giving it the role user or assistant REROLE, deleting it DELETE (a blank or repeated row has to
    go), inserting an empty turn INSERT; a truncated row that stays costs TRUNCATED more. The initials of the roles have to
    read ``(s?(ua)+)?`` afterwards.

    Equal rows of a turn are one row with a number of copies. Rows get places by a range sort of keys, without texts, so that one
    very long conversation lies in many partitions. Runs of 2^SEGMENT_BITS rows are solved by themselves, from each
    state before to each state behind them; the tables of neighbours, 16 costs each, are folded level by level, and the
    chosen states are handed down again. A conversation of one run, as nearly all are, is one search. Texts move to
    the rows that keep them.
    """

    def __init__(self, rows: DataFrame):
        bounded_batches(rows.sparkSession)
        self.kind = rows.schema["conv"].dataType
        c = F.coalesce(F.concat(F.lit("="), F.col("conv").cast("string")), F.lit(""))
        said = F.concat_ws("|", F.char_length("role"), F.col("role"), F.col("text"))
        self.source = rows.select(c.alias("c"), "turn", "role", "text", "copies", F.unhex(F.md5(said)).alias("same"))
        self.source = self.source.withColumn("g", F.unhex(F.md5(F.concat_ws("|", F.char_length("c"), "c", F.coalesce(F.col("turn").cast("string"), F.lit("-")), F.hex("same")))))
        self.facts = self._facts()
        self.segments, self.tables = self._segments()
        self.chosen = self._chosen()

    def _facts(self) -> DataFrame:
        space, last = F.lit(SPACE), F.substring(F.rtrim("text", F.lit(SPACE)), -1, 1)
        initial = F.substring("role", 1, 1)
        rows = self.source.where("copies > 0").select(
            "g", "c", "turn", "role", "same", "copies",
            (F.btrim("text", space) == "").alias("blank"), (~last.isin(".", "!", "?")).alias("cut"),
            F.when(initial == "s", SYSTEM).when(initial == "u", USER).when(initial == "a", ASSISTANT).otherwise(OTHER).alias("initial"),
        )
        once = rows.groupBy("g").agg(*[F.first(n).alias(n) for n in ("c", "turn", "role", "same", "blank", "cut", "initial")], F.sum("copies").cast("long").alias("copies"))
        once = cut_lineage(once, "turns")
        order = ["c", "turn", "role", "same"]
        placed = once.repartitionByRange(*order).sortWithinPartitions(*order)
        schema = once.schema.add("pos", "long")
        placed = cut_lineage(placed.mapInArrow(_place, schema), "places")
        seen = placed.groupBy("c", "same").agg(F.min("pos").alias("earliest"), F.count("*").alias("n")).where("n > 1").drop("n")
        marked = placed.join(cut_lineage(seen, "repeats"), ["c", "same"], "left")
        repeated = F.coalesce(F.col("pos") > F.col("earliest"), F.lit(False))
        fault = F.when(F.col("blank"), "blank").when(repeated, "duplicate").when(F.col("cut"), "truncated").otherwise("")
        out = marked.withColumn("fault", fault)
        code = F.col("initial") + F.when(F.col("fault").isin("blank", "duplicate"), MUST_GO).when(F.col("fault") == "truncated", CUT_OFF).otherwise(0)
        return cut_lineage(out.select("g", "c", "turn", "pos", "copies", "fault", code.cast("long").alias("code")), "faults")

    def _segments(self) -> tuple[DataFrame, DataFrame]:
        node = F.shiftright("pos", SEGMENT_BITS)
        runs = self.facts.groupBy("c", node.alias("node")).agg(F.sort_array(F.collect_list(F.struct("pos", "code", "copies"))).alias("rows"))
        runs = cut_lineage(runs, "runs")
        ends = runs.groupBy("c").agg(F.min("node").alias("low"), F.max("node").alias("high"))
        segments = runs.join(ends, "c").select("c", "node", "rows", (F.col("node") == F.col("low")).alias("first"), (F.col("node") == F.col("high")).alias("last"))
        segments = cut_lineage(segments, "segments")
        return segments, cut_lineage(segments.mapInArrow(_tables, _schema(_TABLE)), "tables")

    def _chosen(self) -> DataFrame:
        """(c, node, entry, leave) of every segment, and ``self.illegal`` of every conversation."""
        level, levels = self.tables.drop("audits"), []
        while not level.groupBy("c").count().where("count > 1").isEmpty():
            levels.append(level)
            level = cut_lineage(_groups(level).mapInArrow(_folded, _schema(_NODE)), "folded")
        self.illegal = level.select("c", "illegal")
        chosen = level.select("c", "node", F.lit(0).cast("long").alias("entry"), F.lit(0).cast("long").alias("leave"))
        for below in reversed(levels):
            above = chosen.withColumnRenamed("node", "up")
            chosen = cut_lineage(_groups(below).join(above, ["c", "up"]).mapInArrow(_routed, _schema(_CHOSEN)), "routed")
        table = self.tables.select("c", "node", "costs", "audits")
        at = (F.col("entry") * STATES + F.col("leave")).cast("int")
        both = chosen.join(table, ["c", "node"]).select("c", "node", "entry", F.get("costs", at).alias("cost"), F.get("audits", at).alias("way"))
        return cut_lineage(both, "chosen")

    def conv(self, c: Column) -> Column:
        """The conversation's id, as it was."""
        return F.when(c != "", F.substr(c, F.lit(2)).cast(self.kind))

    def actions(self) -> DataFrame:
        """(c, pos, sub, letter, role) of rows that stay or are inserted; ``role`` is NULL where it is kept."""
        return self.segments.select("c", "node", "rows").join(self.chosen, ["c", "node"]).mapInArrow(_actions, _schema(_ACTION))

    def rows(self) -> DataFrame:
        """The repaired rows: (c, pos, sub, role, text), in the order of pos and sub within a conversation."""
        actions = cut_lineage(self.actions(), "actions")
        texts = self.source.where("copies > 0").groupBy("g").agg(F.first("role").alias("own"), F.first("text").alias("text"))
        stay = actions.where("letter <> 'I'").join(self.facts.select("pos", "g"), "pos")
        stay = texts.join(stay, "g").select("c", "pos", "sub", F.coalesce("role", "own").alias("role"), "text")
        return stay.unionByName(actions.where("letter = 'I'").select("c", "pos", "sub", "role", F.lit("").alias("text")))

    def digests(self) -> DataFrame:
        """(c, sha) of the repaired ``role:text`` lines. A hash runs over a conversation from its begin to its end, so one task streams it."""
        rows = self.rows().repartition("c").sortWithinPartitions("c", "pos", "sub").select("c", "role", "text")
        return rows.mapInArrow(_digests, "c string, sha string")

    def summary(self) -> DataFrame:
        """(c, gaps, blank, duplicate, truncated, illegal, cost, audit) of conversations that have rows."""
        n = lambda fault: F.sum(F.when(F.col("fault") == fault, F.col("copies")).otherwise(0))
        kept = ~F.col("fault").isin("blank", "duplicate")
        # Of equal rows of a turn all but the first are repeats.
        again = F.sum(F.when(F.col("fault") == "duplicate", F.col("copies")).when(kept, F.col("copies") - 1).otherwise(0))
        faults = self.facts.groupBy("c").agg(n("blank").alias("blank"), again.alias("duplicate"), F.sum(F.when(F.col("fault") == "truncated", 1).otherwise(0)).alias("truncated"))
        turn = F.col("turn").cast("decimal(38,0)")
        turns = self.facts.where("turn is not null").groupBy("c", "turn").count()
        gaps = turns.groupBy("c").agg(F.struct((F.max(turn) - F.min(turn) + 1 - F.count("*")).try_cast("long").alias("n")).alias("gaps"))
        parts = self.segments.select("c", "node", "rows").join(self.chosen, ["c", "node"]).mapInArrow(_spelled, "c string, node long, cost long, audit string")
        audits = parts.groupBy("c").agg(F.sum("cost").alias("cost"), F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("node", "audit"))), lambda x: x["audit"]), "").alias("audit"))
        return faults.join(gaps, "c", "left").join(self.illegal, "c").join(audits, "c")


def _spelled(batches):
    """Audits with a D for every deleted copy."""
    for batch in batches:
        out = []
        for r in batch.to_pylist():
            letters, at = [], 0
            for letter in r["way"]:
                letters.append(letter)
                if letter != "I":
                    letters.append("D" * (r["rows"][at]["copies"] - 1))
                    at += 1
            out.append((r["c"], r["node"], r["cost"], "".join(letters)))
        yield _record(out, [("c", pa.string()), ("node", pa.int64()), ("cost", pa.int64()), ("audit", pa.string())])


def repair(rows: DataFrame, every: DataFrame) -> DataFrame:
    """One row per conversation of ``every`` (conv): gaps, faults, cost, audit and digest of the repair of ``rows``.

    See ``Repair``. NULL is a conversation of its own. A conversation without rows has zeros, an empty audit and the hash of
    nothing. A NULL turn comes first and counts for no gap; a gap beyond 64 bits is NULL. An empty role has no initial and
    cannot stay. Roles and texts must not be NULL (``damage`` makes them one space).
    """
    done = Repair(rows)
    c = F.coalesce(F.concat(F.lit("="), F.col("conv").cast("string")), F.lit(""))
    out = every.select(c.alias("c")).distinct().join(done.summary(), "c", "left").join(done.digests(), "c", "left")
    numbers = [F.coalesce(n, F.lit(0)).cast("long").alias(n) for n in ("blank", "duplicate", "truncated", "illegal", "cost")]
    # Turns that are all NULL leave no gap.
    gaps = F.when(F.col("gaps").isNull(), F.lit(0).cast("long")).otherwise(F.col("gaps.n"))
    nothing = hashlib.sha256().hexdigest()
    return out.select(done.conv(F.col("c")).alias("conv"), gaps.alias("gaps"), *numbers, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("sha", F.lit(nothing)).alias("repaired_sha256"))
