"""Conversation structure repair (op13): auction shortest paths over an edit lattice.

A conversation's rows, by turn, are edited into one whose role initials are
``(s?(ua)+)?``: Keep costs 0, Rerole to user or assistant 2, Delete 3 (required for blank and
duplicate rows), Insert an empty user or assistant turn 2; a truncated row that stays costs 1
more. The lattice has a node per position and role state (start, after s, after u,
after a); edits are its arcs, with integer costs.

*Auction.* Every node has a price, at first a lower bound on its cost to the end (the cost that
no edit avoids). From an origin a path is grown: if its last node's price is below the best of arc cost
plus price of the arc's end, the price rises to that and the path contracts by the node; else the
path extends along that arc, of equal ones along the first letter. Prices never exceed
true costs, and when the path arrives its nodes' prices are exact. An arc is tight when price equals cost plus the end's
price; an arc of an earlier letter was not tight when its node was last left, and prices only rise, so following the
first tight letter from the origin gives the cheapest edits of least spelling. Blocks of positions are
solved from the last to the first, from all four states of a block's start, so the work is
linear in the rows.

*Scale.* Rows are dealt by ranges of (conversation, turn, role, text), so also a conversation that holds
a third of all rows is dealt to many tasks, which cut it into segments of bounded size. A segment that is a
whole conversation is solved at once. For the others the costs between the four states of
their ends are made by auctions, a conversation's chain of these 4 x 4 tables gives each segment
its end prices and then its first state, and every segment is traced on its own. Only the
result's own columns, audit and repaired text, bring a conversation into one row.

Faults, the first of a row counts: blank (no character but white space), duplicate (role and
text seen earlier in the conversation), truncated (the last character that is no white space is not one of ``.!?``).

Edge cases: null roles and texts are one space; rows without a turn come first; equal turns
go by role, then the text's first 64 characters, then its SHA-256; rows of a null conversation id are one
conversation; roles of other initials are kept by no edit; an empty table has no rows;
other columns are ignored.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonekit.llm.common import stored

#: rows and text bytes of a segment, positions of a block
SEGMENT_ROWS = 1024
SEGMENT_BYTES = 4 << 20
BLOCK = 32
#: costs of the edits (fixed values)
DELETE, REROLE, INSERT, TRUNCATED = 3, 2, 2, 1
START, SYSTEM, USER, ASSISTANT = range(4)
#: state after a kept row, by (state, initial)
KEPT = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (ASSISTANT, "u"): USER, (USER, "a"): ASSISTANT}
#: state after a turn that is made to fit
NEXT = (USER, USER, ASSISTANT, USER)
ROLE = {USER: "user", ASSISTANT: "assistant"}
LEGAL = ("su", "ua", "au")
FAR = 1 << 40
END = -1
_SEGMENT = "part long, seg int, whole boolean, conv_id long, roles array<string>, texts array<string>, blank binary, truncated binary, digests array<string>"
_TABLE = "part long, seg int, conv_id long, first string, last string, costs array<long>, closing array<long>"
_EXIT = "part long, seg int, final boolean, exit array<long>, illegal long"
_STATES = "part long, seg int, conv_id long, after array<int>"
_ENTRY = "part long, seg int, entry int"
_SOLVED = ("conv_id long, part long, seg int, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired string")


class Lattice:
    """A segment's lattice. ``initials`` of its rows, the rows that must go, and the truncated ones;
    ``exit`` has the price of each state behind the last row, ``final`` allows inserts there."""

    def __init__(self, initials: list[str], must_go: list[bool], truncated: list[bool], exit: list[int], final: bool):
        self.n, self.exit, self.final = len(initials), exit, final
        self.arcs: list[list[tuple[str, int, int]]] = []
        for i, (initial, gone, cut) in enumerate(zip(initials, must_go, truncated)):
            for state in range(4):
                node, after = 4 * i, 4 * i + 4
                arcs = [("D", DELETE, after + state), ("I", INSERT, node + NEXT[state])]
                if not gone:
                    if (kept := KEPT.get((state, initial))) is not None:
                        arcs.append(("K", cut * TRUNCATED, after + kept))
                    arcs.append(("R", REROLE + cut * TRUNCATED, after + NEXT[state]))
                self.arcs.append(arcs)
        for state in range(4):
            arcs = [("", exit[state], END)] if exit[state] < FAR else []
            self.arcs.append(arcs + [("I", INSERT, 4 * self.n + NEXT[state])] * final)
        # what no edit avoids, from each position on
        least = [min(exit)] * (self.n + 1)
        for i in range(self.n - 1, -1, -1):
            least[i] = least[i + 1] + (DELETE if must_go[i] else truncated[i] * TRUNCATED)
        self.price = [least[k // 4] for k in range(4 * self.n + 4)] + [0]  # the end's price comes last: END is -1

    def _close_dead_ends(self) -> None:
        """Nodes that reach no exit cost more than anything (the auction would raise their prices for ever)."""
        for i in range(self.n, -1, -1):
            nodes = range(4 * i, 4 * i + 4)
            alive = {k for k in nodes if any(t == END or t >= 4 * i + 4 and self.price[t] < FAR for _, _, t in self.arcs[k])}
            for _ in range(2):
                alive |= {k for k in nodes if any(t in alive for _, _, t in self.arcs[k])}
            for k in nodes:
                if k not in alive:
                    self.price[k] = FAR

    def _auction(self, origin: int, stop: int) -> None:
        """Grow a path from ``origin`` until it reaches a node from ``stop`` on, or the end."""
        price, arcs, path = self.price, self.arcs, [origin]
        while 0 <= path[-1] < stop:
            node = path[-1]
            best, to = FAR, END
            for _, cost, target in arcs[node]:
                if cost + price[target] < best:
                    best, to = cost + price[target], target
            if price[node] < best:
                price[node] = best
                if len(path) > 1:
                    path.pop()
            else:
                path.append(to)

    def solve(self, entries=range(4), block: int = BLOCK) -> list[int]:
        """Exact prices of the states before the first row."""
        if not self.final and max(self.exit) >= FAR:
            self._close_dead_ends()
        for first in range((self.n // block) * block, -1, -block):
            stop = 4 * (first + block) if first + block <= self.n else 4 * self.n + 4
            for state in range(4) if first else entries:
                if self.price[4 * first + state] < FAR:
                    self._auction(4 * first + state, stop)
        return self.price[:4]

    def trace(self, state: int) -> tuple[str, int]:
        """(letters, last state) along the first tight arcs from a state before the first row."""
        node, letters, last = state, [], state
        while node != END:
            letter, _, to = next(a for a in self.arcs[node] if self.price[node] == a[1] + self.price[a[2]])
            letters.append(letter)
            node, last = to, node % 4
        return "".join(letters), last


def follow(letters: str, state: int, roles: list[str], texts: list[str]) -> list[str]:
    """The repaired turns, ``role:text``."""
    out, row = [], 0
    for letter in letters:
        if letter == "K":
            state = KEPT[state, roles[row][:1]]
            out.append(f"{roles[row]}:{texts[row]}")
        elif letter != "D":
            state = NEXT[state]
            out.append(f"{ROLE[state]}:{texts[row] if letter == 'R' else ''}")
        row += letter != "I"
    return out


def _segments(max_rows: int, max_bytes: int):
    """Cuts a task's sorted rows into segments, none across conversations."""
    def run(batches):
        part, made, rows, size, started, fresh, conv = TaskContext.get().partitionId(), 0, [], 0, False, False, None
        schema = pa.schema([("part", pa.int64()), ("seg", pa.int32()), ("whole", pa.bool_()), ("conv_id", pa.int64()), ("roles", pa.list_(pa.string())),
                            ("texts", pa.list_(pa.string())), ("blank", pa.binary()), ("truncated", pa.binary()), ("digests", pa.list_(pa.string()))])

        def segment(whole):
            return {"part": part, "seg": made, "whole": whole, "conv_id": conv, "roles": [r["role"] for r in rows], "texts": [r["text"] for r in rows],
                    "blank": bytes(r["blank"] for r in rows), "truncated": bytes(r["truncated"] for r in rows), "digests": [r["digest"] for r in rows]}

        for batch in batches:
            out = []
            for r in batch.to_pylist():
                other = started and r["conv_id"] != conv
                if rows and (other or len(rows) >= max_rows or size >= max_bytes):
                    # whole: it began behind another conversation and ends before one, uncut
                    out.append(segment(fresh and other))
                    made, rows, size = made + 1, [], 0
                    fresh = other
                started, conv = True, r["conv_id"]
                rows.append(r)
                size += len(r["text"])
                if len(out) >= 256:
                    yield pa.RecordBatch.from_pylist(out, schema)
                    out = []
            yield pa.RecordBatch.from_pylist(out, schema)
        if rows:
            yield pa.RecordBatch.from_pylist([segment(False)], schema)
    return run


def _faults(row: dict) -> tuple[list[str], list[bool], list[bool], dict]:
    """(initials, rows that must go, truncated rows, counts of the first faults)."""
    again = set(row["dups"] or ())
    blank = [bool(b) for b in row["blank"]]
    duplicate = [i in again and not b for i, b in enumerate(blank)]
    must_go = [a or b for a, b in zip(blank, duplicate)]
    truncated = [bool(t) and not g for t, g in zip(row["truncated"], must_go)]
    initials = [r[:1] for r in row["roles"]]
    illegal = sum(a + b not in LEGAL for a, b in zip(initials, initials[1:]))
    return initials, must_go, truncated, {"blank": sum(blank), "duplicate": sum(duplicate), "truncated": sum(truncated), "illegal": illegal}


def _rows(ddl: str, make):
    """A mapInArrow function that turns each row (a dict) into rows of a schema."""
    kinds = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "boolean": pa.bool_(), "array<long>": pa.list_(pa.int64()), "array<int>": pa.list_(pa.int32())}
    schema = pa.schema([(name, kinds[kind]) for name, kind in (f.split() for f in ddl.split(", "))])

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                yield pa.RecordBatch.from_pylist([make(r) for r in batch.slice(at, 64).to_pylist()], schema)
    return run


def _ends(row: dict) -> dict:
    """Costs between the states of a segment's ends, and to the conversation's end if it is the last."""
    initials, must_go, truncated, _ = _faults(row)
    costs = [[0] * 4 for _ in range(4)]
    for state in range(4):
        prices = Lattice(initials, must_go, truncated, [0 if s == state else FAR for s in range(4)], False).solve()
        for entry in range(4):
            costs[entry][state] = prices[entry]
    return {"part": row["part"], "seg": row["seg"], "conv_id": row["conv_id"], "first": initials[0], "last": initials[-1],
            "costs": [c for entry in costs for c in entry], "closing": Lattice(initials, must_go, truncated, [0, FAR, FAR, 0], True).solve()}


def _chain_prices(table: pa.Table) -> pa.Table:
    """End prices of a conversation's segments, from the last to the first."""
    rows = sorted(table.to_pylist(), key=lambda r: (r["part"], r["seg"]))
    out, prices = [], None
    for i in range(len(rows) - 1, -1, -1):
        r = rows[i]
        illegal = int(i > 0 and rows[i - 1]["last"] + r["first"] not in LEGAL)
        out.append({"part": r["part"], "seg": r["seg"], "final": prices is None, "exit": prices or [0, FAR, FAR, 0], "illegal": illegal})
        prices = r["closing"] if prices is None else [min(FAR, *(r["costs"][4 * e + s] + prices[s] for s in range(4))) for e in range(4)]
    return pa.Table.from_pylist(out, pa.schema([("part", pa.int64()), ("seg", pa.int32()), ("final", pa.bool_()), ("exit", pa.list_(pa.int64())), ("illegal", pa.int64())]))


def _solved(row: dict) -> Lattice:
    initials, must_go, truncated, _ = _faults(row)
    lattice = Lattice(initials, must_go, truncated, row["exit"], row["final"])
    lattice.solve()
    return lattice


def _states(row: dict) -> dict:
    """The state behind a segment for each state before it."""
    lattice = _solved(row)
    after = [lattice.trace(s)[1] if lattice.price[s] < FAR else s for s in range(4)]
    return {"part": row["part"], "seg": row["seg"], "conv_id": row["conv_id"], "after": after}


def _chain_states(table: pa.Table) -> pa.Table:
    out, state = [], START
    for r in sorted(table.to_pylist(), key=lambda r: (r["part"], r["seg"])):
        out.append({"part": r["part"], "seg": r["seg"], "entry": state})
        state = r["after"][state]
    return pa.Table.from_pylist(out, pa.schema([("part", pa.int64()), ("seg", pa.int32()), ("entry", pa.int32())]))


def _repaired(row: dict) -> dict:
    initials, must_go, truncated, counts = _faults(row)
    lattice = Lattice(initials, must_go, truncated, row["exit"], row["final"])
    # a whole conversation needs no price but its start's
    lattice.solve([row["entry"]])
    letters, last = lattice.trace(row["entry"])
    lines = follow(letters, row["entry"], row["roles"], row["texts"])
    cost = lattice.price[row["entry"]] - (0 if row["final"] else row["exit"][last])
    return {**counts, "illegal": counts["illegal"] + row["illegal"], "conv_id": row["conv_id"], "part": row["part"], "seg": row["seg"],
            "cost": cost, "audit": letters, "repaired": "\n".join(lines) if lines else None}


def _in_order(column: str, between: str) -> Column:
    """A string column of a conversation's segments, joined in their order (nulls left out)."""
    parts = F.array_sort(F.collect_list(F.struct("part", "seg", F.col(column).alias("x"))))
    return F.array_join(F.transform(parts, lambda p: p["x"]), between)


def repair(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
           segment_rows: int = SEGMENT_ROWS, segment_bytes: int = SEGMENT_BYTES) -> DataFrame:
    """A row per conversation: ``(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired)``;
    ``repaired`` is the turns as ``role:text``, newline-joined."""
    rows = turns.select(F.col(conv_col).cast("long").alias("conv_id"), F.col(turn_col).cast("long").alias("turn"),
                        F.coalesce(F.col(role_col), F.lit(" ")).alias("role"), F.coalesce(F.col(text_col), F.lit(" ")).alias("text"))
    blank = ~F.col("text").rlike(r"[^\x20\x09-\x0D]")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"), F.length("role").cast("string"), F.lit(":"), "role", "text")
    made = rows.select("*", blank.alias("blank"), (~blank & ~F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z")).alias("truncated"),
                       F.sha2(key, 256).alias("digest"), F.substring("text", 1, 64).alias("head"), F.monotonically_increasing_id().alias("row"))
    order = ["conv_id", "turn", "role", "head", "digest", "row"]
    # equal rows, however many, may be dealt to several tasks
    dealt = made.repartitionByRange(*order).sortWithinPartitions(*order).select("conv_id", "role", "text", "blank", "truncated", "digest")
    segments = stored(dealt.mapInArrow(_segments(segment_rows, segment_bytes), _SEGMENT), "chat-segments")

    at = F.struct("part", "seg", "pos")
    places = (segments.select("part", "seg", "blank", F.posexplode("digests").alias("pos", "digest"))
              .where(F.expr("substring(blank, pos + 1, 1) = X'00'")).withColumn("at", at))
    first = places.groupBy("digest").agg(F.min("at").alias("first"), F.count("*").alias("times")).where("times > 1")
    again = places.join(first.select("digest", "first"), "digest").where("at > first").groupBy("part", "seg").agg(F.collect_list("pos").alias("dups"))
    marked = stored(segments.drop("digests").join(again, ["part", "seg"], "left"), "chat-marked")

    pieces = marked.where("not whole")
    light = pieces.drop("texts")
    tables = stored(light.mapInArrow(_rows(_TABLE, _ends), _TABLE), "chat-tables")
    exits = stored(tables.groupBy("conv_id").applyInArrow(_chain_prices, _EXIT), "chat-exits")
    states = light.join(exits, ["part", "seg"]).mapInArrow(_rows(_STATES, _states), _STATES)
    entries = states.groupBy("conv_id").applyInArrow(_chain_states, _ENTRY)
    cut = pieces.join(exits, ["part", "seg"]).join(entries, ["part", "seg"])
    whole = marked.where("whole").select("*", F.lit(True).alias("final"), F.array(*(F.lit(x).cast("long") for x in (0, FAR, FAR, 0))).alias("exit"),
                                         F.lit(0).cast("long").alias("illegal"), F.lit(START).alias("entry"))
    solved = whole.unionByName(cut).mapInArrow(_rows(_SOLVED, _repaired), _SOLVED)

    totals = [F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated", "illegal", "cost")]
    repaired = solved.groupBy("conv_id").agg(*totals, _in_order("audit", "").alias("audit"), _in_order("repaired", "\n").alias("repaired"))
    span = (rows.select("conv_id", "turn").distinct().groupBy("conv_id")
            .agg(F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0)).alias("gaps")).withColumnRenamed("conv_id", "c"))
    return (repaired.join(span, F.col("conv_id").eqNullSafe(F.col("c")))
            .select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired"))


__all__ = ["repair", "Lattice", "follow"]
