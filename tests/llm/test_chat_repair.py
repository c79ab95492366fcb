import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from zonekit.llm import chat_repair, queries
from zonekit.llm.chat_repair import FAR, Lattice

SCHEMA = "conv_id long, turn long, role string, text string, part string, audit int"
TEXTS = ["Hello.", "what?", "no end", "cut ", "", " \t\n", None, "fine!  \n", "Hello.", "no end"]
ROLES = ["system", "user", "assistant", "user", "assistant", "tool", None, "", "service"]


def conversations(rng, n, longest):
    rows = []
    for c in [None, *range(n)]:
        for turn in range(rng.randrange(longest)):
            rows.append((c, rng.choice([turn, turn, turn, turn + 3, None]), rng.choice(ROLES), rng.choice(TEXTS) if rng.random() < 0.5 else f"t{rng.randrange(9)}."))
    return rows + rows[:3]


def cheapest(rows):
    """(cost, letters, lines) of the cheapest edits, least letters first: every way to every state, kept by (cost, letters)."""
    def inserted(ways):
        for _ in range(3):
            for s in range(4):
                if s in ways:
                    cost, letters, lines = ways[s]
                    to, role = (3, "assistant") if s == 2 else (2, "user")
                    ways[to] = min(ways.get(to, (FAR,)), (cost + 2, letters + "I", lines + (role + ":",)))
        return ways

    ways = inserted({0: (0, "", ())})
    for role, text, fault in rows:
        after = {}
        for s, (cost, letters, lines) in ways.items():
            def reach(to, more, letter, line, cost=cost, letters=letters, lines=lines):
                after[to] = min(after.get(to, (FAR,)), (cost + more, letters + letter, lines + line))
            reach(s, 3, "D", ())
            if fault not in ("blank", "duplicate"):
                cut = fault == "truncated"
                to, made = (3, "assistant") if s == 2 else (2, "user")
                reach(to, 2 + cut, "R", (f"{made}:{text}",))
                kept = {"s": 1 if s == 0 else None, "u": 2 if s in (0, 1, 3) else None, "a": 3 if s == 2 else None}.get(role[:1])
                if kept is not None:
                    reach(kept, cut, "K", (f"{role}:{text}",))
        ways = inserted(after)
    return min(ways[s] for s in (0, 3) if s in ways)


def expected(rows, conv):
    """The contract, row by row (rows after damage)."""
    space = " \t\n\x0b\x0c\r"
    said = [(t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows if c == conv]
    order = lambda x: (x[0] is not None, x[0] or 0, x[1].encode(), x[2][:64].encode(), digest(conv, x[1], x[2]))
    said.sort(key=order)
    seen, faults = set(), []
    for _, role, text in said:
        bare = text.strip(space)
        faults.append("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else "")
        seen.add((role, text))
    turns = {t for t, _, _ in said if t is not None}
    cost, letters, lines = cheapest([(r, x, f) for (_, r, x), f in zip(said, faults)])
    initials = [r[:1] for _, r, _ in said]
    return (conv, max(turns) - min(turns) + 1 - len(turns) if turns else 0, *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
            sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), cost, letters, "\n".join(lines))


def digest(conv, role, text):
    return hashlib.sha256(f"{' ' if conv is None else conv}:{len(role)}:{role}{text}".encode()).hexdigest()


@pytest.mark.parametrize("seed, rows, size", [(1, 1024, 1 << 20), (2, 3, 1 << 20), (3, 1, 1 << 20), (4, 1024, 20)])
def test_repair_equals_brute_force(spark, seed, rows, size):
    made = conversations(random.Random(seed), 25, 14)
    turns = spark.createDataFrame([(*r, "x", 1) for r in made], SCHEMA).repartition(3)
    got = chat_repair.repair(turns, segment_rows=rows, segment_bytes=size).collect()
    convs = {r[0] for r in made}
    assert len(got) == len(convs)
    assert {tuple(r) for r in got} == {expected(made, c) for c in convs}


def test_one_long_conversation_is_dealt_to_many_tasks(spark):
    rng = random.Random(6)
    made = [(5, i // 2, rng.choice(("user", "assistant", "assistant", "system")), rng.choice((f"t{i}.", f"t{i}", "", "same."))) for i in range(2000)]
    made += [(c, 0, "user", "x.") for c in range(3)]
    turns = spark.createDataFrame([(*r, "x", 1) for r in made], SCHEMA).repartition(4)
    got = {r.conv_id: tuple(r) for r in chat_repair.repair(turns, segment_rows=50).collect()}
    assert got == {c: expected(made, c) for c in (0, 1, 2, 5)}


@pytest.mark.parametrize("seed", range(60))
def test_auction_prices_and_letters(seed):
    rng = random.Random(seed)
    n, block = rng.randrange(1, 70), rng.choice((1, 2, 5, 32))
    rows = [(rng.choice(["system", "user", "assistant", "tool", ""]), "x", rng.choice(["", "", "", "blank", "truncated"])) for _ in range(n)]
    lattice = Lattice([r[:1] for r, _, _ in rows], [f == "blank" for _, _, f in rows], [f == "truncated" for _, _, f in rows], [0, FAR, FAR, 0], True)
    cost, letters, lines = cheapest(rows)
    assert lattice.solve([0] if seed % 2 else range(4), block)[0] == cost
    assert lattice.trace(0)[0] == letters
    assert tuple(chat_repair.follow(letters, 0, [r for r, _, _ in rows], ["x"] * n)) == lines
    assert re.fullmatch("(s?(ua)+)?", "".join(line[:1] for line in lines))
    # dual prices: none above an arc's cost plus the price of its end
    assert all(lattice.price[k] <= c + lattice.price[t] for k, arcs in enumerate(lattice.arcs) for _, c, t in arcs)


def test_states_that_no_edit_reaches():
    rows = ["u", "a", "s"]
    costs = [[Lattice(rows, [False] * 3, [False] * 3, [0 if s == state else FAR for s in range(4)], False).solve()[entry] for state in range(4)] for entry in range(4)]
    assert costs[0] == [9, 6, 2, 3] and costs[2][0] == FAR and costs[2][1] == FAR and costs[1][1] == 9


def test_damage_and_query(spark):
    turns = spark.createDataFrame([(c, t, r, x, "p", 1) for c in (None, *range(40)) for t, r, x in ((None, "user", "a.b!c?"), (1, None, "Yes."), (2, "assistant", None))], SCHEMA)
    want = []
    for r in turns.collect():
        said = lambda x: " " if x is None else str(x)
        fault = zlib.crc32(f"{said(r.conv_id)}:{said(r.turn)}".encode()) % 20
        text = "" if fault == 1 else re.sub("[.!?]", "", said(r.text)) if fault == 2 else said(r.text)
        want += [(r.conv_id, r.turn, "user" if fault == 4 else said(r.role), text)] * (0 if fault == 0 else 2 if fault == 3 else 1)
    assert sorted(map(str, map(tuple, queries.damaged(turns).collect()))) == sorted(map(str, want))


def test_repair_of_empty_table(spark):
    turns = spark.createDataFrame([(1, 1, "user", "x", "p", 1)], SCHEMA)
    assert chat_repair.repair(turns.where("false")).count() == 0
    got = chat_repair.repair(turns.withColumn("text", F.lit(None).cast("string"))).first()
    assert (got.blank, got.audit, got.repaired, got.cost) == (1, "D", "", 3)
