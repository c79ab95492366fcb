"""Fuzzy reconciliation against all-pairs edit distance."""

import random
from collections import defaultdict

import pytest

from zonekit.operators.fuzzy import candidates, fuzzy_matches, reconcile_fuzzy
from zonekit.operators.reconcile import alias_table


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, last = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
    return row[-1]


def edited(rng, text, edits):
    for _ in range(edits):
        at, kind = rng.randrange(len(text) + 1), rng.randrange(3)
        text = text[:at] + (rng.choice("abcxé") if kind < 2 else "") + text[at + (kind > 0):]
    return text


def made(seed, n=60):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abc") for _ in range(rng.randrange(1, 5))) for _ in range(12)]
    aliases = sorted({"common prefix " * (i % 2) + " ".join(rng.choice(words) for _ in range(rng.randrange(1, 4))) for i in range(n)})
    ids = [(a, f"id{rng.randrange(n)}") for a in aliases] + [(aliases[0], "other"), (None, "x"), ("", "y")]
    names = [edited(rng, rng.choice(aliases), rng.randrange(4)) for _ in range(3 * n)] + [None, "", "zzzzzzzzzz", "a"]
    return names, ids


@pytest.mark.parametrize("seed, max_edits, large", [(1, 2, 64), (2, 2, 0), (3, 1, 2), (4, 3, 3), (5, 0, 1)])
def test_matches_equal_all_pairs(spark, seed, max_edits, large):
    names, aliases = made(seed)
    got = fuzzy_matches(spark.createDataFrame([(x,) for x in names], "name string"), spark.createDataFrame(aliases, "alias string, id string"), max_edits, large)
    want = {}
    for name in {x for x in names if x}:
        near = defaultdict(list)
        for alias, i in aliases:
            if alias and (d := distance(name, alias)) <= min(max_edits, len(alias) // 5):
                near[d].append((alias, i))
        if near:
            best = near[min(near)]
            ids = {i for _, i in best}
            want[name] = (min(ids) if len(ids) == 1 else None, min(best)[0], min(near), len(ids) > 1)
    assert {r.name: tuple(r)[1:] for r in got.collect()} == want


def test_large_blocks_are_cut_by_a_second_piece(spark):
    rng = random.Random(7)
    aliases = ["a long common prefix " + "".join(rng.choice("abcdefgh") for _ in range(12)) for _ in range(400)]
    names = [edited(rng, rng.choice(aliases), 2) for _ in range(300)]
    n, a = spark.createDataFrame([(x,) for x in set(names)], "name string"), spark.createDataFrame([(x,) for x in set(aliases)], "alias string")
    assert candidates(n, a, 2, 16).count() < 0.1 * len(set(names)) * len(set(aliases)) < candidates(n, a, 2, 10 ** 6).count()


def test_no_plan_pairs_all_with_all(spark):
    n, a = spark.createDataFrame([("abcdefgh",)], "name string"), spark.createDataFrame([("abcdefgx", "1")], "alias string, id string")
    df = fuzzy_matches(n, a)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_rows_keep_their_number_and_columns(spark):
    lookup = spark.createDataFrame([("N1", "Alt Molinàr"), ("N2", "Vàlle nova"), ("N3", "Valle novo")], "_id string, neighborhood string")
    aliases = alias_table([(lookup, ["neighborhood"])])
    df = spark.createDataFrame([(1, "ALT  MOLINÀRS", "x"), (2, "Vàlle novx", "x"), (3, None, "x"), (4, "elsewhere", "x"), (5, "alt molinar", "x")], "k int, place string, hood string")
    got = {r.k: (r.hood, r.edit_distance) for r in reconcile_fuzzy(df, "place", aliases, "hood").collect()}
    assert got == {1: ("N1", 1), 2: (None, None), 3: (None, None), 4: (None, None), 5: ("N1", 0)}
    assert reconcile_fuzzy(df.where("false"), "place", aliases, "hood").count() == 0


@pytest.mark.parametrize("edits", [1, 2, 3])
def test_a_text_is_asked_where_one_piece_must_lie(spark, edits):
    from pyspark.sql import functions as F

    from zonekit.operators.fuzzy import _cuts, _probes

    rng, n = random.Random(edits), 9
    asked = {(r.n, r.i, r.start, r.size) for r in _probes(_cuts(spark.createDataFrame([(n, n)], "length int, left int"), F.lit(edits))).collect()}
    cuts = [(r.i, r.start, r.size) for r in _cuts(spark.createDataFrame([(n, n)], "length int, left int"), F.lit(edits)).collect()]
    assert sorted(s for _, s, z in cuts for s in range(s, s + z)) == list(range(n))
    assert len({a[1:] for a in asked if a[0] == n}) == {1: 2, 2: 5, 3: 8}[edits]
    for _ in range(300):
        alias = "".join(rng.choice("ab") for _ in range(n))
        name = edited(rng, alias, edits)
        assert any(len(name) == m and name[q:q + z] == alias[s:s + z] for i, s, z in cuts for m, j, q, _ in asked if i == j)


def test_names_that_an_alias_equals_are_not_cut(spark, monkeypatch):
    from zonekit.operators import fuzzy

    seen, whole = [], fuzzy.candidates
    monkeypatch.setattr(fuzzy, "candidates", lambda names, *a: seen.extend(r.name for r in names.collect()) or whole(names, *a))
    names = spark.createDataFrame([("abcdefgh",), ("abcdefgx",), ("",), (None,)], "name string")
    got = fuzzy_matches(names, spark.createDataFrame([("abcdefgh", "1"), ("abcdefgh", "2"), ("abcdefgy", "3"), ("", "4")], "alias string, id string"))
    assert {tuple(r) for r in got.collect()} == {("abcdefgh", None, "abcdefgh", 0, True), ("abcdefgx", None, "abcdefgh", 1, True)}
    assert sorted(seen) == ["", "abcdefgx"]
