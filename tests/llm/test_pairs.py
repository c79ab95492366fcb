"""The Jaccard join and the repeated spans against brute force."""

import hashlib
import random
import re
import tracemalloc
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest

from tests.llm.fixture import documents, prose, texts
from zonekit.llm import jaccard_join, repeats
from zonekit.llm.components import components
from zonekit.llm.run_index import RunIndex
from zonekit.session import checkpoint_root


def shingles(text, k):
    words = (text or "").encode().lower().split()
    return frozenset(zip(*(words[i:] for i in range(k)))) if len(words) >= k else frozenset([tuple(words)] if words else [])


def classes(sets, percent):
    root = list(range(len(sets)))

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for a in range(len(sets)):
        for b in range(a):
            shared = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * shared >= percent * (len(sets[a]) + len(sets[b]) - shared):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return [find(a) for a in range(len(sets))]


@pytest.mark.parametrize("k,percent,tile,frequent", [(3, 90, 2048, 200_000), (5, 80, 2, 5), (3, 60, 3, 0), (2, 100, 2048, 10)])
def test_components_equal_brute_force(spark, k, percent, tile, frequent):
    rng = random.Random(9)
    extra = []
    chain = prose(rng, 60).split()
    for i in range(25):  # a chain: neighbours link, ends do not
        chain[rng.randrange(60)] = f"c{i}"
        extra.append(" ".join(chain))
    docs = documents(spark, extra).where("doc_id is not null and not (doc_id = 3 and n_chars > 3)")
    rows = sorted({(r.doc_id, r.text) for r in docs.collect()})
    sets = [shingles(t, k) for _, t in rows]
    roots = classes(sets, percent)
    got = {(r.doc_id, r.n_shingles, r.component_id) for r in jaccard_join.link_components(docs, k, percent, tile=tile, max_frequent=frequent).collect()}
    assert got == {(i, len(s), rows[root][0]) for (i, _), s, root in zip(rows, sets, roots)}


def test_every_row_is_answered_and_ids_may_be_missing(spark):
    docs = documents(spark)
    out = jaccard_join.link_components(docs, 3, 90)
    assert out.count() == docs.count()
    lost = spark.createDataFrame([(None, "a b c d"), (None, "a b c d"), (None, None)], "doc_id long, text string")
    assert [r.component_id for r in jaccard_join.link_components(lost, 3, 90).collect()] == [None] * 3
    assert jaccard_join.link_components(docs.where("false"), 3, 90).count() == 0


def test_sets_that_only_share_a_passage_are_not_written_out(spark):
    rng = random.Random(5)
    passage = prose(rng, 1000, 9000)
    rows = [(i, f"{prose(rng, 3000, 9000)} {passage}") for i in range(60)]
    root = Path(re.sub("^file:", "", checkpoint_root(spark)))
    written = lambda: {p: p.stat().st_size for p in root.rglob("*.parquet")}
    before = written()
    out = jaccard_join.link_components(spark.createDataFrame(rows, "doc_id long, text string"), 3, 90, max_frequent=0).collect()
    assert sorted((r.doc_id, r.component_id) for r in out) == [(i, i) for i, _ in rows]
    assert sum(size for p, size in written().items() if p not in before) < sum(len(t) for _, t in rows) / 3


def test_widely_held_shingles_are_counted_in_little_memory():
    rng = np.random.default_rng(8)
    sets = [np.unique(rng.integers(0, 1 << 16, 2000).astype(np.uint64)) for _ in range(300)]
    times = Counter(x for s in sets for x in s.tolist())
    for least in (1, 3, 1000):
        known, counts = jaccard_join._widely(sets, least)
        assert dict(zip(known.tolist(), counts.tolist())) == {x: c for x, c in times.items() if c >= least}
    many = [np.unique(rng.integers(0, 1 << 62, 50_000).astype(np.uint64)) for _ in range(20)]
    tracemalloc.start()
    assert not len(jaccard_join._widely(many, 3)[0])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 2 * sum(s.nbytes for s in many)


def test_words_and_shingles_are_counted_across_batches(spark):
    docs = spark.createDataFrame([(i, f"x{i} often said here y{i}") for i in range(12)], "doc_id long, text string")
    docs = docs.selectExpr("doc_id", "text", "xxhash64(doc_id, text) h").coalesce(1)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2")
    try:
        rows = jaccard_join._documents(docs, 3)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert sorted((r.shingle, r.times) for r in rows.where("heard is not null").collect()) == [(False, 12)] * 3 + [(True, 12)]


def test_rows_go_to_python_in_small_batches(spark):
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    rows = spark.range(4000, numPartitions=1).selectExpr("id doc_id", "repeat(concat('w', id, ' '), 200) text")

    def widest(batches):
        yield pa.RecordBatch.from_arrays([pa.array([max(b.nbytes for b in batches)])], ["n"])

    spark.conf.unset(key)
    jaccard_join.link_components(rows.limit(3))
    assert rows.mapInArrow(widest, "n long").first().n < 2 << 20
    spark.conf.set(key, "3m")  # a size that the user has set stays
    jaccard_join.link_components(rows.limit(3))
    assert spark.conf.get(key) == "3m"
    spark.conf.unset(key)


def test_tiles_tell_the_members_of_pairs_left_out():
    rng = np.random.default_rng(6)
    near, other = (np.unique(rng.integers(1, 1 << 62, 100).astype(np.uint64)) for _ in range(2))
    sets = [near, near[1:], near[2:], other]
    e, n = np.arange(10, 14), np.array([len(s) for s in sets])
    found = list(jaccard_join._tile_pairs(e, n, e, np.zeros(4, int), [jaccard_join.bitmap(s) for s in sets], 90, alone=True, tree=True))
    assert [(a, b) for p, q, _ in found for a, b in zip(p.tolist(), q.tolist())] == [(10, 11), (10, 12)]
    assert [m for _, _, members in found for m in members.tolist()] == [11, 12]


def test_connected_components(spark):
    rng = random.Random(3)
    links = [(rng.randrange(200), rng.randrange(200)) for _ in range(150)] + [(300 + i, 301 + i) for i in range(40)] + [(7, 7)]
    root = {x: x for pair in links for x in pair if pair[0] != pair[1]}
    for _ in range(400):
        for a, b in links:
            if a != b:
                root[a] = root[b] = min(root[a], root[b])
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == root
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_bitmaps_bound_the_overlap():
    rng = np.random.default_rng(1)
    for _ in range(50):
        pool = rng.integers(0, 1 << 62, 400).astype(np.uint64)
        x, y = (np.unique(rng.choice(pool, rng.integers(1, 300))) for _ in "ab")
        p, q = jaccard_join.bitmap(x), jaccard_join.bitmap(y)
        words = min(len(p), len(q))
        p, q = jaccard_join.folded(p, words), jaccard_join.folded(q, words)
        shared = len(np.intersect1d(x, y))
        percent = 100 * shared // (len(x) + len(y) - shared)
        assert jaccard_join.may_link(len(x), int(np.bitwise_count(p).sum()), len(y), int(np.bitwise_count(q).sum()), int(np.bitwise_count(p & q).sum()), percent)


def test_run_index_matches_equal_brute_force():
    rng = random.Random(2)
    for _ in range(30):
        groups, data = [], []
        for g in range(rng.randrange(1, 4)):
            for _ in range(rng.randrange(1, 6)):
                groups.append(g)
                data.append(bytes(rng.choice(b"ab\x00\xff") for _ in range(rng.randrange(1, 60))) * rng.randrange(1, 3))
        starts = np.concatenate([[0], np.cumsum([len(d) for d in data])[:-1]])
        index = RunIndex(np.frombuffer(b"".join(data), np.uint8), starts, np.array(groups))
        assert index.run_length.sum() == sum(map(len, data)) + len(data)
        want = []
        for i, d in enumerate(data):
            for j in range(len(d)):
                best = 0
                for i2, d2 in enumerate(data):
                    for j2 in range(len(d2)):
                        if groups[i2] == groups[i] and (i2, j2) != (i, j):
                            n = 0
                            while j + n < len(d) and j2 + n < len(d2) and d[j + n] == d2[j2 + n]:
                                n += 1
                            best = max(best, n)
                want.append(best)
        assert index.matches().tolist() == want


def removed(rows, span):
    encoded = [(i, (t or "").encode()) for i, t in rows]
    times = Counter(t[j:j + span] for _, t in encoded for j in range(len(t) - span + 1))
    out = []
    for i, t in encoded:
        cover = np.zeros(len(t), bool)
        for j in range(len(t) - span + 1):
            if times[t[j:j + span]] > 1:
                cover[j:j + span] = True
        kept = np.frombuffer(t, np.uint8)[~cover].tobytes()
        edges = np.flatnonzero(np.diff(np.concatenate([[0], cover.astype(int), [0]])))
        out.append((i, len(t), int(cover.sum()), list(zip(edges[::2].tolist(), edges[1::2].tolist())), hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("span,gram,index_bytes", [(200, 48, 8 << 20), (60, 16, 3000), (30, 8, 64)])
def test_repeats_equal_brute_force(spark, span, gram, index_bytes, monkeypatch):
    rng = random.Random(4)
    passage = prose(rng, 80)
    extra = [f"{prose(rng, rng.randrange(60))} {passage[:rng.randrange(150, len(passage))]}{prose(rng, 20)}" for _ in range(30)]
    extra += [(prose(rng, 30) + " ") * 4, "é" * 300 + passage]
    docs = documents(spark, extra).repartition(4)
    key = lambda x: (x[0] is None, str(x))
    got = [(r.doc_id, r.n_bytes, r.n_removed, [tuple(s) for s in r.removed], r.kept_sha256) for r in repeats.remove_repeats(docs, span, gram, index_bytes=index_bytes).collect()]
    want = removed([(r.doc_id, r.text) for r in docs.collect()], span)
    assert sorted(got, key=key) == sorted(want, key=key)


@pytest.mark.parametrize("rows", [1, 3])
def test_small_batches_change_nothing(spark, rows):
    """Groups and runs that are cut by the ends of Arrow batches."""
    rng = random.Random(11)
    passage, base = prose(rng, 50), prose(rng, 70).split()
    extra = []
    for i in range(12):
        near = list(base)
        for j in rng.sample(range(70), i // 3):
            near[j] = f"n{i}"
        extra.append(" ".join(near))
    extra += [f"{prose(rng, 30)} {passage} {prose(rng, 9)}" for _ in range(6)] + [extra[0], extra[1]]
    docs = spark.createDataFrame(list(enumerate(extra)), "doc_id long, text string").repartition(2)
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(rows))
    try:
        linked = {(r.doc_id, r.component_id) for r in jaccard_join.link_components(docs, 3, 80, tile=4).collect()}
        cut = sorted((r.doc_id, r.n_bytes, r.n_removed, [tuple(s) for s in r.removed], r.kept_sha256) for r in repeats.remove_repeats(docs, 60, 16, index_bytes=2000).collect())
    finally:
        spark.conf.set(key, before)
    roots = classes([shingles(t, 3) for t in extra], 80)
    assert linked == {(i, root) for i, root in enumerate(roots)}
    assert cut == sorted(removed(list(enumerate(extra)), 60))


def test_repeats_of_an_empty_table_and_long_pieces(spark):
    docs = documents(spark)
    assert repeats.remove_repeats(docs.where("false")).count() == 0
    data = np.frombuffer(b"abcdefgh" * 100, np.uint8)
    old, repeats._PIECE = repeats._PIECE, 300
    try:
        pieces = list(repeats._pieces(data, 200))
    finally:
        repeats._PIECE = old
    starts = defaultdict(int)
    for at, piece in pieces:
        for j in range(len(piece) - 199):
            starts[at + j] += 1
    assert starts == {j: 1 for j in range(601)}


def test_fixture_has_the_cases():
    assert None in texts() and "" in texts()
