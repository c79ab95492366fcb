import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tests.llm.fixture import documents, plain, prose, texts
from zonekit.llm import packing, queries, ranked_search
from zonekit.llm.common import scratch

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def split(text):
    return TERM.findall((text or "").translate(FOLD))


def ranked(docs, items, k):
    """(item number, doc_id, score) of the best documents, by the formulas alone."""
    counts = [(i, Counter(split(t))) for i, t in docs]
    counts = [(i, c) for i, c in counts if c]
    n_all, l_all = len(counts), sum(sum(c.values()) for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    out = []
    for number, text in enumerate(items):
        scores = []
        for i, c in counts:
            m = 75 + 25 * sum(c.values()) * n_all // l_all
            score = sum(math.floor(1000 * math.log((2 * n_all + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 12 * m)) for t in split(text) if t in c)
            if score > 0:
                scores.append((-score, i is None, i or 0))
        out += [(number, None if none else i, -s) for s, none, i in sorted(scores)[:k]]
    return out


def searched(spark, docs, items, k, **sizes):
    rows = spark.createDataFrame([(n, t, "x", 5) for n, t in enumerate(items)], "item_id long, text string, term string, query int")
    path = scratch(spark, "t")
    cut = {a: b for a, b in sizes.items() if a.startswith("shard")}
    index = ranked_search.build_index(docs, path, **cut)
    found = ranked_search.search(index, rows, k, **{a: b for a, b in sizes.items() if a not in cut}).collect()
    for item in {r.item_id for r in found}:
        assert sorted(r.rank for r in found if r.item_id == item) == list(range(1, 1 + sum(r.item_id == item for r in found)))
    return [(r.item_id, r.doc_id, r.score) for r in sorted(found, key=lambda r: (r.item_id, r["rank"]))]


ITEMS = ["w1 w2 w3 W1.", "edit3x1 w7", None, "", "no-such-term-there", "日本語 été ÀÉ", "the x" + "x" * 899, " ".join(f"w{i}" for i in range(300)), "w1 w2 w3 W1."]


@pytest.mark.parametrize("sizes", [{}, {"shard_rows": 3, "window": 2, "query_block": 2}, {"shard_bytes": 2000, "window": 1}])
def test_search_equals_brute_force(spark, sizes):
    docs = documents(spark)
    want = ranked([(r.doc_id, r.text) for r in docs.collect()], ITEMS, 5)
    assert searched(spark, docs.repartition(4), ITEMS, 5, **sizes) == want


def test_search_over_many_blocks(spark):
    rng = random.Random(3)
    rows = [(i * 3, " ".join(f"t{min(rng.randrange(400), rng.randrange(400))}" for _ in range(rng.choice((3, 30, 300))))) for i in range(1500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    items = [" ".join(f"t{rng.randrange(400)}" for _ in range(n)) for n in (1, 2, 5, 20, 60)] + ["t0 t0 t0 t399"]
    for sizes in ({}, {"window": 64}, {"window": 100, "shard_rows": 400}):
        assert searched(spark, docs, items, 20, **sizes) == ranked(rows, items, 20)


def test_blocks_are_rejected_unread(spark):
    rng = random.Random(4)
    rows = [(i, "common " * rng.randrange(1, 4) + ("rare " * 3 if i < 40 else "") + prose(rng, 20)) for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    index = {r["term"]: r.asDict() for r in ranked_search.build_index(docs, scratch(spark, "t")).where("term in ('', 'common', 'rare')").collect()}
    lengths = np.frombuffer(index[""]["lengths"], "<i8")
    norm = lambda n: 75 + 25 * n * 3000 // lengths.sum()
    lists = [ranked_search._List(index[t], norm(lengths), norm) for t in ("common", "rare")]
    found, scores = ranked_search.search_shard([(1, lists[0]), (5000, lists[1])], 3000, 20, window=256)
    values = [np.bincount(p.docs[:0], minlength=3000) for p in lists]
    for p, v in zip(lists, values):
        read = p.done.copy()
        p.read(range(len(p.last)))
        v[p.docs] = p.values
        p.was_read = read
    total = values[0] + 5000 * values[1]
    assert list(zip(found, scores)) == [(d, total[d]) for d in np.lexsort((np.arange(3000), -total))[:20]]
    assert lists[0].was_read.sum() <= 3 < len(lists[0].last)


def test_search_of_empty_tables(spark):
    docs = documents(spark)
    assert searched(spark, docs.where("false"), ITEMS, 5) == []
    assert searched(spark, docs.withColumn("text", F.lit(None).cast("string")), ITEMS, 5) == []
    assert searched(spark, docs, [None, "", "...", "zzz-no"], 5) == []


def test_equal_item_ids_are_ranked_each(spark):
    docs = plain(spark)
    items = spark.createDataFrame([(1, "w1 w2"), (1, "w1 w2"), (None, "w2 w1")], "item_id long, text string")
    found = ranked_search.ranked_search(docs, items, 4).collect()
    assert sorted(r["rank"] for r in found if r.item_id == 1) == [1, 1, 2, 2, 3, 3, 4, 4]
    assert sorted(r["rank"] for r in found if r.item_id is None) == [1, 2, 3, 4]


def check_packed(pieces, docs, length, end_id):
    """Every document's ids once, in order; sequences gapless, within length; returns ids of padding."""
    whole = Tokenizer.from_file(queries.WORD_TOKENIZER)
    want = Counter()
    for i, t in docs:
        want[i, tuple([*whole.encode(t or "", add_special_tokens=False).ids, end_id])] += 1
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for p in pieces:
        ids = np.frombuffer(p.ids, "<u4").tolist()
        assert len(ids) == p.length > 0
        by_doc[p.doc_id].append((p.start, ids, p.doc_tokens))
        by_sequence[p.sequence_id].append((p.offset, p.length))
    padding = 0
    for parts in by_sequence.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= length
        padding += 0 if at & (at - 1) == 0 else length - at
    counted = Counter(i for i, _ in want.elements())
    for i, ids in want:
        if counted[i] == 1:
            parts = sorted(by_doc[i])
            assert [x for _, p, _ in parts for x in p] == list(ids) and all(n == len(ids) for _, _, n in parts)
            assert [s for s, _, _ in parts] == np.cumsum([0, *(len(p) for _, p, _ in parts)])[:-1].tolist()
    assert sum(p.length for p in pieces) == sum(len(ids) * n for (_, ids), n in want.items())
    assert Counter(x for p in pieces for x in np.frombuffer(p.ids, "<u4").tolist()) == Counter(x for (_, ids), n in want.items() for x in ids * n)
    return padding


@pytest.mark.parametrize("length, n_open, merge, parts", [(2048, 32, 64, 3), (64, 2, 2, 7), (16, 1, 3, 5), (1, 1, 2, 2)])
def test_packed_pieces_tile_documents_and_sequences(spark, length, n_open, merge, parts):
    docs = documents(spark)
    rows = [(r.doc_id, r.text) for r in docs.collect() if length > 1 or len(r.text or "") < 1000]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("window", F.lit("x")).withColumn("part", F.lit(1)).repartition(parts)
    pieces = packing.pack(docs, queries.WORD_TOKENIZER, 1, length, n_open, merge).collect()
    assert check_packed(pieces, rows, length, 1) == 0


def test_packing_of_empty_and_null(spark):
    docs = spark.createDataFrame([(1, None), (2, ""), (None, "a")], "doc_id long, text string")
    assert packing.pack(docs.where("false"), queries.WORD_TOKENIZER, 1).count() == 0
    pieces = packing.pack(docs, queries.WORD_TOKENIZER, 1).collect()
    assert check_packed(pieces, [(1, None), (2, ""), (None, "a")], 2048, 1) == 0
    with pytest.raises(ValueError):
        packing.pack(docs, queries.WORD_TOKENIZER, 1, length=1000)


def test_best_fit_before_cutting():
    packer = packing.Packer(10, 2)
    for n in (7, 4, 3, 6, 9):
        packer.place(n, 0, np.arange(n), n)
    # 3 goes to the 7, 6 to the 4; 9 opens a window of its own
    assert [[p[0] for p in pieces] for _, pieces in packer.emitted] == [[7, 3], [4, 6]]
    assert [[p[0] for p in pieces] for pieces in packer.windows.values()] == [[9]]
    packer.place(5, 0, np.arange(5), 5)
    packer.place(8, 0, np.arange(8), 8)  # none fits: the fullest is filled with its first id
    assert [(p[0], len(p[2])) for p in packer.emitted[-1][1]] == [(9, 9), (8, 1)]


def test_packing_query(spark):
    got = queries.op12_packing(spark, "/root/testdata/sf0.001").collect()
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    whole = Tokenizer.from_file(queries.WORD_TOKENIZER)
    ids = {r.doc_id: np.array([*whole.encode(r.text or "", add_special_tokens=False).ids, 1], "<u4") for r in docs}
    tiled, lengths = Counter(), Counter()
    for r in got:
        assert r.doc_tokens == len(ids[r.doc_id])
        assert zlib.crc32(ids[r.doc_id][r.start:r.start + r.length].tobytes()) == r.ids_crc32
        tiled.update((r.doc_id, i) for i in range(r.start, r.start + r.length))
        lengths[r.sequence_id] += r.length
    assert tiled == Counter((i, k) for i, x in ids.items() for k in range(len(x)))
    assert sum(n != 2048 for n in lengths.values()) <= 11 and all(n & (n - 1) == 0 for n in lengths.values())
