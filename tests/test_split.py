"""The hash split against an independent computation in plain Python."""

import hashlib

from zonekit.operators.model import hash_split
from zonekit.plans.catalog import q_hash_split_counts
from zonekit.plans.star import table

SF = "/root/testdata/sf0.001"


def _bucket(salt: int, *keys) -> int:
    return int(hashlib.md5("|".join(map(str, (salt, *keys))).encode()).hexdigest()[:8], 16) % 100


def test_split_matches_brute_force(spark):
    li = table(spark, SF, "lineitem").select("l_orderkey", "l_linenumber")
    tr, te = hash_split(li, ["l_orderkey", "l_linenumber"])
    keys = [(r.l_orderkey, r.l_linenumber) for r in li.collect()]
    want_train = sorted(k for k in keys if _bucket(0, *k) < 75)
    want_test = sorted(k for k in keys if _bucket(0, *k) >= 75)
    assert sorted((r.l_orderkey, r.l_linenumber) for r in tr.collect()) == want_train
    assert sorted((r.l_orderkey, r.l_linenumber) for r in te.collect()) == want_test
    counts = {r.part: r.n for r in q_hash_split_counts(spark, SF).collect()}
    assert counts == {"train": len(want_train), "test": len(want_test)}


def test_split_is_repeatable_and_partition_independent(spark):
    li = table(spark, SF, "lineitem")
    a = sorted(map(tuple, hash_split(li, ["l_orderkey", "l_linenumber"])[1].collect()))
    b = sorted(map(tuple, hash_split(li.repartition(5), ["l_orderkey", "l_linenumber"])[1].collect()))
    assert a == b


def test_null_keys_are_split_too(spark):
    df = spark.createDataFrame([(None, i) for i in range(200)], "a string, b int")
    tr, te = hash_split(df, ["a", "b"])
    assert tr.count() + te.count() == 200 and te.count() > 0
