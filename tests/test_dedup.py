from pyspark.sql import functions as F

from conftest import rows
from zonekit.operators.dedup import dedup, merge_by_priority, union_sources, upsert


def _data(spark):
    data = [(1, "b", 2.0), (1, "a", 3.0), (1, "a", 1.0), (2, "z", 9.0), (3, None, 0.5), (3, "c", 0.5)]
    return spark.createDataFrame(data, "k int, s string, v double")


def test_dedup_keeps_first_by_order_then_row(spark):
    out = dedup(_data(spark), "k", ["s"])
    assert rows(out) == [(1, "a", 1.0), (2, "z", 9.0), (3, None, 0.5)]
    assert out.columns == ["k", "s", "v"]


def test_dedup_descending(spark):
    out = dedup(_data(spark), "k", ["v"], descending=True)
    assert rows(out, "k", "v") == [(1, 3.0), (2, 9.0), (3, 0.5)]


def test_dedup_invariant_under_repartition(spark):
    df = _data(spark)
    a = rows(dedup(df, "k", ["s"]))
    for n in (1, 3, 7):
        assert rows(dedup(df.repartition(n), "k", ["s"])) == a


def test_dedup_idempotent(spark):
    once = dedup(_data(spark), "k", ["s"])
    assert rows(dedup(once, "k", ["s"])) == rows(once)


def test_hot_key_is_combined_before_the_shuffle(spark):
    # one key holds a third of the rows: the plan aggregates partially on
    # the map side, so the hot key is not collected into one task
    df = spark.range(0, 30000).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("k"),
        (F.col("id") * 7 % 1000).alias("v"))
    out = dedup(df, "k", ["v"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Aggregate") >= 2  # partial + final
    got = {r.k: r.v for r in out.collect()}
    assert got[0] == 0 and len(got) == 20001


def test_union_by_name_with_other_column_order_and_missing(spark):
    a = spark.createDataFrame([(1, "x")], "_id int, ne string")
    b = spark.createDataFrame([("y", 2, "extra")], "neighborhood string, _id int, other string")
    u = union_sources([a, b], {"ne": "neighborhood"})
    assert rows(u, "_id", "neighborhood", "other", "_src_rank") == [(1, "x", None, 0), (2, "y", "extra", 1)]


def test_merge_by_priority_prefers_earlier_source(spark):
    a = spark.createDataFrame([("Q1", "income name")], "_id string, neighborhood string")
    b = spark.createDataFrame([("Q1", "rent name"), ("Q2", "rent only")], "_id string, ne string")
    out = merge_by_priority([a, b], "_id", {"ne": "neighborhood"})
    assert rows(out) == [("Q1", "income name"), ("Q2", "rent only")]


def test_upsert_replaces_by_key(spark):
    old = spark.createDataFrame([(1, "old"), (2, "old")], "k int, v string")
    new = spark.createDataFrame([(2, "new"), (3, "new")], "k int, v string")
    assert rows(upsert(old, new, "k")) == [(1, "old"), (2, "new"), (3, "new")]


def test_sort_result_orders_globally(spark):
    out = dedup(_data(spark), "k", ["s"], sort_result=True)
    assert [r.k for r in out.collect()] == [1, 2, 3]


def test_dedup_with_map_column(spark):
    df = spark.createDataFrame([(1, 2, {"a": 1}), (1, 1, {"b": 2}), (2, 5, None)], "k int, v int, m map<string,int>")
    got = {r.k: (r.v, r.m) for r in dedup(df, "k", ["v"]).collect()}
    assert got == {1: (1, {"b": 2}), 2: (5, None)}


def test_union_makes_mixed_text_and_number_ids_text(spark):
    a = spark.createDataFrame([(1, "x")], "_id int, v string")
    b = spark.createDataFrame([("1", "y"), ("Q1", "z")], "_id string, v string")
    out = merge_by_priority([a, b], "_id")
    assert out.schema["_id"].dataType.simpleString() == "string"
    assert rows(out) == [("1", "x"), ("Q1", "z")]


def test_union_with_both_short_and_long_names(spark):
    a = spark.createDataFrame([(1, None, "short")], "_id int, neighborhood string, ne string")
    b = spark.createDataFrame([(2, "long")], "_id int, neighborhood string")
    u = union_sources([a, b], {"ne": "neighborhood"}, rank_col=None)
    assert u.columns == ["_id", "neighborhood"] and rows(u) == [(1, "short"), (2, "long")]
