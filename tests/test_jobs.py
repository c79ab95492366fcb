"""Jobs that keep state: windowed KPIs, keyed tables, published zone runs, reports."""

import os
import time
from collections import defaultdict
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import rows
from zonekit.operators.conform import conform, conform_reported, rejected_values
from zonekit.plans import star, zones
from zonekit.plans.zones import ZoneConfig, current_zones, newest_listings, run_zones_versioned
from zonekit.sinks import keyed
from zonekit.sinks.keyed import create_keyed_table, read_keyed_table, upsert_keyed_table, vacuum
from zonekit.sinks.pointer import current, current_number, publish
from zonekit.streaming.window_kpis import late_rows, start_window_kpis, window_kpis

SF = "/root/testdata/sf0.001"
START = datetime(2024, 3, 1)
EVENTS = "ts timestamp, kind string, value double"


# ------------------------------------------------------------ windowed KPIs

def _deliver(spark, root, events):
    spark.createDataFrame([(START + timedelta(hours=h) if h is not None else None, k, v) for h, k, v in events], EVENTS).write.mode("append").parquet(f"{root}/landing")


def _run(spark, root):
    stream = spark.readStream.schema(EVENTS).parquet(f"{root}/landing")
    q = start_window_kpis(stream, f"{root}/out", f"{root}/ckpt", "ts", "kind", "value", "1 day", "12 hours")
    q.awaitTermination()


def _kpis(spark, root):
    return {(r.window_start.day, r.key): (r.n, r.mean, r.least, r.most, r.closed) for r in window_kpis(spark, f"{root}/out").collect()}


def test_windows_close_behind_the_watermark_and_late_rows_are_counted(spark, tmp_dir):
    assert window_kpis(spark, f"{tmp_dir}/none").count() == 0 and late_rows(spark, f"{tmp_dir}/none").count() == 0
    _deliver(spark, tmp_dir, [(1, "a", 2.0), (2, "a", 4.0), (3, "b", 1.0), (30, "a", 7.0), (None, "a", 9.0), (31, None, 9.0)])
    _run(spark, tmp_dir)  # watermark: hour 31 (a row without key has a time too) less 12
    assert _kpis(spark, tmp_dir) == {(1, "a"): (2, 3.0, 2.0, 4.0, False), (1, "b"): (1, 1.0, 1.0, 1.0, False), (2, "a"): (1, 7.0, 7.0, 7.0, False)}
    _deliver(spark, tmp_dir, [(5, "b", 3.0), (40, "a", None)])  # still open; the watermark goes to hour 28
    _run(spark, tmp_dir)
    first = _kpis(spark, tmp_dir)
    assert first == {(1, "a"): (2, 3.0, 2.0, 4.0, True), (1, "b"): (2, 2.0, 1.0, 3.0, True), (2, "a"): (2, 3.5, 7.0, 7.0, False)}
    _deliver(spark, tmp_dir, [(6, "b", 100.0), (7, "c", 1.0), (8, "b", 50.0), (33, "a", 1.0)])  # day 1 is closed
    _run(spark, tmp_dir)
    assert _kpis(spark, tmp_dir) == {**first, (2, "a"): (3, 8.0 / 3, 1.0, 7.0, False)}
    assert {(r.window_start.day, r.key): (r.n, r.total) for r in late_rows(spark, f"{tmp_dir}/out").collect()} == {(1, "b"): (2, 150.0), (1, "c"): (1, 1.0)}


def test_a_batch_that_is_replayed_changes_nothing(spark, tmp_dir):
    import shutil

    for k, events in enumerate(([(1, "a", 2.0), (40, "b", 5.0)], [(2, "a", 1.0), (41, "b", 6.0), (70, "a", 1.0)])):
        _deliver(spark, tmp_dir, events)
        _run(spark, tmp_dir)
    before, late = _kpis(spark, tmp_dir), rows(late_rows(spark, f"{tmp_dir}/out"))
    # as after a crash: the batch is written, its commit and its state (written last) are not
    os.remove(os.path.join(tmp_dir, "ckpt", "commits", "1"))
    for f in os.listdir(os.path.join(tmp_dir, "ckpt", "commits")):
        if f.startswith(".1."):
            os.remove(os.path.join(tmp_dir, "ckpt", "commits", f))
    shutil.rmtree(os.path.join(tmp_dir, "out", "state", "batch_id=1"))
    _run(spark, tmp_dir)
    assert _kpis(spark, tmp_dir) == before and rows(late_rows(spark, f"{tmp_dir}/out")) == late


# ------------------------------------------------------ incremental landing

def test_a_delivery_lands_what_was_not_seen_and_reads_no_listings(spark, tmp_dir):
    import shutil

    from zonekit.streaming.landing import landed_listings, start_landing

    ddl = "_id string, value array<struct<propertyCode: string, price: string>>"

    def deliver(docs):
        spark.createDataFrame(docs, ddl).repartition(3).write.mode("append").parquet(f"{tmp_dir}/landing")
        start_landing(spark.readStream.schema(ddl).parquet(f"{tmp_dir}/landing"), f"{tmp_dir}/out", f"{tmp_dir}/ckpt").awaitTermination()

    def landed():
        return rows(landed_listings(spark, f"{tmp_dir}/out").select("_id", "propertyCode", "price"))

    assert landed_listings(spark, f"{tmp_dir}/out") is None
    deliver([("a", [("p1", "1.5"), ("p2", "x")]), ("a", [("p1", "1.5"), ("p2", "x")]), (None, [("n", "1")]), (None, [("n", "1")])])
    first = [(None, "n", 1.0)] * 2 + [("a", "p1", 1.5), ("a", "p2", None)]
    assert landed() == first
    hidden = f"{tmp_dir}/hidden"  # the stored listings and documents are not there: the delivery must not need them
    os.mkdir(hidden)
    for name in ("documents", "listings"):
        shutil.move(f"{tmp_dir}/out/{name}/batch_id=0", f"{hidden}/{name}")
    deliver([("a", [("p1", "9.0")]), ("b", [("p3", "2.0")]), ("b", [("p3", "2.0")])])
    for name in ("documents", "listings"):
        shutil.move(f"{hidden}/{name}", f"{tmp_dir}/out/{name}/batch_id=0")
    assert landed() == first + [("b", "p3", 2.0)]
    deliver([("b", [("p3", "2.0")]), ("a", [])])
    assert landed() == first + [("b", "p3", 2.0)]


# ------------------------------------------------------------- keyed tables

def _files(path):
    return {os.path.join(d, f): os.path.getmtime(os.path.join(d, f)) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


def test_only_touched_buckets_are_written_again(spark, tmp_dir):
    path = f"{tmp_dir}/t"
    table = spark.range(500).select(F.col("id").alias("k"), F.lit("old").alias("v"))
    create_keyed_table(table.union(spark.createDataFrame([(None, "old")], "k long, v string")), path, "k", buckets=8)
    before = _files(path)
    out = upsert_keyed_table(spark.createDataFrame([("new", 3), ("newer", 3), ("new", None), ("new", 1000)], "v string, k long"), path, order_by="v")
    assert 1 <= len(out["touched"]) <= 3
    after = _files(path)
    assert before.items() <= after.items()  # nothing that was there has changed
    assert len({f.split("_bucket=")[1].split("/")[0] for f in after.keys() - before.keys()}) == len(out["touched"])
    got = {r.k: r.v for r in read_keyed_table(spark, path).collect()}
    assert got == {**{k: "old" for k in range(500)}, 3: "new", None: "new", 1000: "new"}
    assert {r.k: r.v for r in read_keyed_table(spark, path, number=1).collect()} == {**{k: "old" for k in range(500)}, None: "old"}
    assert upsert_keyed_table(table.where("false"), path)["touched"] == []
    gone = vacuum(spark, path)
    assert len(gone) == len(out["touched"]) and {r.k: r.v for r in read_keyed_table(spark, path).collect()} == got
    with pytest.raises(ValueError):
        create_keyed_table(table, path, "k")
    with pytest.raises(ValueError):
        read_keyed_table(spark, f"{tmp_dir}/none")


def test_a_job_that_dies_leaves_the_keyed_table_as_it_was(spark, tmp_dir, monkeypatch):
    path = f"{tmp_dir}/t"
    create_keyed_table(spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string"), path, "k", buckets=2)

    def dies(*_, **__):
        raise OSError("lost")

    monkeypatch.setattr(keyed, "publish", dies)
    with pytest.raises(OSError):
        upsert_keyed_table(spark.createDataFrame([(1, "x"), (3, "y")], "k int, v string"), path)
    assert rows(read_keyed_table(spark, path)) == [(1, "a"), (2, "b")]
    monkeypatch.undo()
    upsert_keyed_table(spark.createDataFrame([(1, "x"), (3, "y")], "k int, v string"), path)
    assert rows(read_keyed_table(spark, path)) == [(1, "x"), (2, "b"), (3, "y")]


def test_the_later_of_two_jobs_from_one_state_fails(spark, tmp_dir):
    assert current(spark, tmp_dir) is None and current_number(spark, tmp_dir) == 0
    assert publish(spark, tmp_dir, {"a": 1}) == 1
    assert publish(spark, tmp_dir, {"a": 2}, after=1) == 2
    with pytest.raises(RuntimeError):
        publish(spark, tmp_dir, {"a": 3}, after=1)
    assert current(spark, tmp_dir) == {"a": 2} and current(spark, tmp_dir, 1) == {"a": 1}


# ------------------------------------------------------ published zone runs

def test_readers_see_one_run_of_the_zones(spark, tmp_dir, monkeypatch):
    root = f"{tmp_dir}/zones"
    inputs = star.zone_inputs(spark, SF)
    assert current_zones(spark, root) == {}
    with pytest.raises(ValueError):
        run_zones_versioned(spark, None, ZoneConfig(root=root, steps=("kpis",)))
    first = run_zones_versioned(spark, inputs, ZoneConfig(root=root, steps=("formatted", "kpis")))
    assert current_zones(spark, root) == first
    kpis = rows(spark.read.parquet(first["kpis"]))

    def dies(*_, **__):
        raise OSError("lost")

    monkeypatch.setattr(zones, "exploitation_zone", dies)
    with pytest.raises(OSError):
        run_zones_versioned(spark, inputs, ZoneConfig(root=root, steps=("formatted", "kpis")))
    monkeypatch.undo()
    assert current_zones(spark, root) == first and rows(spark.read.parquet(first["kpis"])) == kpis
    second = run_zones_versioned(spark, None, ZoneConfig(root=root, steps=("kpis",)))
    assert second["kpis"] != first["kpis"] and second["rentals_reconciled"] == first["rentals_reconciled"]
    assert current_zones(spark, root) == second and current_zones(spark, root, 1) == first
    assert rows(spark.read.parquet(second["kpis"])) == kpis


def test_equal_flat_listings_without_code_all_stay(spark):
    columns = "_id string, propertyCode string, price double, _order string, _place int"
    listings = spark.createDataFrame([("b", None, 1.0, "b", 0)] * 2 + [("b", "p", 1.0, "b", 0), ("c", "p", 2.0, "c", 0)], columns)
    assert rows(newest_listings(listings)) == [("b", None, 1.0)] * 2 + [("c", "p", 2.0)]


# ------------------------------------------------------------------ reports

def test_rejects_are_reported_in_the_same_pass(spark, tmp_dir):
    df = spark.createDataFrame([("1", "2x", "7", ["1", "z"], 7), ("x", None, "8", None, 8), (None, "3", "9", [], 9), ("5", "", "9", ["2"], 9)],
                               "a string, b string, c string, d array<string>, key int")
    schema = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.DoubleType()), T.StructField("c", T.StringType()),
                           T.StructField("d", T.ArrayType(T.IntegerType())), T.StructField("absent", T.DateType())])
    typed, observation = conform_reported(df, schema, keep=["key"])
    assert typed._jdf.queryExecution().executedPlan().toString().count("Scan") <= 1
    typed.write.parquet(f"{tmp_dir}/t")
    assert observation.get == {"rows": 4, "a": 1, "b": 2, "c": 0, "d": 0, "absent": 0}
    stored = spark.read.parquet(f"{tmp_dir}/t")
    assert {tuple(r) for r in stored.select("a", "b", "c").collect()} == {tuple(r) for r in conform(df, schema).select("a", "b", "c").collect()}
    assert rows(rejected_values(stored, ["key"])) == [(7, "b", "2x"), (8, "a", "x"), (9, "b", "")]
    with pytest.raises(ValueError):
        conform_reported(df, schema, keep=["c"])


def test_means_per_key_are_those_of_the_joined_arrays(spark):
    from zonekit.functions.arrays import array_mean
    from zonekit.plans.features import key_means, one_doc_per_key

    docs = spark.createDataFrame([(1, "a", [(1.0,), (4.0,)]), (2, "a", [(7.0,)]), (3, "b", []), (4, "b", None), (5, "c", [(1.0,), (None,)]), (6, None, [(1.0,)]),
                                  (7, "d", [(2.0,)]), (8, "d", None)], "_id int, k string, info array<struct<RFD: double>>")
    want = one_doc_per_key(docs, "k").select("k", "_id", array_mean(F.col("info.RFD")).alias("mean"))
    means = key_means(docs, "k", "RFD").withColumnRenamed("key", "k").drop("found")
    assert rows(means) == rows(want) == [("a", 1, 4.0), ("b", 3, None), ("c", 5, None), ("d", 7, 2.0)]


def test_every_new_listing_comes_back(spark):
    from zonekit.plans.catalog_jobs import q_predict_odd_listings

    out = q_predict_odd_listings(spark, SF).collect()
    li = star.table(spark, SF, "lineitem").collect()
    assert len(out) == len(li)
    by_line = defaultdict(set)
    for r in out:
        by_line[r.line].add((r.not_priced, r.prediction is None))
    assert {k: v for k, v in by_line.items() if k in (1, 3, 6)} == {1: {("incomplete", True)}, 3: {(None, False)}, 6: {("no documents", True)}}


# ----------------------------------------------------------- rows that move

def _tables(spark, root):
    """A few rows of the tables that the zone job reads."""
    put = lambda name, rows_, ddl: spark.createDataFrame(rows_, ddl).coalesce(1).write.parquet(f"{root}/{name}.parquet")
    put("region", [(0, "EAST")], "r_regionkey int, r_name string")
    put("nation", [(0, "NATION_0", 0), (1, "NATION_1", 0)], "n_nationkey int, n_name string, n_regionkey int")
    put("supplier", [(k, k % 2) for k in range(4)], "s_suppkey long, s_nationkey int")
    put("customer", [(k, k % 2) for k in range(3)], "c_custkey long, c_nationkey int")
    put("orders", [(k, k % 3, START, 10.0 * k) for k in range(6)], "o_orderkey long, o_custkey long, o_orderdate timestamp, o_totalprice double")
    lines = [(k, 7, k % 4, n, 10.0 + n, 100.0 * k + n, 0.05, 0.04, "R", "F", START + timedelta(days=200 * n)) for k in range(6) for n in range(1, 6)]
    put("lineitem", lines + lines[:1], "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, "
        "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp")
    return lines


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_lines_move_once_to_their_documents(spark, tmp_dir):
    lines = _tables(spark, tmp_dir)
    assert "Exchange hashpartitioning" not in _plan(star.listings(spark, tmp_dir))
    flat = zones.flat_listings(star.zone_inputs(spark, tmp_dir).rentals)
    assert _plan(flat).count("Exchange hashpartitioning") == 1
    newest = newest_listings(flat)
    assert _plan(newest).count("lineitem.parquet") == 1
    assert newest.count() == len(lines) and flat.count() == len(lines) + 1
    assert {(r._id, r.n) for r in flat.groupBy("_id").agg(F.count("price").alias("n")).collect()} == {(f"{k}:{c}", 3 if c == 0 else 2) for k in range(6) for c in (0, 1)} - {("0:0", 3)} | {("0:0", 4)}


def test_listings_without_code_come_back_in_the_same_pass(spark):
    listings = spark.createDataFrame([("b", None, 1.0, "b", 0)] * 3 + [("b", None, None, "b", 0), ("b", "p", 1.0, "b", 0), ("b", "p", 1.0, "b", 1), ("c", "p", 2.0, "c", 0), ("", "q", None, None, None)],
                                     "_id string, propertyCode string, price double, _order string, _place int")
    got = newest_listings(listings)
    assert rows(got) == rows(spark.createDataFrame([("b", None, 1.0)] * 3 + [("b", None, None), ("c", "p", 2.0), ("", "q", None)], "_id string, propertyCode string, price double"))
    assert got.columns == ["_id", "propertyCode", "price"] and "Union" not in _plan(got)


def test_a_delivery_is_made_unique_once(spark, tmp_dir, monkeypatch):
    from zonekit.streaming.landing import landed_listings, start_landing

    def again(*_, **__):
        raise AssertionError("documents are unique already")

    monkeypatch.setattr(zones, "dedup", again)
    ddl = "_id string, value array<struct<propertyCode: string, price: string>>"
    spark.createDataFrame([("a", [("p", "1")]), ("a", [("p", "1")]), (None, [("n", "2")]), (None, [("n", "2")]), ("b", None)], ddl).write.parquet(f"{tmp_dir}/landing")
    start_landing(spark.readStream.schema(ddl).parquet(f"{tmp_dir}/landing"), f"{tmp_dir}/out", f"{tmp_dir}/ckpt").awaitTermination()
    assert rows(landed_listings(spark, f"{tmp_dir}/out").select("_id", "propertyCode", "price")) == [(None, "n", 2.0)] * 2 + [("a", "p", 1.0)]


def test_training_keeps_what_the_pipeline_reads(spark):
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import SQLTransformer

    from zonekit.operators.model import build_pipeline, train, training_columns

    columns = ["_id", "exterior", "floor", "RFD", "price"]
    assert training_columns(build_pipeline(numeric=["floor"], flags=["exterior"]), columns) == ["exterior", "floor", "price"]
    assert training_columns(Pipeline(stages=[SQLTransformer(statement="SELECT RFD FROM __THIS__")]), columns) == columns
    df = spark.createDataFrame([(k, "true" if k % 2 else "false", float(k), [1.0], 10.0 * (k % 2)) for k in range(20)], "_id int, exterior string, floor double, RFD array<double>, price double")
    model = train(df, build_pipeline(numeric=[], flags=["exterior"], maxIter=1, maxDepth=1))
    assert {(r.price, r.prediction) for r in model.transform(df).collect()} == {(0.0, 0.0), (10.0, 10.0)}


def test_listings_are_sorted_once_on_each_side_of_their_shuffle(spark, tmp_dir):
    from zonekit.session import WRITE_CONF, settings

    lines = _tables(spark, tmp_dir)
    before = {k: spark.conf.get(k) for k in WRITE_CONF}
    with settings(spark, WRITE_CONF):
        flat = zones.flat_listings(star.zone_inputs(spark, tmp_dir).rentals)
        newest = newest_listings(flat)
        assert _plan(flat).count("Sort [") == 1 and _plan(newest).count("Sort [") == 2 and "HashAggregate" not in _plan(newest)
        assert newest.count() == len(lines) and flat.count() == len(lines) + 1
    assert {k: spark.conf.get(k) for k in WRITE_CONF} == before
    with pytest.raises(OSError), settings(spark, {**WRITE_CONF, "zonekit.test": "1"}):
        raise OSError("lost")
    assert {k: spark.conf.get(k) for k in WRITE_CONF} == before and spark.conf.get("zonekit.test", None) is None


def test_the_newest_copy_of_a_listing_stays_whatever_its_order(spark):
    columns = "_id string, propertyCode string, price double, _order string, _place int"
    copies = [("a", "p", 9.0, "1", 0), ("a", "p", 1.0, "2", 0), ("b", "p", None, "2", 1), ("b", "p", 2.0, "2", 1), ("b", "p", 2.0, "2", 1), (None, "p", 7.0, "2", None), ("z", "p", 8.0, None, 5),
              ("a", "q", None, None, 0), ("a", None, float("nan"), None, 0), ("a", None, float("nan"), None, 0)]
    for some in (copies, copies[::-1]):
        got = rows(newest_listings(spark.createDataFrame(some, columns).repartition(3)))
        assert [str(r) for r in got] == [str(r) for r in [("a", None, float("nan"))] * 2 + [("a", "q", None), ("b", "p", 2.0)]]


def test_shuffles_of_a_write_leave_the_disk(spark, tmp_dir):
    def shuffles():
        blocks = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().getAllBlocks()
        return {b for b in blocks.mkString(" ").split() if b.startswith("shuffle_")}

    before = shuffles()
    written = zones._write(spark.range(2000).groupBy((F.col("id") % 7).alias("k")).count(), f"{tmp_dir}/t")
    until = time.time() + 10
    while shuffles() - before and time.time() < until:
        time.sleep(0.1)
    assert not shuffles() - before and written.count() == 7
