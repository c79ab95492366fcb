import os

from pyspark.sql import functions as F

from conftest import rows
from zonekit.plans import star
from zonekit.plans.catalog import rounded
from zonekit.plans.kpi import RENT_KPIS
from zonekit.streaming.kpi_stream import (compact_rent_kpis, current_rent_kpis, rent_kpi_state,
                                          start_rent_kpi_stream)

SF = "/root/testdata/sf0.001"


def _batch_kpis(listings):
    return listings.groupBy("neighborhood_name").agg(*[F.avg(s).alias(k) for k, s in RENT_KPIS.items()])


def test_stream_updates_incrementally_and_resumes(spark, tmp_dir):
    li = star.table(spark, SF, "lineitem")
    landing = os.path.join(tmp_dir, "landing")
    first = li.where(F.col("l_orderkey") % 3 != 0)
    second = li.where(F.col("l_orderkey") % 3 == 0)
    first.write.parquet(os.path.join(landing, "part=1"))
    out, ckpt = os.path.join(tmp_dir, "out"), os.path.join(tmp_dir, "ckpt")

    def run():
        stream = (spark.readStream.schema(li.schema).option("recursiveFileLookup", "true")
                  .parquet(landing))
        q = start_rent_kpi_stream(stream, out, ckpt, prepare=lambda batch: star.listings(spark, SF, lineitem=batch))
        q.awaitTermination()
        return q

    run()
    got1 = rows(rounded(current_rent_kpis(spark, out)))
    assert got1 == rows(rounded(_batch_kpis(star.listings(spark, SF, lineitem=first))))
    # snapshot the state; the next read combines it with newer batches only
    upto = compact_rent_kpis(spark, out)
    assert rows(rounded(current_rent_kpis(spark, out))) == got1
    assert not [x for x in os.listdir(os.path.join(out, "data")) if x.startswith("batch_id=")]

    second.write.parquet(os.path.join(landing, "part=2"))
    q = run()
    got2 = rows(rounded(current_rent_kpis(spark, out)))
    assert got2 == rows(rounded(_batch_kpis(star.listings(spark, SF))))
    assert upto is not None
    again = compact_rent_kpis(spark, out)
    assert again > upto and [x for x in os.listdir(os.path.join(out, "snapshots")) if "=" in x] == [f"upto={again}"]
    assert compact_rent_kpis(spark, out) == again and rows(rounded(current_rent_kpis(spark, out))) == got2
    # the second run read exactly the new files
    assert sum(p["numInputRows"] for p in q.recentProgress) == second.count()


def test_state_is_one_row_per_key(spark):
    lst = star.listings(spark, SF)
    st = rent_kpi_state(lst)
    assert st.count() == lst.select("neighborhood_name").distinct().count()


def test_micro_batches_join_adaptively_and_split_a_hot_supplier(spark, tmp_dir):
    li = star.table(spark, SF, "lineitem")
    hot = li.withColumn("l_suppkey", F.when(F.col("l_linenumber") > 1, li.select(F.min("l_suppkey")).first()[0]).otherwise(F.col("l_suppkey")))
    landing = os.path.join(tmp_dir, "landing")
    hot.write.parquet(os.path.join(landing, "part=1"))
    stream = spark.readStream.schema(li.schema).option("recursiveFileLookup", "true").parquet(landing)
    seen = []

    def prepare(batch):
        seen.append(batch.sparkSession.conf.get("spark.sql.adaptive.enabled"))
        return star.listings(spark, SF, lineitem=batch)

    tables = len(spark.catalog.listTables())
    start_rent_kpi_stream(stream, os.path.join(tmp_dir, "out"), os.path.join(tmp_dir, "ckpt"), prepare=prepare).awaitTermination()
    assert seen and set(seen) == {"true"}
    assert len(spark.catalog.listTables()) == tables
    got = rows(rounded(current_rent_kpis(spark, os.path.join(tmp_dir, "out"))))
    assert got == rows(rounded(_batch_kpis(star.listings(spark, SF, lineitem=hot))))


def test_current_kpis_before_the_first_batch(spark, tmp_dir):
    li = star.table(spark, SF, "lineitem")
    landing = os.path.join(tmp_dir, "empty")
    os.makedirs(landing)
    stream = spark.readStream.schema(li.schema).parquet(landing)
    out = os.path.join(tmp_dir, "out")
    start_rent_kpi_stream(stream, out, os.path.join(tmp_dir, "c"),
                          prepare=lambda batch: star.listings(spark, SF, lineitem=batch)).awaitTermination()
    assert compact_rent_kpis(spark, out) is None
    kpis = current_rent_kpis(spark, out)
    assert kpis.count() == 0 and kpis.columns == ["neighborhood_name", *RENT_KPIS]
