import json
import os

import pytest

from conftest import rows
from zonekit.schemas import DISTRICT_RENAMES, lookup_district_schema
from zonekit.sinks.writers import upsert_table, write_table
from zonekit.sources.readers import read_collection, read_json_lines, read_table


def test_json_lines_lookup_with_declared_schema(spark, tmp_dir):
    path = os.path.join(tmp_dir, "district.json")
    with open(path, "w", encoding="utf-8") as f:
        f.write(json.dumps({"_id": "D1", "di": "Alt Molí", "di_n": "alt moli", "di_re": "Molí, Alt",
                            "ne_id": ["N1", "N2"]}, ensure_ascii=False) + "\n")
        f.write(json.dumps({"_id": "D2", "district": "Vall Gròga", "district_name": "vall groga",
                            "district_reconciled": "Gròga, Vall", "neighborhood_id": ["N3"]},
                           ensure_ascii=False) + "\n")
    short = read_json_lines(spark, path, "_id string, di string, di_n string, di_re string, ne_id array<string>")
    renamed = short.withColumnsRenamed(DISTRICT_RENAMES)
    assert renamed.columns == lookup_district_schema().fieldNames()
    got = {r._id: r for r in renamed.collect()}
    assert got["D1"].neighborhood_id == ["N1", "N2"] and got["D2"].district is None
    full = read_json_lines(spark, path, lookup_district_schema())
    assert {r._id: r.district for r in full.collect()}["D2"] == "Vall Gròga"


def test_write_and_upsert_to_new_path(spark, tmp_dir):
    base = os.path.join(tmp_dir, "t0")
    write_table(spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string"), base)
    out = upsert_table(spark, base, spark.createDataFrame([(2, "B"), (3, "C")], "k int, v string"), "k",
                       os.path.join(tmp_dir, "t1"))
    assert rows(out) == [(1, "a"), (2, "B"), (3, "C")]
    with pytest.raises(ValueError):
        upsert_table(spark, base, out, "k", base)
    write_table(out, base, mode="overwrite")
    assert read_table(spark, base).count() == 3


def test_trailing_space_columns_trimmed_on_read(spark, tmp_dir):
    p = os.path.join(tmp_dir, "inc")
    spark.createDataFrame([(1, "x")], "_id int, `neigh_name ` string").write.parquet(p)
    assert read_table(spark, p).columns == ["_id", "neigh_name"]
    assert read_table(spark, p, trim_names=False).columns == ["_id", "neigh_name "]


def test_read_collection_passes_format_and_options(spark, tmp_dir):
    p = os.path.join(tmp_dir, "c")
    spark.createDataFrame([(1, "x")], "_id int, v string").write.parquet(p)
    df = read_collection(spark, "parquet", "_id int, v string", path=p)
    assert rows(df) == [(1, "x")]


def test_json_lines_with_byte_order_mark(spark, tmp_dir):
    path = os.path.join(tmp_dir, "bom.json")
    with open(path, "wb") as f:
        f.write(b"\xef\xbb\xbf" + '{"_id":"Q1","ne":"Gràcia"}\n{"_id":"Q2","ne":"Sants"}\n'.encode("utf-8"))
    assert rows(read_json_lines(spark, path, "_id string, ne string")) == [("Q1", "Gràcia"), ("Q2", "Sants")]


def test_write_jdbc_passes_url_table_mode_and_credentials(spark, monkeypatch):
    # no database is started here: the call into Spark's JDBC writer is recorded instead
    from pyspark.sql.readwriter import DataFrameWriter

    from zonekit.sinks.writers import write_jdbc

    seen = {}

    def fake_jdbc(self, url, table, mode=None, properties=None):
        seen.update(url=url, table=table, mode=mode, properties=properties,
                    partitions=self._df.rdd.getNumPartitions())

    monkeypatch.setattr(DataFrameWriter, "jdbc", fake_jdbc)
    df = spark.range(100).repartition(8)
    write_jdbc(df, "jdbc:postgresql://db.example:5432/zones", "kpis_table", user="u", password="p",
               driver="org.postgresql.Driver", num_partitions=2)
    assert seen["url"] == "jdbc:postgresql://db.example:5432/zones" and seen["table"] == "kpis_table"
    assert seen["mode"] == "overwrite" and seen["partitions"] == 2
    assert seen["properties"] == {"batchsize": "10000", "user": "u", "password": "p",
                                  "driver": "org.postgresql.Driver"}
