"""Keyed tables that are replaced in place, bucket by bucket.

Rows lie in buckets by a hash of their key. A delivery touches the buckets of its
keys: only those are read, merged with the delivery and written again, in a new
folder; all other buckets' files stay as they are. The table's pointer
(``sinks.pointer``) names each bucket's folder and moves last, so readers see whole deliveries
only, and a job that dies leaves the table as it was. ``vacuum`` removes folders that
no bucket uses any more.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zonekit.operators.dedup import dedup, upsert
from zonekit.sinks.pointer import _fs, current, current_number, publish

BUCKET = "_bucket"


def _bucketed(df: DataFrame, keys: Sequence[str], buckets: int) -> DataFrame:
    return df.withColumn(BUCKET, F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int"))


def _write(df: DataFrame, path: str, folder: str, keys: Sequence[str], buckets: int) -> None:
    _bucketed(df, keys, buckets).repartition(BUCKET).write.partitionBy(BUCKET).parquet(f"{path}/data/{folder}")


def _written(spark: SparkSession, path: str, folder: str) -> list[int]:
    fs, p = _fs(spark, f"{path}/data/{folder}")
    return sorted(int(s.getPath().getName().split("=")[1]) for s in fs.listStatus(p) if s.getPath().getName().startswith(f"{BUCKET}="))


def create_keyed_table(df: DataFrame, path: str, keys: str | Sequence[str], buckets: int = 64, order_by: str | Sequence[str] | None = None) -> None:
    """A new table at ``path``: one row per key (the first by ``order_by``, then by the whole row)."""
    spark, keys = df.sparkSession, [keys] if isinstance(keys, str) else list(keys)
    if current_number(spark, path):
        raise ValueError(f"{path} holds a table already")
    folder = f"v1-{uuid.uuid4().hex[:8]}"
    _write(dedup(df, keys, order_by), path, folder, keys, buckets)
    publish(spark, path, {"keys": keys, "buckets": buckets, "schema": df.schema.json(), "folders": {str(b): folder for b in _written(spark, path, folder)}}, after=0)


def read_keyed_table(spark: SparkSession, path: str, only: Sequence[int] | None = None, number: int | None = None) -> DataFrame:
    """The table as last published, or as of a number; ``only`` some of its buckets."""
    state = current(spark, path, number)
    if state is None:
        raise ValueError(f"{path} holds no table")
    schema = T.StructType.fromJson(json.loads(state["schema"]))
    folders = [f"{path}/data/{folder}/{BUCKET}={b}" for b, folder in sorted(state["folders"].items()) if only is None or int(b) in set(only)]
    return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)


def upsert_keyed_table(incoming: DataFrame, path: str, order_by: str | Sequence[str] | None = None) -> dict:
    """Replace rows by key, add new ones. Returns ``{"touched": [...], "number": n}``."""
    spark = incoming.sparkSession
    number = current_number(spark, path)
    state = current(spark, path, number)
    if state is None:
        raise ValueError(f"{path} holds no table")
    keys, buckets = state["keys"], state["buckets"]
    stored = read_keyed_table(spark, path, number=number)
    fresh = dedup(incoming.select(*stored.columns), keys, order_by)
    # at most as many numbers as the table has buckets
    touched = sorted(r[0] for r in _bucketed(fresh, keys, buckets).select(BUCKET).distinct().collect())
    if not touched:
        return {"touched": [], "number": number}
    folder = f"v{number + 1}-{uuid.uuid4().hex[:8]}"
    _write(upsert(read_keyed_table(spark, path, touched, number), fresh, keys), path, folder, keys, buckets)
    folders = {**state["folders"], **{str(b): folder for b in touched}}
    return {"touched": touched, "number": publish(spark, path, {**state, "folders": folders}, after=number)}


def vacuum(spark: SparkSession, path: str) -> list[str]:
    """Remove the bucket folders that the current state does not use; returns their names. Only while no older state is read."""
    used = {(folder, b) for b, folder in current(spark, path)["folders"].items()}
    fs, data = _fs(spark, f"{path}/data")
    gone = []
    for version in fs.listStatus(data):
        folder = version.getPath().getName()
        for bucket in fs.listStatus(version.getPath()):
            name = bucket.getPath().getName()
            if name.startswith(f"{BUCKET}=") and (folder, name.split("=")[1]) not in used:
                fs.delete(bucket.getPath(), True)
                gone.append(f"{folder}/{name}")
    return gone


__all__ = ["create_keyed_table", "read_keyed_table", "upsert_keyed_table", "vacuum"]
