"""Incremental rent KPIs with Structured Streaming.

New listing files arriving in a landing folder update the per-neighbourhood
rent KPIs without recomputing history:

* each micro-batch is an ordinary batch plan inside ``foreachBatch`` with
  adaptive execution on: ``prepare`` (joins with static sides) sees measured
  sizes, and a hot join key is split like in any batch job;
* the batch's sums and counts per key are written to
  ``<out>/data/batch_id=<n>`` with overwrite, so a replayed batch rewrites the
  same folder (exactly-once output);
* the current KPI table is the sum of the newest snapshot and the batch
  folders after it (``current_rent_kpis``); ``compact_rent_kpis`` writes a
  snapshot and removes the folders that it covers.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from zonekit.plans.kpi import RENT_KPIS

ADAPTIVE = "spark.sql.adaptive.enabled"


def rent_kpi_state(listings: DataFrame, key: str = "neighborhood_name") -> DataFrame:
    """Sums and counts per key; a hot key is combined before the shuffle."""
    aggs = []
    for kpi, src in RENT_KPIS.items():
        aggs += [F.sum(src).alias(f"{kpi}__sum"), F.count(src).alias(f"{kpi}__n")]
    return listings.where(F.col(key).isNotNull()).groupBy(key).agg(*aggs)


def start_rent_kpi_stream(stream: DataFrame, out_path: str, checkpoint_location: str,
                          key: str = "neighborhood_name", available_now: bool = True,
                          processing_time: str | None = None,
                          prepare: Callable[[DataFrame], DataFrame] | None = None) -> StreamingQuery:
    """Start the incremental KPI query. ``prepare`` turns the rows of a
    micro-batch into listings (default: they are listings). ``available_now``
    processes what has arrived and stops; otherwise it runs every ``processing_time``."""

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        conf = batch.sparkSession.conf  # streams plan with adaptive execution off
        before = conf.get(ADAPTIVE)
        conf.set(ADAPTIVE, "true")
        try:
            sums = rent_kpi_state(prepare(batch) if prepare else batch, key)
            # the batch id lives in the folder name (a partition column on read)
            sums.write.mode("overwrite").parquet(f"{out_path}/data/batch_id={batch_id}")
        finally:
            conf.set(ADAPTIVE, before)

    w = (stream.writeStream.foreachBatch(write_batch)
         .option("checkpointLocation", checkpoint_location))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time or "1 minute")
    return w.start()


def _folder(spark: SparkSession, path: str):
    """(file system, path) in any store that Spark can reach."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _exists(spark: SparkSession, path: str) -> bool:
    fs, p = _folder(spark, path)
    return fs.exists(p)


def _state(spark: SparkSession, out_path: str, key: str) -> tuple[DataFrame | None, int]:
    """(sums per key, last batch id): the newest snapshot plus later batches."""
    parts, upto, last = [], -1, -1
    if _exists(spark, f"{out_path}/snapshots"):
        snaps = spark.read.parquet(f"{out_path}/snapshots")
        upto = last = snaps.agg(F.max("upto")).first()[0]
        parts.append(snaps.where(F.col("upto") == upto).drop("upto"))
    if _exists(spark, f"{out_path}/data"):
        fs, p = _folder(spark, f"{out_path}/data")
        ids = [int(s.getPath().getName().split("=")[1]) for s in fs.listStatus(p) if "=" in s.getPath().getName()]
        if any(i > upto for i in ids):
            last = max(ids)
            parts.append(spark.read.parquet(f"{out_path}/data").where(F.col("batch_id") > F.lit(upto)).drop("batch_id"))
    if not parts:
        return None, -1
    rows = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    return rows.groupBy(key).agg(*[F.sum(f"`{c}`").alias(c) for c in rows.columns if c != key]), last


def compact_rent_kpis(spark: SparkSession, out_path: str, key: str = "neighborhood_name") -> int | None:
    """Write the current sums (one row per key) as a snapshot up to the last
    written batch, then remove the batch folders and older snapshots that it covers.
    Returns that batch id (None: nothing written yet). A crash in between leaves
    folders that the snapshot makes irrelevant."""
    state, last = _state(spark, out_path, key)
    if state is None:
        return None
    if not _exists(spark, f"{out_path}/snapshots/upto={last}/_SUCCESS"):
        state.write.mode("overwrite").parquet(f"{out_path}/snapshots/upto={last}")
    for folder, covered in ((f"{out_path}/data", lambda i: i <= last), (f"{out_path}/snapshots", lambda i: i < last)):
        if not _exists(spark, folder):
            continue
        fs, p = _folder(spark, folder)
        for s in fs.listStatus(p):
            name = s.getPath().getName()
            if "=" in name and covered(int(name.split("=")[1])):
                fs.delete(s.getPath(), True)
    return last


def current_rent_kpis(spark: SparkSession, out_path: str, key: str = "neighborhood_name") -> DataFrame:
    """The KPI table as of the last completed micro-batch (empty before the
    first batch)."""
    state, _ = _state(spark, out_path, key)
    if state is None:
        return spark.createDataFrame([], ", ".join([f"`{key}` string"] + [f"{k} double" for k in RENT_KPIS]))
    return state.select(key, *[F.try_divide(F.col(f"{k}__sum"), F.col(f"{k}__n")).alias(k)
                               for k in RENT_KPIS])
