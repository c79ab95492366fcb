"""Incremental landing: only documents that were not seen before go through.

New files of a landing folder arrive as micro-batches. A batch is made unique on the
document key, anti-joined with the digests of the keys landed before, flattened to listings
and appended. Of what is stored only the digests (32 bytes a document) are read, never
the listings, so a delivery costs its own size and the digests. Every batch writes folders of its own id
with overwrite, the listings first and its digests last: a batch that is replayed after a crash
finds none of its own digests and writes the same folders again. Documents without key are
no copies of one another and all land.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from zonekit.operators.dedup import dedup
from zonekit.plans.zones import flat_listings
from zonekit.streaming.kpi_stream import ADAPTIVE
from zonekit.streaming.window_kpis import _batches


def _digest(key: str) -> Column:
    return F.unhex(F.sha2(F.col(f"`{key}`").cast("string"), 256)).alias("digest")


def start_landing(stream: DataFrame, path: str, checkpoint_location: str, key: str = "_id", batch_order: str | None = None,
                  available_now: bool = True, processing_time: str | None = None) -> StreamingQuery:
    """Start the landing job; of copies in one batch the first by all columns (with ``batch_order`` the last by that column) lands."""

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        before = spark.conf.get(ADAPTIVE)
        spark.conf.set(ADAPTIVE, "true")
        try:
            known = batch.where(F.col(f"`{key}`").isNotNull()).withColumn("_digest", _digest(key))
            earlier = [f"{path}/seen/batch_id={b}" for b in _batches(spark, f"{path}/seen") if b < batch_id]
            # copies meet by digest, as they then meet the digests landed before: documents move once
            once = dedup(known, "_digest", [batch_order] if batch_order else None, descending=bool(batch_order))
            if earlier:
                once = once.join(spark.read.schema("digest binary").parquet(*earlier), F.col("_digest") == F.col("digest"), "left_anti")
            # written once: the listings and the digests come from the same rows
            new = once.drop("_digest").unionByName(batch.where(F.col(f"`{key}`").isNull()))
            new.write.mode("overwrite").parquet(f"{path}/documents/batch_id={batch_id}")
            new = spark.read.schema(batch.schema).parquet(f"{path}/documents/batch_id={batch_id}")
            flat_listings(new, batch_order, unique=key == "_id").write.mode("overwrite").parquet(f"{path}/listings/batch_id={batch_id}")
            new.where(F.col(f"`{key}`").isNotNull()).select(_digest(key)).write.mode("overwrite").parquet(f"{path}/seen/batch_id={batch_id}")
        finally:
            spark.conf.set(ADAPTIVE, before)

    w = stream.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint_location)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time or "1 minute")
    return w.start()


def landed_listings(spark: SparkSession, path: str) -> DataFrame | None:
    """The listings of all finished batches (None before the first)."""
    ids = _batches(spark, f"{path}/seen")
    return spark.read.parquet(*[f"{path}/listings/batch_id={b}" for b in ids]) if ids else None


__all__ = ["start_landing", "landed_listings"]
