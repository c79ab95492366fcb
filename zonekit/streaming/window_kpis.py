"""Incremental KPIs on event-time windows, with a watermark and late rows.

Each micro-batch is a batch plan inside ``foreachBatch`` (adaptive execution on; sums per
window and key are combined before the shuffle, so a hot key is no hot task). Three things are
kept per batch, in folders named by its id and written with overwrite, so a
batch that is replayed after a crash rewrites what it had written:

* ``state``  - sums of the windows that are still open (older ones leave it, so a batch
  costs what is open, not the history);
* ``closed`` - windows whose end the watermark has passed, each once;
* ``late``   - rows that came for a window already closed: counted and summed per
  window and key, never mixed into a published window and never lost.

The watermark after a batch is the latest event time seen so far less the
allowed delay; it is stored with the state, and a batch is judged by the one before it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from zonekit.streaming.kpi_stream import ADAPTIVE, _exists, _folder


def window_sums(events: DataFrame, time_col: str, key_col: str, value_col: str, width: str) -> DataFrame:
    """``(window_start, window_end, key, n, total, least, most)``; rows without time or key are left out."""
    rows = events.where(F.col(time_col).isNotNull() & F.col(key_col).isNotNull())
    rows = rows.select(F.window(F.col(time_col), width).alias("w"), F.col(key_col).cast("string").alias("key"), F.col(value_col).cast("double").alias("v"))
    return _summed(rows.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "key",
                               F.lit(1).cast("long").alias("n"), F.col("v").alias("total"), F.col("v").alias("least"), F.col("v").alias("most")))


def _summed(parts: DataFrame) -> DataFrame:
    return parts.groupBy("window_start", "window_end", "key").agg(F.sum("n").alias("n"), F.sum("total").alias("total"), F.min("least").alias("least"), F.max("most").alias("most"))


def _batches(spark: SparkSession, folder: str) -> list[int]:
    """Ids of the finished batch folders."""
    if not _exists(spark, folder):
        return []
    fs, p = _folder(spark, folder)
    names = [s.getPath().getName() for s in fs.listStatus(p)]
    return sorted(int(n.split("=")[1]) for n in names if n.startswith("batch_id=") and _exists(spark, f"{folder}/{n}/_SUCCESS"))


def start_window_kpis(stream: DataFrame, out_path: str, checkpoint_location: str, time_col: str, key_col: str, value_col: str,
                      width: str = "1 day", delay: str = "1 day", available_now: bool = True, processing_time: str | None = None) -> StreamingQuery:
    """Start the query; ``available_now`` processes what has arrived and stops."""

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        before = spark.conf.get(ADAPTIVE)
        spark.conf.set(ADAPTIVE, "true")
        try:
            earlier = [b for b in _batches(spark, f"{out_path}/state") if b < batch_id]
            kind = batch.schema[time_col].dataType
            mark = lambda b: F.lit(spark.read.parquet(f"{out_path}/marks/batch_id={b}").first()[0]).cast(kind)
            old = mark(earlier[-1]) if earlier else F.lit(None).cast(kind)
            sums = window_sums(batch, time_col, key_col, value_col, width)
            sums.write.mode("overwrite").parquet(f"{out_path}/sums/batch_id={batch_id}")
            sums = spark.read.schema(sums.schema).parquet(f"{out_path}/sums/batch_id={batch_id}")
            latest = batch.agg((F.max(time_col) - F.expr(f"INTERVAL {delay}")).alias("mark"))
            # as text: it comes back in the session's time zone
            latest.select(F.greatest("mark", old).cast("string").alias("mark")).write.mode("overwrite").parquet(f"{out_path}/marks/batch_id={batch_id}")
            new = mark(batch_id)
            late = F.coalesce(F.col("window_end") <= old, F.lit(False))
            sums.where(late).write.mode("overwrite").parquet(f"{out_path}/late/batch_id={batch_id}")
            state = sums.where(~late)
            if earlier:
                state = _summed(state.unionByName(spark.read.schema(sums.schema).parquet(f"{out_path}/state/batch_id={earlier[-1]}")))
            done = F.coalesce(F.col("window_end") <= new, F.lit(False))
            state.where(done).write.mode("overwrite").parquet(f"{out_path}/closed/batch_id={batch_id}")
            # last: a batch counts as done when its state is there
            state.where(~done).write.mode("overwrite").parquet(f"{out_path}/state/batch_id={batch_id}")
        finally:
            spark.conf.set(ADAPTIVE, before)

    w = stream.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint_location)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time or "1 minute")
    return w.start()


def _read(spark: SparkSession, out_path: str, name: str, ids: list[int]) -> DataFrame:
    paths = [f"{out_path}/{name}/batch_id={b}" for b in ids]
    schema = "window_start timestamp, window_end timestamp, key string, n long, total double, least double, most double"
    return spark.read.parquet(*paths) if paths else spark.createDataFrame([], schema)


def window_kpis(spark: SparkSession, out_path: str) -> DataFrame:
    """``(window_start, window_end, key, n, mean, least, most, closed)``: published windows, and open ones as they stand."""
    ids = _batches(spark, f"{out_path}/state")
    parts = _read(spark, out_path, "closed", ids).withColumn("closed", F.lit(True)).unionByName(
        _read(spark, out_path, "state", ids[-1:]).withColumn("closed", F.lit(False)))
    return parts.select("window_start", "window_end", "key", "n", F.try_divide("total", F.col("n")).alias("mean"), "least", "most", "closed")


def late_rows(spark: SparkSession, out_path: str) -> DataFrame:
    """``(window_start, window_end, key, n, total)`` of rows that came after their window was closed."""
    return _summed(_read(spark, out_path, "late", _batches(spark, f"{out_path}/state"))).drop("least", "most")


__all__ = ["start_window_kpis", "window_kpis", "late_rows", "window_sums"]
