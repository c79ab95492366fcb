"""Shared helpers: reading the given tables, scratch tables in the shared
checkpoint folder, and files that executors write there."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from zonekit.session import scratch_path

#: bytes of an Arrow batch between Spark and a Python worker
BATCH_BYTES = 1 << 20
_BATCH_CONF = "spark.sql.execution.arrow.maxBytesPerBatch"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The given table, through Spark's own reader (any store Spark can read)."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder name below ``spark.checkpoint.dir``; shared by all
    executors and never reused, so reruns and retries cannot mix."""
    return scratch_path(spark, "llm", f"{name}-{uuid.uuid4().hex[:12]}")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back: cuts the
    lineage, survives lost executors, and computes an expensive step once."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small_batches(spark: SparkSession) -> None:
    """From now on rows move between Spark and its Python workers in Arrow batches of about ``BATCH_BYTES``, where the
    session names no size: both sides keep the memory of their largest batch (64 MB by default) through later stages."""
    if _BATCH_CONF not in spark.conf.getAll:
        spark.conf.set(_BATCH_CONF, str(BATCH_BYTES))


def carried(docs: DataFrame, new: str, carry: list[str] | None = None) -> tuple[list[str], StructType]:
    """Columns a mapping step passes on (all by default, but for those that it
    makes itself), and the schema of its result; ``new`` is a DDL string."""
    new = StructType.fromDDL(new)
    names = [c for c in (docs.columns if carry is None else carry) if c not in new.names]
    return names, StructType([*(docs.schema[c] for c in names), *new.fields])


def filesystem(uri: str):
    """(pyarrow file system, path) of a shared folder: local paths, file:, and
    whatever pyarrow knows (hdfs:, s3:, gs:). Imported in tasks."""
    from pyarrow import fs

    if m := re.match(r"(?:file:)?/+(.*)", uri):
        return fs.LocalFileSystem(), "/" + m[1]
    return fs.FileSystem.from_uri(uri)


__all__ = ["table", "scratch", "stored", "small_batches", "carried", "filesystem"]
