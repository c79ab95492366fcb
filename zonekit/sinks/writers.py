"""Table writers: overwrite/append, keyed upsert into a fresh path, JDBC."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from zonekit.operators.dedup import upsert


def write_table(df: DataFrame, path: str, mode: str = "errorifexists", fmt: str = "parquet",
                partition_by: Sequence[str] | None = None, **options) -> None:
    """Write a zone table. ``mode='overwrite'`` replaces the target."""
    w = df.write.format(fmt).mode(mode).options(**options)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)


def write_collection(df: DataFrame, fmt: str, options: dict | None = None, path: str | None = None,
                     mode: str = "errorifexists") -> None:
    """Write through a connector that is configured by options (the twin of
    ``sources.read_collection``): a document store, or files when ``path`` is given.
    Replace-by-key and append-or-replace are options of the connector."""
    w = df.write.format(fmt).mode(mode).options(**(options or {}))
    w.save(path) if path else w.save()


def upsert_table(spark: SparkSession, existing_path: str, incoming: DataFrame,
                 keys: str | Sequence[str], out_path: str, fmt: str = "parquet",
                 order_by: str | Sequence[str] | None = None) -> DataFrame:
    """Replace-by-key of ``incoming`` into the table at ``existing_path``,
    written to ``out_path`` (a new path: a job never overwrites what it is
    reading). Returns the re-read result."""
    if out_path.rstrip("/") == existing_path.rstrip("/"):
        raise ValueError("upsert_table writes to a new path, not over its input")
    existing = spark.read.format(fmt).load(existing_path)
    write_table(upsert(existing, incoming.select(*existing.columns), keys, order_by),
                out_path, mode="errorifexists", fmt=fmt)
    return spark.read.format(fmt).load(out_path)


def write_bucketed_table(df: DataFrame, key: str | Sequence[str], path: str, name: str,
                         buckets: int | None = None) -> DataFrame:
    """Write ``df`` as a table bucketed (and sorted) by ``key`` at ``path``
    and return it. Joins on ``key`` against it then shuffle only the other
    side - e.g. the micro-batches of a stream-static join, which would
    otherwise re-shuffle the static side every batch. ``buckets`` defaults
    to the session's shuffle partitions, the smallest count Spark reuses."""
    spark = df.sparkSession
    keys = [key] if isinstance(key, str) else list(key)
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    (df.write.mode("overwrite").bucketBy(n, *keys).sortBy(*keys)
     .option("path", path).saveAsTable(name))
    return spark.table(name)


def write_jdbc(df: DataFrame, url: str, table: str, user: str | None = None,
               password: str | None = None, driver: str | None = None,
               mode: str = "overwrite", num_partitions: int | None = 16,
               batch_size: int = 10000) -> None:
    """Write to a database table over JDBC. Credentials come from the
    caller; each task opens its own connection, so ``num_partitions``
    caps the number of concurrent connections
    (None: as many as the frame has partitions)."""
    props = {"batchsize": str(batch_size)}
    if user is not None:
        props["user"] = user
    if password is not None:
        props["password"] = password
    if driver is not None:
        props["driver"] = driver
    # repartition, not coalesce: a narrow coalesce would also shrink the
    # stage computing ``df`` to ``num_partitions`` tasks
    out = df.repartition(num_partitions) if num_partitions else df
    out.write.jdbc(url=url, table=table, mode=mode, properties=props)
