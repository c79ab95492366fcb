"""Session construction and the shared checkpoint folder.

The settings below are the ones that matter on a large cluster: adaptive
query execution (runtime coalescing of small shuffle partitions, skew-join
splitting of a hot key's partition, runtime broadcast of sides whose
measured size is small). Plans carry no broadcast hints: Spark checks the size.
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "128m",
    # Before a run, only tables whose files are this small are broadcast (so a
    # join with a dimension of a few rows does not shuffle the facts); at run
    # time AQE broadcasts a side whose measured size is small.
    "spark.sql.autoBroadcastJoinThreshold": "10m",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
    "spark.sql.session.timeZone": "UTC",
    # the tree learner shuffles RDDs of JVM objects: Kryo is the compact,
    # faster serializer for those (DataFrame operators are unaffected)
    "spark.serializer": "org.apache.spark.serializer.KryoSerializer",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    # remove reliable-checkpoint files once their DataFrame is unreachable
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}

# For the time of a write: rows that lie sorted by a grouping's keys are grouped as they
# come, without another sort, and the shuffle files of a write go when it is done.
WRITE_CONF = {
    "spark.sql.execution.replaceHashWithSortAgg": "true",
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
}


@contextmanager
def settings(spark: SparkSession, conf: dict[str, str]) -> Iterator[None]:
    """Session settings that hold inside the block; those from before hold after it."""
    before = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def build_session(master: str | None = None, app_name: str = "zonekit",
                  shuffle_partitions: int | None = None,
                  extra_conf: dict[str, str] | None = None) -> SparkSession:
    """Create (or reuse) a session with the scale settings applied."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(SCALE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    if not spark.sparkContext.master.startswith("local"):
        # on a shared cluster, coalesce shuffle output to the advisory size
        # (128 MB) instead of maximising the number of small tasks
        spark.conf.set("spark.sql.adaptive.coalescePartitions.parallelismFirst", "false")
    ensure_checkpoint_dir(spark)
    return spark


def checkpoint_root(spark: SparkSession) -> str | None:
    """The shared folder the cluster names in ``spark.checkpoint.dir``."""
    d = spark.sparkContext.getCheckpointDir()
    if d:
        return d
    return spark.sparkContext.getConf().get("spark.checkpoint.dir", None)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint folder the cluster names in
    ``spark.checkpoint.dir``. Only in local mode, when none is configured
    (tests), fall back to a fresh local temporary folder; on a cluster a
    machine-local folder would not survive the loss of an executor, so an
    unset setting is an error there."""
    d = checkpoint_root(spark)
    if d:
        return d
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir is not set: name a shared folder for checkpoints")
    d = tempfile.mkdtemp(prefix="zonekit-ckpt-")
    spark.sparkContext.setCheckpointDir(d)
    return spark.sparkContext.getCheckpointDir() or d


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A path below the shared checkpoint folder (for written tables that
    cut lineage or hold streaming state)."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    return "/".join([root, "zonekit", *parts])


def cut_lineage(df, eager: bool = True):
    """Reliable checkpoint into the shared checkpoint folder (survives the
    loss of the executors that computed it)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=eager)


__all__ = ["build_session", "checkpoint_root", "ensure_checkpoint_dir",
           "scratch_path", "cut_lineage", "settings", "SCALE_CONF", "WRITE_CONF"]
