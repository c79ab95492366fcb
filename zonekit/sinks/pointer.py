"""Atomic pointers to immutable data: writers put data into new folders and
publish it last, by one rename; readers follow the newest pointer, so they
see the state before or after a job, never one in between. Works on any store
whose rename is atomic (local files, HDFS)."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _numbers(spark: SparkSession, root: str) -> list[int]:
    fs, folder = _fs(spark, f"{root}/_pointers")
    if not fs.exists(folder):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(folder)]
    return sorted(int(n) for n in names if n.isdigit())


def publish(spark: SparkSession, root: str, payload: dict, after: int | None = None) -> int:
    """Make ``payload`` the current state of ``root``; returns its number. ``after`` is the number
    the new state was made from (default: the current one): if another job has published
    since, this fails rather than undo that job."""
    number = (current_number(spark, root) if after is None else after) + 1
    fs, target = _fs(spark, f"{root}/_pointers/{number:012d}")
    _, draft = _fs(spark, f"{root}/_pointers/.draft-{uuid.uuid4().hex}")
    out = fs.create(draft, False)
    out.write(bytearray(json.dumps(payload, sort_keys=True).encode()))
    out.close()
    if fs.exists(target) or not fs.rename(draft, target):
        fs.delete(draft, False)
        raise RuntimeError(f"{root}: state {number} was published by another job")
    return number


def current_number(spark: SparkSession, root: str) -> int:
    """Number of the newest state; 0 if nothing is published."""
    return (_numbers(spark, root) or [0])[-1]


def current(spark: SparkSession, root: str, number: int | None = None) -> dict | None:
    """The newest published payload, or that of a number; None if there is none."""
    number = number or current_number(spark, root)
    if not number:
        return None
    text = spark.read.text(f"{root}/_pointers/{number:012d}", wholetext=True).first()[0]
    return json.loads(text)


__all__ = ["publish", "current", "current_number"]
