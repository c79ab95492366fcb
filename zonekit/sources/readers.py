"""Scans with a declared schema (no inference pass over the data)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from zonekit.operators.rename import trim_column_names


def read_table(spark: SparkSession, path: str, schema: T.StructType | str | None = None,
               fmt: str = "parquet", trim_names: bool = True, **options) -> DataFrame:
    """Read a zone table. Filters and projections applied later are pushed
    into the scan by Catalyst (parquet ``PushedFilters``/``ReadSchema``)."""
    r = spark.read.format(fmt).options(**options)
    if schema is not None:
        r = r.schema(schema)
    df = r.load(path)
    return trim_column_names(df) if trim_names else df


def read_json_lines(spark: SparkSession, path: str, schema: T.StructType | str | None = None,
                    trim_names: bool = False) -> DataFrame:
    """JSON-lines lookup files (one document per line). Pass a schema to
    avoid the inference pass and to pin the types."""
    return read_table(spark, path, schema, fmt="json", trim_names=trim_names,
                      mode="PERMISSIVE", encoding="UTF-8")


def read_collection(spark: SparkSession, fmt: str, schema: T.StructType | str | None = None,
                    **options) -> DataFrame:
    """Any connector source (e.g. a document-store connector the caller has
    on the classpath): ``fmt`` and its options are passed through."""
    r = spark.read.format(fmt).options(**options)
    if schema is not None:
        r = r.schema(schema)
    return r.load()
