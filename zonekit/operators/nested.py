"""Nested documents: detect, explode, star-expand."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def has_array_of_structs(df: DataFrame, column: str) -> bool:
    """Schema test (no data read): is ``column`` an array of structs?"""
    if column not in df.columns:
        return False
    t = df.schema[column].dataType
    return isinstance(t, T.ArrayType) and isinstance(t.elementType, T.StructType)


def explode_rows(df: DataFrame, column: str, keep: Sequence[str] = ("_id",),
                 outer: bool = False, expand: bool = True,
                 position: str | None = None) -> DataFrame:
    """One output row per element of ``column``; the kept columns are
    repeated. A null or empty array gives no row unless ``outer``.
    With ``expand`` the struct's fields become top-level columns; a field
    whose name clashes with a kept column is prefixed with ``item_``."""
    keep = [k for k in keep if k in df.columns]
    gen = F.posexplode_outer if (outer and position) else (
        F.posexplode if position else (F.explode_outer if outer else F.explode))
    item = "_item"
    if position:
        ex = df.select(*[F.col(f"`{k}`") for k in keep], gen(F.col(f"`{column}`")).alias(position, item))
        keep = keep + [position]
    else:
        ex = df.select(*[F.col(f"`{k}`") for k in keep], gen(F.col(f"`{column}`")).alias(item))
    if not expand:
        return ex.withColumnRenamed(item, column)
    et = df.schema[column].dataType.elementType
    if not isinstance(et, T.StructType):
        return ex.withColumnRenamed(item, column)
    fields = [F.col(item).getField(f.name).alias(f"item_{f.name}" if f.name in keep else f.name)
              for f in et.fields]
    return ex.select(*[F.col(f"`{k}`") for k in keep], *fields)


def flatten_if_nested(df: DataFrame, column: str = "value", keep: Sequence[str] = ("_id",)) -> DataFrame:
    """Explode ``column`` when it is an array of structs, else return ``df``."""
    return explode_rows(df, column, keep) if has_array_of_structs(df, column) else df
