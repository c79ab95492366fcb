"""Cast a DataFrame to a declared schema in one projection."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zonekit.functions.casting import _find_field, conform_column


def conform(df: DataFrame, schema: T.StructType, keep_extra: bool = False,
            required: Sequence[str] = ()) -> DataFrame:
    """Every declared field that exists in ``df`` (matched by name, also
    through nested structs and arrays) is converted with ``try_cast``;
    declared fields that are absent become typed nulls; undeclared columns
    are dropped unless ``keep_extra``. Unlike a per-column loop, all casts
    apply, and unlike ``Column.cast`` on structs, nothing is matched by
    position. Names in ``required`` (keys) must be there: their absence is
    an error, not a column of nulls."""
    absent = [c for c in required if _find_field(df.schema, c) is None]
    if absent:
        raise ValueError(f"conform: required columns {absent} are not among {df.columns}")
    cols = []
    used = set()
    for tf in schema.fields:
        sf = _find_field(df.schema, tf.name)
        if sf is None:
            cols.append(F.lit(None).cast(tf.dataType).alias(tf.name))
        else:
            used.add(sf.name)
            cols.append(conform_column(F.col(f"`{sf.name}`"), sf.dataType, tf.dataType)
                        .alias(tf.name))
    if keep_extra:
        cols += [F.col(f"`{c}`") for c in df.columns if c not in used]
    return df.select(*cols)


def _rejects_of(column: str):
    return lambda r: r["column"] == column


def conform_reported(df: DataFrame, schema: T.StructType, keep: Sequence[str] = (), name: str | None = None):
    """``(typed, observation)``: ``conform`` in one pass with a report of what did not fit. ``typed`` has
    the declared columns, the input columns named in ``keep`` and ``rejected``, an array of ``(column, value)`` with the original text of every
    top-level value that was there and became null; the observation holds, once a query over ``typed`` has
    run, the number of rows and of rejects per column (``rows`` and the column names)."""
    if twice := [c for c in (*keep, "rejected") if c in schema.fieldNames()]:
        raise ValueError(f"conform_reported: columns {twice} are declared as well")
    cols, rejects = [], []
    for tf in schema.fields:
        sf = _find_field(df.schema, tf.name)
        if sf is None:
            cols.append(F.lit(None).cast(tf.dataType).alias(tf.name))
            continue
        source = F.col(f"`{sf.name}`")
        typed = conform_column(source, sf.dataType, tf.dataType)
        cols.append(typed.alias(tf.name))
        if sf.dataType != tf.dataType:
            text = source.cast("string") if not isinstance(sf.dataType, (T.ArrayType, T.StructType, T.MapType)) else F.to_json(source)
            rejects.append(F.when(source.isNotNull() & typed.isNull(), F.struct(F.lit(tf.name).alias("column"), text.alias("value"))))
    found = F.filter(F.array(*rejects), lambda r: r.isNotNull()) if rejects else F.array().cast("array<struct<column:string,value:string>>")
    out = df.select(*cols, *[F.col(f"`{c}`") for c in keep], found.alias("rejected"))
    observation = Observation(name) if name else Observation()
    counts = [F.count_if(F.exists("rejected", _rejects_of(tf.name))).alias(tf.name) for tf in schema.fields]
    return out.observe(observation, F.count(F.lit(1)).alias("rows"), *counts), observation


def rejected_values(typed: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """``(column, value)`` and the columns named in ``keep``: a row per value that did not fit, from a (written) result of ``conform_reported``."""
    return typed.where(F.size("rejected") > 0).select(*[F.col(f"`{c}`") for c in keep], F.inline("rejected"))


def bad_values(df: DataFrame, schema: T.StructType, column: str) -> DataFrame:
    """Rows whose ``column`` is non-null before and null after conforming:
    values that did not fit the declared type."""
    tf = schema[column]
    sf = _find_field(df.schema, column)
    conv = conform_column(F.col(f"`{sf.name}`"), sf.dataType, tf.dataType)
    return df.where(F.col(f"`{sf.name}`").isNotNull() & conv.isNull())
