"""Column renames: by mapping, for names with stray whitespace, and for
fields nested inside structs or arrays of structs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def rename_columns(df: DataFrame, mapping: dict[str, str]) -> tuple[DataFrame, list[str]]:
    """Apply ``{old: new}`` for every old name present; also accept a
    mapping key that differs from the column name only by surrounding
    whitespace. Returns the frame and the list of names not found."""
    actual, nested, missing = {}, {}, []
    for old, new in mapping.items():
        if old in df.columns:
            actual[old] = new
            continue
        alt = [c for c in df.columns if c.strip() == old.strip()]
        if alt:
            actual[alt[0]] = new
        elif "." in old and _nested_exists(df.schema, old.split(".")):
            nested[old] = new
        else:
            missing.append(old)
    clash = [new for old, new in actual.items() if new in df.columns and new not in actual]
    if clash:
        raise ValueError(f"rename_columns: target column(s) already exist: {clash}")
    # one projection: all renames apply at once (a swap of two names works)
    out = (df.select(*[F.col(f"`{c}`").alias(actual.get(c, c)) for c in df.columns])
           if actual else df)
    for path, new in nested.items():
        top, *rest = path.split(".")
        out = rename_nested(out, actual.get(top, top), {".".join(rest): new})
    return out, missing


def merge_synonyms(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """``{short: long}`` for frames that may carry either name or both (a
    source read with a superset schema): ``long = coalesce(long, short)``,
    then ``short`` is dropped; a lone ``short`` is renamed."""
    out = df
    for short, long_ in mapping.items():
        if short not in out.columns:
            continue
        if long_ in out.columns:
            out = out.withColumn(long_, F.coalesce(F.col(f"`{long_}`"), F.col(f"`{short}`"))).drop(short)
        else:
            out = out.withColumnRenamed(short, long_)
    return out


def trim_column_names(df: DataFrame) -> DataFrame:
    """Strip leading/trailing whitespace from top-level column names."""
    m = {c: c.strip() for c in df.columns if c != c.strip()}
    return df.withColumnsRenamed(m) if m else df


def _nested_exists(schema: T.DataType, parts: list[str]) -> bool:
    t = schema
    for p in parts:
        while isinstance(t, T.ArrayType):
            t = t.elementType
        if not isinstance(t, T.StructType) or p not in t.fieldNames():
            return False
        t = t[p].dataType
    return True


def _rename_in(col: Column, dtype: T.DataType, path: list[str], new: str) -> Column:
    if isinstance(dtype, T.ArrayType):
        return F.transform(col, lambda x: _rename_in(x, dtype.elementType, path, new))
    if not isinstance(dtype, T.StructType):
        return col
    head, rest = path[0], path[1:]
    parts = []
    for f in dtype.fields:
        child = col.getField(f.name)
        if f.name == head:
            if rest:
                parts.append(_rename_in(child, f.dataType, rest, new).alias(f.name))
            else:
                parts.append(child.alias(new))
        else:
            parts.append(child.alias(f.name))
    return F.when(col.isNull(), F.lit(None)).otherwise(F.struct(*parts))


def rename_nested(df: DataFrame, column: str, mapping: dict[str, str]) -> DataFrame:
    """Rename fields inside ``column`` (a struct, or an array of structs);
    keys of ``mapping`` are dotted paths relative to ``column``."""
    dtype = df.schema[column].dataType
    col = F.col(f"`{column}`")
    for path, new in mapping.items():
        parts = path.split(".")
        if not _nested_exists(dtype, parts):
            raise ValueError(f"rename_nested: {column}.{path} not found")
        col = _rename_in(col, dtype, parts, new)
        dtype = _renamed_type(dtype, parts, new)
    return df.withColumn(column, col)


def _renamed_type(dtype: T.DataType, path: list[str], new: str) -> T.DataType:
    if isinstance(dtype, T.ArrayType):
        return T.ArrayType(_renamed_type(dtype.elementType, path, new), dtype.containsNull)
    fields = []
    for f in dtype.fields:
        if f.name == path[0]:
            if len(path) > 1:
                fields.append(T.StructField(f.name, _renamed_type(f.dataType, path[1:], new), f.nullable))
            else:
                fields.append(T.StructField(new, f.dataType, f.nullable))
        else:
            fields.append(f)
    return T.StructType(fields)
