"""By-name schema conformance for nested data.

Spark's plain ``cast`` between struct types matches fields by *position*;
this builds one expression per column that matches struct fields by *name*
(recursively through structs, arrays and maps) and uses ``try_cast`` for
leaf values, so a malformed value becomes null instead of failing the job.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _find_field(struct: T.StructType, name: str) -> T.StructField | None:
    for f in struct.fields:
        if f.name == name:
            return f
    key = name.strip().lower()
    for f in struct.fields:
        if f.name.strip().lower() == key:
            return f
    return None


def conform_column(col: Column, source: T.DataType, target: T.DataType) -> Column:
    """Expression turning ``col`` (of type ``source``) into ``target``."""
    if source == target:
        return col
    if isinstance(target, T.StructType):
        if not isinstance(source, T.StructType):
            return F.lit(None).cast(target)
        parts = []
        for tf in target.fields:
            sf = _find_field(source, tf.name)
            if sf is None:
                parts.append(F.lit(None).cast(tf.dataType).alias(tf.name))
            else:
                parts.append(conform_column(col.getField(sf.name), sf.dataType,
                                            tf.dataType).alias(tf.name))
        return F.when(col.isNull(), F.lit(None).cast(target)).otherwise(F.struct(*parts))
    if isinstance(target, T.ArrayType):
        if not isinstance(source, T.ArrayType):
            return F.lit(None).cast(target)
        return F.transform(col, lambda x: conform_column(x, source.elementType,
                                                         target.elementType))
    if isinstance(target, T.MapType):
        if not isinstance(source, T.MapType):
            return F.lit(None).cast(target)
        m = F.transform_keys(col, lambda k, v: conform_column(k, source.keyType, target.keyType))
        return F.transform_values(m, lambda k, v: conform_column(v, source.valueType,
                                                                 target.valueType))
    if isinstance(source, (T.StructType, T.ArrayType, T.MapType)):
        if isinstance(target, T.StringType):
            return F.to_json(col)
        return F.lit(None).cast(target)
    return col.try_cast(target)
