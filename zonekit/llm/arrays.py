"""Array expressions used by the native operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_BLOCK = 512


def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once per row."""
    return F.transform(F.array(value), body)[0]


def total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0).cast("long"), lambda a, x: a + x.cast("long"))


def sums_before(values: Column) -> Column:
    """For each element, the sum of those before it. Sums of blocks first, so a
    long array costs a block's length per element, not its own length."""
    n = F.size(values)

    def up_to(sums: Column) -> Column:
        return F.transform(values, lambda x, i: total(F.slice(sums, F.lit(1), F.floor(i / _BLOCK).cast("int")))
                           + total(F.slice(values, F.floor(i / _BLOCK).cast("int") * _BLOCK + 1, i % _BLOCK)))

    blocks = F.transform(F.sequence(F.lit(0), F.floor((n - 1) / _BLOCK).cast("int")),
                         lambda b: total(F.slice(values, b * _BLOCK + 1, F.lit(_BLOCK))))
    return F.when(n > 0, let(blocks, up_to)).otherwise(F.array().cast("array<bigint>"))


__all__ = ["let", "total", "sums_before"]
