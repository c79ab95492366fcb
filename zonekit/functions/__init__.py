"""Column-level building blocks (all JVM-side built-in expressions)."""

from zonekit.functions.arrays import array_mean, field_values
from zonekit.functions.casting import conform_column
from zonekit.functions.text import basic_norm, canon, canon_sql, basic_norm_sql

__all__ = ["array_mean", "field_values", "conform_column", "basic_norm",
           "canon", "canon_sql", "basic_norm_sql"]
