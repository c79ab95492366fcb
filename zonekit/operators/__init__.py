"""Relational building blocks of the zone jobs."""

from zonekit.operators.conform import bad_values, conform
from zonekit.operators.dedup import dedup, merge_by_priority, union_sources, upsert
from zonekit.operators.impute import impute
from zonekit.operators.nested import explode_rows, flatten_if_nested, has_array_of_structs
from zonekit.operators.reconcile import alias_table, reconcile
from zonekit.operators.rename import merge_synonyms, rename_columns, rename_nested, trim_column_names

__all__ = ["conform", "bad_values", "dedup", "merge_by_priority", "union_sources", "upsert",
           "impute", "explode_rows", "flatten_if_nested", "has_array_of_structs", "alias_table", "reconcile",
           "rename_columns", "rename_nested", "trim_column_names", "merge_synonyms"]
