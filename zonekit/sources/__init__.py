"""Readers for zone tables (parquet/JSON lines/any connector format)."""

from zonekit.sources.readers import read_collection, read_json_lines, read_table

__all__ = ["read_table", "read_json_lines", "read_collection"]
