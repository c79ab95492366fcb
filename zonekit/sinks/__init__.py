"""Writers for zone tables."""

from zonekit.sinks.writers import upsert_table, write_bucketed_table, write_collection, write_jdbc, write_table

__all__ = ["write_table", "upsert_table", "write_jdbc", "write_bucketed_table", "write_collection"]
