"""Structured Streaming form of the KPI job."""

from zonekit.streaming.kpi_stream import (compact_rent_kpis, current_rent_kpis, rent_kpi_state,
                                          start_rent_kpi_stream)

__all__ = ["rent_kpi_state", "start_rent_kpi_stream", "current_rent_kpis", "compact_rent_kpis"]
