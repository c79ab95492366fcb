"""Composite jobs: KPI table, feature table, the whole zone job."""

from zonekit.plans.features import feature_means, feature_table, one_doc_per_key, predict_prices
from zonekit.plans.kpi import kpi_table
from zonekit.plans.zones import ZoneConfig, ZoneInputs, read_landing, run_zones

__all__ = ["kpi_table", "feature_means", "feature_table", "one_doc_per_key", "predict_prices", "ZoneConfig", "ZoneInputs",
           "read_landing", "run_zones"]
