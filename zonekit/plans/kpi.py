"""Per-neighbourhood KPI table (rent, location, price by area, income,
density): three sides aggregated per key, then joined."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonekit.operators.impute import impute
from zonekit.operators.nested import explode_rows

# Names of the KPI columns and of the source fields they
# average, as in the reference.
RENT_KPIS = {"avg_rent": "price", "avg_latitude": "latitude",
             "avg_longitude": "longitude", "avg_price_by_area": "priceByArea"}
INCOME_FIELD = "RFD"
DENSITY_FIELD = "density(inh/ha)"


def info_average(docs: DataFrame, key: str, field: str, out: str,
                 info_col: str = "info") -> DataFrame:
    """Explode the per-year ``info`` array and average one field per key
    (null/empty arrays contribute no row; null values are skipped)."""
    ex = explode_rows(docs.select(key, info_col), info_col, keep=[key], expand=False)
    return (ex.select(key, F.col(info_col).getField(field).alias("_v"))
            .groupBy(key).agg(F.avg("_v").alias(out)))


def kpi_table(rent: DataFrame, income: DataFrame, density: DataFrame,
              key: str = "neighborhood_name", impute_strategy: str = "none",
              impute_value: float | None = None, seed: int | None = None) -> DataFrame:
    """``key, avg_rent, avg_latitude, avg_longitude, avg_price_by_area,
    avg_income, avg_density`` (+ ``*_imputed`` flags).

    Each side is aggregated before the joins (partial aggregation on the
    map side, so a hot key is combined before the shuffle); the two joins
    are left joins of one-row-per-key tables, so the rent side keeps every
    neighbourhood. Rows with a null key are dropped.
    """
    rent_avg = (rent.where(F.col(key).isNotNull())
                .groupBy(key).agg(*[F.avg(src).alias(k) for k, src in RENT_KPIS.items()]))
    income_avg = info_average(income.where(F.col(key).isNotNull()), key, INCOME_FIELD, "avg_income")
    density_avg = info_average(density.where(F.col(key).isNotNull()), key, DENSITY_FIELD, "avg_density")
    out = rent_avg.join(income_avg, key, "left").join(density_avg, key, "left")
    # the KPI table has one row per key: write it once before computing a
    # global fill statistic over it
    return impute(out, ["avg_income", "avg_density"], impute_strategy,
                  value=impute_value, seed=seed, materialize=True, key=[key])
