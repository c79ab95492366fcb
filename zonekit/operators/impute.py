"""Explicit null imputation with a flag column per imputed column."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonekit.session import cut_lineage

STRATEGIES = ("none", "constant", "mean", "median", "random")


def random_fill(key: Sequence[str], column: str, seed: int, scale: float) -> Column:
    """Uniform number in [0, scale) from seed, column name and row key."""
    text = F.concat_ws("|", F.lit(str(seed)), F.lit(column), *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in key])
    digits = F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("double")
    return digits / F.lit(float(1 << 32)) * F.lit(float(scale))


def impute(df: DataFrame, cols: Sequence[str], strategy: str = "none", value: float | None = None,
           seed: int | None = None, scale: float = 1000.0, flag_suffix: str = "_imputed",
           median_accuracy: int = 10000, materialize: bool = False,
           key: Sequence[str] = ()) -> DataFrame:
    """Fill nulls of ``cols`` and add ``<col><flag_suffix>`` (true where the
    value was null).

    * ``none``      - leave nulls, only add the flags
    * ``constant``  - ``value``
    * ``mean``      - column mean, from one scalar subquery shared by all columns
    * ``median``    - approximate median (``percentile_approx``), likewise
    * ``random``    - uniform in [0, scale), the reference's placeholder. With
      ``key`` columns it is a function of seed, column and row key (the
      first 8 hex digits of an md5), the same under any partitioning; without
      them it is ``rand(seed)``, which repeats only for equal partitions

    ``materialize`` checkpoints ``df`` (shared checkpoint folder) before a
    mean/median fill, for inputs that are expensive to recompute.
    """
    if strategy not in STRATEGIES:
        raise ValueError(f"unknown strategy {strategy!r}; use one of {STRATEGIES}")
    if materialize and strategy in ("mean", "median"):
        # the statistics and the rows read one written copy instead of
        # computing the input plan twice
        df = cut_lineage(df)
    out = df
    for c in cols:
        out = out.withColumn(f"{c}{flag_suffix}", F.col(c).isNull())
    if strategy == "none":
        return out
    stats = None
    if strategy in ("mean", "median"):
        # one scalar subquery for all columns (a struct), referenced per column
        agg = ([F.avg(c).alias(c) for c in cols] if strategy == "mean" else
               [F.percentile_approx(c, 0.5, median_accuracy).alias(c) for c in cols])
        stats = df.select(F.struct(*agg).alias("s")).scalar()
    fills = {}
    for c in cols:
        if strategy == "constant":
            if value is None:
                raise ValueError("constant strategy needs value")
            fill = F.lit(value)
        elif stats is not None:
            fill = stats.getField(c)
        else:
            fill = random_fill(key, c, seed or 0, scale) if key else F.rand(seed) * F.lit(scale)
        fills[c] = F.coalesce(F.col(c), fill.cast(df.schema[c].dataType))
    return out.withColumns(fills)
