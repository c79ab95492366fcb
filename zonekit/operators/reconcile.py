"""Place-name reconciliation against merged lookup tables.

``alias_table`` collects every spelling a set of lookup sources uses for an
entity (raw name, pre-normalised name, display name) and keys it by
``canon``; aliases that point at more than one id are flagged and never
joined, so reconciling can neither fan out nor pick an arbitrary id.
``reconcile`` then attaches id and reconciled name with one left join of
the big table against the alias table; every input row is kept. No
strategy is forced: adaptive execution broadcasts the alias side when its
measured bytes are few and splits hot names when they are not.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonekit.functions.text import basic_norm, canon
from zonekit.session import cut_lineage


def alias_table(lookups: Sequence[tuple[DataFrame, Sequence[str]]], id_col: str = "_id",
                display: DataFrame | None = None, display_col: str | None = None) -> DataFrame:
    """``(alias, id, ambiguous[, reconciled])`` from ``[(lookup_df, [name
    columns]), ...]``. ``display`` supplies
    the reconciled display name in ``display_col`` (of several rows per id,
    the smallest name, so the join cannot fan out)."""
    parts = None
    for df, names in lookups:
        present = [F.col(n) for n in names if n in df.columns]
        if present:  # one scan per lookup, whatever the number of name columns
            p = df.select(F.explode(F.array_distinct(F.array(*[canon(n) for n in present]))).alias("alias"),
                          F.col(id_col).cast("string").alias("id"))
            parts = p if parts is None else parts.unionByName(p)
    if parts is None:
        raise ValueError("alias_table: no name columns found")
    agg = (parts.where(F.col("alias").isNotNull() & (F.col("alias") != ""))
           .groupBy("alias")
           .agg(F.min("id").alias("id"), (F.min("id") != F.max("id")).alias("ambiguous")))
    if display is not None:
        d = (display.groupBy(F.col(id_col).cast("string").alias("id"))
             .agg(F.min(display_col).alias("reconciled")))
        agg = agg.join(d, "id", "left")
    return agg


def reconcile(df: DataFrame, name_col: str, aliases: DataFrame, out_name: str,
              out_id: str | None = None, mode: str = "canon",
              materialize: bool = True) -> DataFrame:
    """Add ``out_name`` (reconciled name) and optionally ``out_id`` to every
    row of ``df``, matching ``name_col`` against ``aliases``.

    ``mode='canon'``: accent/case/punctuation-insensitive match on the alias
    table. ``mode='basic'``: the reference behaviour - ``aliases`` must
    then hold ``(alias, id, reconciled)`` keyed by the lookup's
    pre-normalised name and the match uses ``basic_norm`` on both sides; a
    name that stands for several ids is skipped, as in ``canon`` mode.

    ``materialize`` writes the alias side once to the shared checkpoint
    folder, for aliases that are expensive to recompute.
    """
    key = "_rk"
    if "reconciled" not in aliases.columns:  # no display names: the id stands in
        aliases = aliases.withColumn("reconciled", F.col("id"))
    if mode == "canon":
        left_key = canon(F.col(name_col))
        right = aliases.where(~F.col("ambiguous")) if "ambiguous" in aliases.columns else aliases
        right = right.select(F.col("alias").alias(key), "id", "reconciled")
    elif mode == "basic":
        left_key = basic_norm(F.col(name_col))
        right = (aliases.select(basic_norm(F.col("alias")).alias(key), "id", "reconciled")
                 .groupBy(key).agg(F.min(F.struct("id", "reconciled")).alias("_m"),
                                   F.max("id").alias("_last"))
                 .where(F.col("_m.id") == F.col("_last")).select(key, "_m.id", "_m.reconciled"))
    else:
        raise ValueError("mode must be 'canon' or 'basic'")
    right = right.withColumnsRenamed({"reconciled": out_name, "id": out_id or "_rid"})
    # output columns are (re)computed: an existing column of that name is replaced
    df = df.drop(*[c for c in (out_name, out_id) if c and c in df.columns])
    if materialize:
        right = cut_lineage(right)
    out = df.withColumn(key, left_key).join(right, key, "left").drop(key)
    return out if out_id else out.drop("_rid")
