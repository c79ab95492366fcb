"""Keyed, deterministic de-duplication, priority merge and upsert.

All three are one hash/sort aggregation keyed on the business key: the
survivor of each key is the minimum of a struct whose leading fields are the
ordering columns and whose remaining fields are the whole row. That makes
the survivor a pure function of the data (a total order: ties can only be
identical rows) and, because ``min`` is an algebraic aggregate, Spark runs a
partial aggregation on the map side before the shuffle. A key that holds a
third of all rows therefore sends at most one row per map task across the
network - no window sort of a hot key inside one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zonekit.operators.rename import merge_synonyms

_SRC_RANK = "_src_rank"


def _as_list(x) -> list[str]:
    if x is None:
        return []
    return [x] if isinstance(x, str) else list(x)


def _orderable(t: T.DataType) -> bool:
    if isinstance(t, T.MapType):
        return False
    if isinstance(t, T.ArrayType):
        return _orderable(t.elementType)
    if isinstance(t, T.StructType):
        return all(_orderable(f.dataType) for f in t.fields)
    return True


def dedup(df: DataFrame, keys: str | Sequence[str], order_by: str | Sequence[str] | None = None,
          descending: bool = False, sort_result: bool = False) -> DataFrame:
    """Keep one row per ``keys``: the first by ``order_by`` (then by all
    remaining columns), or the last when ``descending``.

    Output columns and their order are those of ``df``. ``sort_result``
    adds a global sort on the keys (a range shuffle) - only ask for it when
    a consumer needs ordered output.
    """
    keys = _as_list(keys)
    order = _as_list(order_by)
    missing = [c for c in keys + order if c not in df.columns]
    if missing:
        raise ValueError(f"dedup: unknown columns {missing}")
    payload = [c for c in df.columns if c not in keys]
    rest = [c for c in payload if c not in order]
    ordered = [F.col(c).alias(f"_ord{i}") for i, c in enumerate(order)]
    packed = F.struct(*ordered, *[F.col(c) for c in rest])
    pick = F.max if descending else F.min
    types = {f.name: f.dataType for f in df.schema.fields}
    if not payload:
        out = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).select(*keys)
    else:
        win = "_win"
        if all(_orderable(types[c]) for c in payload):
            chosen = pick(packed)
        else:
            # map columns cannot be compared: order by the orderable columns
            # only and carry the whole row as the value
            by = F.struct(*ordered, *[F.col(c) for c in rest if _orderable(types[c])])
            chosen = (F.max_by if descending else F.min_by)(packed, by)
        agg = df.groupBy(*keys).agg(chosen.alias(win))
        cols = []
        for c in df.columns:
            if c in keys:
                cols.append(F.col(c))
            elif c in order:
                cols.append(F.col(win).getField(f"_ord{order.index(c)}").alias(c))
            else:
                cols.append(F.col(win).getField(c).alias(c))
        out = agg.select(*cols)
    if sort_result:
        out = out.orderBy(*keys)
    return out


def union_sources(sources: Sequence[DataFrame], rename_map: dict[str, str] | None = None,
                  rank_col: str | None = _SRC_RANK) -> DataFrame:
    """Rename each source with ``rename_map`` (absent names ignored; when a
    source has both names, the values are coalesced), tag it with its
    position and union **by name** (missing columns become null)."""
    renamed = [merge_synonyms(s, rename_map) if rename_map else s for s in sources]
    # a column that is text in one source and not in another becomes text
    # everywhere (ids exported as numbers by one system, as strings by
    # another); implicit casting to the numeric side would fail on the
    # first non-numeric value
    types: dict[str, set] = {}
    for s in renamed:
        for f in s.schema.fields:
            types.setdefault(f.name, set()).add(f.dataType)
    to_text = {c for c, ts in types.items() if len(ts) > 1 and T.StringType() in ts}
    out = None
    for i, s in enumerate(renamed):
        if to_text & set(s.columns):
            s = s.withColumns({c: F.col(f"`{c}`").cast("string") for c in to_text if c in s.columns})
        if rank_col:
            s = s.withColumn(rank_col, F.lit(i))
        out = s if out is None else out.unionByName(s, allowMissingColumns=True)
    if out is None:
        raise ValueError("union_sources needs at least one source")
    return out


def merge_by_priority(sources: Sequence[DataFrame], keys: str | Sequence[str],
                      rename_map: dict[str, str] | None = None,
                      order_by: str | Sequence[str] | None = None,
                      keep_rank: bool = False) -> DataFrame:
    """Union several sources of one entity and keep, per key, the row of the
    earliest source in ``sources`` (ties broken by ``order_by``, then by the
    whole row)."""
    u = union_sources(sources, rename_map)
    out = dedup(u, keys, [_SRC_RANK, *_as_list(order_by)])
    return out if keep_rank else out.drop(_SRC_RANK)


def upsert(existing: DataFrame, incoming: DataFrame, keys: str | Sequence[str],
           order_by: str | Sequence[str] | None = None) -> DataFrame:
    """Replace-by-key: rows of ``incoming`` (one per key: the first by
    ``order_by``, then by the whole row) win over rows of ``existing`` with the
    same key; other rows of ``existing`` are kept as they are. Columns are matched
    by name. The stored side is only anti-joined with the incoming keys: when those
    are few, adaptive execution broadcasts them and it is not shuffled. The result
    is a new DataFrame - write it to a fresh path, never over its own input."""
    keys = _as_list(keys)
    fresh = dedup(incoming, keys, order_by)
    replaced = fresh.select(*[F.col(k).alias(f"_new_{k}") for k in keys])
    same = F.lit(True)
    for k in keys:  # null keys are keys too
        same = same & F.col(k).eqNullSafe(F.col(f"_new_{k}"))
    return fresh.unionByName(existing.join(replaced, same, "left_anti"), allowMissingColumns=True)
