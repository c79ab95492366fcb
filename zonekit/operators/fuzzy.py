"""Fuzzy reconciliation: names that no alias equals, matched by edit distance.

Names and aliases meet in blocks, never all against all, and the blocks lose no pair:
an alias is cut into t + 1 pieces, t being the edits allowed for its length; t edits leave at
least one piece as it is, so a name within t edits holds that piece, shifted by
no more than the edits before and behind it. Aliases give one key per piece (length, place, piece), names one per
substring that may be such a piece; the places are a small table by lengths, so cutting is a join with it. A piece that very many aliases share (a common prefix)
would make a large block: there, what is left of the alias is cut into t + 1 pieces
again, and pairs meet by two pieces, or more where those are common too. Candidates are settled by the built-in ``levenshtein``
with its threshold, and the best alias is kept by a grouped minimum.

Only distinct normalised names take part, so a name on a third of all rows is matched once. Names that
an alias equals are settled by that; the others are cut.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonekit.functions.text import canon
from zonekit.session import cut_lineage

#: most edits, and letters of an alias per edit (shorter aliases must match exactly)
MAX_EDITS = 2
LETTERS_PER_EDIT = 5
#: aliases that share a key before their block is cut by a further piece, and pieces at most
LARGE_BLOCK = 64
MAX_PIECES = 5


def edits_allowed(length: Column, max_edits: int = MAX_EDITS) -> Column:
    return F.least(F.lit(max_edits), F.floor(length / LETTERS_PER_EDIT).cast("int"))


def _cuts(shapes: DataFrame, edits: Column) -> DataFrame:
    """``(length, left, i, start, size, edits)``: where the pieces of the texts of some ``shapes(length, left)`` lie, a text
    of ``left`` letters being cut into edits + 1 pieces; later pieces take what is over."""
    parts = F.col("edits") + 1
    base, over = F.floor(F.col("left") / parts).cast("int"), (F.col("left") % parts).cast("int")
    cut = shapes.select("length", "left", edits.alias("edits")).select("*", F.explode(F.sequence(F.lit(0), F.col("edits"))).alias("i"))
    return cut.select("length", "left", "i", (F.col("i") * base + F.greatest(F.lit(0), F.col("i") - (parts - over))).alias("start"),
                      (base + (F.col("i") >= parts - over).cast("int")).alias("size"), "edits")


def _probes(cuts: DataFrame) -> DataFrame:
    """``(length, left, i, start, size, n)``: where a text of n letters may hold a piece. Of edits + 1 pieces one is as
    it was with i edits before it and the others behind it, so it is shifted by as many letters at most,
    counted from the beginning and from the end."""
    some = cuts.select("*", F.explode(F.sequence(F.greatest(F.lit(0), F.col("left") - F.col("edits")), F.col("left") + F.col("edits"))).alias("n"))
    behind, more = F.col("edits") - F.col("i"), F.col("n") - F.col("left")
    first = F.greatest(F.lit(0), F.col("start") - F.col("i"), F.col("start") + more - behind)
    last = F.least(F.col("n") - F.col("size"), F.col("start") + F.col("i"), F.col("start") + more + behind)
    return some.select("length", "left", "i", "size", "n", first.alias("first"), last.alias("last")).where("first <= last").select(
        "length", "left", "i", F.explode(F.sequence("first", "last")).alias("start"), "size", "n")


def _cut(texts: DataFrame, who: str) -> DataFrame:
    """The texts less the piece at ``start``, with the digest of the pieces taken so far."""
    piece = F.expr("substring(rest, start + 1, size)")
    rest = F.concat(F.expr("substring(rest, 1, start)"), F.expr("substring(rest, start + size + 1)"))
    return texts.select(who, "length", F.xxhash64("key", "i", piece).alias("key"), (F.col("left") - F.col("size")).alias("left"), rest.alias("rest"))


def candidates(names: DataFrame, aliases: DataFrame, max_edits: int = MAX_EDITS, large_block: int = LARGE_BLOCK) -> DataFrame:
    """``(name, alias)``: every pair within the allowed edits, and some that are not; ``names(name)``,
    ``aliases(alias)``, distinct and not null."""
    edits = edits_allowed(F.col("length"), max_edits)
    # keys are digests of the pieces so far: equal ones by chance are candidates that fail later
    start = F.xxhash64("length").alias("key")
    held = aliases.select("alias", F.length("alias").alias("length")).where("length > 0").select("alias", "length", start, F.col("length").alias("left"), F.col("alias").alias("rest"))
    asked = names.where(F.length("name") > 0).select("name", F.col("name").alias("rest"), F.length("name").alias("n"))
    out = None
    for k in range(MAX_PIECES):
        # cut what is left by one more piece; the places follow from the lengths, of which there are few
        cuts = cut_lineage(_cuts(held.select("length", "left").distinct(), edits))
        probes = F.broadcast(_probes(cuts).withColumn("key", start) if k == 0 else _probes(cuts))
        held = cut_lineage(_cut(held.join(F.broadcast(cuts), ["length", "left"]), "alias").distinct())
        asked = _cut(asked.join(probes, ["n"] if k == 0 else ["length", "left", "n"]), "name").join(held.select("key").distinct(), "key", "left_semi")
        # pieces of equal letters may be found in several ways
        asked = cut_lineage((asked.distinct() if k else asked).withColumn("n", F.length("rest")))
        large = held.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > large_block).select("key")
        more = k + 1 < MAX_PIECES and large.head(1)
        small = held.join(large, "key", "left_anti") if more else held
        pairs = small.select("key", "alias").join(asked.select("key", "name"), "key").select("name", "alias")
        out = pairs if out is None else out.union(pairs)
        if not more:
            break
        held, asked = (x.join(large, "key", "left_semi") for x in (held, asked))
    return out.distinct()


def fuzzy_matches(names: DataFrame, aliases: DataFrame, max_edits: int = MAX_EDITS, large_block: int = LARGE_BLOCK) -> DataFrame:
    """``(name, id, alias, distance, ambiguous)`` for every name that is within the allowed edits of
    an alias: the nearest alias (then the least alias). ``ambiguous``: aliases of several ids are as near;
    the id is then null. ``names(name)``, ``aliases(alias, id)``; nulls and empty names match nothing."""
    names = names.select("name").where("name is not null").distinct()
    known = aliases.select("alias", F.col("id").cast("string").alias("id")).where("alias is not null and id is not null").distinct()
    spelt = known.select("alias").where("alias <> ''").distinct()
    equal = names.join(spelt, names["name"] == spelt["alias"]).select("name", "alias", F.lit(0).alias("distance"))
    odd = cut_lineage(names.join(spelt, names["name"] == spelt["alias"], "left_anti"))
    distance = F.levenshtein("name", "alias", max_edits)
    near = candidates(odd, spelt, max_edits, large_block).select("name", "alias", distance.alias("distance"))
    near = near.where((F.col("distance") >= 0) & (F.col("distance") <= edits_allowed(F.length("alias"), max_edits)))
    near = near.union(equal).join(known, "alias")
    # per name: the ids at the least distance, in one pass of partial minima
    per_distance = near.groupBy("name", "distance").agg(F.min("alias").alias("alias"), F.min("id").alias("id"), F.max("id").alias("last"))
    best = per_distance.groupBy("name").agg(F.min(F.struct("distance", "alias", "id", "last")).alias("b"))
    same = F.col("b.id") == F.col("b.last")
    return best.select("name", F.when(same, F.col("b.id")).alias("id"), F.col("b.alias").alias("alias"), F.col("b.distance").alias("distance"), (~same).alias("ambiguous"))


def reconcile_fuzzy(df: DataFrame, name_col: str, aliases: DataFrame, out_id: str, out_distance: str = "edit_distance",
                    max_edits: int = MAX_EDITS, large_block: int = LARGE_BLOCK) -> DataFrame:
    """Add ``out_id`` and ``out_distance`` to every row of ``df``: the id of the alias within the allowed
    edits that is nearest to the normalised name (null: none, or several ids as near). ``aliases`` is an ``alias_table``
    (aliases that it flags ambiguous don't take part). Columns of the output names are replaced."""
    usable = aliases.where(~F.col("ambiguous")) if "ambiguous" in aliases.columns else aliases
    df = df.drop(*[c for c in (out_id, out_distance) if c in df.columns])
    names = df.select(canon(F.col(name_col)).alias("name"))
    found = cut_lineage(fuzzy_matches(names, usable.select("alias", "id"), max_edits, large_block))
    right = found.where(~F.col("ambiguous")).select(F.col("name").alias("_fk"), F.col("id").alias(out_id), F.col("distance").alias(out_distance))
    return df.withColumn("_fk", canon(F.col(name_col))).join(right, "_fk", "left").drop("_fk")


__all__ = ["edits_allowed", "candidates", "fuzzy_matches", "reconcile_fuzzy"]
