"""Connected components of a link table, by alternating large-star and
small-star steps. Every step is a grouped minimum and a join on the node, so a
node with very many links is pre-aggregated and its join partition split by
adaptive execution; nothing is gathered per component or on the driver but two
numbers per round, which tell when nothing changes any more."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonekit.llm.common import stored


def _star(links: DataFrame, small: bool) -> DataFrame:
    """Connect each node's larger (small: not larger) neighbours to the least of all."""
    both = links.union(links.select(F.col("b"), F.col("a"))).toDF("node", "near")
    if small:
        both = links.select(F.greatest("a", "b").alias("node"), F.least("a", "b").alias("near"))
    least = both.groupBy("node").agg(F.least(F.min("near"), F.col("node")).alias("least"))
    moved = both.join(least, "node")
    if not small:
        moved = moved.where("near > node")
    out = moved.select(F.col("near").alias("a"), F.col("least").alias("b"))
    if small:
        out = out.union(least.select(F.col("node").alias("a"), F.col("least").alias("b")))
    return out.where("a <> b").distinct()


def components(links: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``links(a, b)``: root is the least node it
    is connected with. Self links, repeated and mirrored links are fine; an empty table gives an empty result."""
    links = stored(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), "links")
    before = None
    while True:
        now = links.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("x")).first()
        if now == before or not now.n:
            break
        before = now
        links = stored(_star(_star(links, small=False), small=True), "links")
    roots = links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return links.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots)


__all__ = ["components"]
