"""Mixing sources to target weights (op4), native.

Sources weigh 5, 2, 1, repeating, in order of name (null last) and share as
many words as there are; a target stops at ``max_epochs`` times its source's
words, the excess goes to the others by weight until none is above.

Schedule: every source needs as many slots as blocks of ``block_words`` fill
its target. The slots' van der Corput points (bits of the slot's time
reversed) mapped through the sources' cumulative slot numbers give each source exactly
its slots, evenly spread over the whole mix. A source's slots are ranked by
time, and the r-th takes its r-th block: its documents in hashed order, end to
end and round and round, cut every ``block_words`` words. The last block ends
at the target, so what a source gives is its target in whole words.

Scale: documents are read once into a slim table (no text). Running sums over a
source and ranks of its slots are taken in two steps (per hash bucket or
stretch of time, then over those), so a source with most of the rows is spread
over many tasks; joins are on (source, block).

Edge cases: a null text has no words; documents without words are never
taken; a null source is a source of its own; rows with equal or null ids are
separate documents; an empty table gives an empty mix.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from zonekit.llm.common import stored

WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3
BLOCK_WORDS = 1024
WORD = r"[^\x20\x09-\x0D]+"
_STRETCH = 1 << 16


def word_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def hashed_order(key: Column, seed: int = 7) -> Column:
    """A shuffled order of the keys: 60 bits of a digest (any engine can compute it)."""
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), F.coalesce(key.cast("string"), F.lit(""))).cast("binary"))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")


def sizes(docs: DataFrame, key: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: int = 7) -> DataFrame:
    """Slim stored table ``(row, key, source, size, order)``; ``row`` tells equal rows apart."""
    slim = docs.select(F.col(key).alias("key"), F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size"))
    slim = slim.withColumn("order", hashed_order(F.col("key"), seed)).withColumn("row", F.monotonically_increasing_id())
    return stored(slim, "mix-sizes")


def targets(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """One row per source: ``(source, idx, source_size, target)``."""
    by_source = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    named = Window.orderBy(F.col("source").asc_nulls_last())
    # these windows are over one row per source
    table = by_source.withColumn("idx", F.row_number().over(named) - 1)
    weight = F.array(*map(F.lit, weights))[F.col("idx") % len(weights)]
    exact = "decimal(38,0)"
    table = table.withColumn("weight", weight.cast("long")).withColumn("most", F.col("source_size") * max_epochs)
    full_first = Window.orderBy(F.col("most") / F.col("weight"), "idx").rowsBetween(Window.unboundedPreceding, -1)
    table = (table.withColumn("left", F.sum("source_size").over(everything) - F.coalesce(F.sum("most").over(full_first), F.lit(0)))
             .withColumn("weights", F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(full_first), F.lit(0))))
    # the first source, by fill ratio, that its share of what the fuller ones leave does not overfill; it and all after it get their share
    free = F.col("left").cast(exact) * F.col("weight") <= F.col("most").cast(exact) * F.col("weights")
    table = table.withColumn("share", F.min(F.when(free, F.struct((F.col("most") / F.col("weight")).alias("ratio"), "idx", "left", "weights"))).over(everything))
    shared = F.struct((F.col("most") / F.col("weight")).alias("ratio"), "idx") >= F.struct(F.col("share.ratio").alias("ratio"), F.col("share.idx").alias("idx"))
    target = F.when(shared, (F.col("weight") * F.col("share.left")).cast("double") / F.col("share.weights").cast("double")).otherwise(F.col("most").cast("double"))
    return table.select("source", "idx", "source_size", target.alias("target"))


def _reversed_bits(value: Column, bits: Column) -> Column:
    return F.when(bits == 0, F.lit(0).cast("long")).otherwise(F.conv(F.reverse(F.lpad(F.bin(value), bits, "0")), 2, 10).cast("long"))


def schedule(sources: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The slots ``(idx, block, time)``: at ``time`` (increasing, with gaps), the mix takes that block."""
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = Window.orderBy("idx").rowsBetween(Window.unboundedPreceding, -1)
    table = (sources.withColumn("slots", F.ceil(F.floor("target") / block_words))
             .withColumn("first", F.coalesce(F.sum("slots").over(before), F.lit(0)))
             .withColumn("bits", F.when(F.sum("slots").over(everything) <= 1, 0).otherwise(F.length(F.bin(F.sum("slots").over(everything) - 1)))))
    # a source's slots are made in stretches, which the shuffle spreads
    starts = table.where("slots > 0").select("idx", "slots", "first", "bits", F.explode(F.sequence(F.lit(0).cast("long"), F.col("slots") - 1, F.lit(_STRETCH).cast("long"))).alias("from"))
    starts = starts.repartition("idx", "from")
    points = starts.select("idx", "bits", F.explode(F.sequence(F.col("first") + F.col("from"), F.col("first") + F.least(F.col("from") + _STRETCH, F.col("slots")) - 1)).alias("point"))
    slots = points.select("idx", _reversed_bits(F.col("point"), F.col("bits")).alias("time"))
    slots = slots.withColumn("stretch", F.floor(F.col("time") / _STRETCH))
    earlier = Window.partitionBy("idx").orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    counts = slots.groupBy("idx", "stretch").agg(F.count(F.lit(1)).alias("n")).withColumn("base", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
    ranked = slots.withColumn("rank", F.row_number().over(Window.partitionBy("idx", "stretch").orderBy("time")) - 1)
    return ranked.join(counts, ["idx", "stretch"]).select("idx", (F.col("base") + F.col("rank")).alias("block"), "time")


def pieces(sized: DataFrame, sources: DataFrame, block_words: int = BLOCK_WORDS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """What lies in each block: ``(idx, block, row, key, epoch, from_word, to_word)``."""
    docs = sized.where("size > 0").withColumn("bucket", F.shiftright("order", 48))
    docs = docs.join(sources, sized["source"].eqNullSafe(sources["source"])).select("row", "key", "size", "order", "bucket", "idx", "source_size", "target")
    earlier = Window.partitionBy("idx").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    bases = docs.groupBy("idx", "bucket").agg(F.sum("size").alias("n")).withColumn("base", F.coalesce(F.sum("n").over(earlier), F.lit(0))).drop("n")
    within = Window.partitionBy("idx", "bucket").orderBy("order", "key", "row").rowsBetween(Window.unboundedPreceding, -1)
    docs = docs.withColumn("start", F.coalesce(F.sum("size").over(within), F.lit(0))).join(bases, ["idx", "bucket"]).withColumn("start", F.col("start") + F.col("base"))
    copies = docs.withColumn("epoch", F.explode(F.sequence(F.lit(0), F.lit(max_epochs - 1))))
    copies = (copies.withColumn("lo", F.col("start") + F.col("epoch") * F.col("source_size"))
              .withColumn("hi", F.least(F.col("lo") + F.col("size"), F.floor("target"))).where("lo < hi"))
    cut = copies.withColumn("block", F.explode(F.sequence(F.floor(F.col("lo") / block_words), F.floor((F.col("hi") - 1) / block_words))))
    return cut.select("idx", "block", "row", "key", "epoch",
                      (F.greatest("lo", F.col("block") * block_words) - F.col("lo")).alias("from_word"),
                      (F.least("hi", (F.col("block") + 1) * block_words) - F.col("lo")).alias("to_word"))


def mixture(sized: DataFrame, sources: DataFrame, block_words: int = BLOCK_WORDS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """The mix: ``(time, row, key, epoch, from_word, to_word)``, to be read by (time, epoch, from_word)."""
    return schedule(sources, block_words).join(pieces(sized, sources, block_words, max_epochs), ["idx", "block"]).drop("idx", "block")


def taken(sized: DataFrame, sources: DataFrame, block_words: int = BLOCK_WORDS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """Per document: ``(row, key, size, source_size, target, taken, first_time)``; ``first_time`` is the time of
    the first slot that takes of it (null: none does)."""
    words = mixture(sized, sources, block_words, max_epochs).groupBy("row").agg(F.sum(F.col("to_word") - F.col("from_word")).alias("taken"), F.min("time").alias("first_time"))
    known = sized.join(sources, sized["source"].eqNullSafe(sources["source"])).select("row", "key", "size", "source_size", "target")
    return known.join(words, "row", "left").withColumn("taken", F.coalesce("taken", F.lit(0).cast("long")))


def mixed_documents(docs: DataFrame, key: str = "doc_id", text_col: str = "text", source_col: str = "source",
                    weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS, block_words: int = BLOCK_WORDS) -> DataFrame:
    """``docs`` as the mix takes them: a row per epoch in which a document is
    taken, its text cut to the words taken where the target ends inside it (its white space
    before each word stays). Documents not taken are left out. Rows are dealt by ranges of, and sorted
    by, the time of the first block that holds them, and in a block in the source's order."""
    columns = docs.columns
    docs = stored(docs.select(F.struct("*").alias("doc"), F.monotonically_increasing_id().alias("row")), "mix-documents")
    doc = F.col("doc")
    slim = stored(docs.select("row", doc[key].alias("key"), doc[source_col].alias("source"), word_count(doc[text_col]).alias("size"))
                  .withColumn("order", hashed_order(F.col("key"))), "mix-sizes")
    sources = stored(targets(slim, weights, max_epochs), "mix-sources")
    mix = mixture(slim, sources, block_words, max_epochs)
    times = mix.groupBy("row", "epoch").agg(F.max("to_word").alias("upto"), F.min("time").alias("time"))
    out = docs.join(times.join(slim.select("row", "size", "order", "key"), "row"), "row")
    place = ["time", "epoch", "order", "key", "row"]
    out = out.repartitionByRange(*place).sortWithinPartitions(*place)
    first = F.array_join(F.slice(F.regexp_extract_all(doc[text_col], F.lit(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+"), 0), F.lit(1), F.col("upto").cast("int")), "")
    text = F.when(F.col("upto") < F.col("size"), first).otherwise(doc[text_col])
    return out.select(*[text.alias(c) if c == text_col else doc[c].alias(c) for c in columns])


__all__ = ["sizes", "targets", "schedule", "pieces", "mixture", "taken", "mixed_documents", "word_count", "WEIGHTS", "MAX_EPOCHS", "BLOCK_WORDS"]
