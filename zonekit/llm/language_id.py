"""Language identification by rank-order profiles (op3).

Texts are lower-cased, everything but letters becomes one space, and byte n-grams
of 1 to 3 bytes that do not reach across a space are counted (a space at
either end marks a word's start or end). A language's profile is its most
frequent n-grams in rank order, counted over all training documents of the language;
a document is compared with each profile by the out-of-place distance: the sum,
over its own most frequent n-grams, of the difference of ranks, or the profile
length for an n-gram that the profile lacks. Ties in frequency go to the
smaller n-gram, ties in distance to the smaller language name.

Scale: training reads the text once and shuffles counts of distinct n-grams
only; the top of each language is taken in two steps, so a language with most of
the rows is no hot group. Profiles (languages x ``PROFILE`` ranks) are small
whatever the input and are sent to the tasks; prediction has no shuffle.

Edge cases: a text that is null or has no letter gets ``und`` with score 0, as
does every text when nothing could be learned; documents with a null language or text
train nothing; the checksum of a null id is that of the empty text.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from zonekit.llm.common import carried
from zonekit.llm.textscan import slices, text_bytes

PROFILE = 400
FOLDS = 5

# letters (a-z, and the bytes of letters beyond ASCII) get codes from 2, a space is 1, 0 pads short n-grams
_CODE = np.ones(256, np.int32)
_CODE[97:123] = np.arange(2, 28)
_CODE[0x80:0xF5] = np.arange(28, 28 + 0xF5 - 0x80)
BASE = int(_CODE.max()) + 1
IDS = BASE ** 3


def _letters(column):
    """Lower-cased text with all but letters replaced by spaces."""
    return pc.replace_substring_regex(pc.utf8_lower(pc.fill_null(column, "")), r"[^\p{L}]+", " ")


def _ngrams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(n-gram ids, index of each one's document) of prepared texts."""
    sizes = np.diff(offsets)
    n = len(sizes)
    # a space before and after each text, none doubled
    stream = np.ones(len(data) + 2 * n, np.int32)
    owner = np.repeat(np.arange(n), sizes + 2)
    place = np.arange(len(data)) + 2 * np.repeat(np.arange(n), sizes) + 1
    stream[place] = _CODE[data]
    keep = np.ones(len(stream), bool)
    keep[1:] = ~((stream[1:] == 1) & (stream[:-1] == 1) & (owner[1:] == owner[:-1]))
    stream, owner = stream[keep], owner[keep]
    one = stream > 1
    two = one[1:] | one[:-1]
    two &= owner[1:] == owner[:-1]
    three = one[1:-1] & (owner[2:] == owner[:-2])
    twos = stream[:-1] * BASE + stream[1:]
    ids = np.concatenate([stream[one], twos[two], (twos[:-1] * BASE + stream[2:])[three]])
    return ids, np.concatenate([owner[one], owner[:-1][two], owner[:-2][three]])


def ngram_text(gram: int) -> bytes:
    """The bytes of an n-gram id (spaces as they are)."""
    digits = [gram // BASE ** 2, gram // BASE % BASE, gram % BASE]
    back = {int(c): b for b, c in enumerate(_CODE) if c > 1} | {1: 32}
    return bytes(back[d] for d in digits if d)


def checksum_fold(key, folds: int = FOLDS):
    """crc32 of the id as text, modulo ``folds`` (a null id counts as empty text)."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit(""))) % folds


def learn(training: DataFrame, text_col: str = "text", lang_col: str = "lang", profile: int = PROFILE) -> DataFrame:
    """Profiles ``(lang, gram, rank)``, rank from 0, of all languages in ``training``."""

    def run(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                langs = part.column("lang")
                for lang in pc.unique(langs).to_pylist():
                    own = part.filter(pc.equal(langs, lang)).column("text")
                    counts = np.bincount(_ngrams(*text_bytes(_letters(own)))[0], minlength=IDS)
                    used = np.flatnonzero(counts)
                    yield pa.RecordBatch.from_arrays([pa.array([lang] * len(used), pa.string()), pa.array(used), pa.array(counts[used])], ["lang", "gram", "n"])

    rows = training.select(F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"))
    counts = rows.where("text is not null and lang is not null").mapInArrow(run, "lang string, gram long, n long")
    counts = counts.groupBy("lang", "gram").agg(F.sum("n").alias("n")).withColumn("part", F.col("gram") % 64)
    order = [F.col("n").desc(), "gram"]
    for keys in (["lang", "part"], ["lang"]):
        counts = counts.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)) - 1).where(F.col("rank") < profile)
    return counts.select("lang", "gram", "rank")


def predict(docs: DataFrame, profiles: DataFrame, text_col: str = "text", profile: int = PROFILE,
            carry: list[str] | None = None) -> DataFrame:
    """Add ``lang_pred`` and ``score`` (1: the document's ranks are the profile's,
    0: nothing in common) to every row. Input columns of these names are
    replaced; ``carry`` names the input columns to pass on (default: all)."""
    known = profiles.toPandas()
    langs = sorted(known["lang"].unique())
    grams = np.sort(known["gram"].unique())
    ranks = np.full((len(langs), len(grams) + 1), -1, np.int64)
    ranks[np.searchsorted(langs, known["lang"]) if langs else [], np.searchsorted(grams, known["gram"])] = known["rank"]
    names, schema = carried(docs, "lang_pred string, score double", carry)

    def best(ids: np.ndarray) -> tuple[str, float]:
        if not len(ids) or not langs:
            return "und", 0.0
        used, counts = np.unique(ids, return_counts=True)
        top = np.argsort(-counts, kind="stable")[:profile]  # ties: smaller n-gram first
        used = used[top]
        at = np.searchsorted(grams, used)
        at[grams[np.minimum(at, len(grams) - 1)] != used] = len(grams)
        found = ranks[:, at]
        far = np.where(found < 0, profile, np.abs(found - np.arange(len(used)))).sum(axis=1)
        k = int(np.argmin(far))
        return langs[k], 1.0 - float(far[k]) / (profile * len(used))

    def run(batches):
        for batch in batches:
            for part in slices(batch, text_col):
                ids, owner = _ngrams(*text_bytes(_letters(part.column(text_col))))
                order = np.argsort(owner, kind="stable")
                ids, ends = ids[order], np.searchsorted(owner[order], np.arange(part.num_rows + 1))
                out = [best(ids[a:b]) for a, b in zip(ends[:-1], ends[1:])]
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in names), pa.array([x[0] for x in out], pa.string()), pa.array([x[1] for x in out], pa.float64())],
                    schema.names)

    return docs.select(*{*names, text_col}).mapInArrow(run, schema)


__all__ = ["learn", "predict", "checksum_fold", "ngram_text", "PROFILE", "FOLDS"]
