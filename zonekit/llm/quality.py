"""Quality rules (op8): counted base rules, then importance of hashed n-grams.

Base rules count, per document, words, code points in words, symbol
characters, repeated lines and words in repeated 3-word windows. The verdict
on documents that pass them is a log-likelihood ratio: word uni- and bigrams
are hashed into a fixed number of buckets, counted over a trusted target
(documents labelled good) and over the whole raw corpus. A bucket's weight is
log((seen + s) / (expected + s)): how often the target has it, against how often
it would at the raw corpus's rate, so a bucket the target is too small to
speak of weighs nothing. A document's score is the mean over its n-grams.

The threshold is ``THRESHOLD``, or lower where clean documents outside the target
score lower: the target is dealt into folds by text (copies stay together), each fold is
scored by weights counted without it, and the threshold is not above the median
of these scores less ``SPREAD`` times its distance to their tenth
percentile. One threshold holds for all rows, so equal texts always get equal verdicts.

Scale: three passes over the text (the second hashes target documents only) and
one shuffle of at most ``FOLDS`` + 1 times ``buckets`` rows per task; held-out scores are
counted in steps of 1 / ``STEPS``. Only the bucket tables (their size is the parameter) and the target ids
(at most ``max_target``, chosen by hash among the labelled good documents; a
parameter, only for the fitted side) go to the tasks; the raw counts
cover every document.

Edge cases: a null or empty text has zero counts and fails the base rules;
repeated document ids are scored row by row; empty tables give an empty result;
without target documents every weight is 0 and only the base rules decide; null labels or ids in ``labels`` are no target.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonekit.llm.common import carried
from zonekit.llm.textscan import Words, lines, mix, slices, text_bytes

BUCKETS = 1 << 13
MAX_TARGET = 20_000
THRESHOLD = -0.05
#: occurrences of a bucket that the target is taken to hold at the raw rate besides its own
SMOOTHING = 10
#: parts of the target that are scored without being counted
FOLDS = 10
SPREAD = 2.5
STEPS = 1000
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
#: text bytes that are measured at a time: the arrays of words and hashes are many times as large
PART = 1 << 18

_IS_SYMBOL = np.zeros(256, bool)
_IS_SYMBOL[list(b"#*$%&|<>")] = True


def _sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums of consecutive stretches (an empty stretch sums to 0)."""
    total = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    return total[bounds[1:]] - total[bounds[:-1]]


def _twice(keys: np.ndarray) -> np.ndarray:
    """Which keys occur more than once."""
    order = np.argsort(keys, kind="stable")
    same = keys[order][1:] == keys[order][:-1]
    out = np.zeros(len(keys), bool)
    out[order[1:][same]] = True
    out[order[:-1][same]] = True
    return out


def _own(hashes: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """Hashes made distinct by document."""
    return mix(hashes + owner.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def measure(data: np.ndarray, offsets: np.ndarray, words: Words) -> dict[str, np.ndarray]:
    """The base counts of a batch of texts."""
    n_docs = len(offsets) - 1
    bounds = words.bounds
    n_words = np.diff(bounds)
    lead = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80, dtype=np.int64)])
    word_chars = _sums(lead[words.end] - lead[words.start], bounds)
    n_symbols = _sums(_IS_SYMBOL[data], offsets)

    starts, ends, line_hash = lines(data, offsets)
    seen = np.searchsorted(words.start, [starts, ends])
    has_word = seen[0] < seen[1]
    line_doc = np.searchsorted(offsets, starts, "right") - 1
    keys = _own(line_hash, line_doc)[has_word]
    order = np.argsort(keys, kind="stable")
    later = order[1:][keys[order][1:] == keys[order][:-1]]
    n_dup_lines = np.bincount(line_doc[has_word][later], minlength=n_docs)

    owner = np.repeat(np.arange(n_docs), n_words)
    threes = words.shingles(3)
    whole = owner[:len(threes)] == owner[2:] if len(threes) else np.zeros(0, bool)
    places = np.flatnonzero(whole)
    twice = places[_twice(_own(threes, owner[:len(threes)])[places])]
    covered = np.zeros(len(owner), bool)
    for j in range(3):
        covered[twice + j] = True
    return {"n_words": n_words, "word_chars": word_chars, "n_symbols": n_symbols,
            "n_dup_lines": n_dup_lines, "n_repeat_words": _sums(covered, bounds)}


def _grams(words: Words, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bucket of each unigram, bucket of each bigram, is the bigram within one document)."""
    n = len(words.hash)
    ones = (mix(words.hash) % np.uint64(buckets)).astype(np.int64)
    twos = (words.shingles(2) % np.uint64(buckets)).astype(np.int64)
    inside = np.ones(max(0, n - 1), bool)
    cut = words.bounds[1:-1]
    inside[cut[(cut > 0) & (cut < n)] - 1] = False
    return ones, twos, inside


def target_ids(labels: DataFrame, max_target: int = MAX_TARGET, key: str = "doc_id") -> list[int]:
    """Ids of at most ``max_target`` good, not toxic documents, those with the smallest hash."""
    good = labels.where((F.col("quality") == 1) & (F.coalesce(F.col("toxic"), F.lit(0)) == 0) & F.col(key).isNotNull())
    good = good.select(F.col(key).cast("long").alias("id")).distinct()
    return sorted(r.id for r in good.orderBy(F.xxhash64("id"), "id").limit(max_target).collect())


def _folds(words: Words) -> np.ndarray:
    """The fold of each document; equal texts share one."""
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(words.hash), dtype=np.uint64)])
    return (mix(total[words.bounds[1:]] - total[words.bounds[:-1]]) % np.uint64(FOLDS)).astype(np.int64)


def _means(words: Words, ones: np.ndarray, twos: np.ndarray, inside: np.ndarray, ratio: np.ndarray) -> np.ndarray:
    """Mean weight of each document's n-grams (nan without words)."""
    gain = np.zeros(len(ones))
    gain += ratio[ones]
    gain[:-1] += np.where(inside, ratio[twos], 0.0)
    return np.array([gain[a:b].sum() / (2 * (b - a) - 1) if b > a else np.nan
                     for a, b in zip(words.bounds[:-1], words.bounds[1:])])


def _failed(n_words: np.ndarray, n_repeat_words: np.ndarray, min_words: int, max_repeat_percent: int) -> np.ndarray:
    return (n_words < min_words) | (100 * n_repeat_words > max_repeat_percent * n_words)


def weights(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """log of target against raw rate per bucket, towards 0 where the target is small."""
    expected = raw * (target.sum() / max(1, raw.sum()))
    return np.log((target + SMOOTHING) / (expected + SMOOTHING))


def counts(docs: DataFrame, targets: list[int], key: str = "doc_id", text_col: str = "text", buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray]:
    """Occurrences per bucket: in all documents, and in the target by fold."""
    targets = np.array(targets, np.int64)

    def run(batches):
        # the last row is the raw corpus
        seen = np.zeros((FOLDS + 1, buckets), np.int64)
        for batch in batches:
            for part in slices(batch, "text", PART):
                data, offsets = text_bytes(part.column("text"))
                words = Words(data, offsets)
                ids = part.column("id").fill_null(-1 << 63).to_numpy(zero_copy_only=False)
                fold = np.repeat(np.where(np.isin(ids, targets), _folds(words), -1), np.diff(words.bounds))
                ones, twos, inside = _grams(words, buckets)
                seen[FOLDS] += np.bincount(ones, minlength=buckets) + np.bincount(twos[inside], minlength=buckets)
                good, both = fold >= 0, inside & (fold[:-1] >= 0)
                places = np.concatenate([fold[good] * buckets + ones[good], fold[:-1][both] * buckets + twos[both]])
                seen[:FOLDS] += np.bincount(places, minlength=FOLDS * buckets).reshape(FOLDS, buckets)
        fold, bucket = np.nonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(fold), pa.array(bucket), pa.array(seen[fold, bucket])], ["fold", "bucket", "n"])

    counted = docs.select(F.col(key).cast("long").alias("id"), F.col(text_col).alias("text")).mapInArrow(run, "fold long, bucket long, n long")
    rows = counted.groupBy("fold", "bucket").agg(F.sum("n").alias("n")).toArrow()
    seen = np.zeros((FOLDS + 1, buckets), np.int64)
    seen[rows["fold"].to_numpy(), rows["bucket"].to_numpy()] = rows["n"].to_numpy()
    return seen[FOLDS], seen[:FOLDS]


def held_out_threshold(docs: DataFrame, targets: list[int], raw: np.ndarray, folds: np.ndarray, key: str = "doc_id", text_col: str = "text",
                       most: float = THRESHOLD, min_words: int = MIN_WORDS, max_repeat_percent: int = MAX_REPEAT_PERCENT) -> float:
    """``most``, or less where target documents that are not counted score less."""
    targets, buckets = np.array(targets, np.int64), len(raw)
    ratios = [weights(raw, folds.sum(axis=0) - own) for own in folds]

    def run(batches):
        times: dict[int, int] = {}
        for batch in batches:
            ids = batch.column("id").fill_null(-1 << 63).to_numpy(zero_copy_only=False)
            for part in slices(batch.filter(pa.array(np.isin(ids, targets))), "text", PART):
                data, offsets = text_bytes(part.column("text"))
                words = Words(data, offsets)
                out, fold = measure(data, offsets, words), _folds(words)
                passed = ~_failed(out["n_words"], out["n_repeat_words"], min_words, max_repeat_percent)
                grams = _grams(words, buckets)
                for i in np.unique(fold[passed]):
                    means = _means(words, *grams, ratios[i])[passed & (fold == i)]
                    for step in np.floor(means * STEPS).astype(np.int64).tolist():
                        times[step] = times.get(step, 0) + 1
        yield pa.RecordBatch.from_arrays([pa.array(list(times), pa.int64()), pa.array(list(times.values()), pa.int64())], ["step", "n"])

    scored = docs.select(F.col(key).cast("long").alias("id"), F.col(text_col).alias("text")).mapInArrow(run, "step long, n long")
    rows = scored.groupBy("step").agg(F.sum("n").alias("n")).orderBy("step").toArrow()
    if not rows.num_rows:
        return most
    steps, upto = rows["step"].to_numpy(), np.cumsum(rows["n"].to_numpy())
    low, middle = (steps[np.searchsorted(upto, share * upto[-1])] / STEPS for share in (0.1, 0.5))
    return min(most, float(middle - SPREAD * (middle - low)))


def fit(docs: DataFrame, targets: list[int], key: str = "doc_id", text_col: str = "text",
        buckets: int = BUCKETS, most: float = THRESHOLD) -> tuple[np.ndarray, float]:
    """Weight per bucket, and the threshold."""
    raw, folds = counts(docs, targets, key, text_col, buckets)
    if not folds.any():
        return np.zeros(buckets), most
    return weights(raw, folds.sum(axis=0)), held_out_threshold(docs, targets, raw, folds, key, text_col, most)


def score(docs: DataFrame, ratio: np.ndarray, text_col: str = "text", threshold: float = THRESHOLD,
          min_words: int = MIN_WORDS, max_repeat_percent: int = MAX_REPEAT_PERCENT,
          carry: list[str] | None = None) -> DataFrame:
    """Add the base counts, ``base_failed``, ``score`` (mean weight; null without
    words) and ``kept`` to every row. Input columns of these names are replaced;
    ``carry`` names the input columns to pass on (default: all)."""
    new = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, score double, kept boolean"
    names, schema = carried(docs, new, carry)
    counted = schema.names[len(names):len(names) + 5]
    buckets = len(ratio)

    def run(batches):
        for batch in batches:
            for part in slices(batch, text_col, PART):
                data, offsets = text_bytes(part.column(text_col))
                words = Words(data, offsets)
                out = measure(data, offsets, words)
                n = out["n_words"]
                means = _means(words, *_grams(words, buckets), ratio)
                failed = _failed(n, out["n_repeat_words"], min_words, max_repeat_percent)
                kept = ~failed & (means >= threshold)
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in names), *(pa.array(out[k], pa.int64()) for k in counted), pa.array(failed), pa.array(means, mask=n == 0), pa.array(kept)],
                    schema.names)

    return docs.select(*{*names, text_col}).mapInArrow(run, schema)


def quality(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text_col: str = "text",
            buckets: int = BUCKETS, max_target: int = MAX_TARGET, threshold: float = THRESHOLD,
            carry: list[str] | None = None) -> DataFrame:
    """Fit on ``docs`` and ``labels``, then score every row of ``docs``; ``threshold`` is the highest allowed."""
    ratio, threshold = fit(docs, target_ids(labels, max_target, key), key, text_col, buckets, threshold)
    return score(docs, ratio, text_col, threshold, carry=carry)


__all__ = ["measure", "target_ids", "weights", "counts", "held_out_threshold", "fit", "score", "quality", "BUCKETS", "MAX_TARGET", "THRESHOLD"]
