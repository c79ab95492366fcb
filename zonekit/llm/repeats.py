"""Suffix-array dedup (op7): bytes covered by a string of ``span`` bytes that also
starts anywhere else in the corpus.

One index over a corpus does not fit one machine, so equal strings are brought
together first. Every string of ``span`` bytes has an anchor, the 48-byte gram
of least hash inside it (the first, if equal); equal strings have equal anchors at
equal places. The strings of one anchor occurrence lie in one context, a
stretch of the document; contexts with the same anchor gram form a group, and
each string of the corpus lies in exactly one context. A repeat can only
occur within a group, and groups of one context are dropped.

Equal contexts of a group are one entry that counts twice: every string in
them repeats. Groups with different contexts go to run-length indexes
(``run_index``): the run-compressed Burrows-Wheeler transform of the group's
contexts with samples at the run ends, from which matching statistics are
streamed; strings whose longest match is ``span`` bytes or more are marked. Copies of whole
documents are one class, whose text enters once and is covered whole.

Scale: two shuffles of small rows by anchor, one of the contexts that differ (a
small part of the text), and two joins of text by document. Tasks hold one
index of ``index_bytes`` at most; a group that is larger is counted exactly, by hashes of all
its strings, in a grouped count that combines before the shuffle.

Edge cases: a null text is empty; texts shorter than ``span`` lose nothing;
rows with equal or null ids are separate documents, equal texts are copies; an
empty table gives an empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonekit.llm.common import stored
from zonekit.llm.run_index import RunIndex
from zonekit.llm.textscan import mix, slices, text_bytes

SPAN = 200
GRAM = 48
#: bytes of contexts in one index
INDEX_BYTES = 3 << 20
#: bytes that are scanned at a time, parts of a longer document too
_PIECE = 1 << 20
_PLACE_BITS = np.uint64(23)
_PRIME = 0xD6E8FEB86659FD93
_VALUES = mix((np.arange(256, dtype=np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15))
_POWERS: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    if base not in _POWERS or len(_POWERS[base]) < n:
        _POWERS[base] = np.cumprod(np.full(n, base, np.uint64))
    return _POWERS[base][:n]


def text_class(data: bytes | memoryview) -> int:
    """Signed 64-bit digest of a text."""
    return int(np.array([xxhash.xxh3_64_intdigest(data)], np.uint64).view(np.int64)[0])


def _texts(column) -> list[memoryview]:
    data, offsets = text_bytes(column)
    whole = memoryview(data)
    return [whole[a:b] for a, b in zip(offsets.tolist()[:-1], offsets.tolist()[1:])]


class Hashes:
    """Hashes of any stretch of a byte array."""

    def __init__(self, data: np.ndarray):
        n = len(data)
        self.total = np.zeros(n + 1, np.uint64)
        np.cumsum(_VALUES[data] * _powers(_PRIME, n), out=self.total[1:])
        self.back = _powers(pow(_PRIME, -1, 1 << 64), n + 1)

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (self.total[end] - self.total[start]) * self.back[start]

    def each(self, length: int) -> np.ndarray:
        return (self.total[length:] - self.total[:-length]) * self.back[:len(self.total) - length]


def contexts(data: np.ndarray, offsets: np.ndarray, span: int, gram: int):
    """Of each anchor occurrence: gram hash, context hash, document index, and the
    context's start and end in the document. Together the contexts hold every
    string of ``span`` bytes once."""
    empty = np.zeros(0, np.int64)
    n = len(data)
    if n < span:
        return empty.view(np.uint64), empty.view(np.uint64), empty, empty, empty
    width = span - gram + 1
    hashes = Hashes(data)
    grams = mix(hashes.each(gram))
    # the place in the low bits: the least key is the first of the least hashes
    keys = (grams >> _PLACE_BITS << _PLACE_BITS) | np.arange(len(grams), dtype=np.uint64)
    # least key of each window, from running minima of blocks of the window's width in both directions
    blocks = np.concatenate([keys, np.full(width + (-len(keys)) % width, ~np.uint64(0))]).reshape(-1, width)
    to_here = np.minimum.accumulate(blocks, axis=1).ravel()
    from_here = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    windows = n - span + 1
    place = (np.minimum(from_here[:windows], to_here[width - 1:width - 1 + windows]) & ((np.uint64(1) << _PLACE_BITS) - np.uint64(1))).astype(np.int64)
    owner = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))[:windows]
    start = np.flatnonzero(np.arange(windows) + span <= offsets[1:][owner])
    if not len(start):
        return empty.view(np.uint64), empty.view(np.uint64), empty, empty, empty
    place, owner = place[start], owner[start]
    fresh = np.ones(len(start), bool)
    fresh[1:] = (place[1:] != place[:-1]) | (owner[1:] != owner[:-1])
    first = np.flatnonzero(fresh)
    low, high = start[first], start[np.append(first[1:], len(start)) - 1] + span
    place, owner = place[first], owner[first]
    shape = (high - low).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + (place - low).astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)
    return grams[place], mix(hashes.of(low, high) + shape), owner, low - offsets[owner], high - offsets[owner]


def _merged(owner: np.ndarray, start: np.ndarray, end: np.ndarray):
    """Overlapping or touching stretches of one owner as one (input sorted by owner, start)."""
    if not len(start):
        return owner, start, end
    base = owner.astype(np.int64) * (int(end.max()) + 2)
    reach = np.maximum.accumulate(end + base)
    fresh = np.ones(len(start), bool)
    fresh[1:] = (start + base)[1:] > reach[:-1]
    at = np.flatnonzero(fresh)
    last = np.append(at[1:], len(start)) - 1
    return owner[at], start[at], (reach - base)[last]


def _documents(docs: DataFrame) -> DataFrame:
    """Stored ``(doc_id, e, n_bytes, sha)``."""

    def run(batches):
        for batch in batches:
            for part in slices(batch, "text", _PIECE):
                texts = _texts(part.column("text"))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array([text_class(t) for t in texts], pa.int64()), pa.array([len(t) for t in texts], pa.int64()),
                     pa.array([hashlib.sha256(t).hexdigest() for t in texts], pa.string())], ["doc_id", "e", "n_bytes", "sha"])

    return stored(docs.mapInArrow(run, "doc_id long, e long, n_bytes long, sha string"), "repeat-documents")


def _pieces(data: np.ndarray, span: int):
    """(start, bytes) of a long text's pieces, which overlap so that each holds the strings that start in it."""
    for at in range(0, max(1, len(data) - span + 1), _PIECE):
        yield at, data[at:at + _PIECE + span - 1]


def _anchors(docs: DataFrame, span: int, gram: int) -> DataFrame:
    """``(mark, a, c, e, start, end)``: contexts, once per class in a task. Contexts found twice
    in one scan are marked at once (``mark``; a is then only a spread) and passed on once."""

    def run(batches):
        sent: set[int] = set()
        for batch in batches:
            for part in slices(batch, "text", _PIECE):
                data, offsets = text_bytes(part.column("text"))
                texts = [data[a:b] for a, b in zip(offsets[:-1], offsets[1:])]
                owners = np.array([text_class(memoryview(t)) for t in texts], np.int64)
                fresh = []
                for i, (e, t) in enumerate(zip(owners.tolist(), texts)):
                    if len(t) >= span and e not in sent:
                        fresh.append(i)
                        sent.add(e)
                if len(sent) > 1_000_000:
                    sent.clear()
                if not fresh:
                    continue
                if len(fresh) == 1:
                    scans = [(piece, np.array([0, len(piece)]), owners[fresh], at) for at, piece in _pieces(texts[fresh[0]], span)]
                else:
                    scans = [(np.concatenate([texts[i] for i in fresh]), np.concatenate([[0], np.cumsum([len(texts[i]) for i in fresh])]), owners[fresh], 0)]
                for data, offsets, own, at in scans:
                    a, c, doc, start, end = contexts(data, offsets, span, gram)
                    both = mix(a + c * np.uint64(_PRIME))
                    order = np.argsort(both, kind="stable")
                    equal = both[order][1:] == both[order][:-1]
                    twice, later = np.zeros(len(a), bool), np.zeros(len(a), bool)
                    twice[order[1:][equal]] = twice[order[:-1][equal]] = True
                    later[order[1:][equal]] = True
                    m_doc, m_start, m_end = _merged(doc[twice], start[twice], end[twice])
                    keep = ~later
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.concatenate([np.zeros(keep.sum(), bool), np.ones(len(m_doc), bool)])),
                         pa.array(np.concatenate([a[keep].view(np.int64), own[m_doc]])),
                         pa.array(np.concatenate([c[keep].view(np.int64), np.zeros(len(m_doc), np.int64)])),
                         pa.array(np.concatenate([own[doc[keep]], own[m_doc]])),
                         pa.array(np.concatenate([start[keep], m_start]) + at), pa.array(np.concatenate([end[keep], m_end]) + at)],
                        ["mark", "a", "c", "e", "start", "end"])

    return docs.select("text").mapInArrow(run, "mark boolean, a long, c long, e long, start long, end long")


def _shared(anchors: DataFrame) -> DataFrame:
    """Stored ``(mark, a, e, start, end)``: marked stretches, and one entry (mark false) for each
    of the different contexts of groups that have several. One pass over sorted rows, which holds two back."""
    names = ["mark", "a", "c", "e", "start", "end"]

    def out(rows, mark):
        return pa.RecordBatch.from_arrays([pa.array(np.full(rows.shape[1], mark)), *(pa.array(rows[i]) for i in (1, 3, 4, 5))], ["mark", "a", "e", "start", "end"])

    def run(batches):
        last = pending = None  # the last row, with whether the one before had its context; the first entry of its group
        last_twice = False
        for batch in batches:
            rows = np.stack([batch.column("mark").to_numpy(zero_copy_only=False).astype(np.int64), *(batch.column(c).to_numpy() for c in names[1:])])
            marks = rows[0] == 1
            if marks.any():
                yield out(rows[:, marks], True)
                rows = rows[:, ~marks]
            if last is not None:
                rows = np.concatenate([last[:, None], rows], axis=1)
            n = rows.shape[1]
            if not n:
                continue
            same_a = np.zeros(n, bool)
            same_a[1:] = rows[1, 1:] == rows[1, :-1]
            same_c = np.zeros(n, bool)
            same_c[1:] = same_a[1:] & (rows[2, 1:] == rows[2, :-1])
            first_known = last is not None  # row 0 was looked at before, but for its successor
            twice = same_c.copy()
            twice[:-1] |= same_c[1:]
            if first_known:
                twice[0] |= last_twice
            done = np.arange(n) < n - 1
            if (twice & done).any():
                yield out(rows[:, twice & done], True)
            # entries: the first of each context, where the group has another
            heads = np.flatnonzero(~same_c & ~((np.arange(n) == 0) & first_known))
            other = same_a[heads]
            if len(heads):
                followed = np.append(other[1:], False)
                if other[0] and pending is not None:
                    yield out(pending[:, None], False)
                if (other | followed).any():
                    yield out(rows[:, heads[other | followed]], False)
                pending = rows[:, heads[-1]] if not other[-1] else None
            last, last_twice = rows[:, -1], bool(twice[-1])
        if last is not None and last_twice:
            yield out(last[:, None], True)

    ordered = anchors.repartition("a").sortWithinPartitions("mark", "a", "c", "e", "start")
    return stored(ordered.mapInArrow(run, "mark boolean, a long, e long, start long, end long"), "repeat-shared")


def _entries(docs: DataFrame, shared: DataFrame, classes: DataFrame) -> DataFrame:
    """``(a, e, start, bytes)`` of the entries, cut from one document of each class."""
    places = shared.where("not mark").groupBy("e").agg(F.collect_list(F.struct("a", "start", "end")).alias("places"))
    places = places.join(classes, "e")

    def run(batches):
        for batch in batches:
            for part in slices(batch, "text", _PIECE):
                a, e, start, cut = [], [], [], []
                for data, own, wanted in zip(_texts(part.column("text")), *(part.column(i).to_pylist() for i in (1, 2))):
                    if text_class(data) != own:
                        continue
                    for p in wanted:
                        a.append(p["a"])
                        e.append(own)
                        start.append(p["start"])
                        cut.append(bytes(data[p["start"]:p["end"]]))
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(e, pa.int64()), pa.array(start, pa.int64()), pa.array(cut, pa.binary())],
                                                 ["a", "e", "start", "bytes"])

    texts = docs.join(places, docs["doc_id"].eqNullSafe(places["rep"])).select("text", "e", "places")
    # repeated rows of one id give equal entries
    return texts.mapInArrow(run, "a long, e long, start long, bytes binary")


def _indexed(entries: DataFrame, span: int, index_bytes: int) -> DataFrame:
    """Stored ``(e, start, end, window)``: marked stretches (window null), and for groups larger
    than an index all strings of the group by hash."""

    def marked(group, e, start, data):
        firsts = np.concatenate([[0], np.cumsum([len(b) for b in data])[:-1]])
        joined = np.frombuffer(b"".join(data), np.uint8)
        found = np.flatnonzero(RunIndex(joined, firsts, group).matches() >= span)
        string = np.searchsorted(firsts, found, "right") - 1
        begin = start[string] + found - firsts[string]
        string, begin, end = _merged(string, begin, begin + span)
        return pa.RecordBatch.from_arrays([pa.array(e[string]), pa.array(begin), pa.array(end), pa.nulls(len(begin), pa.int64())], ["e", "start", "end", "window"])

    def windows(e, start, data):
        for own, at, b in zip(e, start, data):
            h = mix(Hashes(np.frombuffer(b, np.uint8)).each(span)).view(np.int64)
            begin = at + np.arange(len(h))
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(h), own)), pa.array(begin), pa.array(begin + span), pa.array(h)], ["e", "start", "end", "window"])

    def run(batches):
        held, size, large = [], 0, None  # whole groups for the next index; the group that is too large for one

        def flush(rows):
            group, e, start = (np.array([r[i] for r in rows], np.int64) for i in range(3))
            change = np.concatenate([[False], group[1:] != group[:-1]])
            yield marked(np.cumsum(change), e, start, [r[3] for r in rows])

        for batch in batches:
            for row in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if large is not None and row[0] == large:
                    yield from windows([row[1]], [row[2]], [row[3]])
                    continue
                large = None
                if size + len(row[3]) > index_bytes and held:
                    whole = [r for r in held if r[0] != row[0]]
                    if whole:
                        yield from flush(whole)
                    held = held[len(whole):]
                    size = sum(len(r[3]) for r in held)
                    if size + len(row[3]) > index_bytes:
                        large = row[0]
                        yield from windows(*zip(*[r[1:] for r in [*held, row]]))
                        held, size = [], 0
                        continue
                held.append(row)
                size += len(row[3])
        if held:
            yield from flush(held)

    ordered = entries.repartition("a").sortWithinPartitions("a", "e", "start")
    return stored(ordered.mapInArrow(run, "e long, start long, end long, window long"), "repeat-marks")


def _spans(docs: DataFrame, classes: DataFrame, span: int, gram: int, index_bytes: int) -> DataFrame:
    """``(e, spans)``: marked stretches of each class, unmerged."""
    shared = _shared(_anchors(docs, span, gram))
    found = _indexed(_entries(docs, shared, classes), span, index_bytes)
    windows = found.where("window is not null")
    often = windows.groupBy("window").agg(F.count(F.lit(1)).alias("times")).where("times > 1").select("window")
    marks = (shared.where("mark").select("e", "start", "end").union(found.where("window is null").select("e", "start", "end"))
             .union(windows.join(often, "window").select("e", "start", "end")))
    return marks.groupBy("e").agg(F.sort_array(F.collect_set(F.struct("start", "end"))).alias("spans"))


def remove_repeats(docs: DataFrame, span: int = SPAN, gram: int = GRAM, key: str = "doc_id", text_col: str = "text",
                   index_bytes: int = INDEX_BYTES) -> DataFrame:
    """One row per document: ``(doc_id, n_bytes, n_removed, removed, kept_sha256)``;
    ``removed`` are the maximal removed stretches in bytes, end exclusive."""
    docs = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    documents = _documents(docs)
    classes = stored(documents.groupBy("e").agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("copies")), "repeat-classes")
    spans = _spans(docs, classes.select("e", "rep"), span, gram, index_bytes)
    # what is known of each class: several copies, or marked stretches, or neither
    known = stored(classes.join(spans, "e", "left").select("e", "copies", "spans"), "repeat-spans")
    rows = documents.join(known, "e")
    covered = (F.col("copies") > 1) & (F.col("n_bytes") >= span)
    kind = "array<struct<start:bigint,end:bigint>>"
    simple = rows.where(covered | F.col("spans").isNull()).select(
        "doc_id", "n_bytes", F.when(covered, F.col("n_bytes")).otherwise(0).cast("long").alias("n_removed"),
        F.when(covered, F.array(F.struct(F.lit(0).cast("long").alias("start"), F.col("n_bytes").alias("end")))).otherwise(F.array().cast(kind)).cast(kind).alias("removed"),
        F.when(covered, F.sha2(F.lit("").cast("binary"), 256)).otherwise(F.col("sha")).alias("kept_sha256"))
    partly = rows.where(~covered & F.col("spans").isNotNull()).select(F.col("doc_id").alias("id"), "e", "spans")

    def run(batches):
        struct = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        for batch in batches:
            for part in slices(batch, "text", _PIECE):
                out = []
                for data, doc_id, own, marks in zip(_texts(part.column("text")), *(part.column(i).to_pylist() for i in (0, 2, 3))):
                    if text_class(data) != own:
                        continue
                    begin, end = (np.array([m[x] for m in marks], np.int64) for x in ("start", "end"))
                    _, begin, end = _merged(np.zeros(len(begin), np.int64), begin, end)
                    edges = [0, *np.stack([begin, end], axis=1).ravel().tolist(), len(data)]
                    kept = b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2]))
                    out.append((doc_id, len(data), len(data) - len(kept), [{"start": a, "end": b} for a, b in zip(begin.tolist(), end.tolist())], hashlib.sha256(kept).hexdigest()))
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.int64(), struct, pa.string()))],
                                                 ["doc_id", "n_bytes", "n_removed", "removed", "kept_sha256"])

    cut = docs.join(partly, docs["doc_id"].eqNullSafe(partly["id"])).select("doc_id", "text", "e", "spans")
    return simple.union(cut.mapInArrow(run, f"doc_id long, n_bytes long, n_removed long, removed {kind}, kept_sha256 string"))


__all__ = ["remove_repeats", "contexts", "SPAN", "GRAM", "INDEX_BYTES"]
