"""Packing (op12): bounded-space online best fit into sequences of fixed length.

Every task encodes its documents and keeps a fixed number of open windows. A
document's ids go, whole, into the open window that they fit most tightly (an exact
fit closes it); ids longer than a window fill whole windows first. When none
fits and no further window may be opened, the fullest is filled to its end with the
document's first ids and emitted, and the rest is placed in the same way; so
an emitted window has no padding. What is still open when a task ends is left
over: leftovers of 64 tasks at a time are packed by the same rule, round after
round, until one group is left; its last windows are joined end to end, and
the ids that do not fill a window are cut into sequences of descending powers of
two, which need no padding either.

A task holds its open windows and one document, a merge group 64 times the windows.
Ids travel with their pieces, so the pieces are the packed corpus. Every round's
result is a written table; a repeated task writes the same rows again.

Edge cases: a null or empty text is its end id alone; repeated rows are packed each; null ids
are carried; an empty table has no pieces; other columns are ignored.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonekit.llm.common import stored
from zonekit.llm.token_files import encoder

#: open windows of a task
OPEN = 32
#: tasks whose leftovers are merged at a time
MERGE = 64
#: rows of a batch that a task hands on
_ROWS = 2048
PIECES = "doc_id long, start long, length int, ids binary, doc_tokens long, part long, window long, offset int, done boolean"
_NAMES = ["doc_id", "start", "length", "ids", "doc_tokens", "part", "window", "offset", "done"]
_TYPES = [pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.bool_()]


class Packer:
    """Open windows of one task or merge group. A piece is (doc_id, start, ids, doc_tokens),
    ids an array; ``emitted`` collects (window number, pieces)."""

    def __init__(self, length: int, n_open: int):
        self.length, self.n_open = length, n_open
        self.windows: dict[int, list] = {}
        self.room: list[tuple[int, int]] = []  # (room left, window), ascending
        self.emitted, self.made = [], 0

    def _put(self, room: int, window: int, piece) -> None:
        """Put a piece into a window that has ``room`` for it."""
        self.windows[window].append(piece)
        room -= len(piece[2])
        if room:
            insort(self.room, (room, window))
        else:
            self.emitted.append((window, self.windows.pop(window)))

    def _open(self) -> int:
        self.windows[self.made] = []
        self.made += 1
        return self.made - 1

    def place(self, doc_id, start: int, ids: np.ndarray, doc_tokens: int) -> None:
        while len(ids):
            n = min(len(ids), self.length)
            at = bisect_left(self.room, (n, -1))
            if n == self.length or at == len(self.room) and len(self.room) < self.n_open:
                room, window = self.length, self._open()
            elif at < len(self.room):
                room, window = self.room.pop(at)
            else:  # none fits: the fullest is filled and emitted
                room, window = self.room.pop(0)
                n = room
            self._put(room, window, (doc_id, start, ids[:n], doc_tokens))
            start, ids = start + n, ids[n:]

    def finish(self) -> None:
        """Emit what is open: joined end to end, the last ids in powers of two."""
        pieces = [p for _, w in sorted(self.windows.items()) for p in w]
        left = sum(len(p[2]) for p in pieces)
        self.windows, self.room = {}, []
        window, room = -1, 0
        for doc_id, start, ids, doc_tokens in pieces:
            while len(ids):
                if not room:
                    room = min(self.length, 1 << (left.bit_length() - 1))
                    window = self._open()
                    self.emitted.append((window, self.windows.pop(window)))
                n = min(room, len(ids))
                self.emitted[-1][1].append((doc_id, start, ids[:n], doc_tokens))
                start, ids, room, left = start + n, ids[n:], room - n, left - n


def _batch(windows, part: int, done: bool) -> pa.RecordBatch:
    rows = []
    for window, pieces in windows:
        at = 0
        for doc_id, start, ids, doc_tokens in pieces:
            rows.append((doc_id, start, len(ids), ids.astype("<u4").tobytes(), doc_tokens, part, window, at, done))
            at += len(ids)
    columns = list(zip(*rows)) or [()] * len(_NAMES)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _TYPES)], names=_NAMES)


def pack(docs: DataFrame, tokenizer_path: str, end_id: int, length: int = 2048, n_open: int = OPEN, merge: int = MERGE,
         key: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The packed corpus, a row per piece: ``(doc_id, start, length, ids, doc_tokens, sequence_id, offset)``;
    ``ids`` are little-endian unsigned 32-bit integers. ``length`` must be a power of two."""
    if length & (length - 1):
        raise ValueError("length must be a power of two")

    def encode_and_pack(batches):
        enc, packer, part = encoder(tokenizer_path), Packer(length, n_open), TaskContext.get().partitionId()
        end = np.array([end_id], enc.dtype)
        for batch in batches:
            for doc_id, text in zip(batch.column(0), batch.column(1)):
                ids = np.concatenate([np.frombuffer(enc.encode(text.as_py()), enc.dtype), end])
                packer.place(doc_id.as_py(), 0, ids, len(ids))
                if len(packer.emitted) >= _ROWS // 8:
                    yield _batch(packer.emitted, part, True)
                    packer.emitted = []
        yield _batch(packer.emitted, part, True)
        yield _batch(sorted(packer.windows.items()), part, False)

    def merge_group(last: bool):
        def run(table: pa.Table) -> pa.Table:
            rows = sorted(table.to_pylist(), key=lambda r: (r["part"], r["window"], r["offset"]))
            packer, part = Packer(length, n_open), rows[0]["part"] // merge
            for r in rows:
                packer.place(r["doc_id"], r["start"], np.frombuffer(r["ids"], "<u4"), r["doc_tokens"])
            if last:
                packer.finish()
            parts = [_batch(packer.emitted, part, True), _batch(sorted(packer.windows.items()), part, False)]
            return pa.Table.from_batches(parts)
        return run

    rows = docs.select(F.col(key).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    rounds = [stored(rows.mapInArrow(encode_and_pack, PIECES), "packed-0")]
    groups = rounds[0].agg(F.max("part")).first()[0]
    while groups is not None:
        groups //= merge
        open_ = rounds[-1].where("not done").withColumn("grp", F.expr(f"part div {merge}"))
        rounds.append(stored(open_.groupBy("grp").applyInArrow(merge_group(groups == 0), PIECES), f"packed-{len(rounds)}"))
        if groups == 0:
            break
    out = None
    for k, made in enumerate(rounds):
        # round, task and window number of a sequence, in one integer
        own = made.where("done").withColumn("sequence_id", F.lit(k << 58) + F.shiftleft("part", 28) + F.col("window"))
        out = own if out is None else out.unionByName(own)
    return out.select("doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset")


__all__ = ["pack", "Packer", "OPEN", "MERGE"]
