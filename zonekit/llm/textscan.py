"""Vectorised scanning of Arrow text columns (runs inside tasks).

A column's UTF-8 bytes are read in place; words, lines and shingles of all
documents of a batch are hashed by numpy in one go. Words are the runs of
``[^\\x20\\x09-\\x0D]+``; null texts count as empty. Hashes are 64 bits of a
polynomial over a fixed random byte table; equal strings give equal hashes on
every machine.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

#: bytes hashed at a time (bounds the temporary arrays)
PIECE = 1 << 20
#: longer words are hashed one by one, by xxHash (the polynomial has collisions among long structured words)
LONG_WORD = 256


def mix(h: np.ndarray) -> np.ndarray:
    """64-bit finaliser (splitmix64's)."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _byte_table() -> np.ndarray:
    return mix((np.arange(256, dtype=np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


IS_SPACE = np.zeros(256, bool)
IS_SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
EXACT = _byte_table()
EXACT[IS_SPACE] = 0
FOLDED = EXACT[LOWER]
LINE = _byte_table()
LINE[10] = 0
_POWERS = np.cumprod(np.full(LONG_WORD + 1, 0xD6E8FEB86659FD93, np.uint64))


def text_bytes(column) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; a null text is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def slices(batch, column: str, at_most: int = 1 << 20):
    """Parts of a batch of about ``at_most`` text bytes, at least one row each."""
    start, size = 0, 0
    lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    for i, n in enumerate(lengths):
        if size and size + n > at_most:
            yield batch.slice(start, i - start)
            start, size = i, 0
        size += int(n)
    if start < batch.num_rows:
        yield batch.slice(start)


def slices_of_rows(batch, rows: int):
    """Parts of a batch of at most ``rows`` rows."""
    for at in range(0, batch.num_rows, rows):
        yield batch.slice(at, rows)


def _runs(data, offsets, separator) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs without separators; none crosses a document."""
    inside = ~separator[data]
    cut = offsets[1:-1]
    cut = cut[(cut > 0) & (cut < len(data))]
    begin = inside.copy()
    begin[1:] &= ~inside[:-1]
    begin[cut] = inside[cut]
    end = inside.copy()
    end[:-1] &= ~inside[1:]
    end[cut - 1] = inside[cut - 1]
    return np.flatnonzero(begin), np.flatnonzero(end) + 1


def _hash_runs(data, starts, ends, byte_table, lower: bool) -> np.ndarray:
    out = np.zeros(len(starts), np.uint64)
    lengths = ends - starts
    at = 0
    while at < len(starts):
        if lengths[at] > LONG_WORD:
            word = data[starts[at]:ends[at]]
            out[at] = xxhash.xxh64_intdigest((LOWER[word] if lower else word).tobytes())
            at += 1
            continue
        to = max(at + 1, int(np.searchsorted(ends, starts[at] + PIECE, "right")))
        if (long := np.flatnonzero(lengths[at:to] > LONG_WORD)).size:
            to = at + int(long[0])
        base = starts[at]
        first = starts[at:to] - base
        piece = data[base:ends[to - 1]]
        place = np.arange(len(piece)) - np.repeat(first, np.diff(np.append(first, len(piece))))
        np.minimum(place, LONG_WORD, out=place)
        out[at:to] = np.add.reduceat(byte_table[piece] * _POWERS[place], first)
        at = to
    return mix(out + lengths.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))


class Words:
    """Words of a batch: ``start``, ``end`` (byte positions), ``hash``, and
    ``bounds``: document i has words bounds[i]..bounds[i + 1]."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, lower: bool = False):
        self.start, self.end = _runs(data, offsets, IS_SPACE)
        self.hash = _hash_runs(data, self.start, self.end, FOLDED if lower else EXACT, lower)
        self.bounds = np.searchsorted(self.start, offsets)

    def shingles(self, k: int) -> np.ndarray:
        """Hash of the k words from each position; a document's own are those
        from bounds[i] to bounds[i + 1] - k."""
        n = max(0, len(self.hash) - k + 1)
        h = mix(self.hash[:n] + np.uint64(k))
        for j in range(1, k):
            h = mix(h * np.uint64(0x9E3779B97F4A7C15) + self.hash[j:n + j])
        return h


def lines(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and hashes of the non-empty lines (split at ``\\n``)."""
    separator = np.zeros(256, bool)
    separator[10] = True
    starts, ends = _runs(data, offsets, separator)
    return starts, ends, _hash_runs(data, starts, ends, LINE, False)


__all__ = ["Words", "lines", "mix", "slices", "slices_of_rows", "text_bytes", "IS_SPACE", "LOWER"]
