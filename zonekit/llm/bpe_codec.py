"""Byte-level BPE encoding and decoding (op9).

The ``tiktoken`` library does the merges, from a local rank file. Long texts
are cut before encoding at safe boundaries of the splitting pattern: directly
before a space or newline that follows an ASCII letter or digit. No match of
the pattern contains such a place in its inside (no alternative continues from
a letter or digit to white space) and the only look-ahead belongs to runs of
white space, so the parts' ids joined are the whole text's ids. A stretch
without such a place stays whole.

Edge cases: a null or empty text has no ids; columns named like the output
columns in the input are replaced.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from zonekit.llm.common import carried
from zonekit.llm.textscan import slices, slices_of_rows

#: texts longer than this are cut at safe boundaries into parts of about it
PART_CHARS = 1 << 16
#: bytes of text encoded at a time
PART_BYTES = 1 << 20
_SAFE = re.compile(r"(?<=[A-Za-z0-9])(?=[ \n])")
_LOADED: dict = {}


def codec(rank_file: str, pattern: str):
    """The library's encoding for a rank file (loaded once per Python worker)."""
    import tiktoken

    if (rank_file, pattern) not in _LOADED:
        with open(rank_file, "rb") as f:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
        _LOADED[rank_file, pattern] = tiktoken.Encoding("local", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    return _LOADED[rank_file, pattern]


def parts(text: str, part_chars: int = PART_CHARS) -> Iterator[str]:
    """Cut a long text at safe boundaries; joined, the parts are the text."""
    start = 0
    while len(text) - start > part_chars:
        found = _SAFE.search(text, start + part_chars)
        if not found:
            break
        yield text[start:found.start()]
        start = found.start()
    yield text[start:] if start else text


def encode_text(encoding, text: str | None, part_chars: int = PART_CHARS) -> list[int]:
    ids: list[int] = []
    for part in parts(text or "", part_chars):
        ids += encoding.encode_ordinary(part)
    return ids


def encode(docs: DataFrame, rank_file: str, pattern: str, text_col: str = "text",
           part_chars: int = PART_CHARS) -> DataFrame:
    """Add ``ids array<int>`` to every row. Rows keep their partition: no shuffle."""
    names, schema = carried(docs, "ids array<int>")

    def run(batches):
        encoding = codec(rank_file, pattern)
        for batch in batches:
            for part in slices(batch, text_col, PART_BYTES):  # lists of ids are many times the text
                ids = [encode_text(encoding, t.as_py(), part_chars) for t in part.column(text_col)]
                yield pa.RecordBatch.from_arrays([*(part.column(n) for n in names), pa.array(ids, pa.list_(pa.int32()))], schema.names)

    return docs.mapInArrow(run, schema)


def decode(encoded: DataFrame, rank_file: str, pattern: str, ids_col: str = "ids") -> DataFrame:
    """Add ``decoded binary``: the raw bytes of the ids (null ids: null)."""
    names, schema = carried(encoded, "decoded binary")

    def run(batches):
        encoding = codec(rank_file, pattern)
        for batch in batches:
            for part in slices_of_rows(batch, 256):
                out = [None if ids is None else encoding.decode_bytes(ids) for ids in part.column(ids_col).to_pylist()]
                yield pa.RecordBatch.from_arrays([*(part.column(n) for n in names), pa.array(out, pa.binary())], schema.names)

    return encoded.mapInArrow(run, schema)


def round_trip_digests(docs: DataFrame, rank_file: str, pattern: str, key: str = "doc_id",
                       text_col: str = "text", part_chars: int = PART_CHARS) -> DataFrame:
    """Encode, decode again, and keep digests only, in one pass per batch: the
    id lists (several times the text) never leave the Python worker."""

    def run(batches):
        encoding = codec(rank_file, pattern)
        names = [str(i) for i in range(encoding.n_vocab + 1)]
        for batch in batches:
            n, ids_sha, text_sha = [], [], []
            for text in batch.column(text_col):
                ids = encode_text(encoding, text.as_py(), part_chars)
                n.append(len(ids))
                ids_sha.append(hashlib.sha256(",".join([names[i] for i in ids]).encode()).hexdigest())
                text_sha.append(hashlib.sha256(encoding.decode_bytes(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(key), pa.array(n, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(text_sha, pa.string())],
                [key, "n_tokens", "ids_sha256", "decoded_sha256"])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, text_col).mapInArrow(run, f"`{key}` {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")


__all__ = ["codec", "parts", "encode_text", "encode", "decode", "round_trip_digests", "PART_CHARS"]
