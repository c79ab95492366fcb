"""Token-ID / binary output (op1).

File format, per shard: ``shard-NNNNNN.bin`` holds the ids of the shard's
documents back to back as flat little-endian unsigned integers (16 bits where
the vocabulary fits, else 32); ``shard-NNNNNN.idx`` holds 64-bit integers: the
number of documents n, how many of them (the first ones) have a null id, the
n + 1 offsets in ids from the shard's start, and the n document ids. The
table ``manifest`` beside them has one row per shard with its base, the number
of ids in all shards before it, from a prefix sum over the shards' totals: no
document passes through the driver or one task.

Order: documents are range-partitioned and sorted by id (null ids first, equal
ids by text), so shard by shard the files are in ascending id order. A shard is
written under a name of its own task attempt and renamed when complete; a
repeated task writes the same bytes again.

Edge cases: a null text is encoded like an empty one (only the end id); an
empty table gives no shard; repeated rows are written as often as they occur.
"""

from __future__ import annotations

import os
import re
import uuid

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from zonekit.llm.common import filesystem

#: distinct pieces a worker remembers
CACHE_PIECES = 500_000
#: text whose lower case and splitting are simple
_PLAIN = re.compile(r"[\t-\r -~À-ÖØ-öø-ÿ]*")
#: Unicode's White_Space
_SPACE = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+")
#: byte-level vocabularies write the bytes that are no visible Latin-1 characters as U+0100 onwards
_BYTE_CHARS = {b: 256 + i for i, b in enumerate([*range(33), *range(127, 161), 173])}
_SHARD = "shard long, n_docs long, n_tokens long"
_LOADED: dict = {}


class _Pieces(dict):
    """Ids, as bytes, of the pieces of split text; a new piece is merged by the library's model."""

    def __init__(self, model, one: list[bytes]):
        self.merge, self.one = model.tokenize, one

    def __missing__(self, piece: str) -> bytes:
        as_bytes = piece if piece.isascii() else piece.encode().decode("latin-1").translate(_BYTE_CHARS)
        ids = self[piece] = b"".join([self.one[t.id] for t in self.merge(as_bytes)])
        return ids


class WordEncoder:
    """Encodes with a local tokenizer file of the ``tokenizers`` library whose white space is dropped
    and always ends a piece.

    Text of ASCII and Latin-1 letters, digits, signs and plain white space is
    lower-cased and split here, as the file's own normaliser and splitter do
    for these characters; each distinct piece is merged once by the library's
    model and remembered. In any other text, words are the unit, and a word
    with other characters goes through the library's whole pipeline. The file's
    added tokens (``<|endoftext|>``) are recognised in texts as the library does
    by default: their strings become their ids, what lies between is encoded apart.
    """

    #: splitting pattern of the vocabulary file, for the characters above (fixed values)
    SPLIT = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^\sa-zß-öø-ÿ0-9]+")

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        added = self.tokenizer.get_added_tokens_decoder()
        if any(t.normalized or t.lstrip or t.rstrip or t.single_word for t in added.values()):
            raise ValueError("added tokens must match texts as they stand")
        self.added = {t.content: i for i, t in added.items()}
        self.cut = re.compile("(" + "|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) + ")") if added else None
        self.vocabulary = self.tokenizer.get_vocab_size()
        self.dtype = np.dtype("<u2" if self.vocabulary <= 1 << 16 else "<u4")
        self.one = [i.to_bytes(self.dtype.itemsize, "little") for i in range(self.vocabulary)]
        self.pieces = _Pieces(self.tokenizer.model, self.one)

    def _plain(self, text: str) -> bytes:
        return b"".join(map(self.pieces.__getitem__, self.SPLIT.findall(text.lower())))

    def _word(self, word: str) -> bytes:
        if _PLAIN.fullmatch(word):
            return self._plain(word)
        return b"".join([self.one[i] for i in self.tokenizer.encode(word, add_special_tokens=False).ids])

    def encode(self, text: str | None) -> bytes:
        """The ids of a text as bytes of ``dtype``."""
        if len(self.pieces) > CACHE_PIECES:
            self.pieces.clear()
        text = text or ""
        if self.cut and self.cut.search(text):
            return b"".join([self.one[self.added[t]] if t in self.added else self._part(t) for t in self.cut.split(text)])
        return self._part(text)

    def _part(self, text: str) -> bytes:
        if _PLAIN.fullmatch(text):
            return self._plain(text)
        return b"".join([self._word(word) for word in _SPACE.split(text)])


def encoder(path: str) -> WordEncoder:
    if path not in _LOADED:
        _LOADED[path] = WordEncoder(path)
    return _LOADED[path]


def write_token_files(docs: DataFrame, out_dir: str, tokenizer_path: str, end_id: int,
                      key: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write the shards and the manifest; returns the manifest
    ``(shard, n_docs, n_tokens, base)``. ``tokenizer_path`` must exist on every executor."""

    def run(batches):
        shard = TaskContext.get().partitionId()
        enc = encoder(tokenizer_path)
        end = np.array([end_id], enc.dtype).tobytes()
        width = enc.dtype.itemsize
        fs, root = filesystem(out_dir)
        name, mine = f"{root}/shard-{shard:06d}", uuid.uuid4().hex
        out, ids, sizes, nulls = None, [], [], 0
        for batch in batches:
            if batch.num_rows and out is None:
                fs.create_dir(root, recursive=True)
                out = fs.open_output_stream(f"{name}.bin.{mine}")
            for doc_id, text in zip(batch.column(0), batch.column(1)):
                packed = enc.encode(text.as_py()) + end
                out.write(packed)
                sizes.append(len(packed) // width)
                nulls += not doc_id.is_valid
                ids.append(doc_id.as_py() or 0)
        if out is None:
            return
        out.close()
        offsets = np.concatenate([[0], np.cumsum(sizes)])
        with fs.open_output_stream(f"{name}.idx.{mine}") as f:
            f.write(np.concatenate([[len(sizes), nulls], offsets, ids]).astype("<i8").tobytes())
        for kind in ("bin", "idx"):
            fs.move(f"{name}.{kind}.{mine}", f"{name}.{kind}")
        yield pa.RecordBatch.from_pydict({"shard": [shard], "n_docs": [len(sizes)], "n_tokens": [int(offsets[-1])]})

    ordered = docs.select(F.col(key).cast("long").alias("id"), F.col(text_col).alias("text"))
    # rows of one id, however many, may be dealt to several neighbouring shards
    ordered = (ordered.withColumn("tie", F.xxhash64("text")).withColumn("row", F.monotonically_increasing_id())
               .repartitionByRange("id", "tie", "row").sortWithinPartitions("id", "tie", "row").select("id", "text"))
    spark = docs.sparkSession
    ordered.mapInArrow(run, _SHARD).write.parquet(f"{out_dir}/shards")
    # one row per shard: the prefix sum is over their totals only
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    shards = spark.read.schema(_SHARD).parquet(f"{out_dir}/shards")
    shards.withColumn("base", F.coalesce(F.sum("n_tokens").over(before), F.lit(0))).write.parquet(f"{out_dir}/manifest")
    return read_manifest(spark, out_dir)


def read_manifest(spark: SparkSession, out_dir: str) -> DataFrame:
    return spark.read.schema(_SHARD + ", base long").parquet(f"{out_dir}/manifest")


def read_token_files(spark: SparkSession, out_dir: str, vocabulary: int, part_ids: int = 1 << 20) -> DataFrame:
    """Read the files back: ``(doc_id, start, n_tokens, ids)`` per document, ids
    as little-endian unsigned 32-bit integers. Local and mounted files are
    memory-mapped; other stores are read through one stream."""
    dtype = np.dtype("<u2" if vocabulary <= 1 << 16 else "<u4")

    def run(batches):
        fs, root = filesystem(out_dir)
        for batch in batches:
            for row in batch.to_pylist():
                name = f"{root}/shard-{row['shard']:06d}"
                if fs.type_name == "local":
                    index = np.memmap(f"{name}.idx", "<i8", "r")
                    flat = np.memmap(f"{name}.bin", dtype, "r")
                else:
                    with fs.open_input_file(f"{name}.idx") as f, fs.open_input_file(f"{name}.bin") as g:
                        index, flat = np.frombuffer(f.read(), "<i8"), np.frombuffer(g.read(), dtype)
                n, nulls = int(index[0]), int(index[1])
                offsets, doc_ids = index[2:n + 3], index[n + 3:]
                at = 0
                while at < n:
                    to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + part_ids, "right")) - 1)
                    sizes = np.diff(offsets[at:to + 1])
                    ids = flat[offsets[at]:offsets[to]].astype("<u4").tobytes()
                    cut = (offsets[at:to + 1] - offsets[at]) * 4
                    yield pa.RecordBatch.from_arrays([
                        pa.array(doc_ids[at:to], pa.int64(), mask=np.arange(at, to) < nulls),
                        pa.array(offsets[at:to] + row["base"], pa.int64()),
                        pa.array(sizes, pa.int64()),
                        pa.array([ids[a:b] for a, b in zip(cut[:-1], cut[1:])], pa.binary()),
                    ], ["doc_id", "start", "n_tokens", "ids"])
                    at = to

    manifest = read_manifest(spark, out_dir)
    # one task per shard: the rows are few, the files behind them are not
    return (manifest.repartition(max(1, manifest.count())).select("shard", "base")
            .mapInArrow(run, "doc_id long, start long, n_tokens long, ids binary"))


__all__ = ["WordEncoder", "encoder", "write_token_files", "read_manifest", "read_token_files"]
