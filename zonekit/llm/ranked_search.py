"""Ranked lexical search (op11): sharded inverted index, Block-Max MaxScore.

Terms are maximal runs of ASCII letters and digits and of all characters beyond
ASCII, with only A-Z lower-cased. N documents hold a term, L terms in all, n in one
document; a term's weight is ``w = floor(1000 * ln((2N + 2) / (2df + 1)))``, a document's
norm ``m = 75 + (25 * n * N) div L``, and a query's score the sum, over its terms with
repeats, of ``w * ((10^9 * tf) div (1000 * tf + 12 * m))``.

*Index.* Every task cuts its rows into shards (bounded in bytes and rows), each in
ascending id order. A term's postings in a shard are blocks of 128: gaps of document numbers and
term frequencies, each in as few bytes (1, 2 or 4) as its block needs. What bounds a
block without reading it are its undominated pairs (tf, n): the impact grows with tf and falls
with n, so the bound holds for whatever N and L turn out to be. No shuffle; terms are compared
as strings, not hashes.

*Search.* Queries go in blocks of bounded size; a query term's posting lists meet the
block's uses of it in a join, and one task answers a block of queries on one shard. Lists are
ordered by their global bounds; those whose bounds together cannot lift a document above the
k-th best score so far are non-essential. Windows of documents are scored on the essential lists; on
the others, from the largest bound down, block maxima reject candidates before the block
is decompressed. The shards' heaps are merged in two steps. Scores are exact
integers, equal ones go by ascending id, so the result does not depend on the sharding.

Edge cases: a null or empty text, or one without terms, is in no result and not in N; a query without
terms, or whose terms all weigh 0, has no result; every query row is ranked on its own, also under
an equal id; repeated document rows are ranked each; null document ids come last among equals;
empty tables give no rows; other columns are ignored.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from zonekit.llm.common import scratch, stored
from zonekit.llm.textscan import LOWER, slices, text_bytes

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
BLOCK = 128
#: a shard ends at so many text bytes or rows
SHARD_BYTES = 16 << 20
SHARD_ROWS = 1 << 15
#: documents scored at a time
WINDOW = 1 << 12
#: queries answered by a task at a time
QUERY_BLOCK = 256
#: shards whose heaps are merged first
MERGE = 1024
_NO_ID = np.iinfo(np.int64).max
_INDEX = ("shard long, term string, n_docs long, last array<int>, at array<int>, doc_width array<tinyint>, tf_width array<tinyint>, "
          "bound_at array<int>, bound_tf array<int>, bound_n array<int>, data binary, ids binary, lengths binary, n_terms long")
_FOUND = "shard long, query long, doc_id long, missing boolean, score long"

IN_TERM = np.zeros(256, bool)
IN_TERM[128:] = True
for _first, _last in ((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A)):
    IN_TERM[_first:_last + 1] = True


def terms(column) -> tuple[pa.Array, np.ndarray]:
    """(all terms of a text column in order, as a string array; the row of each)."""
    data, offsets = text_bytes(column)
    inside = IN_TERM[data]
    begin = inside.copy()
    begin[1:] &= ~inside[:-1]
    row_starts = offsets[:-1][offsets[:-1] < len(data)]
    begin[row_starts] = inside[row_starts]
    starts = np.flatnonzero(begin)
    kept = LOWER[data[inside]]
    ends = np.append(np.cumsum(inside)[starts] - 1, len(kept)) if len(starts) else np.zeros(1, np.int64)
    found = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(kept))
    return found, np.searchsorted(offsets, starts, "right") - 1


def _width(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Bytes (1, 2 or 4) that the largest value of each block needs."""
    top = np.maximum.reduceat(values, starts)
    return np.where(top < 1 << 8, 1, np.where(top < 1 << 16, 2, 4))


def _put(out: np.ndarray, places: np.ndarray, values: np.ndarray, widths: np.ndarray) -> None:
    for k in range(4):
        use = widths > k
        out[places[use] + k] = (values[use] >> (8 * k)) & 255


def _lists(values: np.ndarray, cuts: np.ndarray, kind) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(values, kind))


class _Shard:
    """Rows of one shard until it is written."""

    def __init__(self):
        self.ids, self.lengths, self.found, self.rows, self.bytes = [], [], [], [], 0

    def add(self, ids: np.ndarray, texts) -> None:
        found, rows = terms(texts)
        base = sum(map(len, self.ids))
        self.ids.append(ids)
        self.lengths.append(np.bincount(rows, minlength=len(ids)))
        encoded = found.dictionary_encode()
        # each term of a row once, with its count
        key, counts = np.unique(rows * np.int64(max(1, len(encoded.dictionary))) + encoded.indices.to_numpy(), return_counts=True)
        row, code = np.divmod(key, np.int64(max(1, len(encoded.dictionary))))
        self.found.append((encoded.dictionary, code, counts))
        self.rows.append(row + base)

    def batches(self, shard: int) -> list[pa.RecordBatch]:
        ids, lengths = np.concatenate(self.ids), np.concatenate(self.lengths)
        order = np.argsort(ids, kind="stable")
        place = np.empty(len(ids), np.int64)
        place[order] = np.arange(len(ids))
        ids, lengths = ids[order], lengths[order]
        whole = pa.chunked_array([d for d, _, _ in self.found]).combine_chunks().dictionary_encode()
        code_of = whole.indices.to_numpy()
        cut = np.cumsum([0, *(len(d) for d, _, _ in self.found)])
        code = np.concatenate([code_of[a:b][c] for a, b, (_, c, _) in zip(cut[:-1], cut[1:], self.found)]).astype(np.int64)
        doc = place[np.concatenate(self.rows)]
        tf = np.concatenate([n for _, _, n in self.found])
        order = np.argsort(code * len(ids) + doc)
        code, doc, tf = code[order], doc[order], tf[order]
        schema = pa.schema([("shard", pa.int64()), ("term", pa.string()), ("n_docs", pa.int64()), ("last", pa.list_(pa.int32())), ("at", pa.list_(pa.int32())),
                            ("doc_width", pa.list_(pa.int8())), ("tf_width", pa.list_(pa.int8())), ("bound_at", pa.list_(pa.int32())),
                            ("bound_tf", pa.list_(pa.int32())), ("bound_n", pa.list_(pa.int32())), ("data", pa.binary()), ("ids", pa.binary()),
                            ("lengths", pa.binary()), ("n_terms", pa.int64())])
        head = pa.RecordBatch.from_pylist([{"shard": shard, "term": "", "n_docs": int((lengths > 0).sum()), "n_terms": int(lengths.sum()),
                                            "ids": ids.astype("<i8").tobytes(), "lengths": lengths.astype("<i8").tobytes()}], schema)
        if not len(code):
            return [head]
        n_terms = len(whole.dictionary)
        first = np.searchsorted(code, np.arange(n_terms + 1))
        # blocks: every 128th posting of a list starts one
        within = np.arange(len(code)) - first[code]
        block_start = np.flatnonzero(within % BLOCK == 0)
        block_end = np.append(block_start[1:], len(code))
        block_of = np.cumsum(within % BLOCK == 0) - 1
        gap = doc.copy()
        gap[1:] -= doc[:-1]
        gap[block_start] = doc[block_start]
        doc_width, tf_width = _width(gap, block_start), _width(tf, block_start)
        sizes = (block_end - block_start) * (doc_width + tf_width)
        at = np.concatenate([[0], np.cumsum(sizes)])
        out = np.zeros(at[-1], np.uint8)
        inside = np.arange(len(code)) - block_start[block_of]
        _put(out, at[block_of] + inside * doc_width[block_of], gap, doc_width[block_of])
        tf_at = at[:-1] + (block_end - block_start) * doc_width
        _put(out, tf_at[block_of] + inside * tf_width[block_of], tf, tf_width[block_of])
        # undominated (tf, n) of each block: by ascending n, those with a larger tf than any before
        n = lengths[doc]
        order = np.lexsort((-tf, n, block_of))
        high = block_of * (np.int64(1) << 32) + tf[order]  # block_of is sorted, and so is block_of[order]
        best = np.maximum.accumulate(high)
        keep = np.append(True, best[1:] > best[:-1])
        bound_tf, bound_n = tf[order][keep], n[order][keep]
        bound_cut = np.searchsorted(block_of[keep], np.arange(len(block_start) + 1))
        # per term: cuts in blocks, in bounds and in bytes
        blocks = np.searchsorted(code[block_start], np.arange(n_terms + 1))
        data_cut = at[blocks]
        term_block = blocks[:-1]
        owner = code[block_start]
        parts = pa.RecordBatch.from_arrays([
            pa.array(np.full(n_terms, shard), pa.int64()), whole.dictionary.cast(pa.string()), pa.array(np.diff(first), pa.int64()),
            _lists(doc[block_end - 1], blocks, pa.int32()), _lists(at[:-1] - data_cut[:-1][owner], blocks, pa.int32()),
            _lists(doc_width, blocks, pa.int8()), _lists(tf_width, blocks, pa.int8()),
            _lists(bound_cut[:-1] - bound_cut[term_block][owner], blocks, pa.int32()),
            _lists(bound_tf, bound_cut[blocks], pa.int32()), _lists(bound_n, bound_cut[blocks], pa.int32()),
            pa.Array.from_buffers(pa.large_binary(), n_terms, [None, pa.py_buffer(data_cut.astype(np.int64)), pa.py_buffer(out)]).cast(pa.binary()),
            pa.nulls(n_terms, pa.binary()), pa.nulls(n_terms, pa.binary()), pa.nulls(n_terms, pa.int64())], schema=schema)
        return [head, *(parts.slice(i, 1 << 13) for i in range(0, n_terms, 1 << 13))]


def build_index(docs: DataFrame, path: str, key: str = "doc_id", text_col: str = "text",
                shard_bytes: int = SHARD_BYTES, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """Write the index of all rows as a table and read it back: a row per shard and term,
    and one with the empty term for the shard's document ids and lengths."""

    def run(batches):
        shard = _Shard()
        made = TaskContext.get().partitionId() << 32
        for batch in batches:
            for part in slices(batch, "text", 1 << 20):
                while part.num_rows:
                    rows = min(part.num_rows, shard_rows - sum(map(len, shard.ids)))
                    own, part = part.slice(0, rows), part.slice(rows)
                    ids = own.column("key")
                    shard.add(np.where(ids.is_null().to_numpy(zero_copy_only=False), _NO_ID, ids.fill_null(0).to_numpy()), own.column("text"))
                    shard.bytes += own.column("text").nbytes
                    if shard.bytes >= shard_bytes or sum(map(len, shard.ids)) >= shard_rows:
                        yield from shard.batches(made)
                        shard, made = _Shard(), made + 1
        if shard.ids:
            yield from shard.batches(made)

    rows = docs.select(F.col(key).cast("long").alias("key"), F.col(text_col).cast("string").alias("text"))
    rows.mapInArrow(run, _INDEX).write.parquet(path)
    return read_index(docs.sparkSession, path)


def read_index(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(_INDEX).parquet(path)


def query_terms(queries: DataFrame, text_col: str = "text") -> DataFrame:
    """``(query, term, times)``: a query's terms, split as the index splits texts; native."""
    folded = F.translate(F.col(text_col).cast("string"), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    found = queries.select("query", F.explode(F.regexp_extract_all(folded, F.lit(TERM), 0)).alias("term"))
    return found.groupBy("query", "term").agg(F.count("*").alias("times"))


class _List:
    """One term's postings in a shard; blocks are decompressed when asked for."""

    def __init__(self, row: dict, norms: np.ndarray, lengths_to_norm):
        self.row, self.norms = row, norms
        self.last = np.asarray(row["last"], np.int64)
        self.n = row["n_docs"]
        self.docs, self.values = np.empty(self.n, np.int64), np.empty(self.n, np.int64)
        self.done = np.zeros(len(self.last), bool)
        bounds = impact(np.asarray(row["bound_tf"], np.int64), lengths_to_norm(np.asarray(row["bound_n"], np.int64)))
        self.block_max = np.maximum.reduceat(bounds, np.asarray(row["bound_at"], np.int64))
        self.max = int(self.block_max.max())

    def read(self, blocks) -> None:
        row = self.row
        for b in blocks:
            if self.done[b]:
                continue
            a, z = b * BLOCK, min((b + 1) * BLOCK, self.n)
            dw, tw, at = row["doc_width"][b], row["tf_width"][b], row["at"][b]
            gaps = np.frombuffer(row["data"], f"<u{dw}", z - a, at)
            tf = np.frombuffer(row["data"], f"<u{tw}", z - a, at + (z - a) * dw).astype(np.int64)
            docs = np.cumsum(gaps, dtype=np.int64)
            self.docs[a:z], self.values[a:z] = docs, impact(tf, self.norms[docs])
            self.done[b] = True

    def between(self, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
        """(documents, impacts) of the postings from document ``low`` up to ``high``, exclusive."""
        first, last = np.searchsorted(self.last, (low, high))
        self.read(range(first, min(last + 1, len(self.last))))
        a, z = first * BLOCK, min((last + 1) * BLOCK, self.n)
        x, y = a + np.searchsorted(self.docs[a:z], (low, high))
        return self.docs[x:y], self.values[x:y]


def impact(tf: np.ndarray, norm: np.ndarray) -> np.ndarray:
    return (1_000_000_000 * tf) // (1000 * tf + 12 * norm)


def _best(docs: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k highest scores; of equal ones, the first documents."""
    order = np.lexsort((docs, -scores))[:k]
    return docs[order], scores[order]


def search_shard(lists: list[tuple[int, _List]], n_docs: int, k: int, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """The k best documents of a shard (numbers ascend with ids) for lists with weights."""
    lists = sorted(((w, p) for w, p in lists if w > 0), key=lambda x: x[0] * x[1].max)
    bounds = np.cumsum([w * p.max for w, p in lists])
    top_docs, top_scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
    for low in range(0, n_docs, window):
        high = min(low + window, n_docs)
        # a document counts only with more than this: of equal scores the earlier document stays
        least = int(top_scores[-1]) if len(top_scores) == k else 0
        essential = int(np.searchsorted(bounds, least, "right"))
        if essential == len(lists):
            break
        scores = np.zeros(high - low, np.int64)
        for w, p in lists[essential:]:
            docs, values = p.between(low, high)
            scores[docs - low] += w * values
        found = np.flatnonzero(scores > 0)
        total = scores[found]
        for i in range(essential - 1, -1, -1):
            alive = total + bounds[i] > least
            found, total = found[alive], total[alive]
            if not len(found):
                break
            w, p = lists[i]
            docs = found + low
            block = np.searchsorted(p.last, docs)
            inside = block < len(p.last)
            rest = int(bounds[i - 1]) if i else 0
            most = np.where(inside, w * p.block_max[np.minimum(block, len(p.last) - 1)], 0)
            alive = total + most + rest > least
            found, total, docs, block, inside = found[alive], total[alive], docs[alive], block[alive], inside[alive]
            p.read(np.unique(block[inside]))
            docs, block = docs[inside], block[inside]
            gain = np.zeros(len(found), np.int64)
            hit = np.zeros(len(docs), np.int64)
            for b in np.unique(block):
                own = block == b
                a, z = b * BLOCK, min((b + 1) * BLOCK, p.n)
                at = np.minimum(np.searchsorted(p.docs[a:z], docs[own]), z - a - 1)
                hit[own] = np.where(p.docs[a:z][at] == docs[own], p.values[a:z][at], 0)
            gain[inside] = w * hit
            total = total + gain
        better = total > least
        if better.any():
            top_docs, top_scores = _best(np.append(top_docs, found[better] + low), np.append(top_scores, total[better]), k)
    return top_docs, top_scores


def search(index: DataFrame, queries: DataFrame, k: int = 20, query_col: str = "item_id", text_col: str = "text",
           query_block: int = QUERY_BLOCK, window: int = WINDOW) -> DataFrame:
    """``(query_col, rank, doc_id, score)``: each query's k best documents."""
    spark = index.sparkSession
    # one row: document and term counts of all shards
    stats = index.where("term = ''").agg(F.sum("n_docs"), F.sum("n_terms")).first()
    n_all, l_all = int(stats[0] or 0), int(stats[1] or 0)
    rows = stored(queries.select(F.col(query_col).alias("__id"), F.col(text_col).alias("__text"))
                  .withColumn("query", F.monotonically_increasing_id()), "search-queries")
    n_blocks = max(1, -(-rows.count() // query_block))
    asked = stored(query_terms(rows, "__text"), "search-terms")
    wanted = asked.select("term").distinct()
    df = index.join(wanted, "term", "left_semi").groupBy("term").agg(F.sum("n_docs").alias("df"))
    weight = F.floor(1000 * F.log((F.lit(2 * n_all + 2) / (2 * F.col("df") + 1)).cast("double"))).cast("long")
    uses = (asked.join(df, "term").withColumn("w", F.col("times") * weight).where("w > 0")
            .withColumn("block", F.pmod(F.xxhash64("query"), F.lit(n_blocks)))
            .groupBy("block", "term").agg(F.collect_list(F.struct("query", "w")).alias("uses")))
    # the documents' row of every shard goes to every block of queries
    ids = uses.select("block").distinct().select("block", F.lit("").alias("term"), F.lit(None).cast("array<struct<query:bigint,w:bigint>>").alias("uses"))
    uses = stored(uses.unionByName(ids), "search-uses")

    def run(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        docs = next(r for r in rows if not r["term"])
        ids, lengths = np.frombuffer(docs["ids"], "<i8"), np.frombuffer(docs["lengths"], "<i8")
        norm = lambda n: 75 + (25 * n * n_all) // l_all
        norms = norm(lengths)
        by_query = defaultdict(list)
        for row in rows:
            if row["term"]:
                postings = _List(row, norms, norm)
                for use in row["uses"]:
                    by_query[use["query"]].append((use["w"], postings))
        out = [(q, *search_shard(lists, len(ids), k, window)) for q, lists in sorted(by_query.items())]
        found = np.concatenate([d for _, d, _ in out]) if out else np.zeros(0, np.int64)
        asked = np.repeat([q for q, _, _ in out], [len(d) for _, d, _ in out]).astype(np.int64)
        own = ids[found]
        return pa.Table.from_arrays([pa.array(np.full(len(found), docs["shard"]), pa.int64()), pa.array(asked, pa.int64()),
                                     pa.array(own, pa.int64(), mask=own == _NO_ID), pa.array(own == _NO_ID),
                                     pa.array(np.concatenate([s for _, _, s in out]) if out else [], pa.int64())],
                                    names=["shard", "query", "doc_id", "missing", "score"])

    heaps = index.join(uses, "term").groupBy("shard", "block").applyInArrow(run, _FOUND)
    first = F.row_number().over(Window.partitionBy("query", "group").orderBy(F.desc("score"), "missing", "doc_id"))
    merged = heaps.withColumn("group", F.pmod(F.xxhash64("shard"), F.lit(MERGE))).withColumn("rank", first).where(F.col("rank") <= k)
    rank = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "missing", "doc_id"))
    best = merged.withColumn("rank", rank).where(F.col("rank") <= k)
    return best.join(rows, "query").select(F.col("__id").alias(query_col), F.col("rank").cast("int").alias("rank"), "doc_id", "score")


def ranked_search(docs: DataFrame, queries: DataFrame, k: int = 20) -> DataFrame:
    """Index all documents and search: ``(item_id, rank, doc_id, score)``."""
    return search(build_index(docs, scratch(docs.sparkSession, "search-index")), queries, k)


__all__ = ["terms", "build_index", "read_index", "query_terms", "search_shard", "search", "ranked_search", "impact", "TERM"]
