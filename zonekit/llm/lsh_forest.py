"""Approximate nearest neighbours by a hash-prefix forest (op10).

Each row gets, per tree, a long hash string: symbols of random rotations, each the
coordinate of largest size and its sign (cross-polytope hashing: two unit vectors of
cosine 0.4 in 64 dimensions share one with a chance of 0.06, random ones of 0.008). A tree reads
a rotation of its own, then those of its neighbours, and is the sorted array of its rows' strings. A query
descends every tree to its longest-prefix matches, then all trees ascend together: first to fewer
trees that must agree, then to prefixes one symbol shorter, so that ever more rows become
candidates. The ascent stops by what has been
found: with the k-th best score so far, a row as good is found by a binomial number of the
trees at prefix length d, with the chance p^d each; p, the chance that it shares a
symbol, is tabulated by angle from random pairs. When fewer trees than must agree are as likely as ``miss``
or less, the search is done. Length 0 is every
row, so hard data cost more but nothing is cut off; there is no cap on
candidates. Measured recall is in the README.

Largest inner products become largest cosines by one more component that fills every
row up to its block's largest norm. Scores are summed in double precision
over the original vectors, row by row, so equal vectors score equally; equal vectors of a
block are one entry of its forest.

Scale: rows are dealt into blocks, and a task builds its blocks' forests once and answers
queries as they stream by; the blocks' best k are merged per query. Nothing is
fitted (rotations are fixed by a seed). Memory is bounded by a block and ``QUERY_ROWS`` queries. Every query
visits every block: hashing and sorting grow with the rows, looking at candidates (a few
in a hundred of a block on uniform data, fewer on clustered) with rows times queries.

Edge cases: rows with a null id or vector, a zero vector or components that are null or not
finite take no part; vectors are compared with those of their own length;
rows with equal ids are separate rows (a query skips only itself); with fewer
candidates than k all are returned.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from zonekit.llm.common import stored

TREES = 192
#: bits of a string
BITS = 21
MISS = 0.05
BLOCK_ROWS = 1 << 15
#: queries answered together
QUERY_ROWS = 256
SEED = 11
_TABLES: dict = {}


def rotations(dims: int, n: int, seed: int) -> np.ndarray:
    rng = np.random.default_rng([seed, dims])
    return np.stack([np.linalg.qr(rng.standard_normal((dims, dims)))[0] for _ in range(n)])


def symbols(points: np.ndarray, turned: np.ndarray) -> np.ndarray:
    """[rotation, point]: twice the coordinate of largest size, and one more if it is positive."""
    out = np.empty((len(turned), len(points)), np.int64)
    for r, rotation in enumerate(turned):
        for a in range(0, len(points), 4096):
            y = points[a:a + 4096] @ rotation
            at = np.abs(y).argmax(axis=1)
            out[r, a:a + 4096] = 2 * at + (y[np.arange(len(y)), at] > 0)
    return out


def agreement(dims: int, turned: np.ndarray, pairs: int = 400, steps: int = 41) -> np.ndarray:
    """Chance that two unit vectors share a symbol, for angles from 0 to pi in even steps (never rising)."""
    rng = np.random.default_rng(dims)
    a, b = rng.standard_normal((2, pairs, dims))
    a /= np.linalg.norm(a, axis=1)[:, None]
    b -= (a * b).sum(axis=1)[:, None] * a
    b /= np.maximum(np.linalg.norm(b, axis=1), 1e-300)[:, None]
    turned = turned[:48]
    own = symbols(a, turned)
    shares = [(own == symbols(np.cos(t) * a + np.sin(t) * b, turned)).mean() for t in np.linspace(0, np.pi, steps)]
    return np.minimum.accumulate(shares)


def _tables(dims: int, trees: int, seed: int):
    if (dims, trees, seed) not in _TABLES:
        turned = rotations(dims, trees, seed)
        _TABLES[dims, trees, seed] = turned.astype(np.float32), agreement(dims, turned)
    return _TABLES[dims, trees, seed]


class Forest:
    """Sorted arrays of hash strings over the different vectors of one block (double precision).
    ``ids`` and ``rows`` (numbers of their own) belong to the vectors."""

    def __init__(self, vectors: np.ndarray, ids: np.ndarray, rows: np.ndarray, trees: int = TREES, seed: int = SEED):
        order = np.lexsort((rows, ids))
        unique, place = np.unique(np.ascontiguousarray(vectors[order]).view([("", "V%d" % vectors[:1].nbytes)]).ravel(), return_index=True, return_inverse=True)[1:]
        self.vectors = vectors[order][unique]
        by_vector = np.argsort(place, kind="stable")
        self.ids, self.rows = ids[order][by_vector], rows[order][by_vector]  # ascending ids within a vector
        self.first = np.searchsorted(place[by_vector], np.arange(len(unique) + 1))
        self.place_of = dict(zip(self.rows.tolist(), place[by_vector].tolist()))
        norms = np.sqrt((self.vectors * self.vectors).sum(axis=1))
        self.largest = norms.max()
        filled = self.vectors / self.largest
        filled = np.column_stack([filled, np.sqrt(np.maximum(0.0, 1.0 - (norms / self.largest) ** 2))])
        dims = filled.shape[1]
        self.turned, self.agree = _tables(dims, trees, seed)
        self.width = max(1, int(2 * dims - 1).bit_length())
        self.depth = max(2, BITS // self.width)
        self.sequences = (np.arange(trees)[:, None] + np.arange(self.depth)) % trees
        own = symbols(filled.astype(np.float32), self.turned)
        kind = np.int32 if self.depth * self.width < 31 else np.int64
        self.order = np.empty((trees, len(filled)), np.int32)
        self.strings = np.empty((trees, len(filled)), kind)
        for t, sequence in enumerate(self.sequences):
            strings = self._strings(own, sequence).astype(kind)
            self.order[t] = np.argsort(strings, kind="stable")
            self.strings[t] = strings[self.order[t]]

    def _strings(self, own: np.ndarray, sequence: np.ndarray) -> np.ndarray:
        out = np.zeros(own.shape[1], np.int64)
        for r in sequence:
            out = (out << self.width) | own[r]
        return out

    def ranges(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """[depth + 1, query, tree]: where the vectors lie that share a prefix of that length."""
        norms = np.sqrt((queries * queries).sum(axis=1))
        own = symbols(np.column_stack([queries / norms[:, None], np.zeros(len(queries))]).astype(np.float32), self.turned)
        low = np.zeros((self.depth + 1, len(queries), len(self.order)), np.int32)
        high = np.full(low.shape, len(self.vectors), np.int32)
        for t, sequence in enumerate(self.sequences):
            string = self._strings(own, sequence)
            for d in range(1, self.depth + 1):
                rest = (self.depth - d) * self.width
                prefix = string >> rest << rest
                low[d, :, t] = np.searchsorted(self.strings[t], prefix.astype(self.strings.dtype), "left")
                high[d, :, t] = np.searchsorted(self.strings[t], (prefix + (1 << rest) - 1).astype(self.strings.dtype), "right")
        return low, high

    def must_agree(self, score: float, norm: float, length: int, miss: float) -> int:
        """How many trees may be asked to agree on a prefix of this length, if a row with this score is to be
        missed with probability ``miss`` at most; 0 if one is too many."""
        cosine = float(np.clip(score / (self.largest * norm), -1.0, 1.0))
        p = float(np.interp(np.arccos(cosine), np.linspace(0, np.pi, len(self.agree)), self.agree)) ** length
        trees = len(self.order)
        if p >= 1.0:
            return trees
        fewer, term, votes = 0.0, (1.0 - p) ** trees, 0
        while votes < trees and fewer + term <= miss:  # term: exactly that many trees agree
            fewer += term
            votes += 1
            term *= (trees - votes + 1) / votes * p / (1.0 - p)
        return votes

    def search(self, queries: np.ndarray, query_rows: np.ndarray, k: int, miss: float = MISS):
        """Per query: (ids, scores) of the best k found, best first, ties to the
        smaller id; ``query_rows`` are the queries' own row numbers, which are left out."""
        low, high = self.ranges(queries)
        counts = np.diff(self.first)
        for i, query in enumerate(queries):
            norm = np.sqrt((query * query).sum())
            own = self.place_of.get(int(query_rows[i]), -1)
            others = counts.copy() if own >= 0 else counts
            if own >= 0:
                others[own] -= 1
            kth = None  # the k-th best score so far
            for length in range(self.depth, -1, -1):
                if length == 0:
                    found, votes = np.arange(len(self.vectors)), 0
                else:
                    matched = [self.order[t, a:b] for t, (a, b) in enumerate(zip(low[length, i].tolist(), high[length, i].tolist())) if a < b]
                    agreed = np.bincount(np.concatenate(matched), minlength=len(self.vectors)) if matched else np.zeros(len(self.vectors), np.int64)
                    # rows by how many trees agree: at first as many trees as still give k rows
                    by_votes = np.cumsum(np.bincount(agreed, others, len(self.order) + 1)[::-1])[::-1]
                    votes = int(np.flatnonzero(by_votes >= k)[-1]) if by_votes[0] >= k else 0
                    if kth is not None:
                        votes = min(votes, self.must_agree(kth, norm, length, miss))
                while True:
                    if length:
                        if not votes:
                            break
                        found = np.flatnonzero(agreed >= votes)
                    scores = self.vectors[found] @ query
                    # the k-th best row lies among the k + 1 best vectors (the query's own may have no other row)
                    best = np.argpartition(-scores, k)[:k + 1] if len(scores) > k + 1 else np.arange(len(scores))
                    best = best[np.argsort(-scores[best])]
                    last = min(int(np.searchsorted(np.cumsum(others[found[best]]), k)), len(best) - 1)
                    kth = float(scores[best[last]])
                    to = self.must_agree(kth, norm, length, miss) if length else 0
                    if to >= votes:
                        break
                    votes = to
                if votes or not length:
                    break
            # vectors as good as the last, each with the k + 1 smallest ids that hold it
            good = found[scores >= kth - 1e-9 * self.largest * norm]
            value = (self.vectors[good] * query).sum(axis=1)
            take = np.minimum(counts[good], k + 1)
            at = np.repeat(self.first[good] - np.cumsum(take) + take, take) + np.arange(take.sum())
            keep = self.rows[at] != query_rows[i]
            ids, value = self.ids[at][keep], np.repeat(value, take)[keep]
            ranked = np.lexsort((ids, -value))[:k]
            yield ids[ranked], value[ranked]


def usable(vector: Column) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0)


_FOUND = "query_row long, query_id long, vec_id long, score double"


def nearest(rows: DataFrame, is_query: Column, k: int = 20, key: str = "vec_id", vector_col: str = "embedding",
            trees: int = TREES, miss: float = MISS, block_rows: int = BLOCK_ROWS,
            query_rows: int = QUERY_ROWS) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: for each row where ``is_query``, the k nearest found among the other rows."""
    vector = F.col(vector_col).cast("array<double>")
    table = rows.select(F.col(key).cast("long").alias("id"), vector.alias("vector"), F.coalesce(is_query, F.lit(False)).alias("asks"))
    table = table.where(F.col("id").isNotNull() & usable(F.col("vector"))).withColumn("dims", F.size("vector"))
    table = stored(table.withColumn("row", F.monotonically_increasing_id()), "forest-rows")
    blocks = max(1, -(-table.count() // block_rows))
    dealt = F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int")
    data = table.select("dims", dealt.alias("block"), F.lit(0).alias("kind"), "row", "id", "vector")
    asking = table.where("asks").select("dims", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), F.lit(1).alias("kind"), "row", "id", "vector")

    def answers(forest: Forest, held: list, dims: int) -> pa.RecordBatch:
        own, ids, vectors = (np.concatenate(x) for x in zip(*held))
        out = [(np.full(len(found), row), np.full(len(found), q), found, scores)
               for row, q, (found, scores) in zip(own, ids, forest.search(vectors.reshape(-1, dims), own, k, miss))]
        columns = [np.concatenate(c) for c in zip(*out)]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.int64(), pa.float64()))],
                                          names=["query_row", "query_id", "vec_id", "score"])

    def run(batches):
        at, forest, data, asked = None, None, [], []
        for batch in batches:
            keys = np.stack([batch.column(c).to_numpy() for c in ("dims", "block", "kind")])
            cuts = [0, *(np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1).tolist(), batch.num_rows]
            for a, b in zip(cuts[:-1], cuts[1:]):
                if a == b:
                    continue
                dims, block, kind = keys[:, a].tolist()
                if at != (dims, block):  # what is asked of a block that ends is answered first
                    if asked:
                        yield answers(forest, asked, at[0])
                    at, forest, data, asked = (dims, block), None, [], []
                for c in range(a, b, query_rows if kind else b - a):
                    part = batch.slice(c, min(b - c, query_rows) if kind else b - c)
                    own = (part.column("row").to_numpy(), part.column("id").to_numpy(), part.column("vector").flatten().to_numpy())
                    if not kind:
                        data.append(own)
                        continue
                    if forest is None and data:
                        held, ids, vectors = (np.concatenate(x) for x in zip(*data))
                        forest, data = Forest(vectors.reshape(-1, dims), ids, held, trees), []
                    if forest is not None:  # a block without rows of this length has no answers
                        asked.append(own)
                    if sum(len(x[0]) for x in asked) >= query_rows:
                        yield answers(forest, asked, dims)
                        asked = []
        if asked:
            yield answers(forest, asked, at[0])

    # a task per block; a block's rows come before the queries
    streamed = data.union(asking).repartition(blocks, "dims", "block").sortWithinPartitions("dims", "block", "kind")
    found = streamed.mapInArrow(run, _FOUND)
    best = Window.partitionBy("query_row").orderBy(F.col("score").desc(), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


__all__ = ["Forest", "nearest", "usable", "agreement", "TREES", "MISS"]
