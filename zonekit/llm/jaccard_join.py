"""N-gram Jaccard join (op5): exact links between word-shingle sets of similarity
``percent`` / 100 or more, and their components.

1. Every text becomes its set of distinct shingles (64-bit hashes). Equal sets
   are one class with one representative; copies are never compared.
2. Shingles are put in one order for all: by how frequent their words are (from a
   bounded list of counted words, others as the rarest), those that many different sets of
   a batch hold last (a bounded list too), then by hash. Two sets that
   reach the similarity share a shingle among the first n - ceil(t * n) + 1 of each,
   whatever the order is, so only these are joined on; and the smaller set's shared one is among its
   first n - ceil(2t / (1 + t) * n) + 1, so a larger set's later ones only meet those. Rare first, unrelated texts
   hardly ever meet, shared passages included; the lists' bounds affect speed, never the result.
3. The sets that share such a shingle are cut by size into bands whose
   neighbours are within the similarity; each band's smallest set, its hub, is compared
   with the band (a star, not all pairs). Every set meets the hub that it shares most
   bands with first, and the other hubs only where that left them in different components.
4. Where that leaves a group in several components, the group is dealt into
   tiles of at most ``TILE`` sets (tile pairs, if it is larger), and sets of
   different components and fitting sizes are compared by hashed bitmaps: of
   the n shingles of a set, at least as many are not shared as it has bits
   that the other lacks, which bounds the overlap from above. In a first round a
   tile passes on only pairs that join components not joined in it before, so a
   large group of near copies gives a tree, not all pairs; so it does in a second, with longer bitmaps
   that hardly let unlinked pairs pass, over the members of the pairs that the first left out; in a third, the members
   of those that this did too pass on every pair of components that are still apart.
5. Pairs that are passed on, by tiles or by stars, whose bitmaps are compared as well, are verified on the
   sorted hash arrays, and linked sets become components.

No group is gathered whole, no pair table is more than stars and the pairs that
pass the bitmaps, and hashes of one task's documents leave it once per class. Texts never
move: bitmaps and arrays are made where the text is, arrays only of the sets in pairs that have passed
the bitmaps. To be compared, they move to their hub, whose own moves once for every ``HUB`` of them. Before
texts or sets meet a table of keys, a bitmap of the keys, of bounded size, leaves
most of those that have no partner where they are.
Equality of shingles, sets and rows is that of 64-bit digests (words beyond 256 bytes
go through xxHash, so that long structured words don't collide).

Edge cases: a text without words, or null, has an empty set and is linked with
nothing; fewer words than ``k`` make one shingle of the whole sequence;
repeated rows are copies; a document without id belongs to its class, whose
component is named by the smallest id in it (null if there is none). Input
columns other than id and text are not looked at.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonekit.llm.common import small_batches, stored
from zonekit.llm.components import components
from zonekit.llm.textscan import Words, mix, slices, slices_of_rows, text_bytes

#: sets compared with each other in one task at a time
TILE = 2048
#: words whose counts order the shingles
MAX_FREQUENT = 200_000
#: a word is listed from this many occurrences on among those counted together, a shingle from this many different sets on
_OFTEN = 8
_OFTEN_SHINGLE = 3
#: shingles of a task's different sets that are counted together, and words of its parts
_COUNTED = 1_000_000
_COUNTED_WORDS = 250_000
#: sets that are sent to one copy of their hub
HUB = 512
#: longest bitmap of keys (8 MB as words); beyond 16 bits a key, more rows without a partner move
KEY_BITS = 1 << 25
#: bits per shingle of the bitmaps of later rounds
FINE = 16
#: classes (rows, for sets) that a task remembers having sent
SENT = 1_000_000
#: text bytes that are hashed at a time: the arrays of hashes and shingles are many times as large
PART = 1 << 18


def shingle_sets(data: np.ndarray, offsets: np.ndarray, k: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    return _sets_of(Words(data, offsets, lower=True), k)


def _sets_of(words: Words, k: int) -> list[np.ndarray]:
    hashes = words.shingles(k)
    out = []
    for a, b in zip(words.bounds[:-1], words.bounds[1:]):
        if b - a >= k:
            out.append(np.unique(hashes[a:b - k + 1]))
        else:  # the number of words keeps short sequences apart
            whole = np.full(min(1, b - a), b - a, np.uint64)
            for h in words.hash[a:b]:
                whole = mix(whole * np.uint64(0x9E3779B97F4A7C15) + h)
            out.append(whole)
    return out


def class_of(grams: np.ndarray) -> int:
    """Signed 64-bit digest of a set; 0 for the empty set."""
    return int(np.array([xxhash.xxh3_64_intdigest(grams.tobytes())], np.uint64).view(np.int64)[0]) if len(grams) else 0


def least_overlap(n: int | np.ndarray, percent: int):
    """How many of its n shingles a set must share with a set of its own size or more."""
    return -(-n * percent // 100)


def bitmap(grams: np.ndarray, per_shingle: int = 2) -> np.ndarray:
    """Hashed bitmap of that many bits or more per shingle, a power of two long."""
    bits = max(64, 1 << int(per_shingle * max(1, len(grams)) - 1).bit_length())
    out = np.zeros(bits // 8, np.uint8)
    at = grams & np.uint64(bits - 1)
    np.bitwise_or.at(out, (at >> np.uint64(3)).astype(np.int64), (np.uint8(1) << (at & np.uint64(7)).astype(np.uint8)))
    return out.view(np.uint64)


def folded(bits: np.ndarray, words: int) -> np.ndarray:
    """A longer bitmap as one of ``words`` 64-bit words."""
    return np.bitwise_or.reduce(bits.reshape(-1, words), axis=0)


def may_link(n_a, bits_a, n_b, bits_b, shared_bits, percent: int):
    """Whether the bound on the overlap allows the similarity."""
    most = np.minimum(n_a - (bits_a - shared_bits), n_b - (bits_b - shared_bits))
    return 100 * most >= percent * (n_a + n_b - most)


def _often(counted: list[tuple[np.ndarray, np.ndarray]], least: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, counts) of what lists of (hashes, counts) hold ``least`` times or more together."""
    known, place = np.unique(np.concatenate([h for h, _ in counted]), return_inverse=True)
    counts = np.bincount(place, np.concatenate([c for _, c in counted]), len(known)).astype(np.int64)
    return known[counts >= least], counts[counts >= least]


def _widely(sets: list[np.ndarray], least: int) -> tuple[np.ndarray, np.ndarray]:
    """(shingles, counts) of the shingles that ``least`` of the sets or more hold."""
    held = np.concatenate(sets)
    held.sort()
    # a shingle is found once less often than it is held, for each set but the first that it needs: no more arrays of all
    known, more = np.unique(held[least - 1:][held[least - 1:] == held[:max(0, len(held) - least + 1)]], return_counts=True)
    return known, more + (least - 1)


_DOCUMENT = "doc_id long, n long, e long, h long, heard long, times long, shingle boolean"


def _documents(docs: DataFrame, k: int) -> DataFrame:
    """Stored ``(doc_id, n, e, h)`` per document (heard is null), and ``(heard, times, shingle)`` of
    the words and shingles that a task's texts hold often, however Spark cuts these into batches."""

    def listed(hashes: np.ndarray, counts: np.ndarray, shingle: bool) -> pa.RecordBatch:
        m = len(hashes)
        return pa.RecordBatch.from_arrays([pa.nulls(m, pa.int64())] * 4 + [pa.array(hashes.view(np.int64)), pa.array(counts), pa.array([shingle] * m, pa.bool_())],
                                          ["doc_id", "n", "e", "h", "heard", "times", "shingle"])

    def run(batches):
        heard, listening, shingles, seen, size = [], 0, [], set(), 0
        for batch in batches:
            for part in slices(batch, "text", PART):
                words = Words(*text_bytes(part.column("text")), lower=True)
                sets = _sets_of(words, k)
                heard.append(np.unique(words.hash, return_counts=True))
                listening += len(heard[-1][0])
                ids = [class_of(s) for s in sets]
                for e, own in zip(ids, sets):
                    if e not in seen:
                        seen.add(e)
                        shingles.append(own)
                        size += len(own)
                m = len(ids)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()), pa.array(ids, pa.int64()), part.column("h"),
                     pa.nulls(m, pa.int64()), pa.nulls(m, pa.int64()), pa.nulls(m, pa.bool_())], ["doc_id", "n", "e", "h", "heard", "times", "shingle"])
                if size > _COUNTED:
                    yield listed(*_widely(shingles, _OFTEN_SHINGLE), True)
                    shingles, seen, size = [], set(), 0
                if listening > _COUNTED_WORDS:
                    yield listed(*_often(heard, _OFTEN), False)
                    heard, listening = [], 0
        if heard:
            yield listed(*_often(heard, _OFTEN), False)
        if shingles:
            yield listed(*_widely(shingles, _OFTEN_SHINGLE), True)

    return stored(docs.mapInArrow(run, _DOCUMENT), "jaccard-documents")


def _frequent(rows: DataFrame, most: int, shingles: bool) -> tuple[np.ndarray, np.ndarray]:
    """The hashes (sorted) of the most frequent words or shingles, at most ``most``, and the weights of their counts."""
    counts = rows.where(F.col("shingle") == shingles).groupBy("heard").agg(F.sum("times").alias("times"))
    table = counts.orderBy(F.col("times").desc(), "heard").limit(most).toArrow()
    hashes, times = table["heard"].to_numpy().view(np.uint64), table["times"].to_numpy()
    order = np.argsort(hashes)
    return hashes[order], np.round(np.log2(np.maximum(times[order], 1)) * (16 if shingles else 1)).astype(np.uint64)


def _weights(frequent: tuple[np.ndarray, np.ndarray], hashes: np.ndarray) -> np.ndarray:
    """Weight of each hash; 0 beyond the list."""
    known, weight = frequent
    if not len(known):
        return np.zeros(len(hashes), np.uint64)
    at = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
    return np.where(known[at] == hashes, weight[at], np.uint64(0))


def _first_shingles(words: Words, k: int, percent: int, frequent, wanted: list[int], sets: list[np.ndarray]):
    """Of each wanted text, the shingles that come first in the common order."""
    weights = _weights(frequent[0], words.hash)
    hashes = words.shingles(k)
    n = len(hashes)
    total = np.zeros(n, np.uint64)
    for j in range(k):
        total += weights[j:n + j]
    own = _weights(frequent[1], hashes)
    total = np.where(own > 0, np.minimum(own, np.uint64(511)) + np.uint64(512), np.minimum(total, np.uint64(511)))
    # weight, then most of the hash: one number orders the shingles
    order = (total << np.uint64(54)) | (hashes >> np.uint64(10))
    for i in wanted:
        first = len(sets[i]) - least_overlap(len(sets[i]), percent) + 1
        a, b = words.bounds[i], words.bounds[i + 1]
        if b - a < k:
            yield sets[i]
            continue
        own, place = np.unique(order[a:b - k + 1], return_index=True)
        yield hashes[a + place[:first]]


def first_of_smaller(n: int, percent: int) -> int:
    """How many of its n shingles a set must look at to meet every partner that is not smaller."""
    return n - -(-2 * n * percent // (100 + percent)) + 1


def _prefixes(docs: DataFrame, k: int, percent: int, frequent) -> DataFrame:
    """``(key, place, e)``: each class's first shingles in the common order; ``place`` is twice the size,
    plus 1 but for ``early`` shingles, which also meet larger sets."""

    def run(batches):
        sent: set[int] = set()
        for batch in batches:
            for part in slices(batch, "text", PART):
                words = Words(*text_bytes(part.column("text")), lower=True)
                sets = _sets_of(words, k)
                ids, wanted = [class_of(s) for s in sets], []
                for i, e in enumerate(ids):
                    if len(sets[i]) and e not in sent:
                        sent.add(e)
                        wanted.append(i)
                if len(sent) > SENT:
                    sent.clear()
                keys = list(_first_shingles(words, k, percent, frequent, wanted, sets))
                places = [2 * len(sets[i]) + (np.arange(len(head)) >= first_of_smaller(len(sets[i]), percent)) for i, head in zip(wanted, keys)]
                owners = [np.full(len(head), ids[i], np.int64) for i, head in zip(wanted, keys)]
                if keys:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys).view(np.int64)), pa.array(np.concatenate(places)),
                                                      pa.array(np.concatenate(owners))], ["key", "place", "e"])

    return docs.select("text").mapInArrow(run, "key long, place long, e long")


def _groups(prefixes: DataFrame, percent: int) -> DataFrame:
    """``(grp, e, n, hub)``: classes that share a key and whose sizes, in order,
    are within the similarity; hub is the smallest of the size band. A group begins with an early
    key: without one no pair of it has to meet here. One pass over sorted rows, holding one row back."""

    def run(batches):
        key0 = e0 = None          # of the row held back: its key and class
        group = hub = hub_n = n0 = None
        sent = False              # is the row held back written
        for batch in batches:
            rows = []
            # rows that share their key with a neighbour, and the last one
            keys = batch.column("key").to_numpy()
            if not len(keys):
                continue
            same = keys[1:] == keys[:-1]
            near = np.append(same, True) | np.insert(same, 0, keys[0] == key0)
            for key, place, e in zip(*(batch.column(c).filter(pa.array(near)).to_pylist() for c in ("key", "place", "e"))):
                n, early = place // 2, place % 2 == 0
                if key == key0 and e == e0:
                    continue
                if key == key0 and group is not None and 100 * n0 >= percent * n:
                    if not sent:
                        rows.append((group, e0, n0, hub))
                    if 100 * hub_n < percent * n:
                        hub, hub_n = e, n
                    rows.append((group, e, n, hub))
                    sent = True
                else:
                    sent = False
                    group = None
                    if early:
                        group = int(mix(np.array([key], np.int64).view(np.uint64) + np.array([e], np.int64).view(np.uint64) * np.uint64(0xD6E8FEB86659FD93)).view(np.int64)[0])
                        hub, hub_n = e, n
                key0, e0, n0 = key, e, n
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], ["grp", "e", "n", "hub"])

    # of equal sizes the early ones first: a pair meets if either has the key early
    ordered = prefixes.repartition("key").sortWithinPartitions("key", "place", "e")
    return ordered.mapInArrow(run, "grp long, e long, n long, hub long")


def _key_bits(keys: DataFrame, most: int = KEY_BITS) -> tuple[DataFrame, int]:
    """A bitmap of the hashed keys (one column) as rows ``(word, mask)``, and its length in bits, ``most`` at most."""
    bits = min(most, max(1 << 10, 1 << int(16 * keys.count()).bit_length()))
    slot = F.pmod(F.xxhash64(keys.columns[0]), F.lit(bits))
    slots = keys.select(slot.alias("slot"))
    return stored(slots.groupBy(F.expr("slot div 64").alias("word")).agg(F.expr("bit_or(shiftleft(1L, cast(slot % 64 as int)))").alias("mask")), "jaccard-bits"), bits


def _narrowed(rows: DataFrame, column: str, bitmap: tuple[DataFrame, int], without: bool = False) -> DataFrame:
    """The rows whose hashed key is in a bitmap (``without``: is not): all that have a partner among its keys, and a few more."""
    words, bits = bitmap
    slot = f"pmod(xxhash64({column}), {bits})"
    holds = F.expr(f"{slot} div 64 = word") & F.expr(f"shiftright(mask, cast({slot} % 64 as int)) & 1 = 1")
    # KEY_BITS / 64 short rows at most
    return rows.join(F.broadcast(words), holds, "left_anti" if without else "left_semi")


def _of_sets(docs: DataFrame, wanted: DataFrame, k: int, of) -> DataFrame:
    """``(e, n, of)`` of the wanted classes ``(e, h)``: what ``of`` makes of a set, made where the text is, so that
    no text moves (equal rows may give a set once per task)."""

    def run(batches):
        sent: set[int] = set()
        for batch in batches:
            for part in slices(batch, "text", PART):
                rows = []
                for h, s in zip(part.column("h").to_pylist(), shingle_sets(*text_bytes(part.column("text")), k)):
                    if len(s) and h not in sent:
                        sent.add(h)
                        rows.append((class_of(s), h, len(s), of(s).tobytes()))
                if len(sent) > SENT:
                    sent.clear()
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)], ["e", "h", "n", "of"])

    made = _narrowed(docs.select("h", "text"), "h", _key_bits(wanted.select("h"))).mapInArrow(run, "e long, h long, n long, of binary")
    # texts that are not wanted and have passed the first bitmap hardly ever pass a second
    known = wanted.select("e", F.col("h").alias("first")).hint("merge")
    return _narrowed(made, "e", _key_bits(wanted.select("e"))).join(known, "e").where("h = first").select("e", "n", "of")


def _sent_to_hubs(sides: DataFrame, keep) -> DataFrame:
    """The pairs ``(a, b)`` whose sets pass ``keep``; of ``sides(a, copy, e, member, n, of)`` the members move to the copies of their hub, the other rows."""

    def run(batches):
        hub = None
        for batch in batches:
            for part in slices_of_rows(batch, 256):
                kept = []
                for a, e, member, n, of in zip(*(part.column(c).to_pylist() for c in ("a", "e", "member", "n", "of"))):
                    own = (n, np.frombuffer(of, np.uint64))
                    if not member:
                        hub = own
                    elif keep(hub, own):
                        kept.append((a, e))
                yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in kept], pa.int64()) for i in (0, 1)], ["a", "b"])

    moved = sides.repartition("a", "copy").sortWithinPartitions("a", "copy", "member")
    return moved.select("a", "e", "member", "n", "of").mapInArrow(run, "a long, b long").distinct()


def _kept_pairs(pairs: DataFrame, sets, keep) -> DataFrame:
    """The pairs ``(a, b)`` whose sets pass ``keep``: the sets b move to a, which is copied for every ``HUB`` of them.
    ``sets`` gives ``(e, n, of)`` of the classes ``(e)`` that it is asked for, and maybe of a few more."""
    pairs = stored(pairs, "jaccard-pairs")
    sizes = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / HUB).alias("copies"))
    dealt = pairs.join(sizes, "a").select("a", F.pmod(F.xxhash64("b"), F.col("copies")).alias("copy"), "b")
    members = dealt.select("a", "copy", F.col("b").alias("e"), F.lit(True).alias("member"))
    hubs = dealt.select("a", "copy").distinct().select("a", "copy", F.col("a").alias("e"), F.lit(False).alias("member"))
    asked = pairs.select(F.col("a").alias("e")).union(pairs.select("b")).distinct()
    # sets move by shuffle whatever their number: one plan for all sizes
    return _sent_to_hubs(members.union(hubs).join(sets(asked).hint("merge"), "e"), keep)


def _within_bound(pairs: DataFrame, maps: DataFrame, percent: int) -> DataFrame:
    """The pairs whose bitmaps allow the similarity."""

    def keep(one, other):
        words = min(len(one[1]), len(other[1]))
        x, y = folded(one[1], words), folded(other[1], words)
        counts = [int(np.bitwise_count(z).sum()) for z in (x, y, x & y)]
        return bool(may_link(one[0], counts[0], other[0], counts[1], counts[2], percent))

    return _kept_pairs(pairs, lambda asked: _narrowed(maps, "e", _key_bits(asked)), keep)


def _linking(percent: int):
    def keep(one, other):
        shared = len(np.intersect1d(one[1], other[1], assume_unique=True))
        return 100 * shared >= percent * (one[0] + other[0] - shared)
    return keep


def _verified(pairs: DataFrame, docs: DataFrame, classes: DataFrame, k: int, percent: int) -> DataFrame:
    """The pairs that truly link, by intersecting the sorted arrays; only the sets of these pairs are made and move."""

    def grams(asked: DataFrame) -> DataFrame:
        return _of_sets(docs, stored(asked.join(classes, "e").select("e", "h"), "jaccard-wanted"), k, np.asarray)

    return _kept_pairs(pairs, grams, _linking(percent))


class _Forest:
    """Which components a tile has joined so far."""

    def __init__(self):
        self.up: dict[int, int] = {}

    def _top(self, x: int) -> int:
        while (y := self.up.get(x, x)) != x:
            self.up[x] = x = self.up.get(y, y)
        return x

    def joins(self, x: int, y: int) -> bool:
        x, y = self._top(x), self._top(y)
        self.up[max(x, y)] = min(x, y)
        return x != y


def _tile_pairs(e, n, root, side, maps, percent: int, alone: bool, tree: bool):
    """Pairs of one tile (or of two tiles with each other) that the bitmaps let
    pass, and the members of those left out; with ``tree`` those that join nothing are."""
    forest = _Forest()
    words = min(len(m) for m in maps)
    maps = np.stack([folded(m, words) for m in maps])
    counts = np.bitwise_count(maps).sum(axis=1).astype(np.int64)
    step = max(1, (1 << 21) // max(1, maps.size))
    for i in range(0, len(e), step):
        j = slice(i, i + step)
        open_ = (root[j, None] != root) & (100 * np.minimum(n[j, None], n) >= percent * np.maximum(n[j, None], n))
        open_ &= (np.arange(len(e))[j, None] < np.arange(len(e))) if alone else (side[j, None] < side)
        x, y = np.nonzero(open_)
        some = max(1, (1 << 20) // words)
        for a in range(0, len(x), some):
            p, q = x[a:a + some] + i, y[a:a + some]
            shared = np.bitwise_count(maps[p] & maps[q]).sum(axis=1).astype(np.int64)
            ok = may_link(n[p], counts[p], n[q], counts[q], shared, percent)
            p, q = p[ok], q[ok]
            if not len(p):
                continue
            new = np.ones(len(p), bool)
            if tree:
                new[:] = [forest.joins(a, b) for a, b in zip(root[p].tolist(), root[q].tolist())]
            yield e[p[new]], e[q[new]], np.unique(e[np.concatenate([p[~new], q[~new]])])


def _across(groups: DataFrame, roots: DataFrame, maps: DataFrame, percent: int, tile: int, tree: bool, least: int) -> DataFrame:
    """``(a, b, grp)``: pairs of different components within a group ``(grp, e)`` of ``least`` or more that the bitmaps let
    pass (grp null); with ``tree`` only as many as join the components of each
    tile, and the members (as a, b null) of the pairs that were left out, by group. Of groups with the same members one is looked at."""
    known = groups.join(roots, groups["e"] == roots["node"], "left").select("grp", "e", F.coalesce("root", "e").alias("root"))
    mixed = (known.groupBy("grp").agg(F.count(F.lit(1)).alias("g"), F.min("root").alias("r0"), F.max("root").alias("r1"),
                                      F.bit_xor(F.xxhash64("e")).alias("x"), F.bit_xor(F.xxhash64("e", F.lit(1))).alias("y"))
             .where((F.col("g") >= least) & (F.col("r0") != F.col("r1"))).groupBy("g", "x", "y").agg(F.min("grp").alias("grp"))
             .select("grp", F.ceil(F.col("g") / tile).cast("int").alias("tiles")))
    rows = known.join(mixed, "grp").withColumn("own", F.pmod(F.xxhash64("e"), F.col("tiles")).cast("int"))
    dealt = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    dealt = dealt.select("grp", F.least("own", "other").alias("t0"), F.greatest("own", "other").alias("t1"), "own", "e", "root")
    dealt = dealt.join(maps.select("e", "n", F.col("of").alias("bits")).hint("merge"), "e").repartition("grp", "t0", "t1")
    # by class, so that the trees of groups with the same members are the same pairs
    dealt = dealt.sortWithinPartitions("grp", "t0", "t1", "e")
    names = ["grp", "t0", "t1", "own", "e", "root", "n", "bits"]

    def runs(batches):
        held = None
        for batch in batches:
            table = pa.Table.from_batches([batch]) if held is None else pa.concat_tables([held, pa.Table.from_batches([batch])])
            ids = np.stack([table[c].to_numpy() for c in names[:3]])
            cuts = np.flatnonzero((ids[:, 1:] != ids[:, :-1]).any(axis=0)) + 1
            bounds = [0, *cuts.tolist()]
            for a, b in zip(bounds[:-1], bounds[1:]):
                yield table.slice(a, b - a)
            held = table.slice(bounds[-1])
        if held is not None and held.num_rows:
            yield held

    def run(batches):
        for group in runs(batches):
            t0, t1 = group["t0"][0].as_py(), group["t1"][0].as_py()
            e, n, root, side = (group[c].to_numpy() for c in ("e", "n", "root", "own"))
            maps = [np.frombuffer(b, np.uint64) for b in group["bits"].to_pylist()]
            left_out = [e[:0]]
            for p, q, members in _tile_pairs(e, n, root, side, maps, percent, t0 == t1, tree):
                left_out = [np.unique(np.concatenate([*left_out, members]))]
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(p, q)), pa.array(np.maximum(p, q)), pa.nulls(len(p), pa.int64())], ["a", "b", "grp"])
            if m := len(left_out[0]):
                yield pa.RecordBatch.from_arrays([pa.array(left_out[0]), pa.nulls(m, pa.int64()), pa.array([group["grp"][0].as_py()] * m, pa.int64())], ["a", "b", "grp"])

    return dealt.select(*names).mapInArrow(run, "a long, b long, grp long").distinct()


def _apart(pairs: DataFrame, roots: DataFrame) -> DataFrame:
    """The pairs whose ends are in different components."""
    ends = [roots.select(F.col("node").alias(c), F.col("root").alias(f"root_{c}")) for c in ("a", "b")]
    known = pairs.join(ends[0], "a", "left").join(ends[1], "b", "left")
    return known.where(F.coalesce("root_a", "a") != F.coalesce("root_b", "b")).select("a", "b")


def _joined(roots: DataFrame | None, pairs: DataFrame, verified) -> DataFrame:
    """Components after the pairs that truly link are added to those of earlier rounds, if there are any."""
    pairs = stored(pairs, "jaccard-pairs")
    if roots is not None and not pairs.head(1):
        return roots
    links = stored(verified(pairs), "jaccard-links")
    if roots is not None:
        if not links.head(1):
            return roots
        links = roots.select(F.col("node").alias("a"), F.col("root").alias("b")).union(links)
    return stored(components(links), "jaccard-roots")


def link_components(docs: DataFrame, k: int = 5, percent: int = 80, key: str = "doc_id", text_col: str = "text",
                    tile: int = TILE, max_frequent: int = MAX_FREQUENT) -> DataFrame:
    """One row per document: ``(doc_id, n_shingles, class_id, component_id)``; documents
    link when 100 * intersection >= ``percent`` * union of their shingle sets.
    ``component_id`` is the smallest id of the component, ``class_id`` that of the documents with an equal set."""
    small_batches(docs.sparkSession)
    docs = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    docs = docs.withColumn("h", F.xxhash64("doc_id", "text"))
    rows = _documents(docs, k)
    documents = rows.where("heard is null").select("doc_id", "n", "e")
    classes = stored(rows.where("n > 0").groupBy("e").agg(F.min("doc_id").alias("rep"), F.min("h").alias("h")), "jaccard-classes")
    frequent = [_frequent(rows, max_frequent, shingles) for shingles in (False, True)]
    groups = stored(_groups(_prefixes(docs, k, percent, frequent), percent), "jaccard-groups")
    stars = stored(groups.where("e <> hub").groupBy(F.col("hub").alias("a"), F.col("e").alias("b")).agg(F.count(F.lit(1)).alias("shared")), "jaccard-stars")
    closest = stars.groupBy("b").agg(F.max_by("a", F.struct("shared", "a")).alias("a")).select("a", "b")
    found = stored(groups.select("e").distinct().join(classes, "e").select("e", "h"), "jaccard-wanted")
    maps = stored(_of_sets(docs, found, k, bitmap), "jaccard-maps")

    def verified(pairs: DataFrame) -> DataFrame:
        return _verified(pairs, docs, classes, k, percent)

    roots = _joined(None, _within_bound(closest, maps, percent), verified)
    roots = _joined(roots, _within_bound(_apart(stars.select("a", "b"), roots), maps, percent), verified)
    # a group of two has met its hub
    for turn, (tree, least) in enumerate(((True, 3), (True, 2), (False, 2))):
        across = stored(_across(groups.select("grp", "e"), roots, maps, percent, tile, tree, least), "jaccard-pairs")
        roots = _joined(roots, across.where("grp is null").select("a", "b"), verified)
        groups = across.where("grp is not null").select("grp", F.col("a").alias("e"))
        if not groups.head(1):
            break
        if turn == 0:
            left = stored(groups.select("e").distinct().join(classes, "e").select("e", "h"), "jaccard-wanted")
            maps = stored(_of_sets(docs, left, k, partial(bitmap, per_shingle=FINE)), "jaccard-maps")
    member = classes.join(roots, classes["e"] == roots["node"], "left").select("e", "rep", F.coalesce("root", "e").alias("root"))
    named = member.join(member.groupBy("root").agg(F.min("rep").alias("component_id")), "root").select("e", "rep", "component_id")
    alone: Column = F.col("n") == 0
    return documents.join(named, "e", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.when(alone, F.col("doc_id")).otherwise(F.col("rep")).alias("class_id"),
        F.when(alone, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))


def one_of_each(docs: DataFrame, k: int = 5, percent: int = 80, key: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each group of near copies, and all rows without words: of a group the row of the
    smallest key (null last), then of the smallest digest of all columns. Rows equal in all columns are one row.
    Rows that are neither dropped nor repeated stay where they are; the others are told by their digest."""
    rows = docs.select(F.struct("*").alias("row"), F.xxhash64(*docs.columns).alias("h"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).rlike(r"[^\x20\x09-\x0D]").alias("worded"))
    worded = rows.where("worded")
    linked = link_components(worded.select("h", F.col("row")[text_col].alias("text")), k, percent, key="h")
    linked = linked.select(F.col("doc_id").alias("h"), "component_id").distinct()
    keys = worded.groupBy("h").agg(F.min(F.col("row")[key].cast("long")).alias("id"), F.count(F.lit(1)).alias("times"))
    known = stored(linked.join(keys, "h"), "jaccard-known")
    first = known.groupBy("component_id").agg(F.min(F.struct(F.col("id").isNull().alias("missing"), "id", "h")).alias("first")).select(F.col("first.h").alias("h"), F.lit(True).alias("first"))
    odd = known.join(first, "h", "left").where("first is null or times > 1").select("h", F.col("first").isNotNull().alias("kept"))
    odd = stored(odd, "jaccard-odd")
    bitmap_ = _key_bits(odd.select("h"))
    as_they_are = _narrowed(worded, "h", bitmap_, without=True).select("row")
    told = _narrowed(worded, "h", bitmap_).select("h", "row").join(odd.hint("merge"), "h", "left")
    again = told.where("kept").groupBy("h").agg(F.min("row").alias("row")).select("row")
    return as_they_are.union(told.where("kept is null").select("row")).union(again).union(rows.where(~F.col("worded")).select("row")).select("row.*")


__all__ = ["link_components", "one_of_each", "shingle_sets", "class_of", "bitmap", "TILE", "MAX_FREQUENT"]
