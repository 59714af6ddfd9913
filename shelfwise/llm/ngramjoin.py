"""N-gram Jaccard join with a count-vector R-tree.

A document is the set of its distinct word shingles.  Hashing the shingles into ``GROUPS`` groups and
counting each group makes the set a point, and two sets share at most the sum of their coordinates'
minima.  An R-tree over the points carries the maxima of its boxes, so the same sum bounds what any two
boxes share; the tree is joined with itself from the top, and pairs of points whose bound allows the
similarity are verified on the sets.  Pairs that links found before already connect are not verified.

Points of unrelated texts of one length lie close together, so one tree over the corpus would compare
nearly everything with everything.  Trees are therefore built per candidate block, and blocks lose no
link: two sets of similarity s differ in at most D = (1-s)/(1+s) (|A|+|B|) shingles, so if both are
dealt by hash into parts, of any D+1 parts of one set some part is equal in the other.  Each set gives
its D+1 fullest parts (with ties), where rare shingles fill a part more than common ones: of the two
sets, take the one whose last part is fuller; its equal part is full enough to be given by both.
Documents that share a part (same place, same content) are joined, transitively, into blocks; as parts
of rare shingles are given first, a common passage rarely ties documents together.  Which shingles are
common is read off a sketch of fixed size, counted over all documents; it orders parts and nothing else.

Parts travel as packed arrays, once per part and block of documents, so a part that a third of all
documents share is a few rows.  Equal sets are one set throughout.  A block of more than ``TILE`` sets is
cut into tiles of sets of about one size: tiles first, then one set of each class found in each tile,
then the pairs of tiles of matching sizes that still hold different classes.  Nothing is capped and no
list of all pairs is made.

Sets hold 64-bit fingerprints of shingles.  Defined results: a text without words, or null, is an empty
set, linked with nothing; a text of fewer words than a shingle is one shingle.  Ids are integers; rows of
one id are one document, linked with whatever one of them links with, and have a row each.  A row with a
null id has a null component and links with nothing.  An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.llm.common import (Scratch, Words, bucket_bounds, chain, fingerprints, group_starts, mix, pack_sorted,
                                  planes, ship, slices, squeeze, tidy, unpack_sorted, unplanes, unsqueeze,
                                  whole_groups)
from shelfwise.llm.components import connected

SIZE, SIMILARITY = 5, (4, 5)
#: Groups of a count vector: one for so many shingles of the largest set, between these bounds.
PER_GROUP, GROUPS = 16, (32, 512)
#: Cells of the sketch of common shingles, and how far above the mean a common one's cell lies.
CELLS, COMMON = 1 << 22, 4
#: Children of a node of the tree.
FANOUT = 16
#: Sets, and shingles of all its sets, that one tree holds.
TILE, TILE_SHINGLES = 4096, 2_000_000
#: Ratio of the set sizes that share one number of parts, and parts made for each that may be needed.
STEP, SPARE = 1.2, 1.3
#: Parts that a reduce task merges, about.
PARTS_PER_BUCKET = 2_000_000
#: Pieces in which sketches are merged.
SEGMENTS = 64
#: Text bytes, and shingles, whose arrays are held at once.
AT_ONCE, SHINGLES_AT_ONCE = 2 << 20, 1 << 18
#: Characters of text that pairs of tiles are sent at a time, or as many as the tiles hold if these hold more.
TURN_CHARS = 1 << 30
#: Pairs of nodes that are expanded at once.
PAIRS_AT_ONCE = 20_000


# ------------------------------------------------------------------ sets of shingles
def shingle_sets(texts: pa.Array, size: int) -> list[np.ndarray]:
    """The distinct shingles of each text, as ascending 64-bit fingerprints."""
    out: list[np.ndarray] = []
    for i, j in slices(texts, AT_ONCE):
        words = Words(texts.slice(i, j - i))
        own = fingerprints(words.vocab)[words.codes]
        whole = own[:max(0, len(own) - size + 1)]
        for k in range(1, size):
            whole = chain(whole, own[k:k + len(whole)])
        start = 0
        for end in words.ends.tolist():
            if end - start >= size:
                out.append(np.unique(whole[start:end - size + 1]))
            elif end > start:
                one = own[start:start + 1]
                for k in range(start + 1, end):
                    one = chain(one, own[k:k + 1])
                out.append(one.copy())
            else:
                out.append(own[:0].copy())
            start = end
    return out


def set_identity(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """128 bits that tell sets apart, as two columns of longs."""
    salt = np.uint64(0xA5A5A5A5A5A5A5A5)
    a = [int(mix(s).sum(dtype=np.uint64)) for s in sets]
    b = [int(mix(s ^ salt).sum(dtype=np.uint64)) for s in sets]
    return np.array(a, np.uint64).view(np.int64), np.array(b, np.uint64).view(np.int64)


def shared_at_least(total: np.ndarray, similarity: tuple[int, int]) -> np.ndarray:
    """Least number of shared shingles for sets whose sizes sum to ``total``."""
    p, q = similarity
    return -(-total * p // (p + q))


# ------------------------------------------------------------------ parts
def size_levels(largest: int) -> np.ndarray:
    """Upper ends of the classes of set size."""
    ends = [1]
    while ends[-1] < largest:
        ends.append(max(ends[-1] + 1, int(ends[-1] * STEP)))
    return np.array(ends, np.int64)


def part_keys(sets: list[np.ndarray], similarity: tuple[int, int], common: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(key, place of the set) of the parts that each set gives; sets with the similarity share a key.

    ``common``: cells of the sketch that hold a common shingle.
    """
    p, q = similarity
    sizes = np.array([len(s) for s in sets], np.int64)
    levels = size_levels(int(sizes.max(initial=1)) * q // p + 1)
    low, high = np.searchsorted(levels, sizes), np.searchsorted(levels, sizes * q // p)
    keys, places = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for k in range(int((high - low).max(initial=-1)) + 1):
        every = np.flatnonzero((sizes > 0) & (low + k <= high))
        before = np.cumsum(sizes[every]) - sizes[every]
        for some in np.split(every, np.flatnonzero(np.diff(before // SHINGLES_AT_ONCE)) + 1):
            if not len(some):
                continue
            level = low[some] + k
            differ = 2 * levels[level] * (q - p) // (q + p)
            parts = np.ceil((differ + 1) * SPARE).astype(np.int64)
            base = np.cumsum(parts) - parts
            of = np.repeat(np.arange(len(some)), sizes[some])
            h = np.concatenate([sets[i] for i in some.tolist()])
            part = (mix(h ^ np.uint64(0x5851F42D4C957F2D)) % parts[of].astype(np.uint64)).astype(np.int64)
            cell = base[of] + part
            content = mix(h + np.uint64(0x14057B7EF767814F))
            n = int(parts.sum())
            half = np.uint64(32)
            left = np.bincount(cell, weights=(content >> half).astype(float), minlength=n).astype(np.uint64)
            right = np.bincount(cell, weights=(content & np.uint64(0xFFFFFFFF)).astype(float), minlength=n).astype(np.uint64)
            fills = np.where(common[(h % np.uint64(len(common))).astype(np.int64)], 1.0, 256.0)
            held = np.bincount(cell, weights=fills, minlength=n)
            owner = np.repeat(np.arange(len(some)), parts)
            number = np.arange(n) - base[owner]
            # The fullest parts, one more than can differ, and those as full as the last of them.
            by_size = held[np.lexsort((-held, owner))]
            emit = held >= by_size[base + differ][owner]
            key = chain(mix(left * np.uint64(0x9E3779B97F4A7C15) + right), mix((level[owner] << 32 | number).astype(np.uint64)))
            keys.append(key[emit])
            places.append(some[owner[emit]])
    return np.concatenate(keys), np.concatenate(places)


def _stars(keys: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys with their least id; and edges (id, least id) that join the holders of a key."""
    order = np.lexsort((ids, keys))
    keys, ids = keys[order], ids[order]
    head = np.ones(len(keys), bool)
    head[1:] = keys[1:] != keys[:-1]
    least = ids[np.maximum.accumulate(np.where(head, np.arange(len(keys)), 0))] if len(keys) else ids
    a, b = ids[~head], least[~head]
    return keys[head], ids[head], *_contract(a, b)


def _contract(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges (id, least id of its component) that join what the edges (a, b) join."""
    ids, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = at[:len(a)], at[len(a):]
    label = np.arange(len(ids))
    while True:
        least = np.minimum(label[x], label[y])
        new = label.copy()
        np.minimum.at(new, x, least)
        np.minimum.at(new, y, least)
        new = new[new]
        if (new == label).all():
            return _distinct(ids, ids[label])
        label = new


def _distinct(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    a, b = a[a != b], b[a != b]
    order = np.lexsort((b, a))
    a, b = a[order], b[order]
    new = np.ones(len(a), bool)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    return a[new], b[new]


def _common_cells(sketches: DataFrame) -> np.ndarray:
    """Cells that a common shingle has raised, from the tasks' sketches (segment, cells)."""

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for segment, cells in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                part = unsqueeze(cells, np.uint32).astype(np.uint64)
                sums[segment] = sums[segment] + part if segment in sums else part
        for segment, cells in sums.items():
            yield pa.RecordBatch.from_pydict({"segment": pa.array([segment], pa.int32()), "cells": [squeeze(cells)]})

    total = np.zeros(CELLS, np.uint64)
    width = CELLS // SEGMENTS
    scratch = Scratch(sketches.sparkSession, "ngram-sketch")
    merged = scratch.keep(sketches.repartition(SEGMENTS, "segment").mapInArrow(tidy(merge), "segment int, cells binary"))
    for row in merged.toLocalIterator():
        total[row["segment"] * width:(row["segment"] + 1) * width] = unsqueeze(row["cells"], np.uint64)
    scratch.drop(merged)
    return total > COMMON * total.mean() + COMMON


def _candidate_edges(docs: DataFrame, size: int, similarity, buckets: int, common: np.ndarray) -> DataFrame:
    """(a, b): each document that shares a part with others, and the least of them."""
    marked = docs.sparkSession.sparkContext.broadcast(np.packbits(common))  # CELLS bits

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turn = TaskContext.get().partitionId()
        common = np.unpackbits(marked.value).astype(bool)
        for batch in batches:
            all_ids = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            for i, j in slices(batch.column(1)):
                keys, places = part_keys(shingle_sets(batch.column(1).slice(i, j - i), size), similarity, common)
                keys, ids, a, b = _stars(keys, all_ids[i:j][places])
                at = bucket_bounds(keys, buckets)
                turn += 1
                rows = [(k, pack_sorted(keys[s:e]), planes(ids[s:e])) for k, (s, e) in enumerate(zip(at[:-1], at[1:])) if e > s]
                columns = [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int32(), pa.binary(), pa.binary()))]
                if rows:
                    empty = pa.array([b""] * len(rows), pa.binary())
                    yield pa.RecordBatch.from_arrays([*columns, empty, empty], ["bucket", "keys", "ids", "a", "b"])
                if len(a):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([turn % buckets], pa.int32()), *(pa.array([x], pa.binary()) for x in (b"", b"", planes(a), planes(b)))],
                        ["bucket", "keys", "ids", "a", "b"])

    def meet(pdf: pd.DataFrame) -> pd.DataFrame:
        keys = np.concatenate([unpack_sorted(x) for x in pdf["keys"]])
        ids = np.concatenate([unplanes(x, np.int64) for x in pdf["ids"]])
        _, _, a, b = _stars(keys, ids)
        a, b = _contract(np.concatenate([a, *(unplanes(x, np.int64) for x in pdf["a"])]),
                         np.concatenate([b, *(unplanes(x, np.int64) for x in pdf["b"])]))
        return pd.DataFrame({"a": a, "b": b})

    packets = docs.select("id", "text").mapInArrow(tidy(pack), "bucket int, keys binary, ids binary, a binary, b binary")
    return packets.groupBy("bucket").applyInPandas(meet, "a long, b long")


# ------------------------------------------------------------------ the tree
class CountTree:
    """An R-tree over count vectors: boxes keep the maxima of their points, and the range of set sizes.

    Points are ordered by median splits on the widest coordinate; ``FANOUT`` neighbours make a node.
    """

    def __init__(self, sets: list[np.ndarray]):
        most = max(map(len, sets), default=0)
        groups = int(np.clip(1 << (most // PER_GROUP).bit_length(), *GROUPS))
        points = np.zeros((len(sets), groups), np.int32)
        for i, s in enumerate(sets):
            points[i] = np.bincount((s % np.uint64(groups)).astype(np.int64), minlength=groups)
        self.order = self._split(points, np.arange(len(sets)))
        top = points[self.order]
        low = high = top.sum(1)
        self.levels = [(top, low, high)]
        while len(top) > 1:
            cuts = np.arange(0, len(top), FANOUT)
            top, low, high = np.maximum.reduceat(top, cuts), np.minimum.reduceat(low, cuts), np.maximum.reduceat(high, cuts)
            self.levels.append((top, low, high))

    def _split(self, points: np.ndarray, rows: np.ndarray) -> np.ndarray:
        if len(rows) <= FANOUT:
            return rows
        spread = np.concatenate([points[rows], points[rows].sum(1, keepdims=True)], axis=1)
        widest = spread[:, np.argmax(spread.max(0) - spread.min(0))]
        # Whole nodes on the left side.
        half = -(-len(rows) // (2 * FANOUT)) * FANOUT
        rows = rows[np.argsort(widest, kind="stable")]
        return np.concatenate([self._split(points, rows[:half]), self._split(points, rows[half:])])

    def _may_link(self, level: int, a: np.ndarray, b: np.ndarray, similarity) -> np.ndarray:
        p, q = similarity
        top, low, high = self.levels[level]
        fits = (low[a] * p <= high[b] * q) & (low[b] * p <= high[a] * q)
        shared = np.minimum(top[a], top[b]).sum(1)
        return fits & (shared >= shared_at_least(low[a].astype(np.int64) + low[b], similarity))

    def pairs(self, similarity) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs (i, j) of places of sets whose bound allows the similarity."""
        top = len(self.levels) - 1
        todo = [(top, np.zeros(1, np.int64), np.zeros(1, np.int64))]
        while todo:
            level, a, b = todo.pop()
            if len(a) > PAIRS_AT_ONCE:
                todo += [(level, a[i:i + PAIRS_AT_ONCE], b[i:i + PAIRS_AT_ONCE]) for i in range(0, len(a), PAIRS_AT_ONCE)]
                continue
            keep = self._may_link(level, a, b, similarity) if level < top else np.ones(1, bool)
            a, b = a[keep], b[keep]
            if level == 0:
                if len(a):
                    yield self.order[a], self.order[b]
                continue
            n = len(self.levels[level - 1][1])
            for i in range(0, len(a), PAIRS_AT_ONCE // FANOUT ** 2):
                x = a[i:i + PAIRS_AT_ONCE // FANOUT ** 2, None, None] * FANOUT + np.arange(FANOUT)[None, :, None]
                y = b[i:i + PAIRS_AT_ONCE // FANOUT ** 2, None, None] * FANOUT + np.arange(FANOUT)[None, None, :]
                x, y = (z.ravel() for z in np.broadcast_arrays(x, y))
                # Below the leaves a pair of points is met once; above, a node also meets itself.
                fit = (x < n) & (y < n) & ((x < y) if level == 1 else (x <= y))
                if fit.any():
                    todo.append((level - 1, x[fit], y[fit]))


def links(sets: list[np.ndarray], similarity, classes: np.ndarray) -> list[tuple[int, int]]:
    """(place, least place of its class) for the sets whose classes links join."""
    root = list(range(len(sets)))
    first: dict[int, int] = {}
    for i, c in enumerate(classes.tolist()):
        root[i] = first.setdefault(c, i)

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = i = root[root[i]]
        return i

    before = list(root)
    for a, b in CountTree(sets).pairs(similarity):
        now = np.array([find(i) for i in range(len(sets))])
        apart = now[a] != now[b]
        for i, j in zip(a[apart].tolist(), b[apart].tolist()):
            x, y = find(i), find(j)
            if x == y:
                continue
            total = len(sets[i]) + len(sets[j])
            need = -(-total * similarity[0] // sum(similarity))
            s, t = (sets[i], sets[j]) if len(sets[i]) <= len(sets[j]) else (sets[j], sets[i])
            at = np.searchsorted(t, s)
            at[at == len(t)] = 0
            if int((t[at] == s).sum()) >= need:
                root[max(x, y)] = min(x, y)
    return [(i, find(i)) for i in range(len(sets)) if find(i) != before[i]]


_ORDER = ["block", "low", "high"]


def _link_tiles(tiled: DataFrame, size: int, similarity) -> DataFrame:
    """(a, b): links between sets of different classes in each (block, low, high) of (.., rep, class, text)."""
    tiled = tiled.select(*_ORDER, "rep", "class", "text").repartition(*_ORDER).sortWithinPartitions(*_ORDER, "rep")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, _ORDER):
            at = group_starts(table, _ORDER)
            reps, classes = (table.column(c).to_numpy() for c in ("rep", "class"))
            out: list[tuple[int, int]] = []
            i = 0
            while i < len(at) - 1:
                # Several small groups share one pass over their words.
                j = i + 1
                while j < len(at) - 1 and at[j + 1] - at[i] <= 256:
                    j += 1
                sets = shingle_sets(table.column("text").slice(at[i], at[j] - at[i]).combine_chunks(), size)
                for g in range(i, j):
                    s, e = at[g] - at[i], at[g + 1] - at[i]
                    if e - s > 1:
                        out += [(reps[at[g] + x], reps[at[g] + y]) for x, y in links(sets[s:e], similarity, classes[at[g]:at[g + 1]])]
                i = j
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], ["a", "b"])

    return tiled.mapInArrow(tidy(run), "a long, b long")


def _tiles_for(which) -> Column:
    """Aggregate: the tiles that the rows for which ``which`` holds need."""
    return F.greatest(F.ceil(F.count_if(which) / TILE),
                      F.ceil(F.sum(F.when(which, F.col("n")).otherwise(0)) / TILE_SHINGLES))


def _links_in_blocks(members: DataFrame, texts: DataFrame, size: int, similarity) -> DataFrame:
    """Links (a, b) that connect what is linked in the blocks of ``members`` (block, rep, n)."""
    p, q = similarity
    # Sets that link are of one size class or of neighbouring ones.
    members = members.withColumn("z", F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(q / p)))).withColumn("class", F.col("rep"))

    def tile(rows: DataFrame) -> DataFrame:
        """``rows`` with the tile of each: the whole block, or a part of one of its size classes."""
        count = rows.groupBy("block", "z").agg(F.count("*").alias("of_z"), F.sum("n").alias("shingles"),
                                               _tiles_for(F.lit(True)).alias("parts"))
        whole = Window.partitionBy("block")
        count = count.select("block", "z", "parts", F.sum("of_z").over(whole).alias("of_block"),
                             F.sum("shingles").over(whole).alias("of_block_shingles"))
        rows = rows.join(count, ["block", "z"]).filter("of_block > 1")
        one = (F.col("of_block") <= TILE) & (F.col("of_block_shingles") <= TILE_SHINGLES)
        own = (F.col("z") + 1) * (1 << 32) + F.pmod(F.xxhash64("rep"), F.col("parts"))
        rows = rows.withColumn("low", F.when(one, -1).otherwise(own))
        return rows.withColumn("high", F.col("low")).drop("parts", "of_block", "of_block_shingles")

    scratch = Scratch(members.sparkSession, "ngram-blocks")
    members = tile(members)
    members = texts.withColumnRenamed("id", "rep").join(members, "rep")
    tiled = scratch.keep(members)
    found = scratch.keep(_link_tiles(tiled, size, similarity))
    large = tiled.filter("low >= 0")
    if large.isEmpty():
        scratch.drop(tiled)
        return found

    def classed(edges: DataFrame) -> DataFrame:
        roots = connected(edges).withColumnRenamed("node", "rep")
        return large.drop("class").join(roots, "rep", "left").withColumn("class", F.coalesce("root", "rep")).drop("root")

    # One set of each class found in a tile stands for it, where that joins two or more.
    now = classed(found)
    heads = now.groupBy("block", "low", "class").agg(F.count("*").alias("n_in"), F.min_by(F.struct("rep", "n", "z", "text"), "rep").alias("one"))
    heads = tile(heads.filter("n_in > 1").select("block", "class", "one.*"))
    found = scratch.keep(found.union(_link_tiles(heads, size, similarity)))

    # Tiles anew, of one large class each or of leftovers; pairs of tiles of one and the same class are done.
    now = classed(found)
    count = now.groupBy("block", "z", "class").agg(_tiles_for(F.lit(True)).alias("of_class"))
    now = now.drop("low", "high").join(count, ["block", "z", "class"]).withColumn(
        "own", F.when(F.col("of_class") > 1, F.col("class")))
    left = now.groupBy("block", "z").agg(_tiles_for(F.col("own").isNull()).alias("left"))
    part = F.pmod(F.xxhash64("rep"), F.when(F.col("own").isNotNull(), F.col("of_class")).otherwise(F.col("left")))
    now = scratch.keep(now.join(left, ["block", "z"]).withColumn("tile", F.xxhash64("z", F.coalesce("own", F.lit(-1)), part))
                       .select("block", "z", "own", "tile", "rep", "class", "text"))
    scratch.drop(tiled)
    tiles = now.select("block", "z", "own", "tile").distinct()
    near = tiles.withColumn("z", F.explode(F.array("z", F.col("z") + 1))).toDF("block", "z", "own_2", "tile_2")
    # A tile meets those of its own size class once, and all of the class below.
    first = tiles.withColumnRenamed("tile", "t").withColumnRenamed("own", "o")
    pairs = (first.join(near.join(tiles.select("block", F.col("z").alias("z_2"), F.col("tile").alias("tile_2")), ["block", "tile_2"]),
                        ["block", "z"])
             .filter("(z = z_2 and t <= tile_2 or z <> z_2) and (o is null or own_2 is null or o <> own_2)"))
    pairs = scratch.keep(pairs.select("block", F.col("t").alias("low"), F.col("tile_2").alias("high")))
    ends = pairs.select("block", F.col("low").alias("tile"), "low", "high").union(
        pairs.filter("low <> high").select("block", "high", "low", "high"))
    # A tile's texts travel once for each of its pairs: so many pairs at a time that these are about the texts given.
    weight = now.groupBy("block", "tile").agg(F.sum(F.length("text")).alias("chars"))
    sent = ends.join(weight, ["block", "tile"]).agg(F.coalesce(F.sum("chars"), F.lit(0))).first()[0]
    given = weight.agg(F.coalesce(F.sum("chars"), F.lit(0))).first()[0]
    turns = max(1, -(-sent // max(given, TURN_CHARS)))
    for k in range(turns):
        some = ends.filter(F.pmod(F.xxhash64("low", "block", "high"), F.lit(turns)) == k)
        again = now.select("block", "tile", "rep", "class", "text").join(some, ["block", "tile"])
        found = found.union(scratch.keep(_link_tiles(again, size, similarity)))
    scratch.drop(now)
    return found


def classes(docs: DataFrame, size: int = SIZE, similarity: tuple[int, int] = SIMILARITY, id_col: str = "doc_id",
            text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id) of each document; a class's id is its least doc_id."""
    ship(docs.sparkSession)
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = np.zeros(CELLS, np.uint32)
        nothing = lambda n, t: pa.nulls(n, t)
        names = ["id", "n", "set_a", "set_b", "segment", "cells"]
        for batch in batches:
            for i, j in slices(batch.column(1)):
                sets = shingle_sets(batch.column(1).slice(i, j - i), size)
                a, b = set_identity(sets)
                met, times = np.unique(np.concatenate(sets) % np.uint64(CELLS), return_counts=True)
                cells[met.astype(np.int64)] += times.astype(np.uint32)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i), pa.array([len(s) for s in sets], pa.int64()), pa.array(a), pa.array(b),
                     nothing(j - i, pa.int32()), nothing(j - i, pa.binary())], names)
        width = CELLS // SEGMENTS
        for k in range(SEGMENTS):
            if cells[k * width:(k + 1) * width].any():
                yield pa.RecordBatch.from_arrays(
                    [*(nothing(1, pa.int64()) for _ in range(4)), pa.array([k], pa.int32()),
                     pa.array([squeeze(cells[k * width:(k + 1) * width])], pa.binary())], names)

    scratch = Scratch(docs.sparkSession, "ngram-sets")
    described = scratch.keep(texts.mapInArrow(
        tidy(describe), "id long, n long, set_a long, set_b long, segment int, cells binary"))
    every = scratch.keep(described.filter("segment is null").drop("segment", "cells"))
    common = _common_cells(described.filter("segment is not null").select("segment", "cells"))
    scratch.drop(described)
    some = every.filter("id is not null and n > 0")
    equal = some.groupBy("n", "set_a", "set_b").agg(F.min("id").alias("rep"))
    known = some.join(equal, ["n", "set_a", "set_b"])
    # An id has one set, unless rows repeat it: then the sets of all of them are one document's.
    known = scratch.keep(known.groupBy("id", "rep").agg(F.max("n").alias("n")))
    per_id = scratch.keep(known.groupBy("id").agg(F.min("rep").alias("rep"), F.max("rep").alias("last_rep")))

    total = every.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    p, q = similarity
    per_shingle = 4 * STEP * (q - p) / (q + p)
    buckets = max(4, int(total * per_shingle) // PARTS_PER_BUCKET)
    edges = _candidate_edges(texts.filter("id is not null"), size, similarity, buckets, common)
    blocks = connected(edges)
    blocks = blocks.union(blocks.select("root", "root").distinct())
    reps = known.filter("id = rep").select("rep", "n")
    members = blocks.select(F.col("node").alias("rep"), F.col("root").alias("block")).join(reps, "rep")
    found = _links_in_blocks(members, texts, size, similarity)

    several = per_id.filter("rep <> last_rep")
    if not several.isEmpty():
        found = found.union(known.join(several.select("id", F.col("rep").alias("least")), "id").filter("rep <> least")
                            .select("rep", "least"))
    roots = connected(found.select("a", "b"))
    whole = (per_id.join(roots.withColumnRenamed("node", "rep"), "rep", "left")
             .select(F.col("id").alias("of"), F.coalesce("root", "rep").alias("component")))
    return every.join(whole, every["id"] == whole["of"], "left").select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"),
        F.coalesce("component", "id").alias("component_id"))


def representatives(docs: DataFrame, size: int = SIZE, similarity: tuple[int, int] = SIMILARITY, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """One row of each class, that of its least doc_id, with all columns; rows with a null id all stay.

    Of rows that repeat the id, the one whose text has the least hash stays.
    """
    kept = (classes(docs, size, similarity, id_col, text_col).filter(F.col(id_col) == F.col("component_id"))
            .select(F.col(id_col).alias("kept")).distinct())
    plain = [f"c{i}" for i in range(len(docs.columns))]  # no column of ``docs`` meets one of ``kept``
    own, text = (F.col(plain[docs.columns.index(c)]) for c in (id_col, text_col))
    nth = F.row_number().over(Window.partitionBy(own).orderBy(F.xxhash64(text)))
    rows = docs.toDF(*plain)
    one = rows.join(kept, own.cast("long") == F.col("kept")).withColumn("nth", nth).filter("nth = 1").select(*plain)
    return one.union(rows.filter(own.isNull())).toDF(*docs.columns)
