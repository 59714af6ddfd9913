"""A prefix trie of conversations, rolled up by centroid decomposition.

A conversation is a sequence of turns (role, text); a node of the trie is a distinct sequence of first
turns, and its parent the sequence without the last.  Nodes are found without any tree walk: each turn is
fingerprinted with its position, and the fingerprint of a prefix is the exclusive or of its turns' (two
lanes of 64 bits), a running total that pieces of a long conversation compute apart and then add.

Subtree totals (childless nodes, saved tokens) are rolled up by centroid decomposition of the parent-edge
forest.  The weight of a node is the number of turns that lie in its subtree, counted for each member, and
known from the conversations' lengths.  In each component the centroid is the lowest node with half of its
weight or more.  The total of the part below it (with itself) is aggregated and added to the nodes on the
path from the centroid to the component's top, and the part's weight is taken off them.  The centroid
leaves; its children's parts and the part above are components of at most half the weight.  So the rounds
grow with the logarithm of the weight, however deep the trie is, and no node sees its whole subtree.
Rounds run on all components at once as joins; a component of up to ``IN_TASK`` weight is decomposed in
the same way within a task.

Lists of members are hashed piece by piece: ids fall into ranges of ``PIECE`` values, a range is sorted
and joined to text by itself, and a node's pieces stream in order through one SHA-256, which needs no list
in memory (a digest is sequential by definition; sorting and formatting is not).

Defined results: turns go by turn number, null first; those of equal number by role, then by the MD5 of
the text.  A null role or text is empty.  Rows without a conversation id take no part.  Repeated rows are
turns of their own.  Texts are compared by MD5, prefixes by 128 bits.  A table without conversations has no
nodes, not even a root.  Other columns may have any names.  Ids are integers.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.llm.common import checkpointed, group_starts, ship, whole_groups, written

#: Turn numbers, or turns, of a conversation that are put in order together.
TURNS = 512
#: Weight of the components that a task decomposes by itself.
IN_TASK = 1 << 15
#: Values of an id whose members are one piece of a list.
PIECE = 512
_LANES = ("k1", "k2")


# ------------------------------------------------------------------ turns
def turns_of(table: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
             text_col: str = "text") -> DataFrame:
    """(conv, pos, role, content, n_bytes): turns by their place in the conversation, from 1; texts as MD5."""
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    rows = table.select(
        F.col(f"`{id_col}`").cast("long").alias("conv"), F.col(f"`{turn_col}`").cast("long").alias("turn"),
        F.coalesce(F.col(f"`{role_col}`").cast("string"), F.lit("")).alias("role"),
        F.md5(text.cast("binary")).alias("content"), F.octet_length(text).cast("long").alias("n_bytes"))
    rows = rows.filter("conv is not null").withColumn("piece", F.expr(f"turn div {TURNS}"))
    order = [F.col("turn").asc_nulls_first(), "role", "content"]
    nth = F.row_number().over(Window.partitionBy("conv", "piece").orderBy(*order))
    before = _before(rows.groupBy("conv", "piece").agg(F.count(F.lit(1)).alias("n")), ["conv"], "piece", F.sum("n"))
    return _joined(rows.withColumn("nth", nth), before, ["conv", "piece"]).select(
        "conv", (F.col("nth") + F.coalesce("before", F.lit(0))).cast("long").alias("pos"), "role", "content", "n_bytes")


def _before(totals: DataFrame, group: list[str], piece: str, total: Column) -> DataFrame:
    """(group, piece, before): what all earlier pieces of the group amount to."""
    w = Window.partitionBy(*group).orderBy(F.col(piece).asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
    return totals.select(*group, piece, total.over(w).alias("before")).filter("before is not null")


def _joined(rows: DataFrame, before: DataFrame, keys: list[str]) -> DataFrame:
    """Rows with what lies before their piece; most conversations have one piece and no row in ``before``."""
    named = before.select(*[F.col(k).alias(f"_{k}") for k in keys], "before")
    return rows.join(named, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys], "left").drop(*[f"_{k}" for k in keys])


def spliced(turns: DataFrame, group: int, heads: int) -> tuple[DataFrame, DataFrame]:
    """(convs, rows): the conversations (conv, length) and turns of every conversation c when it begins with
    the first h turns of conversation c - c % ``group``, then goes on with its own after its first h;
    h = crc32(c) % ``heads``.
    """
    length = turns.groupBy("conv").agg(F.count(F.lit(1)).alias("own"))
    convs = length.select("conv", "own", (F.col("conv") - F.col("conv") % group).alias("base"),
                          (F.crc32(F.col("conv").cast("string").cast("binary")) % heads).alias("h"))
    lent = convs.join(length.select(F.col("conv").alias("base"), F.col("own").alias("lent")), "base", "left").select(
        "conv", "base", "h", "own", F.least(F.col("h"), F.coalesce("lent", F.lit(0))).alias("taken"))
    lent = checkpointed(lent)
    # At most ``group`` conversations share a base, and heads - 1 turns of it.
    head = turns.filter(F.col("pos") < heads).select(F.col("conv").alias("base"), *turns.columns[1:]).join(
        lent.select("conv", "base", "taken"), "base").filter("pos <= taken").select("conv", *turns.columns[1:])
    rest = turns.join(lent.select("conv", "h", "taken"), "conv").filter("pos > h").withColumn(
        "pos", F.col("pos") - F.col("h") + F.col("taken")).select(*turns.columns)
    convs = lent.select("conv", (F.col("taken") + F.greatest(F.lit(0), F.col("own") - F.col("h"))).alias("length"))
    return convs, head.union(rest)


# ------------------------------------------------------------------ nodes
def _prefixes(convs: DataFrame, turns: DataFrame) -> DataFrame:
    """(conv, depth, k1, k2, n_bytes, length): every prefix of every conversation, the empty one included."""
    marks = [F.xxhash64(F.lit(lane), "pos", "role", "content").alias(k) for lane, k in enumerate(_LANES)]
    rows = turns.select("conv", "pos", "n_bytes", *marks).withColumn("piece", F.expr(f"pos div {TURNS}"))
    within = Window.partitionBy("conv", "piece").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    totals = rows.groupBy("conv", "piece").agg(*[F.bit_xor(k).alias(k) for k in _LANES])
    w = Window.partitionBy("conv").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    before = totals.select(F.col("conv").alias("_conv"), F.col("piece").alias("_piece"),
                           *[F.bit_xor(k).over(w).alias(f"_{k}") for k in _LANES]).filter("_k1 is not null")
    rows = rows.select("conv", "pos", "n_bytes", "piece", *[F.bit_xor(k).over(within).alias(k) for k in _LANES])
    rows = rows.join(before, (F.col("conv") == F.col("_conv")) & (F.col("piece") == F.col("_piece")), "left")
    rows = rows.select("conv", F.col("pos").alias("depth"), "n_bytes", *[
        F.col(k).bitwiseXOR(F.coalesce(f"_{k}", F.lit(0).cast("long"))).alias(k) for k in _LANES])
    zero = F.lit(0).cast("long")
    empty = convs.select("conv", zero.alias("depth"), zero.alias("n_bytes"), *[zero.alias(k) for k in _LANES])
    return rows.union(empty).join(convs, "conv").select("conv", "depth", *_LANES, "n_bytes", "length")


def _nodes(prefixes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(nodes, paths).  A node is known by (conv, depth): its smallest member and its depth.  ``paths`` has
    (conv, depth, node, parent) of every conversation that stands for a node: the nodes that it passes.
    """
    key = ["depth", *_LANES]
    nodes = written(prefixes.groupBy(*key).agg(
        F.min("conv").alias("node"), F.count(F.lit(1)).alias("n_convs"), F.max("n_bytes").alias("n_bytes"),
        F.sum(F.col("length") - F.col("depth") + 1).alias("weight")), "trie-nodes")
    named = nodes.select(*key, "node")
    standing = nodes.select(F.col("node").alias("conv")).distinct()
    passed = prefixes.join(standing, "conv", "left_semi").join(named, key).select("conv", "depth", "node")
    above = passed.select("conv", (F.col("depth") + 1).alias("depth"), F.col("node").alias("parent"))
    paths = written(passed.join(above, ["conv", "depth"], "left"), "trie-paths")
    own = paths.filter("conv = node").select("node", "depth", "parent")
    children = own.groupBy(F.col("parent").alias("node"), (F.col("depth") - 1).alias("depth")).agg(F.count(F.lit(1)).alias("n_children"))
    nodes = (nodes.join(own, ["node", "depth"]).join(children.filter("node is not null"), ["node", "depth"], "left")
             .withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long"))))
    return nodes, paths


# ------------------------------------------------------------------ the rollup
def decompose(parent: np.ndarray, weight: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Subtree sums of ``values`` (one column each) in a forest, by centroid decomposition.

    ``parent`` is -1 for tops; ``weight`` is larger for a node than for all its children together.
    """
    total, weight = np.zeros_like(values), weight.copy()
    self_ = np.arange(len(parent))
    alive = np.ones(len(parent), bool)
    while alive.any():
        up = np.where(alive & (parent >= 0) & alive[parent], parent, self_)
        top = _roots(up)
        live = np.flatnonzero(alive)
        heavy = live[2 * weight[live] >= weight[top[live]]]
        heavy = heavy[np.lexsort((weight[heavy], top[heavy]))]
        centroid = heavy[np.flatnonzero(np.diff(top[heavy], prepend=-1))]
        # What lies below a centroid: cut above it, its part hangs on it.
        cut = up.copy()
        cut[centroid] = centroid
        root = _roots(cut)[live]
        place = np.full(len(parent), -1)
        place[centroid] = np.arange(len(centroid))
        below = place[root] >= 0
        part = np.zeros((len(centroid), values.shape[1]), values.dtype)
        np.add.at(part, place[root[below]], values[live[below]])
        # Add the part's total along the path to the top, and take its weight off.
        total[centroid] += part
        at, lost = centroid, weight[centroid]
        while True:
            on = up[at] != at
            at, part, lost = up[at[on]], part[on], lost[on]
            if not len(at):
                break
            total[at] += part
            weight[at] -= lost
        alive[centroid] = False
    return total


def _roots(up: np.ndarray) -> np.ndarray:
    while True:
        further = up[up]
        if (further == up).all():
            return up
        up = further


_STATE = ["node", "depth", "top", "top_depth", "parent", "weight", "leaves", "saved", "sum_leaves", "sum_saved"]
_STATE_TYPE = ", ".join(f"{c} long" for c in _STATE)


def _in_tasks(state: DataFrame) -> DataFrame:
    """``state`` with the sums of whole components added, each in one task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, ["top", "top_depth"]):
            c = {k: table.column(k).to_numpy() for k in _STATE if k != "parent"}
            parent = table.column("parent").fill_null(-1).to_numpy()  # the root has none
            starts = group_starts(table, ["top", "top_depth"])
            component = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
            order = np.lexsort((c["node"], c["depth"], component))
            key = _pairs(component[order], c["depth"][order], c["node"][order])
            wanted = _pairs(component, c["depth"] - 1, parent)
            at = np.minimum(np.searchsorted(key, wanted), len(key) - 1)
            found = key[at] == wanted
            up = np.where(found, order[at], -1)
            sums = decompose(up, c["weight"], np.stack([c["leaves"], c["saved"]], 1))
            c["sum_leaves"], c["sum_saved"] = c["sum_leaves"] + sums[:, 0], c["sum_saved"] + sums[:, 1]
            for batch in pa.table([table.column(k) if k == "parent" else pa.array(c[k], pa.int64()) for k in _STATE], _STATE).to_batches():
                yield batch

    by = ["top", "top_depth"]
    return state.select(*_STATE).repartition(*by).sortWithinPartitions(*by).mapInArrow(run, _STATE_TYPE)


def _pairs(*columns: np.ndarray) -> np.ndarray:
    """Rows as sortable records."""
    out = np.empty(len(columns[0]), dtype=[(f"f{i}", np.int64) for i in range(len(columns))])
    for i, c in enumerate(columns):
        out[f"f{i}"] = c
    return out


def _halved(state: DataFrame, paths: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(centroids, others): each component's centroid with its sums complete, and the smaller components."""
    tops = state.filter("node = top and depth = top_depth").select("top", "top_depth", F.col("weight").alias("whole"))
    heavy = state.join(tops, ["top", "top_depth"]).filter("2 * weight >= whole")
    centroids = heavy.groupBy("top", "top_depth").agg(F.min(F.struct("weight", "depth", "node")).alias("c")).select(
        "top", "top_depth", F.col("c.node").alias("c_node"), F.col("c.depth").alias("c_depth"), F.col("c.weight").alias("c_weight"))
    centroids = checkpointed(centroids)
    # A node lies below the centroid if it passes one of the centroid's children, which is its new top.
    step = paths.select(F.col("conv").alias("p_conv"), F.col("depth").alias("p_depth"), F.col("node").alias("p_node"),
                        F.col("parent").alias("p_parent"))
    placed = state.join(centroids, ["top", "top_depth"])
    deeper = placed.filter("depth > c_depth").join(
        step, (F.col("node") == F.col("p_conv")) & (F.col("p_depth") == F.col("c_depth") + 1))
    below = F.col("p_parent") == F.col("c_node")
    deeper = deeper.withColumn("is_below", below).withColumn("new_top", F.when(below, F.col("p_node")).otherwise(F.col("top"))).withColumn(
        "new_depth", F.when(below, F.col("p_depth")).otherwise(F.col("top_depth")))
    level = placed.filter("depth <= c_depth").withColumn("is_below", F.expr("node = c_node and depth = c_depth")).withColumn(
        "new_top", F.col("top")).withColumn("new_depth", F.col("top_depth"))
    cols = [*_STATE, "c_node", "c_depth", "c_weight", "is_below", "new_top", "new_depth"]
    placed = checkpointed(deeper.select(*cols).union(level.select(*cols)))
    parts = placed.filter("is_below").groupBy("c_node", "c_depth").agg(
        F.sum("leaves").alias("part_leaves"), F.sum("saved").alias("part_saved"))
    # The nodes from the centroid up to the top of its component.
    path = (centroids.join(parts, ["c_node", "c_depth"])
            .withColumn("at", F.explode(F.sequence("top_depth", "c_depth")))
            .join(step, (F.col("c_node") == F.col("p_conv")) & (F.col("at") == F.col("p_depth")))
            .select(F.col("p_node").alias("a_node"), F.col("at").alias("a_depth"), "part_leaves", "part_saved",
                    F.when(F.col("at") < F.col("c_depth"), F.col("c_weight")).otherwise(F.lit(0)).alias("lost")))
    after = placed.join(path, (F.col("node") == F.col("a_node")) & (F.col("depth") == F.col("a_depth")), "left")
    zero = F.lit(0).cast("long")
    after = checkpointed(after.select(
        "node", "depth", F.col("new_top").alias("top"), F.col("new_depth").alias("top_depth"), "parent",
        (F.col("weight") - F.coalesce("lost", zero)).alias("weight"), "leaves", "saved",
        (F.col("sum_leaves") + F.coalesce("part_leaves", zero)).alias("sum_leaves"),
        (F.col("sum_saved") + F.coalesce("part_saved", zero)).alias("sum_saved"),
        F.expr("node = c_node and depth = c_depth").alias("done")))
    return after.filter("done").select(*_STATE), after.filter("not done").select(*_STATE)


def _rolled(nodes: DataFrame, paths: DataFrame) -> DataFrame:
    """(node, depth, sum_leaves, sum_saved) of every node."""
    zero = F.lit(0).cast("long")
    root = nodes.filter("depth = 0").select("node").first()
    state = checkpointed(nodes.select(
        "node", "depth", F.lit(root["node"] if root else 0).cast("long").alias("top"), zero.alias("top_depth"), "parent",
        "weight", (F.col("n_children") == 0).cast("long").alias("leaves"),
        ((F.col("n_convs") - 1) * F.col("n_bytes")).alias("saved"), zero.alias("sum_leaves"), zero.alias("sum_saved")))
    done, small = [], []
    while True:
        large = state.filter(f"node = top and depth = top_depth and weight > {IN_TASK}").select("top", "top_depth")
        small.append(state.join(large, ["top", "top_depth"], "left_anti").select(*_STATE))
        large = state.join(large, ["top", "top_depth"], "left_semi").select(*_STATE)
        if large.isEmpty():
            break
        centroids, state = _halved(large, paths)
        done.append(centroids)
    out = _in_tasks(reduce(DataFrame.union, small))
    return reduce(DataFrame.union, done, out).select("node", "depth", "sum_leaves", "sum_saved")


def _ends(prefixes: DataFrame) -> DataFrame:
    """(depth, k1, k2, ends_sha256) of the prefixes that are whole conversations."""
    key = ["depth", *_LANES]
    pieces = (prefixes.filter("depth = length").withColumn("piece", F.expr(f"conv div {PIECE}")).groupBy(*key, "piece")
              .agg(F.array_join(F.sort_array(F.collect_list("conv")).cast("array<string>"), ",").alias("members")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([*((k, pa.int64()) for k in key), ("ends_sha256", pa.string())])
        last, digest = None, None
        for batch in batches:
            out = []
            for *node, members in zip(*(batch.column(i).to_pylist() for i in (*range(len(key)), len(key) + 1))):
                if node == last:
                    digest.update(b"," + members.encode())
                    continue
                if last is not None:
                    out.append((*last, digest.hexdigest()))
                last, digest = node, hashlib.sha256(members.encode())
            yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r)) for r in out], schema)
        if last is not None:
            yield pa.RecordBatch.from_pylist([dict(zip(schema.names, (*last, digest.hexdigest())))], schema)

    ordered = pieces.select(*key, "piece", "members").repartition(*key).sortWithinPartitions(*key, "piece")
    return ordered.mapInArrow(run, ", ".join(f"{k} long" for k in key) + ", ends_sha256 string")


def trie(convs: DataFrame, turns: DataFrame) -> DataFrame:
    """The nodes of the trie of conversations ``convs`` (conv, length) with ``turns`` (conv, pos from 1, role,
    content, n_bytes): conv_id (the smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens and ends_sha256 (of the members that end there).
    """
    ship(convs.sparkSession)
    prefixes = written(_prefixes(convs, turns), "trie-prefixes")
    nodes, paths = _nodes(prefixes)
    nodes = written(nodes, "trie-parents")
    sums = _rolled(nodes, paths)
    return (nodes.join(sums, ["node", "depth"]).join(_ends(prefixes), ["depth", *_LANES], "left")
            .select(F.col("node").alias("conv_id"), "depth", F.col("parent").alias("parent_conv_id"), "n_convs", "n_children",
                    F.col("sum_leaves").alias("n_leaves"), F.col("sum_saved").alias("saved_tokens"),
                    F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256")))


def trie_of(table: DataFrame, group: int = 1, heads: int = 1, **columns: str) -> DataFrame:
    """The trie of the conversations in ``table``; ``group`` and ``heads`` above 1 splice them first."""
    turns = written(turns_of(table, **columns), "trie-turns")
    return trie(*spliced(turns, group, heads))
