"""Sharding by a minimax contiguous partition of atomic groups.

Rows of equal text are one group and stay together.  Groups stand in the order of their text's MD5, which
is a shuffle that any engine can repeat, and are laid end to end: a group ends at the sum of the sizes up
to itself.  The shards are stretches of that line.  The smallest capacity that suffices is found by binary
search; a capacity is checked greedily, each shard taking as many groups as fit.  Then the line is cut:
every cut takes the group end that is nearest to an even share of what is left, among those that keep all
shards within the capacity.  So no partition of this order has a smaller largest shard, and the shards
before and after a huge group stay near each other in size.

The driver never sees the groups.  It holds some of the ends, and for each gap between two of them whether
more ends lie inside.  With these, the greedy check and the cuts are computed as intervals: the least and
the greatest end that a look-up may give.  Where they differ and the answer depends on it, one job returns
the first and last end of each of at most ``BINS`` slices of the gaps in doubt, and the check is repeated.
Each round narrows the doubt by a large factor, so a few jobs, which read only the stretches in doubt,
give the exact result at any size.

Slots number the rows of a shard in the order of the groups and, within a group, of the MD5 of the id.
Numbers are made of the totals of cells (``CELL_ROWS`` rows on average) and of positions within a cell:
a text that a third of all rows share has many cells.

Defined results: a null text is a group with the empty text, of no bytes and checksum 0.  Rows are told
apart by all their columns; repeated rows are rows of their own.  A shard may stay empty where there are
fewer groups than shards or one group is larger than an even share.  An empty table gives no rows.
An input column that is named like a result gives way to it.  Results depend on the rows alone.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.llm.common import checkpointed, written

SHARDS = 16
#: Rows that a job returns to the driver at most, while it looks for the capacity and the cuts.
BINS = 1 << 14
#: Ranges of the order whose sums meet in one task.
PARTS = 1 << 14
#: Rows of a group that are numbered together on average.
CELL_ROWS = 5_000


class Ends:
    """Some of the groups' ends on the line, 0 and the last included, and where more lie between."""

    def __init__(self, total: int, groups: int):
        self.at = np.array([0, total], np.int64)
        self.open = np.array([groups > 1])
        self.total = total
        self.doubts: set[tuple[int, int]] = set()
        self.spans: list[tuple[int, int]] = []

    def last(self, x: int) -> tuple[int, int]:
        """Bounds of the last end at or before ``x``."""
        if x >= self.total:
            return self.total, self.total
        i = int(np.searchsorted(self.at, x, "right")) - 1
        known = int(self.at[i])
        return known, x if self.open[i] else known

    def first(self, x: int) -> tuple[int, int]:
        """Bounds of the first end at or after ``x`` (within the line)."""
        i = int(np.searchsorted(self.at, x, "left"))
        known = int(self.at[i])
        return (x if i and self.open[i - 1] else known), known

    def doubt(self, low: int, high: int) -> None:
        """Ask for the ends of the open gaps that meet low..high."""
        i = max(0, int(np.searchsorted(self.at, low, "right")) - 1)
        gaps = np.arange(i, max(i, int(np.searchsorted(self.at[:-1], high, "right"))))
        gaps = gaps[self.open[gaps]]
        if len(gaps):
            self.doubts |= {(int(self.at[g]), int(self.at[g + 1])) for g in gaps}
            self.spans.append((int(self.at[gaps[0]]), int(self.at[gaps[-1] + 1])))

    def windows(self, bins: int) -> tuple[list[tuple[int, int]], int]:
        """The spans in doubt, joined where they meet (a few for each shard), and the width of a slice.

        Slices lie where ends are, so closed gaps within a span take none.
        """
        out: list[tuple[int, int]] = []
        for low, high in sorted(self.spans):
            if out and low <= out[-1][1]:
                out[-1] = (out[-1][0], max(high, out[-1][1]))
            else:
                out.append((low, high))
        return out, max(1, -(-sum(b - a for a, b in self.doubts) // bins))

    def learn(self, windows: list[tuple[int, int]], slices: list[tuple[int, int, int]]) -> None:
        """(first end, last end, ends) of slices that cover the windows: only within a slice can more lie."""
        old = dict(zip(self.at.tolist(), [*self.open.tolist(), False]))
        at = np.unique(np.concatenate([self.at, *[np.array(x[:2], np.int64) for x in slices]]))
        inside = np.zeros(len(at) - 1, bool)
        for low, high in windows:
            a, b = np.searchsorted(at, [low, high])
            inside[a:b] = True
        self.open = np.array([old.get(int(x), False) for x in at[:-1]]) & ~inside
        for first, last, n in slices:
            a, b = np.searchsorted(at, [first, last])
            self.open[a:b] = n > b - a + 1
        self.at, self.doubts, self.spans = at, set(), []


def _reach(ends: Ends, capacity: int, shards: int) -> list[tuple[int, int]]:
    """Bounds of where each of the shards ends that greedily take what fits."""
    low = high = 0
    out = []
    for _ in range(shards):
        low, high = ends.last(low + capacity)[0], ends.last(high + capacity)[1]
        out.append((low, high))
    return out


def _least(surely, low: int, high: int) -> int:
    """The least capacity in (low, high] for which ``surely`` holds; it holds for ``high``."""
    while high - low > 1:
        middle = (low + high) // 2
        low, high = (low, middle) if surely(middle) else (middle, high)
    return high


def smallest_capacity(ends: Ends, largest: int, shards: int, ask) -> int:
    """Binary search for the least capacity of a contiguous partition; ``ask`` resolves the doubts."""
    if not ends.total:
        return 0
    low, high = max(largest, -(-ends.total // shards)) - 1, ends.total
    while True:
        high = _least(lambda c: _reach(ends, c, shards)[-1][0] >= ends.total, low, high)
        low = _least(lambda c: _reach(ends, c, shards)[-1][1] >= ends.total, low, high) - 1
        if high - low == 1:
            return high
        for (a, _), (_, b) in zip(_reach(ends, low + 1, shards), _reach(ends, high, shards)):
            ends.doubt(a, b)
        ask(ends)


def even_cuts(ends: Ends, capacity: int, shards: int, ask) -> list[int]:
    """The end of each shard: near even shares of what is left, none above the capacity."""
    while True:
        # earliest[k]: the first end from which the capacity takes shards - k shards to the end of the line.
        earliest = [(ends.total, ends.total)]
        for _ in range(shards - 1):
            low, high = earliest[-1]
            earliest.append((ends.first(max(0, low - capacity))[0], ends.first(max(0, high - capacity))[1]))
        earliest = earliest[::-1]
        cuts, sure, low, high = [], True, 0, 0
        for k in range(shards):
            if k == shards - 1:
                cuts.append(ends.total)
                break
            bounds = [_cut(ends, p, earliest[k], capacity, shards - k) for p in (low, high)]
            low, high = bounds[0][0], bounds[1][1]
            cuts.append(high)
            if low != high:
                sure = False
                ends.doubt(low, high)
                for a, b in (bounds[0], bounds[1], earliest[k]):
                    ends.doubt(a, b)
        if sure:
            return cuts
        ask(ends)


def _cut(ends: Ends, start: int, earliest: tuple[int, int], capacity: int, left: int) -> tuple[int, int]:
    """Bounds of the cut after ``start`` when ``left`` shards share what follows."""
    share = start + (ends.total - start) // left
    before, after = ends.last(share), ends.first(share)
    latest = ends.last(start + capacity)
    if before[0] == before[1] and after[0] == after[1]:
        near = after[0] if before[0] <= start or after[0] - share < share - before[0] else before[0]
        low = high = near
    else:
        low, high = max(before[0], start), after[1]
    low, high = min(max(low, earliest[0]), latest[0]), min(max(high, earliest[1]), latest[1])
    return low, max(low, high)


def _md5_range(key: str, parts):
    """The place of an MD5 among ``parts`` equal ranges."""
    return F.floor(F.conv(F.substring(key, 1, 8), 16, 10).cast("long") * parts / F.lit(1 << 32)).cast("long")


def _group_ends(groups: DataFrame) -> DataFrame:
    """Groups with ``end`` and ``rows_upto``: sizes and rows of this and all earlier groups, by key."""
    groups = groups.withColumn("_part", _md5_range("key", F.lit(PARTS)))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # PARTS rows
    totals = groups.groupBy("_part").agg(F.sum("bytes").alias("_b"), F.sum("rows").alias("_r")).select(
        "_part", F.coalesce(F.sum("_b").over(before), F.lit(0)).alias("_b0"),
        F.coalesce(F.sum("_r").over(before), F.lit(0)).alias("_r0"))
    inside = Window.partitionBy("_part").orderBy("key").rowsBetween(Window.unboundedPreceding, 0)
    return groups.join(totals, "_part").select(
        "key", "bytes", "rows", (F.col("_b0") + F.sum("bytes").over(inside)).alias("end"),
        (F.col("_r0") + F.sum("rows").over(inside)).alias("rows_upto"))


def _asker(groups: DataFrame, bins: int):
    """Resolves the doubts of some ends by one job over the groups that end inside them."""

    def ask(ends: Ends) -> None:
        windows, width = ends.windows(bins)
        inside, window = F.lit(False), F.lit(0)
        for a, b in windows:
            inside = inside | ((F.col("end") > a) & (F.col("end") < b))
            window = window + F.when(F.col("end") > a, 1).otherwise(0)
        slices = groups.filter(inside).groupBy(window, F.floor(F.col("end") / width)).agg(
            F.min("end").alias("a"), F.max("end").alias("b"), F.count(F.lit(1)).alias("n"))
        ends.learn(windows, [(r["a"], r["b"], r["n"]) for r in slices.select("a", "b", "n").collect()])

    return ask


RESULTS = ("size", "text_crc32", "shard", "slot")


def assign(docs: DataFrame, shards: int = SHARDS, id_col: str = "doc_id", text_col: str = "text",
           keep_text: bool = False, bins: int = BINS) -> DataFrame:
    """The rows of ``docs``: (*columns, size, text_crc32, shard, slot), the text only with ``keep_text``."""
    names = [c for c in docs.columns if c not in RESULTS and (keep_text or c != text_col)]
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    # One pass over the texts; unless they are kept, only fingerprints move from here on.
    rest = F.struct(F.lit(0).alias("none"), *[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)])
    told = F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns) if c != text_col])
    nth_id = F.md5(F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")).cast("binary"))
    rows = written(docs.select(
        rest.alias("rest"), F.md5(text.cast("binary")).alias("key"), F.octet_length(text).cast("long").alias("n_bytes"),
        F.crc32(text.cast("binary")).alias("crc"), nth_id.alias("draw"), F.xxhash64(F.to_json(told)).alias("told")), "shard-rows")
    groups = rows.groupBy("key").agg(F.count(F.lit(1)).alias("rows"), F.max("n_bytes").alias("n_bytes"))
    groups = checkpointed(groups.select("key", "rows", (F.col("rows") * (F.col("n_bytes") + 1)).alias("bytes")))
    n = groups.agg(F.count(F.lit(1)), F.max("bytes"), F.sum("bytes")).first()
    groups = written(_group_ends(groups), "shard-groups")
    ends, ask = Ends(n[2] or 0, n[0]), _asker(groups, bins)
    cuts = even_cuts(ends, smallest_capacity(ends, n[1] or 0, shards, ask), shards, ask)
    shard = sum((F.when(F.col("end") > c, 1).otherwise(0) for c in cuts[:-1]), F.lit(0))
    starts = {r["end"]: r["rows_upto"] for r in groups.filter(F.col("end").isin(sorted(set(cuts)))).collect()}
    first = F.element_at(F.array(F.lit(0).cast("long"), *[F.lit(starts.get(c, 0)).cast("long") for c in cuts[:-1]]),
                         (F.col("shard") + 1).cast("int"))
    placed = groups.withColumn("shard", shard).select(
        "key", "shard", (F.col("rows_upto") - F.col("rows") - first).alias("slot0"),
        F.ceil(F.col("rows") / CELL_ROWS).alias("cells"))
    # A cell of a group: rows whose draw lies in one range.
    rows = written(rows.join(placed, "key").withColumn("cell", _md5_range("draw", F.col("cells"))), "shard-placed")
    counts = rows.filter("cells > 1").groupBy("key", "cell").agg(F.count(F.lit(1)).alias("n"))
    of_key = Window.partitionBy("key").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("key", "cell", F.coalesce(F.sum("n").over(of_key), F.lit(0)).alias("cell0"))
    in_cell = Window.partitionBy("key", "cell").orderBy("draw", "told")
    rows = rows.repartition("key", "cell").withColumn("nth", F.row_number().over(in_cell))
    return rows.join(offsets, ["key", "cell"], "left").select(
        *[F.col(f"rest.c{i}").alias(c) for i, c in enumerate(names)],
        (F.col("n_bytes") + 1).alias("size"), F.col("crc").alias("text_crc32"), F.col("shard").cast("int").alias("shard"),
        (F.col("slot0") + F.coalesce("cell0", F.lit(0)) + F.col("nth") - 1).alias("slot"))


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS, id_col: str = "doc_id",
                 text_col: str = "text") -> None:
    """A folder ``shard=k`` of Parquet files for each shard, its rows by slot; large shards have many files."""
    rows = assign(docs, shards, id_col, text_col, keep_text=True)
    (rows.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot")
     .write.partitionBy("shard").parquet(path))
