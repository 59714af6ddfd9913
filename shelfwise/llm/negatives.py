"""Hard negatives by threshold joins in the manner of L2AP.

An anchor's positives are its best rows of the same label by integer inner product.  For each of them, the
hard negatives are the best rows of another label whose score lies in a window below the positive's.  Both
are top-k searches, answered by threshold joins: find all rows that score at least t, for a t that is high
at first, and lower it for those anchors whose windows are not full yet.

A threshold join of a block of anchors with a block of rows uses an inverted index over dimensions, in the
order of their mass.  A row is listed under its leading dimensions only.  The rest is left out as soon as
the norm of what follows (its suffix), times the largest suffix norm of an anchor, is below the least
threshold: such a rest cannot reach it by itself, so a row that is in no list is no candidate.  Scores
are accumulated list by list; after every few lists a pair is dropped unless its partial score plus the
product of both remaining norms reaches its threshold.  Thresholds rise within a task as windows fill.
The exact score is computed for the survivors.  All bounds only drop what cannot count, so the result is
that of comparing everything.

Anchors are dealt into blocks, rows into units of several blocks; a pair of an anchor block and a unit is
one group, and returns at most k rows for each window.  Nothing is collected; a round that finds all
windows full ends the search.

Defined results: a component x counts as floor(``scale`` x).  Rows with a null label or id, a null vector
or null or non-finite components take no part.  Of rows that repeat an id, the least (label, vector)
counts.  Vectors of another length than the anchor's are not compared with it.  Ties go to the smaller id.
Scores beyond the range of long are cut to it.  An anchor without positives, and a positive without
negatives, has no row.  Ids are integers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.llm.common import checkpointed, ship, written

SCALE = 256
POSITIVES, NEGATIVES = 5, 5
#: A negative scores this share of the positive at least, and the shares at which the search begins.
LOWEST, SHARES = (80, 100), ((95, 100), (90, 100))
#: Shares of an anchor's product with itself at which its positives are looked for, before all count.
POSITIVE_SHARES = ((1, 2), (1, 5))
#: Vectors of a block of rows, blocks of a unit, and anchors of a block.
ROWS, BLOCKS, ANCHORS = 2048, 8, 2048
#: Anchors whose partial scores a task holds at once, and dimensions between two prunings.
AT_ONCE, LISTS = 256, 8
#: Share of pairs alive below which they are finished one by one.
SPARSE = 0.02
_LONG = np.iinfo(np.int64)


# ------------------------------------------------------------------ the threshold join of two blocks
def exact_scores(a: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Inner products, pair by pair, of integer vectors held as doubles."""
    if len(a) and np.abs(a).max(initial=0) * np.abs(x).max(initial=0) * a.shape[1] >= 2.0 ** 53:
        return np.array([min(max(sum(int(s) * int(t) for s, t in zip(u, v)), _LONG.min), _LONG.max)
                         for u, v in zip(a, x)], np.int64)
    return np.einsum("ij,ij->i", a, x).astype(np.int64)


def _suffix_norms(x: np.ndarray) -> np.ndarray:
    """Norms of the dimensions from k on, for k = 0 .. all (0)."""
    squares = np.cumsum((x * x)[:, ::-1], axis=1)[:, ::-1]
    return np.sqrt(np.concatenate([squares, np.zeros((len(x), 1))], axis=1))


class Index:
    """Rows by dimension; each row under its leading dimensions, as far as ``prepare`` was told to list it."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, x: np.ndarray):
        self.order = np.argsort(-(x * x).sum(0), kind="stable")
        self.ids, self.labels, self.x = ids, labels, x[:, self.order]
        self.norms = _suffix_norms(self.x)

    def join(self, a: np.ndarray, least: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(anchor, row, score): all pairs whose score reaches the anchor's threshold, and maybe others."""
        a, dim = a[:, self.order], self.x.shape[1]
        norms = _suffix_norms(a)
        slack = 0.5 + 1e-9 * norms[:, 0] * self.norms[:, 0].max(initial=0)
        for i in range(0, len(a), AT_ONCE):
            some = slice(i, min(i + AT_ONCE, len(a)))
            bar = (least[some] - slack[some])[:, None]
            # How many dimensions list a row: those before the first whose suffix can't reach any threshold.
            listed = (self.norms * norms[some].max(0) >= bar.min()).sum(1)
            listed = np.minimum(listed, dim)
            rows = np.argsort(-listed, kind="stable")
            rows = rows[:int((listed > 0).sum())]
            listed = listed[rows]
            partial = np.zeros((some.stop - i, len(rows)))
            alive = norms[some, :1] * self.norms[rows, 0] >= bar
            for k in range(0, dim, LISTS):
                n = int((listed > k).sum())
                if not n or alive.mean() < SPARSE:
                    break
                end = min(k + LISTS, dim)
                values = np.where(np.arange(k, end) < listed[:n, None], self.x[rows[:n], k:end], 0.0)
                partial[:, :n] += a[some, k:end] @ values.T
                # What is left of a row: its lists from here on, and what is in no list.
                left = np.minimum(end, listed)
                alive &= partial + norms[some][:, left] * self.norms[rows, left] >= bar
            p, r = np.nonzero(alive)
            for j in range(0, len(p), 1 << 16):
                q, s = p[j:j + (1 << 16)] + i, rows[r[j:j + (1 << 16)]]
                score = exact_scores(a[q], self.x[s])
                hit = score >= least[q] - slack[q]
                yield q[hit], s[hit], score[hit]


# ------------------------------------------------------------------ windows
def _best(found: pd.DataFrame, k: int) -> pd.DataFrame:
    """The k best of each (anchor, window): by score, then the smaller id."""
    found = found.sort_values(["anchor", "window", "score", "id"], ascending=[True, True, False, True], kind="stable")
    return found[found.groupby(["anchor", "window"]).cumcount() < k]


def _fill(anchors: pd.DataFrame, rows: pd.DataFrame, k: int, same: bool) -> pd.DataFrame:
    """(anchor_id, tag, id, score): the k best rows of a unit for each window of each anchor.

    An anchor's windows are lists ``tags``, ``lows``, ``highs`` of equal length.
    """
    a, tags = _vectors(anchors["v"]), anchors["tags"].to_list()
    window = np.array([len(t) for t in tags], np.int64)
    of = np.repeat(np.arange(len(a)), window)
    first = np.cumsum(window) - window
    low = np.concatenate([np.asarray(x, np.int64) for x in anchors["lows"]])
    high = np.concatenate([np.asarray(x, np.int64) for x in anchors["highs"]])
    tag = np.concatenate([np.asarray(x, np.int64) for x in tags])
    ids, labels = anchors["id"].to_numpy(np.int64), anchors["label"].to_numpy(np.int64)
    best = pd.DataFrame({"anchor": [], "window": [], "id": [], "score": []}, dtype=np.int64)
    threshold = low.copy()
    for _, block in rows.groupby("block"):
        parts = [(block, a, np.arange(len(a)))]
        if same:  # a label's rows with its anchors
            of_label = dict(list(block.groupby("label")))
            parts = [(of_label[y], a[labels == y], np.flatnonzero(labels == y)) for y in np.unique(labels) if y in of_label]
        found = [best]
        for part, vectors, place in parts:
            index = Index(part["id"].to_numpy(np.int64), part["label"].to_numpy(np.int64), _vectors(part["v"]))
            least = np.minimum.reduceat(threshold, first)[place].astype(float)
            for q, r, score in index.join(vectors, least):
                q = place[q]
                right = (index.ids[r] != ids[q]) & ((index.labels[r] == labels[q]) == same)
                q, r, score = q[right], r[right], score[right]
                many = window[q]
                w = np.repeat(first[q] - np.cumsum(many) + many, many) + np.arange(many.sum())
                r, score = np.repeat(r, many), np.repeat(score, many)
                inside = (score >= threshold[w]) & (score <= high[w])
                w = w[inside]
                found.append(pd.DataFrame({"anchor": of[w], "window": w, "id": index.ids[r[inside]], "score": score[inside]}))
                if sum(map(len, found)) > 1 << 20:
                    found = [_best(pd.concat(found), k)]
        best = _best(pd.concat(found), k)
        # A full window is interested in scores from its last one on.
        last = best.groupby("window")["score"].agg(["size", "min"])
        last = last[last["size"] >= k]
        threshold[last.index.to_numpy()] = last["min"].to_numpy()
    return pd.DataFrame({"anchor_id": ids[best["anchor"]], "tag": tag[best["window"]], "id": best["id"], "score": best["score"]})


def _vectors(column: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(column), np.float64).reshape(len(column), -1)


def _usable(vectors: DataFrame, scale: int, id_col: str, vector_col: str, label: Column) -> DataFrame:
    """(id, label, dim, v): rows that take part, one for each id, with their integers as bytes of doubles."""
    fit = (F.col("id").isNotNull() & F.col("label").isNotNull()
           & F.forall("x", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))
    rows = vectors.select(F.col(f"`{id_col}`").cast("long").alias("id"), label.cast("long").alias("label"),
                          F.col(f"`{vector_col}`").cast("array<double>").alias("x")).filter(fit)
    rows = rows.groupBy("id").agg(F.min(F.struct("label", "x")).alias("s")).select("id", "s.label", "s.x")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = b.column(2)
            ends = x.offsets.to_numpy() - x.offsets[0].as_py()
            flat = np.floor(scale * x.flatten().to_numpy(zero_copy_only=False)) + 0.0
            v = [flat[i:j].tobytes() for i, j in zip(ends[:-1], ends[1:])]
            own = [int(np.clip(flat[i:j] @ flat[i:j], 0, 2.0 ** 62)) for i, j in zip(ends[:-1], ends[1:])]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(np.diff(ends), pa.int32()), pa.array(v, pa.binary()), pa.array(own, pa.int64())],
                ["id", "label", "dim", "v", "own"])

    return rows.filter(F.size("x") > 0).mapInArrow(pack, "id long, label long, dim int, v binary, own long")


def _search(windows: DataFrame, rows: DataFrame, k: int, same: bool, sizes: tuple[int, int, int]) -> DataFrame:
    """(anchor_id, tag, rank, id, score): the k best rows of each window (anchor_id, tag, low, high)."""
    n_blocks, n_units, n_anchors = sizes
    asks = windows.groupBy("anchor_id").agg(F.sort_array(F.collect_list(F.struct("tag", "low", "high"))).alias("w"))
    asks = asks.join(rows.select(F.col("id").alias("anchor_id"), "label", "dim", "v"), "anchor_id").select(
        F.col("anchor_id").alias("id"), "label", "dim", "v", F.col("w.tag").alias("tags"), F.col("w.low").alias("lows"),
        F.col("w.high").alias("highs"))
    each = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    asks = asks.withColumn("part", F.pmod(F.xxhash64("id", F.lit(1)), F.lit(n_anchors)).cast("int")).withColumn("unit", each(n_units))
    block = F.pmod(F.xxhash64("id"), F.lit(n_blocks)).cast("int")
    units = rows.drop("own").withColumn("block", block).withColumn("unit", F.floor(F.col("block") / BLOCKS).cast("int")).withColumn("part", each(n_anchors))
    units = units.toDF(*units.columns)  # columns of its own: anchors are rows, too
    key = ["dim", "part", "unit"]

    def fill(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if len(left) and len(right):
            return _fill(left, right, k, same)
        return pd.DataFrame({c: np.zeros(0, np.int64) for c in ("anchor_id", "tag", "id", "score")})

    found = asks.groupBy(*key).cogroup(units.groupBy(*key)).applyInPandas(fill, "anchor_id long, tag long, id long, score long")
    order = Window.partitionBy("anchor_id", "tag").orderBy(F.col("score").desc(), "id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _rounds(windows: DataFrame, lows: list[Column], rows: DataFrame, k: int, same: bool, sizes) -> DataFrame:
    """The k best of each window, whose low end is one of ``lows`` after the other until it is full."""
    done, rest = None, windows
    for nth, low in enumerate(lows):
        last = nth == len(lows) - 1
        found = checkpointed(_search(rest.withColumn("low", low), rows, k, same, sizes))
        if not last:
            full = found.filter(F.col("rank") == k).select("anchor_id", "tag")
            rest = checkpointed(rest.join(full, ["anchor_id", "tag"], "left_anti"))
            found = found.join(full, ["anchor_id", "tag"])
        done = found if done is None else done.union(found)
        if not last and rest.isEmpty():
            break
    return done


def _at_least(share: tuple[int, int]) -> Column:
    """The least integer that is ``share`` of ``high`` or more, for ``high`` >= 0, within the range of long."""
    m, d = share
    return F.expr(f"(high div {d}) * {m} + ((high % {d}) * {m} + {d - 1}) div {d}")


def mine(vectors: DataFrame, is_anchor: Column, positives: int = POSITIVES, negatives: int = NEGATIVES, lowest=LOWEST,
         scale: int = SCALE, id_col: str = "vec_id", vector_col: str = "embedding", label: Column | None = None) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) of the rows for which
    ``is_anchor`` holds, a condition on the column ``id``.  ``label``: an expression over ``vectors``.
    """
    ship(vectors.sparkSession)
    rows = written(_usable(vectors, scale, id_col, vector_col, F.col("label") if label is None else label), "negatives-rows")
    n = rows.agg(F.count("*"), F.count_if(is_anchor)).first()
    n_blocks = max(1, -(-n[0] // ROWS))
    sizes = (n_blocks, -(-n_blocks // BLOCKS), max(1, -(-n[1] // ANCHORS)))
    asks = rows.filter(is_anchor).select(F.col("id").alias("anchor_id"), F.lit(0).cast("long").alias("tag"),
                                         F.lit(_LONG.max).alias("high"), "own")
    lows = [F.expr(f"(own div {d}) * {m}") for m, d in POSITIVE_SHARES]
    friends = _rounds(asks, [*lows, F.lit(_LONG.min)], rows, positives, True, sizes)
    asks = friends.select("anchor_id", F.col("id").alias("tag"), F.col("score").alias("high")).filter("high >= 0")
    lows = [_at_least(s) for s in SHARES if s[0] * lowest[1] > lowest[0] * s[1]]
    found = _rounds(asks, [*lows, _at_least(lowest)], rows, negatives, False, sizes)
    return found.join(asks, ["anchor_id", "tag"]).select(
        "anchor_id", F.col("tag").alias("positive_id"), "rank", F.col("id").alias("negative_id"),
        F.col("high").alias("positive_score"), F.col("score").alias("negative_score"))
