"""Exact top-k by integer inner product, pruned with multi-resolution segment statistics.

A vector is cut into 1, 2, 4, ... segments; of each segment its sum and the length of its deviation
from the mean are kept.  For a query q and a candidate x of the same length,

    q.x <= sum over segments of  sum(q) sum(x) / n + dev(q) dev(x)

(the squared distance is |q|^2 + |x|^2 - 2 q.x, so this is a lower bound of the distance), and finer
segments give a tighter bound.  Candidates whose bound falls below the k-th best score found so far are
dropped level by level, coarse to fine; the exact score is computed for the survivors.

Queries and candidates are dealt into blocks, and each pair of blocks is one group, so no task holds
more than a block of each; each group returns its k best, which are ranked per query.

Defined results: a component x counts as floor(1024 x).  Vectors that are null or hold null or
non-finite components take no part, nor does a null id.  Vectors of another length than the query's are
not its candidates.  Rows are told apart by id: of rows that repeat one, the least vector counts.  Ties go
to the smaller id.  Scores beyond the range of long are cut to it.  Without candidates a query has no row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.llm.common import checkpointed, ship

K = 10
#: Vectors of a block of candidates, and of a block of queries.
CANDIDATES, QUERIES = 4096, 2048
#: Queries whose bounds a task holds at once.
AT_ONCE = 128
#: Survivors, as a share of all pairs, below which pairs are followed one by one.
SPARSE = 0.05
_LONG = np.iinfo(np.int64)


def statistics(x: np.ndarray, segments: int) -> np.ndarray:
    """Per vector the scaled sums and deviations of its segments: a.b of two rows bounds x.y."""
    cuts = np.linspace(0, x.shape[1], segments + 1).astype(int)
    sizes = np.diff(cuts)
    sums = np.add.reduceat(x, cuts[:-1], axis=1)
    squares = np.add.reduceat(x * x, cuts[:-1], axis=1)
    return np.concatenate([sums / np.sqrt(sizes), np.sqrt(np.maximum(squares - sums * sums / sizes, 0))], axis=1)


def levels(dim: int) -> list[int]:
    out, s = [], 1
    while s < dim:
        out.append(s)
        s *= 2
    return out


def _scores(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Exact inner products of integer vectors that are held as doubles, pair by pair."""
    if len(q) and np.abs(q).max(initial=0) * np.abs(x).max(initial=0) * q.shape[1] >= 2.0 ** 53:
        return np.array([min(max(sum(int(a) * int(b) for a, b in zip(r, s)), _LONG.min), _LONG.max)
                         for r, s in zip(q, x)], np.int64)
    return np.einsum("ij,ij->i", q, x).astype(np.int64)


def _search(q_ids, q, x_ids, x, k: int) -> Iterator[tuple]:
    """(query id, candidate id, score) of at least the k best candidates of each query."""
    dim = q.shape[1]
    fine = levels(dim)
    of_q, of_x = {s: statistics(q, s) for s in fine}, {s: statistics(x, s) for s in fine}
    slack = 0.5 + 1e-9 * np.sqrt((q * q).sum(1)) * np.sqrt((x * x).sum(1).max(initial=0))
    for i in range(0, len(q), AT_ONCE):
        rows = slice(i, min(i + AT_ONCE, len(q)))
        m = rows.stop - i
        other = q_ids[rows, None] != x_ids[None, :]
        best = np.full(m, -np.inf)
        alive = other
        dense = True
        for s in fine:
            if dense:
                bound = of_q[s][rows] @ of_x[s].T
                if s == fine[0] and len(x) > k + 1:
                    # The candidates with the highest coarse bounds give a first k-th best score.
                    likely = np.argpartition(-bound, min(4 * k, len(x) - 1), axis=1)[:, :4 * k + 1]
                    a = np.repeat(np.arange(m), likely.shape[1])
                    b = likely.ravel()
                    score = _scores(q[i + a], x[b]).astype(float)
                    score[~other[a, b]] = -np.inf
                    score = np.sort(score.reshape(m, -1), axis=1)
                    if score.shape[1] >= k:
                        best = score[:, -k] - slack[rows]
                alive = alive & (bound >= best[:, None])
                if alive.mean() < SPARSE:
                    dense = False
                    a, b = np.nonzero(alive)
            else:
                keep = np.einsum("ij,ij->i", of_q[s][i + a], of_x[s][b]) >= best[a]
                a, b = a[keep], b[keep]
        if dense:
            a, b = np.nonzero(alive)
        for j in range(0, m, 16):  # exact scores of the survivors
            lo, hi = np.searchsorted(a, [j, min(j + 16, m)])
            pa, pb = a[lo:hi], b[lo:hi]
            score = _scores(q[i + pa], x[pb])
            order = np.lexsort((x_ids[pb], -score.astype(object) if len(score) and score.min() == _LONG.min else -score, pa))
            pa, pb, score = pa[order], pb[order], score[order]
            nth = np.arange(len(pa)) - np.searchsorted(pa, pa)
            top = nth < k
            yield q_ids[i + pa[top]], x_ids[pb[top]], score[top]


def top_k(vectors: DataFrame, is_query, k: int = K, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the k best candidates of each row for which ``is_query`` holds.

    ``is_query`` is a condition on the column ``id``.
    """
    ship(vectors.sparkSession)
    fit = F.col("id").isNotNull() & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
    rows = rows.filter(fit).groupBy("id").agg(F.min("v").alias("v")).withColumn("dim", F.size("v"))
    rows = checkpointed(rows.withColumn("asks", is_query))
    n = rows.agg(F.count("*"), F.count_if("asks")).first()
    n_x, n_q = max(1, -(-n[0] // CANDIDATES)), max(1, -(-n[1] // QUERIES))
    whole = lambda c, blocks: F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    key = ["dim", "q_block", "x_block"]
    xs = rows.select("dim", F.pmod(F.xxhash64("id"), F.lit(n_x)).cast("int").alias("x_block"), "id", "v")
    xs = xs.withColumn("q_block", whole("q", n_q))
    qs = rows.filter("asks").select("dim", F.pmod(F.xxhash64("id", F.lit(1)), F.lit(n_q)).cast("int").alias("q_block"), "id", "v")
    qs = qs.withColumn("x_block", whole("x", n_x))

    def search(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(left) and len(right):
            q, x = (np.floor(1024.0 * np.stack(p["v"].to_numpy()).astype(float)).reshape(len(p), -1) for p in (left, right))
            for a, b, s in _search(left["id"].to_numpy(np.int64), q, right["id"].to_numpy(np.int64), x, k):
                out.append(pd.DataFrame({"query_id": a, "vec_id": b, "score": s}))
        return pd.concat(out) if out else pd.DataFrame({c: np.zeros(0, np.int64) for c in ("query_id", "vec_id", "score")})

    found = (qs.groupBy(*key).cogroup(xs.groupBy(*key))
             .applyInPandas(search, "query_id long, vec_id long, score long"))
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return (found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
