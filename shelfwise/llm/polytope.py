"""Near-duplicate embeddings: cross-polytope hashing after fast Hadamard rotations.

A hash rotates the unit vector (three rounds of random signs and a fast Hadamard transform) and takes
the signed axis nearest to it; ``WIDTH`` hashes make a bucket, ``TABLES`` buckets are drawn, and a
vector is put into the ``PROBES`` likeliest buckets of each table (multiprobe).  Vectors that meet in a
bucket of their label are verified by cosine in double precision.  A pair that meets more than once is
counted only in the first bucket that both share, so links are counted without a list of pairs, and a
bucket gives at most one edge for each of its vectors (a spanning forest) to the components.

Equal vectors are one vector with a multiplicity throughout.  A bucket of more than ``TILE`` vectors is
cut into tiles, and pairs of tiles are joined in different tasks; nothing is capped.

Defined results: vectors that are null, empty, zero or hold null or non-finite components, and vectors
with a null label, link with nothing, as do vectors of different length.  Rows are told apart by
vec_id: of rows that repeat one, the least (label, vector) counts.  A null vec_id gives one row without
links and not kept.  An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.llm.common import checkpointed, mix, ship
from shelfwise.llm.components import connected

THRESHOLD = 0.93
TABLES = 6
WIDTH = 2
PROBES = 4
#: Vectors of a bucket that one task compares with each other.
TILE = 2048
#: Buckets up to this size are compared together.
SMALL = 16
SEED = 7


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of the rows, orthonormal; their length is a power of two."""
    n, d = x.shape
    h = 1
    while h < d:
        x = x.reshape(n, d // (2 * h), 2, h)
        x = np.stack([x[:, :, 0] + x[:, :, 1], x[:, :, 0] - x[:, :, 1]], axis=2)
        h *= 2
    return x.reshape(n, d) / np.sqrt(d)


def signatures(unit: np.ndarray, tables: int = TABLES, width: int = WIDTH, probes: int = PROBES,
               seed: int = SEED) -> np.ndarray:
    """(vectors, tables, probes): the likeliest buckets of each unit vector in each table."""
    n, d = unit.shape
    size = 1 << max(0, d - 1).bit_length()
    padded = np.zeros((n, size))
    padded[:, :d] = unit
    rng = np.random.default_rng([seed, size])
    best = min(probes, 2 * size)
    out = np.empty((n, tables, best if width == 1 else min(probes, best * best)), np.int64)
    for t in range(tables):
        axes, loss = [], []
        for _ in range(width):
            x = padded
            for _ in range(3):
                x = hadamard(x * rng.choice([-1.0, 1.0], size))
            both = np.concatenate([x, -x], axis=1)  # axis i, and its negative as size + i
            top = np.argpartition(-both, best - 1, axis=1)[:, :best] if best < 2 * size else np.tile(np.arange(best), (n, 1))
            value = np.take_along_axis(both, top, axis=1)
            order = np.argsort(-value, axis=1, kind="stable")
            top, value = np.take_along_axis(top, order, axis=1), np.take_along_axis(value, order, axis=1)
            axes.append(top)
            loss.append(value[:, :1] - value)
        code, cost = axes[0], loss[0]
        for a, c in zip(axes[1:], loss[1:]):
            code = (code[:, :, None] * (2 * size) + a[:, None, :]).reshape(n, -1)
            cost = (cost[:, :, None] ** 2 + c[:, None, :] ** 2).reshape(n, -1) ** 0.5
            pick = np.argsort(cost, axis=1, kind="stable")[:, :out.shape[2]]
            code, cost = np.take_along_axis(code, pick, axis=1), np.take_along_axis(cost, pick, axis=1)
        out[:, t, :] = code[:, :out.shape[2]]
    return out


def unit_vectors(vectors: pd.Series) -> np.ndarray:
    """Vectors of one length and none of them zero, scaled to length 1 in double precision."""
    x = np.stack(vectors.to_numpy()).astype(np.float64)
    x = x / np.abs(x).max(1, keepdims=True)  # so that squares neither overflow nor vanish
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def bucket_keys(unit: np.ndarray, **options) -> np.ndarray:
    """(vectors, tables * probes): 64-bit keys of all buckets of a vector, ascending."""
    sig = signatures(unit, **options)
    table = np.arange(sig.shape[1], dtype=np.uint64)[None, :, None]
    keys = mix(mix(sig.astype(np.uint64)) + table * np.uint64(0x9E3779B97F4A7C15))
    return np.sort(keys.reshape(len(sig), -1).view(np.int64), axis=1)


def _here_first(keys_a: np.ndarray, keys_b: np.ndarray, here: np.ndarray) -> np.ndarray:
    """Whether ``here`` is the least key that both have, for each pair of rows."""
    out = np.empty(len(keys_a), bool)
    for i in range(0, len(out), 20_000):
        a, b, h = keys_a[i:i + 20_000], keys_b[i:i + 20_000], here[i:i + 20_000, None]
        common = (a[:, :, None] == b[:, None, :]).any(2)
        out[i:i + 20_000] = ~(common & (a < h)).any(1)
    return out


class _Found:
    """Links counted and edges found in a task."""

    def __init__(self, ids: np.ndarray, copies: np.ndarray, keys: np.ndarray):
        self.ids, self.copies, self.keys = ids, copies, keys
        self.links = np.zeros(len(ids), np.int64)
        self.root = ids.copy()

    def add(self, a: np.ndarray, b: np.ndarray, here: np.ndarray) -> None:
        """Links between rows a and b, met in the buckets ``here``."""
        first = _here_first(self.keys[a], self.keys[b], here)
        np.add.at(self.links, a[first], self.copies[b[first]])
        np.add.at(self.links, b[first], self.copies[a[first]])


def _small_buckets(unit, starts, sizes, bucket, found: _Found, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """All linked pairs of the buckets that begin at ``starts``."""
    rows = np.repeat(starts, sizes) + (np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes))
    later = np.repeat(starts + sizes, sizes) - rows - 1
    a = np.repeat(rows, later)
    b = a + 1 + (np.arange(len(a)) - np.repeat(np.cumsum(later) - later, later))
    keep = []
    for i in range(0, len(a), 100_000):
        keep.append(np.einsum("ij,ij->i", unit[a[i:i + 100_000]], unit[b[i:i + 100_000]]) >= threshold)
    keep = np.concatenate(keep) if keep else np.zeros(0, bool)
    a, b = a[keep], b[keep]
    found.add(a, b, bucket[a])
    return a, b


def _forest(linked: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """The least id that each row reaches in a bucket's matrix of links."""
    label = ids.copy()
    while True:
        new = np.minimum(label, np.where(linked, label[None, :], np.iinfo(np.int64).max).min(1))
        if (new == label).all():
            return label
        label = new


def _join_rows(pdf: pd.DataFrame, threshold: float) -> pd.DataFrame:
    """(id, links, root) of rows sorted by (label, key, tile pair), for whole buckets."""
    lengths = pdf["vector"].map(len)
    if (lengths != lengths.iloc[0]).any():  # buckets of different spaces
        return pd.concat([_join_rows(part.reset_index(drop=True), threshold) for _, part in pdf.groupby(lengths)])
    unit = unit_vectors(pdf["vector"])
    keys = np.stack(pdf["keys"].to_numpy())
    found = _Found(pdf["rep"].to_numpy(np.int64), pdf["copies"].to_numpy(np.int64), keys)
    bucket, own = pdf["key"].to_numpy(np.int64), pdf["tile"].to_numpy(np.int64)
    group = pdf[["label", "key", "low", "high"]].to_numpy(np.int64)
    new = np.concatenate([[True], (group[1:] != group[:-1]).any(1)])
    starts = np.flatnonzero(new)
    sizes = np.diff(np.append(starts, len(pdf)))
    small = (sizes > 1) & (sizes <= SMALL) & (group[starts, 2] == group[starts, 3])
    a, b = _small_buckets(unit, starts[small], sizes[small], bucket, found, threshold)
    ids = found.ids
    edges = [np.stack([ids[a], ids[b]], 1)]
    for s, n in zip(starts[(sizes > 1) & ~small].tolist(), sizes[(sizes > 1) & ~small].tolist()):
        low, high = group[s, 2], group[s, 3]
        linked = unit[s:s + n] @ unit[s:s + n].T >= threshold
        np.fill_diagonal(linked, False)
        if low != high:  # links within a tile are counted by its own task
            linked &= own[s:s + n, None] != own[None, s:s + n]
        i, j = np.nonzero(np.triu(linked, 1))
        found.add(i + s, j + s, bucket[i + s])
        root = _forest(linked, ids[s:s + n])
        edges.append(np.stack([ids[s:s + n], root], 1))
    edges = np.concatenate(edges)
    edges = np.unique(np.sort(edges[edges[:, 0] != edges[:, 1]], axis=1), axis=0)
    some = found.links > 0
    return pd.concat([
        pd.DataFrame({"id": ids[some], "links": found.links[some], "root": ids[some]}),
        pd.DataFrame({"id": edges[:, 1], "links": 0, "root": edges[:, 0]})])


def link(vectors: DataFrame, threshold: float = THRESHOLD, tables: int = TABLES, width: int = WIDTH,
         probes: int = PROBES, seed: int = SEED, id_col: str = "vec_id", vector_col: str = "embedding",
         label_col: str = "label") -> DataFrame:
    """(vec_id, n_links, component_id, kept) of each vector."""
    ship(vectors.sparkSession)
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"),
                          F.col(vector_col).alias("vector"))
    element = rows.schema["vector"].dataType.elementType.simpleString()
    rows = rows.groupBy("id").agg(F.min(F.struct("label", "vector")).alias("row")).select("id", "row.*")
    fit = (F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("vector").isNotNull()
           & F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
           & F.exists("vector", lambda x: x != 0))
    rows = checkpointed(rows.withColumn("fit", F.coalesce(fit, F.lit(False))))
    equal = rows.filter("fit").groupBy("label", "vector").agg(F.min("id").alias("rep"), F.count("*").alias("copies"))

    def hash_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for dim, part in pdf.groupby(pdf["vector"].map(len)):
                for i in range(0, len(part), 2000):
                    some = part.iloc[i:i + 2000]
                    keys = bucket_keys(unit_vectors(some["vector"]), tables=tables, width=width, probes=probes, seed=seed)
                    # Vectors of other lengths are other spaces.
                    yield pd.DataFrame({"label": some["label"], "dim": int(dim), "rep": some["rep"],
                                        "copies": some["copies"], "vector": some["vector"], "keys": list(keys)})

    hashed = checkpointed(equal.mapInPandas(
        hash_rows, f"label long, dim int, rep long, copies long, vector array<{element}>, keys array<long>"))
    # A label number for each (label, length), so that one column tells spaces apart.
    hashed = hashed.withColumn("label", F.xxhash64("label", "dim"))
    # Large buckets are found, and noted with their vectors, by keys alone.
    place = hashed.select("label", "rep", F.explode("keys").alias("key"))
    large = checkpointed(place.groupBy("label", "key").count().filter(F.col("count") > TILE)
                         .select("label", "key", F.ceil(F.col("count") / TILE).alias("tiles")))
    if large.isEmpty():
        noted = hashed.withColumn("tiles_of", F.create_map().cast("map<bigint,bigint>"))
    else:
        held = place.join(large, ["label", "key"]).groupBy("rep").agg(
            F.map_from_entries(F.collect_list(F.struct("key", "tiles"))).alias("tiles_of"))
        noted = hashed.join(held, "rep", "left")
    tiled = (noted.withColumn("key", F.explode("keys"))
             .withColumn("tiles", F.coalesce(F.col("tiles_of")[F.col("key")], F.lit(1).cast("long")))
             .withColumn("tile", F.pmod(F.xxhash64("rep"), F.col("tiles")))
             .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1)))
             .withColumns({"low": F.least("tile", "other"), "high": F.greatest("tile", "other")}))
    order = ["label", "key", "low", "high"]
    tiled = tiled.select(*order, "tile", "rep", "copies", "vector", "keys").repartition(*order)
    tiled = tiled.sortWithinPartitions(*order, "rep")

    def join_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest = None
        for pdf in batches:
            pdf = pdf if rest is None else pd.concat([rest, pdf], ignore_index=True)
            last = (pdf[order] == pdf[order].iloc[-1]).all(axis=1).to_numpy()
            cut = int(np.argmax(last))  # the last bucket may go on in the next batch
            rest = pdf.iloc[cut:]
            if cut:
                yield _join_rows(pdf.iloc[:cut].reset_index(drop=True), threshold)
        if rest is not None:
            yield _join_rows(rest.reset_index(drop=True), threshold)

    found = checkpointed(tiled.mapInPandas(join_rows, "id long, links long, root long")
                         .groupBy("id", "root").agg(F.sum("links").alias("links")))
    links = found.groupBy("id").agg(F.sum("links").alias("links"))
    roots = connected(found.select(F.col("id").alias("a"), F.col("root").alias("b")))
    reps = (hashed.select("rep", "copies").join(links.withColumnRenamed("id", "rep"), "rep", "left")
            .join(roots.withColumnRenamed("node", "rep"), "rep", "left")
            .select("rep", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
                    F.coalesce("root", "rep").alias("component")))
    member = (rows.filter("fit").select("id", F.col("label").alias("l"), F.col("vector").alias("v"))
              .join(equal.select(F.col("label").alias("l"), F.col("vector").alias("v"), "rep"), ["l", "v"])
              .select("id", "rep").join(reps, "rep").select("id", "n_links", "component"))
    return rows.select("id").join(member, "id", "left").select(
        F.col("id").alias("vec_id"), F.coalesce("n_links", F.lit(0)).alias("n_links"),
        F.coalesce("component", "id").alias("component_id"),
        F.coalesce(F.coalesce("component", "id") == F.col("id"), F.lit(False)).alias("kept"))
