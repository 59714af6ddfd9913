"""A versioned log of snapshots, and K04 tables of key ranges that a delta rewrites in part.

Each publication is a numbered manifest under ``log/`` (table -> entry).  A publisher that has read version
n creates n + 1; the file system lets only one do so (rename without overwrite).  The loser reads what came
in between: changes of other tables, or of other key ranges of the same table, are carried over and the
commit is tried again; a change of what it replaces raises ``Conflict``, and a merge is then redone.  Older
versions stay readable until ``expire``, which keeps every folder that a kept version refers to.

A *ranged* table is cut by its integer key into ranges of ``span`` values, a folder each.  Its rows carry a
version, and a deleted key leaves a tombstone with the version of its deletion.  A delta is merged by
version, not by arrival: the newest version of a key counts, whether the table or the delta has it, so
deltas in any order, late or repeated, give the same table.  Only ranges that the delta's keys fall into are
read and written; the manifest refers to the others where they are.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.plans import storage

VERSION, DELETED, RANGE, SIGN = "_version", "_deleted", "_range", "_sign"
#: Rows that a range holds on average, when a table is cut.
ROWS_PER_RANGE = 1_000_000
TRIES = 8


class Conflict(RuntimeError):
    """Another publisher has replaced what this one replaces."""


@dataclass(frozen=True)
class Snapshot:
    version: int
    tables: dict[str, dict]


# ------------------------------------------------------------------ the log
def _log(root: str) -> str:
    return storage.join(root, "log")


def versions(spark: SparkSession, root: str) -> list[int]:
    """The versions that can be read, oldest first."""
    return sorted(int(n[:-5]) for n in storage.list_names(spark, _log(root)) if n.endswith(".json") and n[0].isdigit())


def _manifest(root: str, version: int) -> str:
    return storage.join(_log(root), f"{version:020d}.json")


def read(spark: SparkSession, root: str, version: int | None = None) -> Snapshot:
    """A version, the newest by default; version 0 is empty."""
    if version is None:
        version = max(versions(spark, root), default=0)
    if not version:
        return Snapshot(0, {})
    return Snapshot(version, json.loads(storage.read_text(spark, _manifest(root, version)))["tables"])


def _carried(base: dict | None, now: dict | None, new: dict, touched: set[str] | None) -> dict:
    """The entry to publish when the table has become ``now`` since ``base`` was read."""
    if now == base:
        return new
    ranged = touched is not None and base is not None and now is not None and "ranges" in now and now["span"] == base["span"]
    if not ranged or any(now["ranges"].get(r) != base["ranges"].get(r) for r in touched):
        raise Conflict("the table has changed since it was read")
    others = {r: p for r, p in now["ranges"].items() if r not in touched}
    return {**new, "ranges": others | {r: new["ranges"][r] for r in touched if r in new["ranges"]}}


def commit(spark: SparkSession, root: str, changes: dict[str, dict], base: Snapshot,
           touched: dict[str, set[str]] | None = None, whole: bool = False) -> Snapshot:
    """Publish ``changes`` (table -> entry) on top of what is newest; ``base`` is what they were made from.

    ``touched``: the key ranges that a change of a table replaces.  ``whole``: the snapshot has these
    tables only, whatever was there.
    """
    while True:
        live = read(spark, root)
        if whole:
            tables = dict(changes)
        else:
            tables = live.tables | {
                name: _carried(base.tables.get(name), live.tables.get(name), entry, (touched or {}).get(name))
                for name, entry in changes.items()}
        made = Snapshot(live.version + 1, tables)
        storage.make_dirs(spark, _log(root))
        if storage.create_text(spark, _manifest(root, made.version), json.dumps({"tables": tables}, sort_keys=True)):
            return made


def expire(spark: SparkSession, root: str, keep: int = 10) -> list[str]:
    """Drop all but the newest ``keep`` versions and the build folders that no kept version refers to.

    Returns the folders that went.  Builds that are being written must be over: they are not referred to.
    """
    every = versions(spark, root)
    kept = every[-keep:] if keep else []
    used = set()
    for v in kept:
        for entry in read(spark, root, v).tables.values():
            used |= set(entry["ranges"].values()) if "ranges" in entry else {entry["path"]}
    builds = storage.join(root, "builds")
    marks = {u.split("/builds/", 1)[1].split("/", 1)[0] for u in used if "/builds/" in u}
    gone = [storage.join(builds, n) for n in storage.list_names(spark, builds) if n not in marks]
    for v in every[:len(every) - len(kept)]:
        storage.delete(spark, _manifest(root, v))
    for folder in gone:
        storage.delete(spark, folder)
    return gone


# ------------------------------------------------------------------ merging by version
def merge_versions(existing: DataFrame, delta: DataFrame, key: str | list[str]) -> DataFrame:
    """Rows with version and deletion mark: of each key, those of the newest version that either side has.

    Rows of a key's version arrive together.  At equal versions a deletion wins, then what is there, so
    a repeated delta changes nothing; equal rows of a delta are one.
    """
    keys = [key] if isinstance(key, str) else list(key)
    rank = lambda here: F.col(DELETED).cast("int") * 2 + F.lit(here)
    rows = existing.withColumn("_rank", rank(1)).unionByName(
        delta.select(*existing.columns).distinct().withColumn("_rank", rank(0)))
    newest = F.max(F.struct(VERSION, "_rank")).over(Window.partitionBy(*keys))
    return (rows.withColumn("_newest", newest).filter(F.struct(VERSION, "_rank").eqNullSafe(F.col("_newest")))
            .select(*existing.columns))


def versioned(rows: DataFrame, version: Column, deleted: DataFrame | None = None) -> DataFrame:
    """``rows`` with their version, and tombstones of ``deleted`` (key columns and ``_version``)."""
    out = rows.withColumn(VERSION, version).withColumn(DELETED, F.lit(False))
    if deleted is None:
        return out
    return out.unionByName(deleted.distinct().withColumn(DELETED, F.lit(True)), allowMissingColumns=True).select(*out.columns)


def live_rows(rows: DataFrame) -> DataFrame:
    """The rows that are not deleted, without the marks."""
    return rows.filter(~F.col(DELETED)).drop(VERSION, DELETED)


def images(before: DataFrame, after: DataFrame, delta: DataFrame, key: str | list[str]) -> DataFrame:
    """The live rows of a delta's keys before (``SIGN`` -1) and after it is merged (``SIGN`` 1)."""
    keys = [key] if isinstance(key, str) else list(key)
    changed = delta.select(*[F.col(k).alias(f"_key{i}") for i, k in enumerate(keys)]).distinct()
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_key{i}")) for i, k in enumerate(keys)])
    side = lambda rows, sign: (
        live_rows(rows.join(changed, same, "left_semi")).withColumn(SIGN, F.lit(sign).cast("long")))
    return side(before, -1).unionByName(side(after, 1))


# ------------------------------------------------------------------ ranged tables
def _range(key: str, span: int) -> Column:
    return F.floor(F.col(key).cast("decimal(20,0)") / F.lit(span)).cast("long")


def _write_ranges(rows: DataFrame, path: str, key: str, span: int) -> dict[str, str]:
    """Write a folder for each key range; range -> folder."""
    (rows.withColumn(RANGE, _range(key, span)).repartitionByRange(RANGE, key).sortWithinPartitions(RANGE, key)
     .write.partitionBy(RANGE).parquet(path))
    names = [n for n in storage.list_names(rows.sparkSession, path) if n.startswith(f"{RANGE}=")]
    return {n.split("=", 1)[1]: storage.join(path, n) for n in names}


def _rows(spark: SparkSession, entry: dict, only: set[str] | None = None) -> DataFrame:
    """All rows of a ranged table, tombstones included, or those of some ranges."""
    schema = T.StructType.fromJson(json.loads(entry["schema"]))
    paths = [p for r, p in sorted(entry["ranges"].items()) if only is None or r in only]
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def table(spark: SparkSession, entry: dict) -> DataFrame:
    """A table of a snapshot: the rows of a ranged table that are not deleted, or a plain one."""
    return live_rows(_rows(spark, entry)) if "ranges" in entry else spark.read.parquet(entry["path"])


def _build(root: str, name: str) -> str:
    return storage.join(root, "builds", uuid.uuid4().hex, name)


def create_ranged(spark: SparkSession, root: str, name: str, rows: DataFrame, key: str,
                  rows_per_range: int = ROWS_PER_RANGE) -> Snapshot:
    """Publish ``rows`` (with version and deletion mark) as a ranged table."""
    base = read(spark, root)
    n = rows.agg(F.count(F.lit(1)), F.min(key), F.max(key)).first()
    span = max(1, int((n[2] - n[1] + 1) * rows_per_range // n[0])) if n[0] and n[1] is not None else rows_per_range
    entry = {"key": key, "span": span, "schema": rows.schema.json(), "ranges": _write_ranges(rows, _build(root, name), key, span)}
    return commit(spark, root, {name: entry}, base)


def merge_ranged(spark: SparkSession, root: str, name: str, delta: DataFrame,
                 also: Callable[[Snapshot, DataFrame], dict[str, dict]] | None = None) -> Snapshot:
    """Merge a delta (rows and tombstones, with version and deletion mark) into the ranges that its keys fall into.

    ``also`` gets the snapshot merged into and the images of the delta's keys; the entries that it returns
    are published with the table or not at all.  The delta is read several times and must be repeatable.
    """
    for _ in range(TRIES):
        base = read(spark, root)
        entry = base.tables[name]
        key, span = entry["key"], entry["span"]
        found = delta.select(_range(key, span).alias("r")).distinct().collect()  # not more than the table has ranges
        touched = {"__HIVE_DEFAULT_PARTITION__" if r["r"] is None else str(r["r"]) for r in found}
        if not touched:
            return base
        before = _rows(spark, entry, touched)
        ranges = _write_ranges(merge_versions(before, delta, key), _build(root, name), key, span)
        others = {r: p for r, p in entry["ranges"].items() if r not in touched}
        changes = {name: {**entry, "ranges": others | ranges}}
        if also is not None:
            changes |= also(base, images(before, _rows(spark, {**entry, "ranges": ranges}), delta, key))
        try:
            return commit(spark, root, changes, base, {name: touched})
        except Conflict:
            continue
    raise Conflict(f"{name}: another publisher changed the same ranges {TRIES} times")
