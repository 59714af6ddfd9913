"""Per-session cache of the source relations and base tables for a data folder."""

from __future__ import annotations

import datetime as _dt
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.operators import extract
from shelfwise.session import scratch_path
from shelfwise.sources.tables import load_sources, slices_for

# Reproducible "now" of the registered queries (the oracles use the same date).
AS_OF = _dt.date(2024, 2, 1)

_CACHE: dict[tuple, dict] = {}


def _key(spark: SparkSession, sf_dir: str) -> tuple:
    try:
        app = spark.sparkContext.applicationId
    except Exception:  # noqa: BLE001 - no SparkContext (e.g. Spark Connect)
        app = None
    return (id(spark), app, sf_dir)


def sources(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    key = _key(spark, sf_dir)
    if key not in _CACHE:
        _CACHE[key] = {"sources": load_sources(spark, sf_dir)}
    return _CACHE[key]["sources"]


def base(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    key = _key(spark, sf_dir)
    s = sources(spark, sf_dir)
    entry = _CACHE[key]
    if "base" not in entry:
        entry["base"] = extract.build_base_tables(s, AS_OF)
    return entry["base"]


def count_item_parts(spark: SparkSession, sf_dir: str) -> int:
    """In how many parts ``item_parts`` gives the items; few rows, or a session without scratch space, have one."""
    if scratch_path(spark) is None:
        return 1
    items, s = base(spark, sf_dir)["item"], sources(spark, sf_dir)
    return slices_for(items if _CACHE[_key(spark, sf_dir)].get("published") else s["item_record"])


def item_parts(spark: SparkSession, sf_dir: str, since=None) -> Iterator[DataFrame]:
    """The item table, or its records changed ``since``, in parts by a hash of the id."""
    items, s = base(spark, sf_dir)["item"], sources(spark, sf_dir)
    published, n = _CACHE[_key(spark, sf_dir)].get("published"), count_item_parts(spark, sf_dir)
    for k in range(n):
        if since is None and (published or n == 1):
            yield items if n == 1 else items.filter(F.pmod(F.xxhash64("item_record_id"), F.lit(n)) == k)
        else:
            yield extract.item(s, since, None if n == 1 else (k, n))


def use_snapshot(spark: SparkSession, sf_dir: str, root: str) -> None:
    """Serve ``base()`` for this folder from a published snapshot instead of re-deriving it."""
    from shelfwise.plans import publish

    names = list(extract.BASE_TABLES) + ["branch_locations"]
    sources(spark, sf_dir)
    _CACHE[_key(spark, sf_dir)]["published"] = True
    _CACHE[_key(spark, sf_dir)]["base"] = publish.read_snapshot(spark, root, names)
