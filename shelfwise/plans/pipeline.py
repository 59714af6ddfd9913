"""Nightly rebuild and daily incremental run: sources -> base tables -> snapshot.

``rebuild`` writes the 21 base tables (plus branch coordinates) into a fresh
staging folder, submitting independent table jobs concurrently, records run
telemetry, and publishes atomically.  Marts then read the published base
tables instead of re-deriving them from the sources.
``incremental`` re-extracts only records changed since a watermark derived
from the live snapshot and upserts them by key (S07 + K04).
"""

from __future__ import annotations

import datetime as _dt
import time
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.functions.dates import JD_EPOCH
from shelfwise.operators import extract
from shelfwise.plans import publish, snapshots, storage
from shelfwise.sources.tables import first_rows

# Upserted by key in incremental mode; everything else is reloaded whole.
UPSERT_KEYS = {"record_metadata": "record_id", "bib": "bib_record_id", "item": "item_record_id",
               "bib_record": "id", "volume_record": "volume_record_id"}


def _write_all(tables: dict[str, DataFrame], build: str, workers: int,
               ended: Callable[[dict], None] = lambda stage: None) -> list[dict]:
    """Write all tables, some at a time; ``ended`` is told of each one as it ends."""

    def one(name: str) -> dict:
        t0 = time.perf_counter()
        rows = publish.write_table(tables[name], storage.join(build, name))
        stage = {"stage": name, "rows": rows, "elapsed_seconds": time.perf_counter() - t0}
        ended(stage)
        return stage

    with ThreadPoolExecutor(max_workers=workers) as pool:
        return list(pool.map(one, sorted(tables)))


def _run(spark: SparkSession, root: str, tables: Callable[[], dict[str, DataFrame]], telemetry, run_id: int,
         workers: int) -> dict:
    """Write a build, publish it with its run statistics, and record the run, failed or not."""
    started = _dt.datetime.now(_dt.timezone.utc).isoformat(timespec="seconds")
    t0 = time.perf_counter()
    if telemetry is not None:
        telemetry.start_run(run_id, started)
    ok = False

    def ended(stage: dict) -> None:
        if telemetry is not None:
            telemetry.record_stage(run_id, time.time_ns(), stage["stage"], stage["rows"], stage["elapsed_seconds"])

    try:
        base = snapshots.read(spark, root)
        build = publish.new_staging(spark, root)
        stats = _write_all(tables(), build, workers, ended)
        publish.run_stats_table(spark, started, stats).coalesce(1).write.mode("overwrite").parquet(
            storage.join(build, "_pipeline_run"))
        names = [s["stage"] for s in stats] + ["_pipeline_run"]
        publish.publish(spark, root, {n: storage.join(build, n) for n in names}, base)
        ok = True
        return {"build": build, "stats": stats}
    finally:
        if telemetry is not None:
            telemetry.finish_run(run_id, ok, time.perf_counter() - t0)


def rebuild(spark: SparkSession, sources: dict[str, DataFrame], root: str, as_of, since=None,
            telemetry=None, run_id: int = 1, workers: int = 4, sample: int | None = None) -> dict:
    """Full (or since-filtered) build of every base table, then atomic publish.

    ``sample=n`` keeps the first n rows of each table (a sample build).
    """

    def tables() -> dict[str, DataFrame]:
        out = extract.build_base_tables(sources, as_of, since)
        return out if sample is None else {n: first_rows(df, sample, df.columns[0]) for n, df in out.items()}

    return _run(spark, root, tables, telemetry, run_id, workers)


def watermark(record_metadata: DataFrame, default=_dt.date(1969, 1, 1)) -> _dt.date:
    """One day before the newest change in a snapshot (default: full rebuild)."""
    latest = record_metadata.agg(F.max("record_last_updated_julianday")).first()[0]
    if latest is None:
        return default
    return _dt.date(1970, 1, 1) + _dt.timedelta(days=int(latest) - JD_EPOCH - 1)


def watermark_table(record_metadata: DataFrame) -> DataFrame:
    """S07 as a table of one row: the day from which a daily run reads changes."""
    day = F.date_add(F.lit("1970-01-01").cast("date"), (F.max("record_last_updated_julianday") - JD_EPOCH - 1).cast("int"))
    return record_metadata.agg(day.alias("since"))


def incremental(spark: SparkSession, sources: dict[str, DataFrame], root: str, as_of, workers: int = 4,
                telemetry=None, run_id: int = 1) -> dict:
    """Daily run: changed records upserted by key, deletions removed, the rest reloaded."""
    live = publish.read_snapshot(spark, root, list(extract.BASE_TABLES))
    since = _dt.datetime.combine(watermark(live["record_metadata"]), _dt.time())

    def tables() -> dict[str, DataFrame]:
        changed = extract.build_base_tables(sources, as_of, since)
        deleted = (changed["record_metadata"].filter(F.col("deletion_julianday").isNotNull())
                   .select("record_id"))
        out = {}
        for name, df in changed.items():
            if name in UPSERT_KEYS:
                key = UPSERT_KEYS[name]
                gone = deleted.withColumnRenamed("record_id", key) if name in ("bib", "item") else None
                out[name] = publish.upsert(live[name], df, key, deleted_keys=gone)
            else:
                out[name] = df
        return out

    return _run(spark, root, tables, telemetry, run_id, workers) | {"since": since}


def land_sources(spark: SparkSession, sources: dict[str, DataFrame], folder: str, workers: int = 4) -> dict:
    """Land every source relation once as parquet (the extraction from the live
    source system) and return readers over the landed copies (S03)."""
    stats = _write_all(sources, folder, workers)
    from shelfwise.sources.tables import read_parquet_sources

    return {"sources": read_parquet_sources(spark, folder, list(sources)), "stats": stats}
