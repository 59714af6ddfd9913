"""Sinks and write modes (K01-K08): staged build, atomic publish, upsert, exports.

A snapshot is a set of parquet tables.  A build writes tables into a fresh
staging folder; only when all succeed is a new manifest (table -> path) added
to the snapshot log (``plans/snapshots.py``), so readers always see either the
old or the new snapshot, never a mix.  Failed builds leave the live snapshot
untouched.  A build that renews some tables carries the others over by their
paths.  All paths are on the cluster's storage (any Hadoop URI).

Tables are stored as plain parquet, not bucketed: joins on a hot title then
pass a shuffle, whose partitions can be split at run time.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.plans import snapshots, storage


def write_table(df: DataFrame, path: str, *, mode: str = "overwrite", partition_by=None) -> int:
    """Write one table and return its row count from the same job.

    The count is an ``Observation`` metric collected while writing, not a
    second pass over the data.
    """
    obs = Observation(f"rows_{uuid.uuid4().hex[:8]}")
    writer = df.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return int(obs.get["rows"])


def _iso_time(c):
    """ISO text of a timestamp; microseconds only where there are any, as Python's isoformat."""
    return F.when(F.date_format(c, "SSSSSS") == "000000", F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss")).otherwise(
        F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"))


_KEEP_NULLS = {"ignoreNullFields": "false"}


def encode_for_text(df: DataFrame) -> DataFrame:
    """arrays/structs/maps as JSON text, dates and timestamps as ISO text (text sinks only)."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.ArrayType, T.StructType, T.MapType)):
            c = F.to_json(c, _KEEP_NULLS)
        elif isinstance(f.dataType, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(f.dataType, T.TimestampType):
            c = _iso_time(c)
        cols.append(c.alias(f.name))
    return df.select(*cols)


def new_staging(spark: SparkSession, root: str) -> str:
    """A fresh build folder under ``root`` (never reused, never cleared)."""
    path = storage.join(root, "builds", uuid.uuid4().hex)
    storage.make_dirs(spark, path)
    return path


def publish(spark: SparkSession, root: str, tables: dict[str, str], base: snapshots.Snapshot | None = None) -> None:
    """Atomically make ``tables`` (name -> path) the snapshot of ``root``.

    With ``base``, the snapshot from which the run started, the other tables stay, also those that were
    published meanwhile; a table that another run has replaced meanwhile raises ``snapshots.Conflict``.
    """
    entries = {n: {"path": p} for n, p in tables.items()}
    snapshots.commit(spark, root, entries, base or snapshots.Snapshot(0, {}), whole=base is None)


def current(spark: SparkSession, root: str, version: int | None = None) -> dict[str, str]:
    """Plain tables of a published snapshot (name -> path), the newest by default; empty before the first."""
    return {n: e["path"] for n, e in snapshots.read(spark, root, version).tables.items() if "path" in e}


def read_snapshot(spark: SparkSession, root: str, names=None, version: int | None = None) -> dict[str, DataFrame]:
    """The snapshot's tables, all or the named ones, of the newest or an older version."""
    live = snapshots.read(spark, root, version).tables
    if not live:
        raise FileNotFoundError(f"no published snapshot under {root}")
    return {n: snapshots.table(spark, live[n]) for n in (names or sorted(live))}


def upsert(existing: DataFrame, delta: DataFrame, key: str | list[str], order_col: str | None = None,
           deleted_keys: DataFrame | None = None) -> DataFrame:
    """The rows of a key are replaced by those the delta has for it; optional deletes.

    A key may have several rows (an item linked to two titles, a volume that
    spans two): all rows of the delta count, or with ``order_col`` all rows of
    a key's newest version, be it the delta's or the one that is there (the
    delta's at a tie).  Keys listed in ``deleted_keys`` are removed.
    """
    keys = [key] if isinstance(key, str) else list(key)
    if order_col is not None:
        newest = F.max(F.struct(order_col, "_new")).over(Window.partitionBy(*keys))
        both = existing.withColumn("_new", F.lit(0)).unionByName(delta.withColumn("_new", F.lit(1)))
        out = both.withColumn("_newest", newest).filter(F.struct(order_col, "_new").eqNullSafe(F.col("_newest")))
        return (out if deleted_keys is None else out.join(deleted_keys.select(*keys), keys, "left_anti")).select(*existing.columns)
    out = existing.join(delta.select(*keys).distinct(), keys, "left_anti")
    if deleted_keys is not None:
        # Both sides before the union, after which rows would be dealt out by the keys once more.
        gone = deleted_keys.select(*keys)
        out, delta = out.join(gone, keys, "left_anti"), delta.join(gone, keys, "left_anti")
    return out.select(*existing.columns).unionByName(delta).select(*existing.columns)


def export_csv(df: DataFrame, path: str, columns: list[str], sep: str = "|", quote_all: bool = True) -> None:
    """Delimited text export of a column subset with a header row.

    Spark's CSV writer quotes either all fields or only those that need it;
    ``export_nonnumeric_quoted`` reproduces the source exporter's "quote every
    non-numeric field" format exactly.
    """
    (encode_for_text(df.select(*columns)).write.mode("overwrite")
     .option("header", True).option("sep", sep).option("quoteAll", quote_all).csv(path))


RUN_STATS_SCHEMA = T.StructType([
    T.StructField("run_started", T.StringType()), T.StructField("stage", T.StringType()),
    T.StructField("rows", T.LongType()), T.StructField("elapsed_seconds", T.DoubleType()),
    T.StructField("rows_per_sec", T.DoubleType()),
])


def run_stats_table(spark: SparkSession, run_started: str, stats: list[dict]) -> DataFrame:
    """The per-run stage statistics as a small table stored with the snapshot."""
    rows = [(run_started, s["stage"], s.get("rows"), float(s["elapsed_seconds"]),
             (s["rows"] / s["elapsed_seconds"]) if s.get("rows") and s["elapsed_seconds"] > 0 else None)
            for s in stats]
    return spark.createDataFrame(rows, RUN_STATS_SCHEMA)


def write_per_group(df: DataFrame, path: str, group_cols: list[str], fmt: str = "json", salt: int = 16) -> None:
    """One output folder per group value (e.g. R22: one in-transit listing per branch).

    Rows are shuffled by the group columns plus a deterministic salt (a hash of
    the row modulo ``salt``), so a hot group is written by up to ``salt`` tasks
    instead of one, and every task writes files for few groups.  The salt is a
    pure function of the row, so a retried task sees the same partitioning.
    """
    bucket = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]), F.lit(salt))
    (df.repartition(*[F.col(c) for c in group_cols], bucket).write.mode("overwrite")
     .partitionBy(*group_cols).format(fmt).save(path))


_NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


def export_nonnumeric_quoted(df: DataFrame, path: str, columns: list[str], sep: str = "|") -> None:
    """K06 exact: delimited export quoting every non-numeric field (header included).

    Numbers are written bare; NULL is written as ``""``; text, dates and other
    values are quoted with embedded quotes doubled; booleans read ``True`` /
    ``False``.  Each row becomes one text value (built with built-in
    expressions), written as a single unquoted column whose name is the header
    line, so every output file starts with the header and no row passes
    through the driver.  Lines end with ``\\n``.
    """
    fields = {f.name: f.dataType for f in df.schema.fields}

    def quoted(c):
        return F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"'))

    parts = []
    for name in columns:
        c, t = F.col(f"`{name}`"), fields[name]
        if isinstance(t, _NUMERIC):
            text = c.cast("string")
        elif isinstance(t, T.BooleanType):
            text = F.when(c, F.lit("True")).otherwise(F.lit("False"))
        elif isinstance(t, (T.ArrayType, T.StructType, T.MapType)):
            text = quoted(F.to_json(c, _KEEP_NULLS))
        elif isinstance(t, T.DateType):
            text = quoted(F.date_format(c, "yyyy-MM-dd"))
        else:
            text = quoted(c.cast("string"))
        parts.append(F.coalesce(text, F.lit('""')))
    header = sep.join('"' + n.replace('"', '""') + '"' for n in columns)
    (df.select(F.concat_ws(sep, *parts).alias(header)).write.mode("overwrite")
     .option("header", True).option("sep", "\u0001").option("quote", "").option("escape", "")
     .csv(path))
