"""Totals beside a ranged table, published with it.

A merge writes the touched key ranges, reads the images of the delta's keys from these ranges alone and puts
the new totals into the same manifest version, so no reader sees one without the other and a delta that
arrives twice adds nothing.  A publisher that loses a race starts again from what is then live.  Totals have
a row for each group and are rewritten whole; they must be much smaller than the table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shelfwise.operators import totals as running
from shelfwise.plans import publish, snapshots, storage


def _written(spark: SparkSession, root: str, rows: dict[str, DataFrame]) -> dict[str, dict]:
    build = publish.new_staging(spark, root)
    out = {}
    for name, df in rows.items():
        path = storage.join(build, name)
        publish.write_table(df, path)
        out[name] = {"path": path}
    return out


def start(spark: SparkSession, root: str, table: str, totals: dict[str, running.Totals]) -> snapshots.Snapshot:
    """Compute totals of a published table once, from all its rows."""
    base = snapshots.read(spark, root)
    rows = snapshots.table(spark, base.tables[table])
    entries = _written(spark, root, {n: running.computed(rows, s) for n, s in totals.items()})
    return snapshots.commit(spark, root, {table: base.tables[table], **entries}, base)  # not if the table has changed


def merge(spark: SparkSession, root: str, table: str, delta: DataFrame,
          totals: dict[str, running.Totals]) -> snapshots.Snapshot:
    """Merge a versioned delta into a ranged table and its totals, in one publication."""

    def also(base: snapshots.Snapshot, images: DataFrame) -> dict[str, dict]:
        state = {n: snapshots.table(spark, base.tables[n]) for n in totals}
        return _written(spark, root, {n: running.add(state[n], running.change(images, s), totals=s)
                                      for n, s in totals.items()})

    return snapshots.merge_ranged(spark, root, table, delta, also)
