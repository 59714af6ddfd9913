"""E07 by seeking: a page starts behind a cursor, so a late page costs what the first one does.

``page_after`` seeks in any table: rows behind the cursor's sort keys, of which each task keeps a page's
worth; nothing counts or gathers the rows before it.  ``write_pages`` makes a copy for browsing, range-sorted
into files of bounded size, with the places of each file's first and last row; ``read_page`` opens the files
that a page lies in and no others.  The copy does not change while it is browsed; a newer one is another folder.

Order: ascending with nulls first, or descending with nulls last.  In a copy, ties of the keys are put in
order by a hash of the row, which also spreads a hot key over files; repeated rows stay, each with a place.
An empty table has one empty page.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.plans import storage

#: Column of a copy: rises in page order.
PLACE = "_place"
ROWS_PER_FILE = 1_000_000


def _order(keys: list[str], descending: bool) -> list[Column]:
    return [F.desc_nulls_last(k) if descending else F.asc_nulls_first(k) for k in keys]


def _behind(key: str, value, descending: bool) -> Column:
    c = F.col(key)
    if value is None:
        return F.lit(False) if descending else c.isNotNull()
    return (c < F.lit(value)) | c.isNull() if descending else c > F.lit(value)


def page_after(df: DataFrame, keys: list[str], cursor: list | None = None, limit: int = 100,
               descending: bool = False) -> DataFrame:
    """The ``limit`` rows behind ``cursor`` (the keys of the last row seen; None: from the start).

    The keys together must identify a row, or rows that tie with the cursor are passed over.
    """
    if cursor is not None:
        same = [F.col(k).eqNullSafe(F.lit(v)) for k, v in zip(keys, cursor)]
        parts = [reduce(Column.__and__, [*same[:i], _behind(k, v, descending)])
                 for i, (k, v) in enumerate(zip(keys, cursor))]
        df = df.filter(reduce(Column.__or__, parts))
    return df.orderBy(*_order(keys, descending)).limit(limit)


def write_pages(df: DataFrame, path: str, keys: list[str], descending: bool = False,
                rows_per_file: int = ROWS_PER_FILE) -> None:
    """Write the copy (``path``/rows) and the bounds of its files (``path``/bounds)."""
    spark = df.sparkSession
    files = df.count() // rows_per_file + 1
    order = [*_order(keys, descending), F.col("_tie")]
    rows = (df.withColumn("_tie", F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]))
            .repartitionByRange(files, *order).sortWithinPartitions(*order).drop("_tie")
            .withColumn(PLACE, F.monotonically_increasing_id()))
    rows.write.parquet(storage.join(path, "rows"))
    bounds = (spark.read.parquet(storage.join(path, "rows")).groupBy(F.input_file_name().alias("file"))
              .agg(F.min(PLACE).alias("first"), F.max(PLACE).alias("last"), F.count(F.lit(1)).alias("n")))
    bounds.repartitionByRange("first").write.parquet(storage.join(path, "bounds"))


def files_of_page(spark: SparkSession, path: str, limit: int, after: int = -1) -> list[str]:
    """The files that hold the ``limit`` rows behind place ``after``; every file has a row, so at most ``limit``."""
    bounds = spark.read.parquet(storage.join(path, "bounds")).filter(F.col("last") > after)
    out, found = [], 0
    for r in bounds.orderBy("first").limit(limit).collect():
        if found >= limit:
            break
        out.append(r["file"])
        # Places within a file are consecutive.
        found += r["last"] - max(after, r["first"] - 1)
    return out


def read_page(spark: SparkSession, path: str, limit: int = 100, after: int = -1) -> DataFrame:
    """A page of a copy in order; its last row's ``_place`` is the cursor of the next page."""
    rows = storage.join(path, "rows")
    schema = spark.read.parquet(rows).schema
    files = files_of_page(spark, path, limit, after)
    page = spark.read.schema(schema).parquet(*files) if files else spark.createDataFrame([], schema)
    return page.filter(F.col(PLACE) > after).orderBy(PLACE).limit(limit)
