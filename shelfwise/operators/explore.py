"""Table exploration helpers (E01-E08): the link parameters of a table browser
re-expressed as DataFrame operations on any mart."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

_OPS = {
    "exact": lambda c, v: c == F.lit(v),
    "not": lambda c, v: c != F.lit(v),
    "gt": lambda c, v: c > F.lit(v),
    "gte": lambda c, v: c >= F.lit(v),
    "lt": lambda c, v: c < F.lit(v),
    "lte": lambda c, v: c <= F.lit(v),
    "in": lambda c, v: c.isin(*v),
    "notin": lambda c, v: ~c.isin(*v),
    "arraycontains": lambda c, v: F.array_contains(c, F.lit(v)),
    "isnull": lambda c, v: c.isNull() if v else c.isNotNull(),
    "like": lambda c, v: c.ilike(v),
}


def where(df: DataFrame, column: str, op: str, value) -> DataFrame:
    """``column__op=value`` filters (exact, range, in/notin, arraycontains)."""
    return df.filter(_OPS[op](F.col(column), value))


def where_all(df: DataFrame, filters: list[tuple[str, str, object]]) -> DataFrame:
    return reduce(lambda d, f: where(d, *f), filters, df)


def facet_counts(df: DataFrame, columns: list[str], size: int = 30) -> DataFrame:
    """The ``size`` most frequent values of each facet column, with counts.

    One pass for all facets: each row gives a (facet, value) pair per column,
    pairs are counted once, and the rank limit keeps ``size`` rows of a facet
    per task before they meet.
    """
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("facet"), F.col(c).cast("string").alias("value"))
                                for c in columns]))
    counts = df.select(pairs.alias("p")).groupBy("p.facet", "p.value").agg(F.count(F.lit(1)).alias("count"))
    w = Window.partitionBy("facet").orderBy(F.desc("count"), F.asc_nulls_first("value"))
    ranked = counts.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= size)
    return ranked.select("facet", "value", "count", F.col("rank").cast("long").alias("rank"))


def sort_page(df: DataFrame, keys: list[str], descending: bool = False, limit: int = 100,
              offset: int = 0) -> DataFrame:
    """Sort by keys (``_sort`` / ``_sort_desc``) and cut one page.

    The keys should be unique (append a record number) so pages are stable.
    """
    cols = [F.desc_nulls_last(k) if descending else F.asc_nulls_first(k) for k in keys]
    return df.orderBy(*cols).offset(offset).limit(limit)


def as_json_rows(df: DataFrame) -> DataFrame:
    """Each row as one JSON object text (JSON Lines when written)."""
    return df.select(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias("json"))
