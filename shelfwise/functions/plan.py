"""Plan helpers: size-checked broadcast hints."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.session import written

# Dimensions of the library schema (locations, branches, lookups) are a few
# thousand rows; anything estimated above this bound is left to the planner.
# Key sets that grow with the data take no hint: AQE broadcasts them if small.
BROADCAST_LIMIT_BYTES = 64 * 1024 * 1024


def estimated_bytes(df: DataFrame) -> int | None:
    """Catalyst's size estimate of the optimized plan (no job is run)."""
    try:
        size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
        return int(size if isinstance(size, int) else size.toString())
    except Exception:  # noqa: BLE001 - estimate unavailable (e.g. Spark Connect)
        return None


def bounded_broadcast(df: DataFrame, limit: int = BROADCAST_LIMIT_BYTES) -> DataFrame:
    """Broadcast ``df`` only when its estimated size is within ``limit``.

    Beyond the bound the join stays a shuffle join; AQE may still turn it into
    a broadcast join at run time once the real size is known.
    """
    size = estimated_bytes(df)
    if size is not None and size <= limit:
        return F.broadcast(df)
    return df


def written_broadcast(df: DataFrame, limit: int = BROADCAST_LIMIT_BYTES) -> DataFrame:
    """``bounded_broadcast`` of a dimension made of joins, whose estimate is the product of its inputs' sizes.

    Where the estimate is beyond the limit it is written, and the rows tell its size.
    """
    size = estimated_bytes(df)
    if size is None or size > limit:
        df = written(df)
        width = 8 + sum(20 if isinstance(f.dataType, T.StringType) else 8 for f in df.schema.fields)
        return F.broadcast(df) if df.count() * width <= limit else df
    return F.broadcast(df)


def sparse_left_join(left: DataFrame, right: DataFrame, key: str, by: str) -> DataFrame:
    """``left LEFT JOIN right USING (key)`` for a positive integer key that most left rows lack.

    Rows without a key would all hash to one partition; they get negative
    stand-ins drawn from ``by``, which match nothing and spread evenly.
    """
    spread = F.coalesce(F.col(key).cast("long"), -1 - F.pmod(F.xxhash64(by), F.lit(1 << 40)))
    right = right.withColumn("__key", F.col(key).cast("long")).drop(key)
    return left.withColumn("__key", spread).join(right, "__key", "left").drop("__key")


def skew_safe_left_join(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
    """``left LEFT OUTER JOIN right USING (on)`` when the *right* side may hold hot keys.

    AQE can split a skewed partition only on the preserved side of an outer
    join, so a hot key on the right of a left join would run in one task.  The
    same result is an inner join (splittable on both sides) plus the left rows
    without a match (anti join against the distinct right keys, NULL keys
    included), with the right columns NULL.
    """
    matched = left.join(right, on, "inner")
    unmatched = left.join(right.select(*on).distinct(), on, "left_anti")
    return matched.unionByName(unmatched, allowMissingColumns=True)
