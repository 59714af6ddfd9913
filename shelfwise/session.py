"""Spark session helpers.

The engine never picks machine-local scratch space on a cluster: lineage is cut
with ``DataFrame.checkpoint()`` into the folder the cluster names in
``spark.checkpoint.dir``.  Only when that setting is absent (tests, a laptop)
do we point it at a caller-supplied folder.
"""

from __future__ import annotations

import contextlib
import os
import uuid
from collections.abc import Iterable, Iterator
from functools import reduce

from pyspark.sql import DataFrame, SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # 64 MiB: small dimensions are broadcast by size, anything else is shuffled.
    "spark.sql.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "shelfwise", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.setdefault("spark.driver.memory", os.environ.get("SHELFWISE_DRIVER_MEMORY", "16g"))
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """The shared checkpoint folder named by the cluster, or ``fallback`` when unset."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        spark.sparkContext.setCheckpointDir(configured)
        return configured
    if fallback is None:
        raise RuntimeError("spark.checkpoint.dir is not set and no fallback folder was given")
    spark.sparkContext.setCheckpointDir(fallback)  # the setting itself cannot change in a running session
    return fallback


FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextlib.contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Writes in this block leave no shuffle files behind (Spark 4.1; older ones keep them until garbage goes)."""
    old = spark.conf.get(FREE_SHUFFLES, None)
    spark.conf.set(FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.unset(FREE_SHUFFLES) if old is None else spark.conf.set(FREE_SHUFFLES, old)


def scratch_path(spark: SparkSession) -> str | None:
    """A fresh path in the shared checkpoint folder; None for a session without one."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        folder = spark.sparkContext._jsc.sc().getCheckpointDir()
        if folder.isEmpty():
            return None
        root = folder.get()
    return f"{root.rstrip('/')}/written-{uuid.uuid4().hex}"


def save(df: DataFrame, path: str) -> DataFrame:
    """``df`` written as Parquet and read back; the shuffle files of the write go with it."""
    with shuffles_freed(df.sparkSession):
        df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def written(*parts: DataFrame) -> DataFrame:
    """Cut lineage: the rows of all ``parts`` written into the shared checkpoint folder and read back."""
    return written_in_turn(parts)


def written_in_turn(parts: Iterable[DataFrame]) -> DataFrame:
    """The rows of all ``parts``, written one after the other: only one part's shuffle files are there at a time.

    A session without a checkpoint folder gets the parts themselves.
    """
    paths, whole = [], []
    for k, part in enumerate(parts):
        path = paths[0].rsplit("/", 1)[0] if paths else scratch_path(part.sparkSession)
        if path is None:
            whole.append(part)
            continue
        paths.append(f"{path}/{k}")
        save(part, paths[-1])
        schema, spark = part.schema, part.sparkSession
    return spark.read.schema(schema).parquet(*paths) if paths else reduce(DataFrame.union, whole)
