"""Run telemetry (T01-T06): append-only ``run`` and ``stage`` tables and their reports.

Rows are appended as events (a run start, stage completions, a run finish);
the current state of a run is the latest event per run id.  The tables are
tiny, the reports are ordinary aggregations.
"""

from __future__ import annotations

import datetime as _dt
import threading
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.plans import storage

RUN_SCHEMA = T.StructType([
    T.StructField("id", T.LongType(), False), T.StructField("started_at", T.StringType()),
    T.StructField("completed_at", T.StringType()), T.StructField("total_elapsed_seconds", T.DoubleType()),
    T.StructField("success", T.IntegerType(), False), T.StructField("event_seq", T.LongType(), False),
])
STAGE_SCHEMA = T.StructType([
    T.StructField("id", T.LongType(), False), T.StructField("run_id", T.LongType(), False),
    T.StructField("stage", T.StringType(), False), T.StructField("rows", T.LongType()),
    T.StructField("elapsed_seconds", T.DoubleType(), False), T.StructField("rows_per_sec", T.DoubleType()),
])


class Telemetry:
    """Append run/stage events to parquet tables under ``root``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root
        self._one = threading.Lock()  # appends to a folder share its temporary files

    def _append(self, name: str, rows, schema) -> None:
        with self._one:
            self.spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(storage.join(self.root, name))

    def start_run(self, run_id: int, started_at: str | None = None) -> None:
        started_at = started_at or _dt.datetime.now(_dt.timezone.utc).isoformat(timespec="seconds")
        self._append("run", [(run_id, started_at, None, None, 0, time.time_ns())], RUN_SCHEMA)

    def record_stage(self, run_id: int, stage_id: int, stage: str, rows: int | None, elapsed: float) -> None:
        rate = (rows / elapsed) if rows and elapsed > 0 else None
        self._append("stage", [(stage_id, run_id, stage, rows, float(elapsed), rate)], STAGE_SCHEMA)

    def finish_run(self, run_id: int, success: bool, elapsed: float, completed_at: str | None = None) -> None:
        completed_at = completed_at or _dt.datetime.now(_dt.timezone.utc).isoformat(timespec="seconds")
        # When it started is in its start event, which another process may have written.
        self._append("run", [(run_id, None, completed_at, float(elapsed), int(success), time.time_ns())], RUN_SCHEMA)

    def tables(self) -> tuple[DataFrame, DataFrame]:
        run = self.spark.read.parquet(storage.join(self.root, "run"))
        stage = self.spark.read.parquet(storage.join(self.root, "stage"))
        return latest_runs(run), stage


def latest_runs(run_events: DataFrame) -> DataFrame:
    """Current state of each run: its latest event, with the start of its first."""
    state = ["completed_at", "total_elapsed_seconds", "success"]
    return (run_events.groupBy("id").agg(F.min_by("started_at", F.when(F.col("started_at").isNotNull(), F.col("event_seq")))
                                         .alias("started_at"),
                                         F.max_by(F.struct(*state), "event_seq").alias("last"))
            .select("id", "started_at", "last.*"))


def stage_summary(run: DataFrame, stage: DataFrame) -> DataFrame:
    """Per stage over successful runs: count, avg/min/max seconds, avg rows and rate."""
    ok = stage.join(run.filter(F.col("success") == 1).select(F.col("id").alias("run_id")), "run_id")
    return (ok.groupBy("stage").agg(
        F.count(F.lit(1)).alias("run_count"), F.round(F.avg("elapsed_seconds"), 1).alias("avg_secs"),
        F.round(F.min("elapsed_seconds"), 1).alias("min_secs"), F.round(F.max("elapsed_seconds"), 1).alias("max_secs"),
        F.round(F.avg(F.coalesce("rows", F.lit(0)))).alias("avg_rows"),
        F.round(F.avg("rows_per_sec")).alias("avg_rows_per_sec"))
        .orderBy(F.desc("avg_secs")))


def recent_runs(run: DataFrame, n: int = 20) -> DataFrame:
    """The last ``n`` runs with minutes and a result label."""
    return (run.select("id", "started_at", "completed_at",
                       F.round(F.col("total_elapsed_seconds") / 60.0, 1).alias("total_minutes"),
                       F.when(F.col("success") == 1, "success").otherwise("failed").alias("result"))
            .orderBy(F.desc("id")).limit(n))


def stage_trends(run: DataFrame, stage: DataFrame) -> DataFrame:
    """Stage timings per run, stage ascending, run descending."""
    r = run.select(F.col("id").alias("run_id"), F.col("started_at").alias("run_started"))
    return (stage.join(r, "run_id")
            .select("stage", "run_id", "run_started", "rows", F.round("elapsed_seconds", 1).alias("elapsed_secs"),
                    F.round("rows_per_sec").alias("rows_per_sec"))
            .orderBy("stage", F.desc("run_id")))


def run_report(run: DataFrame, stage: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Totals (runs, successes) and per-run stage count and total stage time."""
    totals = run.agg(F.count(F.lit(1)).alias("total_runs"),
                     F.coalesce(F.sum("success"), F.lit(0)).cast("long").alias("successes"))
    per_run = (stage.groupBy("run_id").agg(F.count(F.lit(1)).alias("stages"),
                                           F.sum("elapsed_seconds").alias("total_stage_seconds")))
    return totals, per_run


def failure_analysis(run: DataFrame, stage: DataFrame) -> DataFrame:
    """For each failed run, stages completed and the last stage reached."""
    failed = run.filter(F.col("success") == 0).select(F.col("id").alias("run_id"), "started_at",
                                                       "total_elapsed_seconds", "completed_at")
    last = stage.groupBy("run_id").agg(F.count(F.lit(1)).alias("stages_completed"),
                                       F.max_by("stage", "id").alias("last_stage"))
    return (failed.join(last, "run_id", "left")
            .select("run_id", "started_at", "total_elapsed_seconds", "completed_at",
                    F.coalesce("stages_completed", F.lit(0)).alias("stages_completed"),
                    F.coalesce("last_stage", F.lit("(no stages)")).alias("last_stage")))
