"""Structured Streaming forms of the incremental path.

- ``start_upsert_stream``: changed rows landing as files are merged into the
  published snapshot by key in each micro-batch (``foreachBatch`` -> staged
  build -> atomic publish).  Progress lives in a checkpoint folder on shared
  storage, so a restarted query resumes where it stopped.
- ``daily_circulation``: circulation transactions aggregated per day, stat
  group, op, item type and loan rule with a watermark, the streaming form of
  the daily circulation table, with exact distinct patrons.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.functions import codes
from shelfwise.plans import publish, snapshots, storage


def start_upsert_stream(spark: SparkSession, landing: str, schema: T.StructType, root: str, table: str,
                        key: str, checkpoint: str, order_col: str | None = None, available_now: bool = True):
    """Merge every new landing file into ``root``'s snapshot table ``table`` by ``key``."""

    def merge(batch: DataFrame, batch_id: int) -> None:
        for _ in range(snapshots.TRIES):
            base = snapshots.read(spark, root)
            existing = snapshots.table(spark, base.tables[table]) if table in base.tables else batch.limit(0)
            path = storage.join(publish.new_staging(spark, root), table)
            publish.write_table(publish.upsert(existing, batch, key, order_col), path)
            try:
                publish.publish(spark, root, {table: path}, base)  # the other tables stay as they are
                return
            except snapshots.Conflict:
                continue
        raise snapshots.Conflict(f"{table}: replaced by others {snapshots.TRIES} times")

    stream = spark.readStream.schema(schema).parquet(landing)
    writer = stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()


def daily_circulation(circ_stream: DataFrame, watermark: str = "1 day") -> DataFrame:
    """Daily circulation counts with exact distinct patrons over a stream of transactions.

    A transaction that arrives again within the watermark counts once (by ``id``).  Counts per day, group
    and patron are summed per day and group: the distinct patrons are the rows of the first step, so no
    state holds a group's patrons together.  State of a day is dropped when the watermark passes its end.
    """
    group = ["stat_group_code_num", "op_code", "itype_code_num", "loanrule_code_num"]
    per_patron = (circ_stream.filter(F.col("op_code").isin(*codes.CIRC_OPS))
                  .withColumn("transaction_gmt", F.col("transaction_gmt").cast("timestamp"))
                  .withWatermark("transaction_gmt", watermark)
                  .dropDuplicatesWithinWatermark(["id"])
                  .groupBy(F.window("transaction_gmt", "1 day").alias("day"), *group, "patron_record_id")
                  .agg(F.count(F.lit(1)).alias("n")))
    return (per_patron.groupBy(F.window(F.window_time("day"), "1 day").alias("day"), *group)
            .agg(F.sum("n").alias("count_op_code"), F.count("patron_record_id").alias("count_distinct_patrons"))
            .select(F.date_format("day.start", "yyyy-MM-dd").alias("transaction_day"), *group, "count_op_code",
                    "count_distinct_patrons"))


def start_daily_circulation(spark: SparkSession, landing: str, schema: T.StructType, out: str, checkpoint: str,
                            available_now: bool = True, watermark: str = "1 day"):
    agg = daily_circulation(spark.readStream.schema(schema).parquet(landing), watermark)
    writer = (agg.writeStream.outputMode("append").format("parquet").option("path", out)
              .option("checkpointLocation", checkpoint))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="5 minutes")
    return writer.start()
