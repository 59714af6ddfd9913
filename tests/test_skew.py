"""A title holding a third of all items: AQE splits the hot join partition."""

import os

from pyspark.sql import functions as F

from shelfwise.operators import marts
from shelfwise.plans import publish


def test_hot_bib_join_is_split(spark, scratch):
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
            "spark.sql.adaptive.coalescePartitions.enabled": "false",
            "spark.sql.shuffle.partitions": "8"}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        n = 30000
        item = spark.range(n).select(
            F.col("id").alias("item_record_num"),
            F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 1000).alias("bib_record_num"),
            F.lit("l1").alias("location_code"), F.lit("-").alias("item_status_code"))
        bib = spark.range(1000).select(F.col("id").alias("bib_record_num"), F.lit("c").alias("bib_level_callnumber"),
                                       F.array(F.concat(F.lit("97800000"), F.col("id").cast("string"))).alias("isbn_values"))
        root = os.path.join(scratch, "snap")
        tables = {"item": item, "bib": bib}
        for name, table in tables.items():
            publish.write_table(table, os.path.join(root, name))
        publish.publish(spark, root, {name: os.path.join(root, name) for name in tables})
        df = marts.isbn_view(publish.read_snapshot(spark, root))
        assert len(df.collect()) == n
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin(skew=true)" in plan          # the hot bib's items are split over tasks
        # a plain left outer join cannot split its non-preserved (hot) side
        plain = bib.select("bib_record_num").join(item, "bib_record_num", "left")
        assert len(plain.collect()) == n
        assert "skew=true" not in plain._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
