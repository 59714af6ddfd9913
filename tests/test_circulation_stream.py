import datetime as dt
import os

from pyspark.sql import functions as F

from shelfwise.functions import codes
from shelfwise.sources.tables import load_sources
from shelfwise.streaming import incremental
from tests.conftest import SF_SMALL

GROUP = ["stat_group_code_num", "op_code", "itype_code_num", "loanrule_code_num"]


def batch(circ):
    """The daily part of the batch build."""
    return circ.filter(F.col("op_code").isin(*codes.CIRC_OPS)).groupBy(
        F.date_format("transaction_gmt", "yyyy-MM-dd").alias("transaction_day"), *GROUP).agg(
        F.count(F.lit(1)).alias("count_op_code"), F.countDistinct("patron_record_id").alias("count_distinct_patrons"))


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_stream_equals_batch_on_replayed_files(spark, scratch):
    """Files land out of order, one of them twice, over two runs of the query; a row without a patron counts."""
    circ = load_sources(spark, SF_SMALL)["circ_trans"].cache()
    days = sorted(r["d"] for r in circ.select(F.to_date("transaction_gmt").alias("d")).distinct().collect())
    some = circ.filter(F.to_date("transaction_gmt").isin(days[:4]))
    some = some.withColumn("patron_record_id", F.when(F.col("id") % 11 != 0, F.col("patron_record_id") % 3))
    landing, out, ckpt = (os.path.join(scratch, n) for n in ("circ", "out", "ckpt"))
    part = lambda k: some.filter(F.col("id") % 3 == k)
    end = circ.filter(F.to_date("transaction_gmt") == days[-1])  # lets the watermark pass the days before

    def run():
        incremental.start_daily_circulation(spark, landing + "/*", circ.schema, out, ckpt, watermark="5 days").awaitTermination(180)

    for n, k in enumerate([2, 0]):
        part(k).write.parquet(os.path.join(landing, str(n)))
    run()
    for n, k in enumerate([0, 1], 2):  # the first again, and the rest
        part(k).write.parquet(os.path.join(landing, str(n)))
    run()
    end.write.parquet(os.path.join(landing, "9"))
    run()
    columns = ["transaction_day", *GROUP, "count_op_code", "count_distinct_patrons"]
    got = spark.read.parquet(out).select(columns)
    assert rows(got) == rows(batch(some).select(columns)) and got.count() > 20
    assert days[-1] - days[3] > dt.timedelta(days=6)
