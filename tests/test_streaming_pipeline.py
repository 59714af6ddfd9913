import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from shelfwise.operators import extract
from shelfwise.plans import pipeline, publish, storage
from shelfwise.plans.telemetry import Telemetry, failure_analysis, stage_summary
from shelfwise.sources.tables import load_sources, read_branch_locations_csv
from shelfwise.streaming import incremental
from tests.conftest import SF_SMALL

AS_OF = dt.date(2024, 2, 1)


def test_upsert_stream_merges_batches(spark, scratch):
    landing, root, ckpt = (os.path.join(scratch, n) for n in ("landing", "snap", "ckpt"))
    other = storage.join(publish.new_staging(spark, root), "other")
    publish.write_table(spark.range(7), other)
    publish.publish(spark, root, {"other": other})
    spark.createDataFrame([(1, "a", 1), (2, "b", 1)], "id long, v string, ts long").write.parquet(landing + "/b1")
    q = incremental.start_upsert_stream(spark, landing + "/*", "id long, v string, ts long", root, "t", "id",
                                        ckpt, order_col="ts")
    q.awaitTermination(120)
    spark.createDataFrame([(2, "b2", 2), (3, "c", 2)], "id long, v string, ts long").write.parquet(landing + "/b2")
    q = incremental.start_upsert_stream(spark, landing + "/*", "id long, v string, ts long", root, "t", "id",
                                        ckpt, order_col="ts")
    q.awaitTermination(120)
    got = sorted((r.id, r.v) for r in publish.read_snapshot(spark, root, ["t"])["t"].collect())
    assert got == [(1, "a"), (2, "b2"), (3, "c")]
    assert publish.read_snapshot(spark, root)["other"].count() == 7   # other tables stay


def test_daily_circulation_stream_matches_batch_counts(spark, scratch):
    s = load_sources(spark, SF_SMALL)
    circ = s["circ_trans"]
    landing, out, ckpt = (os.path.join(scratch, n) for n in ("circ", "out", "ckpt"))
    circ.write.parquet(landing)
    q = incremental.start_daily_circulation(spark, landing, circ.schema, out, ckpt)
    q.awaitTermination(180)
    streamed = spark.read.parquet(out).agg(F.sum("count_op_code")).first()[0]
    # append mode emits a day once the watermark (latest event - 1 day) passes its end
    ops = circ.filter(F.col("op_code").isin("o", "i", "f")).withColumn("ts", F.col("transaction_gmt").cast("timestamp"))
    wm = ops.agg(F.max("ts")).first()[0] - dt.timedelta(days=1)
    closed = ops.filter(F.date_trunc("day", "ts") + F.expr("INTERVAL 1 DAY") <= F.lit(wm)).count()
    assert streamed == closed and closed > 0


def test_rebuild_then_incremental(spark, scratch):
    s = load_sources(spark, SF_SMALL)
    root = "file://" + os.path.join(scratch, "snap")
    tm = Telemetry(spark, os.path.join(scratch, "telemetry"))
    out = pipeline.rebuild(spark, s, root, AS_OF, telemetry=tm, workers=2)
    counts = {st["stage"]: st["rows"] for st in out["stats"]}
    assert counts["item"] == extract.item(s).count() and counts["bib"] > 0
    run, stage = tm.tables()
    assert stage_summary(run, stage).count() == len(counts)
    live = publish.read_snapshot(spark, root, ["record_metadata"])["record_metadata"]
    wm = pipeline.watermark(live)
    assert dt.date(2023, 1, 1) < wm < dt.date(2024, 12, 31)
    def rows(name):
        # Columns as text: arrays and dates compare the same way.
        df = publish.read_snapshot(spark, root, [name])[name]
        return sorted(df.select(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"})).toPandas().iloc[:, 0])

    before = {n: rows(n) for n in ("item", "bib", "volume_record", "record_metadata", "bib_record")}
    for since in (wm, dt.date(2023, 9, 1)):     # the watermark's day, and a delta with items of two titles
        live = publish.current(spark, root)
        assert pipeline.watermark(publish.read_snapshot(spark, root, ["record_metadata"])["record_metadata"]) == wm
        if since != wm:
            pipeline_watermark, pipeline.watermark = pipeline.watermark, lambda _: since
        try:
            inc = pipeline.incremental(spark, s, root, AS_OF, workers=2, telemetry=tm, run_id=2)
        finally:
            if since != wm:
                pipeline.watermark = pipeline_watermark
        assert inc["since"].date() == since and publish.current(spark, root) != live
        for name, expected in before.items():
            assert rows(name) == expected, name     # same sources: the daily run equals the rebuild
    delta = extract.item(s, dt.datetime(2023, 9, 1))
    assert delta.groupBy("item_record_id").count().filter("count > 1").count() > 0
    assert publish.read_snapshot(spark, root, ["_pipeline_run"])["_pipeline_run"].count() == len(counts)
    runs = {r["id"]: r["success"] for r in tm.tables()[0].collect()}
    assert runs == {1: 1, 2: 1}


def test_failed_build_reports_its_stages(spark, scratch):
    s = load_sources(spark, SF_SMALL)
    s = {**s, "hold": s["hold"].withColumn("status", F.raise_error(F.lit("boom")).cast("string"))}
    tm = Telemetry(spark, os.path.join(scratch, "telemetry"))
    with pytest.raises(Exception):
        pipeline.rebuild(spark, s, os.path.join(scratch, "snap"), AS_OF, telemetry=tm, workers=2, sample=50)
    assert publish.current(spark, os.path.join(scratch, "snap")) == {}
    failed = failure_analysis(*tm.tables()).collect()
    assert len(failed) == 1 and failed[0]["stages_completed"] > 3 and failed[0]["last_stage"] != "(no stages)"


def test_branch_locations_csv(spark, scratch):
    s = load_sources(spark, SF_SMALL)
    path = os.path.join(scratch, "bl")
    s["branch_locations"].write.option("header", True).csv(path)
    df = read_branch_locations_csv(spark, path)
    assert df.schema["latitude"].dataType.typeName() == "double"
    assert sorted(df.select("code_num").collect()) == sorted(s["branch_locations"].select("code_num").collect())


def test_csv_export(spark, scratch):
    df = spark.createDataFrame([(1, "a|b", ["x"])], "n int, s string, arr array<string>")
    path = os.path.join(scratch, "csv")
    publish.export_csv(df, path, ["n", "s", "arr"])
    text = "".join(open(os.path.join(path, f)).read() for f in os.listdir(path) if f.endswith(".csv"))
    assert text.splitlines()[0] == '"n"|"s"|"arr"' and '"a|b"' in text
