import os

import pytest
from pyspark.sql import functions as F

from shelfwise.plans import publish, storage, telemetry


def test_upsert_replaces_by_key_and_deletes(spark):
    existing = spark.createDataFrame([(1, "a", 0), (2, "b", 0), (3, "c", 0)], ["id", "v", "ts"])
    delta = spark.createDataFrame([(2, "b1", 1), (2, "b2", 2), (4, "d", 1)], ["id", "v", "ts"])
    deleted = spark.createDataFrame([(3,)], ["id"])
    out = publish.upsert(existing, delta, "id", order_col="ts", deleted_keys=deleted)
    got = sorted((r["id"], r["v"]) for r in out.collect())
    assert got == [(1, "a"), (2, "b2"), (4, "d")]
    # idempotent: applying the same delta again changes nothing
    again = publish.upsert(out, delta, "id", order_col="ts", deleted_keys=deleted)
    assert sorted((r["id"], r["v"]) for r in again.collect()) == got


def test_write_table_counts_in_same_job(spark, scratch):
    df = spark.range(1234).withColumn("x", F.col("id") % 7)
    assert publish.write_table(df, os.path.join(scratch, "t")) == 1234


@pytest.mark.parametrize("scheme", ["", "file://"])
def test_publish_swap_and_failed_build_keeps_live(spark, scratch, scheme):
    root = scheme + os.path.join(scratch, "snap")
    assert publish.current(spark, root) == {}
    b1 = storage.join(publish.new_staging(spark, root), "t")
    publish.write_table(spark.range(3), b1)
    publish.publish(spark, root, {"t": b1})
    assert publish.current(spark, root) == {"t": b1}
    b2 = storage.join(publish.new_staging(spark, root), "t")
    with pytest.raises(Exception):
        publish.write_table(spark.range(3).select(F.raise_error(F.lit("boom"))), b2)
    assert publish.current(spark, root) == {"t": b1}            # failed build never published
    before = {t.name for t in spark.catalog.listTables()}
    assert publish.read_snapshot(spark, root)["t"].count() == 3
    assert {t.name for t in spark.catalog.listTables()} == before
    publish.publish(spark, root, {"t": b2})
    assert publish.current(spark, root) == {"t": b2}            # an existing pointer is replaced


def test_upsert_keeps_all_rows_of_a_key(spark):
    # An item linked to two titles has two rows; a repeated version is replaced as a whole.
    item = spark.createDataFrame([(1, 10, 0), (1, 11, 0), (2, 10, 0)], ["id", "bib", "ts"])
    rows = lambda df: sorted(map(tuple, df.collect()))
    assert rows(publish.upsert(item, item, "id")) == rows(item)
    delta = spark.createDataFrame([(1, 12, 1), (1, 13, 2), (1, 14, 2)], ["id", "bib", "ts"])
    assert rows(publish.upsert(item, delta, "id", order_col="ts")) == [(1, 13, 2), (1, 14, 2), (2, 10, 0)]
    assert rows(publish.upsert(item, delta.limit(0), "id")) == rows(item)


def test_encode_for_text(spark):
    df = spark.createDataFrame([(["a", None], {"k": 1}, (1, None))], "arr array<string>, m map<string,int>, s struct<a:int,b:int>")
    df = df.withColumn("d", F.lit("2024-01-02").cast("date"))
    df = df.withColumn("t", F.lit("2024-01-02 03:04:05").cast("timestamp"))
    df = df.withColumn("u", F.lit("2024-01-02 03:04:05.12").cast("timestamp"))
    row = publish.encode_for_text(df).first()
    assert row["arr"] == '["a",null]' and row["m"] == '{"k":1}' and row["d"] == "2024-01-02"
    assert row["s"] == '{"a":1,"b":null}'
    assert row["t"] == "2024-01-02T03:04:05" and row["u"] == "2024-01-02T03:04:05.120000"


def test_telemetry_views(spark, scratch):
    tm = telemetry.Telemetry(spark, scratch)
    tm.start_run(1, "2024-01-01T00:00:00")
    tm.record_stage(1, 1, "bib", 100, 2.0)
    tm.record_stage(1, 2, "item", None, 4.0)
    tm.finish_run(1, True, 6.0, "2024-01-01T00:01:00")
    tm.start_run(2, "2024-01-02T00:00:00")
    tm.record_stage(2, 3, "bib", 50, 9.0)
    tm.finish_run(2, False, 9.0)
    run, stage = tm.tables()
    summary = {r["stage"]: r for r in telemetry.stage_summary(run, stage).collect()}
    assert summary["bib"]["run_count"] == 1 and summary["bib"]["avg_secs"] == 2.0   # failed run excluded
    assert summary["item"]["avg_rows"] == 0.0
    labels = {r["id"]: r["result"] for r in telemetry.recent_runs(run).collect()}
    assert labels == {1: "success", 2: "failed"}
    telemetry.Telemetry(spark, scratch).finish_run(1, True, 6.0, "2024-01-01T00:02:00")  # by another process
    again = {r["id"]: r for r in tm.tables()[0].collect()}[1]
    assert again["started_at"] == "2024-01-01T00:00:00" and again["completed_at"] == "2024-01-01T00:02:00"
    totals, per_run = telemetry.run_report(run, stage)
    assert tuple(totals.first()) == (2, 1)
    fail = telemetry.failure_analysis(run, stage).collect()
    assert [(r["run_id"], r["stages_completed"], r["last_stage"]) for r in fail] == [(2, 1, "bib")]
    trends = telemetry.stage_trends(run, stage).collect()
    assert [(r["stage"], r["run_id"]) for r in trends] == [("bib", 2), ("bib", 1), ("item", 1)]


def test_write_per_group(spark, scratch):
    df = spark.createDataFrame([("A", 1), ("A", 2), ("B", 3)], "branch string, n int")
    path = os.path.join(scratch, "per_branch")
    publish.write_per_group(df, path, ["branch"])
    assert sorted(d for d in os.listdir(path) if d.startswith("branch=")) == ["branch=A", "branch=B"]
    assert spark.read.json(os.path.join(path, "branch=A")).count() == 2


def test_nonnumeric_quoted_export_matches_python_csv(spark, scratch):
    import csv
    import datetime as dt
    import io
    from decimal import Decimal

    rows = [(12, None, 'a|"b', dt.date(2024, 1, 2), 1.5, True, Decimal("2.50")),
            (None, "plain", None, None, None, False, None)]
    schema = "n long, s string, t string, d date, f double, b boolean, m decimal(10,2)"
    df = spark.createDataFrame(rows, schema)
    path = os.path.join(scratch, "nn")
    publish.export_nonnumeric_quoted(df.coalesce(1), path, df.columns)
    got = "".join(open(os.path.join(path, f)).read() for f in sorted(os.listdir(path)) if f.endswith(".csv"))
    buf = io.StringIO()
    w = csv.writer(buf, delimiter="|", quotechar='"', quoting=csv.QUOTE_NONNUMERIC, lineterminator="\n")
    w.writerow(df.columns)
    for r in rows:
        w.writerow(r)
    assert got == buf.getvalue()
