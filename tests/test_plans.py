"""Plan discipline of every registered query (checked on the physical plan, not on timings)."""

import os
import re

import pytest

from shelfwise.operators import explore, extract, marts
from shelfwise.plans import context, pipeline, publish, registry
from tests.conftest import SF_SMALL

FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
             "FlatMapGroupsInPandas", "MapInPandas", "PythonUDF")


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_no_cross_joins_no_python(spark, name):
    plan = _plan(registry.QUERIES[name](spark, SF_SMALL))
    bad = [op for op in FORBIDDEN if op in plan]
    assert not bad, f"{name}: {bad}"


def test_snapshot_scans_push_filters_and_prune_columns(spark, scratch):
    root = os.path.join(scratch, "snap")
    pipeline.rebuild(spark, context.sources(spark, SF_SMALL), root, context.AS_OF, workers=2)
    base = publish.read_snapshot(spark, root)
    df = marts.leased_item_view(base)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    item_scan = [ln for ln in plan.splitlines() if "FileScan parquet" in ln and "barcode" in ln][0]
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThanOrEqual\(barcode,L000000000000\)", item_scan)
    scanned = re.search(r"FileScan parquet \[([^\]]*)\]", item_scan).group(1)
    assert "barcode" in scanned and "volume_record_statement" not in scanned and "item_callnumber" not in scanned


def test_search_reads_the_text_twice(spark):
    plan = _plan(registry.QUERIES["R14_search_documents"](spark, SF_SMALL))
    # Statistics, then matching; the joined columns lang and source are a scan without text.
    assert len(re.findall(r"FileScan parquet \[[^\]]*\btext#", plan)) <= 2 and "Generate" not in plan


def test_item_extraction_joins_on_the_item_only(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = _plan(extract.item(context.sources(spark, SF_SMALL)))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    wide = [ln for ln in plan.splitlines() if "Join" in ln and ("patron_record_id" in ln or "volume_record_id" in ln)]
    # Patron and volume are joined to loans and links, below any join that brings in the barcode.
    assert wide and plan.index("barcode") >= 0
    for line in wide:
        below = plan[plan.index(line):].splitlines()
        depth = len(line) - len(line.lstrip(" :+-"))
        subtree = []
        for ln in below[1:]:
            if len(ln) - len(ln.lstrip(" :+-")) <= depth:
                break
            subtree.append(ln)
        assert not any("barcode" in ln for ln in subtree)


@pytest.mark.parametrize("name,scans", [("V17_last_copy_view", 1), ("V18_dup_at_location_view", 2), ("E01_facet_counts", 1)])
def test_item_scans_of_the_snapshot(spark, scratch, name, scans):
    base = context.base(spark, SF_SMALL)
    tables = {}
    for t in ("item", "bib", "location", "location_name", "branch", "branch_name", "item_status_property"):
        tables[t] = os.path.join(scratch, t)
        base[t].limit(50).write.parquet(tables[t])
    publish.publish(spark, os.path.join(scratch, "snap"), tables)
    snap = publish.read_snapshot(spark, os.path.join(scratch, "snap"))
    fn = {"V17_last_copy_view": marts.last_copy_view, "V18_dup_at_location_view": marts.dup_at_location_view,
          "E01_facet_counts": lambda t: explore.facet_counts(marts.item_view(t), ["location_code", "item_format", "item_status_code"])}
    plan = _plan(fn[name](snap))
    assert len(re.findall(r"FileScan parquet[^\n]*/item\]", plan)) <= scans


def test_a_page_is_as_long_as_asked(spark):
    assert explore.sort_page(spark.range(30_000), ["id"], limit=20_000).count() == 20_000


@pytest.mark.parametrize("name", ["K04_merge_by_version", "K04_upsert_item"])
def test_merges_derive_the_items_once(spark, name):
    df = registry.QUERIES[name](spark, SF_SMALL)
    plan = _plan(df)
    # The merge reads written rows: neither the source tables nor the joins that make items are under it.
    assert "lineitem.parquet" not in "".join(df.inputFiles()) and "item_status_code" in plan
    assert plan.count("itype_code_num") == 0
    item = context.base(spark, SF_SMALL)["item"]
    assert df.columns == item.columns and 0 < df.count() <= item.count()
