"""E07 by seeking: pages put together are the full order; a late page opens few files."""

import pytest
from pyspark.sql import functions as F

from shelfwise.operators import paging

SCHEMA = "k string, n long, v int"


def table(spark):
    # a third of the rows share one key; null keys; repeated rows
    rows = [("hot", i % 40, i % 3) for i in range(200)]
    rows += [(None if i % 9 == 0 else f"k{i % 50:02d}", i, i % 3) for i in range(400)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.mark.parametrize("descending", [False, True])
def test_pages_of_a_copy_are_the_full_order(spark, scratch, descending):
    df = table(spark)
    paging.write_pages(df, f"{scratch}/copy", ["k"], descending=descending, rows_per_file=60)
    seen, after = [], -1
    while page := paging.read_page(spark, f"{scratch}/copy", 100, after).collect():
        assert len(page) == 100 and len(paging.files_of_page(spark, f"{scratch}/copy", 100, after)) <= 6
        seen += page
        after = page[-1][paging.PLACE]
    order = F.desc_nulls_last("k") if descending else F.asc_nulls_first("k")
    assert [r["k"] for r in seen] == [r["k"] for r in df.orderBy(order).collect()]
    plain = lambda rows: sorted((repr((r["k"], r["n"], r["v"])) for r in rows))
    assert plain(seen) == plain(df.collect())


def test_a_hot_key_lies_in_many_files(spark, scratch):
    paging.write_pages(table(spark), f"{scratch}/copy", ["k"], rows_per_file=60)
    files = spark.read.parquet(f"{scratch}/copy/rows").filter("k = 'hot'").select(F.input_file_name()).distinct()
    assert files.count() > 2


def test_empty_copy(spark, scratch):
    paging.write_pages(spark.createDataFrame([], SCHEMA), f"{scratch}/copy", ["k"])
    assert paging.read_page(spark, f"{scratch}/copy").collect() == []


@pytest.mark.parametrize("descending", [False, True])
def test_cursor_of_keys(spark, descending):
    df = table(spark).distinct()
    keys = ["k", "n", "v"]
    full = [tuple(r) for r in paging.page_after(df, keys, limit=10_000, descending=descending).collect()]
    seen = [tuple(r) for r in paging.page_after(df, keys, limit=150, descending=descending).collect()]
    while page := paging.page_after(df, keys, list(seen[-1]), 150, descending).collect():
        seen += [tuple(r) for r in page]
    assert seen == full and len(full) == df.count()


def test_a_seek_needs_no_global_sort(spark):
    plan = paging.page_after(table(spark), ["k", "n"], ["k10", 3])._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan and "rangepartitioning" not in plan
