"""Item tables that are made one part after the other, so that only one part's shuffle files are on disk."""

import datetime

import pytest

import __spark_entry__ as entry
from shelfwise.operators import extract, marts
from shelfwise.plans import context, publish
from shelfwise.session import FREE_SHUFFLES, written, written_in_turn
from shelfwise.sources import sampling, tables

from tests.conftest import SF_SMALL
from tests.test_item_numbers import _lineitem
from tools.check_oracle import rows_of


def _rows(df):
    return rows_of(df.columns, [tuple(r) for r in df.collect()])


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture()
def parted(monkeypatch):
    """However small, tables are worked through in as many parts as there may be."""
    monkeypatch.setattr(tables, "SLICE_BYTES", 1)


@pytest.mark.parametrize("name", ["V04_item_view", "V25_collection_detail_view", "K04_upsert_item", "K04_merge_by_version"])
def test_parts_make_the_whole(spark, monkeypatch, name):
    whole = _rows(entry.queries()[name](spark, SF_SMALL))
    monkeypatch.setattr(tables, "SLICE_BYTES", 1)
    assert context.count_item_parts(spark, SF_SMALL) == tables.SLICES
    df = entry.queries()[name](spark, SF_SMALL)
    assert _rows(df) == whole and len(whole) > 100
    if name != "V25_collection_detail_view":  # it adds the bibs without items
        assert "Exchange" not in _plan(df) and "Join" not in _plan(df)


def test_parts_of_a_snapshot_make_the_whole(spark, monkeypatch, parted):
    t = context.base(spark, SF_SMALL)
    item = written(t["item"])
    whole = _rows(marts.item_view({**t, "item": item}))
    monkeypatch.setitem(context._CACHE, context._key(spark, SF_SMALL),
                        {"sources": context.sources(spark, SF_SMALL), "base": {**t, "item": item}, "published": True})
    assert context.count_item_parts(spark, SF_SMALL) > 1
    parts = list(context.item_parts(spark, SF_SMALL))
    assert all("Join" not in _plan(p) for p in parts)
    assert _rows(marts.item_view(context.base(spark, SF_SMALL), None, parts)) == whole


def test_changed_items_in_parts(spark, parted):
    s = context.sources(spark, SF_SMALL)
    since = datetime.date(2023, 12, 15)
    parts = [extract.item(s, since, (k, 3)) for k in range(3)]
    assert all(p.count() for p in parts)
    assert _rows(parts[0].union(parts[1]).union(parts[2])) == _rows(extract.item(s, since))


def test_upsert_deals_the_rows_out_once(spark):
    rows = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (3, "d"), (None, "e")], "k long, v string")
    delta = spark.createDataFrame([("x", 2), ("y", 4), ("y", 4), ("z", 3), ("n", None)], "v string, k long")
    gone = spark.createDataFrame([(3,), (1,), (None,)], "k long")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = publish.upsert(rows, delta, "k", deleted_keys=gone)
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert sorted(map(tuple, got.collect()), key=repr) == [(2, "x"), (4, "y"), (4, "y"), (None, "e"), (None, "n")]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "Exchange" not in plan[:plan.index("Union")]  # what both sides have kept isn't dealt out again


def test_ranked_items_are_sorted_and_written_once(spark, parted):
    far = 1 << 40
    keys = [(far + i % 7, i % 3, i % 5, i % 2) for i in range(200)] + [(None, 1, 1, 1), (far, 1, None, 1)]
    got = tables.ranked_items(_lineitem(spark, keys))
    assert "Join" not in _plan(got) and "Exchange" not in _plan(got)
    ranks = [(tuple(r[c] for c in tables.ITEM_KEYS), r["item_num"]) for r in got.collect()]
    assert sorted(k for k, _ in ranks if None not in k) == sorted(k for k in keys if None not in k)
    place = {k: i for i, k in enumerate(sorted({k for k in keys if None not in k}), 1)}
    assert len(ranks) == len(keys) and all(n == place.get(k) for k, n in ranks)


def test_a_sample_sets_ends_apart_that_lead_no_further(spark, monkeypatch):
    """Chains, an end reached from two ids, roots at an end, and links both ways and to oneself."""
    links = [(i, 100 + i) for i in range(50)] + [(1, 102), (2, 102), (102, 103), (7, 7), (8, 9), (9, 8), (20, 120), (20, 120)]
    seen = []
    only = sampling._only
    monkeypatch.setattr(sampling, "_only", lambda df, c, ids: seen.append((c, df.count())) or only(df, c, ids))
    got = sampling.reached(spark.createDataFrame(links, "a long, b long"), spark.createDataFrame([(1,), (120,), (9,), (500,)], "id long"))
    assert {r["id"] for r in got.collect()} == {1, 101, 102, 2, 103, 3, 120, 20, 9, 8, 109, 108, 500}
    rounds = [n for c, n in seen if c in "ab"][1:]
    assert rounds and max(rounds) < len(links) / 3


def test_writing_in_turn_restores_the_setting(spark):
    old = spark.conf.get(FREE_SHUFFLES, None)
    df = written_in_turn(spark.range(k, k + 5).groupBy("id").count() for k in (0, 5))
    assert sorted(r["id"] for r in df.collect()) == list(range(10))
    assert spark.conf.get(FREE_SHUFFLES, None) == old
