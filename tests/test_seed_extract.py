"""Extraction on the hand-made seed database, against hand-derived expectations."""

import pytest

from shelfwise.operators import extract, marts
from tests.conftest import SF_SMALL
from tests.seed_fixture import AS_OF, seed_sources


@pytest.fixture(scope="module")
def seed(spark):
    return seed_sources(spark, SF_SMALL)


@pytest.fixture(scope="module")
def base(seed):
    return extract.build_base_tables(seed, AS_OF)


def test_record_metadata_keeps_bib_item_volume_only(base):
    assert base["record_metadata"].count() == 9


def test_bib_arrays(base):
    rows = {r.bib_record_num: r for r in base["bib"].collect()}
    assert set(rows) == {1000001, 1000002, 1000003}
    for r in rows.values():
        assert r.control_numbers is None and r.isbn_values is None and r.genres is None
        assert r.indexed_subjects is None and r.publisher is None
    assert rows[1000001].item_types == ["Book"]
    assert rows[1000003].item_types == ["Book", "DVD"]        # count tie -> by name


def test_item_rows(base):
    rows = {r.item_record_num: r for r in base["item"].collect()}
    assert len(rows) == 5
    assert {k for k, r in rows.items() if r.volume_record_num is not None} == {2000001}
    assert [rows[k].price_cents for k in sorted(rows)] == [1499, 1299, 1000, 2495, 1999]
    assert sorted(r.item_format for r in rows.values()) == ["Book"] * 4 + ["DVD"]
    assert rows[2000004].patron_branch_code == "mapl" and rows[2000004].due_date.isoformat() == "2024-11-22"


def test_holds(base):
    rows = sorted(base["hold"].collect(), key=lambda r: r.hold_id)
    assert [(r.bib_record_num, r.hold_status, r.patron_is_active) for r in rows] == [
        (1000001, "on hold", True), (1000002, "on hold", True)]


def test_circulation(base):
    agg = sorted((r.op_code, r.count_op_code, r.count_distinct_patrons, r.branch_name)
                 for r in base["circ_agg"].collect())
    assert agg == [("i", 1, 1, "Main Library"), ("o", 1, 1, "Main Library"), ("o", 1, 1, "Main Library")]
    leased = base["circ_leased_items"].collect()
    assert len(leased) == 2 and {r.barcode for r in leased} == {"L000000002005"}


def test_volume_and_message(base):
    assert base["volume_record"].count() == 1
    assert base["item_message"].count() == 0     # no weekday, no route -> no row


def test_marts_on_seed(base):
    t = base
    v07 = {(r.branch_name, r.location_name, r.item_format): (r.count_items, r.sum_price)
           for r in marts.collection_value_branch_view(t).collect()}
    assert v07[("Main Library", "Main Library - Adult Fiction", "Book")] == (1, 14.99)
    assert v07[("Main Library", "College Hill Library", "DVD")] == (1, 24.95)
    assert sum(n for n, _ in v07.values()) == 5
    active = marts.active_holds_view(t, AS_OF).collect()
    assert sorted(r.hold_id for r in active) == [1, 2]
    leased = marts.leased_item_view(t).collect()
    assert [(r.barcode, r.best_title) for r in leased] == [("L000000002005", "The Hitchhiker's Guide to the Galaxy")]
