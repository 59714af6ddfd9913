"""Edge semantics of the marts on tiny hand-built base tables."""

import datetime as dt
import json

import pytest
from pyspark.sql import types as T

from shelfwise.operators import extract, marts, reports
from tests.conftest import SF_SMALL
from tests.seed_fixture import AS_OF, seed_sources


@pytest.fixture(scope="module")
def base(spark):
    return extract.build_base_tables(seed_sources(spark, SF_SMALL), AS_OF)


def frame(spark, like, rows):
    schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in like.schema.fields])
    return spark.createDataFrame([tuple(r.get(f.name) for f in schema.fields) for r in rows], schema)


def item_row(**kw):
    row = dict(item_record_num=1, item_record_id=10, bib_record_num=1000001, location_code="mapl",
               item_status_code="-", item_format="Book", barcode="3100", item_callnumber="cn",
               volume_record_statement=None, checkout_total=1, renewal_total=0, price_cents=100)
    row.update(kw)
    return row


def test_v02_null_and_empty_statement_match_each_other(spark, base):
    items = frame(spark, base["item"], [
        item_row(item_record_num=1, item_record_id=10, barcode="a", volume_record_statement=None),
        item_row(item_record_num=2, item_record_id=20, barcode="b", volume_record_statement=None),
        item_row(item_record_num=3, item_record_id=30, barcode="c", volume_record_statement=""),
    ])
    t = dict(base, item=items)
    rows = {r.volume_record_statement: r for r in marts.duplicate_items_in_location_view(t).collect()}
    # only the NULL group has > 1 items, but its item list also takes the '' item
    assert set(rows) == {None}
    assert rows[None].count_item_records == 2
    assert [o["barcode"] for o in json.loads(rows[None].item_data)] == ["a", "b", "c"]


def test_v22_hold_only_month_and_browse_subtraction(spark, base):
    circ = frame(spark, base["circ_agg"], [
        dict(transaction_day="2024-01-05", op_code="o", itype_code_num=1, count_op_code=10, branch_name="Main"),
        dict(transaction_day="2024-01-09", op_code="f", itype_code_num=1, count_op_code=3, branch_name="Main"),
        dict(transaction_day="2024-02-02", op_code="f", itype_code_num=1, count_op_code=4, branch_name="Main"),
        dict(transaction_day="2024-02-03", op_code="i", itype_code_num=1, count_op_code=9, branch_name="Main"),
    ])
    got = sorted(tuple(r) for r in marts.circ_agg_branch_view(dict(base, circ_agg=circ)).collect())
    assert got == [("2024-01", "Main", "Book", "from_browse", 7), ("2024-01", "Main", "Book", "from_hold", 3),
                   ("2024-02", "Main", "Book", "from_hold", 4)]


def test_v11_two_leased_formats_do_not_multiply_owned(spark, base):
    items = frame(spark, base["item"], [
        item_row(item_record_num=1, barcode="L01", item_format="Leased Book", checkout_total=4),
        item_row(item_record_num=2, barcode="l02", item_format="Leased DVD", checkout_total=6),
        item_row(item_record_num=3, barcode="3103", item_format="Book", checkout_total=5),
        item_row(item_record_num=4, barcode=None, item_format="Book", checkout_total=100),
    ])
    rows = {r.ld_item_format: r for r in marts.ld_compare_view(dict(base, item=items)).collect()}
    assert set(rows) == {"Leased Book", "Leased DVD"}          # lower-case 'l' counts as leased
    for r in rows.values():
        assert (r.non_ld_count_items, r.non_ld_sum_checkout_total) == (1, 5)   # NULL barcode is neither
    assert rows["Leased DVD"].ld_checkouts_per_item == 6.0


def test_modal_format_counts_null_as_a_format(spark, base):
    items = frame(spark, base["item"], [
        item_row(item_record_num=1, item_format=None), item_row(item_record_num=2, item_format=None),
        item_row(item_record_num=3, item_format="Book")])
    got = marts.modal_format(items).collect()
    assert [(r.bib_record_num, r.modal_format) for r in got] == [(1000001, None)]


def test_json_objects_keep_null_fields(spark, base):
    row = marts.last_copy_view(base).filter("barcode = '31234002'").first()
    stats = json.loads(row.circ_stats)
    assert list(stats) == ["last_checkout_date", "due_date", "checkout_total", "renewal_total"]
    assert stats["due_date"] is None and stats["last_checkout_date"] == "2024-06-01"
    jacket = json.loads(row.jacket)
    assert jacket["img_src"] is None                     # no ISBN -> NULL image, key kept


def test_hold_record_types_and_unknown_patron(spark):
    s = seed_sources(spark, SF_SMALL)
    extra = [dict(id=3, patron_record_id=99, record_id=2000003, placed_gmt=dt.datetime(2024, 11, 2), delay_days=0,
                  is_frozen=True, status="i", is_ir=False, is_ill=False),
             dict(id=4, patron_record_id=3000001, record_id=4000001, placed_gmt=dt.datetime(2024, 11, 3),
                  delay_days=0, is_frozen=False, status="t", is_ir=False, is_ill=False)]
    s = dict(s, hold=s["hold"].unionByName(frame(spark, s["hold"], extra)))
    rows = {r.hold_id: r for r in extract.hold(s, AS_OF).collect()}
    assert (rows[3].record_type_on_hold, rows[3].bib_record_num, rows[3].item_record_num) == ("i", 1000003, 2000003)
    assert rows[3].patron_is_active is False and rows[3].patron_has_over_10usd_owed is False
    assert rows[3].hold_status == "item hold ready for pickup"
    assert (rows[4].record_type_on_hold, rows[4].bib_record_num, rows[4].volume_record_num) == ("j", 1000001, 4000001)
    assert rows[4].hold_status == "in transit to pickup location"
    v08 = {r.hold_id: r for r in marts.hold_view(extract.build_base_tables(s, AS_OF)).collect()}
    assert v08[3].not_wanted_before_date is None            # frozen
    assert v08[1].not_wanted_before_date == dt.date(2024, 10, 15)


def test_empty_inputs_give_typed_empty_outputs(spark, base):
    empty = {k: v.limit(0) for k, v in base.items()}
    for fn in (marts.item_view, marts.collection_value_branch_view, marts.genre_view, marts.dup_at_location_view,
               reports.items_by_branch):
        out = fn(empty)
        assert out.count() == 0 and len(out.schema.fields) > 0


def test_genre_counts_repeats_and_skips_empty_arrays(spark, base):
    bib = frame(spark, base["bib"], [dict(bib_record_num=1, genres=["fantasy", "fantasy"]),
                                     dict(bib_record_num=2, genres=[]), dict(bib_record_num=3, genres=None),
                                     dict(bib_record_num=4, genres=["fantasy", "poetry"])])
    got = {r.genre: r.count_bibs for r in marts.genre_view(dict(base, bib=bib)).collect()}
    assert got == {"fantasy": 3, "poetry": 1}


def test_two_month_window_monday_and_year_end(spark, base):
    items = frame(spark, base["item"], [
        item_row(item_record_num=1, bib_record_num=11, item_format="Leased Book", creation_date=dt.date(2023, 12, 28)),
        item_row(item_record_num=2, bib_record_num=12, item_format="Leased Book", creation_date=dt.date(2024, 1, 1)),
        item_row(item_record_num=3, bib_record_num=13, item_format="Leased DVD", creation_date=dt.date(2023, 11, 1))])
    circ = frame(spark, base["circ_leased_items"], [
        dict(bib_record_num=13, op_code="o", transaction_day="2023-11-20"),    # earliest overall: excluded
        dict(bib_record_num=11, op_code="o", transaction_day="2023-12-31"),    # Sunday -> Monday Dec 25
        dict(bib_record_num=11, op_code="o", transaction_day="2024-02-25"),    # inside window (<= Feb 25)
        dict(bib_record_num=11, op_code="o", transaction_day="2024-02-26"),    # outside
        dict(bib_record_num=12, op_code="i", transaction_day="2024-01-01"),    # Monday -> previous Monday
        dict(bib_record_num=12, op_code="o", transaction_day="2024-01-08")])
    bibs = frame(spark, base["bib"], [dict(bib_record_num=b, best_title=f"t{b}") for b in (11, 12, 13)])
    out = {r.bib_record_num: r for r in marts.two_months_leased_item_view(
        dict(base, item=items, circ_leased_items=circ, bib=bibs), "2024-06-01").collect()}
    assert set(out) == {11, 12}
    assert out[11]._2_months_from_earliest_circ_date == dt.date(2024, 2, 25)
    assert out[11].count_checkouts_2_months_from_earliest_circ_date == 2
    assert out[12].earliest_circ_date == "2024-01-01"
    assert out[12]._2_months_from_earliest_circ_date == dt.date(2024, 2, 25)     # Dec 25 + 2 months
    # checkouts counted against the window of the first *checkout* (Jan 8 -> Mon Jan 1 -> Mar 1)
    assert out[12].count_checkouts_2_months_from_earliest_circ_date == 1
