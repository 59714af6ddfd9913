"""A small hand-made source database (the reference's integration seed, re-typed as rows).

Relative timestamps of the seed ("now - 7 days") are taken relative to AS_OF.
Frames get exactly the column names and types of the adapter relations.
"""

import datetime as dt
from decimal import Decimal

from pyspark.sql import types as T

from shelfwise.sources.tables import load_sources

AS_OF = dt.date(2024, 12, 1)
NOW = dt.datetime.combine(AS_OF, dt.time(12, 0))


def ts(s):
    return dt.datetime.fromisoformat(s)


ROWS = {
    "record_metadata": [
        dict(id=i, record_num=i, record_type_code=t, campus_code="", creation_date_gmt=ts(c),
             record_last_updated_gmt=ts(u))
        for i, t, c, u in [
            (1000001, "b", "2020-01-01", "2024-01-01"), (1000002, "b", "2021-06-15", "2024-06-15"),
            (1000003, "b", "2019-03-20", "2023-03-20"), (2000001, "i", "2020-02-01", "2024-02-01"),
            (2000002, "i", "2021-07-10", "2024-07-10"), (2000003, "i", "2019-04-05", "2023-04-05"),
            (2000004, "i", "2022-09-01", "2024-09-01"), (2000005, "i", "2023-01-01", "2024-01-01"),
            (3000001, "p", "2018-05-01", "2024-05-01"), (3000002, "p", "2019-11-11", "2024-11-11"),
            (4000001, "j", "2021-01-01", "2024-01-01")]],
    "bib_record": [
        dict(id=k, record_id=r, language_code="eng", bcode1="a", bcode2=" ", bcode3="-", country_code="ohu",
             index_change_count=0, is_on_course_reserve=False, is_right_result_exact=True, allocation_rule_code=" ",
             skip_num=0, cataloging_date_gmt=ts(c), marc_type_code="a", is_suppressed=False)
        for k, r, c in [(1, 1000001, "2020-02-01"), (2, 1000002, "2021-07-01"), (3, 1000003, "2019-05-01")]],
    "bib_record_property": [
        dict(id=k, bib_record_id=r, best_author=a, best_author_norm=a.lower(), best_title=t, best_title_norm=t.lower(),
             publish_year=y)
        for k, r, a, t, y in [(1, 1000001, "Adams, Douglas", "The Hitchhiker's Guide to the Galaxy", 1979),
                              (2, 1000002, "Le Guin, Ursula K.", "The Left Hand of Darkness", 1969),
                              (3, 1000003, "Butler, Octavia E.", "Kindred", 1979)]],
    "volume_record": [dict(id=1, record_id=4000001)],
    "varfield": [dict(id=1, record_id=2000001, marc_tag=None, marc_ind1=" ", marc_ind2=" ", varfield_type_code="m",
                      occ_num=0, field_content="Jan 01 2024 09:00AM")],
    "item_record": [
        dict(id=k, record_id=r, agency_code_num=1, location_code=loc, checkout_statistic_group_code_num=sg,
             checkin_statistics_group_code_num=sg, last_checkout_gmt=lo and ts(lo), last_checkin_gmt=li and ts(li),
             checkout_total=ct, renewal_total=rt, itype_code_num=it, item_status_code=st, price=Decimal(p))
        for k, r, loc, sg, lo, li, ct, rt, it, st, p in [
            (1, 2000001, "mapl", 10, "2024-01-15", "2024-01-20", 42, 5, 1, "-", "14.9900"),
            (2, 2000002, "wpl", 20, "2024-06-01", "2024-06-15", 18, 2, 1, "-", "12.9900"),
            (3, 2000003, "npl", 30, "2023-11-01", "2023-11-15", 67, 12, 1, "-", "10.0000"),
            (4, 2000004, "cpl", 10, None, None, 3, 0, 2, "o", "24.9500"),
            (5, 2000005, "2anf", 10, None, None, 1, 0, 1, "-", "19.9900")]],
    "item_record_property": [
        dict(id=k, item_record_id=r, barcode=b, call_number=c, call_number_norm=c.lower())
        for k, r, b, c in [(1, 2000001, "31234001", "SF ADAMS"), (2, 2000002, "31234002", "SF LE GUIN"),
                           (3, 2000003, "31234003", "SF BUTLER"), (4, 2000004, "31234004", "SF BUTLER K"),
                           (5, 2000005, "L000000002005", "SF TEST")]],
    "bib_record_item_record_link": [
        dict(id=k, bib_record_id=b, item_record_id=i, items_display_order=o, bibs_display_order=0)
        for k, b, i, o in [(1, 1000001, 2000001, 0), (2, 1000002, 2000002, 0), (3, 1000003, 2000003, 0),
                           (4, 1000003, 2000004, 1), (5, 1000001, 2000005, 2)]],
    "bib_record_volume_record_link": [dict(bib_record_id=1000001, volume_record_id=4000001)],
    "volume_record_item_record_link": [dict(id=1, volume_record_id=4000001, item_record_id=2000001,
                                            items_display_order=0)],
    "checkout": [dict(id=1, item_record_id=2000004, patron_record_id=3000001, checkout_gmt=ts("2024-11-01"),
                      due_gmt=ts("2024-11-22"), loanrule_code_num=1, renewal_count=0, overdue_count=0)],
    "patron_record": [
        dict(id=1, record_id=3000001, home_library_code="mapl", ptype_code=1, mblock_code=" ",
             owed_amt=Decimal("0.0000"), activity_gmt=NOW - dt.timedelta(days=30)),
        dict(id=2, record_id=3000002, home_library_code="wpl", ptype_code=1, mblock_code=" ",
             owed_amt=Decimal("0.0000"), activity_gmt=NOW - dt.timedelta(days=60))],
    "hold": [
        dict(id=1, patron_record_id=3000001, record_id=1000001, placed_gmt=ts("2024-10-15"), delay_days=0,
             is_frozen=False, expires_gmt=ts("2025-01-15"), status="0", is_ir=False, is_ill=False,
             pickup_location_code="mapl", location_code="mapl", is_ir_converted_request=False),
        dict(id=2, patron_record_id=3000002, record_id=1000002, placed_gmt=ts("2024-11-01"), delay_days=7,
             is_frozen=False, expires_gmt=ts("2025-02-01"), status="0", is_ir=False, is_ill=False,
             pickup_location_code="wpl", location_code="wpl", is_ir_converted_request=False)],
    "branch": [dict(id=1, code_num=10, address="800 Vine St", address_latitude=39.1031, address_longitude=-84.512),
               dict(id=2, code_num=20, address="3450 Central Ave", address_latitude=39.135, address_longitude=-84.533)],
    "branch_name": [dict(id=1, branch_id=1, name="Main Library"), dict(id=2, branch_id=2, name="Anderson Library")],
    "location": [dict(id=k, code=c, branch_code_num=b, is_public=True, is_requestable=True)
                 for k, c, b in [(1, "mapl", 10), (2, "wpl", 20), (3, "npl", 10), (4, "cpl", 10), (5, "2anf", 20)]],
    "location_name": [dict(id=k, location_id=k, name=n) for k, n in [
        (1, "Main Library - Adult Fiction"), (2, "Westwood Library"), (3, "Northside Library"),
        (4, "College Hill Library"), (5, "Anderson Library - Adult Non-Fiction")]],
    "statistic_group": [dict(id=1, code_num=10, location_code="mapl"), dict(id=2, code_num=20, location_code="wpl")],
    "statistic_group_name": [dict(id=1, statistic_group_id=1, name="Main Library"),
                             dict(id=2, statistic_group_id=2, name="Westwood Library")],
    "circ_trans": [
        dict(id=1, transaction_gmt=NOW - dt.timedelta(days=7), stat_group_code_num=10, op_code="o", itype_code_num=1,
             loanrule_code_num=1, patron_record_id=3000001, item_record_id=2000001, bib_record_id=1000001,
             item_location_code="mapl", ptype_code=1, patron_home_library_code="mapl", patron_agency_code_num=1,
             due_date_gmt=NOW + dt.timedelta(days=14), application_name="self-checkout"),
        dict(id=2, transaction_gmt=NOW - dt.timedelta(days=14), stat_group_code_num=10, op_code="o", itype_code_num=1,
             loanrule_code_num=1, patron_record_id=3000001, item_record_id=2000005, bib_record_id=1000001,
             item_location_code="2anf", ptype_code=1, patron_home_library_code="mapl", patron_agency_code_num=1,
             due_date_gmt=NOW + dt.timedelta(days=14), application_name="self-checkout"),
        dict(id=3, transaction_gmt=NOW - dt.timedelta(days=7), stat_group_code_num=10, op_code="i", itype_code_num=1,
             loanrule_code_num=1, patron_record_id=3000001, item_record_id=2000005, bib_record_id=1000001,
             item_location_code="2anf", ptype_code=1, patron_home_library_code="mapl", patron_agency_code_num=1,
             due_date_gmt=None, application_name="staff-client")],
    "item_status_property": [dict(id=k, code=c, display_order=k) for k, c in [(1, "-"), (2, "o"), (3, "m")]],
    "item_status_property_name": [dict(id=k, item_status_property_id=k, name=n)
                                  for k, n in [(1, "Available"), (2, "Checked Out"), (3, "Missing")]],
    "itype_property": [dict(id=1, code_num=1, display_order=1, physical_format_id=1),
                       dict(id=2, code_num=2, display_order=2, physical_format_id=2)],
    "itype_property_name": [dict(id=1, itype_property_id=1, name="Book"), dict(id=2, itype_property_id=2, name="DVD")],
    "physical_format_name": [dict(id=1, physical_format_id=1, name="Print"),
                             dict(id=2, physical_format_id=2, name="Video")],
}


def seed_sources(spark, template_dir):
    """Source frames with the adapter's schemas; relations absent from the seed are empty."""
    template = load_sources(spark, template_dir)
    out = {}
    for name, df in template.items():
        schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in df.schema.fields])
        rows = [tuple(r.get(f.name) for f in schema.fields) for r in ROWS.get(name, [])]
        out[name] = spark.createDataFrame(rows, schema)
    return out
