"""Analytical marts over the base tables.

Signature: ``v_<name>(t, as_of) -> DataFrame`` where ``t`` maps base-table names
to DataFrames.  Per-row correlated lookups of the view definitions become one
pre-aggregation per child relation plus an equi-join; dimension tables
(locations, branches, lookups: thousands of rows at most) are broadcast, the
item/bib/hold relations are joined by shuffle on their record number.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.functions import codes
from shelfwise.functions.plan import bounded_broadcast, skew_safe_left_join, sparse_left_join, written_broadcast
from shelfwise.functions.dates import as_date, from_jd, jd_of, monday_before, plus_months_overflow
from shelfwise.functions.text import json_object, ordered_values, truncate_ellipsis
from shelfwise.session import written, written_in_turn


# ----------------------------------------------------------------- shared parts
def _loc_names(t) -> DataFrame:
    """location code -> location id, name, branch number, branch name (small)."""
    loc = t["location"].select(F.col("id").alias("location_id"), F.col("code").alias("location_code"),
                               "branch_code_num", "is_public", "is_requestable")
    ln = t["location_name"].select("location_id", F.col("name").alias("location_name"))
    br = t["branch"].select(F.col("id").alias("branch_id"), F.col("code_num").alias("b_code_num"))
    bn = t["branch_name"].select("branch_id", F.col("name").alias("branch_name"))
    return loc, ln, br, bn


def named_locations(t) -> DataFrame:
    """Locations that have a name and a branch (small)."""
    loc, ln, br, bn = _loc_names(t)
    return (loc.join(ln, "location_id").join(br, F.col("branch_code_num") == F.col("b_code_num"))
            .join(bn, "branch_id").select("location_code", "location_id", "location_name", "branch_name"))


def _isbn0(isbn_values: Column) -> Column:
    return F.get(isbn_values, 0)


def jacket(bib_num: Column, isbn_values: Column) -> Column:
    return json_object(
        ("img_src", F.concat(F.lit(codes.JACKET_URL_PREFIX), _isbn0(isbn_values), F.lit("-L.jpg"))),
        ("href", F.concat(F.lit(codes.CATALOG_URL_PREFIX), bib_num.cast("string"))))


def catalog_link(bib_num, title, author, year, callnum, label=None) -> Column:
    nl = F.lit("\n")
    return json_object(
        ("href", F.concat(F.lit(codes.CATALOG_URL_PREFIX), bib_num.cast("string"))),
        ("label", title if label is None else label),
        ("title", F.concat(title, F.coalesce(F.concat(nl, author), F.lit("")))),
        ("description", F.concat(author, nl, year.cast("string"),
                                 F.coalesce(F.concat(nl, callnum), F.lit("")))))


def modal_format(item: DataFrame) -> DataFrame:
    """Most frequent item format per bib (NULL counts as a format; ties -> smallest)."""
    counts = item.groupBy("bib_record_num", "item_format").agg(F.count(F.lit(1)).alias("n"))
    return (counts.groupBy("bib_record_num")
            .agg(F.min_by("item_format", F.struct(-F.col("n"), F.col("item_format"))).alias("modal_format")))


def _json_sorted_list(value: Column) -> Column:
    """Aggregate: JSON array text of all values (NULLs kept), in sorted order."""
    return F.to_json(ordered_values(value, value))


def _avail_due_ok(as_of) -> Column:
    """Due date (if any) at most 59 days before ``as_of`` (noon-based Julian reading)."""
    return F.coalesce(F.datediff(F.lit(as_of), F.col("due_date")), F.lit(0)) <= 59


# ----------------------------------------------------------------- V01-V07
def isbn_view(t, as_of=None) -> DataFrame:
    b = t["bib"].select("bib_record_num", "bib_level_callnumber", F.explode("isbn_values").alias("isbn"))
    i = t["item"].select("bib_record_num", "item_record_num", "location_code", "item_status_code")
    return (skew_safe_left_join(b, i, ["bib_record_num"])
            .select("isbn", "bib_level_callnumber", "bib_record_num", "item_record_num", "location_code",
                    "item_status_code"))


def duplicate_items_in_location_view(t, as_of=None) -> DataFrame:
    avail = t["item"].filter(F.col("item_status_code").isin(*codes.AVAILABLE_STATUS))
    groups = (avail.groupBy("bib_record_num", "volume_record_statement", "location_code")
              .agg(F.count("item_record_num").alias("count_item_records"))
              .filter(F.col("count_item_records") > 1)
              .join(t["bib_record_item_record_link"].select("bib_record_num"), "bib_record_num", "left_semi"))
    members = avail.select("bib_record_num", "location_code",
                           F.coalesce("volume_record_statement", F.lit("")).alias("vkey"),
                           F.struct("barcode", "location_code",
                                    F.col("item_callnumber").alias("call_number")).alias("obj"))
    data = (groups.withColumn("vkey", F.coalesce("volume_record_statement", F.lit("")))
            .join(members, ["bib_record_num", "location_code", "vkey"])
            .groupBy("bib_record_num", "volume_record_statement", "location_code", "count_item_records")
            .agg(F.to_json(F.array_sort(F.collect_set("obj")), {"ignoreNullFields": "false"})
                 .alias("item_data")))
    return data.orderBy(F.desc("count_item_records"), "bib_record_num", "location_code", "volume_record_statement")


def location_view(t, as_of=None) -> DataFrame:
    loc, ln, br, bn = _loc_names(t)
    out = (loc.join(ln, "location_id").join(br, F.col("branch_code_num") == F.col("b_code_num"))
           .join(bn, "branch_id"))
    return out.select(
        "location_id", "location_code", "is_public", "is_requestable",
        F.col("b_code_num").alias("branch_code_num"), "location_name", "branch_name",
        json_object(("href", F.concat(F.lit(codes.LOCATION_ITEMS_HREF_PREFIX),
                                      F.coalesce("location_code", F.lit("")))),
                    ("label", F.lit("view items"))).alias("items"))


def _location_dim(t) -> DataFrame:
    """location code -> location name, branch name (left-joined, small)."""
    loc, ln, br, bn = _loc_names(t)
    return (loc.join(ln, "location_id", "left")
            .join(br, F.col("branch_code_num") == F.col("b_code_num"), "left")
            .join(bn, "branch_id", "left")
            .select("location_code", "location_name", "branch_name"))


def item_view(t, as_of=None, items: Iterable[DataFrame] | None = None) -> DataFrame:
    """Items with title, place and status; ``items``: the item table in parts, worked through one after the other."""
    b = t["bib"].select("bib_record_num", "best_author", "best_title", "publish_year")
    locations = written_broadcast(_location_dim(t))
    st = bounded_broadcast(t["item_status_property"].select("item_status_code", "item_status_name"))

    def view(i: DataFrame, b: DataFrame) -> DataFrame:
        out = (i.join(b, "bib_record_num", "left")
               .join(locations, "location_code", "left")
               .join(st, "item_status_code", "left"))
        return out.select(
            "item_record_num", "volume_record_num", "bib_record_num", "creation_date", "barcode", "item_format",
            "location_code", "location_name", "branch_name", "item_callnumber",
            F.col("volume_record_statement").alias("vol_statement"), "best_author", "best_title",
            "agency_code_num", "item_status_code", "item_status_name", "checkout_date", "due_date",
            "checkout_total", "renewal_total", "publish_year",
            F.coalesce("checkout_date", "last_checkin_date", "last_checkout_date").alias("last_circ_act_date"),
            (F.col("price_cents") / F.lit(100.0)).alias("item_price"))

    if items is None:
        return view(t["item"], b)
    b = written(b)
    return written_in_turn(view(i, b) for i in items)


def branch_30_day_circ_view(t, as_of=None) -> DataFrame:
    c = t["circ_agg"].withColumn("day", F.to_date("transaction_day"))
    latest = c.agg(F.max("day")).scalar()
    recent = c.filter((F.col("day") > F.date_sub(latest, 30)) & F.col("op_code").isin("o", "i"))
    per_type = (recent.groupBy("branch_name", "branch_code_num",
                               F.when(F.col("op_code") == "o", "check-out").otherwise("check-in")
                               .alias("circ_type"))
                .agg(F.sum("count_op_code").alias("sum_circ_type")))
    loc = t["branch_locations"].select(F.col("code_num").alias("branch_code_num"), "latitude", "longitude")
    out = (per_type.join(bounded_broadcast(loc), "branch_code_num")
           .groupBy("branch_name", "latitude", "longitude")
           .agg(F.to_json(F.map_from_entries(F.array_sort(F.collect_list(
                F.struct("circ_type", "sum_circ_type"))))).alias("circulations"),
                F.sum("sum_circ_type").alias("total")))
    return out.orderBy(F.desc("total"), "branch_name")


def branch_location_view(t, as_of=None) -> DataFrame:
    loc, ln, br, bn = _loc_names(t)
    out = (loc.filter(F.col("branch_code_num").isNotNull())
           .join(ln, "location_id", "left")
           .join(br, F.col("branch_code_num") == F.col("b_code_num"), "left")
           .join(bn, "branch_id", "left"))
    return (out.select(F.col("location_code").alias("code"), "location_name",
                       F.col("b_code_num").alias("branch_code_num"), "branch_name",
                       F.concat(F.lit(codes.ITEM_VIEW_URL_PREFIX), F.col("location_code"))
                       .alias("location_item_view"))
            .orderBy("branch_code_num", "location_name", "code"))


def collection_value_branch_view(t, as_of=None) -> DataFrame:
    return (t["item"].select("location_code", "item_format", "item_record_num", "price_cents")
            .join(bounded_broadcast(named_locations(t).drop("location_id")), "location_code")
            .groupBy("branch_name", "location_name", "item_format")
            .agg(F.count("item_record_num").alias("count_items"),
                 (F.sum("price_cents") / F.lit(100.0)).alias("sum_price")))


# ----------------------------------------------------------------- holds V08, V09, V19
def hold_view(t, as_of=None) -> DataFrame:
    h = t["hold"]
    b = t["bib"].select("bib_record_num", F.col("best_title").alias("title"),
                        F.col("cataloging_date").alias("cat_date"))
    vol = t["volume_record"].select("volume_record_num", "volume_statement")
    loc, ln, br, bn = _loc_names(t)
    pickup = (loc.join(ln, "location_id", "left")
              .join(br, F.col("branch_code_num") == F.col("b_code_num"), "left")
              .join(bn, "branch_id", "left")
              .select(F.col("location_code").alias("pickup_location_code"),
                      F.col("branch_name").alias("branch_pickup_name")))
    campus = (loc.join(ln, "location_id").groupBy(F.col("location_code").alias("campus_code"))
              .agg(F.min("location_name").alias("campus_location_name")))
    out = (sparse_left_join(h.join(b, "bib_record_num"), vol, "volume_record_num", by="hold_id")
           .join(bounded_broadcast(pickup), "pickup_location_code", "left")
           .join(bounded_broadcast(campus), "campus_code", "left"))
    return out.select(
        "hold_id", "title", "cat_date", "bib_record_num", "item_record_num", "volume_record_num",
        "volume_statement", "campus_code", "record_type_on_hold", "hold_status", "is_frozen", "is_ir",
        "is_ill", "location_code", "pickup_location_code", "branch_pickup_name", "ir_pickup_location_code",
        "ir_print_name", "ir_delivery_stop_name", "is_ir_converted_request", "patron_is_active",
        "patron_ptype_code", "patron_home_library_code", "patron_mblock_code",
        "patron_has_over_10usd_owed", "campus_location_name",
        from_jd(F.col("placed_julianday")).alias("hold_placed_date"),
        from_jd(F.col("expires_julianday")).alias("hold_expires_date"),
        F.when(F.col("is_frozen") == F.lit(True), F.lit(None))
         .otherwise(from_jd(F.col("placed_julianday") + F.col("delay_days"))).alias("not_wanted_before_date"))


def hold_title_view(t, as_of) -> DataFrame:
    as_of = as_date(as_of)
    now_jd = jd_of(as_of)
    h = t["hold"].filter((F.col("hold_status") == "on hold") & F.col("is_frozen").eqNullSafe(False)
                         & (F.col("placed_julianday") + F.col("delay_days") < now_jd)
                         & F.col("patron_ptype_code").isin(*codes.ACTIVE_PTYPES))
    b = t["bib"].select("bib_record_num", "cataloging_date",
                        truncate_ellipsis("best_title", 37).alias("title"),
                        truncate_ellipsis("best_author", 37).alias("author"))
    vol = t["volume_record"].select("volume_record_num", F.col("volume_statement").alias("vol"))
    # Supply counts are needed only for titles / volumes that have active holds:
    # the item and link relations are reduced to those keys before aggregating.
    held_bibs = h.select("bib_record_num").distinct()
    held_vols = h.select("volume_record_num").filter(F.col("volume_record_num").isNotNull()).distinct()
    item = t["item"].join(held_bibs, "bib_record_num", "left_semi")
    avail = item.filter(F.col("item_status_code").isin(*codes.AVAILABLE_STATUS) & _avail_due_ok(as_of))
    per_bib = avail.groupBy("bib_record_num").agg(F.count(F.lit(1)).alias("bib_items"))
    avail_any = t["item"].filter(F.col("item_status_code").isin(*codes.AVAILABLE_STATUS) & _avail_due_ok(as_of))
    per_vol = (t["volume_record_item_record_link"].select("volume_record_num", "item_record_num")
               .join(held_vols, "volume_record_num", "left_semi")
               .join(avail_any.select("item_record_num"), "item_record_num")
               .groupBy("volume_record_num").agg(F.count(F.lit(1)).alias("vol_items")))
    formats = (item.select("bib_record_num", "item_format").distinct()
               .groupBy("bib_record_num")
               .agg(F.to_json(ordered_values(F.col("item_format"), F.col("item_format"))).alias("item_types")))
    keys = ["bib_record_num", "vol", "volume_record_num", "item_record_num", "cataloging_date", "title", "author"]
    grouped = (sparse_left_join(h.select("hold_id", "bib_record_num", "volume_record_num", "item_record_num")
                                .join(b, "bib_record_num"), vol, "volume_record_num", by="hold_id")
               .groupBy(*keys).agg(F.count("hold_id").alias("count_active_holds")))
    out = grouped.join(formats, "bib_record_num", "left").join(per_bib, "bib_record_num", "left")
    out = sparse_left_join(out, per_vol, "volume_record_num", by="bib_record_num")
    count_items = (F.when(F.col("item_record_num").isNotNull(), F.lit(1).cast("long"))
                   .when(F.col("volume_record_num").isNotNull(), F.coalesce("vol_items", F.lit(0)))
                   .otherwise(F.coalesce("bib_items", F.lit(0))))
    return (out.select(*keys, F.coalesce("item_types", F.lit("[]")).alias("item_types"),
                       "count_active_holds", count_items.alias("count_items"))
            .orderBy(F.desc("count_active_holds"), "bib_record_num", "volume_record_num", "item_record_num"))


def active_holds_view(t, as_of) -> DataFrame:
    now_jd = jd_of(as_date(as_of))
    bibs = t["record_metadata"].filter(F.col("record_type_code") == "b").select(
        F.col("record_num").alias("bib_record_num"))
    h = t["hold"]
    return (h.join(bibs, "bib_record_num", "left_semi")
            .filter((F.col("is_frozen").eqNullSafe(False) | (F.col("patron_ptype_code") == codes.FROZEN_EXEMPT_PTYPE))
                    & (F.col("placed_julianday") + F.col("delay_days") <= now_jd)
                    & F.col("patron_ptype_code").isin(*codes.ACTIVE_PTYPES)
                    & (F.col("hold_status") == "on hold"))
            .select(*h.columns))


# ----------------------------------------------------------------- leased V10, V11, V14
def _leased_range(c: Column) -> Column:
    return (c >= codes.LEASED_BARCODE_LOW) & (c < codes.LEASED_BARCODE_HIGH)


def leased_item_view(t, as_of=None) -> DataFrame:
    i = t["item"].filter(_leased_range(F.col("barcode")))
    st = t["item_status_property"].select("item_status_code", "item_status_name")
    b = t["bib"].select("bib_record_num", "best_author", "best_title", "publisher", "publish_year",
                        "bib_level_callnumber", F.col("cataloging_date").alias("bib_cataloging_date"))
    return (i.join(bounded_broadcast(st), "item_status_code", "left").join(b, "bib_record_num", "left")
            .select("item_format", "bib_record_num", "barcode", "price_cents", "checkout_date", "due_date",
                    "last_checkout_date", "last_checkin_date", "checkout_total", "item_status_name",
                    F.col("creation_date").alias("item_creation_date"),
                    F.col("record_last_updated").alias("item_record_last_updated"), "best_author",
                    "best_title", "publisher", "publish_year", "bib_level_callnumber", "bib_cataloging_date"))


def _per_item_2dp(total: Column, n: Column) -> Column:
    """round(total / n, 2) half-up on exact integers, as a double."""
    return (F.floor((total * 200 + n) / (n * 2)).cast("long") / F.lit(100.0))


def ld_compare_view(t, as_of=None) -> DataFrame:
    item = t["item"]
    is_ld = F.col("barcode").ilike("L%")
    ld = (item.filter(is_ld).groupBy("bib_record_num", F.col("item_format").alias("ld_item_format"))
          .agg(F.count("item_record_num").alias("ld_count_items"),
               F.sum("checkout_total").alias("ld_sum_checkout_total")))
    owned = (item.filter(~is_ld).groupBy("bib_record_num")
             .agg(F.count("item_record_num").alias("non_ld_count_items"),
                  F.sum("checkout_total").alias("non_ld_sum_checkout_total")))
    b = t["bib"].select("bib_record_num", "best_author", "best_title", "publisher", "publish_year",
                        "cataloging_date")
    out = ld.join(b, "bib_record_num").join(owned, "bib_record_num")
    return out.select(
        "bib_record_num", "best_author", "best_title", "ld_item_format", "ld_count_items",
        "ld_sum_checkout_total", "non_ld_count_items", "non_ld_sum_checkout_total", "publisher",
        "publish_year", "cataloging_date",
        _per_item_2dp(F.col("ld_sum_checkout_total"), F.col("ld_count_items")).alias("ld_checkouts_per_item"),
        _per_item_2dp(F.col("non_ld_sum_checkout_total"), F.col("non_ld_count_items"))
        .alias("non_ld_checkouts_per_item"))


def two_months_leased_item_view(t, as_of) -> DataFrame:
    as_of = as_date(as_of)
    leased = (t["item"].filter(F.col("item_format").isin(*codes.LEASED_FORMATS))
              .groupBy("bib_record_num", "item_format")
              .agg(F.count("item_record_num").alias("count_items"),
                   F.sum("checkout_total").alias("sum_total_items_checkouts"),
                   F.min("creation_date").alias("item_creation_date")))
    circ = t["circ_leased_items"].select("bib_record_num", "op_code", F.to_date("transaction_day").alias("day"))
    first = (circ.groupBy("bib_record_num")
             .agg(F.min("day").alias("first_any"),
                  F.min(F.when(F.col("op_code") == "o", F.col("day"))).alias("first_o")))
    first = (first.withColumn("window_any", plus_months_overflow(monday_before("first_any"), 2))
             .withColumn("window_o", plus_months_overflow(monday_before("first_o"), 2)))
    checkouts = (circ.filter(F.col("op_code") == "o").join(first.select("bib_record_num", "window_o"),
                                                           "bib_record_num")
                 .filter(F.col("day") <= F.col("window_o"))
                 .groupBy("bib_record_num").agg(F.count(F.lit(1)).alias("n_o")))
    counted = (leased.join(first, "bib_record_num", "left").join(checkouts, "bib_record_num", "left")
               .select("bib_record_num", "item_format", "count_items", "sum_total_items_checkouts",
                       "item_creation_date",
                       F.date_format("first_any", "yyyy-MM-dd").alias("earliest_circ_date"),
                       F.col("window_any").alias("_2_months_from_earliest_circ_date"),
                       F.coalesce("n_o", F.lit(0)).alias("count_checkouts_2_months_from_earliest_circ_date")))
    # The earliest transaction of any leased title: the minimum of the firsts, without building them again.
    titles = t["item"].filter(F.col("item_format").isin(*codes.LEASED_FORMATS)).select("bib_record_num")
    global_first = (circ.join(titles, "bib_record_num", "left_semi")
                    .agg(F.date_format(F.min("day"), "yyyy-MM-dd")).scalar())
    b = t["bib"].select("bib_record_num", "best_title", "best_author")
    out = (counted.filter(F.col("earliest_circ_date").isNotNull()
                          & (F.datediff(F.to_date("earliest_circ_date"), F.col("item_creation_date")) <= 14)
                          & (F.col("_2_months_from_earliest_circ_date") <= monday_before(F.lit(as_of)))
                          & (F.col("earliest_circ_date") > global_first))
           .join(b, "bib_record_num"))
    return (out.select("item_format", "bib_record_num", "best_title", "best_author", "count_items",
                       "sum_total_items_checkouts", "item_creation_date", "earliest_circ_date",
                       "_2_months_from_earliest_circ_date", "count_checkouts_2_months_from_earliest_circ_date")
            .orderBy(F.desc("_2_months_from_earliest_circ_date"), "bib_record_num", "item_format"))


# ----------------------------------------------------------------- V12, V13
def location_percent_checkout_view(t, as_of=None) -> DataFrame:
    agg = (t["item"].filter(F.col("item_status_code").isin(*codes.ACTIVE_STATUS))
           .groupBy("location_code")
           .agg(F.count("item_record_num").alias("count_total"), F.count("due_date").alias("count_checkout")))
    return percent_checkout(agg, t)


def percent_checkout(counts: DataFrame, t) -> DataFrame:
    """V12 from the active items of each location."""
    out = counts.join(bounded_broadcast(named_locations(t)), "location_code")
    pct = F.floor((F.col("count_checkout") * 20000 + F.col("count_total")) / (F.col("count_total") * 2))
    return (out.orderBy("location_id")
            .select("count_checkout", "count_total", "location_code", "location_name", "branch_name",
                    (pct.cast("long") / F.lit(100.0)).alias("percent_checkout")))


def book_connections_view(t, as_of=None) -> DataFrame:
    i = t["item"].filter(~F.col("item_status_code").isin(*codes.EXCLUDED_STATUS))
    b = t["bib"].select("bib_record_num", F.col("best_title").alias("title"),
                        F.col("best_author").alias("author"), _isbn0(F.col("isbn_values")).alias("isbn"))
    return (i.join(b, "bib_record_num")
            .groupBy("title", "author", "location_code", "item_format", "isbn")
            .agg(F.count(F.lit(1)).alias("count_location_items"),
                 F.sum(F.col("checkout_total") + F.col("renewal_total")).alias("total_item_circulation"))
            .select("title", "author", "isbn", "location_code", "item_format", "count_location_items",
                    "total_item_circulation"))


# ----------------------------------------------------------------- titles V15, V16, V26
def new_downloadable_book_view(t, as_of) -> DataFrame:
    since = F.date_sub(monday_before(F.lit(as_date(as_of))), 60)
    i = (t["item"].filter((F.col("creation_date") >= since) & (F.col("item_format") == "Downloadable Book"))
         .select("item_record_num", "bib_record_num", "creation_date", "item_callnumber", "volume_record_statement"))
    out = i.join(t["bib"].select("bib_record_num", "best_title", "best_author", "publish_year", "isbn_values"),
                 "bib_record_num")
    num = F.col("bib_record_num")
    return (out.select(
        F.col("creation_date").alias("date added"),
        jacket(num, F.col("isbn_values")).alias("jacket"),
        catalog_link(num, F.col("best_title"), F.col("best_author"), F.col("publish_year"),
                     F.col("item_callnumber"),
                     label=F.concat(F.col("best_title"), F.coalesce("volume_record_statement", F.lit(""))))
        .alias("catalog_link"),
        F.coalesce("best_author", F.lit("Zzzz")).alias("_a"), F.col("best_title").alias("_t"),
        F.col("item_record_num").alias("_i"))
        .orderBy(F.desc("date added"), "_a", "_t", "_i").drop("_a", "_t", "_i"))


def new_titles_view(t, as_of) -> DataFrame:
    since = F.date_sub(monday_before(F.lit(as_date(as_of))), 30)
    b = t["bib"].filter(F.col("cataloging_date") >= since)
    num = F.col("bib_record_num")
    out = b.join(modal_format(t["item"]), "bib_record_num", "left")
    return (out.select(
        "cataloging_date", "indexed_subjects", jacket(num, F.col("isbn_values")).alias("jacket"),
        catalog_link(num, F.col("best_title"), F.col("best_author"), F.col("publish_year"),
                     F.col("bib_level_callnumber")).alias("catalog_link"),
        F.col("modal_format").alias("item_format"), F.col("bib_record_num").alias("_b"))
        .orderBy(F.desc("cataloging_date"), "_b").drop("_b"))


def genre_view(t, as_of=None) -> DataFrame:
    g = t["bib"].select("bib_record_num", F.explode("genres").alias("genre"))
    return linked_genres(g.groupBy("genre").agg(F.count("bib_record_num").alias("count_bibs")))


def linked_genres(counts: DataFrame) -> DataFrame:
    """V26 from the bibs of each genre."""
    return counts.select("genre", "count_bibs",
                         json_object(("href", F.concat(F.lit(codes.GENRE_HREF_PREFIX), F.col("genre"))),
                                     ("label", F.lit("bibs with this genre"))).alias("link"))


# ----------------------------------------------------------------- copies V17, V18, V23, V24
def last_copy_view(t, as_of=None) -> DataFrame:
    """Bib+volume groups with exactly one active item, with that item's detail.

    One aggregate: a group's count and, as it has one member, that member.
    """
    active = t["item"].filter(F.col("item_status_code").isin(*codes.ACTIVE_STATUS))
    detail = ["location_code", "barcode", "item_format", "item_callnumber", "last_checkout_date", "due_date",
              "checkout_total", "renewal_total"]
    items = (active.groupBy("bib_record_num", "volume_record_statement")
             .agg(F.count(F.lit(1)).alias("n"), F.any_value(F.struct(*detail)).alias("only"))
             .filter(F.col("n") == 1).select("bib_record_num", "volume_record_statement", "only.*"))
    blv = branch_location_view(t).select(F.col("code").alias("location_code"), "branch_name")
    b = t["bib"]
    out = items.join(b.select("bib_record_num", "isbn_values", "best_title", "best_author", "publish_year",
                              "bib_level_callnumber"), "bib_record_num").join(bounded_broadcast(blv), "location_code")
    num = F.col("bib_record_num")
    return out.select(
        "bib_record_num", "branch_name", "location_code", "barcode", "item_format", "item_callnumber",
        F.col("volume_record_statement").alias("vol_statement"),
        jacket(num, F.col("isbn_values")).alias("jacket"),
        catalog_link(num, F.col("best_title"), F.col("best_author"), F.col("publish_year"),
                     F.col("bib_level_callnumber")).alias("catalog_link"),
        json_object(("last_checkout_date", F.col("last_checkout_date")), ("due_date", F.col("due_date")),
                    ("checkout_total", F.col("checkout_total")),
                    ("renewal_total", F.col("renewal_total"))).alias("circ_stats"))


def dup_at_location_view(t, as_of=None) -> DataFrame:
    item = t["item"]
    active = F.col("item_status_code").isin(*codes.ACTIVE_STATUS)
    # One pass over the items: copies and barcodes per volume, then all barcodes of the shelf.
    by_volume = (item.groupBy("bib_record_num", "location_code", "volume_record_statement")
                 .agg(F.count_if(active).alias("count_items"),
                      F.collect_list(F.struct("barcode")).alias("codes")))
    shelf = (by_volume.groupBy("bib_record_num", "location_code")
             .agg(F.filter(F.collect_list(F.struct("volume_record_statement", "count_items")),
                           lambda v: v["count_items"] > 1).alias("volumes"),
                  F.flatten(F.collect_list("codes")).alias("codes"))
             .filter(F.size("volumes") > 0))
    dil = (shelf.withColumn("barcodes", F.to_json(F.transform(F.array_sort("codes"), lambda c: c["barcode"])))
           .select("bib_record_num", "location_code", "barcodes", F.explode("volumes").alias("v"))
           .select("bib_record_num", "location_code", "barcodes", "v.*"))
    modal = modal_format(item)
    out = dil.join(t["bib"], "bib_record_num").join(modal, "bib_record_num", "left")
    num = F.col("bib_record_num")
    return (out.select(
        "bib_record_num", F.col("volume_record_statement").alias("vol"), "location_code", "count_items",
        "cataloging_date", "bib_level_callnumber", "indexed_subjects",
        jacket(num, F.col("isbn_values")).alias("jacket"),
        catalog_link(num, F.col("best_title"), F.col("best_author"), F.col("publish_year"),
                     F.col("bib_level_callnumber")).alias("catalog_link"),
        "barcodes", F.col("modal_format").alias("item_format"))
        .orderBy("bib_level_callnumber", "bib_record_num", "location_code", "vol"))


def duplicates_across(t, locations: list[str], as_of=None) -> DataFrame:
    """Active copies of a title spread over the given locations.

    The three lists stay aligned: one ordered list of (location, barcode, call
    number) structs is collected per group and then split with ``transform``.
    """
    item = t["item"].filter(F.col("item_status_code").isin(*codes.ACTIVE_STATUS)
                            & F.col("location_code").isin(*locations))
    b = t["bib"]
    grouped = (item.groupBy("bib_record_num", "volume_record_statement")
               .agg(F.array_sort(F.collect_list(F.struct("location_code", "barcode", "item_callnumber",
                                                         "item_record_num"))).alias("members"),
                    F.count(F.lit(1)).alias("count_items"))
               .filter(F.col("count_items") > 1))
    out = grouped.join(b, "bib_record_num")
    m = F.col("members")
    return out.select(
        "bib_record_num", "volume_record_statement", "best_author", "best_title", "publisher", "publish_year",
        F.to_json(F.transform(m, lambda s: s["location_code"])).alias("locations"),
        F.to_json(F.transform(m, lambda s: s["item_callnumber"])).alias("item_callnumbers"),
        F.to_json(F.transform(m, lambda s: s["barcode"])).alias("item_barcodes"),
        "count_items", jacket(F.col("bib_record_num"), F.col("isbn_values")).alias("jacket"))


# ----------------------------------------------------------------- V20, V21, V22, V25
def active_items_view(t, as_of) -> DataFrame:
    as_of = as_date(as_of)
    bibs = t["record_metadata"].filter(F.col("record_type_code") == "b").select(
        F.col("record_num").alias("bib_record_num"))
    v = t["volume_record_item_record_link"].select("item_record_num", "volume_record_num", "volume_statement",
                                                   "items_display_order")
    overdue = F.datediff(F.lit(as_of), F.col("due_date")) > 60
    i = (t["item"].filter(F.col("item_status_code").isin(*codes.ACTIVE_STATUS)
                          & ~F.coalesce(overdue, F.lit(False)))
         .select("bib_record_num", "item_record_num")
         .join(bibs, "bib_record_num"))
    return (i.join(v, "item_record_num", "left")
            .select("bib_record_num", "item_record_num", "volume_record_num", "volume_statement",
                    "items_display_order"))


def item_in_transit_view(t, as_of=None) -> DataFrame:
    i = t["item"].filter(F.col("item_status_code") == "t")
    h = t["hold"].select("item_record_num", "placed_julianday", "expires_julianday")
    m = t["item_message"].select("item_record_id", "in_transit_days", "transit_from", "transit_to",
                                 "has_in_transit_too_long", "in_transit_julianday")
    out = i.join(h, "item_record_num").join(m, "item_record_id")
    return out.select(
        "item_record_num", F.col("record_last_updated").alias("item_record_last_update"), "barcode",
        "in_transit_days", "transit_from", "transit_to", "agency_code_num", "location_code", "checkout_date",
        "due_date", "item_format", "item_status_code", "price_cents", "item_callnumber", "bib_record_num",
        "volume_record_num", "volume_record_statement", "has_in_transit_too_long",
        from_jd(F.col("in_transit_julianday")).alias("in_transit_date"),
        from_jd(F.col("placed_julianday")).alias("date_hold_placed"),
        from_jd(F.col("expires_julianday")).alias("date_hold_expires"))


def circ_agg_branch_view(t, as_of=None) -> DataFrame:
    it = t["itype_property"].select(F.col("itype_code").alias("itype_code_num"), "itype_name")
    month = (t["circ_agg"].filter(F.col("op_code").isin("f", "o"))
             .join(bounded_broadcast(it), "itype_code_num")
             .groupBy(F.substring("transaction_day", 1, 7).alias("transaction_month"), "branch_name", "itype_name")
             .agg(F.sum(F.when(F.col("op_code") == "o", F.col("count_op_code"))).alias("o_sum"),
                  F.sum(F.when(F.col("op_code") == "f", F.col("count_op_code"))).alias("f_sum")))
    return checkout_types(month)


def checkout_types(month: DataFrame) -> DataFrame:
    """V22 from the checkouts and filled holds of each month, branch and item type."""
    rows = F.filter(F.array(
        F.struct(F.lit("from_browse").alias("checkout_type"),
                 (F.col("o_sum") - F.coalesce("f_sum", F.lit(0))).alias("sum_transactions"),
                 F.col("o_sum").isNotNull().alias("present")),
        F.struct(F.lit("from_hold").alias("checkout_type"), F.col("f_sum").alias("sum_transactions"),
                 F.col("f_sum").isNotNull().alias("present"))), lambda s: s["present"])
    return (month.select("transaction_month", "branch_name", "itype_name", F.explode(rows).alias("r"))
            .select("transaction_month", "branch_name", "itype_name", "r.checkout_type", "r.sum_transactions"))


def collection_detail_view(t, as_of=None, items: Iterable[DataFrame] | None = None) -> DataFrame:
    """Bibs with their items, if any; ``items``: the item table in parts, worked through one after the other."""
    br = t["bib_record"].select("record_id", F.col("cataloging_date_gmt").alias("bib_cat_date"), "language_code",
                                "bcode1", "bcode2", "bcode3", F.col("is_suppressed").alias("is_bib_suppressed"))
    rm = t["record_metadata"].select("record_id", F.col("record_num").alias("bib_record_num"),
                                     "creation_julianday", "record_last_updated_julianday")

    def told(item: DataFrame) -> DataFrame:
        return item.select(
            "bib_record_num", F.col("volume_record_statement").alias("vol_stmnt"), "item_record_num",
            F.col("creation_date").alias("item_creation_date"), F.col("record_last_updated").alias("item_last_update"),
            F.col("agency_code_num").alias("item_agency_code_num"), F.col("location_code").alias("item_location_code"),
            "item_status_code", "item_format", F.col("price_cents").alias("item_price_cents"))

    loc, ln, brn, bn = _loc_names(t)
    names = written_broadcast(loc.join(ln, "location_id").groupBy(F.col("location_code").alias("item_location_code"))
                              .agg(F.min("location_name").alias("item_location_name")))
    branches = written_broadcast(loc.join(brn, F.col("branch_code_num") == F.col("b_code_num")).join(bn, "branch_id")
                                 .groupBy(F.col("location_code").alias("item_location_code"))
                                 .agg(F.min("branch_name").alias("item_branch_name")))

    def view(rows: DataFrame) -> DataFrame:
        out = rows.join(names, "item_location_code", "left").join(branches, "item_location_code", "left")
        return out.select(
            "bib_record_num", "bib_cat_date", from_jd(F.col("creation_julianday")).alias("creation_date"),
            from_jd(F.col("record_last_updated_julianday")).alias("record_last_update"), "language_code", "bcode1",
            "bcode2", "bcode3", "is_bib_suppressed", "vol_stmnt", "item_record_num", "item_creation_date",
            "item_last_update", "item_agency_code_num", "item_location_code", "item_location_name",
            "item_branch_name", "item_status_code", "item_format", "item_price_cents")

    bibs = br.join(rm, "record_id")
    if items is None:
        return view(skew_safe_left_join(bibs, told(t["item"]), ["bib_record_num"]))
    bibs = written(bibs)
    matched = written_in_turn(view(bibs.join(told(i), "bib_record_num")) for i in items)
    rest = bibs.join(matched.select("bib_record_num").distinct(), "bib_record_num", "left_anti")
    lacking = [F.lit(None).cast(f.dataType).alias(f.name) for f in told(t["item"]).schema if f.name != "bib_record_num"]
    return matched.union(view(rest.select("*", *lacking)))


MARTS = {
    "V01": ("isbn_view", isbn_view), "V02": ("duplicate_items_in_location_view", duplicate_items_in_location_view),
    "V03": ("location_view", location_view), "V04": ("item_view", item_view),
    "V05": ("branch_30_day_circ_view", branch_30_day_circ_view),
    "V06": ("branch_location_view", branch_location_view),
    "V07": ("collection_value_branch_view", collection_value_branch_view), "V08": ("hold_view", hold_view),
    "V09": ("hold_title_view", hold_title_view), "V10": ("leased_item_view", leased_item_view),
    "V11": ("ld_compare_view", ld_compare_view),
    "V12": ("location_percent_checkout_view", location_percent_checkout_view),
    "V13": ("book_connections_view", book_connections_view),
    "V14": ("two_months_leased_item_view", two_months_leased_item_view),
    "V15": ("new_downloadable_book_view", new_downloadable_book_view),
    "V16": ("new_titles_view", new_titles_view), "V17": ("last_copy_view", last_copy_view),
    "V18": ("dup_at_location_view", dup_at_location_view), "V19": ("active_holds_view", active_holds_view),
    "V20": ("active_items_view", active_items_view), "V21": ("item_in_transit_view", item_in_transit_view),
    "V22": ("circ_agg_branch_view", circ_agg_branch_view),
    "V25": ("collection_detail_view", collection_detail_view), "V26": ("genre_view", genre_view),
}
