"""Canned queries (Q01-Q05) and ad-hoc reports.

Top-k reports keep their LIMIT (it is the feature); each sort carries a
unique tie-breaker so the k rows are deterministic, and Spark plans
``orderBy().limit()`` as TakeOrderedAndProject (per-partition top-k, then a
k-row merge), never a global sort of the input.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.functions import codes
from shelfwise.functions.dates import as_date, jd_of
from shelfwise.functions.plan import bounded_broadcast
from shelfwise.functions.text import ordered_values
from shelfwise.operators.marts import _loc_names, _per_item_2dp, location_view


# ----------------------------------------------------------------- Q01-Q05
def items_by_branch(t, as_of=None) -> DataFrame:
    return (t["item"].groupBy("location_code").agg(F.count(F.lit(1)).alias("item_count"))
            .orderBy(F.desc("item_count"), "location_code"))


def most_checked_out(t, as_of=None, k: int = 100) -> DataFrame:
    i = t["item"].select("bib_record_num", "location_code", "item_format", "checkout_total", "item_record_num")
    b = t["bib"].select("bib_record_num", "best_title", "best_author")
    return (i.join(b, "bib_record_num")
            .orderBy(F.desc_nulls_last("checkout_total"), "item_record_num", "bib_record_num").limit(k)
            .select("best_title", "best_author", "location_code", "item_format", "checkout_total"))


def available_items_by_format(t, as_of=None) -> DataFrame:
    return (t["item"].filter(F.col("item_status_code") == "-").groupBy("item_format")
            .agg(F.count(F.lit(1)).alias("available_count")).orderBy(F.desc("available_count"), "item_format"))


def recently_added(t, as_of, k: int = 200) -> DataFrame:
    since = as_date(as_of) - _dt.timedelta(days=30)
    i = (t["item"].filter(F.col("creation_date") >= F.lit(since))
         .select("bib_record_num", "item_format", "location_code", "creation_date", "item_record_num"))
    b = t["bib"].select("bib_record_num", "best_title", "best_author")
    return (i.join(b, "bib_record_num")
            .orderBy(F.desc("creation_date"), "item_record_num", "bib_record_num").limit(k)
            .select("best_title", "best_author", "item_format", "location_code", "creation_date"))


# ----------------------------------------------------------------- R03, R04 (legacy hold strings)
def bib_hold_strings(s) -> DataFrame:
    """One formatted text per bib-level hold (NULL parts read as empty)."""
    rm = s["record_metadata"]
    h = s["hold"]
    r = rm.filter(F.col("record_type_code") == "b").select(
        F.col("id").alias("record_id"), "record_type_code", "record_num")
    pr = rm.filter(F.col("record_type_code") == "p").select(F.col("id").alias("patron_record_id"),
                                                            F.col("record_num").alias("patron_record_num"))
    placed = F.to_date("placed_gmt")
    nnb = F.date_add(placed, F.col("delay_days"))
    nna = F.coalesce(F.to_date("expires_gmt"), F.date_add(placed, 255))

    def part(c):
        return F.coalesce(c.cast("string"), F.lit(""))

    text = F.concat(F.lit('"'), F.lit("P#="), part(F.col("patron_record_num")),
                    F.lit(", I#="), part(F.col("record_num")), F.lit(", P="), part(placed),
                    F.lit(", NNB="), part(nnb), F.lit("("), part(F.col("delay_days")), F.lit(" days)"),
                    F.lit(", RLA=0"), F.lit(", NNA="), part(nna), F.lit(", ST=0"),
                    F.lit(", TP="), part(F.col("record_type_code")),
                    F.lit(", PU="), part(F.col("pickup_location_code")), F.lit('"'))
    out = h.join(r, "record_id").join(pr, "patron_record_id")
    return out.select(
        "patron_record_id", "patron_record_num", "record_type_code", "record_num",
        F.col("record_id").alias("bib_record_id"), F.col("id").alias("hold_id"), "placed_gmt",
        nnb.alias("not_needed_before"), "is_frozen", "delay_days", F.to_date("expires_gmt").alias("expires"),
        "status", "is_ir", "pickup_location_code", text.alias("hold_string"))


def bib_holds(s) -> DataFrame:
    """The hold texts of a bib joined with ';' in placement order."""
    return (bib_hold_strings(s).groupBy("bib_record_id", F.col("record_num").alias("bib_record_num"))
            .agg(F.array_join(ordered_values(F.col("hold_string"), F.col("placed_gmt"), F.col("hold_id")), ";")
                 .alias("holds")))


def top_holds(s, t, as_of=None, k: int = 50) -> DataFrame:
    """Q02: titles with the most holds: entries of their ';'-joined hold texts, counted without joining them."""
    entries = F.coalesce(F.sum(F.size(F.split("hold_string", ";"))), F.lit(1))
    hs = (bib_hold_strings(s).filter(F.col("hold_string").isNotNull())
          .groupBy("bib_record_id", F.col("record_num").alias("bib_record_num")).agg(entries.alias("hold_count")))
    b = t["bib"].select("bib_record_num", "best_title", "best_author", "publish_year")
    return (hs.join(b, "bib_record_num")
            .orderBy(F.desc("hold_count"), "bib_record_num").limit(k)
            .select("best_title", "best_author", "publish_year", "hold_count"))


# ----------------------------------------------------------------- R05-R07 (hold reports)
def _usable_holds(t) -> DataFrame:
    h = t["hold"]
    return h.filter(F.col("is_frozen").eqNullSafe(False) & F.col("is_ir").eqNullSafe(False)
                    & F.col("is_ill").eqNullSafe(False))


def holds_by_patron_activity(t, as_of=None) -> DataFrame:
    """Holds of inactive vs active patrons, one pass."""
    h = _usable_holds(t)
    return h.agg(F.count(F.when(F.col("patron_is_active").eqNullSafe(False), F.col("hold_id")))
                 .alias("count_holds_for_inactive_patrons"),
                 F.count(F.when(F.col("patron_is_active").eqNullSafe(True), F.col("hold_id")))
                 .alias("count_holds_for_active_patrons"))


MAIN_BRANCH = "Main Library"


def holds_by_pickup_branch(t, as_of=None) -> DataFrame:
    """Per pickup branch and patron type, distinct titles, holds and holds per title."""
    h = _usable_holds(t).filter(F.col("patron_ptype_code").isin(*codes.ACTIVE_PTYPES_LEGACY))
    loc, ln, br, bn = _loc_names(t)
    pickup = (loc.join(ln, "location_id").join(br, F.col("branch_code_num") == F.col("b_code_num"))
              .join(bn, "branch_id")
              .groupBy(F.col("location_code").alias("pickup_location_code"))
              .agg(F.min(F.when(F.col("branch_name") == MAIN_BRANCH, F.lit(" " + MAIN_BRANCH))
                         .otherwise(F.col("branch_name"))).alias("pickup_location")))
    g = (h.join(bounded_broadcast(pickup), "pickup_location_code", "left")
         .groupBy("pickup_location", "patron_ptype_code")
         .agg(F.countDistinct("bib_record_num").alias("count_distinct_titles"), F.count(F.lit(1)).alias("count")))
    return (g.withColumn("avg_hold_per_title", _per_item_2dp(F.col("count"), F.col("count_distinct_titles")))
            .orderBy("pickup_location", "patron_ptype_code", F.desc("count_distinct_titles")))


def active_holds_by_title(t, as_of) -> DataFrame:
    """Active holds per title with the average age (days past placement + delay)."""
    now_jd = jd_of(as_date(as_of))
    bibs = (t["record_metadata"].filter(F.col("record_type_code") == "b")
            .select(F.col("record_num").alias("bib_record_num"), F.col("creation_julianday")))
    h = (t["hold"].join(bibs.select("bib_record_num"), "bib_record_num", "left_semi")
         .filter((F.col("is_frozen").eqNullSafe(False) | (F.col("patron_ptype_code") == codes.FROZEN_EXEMPT_PTYPE))
                 & (F.col("placed_julianday") + F.col("delay_days") <= now_jd)
                 & F.col("patron_ptype_code").isin(*codes.ACTIVE_PTYPES) & (F.col("hold_status") == "on hold")))
    g = (h.groupBy("bib_record_num")
         .agg(F.count("bib_record_num").alias("count_active_holds"),
              F.sum(F.lit(now_jd) - F.col("placed_julianday") - F.col("delay_days")).alias("_age")))
    b = t["bib"].select("bib_record_num", "best_author", "best_title", "publish_year", "bib_level_callnumber")
    created = bibs.select("bib_record_num", F.date_add(F.lit("1970-01-01").cast("date"),
                                                       (F.col("creation_julianday") - 2440588).cast("int"))
                          .alias("bib_creation_date"))
    return (g.join(b, "bib_record_num").join(created, "bib_record_num", "left")
            .select("bib_record_num", "count_active_holds",
                    _per_item_2dp(F.col("_age"), F.col("count_active_holds")).alias("average_age_days_of_hold"),
                    "best_author", "best_title", "publish_year", "bib_creation_date", "bib_level_callnumber")
            .orderBy(F.desc("count_active_holds"), "bib_record_num"))


# ----------------------------------------------------------------- R09-R13
def shelf_list(t, location_code: str, with_bib: bool = True, k: int = 10) -> DataFrame:
    """Shelf list of one location (top-k by shelf order)."""
    i = t["item"].filter(F.col("location_code") == location_code)
    if with_bib:
        b = t["bib"].select("bib_record_num", "best_author", "best_title")
        return (i.join(b, "bib_record_num")
                .orderBy("location_code", "item_format", "best_author", "best_title", "item_callnumber",
                         "item_record_num").limit(k)
                .select("item_record_num", "bib_record_num", "location_code", "item_format", "item_callnumber",
                        "best_author", "best_title", "barcode", "item_status_code", "checkout_total"))
    return (i.orderBy("location_code", "item_format", "item_callnumber", "item_record_num").limit(k)
            .select("item_record_num", "bib_record_num", "location_code", "item_format", "item_callnumber",
                    "barcode", "item_status_code", "checkout_total"))


def random_active_items(t, n: int = 10, seed: int = 42) -> DataFrame:
    """A random sample of active items (sampling is the feature), the same however rows are dealt."""
    return (t["item"].filter(F.col("item_status_code").isin(*codes.ACTIVE_STATUS))
            .select("item_record_num", "bib_record_num", "barcode", "location_code", "item_status_code")
            .orderBy(F.md5(F.concat(F.col("item_record_num").cast("string"), F.lit(f":{seed}")).cast("binary")),
                     "item_record_num", "bib_record_num").limit(n))


def titles_with_items(t, as_of=None) -> DataFrame:
    """Number of distinct titles that have at least one item."""
    return (t["bib"].select("bib_record_num").join(t["item"].select("bib_record_num"), "bib_record_num", "left_semi")
            .agg(F.countDistinct("bib_record_num").alias("count_distinct_titles")))


def items_per_bib(t, as_of=None) -> DataFrame:
    """Attached item count of every bib (zero kept)."""
    counts = t["item"].groupBy("bib_record_num").agg(F.count("item_record_num").alias("count_attached_items"))
    return (t["bib"].select("bib_record_num").join(counts, "bib_record_num", "left")
            .select("bib_record_num", F.coalesce("count_attached_items", F.lit(0)).alias("count_attached_items")))


def location_branch_listing(t, as_of=None) -> DataFrame:
    """Every location with its name, branch and branch name."""
    loc = t["location"]
    ln = t["location_name"].select("location_id", F.col("name").alias("location_name"))
    br = t["branch"].select(F.col("id").alias("branch_id"), F.col("code_num").alias("branch_code"), "address",
                            "email_source", "email_reply_to", "address_latitude", "address_longitude")
    bn = t["branch_name"].select(F.col("branch_id").alias("bn_branch_id"), F.col("name").alias("branch_name"))
    return (loc.join(ln, loc["id"] == ln["location_id"])
            .join(br, loc["branch_code_num"] == br["branch_code"])
            .join(bn, br["branch_id"] == bn["bn_branch_id"])
            .orderBy(loc["id"]))


# ----------------------------------------------------------------- R15-R19
def items_by_location_in_branch(t, branch_name: str) -> DataFrame:
    """Item counts per location of one branch, with the items link."""
    lv = location_view(t).filter(F.col("branch_name") == branch_name)
    counts = t["item"].groupBy("location_code").agg(F.count(F.lit(1)).alias("count_items"))
    return (lv.join(counts, "location_code", "left")
            .select("location_code", "location_name", "branch_name",
                    F.coalesce("count_items", F.lit(0)).alias("count_items"), "items")
            .orderBy(F.desc("count_items"), "location_code"))


def titles_by_decade(t, as_of=None) -> DataFrame:
    """Titles per decade of publication, 1800-2021."""
    b = t["bib"].filter((F.col("publish_year") >= 1800) & (F.col("publish_year") <= 2021))
    return (b.groupBy((F.floor(F.col("publish_year") / 10) * 10).cast("int").alias("decade"))
            .agg(F.count(F.lit(1)).alias("count_titles")).orderBy("decade"))


def branches_with_format(t, item_format: str) -> DataFrame:
    """Locations holding a given format, with branch coordinates."""
    lv = location_view(t)
    having = t["item"].filter(F.col("item_format") == item_format).select("location_code")
    bl = t["branch_locations"].select(F.col("code_num").alias("branch_code_num"), "address", "latitude",
                                      "longitude")
    return (lv.join(having, "location_code", "left_semi").join(bounded_broadcast(bl), "branch_code_num")
            .select("location_code", "is_public", "is_requestable", "location_name", "branch_name", "address",
                    "latitude", "longitude"))


def top_circulating_by_subject(t, subject_like: str, any_element: bool = False) -> DataFrame:
    """Titles whose (first) indexed subject contains the text, by total checkouts.

    The source query tests only the first subject; ``any_element=True`` tests all.
    """
    b = t["bib"]
    pattern = f"%{subject_like}%"
    cond = (F.exists("indexed_subjects", lambda x: x.ilike(pattern)) if any_element
            else F.get("indexed_subjects", 0).ilike(pattern))
    totals = t["item"].groupBy("bib_record_num").agg(F.sum("checkout_total").alias("total_checkouts"))
    return (b.filter(cond).join(totals, "bib_record_num", "left")
            .select("total_checkouts",
                    F.concat(F.lit(codes.CATALOG_URL_PREFIX), F.col("bib_record_num").cast("string"))
                    .alias("catalog_link"),
                    "best_author", "best_title", "publisher", "publish_year", "bib_level_callnumber",
                    "indexed_subjects", "bib_record_num")
            .orderBy(F.desc_nulls_last("total_checkouts"), "bib_record_num").drop("bib_record_num"))


def distinct_locations(t, as_of=None) -> DataFrame:
    """Distinct item location codes."""
    return t["item"].select("location_code").distinct()


# ----------------------------------------------------------------- R20, R22 (in-transit reports)
def in_transit_status(t, as_of=None) -> DataFrame:
    """In-transit messages with circulation, transit and record detail as JSON objects."""
    m = t["item_message"].filter(F.col("has_in_transit"))
    to_date = lambda c: F.date_add(F.lit("1970-01-01").cast("date"), (F.col(c) - 2440588).cast("int"))
    return (m.select(
        "item_record_id", "item_barcode", "location_code", "item_format", "best_title",
        F.to_json(F.struct(to_date("checkout_julianday").alias("checkout_date"),
                           to_date("due_julianday").alias("due_date"), "renewal_count", "overdue_count"),
                  {"ignoreNullFields": "false"}).alias("circ"),
        F.to_json(F.struct("transit_from", "transit_to", "in_transit_days",
                           to_date("in_transit_julianday").alias("in_transit_date"), "has_in_transit_too_long"),
                  {"ignoreNullFields": "false"}).alias("transit"),
        F.to_json(F.struct("item_status_code", "item_status_name", "call_number", "occ_num"),
                  {"ignoreNullFields": "false"}).alias("record"),
        "in_transit_days")
        .orderBy(F.desc_nulls_last("in_transit_days"), "item_record_id"))


def in_transit_too_long_by_branch(t, as_of=None) -> DataFrame:
    """Items in transit too long, per destination branch and origin, with days in transit."""
    from shelfwise.operators.marts import item_in_transit_view
    v = item_in_transit_view(t).filter(F.col("has_in_transit_too_long"))
    loc, ln, br, bn = _loc_names(t)
    dest = (loc.join(br, F.col("branch_code_num") == F.col("b_code_num")).join(bn, "branch_id")
            .select(F.col("location_code").alias("transit_to"), F.col("branch_name").alias("destination_branch")))
    return (v.join(bounded_broadcast(dest), "transit_to", "left")
            .select("destination_branch", "transit_from", "transit_to", "item_record_num", "barcode",
                    "in_transit_days", "in_transit_date", "item_format", "item_callnumber")
            .orderBy("destination_branch", "transit_from", F.desc("in_transit_days"), "transit_to", "item_record_num"))


# ----------------------------------------------------------------- R01 (legacy bib export)
def legacy_bib_export(s) -> DataFrame:
    """Flat bib export: ','-joined control numbers and subjects, first ISBN only."""
    from shelfwise.operators.extract import _records, bib_children

    kids = bib_children(s)
    r = _records(s, "b").select(F.col("id").alias("bib_record_id"), F.col("record_num").alias("bib_record_num"),
                                F.to_date("creation_date_gmt").alias("creation_date"),
                                F.to_date("record_last_updated_gmt").alias("record_last_updated"))
    p = s["bib_record_property"].select("bib_record_id", "best_author", "best_author_norm", "best_title",
                                        "best_title_norm", "publish_year")
    out = r.join(p, "bib_record_id")
    for k in ("control", "isbn", "publisher", "callnum", "subjects"):
        out = out.join(kids[k], "bib_record_id", "left")
    return out.select(
        "bib_record_num", "bib_record_id", F.array_join("control_numbers", ",").alias("control_numbers"),
        "creation_date", "record_last_updated", F.substring(F.get("isbn_values", 0), 1, 30).alias("isbn"),
        "best_author", "best_author_norm", "best_title", "best_title_norm", "publisher", "publish_year",
        "bib_level_callnumber", F.array_join("indexed_subjects", ",").alias("indexed_subjects"))


# ----------------------------------------------------------------- R02, R21 (legacy exports)
def legacy_item_export(s) -> DataFrame:
    """Flat item export with the bib's first ISBN and a 2-decimal money price."""
    from shelfwise.operators.extract import _itype_names, _record_nums, _records, bib_children

    r = _records(s, "i").select(F.col("id").alias("item_record_id"), F.col("record_num").alias("item_record_num"),
                                F.to_date("creation_date_gmt").alias("creation_date"),
                                F.to_date("record_last_updated_gmt").alias("record_last_updated"))
    irp = s["item_record_property"].select("item_record_id", "barcode",
                                           F.col("call_number_norm").alias("item_callnumber"))
    ir = s["item_record"].select(
        F.col("record_id").alias("item_record_id"), "agency_code_num", "location_code",
        "checkout_statistic_group_code_num", "checkin_statistics_group_code_num",
        F.to_date("last_checkout_gmt").alias("last_checkout_date"),
        F.to_date("last_checkin_gmt").alias("last_checkin_date"), "checkout_total", "renewal_total",
        "itype_code_num", "item_status_code", F.col("price").cast("decimal(30,2)").alias("price"))
    co = s["checkout"].select("item_record_id", "patron_record_id", F.to_date("checkout_gmt").alias("checkout_date"),
                              F.to_date("due_gmt").alias("due_date"))
    patron = s["patron_record"].groupBy(F.col("record_id").alias("patron_record_id")).agg(
        F.min("home_library_code").alias("patron_branch_code"))
    co = co.join(patron, "patron_record_id", "left").drop("patron_record_id")
    link = (s["bib_record_item_record_link"].select("item_record_id", "bib_record_id")
            .join(_record_nums(s, "b", "bib_record_id", "bib_record_num"), "bib_record_id"))
    isbn = bib_children(s)["isbn"].select("bib_record_id", F.substring(F.get("isbn_values", 0), 1, 30).alias("isbn"))
    itype = _itype_names(s).groupBy("itype_code_num").agg(F.min("name").alias("item_format"))
    out = (r.join(irp, "item_record_id").join(ir, "item_record_id").join(co, "item_record_id", "left")
           .join(link, "item_record_id")
           .join(isbn, "bib_record_id", "left").join(bounded_broadcast(itype), "itype_code_num", "left"))
    return out.select(
        "item_record_id", "item_record_num", "bib_record_id", "bib_record_num", "creation_date", "record_last_updated",
        "barcode", "agency_code_num", "location_code", "checkout_statistic_group_code_num",
        "checkin_statistics_group_code_num", "checkout_date", "due_date", "patron_branch_code", "last_checkout_date",
        "last_checkin_date", "checkout_total", "renewal_total", "isbn", "item_format", "item_status_code", "price",
        "item_callnumber")


def bib_varfields(s) -> DataFrame:
    """Every varfield of the library's bibs, one row per field (long table)."""
    rm = s["record_metadata"].filter((F.col("record_type_code") == "b") & (F.col("campus_code") == ""))
    return (rm.select(F.col("id").alias("bib_record_id"), F.col("record_num").alias("bib_record_num"))
            .join(s["varfield"].withColumnRenamed("record_id", "bib_record_id"), "bib_record_id")
            .select("bib_record_id", "bib_record_num", F.col("id").alias("varfield_id"), "varfield_type_code",
                    "marc_tag", "marc_ind1", "marc_ind2", "occ_num", "field_content"))
