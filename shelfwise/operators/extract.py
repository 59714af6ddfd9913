"""Extraction operators: source schema -> conformed base tables.

Every function takes the source relations ``s`` (name -> DataFrame) and returns
one typed DataFrame.  Correlated per-row lookups of the source queries are
rewritten as one pre-aggregation per child relation followed by an equi-join,
so each child table is scanned once and shuffled once on its key, instead of
being probed once per parent row.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.functions import codes
from shelfwise.functions.plan import bounded_broadcast, sparse_left_join
from shelfwise.functions.dates import as_date, to_jd
from shelfwise.functions.text import (IN_TRANSIT, IN_TRANSIT_TOO_LONG, ISBN_PATTERN, LAST_TRANSIT_ROUTE,
                                      TRANSIT_TIME, empty_to_null, nullif_empty, ordered_values,
                                      ordered_values_where)

FULL_REBUILD = _dt.datetime(1969, 1, 1)


def _since(since) -> F.Column:
    return F.lit(since or FULL_REBUILD).cast("timestamp")


def _records(s, rtype: str, since=None, live_only=True) -> DataFrame:
    rm = s["record_metadata"]
    cond = (F.col("record_type_code") == rtype) & (F.col("campus_code") == "")
    if live_only:
        cond &= F.col("deletion_date_gmt").isNull()
    cond &= F.col("record_last_updated_gmt") >= _since(since)
    return rm.filter(cond)


def _named(prop: DataFrame, names: DataFrame, fk: str, how: str = "inner") -> DataFrame:
    """A property table joined to its name table (``names.fk = prop.id``).

    Both sides are re-projected first so that relations derived from one
    another never share an ambiguous ``id`` attribute.
    """
    left = prop.select(*[F.col(c).alias("__pid" if c == "id" else c) for c in prop.columns])
    right = names.select(F.col(fk).alias("__pid"), "name")
    return left.join(right, "__pid", how).drop("__pid")


def _itype_names(s, how: str = "inner") -> DataFrame:
    return _named(s["itype_property"], s["itype_property_name"], "itype_property_id", how).select(
        F.col("code_num").alias("itype_code_num"), "name")


def _record_nums(s, rtype: str, id_name: str, num_name: str) -> DataFrame:
    """id -> record number lookup for one record type.

    Links always point at records of a known type, so restricting the (largest)
    record table to that type first shrinks every lookup join's shuffle.
    """
    return (s["record_metadata"].filter(F.col("record_type_code") == rtype)
            .select(F.col("id").alias(id_name), F.col("record_num").alias(num_name)))


# --------------------------------------------------------------------------- X01
def record_metadata(s, since=None) -> DataFrame:
    rm = s["record_metadata"]
    t = _since(since)
    return (rm.filter(F.col("record_type_code").isin("b", "i", "j") & (F.col("campus_code") == "")
                      & ((F.col("deletion_date_gmt") >= t) | (F.col("record_last_updated_gmt") >= t)))
            .select(F.col("id").alias("record_id"), "record_num", "record_type_code",
                    to_jd("creation_date_gmt").alias("creation_julianday"),
                    to_jd("record_last_updated_gmt").alias("record_last_updated_julianday"),
                    to_jd("deletion_date_gmt").alias("deletion_julianday")))


# --------------------------------------------------------------------------- X02
def bib_children(s) -> dict[str, DataFrame]:
    """Per-bib pre-aggregates (one groupBy each) for X02a-g."""
    pe = s["phrase_entry"]
    vf = s["varfield"]
    sf = s["subfield"]
    # Control numbers, call number and subjects all come from the phrase index:
    # one scan and one shuffle of it, one conditional aggregate per output.
    is_control = (F.col("index_tag") == "o") & (F.col("varfield_type_code") == "o")
    is_callnum = (F.col("index_tag") == "c") & (F.col("varfield_type_code") == "c")
    is_subject = F.col("index_tag") == "d"
    phrases = (pe.filter(is_control | is_callnum | is_subject)
               .groupBy(F.col("record_id").alias("bib_record_id"))
               .agg(empty_to_null(ordered_values_where(is_control, F.col("index_entry"), F.col("occurrence"),
                                                       F.col("id"))).alias("control_numbers"),
                    F.min_by(F.when(is_callnum, F.col("index_entry")), F.when(is_callnum, F.col("id")))
                    .alias("bib_level_callnumber"),
                    F.count(F.when(is_callnum, F.lit(1))).alias("_n_callnum"),
                    empty_to_null(ordered_values_where(is_subject, F.col("index_entry"), F.col("occurrence"),
                                                       F.col("id"))).alias("indexed_subjects")))
    control = phrases.filter(F.col("control_numbers").isNotNull()).select("bib_record_id", "control_numbers")
    callnum = phrases.filter(F.col("_n_callnum") > 0).select("bib_record_id", "bib_level_callnumber")
    subjects = phrases.filter(F.col("indexed_subjects").isNotNull()).select("bib_record_id", "indexed_subjects")
    phrases = phrases.drop("_n_callnum")
    isbn = (vf.filter(F.concat(F.col("marc_tag"), F.col("varfield_type_code")) == "020i")
            .withColumn("isbn", F.regexp_extract("field_content", ISBN_PATTERN, 1))
            .filter(F.col("isbn") != "")
            .groupBy(F.col("record_id").alias("bib_record_id"))
            .agg(ordered_values(F.col("isbn"), F.col("occ_num"), F.col("id")).alias("isbn_values")))
    publisher = (sf.filter((F.col("field_type_code") == "p") & (F.col("tag") == "b"))
                 .groupBy(F.col("record_id").alias("bib_record_id"))
                 .agg(F.min_by("content", F.struct("display_order", "id")).alias("publisher")))
    genres = (vf.filter(F.col("varfield_type_code") == "j").select(F.col("id").alias("vid"), "record_id")
              .join(sf.filter(F.col("tag") == "a").select("varfield_id", "occ_num", "id", "content"),
                    F.col("vid") == F.col("varfield_id"))
              .groupBy(F.col("record_id").alias("bib_record_id"))
              .agg(ordered_values(F.col("content"), F.col("occ_num"), F.col("id")).alias("genres")))
    itypes = _itype_names(s)
    per_type = (s["bib_record_item_record_link"].select("bib_record_id", "item_record_id")
                .join(s["item_record"].select(F.col("record_id").alias("item_record_id"), "itype_code_num"),
                      "item_record_id")
                .groupBy("bib_record_id", "itype_code_num").agg(F.count(F.lit(1)).alias("n")))
    item_types = (per_type.join(bounded_broadcast(itypes), "itype_code_num")
                  .groupBy("bib_record_id")
                  .agg(ordered_values(F.col("name"), -F.col("n"), F.col("name")).alias("item_types")))
    return dict(control=control, isbn=isbn, publisher=publisher, callnum=callnum,
                subjects=subjects, genres=genres, item_types=item_types, phrases=phrases)


def _only(s, ids: DataFrame, **columns: str) -> dict[str, DataFrame]:
    """``s`` with the relations of ``columns`` (relation -> id column) reduced to the given ids."""
    name = ids.columns[0]
    return {**s, **{rel: s[rel].join(ids.select(F.col(name).alias(c)), c, "left_semi") for rel, c in columns.items()}}


def bib(s, since=None) -> DataFrame:
    r = _records(s, "b", since).select(F.col("id").alias("bib_record_id"),
                                       F.col("record_num").alias("bib_record_num"))
    br = s["bib_record"].select(F.col("record_id").alias("bib_record_id"),
                                F.to_date("cataloging_date_gmt").alias("cataloging_date"))
    prop = s["bib_record_property"].select(F.col("bib_record_id"), "best_author", "best_title",
                                           "publish_year")
    if since is not None:  # a daily run aggregates only what belongs to changed bibs
        s = _only(s, r.select("bib_record_id"), phrase_entry="record_id", varfield="record_id",
                  subfield="record_id", bib_record_item_record_link="bib_record_id")
    kids = bib_children(s)
    out = r.join(br, "bib_record_id").join(prop, "bib_record_id", "left")
    for k in ("phrases", "isbn", "publisher", "genres", "item_types"):
        out = out.join(kids[k], "bib_record_id", "left")
    return out.select("bib_record_num", "bib_record_id", "control_numbers", "isbn_values",
                      "best_author", "best_title", "publisher", "publish_year",
                      "bib_level_callnumber", "indexed_subjects", "genres", "item_types",
                      "cataloging_date")


# --------------------------------------------------------------------------- X03
def _statements(s, record_ids_col: str, types: list[str] | None) -> DataFrame:
    vf = s["varfield"]
    if types is not None:
        vf = vf.filter(F.col("varfield_type_code").isin(*types))
    return (vf.groupBy(F.col("record_id").alias(record_ids_col))
            .agg(F.array_join(ordered_values(F.col("field_content"), F.col("occ_num"), F.col("id")),
                              ", ").alias("statement")))


def item(s, since=None, part: tuple[int, int] | None = None) -> DataFrame:
    """Items; with ``part`` (k, n) those of the k-th of n parts, dealt by a hash of their id."""

    def here(df: DataFrame) -> DataFrame:
        return df if part is None else df.filter(F.pmod(F.xxhash64("item_record_id"), F.lit(part[1])) == part[0])

    r = here(_records(s, "i", since).select(
        F.col("id").alias("item_record_id"), F.col("record_num").alias("item_record_num"),
        F.to_date("creation_date_gmt").alias("creation_date"),
        F.to_date("record_last_updated_gmt").alias("record_last_updated")))
    irp = here(s["item_record_property"].select("item_record_id", "barcode",
                                                F.col("call_number_norm").alias("item_callnumber")))
    ir = here(s["item_record"].select(
        F.col("record_id").alias("item_record_id"), "agency_code_num", "location_code",
        "checkout_statistic_group_code_num", "checkin_statistics_group_code_num",
        F.to_date("last_checkout_gmt").alias("last_checkout_date"),
        F.to_date("last_checkin_gmt").alias("last_checkin_date"),
        "checkout_total", "renewal_total", "itype_code_num", "item_status_code",
        F.round(F.col("price") * 100, 0).cast("int").alias("price_cents")))
    co = here(s["checkout"].select("item_record_id", "patron_record_id",
                                   F.to_date("checkout_gmt").alias("checkout_date"),
                                   F.to_date("due_gmt").alias("due_date")))
    patron = s["patron_record"].groupBy(F.col("record_id").alias("patron_record_id")).agg(
        F.min("home_library_code").alias("patron_branch_code"))
    # What hangs on a patron or a volume is joined to the loans and the volume
    # links first, so that the wide item relation is only ever joined on its own id.
    co = co.join(patron, "patron_record_id", "left").drop("patron_record_id")
    itype = (_itype_names(s).groupBy("itype_code_num").agg(F.min("name").alias("item_format")))
    link = (here(s["bib_record_item_record_link"].select("item_record_id", "bib_record_id"))
            .join(_record_nums(s, "b", "bib_record_id", "bib_record_num"), "bib_record_id"))
    vlink = (here(s["volume_record_item_record_link"].select("item_record_id", "volume_record_id"))
             .join(_record_nums(s, "j", "volume_record_id", "volume_record_num"), "volume_record_id", "left"))
    vstat = _statements(s, "volume_record_id", ["v"]).withColumnRenamed("statement", "volume_record_statement")
    vlink = vlink.join(vstat, "volume_record_id", "left").drop("volume_record_id")
    out = (r.join(irp, "item_record_id").join(ir, "item_record_id")
           .join(co, "item_record_id", "left")
           .join(link, "item_record_id")
           .join(vlink, "item_record_id", "left")
           .join(bounded_broadcast(itype), "itype_code_num", "left"))
    return out.select(
        "item_record_num", "item_record_id", "bib_record_num", "creation_date", "record_last_updated",
        "barcode", "agency_code_num", "location_code", "checkout_statistic_group_code_num",
        "checkin_statistics_group_code_num", "checkout_date", "due_date", "patron_branch_code",
        "last_checkout_date", "last_checkin_date", "checkout_total", "renewal_total", "item_format",
        "item_status_code", "price_cents", "item_callnumber", "volume_record_num",
        "volume_record_statement")


# --------------------------------------------------------------------------- X04
def bib_record(s, since=None) -> DataFrame:
    rm = s["record_metadata"].filter((F.col("campus_code") == "")
                                     & (F.col("record_last_updated_gmt") >= _since(since)))
    b = s["bib_record"]
    return (b.join(rm.select(F.col("id").alias("record_id")), "record_id")
            .select("id", "record_id", "language_code", "bcode1", "bcode2", "bcode3", "country_code",
                    "index_change_count", "is_on_course_reserve", "is_right_result_exact",
                    "allocation_rule_code", "skip_num",
                    F.to_date("cataloging_date_gmt").alias("cataloging_date_gmt"),
                    "marc_type_code", "is_suppressed"))


# --------------------------------------------------------------------------- X05
def volume_record(s, since=None) -> DataFrame:
    rm = s["record_metadata"]
    vol = (s["volume_record"].select(F.col("record_id").alias("volume_record_id"))
           .join(rm.filter(F.col("record_last_updated_gmt") >= _since(since))
                 .select(F.col("id").alias("volume_record_id"), F.col("record_num").alias("volume_record_num"),
                         to_jd("creation_date_gmt").alias("creation_julianday")), "volume_record_id"))
    link = s["bib_record_volume_record_link"].join(_record_nums(s, "b", "bib_record_id", "bib_record_num"),
                                                    "bib_record_id")
    volumes = vol if since is not None else s["volume_record"].select(F.col("record_id").alias("volume_record_id"))
    s = _only(s, volumes.select("volume_record_id"), varfield="record_id")
    stat = _statements(s, "volume_record_id", None).withColumnRenamed("statement", "volume_statement")
    return (vol.join(link, "volume_record_id").join(stat, "volume_record_id", "left")
            .select("volume_record_id", "volume_record_num", "bib_record_id", "bib_record_num",
                    "creation_julianday", "volume_statement"))


# --------------------------------------------------------------------------- X06
def parse_message(df: DataFrame, text: str = "field_content", as_of=None) -> DataFrame:
    """Flags, route and time of an item message.

    A message matching neither the route nor the leading time pattern yields no
    row (two set-returning matches in lockstep); one matching only one of them
    keeps NULL for the other.
    """
    t = F.col(text)
    route_from = nullif_empty(F.regexp_extract(t, LAST_TRANSIT_ROUTE, 1))
    route_to = nullif_empty(F.regexp_extract(t, LAST_TRANSIT_ROUTE, 2))
    stamp = nullif_empty(F.regexp_extract(t, TRANSIT_TIME, 1))
    when = F.try_to_timestamp(F.substring(stamp, 5, 100), F.lit("MMM dd yyyy hh:mma"))
    now_jd = F.lit(None) if as_of is None else to_jd(F.lit(as_date(as_of)))
    return (df.withColumn("transit_from", route_from).withColumn("transit_to", route_to)
            .withColumn("transit_time_string", stamp)
            .filter(F.col("transit_from").isNotNull() | F.col("transit_time_string").isNotNull())
            .withColumn("has_in_transit", t.rlike(IN_TRANSIT))
            .withColumn("has_in_transit_too_long", t.rlike(IN_TRANSIT_TOO_LONG))
            .withColumn("in_transit_julianday", to_jd(when))
            .withColumn("in_transit_days", (now_jd - F.col("in_transit_julianday")).cast("int")))


def item_message(s, as_of) -> DataFrame:
    rm = s["record_metadata"].filter(F.col("record_type_code") == "i")
    msgs = (rm.select(F.col("id").alias("item_record_id"), "campus_code")
            .join(s["varfield"].filter(F.col("varfield_type_code") == "m")
                  .select(F.col("record_id").alias("item_record_id"), F.col("id").alias("varfield_id"),
                          "occ_num", "field_content"), "item_record_id"))
    msgs = parse_message(msgs, as_of=as_of)
    irp = s["item_record_property"].select("item_record_id", F.col("barcode").alias("item_barcode"),
                                           "call_number")
    ir = s["item_record"].select(F.col("record_id").alias("item_record_id"), "item_status_code",
                                 "agency_code_num", "location_code", "itype_code_num")
    co = s["checkout"].select("item_record_id", to_jd("due_gmt").alias("due_julianday"),
                              "loanrule_code_num", to_jd("checkout_gmt").alias("checkout_julianday"),
                              "renewal_count", "overdue_count", to_jd("overdue_gmt").alias("overdue_julianday"))
    status = (_named(s["item_status_property"], s["item_status_property_name"], "item_status_property_id",
                     "left")
              .select(F.col("code").alias("item_status_code"), F.col("name").alias("item_status_name")))
    itype = _itype_names(s, "left").withColumnRenamed("name", "item_format")
    link = s["bib_record_item_record_link"].select("item_record_id", "bib_record_id")
    brp = s["bib_record_property"].select("bib_record_id", "publish_year", "best_title", "best_author")
    out = (msgs.join(irp, "item_record_id", "left").join(ir, "item_record_id", "left")
           .join(co, "item_record_id", "left")
           .join(bounded_broadcast(status), "item_status_code", "left")
           .join(link, "item_record_id", "left").join(brp, "bib_record_id", "left")
           .join(bounded_broadcast(itype), "itype_code_num", "left"))
    return out.select(
        "item_barcode", "campus_code", "call_number", "item_record_id", "varfield_id", "has_in_transit",
        "in_transit_julianday", "in_transit_days", "transit_from", "transit_to",
        "has_in_transit_too_long", "occ_num", "field_content", "publish_year", "best_title",
        "best_author", "item_status_code", "item_status_name", "agency_code_num", "location_code",
        "itype_code_num", "item_format", "due_julianday", "loanrule_code_num", "checkout_julianday",
        "renewal_count", "overdue_count", "overdue_julianday")


# --------------------------------------------------------------------------- X07-X18
def language_property(s) -> DataFrame:
    p = s["language_property"].withColumn("pid", F.col("id"))
    return (_named(p, s["language_property_name"], "language_property_id")
            .select(F.col("pid").alias("id"), "code", "display_order", "name"))


def bib_record_item_record_link(s) -> DataFrame:
    return (s["bib_record_item_record_link"]
            .join(_record_nums(s, "b", "bib_record_id", "bib_record_num"), "bib_record_id")
            .join(_record_nums(s, "i", "item_record_id", "item_record_num"), "item_record_id")
            .select("id", "bib_record_id", "bib_record_num", "item_record_id", "item_record_num",
                    "items_display_order", "bibs_display_order"))


def volume_record_item_record_link(s) -> DataFrame:
    rm = s["record_metadata"]
    vols = rm.filter((F.col("record_type_code") == "j") & (F.col("campus_code") == "")).select(
        F.col("id").alias("volume_record_id"), F.col("record_num").alias("volume_record_num"))
    stat = _statements(s, "volume_record_id", ["v"]).withColumnRenamed("statement", "volume_statement")
    return (vols.join(s["volume_record_item_record_link"], "volume_record_id")
            .join(rm.select(F.col("id").alias("item_record_id"), F.col("record_num").alias("item_record_num")),
                  "item_record_id", "left")
            .join(stat, "volume_record_id", "left")
            .select("id", "volume_record_id", "volume_record_num", "item_record_id", "item_record_num",
                    "items_display_order", "volume_statement"))


def location(s) -> DataFrame:
    return s["location"].select("id", "code", "branch_code_num", "parent_location_code", "is_public",
                                "is_requestable")


def location_name(s) -> DataFrame:
    return s["location_name"].select("location_id", "name")


def branch_name(s) -> DataFrame:
    return s["branch_name"].select("branch_id", "name")


def branch(s) -> DataFrame:
    return s["branch"].select("id", "address", "email_source", "email_reply_to", "address_latitude",
                              "address_longitude", "code_num")


def country_property_myuser(s) -> DataFrame:
    return s["country_property_myuser"].select("code", "display_order", "name")


def item_status_property(s) -> DataFrame:
    return (_named(s["item_status_property"], s["item_status_property_name"], "item_status_property_id")
            .select(F.col("code").alias("item_status_code"), "display_order",
                    F.col("name").alias("item_status_name")))


def itype_property(s) -> DataFrame:
    pf = s["physical_format_name"].select(F.col("physical_format_id").alias("pf_id"),
                                          F.col("name").alias("physical_format_name"))
    return (_named(s["itype_property"], s["itype_property_name"], "itype_property_id")
            .join(pf, F.col("physical_format_id") == pf["pf_id"], "left")
            .select(F.col("code_num").alias("itype_code"), "display_order",
                    F.col("name").alias("itype_name"), "physical_format_name"))


def bib_level_property(s) -> DataFrame:
    return (_named(s["bib_level_property"], s["bib_level_property_name"], "bib_level_property_id", "left")
            .select(F.col("code").alias("bib_level_property_code"), "display_order",
                    F.col("name").alias("bib_level_property_name")))


def material_property(s) -> DataFrame:
    return (_named(s["material_property"], s["material_property_name"], "material_property_id", "left")
            .select(F.col("code").alias("material_property_code"), "display_order", "is_public",
                    F.col("name").alias("material_property_name")))


# --------------------------------------------------------------------------- X19
def hold(s, as_of) -> DataFrame:
    rm = s["record_metadata"]
    as_of = as_date(as_of)
    bib_num = _record_nums(s, "b", "bib_record_id", "bnum")
    # Only links of held records matter: reduce the (large) link tables to the
    # held ids first, then take the "first" bib of an item / a volume: the smallest bib number.
    held = s["hold"].select("record_id").distinct()
    item_bib = (s["bib_record_item_record_link"]
                .join(held.withColumnRenamed("record_id", "item_record_id"), "item_record_id", "left_semi")
                .join(bib_num, "bib_record_id")
                .groupBy(F.col("item_record_id").alias("record_id")).agg(F.min("bnum").alias("item_bib")))
    vol_bib = (s["bib_record_volume_record_link"]
               .join(held.withColumnRenamed("record_id", "volume_record_id"), "volume_record_id", "left_semi")
               .join(bib_num, "bib_record_id")
               .groupBy(F.col("volume_record_id").alias("record_id")).agg(F.min("bnum").alias("vol_bib")))
    h = s["hold"].join(rm.select(F.col("id").alias("record_id"), "record_num", "record_type_code",
                                 "campus_code"), "record_id")
    rtype = F.col("record_type_code")
    p = s["patron_record"].select(F.col("record_id").alias("patron_record_id"), "activity_gmt",
                                  "ptype_code", "home_library_code", "mblock_code", "owed_amt")
    day = 28 if (as_of.month, as_of.day) == (2, 29) else as_of.day
    active_since = F.lit(_dt.datetime(as_of.year - 3, as_of.month, day))
    status = F.col("status")
    status_text = F.coalesce(*[F.when(status == k, F.lit(v)) for k, v in codes.HOLD_STATUS_TEXT.items()],
                             status)
    out = (h.join(item_bib, "record_id", "left").join(vol_bib, "record_id", "left")
           .join(p, "patron_record_id", "left"))
    return out.select(
        F.col("id").alias("hold_id"),
        F.when(rtype == "i", F.col("item_bib")).when(rtype == "j", F.col("vol_bib"))
         .when(rtype == "b", F.col("record_num")).alias("bib_record_num"),
        "campus_code", F.col("record_type_code").alias("record_type_on_hold"),
        F.when(rtype == "i", F.col("record_num")).alias("item_record_num"),
        F.when(rtype == "j", F.col("record_num")).alias("volume_record_num"),
        to_jd("placed_gmt").alias("placed_julianday"), "is_frozen", "delay_days", "location_code",
        to_jd("expires_gmt").alias("expires_julianday"),
        status_text.alias("hold_status"), "is_ir", "is_ill", "pickup_location_code",
        "ir_pickup_location_code", "ir_print_name", "ir_delivery_stop_name", "is_ir_converted_request",
        F.coalesce(F.col("activity_gmt") >= active_since.cast("timestamp"), F.lit(False))
         .alias("patron_is_active"),
        F.col("ptype_code").alias("patron_ptype_code"),
        F.col("home_library_code").alias("patron_home_library_code"),
        F.col("mblock_code").alias("patron_mblock_code"),
        F.coalesce(F.col("owed_amt") > 10, F.lit(False)).alias("patron_has_over_10usd_owed"))


# --------------------------------------------------------------------------- X20, X21
def _stat_groups(s) -> DataFrame:
    return (_named(s["statistic_group"], s["statistic_group_name"], "statistic_group_id")
            .withColumnRenamed("name", "stat_group_name")
            .select(F.col("code_num").alias("stat_group_code_num"), "location_code", "stat_group_name"))


def _branches(s) -> DataFrame:
    return _named(s["branch"], s["branch_name"], "branch_id").select(
        F.col("code_num").alias("branch_code_num"), F.col("name").alias("branch_name"))


def circ_agg(s, as_of) -> DataFrame:
    as_of = as_date(as_of)
    start = _dt.datetime(as_of.year, as_of.month, 1)
    m = start.month - 6
    start = start.replace(year=start.year + (m - 1) // 12, month=(m - 1) % 12 + 1)
    ct = s["circ_trans"].filter((F.col("transaction_gmt") > F.lit(start))
                                & F.col("op_code").isin(*codes.CIRC_OPS))
    daily = (ct.groupBy(F.date_format("transaction_gmt", "yyyy-MM-dd").alias("transaction_day"),
                        "stat_group_code_num", "op_code", "itype_code_num", "loanrule_code_num")
             .agg(F.count(F.lit(1)).alias("count_op_code"),
                  F.countDistinct("patron_record_id").alias("count_distinct_patrons")))
    loc = s["location"].select(F.col("code").alias("location_code"), "branch_code_num")
    dims = (_stat_groups(s).join(loc, "location_code").join(_branches(s), "branch_code_num")
            .select("stat_group_code_num", "stat_group_name", "branch_code_num", "branch_name"))
    return (daily.join(bounded_broadcast(dims), "stat_group_code_num")
            .select("transaction_day", "stat_group_code_num", "op_code", "itype_code_num",
                    "loanrule_code_num", "count_op_code", "count_distinct_patrons",
                    "stat_group_name", "branch_code_num", "branch_name"))


def circ_leased_items(s, as_of) -> DataFrame:
    as_of = as_date(as_of)
    rm = s["record_metadata"]
    leased = (s["item_record_property"]
              .filter((F.col("barcode") >= codes.LEASED_BARCODE_LOW) & (F.col("barcode") < codes.LEASED_BARCODE_HIGH))
              .select("item_record_id", "barcode")
              .join(rm.filter(F.col("campus_code") == "").select(F.col("id").alias("item_record_id")),
                    "item_record_id"))
    since = _dt.datetime.combine(as_of - _dt.timedelta(days=180), _dt.time())
    ct = (s["circ_trans"].filter((F.col("transaction_gmt") > F.lit(since)) & F.col("op_code").isin("o", "i"))
          .join(leased.select("item_record_id"), "item_record_id", "left_semi"))

    loc = s["location"].select(F.col("code").alias("location_code"), "branch_code_num")
    dims = (s["statistic_group"].select(F.col("code_num").alias("stat_group_code_num"), "id",
                                        F.col("location_code").alias("stat_group_location_code"))
            .join(s["statistic_group_name"].select(F.col("statistic_group_id").alias("id"),
                                                   F.col("name").alias("stat_group_name")), "id", "left")
            .join(loc.withColumnRenamed("location_code", "stat_group_location_code"),
                  "stat_group_location_code", "left")
            .join(_branches(s).withColumnRenamed("branch_name", "stat_group_branch_name"),
                  "branch_code_num", "left")
            .select("stat_group_code_num", "stat_group_name", "stat_group_location_code",
                    "stat_group_branch_name"))
    irp = s["item_record_property"].select("item_record_id", "barcode")
    out = (ct.join(bounded_broadcast(dims), "stat_group_code_num", "left")
           .join(_record_nums(s, "i", "item_record_id", "item_record_num"), "item_record_id", "left")
           .join(irp, "item_record_id", "left")
           .join(_record_nums(s, "b", "bib_record_id", "bib_record_num"), "bib_record_id", "left"))
    nums = _record_nums(s, "j", "volume_record_id", "volume_record_num")
    out = sparse_left_join(out, nums, "volume_record_id", by="id")
    return out.select(
        "id", F.date_format("transaction_gmt", "yyyy-MM-dd").alias("transaction_day"), "stat_group_code_num",
        "stat_group_name", "stat_group_location_code", "stat_group_branch_name", "op_code",
        "application_name", F.date_format("due_date_gmt", "yyyy-MM-dd").alias("due_date"),
        "item_record_id", "item_record_num", "barcode", "bib_record_id", "bib_record_num",
        "volume_record_id", "volume_record_num", "itype_code_num", "item_location_code", "ptype_code",
        "patron_home_library_code", "patron_agency_code_num", "loanrule_code_num")


BASE_TABLES = {
    "record_metadata": record_metadata, "bib": bib, "item": item, "bib_record": bib_record,
    "volume_record": volume_record, "item_message": item_message,
    "language_property": language_property,
    "bib_record_item_record_link": bib_record_item_record_link,
    "volume_record_item_record_link": volume_record_item_record_link,
    "location": location, "location_name": location_name, "branch_name": branch_name, "branch": branch,
    "country_property_myuser": country_property_myuser, "item_status_property": item_status_property,
    "itype_property": itype_property, "bib_level_property": bib_level_property,
    "material_property": material_property, "hold": hold, "circ_agg": circ_agg,
    "circ_leased_items": circ_leased_items,
}
NEEDS_AS_OF = {"item_message", "hold", "circ_agg", "circ_leased_items"}
NEEDS_SINCE = {"record_metadata", "bib", "item", "bib_record", "volume_record"}


def build_base_tables(s, as_of, since=None) -> dict[str, DataFrame]:
    """All 21 base tables as plans (plus ``branch_locations`` passed through)."""
    out = {}
    for name, fn in BASE_TABLES.items():
        if name in NEEDS_AS_OF:
            out[name] = fn(s, as_of)
        elif name in NEEDS_SINCE:
            out[name] = fn(s, since)
        else:
            out[name] = fn(s)
    if "branch_locations" in s:
        out["branch_locations"] = s["branch_locations"]
    return out
