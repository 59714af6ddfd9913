"""Registered queries (one per operator of the inventory) and their DuckDB oracles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.functions import codes
from shelfwise.oracle import compose
from shelfwise.plans import context

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

BASE_IDS = [
    ("X01", "record_metadata"), ("X02", "bib"), ("X03", "item"), ("X04", "bib_record"),
    ("X05", "volume_record"), ("X06", "item_message"), ("X07", "language_property"),
    ("X08", "bib_record_item_record_link"), ("X09", "volume_record_item_record_link"),
    ("X10", "location"), ("X11", "location_name"), ("X12", "branch_name"), ("X13", "branch"),
    ("X14", "country_property_myuser"), ("X15", "item_status_property"), ("X16", "itype_property"),
    ("X17", "bib_level_property"), ("X18", "material_property"), ("X19", "hold"),
    ("X20", "circ_agg"), ("X21", "circ_leased_items"),
]


def register(key: str, fn: Query, oracle: str | None = None, extra_ctes=None) -> None:
    QUERIES[key] = fn
    if oracle is not None:
        ORACLES[key] = compose(oracle, extra_ctes)


def _base_query(name: str) -> Query:
    return lambda spark, sf_dir: context.base(spark, sf_dir)[name]


for _id, _name in BASE_IDS:
    register(f"{_id}_{_name}", _base_query(_name), f"SELECT * FROM x_{_name}")


# ----------------------------------------------------------------- marts V01-V26
from shelfwise.oracle.mart_sql import MART_SQL, V14_AS_OF, duplicates_across_sql  # noqa: E402
from shelfwise.operators import marts  # noqa: E402

# V23 / V24 take their two locations as a parameter (fixed values of the test mapping).
DUP_LOCATIONS = {"V23": ["l1", "l2"], "V24": ["l3", "l2"]}


def _mart_query(fn, as_of) -> Query:
    return lambda spark, sf_dir: fn(context.base(spark, sf_dir), as_of)


def _in_parts(fn, as_of) -> Query:
    """A mart that has a row for each item and reads most of its columns: made of one part of the items at a time."""

    def query(spark, sf_dir):
        t = context.base(spark, sf_dir)
        return fn(t, as_of) if context.count_item_parts(spark, sf_dir) == 1 else fn(t, as_of, context.item_parts(spark, sf_dir))

    return query


IN_PARTS = ("V04", "V25")
for _id, (_name, _fn) in marts.MARTS.items():
    _as_of = V14_AS_OF if _id == "V14" else context.AS_OF
    register(f"{_id}_{_name}", (_in_parts if _id in IN_PARTS else _mart_query)(_fn, _as_of), MART_SQL[_id])

for _id, _name in (("V23", "duplicate_items_2ra_2rabi"), ("V24", "duplicate_items_3ra_2rabi")):
    _locs = DUP_LOCATIONS[_id]
    register(f"{_id}_{_name}",
             (lambda locs: lambda spark, sf_dir: marts.duplicates_across(context.base(spark, sf_dir), locs))(_locs),
             duplicates_across_sql(_locs))


# ----------------------------------------------------------------- canned queries and reports
from shelfwise.oracle.report_sql import REPORT_SQL  # noqa: E402
from shelfwise.operators import reports as R  # noqa: E402

# Named parameters of the parametrised reports (values of the test mapping).
SHELF_LOCATION = "l5"
BRANCH = "Nation_5"
FORMAT = "Leased DVD"
SUBJECT = "red"


def _on_base(fn, *args) -> Query:
    return lambda spark, sf_dir: fn(context.base(spark, sf_dir), *args)


def _on_sources(fn) -> Query:
    return lambda spark, sf_dir: fn(context.sources(spark, sf_dir))


register("Q01_items_by_branch", _on_base(R.items_by_branch), REPORT_SQL["Q01"])
register("Q02_top_holds", lambda spark, sf: R.top_holds(context.sources(spark, sf), context.base(spark, sf)),
         REPORT_SQL["Q02"])
register("Q03_most_checked_out", _on_base(R.most_checked_out), REPORT_SQL["Q03"])
register("Q04_available_items_by_format", _on_base(R.available_items_by_format), REPORT_SQL["Q04"])
register("Q05_recently_added", _on_base(R.recently_added, context.AS_OF), REPORT_SQL["Q05"])
register("R03_bib_hold_strings", _on_sources(R.bib_hold_strings), REPORT_SQL["R03"])
register("R04_bib_holds", _on_sources(R.bib_holds), REPORT_SQL["R04"])
register("R05_holds_by_patron_activity", _on_base(R.holds_by_patron_activity), REPORT_SQL["R05"])
register("R06_holds_by_pickup_branch", _on_base(R.holds_by_pickup_branch), REPORT_SQL["R06"])
register("R07_active_holds_by_title", _on_base(R.active_holds_by_title, context.AS_OF), REPORT_SQL["R07"])
register("R09_shelf_list", _on_base(R.shelf_list, SHELF_LOCATION),
         REPORT_SQL["R09"].replace("{location}", SHELF_LOCATION))
register("R10_random_active_items", _on_base(R.random_active_items), f"""
SELECT item_record_num, bib_record_num, barcode, location_code, item_status_code FROM x_item
WHERE item_status_code IN ({", ".join(repr(c) for c in codes.ACTIVE_STATUS)})
ORDER BY md5(CAST(item_record_num AS VARCHAR) || ':42'), item_record_num, bib_record_num LIMIT 10""")
register("R11_titles_with_items", _on_base(R.titles_with_items), REPORT_SQL["R11"])
register("R12_items_per_bib", _on_base(R.items_per_bib), REPORT_SQL["R12"])
register("R13_location_branch_listing", _on_base(R.location_branch_listing), REPORT_SQL["R13"])
register("R15_items_by_location_in_branch", _on_base(R.items_by_location_in_branch, BRANCH),
         REPORT_SQL["R15"].replace("{branch}", BRANCH))
register("R16_titles_by_decade", _on_base(R.titles_by_decade), REPORT_SQL["R16"])
register("R17_branches_with_format", _on_base(R.branches_with_format, FORMAT),
         REPORT_SQL["R17"].replace("{item_format}", FORMAT))
register("R18_top_circulating_by_subject", _on_base(R.top_circulating_by_subject, SUBJECT),
         REPORT_SQL["R18"].replace("{subject}", SUBJECT))
register("R19_distinct_locations", _on_base(R.distinct_locations), REPORT_SQL["R19"])
register("R20_in_transit_status", _on_base(R.in_transit_status), REPORT_SQL["R20"])
register("R22_in_transit_too_long_by_branch", _on_base(R.in_transit_too_long_by_branch), REPORT_SQL["R22"])


# ----------------------------------------------------------------- exploration E01-E08
from shelfwise.operators import explore as E  # noqa: E402


def _explore_e01(spark, sf_dir):
    iv = marts.item_view(context.base(spark, sf_dir))
    return E.facet_counts(iv, ["location_code", "item_format"], size=30)


register("E01_facet_counts", _explore_e01, """
SELECT facet, value, count, rank FROM (
  SELECT facet, value, count, row_number() OVER (PARTITION BY facet ORDER BY count DESC, value NULLS FIRST) AS rank
  FROM (SELECT 'location_code' AS facet, CAST(location_code AS VARCHAR) AS value, count(*) AS count FROM x_item GROUP BY 2
        UNION ALL
        SELECT 'item_format', CAST(item_format AS VARCHAR), count(*) FROM x_item GROUP BY 2))
WHERE rank <= 30""")
register("E02_exact_filter",
         lambda spark, sf: E.where(marts.location_view(context.base(spark, sf)), "location_code", "exact", "l5"),
         MART_SQL["V03"].strip() + "\nAND l.code = 'l5'")
register("E03_range_filter",
         lambda spark, sf: E.where_all(context.base(spark, sf)["bib"].select(
             "bib_record_num", "best_title", "publish_year"),
             [("publish_year", "gte", 1980), ("publish_year", "lte", 1990)]),
         "SELECT bib_record_num, best_title, publish_year FROM x_bib WHERE publish_year BETWEEN 1980 AND 1990")
register("E04_in_notin_filter",
         lambda spark, sf: E.where_all(marts.item_view(context.base(spark, sf)).select(
             "item_record_num", "item_format", "location_code"),
             [("item_format", "in", ["DVD", "Leased DVD"]), ("location_code", "notin", ["l1", "l2", "l3"])]),
         """SELECT item_record_num, item_format, location_code FROM x_item
            WHERE item_format IN ('DVD', 'Leased DVD') AND location_code NOT IN ('l1', 'l2', 'l3')""")
register("E05_array_contains",
         lambda spark, sf: E.where(context.base(spark, sf)["bib"].select("bib_record_num", "genres"),
                                   "genres", "arraycontains", "ring"),
         "SELECT bib_record_num, genres FROM x_bib WHERE list_contains(genres, 'ring')")
register("E06_sort_desc",
         lambda spark, sf: E.sort_page(marts.genre_view(context.base(spark, sf)), ["count_bibs", "genre"],
                                       descending=True, limit=5),
         MART_SQL["V26"].strip() + "\nORDER BY count_bibs DESC, g.genre DESC LIMIT 5")
register("E07_page",
         lambda spark, sf: E.sort_page(context.base(spark, sf)["bib"].select("bib_record_num", "best_title"),
                                       ["bib_record_num"], limit=100, offset=200),
         "SELECT bib_record_num, best_title FROM x_bib ORDER BY bib_record_num LIMIT 100 OFFSET 200")
register("E08_json_rows",
         lambda spark, sf: E.as_json_rows(E.where(marts.genre_view(context.base(spark, sf)), "count_bibs", "gte", 100)),
         """SELECT json_object('genre', genre, 'count_bibs', count_bibs, 'link', link)::VARCHAR AS json
            FROM (""" + MART_SQL["V26"] + ") WHERE count_bibs >= 100")


# ----------------------------------------------------------------- R14 full-text search
from shelfwise.oracle.search_sql import search_bibs_sql, search_documents_sql  # noqa: E402
from shelfwise.operators import search as S  # noqa: E402

BIB_QUERY = dict(any_of=["red", "ring"], none_of=["small"])
DOC_QUERY = dict(all_of=["the", "and"], any_of=["was", "it"], none_of=["en"], phrase=["of", "the"])

_ctes, _final = search_bibs_sql(**BIB_QUERY)
register("R14_search_bibs", lambda spark, sf: S.search_bibs(context.base(spark, sf), **BIB_QUERY), _final, _ctes)
_ctes, _final = search_documents_sql(**DOC_QUERY)
register("R14_search_documents",
         lambda spark, sf: S.search_documents(spark.read.parquet(f"{sf}/documents.parquet"), **DOC_QUERY),
         _final, _ctes)


# ----------------------------------------------------------------- R01, S05
from shelfwise.sources.tables import first_rows  # noqa: E402

register("R01_legacy_bib_export", _on_sources(R.legacy_bib_export), REPORT_SQL["R01"])

SAMPLE_ROWS = 500
register("S05_sample_build_record_metadata",
         lambda spark, sf: first_rows(context.base(spark, sf)["record_metadata"], SAMPLE_ROWS, "record_id"),
         f"SELECT * FROM x_record_metadata ORDER BY record_id LIMIT {SAMPLE_ROWS}")

register("R02_legacy_item_export", _on_sources(R.legacy_item_export), REPORT_SQL["R02"])
register("R21_bib_varfields", _on_sources(R.bib_varfields), """
SELECT rm.id AS bib_record_id, rm.record_num AS bib_record_num, v.id AS varfield_id, v.varfield_type_code,
  v.marc_tag, v.marc_ind1, v.marc_ind2, v.occ_num, v.field_content
FROM record_metadata rm JOIN varfield v ON v.record_id = rm.id
WHERE rm.record_type_code = 'b' AND rm.campus_code = ''""")


# ----------------------------------------------------------------- X02a-g: the per-bib child aggregates
from shelfwise.operators.extract import bib_children  # noqa: E402

_ISBN_RE = "(?i)([0-9]{12,13}x?|[0-9]{9,10}x?)"
BIB_CHILD_SQL = {
    "control": """SELECT record_id AS bib_record_id, list(index_entry ORDER BY occurrence, id) AS control_numbers
FROM phrase_entry WHERE index_tag = 'o' AND varfield_type_code = 'o' GROUP BY 1""",
    "isbn": f"""SELECT bib_record_id, list(m ORDER BY occ_num, vid) AS isbn_values FROM (
  SELECT record_id AS bib_record_id, regexp_extract(field_content, '{_ISBN_RE}', 1) AS m, occ_num, id AS vid
  FROM varfield WHERE marc_tag || varfield_type_code = '020i') WHERE m <> '' GROUP BY 1""",
    "publisher": """SELECT record_id AS bib_record_id, first(content ORDER BY display_order, id) AS publisher
FROM subfield WHERE field_type_code = 'p' AND tag = 'b' GROUP BY 1""",
    "callnum": """SELECT record_id AS bib_record_id, first(index_entry ORDER BY id) AS bib_level_callnumber
FROM phrase_entry WHERE index_tag = 'c' AND varfield_type_code = 'c' GROUP BY 1""",
    "subjects": """SELECT record_id AS bib_record_id, list(index_entry ORDER BY occurrence, id) AS indexed_subjects
FROM phrase_entry WHERE index_tag = 'd' GROUP BY 1""",
    "genres": """SELECT v.record_id AS bib_record_id, list(s.content ORDER BY s.occ_num, s.id) AS genres
FROM varfield v JOIN subfield s ON s.varfield_id = v.id WHERE v.varfield_type_code = 'j' AND s.tag = 'a' GROUP BY 1""",
    "item_types": """SELECT bib_record_id, list(name ORDER BY cnt DESC, name) AS item_types FROM (
  SELECT l.bib_record_id, n.name, count(*) AS cnt FROM bib_record_item_record_link l
  JOIN item_record ir ON ir.record_id = l.item_record_id
  JOIN itype_property ip ON ip.code_num = ir.itype_code_num
  JOIN itype_property_name n ON n.itype_property_id = ip.id
  GROUP BY 1, 2) GROUP BY 1""",
}
for _sub, _key in (("a", "control"), ("b", "isbn"), ("c", "publisher"), ("d", "callnum"), ("e", "subjects"),
                   ("f", "genres"), ("g", "item_types")):
    register(f"X02{_sub}_bib_{_key}",
             (lambda k: lambda spark, sf: bib_children(context.sources(spark, sf))[k])(_key),
             BIB_CHILD_SQL[_key])


# ----------------------------------------------------------------- X06a: item-message parsing alone
from shelfwise.operators.extract import parse_message  # noqa: E402


def _message_parse(spark, sf_dir):
    vf = context.sources(spark, sf_dir)["varfield"].filter("varfield_type_code = 'm'")
    return parse_message(vf.select(F.col("id").alias("varfield_id"), "field_content"), as_of=context.AS_OF).select(
        "varfield_id", "has_in_transit", "has_in_transit_too_long", "transit_from", "transit_to",
        "transit_time_string", "in_transit_julianday", "in_transit_days")


register("X06a_message_parse", _message_parse, """
SELECT varfield_id, has_in_transit, has_in_transit_too_long, transit_from, transit_to, transit_time_string,
  in_transit_julianday, in_transit_days FROM x_item_message_parsed""", [("x_item_message_parsed", f"""
SELECT varfield_id, has_in_transit, has_in_transit_too_long, transit_from, transit_to, stamp AS transit_time_string,
  CAST(CAST(ts AS DATE) - DATE '1970-01-01' AS INTEGER) + 2440588 AS in_transit_julianday,
  CAST(DATE '{context.AS_OF.isoformat()}' - CAST(ts AS DATE) AS INTEGER) AS in_transit_days
FROM (
  SELECT *, try_strptime(substr(stamp, 5), '%b %d %Y %I:%M%p') AS ts FROM (
    SELECT id AS varfield_id,
      regexp_matches(field_content, '(?i)IN\\sTRANSIT') AS has_in_transit,
      regexp_matches(field_content, '(?i)IN\\sTRANSIT\\sTOO\\sLONG') AS has_in_transit_too_long,
      nullif(regexp_extract(field_content, '(?is).*IN\\sTRANSIT\\sfrom\\s([0-9a-z]+)\\sto\\s([0-9a-z]+)', 1), '') AS transit_from,
      nullif(regexp_extract(field_content, '(?is).*IN\\sTRANSIT\\sfrom\\s([0-9a-z]+)\\sto\\s([0-9a-z]+)', 2), '') AS transit_to,
      nullif(regexp_extract(field_content, '(?i)^[a-z]{{3}}\\s[a-z]{{1,3}}\\s[0-9]{{2}}\\s[0-9]{{4}}\\s[0-9]{{2}}:[0-9]{{2}}[AP]M', 0), '') AS stamp
    FROM varfield WHERE varfield_type_code = 'm') q
  WHERE transit_from IS NOT NULL OR stamp IS NOT NULL)""")])


# ----------------------------------------------------------------- S04, S07, K02, K04: the daily run's parts
from shelfwise.operators import extract as X  # noqa: E402
from shelfwise.plans import pipeline, publish, storage  # noqa: E402
from shelfwise.session import save, scratch_path, written_in_turn  # noqa: E402

CHANGED_SINCE = "2023-12-15"
_SINCE = context.AS_OF.__class__.fromisoformat(CHANGED_SINCE)

register("S04_changed_bibs", lambda spark, sf: X.bib(context.sources(spark, sf), _SINCE), f"""
SELECT b.* FROM x_bib b
WHERE b.bib_record_id IN (SELECT id FROM record_metadata WHERE record_last_updated_gmt >= TIMESTAMP '{CHANGED_SINCE}')""")
register("S04_changed_items", lambda spark, sf: X.item(context.sources(spark, sf), _SINCE), f"""
SELECT i.* FROM x_item i
WHERE i.item_record_id IN (SELECT id FROM record_metadata WHERE record_last_updated_gmt >= TIMESTAMP '{CHANGED_SINCE}')""")
register("S04_changed_volumes", lambda spark, sf: X.volume_record(context.sources(spark, sf), _SINCE), f"""
SELECT v.* FROM x_volume_record v
WHERE v.volume_record_id IN (SELECT id FROM record_metadata WHERE record_last_updated_gmt >= TIMESTAMP '{CHANGED_SINCE}')""")
register("S07_watermark", lambda spark, sf: pipeline.watermark_table(context.base(spark, sf)["record_metadata"]), """
SELECT CAST(DATE '1970-01-01' + CAST(max(record_last_updated_julianday) - 2440588 - 1 AS INTEGER) AS DATE) AS since
FROM x_record_metadata""")

_LISTS = ("control_numbers", "isbn_values", "indexed_subjects", "genres", "item_types")
register("K02_text_encoding", lambda spark, sf: publish.encode_for_text(context.base(spark, sf)["bib"]), f"""
SELECT bib_record_num, bib_record_id, best_author, best_title, publisher, publish_year, bib_level_callnumber,
  {", ".join(f"to_json({c})::VARCHAR AS {c}" for c in _LISTS)}, strftime(cataloging_date, '%Y-%m-%d') AS cataloging_date
FROM x_bib""")


def _with_changes(spark, sf_dir, merged) -> DataFrame:
    """``merged(items, changed items, keep)`` of each part of the items in turn.

    ``keep`` writes what is read several times or would leave much shuffled; it goes when the part is merged.
    """

    def parts():
        for pair in zip(context.item_parts(spark, sf_dir), context.item_parts(spark, sf_dir, _SINCE)):
            paths = [scratch_path(spark)]

            def keep(df: DataFrame) -> DataFrame:
                if paths[0] is None:
                    return df
                paths.append(storage.join(paths[0], str(len(paths))))
                return save(df, paths[-1])

            yield merged(*map(keep, pair), keep)
            if paths[0] is not None:
                storage.delete(spark, paths[0])

    return written_in_turn(parts())


def _upserted_items(spark, sf_dir):
    """Items with the rows of changed records renewed (one more checkout) and withdrawn ones deleted."""

    def merged(item, changed, keep):
        delta = changed.withColumn("checkout_total", F.col("checkout_total") + 1)
        gone = item.filter("item_status_code = 'w'").select("item_record_id")
        return publish.upsert(item, delta, "item_record_id", deleted_keys=gone)

    return _with_changes(spark, sf_dir, merged)


register("K04_upsert_item", _upserted_items, f"""
SELECT i.* REPLACE (i.checkout_total + if(m.record_last_updated_gmt >= TIMESTAMP '{CHANGED_SINCE}', 1, 0) AS checkout_total)
FROM x_item i JOIN record_metadata m ON m.id = i.item_record_id
WHERE i.item_record_id NOT IN (SELECT item_record_id FROM x_item WHERE item_status_code = 'w')""")


# ----------------------------------------------------------------- K04 by version: late deltas and tombstones
from shelfwise.plans import snapshots  # noqa: E402


def _items_merged_by_version(spark, sf_dir):
    """Items after two deltas that arrive in the wrong order, the newer one twice, and a deletion.

    The rows have version 0.  Withdrawn items are deleted at version 2.  Changed records come with one more
    checkout at version 3, then late with 100 more at version 1; neither changes what is newer.
    """

    def merged(item, changed, keep):
        more = lambda n, v: snapshots.versioned(
            changed.withColumn("checkout_total", F.col("checkout_total") + n), F.lit(v).cast("long"))
        gone = item.filter("item_status_code = 'w'").select("item_record_id", F.lit(2).cast("long").alias(snapshots.VERSION))
        table = snapshots.versioned(item, F.lit(0).cast("long"))
        deltas = [more(1, 3), snapshots.versioned(changed.limit(0), F.lit(2).cast("long"), gone), more(100, 1), more(1, 3)]
        for delta in deltas:  # what is merged so far is written, so that one merge's shuffle files are there at a time
            table = snapshots.merge_versions(table if delta is deltas[0] else keep(table), delta, "item_record_id")
        return snapshots.live_rows(table)

    return _with_changes(spark, sf_dir, merged)


register("K04_merge_by_version", _items_merged_by_version, f"""
SELECT i.* REPLACE (i.checkout_total + if(m.record_last_updated_gmt >= TIMESTAMP '{CHANGED_SINCE}', 1, 0) AS checkout_total)
FROM x_item i JOIN record_metadata m ON m.id = i.item_record_id
WHERE m.record_last_updated_gmt >= TIMESTAMP '{CHANGED_SINCE}'
  OR i.item_record_id NOT IN (SELECT item_record_id FROM x_item WHERE item_status_code = 'w')""")


# ----------------------------------------------------------------- R14 by a positional inverted index
from shelfwise.oracle.search_sql import search_all_bib_columns_sql  # noqa: E402
from shelfwise.operators import fulltext  # noqa: E402

BIB_INDEX_QUERY = dict(any_of=["dvd", "book"], none_of=["small"], prefixes=["re"])
_ctes, _final = search_all_bib_columns_sql(**BIB_INDEX_QUERY)
register("R14_index_bibs", lambda spark, sf: fulltext.search_bibs(context.base(spark, sf)["bib"], **BIB_INDEX_QUERY), _final, _ctes)
_ctes, _final = search_documents_sql(**DOC_QUERY)
register("R14_index_documents",
         lambda spark, sf: fulltext.search_documents(spark.read.parquet(f"{sf}/documents.parquet"), **DOC_QUERY), _final, _ctes)


# ----------------------------------------------------------------- E07 by seeking
from shelfwise.operators import paging  # noqa: E402

PAGE_CURSOR = ["m", 8]  # sort keys of the last row seen
register("E07_seek_page",
         lambda spark, sf: paging.page_after(context.base(spark, sf)["bib"].select("best_title", "bib_record_num"),
                                             ["best_title", "bib_record_num"], PAGE_CURSOR, limit=100),
         f"""SELECT best_title, bib_record_num FROM x_bib
WHERE best_title > '{PAGE_CURSOR[0]}' OR (best_title = '{PAGE_CURSOR[0]}' AND bib_record_num > {PAGE_CURSOR[1]})
ORDER BY best_title NULLS FIRST, bib_record_num LIMIT 100""")


# ----------------------------------------------------------------- S05 closed under links
from shelfwise.sources import sampling  # noqa: E402

SAMPLE_SHARE = 0.05
SAMPLED = {"bib_record": "record_id", "volume_record": "record_id", "item_record": "record_id", "hold": "id",
           "circ_trans": "id", "patron_record": "record_id"}


def _closed_sample(spark, sf_dir):
    """Ids of the records, holds, transactions and patrons of a sample build."""
    sample = sampling.closed_sample(context.sources(spark, sf_dir), SAMPLE_SHARE)
    return written_in_turn(sample[n].select(F.lit(n).alias("relation"), F.col(c).cast("long").alias("id"))
                           for n, c in SAMPLED.items())


register("S05_closed_sample", _closed_sample, f"""
SELECT relation, CAST(id AS BIGINT) AS id FROM (
  WITH RECURSIVE edge AS MATERIALIZED (
    SELECT bib_record_id AS a, item_record_id AS b FROM bib_record_item_record_link
    UNION SELECT bib_record_id, volume_record_id FROM bib_record_volume_record_link
    UNION SELECT volume_record_id, item_record_id FROM volume_record_item_record_link),
  both_ways AS MATERIALIZED (SELECT a, b FROM edge UNION ALL SELECT b, a FROM edge),
  inside(id) AS (
    SELECT record_id FROM bib_record
    WHERE substr(md5(CAST(record_id AS VARCHAR) || ':0'), 1, 8) < '{int(SAMPLE_SHARE * 16 ** 8):08x}'
    UNION SELECT e.b FROM inside i JOIN both_ways e ON e.a = i.id)
  SELECT 'bib_record' AS relation, record_id AS id FROM bib_record WHERE record_id IN (SELECT id FROM inside)
  UNION ALL SELECT 'volume_record', record_id FROM volume_record WHERE record_id IN (SELECT id FROM inside)
  UNION ALL SELECT 'item_record', record_id FROM item_record WHERE record_id IN (SELECT id FROM inside)
  UNION ALL SELECT 'hold', id FROM hold WHERE record_id IN (SELECT id FROM inside)
  UNION ALL SELECT 'circ_trans', id FROM circ_trans WHERE item_record_id IN (SELECT id FROM inside)
  UNION ALL SELECT 'patron_record', record_id FROM patron_record WHERE record_id IN (
    SELECT patron_record_id FROM hold WHERE record_id IN (SELECT id FROM inside)
    UNION ALL SELECT patron_record_id FROM checkout WHERE item_record_id IN (SELECT id FROM inside)
    UNION ALL SELECT patron_record_id FROM circ_trans WHERE item_record_id IN (SELECT id FROM inside)))""")


# ----------------------------------------------------------------- V07, V12, V22, V26 kept up to date from deltas
from shelfwise.operators import totals as T  # noqa: E402


#: What the totals read of their tables, and what tells the rows of a key apart: equal rows of a delta are one.
_ITS_COLUMNS = {
    "items": ["item_record_num", "location_code", "item_format", "item_status_code", "due_date", "price_cents",
              "bib_record_num", "volume_record_num", "volume_record_statement"],
    "genres": ["bib_record_num", "genres"],
    "circulation": ["stat_group_code_num", "op_code", "itype_code_num", "loanrule_code_num", "branch_name", "count_op_code"]}


def _long(n: int):
    return F.lit(n).cast("long")


def _after_deltas(table, deltas, key, columns, totals):
    """Totals of ``table`` (version 0), changed by the images of the keys of a batch of deltas.

    The newest version counts in whatever order deltas come, so a batch is merged at once.
    """
    table = table.select(key, *columns)
    rows = snapshots.versioned(table, _long(0))
    batch = deltas[0].select(*rows.columns)
    for delta in deltas[1:]:
        batch = batch.unionByName(delta.select(*rows.columns))
    changed = T.change(snapshots.images(rows, snapshots.merge_versions(rows, batch, key), batch, key), totals)
    return T.add(T.computed(table, totals), changed, totals=totals)


def _item_totals(spark, sf_dir):
    """Changed items come dearer, lent and at another location at version 3, late with no price at version 1;
    withdrawn ones are deleted at version 2."""
    item = context.base(spark, sf_dir)["item"]
    changed = X.item(context.sources(spark, sf_dir), _SINCE)
    gone = item.filter("item_status_code = 'w'").select("item_record_id", _long(2).alias(snapshots.VERSION))
    newer = snapshots.versioned(
        changed.withColumn("price_cents", F.col("price_cents") + F.lit(5).cast(item.schema["price_cents"].dataType))
        .withColumn("due_date", F.coalesce("due_date", F.lit("2024-03-01").cast(item.schema["due_date"].dataType)))
        .withColumn("location_code", F.lit("l1")), _long(3), gone)
    late = snapshots.versioned(
        changed.withColumn("price_cents", F.lit(None).cast(item.schema["price_cents"].dataType)), _long(1))
    return _after_deltas(item, [newer, late], "item_record_id", _ITS_COLUMNS["items"], T.ITEMS)


def _genre_totals(spark, sf_dir):
    """Changed bibs come with two other genres, then with their old ones at an older version."""
    bib = context.base(spark, sf_dir)["bib"]
    changed = X.bib(context.sources(spark, sf_dir), _SINCE)
    other = F.array(F.lit("renewed"), F.lit("by delta"))
    deltas = [snapshots.versioned(changed.withColumn("genres", other), _long(2)), snapshots.versioned(changed, _long(1))]
    return _after_deltas(bib, deltas, "bib_record_id", _ITS_COLUMNS["genres"], T.GENRES)


RENEWED_FROM = "2024-01-10"


def _circulation_totals(spark, sf_dir):
    """Days from RENEWED_FROM are counted again, with one more in each group."""
    circ = context.base(spark, sf_dir)["circ_agg"]
    again = circ.filter(F.col("transaction_day") >= RENEWED_FROM).withColumn("count_op_code", F.col("count_op_code") + 1)
    return _after_deltas(circ, [snapshots.versioned(again, _long(1))] * 2, "transaction_day", _ITS_COLUMNS["circulation"], T.CIRCULATION)


_CHANGED = f"SELECT id FROM record_metadata WHERE record_last_updated_gmt >= TIMESTAMP '{CHANGED_SINCE}'"
_RENEWED = {
    "x_item": ("renewed_item", f"""
SELECT i.* REPLACE (if(c.id IS NULL, i.price_cents, i.price_cents + 5) AS price_cents,
  if(c.id IS NULL, i.due_date, coalesce(i.due_date, DATE '2024-03-01')) AS due_date,
  if(c.id IS NULL, i.location_code, 'l1') AS location_code)
FROM x_item i LEFT JOIN ({_CHANGED}) c ON c.id = i.item_record_id
WHERE c.id IS NOT NULL OR i.item_status_code IS DISTINCT FROM 'w'"""),
    "x_bib": ("renewed_bib", f"""
SELECT b.* REPLACE (if(c.id IS NULL, b.genres, ['renewed', 'by delta']) AS genres)
FROM x_bib b LEFT JOIN ({_CHANGED}) c ON c.id = b.bib_record_id"""),
    "x_circ_agg": ("renewed_circ_agg", f"""
SELECT a.* REPLACE (a.count_op_code + if(a.transaction_day >= '{RENEWED_FROM}', 1, 0) AS count_op_code) FROM x_circ_agg a"""),
}


def _register_kept(mart, table, state, read):
    cte, text = _RENEWED[table]
    register(f"{mart}_from_deltas", lambda spark, sf: read(state(spark, sf), context.base(spark, sf)),
             MART_SQL[mart].replace(f"{table} ", f"{cte} "), [(cte, text)])


_register_kept("V07", "x_item", _item_totals, T.collection_value_branch)
_register_kept("V12", "x_item", _item_totals, T.location_percent_checkout)
_register_kept("V22", "x_circ_agg", _circulation_totals, T.circ_agg_branch)
_register_kept("V26", "x_bib", _genre_totals, T.genres)
