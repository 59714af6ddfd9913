"""DuckDB oracle SQL for the canned queries and reports."""

from shelfwise.functions import codes
from shelfwise.oracle.base_sql import AS_OF
from shelfwise.oracle.mart_sql import ACTIVE, NOW_JD, PTYPES, _in, from_jd

PTYPES_LEGACY = _in(codes.ACTIVE_PTYPES_LEGACY)

HOLD_TEXT = """
SELECT h.patron_record_id, pr.record_num AS patron_record_num, r.record_type_code, r.record_num,
  h.record_id AS bib_record_id, h.id AS hold_id, h.placed_gmt,
  CAST(h.placed_gmt AS DATE) + h.delay_days AS not_needed_before, h.is_frozen, h.delay_days,
  CAST(h.expires_gmt AS DATE) AS expires, h.status, h.is_ir, h.pickup_location_code,
  '"P#=' || coalesce(CAST(pr.record_num AS VARCHAR), '') || ', I#=' || coalesce(CAST(r.record_num AS VARCHAR), '')
  || ', P=' || coalesce(CAST(CAST(h.placed_gmt AS DATE) AS VARCHAR), '')
  || ', NNB=' || coalesce(CAST(CAST(h.placed_gmt AS DATE) + h.delay_days AS VARCHAR), '')
  || '(' || coalesce(CAST(h.delay_days AS VARCHAR), '') || ' days), RLA=0, NNA='
  || coalesce(CAST(coalesce(CAST(h.expires_gmt AS DATE), CAST(h.placed_gmt AS DATE) + 255) AS VARCHAR), '')
  || ', ST=0, TP=' || coalesce(r.record_type_code, '') || ', PU=' || coalesce(h.pickup_location_code, '') || '"'
  AS hold_string
FROM hold h JOIN record_metadata r ON r.id = h.record_id AND r.record_type_code = 'b'
JOIN record_metadata pr ON pr.id = h.patron_record_id"""

BIB_HOLDS = f"""
SELECT bib_record_id, record_num AS bib_record_num, string_agg(hold_string, ';' ORDER BY placed_gmt, hold_id) AS holds
FROM ({HOLD_TEXT}) GROUP BY 1, 2"""

REPORT_SQL = {
    "Q01": "SELECT location_code, count(*) AS item_count FROM x_item GROUP BY location_code",
    "Q02": f"""
SELECT b.best_title, b.best_author, b.publish_year,
  length(h.holds) - length(replace(h.holds, ';', '')) + 1 AS hold_count
FROM ({BIB_HOLDS}) h JOIN x_bib b ON b.bib_record_num = h.bib_record_num
ORDER BY hold_count DESC, h.bib_record_num LIMIT 50""",
    "Q03": """
SELECT b.best_title, b.best_author, i.location_code, i.item_format, i.checkout_total
FROM x_item i JOIN x_bib b ON b.bib_record_num = i.bib_record_num
ORDER BY i.checkout_total DESC NULLS LAST, i.item_record_num, i.bib_record_num LIMIT 100""",
    "Q04": "SELECT item_format, count(*) AS available_count FROM x_item WHERE item_status_code = '-' GROUP BY 1",
    "Q05": f"""
SELECT b.best_title, b.best_author, i.item_format, i.location_code, i.creation_date
FROM x_item i JOIN x_bib b ON b.bib_record_num = i.bib_record_num
WHERE i.creation_date >= DATE '{AS_OF}' - 30
ORDER BY i.creation_date DESC, i.item_record_num, i.bib_record_num LIMIT 200""",
    "R03": HOLD_TEXT,
    "R04": BIB_HOLDS,
    "R05": """
SELECT count(hold_id) FILTER (WHERE patron_is_active IS FALSE) AS count_holds_for_inactive_patrons,
       count(hold_id) FILTER (WHERE patron_is_active IS TRUE) AS count_holds_for_active_patrons
FROM x_hold WHERE is_frozen IS FALSE AND is_ir IS FALSE AND is_ill IS FALSE""",
    "R06": f"""
SELECT (SELECT min(CASE WHEN bn.name = 'Main Library' THEN ' Main Library' ELSE bn.name END)
        FROM x_location l JOIN x_location_name ln ON ln.location_id = l.id
        JOIN x_branch br ON br.code_num = l.branch_code_num JOIN x_branch_name bn ON bn.branch_id = br.id
        WHERE l.code = h.pickup_location_code) AS pickup_location,
  h.patron_ptype_code, count(DISTINCT h.bib_record_num) AS count_distinct_titles, count(*) AS count,
  CAST(round(CAST(count(*) AS DECIMAL(38, 10)) / count(DISTINCT h.bib_record_num), 2) AS DOUBLE) AS avg_hold_per_title
FROM x_hold h
WHERE h.is_frozen IS FALSE AND h.is_ir IS FALSE AND h.is_ill IS FALSE AND h.patron_ptype_code IN {PTYPES_LEGACY}
GROUP BY 1, 2""",
    "R07": f"""
WITH a AS (
  SELECT h.* FROM x_hold h
  WHERE h.bib_record_num IN (SELECT record_num FROM x_record_metadata WHERE record_type_code = 'b')
    AND (h.is_frozen IS FALSE OR h.patron_ptype_code = 196)
    AND h.placed_julianday + h.delay_days <= {NOW_JD}
    AND h.patron_ptype_code IN {PTYPES} AND h.hold_status = 'on hold')
SELECT a.bib_record_num, count(a.bib_record_num) AS count_active_holds,
  CAST(round(CAST(sum({NOW_JD} - a.placed_julianday - a.delay_days) AS DECIMAL(38, 10)) / count(*), 2) AS DOUBLE)
    AS average_age_days_of_hold,
  b.best_author, b.best_title, b.publish_year,
  (SELECT min({from_jd('r.creation_julianday')}) FROM x_record_metadata r
    WHERE r.record_type_code = 'b' AND r.record_num = a.bib_record_num) AS bib_creation_date,
  b.bib_level_callnumber
FROM a JOIN x_bib b ON b.bib_record_num = a.bib_record_num
GROUP BY a.bib_record_num, b.best_author, b.best_title, b.publish_year, b.bib_level_callnumber""",
    "R09": """
SELECT i.item_record_num, i.bib_record_num, i.location_code, i.item_format, i.item_callnumber, b.best_author,
  b.best_title, i.barcode, i.item_status_code, i.checkout_total
FROM x_item i JOIN x_bib b ON b.bib_record_num = i.bib_record_num
WHERE i.location_code = '{location}'
ORDER BY i.location_code NULLS FIRST, i.item_format NULLS FIRST, b.best_author NULLS FIRST,
  b.best_title NULLS FIRST, i.item_callnumber NULLS FIRST, i.item_record_num LIMIT 10""",
    "R11": """
SELECT count(DISTINCT b.bib_record_num) AS count_distinct_titles
FROM x_bib b JOIN x_item i ON i.bib_record_num = b.bib_record_num""",
    "R12": """
SELECT b.bib_record_num, (SELECT count(i.item_record_num) FROM x_item i WHERE i.bib_record_num = b.bib_record_num)
  AS count_attached_items FROM x_bib b""",
    "R13": """
SELECT l.*, ln.location_id, ln.name AS location_name, br.id AS branch_id, br.code_num AS branch_code,
  br.address, br.email_source, br.email_reply_to, br.address_latitude, br.address_longitude,
  bn.branch_id AS bn_branch_id, bn.name AS branch_name
FROM x_location l JOIN x_location_name ln ON ln.location_id = l.id
JOIN x_branch br ON br.code_num = l.branch_code_num JOIN x_branch_name bn ON bn.branch_id = br.id""",
    "R15": """
SELECT l.code AS location_code, ln.name AS location_name, bn.name AS branch_name,
  (SELECT count(*) FROM x_item i WHERE i.location_code = l.code) AS count_items,
  json_object('href', '/current_collection/item?location_code__exact=' || coalesce(l.code, ''),
              'label', 'view items')::VARCHAR AS items
FROM x_location l JOIN x_location_name ln ON ln.location_id = l.id
JOIN x_branch br ON br.code_num = l.branch_code_num JOIN x_branch_name bn ON bn.branch_id = br.id
WHERE bn.name = '{branch}'""",
    "R16": """
SELECT CAST(publish_year // 10 * 10 AS INTEGER) AS decade, count(*) AS count_titles FROM x_bib
WHERE publish_year >= 1800 AND publish_year <= 2021 GROUP BY 1""",
    "R17": """
SELECT l.code AS location_code, l.is_public, l.is_requestable, ln.name AS location_name, bn.name AS branch_name,
  bl.address, bl.latitude, bl.longitude
FROM x_location l JOIN x_location_name ln ON ln.location_id = l.id
JOIN x_branch br ON br.code_num = l.branch_code_num JOIN x_branch_name bn ON bn.branch_id = br.id
JOIN branch_locations bl ON bl.code_num = br.code_num
WHERE l.code IN (SELECT DISTINCT location_code FROM x_item WHERE item_format = '{item_format}')""",
    "R18": f"""
SELECT (SELECT CAST(sum(i.checkout_total) AS BIGINT) FROM x_item i WHERE i.bib_record_num = b.bib_record_num)
    AS total_checkouts,
  '{codes.CATALOG_URL_PREFIX}' || CAST(b.bib_record_num AS VARCHAR) AS catalog_link,
  b.best_author, b.best_title, b.publisher, b.publish_year, b.bib_level_callnumber, b.indexed_subjects
FROM x_bib b WHERE b.indexed_subjects[1] ILIKE '%{{subject}}%'""",
    "R19": "SELECT DISTINCT location_code FROM x_item",
    "R20": f"""
SELECT item_record_id, item_barcode, location_code, item_format, best_title,
  json_object('checkout_date', {from_jd('checkout_julianday')}, 'due_date', {from_jd('due_julianday')},
              'renewal_count', renewal_count, 'overdue_count', overdue_count)::VARCHAR AS circ,
  json_object('transit_from', transit_from, 'transit_to', transit_to, 'in_transit_days', in_transit_days,
              'in_transit_date', {from_jd('in_transit_julianday')},
              'has_in_transit_too_long', has_in_transit_too_long)::VARCHAR AS transit,
  json_object('item_status_code', item_status_code, 'item_status_name', item_status_name,
              'call_number', call_number, 'occ_num', occ_num)::VARCHAR AS record,
  in_transit_days
FROM x_item_message WHERE has_in_transit""",
    "R22": f"""
SELECT bn.name AS destination_branch, m.transit_from, m.transit_to, i.item_record_num, i.barcode,
  m.in_transit_days, {from_jd('m.in_transit_julianday')} AS in_transit_date, i.item_format, i.item_callnumber
FROM x_item i JOIN x_hold h ON h.item_record_num = i.item_record_num
JOIN x_item_message m ON m.item_record_id = i.item_record_id
LEFT JOIN x_location l ON l.code = m.transit_to
LEFT JOIN x_branch br ON br.code_num = l.branch_code_num LEFT JOIN x_branch_name bn ON bn.branch_id = br.id
WHERE i.item_status_code = 't' AND m.has_in_transit_too_long""",
}


# First ISBN of each bib: fields with tag 020 and type i, in display order.
_FIRST_ISBN = """first_isbn AS (
  SELECT record_id AS bib_record_id, left(arg_min(hit, (occ_num, id)), 30) AS isbn
  FROM (SELECT record_id, occ_num, id,
               regexp_extract(field_content, '(?i)([0-9]{12,13}x?|[0-9]{9,10}x?)', 1) AS hit
        FROM varfield WHERE marc_tag = '020' AND varfield_type_code = 'i')
  WHERE hit <> '' GROUP BY record_id)"""

REPORT_SQL["R01"] = f"""
WITH {_FIRST_ISBN},
phrases AS (
  SELECT record_id AS bib_record_id,
    string_agg(index_entry, ',' ORDER BY occurrence, id) FILTER (index_tag = 'o' AND varfield_type_code = 'o') AS control_numbers,
    first(index_entry ORDER BY id) FILTER (index_tag = 'c' AND varfield_type_code = 'c') AS bib_level_callnumber,
    string_agg(index_entry, ',' ORDER BY occurrence, id) FILTER (index_tag = 'd') AS indexed_subjects
  FROM phrase_entry GROUP BY record_id),
publishers AS (
  SELECT record_id AS bib_record_id, first(content ORDER BY display_order, id) AS publisher
  FROM subfield WHERE field_type_code = 'p' AND tag = 'b' GROUP BY record_id),
bibs AS (
  SELECT id AS bib_record_id, record_num AS bib_record_num, CAST(creation_date_gmt AS DATE) AS creation_date,
    CAST(record_last_updated_gmt AS DATE) AS record_last_updated
  FROM record_metadata WHERE record_type_code = 'b' AND campus_code = '' AND deletion_date_gmt IS NULL)
SELECT bibs.*, control_numbers, isbn, best_author, best_author_norm, best_title, best_title_norm, publisher,
  publish_year, bib_level_callnumber, indexed_subjects
FROM bibs JOIN bib_record_property USING (bib_record_id)
LEFT JOIN phrases USING (bib_record_id) LEFT JOIN first_isbn USING (bib_record_id)
LEFT JOIN publishers USING (bib_record_id)"""

REPORT_SQL["R02"] = f"""
WITH {_FIRST_ISBN},
loans AS (
  SELECT c.item_record_id, CAST(c.checkout_gmt AS DATE) AS checkout_date, CAST(c.due_gmt AS DATE) AS due_date,
    home.patron_branch_code
  FROM checkout c LEFT JOIN (SELECT record_id, min(home_library_code) AS patron_branch_code
                             FROM patron_record GROUP BY record_id) home ON home.record_id = c.patron_record_id),
formats AS (
  SELECT ip.code_num AS itype_code_num, min(n.name) AS item_format
  FROM itype_property ip JOIN itype_property_name n ON n.itype_property_id = ip.id GROUP BY ip.code_num),
titles AS (
  SELECT l.item_record_id, l.bib_record_id, m.record_num AS bib_record_num, f.isbn
  FROM bib_record_item_record_link l JOIN record_metadata m ON m.id = l.bib_record_id
  LEFT JOIN first_isbn f ON f.bib_record_id = l.bib_record_id),
items AS (
  SELECT id AS item_record_id, record_num AS item_record_num, CAST(creation_date_gmt AS DATE) AS creation_date,
    CAST(record_last_updated_gmt AS DATE) AS record_last_updated
  FROM record_metadata WHERE record_type_code = 'i' AND campus_code = '' AND deletion_date_gmt IS NULL)
SELECT items.*, titles.bib_record_id, titles.bib_record_num, p.barcode, i.agency_code_num, i.location_code,
  i.checkout_statistic_group_code_num, i.checkin_statistics_group_code_num, loans.checkout_date, loans.due_date,
  loans.patron_branch_code, CAST(i.last_checkout_gmt AS DATE) AS last_checkout_date,
  CAST(i.last_checkin_gmt AS DATE) AS last_checkin_date, i.checkout_total, i.renewal_total, titles.isbn,
  formats.item_format, i.item_status_code, CAST(i.price AS DECIMAL(30, 2)) AS price,
  p.call_number_norm AS item_callnumber
FROM items JOIN titles USING (item_record_id)
JOIN item_record_property p USING (item_record_id)
JOIN item_record i ON i.record_id = items.item_record_id
LEFT JOIN loans USING (item_record_id)
LEFT JOIN formats ON formats.itype_code_num = i.itype_code_num"""
