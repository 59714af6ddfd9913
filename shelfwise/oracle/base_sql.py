"""DuckDB oracle for the extraction operators (base tables), written as SQL.

These CTEs are an independent statement of the same semantics as
``shelfwise.operators.extract``; they run on the adapter relations.  Dates are
fixed: AS_OF is the reproducible "now" of every oracle.
"""

AS_OF = "2024-02-01"

JD = "(CAST(CAST({x} AS DATE) - DATE '1970-01-01' AS INTEGER) + 2440588)"


def jd(x: str) -> str:
    return JD.format(x=x)


BASE_CTES: list[tuple[str, str]] = [
    ("x_record_metadata", f"""
SELECT id AS record_id, record_num, record_type_code,
       {jd('creation_date_gmt')} AS creation_julianday,
       {jd('record_last_updated_gmt')} AS record_last_updated_julianday,
       {jd('deletion_date_gmt')} AS deletion_julianday
FROM record_metadata
WHERE record_type_code IN ('b', 'i', 'j') AND campus_code = ''
  AND (deletion_date_gmt >= TIMESTAMP '1969-01-01' OR record_last_updated_gmt >= TIMESTAMP '1969-01-01')"""),
    ("x_bib", """
WITH live_bibs AS (
  SELECT id, record_num FROM record_metadata
  WHERE record_type_code = 'b' AND campus_code = '' AND deletion_date_gmt IS NULL
    AND record_last_updated_gmt >= TIMESTAMP '1969-01-01'),
ctl AS (SELECT record_id, list(index_entry ORDER BY occurrence, id) AS vals FROM phrase_entry
        WHERE index_tag = 'o' AND varfield_type_code = 'o' GROUP BY record_id),
isbns AS (SELECT record_id, list(hit ORDER BY occ_num, id) AS vals FROM (
            SELECT record_id, occ_num, id,
                   regexp_extract(field_content, '(?i)([0-9]{12,13}x?|[0-9]{9,10}x?)', 1) AS hit
            FROM varfield WHERE marc_tag || varfield_type_code = '020i') WHERE hit <> '' GROUP BY record_id),
pub AS (SELECT record_id, first(content ORDER BY display_order, id) AS val FROM subfield
        WHERE field_type_code = 'p' AND tag = 'b' GROUP BY record_id),
cn AS (SELECT record_id, first(index_entry ORDER BY id) AS val FROM phrase_entry
       WHERE index_tag = 'c' AND varfield_type_code = 'c' GROUP BY record_id),
subj AS (SELECT record_id, list(index_entry ORDER BY occurrence, id) AS vals FROM phrase_entry
         WHERE index_tag = 'd' GROUP BY record_id),
gen AS (SELECT fld.record_id, list(sf.content ORDER BY sf.occ_num, sf.id) AS vals
        FROM varfield fld JOIN subfield sf ON sf.varfield_id = fld.id
        WHERE fld.varfield_type_code = 'j' AND sf.tag = 'a' GROUP BY fld.record_id),
fmt AS (SELECT bib_record_id AS record_id, list(name ORDER BY cnt DESC, name) AS vals FROM (
          SELECT lk.bib_record_id, tn.name, count(*) AS cnt FROM bib_record_item_record_link lk
          JOIN item_record itm ON itm.record_id = lk.item_record_id
          JOIN itype_property tp ON tp.code_num = itm.itype_code_num
          JOIN itype_property_name tn ON tn.itype_property_id = tp.id
          GROUP BY 1, 2) GROUP BY 1)
SELECT lb.record_num AS bib_record_num, lb.id AS bib_record_id, ctl.vals AS control_numbers,
  isbns.vals AS isbn_values, props.best_author, props.best_title, pub.val AS publisher, props.publish_year,
  cn.val AS bib_level_callnumber, subj.vals AS indexed_subjects, gen.vals AS genres, fmt.vals AS item_types,
  CAST(fixed.cataloging_date_gmt AS DATE) AS cataloging_date
FROM live_bibs lb
JOIN bib_record fixed ON fixed.record_id = lb.id
LEFT JOIN bib_record_property props ON props.bib_record_id = lb.id
LEFT JOIN ctl ON ctl.record_id = lb.id LEFT JOIN isbns ON isbns.record_id = lb.id
LEFT JOIN pub ON pub.record_id = lb.id LEFT JOIN cn ON cn.record_id = lb.id
LEFT JOIN subj ON subj.record_id = lb.id LEFT JOIN gen ON gen.record_id = lb.id
LEFT JOIN fmt ON fmt.record_id = lb.id"""),
    ("x_item", """
WITH live_items AS (
  SELECT id, record_num, creation_date_gmt, record_last_updated_gmt FROM record_metadata
  WHERE record_type_code = 'i' AND campus_code = '' AND deletion_date_gmt IS NULL
    AND record_last_updated_gmt >= TIMESTAMP '1969-01-01'),
type_names AS (
  SELECT prop.code_num, min(nm.name) AS fmt FROM itype_property prop
  JOIN itype_property_name nm ON nm.itype_property_id = prop.id GROUP BY prop.code_num),
home_branch AS (SELECT record_id, min(home_library_code) AS home FROM patron_record GROUP BY record_id),
vol_text AS (
  SELECT record_id, string_agg(field_content, ', ' ORDER BY occ_num, id) AS txt
  FROM varfield WHERE varfield_type_code = 'v' GROUP BY record_id)
SELECT li.record_num AS item_record_num, li.id AS item_record_id, bibrec.record_num AS bib_record_num,
  CAST(li.creation_date_gmt AS DATE) AS creation_date, CAST(li.record_last_updated_gmt AS DATE) AS record_last_updated,
  props.barcode, ir.agency_code_num, ir.location_code, ir.checkout_statistic_group_code_num,
  ir.checkin_statistics_group_code_num, CAST(co.checkout_gmt AS DATE) AS checkout_date,
  CAST(co.due_gmt AS DATE) AS due_date, hb.home AS patron_branch_code,
  CAST(ir.last_checkout_gmt AS DATE) AS last_checkout_date, CAST(ir.last_checkin_gmt AS DATE) AS last_checkin_date,
  ir.checkout_total, ir.renewal_total, tn.fmt AS item_format, ir.item_status_code,
  CAST(round(ir.price * 100) AS INTEGER) AS price_cents, props.call_number_norm AS item_callnumber,
  volrec.record_num AS volume_record_num, vt.txt AS volume_record_statement
FROM live_items li
JOIN item_record_property props ON props.item_record_id = li.id
JOIN item_record ir ON ir.record_id = li.id
JOIN bib_record_item_record_link bl ON bl.item_record_id = li.id
JOIN record_metadata bibrec ON bibrec.id = bl.bib_record_id
LEFT JOIN checkout co ON co.item_record_id = li.id
LEFT JOIN home_branch hb ON hb.record_id = co.patron_record_id
LEFT JOIN type_names tn ON tn.code_num = ir.itype_code_num
LEFT JOIN volume_record_item_record_link vil ON vil.item_record_id = li.id
LEFT JOIN record_metadata volrec ON volrec.id = vil.volume_record_id
LEFT JOIN vol_text vt ON vt.record_id = volrec.id"""),
    ("x_bib_record", """
SELECT b.id, b.record_id, b.language_code, b.bcode1, b.bcode2, b.bcode3, b.country_code,
  b.index_change_count, b.is_on_course_reserve, b.is_right_result_exact, b.allocation_rule_code,
  b.skip_num, CAST(b.cataloging_date_gmt AS DATE) AS cataloging_date_gmt, b.marc_type_code, b.is_suppressed
FROM bib_record b JOIN record_metadata r ON r.id = b.record_id
WHERE r.campus_code = '' AND r.record_last_updated_gmt >= TIMESTAMP '1969-01-01'"""),
    ("x_volume_record", f"""
WITH stmt AS (SELECT record_id, string_agg(field_content, ', ' ORDER BY occ_num, id) AS txt
              FROM varfield GROUP BY record_id)
SELECT vrec.id AS volume_record_id, vrec.record_num AS volume_record_num, brec.id AS bib_record_id,
  brec.record_num AS bib_record_num, {jd('vrec.creation_date_gmt')} AS creation_julianday,
  stmt.txt AS volume_statement
FROM volume_record vol
JOIN record_metadata vrec ON vrec.id = vol.record_id AND vrec.record_last_updated_gmt >= TIMESTAMP '1969-01-01'
JOIN bib_record_volume_record_link bv ON bv.volume_record_id = vol.record_id
JOIN record_metadata brec ON brec.id = bv.bib_record_id
LEFT JOIN stmt ON stmt.record_id = vol.record_id"""),
    ("x_item_message", f"""
WITH parsed AS (
  SELECT *, try_strptime(substr(stamp, 5), '%b %d %Y %I:%M%p') AS ts FROM (
    SELECT rec.id AS item_record_id, rec.campus_code, fld.id AS varfield_id, fld.occ_num, fld.field_content,
      regexp_matches(fld.field_content, '(?i)IN\\sTRANSIT') AS has_in_transit,
      regexp_matches(fld.field_content, '(?i)IN\\sTRANSIT\\sTOO\\sLONG') AS has_in_transit_too_long,
      nullif(regexp_extract(fld.field_content, '(?is).*IN\\sTRANSIT\\sfrom\\s([0-9a-z]+)\\sto\\s([0-9a-z]+)', 1), '') AS transit_from,
      nullif(regexp_extract(fld.field_content, '(?is).*IN\\sTRANSIT\\sfrom\\s([0-9a-z]+)\\sto\\s([0-9a-z]+)', 2), '') AS transit_to,
      nullif(regexp_extract(fld.field_content, '(?i)^[a-z]{{3}}\\s[a-z]{{1,3}}\\s[0-9]{{2}}\\s[0-9]{{4}}\\s[0-9]{{2}}:[0-9]{{2}}[AP]M', 0), '') AS stamp
    FROM record_metadata rec JOIN varfield fld ON fld.record_id = rec.id
    WHERE rec.record_type_code = 'i' AND fld.varfield_type_code = 'm')
  WHERE transit_from IS NOT NULL OR stamp IS NOT NULL),
status_names AS (SELECT sp.code, sn.name FROM item_status_property sp
                 LEFT JOIN item_status_property_name sn ON sn.item_status_property_id = sp.id),
type_names AS (SELECT tp.code_num, tn.name FROM itype_property tp
               LEFT JOIN itype_property_name tn ON tn.itype_property_id = tp.id)
SELECT prop.barcode AS item_barcode, pm.campus_code, prop.call_number, pm.item_record_id, pm.varfield_id,
  pm.has_in_transit, {jd('pm.ts')} AS in_transit_julianday,
  {jd("DATE '" + AS_OF + "'")} - {jd('pm.ts')} AS in_transit_days,
  pm.transit_from, pm.transit_to, pm.has_in_transit_too_long, pm.occ_num, pm.field_content,
  bp.publish_year, bp.best_title, bp.best_author, itm.item_status_code, sn.name AS item_status_name,
  itm.agency_code_num, itm.location_code, itm.itype_code_num, tn.name AS item_format,
  {jd('loan.due_gmt')} AS due_julianday, loan.loanrule_code_num, {jd('loan.checkout_gmt')} AS checkout_julianday,
  loan.renewal_count, loan.overdue_count, {jd('loan.overdue_gmt')} AS overdue_julianday
FROM parsed pm
LEFT JOIN item_record_property prop ON prop.item_record_id = pm.item_record_id
LEFT JOIN item_record itm ON itm.record_id = pm.item_record_id
LEFT JOIN checkout loan ON loan.item_record_id = itm.record_id
LEFT JOIN status_names sn ON sn.code = itm.item_status_code
LEFT JOIN bib_record_item_record_link bl ON bl.item_record_id = pm.item_record_id
LEFT JOIN bib_record_property bp ON bp.bib_record_id = bl.bib_record_id
LEFT JOIN type_names tn ON tn.code_num = itm.itype_code_num"""),
    ("x_language_property", """
SELECT p.id, p.code, p.display_order, n.name FROM language_property p
JOIN language_property_name n ON n.language_property_id = p.id"""),
    ("x_bib_record_item_record_link", """
SELECT l.id, l.bib_record_id, r.record_num AS bib_record_num, l.item_record_id,
  ir.record_num AS item_record_num, l.items_display_order, l.bibs_display_order
FROM bib_record_item_record_link l
JOIN record_metadata r ON r.id = l.bib_record_id
JOIN record_metadata ir ON ir.id = l.item_record_id"""),
    ("x_volume_record_item_record_link", """
WITH statements AS (
  SELECT record_id, string_agg(field_content, ', ' ORDER BY occ_num, id) AS txt
  FROM varfield WHERE varfield_type_code = 'v' GROUP BY record_id),
volumes AS (
  SELECT m.id, m.record_num, st.txt FROM record_metadata m LEFT JOIN statements st ON st.record_id = m.id
  WHERE m.record_type_code = 'j' AND m.campus_code = '')
SELECT l.id, l.volume_record_id, volumes.record_num AS volume_record_num, items.id AS item_record_id,
  items.record_num AS item_record_num, l.items_display_order, volumes.txt AS volume_statement
FROM volume_record_item_record_link l
JOIN volumes ON volumes.id = l.volume_record_id
LEFT JOIN record_metadata items ON items.id = l.item_record_id"""),
    ("x_location", "SELECT id, code, branch_code_num, parent_location_code, is_public, is_requestable FROM location"),
    ("x_location_name", "SELECT location_id, name FROM location_name"),
    ("x_branch_name", "SELECT branch_id, name FROM branch_name"),
    ("x_branch", """SELECT id, address, email_source, email_reply_to, address_latitude, address_longitude, code_num
FROM branch"""),
    ("x_country_property_myuser", "SELECT code, display_order, name FROM country_property_myuser"),
    ("x_item_status_property", """
SELECT isp.code AS item_status_code, isp.display_order, n.name AS item_status_name
FROM item_status_property isp JOIN item_status_property_name n ON n.item_status_property_id = isp.id"""),
    ("x_itype_property", """
SELECT ip.code_num AS itype_code, ip.display_order, n.name AS itype_name, pf.name AS physical_format_name
FROM itype_property ip JOIN itype_property_name n ON n.itype_property_id = ip.id
LEFT JOIN physical_format_name pf ON pf.physical_format_id = ip.physical_format_id"""),
    ("x_bib_level_property", """
SELECT p.code AS bib_level_property_code, p.display_order, n.name AS bib_level_property_name
FROM bib_level_property p LEFT JOIN bib_level_property_name n ON n.bib_level_property_id = p.id"""),
    ("x_material_property", """
SELECT p.code AS material_property_code, p.display_order, p.is_public, n.name AS material_property_name
FROM material_property p LEFT JOIN material_property_name n ON n.material_property_id = p.id"""),
    ("x_hold", f"""
WITH targets AS (
  -- What a hold can be placed on, with the (first) bib it belongs to.
  SELECT id AS record_id, record_num AS bib_record_num,
         CAST(NULL AS BIGINT) AS item_record_num, CAST(NULL AS BIGINT) AS volume_record_num
  FROM record_metadata WHERE record_type_code = 'b'
  UNION ALL
  SELECT i.id, min(b.record_num), any_value(i.record_num), NULL
  FROM record_metadata i
  LEFT JOIN bib_record_item_record_link l ON l.item_record_id = i.id
  LEFT JOIN record_metadata b ON b.id = l.bib_record_id
  WHERE i.record_type_code = 'i' GROUP BY i.id
  UNION ALL
  SELECT v.id, min(b.record_num), NULL, any_value(v.record_num)
  FROM record_metadata v
  LEFT JOIN bib_record_volume_record_link l ON l.volume_record_id = v.id
  LEFT JOIN record_metadata b ON b.id = l.bib_record_id
  WHERE v.record_type_code = 'j' GROUP BY v.id),
status_text(code, txt) AS (VALUES ('0', 'on hold'), ('b', 'bib hold ready for pickup'),
  ('j', 'volume hold ready for pickup'), ('i', 'item hold ready for pickup'),
  ('t', 'in transit to pickup location'))
SELECT hq.id AS hold_id,
  tg.bib_record_num, rec.campus_code, rec.record_type_code AS record_type_on_hold,
  tg.item_record_num, tg.volume_record_num,
  {jd('hq.placed_gmt')} AS placed_julianday, hq.is_frozen, hq.delay_days, hq.location_code,
  {jd('hq.expires_gmt')} AS expires_julianday, coalesce(st.txt, hq.status) AS hold_status,
  hq.is_ir, hq.is_ill, hq.pickup_location_code, hq.ir_pickup_location_code, hq.ir_print_name,
  hq.ir_delivery_stop_name, hq.is_ir_converted_request,
  coalesce(pat.activity_gmt >= TIMESTAMP '{AS_OF}' - INTERVAL 3 YEAR, FALSE) AS patron_is_active,
  pat.ptype_code AS patron_ptype_code, pat.home_library_code AS patron_home_library_code,
  pat.mblock_code AS patron_mblock_code, coalesce(pat.owed_amt > 10, FALSE) AS patron_has_over_10usd_owed
FROM hold hq
JOIN record_metadata rec ON rec.id = hq.record_id
LEFT JOIN patron_record pat ON pat.record_id = hq.patron_record_id
LEFT JOIN targets tg ON tg.record_id = hq.record_id
LEFT JOIN status_text st ON st.code = hq.status"""),
    ("x_circ_agg", f"""
WITH places AS (
  SELECT grp.code_num AS stat_group_code_num, gname.name AS stat_group_name, loc.branch_code_num,
         bname.name AS branch_name
  FROM statistic_group grp
  JOIN statistic_group_name gname ON gname.statistic_group_id = grp.id
  JOIN location loc ON loc.code = grp.location_code
  JOIN branch br ON br.code_num = loc.branch_code_num
  JOIN branch_name bname ON bname.branch_id = br.id),
daily AS (
  SELECT strftime(tr.transaction_gmt, '%Y-%m-%d') AS transaction_day, tr.stat_group_code_num, tr.op_code,
    tr.itype_code_num, tr.loanrule_code_num, count(*) AS count_op_code,
    count(DISTINCT tr.patron_record_id) AS count_distinct_patrons
  FROM circ_trans tr
  WHERE tr.op_code IN ('o', 'i', 'f')
    AND tr.transaction_gmt > date_trunc('month', TIMESTAMP '{AS_OF}') - INTERVAL 6 MONTH
  GROUP BY ALL)
SELECT daily.*, places.stat_group_name, places.branch_code_num, places.branch_name
FROM daily JOIN places USING (stat_group_code_num)"""),
    ("x_circ_leased_items", f"""
WITH leased AS (
  SELECT p.item_record_id FROM item_record_property p JOIN record_metadata m ON m.id = p.item_record_id
  WHERE m.campus_code = '' AND p.barcode >= 'L000000000000' AND p.barcode < 'M'),
groups AS (
  SELECT grp.code_num, gname.name AS group_name, grp.location_code AS group_location, bname.name AS group_branch
  FROM statistic_group grp
  LEFT JOIN statistic_group_name gname ON gname.statistic_group_id = grp.id
  LEFT JOIN location loc ON loc.code = grp.location_code
  LEFT JOIN branch br ON br.code_num = loc.branch_code_num
  LEFT JOIN branch_name bname ON bname.branch_id = br.id),
nums AS (SELECT id, record_num FROM record_metadata)
SELECT tr.id, strftime(tr.transaction_gmt, '%Y-%m-%d') AS transaction_day, tr.stat_group_code_num,
  g.group_name AS stat_group_name, g.group_location AS stat_group_location_code,
  g.group_branch AS stat_group_branch_name, tr.op_code, tr.application_name,
  strftime(tr.due_date_gmt, '%Y-%m-%d') AS due_date, tr.item_record_id, ni.record_num AS item_record_num,
  pr.barcode, tr.bib_record_id, nb.record_num AS bib_record_num, tr.volume_record_id,
  nv.record_num AS volume_record_num, tr.itype_code_num, tr.item_location_code, tr.ptype_code,
  tr.patron_home_library_code, tr.patron_agency_code_num, tr.loanrule_code_num
FROM circ_trans tr
SEMI JOIN leased ON leased.item_record_id = tr.item_record_id
LEFT JOIN groups g ON g.code_num = tr.stat_group_code_num
LEFT JOIN nums ni ON ni.id = tr.item_record_id
LEFT JOIN item_record_property pr ON pr.item_record_id = tr.item_record_id
LEFT JOIN nums nb ON nb.id = tr.bib_record_id
LEFT JOIN nums nv ON nv.id = tr.volume_record_id
WHERE tr.op_code IN ('o', 'i') AND tr.transaction_gmt > TIMESTAMP '{AS_OF}' - INTERVAL 180 DAY"""),
]
