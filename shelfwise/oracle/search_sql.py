"""DuckDB oracle for R14 full-text search (BM25 over matched query terms)."""


def _tokens(source: str, id_col: str, text_expr: str) -> str:
    return rf"""
SELECT id, pos, term FROM (
  SELECT {id_col} AS id, generate_subscripts(ws, 1) - 1 AS pos, unnest(ws) AS term
  FROM (SELECT {id_col}, string_split_regex(lower({text_expr}), '[^\p{{L}}\p{{N}}]+') AS ws FROM {source}))
WHERE term <> ''"""


def _lst(words) -> str:
    return ", ".join(f"'{w.lower()}'" for w in words)


def search_sql(tokens_sql: str, all_of=(), any_of=(), none_of=(), phrase=(), prefixes=()) -> tuple[list, str]:
    conds = [f"id IN (SELECT id FROM tok WHERE term = '{t.lower()}')" for t in all_of]
    if any_of:
        conds.append(f"id IN (SELECT id FROM tok WHERE term IN ({_lst(any_of)}))")
    if phrase:
        joins = " ".join(f"JOIN tok p{k} ON p{k}.id = p0.id AND p{k}.pos = p0.pos + {k} AND p{k}.term = '{w.lower()}'"
                         for k, w in enumerate(phrase[1:], start=1))
        conds.append(f"id IN (SELECT p0.id FROM tok p0 {joins} WHERE p0.term = '{phrase[0].lower()}')")
    conds += [f"id IN (SELECT id FROM tok WHERE starts_with(term, '{p.lower()}'))" for p in prefixes]
    conds += [f"id NOT IN (SELECT id FROM tok WHERE term = '{t.lower()}')" for t in none_of]
    terms = sorted({t.lower() for t in list(all_of) + list(any_of) + list(phrase)})
    ctes = [("tok", tokens_sql),
            ("st", "SELECT id, count(*) AS dl FROM tok GROUP BY id"),
            ("cand", "SELECT DISTINCT id FROM tok WHERE " + " AND ".join(conds)),
            ("dft", f"SELECT term, count(DISTINCT id) AS df FROM tok WHERE term IN ({_lst(terms)}) GROUP BY term"),
            ("tf", f"SELECT id, term, count(*) AS tf FROM tok WHERE term IN ({_lst(terms)}) "
                   "AND id IN (SELECT id FROM cand) GROUP BY id, term"),
            ("hits", """
SELECT c.id, coalesce(round(sum(ln(1 + ((SELECT count(*) FROM st) - d.df + 0.5) / (d.df + 0.5)) * tf.tf * 2.2
    / (tf.tf + 1.2 * (1 - 0.75 + 0.75 * s.dl / (SELECT avg(dl) FROM st)))), 6), 0.0) AS score
FROM cand c LEFT JOIN tf ON tf.id = c.id LEFT JOIN dft d ON d.term = tf.term LEFT JOIN st s ON s.id = c.id
GROUP BY c.id""")]
    return ctes, "hits"


def search_bibs_sql(**query) -> tuple[list, str]:
    tok = _tokens("x_bib", "bib_record_num",
                  "concat_ws(' ', coalesce(best_title, ''), coalesce(best_author, ''), "
                  "coalesce(array_to_string(indexed_subjects, ' '), ''))")
    ctes, hits = search_sql(tok, **query)
    final = f"""
SELECT h.id AS bib_record_num, b.best_title, b.best_author, h.score,
  (SELECT CAST(sum(i.checkout_total) AS BIGINT) FROM x_item i WHERE i.bib_record_num = h.id) AS total_checkouts
FROM {hits} h JOIN x_bib b ON b.bib_record_num = h.id"""
    return ctes, final


def search_documents_sql(**query) -> tuple[list, str]:
    ctes, hits = search_sql(_tokens("documents", "doc_id", "text"), **query)
    final = f"SELECT h.id AS doc_id, h.score, d.lang, d.source FROM {hits} h JOIN documents d ON d.doc_id = h.id"
    return ctes, final


def search_all_bib_columns_sql(**query) -> tuple[list, str]:
    texts = ["best_title", "best_author", "publisher", "CAST(publish_year AS VARCHAR)", "bib_level_callnumber",
             *(f"array_to_string({c}, ' ')" for c in ("isbn_values", "indexed_subjects", "genres", "item_types"))]
    ctes, hits = search_sql(_tokens("x_bib", "bib_record_num", "concat_ws(' ', " + ", ".join(texts) + ")"), **query)
    return ctes, f"SELECT h.id AS bib_record_num, b.best_title, h.score FROM {hits} h JOIN x_bib b ON b.bib_record_num = h.id"
