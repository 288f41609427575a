"""The same queries in SQL, from the base columns: what was rendered to text is not parsed back.

``f`` holds the facts behind each rendered filing, ``l`` those behind each line.
"""

from __future__ import annotations

# Remainders that spoil a field of a filing, and the message the spoiled text gives.
_F = """
f AS (
  SELECT o_orderkey AS k,
         o_orderkey AS orderkey,
         CAST(o_custkey AS VARCHAR) AS company_id,
         (o_orderkey // 50) * 1099511627776 + o_orderkey % 50 + 1 AS filing_pos,
         o_custkey * 8 + o_orderkey % 8 AS number,
         CASE WHEN o_orderkey % 2 = 0 THEN replace(format('{:,}', o_custkey * 8 + o_orderkey % 8), ',', '.')
              ELSE CAST(o_custkey * 8 + o_orderkey % 8 AS VARCHAR) END AS document_id,
         CAST(last_day(CAST(date_trunc('quarter', o_orderdate) AS DATE) + INTERVAL 2 MONTH) AS DATE) AS quarter_end,
         CAST(last_day(CAST(o_orderdate AS DATE)) AS DATE) AS month_end,
         o_orderdate + to_minutes(o_orderkey % 1440) AS moment,
         o_totalprice AS price,
         list_extract(['TRIMESTRAL', '3', 'ANUAL', 'IRREGULAR', 'anual'], o_orderkey % 5 + 1) AS d_period,
         list_extract(['Quarter', 'Quarter', 'Annual', 'Irregular', NULL], o_orderkey % 5 + 1) AS d_period_en,
         list_extract(['CONSOLIDADO', 'INDIVIDUAL', 'INDIVIDUAL'], o_orderkey % 3 + 1) AS d_type,
         list_extract(['Consolidated', 'Separate', 'Separate'], o_orderkey % 3 + 1) AS d_type_en,
         list_extract(['NIIF', 'RT', 'NORMAS CONTABLES PROFESIONALES', 'XX'], o_orderkey % 4 + 1) AS d_standard,
         list_extract(['IFRS', 'Argentine GAAP (RT)', 'Argentine GAAP', NULL], o_orderkey % 4 + 1) AS d_standard_en,
         list_extract(['Quarter', 'Annual', 'Semester', NULL, NULL, 'Irregular'], o_orderkey % 6 + 1) AS m_period_en,
         list_extract([NULL, 'Consolidated', 'Separate', NULL], o_orderkey % 4 + 1) AS m_type_en,
         list_extract(['IFRS', 'Argentine GAAP (RT)', NULL], o_orderkey % 3 + 1) AS m_standard_en,
         list_extract([1.0, 1.0, 1000.0, 1000.0, 1000000.0, 1000000.0]::DOUBLE[], o_orderkey % 6 + 1) AS unit,
         list_extract(['Si', 'Sí', 'No'], o_orderkey % 3 + 1) AS merger,
         list_extract(['true', 'true', 'false'], o_orderkey % 3 + 1) AS merger_en
  FROM orders
),
fd AS (
  SELECT *,
         CASE WHEN k % 11 > 0 THEN quarter_end END AS stated_date,
         CASE WHEN k % 7 > 1 THEN month_end END AS form_date,
         CASE WHEN k % 11 = 0 THEN 'SIN FECHA' ELSE 'FECHA CIERRE: ' || strftime(quarter_end, '%Y-%m-%d') END
           || ' - PERIODICIDAD: ' || d_period || ' - TIPO BALANCE: ' || d_type
           || ' - NORMA CONTABLE: ' || d_standard
           || CASE WHEN k % 13 = 0 THEN ' - otros idiomas' WHEN k % 17 = 0 THEN ' - Relac.: Controlada' ELSE '' END
           AS document_description,
         'https://filings.example.com/d/' || k AS document_link,
         CASE WHEN k % 37 = 0 THEN '30 feb. 2025 01:02'
              ELSE CAST(day(moment) AS VARCHAR) || ' '
                || list_extract(['ene.', 'feb.', 'mar.', 'abr.', 'may.', 'jun.', 'jul.', 'ago.', 'sep.', 'oct.', 'nov.', 'dic.'], month(moment))
                || ' ' || strftime(moment, '%Y %H:%M') END AS submission_date,
         concat_ws('; ',
           CASE WHEN k % 37 = 0 THEN 'submission_date: 30 feb. 2025 01:02' END,
           CASE WHEN m_period_en IS NULL AND d_period_en IS NULL
                THEN 'reporting_period: ' || list_extract(['', 'Otro'], k % 6 - 2) END,
           CASE WHEN k % 7 < 2 AND k % 11 = 0
                THEN 'period_end_date: ' || list_extract(['', '31/2/2024'], k % 7 + 1) END,
           CASE WHEN m_standard_en IS NULL AND d_standard_en IS NULL THEN 'accounting_standards_applied: ' END,
           CASE WHEN k % 43 = 0 THEN 'merger_or_demerger_in_process: SI' END,
           CASE WHEN k % 47 = 0 THEN 'equity_share_price_at_period_end:  ' END,
           CASE WHEN k % 53 = 0 THEN 'number_of_employees: 12,5' END,
           CASE WHEN k % 41 = 0 THEN 'unit_of_measure: miles de $' END
         ) AS field_errors
  FROM f
)"""

_L = """
l AS (
  SELECT l_orderkey AS orderkey,
         (l_suppkey * 8 + l_linenumber) * 1099511627776 + l_partkey * 64 + CAST(l_quantity AS BIGINT) AS pos,
         list_extract(['CAJA Y BANCOS', 'VENTAS', 'Costo de lo Vendido', 'resultado del año', 'Ventas', 'Otras partidas', 'NOTA'], l_linenumber) AS label,
         list_extract(['Cash', 'Sales', 'CostOfGoods', 'YearResult', 'Sales', 'Otras partidas', 'NOTA'], l_linenumber) AS concept,
         CASE WHEN l_partkey % 997 > 0 THEN l_extendedprice END AS amount,
         CASE WHEN l_linenumber <> 7 OR l_suppkey % 89 > 0 THEN CAST(l_linenumber AS BIGINT) END AS line_order
  FROM lineitem
)"""

# Judgement of statements: {source} is the relation of filings.
_JUDGED = """
bad AS (
  SELECT orderkey, count(*) FILTER (amount IS NULL) AS amounts, count(*) FILTER (line_order IS NULL) AS orders
  FROM l GROUP BY orderkey
),
judged AS (
  SELECT s.*, concat_ws('; ', nullif(s.field_errors, ''),
           CASE WHEN bad.amounts > 0 THEN 'value: unreadable lines: ' || bad.amounts END,
           CASE WHEN bad.orders > 0 THEN 'id: unreadable lines: ' || bad.orders END) AS errors
  FROM {source} s LEFT JOIN bad USING (orderkey)
),
accepted AS (
  SELECT *, min(filing_pos) OVER (PARTITION BY company_id, number) AS statement_pos
  FROM judged WHERE errors = ''
  QUALIFY filing_pos = max(filing_pos) OVER (PARTITION BY company_id, number)
),
lines AS (
  SELECT orderkey, concept, arg_max(amount, pos) AS amount, arg_max(line_order, pos) AS line_order, min(pos) AS pos
  FROM l GROUP BY orderkey, concept
),
vals AS (
  SELECT a.company_id, a.number AS document_id, lines.line_order AS "order", lines.concept,
         a.unit * lines.amount AS value, a.statement_pos, lines.pos
  FROM lines JOIN accepted a USING (orderkey)
)"""

_EXCLUDED = "k % 13 > 0 AND k % 17 > 0"

_CHOSEN = f"""
found AS (SELECT * FROM fd WHERE {_EXCLUDED}),
chosen AS (
  SELECT * EXCLUDE (alike) FROM (
    SELECT *, count(*) OVER (PARTITION BY company_id, stated_date) AS alike FROM found
  ) WHERE stated_date IS NULL OR alike = 1 OR d_type_en <> 'Separate'
)"""

_FILING_COLUMNS = "company_id, document_id, document_description, document_link, submission_date, filing_pos"

_STATEMENT_COLUMNS = """
company_id, number AS document_id, document_description, document_link,
strftime(moment, '%Y-%m-%d %H:%M:%S') AS submission_date,
coalesce(m_period_en, d_period_en) AS reporting_period,
strftime(coalesce(form_date, stated_date), '%Y-%m-%d') AS period_end_date,
coalesce(m_type_en, d_type_en) AS financial_statements_type,
CASE WHEN k % 19 > 0 THEN 'Pesos' ELSE '' END AS presentation_currency,
coalesce(m_standard_en, d_standard_en) AS accounting_standards_applied,
merger_en AS merger_or_demerger_in_process,
CASE WHEN k % 2 = 0 THEN 'true' ELSE 'false' END AS treasury_shares,
'false' AS insolvency_proceedings,
'true' AS public_offering_of_equity_instruments,
CAST(floor(price) AS BIGINT) AS subscribed_shares_at_period_end,
price AS equity_share_price_at_period_end,
(k % 10000) / 100.0::DOUBLE AS free_float_percentage,
k % 5000 AS number_of_employees
"""

_REGISTRY = """
r AS (
  SELECT c_custkey AS registry_row,
         CASE WHEN c_custkey % 23 > 0 THEN CAST(c_custkey AS VARCHAR) END AS company_id,
         CASE WHEN c_custkey % 29 > 0 THEN c_name END AS name,
         CASE WHEN c_custkey % 31 > 0
              THEN 'T' || (c_custkey - CASE WHEN c_custkey % 10 = 9 THEN 1 ELSE 0 END) END AS ticker,
         c_mktsegment AS sector, CAST(c_nationkey AS VARCHAR) AS industry
  FROM customer
),
companies AS (
  SELECT *, min(registry_row) OVER (PARTITION BY ticker) AS registry_pos
  FROM r WHERE company_id IS NOT NULL AND name IS NOT NULL
  QUALIFY registry_row = max(registry_row) OVER (PARTITION BY ticker)
)"""

#: Stands for a missing text, which no text can be.
NULL = "\x00"

# What the rendered value pages show. Of the captures of a page the longer one counts.
_PAGES = """
all_lines AS (
  SELECT l_orderkey AS k, CAST(ceil(l_linenumber / 2) AS INTEGER) AS page_no,
         row_number() OVER (PARTITION BY l_orderkey, ceil(l_linenumber / 2)
                            ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice)::INTEGER - 1 AS row_no,
         list_extract(['CAJA Y BANCOS', 'VENTAS', 'Costo de lo Vendido', 'resultado del año', 'Ventas', 'Otras partidas', 'NOTA'], l_linenumber) AS label,
         CASE WHEN l_orderkey % 73 = 0 AND l_linenumber = 1 THEN NULL ELSE replace(format('{:.2f}', l_extendedprice), '.', ',') END AS value,
         CAST(l_linenumber AS VARCHAR) AS id
  FROM lineitem
),
last_pages AS (SELECT k, max(page_no) AS last_page FROM all_lines GROUP BY k),
empty_pages AS (SELECT k, last_page + 1 AS page_no FROM last_pages WHERE k % 61 = 0 AND NOT (k % 59 = 0 AND last_page = 0)),
shown AS (
  SELECT * FROM all_lines JOIN (SELECT k, company_id, filing_pos, document_id FROM fd) USING (k)
  WHERE NOT (k % 59 = 0 AND page_no = 1)
),
there AS (SELECT k, page_no FROM shown UNION SELECT k, page_no FROM empty_pages),
wanted AS (SELECT k, last_page + CASE WHEN k % 61 = 0 THEN 1 ELSE 0 END AS pages FROM last_pages),
judged_pages AS (
  SELECT fd.k, fd.company_id, fd.document_id, fd.filing_pos,
         concat_ws('; ',
           CASE WHEN n.pages IS NULL THEN 'capture: missing' END,
           CASE WHEN fd.k % 71 > 0 AND n.pages < wanted.pages THEN 'capture: page missing' END,
           CASE WHEN fd.k % 71 > 0 AND fd.k % 61 = 0 AND n.pages IS NOT NULL THEN 'capture: page empty' END,
           CASE WHEN fd.k % 71 > 0 AND fd.k IN (SELECT k FROM shown WHERE value IS NULL) THEN 'capture: line cut short' END
         ) AS errors
  FROM fd LEFT JOIN (SELECT k, count(*) AS pages FROM there GROUP BY k) n USING (k) LEFT JOIN wanted USING (k)
),
failed AS (SELECT * FROM judged_pages WHERE errors <> '')"""

_CLEAN = f"WITH {_F},{_L},{_JUDGED.format(source='fd')}"
_CLEAN_CHOSEN = f"WITH {_F},{_L},{_CHOSEN},{_JUDGED.format(source='chosen')}"

ORACLE: dict[str, str] = {
    "es_number_parse": """
SELECT (l_suppkey * 8 + l_linenumber) * 1099511627776 + l_partkey * 64 + CAST(l_quantity AS BIGINT) AS pos,
       l_orderkey AS order_key,
       CASE WHEN l_partkey % 997 > 0 THEN l_extendedprice ELSE -1.0 END AS price,
       -l_quantity AS returned
FROM lineitem""",
    "es_datetime_parse": f"""
WITH {_F}
SELECT orderkey, CASE WHEN k % 37 = 0 THEN '' ELSE strftime(moment, '%Y-%m-%d %H:%M:%S') END AS submitted
FROM fd""",
    "metadata_date_parse": f"""
WITH {_F}
SELECT orderkey,
       coalesce(strftime(form_date, '%Y-%m-%d'), '') AS form_date,
       coalesce(strftime(stated_date, '%Y-%m-%d'), '') AS stated_date,
       coalesce(strftime(coalesce(form_date, stated_date), '%Y-%m-%d'), '') AS period_end
FROM fd""",
    "description_fields": f"""
WITH {_F}
SELECT orderkey, coalesce(strftime(stated_date, '%Y-%m-%d'), '') AS period_end,
       coalesce(d_period_en, '') AS period, d_type_en AS type, coalesce(d_standard_en, '') AS standard
FROM fd""",
    "resolved_fields": f"""
WITH {_F}
SELECT orderkey, coalesce(m_period_en, '') AS form_period, coalesce(m_type_en, '') AS form_type,
       coalesce(m_standard_en, '') AS form_standard,
       coalesce(m_period_en, d_period_en, '') AS period,
       coalesce(m_type_en, d_type_en, '') AS type,
       coalesce(m_standard_en, d_standard_en, '') AS standard
FROM fd""",
    "flag_parse": f"""
WITH {_F}
SELECT orderkey, CASE WHEN k % 43 = 0 THEN '' ELSE merger_en END AS merger,
       CASE WHEN k % 2 = 0 THEN 'true' ELSE 'false' END AS treasury
FROM fd""",
    "first_non_empty": """
SELECT c_custkey,
       coalesce(CASE WHEN c_custkey % 3 = 1 THEN c_mktsegment END, CASE WHEN c_custkey % 5 > 0 THEN c_name END, '') AS found
FROM customer""",
    "exclude_filings": f"WITH {_F} SELECT {_FILING_COLUMNS} FROM fd WHERE {_EXCLUDED}",
    "exclude_documents": """
SELECT doc_id, lang, source FROM documents
WHERE NOT (contains(lower(text), 'ertion') OR contains(lower(text), 'eaux')
           OR contains(lower(text), 'und d') OR contains(lower(text), 'entre'))""",
    "exclude_many_phrases": """
WITH words AS (
  SELECT string_split(lower(text), ' ') AS w FROM conversations
  UNION ALL SELECT string_split(lower(text), ' ') FROM benchmark
), phrases AS (
  SELECT DISTINCT w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS phrase
  FROM (SELECT w, unnest(range(1, len(w) - 1)) AS i FROM words)
)
SELECT doc_id, lang, source FROM documents AS d
WHERE NOT EXISTS (SELECT 1 FROM phrases AS p WHERE contains(lower(d.text), p.phrase))""",
    "date_bounded_filings": f"""
WITH {_F}
SELECT company_id, filing_pos, CASE WHEN k % 37 = 0 THEN '' ELSE strftime(moment, '%d/%m/%Y') END AS submitted
FROM fd
WHERE k % 37 = 0 OR CAST(moment AS DATE) BETWEEN DATE '1996-01-01' AND DATE '1998-06-30'""",
    "listing_requests": f"""
WITH {_REGISTRY}
SELECT company_id,
       'Empresa/' || company_id || '?formType=INFOFI&fdesde=01/01/1996&fhasta=30/06/1998' AS request
FROM companies""",
    "index_rows": f"""
WITH {_F}
SELECT {_FILING_COLUMNS} FROM fd
WHERE company_id NOT IN (SELECT company_id FROM fd WHERE k % 101 = 0)""",
    "stored_index_filings": f"""
WITH {_F},{_REGISTRY},
dated AS (
  SELECT * FROM fd
  WHERE (k % 37 = 0 OR CAST(moment AS DATE) BETWEEN DATE '1996-01-01' AND DATE '1998-06-30')
    AND company_id IN (SELECT company_id FROM companies)
)
SELECT {_FILING_COLUMNS} FROM dated
WHERE company_id NOT IN (SELECT company_id FROM dated WHERE k % 101 = 0)""",
    "failed_listings": f"""
WITH {_F}
SELECT DISTINCT company_id, 'listing' AS stage, 'index: link missing' AS errors FROM fd WHERE k % 101 = 0""",
    "drop_separate_set": f"""
WITH {_F}
SELECT {_FILING_COLUMNS} FROM (
  SELECT *, count(*) OVER (PARTITION BY company_id, stated_date) AS alike FROM fd
) WHERE stated_date IS NULL OR alike = 1 OR d_type_en <> 'Separate'""",
    "drop_separate_sequential": f"""
WITH {_F},
flagged AS (
  SELECT *, stated_date IS NOT NULL AND d_type_en = 'Separate'
            AND count(*) OVER (PARTITION BY company_id, stated_date) > 1 AS flag
  FROM fd
),
islands AS (
  SELECT *, count(*) FILTER (NOT flag) OVER (PARTITION BY company_id ORDER BY filing_pos) AS island FROM flagged
),
placed AS (
  SELECT *, count(*) FILTER (flag) OVER (PARTITION BY company_id, island ORDER BY filing_pos) AS place FROM islands
)
SELECT {_FILING_COLUMNS} FROM placed WHERE NOT (flag AND place % 2 = 1)""",
    "map_concepts": f"""
WITH {_L}
SELECT orderkey, pos, label, concept, coalesce(line_order, -1) AS "order" FROM l""",
    "unmapped_labels": f"""
WITH {_L}
SELECT label, count(*) AS n_lines FROM l
WHERE NOT EXISTS (
  SELECT 1 FROM (VALUES ('CAJA Y BANCOS'), ('VENTAS'), ('COSTO DE LO VENDIDO'), ('RESULTADO DEL AÑO')) AS t(known)
  WHERE known = upper(label))
GROUP BY label""",
    "scaled_values": f"""
WITH {_F},{_L}
SELECT l.orderkey, l.pos, fd.unit * l.amount AS value
FROM l JOIN fd USING (orderkey) WHERE l.amount IS NOT NULL AND fd.k % 41 > 0""",
    "concept_last_wins": f"""
WITH {_F},{_L}
SELECT fd.company_id, fd.filing_pos, concept,
       coalesce(arg_max_null(amount, pos), -1.0) AS amount,
       coalesce(arg_max_null(line_order, pos), -1) AS "order",
       min(pos) AS pos
FROM l JOIN fd USING (orderkey) GROUP BY ALL""",
    "statement_last_wins": f"""
WITH {_F}
SELECT company_id, number AS document_id, document_description, document_link, submission_date, filing_pos,
       min(filing_pos) OVER (PARTITION BY company_id, number) AS statement_pos
FROM fd QUALIFY filing_pos = max(filing_pos) OVER (PARTITION BY company_id, number)""",
    "merged_statements": f"""
WITH {_F}
SELECT company_id, number AS document_id, document_description, document_link, submission_date, filing_pos,
       min(filing_pos) OVER (PARTITION BY company_id, number) AS statement_pos
FROM fd QUALIFY filing_pos = max(filing_pos) OVER (PARTITION BY company_id, number)""",
    "registry_load": f"""
WITH {_REGISTRY}
SELECT company_id, name, coalesce(ticker, '') AS ticker, '' AS description, sector, '' AS industry_group,
       industry, '' AS sub_industry, '' AS sub_industry_description, registry_pos
FROM companies""",
    "registry_rejects": f"""
WITH {_REGISTRY}
SELECT coalesce(company_id, '') AS company_id, 'registry' AS stage,
       concat_ws('; ', CASE WHEN company_id IS NULL THEN 'company_id: missing' END,
                       CASE WHEN name IS NULL THEN 'name: missing' END) AS errors
FROM r WHERE company_id IS NULL OR name IS NULL""",
    "clean_statements": f"{_CLEAN} SELECT {_STATEMENT_COLUMNS}, filing_pos, statement_pos FROM accepted",
    "clean_values": f"{_CLEAN} SELECT * FROM vals",
    "rejected_statements": f"""
{_CLEAN} SELECT company_id, document_id, filing_pos, 'clean' AS stage, errors FROM judged WHERE errors <> ''""",
    "rejected_lines": f"""
WITH {_F}, {_L}
SELECT * FROM (
  SELECT company_id, filing_pos, (pos // 1099511627776)::INT AS page_no, (pos % 1099511627776)::INT AS row_no, label,
         concat_ws('; ', CASE WHEN amount IS NULL THEN 'value: n/d' END, CASE WHEN line_order IS NULL THEN 'id: 7,5' END) AS errors,
         (row_number() OVER (PARTITION BY company_id, filing_pos ORDER BY pos))::INT AS line,
         count(*) OVER (PARTITION BY company_id, filing_pos) AS bad_lines
  FROM l JOIN f USING (orderkey) WHERE amount IS NULL OR line_order IS NULL
) WHERE line <= 10""",
    "export_failures": """
SELECT CAST(s_nationkey AS VARCHAR) AS nation,
       count(l_orderkey) FILTER (s_nationkey NOT IN (7, 18)) AS n_lines,
       coalesce(sum(l_orderkey) FILTER (s_nationkey NOT IN (7, 18)), 0)::BIGINT AS orders,
       (s_nationkey IN (7, 18))::INT AS failed
FROM supplier LEFT JOIN lineitem ON l_suppkey = s_suppkey GROUP BY s_nationkey""",
    "company_metadata_kv": f"""
{_CLEAN},{_REGISTRY}
SELECT company_id, coalesce(ticker, '') AS ticker, field_pos, field, value FROM (
  SELECT company_id, ticker,
         unnest(range(9))::INTEGER AS field_pos,
         unnest(['id', 'name', 'ticker', 'description', 'sector', 'industry_group', 'industry',
                 'sub_industry', 'sub_industry_description']) AS field,
         unnest([company_id, name, coalesce(ticker, ''), '', sector, '', industry, '', '']) AS value
  FROM companies WHERE company_id IN (SELECT company_id FROM accepted)
)""",
    "statement_metadata_export": f"""
{_CLEAN},
typed AS (SELECT {_STATEMENT_COLUMNS}, statement_pos FROM accepted)
SELECT company_id, document_id, document_description, submission_date, period_end_date, reporting_period,
       financial_statements_type, presentation_currency AS currency,
       accounting_standards_applied AS accounting_standards, merger_or_demerger_in_process, treasury_shares,
       insolvency_proceedings, public_offering_of_equity_instruments,
       subscribed_shares_at_period_end AS subscribed_shares, equity_share_price_at_period_end AS share_price,
       free_float_percentage, number_of_employees, statement_pos
FROM typed""",
    "statement_values_export": f"{_CLEAN_CHOSEN} SELECT * FROM vals",
    "display_format": """
SELECT format('{:,}', l_orderkey) AS l_orderkey, format('{:,}', l_partkey) AS l_partkey,
       format('{:,}', l_suppkey) AS l_suppkey, format('{:,}', l_linenumber) AS l_linenumber,
       format('{:,.2f}', l_extendedprice) AS l_extendedprice,
       strftime(l_shipdate, '%Y-%m-%d %H:%M') AS l_shipdate,
       strftime(l_shipdate, '%Y-%m-%d') AS ship_day,
       CASE WHEN l_returnflag = 'R' THEN 'TRUE' ELSE 'FALSE' END AS is_returned
FROM lineitem""",
    "run_report": f"""
{_CLEAN_CHOSEN},
counted AS (
  SELECT company_id, 1 AS a, 0 AS b, 0 AS c, 0 AS d, 0 AS e FROM found
  UNION ALL SELECT company_id, 0, 1, 0, 0, 0 FROM chosen
  UNION ALL SELECT company_id, 0, 0, 1, 0, 0 FROM judged WHERE errors <> ''
  UNION ALL SELECT company_id, 0, 0, 0, 1, 0 FROM accepted
  UNION ALL SELECT company_id, 0, 0, 0, 0, 1 FROM vals
)
SELECT company_id, CAST(sum(a) AS BIGINT) AS filings_found, CAST(sum(b) AS BIGINT) AS filings_kept,
       CAST(sum(c) AS BIGINT) AS statements_rejected, CAST(sum(d) AS BIGINT) AS statements_exported,
       CAST(sum(e) AS BIGINT) AS values_exported
FROM counted GROUP BY company_id""",
    "page_links": r"""
WITH a AS (
  SELECT page_id, regexp_extract_all(html, '(?is)<a\s[^>]*?href="[^"]*"[^>]*>.*?</a>') AS anchors FROM pages
),
one AS (
  SELECT page_id, unnest(range(len(anchors)))::INTEGER AS link_no, unnest(anchors) AS anchor FROM a
)
SELECT page_id, link_no,
       regexp_extract(anchor, '(?is)href="([^"]*)"', 1) AS href,
       trim(regexp_replace(regexp_replace(regexp_extract(anchor, '(?is)^<a\s[^>]*>(.*)</a>$', 1), '<[^>]*>', '', 'g'), '\s+', ' ', 'g')) AS text
FROM one""",
    "page_links_absolute": r"""
WITH one AS (
  SELECT page_id, url, unnest(regexp_extract_all(html, '(?is)<a\s[^>]*?href="([^"]*)"', 1)) AS href,
         unnest(range(len(regexp_extract_all(html, '(?is)<a\s[^>]*?href="([^"]*)"', 1))))::INTEGER AS link_no
  FROM pages
)
SELECT page_id, link_no,
       CASE WHEN href LIKE 'http%' THEN href ELSE regexp_extract(url, '^([a-z]+://[^/?#]+)', 1) || href END AS href
FROM one""",
    "page_table_rows": r"""
WITH lists AS (
  SELECT page_id, regexp_extract_all(html, '(?s)<ul>.*?</ul>') AS found FROM pages
),
numbered AS (
  SELECT page_id, unnest(range(len(found)))::INTEGER AS container_no, unnest(found) AS list FROM lists
),
items AS (
  SELECT page_id, container_no, regexp_extract_all(list, '(?s)<li>.*?</li>') AS found FROM numbered
),
one AS (
  SELECT page_id, container_no, unnest(range(len(found)))::INTEGER AS row_no, unnest(found) AS item FROM items
)
SELECT page_id, container_no, row_no, regexp_extract(item, '(?s)<a [^>]*>(.*?)</a>', 1) AS cell FROM one""",
    "page_controls": f"""
WITH {_F}
SELECT company_id, filing_pos,
       list_extract(['Trimestral', 'anual', 'SEMESTRAL', '', 'Otro', 'irregular'], k % 6 + 1) AS reporting_period,
       CASE WHEN k % 7 = 0 THEN '' WHEN k % 7 = 1 THEN '31/2/2024'
            ELSE day(month_end) || '/' || month(month_end) || '/' || year(month_end) END AS period_end_date,
       list_extract(['', 'Consolidado', 'individual', 'Combinado'], k % 4 + 1) AS financial_statements_type,
       CASE WHEN k % 41 = 0 THEN 'miles de $'
            ELSE list_extract(['Unit', '$', 'Thousands', 'Miles de $', 'Millions', 'Millones de $'], k % 6 + 1) END AS unit_of_measure,
       CASE WHEN k % 47 = 0 THEN '' ELSE translate(format('{{:,.2f}}', price), ',.', '.,') END AS equity_share_price_at_period_end,
       translate(format('{{:,.2f}}', (k % 10000) / 100.0::DOUBLE), ',.', '.,') AS free_float_percentage,
       CASE WHEN k % 53 = 0 THEN '12,5' ELSE replace(format('{{:,}}', k % 5000), ',', '.') END AS number_of_employees,
       CASE WHEN k % 19 > 0 THEN 'Pesos' ELSE '' END AS presentation_currency,
       list_extract(['NIIF', 'rt', ''], k % 3 + 1) AS accounting_standards_applied,
       CASE WHEN k % 43 = 0 THEN 'SI' ELSE merger END AS merger_or_demerger_in_process,
       CASE WHEN k % 2 = 0 THEN 'Si' ELSE 'No' END AS treasury_shares,
       'No' AS insolvency_proceedings, 'Sí' AS public_offering_of_equity_instruments,
       replace(format('{{:,}}', CAST(floor(price) AS BIGINT)), ',', '.') AS subscribed_shares_at_period_end,
       '' AS price_earnings_ratio, '' AS market_capitalization
FROM fd""",
    "value_page_rows": f"""
WITH {_F},{_PAGES}
SELECT company_id, filing_pos, page_no, row_no, label, value, id FROM shown
WHERE k NOT IN (SELECT k FROM failed) AND k % 71 > 0""",
    "failed_captures": f"""
WITH {_F},{_PAGES}
SELECT company_id, document_id, filing_pos, 'extract' AS stage, errors FROM failed""",
    "page_items_joined": f"""
WITH {_F},{_PAGES}
SELECT company_id, filing_pos, page_no, count(label)::INTEGER AS n_rows,
       CASE WHEN page_no = 1 THEN 26 ELSE 0 END AS n_controls
FROM (SELECT k, company_id, filing_pos, page_no, label FROM shown
      UNION ALL SELECT k, company_id, filing_pos, page_no, NULL FROM fd JOIN empty_pages USING (k))
WHERE k % 13 > 0 AND k % 17 > 0
GROUP BY company_id, filing_pos, page_no""",
    "registry_csv": f"""
WITH {_REGISTRY}
SELECT company_id, name || ' "SA", ' || chr(10) || 'x' AS name, coalesce(ticker, '{NULL}') AS ticker, sector, registry_pos
FROM companies""",
    "bundle_round_trip": f"""
{_CLEAN},{_REGISTRY}
SELECT c.ticker, vals.company_id, document_id, concept, value FROM vals JOIN companies c USING (company_id)
WHERE c.ticker IS NOT NULL AND CAST(c.industry AS BIGINT) % 4 > 0""",
}
