"""Shared oracle-SQL fragments (DuckDB dialect) mirroring the bindings.

Each constant is a list of CTE bodies to put after ``WITH``.
"""

# orderlines after T1 (zero discount/tax = not recorded -> NULL)
OL = """ol AS (
  SELECT l.l_orderkey, l.l_linenumber, CAST(l.l_quantity AS DOUBLE) AS l_quantity,
         CAST(l.l_extendedprice AS DOUBLE) AS l_extendedprice,
         CASE WHEN l.l_discount = 0 THEN NULL ELSE l.l_discount END AS l_discount,
         CASE WHEN l.l_tax = 0 THEN NULL ELSE l.l_tax END AS l_tax,
         trim(l.l_returnflag) AS l_returnflag, trim(l.l_linestatus) AS l_linestatus,
         CASE o.o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN 1 WHEN 'P' THEN 2 END AS severity
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey)"""

# raw orderlines (no sentinel handling)
OL_RAW = """olr AS (
  SELECT l.l_orderkey, l.l_linenumber, l.l_quantity, l.l_extendedprice, l.l_discount, l.l_tax,
         l.l_returnflag, l.l_linestatus,
         CASE o.o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN 1 WHEN 'P' THEN 2 END AS severity
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey)"""

OL_MED = """ol_med AS (
  SELECT quantile_cont(l_quantity, 0.5) AS m_q, quantile_cont(l_extendedprice, 0.5) AS m_p,
         quantile_cont(l_discount, 0.5) AS m_d, quantile_cont(l_tax, 0.5) AS m_t FROM ol)"""

OL_IMP = """ol_imp AS (
  SELECT l_orderkey, l_linenumber, coalesce(l_quantity, m_q) AS l_quantity,
         coalesce(l_extendedprice, m_p) AS l_extendedprice, coalesce(l_discount, m_d) AS l_discount,
         coalesce(l_tax, m_t) AS l_tax, l_returnflag, l_linestatus, severity
  FROM ol CROSS JOIN ol_med)"""

# T5: + binary target, NULL-target rows dropped (categoricals have no gaps)
OL_CLEAN = """ol_clean AS (
  SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax,
         l_returnflag, l_linestatus, CAST(severity > 0 AS INTEGER) AS severity
  FROM ol_imp WHERE severity IS NOT NULL)"""

OL_Q = """ol_q AS (
  SELECT quantile_cont(l_quantity, [0.25, 0.75]) AS qq, quantile_cont(l_extendedprice, [0.25, 0.75]) AS qp,
         quantile_cont(l_discount, [0.25, 0.75]) AS qd, quantile_cont(l_tax, [0.25, 0.75]) AS qt
  FROM ol_clean)"""

OL_BOUNDS = """ol_b AS (
  SELECT qq[1] - 1.5 * (qq[2] - qq[1]) AS lq, qq[2] + 1.5 * (qq[2] - qq[1]) AS hq,
         qp[1] - 1.5 * (qp[2] - qp[1]) AS lp, qp[2] + 1.5 * (qp[2] - qp[1]) AS hp,
         qd[1] - 1.5 * (qd[2] - qd[1]) AS ld, qd[2] + 1.5 * (qd[2] - qd[1]) AS hd,
         qt[1] - 1.5 * (qt[2] - qt[1]) AS lt, qt[2] + 1.5 * (qt[2] - qt[1]) AS ht
  FROM ol_q)"""

OL_CAPPED = """ol_cap AS (
  SELECT l_orderkey, l_linenumber,
         least(greatest(l_quantity, lq), hq) AS l_quantity,
         least(greatest(l_extendedprice, lp), hp) AS l_extendedprice,
         least(greatest(l_discount, ld), hd) AS l_discount,
         least(greatest(l_tax, lt), ht) AS l_tax,
         l_returnflag, l_linestatus, severity
  FROM ol_clean CROSS JOIN ol_b)"""


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


OL_CLEAN_CHAIN = (OL, OL_MED, OL_IMP, OL_CLEAN)
OL_CAP_CHAIN = OL_CLEAN_CHAIN + (OL_Q, OL_BOUNDS, OL_CAPPED)

# docs = documents LEFT JOIN labels
DOCS = """docs AS (
  SELECT d.doc_id, CAST(d.n_chars AS DOUBLE) AS n_chars,
         CAST(length(d.text) - length(replace(d.text, chr(10), '')) + 1 AS DOUBLE) AS n_lines,
         CAST(length(d.text) - length(regexp_replace(d.text, '[0-9]', '', 'g')) AS DOUBLE) AS n_digits,
         trim(d.lang) AS lang, trim(d.source) AS source, lb.toxic, lb.quality
  FROM documents d LEFT JOIN labels lb ON d.doc_id = lb.doc_id)"""

# customers = customer JOIN nation
CUST = """cust AS (
  SELECT c.c_custkey, c.c_acctbal, c.c_mktsegment, n.n_name,
         CAST(c.c_acctbal < 0 AS INTEGER) AS in_debt
  FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey)"""

# users = events per user
USERS = """users AS (
  SELECT user_id, CAST(count(*) AS DOUBLE) AS n_events, avg(value) AS avg_value, max(value) AS max_value,
         CAST(count(*) FILTER (WHERE event_type = 'click') AS DOUBLE) AS n_click,
         CAST(count(*) FILTER (WHERE event_type = 'error') AS DOUBLE) AS n_error,
         CAST(count(*) FILTER (WHERE event_type = 'signup') AS DOUBLE) AS n_signup,
         CAST(count(*) FILTER (WHERE event_type = 'view') AS DOUBLE) AS n_view,
         max(CAST(event_type = 'purchase' AS INTEGER)) AS has_purchase
  FROM events GROUP BY user_id)"""


def r6(expr: str) -> str:
    """Oracle-side rounding matching ``functions.exprs.r6``."""
    return f"(round(CAST({expr} AS DOUBLE), 6) + 0.0)"

DOCS_CLEAN_CHAIN = (
    DOCS,
    """docs_m AS (SELECT quantile_cont(n_chars, 0.5) AS m1, quantile_cont(n_lines, 0.5) AS m2,
         quantile_cont(n_digits, 0.5) AS m3,
    (SELECT lang FROM docs WHERE lang IS NOT NULL GROUP BY lang ORDER BY count(*) DESC, lang LIMIT 1) AS m_lang,
    (SELECT source FROM docs WHERE source IS NOT NULL GROUP BY source ORDER BY count(*) DESC, source LIMIT 1) AS m_source,
    (SELECT toxic FROM docs WHERE toxic IS NOT NULL GROUP BY toxic ORDER BY count(*) DESC, toxic LIMIT 1) AS m_toxic
  FROM docs)""",
    """docs_clean AS (
  SELECT doc_id, coalesce(n_chars, m1) AS n_chars, coalesce(n_lines, m2) AS n_lines,
         coalesce(n_digits, m3) AS n_digits, coalesce(lang, m_lang) AS lang,
         coalesce(source, m_source) AS source, coalesce(toxic, m_toxic) AS toxic,
         CAST(quality > 0 AS INTEGER) AS quality
  FROM docs CROSS JOIN docs_m WHERE quality IS NOT NULL)""",
)
DOCS_Q = """docs_b AS (SELECT
    q1[1] - 1.5 * (q1[2] - q1[1]) AS l1, q1[2] + 1.5 * (q1[2] - q1[1]) AS h1,
    q2[1] - 1.5 * (q2[2] - q2[1]) AS l2, q2[2] + 1.5 * (q2[2] - q2[1]) AS h2,
    q3[1] - 1.5 * (q3[2] - q3[1]) AS l3, q3[2] + 1.5 * (q3[2] - q3[1]) AS h3
  FROM (SELECT quantile_cont(n_chars, [0.25, 0.75]) AS q1, quantile_cont(n_lines, [0.25, 0.75]) AS q2,
               quantile_cont(n_digits, [0.25, 0.75]) AS q3 FROM docs_clean))"""
DOCS_CAP = """docs_cap AS (
  SELECT doc_id, least(greatest(n_chars, l1), h1) AS n_chars, least(greatest(n_lines, l2), h2) AS n_lines,
         least(greatest(n_digits, l3), h3) AS n_digits, lang, source, toxic, quality
  FROM docs_clean CROSS JOIN docs_b)"""
DOCS_CAP_CHAIN = DOCS_CLEAN_CHAIN + (DOCS_Q, DOCS_CAP)


def union_all(parts) -> str:
    return "\nUNION ALL\n".join(parts)
