"""Date corroboration over partial dates derived from every order, with its SQL."""

from __future__ import annotations

from visitgraph.operators import dates as C
from visitgraph.operators.tables import settled, spent
from visitgraph.sources.fixtures import PREFIX, TABLES

QUERIES, SQL = {}, {}
_KINDS = " UNION ALL ".join(f"SELECT '{k}' AS kind, {n} AS n" for k, ns in (("action", 3), ("focused", 2), ("signed", 2), ("month", 2), ("checklist", 2)) for n in range(1, ns + 1))
#: Partial dates of each order: most agree, some are a day, a digit or a month off, some are missing.
READS = PREFIX.rstrip() + f""",
kinds AS ({_KINDS}),
shifts AS (SELECT gid, k, due_on, kind, n, CASE kind
  WHEN 'action' THEN CASE WHEN n = 2 AND k % 6 = 0 THEN 1 WHEN n = 2 AND k % 6 = 1 THEN NULL WHEN n = 3 AND k % 4 = 0 THEN 10 ELSE 0 END
  WHEN 'focused' THEN CASE WHEN n = 1 AND k % 3 = 0 THEN 1 WHEN n = 2 AND k % 5 = 0 THEN NULL WHEN n = 2 AND k % 7 = 0 THEN 20 ELSE 0 END
  WHEN 'signed' THEN CASE WHEN n = 1 AND k % 2 = 0 THEN NULL WHEN n = 2 AND k % 8 = 0 THEN NULL WHEN n = 2 AND k % 8 = 1 THEN 1 WHEN n = 2 AND k % 8 = 2 THEN 40 ELSE 0 END
  WHEN 'month' THEN CASE WHEN k % 10 = 0 THEN NULL WHEN k % 9 = 0 THEN 31 ELSE 0 END
  ELSE CASE WHEN n = 2 AND k % 3 = 1 THEN NULL WHEN k % 11 = 0 THEN 2 ELSE 0 END END AS shift FROM first_parts CROSS JOIN kinds),
days AS (SELECT gid AS doc_id, kind, n, due_on + CAST(k % 20 + shift AS INT) AS day FROM shifts),
date_reads AS (SELECT doc_id, kind, n, CASE WHEN kind = 'month' THEN concat(CAST(year(day) AS VARCHAR(4)), '-', lpad(CAST(month(day) AS VARCHAR(2)), 2, '0'))
  WHEN day IS NOT NULL THEN concat(lpad(CAST(day(day) AS VARCHAR(2)), 2, '0'), '/', lpad(CAST(month(day) AS VARCHAR(2)), 2, '0'), '/', CAST(year(day) AS VARCHAR(4))) END AS raw FROM days),
about AS (SELECT gid AS doc_id, CASE project_name WHEN 'Ultrasound - CM' THEN 'CM' ELSE 'PM' END AS doc_type, due_on + CAST(CASE WHEN k % 13 = 0 THEN 200 ELSE 30 END AS INT) AS reading_day FROM first_parts)
"""
_DUCK = READS.format(**{t: t for t in TABLES}).rstrip()
_OFF = "len(list_filter(range(1, 9), lambda i: substr(strftime(day, '%Y%m%d'), i, 1) <> substr(strftime(s2, '%Y%m%d'), i, 1)))"
SQL["date_corroboration"] = _DUCK + rf""",
r AS (SELECT doc_id, kind, n, CASE WHEN kind <> 'month' THEN CAST(strptime(raw, '%d/%m/%Y') AS DATE) END AS day, raw FROM date_reads),
p AS (SELECT doc_id, """ + ", ".join(f"max(day) FILTER (kind = '{k}' AND n = {n}) AS {k[0]}{n}" for k in ("action", "focused", "signed", "checklist") for n in (1, 2)) + rf""", max(raw) FILTER (kind = 'month' AND n = 1) AS m1, max(raw) FILTER (kind = 'month' AND n = 2) AS m2 FROM r GROUP BY 1),
o AS (SELECT r.*, s2, c1, {_OFF} AS off FROM r JOIN p USING (doc_id) WHERE kind IN ('action', 'focused') AND day IS NOT NULL),
c AS (SELECT doc_id, count(DISTINCT n) FILTER (kind = 'focused' AND s2 IS NOT NULL AND off <= 1) AS close_near, count(*) FILTER (kind = 'focused' AND s2 IS NOT NULL AND off > 1) AS close_far, count(*) FILTER (day = s2) AS equal, count(*) FILTER (s2 IS NOT NULL AND off > 1) AS far, count(*) FILTER (kind = 'action' AND day = c1) AS listed FROM o GROUP BY 1),
x AS (SELECT a.doc_id, p.* EXCLUDE (doc_id), CASE WHEN f1 = f2 THEN 'agreed' ELSE 'unresolved' END AS focused,
  CASE WHEN s2 IS NULL THEN 'unresolved' WHEN NOT (reading_day - s2 BETWEEN -7 AND 93) THEN 'outside_window' WHEN NOT ((close_near >= 2 AND close_far = 0) OR (equal > 0 AND far = 0)) THEN 'no_action_date_agreement' WHEN equal > 0 THEN 'corroborated' ELSE 'one_digit_customer_correction' END AS signature,
  CASE WHEN a1 = a2 AND m1 = m2 AND strftime(a1, '%Y-%m') = m1 AND reading_day - a1 BETWEEN -7 AND 93 THEN 'agreed' ELSE 'unresolved' END AS month,
  CASE WHEN doc_type <> 'PM' THEN 'not_pm' WHEN c1 IS NULL OR c2 IS NULL OR c1 <> c2 THEN 'unresolved' WHEN NOT (reading_day - c1 BETWEEN -7 AND 93) THEN 'outside_window'
   WHEN coalesce(s2 <> c1, false) OR coalesce(f1 = f2 AND f1 <> c1, false) THEN 'first_page_conflict' WHEN listed = 0 OR NOT (coalesce(s2 = c1, false) OR coalesce(f1 = c1 AND f2 = c1, false)) THEN 'insufficient_first_page_support' ELSE 'corroborated' END AS checklist
 FROM about a LEFT JOIN p USING (doc_id) LEFT JOIN c USING (doc_id))
SELECT doc_id, CASE WHEN focused = 'agreed' THEN f1 WHEN signature IN ('corroborated', 'one_digit_customer_correction') THEN s2 WHEN month = 'agreed' THEN a1 WHEN checklist = 'corroborated' THEN c1 END AS day,
 CASE WHEN focused = 'agreed' THEN 'focused' WHEN signature IN ('corroborated', 'one_digit_customer_correction') THEN 'signature' WHEN month = 'agreed' THEN 'month' WHEN checklist = 'corroborated' THEN 'checklist' END AS rule,
 signature IN ('corroborated', 'one_digit_customer_correction') OR checklist = 'corroborated' AS corroborated, focused, signature, month, checklist FROM x"""


def date_corroboration(spark, sf_dir):
    """Every document's one service date, which rule gave it, and what each rule said."""
    tables = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in TABLES}
    reads = settled(spark.sql(READS + "SELECT * FROM date_reads", **tables))
    about = settled(spark.sql(READS + "SELECT * FROM about", **tables))
    out = settled(C.corroborate(reads, about))
    spent(reads, about)
    return out


QUERIES["date_corroboration"] = date_corroboration
