"""Checks of a device index kept as files, over rows derived from every order, with their SQL."""

from __future__ import annotations

from visitgraph.sources.fixtures import PREFIX, TABLES, derived
from visitgraph.sources.index_files import DEVICE_LISTS, VISIT_LISTS, device_violations

QUERIES, SQL = {}, {}
#: A device row in JSON for each order; some have no key, a text for a list, a list or visits missing, or are cut off.
_ROWS = """,
visits AS (SELECT gid, k, concat('{{"gid": "', CASE WHEN k % 31 = 0 THEN ' ' ELSE gid END, '", "hospital_aliases": [], "department_rooms": [], "phones": ["', phone, '"], "contacts": [], "assets": ', CASE WHEN k % 37 = 0 THEN 'null' ELSE '[]' END, ', "work_dates": ["1997"]}}') AS visit, phone, contact, asset, serial, product FROM first_parts),
bodies AS (SELECT gid, k, concat('{{"device_key": "', CASE WHEN k % 17 = 0 THEN '' ELSE concat('D', serial) END, '", "product_families": [], "product_variants": ["', product, '"], "locations": [], "hospitals": [], "hospital_aliases": [], "department_rooms": [], "phones": ', CASE WHEN k % 19 = 0 THEN concat('"', phone, '"') ELSE concat('["', phone, '"]') END,
  CASE WHEN k % 23 = 0 THEN '' ELSE concat(', "contacts": ["', contact, '"]') END, ', "assets": ["', asset, '", 1, null], "work_dates": [], "job_types": [], "task_refs": ', CASE WHEN k % 29 = 0 THEN '{{}}' WHEN k % 3 = 0 THEN concat('[', visit, ', ', visit, ']') WHEN k % 43 = 0 THEN '["x"]' ELSE concat('[', visit, ']') END, '}}') AS body FROM visits),
index_rows AS (SELECT gid, CASE WHEN k % 41 = 0 THEN substr(body, 1, length(body) - 1) WHEN k % 47 = 0 THEN '[1]' ELSE body END AS body FROM bodies)
"""
_DUCK = (PREFIX.rstrip() + _ROWS).format(**{t: t for t in TABLES})
_LISTS = " UNION ALL ".join(f"SELECT '{k}' AS k" for k in (*DEVICE_LISTS, "task_refs"))
_VISIT = " UNION ALL ".join(f"SELECT '{k}' AS k" for k in VISIT_LISTS)
SQL["index_validation"] = _DUCK.rstrip() + rf""",
j AS (SELECT gid, CASE WHEN json_valid(body) AND json_type(CASE WHEN json_valid(body) THEN body END) = 'OBJECT' THEN body END AS b FROM index_rows),
r AS (SELECT gid, i, json_extract(b, concat('$.task_refs[', i, ']')) AS v FROM (SELECT gid, b, unnest(range(0, CASE WHEN json_type(b, '$.task_refs') = 'ARRAY' THEN CAST(json_array_length(b, '$.task_refs') AS BIGINT) ELSE 0 END)) AS i FROM j WHERE b IS NOT NULL))
SELECT gid, 'device' AS place, '' AS field, 'not_an_object' AS fault FROM j WHERE b IS NULL
UNION ALL SELECT gid, 'device', 'device_key', 'missing' FROM j WHERE b IS NOT NULL AND coalesce(trim(json_extract_string(b, '$.device_key')), '') = ''
UNION ALL SELECT gid, 'device', k, 'not_a_list' FROM j CROSS JOIN ({_LISTS}) WHERE b IS NOT NULL AND coalesce(json_type(b, concat('$.', k)), '') <> 'ARRAY'
UNION ALL SELECT gid, concat('visit ', i), 'gid', 'missing' FROM r WHERE json_type(v) <> 'OBJECT' OR coalesce(trim(json_extract_string(v, '$.gid')), '') = ''
UNION ALL SELECT gid, concat('visit ', i), k, 'not_a_list' FROM r CROSS JOIN ({_VISIT}) WHERE json_type(v) = 'OBJECT' AND coalesce(json_type(v, concat('$.', k)), '') <> 'ARRAY'"""


def index_validation(spark, sf_dir):
    """Every broken rule of every device row."""
    return device_violations(derived(spark, sf_dir, "SELECT * FROM index_rows", True, more=_ROWS))


QUERIES["index_validation"] = index_validation
