"""Queries that vote readings into evidence, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from visitgraph.functions import models as M
from visitgraph.operators import evidence as E
from visitgraph.plans.scalar import _MODEL_SQL, _SITES, joined
from visitgraph.operators.tables import settled
from visitgraph.sources.fixtures import DUCK, readings

QUERIES, SQL = {}, {}
_EXACT = ", ".join(f"'{m}'" for m in M.EXACT_ONLY)
#: Long rows of field keys, by label tables for models and sites.
KEYED = DUCK.rstrip() + ",\n" + _MODEL_SQL + rf""",
sites(k, v) AS (VALUES {_SITES}),
places AS (SELECT DISTINCT hospital_raw AS h, trim(regexp_extract(hospital_raw, '^[^,/\-]*')) AS core FROM readings WHERE hospital_raw IS NOT NULL),
placed AS (SELECT h, CASE WHEN v IS NOT NULL THEN v WHEN regexp_full_match(core, '[A-Za-z]{{2,6}}') THEN ''
 WHEN len(w) >= 2 AND array_to_string(list_transform(w, lambda x: x[1]), '') IN (SELECT v FROM sites) THEN array_to_string(list_transform(w, lambda x: x[1]), '')
 WHEN length(regexp_replace(upper(core), '[^A-Z0-9]', '', 'g')) >= 5 THEN regexp_replace(upper(core), '[^A-Z0-9]', '', 'g') ELSE '' END AS k
 FROM (SELECT *, list_filter(regexp_extract_all(upper(core), '[A-Z]+'), lambda x: x NOT IN ('THE', 'OF', 'AND')) AS w FROM places) LEFT JOIN sites ON sites.k = regexp_replace(upper(core), '[^A-Z0-9]', '', 'g')),
modelled AS (SELECT g.label, CASE WHEN model IN ({_EXACT}) THEN regexp_replace(upper(model), '[^A-Z0-9+]', '', 'g') WHEN starts_with(array_to_string(w, ''), 'AFFINITI') THEN 'AFFINITI' WHEN starts_with(array_to_string(w, ''), 'EPIQ') THEN 'EPIQ' WHEN starts_with(array_to_string(w, ''), 'CX') THEN 'CX' WHEN length(w[1]) >= 2 THEN w[1] ELSE '' END AS k,
 coalesce(CASE WHEN models.m NOT IN ('EPIQ', 'Affiniti', 'CX') THEN models.m END, '') AS name FROM (SELECT label, model, list_filter(regexp_extract_all(upper(model), '[A-Z]+'), lambda x: x NOT IN ('PHILIPS', 'SYSTEM', 'ULTRASOUND')) AS w FROM grouped) g LEFT JOIN models ON models.k = regexp_replace(upper(g.label), '[^A-Z0-9+]', '', 'g')),
keyed AS (SELECT * FROM (SELECT doc_id, round, page, source, unnest(['serial_candidates', 'serial_visual_candidates', 'order_no', 'hospital_raw', 'product_raw', 'product_model', 'phone_candidates', 'asset_candidates', 'contact_person_raw', 'service_date_raw']) AS field,
 unnest([serial, visual_serial, order_no, hospital_raw, product_raw, product_raw, phone, asset, contact_person_raw, service_date_raw]) AS raw,
 unnest([coalesce(serial, ''), coalesce(visual_serial, ''), coalesce(order_no, ''), coalesce(p.k, ''), m.k, m.name, phone, coalesce(asset, ''), lower(replace(contact_person_raw, ' ', '')), strftime(strptime(service_date_raw, '%d/%m/%Y'), '%Y-%m-%d')]) AS key
 FROM readings LEFT JOIN placed p ON p.h = hospital_raw LEFT JOIN modelled m ON m.label = product_raw) WHERE key <> '')"""


def query(sql: str):
    def add(f):
        QUERIES[f.__name__] = lambda spark, sf_dir: f(E.keyed(settled(readings(spark, sf_dir))))
        SQL[f.__name__] = KEYED + sql
        return f

    return add


def pairs(m):
    return F.array_join(F.transform(F.map_entries(m), lambda e: F.concat_ws(":", e["key"], e["value"])), ";")


@query("""SELECT v.doc_id, v.field, v.key, v.votes, p.l AS pages, s.l AS sources FROM (SELECT doc_id, field, key, count(DISTINCT round) AS votes FROM keyed GROUP BY ALL) v
 JOIN (SELECT doc_id, field, key, string_agg(concat(page, ':', n), ';' ORDER BY page) AS l FROM (SELECT doc_id, field, key, page, count(*) AS n FROM keyed GROUP BY ALL) GROUP BY ALL) p USING (doc_id, field, key)
 JOIN (SELECT doc_id, field, key, string_agg(concat(source, ':', n), ';' ORDER BY source) AS l FROM (SELECT doc_id, field, key, source, count(*) AS n FROM keyed GROUP BY ALL) GROUP BY ALL) s USING (doc_id, field, key)""")
def evidence_votes(d):
    return E.votes(d).select("doc_id", "field", "key", "votes", pairs("pages").alias("pages"), pairs("sources").alias("sources"))


@query("SELECT doc_id, field, string_agg(key, ';' ORDER BY key) AS keys FROM (SELECT doc_id, field, key FROM keyed GROUP BY ALL HAVING count(DISTINCT round) >= 2) GROUP BY ALL")
def stable_evidence(d):
    return E.stable(E.votes(d)).select("doc_id", "field", joined("keys").alias("keys"))


@query("""SELECT doc_id, field, CASE WHEN repeated = 1 THEN raw END AS value, CASE WHEN repeated = 1 THEN NULL WHEN repeated > 1 OR n_all > 1 THEN 'conflicting_readings' ELSE 'insufficient_valid_readings' END AS reason FROM (
 SELECT doc_id, field, count_if(n >= 2) AS repeated, count(*) AS n_all, max(CASE WHEN n >= 2 THEN raw END) AS raw FROM (SELECT doc_id, field, key, count(DISTINCT round) AS n, arg_min(raw, round) AS raw FROM keyed GROUP BY ALL) GROUP BY ALL)""")
def scalar_consensus(d):
    return E.scalar_consensus(d)


@query("""SELECT doc_id, field, string_agg(key, ';' ORDER BY r) AS keys FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, field ORDER BY f, key) AS r FROM (
 SELECT doc_id, field, key, count(DISTINCT round) AS n, min(round) AS f FROM keyed GROUP BY ALL) WHERE n >= 2) WHERE r <= 3 GROUP BY ALL""")
def list_consensus(d):
    return E.list_consensus(d).select("doc_id", "field", joined("keys").alias("keys"))


@query("""SELECT doc_id, string_agg(s, ';' ORDER BY r) AS serials FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY f, s) AS r FROM (
 SELECT a.doc_id, a.serial AS s, min(a.round) AS f FROM readings a JOIN readings b ON a.doc_id = b.doc_id AND a.round <> b.round AND levenshtein(a.serial, b.serial) <= 1 GROUP BY ALL)) WHERE r <= 3 GROUP BY ALL""")
def near_serial_consensus(d):
    return E.near_consensus(d).select("doc_id", joined("serials").alias("serials"))


@query("""SELECT doc_id, field, max(pages) AS pages, max(pages) > 1 AND max(on_pages) < max(pages) AS conflict FROM (SELECT doc_id, field, key, count(*) AS on_pages FROM rep GROUP BY ALL) JOIN (SELECT doc_id, field, count(DISTINCT page) AS pages FROM rep GROUP BY ALL) USING (doc_id, field) GROUP BY ALL""")
def crosspage_conflicts(d):
    return E.crosspage_conflicts(d)


SQL["crosspage_conflicts"] = KEYED + ", rep AS (SELECT doc_id, field, page, key FROM keyed WHERE field IN ('hospital_raw', 'product_raw') GROUP BY ALL HAVING count(DISTINCT round) >= 2) " + SQL["crosspage_conflicts"][len(KEYED):]


@query("""SELECT doc_id, asset FROM (SELECT doc_id, key AS asset, count(*) OVER (PARTITION BY doc_id) AS rivals FROM keyed WHERE field = 'asset_candidates' GROUP BY doc_id, key HAVING count(DISTINCT round) >= 2) WHERE rivals = 1""")
def repeated_identifier_agreement(d):
    per = d.where("field = 'asset_candidates'").groupBy("doc_id", "key").agg(F.count_distinct("round").alias("n")).where("n >= 2")
    return per.groupBy("doc_id").agg(F.count("*").alias("rivals"), F.min("key").alias("asset")).where("rivals = 1").select("doc_id", "asset")
