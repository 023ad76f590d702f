"""Reviews over records and confirmations derived from every order, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from visitgraph.functions import reviews as W
from visitgraph.operators import devices as V
from visitgraph.operators import gathered as G
from visitgraph.operators import reviews as P
from visitgraph.operators.readings import repair_references
from visitgraph.plans.devices import RANKED
from visitgraph.plans.matching import LINKED, assessed, linked
from visitgraph.plans.review import _REFS
from visitgraph.sources.fixtures import DUCK, PREFIX, TABLES, gathered_rows

QUERIES, SQL = {}, {}
#: The same readings of work orders, uncertain for orders that have a number of their own.
_SEEN = _REFS.replace("k % 5 = 0", "k % 7 = 0")


def query(sql: str):
    def add(f):
        QUERIES[f.__name__] = f
        SQL[f.__name__] = sql
        return f

    return add


#: Records as they stand after delivery, by rules of their numbers: with or without order, changed, without schedule, noted.
AFTER = """,
after_ AS (SELECT f.gid, f.k, CASE WHEN f.k % 7 = 0 THEN NULL WHEN f.project_name = 'Ultrasound - CM' THEN 'CM' ELSE 'PM' END AS doc_type, CASE WHEN (f.project_name = 'Ultrasound - CM') = (f.k % 11 <> 0) THEN 'CM' ELSE 'PM' END AS job_type,
  CASE WHEN f.k % 4 = 0 THEN w.name ELSE substr(w.name, 1, length(w.name) - CASE WHEN f.order_no = '' THEN 0 ELSE 11 END) END AS matched_name, CASE WHEN f.k % 9 = 0 THEN NULL ELSE f.due_on END AS due_day,
  concat(CASE f.k % 6 WHEN 0 THEN 'Probe broken' WHEN 1 THEN 'screen dark' WHEN 2 THEN 'HAWO 12345678' WHEN 3 THEN 'Tel: 12345678' ELSE 'no idea' END, chr(10), CASE WHEN f.k % 8 < 3 THEN concat(CAST(day(f.due_on) AS VARCHAR(2)), '/', CAST(month(f.due_on) AS VARCHAR(2)), ' 10:30') ELSE 'soon' END) AS notes,
  CASE WHEN f.k % 10 = 1 THEN 'soon' ELSE '' END AS prior_block, CASE WHEN f.k % 12 = 5 THEN 'odd sound issue' END AS issue_read, lpad(CAST(f.k % 10000000 AS VARCHAR(20)), 7, '0') AS digits
 FROM first_parts f JOIN work_records w ON w.gid = f.gid AND w.ord1 = f.ord1 AND w.ord2 = f.ord2)
"""
_FIELDS = """CASE k % 5 WHEN 0 THEN array(named_struct('name', 'Order No.', 'text_value', concat('6', digits), 'number_value', CAST(NULL AS DOUBLE))) WHEN 1 THEN array(named_struct('name', 'Service Order Number', 'text_value', CAST(NULL AS STRING), 'number_value', CAST(concat('5', digits) AS DOUBLE)))
 WHEN 2 THEN array(named_struct('name', 'order number', 'text_value', 'abc', 'number_value', CAST(61234567 AS DOUBLE)), named_struct('name', 'Order-No', 'text_value', '', 'number_value', CAST(61234567.5 AS DOUBLE))) ELSE cast(array() AS array<struct<name:string,text_value:string,number_value:double>>) END"""
_STATED = DUCK.rstrip() + AFTER.rstrip() + r""",
now_ AS (SELECT *, CASE WHEN k % 13 = 0 THEN concat(matched_name, ' x') ELSE matched_name END AS name FROM after_),
ordered_ AS (SELECT *, coalesce(CASE k % 5 WHEN 0 THEN concat('6', digits) WHEN 1 THEN concat('5', digits) END, nullif(regexp_extract(name, '\b([56]\d{7})\b', 1), '')) AS order_no, CASE k % 6 WHEN 0 THEN 'Probe broken' WHEN 1 THEN 'screen dark' WHEN 2 THEN 'HAWO 12345678' WHEN 3 THEN '' ELSE 'no idea' END AS head FROM now_)"""


def after(spark, sf_dir):
    """(gid, doc_type, matched_name, name, notes, custom_fields, ...): every order's record as it stands."""
    d = spark.sql(PREFIX.rstrip() + AFTER + "SELECT * FROM after_", **{t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in TABLES})
    return d.withColumns({"custom_fields": F.expr(_FIELDS), "name": F.expr("CASE WHEN k % 13 = 0 THEN concat(matched_name, ' x') ELSE matched_name END"), "due_at": F.expr("CAST(due_day AS TIMESTAMP) + INTERVAL '10:30' HOUR TO MINUTE")})


@query(_STATED + " SELECT gid, order_no FROM ordered_")
def company_orders(spark, sf_dir):
    """Every record's own order number, by custom field or name."""
    return after(spark, sf_dir).select("gid", W.company_order(F.col("custom_fields"), F.col("name")).alias("order_no"))


@query(_STATED + r""",
said_ AS (SELECT *, CASE WHEN k % 8 < 3 THEN '' ELSE 'soon' END AS tail FROM ordered_),
told_ AS (SELECT *, CASE WHEN head = '' THEN tail WHEN tail = '' THEN head ELSE concat(head, chr(10), tail) END AS fault FROM said_),
labels_ AS (SELECT *, CASE WHEN k % 6 = 0 THEN 'Probe issue' WHEN k % 6 = 1 THEN 'Display issue' ELSE issue_read END AS issue FROM told_),
s_ AS (SELECT *, CASE WHEN doc_type IS NULL THEN 'task_unconfirmed' WHEN order_no IS NOT NULL THEN 'company_order_exists' WHEN job_type <> doc_type THEN 'task_type_changed' WHEN doc_type = 'PM' THEN 'pm_missing_order' WHEN prior_block <> '' AND contains(notes, prior_block) THEN 'description_complete'
 WHEN name <> matched_name THEN 'task_changed' WHEN due_day IS NULL THEN 'missing_schedule' WHEN fault <> '' AND k % 8 < 3 THEN 'description_complete' WHEN issue IS NULL THEN 'issue_needs_review' ELSE 'preview' END AS status FROM labels_)
SELECT gid AS doc_id, status, status <> 'company_order_exists' AS attention, CASE WHEN status = 'company_order_exists' THEN order_no END AS order_no, CASE WHEN status = 'preview' THEN concat(issue, chr(10), day(due_day), '/', month(due_day), ' 10:30') END AS draft FROM s_""")
def post_delivery_review(spark, sf_dir):
    """Every delivered document's record: what it lacks, and a draft where one can be made."""
    return P.post_delivery(after(spark, sf_dir).withColumn("doc_id", F.col("gid")))


#: Confirmations as people type them, by a rule of the order's number; most are sound.
_TYPED = """SELECT gid, CASE k % 7 WHEN 0 THEN '8/9/2026' WHEN 1 THEN '2026-02-30' WHEN 2 THEN '1996-01-02' ELSE concat('20', substr(CAST(due_on AS VARCHAR(10)), 3, 8)) END AS day_,
 CASE k % 6 WHEN 0 THEN '' WHEN 1 THEN concat(' 1', lpad(gid, 9, '0'), ' ') WHEN 2 THEN concat('https://tracker.example/0/12/1', lpad(gid, 9, '0'), '/f?x=1') WHEN 3 THEN concat('http://tracker.example/0/12/1', lpad(gid, 9, '0')) WHEN 4 THEN concat('https://tracker.example.net/0/12/1', lpad(gid, 9, '0')) ELSE gid END AS record_,
 CASE k % 5 WHEN 0 THEN lower(serial) WHEN 1 THEN concat(serial, '?') ELSE serial END AS serial_, CASE k % 4 WHEN 0 THEN 'A12' WHEN 1 THEN '123' ELSE concat(' ', asset) END AS asset_ FROM first_parts"""


@query(DUCK.rstrip() + ", t AS (" + _TYPED + r""")
SELECT gid, CAST(CASE WHEN regexp_full_match(day_, '20\d{2}-\d{2}-\d{2}') THEN try_strptime(day_, '%Y-%m-%d') END AS DATE) AS day, CASE WHEN trim(record_) = '' THEN '' WHEN regexp_full_match(trim(record_), '\d{8,20}') THEN trim(record_) ELSE nullif(regexp_extract(record_, '^https://tracker\.example/0/\d+/(\d{8,20})(?:/|\?|$)', 1), '') END AS record_id,
 CASE WHEN regexp_full_match(upper(serial_), '[A-Z]{2,3}[A-Z0-9]{6,9}') AND length(serial_) BETWEEN 8 AND 12 AND length(regexp_replace(serial_, '[^0-9]', '', 'g')) >= 4 THEN upper(serial_) END AS serial, CASE WHEN regexp_full_match(trim(asset_), '\d{4,12}') THEN trim(asset_) END AS asset FROM t""")
def review_inputs(spark, sf_dir):
    """Every confirmation parsed strictly; what can't be read is null."""
    d = spark.sql(PREFIX + _TYPED, **{t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in TABLES})
    return d.select("gid", W.strict_day(F.col("day_")).alias("day"), W.record_id(F.col("record_"), "tracker.example").alias("record_id"), W.whole_serial(F.col("serial_")).alias("serial"), W.whole_asset(F.col("asset_")).alias("asset"))


@query(RANKED + r""",
raw_ AS (SELECT doc_id, max(value) FILTER (field = 'hospital_raw') AS hospital, max(value) FILTER (field = 'product_raw') AS product FROM (SELECT doc_id, field, CASE WHEN count(*) FILTER (n >= 2) = 1 THEN max(CASE WHEN n >= 2 THEN raw END) END AS value FROM (SELECT doc_id, field, key, count(DISTINCT round) AS n, arg_min(raw, round) AS raw FROM keyed GROUP BY ALL) GROUP BY ALL) GROUP BY 1),
tied_ AS (SELECT a.doc_id, f.serial, bool_or(list_contains(w_models, f.model) AND list_contains(w_sites, f.site)) AS sure, count(DISTINCT CASE WHEN list_contains(w_models, f.model) AND list_contains(w_sites, f.site) AND f.job_type = a.doc_type AND abs(f.due - a.day) <= 14 AND list_contains(w_phones, f.phone) THEN f.gid END) AS visits
 FROM ask a JOIN es e USING (doc_id) JOIN facts f ON len(e.two_serial) = 1 AND f.serial = e.two_serial[1] WHERE a.day IS NOT NULL AND a.doc_type IN ('PM', 'CM') GROUP BY ALL)
SELECT doc_id, serial AS device_key, visits, concat_ws(' - ', regexp_replace(hospital, '^[ ._-]+|[ ._-]+$', '', 'g'), product, serial) AS name FROM tied_ JOIN raw_ USING (doc_id) WHERE sure AND visits >= 2""")
def neutral_device_name(spark, sf_dir):
    """Documents of a certain device with several visits that nothing tells apart."""
    link = linked(spark, sf_dir, retrieve=False)
    ask = V.asks(link.evidence, link.types())
    # the first text of the one key that repeats; a document's texts are in its own row
    raw = gathered_rows(link.orders).select("doc_id", "hospital_raw", "product_raw")
    raw = raw.join(link.labels, (F.col("hospital_raw") == F.col("_h")) & (F.col("product_raw") == F.col("_p")))
    labels = raw.select("doc_id", G.agreed(F.col("_h"), F.col("_hospital_raw")).alias("hospital"), G.agreed(F.col("_p"), F.col("_product_raw")).alias("product"))
    out = P.neutral_names(ask, link.evidence.select("doc_id", "two_serial"), link.facts, labels)
    return link.close(out)


@query(LINKED + f""",
refs_ AS (SELECT doc_id, round, {_SEEN} AS key FROM (SELECT *, CAST(doc_id AS BIGINT) AS k FROM readings)),
per_ AS (SELECT doc_id, key, count(*) AS votes, count_if(round >= 3) AS near, length(key) - 4 AS n FROM refs_ WHERE key IS NOT NULL GROUP BY 1, 2),
docs_ AS (SELECT doc_id, list(key) FILTER (votes >= 2) AS stable, CAST(sum(near) AS BIGINT) AS near, list(key) FILTER (near > 0 AND n = 8) AS eights FROM per_ GROUP BY 1),
unsure_ AS (SELECT doc_id, eights[1] AS uncertain FROM docs_ WHERE len(stable) = 1 AND length(stable[1]) = 11 AND near = 2 AND len(eights) = 1 AND levenshtein(stable[1], eights[1]) = 1),
focus_ AS (SELECT doc_id, min(key) AS ord FROM keyed WHERE field = 'order_no' GROUP BY 1 HAVING count(DISTINCT key) = 1 AND count(DISTINCT round) FILTER (round >= 3) >= 2)
SELECT a.doc_id, a.gid, u.uncertain AS reference FROM assessed a JOIN focus_ o ON o.doc_id = a.doc_id JOIN unsure_ u ON u.doc_id = a.doc_id
 WHERE a.order_no = o.ord AND u.uncertain = concat('HAWO', lpad(a.gid, 8, '1')) AND distance = 0 AND list_contains(two_serial, serial) AND has_model AND has_site AND list_contains(two_phone, phone) AND len(two_date) = 1""")
def reference_confirmation(spark, sf_dir):
    """Uncertain references of all documents, against the records that bear them."""
    link, pairs = assessed(spark, sf_dir)
    read = gathered_rows(link.orders).select("doc_id", F.explode("round").alias("round"))
    refs = read.withColumn("k", F.col("doc_id").cast("bigint")).select("doc_id", "round", F.expr(_SEEN).alias("key"), (F.col("round") >= 3).alias("focused")).where("key IS NOT NULL")
    uncertain = repair_references(refs).select("doc_id", "uncertain")
    close = F.size(F.array_distinct(F.filter(F.col("order")["round"], lambda r: r >= 3)))
    orders = link.rows.select("doc_id", F.array_distinct(F.col("order")["key"]).alias("keys"), close.alias("close")).where("size(keys) = 1 AND close >= 2").select("doc_id", F.col("keys")[0].alias("order"))
    own = link.facts.select("gid", F.array(F.concat(F.lit("HAWO"), F.lpad("gid", 8, "1"))).alias("references"))
    return link.close(P.confirm_references(pairs, orders, uncertain, own), pairs)
