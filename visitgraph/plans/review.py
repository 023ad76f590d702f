"""Queries over raw readings, references, dates and notes, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from visitgraph.functions import models as M
from visitgraph.functions import notes as N
from visitgraph.functions import text as X
from visitgraph.operators import linkage as L
from visitgraph.operators import readings as R
from visitgraph.operators.directory import plausible_codes
from visitgraph.operators.dispatch import backoff
from visitgraph.operators.tables import settled
from visitgraph.plans.index import _NAMES, directory, parsed
from visitgraph.plans.scalar import _MODEL_SQL, joined
from visitgraph.plans.voting import KEYED
from visitgraph.sources.fixtures import DUCK, readings, table, work_records

QUERIES, SQL = {}, {}


def query(sql: str | None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


#: Readings with faults of all kinds, by expressions that Spark and DuckDB both run.
RAW = {
    "order_raw": "CASE WHEN k % 17 = 0 THEN '512' ELSE order_no END",
    "serial_2": "CASE WHEN k % 13 = 0 AND serial IS NOT NULL THEN concat(serial, '?') WHEN k % 10 = 0 THEN 'N/A' END",
    "phone_1": "CASE WHEN (k + round) % 12 = 0 THEN substr(phone, 1, 7) WHEN k % 5 = 0 THEN concat('+852 ', phone) ELSE phone END",
    "asset_1": "CASE WHEN k % 15 = 0 THEN '12' ELSE asset END",
    "contact_1": "CASE WHEN k % 14 = 0 THEN '93331234' ELSE concat(' ', contact_person_raw, ' ;') END",
    "site_1": "CASE WHEN k % 19 = 0 THEN 'Asset 123' ELSE hospital_raw END",
    "date_1": "CASE WHEN k % 29 = 0 THEN 'soon' WHEN k % 31 = 0 THEN '1/1/1980' ELSE service_date_raw END",
    "source_1": "CASE WHEN k % 23 = 0 THEN 'SIGNATURE' ELSE 'Action Date' END",
    "room_1": "CASE WHEN k % 6 = 0 AND asset IS NOT NULL THEN concat('Ward 5 Asset# ', asset) ELSE 'none' END",
    "work_1": "CASE WHEN k % 21 = 0 THEN 'WO 12' ELSE concat('HAWO ', lpad(CAST(k AS VARCHAR(20)), 8, '1')) END",
}


def raw_readings(spark, sf_dir):
    d = settled(readings(spark, sf_dir)).withColumn("k", F.col("doc_id").cast("bigint")).withColumns({n: F.expr(e) for n, e in RAW.items()})
    c = F.col
    return d.select("doc_id", "round", "reference_day", c("order_raw").alias("order_no"), F.array("serial", "serial_2").alias("serials"), "product_raw", c("site_1").alias("hospital_raw"), c("contact_1").alias("contact_person_raw"), F.array("asset_1").alias("assets"), c("room_1").alias("department_room_raw"), F.array("work_1").alias("work_orders"), c("date_1").alias("service_date_raw"), c("source_1").alias("date_source"), F.when(c("k") % 37 == 0, F.array(*["phone_1"] * 4)).otherwise(F.array("phone_1")).alias("phones"))


_CODES = ", ".join(f"'{k}'" for k in M.SITES)
_KNOWN = ", ".join(f"'{m}'" for m in sorted(set(M.BY_KEY.values())))
_NORMALISED = DUCK.rstrip() + ",\n" + _MODEL_SQL + ", raw AS (SELECT *, " + ", ".join(f"{e} AS {n}" for n, e in RAW.items()) + r""" FROM (SELECT *, CAST(doc_id AS BIGINT) AS k FROM readings)),
parts AS (SELECT r.*, canon.model, list_filter([serial, CASE WHEN serial_2 <> 'N/A' THEN serial_2 END], lambda x: x IS NOT NULL) AS ss, right(regexp_replace(phone_1, '[^0-9]', '', 'g'), 8) AS ph,
 list_distinct(list_filter([regexp_replace(asset_1, '[^0-9]', '', 'g'), CASE WHEN room_1 LIKE '%Asset#%' AND length(asset) >= 4 THEN asset END], lambda x: x IS NOT NULL)) AS aa,
 CAST(try_strptime(date_1, '%d/%m/%Y') AS DATE) AS day, trim(regexp_extract(trim(site_1), '^[^,/\-]*')) AS core FROM raw r LEFT JOIN canon ON canon.label = r.product_raw),
keys_ AS (SELECT *, regexp_replace(upper(core), '[^A-Z0-9]', '', 'g') AS ck, datediff('day', day, reference_day) AS age FROM parts),
checked AS (SELECT *, coalesce(model IN (""" + _KNOWN + r"""), false) AS known, NOT regexp_matches(upper(site_1), '\bASSET\b') AND CASE WHEN regexp_full_match(ck, '[A-Z]{2,6}') THEN ck IN (""" + _CODES + r""") ELSE length(ck) >= 5 AND NOT regexp_full_match(ck, '[0-9]+') END AS placed,
 CASE WHEN date_1 IS NULL THEN NULL WHEN source_1 <> 'Action Date' THEN 'not_action_date' WHEN age IS NULL THEN 'invalid_date_format' WHEN age NOT BETWEEN -7 AND 93 THEN 'date_outside_window' END AS bad FROM keys_),
faults AS (SELECT *, list_filter([CASE WHEN k % 37 = 0 THEN 'phones:candidate_limit' END, CASE WHEN order_raw IS NOT NULL AND NOT regexp_full_match(order_raw, '[56]\d{7}') THEN 'order_no:invalid_order_format' END,
 CASE WHEN len(list_filter(ss, lambda x: contains(x, '?'))) > 0 THEN 'serials:invalid_serial_format' END, CASE WHEN product_raw IS NOT NULL AND NOT known THEN 'product_raw:unconfirmed_product' END,
 CASE WHEN NOT placed THEN 'hospital_raw:unconfirmed_hospital_or_wrong_field' END, CASE WHEN k % 14 = 0 THEN 'contact_person_raw:contact_without_name' END, CASE WHEN length(ph) <> 8 THEN 'phones:invalid_phone_length' END,
 CASE WHEN len(list_filter(aa, lambda x: length(x) < 4)) > 0 THEN 'assets:invalid_asset_length' END, CASE WHEN k % 21 = 0 THEN 'work_orders:invalid_work_order_length' END, 'service_date_raw:' || bad], lambda x: x IS NOT NULL) AS rejections FROM checked)"""


@query(_NORMALISED + r""" SELECT doc_id, round, CASE WHEN order_raw <> '512' THEN order_raw END AS order_no, array_to_string(list_filter(ss, lambda x: NOT contains(x, '?')), ';') AS serials, CASE WHEN known THEN model END AS product, CASE WHEN placed THEN site_1 END AS hospital_raw,
 CASE WHEN k % 14 <> 0 THEN contact_person_raw END AS contact_person_raw, CASE WHEN length(ph) = 8 THEN ph ELSE '' END AS phones, array_to_string(list_sort(list_filter(aa, lambda x: length(x) >= 4)), ';') AS assets, CASE WHEN bad IS NULL THEN day END AS service_date, array_to_string(rejections, ';') AS rejections FROM faults""")
def normalise_readings(spark, sf_dir):
    n = R.normalise_readings(raw_readings(spark, sf_dir))
    said = F.transform("rejections", lambda x: F.concat_ws(":", x["field"], x["reason"]))
    return n.select("doc_id", "round", "order_no", joined("serials").alias("serials"), "product", "hospital_raw", "contact_person_raw", joined("phones").alias("phones"), joined(F.array_sort("assets")).alias("assets"), "service_date", joined(said).alias("rejections"))


@query(_NORMALISED + ", taught AS (" + _NAMES + r""" SELECT nk FROM plaus) SELECT doc_id, round, CASE WHEN placed OR taught_ THEN site_1 END AS hospital_raw, CASE WHEN site_1 IS NULL THEN NULL WHEN NOT (placed OR taught_) THEN 'unconfirmed_hospital_or_wrong_field' WHEN NOT placed THEN 'unconfirmed_short_code' END AS reason
 FROM (SELECT *, NOT regexp_matches(upper(site_1), '\bASSET\b') AND NOT placed AND ck IN (SELECT nk FROM taught) AS taught_ FROM checked)""")
def taught_site_readings(spark, sf_dir):
    """The sites of all readings, checked with the short codes that the records' directory has taught."""
    records = parsed(work_records(spark, sf_dir, first=True))
    codes = settled(plausible_codes(directory(records)))
    n = R.normalise_readings(raw_readings(spark, sf_dir), codes=codes)
    why = F.try_element_at(F.filter("rejections", lambda x: x["field"] == "hospital_raw"), F.lit(1))["reason"]
    return n.select("doc_id", "round", "hospital_raw", why.alias("reason"))


@query(_NORMALISED + " SELECT split_part(x, ':', 1) AS field, split_part(x, ':', 2) AS reason, count(*) AS n FROM (SELECT unnest(rejections) AS x FROM faults) GROUP BY ALL")
def rejection_stats(spark, sf_dir):
    n = R.normalise_readings(raw_readings(spark, sf_dir))
    # outer, and the empty rows dropped after: a plain explode asks for the size of its list in a filter, which works it out again
    each = n.select(F.explode_outer("rejections").alias("x")).where("x.field IS NOT NULL")
    return each.groupBy("x.field", "x.reason").agg(F.count("*").alias("n"))


@query(DUCK + ", ".join([f"SELECT doc_id, round, concat_ws(';', " + ", ".join(f"CASE WHEN {c} <> '' THEN '{c}' END" for c in ("serial", "product_raw", "hospital_raw", "phone", "asset", "contact_person_raw", "order_no", "service_date_raw")) + ") AS filled FROM readings"]))
def redacted_preview(spark, sf_dir):
    """The names of the fields that a reading fills, never their values."""
    fields = ("serial", "product_raw", "hospital_raw", "phone", "asset", "contact_person_raw", "order_no", "service_date_raw")
    return readings(spark, sf_dir).select("doc_id", "round", F.concat_ws(";", *[F.when(F.col(c) != "", c) for c in fields]).alias("filled"))


#: Work orders as they might be read: closer readings (rounds 3 and 4) see eight digits, the others sometimes seven.
_REFS = "CASE WHEN k % 3 = 0 THEN NULL WHEN (k % 3 = 1 AND round <= 2) OR (k % 5 = 0 AND round <> 3) THEN concat('HAWO', substr(lpad(CAST(k AS VARCHAR(20)), 8, '1'), 1, 7)) ELSE concat('HAWO', lpad(CAST(k AS VARCHAR(20)), 8, '1')) END"


@query(DUCK.rstrip() + f""", refs AS (SELECT doc_id, round, {_REFS} AS key FROM (SELECT *, CAST(doc_id AS BIGINT) AS k FROM readings)),
per AS (SELECT doc_id, key, count(*) AS votes, count_if(round >= 3) AS near, length(key) - 4 AS n FROM refs WHERE key IS NOT NULL GROUP BY 1, 2),
docs AS (SELECT doc_id, list(key ORDER BY key) FILTER (votes >= 2) AS stable, list(key ORDER BY key) FILTER (votes >= 2 AND near >= 2) AS f, list(key ORDER BY key) FILTER (votes >= 2 AND near < 2) AS s, CAST(sum(near) AS BIGINT) AS near, list(key ORDER BY key) FILTER (near > 0 AND n = 8) AS eights FROM per GROUP BY 1),
fixed AS (SELECT *, coalesce(len(stable) = 2 AND len(f) = 1 AND length(f[1]) = 12 AND length(s[1]) = 11 AND levenshtein(f[1], s[1]) = 1, false) AS ok FROM docs)
SELECT doc_id, CASE WHEN ok THEN f[1] ELSE coalesce(array_to_string(stable, ';'), '') END AS kept, CASE WHEN ok THEN s[1] END AS shorter, CASE WHEN len(stable) = 1 AND length(stable[1]) = 11 AND near = 2 AND len(eights) = 1 AND levenshtein(stable[1], eights[1]) = 1 THEN eights[1] END AS uncertain FROM fixed""")
def reference_repair(spark, sf_dir):
    d = readings(spark, sf_dir).withColumn("k", F.col("doc_id").cast("bigint"))
    refs = d.select("doc_id", "round", F.expr(_REFS).alias("key"), (F.col("round") >= 3).alias("focused")).where("key IS NOT NULL")
    return R.repair_references(refs).select("doc_id", joined("kept").alias("kept"), "shorter", "uncertain")


@query(DUCK.rstrip() + r""", given AS (SELECT doc_id, round, CAST(strptime(service_date_raw, '%d/%m/%Y') - INTERVAL 12 MONTH * (round - 1) AS DATE) AS day, reference_day - 30 AS due, reference_day AS today FROM readings),
moved AS (SELECT *, abs(datediff('day', day, due)) AS direct, CASE WHEN abs(datediff('day', day, today)) > 93 AND abs(datediff('day', due, today)) <= 93 THEN abs(datediff('day', CAST(try_strptime(concat(year(due), strftime(day, '-%m-%d')), '%Y-%m-%d') AS DATE), due)) END AS m FROM given)
SELECT doc_id, round, CASE WHEN coalesce(m <= 14 AND m < direct, false) THEN m ELSE direct END AS delta, coalesce(m <= 14 AND m < direct, false) AS corrected FROM moved""")
def date_evidence(spark, sf_dir):
    """Service dates, of later rounds with years misread by one to three, against the due day of the record read."""
    d = readings(spark, sf_dir).select("doc_id", "round", "reference_day", F.add_months(X.action_date(F.col("service_date_raw")), -12 * (F.col("round") - 1)).alias("day"), F.date_sub("reference_day", 30).alias("due"))
    e = R.date_evidence(F.col("day"), F.array("due"), F.col("reference_day"))
    return d.select("doc_id", "round", e.alias("e")).select("doc_id", "round", F.col("e.delta").cast("long").alias("delta"), "e.corrected")


_NOTE = "concat('Contact: Ann', chr(10), 'https://t.example/', CAST(conv_id AS VARCHAR(20)), chr(10), chr(10), '3/4 seen', chr(10), 'Fault: ', CASE CAST(turn % 6 AS INT) WHEN 0 THEN 'Probe dropped' WHEN 1 THEN 'keyboard stuck' WHEN 2 THEN 'cannot turn on' WHEN 3 THEN 'dark SCREEN' WHEN 4 THEN 'low gain' ELSE 'other' END, chr(10), coalesce(text, ''), chr(10), chr(10), 'Printer later')"
_ISSUE = "CASE " + " ".join(f"WHEN regexp_matches(fault, '(?i){p}') THEN '{label}'" for p, label in N.ISSUES) + " END"


_QUOTED = lambda xs: ", ".join(f"'{x}'" for x in xs)
_ASIDE = rf"""(lower(trim(regexp_extract(t, '^([^:：]*)[:：]', 1))) IN ({_QUOTED(N.LABELS)}) OR regexp_replace(t, '[0-9()+\s-]', '', 'g') = '' OR (contains(t, ' ') AND (regexp_full_match(split_part(t, ' ', 1), '[0-9]{{1,2}}[/.-][0-9]{{1,2}}([/.-][0-9]{{2,4}})?')
 OR (regexp_replace(lower(split_part(t, ' ', 1)), '\.$', '') IN ({_QUOTED(N.TITLES)}) AND regexp_matches(substr(t, strpos(t, ' ')), '[0-9]')))))"""


@query(rf"""WITH notes AS (SELECT conv_id, turn, {_NOTE} AS note FROM conversations),
lines AS (SELECT *, list_transform(string_split(regexp_replace(note, 'https?://\S+', '', 'g'), chr(10)), lambda x: trim(x)) AS l FROM notes),
kinds AS (SELECT *, list_transform(l, lambda t: CASE WHEN t = '' THEN 0 WHEN {_ASIDE} THEN 1 ELSE 2 END) AS k FROM lines),
stops AS (SELECT *, coalesce(list_min(list_filter(range(1, len(k) + 1), lambda i: k[i] = 0 AND i > list_position(k, 2))), len(k) + 1) AS stop FROM kinds),
faults AS (SELECT conv_id, turn, trim(array_to_string(list_transform(list_filter(range(1, stop), lambda i: k[i] = 2), lambda i: regexp_replace(l[i], '(?i)^fault\s*:\s*', '')), chr(10))) AS fault FROM stops)
SELECT conv_id, turn, sha256(fault) AS fault_sha256, {_ISSUE} AS label FROM faults""")
def issue_labels(spark, sf_dir):
    d = table(spark, sf_dir, "conversations").select("conv_id", "turn", N.fault_text(F.expr(_NOTE)).alias("fault"))
    return d.select("conv_id", "turn", F.sha2("fault", 256).alias("fault_sha256"), N.issue_label(F.col("fault")).alias("label"))


_STAMP = "concat('see https://t.example/1/2 12:00 ', CASE CAST(event_id % 6 AS INT) WHEN 0 THEN {0} WHEN 1 THEN {1} WHEN 2 THEN {2} WHEN 3 THEN concat({0}, '9') WHEN 4 THEN {3} ELSE 'no entry' END)"


@query(r"""WITH n AS (SELECT event_id, ts, """ + _STAMP.format("strftime(ts, '%-d/%-m/%y %H:%M')", "strftime(ts, '%m/%d/%Y %H%M')", "strftime(ts + INTERVAL 1 DAY, '%d/%m %H:%M')", "strftime(ts, '%d/%m/1999 %H:%M')") + r""" AS note FROM events),
e AS (SELECT event_id, ts, regexp_extract(note, '(?:^|[^0-9])([0-9]{1,2})/([0-9]{1,2})(?:/([0-9]{4}|[0-9]{2}))?[ \t]+([0-9]{1,2}:[0-9]{2}|[0-9]{4})(?:[^0-9]|$)', ['d', 'm', 'y', 't']) AS x FROM (SELECT event_id, ts, regexp_replace(note, 'https?://\S+', '', 'g') AS note FROM n)),
v AS (SELECT event_id, ts, TRY_CAST(x.d AS INT) AS d, TRY_CAST(x.m AS INT) AS m, x.y AS y FROM e)
SELECT event_id, coalesce((CASE WHEN m > 12 AND d <= 12 THEN m ELSE d END) = day(ts) AND (CASE WHEN m > 12 AND d <= 12 THEN d ELSE m END) = month(ts) AND (y = '' OR TRY_CAST(right(y, 2) AS INT) = year(ts) % 100), false) AS visited FROM v""")
def has_visit_record(spark, sf_dir):
    f = lambda p, c="ts": f"date_format({c}, '{p}')"
    note = F.expr(_STAMP.format(f("d/M/yy HH:mm"), f("MM/dd/yyyy HHmm"), f("dd/MM HH:mm", "ts + INTERVAL 1 DAY"), f("dd/MM/1999 HH:mm")))
    return table(spark, sf_dir, "events").select("event_id", N.has_visit_record(note, F.to_date("ts")).alias("visited"))


_ISSUE_READ = "concat(product_raw, CASE WHEN CAST(doc_id AS BIGINT) % 4 = 0 THEN ' Probe' ELSE ' probe' END, CASE WHEN CAST(doc_id AS BIGINT) % 9 = 0 AND round = 2 THEN ' and screen' ELSE '' END, ' issue')"


@query(DUCK.rstrip() + f", r AS (SELECT doc_id, regexp_replace(lower({_ISSUE_READ}), '[^a-z0-9]', '', 'g') AS k FROM readings WHERE round <= 2) SELECT doc_id, count(*) = 2 AND count(DISTINCT k) = 1 AS agreed, CASE WHEN count(*) = 2 AND count(DISTINCT k) = 1 THEN 'Probe issue' END AS label FROM r GROUP BY 1")
def issue_pair_agreement(spark, sf_dir):
    """The first two readings of a fault must agree as text and in their label."""
    d = readings(spark, sf_dir).where("round <= 2").select("doc_id", F.expr(_ISSUE_READ).alias("t"))
    g = d.groupBy("doc_id").agg(F.count("*").alias("n"), F.count_distinct(X.text_key(F.col("t"))).alias("keys"), F.count_distinct(N.issue_label(F.col("t"))).alias("labels"), F.min(N.issue_label(F.col("t"))).alias("label"))
    agreed = (F.col("n") == 2) & (F.col("keys") == 1) & (F.col("labels") == 1)
    return g.select("doc_id", agreed.alias("agreed"), F.when(agreed, F.col("label")).alias("label"))


_WAY = """SELECT doc_id, coalesce(text, '') AS old, CASE doc_id % 5 WHEN 0 THEN concat(coalesce(text, ''), chr(10), '<img data-note-gid="', doc_id, '">') ELSE coalesce(text, '') END AS before_, 'visited 1/2 10:00' AS block, CAST(doc_id % 5 AS INT) AS way FROM documents"""
_LINES = r"list_filter(list_transform(regexp_split_to_array({c}, '\r\n|\r|\n'), lambda x: trim(x)), lambda x: x <> '')"


@query(f"""WITH w AS ({_WAY}),
e AS (SELECT doc_id, way, before_, block, CASE way WHEN 0 THEN CASE WHEN doc_id % 2 = 0 THEN concat(before_, chr(10), block) ELSE concat(replace(before_, '">', 'x">'), chr(10), block) END WHEN 1 THEN concat('first', chr(10), before_, chr(10), block)
  WHEN 2 THEN regexp_replace(concat(before_, chr(10), block), '^[^\n]*\n', '') WHEN 3 THEN concat(before_, chr(10), block, chr(10), 'last') ELSE concat(before_, chr(10), block) END AS after_ FROM w),
l AS (SELECT *, {_LINES.format(c="before_")} AS o, {_LINES.format(c="after_")} AS n FROM e)
SELECT doc_id, list_reduce(list_concat([0], range(1, len(n) + 1)), lambda a, i: CASE WHEN a < len(o) AND o[a + 1] = n[i] THEN a + 1 ELSE a END) = len(o) AND ends_with(trim(after_), block)
 AND len(list_filter(regexp_extract_all(before_, 'data-note-gid="([^"]+)', 1), lambda x: NOT list_contains(regexp_extract_all(after_, 'data-note-gid="([^"]+)', 1), x))) = 0 AS kept FROM l""")
def edit_preservation(spark, sf_dir):
    """Documents as notes with an image, edited in five ways: a block added, an image changed, a line added amid, the first line gone, the block not last."""
    d = table(spark, sf_dir, "documents").select("doc_id", X.text_of(F.col("text")).alias("old"))
    block, way, end = F.lit("visited 1/2 10:00"), F.col("doc_id") % 5, F.lit("\n")
    image = F.concat("old", F.lit('\n<img data-note-gid="'), F.col("doc_id").cast("string"), F.lit('">'))
    d = d.withColumn("before", F.when(way == 0, image).otherwise(F.col("old")))
    added = F.concat("before", end, block)
    changed = F.concat(F.replace("before", F.lit('">'), F.lit('x">')), end, block)
    new = F.when((way == 0) & (F.col("doc_id") % 2 == 1), changed).when(way == 1, F.concat(F.lit("first\n"), added)).when(way == 2, F.regexp_replace(added, r"^[^\n]*\n", "")).when(way == 3, F.concat(added, F.lit("\nlast"))).otherwise(added)
    return d.select("doc_id", N.edit_kept(F.col("before"), new, block).alias("kept"))


@query(r"""WITH RECURSIVE shots AS (SELECT user_id, event_id, ts, epoch_us(ts) / 1000000.0 AS at_, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS i, CASE WHEN event_type <> 'signup' THEN CAST(CAST(floor(value / 40) AS BIGINT) AS VARCHAR) END AS fp, event_type = 'click' AS fresh, event_type = 'error' AS changed FROM events),
walk AS (SELECT user_id, 0::BIGINT AS i, 0::BIGINT AS event_id, NULL::VARCHAR AS fp, NULL::DOUBLE AS last_, 0 AS n, '' AS action FROM (SELECT DISTINCT user_id FROM events)
 UNION ALL SELECT user_id, i, event_id, fp, CASE WHEN fp IS NULL THEN NULL WHEN waits THEN last_ ELSE at_ END, CASE WHEN fp IS NULL THEN 0 WHEN waits THEN n ELSE CASE WHEN same AND NOT changed THEN n ELSE 0 END + 1 END, CASE WHEN fp IS NULL THEN 'idle' WHEN waits THEN 'wait' ELSE 'dispatch' END
 FROM (SELECT *, coalesce(at_ - last_ >= 0 AND at_ - last_ < least(1200 * pow(2, least(greatest(1, n) - 1, 60)), 21600), false) AS waits
  FROM (SELECT s.user_id, s.i, s.event_id, s.at_, s.fp, s.changed, coalesce(s.fp = w.fp, false) AS same, CASE WHEN coalesce(s.fp = w.fp, false) THEN w.n ELSE 0 END AS n, CASE WHEN NOT coalesce(s.fp = w.fp, false) AND s.fresh THEN NULL ELSE w.last_ END AS last_ FROM walk w JOIN shots s ON s.user_id = w.user_id AND s.i = w.i + 1)))
SELECT s.user_id AS queue, s.event_id, s.ts, action, n AS attempts FROM walk w JOIN shots s ON s.user_id = w.user_id AND s.i = w.i WHERE w.i > 0""")
def dispatch_backoff(spark, sf_dir):
    """Each user's events as snapshots of a queue: a sign-up empties it, a click is new input, others change it by value."""
    e = table(spark, sf_dir, "events")
    shots = e.select(F.col("user_id").alias("queue"), "event_id", "ts", F.when(F.col("event_type") != "signup", F.floor(F.col("value") / 40).cast("string")).alias("fingerprint"), (F.col("event_type") == "click").alias("has_input"), (F.col("event_type") == "error").alias("changed_later"))
    return backoff(shots)
