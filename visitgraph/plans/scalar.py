"""Queries that apply the text functions to work records, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from visitgraph.functions import models as M
from visitgraph.functions import text as X
from visitgraph.sources.fixtures import DUCK, readings, work_records

QUERIES, SQL = {}, {}
ID = ("gid", "ord1", "ord2")


def query(sql: str, of=work_records):
    """Registers a query over derived records under the function's name."""

    def add(f):
        def run(spark, sf_dir) -> DataFrame:
            return f(of(spark, sf_dir))

        QUERIES[f.__name__] = run
        SQL[f.__name__] = DUCK + sql
        return f

    return add


def joined(a):
    return F.array_join(a, ";")


@query("SELECT gid, ord1, ord2, regexp_replace(upper(name), '[^A-Z0-9]', '', 'g') AS name_key, regexp_replace(upper(project_name), '[^A-Z0-9]', '', 'g') AS project_key FROM work_records")
def norm_key(d):
    return d.select(*ID, X.key(F.col("name")).alias("name_key"), X.key(F.col("project_name")).alias("project_key"))


@query(r"SELECT gid, ord1, ord2, regexp_replace(lower(notes), '[^\pL\pN]', '', 'g') AS text_key, regexp_replace(notes, '[^0-9]', '', 'g') AS digit_key FROM work_records")
def text_and_digit_keys(d):
    return d.select(*ID, X.text_key(F.col("notes")).alias("text_key"), X.digits(F.col("notes")).alias("digit_key"))


@query("""SELECT gid, ord1, ord2, array_to_string(list_filter(l, lambda x, i: x <> '' AND list_position(l, x) = i), ';') AS parts FROM (
 SELECT *, list_transform(string_split(concat(name, '/', name, '/ /', project_name), '/'), lambda x: trim(x)) AS l FROM work_records)""")
def ordered_unique(d):
    return d.select(*ID, joined(X.unique(F.split(F.concat("name", F.lit("/"), "name", F.lit("/ /"), "project_name"), "/"))).alias("parts"))


_DATE_TEXT = "CASE CAST(k % 5 AS INT) WHEN 0 THEN concat('done ', strftime(due_on, '%Y-%m-%d'), 'T08:00') WHEN 1 THEN concat('on ', strftime(due_on, '%d/%m/%y')) WHEN 2 THEN strftime(due_on, '%d.%m.%Y') WHEN 3 THEN '2021-02-31 or 3/4/2021' ELSE 'none' END"


def _date_text():
    y = lambda f: F.date_format("due_on", f)
    k = F.col("k") % 5
    return F.when(k == 0, F.concat(F.lit("done "), y("yyyy-MM-dd"), F.lit("T08:00"))).when(k == 1, F.concat(F.lit("on "), y("dd/MM/yy"))).when(k == 2, y("dd.MM.yyyy")).when(k == 3, "2021-02-31 or 3/4/2021").otherwise("none")


@query(rf"""SELECT gid, ord1, ord2, CAST(CASE WHEN iso <> '' THEN try_strptime(iso, '%Y-%m-%d') WHEN loc <> '' THEN try_strptime(regexp_replace(replace(loc, '.', '/'), '/([0-9]{{2}})$', '/20\1'), '%d/%m/%Y') END AS DATE) AS day FROM (
 SELECT *, CASE WHEN regexp_extract(t, '(^|[^0-9])(20\d\d)[-/.](\d{{1,2}})[-/.](\d{{1,2}})([^0-9]|$)', 0) <> '' AND regexp_extract(t, '(^|[^0-9])(19\d\d)', 0) = '' THEN regexp_extract(t, '(20\d\d[-/.]\d{{1,2}}[-/.]\d{{1,2}})', 1) ELSE '' END AS iso,
  regexp_extract(t, '(^|[^0-9])(\d{{1,2}}[-/.]\d{{1,2}}[-/.]\d{{2,4}})([^0-9]|$)', 2) AS loc FROM (SELECT *, {_DATE_TEXT} AS t FROM work_records))""")
def parse_loose_date(d):
    return d.select(*ID, X.loose_date(_date_text()).alias("day"))


@query(r"""SELECT doc_id, round, CAST(try_strptime(service_date_raw, '%d/%m/%Y') AS DATE) AS day,
 CASE WHEN date_diff('day', CAST(try_strptime(service_date_raw, '%d/%m/%Y') AS DATE), reference_day) BETWEEN -7 AND 93 THEN CAST(try_strptime(service_date_raw, '%d/%m/%Y') AS DATE) END AS in_window,
 CAST(try_strptime(concat('31', substr(service_date_raw, 3)), '%d/%m/%Y') AS DATE) AS last_day FROM readings""", readings)
def parse_action_date(d):
    raw = F.col("service_date_raw")
    return d.select("doc_id", "round", X.action_date(raw).alias("day"), X.action_date_in_window(raw, F.col("reference_day")).alias("in_window"), X.action_date(F.concat(F.lit("31 "), F.substr(raw, F.lit(3)))).alias("last_day"))


@query(r"""SELECT gid, ord1, ord2, CASE CAST(k % 3 AS INT) WHEN 0 THEN CAST(due_on AS DATE) WHEN 1 THEN CAST(due_on + 1 AS DATE) END AS day,
 CASE CAST(k % 3 AS INT) WHEN 1 THEN epoch(CAST(due_on AS TIMESTAMP)) + 64800 ELSE epoch(CAST(due_on AS TIMESTAMP)) + 7200 END AS utc_seconds FROM work_records""")
def local_schedule_day(d):
    day = F.date_format("due_on", "yyyy-MM-dd")
    t = F.when(F.col("k") % 3 == 0, F.concat(day, F.lit("T10:00:00+08:00"))).when(F.col("k") % 3 == 1, F.concat(day, F.lit("T18:00:00Z"))).otherwise(F.concat(day, F.lit("T02:00:00")))
    return d.select(*ID, X.local_day(t).alias("day"), F.unix_timestamp(X.instant(t)).cast("double").alias("utc_seconds"))


@query(r"""SELECT doc_id, round, serial IS NOT NULL AND NOT contains(serial, '?') AND regexp_full_match(regexp_replace(upper(serial), '[^A-Z0-9]', '', 'g'), '[A-Z]{2,3}[A-Z0-9]{6,9}') AND length(regexp_replace(serial, '[^0-9]', '', 'g')) >= 4 AS valid,
 CASE WHEN length(regexp_replace(upper(serial), '[^A-Z0-9]', '', 'g')) BETWEEN 8 AND 12 AND length(regexp_replace(serial, '[^0-9]', '', 'g')) >= 4 THEN regexp_replace(upper(serial), '[^A-Z0-9]', '', 'g') END AS visible FROM readings""", readings)
def serial_token_checks(d):
    s = F.col("serial")
    return d.select("doc_id", "round", X.valid_serial(s).alias("valid"), X.visible_serial(s).alias("visible"))


@query(r"""SELECT gid, ord1, ord2, coalesce(list_filter(l, lambda x: starts_with(x, 'US'))[1], l[1]) AS first_serial, array_to_string(list_filter(m, lambda x, i: regexp_matches(x, '[0-9]') AND list_position(m, x) = i), ';') AS serials FROM (
 SELECT *, regexp_extract_all(upper(name), '\b([A-Z]{2}[A-Z0-9]{6,})\b', 1) AS l, regexp_extract_all(upper(concat(name, chr(10), notes)), '\b[A-Z]{1,4}[A-Z0-9]{5,}\b') AS m FROM work_records)""")
def extract_serials(d):
    return d.select(*ID, X.title_serial(F.col("name")).alias("first_serial"), joined(X.record_serials(F.concat_ws("\n", "name", "notes"))).alias("serials"))


@query(r"SELECT gid, ord1, ord2, nullif(regexp_extract(name, '\b([56]\d{7})\b', 1), '') AS order_no FROM work_records")
def extract_order_numbers(d):
    return d.select(*ID, X.order_number(F.col("name")).alias("order_no"))


_REF = "concat('see ', CASE CAST(k % 3 AS INT) WHEN 0 THEN 'hawo #' WHEN 1 THEN 'WO-' ELSE 'wo ' END, CAST(CASE WHEN k % 2 = 0 THEN 20000000 + k ELSE 300000 + k END AS VARCHAR(20)), ' and HAWO20000001')"


@query(rf"""SELECT gid, ord1, ord2, array_to_string(list_filter(l, lambda x, i: list_position(l, x) = i), ';') AS work_orders FROM (
 SELECT *, list_transform(list_zip(regexp_extract_all(t, '(?i)\b(HAWO|WO)\s*[#.:\-]?\s*(\d{{6,}})\b', 1), regexp_extract_all(t, '(?i)\b(HAWO|WO)\s*[#.:\-]?\s*(\d{{6,}})\b', 2)),
  lambda x: concat(CASE WHEN length(x[2]) = 8 THEN 'HAWO' ELSE upper(x[1]) END, x[2])) AS l FROM (SELECT *, {_REF} AS t FROM work_records))""")
def work_order_keys(d):
    return d.select(*ID, joined(X.work_orders(F.expr(_REF))).alias("work_orders"))


def _record_text():
    return F.concat_ws("\n", "name", "notes")


_PHONE = r"(?i)\b(?:phone|telephone|tel\.?|mobile)\s*(?:no\.?)?\s*[#.:\-]?\s*((?:\+?852[ -]?)?\d{4}[ -]?\d{4})"


@query(rf"""SELECT gid, ord1, ord2, array_to_string(list_transform(regexp_extract_all(notes, '{_PHONE}', 1), lambda x: regexp_replace(x, '[^0-9]', '', 'g')), ';') AS labelled,
 nullif(list_filter([regexp_extract(notes, 'Phone ([0-9]{{8}})', 1)], lambda x: x <> regexp_extract(name, '\b([56]\d{{7}})\b', 1) AND NOT regexp_matches(x, '^[01]'))[1], '') AS unlabelled FROM work_records""")
def extract_phones_index(d):
    t = F.concat_ws("\n", "name", "notes")
    bare = F.regexp_replace(t, r"Phone |Asset# \d+", "")
    taken = X.all_of(F.col("name"), r"(?<!\d)[56]\d{7}(?!\d)")
    return d.select(*ID, joined(X.index_phones(t, F.array_union(taken, X.index_assets(t)))).alias("labelled"), F.try_element_at(X.index_phones(bare, taken), F.lit(1)).alias("unlabelled"))


@query(rf"""SELECT gid, ord1, ord2, array_to_string(list_transform(regexp_extract_all(notes, '{_PHONE}', 1), lambda x: regexp_replace(x, '[^0-9]', '', 'g')), ';') AS labelled,
 regexp_extract(notes, 'Phone ([0-9]{{8}})', 1) AS unlabelled FROM work_records""")
def extract_phones_record(d):
    t = _record_text()
    bare = F.regexp_replace(F.col("notes"), r"Phone |Asset# \d+", "")
    taken = X.all_of(F.col("name"), r"(?<!\d)[56]\d{7}(?!\d)")
    return d.select(*ID, joined(X.record_phones(t, F.array_union(taken, X.record_assets(t)))).alias("labelled"), joined(X.record_phones(bare, F.array_except(taken, taken))).alias("unlabelled"))


@query(r"""SELECT gid, ord1, ord2, regexp_extract(notes, 'Asset# ([0-9]+)', 1) AS index_assets, regexp_extract(notes, 'Asset# ([0-9]+)', 1) AS record_assets,
 concat(substr(a, 1, 4), substr(a, 5)) AS sheet_assets, concat('77', substr(a, 1, 4), ';', a) AS with_orders FROM (SELECT *, regexp_extract(notes, 'Asset# ([0-9]+)', 1) AS a FROM work_records)""")
def extract_assets(d):
    a = F.regexp_extract("notes", r"Asset# ([0-9]+)", 1)
    spaced = F.concat(F.lit("Asset no. "), F.left(a, F.lit(4)), F.lit(" "), F.substr(a, F.lit(5)), F.lit(" x"))
    ordered = F.concat(F.lit("W.O. 77"), F.left(a, F.lit(4)), F.lit(" / "), F.col("notes"))
    t = _record_text()
    return d.select(*ID, *[joined(f(x)).alias(n) for f, x, n in ((X.index_assets, t, "index_assets"), (X.record_assets, t, "record_assets"), (X.sheet_assets, spaced, "sheet_assets"), (X.index_assets, ordered, "with_orders"))])


@query("SELECT gid, ord1, ord2, concat('R', CAST(dev % 40 AS VARCHAR(9)), ' West;', CAST(dev % 9 AS VARCHAR(9)), 'F') AS rooms FROM work_records")
def extract_rooms(d):
    t = F.concat(F.lit("Room: R"), (F.col("dev") % 40).cast("string"), F.lit(" West  phone 1\nfloor "), (F.col("dev") % 9).cast("string"), F.lit("F - Asset "), F.lit("1"))
    return d.select(*ID, joined(X.rooms(t)).alias("rooms"))


@query(r"SELECT gid, ord1, ord2, concat(regexp_extract(notes, 'Contact: (Person [A-Za-z]+)', 1), ';Dr ', upper(regexp_extract(notes, 'Person ([A-Za-z]+)', 1))) AS contacts FROM work_records")
def extract_contacts(d):
    t = F.concat("notes", F.lit("\n2345 6789  Dr "), F.upper(F.regexp_extract("notes", "Person ([A-Za-z]+)", 1)), F.lit("."))
    return d.select(*ID, joined(X.contacts(t)).alias("contacts"))


@query(r"""SELECT gid, ord1, ord2, array_to_string(list_filter(l, lambda x, i: length(x) BETWEEN 5 AND 18 AND regexp_matches(x, '[A-Z]') AND regexp_matches(x, '[0-9]') AND list_position(l, x) = i)[1:8], ';') AS ids FROM (
 SELECT *, list_transform(regexp_extract_all(upper(name), '[A-Z0-9][A-Z0-9./_-]*'), lambda x: regexp_replace(x, '[^A-Z0-9]', '', 'g')) AS l FROM work_records)""")
def action_identifiers(d):
    return d.select(*ID, joined(X.action_identifiers(F.col("name"))).alias("ids"))


_LOC = "trim(string_split(name, ' / ')[1])"


@query(rf"""SELECT gid, ord1, ord2, CASE WHEN s1 <> '' THEN s1 WHEN s2 <> '' THEN s2 ELSE l END AS site, CASE WHEN s1 <> '' THEN trim(d1) WHEN s2 <> '' THEN trim(d2) ELSE '' END AS detail FROM (
 SELECT *, regexp_extract(l, '^([A-Za-z]{{2,8}})\s*-\s*(.+)$', 1) AS s1, regexp_extract(l, '^([A-Za-z]{{2,8}})\s*-\s*(.+)$', 2) AS d1, regexp_extract(l, '^([A-Z]{{2,8}})\s+(.+)$', 1) AS s2, regexp_extract(l, '^([A-Z]{{2,8}})\s+(.+)$', 2) AS d2
 FROM (SELECT *, regexp_replace({_LOC}, '^(\s*\([^)]{{1,40}}\)\s*)+', '') AS l FROM work_records))""")
def split_location(d):
    s, detail = X.split_location(F.split("name", " / ")[0])
    return d.select(*ID, s.alias("site"), detail.alias("detail"))


_SITES = ", ".join(f"('{k}', '{v}')" for k, v in M.SITES.items())
_SITE_SQL = rf"""sites(k, v) AS (VALUES {_SITES}),
loc AS (SELECT *, trim(regexp_replace({_LOC}, '^(\s*\([^)]{{1,40}}\)\s*)+', '')) AS l FROM work_records),
cored AS (SELECT *, trim(regexp_extract(CASE WHEN regexp_matches(l, '^[A-Z]{{2,8}}\s+.') THEN regexp_extract(l, '^([A-Z]{{2,8}})', 1) ELSE l END, '^[^,/\-]*')) AS core FROM loc),
sited AS (SELECT cored.*, CASE WHEN v IS NOT NULL THEN v WHEN regexp_full_match(core, '[A-Za-z]{{2,6}}') THEN NULL
 WHEN len(words) >= 2 AND array_to_string(list_transform(words, lambda w: w[1]), '') IN (SELECT v FROM sites) THEN array_to_string(list_transform(words, lambda w: w[1]), '')
 WHEN length(regexp_replace(upper(core), '[^A-Z0-9]', '', 'g')) >= 5 THEN core END AS site
 FROM (SELECT *, list_filter(regexp_extract_all(upper(core), '[A-Z]+'), lambda w: w NOT IN ('THE', 'OF', 'AND')) AS words FROM cored) cored LEFT JOIN sites ON sites.k = regexp_replace(upper(core), '[^A-Z0-9]', '', 'g'))"""
DUCK_SITES = DUCK.rstrip() + ",\n" + _SITE_SQL


@query("")
def site_canonical(d):
    s, _ = X.split_location(F.split("name", " / ")[0])
    return d.select(*ID, X.site(s).alias("site"))


SQL["site_canonical"] = DUCK_SITES + " SELECT gid, ord1, ord2, site FROM sited"

_MODELS = ", ".join(f"('{k}', '{v}')" for k, v in M.BY_KEY.items())
_FUZZY = ", ".join(f"('{m}', '{M.label_key(m)}')" for m in M.CORRECTABLE)
_MODEL_SQL = rf"""models(k, m) AS (VALUES {_MODELS}), fuzzy(m, k) AS (VALUES {_FUZZY}),
labels AS (SELECT DISTINCT product_raw AS label, regexp_replace(upper(product_raw), '[^A-Z0-9+]', '', 'g') AS t FROM readings),
near AS (SELECT label, fuzzy.m, levenshtein(t, k) AS d FROM labels JOIN fuzzy ON array_to_string(regexp_extract_all(t, '\d+'), ',') = array_to_string(regexp_extract_all(k, '\d+'), ',')
 AND contains(t, '+') = contains(k, '+') AND (NOT starts_with(k, 'CX') OR starts_with(t, 'CX')) AND (NOT regexp_matches(t, '\d') OR regexp_extract(t, '[^0-9]*$') = regexp_extract(k, '[^0-9]*$'))),
best AS (SELECT label, min(d) AS d, arg_min(m, d) AS m FROM near GROUP BY label HAVING min(d) <= 2 AND count_if(d = (SELECT min(n.d) FROM near n WHERE n.label = near.label)) = 1),
canon AS (SELECT labels.label, coalesce(models.m, CASE WHEN length(t) >= 4 THEN best.m END, labels.label) AS model FROM labels LEFT JOIN models ON models.k = t LEFT JOIN best ON best.label = labels.label),
grouped AS (SELECT label, model, list_filter(regexp_extract_all(upper(label), '[A-Z]+'), lambda w: w NOT IN ('PHILIPS', 'SYSTEM', 'ULTRASOUND')) AS w FROM canon)"""


@query("", readings)
def model_canonical(d):
    p = F.col("product_raw")
    labels = d.select("product_raw").distinct().select("product_raw", X.model(p).alias("model"), X.model_family(p).alias("family"), X.model_group(p).alias("model_group"))
    return d.select("doc_id", "round", "product_raw").join(labels, "product_raw").select("doc_id", "round", "model", "family", "model_group")


SQL["model_canonical"] = DUCK.rstrip() + ",\n" + _MODEL_SQL + """
SELECT doc_id, round, model, CASE WHEN model = 'Affiniti 70G' THEN 'Affiniti 70' ELSE model END AS family,
 CASE WHEN starts_with(array_to_string(w, ''), 'AFFINITI') THEN 'AFFINITI' WHEN starts_with(array_to_string(w, ''), 'EPIQ') THEN 'EPIQ' WHEN starts_with(array_to_string(w, ''), 'CX') THEN 'CX' WHEN length(w[1]) >= 2 THEN w[1] END AS model_group
FROM readings JOIN grouped ON label = product_raw"""

_INSPECT = rf"""inspected AS (SELECT seg, CASE WHEN seg = '' THEN 'empty' WHEN regexp_full_match(seg, '(?i)(?:CM|PM|FCO|INS|REPAIR|MAINTENANCE)') THEN 'job_type_not_product'
 WHEN regexp_matches(seg, '(?i)\b(?:HAWO|WO|SR|ORDER|ASSET|PHONE|TEL|CONTACT)\b') THEN 'reference_not_product' WHEN m IS NOT NULL THEN 'confirmed_spelling'
 WHEN len(list_filter(regexp_extract_all(seg, '(?i)\b[A-Z]{{2,3}}[A-Z0-9]{{5,9}}\b'), lambda x: length(regexp_replace(x, '[^0-9]', '', 'g')) >= 4)) > 0 THEN 'serial_not_product'
 WHEN regexp_matches(seg, '\d{{4,}}') THEN 'identifier_not_product' WHEN NOT regexp_full_match(seg, '[A-Za-z0-9+ .-]{{2,50}}') OR NOT regexp_matches(seg, '[A-Za-z]{{2}}') THEN 'non_product_text'
 WHEN NOT regexp_matches(seg, '\d') AND NOT regexp_matches(seg, '(?i)\b(?:PRO|PLUS|ELITE|CVX|XT|IX)\s*$') THEN 'text_needs_review' ELSE 'model_needs_review' END AS reason, m AS canonical
 FROM (SELECT DISTINCT seg FROM segs) s LEFT JOIN (VALUES {_MODELS}) models(k, m) ON models.k = regexp_replace(upper(seg), '[^A-Z0-9+]', '', 'g') AND regexp_full_match(seg, '[A-Za-z0-9+ .-]+'))"""
_STATUS = "CASE WHEN reason = 'confirmed_spelling' THEN CASE WHEN canonical IN ('EPIQ', 'Affiniti', 'CX') THEN 'group_only' ELSE 'confirmed' END WHEN ends_with(reason, '_needs_review') THEN 'unconfirmed' ELSE 'rejected' END"


@query("")
def model_classification(d):
    segs = d.select(*ID, F.posexplode(F.split("name", " / ")).alias("pos", "seg"))
    labels = segs.select("seg").distinct().withColumn("x", X.inspect_model(F.col("seg")))
    return segs.join(labels, "seg").select(*ID, (F.col("pos") + 1).cast("long").alias("pos"), "x.status", "x.reason", F.when(F.col("x.reason") == "confirmed_spelling", F.col("x.canonical")).alias("canonical"))


SQL["model_classification"] = DUCK.rstrip() + rf""",
segs AS (SELECT gid, ord1, ord2, unnest(string_split(name, ' / ')) AS seg, generate_subscripts(string_split(name, ' / '), 1) AS pos FROM work_records),
{_INSPECT}
SELECT gid, ord1, ord2, pos, {_STATUS} AS status, reason, CASE WHEN reason = 'confirmed_spelling' THEN canonical END AS canonical FROM segs JOIN inspected USING (seg)"""


@query(r"""SELECT gid, ord1, ord2, CASE project_name WHEN 'PM Jobs' THEN 'PM' WHEN 'Ultrasound - CM' THEN 'CM' WHEN '2026 Sep' THEN 'PM' END AS container,
 CASE project_name WHEN 'PM Jobs' THEN 'PM' WHEN 'Ultrasound - CM' THEN 'CM' WHEN '2026 Sep' THEN 'PM' END AS record, CASE project_name WHEN 'PM Jobs' THEN 'PM' WHEN 'Ultrasound - CM' THEN 'CM' END AS container_joined,
 CASE project_name WHEN 'PM Jobs' THEN 'PM' WHEN 'Ultrasound - CM' THEN 'CM' WHEN '2026 Sep' THEN 'PM' END AS record_joined FROM work_records""")
def job_type_classification(d):
    p, more = F.col("project_name"), F.concat("project_name", F.lit(" Team A"))
    return d.select(*ID, X.container_type(p).alias("container"), X.record_type(p).alias("record"), X.container_type(more).alias("container_joined"), X.record_type(more).alias("record_joined"))


_SIM = lambda a, b: f"CASE WHEN {a} = '' OR {b} = '' THEN 0.0 ELSE 1 - levenshtein({a}, {b}) / greatest(length({a}), length({b})) END"


@query(rf"""SELECT doc_id, round, round({_SIM("coalesce(serial, '')", "coalesce(s, '')")}, 6) AS serial_similarity, levenshtein(phone, p) AS phone_distance, round({_SIM("upper(replace(product_raw, ' ', ''))", "upper(replace(m, ' ', ''))")}, 6) AS model_similarity
 FROM (SELECT *, max(serial) FILTER (WHERE round = 1) OVER w AS s, max(phone) FILTER (WHERE round = 1) OVER w AS p, max(product_raw) FILTER (WHERE round = 1) OVER w AS m FROM readings WINDOW w AS (PARTITION BY doc_id))""", readings)
def similarity_scores(d):
    b = d.where("round = 1").select("doc_id", F.col("serial").alias("s"), F.col("phone").alias("p"), F.col("product_raw").alias("m"))
    j = d.join(b, "doc_id")
    return j.select("doc_id", "round", F.round(X.similarity(X.key(F.col("serial")), X.key(F.col("s"))), 6).alias("serial_similarity"), F.levenshtein(X.digits(F.col("phone")), X.digits(F.col("p"))).cast("long").alias("phone_distance"), F.round(X.family_similarity(F.col("product_raw"), F.col("m")), 6).alias("model_similarity"))


@query(r"""SELECT doc_id, round, p AS percent, CASE WHEN p IS NULL THEN 0 WHEN asset = b THEN 2 WHEN p >= 70 THEN 1 ELSE 0 END AS level FROM (
 SELECT doc_id, round, asset, b, CASE WHEN asset IS NULL THEN 0 ELSE CAST((200 * (n - levenshtein(asset, b)) + n) // (2 * n) AS INT) END AS p FROM (
  SELECT *, greatest(length(asset), length(b)) AS n FROM (SELECT *, concat(substr(phone, 1, 4), substr(asset, 5)) AS b0, CASE WHEN k3 % 2 = 0 THEN asset ELSE concat(substr(asset, 1, 4), substr(phone, 5)) END AS b FROM (SELECT *, CAST(doc_id AS BIGINT) AS k3 FROM readings))))""", readings)
def asset_match_level(d):
    b = F.when(F.col("doc_id").cast("long") % 2 == 0, F.col("asset")).otherwise(F.concat(F.left("asset", F.lit(4)), F.substr("phone", F.lit(5))))
    one = lambda c: F.when(c.isNull(), F.expr(X.NO_STRINGS)).otherwise(F.array(c))
    return d.select("doc_id", "round", X.asset_percent(F.col("asset"), b).alias("percent"), X.asset_level(one(F.col("asset")), one(b)).alias("level"))


@query(r"""SELECT gid, ord1, ord2, CASE WHEN order_no <> '' THEN concat('SR#', order_no, '.pdf') ELSE concat(title, '.pdf') END AS planned, title FROM (
 SELECT *, regexp_extract(name, '\b([56]\d{7})\b', 1) AS order_no, regexp_replace(replace(name, ' / ', ' - '), '\s+', ' ', 'g') AS title FROM work_records)""")
def planned_output_name(d):
    return d.select(*ID, X.planned_name(F.col("name")).alias("planned"), X.safe_title(F.col("name")).alias("title"))
