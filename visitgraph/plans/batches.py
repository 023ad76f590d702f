"""Batch roll-ups, versions, duplicates, scanned pages and metrics, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from visitgraph.operators.batches import queue_item, segment_jobs, set_fingerprint
from visitgraph.sources.fixtures import table

QUERIES, SQL = {}, {}
STATES = {"error": "outage", "signup": "pending", "purchase": "uploaded", "click": "versioned", "view": "already_exists"}
_STATE = "CASE event_type " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in STATES.items()) + " ELSE event_type END"


def query(sql: str | None, name: str = "events"):
    def add(f):
        QUERIES[f.__name__] = lambda spark, sf_dir: f(table(spark, sf_dir, name))
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def jobs(events: DataFrame) -> DataFrame:
    """(source, job, file_no, ts, state): one row per job result."""
    return events.select(F.col("user_id").alias("source"), F.col("event_id").alias("job"), (F.col("event_id") % 40).alias("file_no"), "ts", F.expr(_STATE).alias("state"))


_JOBS = f"WITH jobs AS (SELECT user_id AS source, event_id AS job, event_id % 40 AS file_no, ts, {_STATE} AS state FROM events) "


def rollup(d: DataFrame) -> DataFrame:
    """Per source: whether all its files are settled by their latest result, and whether any wants attention."""
    last = d.groupBy("source", "file_no").agg(F.max_by("state", F.struct("ts", "job")).alias("state"))
    return last.groupBy("source").agg(F.count("*").alias("files"), F.every(F.col("state") != "outage").alias("final"), F.bool_or(F.col("state").isin("versioned", "pending")).alias("attention"))


@query(_JOBS + """SELECT source, count(*) AS files, bool_and(state <> 'outage') AS final, bool_or(state IN ('versioned', 'pending')) AS attention FROM (
 SELECT source, file_no, arg_max(state, (ts, job)) AS state FROM jobs GROUP BY ALL) GROUP BY ALL""")
def batch_rollup(d):
    return rollup(jobs(d))


@query(_JOBS + """SELECT source, file_no, job, attempts, CASE WHEN state <> 'outage' THEN state WHEN attempts >= 3 THEN 'pending' ELSE 'retryable' END AS state FROM (
 SELECT *, count_if(state = 'outage') OVER (PARTITION BY source, file_no ORDER BY ts, job ROWS UNBOUNDED PRECEDING) AS attempts FROM jobs)""")
def retry_dead_letter(d):
    w = Window.partitionBy("source", "file_no").orderBy("ts", "job").rowsBetween(Window.unboundedPreceding, 0)
    n = jobs(d).withColumn("attempts", F.count_if(F.col("state") == "outage").over(w))
    return n.select("source", "file_no", "job", "attempts", F.when(F.col("state") != "outage", F.col("state")).when(F.col("attempts") >= 3, "pending").otherwise("retryable").alias("state"))


@query("""SELECT digest, n, first_id FROM (SELECT sha256(text) AS digest, count(*) AS n, min(doc_id) AS first_id FROM documents WHERE text IS NOT NULL GROUP BY 1) WHERE n > 1""", "documents")
def exact_duplicates(d):
    return d.where("text IS NOT NULL").groupBy(F.sha2("text", 256).alias("digest")).agg(F.count("*").alias("n"), F.min("doc_id").alias("first_id")).where("n > 1")


@query("""SELECT doc_id, name, CASE WHEN copy > 1 THEN 'already_exists' ELSE 'uploaded' END AS state, CASE WHEN v = 1 THEN concat(name, '.pdf') ELSE concat(name, '_', v, '.pdf') END AS stored FROM (
 SELECT *, dense_rank() OVER (PARTITION BY name ORDER BY first_id) AS v, row_number() OVER (PARTITION BY name, digest ORDER BY doc_id) AS copy FROM (
  SELECT doc_id, source AS name, sha256(coalesce(text, '')) AS digest, min(doc_id) OVER (PARTITION BY source, sha256(coalesce(text, ''))) AS first_id FROM documents))""", "documents")
def versioned_names(d, block: int = 100_000):
    """Same content under one name is stored once; new content takes the next version number by arrival.

    Versions are counted over distinct contents in blocks of ``block`` document ids: a rank within the block plus the
    number of contents in the blocks before it, so that no task sorts all contents of a hot name.
    """
    a = d.select("doc_id", F.col("source").alias("name"), F.sha2(F.coalesce("text", F.lit("")), 256).alias("digest"))
    first = a.groupBy("name", "digest").agg(F.min("doc_id").alias("first_id")).withColumn("block", F.floor(F.col("first_id") / block))
    sizes = first.groupBy("name", "block").agg(F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("name").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    within = F.row_number().over(Window.partitionBy("name", "block").orderBy("first_id"))
    ranked = first.withColumn("r", within).join(sizes.select("name", "block", before.alias("before")), ["name", "block"]).select("name", "digest", "first_id", (F.col("r") + F.col("before")).alias("v"))
    stored = F.concat("name", F.when(F.col("v") > 1, F.concat(F.lit("_"), F.col("v").cast("string"))).otherwise(""), F.lit(".pdf"))
    return a.join(ranked, ["name", "digest"]).select("doc_id", "name", F.when(F.col("doc_id") == F.col("first_id"), "uploaded").otherwise("already_exists").alias("state"), stored.alias("stored"))


def hmac_sha256(key_hex, message):
    """HMAC-SHA256 (hex) of text under a 32-byte key given in hex, from hashes and word-wise exclusive or."""
    def pad(byte: int):
        words = [F.lpad(F.hex(F.conv(F.substr(key_hex, F.lit(8 * i + 1), F.lit(8)), 16, 10).cast("long").bitwiseXOR(F.lit(int(f"{byte:02x}" * 4, 16)))), 8, "0") for i in range(8)]
        return F.unhex(F.concat(*words, F.lit(f"{byte:02x}" * 32)))

    return F.sha2(F.concat(pad(0x5C), F.unhex(F.sha2(F.concat(pad(0x36), F.encode(message, "utf-8")), 256))), 256)


_HMAC = "substr(sha256(unhex(outer_) || unhex(sha256(unhex(inner_) || encode({0})))), 1, 24)"


@query(r"""WITH k AS (SELECT doc_id, source, sha256(coalesce(text, '')) AS k FROM documents),
x AS (SELECT doc_id, source, list_transform(range(0, 32), lambda i: ('0x' || substr(k, 2 * i + 1, 2))::INT) AS b FROM k),
p AS (SELECT doc_id, source, array_to_string(list_transform(b, lambda v: printf('%02x', xor(v, 54))), '') || repeat('36', 32) AS inner_, array_to_string(list_transform(b, lambda v: printf('%02x', xor(v, 92))), '') || repeat('5c', 32) AS outer_ FROM x)
SELECT doc_id, """ + _HMAC.format("'task:' || doc_id") + " AS task_receipt, " + _HMAC.format("'name:' || source") + " AS name_receipt FROM p", "documents")
def keyed_receipts(d):
    k = F.sha2(F.coalesce("text", F.lit("")), 256)
    part = lambda label, c: F.left(hmac_sha256(k, F.concat(F.lit(label), c.cast("string"))), F.lit(24))
    return d.select("doc_id", part("task:", F.col("doc_id")).alias("task_receipt"), part("name:", F.col("source")).alias("name_receipt"))


@query("""SELECT source, count(*) AS calls, sum(n_chars // 1000) AS seconds, sum(n_chars // 4) AS prompt_tokens, sum(n_chars // 40) AS completion_tokens, round(sum(n_chars // 4) * 2e-6 + sum(n_chars // 40) * 8e-6, 4) AS cost FROM documents GROUP BY source""", "documents")
def usage_metrics(d):
    c = lambda n: F.sum(F.floor(F.col("n_chars") / n))
    return d.groupBy("source").agg(F.count("*").alias("calls"), c(1000).alias("seconds"), c(4).alias("prompt_tokens"), c(40).alias("completion_tokens")).withColumn("cost", F.round(F.col("prompt_tokens") * F.lit(2e-6) + F.col("completion_tokens") * F.lit(8e-6), 4))


@query("""SELECT event_type AS queue, CAST(user_id AS VARCHAR) AS name, count(*) AS items, any_value(n) AS files FROM events JOIN (SELECT event_type, count(DISTINCT user_id) AS n FROM events GROUP BY 1) USING (event_type) GROUP BY 1, 2""")
def queue_health(d):
    """One row per queue and file name, with the number of names in the queue beside it."""
    names = d.groupBy(F.col("event_type").alias("queue"), F.col("user_id").cast("string").alias("name")).agg(F.count("*").alias("items"))
    return names.join(names.groupBy("queue").agg(F.count("*").alias("files")), "queue")


@query("""SELECT starts, count(*) AS items, sha256(concat_ws(':', count(*), """ + ", ".join(f"bit_xor(CAST(concat('0x', substr(h, {1 + 15 * i}, 15)) AS BIGINT))" for i in range(4)) + """)) AS fingerprint FROM (
 SELECT DISTINCT time_bucket(INTERVAL 5 MINUTE, ts) AS starts, sha256(concat_ws(':', event_type, event_id, epoch_us(ts))) AS h FROM events) GROUP BY 1""")
def queue_fingerprint(d):
    starts = d.select(F.window("ts", "5 minutes")["start"].alias("starts"), queue_item().alias("h")).distinct()
    return starts.groupBy("starts").agg(F.count("*").alias("items"), set_fingerprint(F.col("h")).alias("fingerprint"))


@query("""SELECT user_id, event_id, ts FROM (SELECT *, row_number() OVER (PARTITION BY user_id, island ORDER BY ts, event_id) AS streak FROM (
 SELECT *, sum(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS island FROM events WHERE event_type IN ('error', 'purchase')) WHERE event_type = 'error') WHERE streak = 3""")
def failure_streak_alert(d):
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    runs = d.where(F.col("event_type").isin("error", "purchase")).withColumn("island", F.count_if(F.col("event_type") == "purchase").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    streak = F.row_number().over(Window.partitionBy("user_id", "island").orderBy("ts", "event_id"))
    return runs.where("event_type = 'error'").withColumn("streak", streak).where("streak = 3").select("user_id", "event_id", "ts")


@query(_JOBS + """SELECT source, job, state, n FROM jobs JOIN (SELECT source, count(*) AS n FROM jobs WHERE state IN ('pending', 'versioned') GROUP BY 1) USING (source) WHERE state IN ('pending', 'versioned')""")
def batch_notices(d):
    """One line per flagged job, with the number of lines of its source's notice."""
    flagged = jobs(d).where(F.col("state").isin("pending", "versioned"))
    return flagged.select("source", "job", "state").join(flagged.groupBy("source").agg(F.count("*").alias("n")), "source")


def vector(d: DataFrame) -> DataFrame:
    name = next(c for c, t in d.dtypes if t.startswith("array"))
    return d.select(d.columns[0], F.col(name).alias("e"))


_HASH = "list_reduce(list_prepend(CAST(0 AS BIGINT), [CASE WHEN e[i] > e[i + 1] THEN 1 ELSE 0 END FOR i IN range(1, len(e))]), lambda a, b: a * 2 + b)"


@query(f"""WITH scans AS (SELECT vec_id * 2 AS id, embedding AS e FROM embeddings UNION ALL
 SELECT vec_id * 2 + 1, list_transform(embedding, lambda x, i: CASE WHEN i = 1 + vec_id % len(embedding) THEN -x ELSE x END) FROM embeddings),
h AS MATERIALIZED (SELECT id, {_HASH} AS h FROM scans), c AS MATERIALIZED (SELECT h, min(id) AS id FROM h GROUP BY 1)
SELECT 'copy' AS kind, c.id, h.id AS id2 FROM h JOIN c USING (h) WHERE h.id > c.id
UNION ALL SELECT 'near', a.id, b.id FROM c a JOIN c b ON a.id < b.id AND bit_count(xor(a.h, b.h)) <= 2""", "embeddings")
def near_duplicate_documents(d):
    """Difference hashes at most 2 of 63 bits apart, of every vector and a rescan of it with one value turned.

    Equal hashes are one class: its first id stands for it, and the others are its copies. Of four bands of such near
    hashes two at least are equal, so classes meet on any two equal bands (some 31 bits), then their bits are counted.
    """
    v = vector(d).toDF("id", "e")
    turned = F.transform("e", lambda x, i: F.when(i == F.col("id") % F.size("e"), -x).otherwise(x))
    scans = v.select(F.explode(F.array(F.struct((F.col("id") * 2).alias("id"), F.col("e").alias("e")), F.struct((F.col("id") * 2 + 1).alias("id"), turned.alias("e")))).alias("s")).select("s.*")
    bits = F.zip_with(F.slice("e", 1, F.size("e") - 1), F.slice("e", 2, F.size("e") - 1), lambda a, b: (a > b).cast("long"))
    h = scans.select("id", F.aggregate(bits, F.lit(0).cast("long"), lambda acc, b: F.shiftleft(acc, 1).bitwiseOR(b)).alias("h"))
    classes = h.groupBy("h").agg(F.min("id").alias("first"))
    copies = h.join(classes, "h").where("id > first").select(F.lit("copy").alias("kind"), F.col("first").alias("id"), F.col("id").alias("id2"))
    band = [F.shiftright("h", 16 * i).bitwiseAND(F.lit(2**16 - 1)) for i in range(4)]
    keys = [F.shiftleft(band[i], 16).bitwiseOR(band[j]) for i in range(4) for j in range(i)]
    bands = classes.select("first", "h", F.posexplode(F.array(*keys)).alias("pair", "part"))
    other = bands.select(F.col("first").alias("id2"), F.col("h").alias("h2"), "pair", "part")
    near = bands.join(other, ["pair", "part"]).where("first < id2").where(F.bit_count(F.col("h").bitwiseXOR(F.col("h2"))) <= 2)
    return copies.union(near.select(F.lit("near").alias("kind"), F.col("first").alias("id"), "id2").distinct())


@query("""SELECT vec_id AS id, round(len(list_filter(embedding, lambda x: x > 0)) / len(embedding), 6) AS density, len(list_filter(embedding, lambda x: x > 0)) / len(embedding) >= 0.03 AS meaningful FROM embeddings""", "embeddings")
def content_density(d):
    v = vector(d)
    share = F.size(F.filter("e", lambda x: x > 0)) / F.size("e")
    return v.select(F.col(v.columns[0]).alias("id"), F.round(share, 6).alias("density"), (share >= 0.03).alias("meaningful"))


@query("""WITH firsts AS (SELECT label, arg_min(embedding, vec_id) AS f FROM embeddings GROUP BY 1)
SELECT vec_id AS id, round(2 * shared / n, 6) AS overlap, 2 * shared >= 0.35 * n AS alike FROM (SELECT vec_id, len(list_filter(range(1, len(f) + 1), lambda i: embedding[i] > 0 AND f[i] > 0)) AS shared,
 len(list_filter(embedding, lambda x: x > 0)) + len(list_filter(f, lambda x: x > 0)) AS n FROM embeddings JOIN firsts USING (label))""", "embeddings")
def dice_similarity(d):
    """Twice the cells dark in both layouts over all dark cells, of each vector and the first of its label."""
    refs = d.groupBy("label").agg(F.min_by("embedding", "vec_id").alias("f"))
    dark = lambda a: F.transform(a, lambda x: (x > 0).cast("int"))
    total = lambda a: F.aggregate(a, F.lit(0), lambda acc, x: acc + x)
    m = d.join(refs, "label").select("vec_id", dark("embedding").alias("a"), dark("f").alias("b"))
    both, n = total(F.zip_with("a", "b", lambda x, y: x * y)), total(F.col("a")) + total(F.col("b"))
    return m.select(F.col("vec_id").alias("id"), F.round(2 * both / n, 6).alias("overlap"), (2 * both >= 0.35 * n).alias("alike"))


#: Pages of a scan: a conversation's turns, whose type is told by role and length.
_PAGE = "CASE WHEN length(text) % 2 = 0 AND role = 'user' THEN 'PM' WHEN role = 'user' THEN 'CM' ELSE '' END"


@query(f"""WITH RECURSIVE pages AS (SELECT conv_id AS source, row_number() OVER w - 1 AS page, count(*) OVER (PARTITION BY conv_id) - row_number() OVER w + 1 AS rest, coalesce({_PAGE}, '') AS kind FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)),
ends AS MATERIALIZED (SELECT p.source, p.page, p.kind, CASE WHEN p.kind = 'CM' AND (rest = 2 OR n2.kind <> '') THEN 2 WHEN p.kind <> 'PM' THEN -1 WHEN rest = 6 OR n6.kind <> '' THEN 6 WHEN n4.kind <> '' THEN 4 WHEN n2.kind <> '' THEN 2 WHEN rest IN (2, 4) THEN rest ELSE -1 END AS size
 FROM pages p LEFT JOIN (SELECT source, page - 2 AS page, kind FROM pages) n2 USING (source, page) LEFT JOIN (SELECT source, page - 4 AS page, kind FROM pages) n4 USING (source, page) LEFT JOIN (SELECT source, page - 6 AS page, kind FROM pages) n6 USING (source, page)),
walk AS (SELECT source, page, kind, size FROM ends WHERE page = 0 UNION ALL SELECT e.source, e.page, e.kind, e.size FROM walk w JOIN ends e ON e.source = w.source AND e.page = w.page + w.size WHERE w.size > 0)
SELECT source, page AS starts, page + size AS ends, kind FROM walk WHERE source NOT IN (SELECT source FROM walk WHERE size < 0)
UNION ALL SELECT source, NULL, NULL, 'needs_review' FROM walk WHERE size < 0""", "conversations")
def boundary_segmentation(d):
    return segment_jobs(d.select(F.col("conv_id").alias("source"), F.col("turn").alias("page"), F.coalesce(F.expr(_PAGE), F.lit("")).alias("kind")))


@query(f"""WITH pages AS MATERIALIZED (SELECT vec_id // 4 AS job, vec_id, CASE WHEN label % 3 = 0 THEN 'CM' ELSE 'PM' END AS page_type, len(list_filter(embedding, lambda x: x > 0)) / len(embedding) >= 0.4 AS kept,
 list_transform([1, 2, 3, 4, 5, 6, 7, 8], lambda i: CASE WHEN embedding[i] > embedding[i + 1] THEN 1 ELSE 0 END) AS bits FROM embeddings),
typed AS MATERIALIZED (SELECT p.*, t.job_type, row_number() OVER (PARTITION BY job ORDER BY vec_id) AS place FROM pages p JOIN (SELECT job, arg_min(page_type, vec_id) AS job_type FROM pages GROUP BY 1) t USING (job) WHERE kept),
dup AS (SELECT DISTINCT a.job FROM typed a JOIN typed b ON a.job = b.job AND 1 < a.place AND a.place < b.place AND a.bits = b.bits)
SELECT job, job_type, n AS pages, CASE WHEN n <> CASE job_type WHEN 'PM' THEN 4 ELSE 1 END THEN 'missing_pages' WHEN job_type = 'PM' AND job IN (SELECT job FROM dup) THEN 'repeated_page' ELSE 'complete' END AS state
FROM (SELECT p.job, any_value(j.job_type) AS job_type, count_if(p.kept) AS n FROM pages p JOIN (SELECT job, arg_min(page_type, vec_id) AS job_type FROM pages GROUP BY 1) j ON j.job = p.job GROUP BY 1)""", "embeddings")
def completeness_check(d):
    """Jobs of four scanned pages: one page with content wanted of a CM job, four of a PM job, whose last three must differ in their coarse hash."""
    dark = F.size(F.filter("embedding", lambda x: x > 0)) / F.size("embedding")
    bits = F.array(*[F.get("embedding", F.lit(i)) > F.get("embedding", F.lit(i + 1)) for i in range(8)])
    pages = d.select(F.floor(F.col("vec_id") / 4).alias("job"), "vec_id", F.when(F.col("label") % 3 == 0, "CM").otherwise("PM").alias("page_type"), (dark >= 0.4).alias("kept"), bits.alias("bits"))
    kept = F.sort_array(F.collect_list(F.when(F.col("kept"), F.struct("vec_id", "bits"))))
    jobs_ = pages.groupBy("job").agg(F.min_by("page_type", "vec_id").alias("job_type"), kept.alias("kept"))
    lists = F.transform(F.slice("kept", 2, 8), lambda x: x["bits"])
    repeated = F.size(F.array_distinct(lists)) < F.size(lists)
    state = F.when(F.size("kept") != F.when(F.col("job_type") == "PM", 4).otherwise(1), "missing_pages").when((F.col("job_type") == "PM") & repeated, "repeated_page").otherwise("complete")
    return jobs_.select("job", "job_type", F.size("kept").cast("long").alias("pages"), state.alias("state"))


_NAME = "concat('Scan ', {stamp}, '_', user_id, CASE event_type WHEN 'purchase' THEN concat('__job', event_id % 40, '_PM.pdf') WHEN 'view' THEN concat('__job', event_id % 40, '_CM.pdf') WHEN 'error' THEN '_pm.PDF' ELSE '.pdf' END)"


@query(f"""SELECT event_id, nullif(regexp_extract(name, '_(CM|PM)[.]pdf$', 1), '') AS job_type, nullif(regexp_extract(name, '^(.+)__job[0-9]+_(CM|PM)[.]pdf$', 1), '') AS stem,
 concat(regexp_replace(regexp_replace(name, '[.][^.]*$', ''), '[^A-Za-z0-9_.-]', '_', 'g'), '.json') AS report, regexp_replace(regexp_extract(name, '(20[0-9]{{12}})', 1), '^(.{{8}})(.{{4}}).*$', '\\1-\\2') AS tag
 FROM (SELECT *, {_NAME.format(stamp="strftime(ts, '%Y%m%d%H%M%S')")} AS name FROM events)""")
def filename_facets(d):
    """Type, scan, report and version tag that the name of a split file bears."""
    name = F.expr(_NAME.format(stamp="date_format(ts, 'yyyyMMddHHmmss')"))
    part = lambda p, g: F.nullif(F.regexp_extract(name, p, g), F.lit(""))
    stem = F.regexp_replace(F.regexp_replace(name, r"\.[^.]*$", ""), "[^A-Za-z0-9_.-]", "_")
    stamp = part(r"(?<!\d)(20\d{12})(?!\d)", 1)
    return d.select("event_id", part(r"_(CM|PM)\.pdf$", 1).alias("job_type"), part(r"(?i)^(.+)__job\d+_(?:CM|PM)\.pdf$", 1).alias("stem"), F.concat(stem, F.lit(".json")).alias("report"), F.concat_ws("-", F.substr(stamp, F.lit(1), F.lit(8)), F.substr(stamp, F.lit(9), F.lit(4))).alias("tag"))
