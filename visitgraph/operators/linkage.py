"""Blocked retrieval of devices for documents, and exact lookups."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from visitgraph.functions import text as X
from visitgraph.operators.evidence import confirmed_model, model_evidence_key
from visitgraph.operators.index import device_records, first_wins
from visitgraph.operators.search import containing
from visitgraph.operators.tables import dealt, settled, spent


#: Fixed value: the longest key of which two or three deletions are listed; longer ones are compared by site and model alone.
LONGEST = 20


def neighbours(s: Column, most: int = 1) -> Column:
    """A key and all that up to ``most`` deletions leave of it: two keys ``most`` edits apart share one of these."""
    gone = lambda c: F.transform(F.sequence(F.lit(1), F.length(c)), lambda i: F.concat(F.left(c, i - 1), F.substr(c, i + 1)))
    out = F.concat(F.array(s), gone(s))
    for _ in range(most - 1):
        out = F.array_distinct(F.concat(out, F.flatten(F.transform(F.filter(out, lambda c: c != ""), gone))))
    return F.array_distinct(out)


def parsed_records(records: DataFrame, won: bool = False) -> DataFrame:
    """(gid, serial, location, variant, phones, assets, contacts, job_type, due, order_no, ...) of first-wins records, settled.

    With ``won`` they are first-wins records already.
    """
    # written before anyone filters it: pushed down, the filter would repeat all of the parsing
    d = device_records(records if won else first_wins(records))
    return settled(d.select("weak_identity", "parsed", "gid", X.key(F.col("serial")).alias("serial"), "location", "variant", "phones", "assets", F.transform("contacts", X.text_key).alias("contacts"), "job_type", F.to_date("due").alias("due"), X.order_number(F.col("name")).alias("order_no")))


def record_facts(parsed: DataFrame) -> DataFrame:
    """(gid, serial, site, model, model_name, phones, assets, contacts, job_type, due, order_no) of the ``parsed_records`` with a serial, as evidence keys.

    Site and model keys are worked out on distinct labels only.
    """
    d = parsed.where("NOT weak_identity AND parsed").drop("weak_identity", "parsed")
    places = d.select("location").distinct().withColumn("site", X.key(X.site(F.col("location"))))
    variants = d.select("variant").distinct().withColumn("model", model_evidence_key(F.col("variant"))).withColumn("model_name", confirmed_model(F.col("variant")))
    return d.join(places, "location").join(variants, "variant").drop("location", "variant")


def device_table(facts: DataFrame) -> DataFrame:
    """(device_key, serial, sites, models, phones, assets) of the devices that ``record_facts`` name."""
    some = lambda c: F.collect_set(F.when(F.col(c) != "", F.col(c)))
    flat = lambda c: F.array_distinct(F.flatten(F.collect_set(c)))
    return facts.groupBy(F.col("serial").alias("device_key")).agg(F.first("serial").alias("serial"), some("site").alias("sites"), some("model").alias("models"), flat("phones").alias("phones"), flat("assets").alias("assets"))


def evidence_sets(evidence: DataFrame) -> DataFrame:
    """(doc_id, serials, e_sites, e_models, e_phones, e_assets): all keys of each document, out of its ``evidence_row``."""
    return evidence.select("doc_id", F.sort_array(F.array_union("any_serial", "any_visual")).alias("serials"), *[F.col(f"any_{n}").alias(f"e_{n}s") for n in ("site", "model", "phone", "asset")])


def _hashed(keys: Column) -> Column:
    """Keys by hash, where equal hashes of unlike keys are told apart by what follows."""
    return F.transform(keys, lambda x: F.xxhash64(x))


def _one_edit(ev: DataFrame, dev: DataFrame, most: int) -> DataFrame:
    """(doc_id, k, over, found, closest) of each document, settled: the number of its serials, and the devices within one edit of any.

    ``found`` has each device with its distance, and ``closest`` the least of these. Each distinct serial is looked up
    once. Documents with more than ``most`` devices are ``over``; so are those of a serial that has more itself, and no
    device of such a serial is moved to a document: the list of a document is as short as its serials times ``most``.
    """
    read = ev.select("doc_id", F.explode("serials").alias("s")).where("s <> ''")
    near = read.select("s").distinct().select("s", F.explode(_hashed(neighbours(F.col("s")))).alias("nb"))
    own = dev.select("device_key", "serial", F.explode(_hashed(neighbours(F.col("serial")))).alias("nb"))
    edge = near.join(own, "nb").withColumn("e", F.levenshtein(F.col("s"), F.col("serial"), 1)).where((F.col("e") >= 0) & (F.greatest(F.length("s"), F.length("serial")) >= 2 * F.col("e")))
    edge = edge.select("s", "device_key", "e").repartition("s").groupBy("s", "device_key").agg(F.min("e").alias("e"))
    first = F.row_number().over(Window.partitionBy("s").orderBy("device_key"))
    edge = edge.withColumn("r", first).where(F.col("r") <= most + 1)
    none = F.expr("cast(array() as array<struct<device_key:string,distance:int>>)")
    lists = edge.groupBy("s").agg((F.count("*") > most).alias("full"), F.collect_list(F.struct("device_key", F.col("e").alias("distance"))).alias("near"))
    lists = lists.select("s", "full", F.when(F.col("full"), none).otherwise(F.col("near")).alias("near"))
    per = read.join(lists, "s").groupBy("doc_id").agg(F.bool_or("full").alias("full"), F.sort_array(F.flatten(F.collect_list("near"))).alias("near"))
    # sorted by device, then distance: the first of each device has its least
    found = F.filter("near", lambda x, i: (i == 0) | (F.get("near", i - 1)["device_key"] != x["device_key"]))
    per = ev.select("doc_id", F.size("serials").alias("k")).join(per.withColumn("found", found).drop("near"), "doc_id", "left")
    per = per.withColumn("over", F.coalesce(F.col("full") | (F.size("found") > most), F.lit(False)))
    return settled(per.select("doc_id", "k", "over", F.coalesce(F.when(~F.col("over"), F.col("found")), none).alias("found"), F.when(~F.col("over"), F.array_min(F.col("found")["distance"])).alias("closest")))


def _more_edits(ev: DataFrame, dev: DataFrame, edits: int) -> DataFrame:
    """(doc_id, device_key): devices within ``edits`` of a serial read that share a site and a model with the document."""
    size = F.length("s")
    keys = F.when(size <= LONGEST, neighbours(F.col("s"), edits)).otherwise(F.array(F.lit("")))
    read = ev.select("doc_id", "e_sites", "e_models", F.explode("serials").alias("s")).where("s <> ''")
    # written, so that few documents are known to be few before the devices' keys are listed
    asked = settled(read.select("doc_id", "s", "e_models", F.explode("e_sites").alias("site")).select("doc_id", "s", "site", F.explode("e_models").alias("model")).withColumn("nb", F.explode(keys)))
    size = F.length("serial")
    none = F.expr(X.NO_STRINGS)
    keys = F.concat(F.when(size <= LONGEST + edits, neighbours(F.col("serial"), edits)).otherwise(none), F.when(size > LONGEST - edits, F.array(F.lit(""))).otherwise(none))
    block = dev.select("device_key", "serial", "models", F.explode("sites").alias("site")).select("device_key", "serial", "site", F.explode("models").alias("model")).withColumn("nb", F.explode(keys))
    met = asked.join(block, ["nb", "site", "model"]).where(F.levenshtein(F.col("s"), F.col("serial"), edits) >= 0)
    out = settled(met.select("doc_id", "device_key").distinct())
    spent(asked)
    return out


def _without_serial(ev: DataFrame, dev: DataFrame) -> DataFrame:
    """(doc_id, device_key) of documents without serials: devices that share a phone, a site and a model with them."""
    asked = ev.where(F.size("serials") == 0).select("doc_id", "e_sites", "e_models", F.explode("e_phones").alias("phone")).select("doc_id", "phone", "e_models", F.explode("e_sites").alias("site")).select("doc_id", "phone", "site", F.explode("e_models").alias("model"))
    held = dev.select("device_key", "sites", "models", F.explode("phones").alias("phone")).select("device_key", "phone", "models", F.explode("sites").alias("site")).select("device_key", "phone", "site", F.explode("models").alias("model"))
    return asked.join(held, ["phone", "site", "model"]).select("doc_id", "device_key").distinct()


def retrieve_devices(ev: DataFrame, facts: DataFrame, most: int = 10, edits: int = 3) -> DataFrame:
    """(doc_id, device_key, distance, reason) for documents' ``evidence_sets``: devices whose serial is near enough, or why there are none.

    Within one edit a serial alone is enough; two or three edits also ask for the site and the model. A document without
    serials asks for site, model, phone and asset of exactly one device. More than ``most`` devices within one edit of
    the closest give none at all. Only what can be kept is looked for: two edits where no serial is equal, three where
    none is within one edit, and nothing more once a document is over the limit; all joins are on shared deletions.
    Documents of an equal serial, or over the limit, are done once one edit is known: no pair of theirs is moved again.
    """
    dev = settled(device_table(facts))
    overlap = lambda a, b: F.coalesce(F.arrays_overlap(a, b), F.lit(False))

    def passed(pairs: DataFrame) -> DataFrame:
        d = pairs.join(dev, "device_key").join(ev, "doc_id")
        likeness = F.array_max(F.transform("serials", lambda s: X.similarity(s, F.col("serial"))))
        d = d.withColumn("distance", F.array_min(F.transform("serials", lambda s: F.levenshtein(s, F.col("serial")))))
        placed = overlap("e_sites", "sites") & overlap("e_models", "models")
        with_serial = (F.size("serials") > 0) & (F.col("distance") <= edits) & (likeness >= 0.5) & ((F.col("distance") <= 1) | placed)
        without = (F.size("serials") == 0) & placed & overlap("e_phones", "phones") & overlap("e_assets", "assets")
        return settled(d.where(with_serial | without).select("doc_id", "device_key", F.coalesce("distance", F.lit(0)).alias("distance"), (F.size("serials") == 0).alias("bare")))

    one = _one_edit(ev, dev, most)
    reason = lambda c: c.alias("reason")
    none = [F.lit(None).cast("string").alias("device_key"), F.lit(None).cast("int").alias("distance")]
    ranked = F.lit("serial_first_retrieval")
    done = one.where("over").select("doc_id", *none, reason(F.lit("device_candidate_limit"))).union(one.where("closest = 0").select("doc_id", F.inline("found")).select("*", reason(ranked)))
    open_ = one.where("NOT over AND (closest IS NULL OR closest > 0)")
    parts = [settled(open_.select("doc_id", F.inline("found")).select("*", F.lit(False).alias("bare"))), passed(_without_serial(ev, dev))]
    found = parts[0].union(parts[1])
    for n in range(2, edits + 1):
        state = found.groupBy("doc_id").agg(F.min("distance").alias("closest"), F.count("*").alias("n"))
        rest = open_.where("k > 0").select("doc_id").join(state.where((F.col("closest") < n - 1) | (F.col("n") > most)).select("doc_id"), "doc_id", "left_anti")
        rest = settled(ev.join(rest, "doc_id", "left_semi"))
        pairs = _more_edits(rest, dev, n)
        parts += [passed(pairs.join(found.select("doc_id", "device_key"), ["doc_id", "device_key"], "left_anti"))]
        found = found.union(parts[-1])
        spent(rest, pairs)
    best = found.groupBy("doc_id").agg(F.min("distance").alias("closest"), F.count("*").alias("n"))
    kept = found.join(best, "doc_id").where(F.col("distance") <= F.col("closest") + 1)
    count = kept.groupBy("doc_id").agg(F.count("*").alias("kept"))
    kept = kept.join(count, "doc_id").where(~F.col("bare") | (F.col("n") == 1)).where(F.col("kept") <= most)
    kept = kept.select("doc_id", "device_key", "distance", reason(ranked))
    missing = open_.select("doc_id", "k").join(kept.select("doc_id").distinct(), "doc_id", "left_anti").join(count, "doc_id", "left")
    why = F.when(F.col("k") == 0, "missing_serial_not_unique").when(F.col("kept") > most, "device_candidate_limit").otherwise("index_miss")
    out = settled(done.union(kept).union(missing.select("doc_id", *none, reason(why))))
    spent(one, dev, *parts)
    return out


def pool_serials(ev: DataFrame, facts: DataFrame, devices: DataFrame, most: int = 80, page: int = 60, serials: int = 6) -> DataFrame:
    """(doc_id, over, pool), settled: the serials whose records each document may be of, its devices' and those it reads.

    A serial read that ``page`` records or more bear, more than ``serials`` valid serials, or more than ``most`` records
    in all make it ``over``.
    """
    read = ev.select("doc_id", F.filter("serials", X.valid_serial).alias("valid"))
    read = read.select("doc_id", (F.size("valid") > serials).alias("many"), F.explode_outer("valid").alias("serial"), F.lit(True).alias("read"))
    near = devices.where("device_key IS NOT NULL").select("doc_id", F.lit(False).alias("many"), F.col("device_key").alias("serial"), F.lit(False).alias("read"))
    held = facts.groupBy("serial").agg(F.count("*").alias("hits"))
    d = read.union(near).join(held, "serial", "left")
    # a document has few serials and at most some devices
    g = d.groupBy("doc_id").agg(F.coalesce(F.bool_or(F.col("many") | (F.col("read") & (F.col("hits") >= page))), F.lit(False)).alias("over"), F.collect_set(F.when(F.col("hits").isNotNull(), F.struct("serial", "hits"))).alias("held"))
    size = F.aggregate("held", F.lit(0).cast("long"), lambda n, x: n + x["hits"])
    return settled(g.select("doc_id", (F.col("over") | (size > most)).alias("over"), F.col("held")["serial"].alias("pool")))


def candidate_pool(ev: DataFrame, facts: DataFrame, devices: DataFrame, most: int = 80, page: int = 60, serials: int = 6) -> DataFrame:
    """(doc_id, gid, reason), settled: records to assess for each document, those of its retrieved ``devices`` and those that bear a serial it reads.

    A serial with ``page`` records or more, more than ``serials`` valid serials, or more than ``most`` records in all
    give none and say so: a shortened list could hide a rival.
    """
    pool = pool_serials(ev, facts, devices, most, page, serials)
    kept = pool.where("NOT over").select("doc_id", F.explode("pool").alias("serial")).join(facts.select("serial", "gid"), "serial")
    none = pool.where("over OR size(pool) = 0").select("doc_id", F.lit(None).cast("string").alias("gid"), F.when(F.col("over"), "task_candidate_limit").otherwise("no_live_tasks").alias("reason"))
    out = settled(kept.select("doc_id", "gid", F.lit("live_tasks_read").alias("reason")).union(none))
    spent(pool)
    return out


def lookup_orders(inputs: DataFrame, records: DataFrame) -> DataFrame:
    """(order_no, gid, status): every distinct input with its exact matches; invalid inputs and misses keep a row."""
    asked = inputs.select(F.trim("order_no").alias("order_no")).where("order_no <> ''").distinct().withColumn("valid", F.col("order_no").rlike(r"^[56]\d{7}$"))
    tokens = records.select("gid", F.explode(F.array_distinct(X.all_of(F.col("name"), r"\b[56]\d{7}\b"))).alias("order_no")).distinct()
    return asked.join(tokens, "order_no", "left").select("order_no", "gid", F.when(~F.col("valid"), "invalid").when(F.col("gid").isNull(), "not_found").otherwise("found").alias("status"))


def _some(a: str, holds: Callable[[Column], Column], few: int = 3) -> Column:
    """Whether something of array ``a`` holds: the first ``few`` are told in compiled code, only what lies beyond by a lambda."""
    first = [F.coalesce(holds(F.get(a, i)), F.lit(False)) for i in range(few)]
    return reduce(or_, first) | ((F.size(a) > few) & F.exists(F.slice(a, few + 1, F.greatest(F.size(a), F.lit(1))), holds))


def audit_cases(cases: DataFrame, records: DataFrame, recent: str, page: int = 100, broad: bool = False) -> DataFrame:
    """(doc_id, gid, due, score, reasons, full): records that name a serial, phone or asset of a case, scored by all that they name.

    ``cases`` (doc_id, serials, phones, assets, sites, product) hold texts and are unique by doc_id; ``records`` (gid,
    name, notes, due) are unique by gid. Each term of a case finds the newest ``page`` records that bear it (by due, then
    gid), as a search does that shows one page; ``full`` tells whether some term of the case has more, so that a rival may
    be beyond it. Terms are whole tokens of letters and digits; with ``broad`` they are also the case's sites, product,
    and both together, and a term is borne by any record whose text contains it. Records are scored by what their text
    contains.

    Cases and records meet whole, once a term that at most ``page`` records bear, and a pair is kept where its first such
    term meets: no pair is moved. Only what terms of more records find beyond that is paired by key. Settled: the caller
    may delete it.
    """
    text = F.concat_ws("\n", "name", "notes")
    keys = lambda c, f: F.array_distinct(F.filter(F.transform(F.array_distinct(F.coalesce(c, F.expr(X.NO_STRINGS))), f), lambda x: x != ""))
    c = cases.where("doc_id IS NOT NULL").select("doc_id", keys("serials", X.key).alias("serials"), keys("phones", X.digits).alias("phones"), keys("assets", X.digits).alias("assets"), keys("sites", X.key).alias("sites"), F.coalesce(X.key(F.col("product")), F.lit("")).alias("product"))
    terms = F.concat("serials", "phones", "assets")
    if broad:
        product = F.when(F.col("product") != "", F.array("product")).otherwise(F.expr(X.NO_STRINGS))
        terms = F.concat(terms, "sites", product, F.flatten(F.transform("sites", lambda s: F.transform(product, lambda p: F.concat(s, p)))))
    c = settled(c.withColumn("terms", F.array_distinct(terms)))
    words = lambda c: F.split(F.upper(c), "[^A-Z0-9]+")
    r = records.where("gid IS NOT NULL").select("gid", "due", words(text).alias("words"), F.array_join(words(X.text_of(F.col("name"))), "").alias("title"))
    r = r.select("gid", "due", F.array_join("words", "").alias("body"), "title", F.array_distinct(F.filter("words", lambda w: F.length(w) >= 6)).alias("tokens"))
    r = r.select("gid", "due", "body", F.regexp_replace("body", "[A-Z]+", "").alias("numbers"), "title", "tokens")
    if broad:
        bodies = settled(r.drop("tokens"))
        held = containing(c.select(F.explode("terms").alias("term")), bodies.select("gid", "body"))
        r = settled(bodies.join(held.groupBy("gid").agg(F.collect_set("term").alias("tokens")), "gid"))  # a text contains few terms
        spent(bodies, held)
    else:
        r = settled(r)
    borne = r.select("gid", "due", F.explode("tokens").alias("token"))
    often = settled(borne.groupBy("token").agg(F.count("*").alias("n")).where(F.col("n") > page).select("token"))
    over = settled(c.select("doc_id", F.explode("terms").alias("token")).join(often, "token").groupBy("doc_id").agg(F.collect_set("token").alias("over")))
    told = c.join(over, "doc_id", "left").withColumn("rare", F.when(F.col("over").isNull(), F.col("terms")).otherwise(F.array_except("terms", "over"))).drop("terms")

    n = sum(d.agg(F.coalesce(F.sum(F.size(a)), F.lit(0))).first()[0] for d, a in ((c, "terms"), (r, "tokens")))
    asked = told.withColumn("full", F.col("over").isNotNull()).drop("over").select("*", F.posexplode("rare").alias("at", "token")).withColumn("before", F.slice("rare", F.lit(1), F.col("at"))).drop("rare", "at")
    named = r.select("*", F.explode("tokens").alias("token")).join(often, "token", "left_anti")
    # at most ``page`` records of a term, so the parts to keep in memory are even
    met = dealt(asked, n, "token").join(dealt(named, n, "token").hint("shuffle_hash"), "token").where(~F.arrays_overlap("before", "tokens"))

    # Points of what a record names.
    points = [("serial", _some("serials", lambda x: F.contains("body", x)), 100), ("phone", _some("phones", lambda x: F.contains("numbers", x)), 45), ("asset", _some("assets", lambda x: F.contains("numbers", x)), 30), ("site", _some("sites", lambda x: F.startswith("title", x)), 20), ("product", (F.col("product") != "") & F.contains("title", F.col("product")), 15), ("recent", F.col("due") >= F.lit(recent).cast("date"), 10)]
    score = sum((F.when(F.col(f"_{name}"), n).otherwise(0) for name, _, n in points), F.lit(0))
    reasons = F.concat_ws(";", *[F.when(F.col(f"_{name}"), name) for name, _, _ in points])

    def scored(d: DataFrame) -> DataFrame:
        # what is found is worked out once for both
        d = d.select("doc_id", "gid", "due", "full", *[cond.alias(f"_{name}") for name, cond, _ in points])
        return d.select("doc_id", "gid", "due", score.cast("long").alias("score"), reasons.alias("reasons"), "full")

    found = scored(met)
    if not over.isEmpty():
        many = told.where("over IS NOT NULL").select("doc_id", F.explode("over").alias("token"))
        newest = Window.partitionBy("token").orderBy(F.desc_nulls_last("due"), "gid")
        shown = borne.join(many.select("token").distinct(), "token", "left_semi").withColumn("place", F.row_number().over(newest)).where(F.col("place") <= page)
        pairs = many.join(shown.select("token", "gid"), "token").select("doc_id", "gid").distinct()
        rest = pairs.join(told.where("over IS NOT NULL"), "doc_id").join(r, "gid").where(~F.arrays_overlap("rare", "tokens")).withColumn("full", F.lit(True))
        found = found.union(scored(rest))
    out = settled(found)
    spent(c, r, often, over)
    return out
