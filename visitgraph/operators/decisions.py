"""Judging candidate records against a document's evidence, and choosing one visit or saying why there is none."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from visitgraph.functions import models as M
from visitgraph.functions import text as X
from visitgraph.operators.evidence import votes

NAMES = {"serial_candidates": "serial", "serial_visual_candidates": "visual", "order_no": "order", "hospital_raw": "site", "product_raw": "model", "product_model": "model_name", "phone_candidates": "phone", "asset_candidates": "asset", "contact_person_raw": "contact", "service_date_raw": "date"}
#: Points by serial distance, and for what else agrees.
SERIAL_POINTS = {0: 100, 1: 80, 2: 60, 3: 40}
POINTS = {"site": 25, "model": 20, "phone": 30, "contact": 5, "asset_exact": 10, "asset_near": 5}


def evidence_row(readings: DataFrame, keys: DataFrame) -> DataFrame:
    """One row per document: for each field the keys read (``any_*``) and those read twice or more (``two_*``), sorted."""
    of = lambda f, least: F.array_sort(F.collect_set(F.when((F.col("field") == f) & (F.col("votes") >= least), F.col("key"))))
    row = votes(keys.repartition("doc_id")).groupBy("doc_id").agg(*[of(f, least).alias(f"{side}_{n}") for f, n in NAMES.items() for side, least in (("any", 1), ("two", 2))])
    days = readings.groupBy("doc_id").agg(F.min("reference_day").alias("reference_day"))
    none = F.expr(X.NO_STRINGS)
    row = days.join(row, "doc_id", "left")
    return row.select("doc_id", "reference_day", *[F.coalesce(c, none).alias(c) for c in row.columns[2:]])


def least_edits(wanted: Column, stored: Column) -> Column:
    return F.array_min(F.transform(wanted, lambda s: F.levenshtein(s, stored)))


def meets(a: Column, b: Column) -> Column:
    return F.arrays_overlap(a, b)


#: What records of a device say alike, but for their type, day and order.
PROFILE = ("site", "model", "model_name", "phones", "assets", "contacts")


def profiles(pool: DataFrame, facts: DataFrame, most: int = 80) -> DataFrame:
    """(doc_id, serial, ..., visits): each document of ``pool`` (doc_id, over, pool) with what records of its serials say, once what all of them say alike.

    ``visits`` are these records (gid, job_type, due, order_no). A serial with more than ``most`` records is in no pool
    that isn't over, so a list is never longer.
    """
    few = facts.groupBy("serial").agg(F.count("*").alias("hits")).where(F.col("hits") <= most).select("serial")
    said = facts.join(few, "serial", "left_semi").groupBy("serial", *PROFILE).agg(F.collect_list(F.struct("gid", "job_type", "due", "order_no")).alias("visits"))
    return pool.where("NOT over").select("doc_id", F.explode("pool").alias("serial")).join(said, "serial")


def assess(pool: DataFrame, evidence: DataFrame, facts: DataFrame, types: DataFrame) -> DataFrame:
    """(doc_id, gid, ..., distance, score, ok, needs_date) for each record of the ``pool`` (``pool_serials``) of a document.

    A document is judged once against all records of a device that say alike; their types, days and orders follow.
    ``types`` (doc_id, doc_type) is the job type each document is of. The gates go by how far the nearest serial read is
    from the record's: equal ones need the model and either a repeated serial or the site; a single edit also passes
    without a known site if model and phone agree, but then needs a date unless model, phone, asset and nearest serial
    all repeat; two or three edits need site, model and phone or asset; without any serial all four must agree.
    """
    d = profiles(pool, facts).join(evidence, "doc_id").join(types, "doc_id")
    one = lambda c: F.when(F.col(c) != "", F.array(c)).otherwise(F.expr(X.NO_STRINGS))
    serials, twice = F.array_union("any_serial", "any_visual"), F.array_union("two_serial", "two_visual")
    d = d.withColumns({"serials": serials, "twice": twice, "sites": one("site"), "models": one("model")})
    d = d.withColumns({"distance": least_edits(F.col("serials"), F.col("serial")), "nearest": F.transform("twice", lambda s: F.levenshtein(s, F.col("serial")))})
    clash = lambda two, own: (F.size(two) > 0) & (F.size(own) > 0) & ~meets(F.col(two), F.col(own))
    near_name = F.exists("any_contact", lambda a: F.exists("contacts", lambda b: X.similarity(a, b) >= 0.75))
    d = d.withColumns({"has_site": meets(F.col("two_site"), F.col("sites")), "has_model": meets(F.col("two_model"), F.col("models")), "has_phone": meets(F.col("any_phone"), F.col("phones")), "has_contact": near_name, "asset_level": X.asset_level(F.col("any_asset"), F.col("assets")), "repeated": F.array_contains("twice", F.col("serial")), "clash": clash("two_site", "sites") | clash("two_model", "models")})
    close = F.array_min("nearest")
    exact = (F.col("model_name") != "") & (F.col("two_model_name") == F.array("model_name")) & meets(F.col("two_phone"), F.col("phones")) & (F.size("two_asset") == 1) & meets(F.col("two_asset"), F.col("assets"))
    lone = F.coalesce((close <= 2) & (F.size(F.filter("nearest", lambda n: n == close)) == 1), F.lit(False))
    strict = F.col("has_site") & F.col("has_model") & (F.col("has_phone") | (F.col("asset_level") == 2))
    no_site = (F.size("two_site") == 0) & F.col("has_model") & F.col("has_phone")
    same = F.col("has_model") & ((F.col("repeated") & F.col("has_site")) | (F.col("has_phone") & (F.col("repeated") | F.col("has_site"))))
    bare = F.col("has_site") & F.col("has_model") & F.col("has_phone") & (F.col("asset_level") == 2)
    safe = F.when(F.size("serials") == 0, bare).when(F.col("distance") > 3, False).when(F.col("distance") == 0, same).when(F.col("distance") == 1, strict | no_site).otherwise(strict)
    points = lambda cond, n: F.when(cond, n).otherwise(0)
    serial_points = F.coalesce(F.element_at(F.create_map(*[F.lit(x) for kv in SERIAL_POINTS.items() for x in kv]), F.col("distance")), F.lit(0))
    score = serial_points + points(F.col("has_site"), POINTS["site"]) + points(F.col("has_model"), POINTS["model"]) + points(F.col("has_phone"), POINTS["phone"]) + points(F.col("has_contact"), POINTS["contact"]) + F.when(F.col("asset_level") == 2, POINTS["asset_exact"]).when(F.col("asset_level") == 1, POINTS["asset_near"]).otherwise(0)
    sure = F.array_contains("two_serial", F.col("serial")) & meets(F.col("two_phone"), F.col("phones")) & (F.size("two_date") == 1)
    d = d.select("doc_id", "doc_type", "serial", "distance", "asset_level", "has_site", "has_model", "has_phone", "has_contact", score.alias("score"), (~F.col("clash") & safe).alias("fits"), ((F.col("distance") == 1) & no_site & ~(exact & lone)).alias("needs_date"), sure.alias("sure"), "two_order", "visits")
    d = d.select("*", F.inline("visits")).drop("visits")
    ok = (F.col("job_type") == F.col("doc_type")) & F.col("fits")
    ordered = (F.size("two_order") == 0) | F.array_contains("two_order", F.col("order_no"))
    return d.withColumns({"ok": F.coalesce(ok, F.lit(False)), "ordered": ordered}).drop("two_order", "fits")


def select_visit(evidence: DataFrame, assessed: DataFrame, window: int = 14, gap: int = 15, prior: bool = True) -> DataFrame:
    """(doc_id, gid, reason): the one visit that a document records, or null and the first rule that refused.

    Order of rules: conflicting models; no confirmed record; pages of different sites or models; conflicting or unmet
    order numbers; devices within ``gap`` points; conflicting dates; with a date, visits within ``window`` days, of which
    the nearest must be alone or ``gap`` ahead; without one, a single visit in the months around the reference day, but
    only if ``prior`` allows that. Ties refuse. Every document keeps a row.
    """
    docs = evidence.select("doc_id", "reference_day", "mixed", ((F.size("two_model_name") > 1) & F.arrays_overlap("two_model_name", F.array(*map(F.lit, M.EXACT_ONLY)))).alias("models"), F.size("two_order").alias("orders"), F.size("two_date").alias("dates"), F.to_date(F.try_element_at("two_date", F.lit(1))).alias("day"))
    good = assessed.where("ok").select("doc_id", "gid", "serial", "score", "needs_date", "due", "ordered")
    any_ = good.groupBy("doc_id").agg(F.count("*").alias("confirmed"), F.count_if("ordered").alias("with_order"))
    devices = good.where("ordered").groupBy("doc_id", "serial").agg(F.max("score").alias("top"))
    rank = Window.partitionBy("doc_id").orderBy(F.desc("top"), "serial")
    devices = devices.withColumns({"place": F.row_number().over(rank), "lead": F.col("top") - F.lead("top").over(rank)}).where("place = 1")
    visits = good.where("ordered").join(devices.select("doc_id", "serial", "lead"), ["doc_id", "serial"]).join(docs.select("doc_id", "day", "reference_day"), "doc_id")
    away = F.abs(F.datediff("due", "day"))
    visits = visits.withColumn("away", F.when(away <= window, away)).withColumn("month", F.col("due").between(F.add_months("reference_day", -1), F.add_months("reference_day", 1)))
    order = Window.partitionBy("doc_id").orderBy(F.col("away").asc_nulls_last(), F.desc("score"), "gid")
    visits = visits.withColumns({"place": F.row_number().over(order), "away_2": F.lead("away").over(order), "score_2": F.lead("score").over(order)})
    best = visits.groupBy("doc_id").agg(F.max("lead").alias("lead"), F.bool_or("needs_date").alias("needs_date"), F.count_if("month").alias("in_month"), F.max(F.when(F.col("month"), F.col("gid"))).alias("month_gid"), F.max(F.when(F.col("place") == 1, F.struct("gid", "away", "score", "away_2", "score_2"))).alias("first"))
    d = docs.join(any_, "doc_id", "left").join(best, "doc_id", "left")
    tied = (F.col("first.away_2") == F.col("first.away")) & (F.col("first.score_2") >= F.col("first.score") - gap)
    reason = (
        F.when(F.col("models"), "repeated_product_models_conflict")
        .when(F.col("confirmed").isNull(), "live_identity_not_confirmed")
        .when(F.col("mixed"), "crosspage_identity_conflict")
        .when(F.col("orders") > 1, "repeated_order_conflict")
        .when(F.col("with_order") == 0, "live_order_conflict")
        .when(F.col("lead") < gap, "live_devices_tied")
        .when(F.col("dates") > 1, "repeated_dates_conflict")
        .when(F.col("day").isNotNull() & F.col("first.away").isNull(), "live_visit_date_conflict")
        .when(F.col("day").isNotNull() & F.coalesce(tied, F.lit(False)), "live_visits_tied")
        .when(F.col("day").isNotNull(), "action_date_live_visit_confirmed")
        .when(F.col("needs_date"), "missing_hospital_fuzzy_needs_action_date")
        .when(F.col("reference_day").isNull(), "upload_date_unknown")
        .when(F.lit(not prior), "need_crosspage_before_upload_prior")
        .when(F.col("in_month") != 1, "upload_prior_not_unique")
        .otherwise("upload_prior_live_visit_confirmed")
    )
    d = d.withColumn("reason", reason)
    gid = F.when(F.col("reason") == "action_date_live_visit_confirmed", F.col("first.gid")).when(F.col("reason") == "upload_prior_live_visit_confirmed", F.col("month_gid"))
    return d.select("doc_id", gid.alias("gid"), "reason")


#: Points of the general score, by serial distance and by what else agrees.
WEIGHTS = {"type": 35, "serial": {0: 100, 1: 70, 2: 50, 3: 30}, "phone": 45, "phone_near": 20, "asset": 35, "asset_near": 15, "site": 20, "model": 15, "contact": 8, "contact_near": 5, "days_3": 50, "days_14": 40, "days_31": 25, "conflict": -1000}


def weigh(pool: DataFrame, evidence: DataFrame, facts: DataFrame, types: DataFrame) -> DataFrame:
    """(doc_id, gid, distance, delta, score) for each record of the ``pool`` (``pool_serials``) of a document: the general score, a sum of weights.

    A date more than 31 days from the record's day excludes the pair, whatever else agrees: its score is the conflict's.
    A field that the document or the record lacks adds nothing.
    """
    d = profiles(pool, facts).join(evidence, "doc_id").join(types, "doc_id")
    w = WEIGHTS
    serials = F.array_union("any_serial", "any_visual")
    has = lambda xs, ys, f: F.exists(xs, lambda a: F.exists(ys, lambda b: f(a, b)))
    contact = F.coalesce(F.array_max(F.flatten(F.transform("any_contact", lambda a: F.transform("contacts", lambda b: X.similarity(a, b))))), F.lit(0.0))
    d = d.withColumns({"distance": least_edits(serials, F.col("serial")), "_level": X.asset_level(F.col("any_asset"), F.col("assets")), "_contact": contact})
    near_phone = has("any_phone", "phones", lambda a, b: (F.length(a) == F.length(b)) & (F.levenshtein(a, b, 1) >= 0))
    if_ = lambda cond, n: F.when(cond, n).otherwise(0)
    one_of = lambda *cases: F.coalesce(*[F.when(c, n) for c, n in cases], F.lit(0))
    alike = (
        one_of(*[(F.col("distance") == k, n) for k, n in w["serial"].items()])
        + one_of((meets(F.col("any_phone"), F.col("phones")), w["phone"]), (near_phone, w["phone_near"]))
        + one_of((F.col("_level") == 2, w["asset"]), (F.col("_level") == 1, w["asset_near"]))
        + if_(F.array_contains("any_site", F.col("site")), w["site"])
        + if_(F.array_contains("any_model", F.col("model")), w["model"])
        + one_of((F.col("_contact") >= 0.9, w["contact"]), (F.col("_contact") >= 0.75, w["contact_near"]))
    )
    d = d.select("doc_id", "doc_type", "distance", alike.alias("alike"), F.transform("any_date", lambda x: F.to_date(x)).alias("days"), "visits").select("*", F.inline("visits"))
    d = d.withColumn("delta", F.array_min(F.transform("days", lambda x: F.abs(F.datediff(x, F.col("due"))))))
    score = F.col("alike") + if_(F.col("job_type") == F.col("doc_type"), w["type"]) + one_of(*[(F.col("delta") <= n, w[f"days_{n}"]) for n in (3, 14, 31)])
    return d.select("doc_id", "gid", "distance", "delta", F.when(F.col("delta") > 31, w["conflict"]).otherwise(score).alias("score"))
