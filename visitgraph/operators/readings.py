"""Checking raw readings field by field, and what may be made of references that were misread."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from visitgraph.functions import models as M
from visitgraph.functions import text as X
from visitgraph.operators.tables import settled

NOTHING = ("", "null", "none", "n/a")


def plausible_site(c: Column) -> Column:
    """A known short code, or text of five letters or digits that is no number and doesn't speak of an asset."""

    def judged(k: Column) -> Column:
        return F.when(k.rlike("^[A-Z]{2,6}$"), k.isin(*M.SITES)).otherwise((F.length(k) >= 5) & ~k.rlike("^[0-9]+$"))

    return ~X.text_of(c).rlike(r"(?i)\bASSET\b") & X.bind(site_core(c), judged)


def site_core(c: Column) -> Column:
    """The key of a site text's first part."""
    return X.key(F.split(F.trim(X.text_of(c)), r"[,/\-]", 2)[0])


def normalise_readings(raw: DataFrame, most: int = 3, oldest: int = 93, ahead: int = 7, codes: DataFrame | None = None) -> DataFrame:
    """``raw`` with its fields checked and an array ``rejections`` of (field, reason) beside them.

    Texts: order_no, product_raw, hospital_raw, contact_person_raw, department_room_raw, service_date_raw, date_source;
    arrays of texts: serials, phones, assets, work_orders; and the date reference_day. Words for nothing count as null.
    A list keeps its first ``most`` values and says so. What fails its check is emptied, never mended: readings keep
    only what can be evidence. ``codes`` (code) are short site codes that an index has taught: text for cross-checks, still
    told as unconfirmed. Added: visual_serials (serial-like tokens, valid or not), product, service_date. Models, sites and
    dates are judged once a distinct text; ``raw`` is read once for each of these and once more: settle it first.
    """
    said = lambda c: F.when(~F.lower(F.trim(c)).isin(*NOTHING), F.trim(c))
    texts = ("order_no", "product_raw", "hospital_raw", "contact_person_raw", "department_room_raw", "service_date_raw", "date_source")
    lists = ("serials", "phones", "assets", "work_orders")
    clean = lambda c: F.array_distinct(F.array_compact(F.transform(F.coalesce(F.col(c), F.expr(X.NO_STRINGS)), said)))
    d = raw.withColumns({**{c: said(F.col(c)) for c in texts}, **{f"_over_{c}": F.size(F.coalesce(F.col(c), F.expr(X.NO_STRINGS))) > most for c in lists}, **{c: F.slice(clean(c), 1, most) for c in lists}})
    labels = {
        "product_raw": lambda c: {"_model": X.model(c)},
        "hospital_raw": lambda c: {"_core": site_core(c), "_placed": plausible_site(c), "_unsited": X.site(c).isNull()},
        "service_date_raw": lambda c: {"_day": X.action_date(c)},
    }
    for name, judged in labels.items():
        # written, so that few labels are known to be few and travel to the readings, which stay where they are
        few = settled(d.select(name).where(F.col(name).isNotNull()).distinct().withColumns(judged(F.col(name))))
        d = d.join(few, name, "left")
    if codes is None:
        d = d.withColumn("_taught", F.lit(False))
    else:
        taught = codes.select(F.col("code").alias("_core"), F.lit(True).alias("_taught")).distinct()
        d = d.join(taught, "_core", "left").withColumn("_taught", F.coalesce("_taught", F.lit(False)))
    d = d.drop("_core")
    order, day = X.digits(F.col("order_no")), F.col("_day")
    contact = F.regexp_replace(F.regexp_replace(F.col("contact_person_raw"), r"\s+", " "), r"^[ ,;/#_-]+|[ ,;/#_-]+$", "")
    phone = lambda a: F.transform(a, lambda x: X._local(X.digits(x)))
    numbers = F.transform(F.concat("assets", X.sheet_assets(F.col("department_room_raw"))), X.digits)
    other_date = F.col("date_source").isNotNull() & (F.regexp_replace(F.upper("date_source"), "[^A-Z]", "") != "ACTIONDATE")
    d = d.withColumns({"_order": order, "_contact": contact, "_phones": phone(F.col("phones")), "_numbers": numbers, "_age": F.datediff("reference_day", day), "_other": F.coalesce(other_date, F.lit(False))})
    known = F.coalesce(F.col("_model").isin(*sorted(set(M.BY_KEY.values()))), F.lit(False))
    inside = F.coalesce(F.col("_age").between(-ahead, oldest), F.lit(False))
    bad_date = F.when(F.col("service_date_raw").isNull(), None).when(F.col("_other"), "not_action_date").when(F.col("_age").isNull(), "invalid_date_format").when(~inside, "date_outside_window")
    has = lambda c: F.col(c).isNotNull()
    faults = [
        *[(c, F.when(F.col(f"_over_{c}"), "candidate_limit")) for c in lists],
        ("order_no", F.when(has("order_no") & ~F.col("_order").rlike(r"^[56]\d{7}$"), "invalid_order_format")),
        ("serials", F.when(F.exists("serials", lambda x: ~X.valid_serial(x)), "invalid_serial_format")),
        ("product_raw", F.when(has("product_raw") & ~known, "unconfirmed_product")),
        ("hospital_raw", F.when(has("hospital_raw") & ~(F.col("_placed") | F.col("_taught")), "unconfirmed_hospital_or_wrong_field").when(has("hospital_raw") & F.col("_unsited"), "unconfirmed_short_code")),
        ("contact_person_raw", F.when(has("contact_person_raw") & (F.length(F.regexp_replace("_contact", r"[^\p{L}]", "")) < 2), "contact_without_name")),
        ("phones", F.when(F.exists("_phones", lambda x: F.length(x) != 8), "invalid_phone_length")),
        ("assets", F.when(F.exists("_numbers", lambda x: F.length(x) < 4), "invalid_asset_length")),
        ("work_orders", F.when(F.exists("work_orders", lambda x: F.length(X.digits(x)) < 6), "invalid_work_order_length")),
        ("service_date_raw", bad_date),
    ]
    found = F.array(*[F.when(r.isNotNull(), F.struct(F.lit(f).alias("field"), r.alias("reason"))) for f, r in faults])
    d = d.withColumn("rejections", F.array_compact(found))
    good_site = F.col("_placed") | F.col("_taught")
    tokens = F.array_compact(F.transform("serials", X.visible_serial))
    d = d.withColumns({"product": F.when(known, F.col("_model")), "visual_serials": F.slice(F.array_distinct(tokens), 1, most), "service_date": F.when(bad_date.isNull(), F.col("_day"))})
    d = d.withColumns({
        "order_no": F.when(F.col("_order").rlike(r"^[56]\d{7}$"), F.col("_order")), "serials": F.filter("serials", X.valid_serial), "product_raw": F.when(known, F.col("product_raw")), "hospital_raw": F.when(good_site, F.col("hospital_raw")),
        "contact_person_raw": F.when(F.length(F.regexp_replace("_contact", r"[^\p{L}]", "")) >= 2, F.col("_contact")), "phones": F.array_distinct(F.filter("_phones", lambda x: F.length(x) == 8)),
        "assets": F.slice(F.array_distinct(F.filter("_numbers", lambda x: F.length(x) >= 4)), 1, most), "work_orders": F.filter("work_orders", lambda x: F.length(X.digits(x)) >= 6), "date_source": F.when(F.col("service_date").isNotNull(), "ACTION_DATE")})
    return d.drop("_model", "_placed", "_unsited", "_taught", "_order", "_day", "_contact", "_phones", "_numbers", "_age", "_other", *[f"_over_{c}" for c in lists])


def repair_references(refs: DataFrame, least: int = 2) -> DataFrame:
    """(doc_id, kept, shorter, uncertain): work-order keys that count, and seven-digit misreadings of eight-digit ones.

    ``refs`` (doc_id, round, key, focused) has a row for each reading of a work order. Of two keys read twice the one
    of eight digits that closer readings repeat is kept, if the other lacks one of its digits. Where only a seven-digit
    key repeats, and of two closer readings exactly one names eight digits a single edit away, that one is uncertain.
    """
    per = refs.groupBy("doc_id", "key").agg(F.count_distinct("round").alias("votes"), F.count_distinct(F.when(F.col("focused"), F.col("round"))).alias("near"))
    item = F.struct("key", F.length(X.digits(F.col("key"))).alias("n"), "near", "votes")
    d = per.groupBy("doc_id").agg(F.array_sort(F.collect_list(item)).alias("all"))  # a document's distinct keys, a few
    d = d.withColumn("stable", F.filter("all", lambda x: x["votes"] >= least))
    d = d.withColumns({"full": F.filter("stable", lambda x: x["near"] >= least), "rest": F.filter("stable", lambda x: x["near"] < least), "close": F.filter("all", lambda x: x["near"] > 0)})
    eights = F.filter("close", lambda x: x["n"] == 8)
    one = lambda c: F.try_element_at(c, F.lit(1))
    edits = lambda a, b: F.levenshtein(X.digits(a["key"]), X.digits(b["key"]))
    full, rest = one(F.col("full")), one(F.col("rest"))
    fixed = (F.size("stable") == 2) & (F.size("full") == 1) & (full["n"] == 8) & (rest["n"] == 7) & (edits(full, rest) == 1)
    fixed = F.coalesce(fixed, F.lit(False))
    near = F.aggregate("close", F.lit(0).cast("long"), lambda a, x: a + x["near"])
    unsure = (F.size("stable") == 1) & (one(F.col("stable"))["n"] == 7) & (near == 2) & (F.size(eights) == 1) & (edits(one(F.col("stable")), one(eights)) == 1)
    kept = F.when(fixed, F.array(full["key"])).otherwise(F.transform("stable", lambda x: x["key"]))
    return d.select("doc_id", kept.alias("kept"), F.when(fixed, rest["key"]).alias("shorter"), F.when(unsure, one(eights)["key"]).alias("uncertain"))


def date_evidence(service: Column, days: Column, today: Column, recent: int = 93, near: int = 14) -> Column:
    """struct(delta, corrected): days between a service date and the nearest of ``days`` (sorted dates, not empty).

    A service date more than ``recent`` days from ``today`` may have its year misread: with the year of a recent day it
    counts if it then is within ``near`` days and nearer than before.
    """
    apart = lambda a, b: F.abs(F.datediff(a, b))
    direct = F.array_min(F.transform(days, lambda x: apart(x, service)))
    dated = lambda x: F.try_to_date(F.concat(F.year(x).cast("string"), F.date_format(service, "-MM-dd")), "yyyy-MM-dd")
    moved = F.array_min(F.transform(F.filter(days, lambda x: apart(x, today) <= recent), lambda x: apart(x, dated(x))))
    pair = F.struct(direct.alias("direct"), F.when(apart(service, today) > recent, moved).alias("moved"))
    return X.bind(pair, lambda p: X.bind(F.coalesce((p["moved"] <= near) & (p["moved"] < p["direct"]), F.lit(False)), lambda ok: F.struct(F.when(ok, p["moved"]).otherwise(p["direct"]).alias("delta"), ok.alias("corrected"))))
