"""Reviews after a decision: what a delivered record still lacks, and names for a device whose visits stay tied."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from visitgraph.functions import notes as N
from visitgraph.functions import text as X
from visitgraph.functions.reviews import company_order

#: Statuses that ask nobody for anything.
QUIET = ("company_order_exists",)


def post_delivery(matched: DataFrame) -> DataFrame:
    """(doc_id, status, attention, order_no, draft) of every matched document, by its record as it stands now.

    ``matched`` has doc_id, gid, doc_type, matched_name and the record's custom_fields, name, notes, job_type, due_at
    (timestamp), prior_block, issue_read (a label read elsewhere). In order: no record or type; a company order exists; the
    record's type changed; a PM lacks its order; the block written before is still there; its name changed; no schedule;
    fault and visit are noted already; no reliable label; else ``preview`` with a draft of label, day and time. Nothing
    is written to a record. Null notes are empty; a null prior block is none.
    """
    order = company_order(F.col("custom_fields"), F.col("name"))
    d = matched.withColumns({"order_no": order, "fault": N.fault_text(F.col("notes"))})
    d = d.withColumns({"noted": N.has_visit_record(F.col("notes"), F.to_date("due_at")), "issue": F.coalesce(N.issue_label(F.col("fault")), F.col("issue_read"))})
    labelled = F.col("issue").rlike(r"^[A-Za-z]+(?:[ -][A-Za-z]+){1,4}\z") & F.lower("issue").endswith(" issue")
    prior = (X.text_of(F.col("prior_block")) != "") & F.contains(X.text_of(F.col("notes")), F.col("prior_block"))
    status = (
        F.when((X.text_of(F.col("gid")) == "") | ~X.text_of(F.col("doc_type")).isin("PM", "CM"), "task_unconfirmed")
        .when(F.col("order_no").isNotNull(), "company_order_exists")
        .when(~F.col("job_type").eqNullSafe(F.col("doc_type")), "task_type_changed")
        .when(F.col("doc_type") == "PM", "pm_missing_order")
        .when(F.coalesce(prior, F.lit(False)), "description_complete")
        .when(~F.col("name").eqNullSafe(F.col("matched_name")), "task_changed")
        .when(F.col("due_at").isNull(), "missing_schedule")
        .when((F.col("fault") != "") & F.col("noted"), "description_complete")
        .when(~F.coalesce(labelled, F.lit(False)), "issue_needs_review")
        .otherwise("preview")
    )
    d = d.withColumn("status", status)
    draft = F.concat("issue", F.lit("\n"), F.date_format("due_at", "d/M HH:mm"))
    return d.select("doc_id", "status", (~F.col("status").isin(*QUIET)).alias("attention"), F.when(F.col("status") == "company_order_exists", F.col("order_no")).alias("order_no"), F.when(F.col("status") == "preview", draft).alias("draft"))


def neutral_names(ask: DataFrame, serials: DataFrame, facts: DataFrame, labels: DataFrame, window: int = 14) -> DataFrame:
    """(doc_id, device_key, visits, name): documents whose device is certain while several of its visits stay tied.

    One repeated serial (``serials``: doc_id, two_serial), a date, a phone; a record of that serial with the document's
    model and site; and two or more visits of its type within ``window`` days that bear the phone, so that no field tells
    them apart. The name is made of the site and model as read (``labels``: doc_id, hospital, product) and the serial; it
    claims no visit. Documents that don't qualify give no row.
    """
    one = serials.where(F.size("two_serial") == 1).select("doc_id", F.col("two_serial")[0].alias("serial"))
    d = ask.where("day IS NOT NULL AND doc_type IN ('PM', 'CM')").join(one, "doc_id").join(facts, "serial")
    same = F.coalesce(F.array_contains("w_models", F.col("model")) & F.array_contains("w_sites", F.col("site")), F.lit(False))
    tied = (F.col("job_type") == F.col("doc_type")) & (F.abs(F.datediff("due", "day")) <= window) & F.arrays_overlap("w_phones", "phones")
    g = d.groupBy("doc_id", "serial").agg(F.bool_or(same).alias("sure"), F.count_distinct(F.when(F.coalesce(tied, F.lit(False)) & same, F.col("gid"))).alias("visits"))
    g = g.where("sure AND visits >= 2").join(labels, "doc_id")
    return g.select("doc_id", F.col("serial").alias("device_key"), "visits", X.safe_title(F.concat_ws(" - ", "hospital", "product", "serial")).alias("name"))


def confirm_references(pairs: DataFrame, orders: DataFrame, uncertain: DataFrame, own: DataFrame) -> DataFrame:
    """(doc_id, gid, reference): uncertain work orders that a company order and the whole identity confirm.

    ``pairs`` are assessed (document, record) pairs, ``sure`` where serial and phone repeat and the date is one; ``orders`` (doc_id, order) the one order that closer readings
    repeat; ``uncertain`` (doc_id, uncertain) the eight-digit reference that repeated readings lack a digit of; ``own``
    (gid, references) what records bear. All must meet: the record's order, its reference, an equal serial read twice,
    model, site, a repeated phone, and a single date. Documents without any of these give no row.
    """
    d = pairs.join(orders, "doc_id").join(uncertain.where("uncertain IS NOT NULL"), "doc_id").join(own, "gid")
    same = (F.col("order_no") == F.col("order")) & F.array_contains("references", F.col("uncertain"))
    whole = (F.col("distance") == 0) & F.col("has_model") & F.col("has_site") & F.col("sure")
    return d.where(same & whole).select("doc_id", "gid", F.col("uncertain").alias("reference"))
