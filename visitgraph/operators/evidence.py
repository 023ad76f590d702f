"""Votes and consensus over repeated field readings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from visitgraph.functions import models as M
from visitgraph.functions import text as X
from visitgraph.operators.tables import dealt, settled


def model_evidence_key(c: Column) -> Column:
    """A model by name where only exact names count, else its group."""
    return X.bind(X.model(c), lambda m: F.when(m.isin(*M.EXACT_ONLY), X.label_key(m)).otherwise(X.key(X.model_group(m))))


def confirmed_model(c: Column) -> Column:
    return X.bind(X.inspect_model(c), lambda x: F.when(x["status"] == "confirmed", x["canonical"]).otherwise(""))


FIELDS = {
    "serial_candidates": ("serial", X.key),
    "serial_visual_candidates": ("visual_serial", X.key),
    "order_no": ("order_no", X.key),
    "hospital_raw": ("hospital_raw", lambda c: X.key(X.site(c))),
    "product_raw": ("product_raw", model_evidence_key),
    "product_model": ("product_raw", confirmed_model),
    "phone_candidates": ("phone", X.key),
    "asset_candidates": ("asset", X.key),
    "contact_person_raw": ("contact_person_raw", X.text_key),
    "service_date_raw": ("service_date_raw", lambda c: X.text_of(F.date_format(X.action_date(c), "yyyy-MM-dd"))),
}


def keyed(readings: DataFrame) -> DataFrame:
    """(doc_id, round, page, source, field, raw, key): one row per filled field of a reading.

    Model and site keys are worked out once for the distinct pairs of labels and joined back, as there are few labels
    and many readings. ``readings`` is read twice: settle it first. What follows takes this table. Readings are dealt by
    document before they become rows of fields, so that the groupings that follow move nothing.
    """
    by = {"hospital_raw": "hospital_raw", "product_raw": "product_raw", "product_model": "product_raw"}
    labels = readings.select(F.col("hospital_raw").alias("_h"), F.col("product_raw").alias("_p")).distinct()
    labels = labels.withColumns({f"_{name}": FIELDS[name][1](F.col("_h" if column == "hospital_raw" else "_p")) for name, column in by.items()})
    labels = settled(labels)  # written, so that few labels are known to be few and travel to the readings
    readings = dealt(readings, readings.count(), "doc_id", always=True)
    d = readings.join(labels, readings["hospital_raw"].eqNullSafe(labels["_h"]) & readings["product_raw"].eqNullSafe(labels["_p"]), "left").drop("_h", "_p")
    parts = [F.struct(F.lit(f).alias("field"), F.col(c).alias("raw"), (F.col(f"_{f}") if f"_{f}" in d.columns else k(F.col(c))).alias("key")) for f, (c, k) in FIELDS.items()]
    return d.select("doc_id", "round", "page", "source", F.explode(F.array(*parts)).alias("x")).select("doc_id", "round", "page", "source", "x.*").where("key <> ''")


def votes(keys: DataFrame) -> DataFrame:
    """(doc_id, field, key, votes, pages, sources): a value has one vote a reading; pages and sources are counted maps.

    Maps are built from one partial aggregation by (page, source), so no list of readings is gathered.
    """
    once = keys.groupBy("doc_id", "field", "key", "round").agg(F.min("page").alias("page"), F.min("source").alias("source"))
    by = once.groupBy("doc_id", "field", "key", "page", "source").agg(F.count("*").alias("n"))
    part = lambda c: F.map_from_entries(F.array_sort(F.transform(F.array_distinct(F.transform("l", lambda x: x[c])), lambda v: F.struct(v.alias("k"), F.aggregate(F.filter("l", lambda x: x[c] == v), F.lit(0).cast("long"), lambda a, x: a + x["n"]).alias("n")))))
    return by.groupBy("doc_id", "field", "key").agg(F.sum("n").alias("votes"), F.collect_list(F.struct("page", "source", "n")).alias("l")).select("doc_id", "field", "key", "votes", part("page").alias("pages"), part("source").alias("sources"))


def stable(v: DataFrame, least: int = 2) -> DataFrame:
    """(doc_id, field, keys): keys with ``least`` votes or more."""
    return v.where(F.col("votes") >= least).groupBy("doc_id", "field").agg(F.array_sort(F.collect_set("key")).alias("keys"))


def scalar_consensus(keys: DataFrame) -> DataFrame:
    """(doc_id, field, value, reason): the first raw value of the one key with two readings or more, else why there is none."""
    per = keys.groupBy("doc_id", "field", "key").agg(F.count_distinct("round").alias("n"), F.min_by("raw", "round").alias("raw"))
    both = per.groupBy("doc_id", "field").agg(F.count_if(F.col("n") >= 2).alias("repeated"), F.count("*").alias("all"), F.max(F.when(F.col("n") >= 2, F.struct("n", "raw"))).alias("top"))
    reason = F.when(F.col("repeated") == 1, None).when((F.col("repeated") > 1) | (F.col("all") > 1), "conflicting_readings").otherwise("insufficient_valid_readings")
    return both.select("doc_id", "field", F.when(F.col("repeated") == 1, F.col("top.raw")).alias("value"), reason.alias("reason"))


def list_consensus(keys: DataFrame, most: int = 3) -> DataFrame:
    """(doc_id, field, keys): keys seen in two rounds or more, by first appearance, at most ``most``."""
    per = keys.groupBy("doc_id", "field", "key").agg(F.count_distinct("round").alias("n"), F.min("round").alias("first")).where("n >= 2")
    ranked = per.withColumn("r", F.row_number().over(Window.partitionBy("doc_id", "field").orderBy("first", "key"))).where(F.col("r") <= most)
    return ranked.groupBy("doc_id", "field").agg(F.array_sort(F.collect_list(F.struct("r", "key"))).alias("l")).select("doc_id", "field", F.transform("l", lambda x: x["key"]).alias("keys"))


def near_consensus(keys: DataFrame, edits: int = 1, most: int = 3) -> DataFrame:
    """(doc_id, serials): serials of different rounds within ``edits`` of each other, by first round, at most ``most``."""
    s = keys.where("field = 'serial_candidates'").select("doc_id", "round", F.col("key").alias("s"))
    other = s.select(F.col("doc_id"), F.col("round").alias("r2"), F.col("s").alias("s2"))
    near = s.join(other, "doc_id").where((F.col("round") != F.col("r2")) & (F.levenshtein(F.col("s"), F.col("s2"), edits) >= 0))
    per = near.groupBy("doc_id", "s").agg(F.min("round").alias("first"))
    return per.groupBy("doc_id").agg(F.slice(F.transform(F.array_sort(F.collect_list(F.struct("first", "s"))), lambda x: x["s"]), 1, most).alias("serials"))


def crosspage_conflicts(keys: DataFrame) -> DataFrame:
    """(doc_id, field, pages, conflict): site and model keys repeated on each page, and whether the pages have none in common."""
    per = keys.where(F.col("field").isin("hospital_raw", "product_raw")).groupBy("doc_id", "field", "page", "key").agg(F.count_distinct("round").alias("n")).where("n >= 2")
    per = per.withColumn("on_pages", F.count("*").over(Window.partitionBy("doc_id", "field", "key")))
    pages = per.groupBy("doc_id", "field").agg(F.count_distinct("page").alias("pages"), F.max("on_pages").alias("m"))
    return pages.select("doc_id", "field", "pages", ((F.col("pages") > 1) & (F.col("m") < F.col("pages"))).alias("conflict"))
