"""Evidence of documents whose readings are gathered in one row of each: nothing is moved or grouped to vote on them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from visitgraph.functions import text as X
from visitgraph.operators.decisions import NAMES
from visitgraph.operators.evidence import FIELDS
from visitgraph.operators.tables import settled

#: Fields whose few distinct texts are judged apart, by the column that holds them.
LABELS = {"hospital_raw": "hospital_raw", "product_raw": "product_raw", "product_model": "product_raw"}


def once(texts: Column, of: Callable[[Column], Column]) -> Column:
    """``of`` each text of an array, worked out once a distinct one; nulls count as empty."""
    told = lambda t, kinds: X.bind(F.transform(kinds, of), lambda keys: F.transform(t, lambda x: F.get(keys, F.array_position(kinds, x).cast("int") - 1)))
    return X.bind(F.transform(texts, X.text_of), lambda t: X.bind(F.array_distinct(t), lambda kinds: told(t, kinds)))


def labels_of(rows: DataFrame) -> DataFrame:
    """(_h, _p, and the keys of each field of ``LABELS``): the distinct lists of site and model texts of ``rows``, settled."""
    d = rows.select(F.col("hospital_raw").alias("_h"), F.col("product_raw").alias("_p")).distinct()
    return settled(d.withColumns({f"_{f}": once(F.col("_h" if c == "hospital_raw" else "_p"), FIELDS[f][1]) for f, c in LABELS.items()}))


def keyed_rows(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, reference_day, and by each of ``NAMES`` its keys as an array of (round, page, key)) of gathered readings.

    ``rows`` (doc_id, reference_day, round, page, and the columns of ``FIELDS``) has an array of each but the first two,
    in one order, one value a reading; ``labels`` are ``labels_of`` these. It says what ``keyed`` says in a row of each field.
    """
    d = rows.join(labels, (rows["hospital_raw"] == labels["_h"]) & (rows["product_raw"] == labels["_p"]), "left")
    each = {f: F.transform(c, of) for f, (c, of) in FIELDS.items()} | {f: once(F.col(FIELDS[f][0]), FIELDS[f][1]) for f in ("contact_person_raw", "service_date_raw")} | {f: F.col(f"_{f}") for f in LABELS}
    entry = lambda keys: F.filter(F.transform(keys, lambda k, i: F.struct(F.get("round", i).alias("round"), F.get("page", i).alias("page"), k.alias("key"))), lambda x: x["key"] != "")
    return d.select("doc_id", "reference_day", *[entry(each[f]).alias(n) for f, n in NAMES.items()])


def gathered(readings: DataFrame, keys: DataFrame) -> DataFrame:
    """What ``keyed_rows`` returns, out of readings in rows of their own and their ``keyed`` fields."""
    once = keys.groupBy("doc_id", "field", "key", "round").agg(F.min("page").alias("page"))
    entry = F.struct(F.col("round").cast("int").alias("round"), F.col("page").cast("int").alias("page"), "key")
    d = once.groupBy("doc_id").agg(*[F.collect_list(F.when(F.col("field") == f, entry)).alias(n) for f, n in NAMES.items()])
    d = readings.groupBy("doc_id").agg(F.min("reference_day").alias("reference_day")).join(d, "doc_id", "left")
    none = F.expr("cast(array() as array<struct<round:int,page:int,key:string>>)")
    return d.select("doc_id", "reference_day", *[F.coalesce(n, none).alias(n) for n in NAMES.values()])


def upto(rows: DataFrame, last: int) -> DataFrame:
    """``keyed_rows`` of the rounds up to ``last`` alone."""
    return rows.withColumns({n: F.filter(n, lambda x: x["round"] <= last) for n in NAMES.values()})


def _repeated(keys: Column) -> Column:
    """The distinct keys that two readings or more have."""
    return F.filter(F.array_distinct(keys), lambda k: F.size(F.filter(keys, lambda x: x == k)) >= 2)


def agreed(texts: Column, keys: Column) -> Column:
    """The first text of the one key that two readings or more have, or null if none or several do."""
    own = X.bind(F.filter(keys, lambda k: k != ""), _repeated)
    return F.when(F.size(own) == 1, F.get(texts, F.array_position(keys, F.get(own, F.lit(0))).cast("int") - 1))


def mixed_pages(entries: Column) -> Column:
    """Whether pages repeat keys of their own, but none that all of these pages repeat."""
    slim = F.transform(entries, lambda a: F.struct(a["page"].alias("page"), a["key"].alias("key")))
    twice = lambda s: F.filter(F.array_distinct(s), lambda a: F.size(F.filter(s, lambda b: a == b)) >= 2)
    pages = lambda t: F.size(F.array_distinct(F.transform(t, lambda a: a["page"])))
    most = lambda t: F.array_max(F.transform(t, lambda a: F.size(F.filter(t, lambda b: a["key"] == b["key"]))))
    return X.bind(X.bind(slim, twice), lambda t: (pages(t) > 1) & (F.coalesce(most(t), F.lit(0)) < pages(t)))


def evidence_of(rows: DataFrame) -> DataFrame:
    """``evidence_row`` of ``keyed_rows``, and ``mixed``: whether pages are of different sites or models."""
    keys = {n: F.col(n)["key"] for n in NAMES.values()}
    sides = [c for n, k in keys.items() for c in (F.sort_array(F.array_distinct(k)).alias(f"any_{n}"), F.sort_array(_repeated(k)).alias(f"two_{n}"))]
    return rows.select("doc_id", "reference_day", *sides, (mixed_pages(F.col("site")) | mixed_pages(F.col("model"))).alias("mixed"))
