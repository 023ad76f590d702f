"""One service date out of several partial and noisy ones, by rule order, with where it comes from."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from visitgraph.functions import text as X

#: Days that a date may lie before and after the day of reading.
OLDEST, AHEAD = 93, 7
#: Rules in the order they are asked; what the first one that holds gives is the date.
RULES = ("focused", "signature", "month", "checklist")


def digits_apart(a: Column, b: Column) -> Column:
    """How many of the eight digits of two days differ."""
    x, y = F.date_format(a, "yyyyMMdd"), F.date_format(b, "yyyyMMdd")
    return F.aggregate(F.sequence(F.lit(1), F.lit(8)), F.lit(0), lambda n, i: n + (F.substring(x, i, F.lit(1)) != F.substring(y, i, F.lit(1))).cast("int"))


def corroborate(reads: DataFrame, about: DataFrame) -> DataFrame:
    """(doc_id, day, rule, corroborated, focused, signature, month, checklist) for every document of ``about``.

    ``reads`` has (doc_id, kind, n, raw): kinds ``action`` (the broad readings), ``focused`` (two closer ones), ``signed``
    (the customer's day, the second of two counts), ``month`` (the customer's month, ``yyyy-MM``, twice), ``checklist``
    (twice). ``about`` has (doc_id, doc_type, reading_day). Each rule's outcome is told:

    - focused: both close readings give the same day.
    - signature: the signed day, if two close readings are at most one digit off and none is further, or if some action or
      close reading equals it and none is more than one digit off. It is ``corroborated``, even where no reading equals it.
    - month: the first two action readings agree, and both months are theirs.
    - checklist (PM only): both readings of the list agree, an action reading gives that day, and the signed day or both
      close ones support it; another signed day, or a close pair on another day, forbids it.

    All but the first need a day within the window around ``reading_day``. Days that can't be read are missing; several
    rows of one kind and number count as the latest day. A document without readings has no day and no rule.
    """
    d = reads.select("doc_id", "kind", "n", F.when(F.col("kind") != "month", X.action_date(F.col("raw"))).alias("day"), F.when(F.col("kind") == "month", F.col("raw")).alias("text"))
    of = lambda kind, n: F.max(F.when((F.col("kind") == kind) & (F.col("n") == n), F.col("day")))
    text = lambda n: F.max(F.when((F.col("kind") == "month") & (F.col("n") == n), F.col("text")))
    named = {f"{kind[0]}{n}": of(kind, n).alias(f"{kind[0]}{n}") for kind in ("action", "focused", "signed", "checklist") for n in (1, 2)}
    points = d.groupBy("doc_id").agg(*named.values(), text(1).alias("m1"), text(2).alias("m2"))
    near = d.where("kind IN ('action', 'focused') AND day IS NOT NULL").join(points.select("doc_id", "s2", "c1"), "doc_id").withColumn("off", digits_apart(F.col("day"), F.col("s2")))
    close = F.col("kind") == "focused"
    counts = near.groupBy("doc_id").agg(F.count("*").alias("valid"), F.count_distinct(F.when(close & (F.col("off") <= 1), F.col("n"))).alias("close_near"), F.count_if(close & (F.col("off") > 1)).alias("close_far"), F.count_if(F.col("day") == F.col("s2")).alias("equal"), F.count_if(F.col("off") > 1).alias("far"), F.count_if((F.col("kind") == "action") & (F.col("day") == F.col("c1"))).alias("listed"))
    x = about.join(points, "doc_id", "left").join(counts, "doc_id", "left")
    inside = lambda day: F.datediff("reading_day", day).between(-AHEAD, OLDEST)
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    focused = F.when(F.col("f1") == F.col("f2"), "agreed").otherwise("unresolved")
    backed = ((zero("close_near") >= 2) & (zero("close_far") == 0)) | ((zero("equal") > 0) & (zero("far") == 0))
    signature = F.when(F.col("s2").isNull(), "unresolved").when(~F.coalesce(inside("s2"), F.lit(False)), "outside_window").when(~backed, "no_action_date_agreement").when(zero("equal") > 0, "corroborated").otherwise("one_digit_customer_correction")
    same = (F.col("a1") == F.col("a2")) & (F.col("m1") == F.col("m2")) & (F.date_format("a1", "yyyy-MM") == F.col("m1")) & inside("a1")
    month = F.when(same, "agreed").otherwise("unresolved")
    clash = F.coalesce(F.col("s2") != F.col("c1"), F.lit(False)) | F.coalesce((F.col("f1") == F.col("f2")) & (F.col("f1") != F.col("c1")), F.lit(False))
    support = F.coalesce(F.col("s2") == F.col("c1"), F.lit(False)) | F.coalesce((F.col("f1") == F.col("c1")) & (F.col("f2") == F.col("c1")), F.lit(False))
    checklist = F.when(F.coalesce(F.col("doc_type") != "PM", F.lit(True)), "not_pm").when(~F.coalesce(F.col("c1") == F.col("c2"), F.lit(False)), "unresolved").when(~F.coalesce(inside("c1"), F.lit(False)), "outside_window").when(clash, "first_page_conflict").when((zero("listed") == 0) | ~support, "insufficient_first_page_support").otherwise("corroborated")
    x = x.withColumns({"focused": focused, "signature": signature, "month": month, "checklist": checklist})
    holds = {"focused": F.col("focused") == "agreed", "signature": F.col("signature").isin("corroborated", "one_digit_customer_correction"), "month": F.col("month") == "agreed", "checklist": F.col("checklist") == "corroborated"}
    days = {"focused": "f1", "signature": "s2", "month": "a1", "checklist": "c1"}
    first = lambda value: F.coalesce(*[F.when(holds[r], value(r)) for r in RULES])
    return x.select("doc_id", first(lambda r: F.col(days[r])).alias("day"), first(F.lit).alias("rule"), (holds["signature"] | holds["checklist"]).alias("corroborated"), *RULES)
