"""What people and records say at a review: confirmed dates, record links, serials, assets, company orders."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from visitgraph.functions import text as X

# Names of the custom field that holds a company's order number, letters only.
ORDER_FIELDS = ("ordernumber", "orderno", "serviceordernumber")


def company_order(fields: Column, name: Column) -> Column:
    """A record's own order number: of the first custom field so named that holds one, else of its name without references.

    ``fields`` is an array of (name, text_value, number_value). A field holds 8 digits that begin with 5 or 6, as text or
    as a whole number; a text, if there is one, is what counts. Hospital references are no company orders, however long.
    """

    def held(x: Column) -> Column:
        whole = (x["number_value"] == F.floor(x["number_value"])) & x["number_value"].between(10_000_000, 99_999_999)
        number = F.when(whole, x["number_value"].cast("long").cast("string"))
        value = F.when(X.text_of(x["text_value"]) != "", x["text_value"]).otherwise(number)
        return F.when(F.regexp_replace(F.lower(X.text_of(x["name"])), "[^a-z]", "").isin(*ORDER_FIELDS) & value.rlike(r"^[56][0-9]{7}$"), value)

    own = F.try_element_at(F.array_compact(F.transform(fields, held)), F.lit(1))
    plain = F.regexp_replace(X.text_of(name), r"(?i)\b(?:HAWO|WO)\s*[#.:\-]?\s*\d+", "")
    return F.coalesce(own, F.nullif(X.order_number(plain), F.lit("")))


def strict_day(c: Column) -> Column:
    """A calendar day written ``20yy-mm-dd``, else null: no other order of day and month is ever guessed."""
    return F.when(X.text_of(c).rlike(r"^20\d{2}-\d{2}-\d{2}\z"), F.try_to_date(c, "yyyy-MM-dd"))


def record_id(c: Column, host: str) -> Column:
    """A record's id of 8 to 20 digits, bare or third in the path of an https link to ``host`` after 0 and a number; '' if blank, else null."""
    t = F.trim(X.text_of(c))
    parts = F.split(F.regexp_replace(F.regexp_extract(t, r"^https://([^?#]*)", 1), "/+$", ""), "/")
    linked = (F.regexp_replace(F.lower(F.get(parts, F.lit(0))), r"^.*@|:\d*$", "") == host) & (F.get(parts, F.lit(1)) == "0") & F.get(parts, F.lit(2)).rlike(r"^\d+$")
    last = F.when(linked, F.get(parts, F.lit(3)))
    good = lambda v: F.when(v.rlike(r"^\d{8,20}\z"), v)
    return F.when(t == "", "").otherwise(F.coalesce(good(t), good(last)))


def whole_serial(c: Column) -> Column:
    """A complete serial as a person read it, upper-cased; null if it has gaps, signs or too few digits."""
    t = F.upper(F.trim(X.text_of(c)))
    return F.when(t.rlike(r"^[A-Z]{2,3}[A-Z0-9]{6,9}\z") & F.length(t).between(8, 12) & (F.length(F.regexp_replace(t, "[^0-9]", "")) >= 4), t)


def whole_asset(c: Column) -> Column:
    """An asset of 4 to 12 digits, else null."""
    t = F.trim(X.text_of(c))
    return F.when(t.rlike(r"^\d{4,12}\z"), t)
