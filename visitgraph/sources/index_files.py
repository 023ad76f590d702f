"""A device index kept as files: JSON lines of devices and sites, CSV copies for people, and a manifest; checked when read."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from visitgraph.functions.text import bind

SCHEMA_VERSION = 3
# The lists that a device, a visit of it and a site must have.
DEVICE_LISTS = ("product_families", "product_variants", "locations", "hospitals", "hospital_aliases", "department_rooms", "phones", "contacts", "assets", "work_dates", "job_types")
VISIT_LISTS = ("hospital_aliases", "department_rooms", "phones", "contacts", "assets", "work_dates")
SITE_LISTS = ("confirmed_aliases", "learned_aliases", "unconfirmed_aliases", "historical_locations", "department_rooms", "alias_sources")
AGREED = ("schema_version", "generated_at", "device_count", "location_count")


class BrokenIndex(ValueError):
    """The index can't be used; a broken index must never look like an index without matches."""


def _kind(v: Column, path: str) -> Column:
    """The type of what lies at ``path`` of a variant, null if there is nothing."""
    return F.schema_of_variant(F.try_variant_get(v, path, "variant"))


def _is_object(v: Column) -> Column:
    """Whether a variant is an object, by a cast that fails for all else: ``_kind`` would work out the type of all within."""
    return F.try_variant_get(v, "$", "map<string,variant>").isNotNull()


def _no_list(v: Column, name: str) -> Column:
    return F.try_variant_get(v, f"$.{name}", "array<variant>").isNull()


def _fault(when: Column, place: Column | str, field: str, fault: str) -> Column:
    at = F.lit(place).cast("string") if isinstance(place, str) else place
    return F.when(when, F.struct(at.alias("place"), F.lit(field).alias("field"), F.lit(fault).alias("fault")))


def device_violations(rows: DataFrame, body: str = "body") -> DataFrame:
    """``rows``' other columns with (place, field, fault): one row per broken rule of a device row in JSON.

    A device must be an object with a key and the lists ``DEVICE_LISTS``; ``task_refs`` a list of objects, each with a
    gid and the lists ``VISIT_LISTS``. ``place`` is ``device`` or ``visit n`` (from 0). What isn't a JSON object at all
    is told once. Sound rows give none, null texts count as broken.
    """
    others = [c for c in rows.columns if c != body]
    blank = lambda x, k: F.coalesce(F.trim(F.try_variant_get(x, f"$.{k}", "string")), F.lit("")) == ""
    none = F.expr("cast(array() as array<struct<place:string,field:string,fault:string>>)")

    def of_visit(x: Column, i: Column) -> Column:
        at = F.concat(F.lit("visit "), i.cast("string"))
        sound = F.array(_fault(blank(x, "gid"), at, "gid", "missing"), *[_fault(_no_list(x, k), at, k, "not_a_list") for k in VISIT_LISTS])
        return F.when(_is_object(x), sound).otherwise(F.array(_fault(F.lit(True), at, "gid", "missing")))

    def of_device(v: Column) -> Column:
        refs = F.coalesce(F.try_variant_get(v, "$.task_refs", "array<variant>"), F.expr("cast(array() as array<variant>)"))
        own = F.array(_fault(blank(v, "device_key"), "device", "device_key", "missing"), *[_fault(_no_list(v, k), "device", k, "not_a_list") for k in (*DEVICE_LISTS, "task_refs")])
        return F.array_compact(F.concat(own, F.flatten(F.transform(refs, of_visit))))

    # each text is parsed once and each kind asked for once, as the inner expression alone sees the parsed value
    found = bind(F.try_parse_json(F.col(body)), lambda v: F.when(_is_object(v), of_device(v)).otherwise(F.array(_fault(F.lit(True), "device", "", "not_an_object"))))
    # outer, and the empty rows dropped after: a plain explode asks for the size of its list in a filter, which works all of it out again
    return rows.select(*others, F.explode_outer(F.coalesce(found, none)).alias("x")).where("x.fault IS NOT NULL").select(*others, "x.*")


def site_violations(rows: DataFrame, body: str = "body") -> DataFrame:
    """The same for rows of the site directory: ``match_enabled`` must be true or false, ``SITE_LISTS`` lists."""
    others = [c for c in rows.columns if c != body]
    d = rows.withColumn("_v", F.try_parse_json(F.col(body)))
    v = F.col("_v")
    thing = _is_object(v)
    flag = F.coalesce(_kind(v, "$.match_enabled") == "BOOLEAN", F.lit(False))
    own = [_fault(~thing, "site", "", "not_an_object"), _fault(thing & ~flag, "site", "match_enabled", "not_a_boolean"), *[_fault(thing & _no_list(v, k), "site", k, "not_a_list") for k in SITE_LISTS]]
    return d.select(*others, F.explode(F.array_compact(F.array(*own))).alias("x")).select(*others, "x.*")


def _joined(d: DataFrame) -> DataFrame:
    """Lists as text, for CSV."""
    return d.select([F.array_join(F.col(c), " ; ").alias(c) if kind.startswith("array<string") else F.col(c) for c, kind in d.dtypes if not kind.startswith("array<struct")])


def write_index(devices: DataFrame, sites: DataFrame, path: str, facts: dict) -> dict:
    """Writes devices and sites as JSON lines and CSV under ``path``, then the manifest, which makes them an index.

    ``facts`` is what else the manifest says, ``generated_at`` at least. Both tables are distributed files; only their
    counts come to the driver. What breaks a rule is refused before the manifest is written.
    """
    spark = devices.sparkSession
    devices.write.mode("overwrite").option("ignoreNullFields", "false").json(f"{path}/devices")
    sites.write.mode("overwrite").option("ignoreNullFields", "false").json(f"{path}/sites")
    _joined(devices).write.mode("overwrite").option("header", "true").csv(f"{path}/devices-csv")
    _joined(sites).write.mode("overwrite").option("header", "true").csv(f"{path}/sites-csv")
    manifest = {"schema_version": SCHEMA_VERSION, **facts, "device_count": spark.read.text(f"{path}/devices").count(), "location_count": spark.read.text(f"{path}/sites").count()}
    check(spark, path, None)
    spark.createDataFrame([(json.dumps(manifest),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/manifest")
    return manifest


def check(spark: SparkSession, path: str, manifest: dict | None) -> None:
    """Raises what is wrong with the index at ``path``, and where ``manifest`` disagrees with it."""
    rows = {"devices": (device_violations, "device_count"), "sites": (site_violations, "location_count")}
    for name, (violations, count) in rows.items():
        body = spark.read.text(f"{path}/{name}").withColumnRenamed("value", "body")
        first = violations(body).groupBy("place", "field", "fault").count().orderBy(F.desc("count"), "place", "field").first()
        if first:
            raise BrokenIndex(f"{first['count']} {name}: {first['place']} {first['field']} {first['fault']}")
        if manifest is not None and str(manifest.get(count)) != str(body.count()):
            raise BrokenIndex(f"manifest disagrees: {count}")


def load_index(spark: SparkSession, path: str, schema: str, generated_at: str | None = None) -> DataFrame:
    """The devices of the index at ``path``, typed by ``schema``; any broken rule or disagreement with its manifest raises."""
    try:
        manifest = json.loads(spark.read.text(f"{path}/manifest", wholetext=True).first()[0])
    except Exception as missing:
        raise BrokenIndex(f"no manifest in {path}") from missing
    if not isinstance(manifest, dict) or manifest.get("schema_version") != SCHEMA_VERSION:
        raise BrokenIndex("manifest disagrees: schema_version")
    if generated_at is not None and manifest.get("generated_at") != generated_at:
        raise BrokenIndex("manifest disagrees: generated_at")
    check(spark, path, manifest)
    return spark.read.schema(schema).option("mode", "FAILFAST").json(f"{path}/devices")
