"""What the device records teach: site aliases, a directory of sites, a catalogue of models, a vocabulary, and newer records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from visitgraph.functions import models as M
from visitgraph.functions import text as X

NONE = X.NO_STRINGS


def places(records: DataFrame) -> DataFrame:
    """(location, core, detail, core_key, site, words) of each distinct location."""
    core, detail = X.split_location(F.col("location"))
    d = records.select("location").distinct().select("location", core.alias("core"), detail.alias("detail"))
    return d.select("*", X.key(F.col("core")).alias("core_key"), X.site(F.col("core")).alias("site"), F.size(X.all_of(F.col("core"), "[A-Za-z]+")).alias("words"))


def learn_aliases(records: DataFrame, least: int = 2) -> DataFrame:
    """(short_key, full_key, short, full, devices): unknown short codes that stand for one full name.

    A code and a name pair up where one serial was seen at both; ``least`` serials must say so, and a code that pairs
    with two names is not learned. Spellings shown are the first by code point. Both sides are distinct by serial and
    place before they meet, so a much visited device adds no more pairs than it has places.
    """
    seen = records.where("NOT weak_identity").join(places(records), "location").select("serial", "core", "core_key", "site", "words").distinct()
    short = seen.where(F.col("core").rlike("^[A-Za-z]{2,8}$") & F.col("site").isNull()).select("serial", F.col("core_key").alias("short_key"), F.col("core").alias("short"))
    full = seen.where("words >= 2").select("serial", F.col("core_key").alias("full_key"), F.col("core").alias("full"))
    pairs = short.join(full, "serial").groupBy("short_key", "full_key").agg(F.min("short").alias("short"), F.min("full").alias("full"), F.count_distinct("serial").alias("devices")).where(F.col("devices") >= least)
    lone = pairs.groupBy("short_key").agg(F.count("*").alias("names")).where("names = 1").select("short_key")
    return pairs.join(lone, "short_key")


def members(groups: DataFrame) -> DataFrame:
    """(core_key, short_key, short, full): each learned group under both of its keys."""
    return groups.select(F.explode(F.array("short_key", "full_key")).alias("core_key"), "short_key", "short", "full")


def propagate_aliases(records: DataFrame, groups: DataFrame) -> DataFrame:
    """``records`` with the names of learned groups after the aliases of every record whose site or alias is in the group.

    Worked out once per distinct location, as a location decides its aliases.
    """
    labels = records.select("location", "aliases").distinct().join(places(records).select("location", "core_key"), "location")
    keys = labels.select("location", F.explode(F.array_distinct(F.concat(F.array("core_key"), F.transform("aliases", X.key)))).alias("core_key"))
    found = keys.join(members(groups), "core_key").groupBy("location").agg(F.array_sort(F.collect_set(F.struct("short_key", "short", "full"))).alias("g"))
    named = found.select("location", F.flatten(F.transform("g", lambda g: F.array(g["short"], g["full"]))).alias("learned"))
    return records.join(named, "location", "left").withColumn("aliases", X.unique(F.concat("aliases", F.coalesce("learned", F.expr(NONE))))).drop("learned")


def location_directory(records: DataFrame, groups: DataFrame) -> DataFrame:
    """One row per site: its names by how they are known, and how many places, rooms and devices it has.

    A site is enabled if its code is confirmed, its code was learned, or it is a full name; other codes stay unconfirmed
    rows of their own. Classes are told on distinct locations; records only count.
    """
    codes = {v: sorted(k for k, w in M.SITES.items() if w == v) for v in set(M.SITES.values())}
    known_codes = F.create_map(*[x for v, ks in sorted(codes.items()) for x in (F.lit(v), F.array(*map(F.lit, ks)))])
    names = members(groups).select("core_key", F.col("full").alias("learned_name"), F.col("short").alias("learned_code")).groupBy("core_key").agg(F.min("learned_name").alias("learned_name"), F.collect_set("learned_code").alias("learned_codes"))
    p = places(records).where("core <> ''").join(names, "core_key", "left")
    tagged, known, learned, full = F.ltrim("core").startswith("("), F.col("site").isNotNull(), F.col("learned_name").isNotNull(), F.col("words") >= 2
    kind = F.when(tagged, "unconfirmed").when(known | (full & ~learned), "confirmed").when(learned, "learned").otherwise("unconfirmed")
    p = p.withColumn("kind", kind)
    k = F.col("kind")
    site_key = F.when(k == "unconfirmed", F.concat(F.lit("UNCONFIRMED|"), "core_key")).when(known, X.key(F.col("site"))).when(k == "learned", X.key(F.col("learned_name"))).otherwise(F.col("core_key"))
    official = F.when(k == "learned", F.col("learned_name")).when((k == "confirmed") & full, F.col("core"))
    confirmed = F.when(k == "confirmed", F.concat(F.array("core", F.coalesce("site", "core")), F.coalesce(F.try_element_at(known_codes, F.col("site")), F.expr(NONE)))).when(k == "learned", F.array("learned_name")).otherwise(F.expr(NONE))
    taught = F.when(k == "learned", F.concat("learned_codes", F.array("learned_name"))).otherwise(F.expr(NONE))
    p = p.select("location", "detail", "kind", "core", site_key.alias("site_key"), official.alias("official"), F.when(known & ~tagged, F.col("site")).alias("known"), confirmed.alias("confirmed"), taught.alias("taught"))
    flat = lambda c: F.array_sort(F.array_distinct(F.flatten(F.collect_set(c))))
    rows = p.groupBy("site_key").agg(F.coalesce(F.min("official"), F.min("known"), F.lit("")).alias("canonical"), flat("confirmed").alias("confirmed"), flat("taught").alias("learned"), F.array_sort(F.collect_set(F.when(k == "unconfirmed", F.col("core")))).alias("unconfirmed"), F.array_sort(F.collect_set("kind")).alias("kinds"), F.bool_or(k != "unconfirmed").alias("enabled"))
    used = records.join(p.select("location", "site_key", "detail"), "location").groupBy("site_key").agg(F.count_distinct(F.when(F.col("serial") != "", F.col("serial")).otherwise(F.col("device_key"))).alias("devices"), F.count_distinct("location").alias("places"), F.count_distinct(F.nullif("detail", F.lit(""))).alias("rooms"))
    return rows.join(used, "site_key")


#: Codes that were misread before, which no frequency makes plausible.
NEVER = ("PN", "KWM", "PYTV")


def known_names(directory: DataFrame) -> DataFrame:
    """(site_key, enabled, devices, name, name_key, sure) of every name in a ``location_directory``; unconfirmed ones aren't ``sure``."""
    name = lambda c, sure: F.transform(c, lambda n: F.struct(n.alias("name"), F.lit(sure).alias("sure")))
    every = F.concat(name(F.array("canonical"), True), name("confirmed", True), name("learned", True), name("unconfirmed", False))
    d = directory.select("site_key", "enabled", "devices", F.explode(every).alias("n")).select("site_key", "enabled", "devices", "n.name", X.key(F.col("n.name")).alias("name_key"), "n.sure")
    return d.where("name_key <> ''").distinct()


def plausible_codes(directory: DataFrame, least: int = 2) -> DataFrame:
    """(code): short codes in any group seen on ``least`` devices or more. Worth keeping in a reading, not a confirmed site."""
    n = known_names(directory).where(F.col("devices") >= least)
    return n.where(F.col("name_key").rlike("^[A-Z]{2,6}$") & ~F.col("name_key").isin(*NEVER)).select(F.col("name_key").alias("code")).distinct()


def site_alias_sets(locations: DataFrame, directory: DataFrame) -> DataFrame:
    """(location, aliases, groups, plausible) of every distinct location text.

    ``aliases``: its own name, canonical code and acronym (an unknown short code has none), and all sure names of the
    enabled group that has its name, if that is one group only; a name in several groups is refused, as either could be
    meant. ``groups`` counts them. ``plausible``: a short code that the directory knows from two devices.
    """
    p = places(locations).where("core <> ''")
    own = F.when(F.col("core").rlike("^[A-Za-z]{2,6}$") & F.col("site").isNull(), F.expr(NONE)).otherwise(X.unique(F.array("core", X.text_of(F.col("site")), X.text_of(X.acronym(F.col("core"))))))
    names = known_names(directory)
    sure = names.where("enabled AND sure")
    found = p.select("core_key").distinct().join(sure.select(F.col("name_key").alias("core_key"), "site_key").distinct(), "core_key")
    groups = found.groupBy("core_key").agg(F.count("*").alias("groups"), F.min("site_key").alias("site_key"))
    one = groups.where("groups = 1").join(sure.groupBy("site_key").agg(F.collect_set("name").alias("names")), "site_key").select("core_key", "names")
    codes = plausible_codes(directory).select(F.col("code").alias("core_key"), F.lit(True).alias("plausible"))
    d = p.withColumn("own", own).join(groups.select("core_key", "groups"), "core_key", "left").join(one, "core_key", "left").join(codes, "core_key", "left")
    aliases = F.array_sort(F.array_distinct(F.concat("own", F.coalesce("names", F.expr(NONE)))))
    return d.select("location", aliases.alias("aliases"), F.coalesce("groups", F.lit(0)).alias("groups"), F.coalesce("plausible", F.lit(False)).alias("plausible"))


def strong_models(records: DataFrame) -> DataFrame:
    """(serial, variant, status, reason, name): the distinct models of devices with a serial, judged once per spelling."""
    own = records.where("NOT weak_identity AND serial <> '' AND variant <> ''").select("serial", "variant").distinct()
    judged = own.select("variant").distinct().withColumn("x", X.inspect_model(F.col("variant")))
    judged = judged.select("variant", "x.status", "x.reason", F.coalesce("x.canonical", "x.variant").alias("name"))
    return own.join(judged, "variant")


def model_catalog(models: DataFrame) -> DataFrame:
    """(status, name, devices, variants): distinct serials and spellings per model; rejected ones counted by reason."""
    name = F.when(F.col("status") == "rejected", F.col("reason")).otherwise(F.col("name"))
    return models.withColumn("name", name).groupBy("status", "name").agg(F.count_distinct("serial").alias("devices"), F.count_distinct("variant").alias("variants"))


def vocabulary(models: DataFrame, directory: DataFrame, families: int = 4, names: int = 12, codes: int = 20) -> DataFrame:
    """(kind, name, n): the most frequent model groups, models and site codes, ties by name; a report, hence the limits."""
    sure = models.where("status = 'confirmed'").select("serial", "name").distinct()
    groups = sure.select("name").distinct().withColumn("family", X.model_group(F.col("name")))
    top = lambda d, k: d.orderBy(F.desc("n"), "name").limit(k)
    fam = top(sure.join(groups, "name").where("family IS NOT NULL").groupBy(F.col("family").alias("name")).agg(F.count("*").alias("n")), families)
    mod = top(sure.groupBy("name").agg(F.count("*").alias("n")), names)
    used = directory.where(F.col("enabled") & F.array_contains("kinds", "confirmed") & (F.col("devices") >= 2)).select(F.explode("confirmed").alias("name"), "devices")
    cod = top(used.where(F.col("name").rlike("^[A-Z]{2,6}$")).groupBy("name").agg(F.sum("devices").alias("n")), codes)
    kind = lambda d, k: d.select(F.lit(k).alias("kind"), "name", "n")
    return kind(fam, "family").union(kind(mod, "model")).union(kind(cod, "site_code"))


def in_window(days: Column, start: Column, length: int = 730) -> Column:
    """Whether any of ``days`` (dates, nulls among them) is within ``length`` days from ``start``, or there is no day at all."""
    known = F.array_compact(days)
    return (F.size(known) == 0) | F.exists(known, lambda x: x.between(start, F.date_add(start, length - 1)))


def counters(records: DataFrame, inside: Column) -> DataFrame:
    """One row: newest day, records, those ``inside`` the window, unparsed ones, devices, and visits beyond one a device."""
    d = records.withColumn("inside", inside)
    sums = d.agg(F.max("due").alias("newest"), F.count("*").alias("records"), F.count_if("inside").alias("in_window"), F.count_if(~F.col("parsed")).alias("unparsed"), F.count_if("parsed").alias("visits"))
    devices = d.where("parsed").groupBy("device_key").agg(F.lit(1).alias("one")).agg(F.count("*").alias("devices"))
    return sums.crossJoin(devices).withColumn("merged", F.greatest(F.col("visits") - F.col("devices"), F.lit(0))).drop("visits")  # one row each


def upsert_records(old: DataFrame, new: DataFrame, inside: Column) -> DataFrame:
    """Records by ``gid`` after a newer scan, with a column ``changed``; both frames have gid and ``modified`` (ISO text).

    A scanned record counts only if it was modified later than the stored one of its gid; it then replaces that one, or
    removes it where ``inside`` (over the scan's columns) is false. Records that the scan didn't see stay.
    """
    columns = [c for c in old.columns if c != "gid"]
    both = old.withColumns({"changed": F.lit(False), "stays": F.lit(True)}).unionByName(new.withColumns({"changed": F.lit(True), "stays": F.coalesce(inside, F.lit(False))}))
    last = both.groupBy("gid").agg(F.max_by(F.struct(*columns, "changed", "stays"), F.struct("modified", ~F.col("changed"))).alias("r"))
    return last.select("gid", "r.*").where("stays").drop("stays")
