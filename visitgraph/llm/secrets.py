"""Secret scans with corpus-wide ownership counts, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from visitgraph.llm.common import SPAN, bound, clear_of, durable, join_spans, private, redact, spans_of, spent

KINDS = ["assign", "access", "hex", "opaque"]
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*+[:=]\x20*+["']?([A-Za-z0-9+/_.=-]++)"""
ACCESS = r"AKIA[A-Z0-9]{16,}+"
HEX = r"(?<![0-9a-f])[0-9a-f]{24,}+"
#: Long opaque tokens that the base forms don't name; only ownership can tell whether they are live.
OPAQUE = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}+"


def base_spans(text: Column) -> dict[str, Column]:
    """The base spans of each kind in ``text`` (not null)."""
    return {
        "assign": spans_of(text, ASSIGN, "assign", lambda m: F.length(F.regexp_extract(m, ASSIGN, 1)) >= 6, text.rlike("[:=]")),
        "access": spans_of(text, ACCESS, "access", lambda m: F.lit(True), F.contains(text, F.lit("AKIA"))),
        "hex": spans_of(text, HEX, "hex", lambda m: F.lit(True), text.rlike("[0-9]|[a-f]{24}")),
    }


def opaque_spans(text: Column) -> Column:
    """Tokens of 20 or more characters mixing lower case, upper case and digits evenly enough not to be words."""
    mixed = lambda m: m.rlike("[a-z]") & m.rlike("[A-Z]") & (F.length(F.regexp_replace(m, "[^0-9]", "")) >= 4) & (F.size(F.array_distinct(F.split(m, ""))) >= 12)
    return spans_of(text, OPAQUE, "opaque", mixed, text.rlike("[0-9]"))


def value_of(x: Column) -> Column:
    """What is secret in a span: the assigned value, else all of it."""
    return F.when(x["kind"] == "assign", F.regexp_extract(x["m"], ASSIGN, 1)).otherwise(x["m"])


def unclaimed(text: Column, base: Column) -> Column:
    """Opaque tokens of ``text`` that overlap none of ``base``, which is worked out only where there are any."""
    return bound(opaque_spans(text), lambda x: F.when(F.size(x) > 0, clear_of(x, base)).otherwise(x))


def ownership(each: DataFrame, copied_owners: int) -> DataFrame:
    """(h, n_repos, n_owners, n_rows, live) of hashed candidates ``each`` (h, repo, owner); null repositories and owners count as one of their own.

    Distinct (hash, repository, owner) are pre-aggregated, so a secret copied into a third of all rows is counted by partial sums.
    """
    once = each.groupBy("h", "repo", "owner").agg(F.count("*").alias("n"))
    named = lambda c: F.coalesce(F.col(c), F.lit("\0"))
    by = once.groupBy("h").agg(F.count_distinct(named("repo")).alias("n_repos"), F.count_distinct(named("owner")).alias("n_owners"), F.sum("n").alias("n_rows"))
    return by.withColumn("live", F.col("n_owners") < copied_owners)


def repository() -> Column:
    """A repository of ``documents``: the texts of one source in one language; the source is its owner."""
    return F.concat_ws("/", "source", F.coalesce("lang", F.lit("?")))


def scan_secrets(docs: DataFrame, text_col: str = "text", repo: Column | None = None, owner: Column | None = None, copied_owners: int = 3, keep: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """Two durable tables: per row of ``docs`` its spans, and per found secret its ownership.

    The first has the ``keep`` columns (named otherwise than the following), ``rid`` (a row number that tells repeated
    rows apart), ``base`` (array of struct(s, e, kind, m)) and ``added`` (the opaque tokens that look live). The second
    has rid, kind, s, e, m, n_repos, n_owners, n_rows and ``live``: a value seen with fewer than ``copied_owners``
    owners is owner-specific; others are widely copied examples. Opaque tokens overlapping a base span are left to it;
    live ones are added, copied ones not. ``repo`` and ``owner`` are columns of ``docs``, by default ``repository()`` and source.

    Null texts are empty. Values are hashed (SHA-256) before they are shuffled for counting. Other columns of ``docs``
    stay out. An empty table gives empty tables.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    repo, owner = repository() if repo is None else repo, F.col("source") if owner is None else owner
    base = F.concat(*base_spans(text).values())
    found = docs.select(*[F.col(c) for c in keep or []], F.monotonically_increasing_id().alias("rid"), repo.cast("string").alias("repo"), owner.cast("string").alias("owner"), text.alias("text"), base.alias("base"))
    found = durable(found.withColumn("maybe", unclaimed(F.col("text"), F.col("base"))).drop("text"))
    each = found.where("size(base) + size(maybe) > 0").select("rid", "repo", "owner", F.explode(F.concat("base", "maybe")).alias("x"))
    each = durable(each.select("rid", "repo", "owner", "x.kind", "x.s", "x.e", "x.m", F.sha2(value_of(F.col("x")), 256).alias("h")))
    owned = durable(each.join(durable(ownership(each, copied_owners)), "h").select("rid", "kind", "s", "e", "m", "n_repos", "n_owners", "n_rows", "live"))
    added = owned.where("kind = 'opaque' AND live").groupBy("rid").agg(F.array_sort(F.collect_list(F.struct("s", "e", "kind", "m"))).alias("added"))
    spent(each)
    return found.drop("repo", "owner", "maybe").join(added, "rid", "left").withColumn("added", F.coalesce("added", F.expr(f"cast(array() as array<{SPAN}>)"))), owned


def redact_secrets(docs: DataFrame, mask: str = "[secret]", copied_owners: int = 3) -> DataFrame:
    """``docs`` (doc_id, text, lang, source, n_chars, ...) with every base secret and every added live one masked.

    Rows are neither dropped nor added; n_chars, if there, follows the text, and a null text stays null; other columns
    keep name and values, whatever their names. Only opaque tokens need counts over the corpus; the few live ones are
    a table whose size is known when it meets the texts. Equal rows are masked alike.
    """
    row, lives, new = private(docs, "row", "lives", "new")
    text = F.coalesce(F.col("text"), F.lit(""))
    name = F.xxhash64("doc_id", F.sha2(text, 256))
    maybe = docs.select(name.alias(row), F.col("source").cast("string").alias("owner"), repository().alias("repo"), F.explode(unclaimed(text, F.concat(*base_spans(text).values()))).alias("x"))
    maybe = durable(maybe.select(row, "owner", "repo", "x", F.sha2("x.m", 256).alias("h")))
    live = maybe.join(ownership(maybe, copied_owners).where("live").select("h"), "h")
    live = durable(live.groupBy(row).agg(F.collect_set("x").alias(lives)))
    spans = F.concat(F.concat(*base_spans(text).values()), F.coalesce(F.col(lives), F.expr(f"cast(array() as array<{SPAN}>)")))
    out = docs.withColumn(row, name).join(live, row, "left").withColumn(new, redact(F.col("text"), spans, mask))
    return out.select(*[F.col(new).alias(c) if c == "text" else F.when(F.col(new).isNull(), F.col(c)).otherwise(F.length(new).cast(docs.schema[c].dataType)).alias(c) if c == "n_chars" else F.col(c) for c in docs.columns])


def op4_secrets(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang", "source")
    found, owned = scan_secrets(docs, keep=["doc_id"])
    tally = owned.groupBy("rid").agg(F.count_if(F.col("live")).alias("n_live"), F.count_if(~F.col("live")).alias("n_copied"), F.max("n_owners").alias("max_owners"))
    n = lambda k: F.size(F.filter("base", lambda x: x["kind"] == k)).cast("long").alias(f"n_{k}")
    spans = join_spans(F.concat("base", "added"), KINDS)
    return found.join(tally, "rid", "left").select("doc_id", *[n(k) for k in KINDS[:3]], F.sha2(join_spans(F.col("base"), KINDS), 256).alias("base_sha256"), spans.alias("spans"), *[F.coalesce(c, F.lit(0)).alias(c) for c in ("n_live", "n_copied", "max_owners")])
