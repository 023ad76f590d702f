"""URL filters with redirect equivalence: block and allow decisions spread over connected components of links."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from visitgraph.llm.common import components, private

#: (rule, verdict): a host, then a path prefix. The longest fitting rule wins.
RULES = [("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow")]
TAG = r"(?is)<(?:link|meta)\b[^>]*>"
SCHEME = r"(?s)^[A-Za-z][A-Za-z0-9+.-]*:"


def host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, ASCII lower case; empty without ``://`` or for null."""
    h = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(h, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def fitting_rule(h: Column, p: Column, rules: list[tuple[str, str]]) -> Column:
    """The longest rule whose host is ``h`` or a parent domain of it and whose path begins ``p``; ties go to the one listed first."""
    out = F.lit(None).cast("string")
    for rule, _ in sorted(reversed(rules), key=lambda r: len(r[0])):
        top, _, rest = rule.partition("/")
        out = F.when(((h == top) | h.endswith("." + top)) & p.startswith("/" + rest), F.lit(rule)).otherwise(out)
    return out


def address(url: Column) -> Column:
    """A node of the link graph: host and what follows it up to ``#``; null where there is no host."""
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^#]*)", 1)
    return F.when(host(url) != "", F.concat(host(url), F.when(rest == "", "/").otherwise(rest)))


def attribute(tag: Column, name: str) -> Column:
    """The value of an HTML attribute, quoted either way or not; ``&amp;`` decoded, ends trimmed; empty without it."""
    groups = [F.regexp_extract(tag, rf"""(?is)[\s"'/]{name}\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+))""", i) for i in (1, 2, 3)]
    return F.trim(F.regexp_replace(F.concat(*groups), "&amp;", "&"))


def target(tag: Column) -> Column:
    """Where a ``link`` with canonical among its rel tokens, or a ``meta`` refresh, points to; empty for other tags. Attributes come in any order."""
    canonical = tag.rlike(r"(?is)^<link\b") & F.lower(attribute(tag, "rel")).rlike(r"(?s)(^|\s)canonical(\s|$)")
    refresh = tag.rlike(r"(?is)^<meta\b") & (F.lower(attribute(tag, "http-equiv")) == "refresh")
    moved = F.regexp_replace(F.regexp_extract(attribute(tag, "content"), r"(?is)\burl\s*=\s*(.+)$", 1), r"""^["'\s]+|["'\s]+$""", "")
    return F.when(canonical, attribute(tag, "href")).when(refresh, moved).otherwise("")


def resolved(page: Column, t: Column) -> Column:
    """Target ``t`` as an absolute URL: with a host as it is, else from the page's host, path and directory, dot segments
    folded. Targets of other schemes (mailto:) give null."""
    way = F.concat(F.when(t.startswith("/"), F.lit("")).when(t.startswith("?") | t.startswith("#") | (t == ""), path(page)).otherwise(F.coalesce(F.nullif(F.regexp_extract(path(page), "(?s)^(.*/)", 1), F.lit("")), F.lit("/"))), F.regexp_extract(t, r"(?s)^([^?#]*)", 1))

    def fold(acc: Column, x: Column) -> Column:
        return F.when(x == "..", F.slice(acc, F.lit(1), F.greatest(F.size(acc) - 1, F.lit(1)))).when(x == ".", acc).otherwise(F.concat(acc, F.array(x)))

    parts = F.split(way, "/")
    folded = F.array_join(F.aggregate(F.slice(parts, F.lit(2), F.size(parts)), F.slice(parts, 1, 1), fold), "/")
    own = F.concat(F.lit("x://"), host(page), folded, F.regexp_extract(t, r"(?s)^[^?#]*(\?[^#]*)", 1))
    return F.when(t.rlike(r"(?s)^[A-Za-z][A-Za-z0-9+.-]*://"), t).when(t.startswith("//"), F.concat(F.lit("x:"), t)).when(~t.rlike(SCHEME), own)


def links(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(a, b): addresses joined by a canonical link or a redirect (meta refresh) of a page; relative targets are ``resolved``."""
    page = F.col(url_col)
    tags = F.regexp_extract_all(F.col(html_col), F.lit(TAG), F.lit(0))
    d = pages.where(F.col(html_col).isNotNull() & page.isNotNull()).select(page.alias("u"), F.explode(tags).alias("m"))
    d = d.select("u", target(F.col("m")).alias("t")).where("t <> ''")
    return d.select(address(F.col("u")).alias("a"), address(resolved(F.col("u"), F.col("t"))).alias("b")).where("a IS NOT NULL AND b IS NOT NULL AND a <> b").distinct()


def judge_urls(pages: DataFrame, rules: list[tuple[str, str]] = RULES, url_col: str = "url", html_col: str = "html", redirects: DataFrame | None = None, default: str = "allow") -> DataFrame:
    """``pages`` with host, path, rule and verdict (columns of these names are replaced).

    A page with a fitting rule has that rule's verdict. Any other takes its component's, formed by canonical links,
    page redirects and the edges of ``redirects`` (two address-like columns ``a`` and ``b`` of URLs): ``allow`` if any
    address in it is allowed by a rule, else ``block`` if any is blocked, else ``default``. Unlinked pages take
    ``default``. Null and broken URLs have empty host and path and no rule. Repeated pages are judged alike. Other
    columns of ``pages`` keep names and values, whatever their names.

    Only addresses with links are shuffled into components; decisions per component are partial aggregates, and pages
    meet them in an equi-join that Spark may split where one address is hot.
    """
    at, own, spread_ = private(pages, "at", "own", "spread")
    verdict_of = F.create_map(*[F.lit(x) for r in rules for x in r]) if rules else None

    def ruled(df: DataFrame) -> DataFrame:
        df = df.withColumn("rule", fitting_rule(F.col("host"), F.col("path"), rules))
        return df.withColumn(own, F.element_at(verdict_of, F.col("rule")) if rules else F.lit(None).cast("string"))

    d = ruled(pages.withColumn("host", host(F.col(url_col))).withColumn("path", path(F.col(url_col))).withColumn(at, address(F.col(url_col))))
    edges = links(pages, url_col, html_col)
    if redirects is not None:
        extra = redirects.select(address(F.col("a")).alias("a"), address(F.col("b")).alias("b"))
        edges = edges.union(extra.where("a IS NOT NULL AND b IS NOT NULL AND a <> b")).distinct()
    parts = components(edges)
    nodes = ruled(parts.withColumn("host", F.regexp_extract("node", r"(?s)^([^/?]*)", 1)).withColumn("path", F.regexp_extract("node", r"(?s)^[^/?]*([^?]*)", 1)))
    said = nodes.groupBy("component").agg(F.when(F.bool_or(F.col(own) == "allow"), "allow").when(F.bool_or(F.col(own) == "block"), "block").alias("said"))
    spread = parts.join(said, "component").select(F.col("node").alias(at), F.col("said").alias(spread_)).where(F.col(spread_).isNotNull())
    out = d.join(spread, at, "left").withColumn("verdict", F.coalesce(own, spread_, F.lit(default)))
    return out.drop(at, own, spread_)


def op2_urls(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    return judge_urls(pages).select("page_id", "host", "path", "rule", "verdict")
