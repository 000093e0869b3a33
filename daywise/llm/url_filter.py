"""URL filters with redirect equivalence.

URLs that redirect to each other or name each other as canonical are aliases. Rules decide the
URLs they fit; what no rule fits takes the decision of its aliases: allowed if one of them is
expressly allowed, else blocked if one is blocked.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..session import materialise
from .components import connected_components

RULES = "verdict string, host string, path string"
DEFAULT = "allow"


def host_of(url: Column) -> Column:
    """What comes after the first `://` up to `/`, `?`, `#` or the end, A-Z lower-cased; else empty."""
    found = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(F.coalesce(found, F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """What comes after the host up to `?`, `#` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _alias_key(url: Column) -> Column:
    """A URL without scheme and fragment: host, path and query. Empty if it has no `://`."""
    query = F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^?#]*(\?[^#]*)", 1), F.lit(""))
    return F.concat(host_of(url), path_of(url), query)


def _without_dots(path: Column) -> Column:
    """A path in which `.` and `..` are followed."""
    parts = F.split(path, "/")
    ends_in_folder = F.element_at(parts, -1).isin(".", "..")
    parts = F.when(ends_in_folder, F.concat(parts, F.array(F.lit("")))).otherwise(parts)

    def follow(seen: Column, part: Column) -> Column:
        up = F.when(F.size(seen) > 1, F.slice(seen, 1, F.size(seen) - 1)).otherwise(seen)
        return F.when(part == "..", up).when(part == ".", seen).otherwise(F.concat(seen, F.array(part)))

    return F.array_join(F.aggregate(parts, F.array().cast("array<string>"), follow), "/")


def _absolute(link: Column, base: Column) -> Column:
    """A link as a page at `base` means it; null for one to the page itself, or to something that is no page."""
    scheme = F.coalesce(F.regexp_extract(base, r"(?s)^(.*?)://", 1), F.lit(""))
    origin = F.concat(scheme, F.lit("://"), host_of(base))
    folder = F.regexp_replace(path_of(base), r"[^/]*$", "")
    folder = F.when(folder == "", "/").otherwise(folder)
    path, rest = F.regexp_extract(link, r"(?s)^([^?#]*)", 1), F.regexp_extract(link, r"(?s)^[^?#]*(.*)$", 1)
    return (
        F.when((link == "") | link.startswith("#"), None)
        .when(link.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"), link)
        .when(link.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), None)
        .when(link.startswith("//"), F.concat(scheme, F.lit(":"), link))
        .when(host_of(base) == "", None)
        .when(link.startswith("?"), F.concat(origin, path_of(base), link))
        .when(link.startswith("/"), F.concat(origin, _without_dots(path), rest))
        .otherwise(F.concat(origin, _without_dots(F.concat(folder, path)), rest))
    )


def _base(html: Column, url: Column) -> Column:
    """What the links of a page start from: its first base tag, or its URL."""
    tag = F.regexp_extract(html, r"(?is)<base\b[^>]*\bhref\s*=\s*[\"']?([^\"'\s>]+)", 1)
    return F.coalesce(_absolute(tag, url), url)


def _links(html: Column) -> Column:
    """Targets of canonical links and of refresh redirects in a page."""
    tags = F.regexp_extract_all(html, F.lit(r"(?is)<link\b[^>]*\brel\s*=\s*[\"']?canonical\b[^>]*>"), F.lit(0))
    canonical = F.transform(tags, lambda t: F.regexp_extract(t, r"(?is)\bhref\s*=\s*[\"']?([^\"'\s>]+)", 1))
    moves = F.regexp_extract_all(html, F.lit(r"(?is)<meta\b[^>]*\bhttp-equiv\s*=\s*[\"']?refresh\b[^>]*>"), F.lit(0))
    moved = F.transform(moves, lambda t: F.regexp_extract(t, r"(?is)\burl\s*=\s*[\"']?([^\"'\s>]+)", 1))
    return F.transform(F.concat(canonical, moved), lambda t: F.replace(t, F.lit("&amp;"), F.lit("&")))


def page_links(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """(a, b): a page's URL and one that its HTML redirects to or names as canonical.

    Relative links are taken from the page's base tag or else its URL. A null page, or one without such a tag, gives no row.
    """
    base = _base(F.col(html), F.col(url))
    found = pages.select(F.col(url).alias("a"), base.alias("base"), F.explode(_links(F.col(html))).alias("link"))
    return found.select("a", _absolute(F.col("link"), F.col("base")).alias("b")).filter("b is not null")


def rules(spark: SparkSession, listed: Sequence[tuple[str, str]]) -> DataFrame:
    """Rules from (verdict, `host/path`) pairs."""
    rows = [(verdict, *rule.partition("/")[::2]) for verdict, rule in listed]
    return spark.createDataFrame([(v, h, "/" + p) for v, h, p in rows], RULES)


def _suffixes(host: Column) -> Column:
    """A host and all domains above it."""
    labels = F.split(host, r"\.")
    return F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))


def apply_rules(places: DataFrame, ruled: DataFrame) -> DataFrame:
    """The longest rule for each of the distinct (host, path): adds `rule` and `ruled`, null where none fits.

    A rule fits its host and subdomains, if the path starts with its path. Domains are joined by
    equality; Spark broadcasts the rules if they are few and splits a hot domain if not.
    """
    names = ruled.select(
        F.lower("host").alias("domain"), F.col("path").alias("start"), F.col("verdict").alias("ruled"),
        F.concat(F.lower("host"), "path").alias("rule"),
    )
    domains = places.select("host", "path", F.explode(_suffixes(F.col("host"))).alias("domain"))
    fits = domains.join(names, "domain").filter(F.col("path").startswith(F.col("start")))
    order = F.struct(F.length("rule"), F.when(F.col("ruled") == "allow", 1).otherwise(0), "rule", "ruled")
    longest = fits.groupBy("host", "path").agg(F.max(order).alias("best"))
    best = longest.select("host", "path", "best.rule", "best.ruled")
    return places.join(best, ["host", "path"], "left")


def judge(
    pages: DataFrame, ruled: DataFrame, links: DataFrame | None = None, page_id: str = "page_id", url: str = "url",
    html: str = "html", default: str = DEFAULT,
) -> DataFrame:
    """A row for each page: page_id, host, path, rule, verdict, by (`rule`, `alias` or `default`).

    Aliases come from the pages' HTML and from `links`, a frame of two URLs such as a crawler's
    redirect log. They are equal if they agree but for scheme and fragment. URLs are reduced to distinct ones
    before they meet rules and components, so hot hosts and copies of a page cost little. A null
    URL has empty host and path, no rule and no alias; of rules for one host and path, allow wins.
    An empty table gives no rows.
    """
    u = F.col(url)
    rows = pages.select(
        F.col(page_id).alias("page_id"), host_of(u).alias("host"), path_of(u).alias("path"), _alias_key(u).alias("key")
    )
    found = page_links(pages, url, html)
    if links is not None:
        found = found.union(links.select(*[F.col(c) for c in links.columns[:2]]))
    edges = found.select(_alias_key(F.col("a")).alias("a"), _alias_key(F.col("b")).alias("b")).filter("a <> '' and b <> ''")
    roots = connected_components(edges)
    known = rows.select("host", "path", "key").distinct()
    # URLs of links that are no pages of their own have a say, too.
    ends = found.select("a").union(found.select("b")).select(
        host_of(F.col("a")).alias("host"), path_of(F.col("a")).alias("path"), _alias_key(F.col("a")).alias("key")
    )
    named = apply_rules(known.union(ends).distinct(), ruled)
    named = materialise(named.join(roots.withColumnRenamed("node", "key"), "key", "left"), "named")
    say = named.filter("root is not null and ruled is not null").groupBy("root").agg(F.min("ruled").alias("shared"))
    judged = named.join(say, "root", "left").select(
        "host", "path", "key", "rule",
        F.coalesce("ruled", "shared", F.lit(default)).alias("verdict"),
        F.when(F.col("ruled").isNotNull(), "rule").when(F.col("shared").isNotNull(), "alias").otherwise("default").alias("by"),
    )
    return rows.join(judged, ["host", "path", "key"]).select("page_id", "host", "path", "rule", "verdict", "by")
