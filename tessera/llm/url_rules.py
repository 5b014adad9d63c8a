"""URL filters with redirect equivalence.

Rules allow or block a host (with its subdomains) and a path prefix; the longest
fitting rule decides. Redirects and canonical links make URLs aliases: the
connected components of those edges. A URL that no rule fits takes its
component's verdict: an explicit allow of any alias wins over blocks, a block
of any alias blocks, else it is allowed. A URL's own rule always stands.

DataFrame operations only. URLs are matched across edges by host, path and
query (scheme and fragment say nothing about the resource), as md5 digests.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut_lineage, lookup_spread
from .components import connected_components

#: (host, path, verdict)
RULES = (("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
         ("com", "/fr/", "allow"), ("com", "/de/", "block"))
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ALLOW, BLOCK = "allow", "block"


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, url.substr(at + 3, F.length(url)))


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end; lower-case ASCII; else empty."""
    return F.coalesce(F.translate(F.regexp_extract(_after_scheme(url), r"(?s)^([^/?#]*)", 1), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(_after_scheme(url), r"(?s)^[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> Column:
    """``struct(rule, verdict)`` of the longest fitting rule, else null. ``rules``
    is a parameter list: it becomes one expression."""
    order = sorted(rules, key=lambda r: (-len(r[0] + r[1]), r))
    out = F.lit(None)
    for h, p, verdict in reversed(order):
        fits = ((host == F.lit(h)) | host.endswith("." + h)) & path.startswith(p)
        out = F.when(fits, F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def _key(url: Column) -> Column:
    """The node of a URL: host, path and query; null where there is no ``://``."""
    query = F.regexp_extract(_after_scheme(url), r"(?s)^[^?#]*(\?[^#]*)?", 1)
    return F.when(F.instr(url, "://") > 0, F.md5(F.concat(host_of(url), path_of(url), query).cast("binary")))


def page_edges(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``(source, target)`` URLs: canonical links and refresh redirects in the html.
    A target without a scheme is taken relative to the page."""
    html, url = F.col(f"`{html_col}`"), F.col(f"`{url_col}`")
    low, none = F.lower(html), F.array().cast("array<string>")
    # a tag ends at the first sign, so one piece between two signs holds the whole of it; every
    # pattern reads a piece once, whatever the markup
    closed = F.slice(F.split(html, ">"), 1, F.greatest(F.size(F.split(html, ">")) - 1, F.lit(0)))

    def targets(word: str, tag: str, says: str, attribute: str) -> Column:
        part = lambda x: F.regexp_extract(x, rf"(?is)(<{tag}\b.*+)", 1)
        tags = F.filter(F.transform(F.filter(closed, lambda x: F.lower(x).contains(word)), part), lambda x: x.rlike(says))
        value = lambda x: F.regexp_extract(x, rf'(?is)\b{attribute}\s*+=\s*+["\']?+\s*+([^"\'\s]++)', 1)
        return F.when(low.contains(word), F.transform(tags, value)).otherwise(none)

    found = pages.select(url.alias("source"), F.explode(F.concat(
        F.coalesce(targets("canonical", "link", r'(?is)\brel\s*+=\s*+["\']?+canonical\b', "href"), none),
        F.coalesce(targets("refresh", "meta", r'(?is)\bhttp-equiv\s*+=\s*+["\']?+refresh\b', "url"), none))).alias("t"))
    site = F.regexp_extract("source", r"(?s)^([^:]*://[^/?#]*)", 1)
    folder = F.regexp_extract("source", r"(?s)^([^:]*://[^/?#]*(?:/[^?#]*/|/)?)", 1)
    target = F.regexp_replace("t", "&amp;", "&")
    return found.where("t <> ''").select("source", F.when(target.contains("://"), target)
        .when(target.startswith("//"), F.concat(F.regexp_extract("source", "^([^:]*:)", 1), target))
        .when(target.startswith("/"), F.concat(site, target))
        .otherwise(F.concat(folder, F.when(folder.endswith("/"), "").otherwise("/"), target)).alias("target"))


def judge(pages: DataFrame, edges: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES,
          id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """``(id, host, path, rule, verdict)``, one row per row of ``pages``. ``edges``
    has ``(source, target)`` URLs, in ``pages`` or not. Null URLs and URLs without
    ``://`` have an empty host and path, fit no rule, have no aliases and are
    allowed. Repeated pages and edges change nothing; no edges leave the rules."""
    url = F.col(f"`{url_col}`").cast("string")
    own = pages.select(F.col(f"`{id_col}`").alias("id"), host_of(url).alias("host"), path_of(url).alias("path"),
                       _key(url).alias("node"))
    own = own.withColumn("own", rule_of(F.col("host"), F.col("path"), rules))
    ends = cut_lineage(edges.select(F.col("source").cast("string").alias("s"), F.col("target").cast("string").alias("t"))
                       .where(F.col("s").isNotNull() & F.col("t").isNotNull()).distinct())
    links = ends.select(_key(F.col("s")).alias("u"), _key(F.col("t")).alias("v"))
    out = lambda d, verdict: d.select("id", "host", "path", F.col("own.rule").alias("rule"),
                                      F.coalesce("own.verdict", verdict, F.lit(ALLOW)).alias("verdict"))
    roots = cut_lineage(connected_components(links, "u", "v"))
    if roots.isEmpty():
        return out(own, F.lit(None))
    known = ends.select(F.explode(F.array("s", "t")).alias("x")).select(
        _key(F.col("x")).alias("node"), rule_of(host_of(F.col("x")), path_of(F.col("x")), rules)["verdict"].alias("w"))
    members = cut_lineage(known.where("node is not null").distinct().join(roots, "node"))
    # allow sorts before block: the smallest verdict of a component wins
    verdicts = cut_lineage(members.groupBy("root").agg(F.min("w").alias("alias_verdict"))
                           .where("alias_verdict is not null"))
    by_node = cut_lineage(lookup_spread(roots, verdicts, "root", "inner").select("node", "alias_verdict"))
    # only pages without a rule of their own look for an alias; one URL may hold many of them
    settled, open_ = own.where("own is not null"), own.where("own is null")
    found = lookup_spread(cut_lineage(open_), by_node, "node")
    return out(settled, F.lit(None)).unionByName(out(found, F.col("alias_verdict")))
