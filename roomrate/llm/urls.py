r"""URL filters (operator 11) with redirect equivalence, DataFrame functions only.

1. Rules are (host, path, action). A rule fits its host and all subdomains if
   the url's path starts with the rule's; the longest (host and path together)
   wins, then the longer host, then allow. Matching is an equi-join: each
   distinct (host, path) meets the rules under its host suffixes and, for each
   host, under its prefixes of the lengths that the host's rules have. A url
   never meets rules of other hosts, however long the list is.
2. Aliases are the connected components over redirect edges: canonical links
   and meta refreshes found in html, and any (src, dst) table given, such as a
   crawler's redirects. A node is host, path and query: scheme and fragment do
   not name another page.
3. A component with an explicitly blocked url, on a page or only as a target,
   blocks its members that no rule fits; a component that also holds an
   explicitly allowed url does not (allow has precedence). A rule that fits a
   url itself always decides for it. All else is allowed.

Joins are on host suffixes, nodes and components; the sides to which rows are
joined have one row a key, so a hot host or component is split by the adaptive
skew join. Components' decisions are pre-aggregated by task.

Defined results: a null url, or one without ``://``, has empty host and path,
no rule and no aliases, and is allowed. A rule without a leading slash in its
path fits no url, as paths begin with one or are empty; null rules are left
out. Null html has no links; ``<base>`` is not read; comments, scripts and
styles are not searched. Several canonical links are several edges. Repeated
rows stay repeated; other columns of ``pages`` are not read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roomrate.llm.common import staged
from roomrate.llm.components import components

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: What is not searched for links.
_HIDDEN = r"(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>"


def _rest(url: Column) -> Column:
    """What follows the first ``://``; null if there is none."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url)))


def host_of(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(_rest(url), r"^[^/?#]*", 0), _UPPER, _LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def node_of(url: Column) -> Column:
    """Host, path (at least a slash) and query; null without ``://``."""
    path = path_of(url)
    query = F.regexp_extract(_rest(url), r"^[^?#]*(\?[^#]*)", 1)
    return F.when(_rest(url).isNotNull(), F.concat(
        host_of(url), F.when(path == "", "/").otherwise(path), F.when(query == "?", "").otherwise(query)))


def resolved(base: Column, link: Column) -> Column:
    """Absolute form of ``link`` on the page ``base`` (null if the page has no
    host or the link is to something other than a page)."""
    link = F.trim(F.regexp_replace(link, r"(?i)&amp;|&#38;|&#x26;", "&"))
    scheme = F.regexp_extract(base, r"^[^:/?#]*", 0)
    root = F.concat(scheme, F.lit("://"), F.regexp_extract(_rest(base), r"^[^/?#]*", 0))
    folder = F.regexp_extract(path_of(base), r"^(?:.*/)?", 0)
    own = F.regexp_replace(base, r"[?#].*$", "")
    return (F.when(_rest(base).isNull() | (link == ""), None)
            .when(F.rlike(link, F.lit(r"^[A-Za-z][A-Za-z0-9+.-]*://")), link)
            .when(F.rlike(link, F.lit(r"^[A-Za-z][A-Za-z0-9+.-]*:")), None)
            .when(link.startswith("//"), F.concat(scheme, F.lit(":"), link))
            .when(link.startswith("/"), F.concat(root, link))
            .when(link.startswith("#"), base)
            .when(link.startswith("?"), F.concat(own, link))
            .otherwise(F.concat(root, F.when(folder == "", "/").otherwise(folder), link)))


def _attribute(tag: Column, name: str) -> Column:
    at = rf"(?is)\s{name}\s*=\s*"
    parts = [F.regexp_extract(tag, at + x, 1) for x in (r'"([^"]*)"', r"'([^']*)'", r"""([^\s"'>]+)""")]
    return F.coalesce(*[F.when(p != "", p) for p in parts], F.lit(""))


def html_edges(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(src, dst): urls of pages and the targets of their canonical links and
    meta refreshes."""
    html, url = F.col(html_col), F.col(url_col)
    # most pages have neither word: their html is looked through once
    some = pages.select(url.alias("src"), html.alias("html")).filter(
        F.rlike(F.col("html"), F.lit(r"(?i)canonical|http-equiv")))
    seen = F.regexp_replace("html", _HIDDEN, " ")
    links = F.filter(F.regexp_extract_all(seen, F.lit(r"(?is)<link\s[^>]*>"), 0), lambda t: F.array_contains(
        F.split(F.lower(_attribute(t, "rel")), r"\s+"), "canonical"))
    metas = F.filter(F.regexp_extract_all(seen, F.lit(r"(?is)<meta\s[^>]*>"), 0),
                     lambda t: F.lower(F.trim(_attribute(t, "http-equiv"))) == "refresh")
    refresh = r"""(?is)^[^;,]*[;,]\s*(?:url\s*=\s*)?['"]?([^'"]*)"""
    targets = F.concat(F.transform(links, lambda t: _attribute(t, "href")),
                       F.transform(metas, lambda t: F.regexp_extract(_attribute(t, "content"), refresh, 1)))
    found = some.select("src", F.explode(targets).alias("link"))
    return found.select("src", resolved(F.col("src"), F.col("link")).alias("dst")).filter("dst is not null")


def matched_rules(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """(host, path, rule, action) of the distinct (host, path) of ``urls`` that
    a rule fits. ``rules``: (host, path, action)."""
    own = (rules.select(F.translate("host", _UPPER, _LOWER).alias("rule_host"), F.col("path").alias("rule_path"),
                        F.col("action").alias("action"))
           .filter("rule_host is not null and rule_path is not null and action is not null")
           .groupBy("rule_host", "rule_path").agg(F.min("action").alias("action")))  # allow before block
    lengths = own.groupBy("rule_host").agg(F.collect_set(F.length("rule_path")).alias("lengths"))
    labels = own.agg(F.max(F.size(F.split("rule_host", r"\."))).alias("n")).first()["n"]
    labels = labels or 0  # of the longest host in the rules: longer suffixes fit none
    suffix = F.transform(F.sequence(F.lit(1), F.least(F.size(F.split("host", r"\.")), F.lit(max(labels, 1)))),
                         lambda k: F.call_function("substring_index", F.col("host"), F.lit("."), -k))
    under = urls.select("host", "path").distinct().withColumn("rule_host", F.explode(F.array_distinct(suffix)))
    prefixes = (under.join(lengths, "rule_host").withColumn("m", F.explode("lengths"))
                .filter(F.length("path") >= F.col("m"))
                .withColumn("rule_path", F.expr("left(path, m)")))
    fits = prefixes.join(own, ["rule_host", "rule_path"])
    size = F.length("rule_host") + F.length("rule_path")
    best = F.max(F.struct(size.alias("size"), F.length("rule_host").alias("host_size"),
                          F.concat("rule_host", "rule_path").alias("rule"), "action")).alias("best")
    return (fits.filter(F.col("rule_path").startswith("/")).groupBy("host", "path").agg(best)
            .select("host", "path", "best.rule", "best.action"))


def judge(pages: DataFrame, rules: DataFrame, redirects: DataFrame | None = None, id_col: str = "page_id",
          url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(id, host, path, rule, verdict, propagated) of every row of ``pages``;
    ``propagated``: blocked because an alias is. ``redirects``: more edges, as
    (src, dst) urls."""
    edges = html_edges(pages, url_col, html_col)
    if redirects is not None:
        edges = edges.unionByName(redirects.select("src", "dst"))
    edges = staged(edges.select("src", "dst"), "url-edges")
    ends = edges.select(F.col("src").alias("url")).union(edges.select("dst"))
    named = lambda df: df.withColumn("host", host_of(F.col("url"))).withColumn("path", path_of(F.col("url")))
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"))
    decided = staged(matched_rules(named(rows.select("url").union(ends)), rules), "url-rules")

    # one row per node of a component, with the decision of the rule that fits it
    members = components(edges.select(node_of(F.col("src")).alias("u"), node_of(F.col("dst")).alias("v")))
    nodes = members.withColumn("url", F.concat(F.lit("x://"), F.col("node")))
    known = (named(nodes).join(decided, ["host", "path"], "left").groupBy("component")
             .agg(*[F.max(F.coalesce((F.col("action") == a).cast("int"), F.lit(0))).alias(a)
                    for a in ("allow", "block")]))
    blocked = (nodes.join(known.filter("block = 1 and allow = 0"), "component")
               .select(F.col("node").alias("blocked")))

    out = (named(rows).withColumn("node", node_of(F.col("url"))).join(decided, ["host", "path"], "left")
           .join(blocked, F.col("node") == F.col("blocked"), "left"))
    spread = F.col("rule").isNull() & F.col("blocked").isNotNull()
    return out.select(F.col("id").alias(id_col), "host", "path", "rule",
                      F.coalesce("action", F.when(spread, "block"), F.lit("allow")).alias("verdict"),
                      spread.alias("propagated"))


def rule_table(spark, rules: list[tuple[str, str]]) -> DataFrame:
    """Rules given as (action, "host/path")."""
    rows = [(r.partition("/")[0], "/" + r.partition("/")[2], action) for action, r in rules]
    values = reduce(lambda a, b: a.union(b), [
        spark.range(1).select(F.lit(h).alias("host"), F.lit(p).alias("path"), F.lit(a).alias("action"))
        for h, p, a in rows]) if rows else None
    return values if values is not None else spark.range(0).selectExpr(
        "cast(null as string) host", "cast(null as string) path", "cast(null as string) action")
