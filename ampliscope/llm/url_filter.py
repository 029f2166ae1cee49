"""URL filters with redirect equivalence.

A page's own url is judged by the longest rule that fits it. Where none fits, the
decision of its aliases holds: pages tied by canonical links or meta redirects, and
by any redirect table given, form a component (found by distributed connected
components). A component with an explicitly allowed url is allowed, else one with a
blocked url is blocked, else the page is allowed.

A node is host and path, so scheme, query and fragment variants of a url are one
node. Links in comments and scripts don't count. A relative target is resolved against the
page's url, or an absolute `<base>` where there is one, dot segments and all.

Defined cases: a null url or one without `://` has an empty host and path, no
aliases, and is allowed. Null or empty html has no links. Repeated pages keep a row
each. Equally long rules: allow wins, then the larger rule text. An empty table
gives an empty table. Other columns are not read.
"""

from __future__ import annotations

from collections import defaultdict

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ampliscope.llm.common import materialize
from ampliscope.llm.components import connected_components

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: (verdict, rule) as host, then path.
RULES = [("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/")]

HOST = r"(?s)^.*?://([^/?#]*)"
PATH = r"(?s)^.*?://[^/?#]*([^?#]*)"
NOT_SHOWN = r"(?is)<!--.*?-->|<script\b.*?</script>"
LINK_TAGS = r"(?is)<(?:link|meta)\b[^>]*>"
CANONICAL = r"(?is)[\s\"'/]rel\s*=\s*[\"']?[^\"'>]*\bcanonical\b"
HREF = r"(?is)[\s\"'/]href\s*=\s*[\"']?([^\"'\s>]+)"
REFRESH = r"(?is)[\s\"'/]http-equiv\s*=\s*[\"']?refresh\b"
BASE = r"(?is)<base\b[^>]*?[\s\"'/]href\s*=\s*[\"']?([^\"'\s>]+)"
REFRESH_URL = r"(?is)\burl\s*=\s*[\"']?([^\"'\s>;]+)"


def host_and_path(url: Column) -> tuple[Column, Column]:
    host = F.translate(F.regexp_extract(url, HOST, 1), UPPER, LOWER)
    return F.coalesce(host, F.lit("")), F.coalesce(F.regexp_extract(url, PATH, 1), F.lit(""))


def _rule(host: Column, path: Column, rules: list[tuple[str, str]]) -> Column:
    """Struct (length, allow, rule) of the longest rule that fits, else null."""
    by_host: dict[str, list[tuple[str, str]]] = defaultdict(list)
    for verdict, rule in rules:
        by_host[rule.partition("/")[0]].append((verdict, rule))
    if not by_host:
        return F.lit(None).cast("struct<n:int,allow:boolean,rule:string>")
    table = F.create_map(*(x for h, own in sorted(by_host.items()) for x in (F.lit(h), F.array(*(F.struct(F.lit(len(r)).alias("n"), F.lit(v == "allow").alias("allow"), F.lit(r).alias("rule"), F.lit(r[len(h) :]).alias("path")) for v, r in sorted(own))))))
    labels = F.split(host, r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    fits = F.flatten(F.filter(F.transform(suffixes, lambda s: F.element_at(table, s)), lambda x: x.isNotNull()))
    fits = F.filter(fits, lambda r: path.startswith(r["path"]))
    return F.array_max(F.transform(fits, lambda r: F.struct(r["n"], r["allow"], r["rule"])))


def _undotted(url: Column) -> Column:
    """x://host/path without the dot segments of its path; query and fragment stay."""
    path = F.regexp_replace(F.regexp_extract(url, PATH, 1), r"/\.\.?$", "$0/")
    step = lambda acc, s: F.when(s == ".", acc).when(s == "..", F.slice(acc, F.lit(1), F.greatest(F.size(acc) - 1, F.lit(1)))).otherwise(F.concat(acc, F.array(s)))
    parts = F.split(path, "/")
    flat = F.array_join(F.aggregate(F.slice(parts, F.lit(2), F.size(parts)), F.slice(parts, F.lit(1), F.lit(1)), step), "/")
    return F.when(path.rlike(r"/\.\.?/"), F.concat(F.regexp_extract(url, r"(?s)^[^/]*//[^/?#]*", 0), flat, F.regexp_extract(url, r"(?s)[?#].*$", 0))).otherwise(url)


def _target(host: Column, path: Column, href: Column) -> Column:
    """An absolute url for a link's target; null for one without a place."""
    base = F.concat(F.lit("x://"), host)
    return (
        F.when(F.length(href) == 0, None)
        .when(href.contains("://"), href)
        .when(href.startswith("//"), F.concat(F.lit("x:"), href))
        .when(href.startswith("/"), _undotted(F.concat(base, href)))
        .when(href.startswith("#") | href.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), None)
        .otherwise(_undotted(F.concat(base, F.when(path.contains("/"), F.regexp_replace(path, r"[^/]*$", "")).otherwise("/"), href)))
    )


def links(pages: DataFrame) -> DataFrame:
    """(host, path, to_host, to_path): canonical links and meta redirects in the pages' html."""
    shown = F.regexp_replace("html", NOT_SHOWN, "")
    tags = F.regexp_extract_all(shown, F.lit(LINK_TAGS), F.lit(0))
    base = F.regexp_extract(shown, BASE, 1)
    (host, path), (base_host, base_path) = host_and_path(F.col("url")), host_and_path(base)
    absolute = F.coalesce(base.contains("://"), F.lit(False))
    from_host, from_path = F.when(absolute, base_host).otherwise(host), F.when(absolute, base_path).otherwise(path)
    tags = F.filter(tags, lambda t: t.rlike(CANONICAL) | t.rlike(REFRESH))
    tag = F.col("tag")
    href = F.when(tag.rlike(CANONICAL), F.regexp_extract(tag, HREF, 1)).otherwise(F.regexp_extract(tag, REFRESH_URL, 1))
    to = F.col("target")
    found = pages.where(F.col("url").contains("://")).select(host.alias("host"), path.alias("path"), from_host.alias("from_host"), from_path.alias("from_path"), F.explode(tags).alias("tag")).select("host", "path", _target(F.col("from_host"), F.col("from_path"), href).alias("target")).where(to.isNotNull())
    to_host, to_path = host_and_path(to)
    return found.select("host", "path", to_host.alias("to_host"), to_path.alias("to_path")).where("to_host != ''")


def judge(pages: DataFrame, rules: list[tuple[str, str]] = RULES, redirects: DataFrame | None = None) -> DataFrame:
    """Verdict for every page. redirects: further (from_url, to_url) edges."""
    host, path = host_and_path(F.col("url"))
    edges = links(pages)
    if redirects is not None:
        (h1, p1), (h2, p2) = host_and_path(F.col("from_url")), host_and_path(F.col("to_url"))
        edges = edges.unionByName(redirects.select(h1.alias("host"), p1.alias("path"), h2.alias("to_host"), p2.alias("to_path")).where("host != '' and to_host != ''"))
    ends = edges.select(F.concat("host", F.lit("\n"), "path").alias("a"), F.concat("to_host", F.lit("\n"), "to_path").alias("b"))
    member = connected_components(ends, "a", "b")
    at = F.instr("node", "\n")
    of = _rule(F.expr("substring_index(node, '\n', 1)"), F.substring(F.col("node"), at + 1, F.length("node")), rules)
    decided = member.select("component", of.alias("r")).groupBy("component").agg(F.max(F.col("r.allow").cast("int")).alias("best")).where("best is not null")
    decided = materialize(decided, "decided")
    alias = materialize(member.join(decided, "component").select("node", F.col("best").alias("alias_allow")), "aliases")
    own = pages.select("page_id", host.alias("host"), path.alias("path")).withColumn("r", _rule(F.col("host"), F.col("path"), rules))
    own = own.withColumn("node", F.concat("host", F.lit("\n"), "path"))
    out = own.join(alias, "node", "left")
    allowed = F.coalesce(F.col("r.allow").cast("int"), F.when(F.col("host") != "", F.col("alias_allow")), F.lit(1))
    via = F.when(F.col("r").isNotNull(), "rule").when(F.col("alias_allow").isNotNull() & (F.col("host") != ""), "alias").otherwise("default")
    return out.select("page_id", "host", "path", F.col("r.rule").alias("rule"), F.when(allowed == 1, "allow").otherwise("block").alias("verdict"), via.alias("via"))


def _parse(url: str) -> str:
    host = f"translate(regexp_extract({url}, '{HOST}', 1), '{UPPER}', '{LOWER}')"
    return f"coalesce({host}, '') AS host, coalesce(regexp_extract({url}, '{PATH}', 1), '') AS path"


def _sql() -> str:
    rules = ", ".join(f"({len(r)}, {v == 'allow'}, '{r}', '{r.partition('/')[0]}', '/{r.partition('/')[2]}')" for v, r in RULES)
    fits = "(n.host = r.host OR ends_with(n.host, '.' || r.host)) AND starts_with(n.path, r.path)"
    quoted = {k: v.replace("'", "''").replace("(?is)", "") for k, v in {"not_shown": NOT_SHOWN, "tags": LINK_TAGS, "canonical": CANONICAL, "href": HREF, "refresh": REFRESH, "refresh_url": REFRESH_URL, "base": BASE}.items()}
    return f"""
WITH RECURSIVE rules(n, allow, rule, host, path) AS (VALUES {rules}),
own AS (SELECT page_id, {_parse("url")}, html FROM pages),
shown AS (SELECT host, path, regexp_replace(html, '{quoted["not_shown"]}', '', 'gis') AS html FROM own WHERE host != '' OR path != ''),
based AS (SELECT s.host, s.path, html, CASE WHEN contains(base, '://') THEN b.host ELSE s.host END AS from_host, CASE WHEN contains(base, '://') THEN b.path ELSE s.path END AS from_path
  FROM (SELECT *, regexp_extract(html, '{quoted["base"]}', 1, 'is') AS base FROM shown) s, LATERAL (SELECT {_parse("s.base")}) b),
tags AS (SELECT host, path, from_host, from_path, unnest(regexp_extract_all(html, '{quoted["tags"]}', 0, 'is')) AS tag FROM based),
hrefs AS (SELECT host, path, from_host, from_path, CASE WHEN regexp_matches(tag, '{quoted["canonical"]}', 'is') THEN regexp_extract(tag, '{quoted["href"]}', 1, 'is') WHEN regexp_matches(tag, '{quoted["refresh"]}', 'is') THEN regexp_extract(tag, '{quoted["refresh_url"]}', 1, 'is') ELSE '' END AS href FROM tags),
targets AS (SELECT host, path, CASE WHEN href = '' THEN NULL WHEN contains(href, '://') THEN href WHEN starts_with(href, '//') THEN 'x:' || href WHEN starts_with(href, '/') THEN 'x://' || from_host || href
  WHEN starts_with(href, '#') OR regexp_matches(href, '^[A-Za-z][A-Za-z0-9+.-]*:') THEN NULL ELSE 'x://' || from_host || CASE WHEN contains(from_path, '/') THEN regexp_replace(from_path, '[^/]*$', '') ELSE '/' END || href END AS target,
  contains(href, '://') OR starts_with(href, '//') AS whole FROM hrefs),
split AS (SELECT *, regexp_replace(regexp_extract(target, '{PATH}', 1), '/(\\.\\.?)$', '/\\1/') AS p FROM targets WHERE target IS NOT NULL),
linked AS (SELECT host, path, CASE WHEN whole OR NOT regexp_matches(p, '/\\.\\.?/') THEN target ELSE regexp_extract(target, '^[^/]*//[^/?#]*', 0) || array_to_string(list_reduce(list_transform(string_split(p, '/'), lambda x: [x]),
  lambda acc, x: CASE WHEN x[1] = '.' THEN acc WHEN x[1] = '..' THEN acc[1:greatest(len(acc) - 1, 1)] ELSE list_concat(acc, x) END), '/') || regexp_extract(target, '(?s)[?#].*$', 0) END AS target FROM split),
ends AS (SELECT a.host || chr(10) || a.path AS a, t.host || chr(10) || t.path AS b FROM linked a, LATERAL (SELECT {_parse("a.target")}) t WHERE t.host != ''),
both_ways AS (SELECT a, b FROM ends UNION SELECT b, a FROM ends UNION SELECT a, a FROM ends UNION SELECT b, b FROM ends),
reach(node, other) AS (SELECT a, b FROM both_ways UNION SELECT r.node, e.b FROM reach r JOIN both_ways e ON r.other = e.a),
judged AS (SELECT n.node, arg_max(r.allow, r.n) AS allow FROM (SELECT DISTINCT node, split_part(node, chr(10), 1) AS host, substr(node, strpos(node, chr(10)) + 1) AS path FROM reach) n JOIN rules r ON {fits} GROUP BY n.node),
alias AS (SELECT reach.node, bool_or(j.allow) AS allow FROM reach JOIN judged j ON j.node = reach.other GROUP BY reach.node),
best AS (SELECT n.page_id, n.host, n.path, arg_max(r.rule, r.n) AS rule, arg_max(r.allow, r.n) AS allow FROM own n LEFT JOIN rules r ON {fits} GROUP BY n.page_id, n.host, n.path)
SELECT b.page_id, b.host, b.path, b.rule, CASE WHEN coalesce(b.allow, a.allow, true) THEN 'allow' ELSE 'block' END AS verdict,
  CASE WHEN b.rule IS NOT NULL THEN 'rule' WHEN a.allow IS NOT NULL THEN 'alias' ELSE 'default' END AS via
FROM best b LEFT JOIN alias a ON b.host != '' AND a.node = b.host || chr(10) || b.path"""


SQL = _sql()
