"""URL filters: rule decisions pass to aliases over redirect and canonical-link edges, in built-in functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import connected_components, materialize

# Fixed values: (verdict, host, path) of the rules.
RULES = (("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"), ("block", "net", "/fr/"))
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """After the first `://` up to `/`, `?`, `#` or the end, A-Z lower-cased; empty for null or without `://`."""
    return F.coalesce(F.translate(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), _UPPER, _LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """From the host's end up to `?`, `#` or the end; empty for null or without `://`."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def matched_rule(host: Column, path: Column, rules=RULES) -> Column:
    """The longest rule (host and path) that fits, as (rule, verdict); null without one. Allow wins a tie."""
    fits = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, h, p in sorted(rules, key=lambda r: (len(r[1]) + len(r[2]), r[0] == "allow")):
        fit = ((host == h) | F.endswith(host, F.lit("." + h))) & F.startswith(path, F.lit(p))
        fits = F.when(fit, F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(fits)
    return fits


def canonical_form(host: Column, path: Column) -> Column:
    """The form that the usual redirects lead to: without scheme, query, fragment, `www.` or `m.`, `.html`, end slash."""
    return F.concat(F.regexp_replace(host, r"^(www|m)\.", ""), F.regexp_replace(path, r"(\.html|/)+$", ""))


# The tags that name another URL, what they must hold, and where the URL stands in them.
_TARGETS = (
    ("(?is)<link\\b[^>]*>", "(?i)\\brel\\s*=\\s*[\"']?canonical\\b", "(?i)\\bhref\\s*=\\s*[\"']?([^\"'\\s>]+)"),
    ("(?is)<meta\\b[^>]*>", "(?i)\\bhttp-equiv\\s*=\\s*[\"']?refresh\\b", "(?i)\\burl\\s*=\\s*[\"']?([^\"'\\s>]+)"),
)
# What is no markup of the page although it may hold tags.
_ASIDE = "(?is)<!--.*?(?:-->|\\z)|<script\\b.*?(?:</script|\\z)|<style\\b.*?(?:</style|\\z)|<template\\b.*?(?:</template|\\z)|<noscript\\b.*?(?:</noscript|\\z)|<textarea\\b.*?(?:</textarea|\\z)"
_SCHEME = "^[A-Za-z][A-Za-z0-9+.-]*:"
_BASE = ("(?is)<base\\b[^>]*>", "(?i)\\bhref\\s*=", "(?i)\\bhref\\s*=\\s*[\"']?([^\"'\\s>]+)")
# Character references of the signs that divide a URL; the ampersand comes last.
_SIGNS = (("&sol;", "/"), ("&#47;", "/"), ("&#x2f;", "/"), ("&#x2F;", "/"), ("&colon;", ":"), ("&#58;", ":"), ("&#x3a;", ":"), ("&#x3A;", ":"), ("&quest;", "?"), ("&#63;", "?"), ("&num;", "#"), ("&#35;", "#"), ("&#38;", "&"), ("&amp;", "&"))


def _tags(html: Column, tag: str, mark: str, place: str) -> Column:
    """The URLs that all tags of a kind name outside comments, scripts and the like, character references decoded; null without any (a
    cheap test comes first)."""

    def decoded(t):
        for sign, plain in _SIGNS:
            t = F.replace(t, F.lit(sign), F.lit(plain))
        return t

    found = F.filter(F.regexp_extract_all(F.regexp_replace(html, _ASIDE, " "), F.lit(tag), F.lit(0)), lambda t: t.rlike(mark))
    return F.when(html.rlike(mark), F.filter(F.transform(found, lambda t: decoded(F.regexp_extract(t, place, 1))), lambda t: t != ""))


def resolved(t: Column, host: Column, path: Column) -> Column:
    """A named URL in full, relative ones resolved against a host and path; null for other schemes (`mailto:` and the like)."""
    full = F.when(t.rlike(_SCHEME + "//"), t).when(t.rlike(_SCHEME), F.lit(None)).when(F.startswith(t, F.lit("//")), F.concat(F.lit("http:"), t))
    full = full.when(F.startswith(t, F.lit("/")), F.concat(F.lit("http://"), host, t)).when(t.rlike("^[?#]"), F.concat(F.lit("http://"), host, path, t))
    return full.otherwise(F.concat(F.lit("http://"), host, F.coalesce(F.nullif(F.regexp_extract(path, "(?s)^.*/", 0), F.lit("")), F.lit("/")), t))


def without_dots(path: Column) -> Column:
    """A path without its `.` and `..` parts."""
    parts = F.split(F.regexp_replace(path, r"(/\.\.?)$", "$1/"), "/")
    step = lambda acc, x: F.when(x == ".", acc).when(x == "..", F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(1)))).otherwise(F.concat(acc, F.array(x)))
    return F.when(path.contains("/."), F.array_join(F.aggregate(F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0))), F.array(F.lit("")), step), "/")).otherwise(path)


def declared_targets(url: Column, html: Column) -> Column:
    """URLs that a page's canonical links and refresh redirects name (all of them), relative ones resolved against its
    first `base`, which is itself resolved against the page's URL. Empty without any."""
    base = F.coalesce(resolved(F.get(_tags(html, *_BASE), F.lit(0)), host_of(url), path_of(url)), url)
    named = F.concat(*[F.coalesce(_tags(html, *t), F.array().cast("array<string>")) for t in _TARGETS])
    return F.array_distinct(F.array_compact(F.transform(named, lambda t: resolved(t, host_of(base), path_of(base)))))


def judge_urls(pages: DataFrame, rules=RULES, forms: bool = False) -> DataFrame:
    """Verdict of every page: (page_id, host, path, rule, verdict, component).

    A page's own rule decides. Without one, its component of redirect and canonical-link edges does: blocked if some
    member is blocked by a rule and none is allowed by one (explicit allow takes precedence), else allowed. Edges run
    from each URL to the targets that the page declares (all its canonical links and refreshes, against its `base`); with
    `forms`, also to its canonical form, which joins URLs that differ in `www.`, `.html` or an end slash only. Nodes are 64-bit
    hashes of URLs without scheme, query and fragment, so copies of a URL are one node. Declared targets count as members even if no page has their URL. Null URLs
    or those without `://` have no edges and are allowed. Repeated rows are judged alike; no rows give none.
    Null html declares nothing; very long pages are searched whole; extra columns are not read.
    """
    p = pages.select("page_id", "url", "html").withColumn("host", host_of(F.col("url"))).withColumn("path", path_of(F.col("url")))
    # The part of a URL before its query, with its host, is a node of its own: rules see no more of it.
    p = p.withColumn("_u", F.when(F.col("host") != "", F.concat("host", "path"))).withColumn("_c", canonical_form(F.col("host"), F.col("path")))
    p = p.withColumn("_to", declared_targets(F.col("url"), F.col("html"))).drop("html", "url").withColumn("_m", matched_rule(F.col("host"), F.col("path"), rules))
    p = materialize(p.select("page_id", "host", "path", F.col("_m.rule").alias("rule"), F.col("_m.verdict").alias("said"), "_u", "_c", "_to"))
    targets = p.where(F.size("_to") > 0).select("_u", F.explode("_to").alias("t")).select("_u", host_of(F.col("t")).alias("host"), without_dots(path_of(F.col("t"))).alias("path"))
    targets = targets.withColumn("_v", F.concat("host", "path")).withColumn("_c", canonical_form(F.col("host"), F.col("path")))
    node = lambda c, kind: F.xxhash64(F.lit(kind), c)
    edges = targets.where("_u is not null").select(node(F.col("_u"), "u").alias("a"), node(F.col("_v"), "u").alias("b"))
    if forms:
        own = p.where("_u is not null").select(node(F.col("_u"), "u"), node(F.col("_c"), "c"))
        edges = edges.union(own).union(targets.select(node(F.col("_v"), "u"), node(F.col("_c"), "c")))
    components = materialize(connected_components(edges.distinct()))
    members = p.where("_u is not null and said is not null").select(node(F.col("_u"), "u").alias("node"), "said")
    members = members.union(targets.select(node(F.col("_v"), "u"), matched_rule(F.col("host"), F.col("path"), rules)["verdict"].alias("said")).where("said is not null"))
    said = members.distinct().join(components, "node").groupBy("component").agg(F.bool_or(F.col("said") == "block").alias("blocked"), F.bool_or(F.col("said") == "allow").alias("allowed"))
    by_node = components.join(said, "component", "left").select(F.col("node").alias("_n"), "component", (F.coalesce("blocked", F.lit(False)) & ~F.coalesce("allowed", F.lit(False))).alias("_bad"))
    out = p.withColumn("_n", node(F.col("_u"), "u")).join(by_node, "_n", "left")
    verdict = F.coalesce("said", F.when(F.col("_bad") & F.col("_u").isNotNull(), "block").otherwise("allow"))
    return out.select("page_id", "host", "path", "rule", verdict.alias("verdict"), "component")


def _sql() -> str:
    """The verdicts in SQL, for tables of a size that a recursive query can walk."""
    fit = lambda h, p: f"((host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}'))"
    longest = sorted(RULES, key=lambda r: (-len(r[1]) - len(r[2]), r[0] != "allow"))
    case = lambda what: "CASE " + " ".join(f"WHEN {fit(h, p)} THEN '{h + p if what == 'rule' else v}'" for v, h, p in longest) + " END"
    q = lambda t: t.replace("'", "''")
    parts = lambda url: f"coalesce(translate(regexp_extract({url}, '(?s)^.*?://([^/?#]*)', 1), '{_UPPER}', '{_LOWER}'), '') AS host, coalesce(regexp_extract({url}, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path"
    clean = "t"
    for sign, plain in _SIGNS:
        clean = f"replace({clean}, '{sign}', '{plain}')"
    found = lambda tag, mark, place: f"list_transform(list_filter(regexp_extract_all(html, '{q(tag)}'), lambda t: regexp_matches(t, '{q(mark)}')), lambda t: regexp_extract(t, '{q(place)}', 1))"
    tags = " UNION ALL ".join(f"SELECT host || path AS u, host, path, b, unnest({found(*t)}) AS t FROM (SELECT *, nullif({found(*_BASE)}[1], '') AS b FROM p)" for t in _TARGETS)
    full = lambda t: f"CASE WHEN regexp_matches({t}, '{_SCHEME}//') THEN {t} WHEN regexp_matches({t}, '{_SCHEME}') THEN NULL WHEN starts_with({t}, '//') THEN 'http:' || {t} WHEN starts_with({t}, '/') THEN 'http://' || host || {t} WHEN regexp_matches({t}, '^[?#]') THEN 'http://' || host || path || {t} ELSE 'http://' || host || coalesce(nullif(regexp_extract(path, '(?s)^.*/'), ''), '/') || {t} END"
    dots = "CASE WHEN contains(path, '/.') THEN array_to_string(list_reduce(list_transform(list_concat([''], string_split(regexp_replace(path, '(/\\.\\.?)$', '\\1/'), '/')[2:]), lambda x: [x]), lambda a, x: CASE x[1] WHEN '.' THEN a WHEN '..' THEN a[1:greatest(len(a) - 1, 1)] ELSE list_concat(a, x) END), '/') ELSE path END"
    return f"""WITH RECURSIVE p AS (SELECT page_id, url, regexp_replace(html, '{q(_ASIDE)}', ' ', 'g') AS html, {parts('url')} FROM pages),
 tag0 AS ({tags}),
 tag1 AS (SELECT u, host, path, {clean} AS t, {clean.replace("(t,", "(b,")} AS b FROM tag0 WHERE t <> ''),
 tag2 AS (SELECT u, t, coalesce({full('b')}, 'http://' || host || path) AS base FROM tag1),
 tag AS (SELECT u, t, {parts('base')} FROM tag2),
 full_ AS (SELECT u, {full('t')} AS t FROM tag),
 v0 AS (SELECT u, {parts('t')} FROM full_ WHERE t IS NOT NULL),
 v AS (SELECT u, host, {dots} AS path FROM v0),
 e0 AS (SELECT DISTINCT 'u' || u AS a, 'u' || host || path AS b FROM v WHERE u <> ''),
 e AS (SELECT a, b FROM e0 UNION SELECT b, a FROM e0),
 walk(a, b) AS (SELECT DISTINCT a, a FROM e UNION SELECT walk.a, e.b FROM walk JOIN e ON walk.b = e.a),
 said AS (SELECT 'u' || host || path AS n, {case('verdict')} AS s FROM (SELECT host, path FROM p UNION SELECT host, path FROM v)),
 c AS (SELECT a AS n, coalesce(bool_or(s = 'block'), false) AND NOT coalesce(bool_or(s = 'allow'), false) AS bad FROM walk LEFT JOIN said ON said.n = walk.b GROUP BY 1)
 SELECT page_id, host, path, {case('rule')} AS rule, coalesce({case('verdict')}, CASE WHEN c.bad THEN 'block' ELSE 'allow' END) AS verdict FROM p LEFT JOIN c ON c.n = 'u' || host || path"""


VERDICTS_SQL = _sql()
