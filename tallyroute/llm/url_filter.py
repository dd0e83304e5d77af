"""Verdicts for pages by URL rules, carried over redirects and canonical links.

A rule fits its host and all subdomains if the URL's path starts with the rule's path; the
longest fitting rule decides.  A URL without a rule takes the verdict of its aliases: pages name
aliases by ``<link rel=canonical>`` and by ``<meta http-equiv=refresh>``; these edges, and those
of a redirect table if one is given, form a graph whose connected components hold equivalent
URLs. In a component an explicit allow goes before an explicit block, and a block before nothing.
A URL whose own rule decides keeps that verdict.  Without any rule in reach a page is allowed.

Everything is DataFrame functions; components are found by joins and minima in rounds stored in
the shared folder.  The rules are a parameter of the plan, so only short lists belong there.

Defined results: a URL that is NULL or has no ``://`` has empty host and path, no rule and no
aliases of its own.  Rows may repeat, each gets its verdict; several pages may share a URL.
"""

from __future__ import annotations

from collections.abc import Callable

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyroute.llm.components import components
from tallyroute.llm.store import stored

#: verdict, host and path of each rule
Rules = Sequence[tuple[str, str, str]]


def _lower(text: Column) -> Column:
    """A-Z in lower case, other characters as they are."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _after_scheme(url: Column) -> Column:
    return F.when(F.instr(url, "://") > 0,
                  F.substring(url, F.instr(url, "://") + 3, F.length(url)))


def host_of(url: Column) -> Column:
    return F.coalesce(_lower(F.regexp_extract(_after_scheme(url), r"(?s)^([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    found = F.regexp_extract(_after_scheme(url), r"(?s)^[^/?#]*([^?#]*)", 1)
    return F.coalesce(found, F.lit(""))


def fitting(host: Column, path: Column, rules: Rules, value: int | None = None) -> Column:
    """The longest fitting rule as host and path, or its verdict if ``value`` is 0; else NULL."""
    picked = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: len(r[1]) + len(r[2])):
        verdict, on, under = rule
        fits = ((host == on) | F.endswith(host, F.lit("." + on))) & F.startswith(path, F.lit(under))
        picked = F.when(fits, F.lit(verdict if value == 0 else on + under)).otherwise(picked)
    return picked


def _reduced(path: Column) -> Column:
    """A path without the segments ``.`` and ``..``."""
    def step(kept: Column, part: Column) -> Column:
        up = F.slice(kept, F.lit(1), F.greatest(F.size(kept) - 1, F.lit(1)))
        return F.when(part == ".", kept).when(part == "..", up).otherwise(
            F.concat(kept, F.array(part)))

    none = F.array().cast("array<string>")
    parts = F.aggregate(F.split(path, "/", -1), none, step)
    last = F.when(path.rlike(r"/\.\.?$"), F.array(F.lit(""))).otherwise(none)
    return F.when(path.rlike(r"/\.\.?(/|$)"),
                  F.array_join(F.concat(parts, last), "/")).otherwise(path)


def _bound(value: Column, function: Callable[[Column], Column]) -> Column:
    """``function`` of a value that is worked out once, however often the function names it."""
    return F.get(F.transform(F.array(value), function), 0)


def node_of(url: Column) -> Column:
    """A URL as a node: scheme and host in lower case, without dot segments and the fragment."""
    scheme = _lower(F.substring_index(url, "://", 1))
    path = path_of(url)
    rest = F.regexp_replace(
        F.substring(_after_scheme(url), F.length(host_of(url)) + F.length(path) + 1, F.length(url)),
        r"(?s)#.*$", "")
    return F.when(F.instr(url, "://") > 0,
                  F.concat(scheme, F.lit("://"), host_of(url), _reduced(path), rest))


def resolve(target: Column, base: Column) -> Column:
    """Absolute form of a link found on page ``base``."""
    def from_page(clean: Column) -> Column:
        scheme = F.substring_index(base, "://", 1)
        root = F.concat(scheme, F.lit("://"), host_of(base))
        folder = F.regexp_replace(path_of(base), r"(?s)[^/]*$", "")
        folder = F.concat(root, F.when(folder == "", "/").otherwise(folder))
        return (
            F.when(clean == "", None)
            .when(clean.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"), clean)
            .when(F.startswith(clean, F.lit("//")), F.concat(scheme, F.lit(":"), clean))
            .when(F.startswith(clean, F.lit("/")), F.concat(root, clean))
            .when(clean.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), None)
            .otherwise(F.concat(folder, clean)))

    return _bound(F.trim(F.regexp_replace(target, "&amp;", "&")), from_page)


def _tag(name: str, attribute: str, word: str) -> str:
    """Pattern of a tag whose attribute has ``word`` among the words of its value."""
    quoted = [rf"{q}(?:[^{q}]*\s)?{word}(?:\s[^{q}]*)?{q}" for q in ("\"", "'")]
    value = "|".join([*quoted, rf"{word}(?=[\s/>])"])
    return rf"(?is)<{name}(?=\s)(?=[^>]*\s{attribute}\s*=\s*(?:{value}))[^>]*>"


#: tags that name an alias, the base of a page's links, and what such tags point to
CANONICAL = _tag("link", "rel", "canonical")
REFRESH = _tag("meta", "http-equiv", "refresh")
BASE = r"(?is)<base(?=\s)[^>]*>"
HREF = r"""(?is)\shref\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""
GOES_TO = r"""(?is)\scontent\s*=\s*["']?[^"'>]*?\burl\s*=\s*["']?([^"'>\s]+)"""


def page_links(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """``a`` and ``b``: the page's URL and each alias its text names, relative ones read from the
    page's base."""
    text = F.col(f"`{html}`")
    tags = pages.select(
        F.col(f"`{url}`").alias("url"), F.regexp_extract(text, BASE, 0).alias("base"),
        F.regexp_extract_all(text, F.lit(CANONICAL), F.lit(0)).alias("canonical"),
        F.regexp_extract_all(text, F.lit(REFRESH), F.lit(0)).alias("refresh"))

    def href(tag: Column) -> Column:
        return F.concat(*[F.regexp_extract(tag, HREF, group) for group in (1, 2, 3)])

    named = tags.where("size(canonical) > 0 OR size(refresh) > 0").select(
        "url", F.coalesce(resolve(href(F.col("base")), F.col("url")), F.col("url")).alias("base"),
        F.explode(F.array_distinct(F.concat(
            F.transform("canonical", href),
            F.transform("refresh", lambda tag: F.regexp_extract(tag, GOES_TO, 1)))))
        .alias("target"))
    return named.select(node_of(F.col("url")).alias("a"),
                        _bound(resolve(F.col("target"), F.col("base")), node_of).alias("b")).where("a <> b")


def judge(pages: DataFrame, rules: Rules, redirects: DataFrame | None = None,
          url: str = "url", html: str = "html", key: str = "page_id") -> DataFrame:
    """``page_id``, ``host``, ``path``, ``rule`` and ``verdict`` of every row.  ``redirects`` has
    the columns ``source`` and ``target``, absolute URLs."""
    links = page_links(pages, url, html)
    if redirects is not None:
        links = links.union(redirects.select(node_of(F.col("source")), node_of(F.col("target"))))
    grouped = components(links)
    own = fitting(host_of(F.col("node")), path_of(F.col("node")), rules, 0)
    decided = (
        grouped.withColumn("own", own).groupBy("component").agg(F.min("own").alias("shared"))
        .where("shared IS NOT NULL"))  # allow sorts before block
    aliases = stored(grouped.join(decided, "component").select("node", "shared"), "aliases")
    judged = pages.select(F.col(f"`{key}`").alias("page_id"), F.col(f"`{url}`").alias("url"))
    judged = judged.select(
        "page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"),
        node_of(F.col("url")).alias("node"))
    judged = judged.withColumns({
        "rule": fitting(F.col("host"), F.col("path"), rules),
        "own": fitting(F.col("host"), F.col("path"), rules, 0)})
    return judged.join(aliases, "node", "left").select(
        "page_id", "host", "path", "rule",
        F.coalesce("own", "shared", F.lit("allow")).alias("verdict"),
        (F.col("own").isNull() & F.col("shared").isNotNull()).alias("by_alias"))
