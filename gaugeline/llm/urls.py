"""URL filtering with redirect equivalence.

A page that has no rule of its own takes the decision of its aliases: the pages and
targets that it is connected with by redirects and canonical links. Components are
found by a distributed connected-components pass over hashed URLs.
"""

from __future__ import annotations

import string
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize, named
from .graph import components

MAX_RULES = 1000
ADDRESS = r"(?s)^.*?://([^/?#]*)([^?#]*)"
#: A tag reaches to the next angle bracket, so that a page of unclosed tags is read once.
TAG = r"(?i)<(?:link|meta)\b[^<>]*+"
#: By kind: what a tag begins with, the attribute that it must have, and its target.
TAGS = {
    "canonical": (r"(?i)^<link\b", r"(?i)\brel\s*+=\s*+[\"']?canonical\b", r"(?i)\bhref\s*+=\s*+[\"']?([^\"'\s>]++)"),
    "refresh": (r"(?i)^<meta\b", r"(?i)\bhttp-equiv\s*+=\s*+[\"']?refresh\b", r"(?i)\burl\s*+=\s*+[\"']?([^\"'\s>]++)"),
}


def host_of(url: Column) -> Column:
    """From the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case; empty for null or no ``://``."""
    return F.coalesce(F.translate(F.regexp_extract(url, ADDRESS, 1), string.ascii_uppercase, string.ascii_lowercase), F.lit(""))


def path_of(url: Column) -> Column:
    """From the host's end up to ``?``, ``#`` or the end; empty for null or no ``://``."""
    return F.coalesce(F.regexp_extract(url, ADDRESS, 2), F.lit(""))


def alias_key(url: Column) -> Column:
    """Hash of the address without scheme, fragment and closing slashes; null where there is no host."""
    query = F.regexp_extract(url, r"^[^?#]*(\?[^#]*)", 1)
    return F.when(host_of(url) != "", F.md5(F.concat(host_of(url), F.rtrim(path_of(url), F.lit("/")), query).cast("binary")))


def fold_dots(url: Column) -> Column:
    """The address with the segments ``.`` and ``..`` of its path removed as in RFC 3986, 5.2.4."""
    head, path, tail = (F.regexp_extract(url, r"(?s)^(.*?://[^/?#]*)([^?#]*)(.*)$", i) for i in (1, 2, 3))
    kept = F.filter(F.split(path, "/"), lambda s: s != ".")

    def step(done: Column, s: Column) -> Column:
        return F.when(s != "..", F.concat(done, F.array(s))).when(F.size(done) > 1, F.slice(done, F.lit(1), F.size(done) - 1)).otherwise(done)

    folded = F.array_join(F.aggregate(kept, F.array().cast("array<string>"), step), "/")
    closing = F.when(path.rlike(r"/\.\.?$"), "/").otherwise("")
    return F.when(path.rlike(r"/\.\.?(/|$)"), F.concat(head, folded, closing, tail)).otherwise(url)


def resolve(link: Column, url: Column) -> Column:
    """The absolute address of a link on the page ``url``, without dot segments; null if the link is empty or null."""
    scheme, base = F.regexp_extract(url, r"^([^:/?#]*):", 1), F.regexp_extract(url, r"(?s)^(.*?://[^/?#]*)", 1)
    folder = F.regexp_extract(url, r"(?s)^(.*?://[^/?#]*(?:[^?#]*/)?)", 1)
    joined = (
        F.when(link.contains("://"), link)
        .when(link.startswith("//"), F.concat(scheme, F.lit(":"), link))
        .when(link.startswith("/"), F.concat(base, link))
        .otherwise(F.concat(F.regexp_replace(folder, r"(://[^/]*)$", "$1/"), link))
    )
    address = F.array(F.when(F.length(link) > 0, F.replace(joined, F.lit("&amp;"), F.lit("&"))))
    return F.transform(address, fold_dots)[0]


def match_rule(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> tuple[Column, Column]:
    """The longest fitting rule as text and its verdict; both null if none fits. ``rules``: (verdict, host, path)."""
    if len(rules) > MAX_RULES:
        raise ValueError(f"more than {MAX_RULES} rules")
    name = verdict = F.lit(None).cast("string")
    for kind, rule_host, rule_path in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        name, verdict = F.when(fits, rule_host + rule_path).otherwise(name), F.when(fits, kind).otherwise(verdict)
    return name, verdict


def judge_urls(pages: DataFrame, rules: Sequence[tuple[str, str, str]], key: str = "page_id", url: str = "url", html: str = "html", default: str = "allow") -> DataFrame:
    """Verdict for every page: its own rule's, else its aliases', else ``default``.

    Result: ``key`` (under its own name), ``host``, ``path``, ``rule``, ``verdict``, ``alias_of``
    (component, null without links to other addresses). Aliases are the addresses connected by canonical
    links and refresh redirects found in ``html``, and those of one ``alias_key``; targets need not be pages themselves. A page with a rule
    always follows it. Without one, an allow rule anywhere in the component wins over block
    rules; a block rule there blocks. Every tag of a page counts, its first target if it has more; pages of any length are read in linear time. Null or malformed addresses have empty host and path, no
    rule and no aliases. Repeated rows, null keys and null html are ordinary; an empty table
    gives an empty result. Other columns are not carried.
    """
    u, body = named(url), named(html)

    def found(kind: str) -> Column:
        begins, has, target = TAGS[kind]
        own = F.filter("tags", lambda t: t.rlike(begins) & t.rlike(has))
        return F.transform(own, lambda t: resolve(F.regexp_extract(t, target, 1), F.col("u")))

    def vertex(address: Column) -> Column:
        return F.struct(alias_key(address).alias("v"), match_rule(host_of(address), path_of(address), rules)[1].alias("own"))

    tags = F.regexp_extract_all(F.coalesce(body, F.lit("")), F.lit(TAG), F.lit(0))
    base = pages.select(named(key).alias("key"), u.alias("u"), tags.alias("tags"))
    base = base.select("key", "u", F.array_distinct(F.array_compact(F.concat(found("canonical"), found("refresh")))).alias("links"))
    rule, own = match_rule(F.col("host"), F.col("path"), rules)
    base = base.withColumns({"host": host_of(F.col("u")), "path": path_of(F.col("u")), "v": alias_key(fold_dots(F.col("u")))}).withColumns({"rule": rule, "own": own, "links": F.transform("links", vertex)})
    base = materialize(base.drop("u"), "pages")

    links = base.filter(F.size("links") > 0).select("v", F.explode("links").alias("to"))
    parts = components(links.select(F.col("v").alias("a"), F.col("to.v").alias("b")))
    decided = base.select("v", "own").union(links.select("to.v", "to.own")).filter(F.col("own").isNotNull() & F.col("v").isNotNull()).distinct()
    # an address without links to others, such as one whose canonical differs by a closing slash, is its own component
    votes = decided.join(parts, "v", "left").groupBy(F.coalesce("c", "v").alias("c")).agg(F.max(F.col("own") == "allow").alias("allowed"))
    votes = materialize(votes.select("c", F.when(F.col("allowed"), "allow").otherwise("block").alias("voted")), "votes")
    lone = votes.withColumnRenamed("c", "v").join(parts, "v", "left_anti").select("v", F.lit(None).cast("string").alias("c"), "voted")
    alias = materialize(parts.join(votes, "c", "left").select("v", "c", "voted").union(lone), "aliases")
    out = base.select("key", "host", "path", "rule", "own", "v").join(alias, "v", "left")
    return out.select(F.col("key").alias(key), "host", "path", "rule", F.coalesce("own", "voted", F.lit(default)).alias("verdict"), F.col("c").alias("alias_of"))
