"""URL filters whose block decisions follow redirects and canonical links.

A page names other addresses of itself: the target of its ``<link rel="canonical">`` and that of a
``<meta http-equiv="refresh">``. These are edges between addresses; a connected component of them
is one resource under several names. A page's own rule decides it. A page without one is allowed
where a rule allows any name of its resource, else blocked where a rule blocks one, else allowed.

An address is the host, path and query of a url; scheme and fragment do not tell addresses apart.
Null and unreadable urls have no address, no rule and no aliases, and are allowed. Html that is
null or names nothing gives no edge; urls and html are read whole, however long. Null keys and repeated
rows are judged like others, each for itself. Of rules of equal length that fit, allow goes first. An
empty table gives an empty one. Only the named columns are read, so others cannot clash. Everything
runs as DataFrame expressions and joins.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.durable import settle
from tidemark.llm.common import only
from tidemark.llm.components import components

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

CANONICAL_TAG = r"""(?is)<link\b[^>]*\brel\s*=\s*["']?canonical\b[^>]*>"""
REFRESH_TAG = r"""(?is)<meta\b[^>]*\bhttp-equiv\s*=\s*["']?refresh\b[^>]*>"""
HREF = r"""(?is)\bhref\s*=\s*["']?([^"'\s>]+)"""
REFRESH_URL = r"""(?is)\burl\s*=\s*["']?([^"'\s>]+)"""


@dataclass(frozen=True)
class Rule:
    verdict: str  # allow or block
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


def host_of(url: Column) -> Column:
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    return F.coalesce(F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), _UPPER, _LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    return F.coalesce(F.regexp_extract(rest, r"^[^/?#]*(/[^?#]*)?", 1), F.lit(""))


def _query_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"^[^?#]*(\?[^#]*)?", 1), F.lit(""))


def address_of(url: Column) -> Column:
    """Host, path and query; null where there is no host."""
    path = path_of(url)
    whole = F.concat(host_of(url), F.when(path == "", "/").otherwise(path), _query_of(url))
    return F.when(host_of(url) != "", whole)


def rule_of(host: Column, path: Column, rules: Sequence[Rule]) -> tuple[Column, Column]:
    """The longest rule that fits, as its text and its verdict. Of equally long ones, allow goes first."""
    text: Column = F.lit(None).cast("string")
    verdict: Column = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.text), r.verdict == "allow", r.text)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        text = F.when(fits, rule.text).otherwise(text)
        verdict = F.when(fits, rule.verdict).otherwise(verdict)
    return text, verdict


def _absolute(url: Column, target: Column) -> Column:
    scheme = F.concat(F.regexp_extract(url, r"^([^:/?#]*)://", 1), F.lit(":"))
    site = F.regexp_extract(url, r"^[^:/?#]*://[^/?#]*", 0)
    folder = F.regexp_extract(url, r"^[^:/?#]*://[^/?#]*(/(?:[^?#]*/)?)", 1)
    return (
        F.when(F.locate("://", target) > 0, target)
        .when(target.startswith("//"), F.concat(scheme, target))
        .when(target.startswith("/"), F.concat(site, target))
        .otherwise(F.concat(site, F.when(folder == "", "/").otherwise(folder), target))
    )


def edges_of(pages: DataFrame) -> DataFrame:
    """(a, b): addresses that one page names, from its url to each target. Takes columns url, html."""
    canonical = F.transform(
        F.regexp_extract_all("html", F.lit(CANONICAL_TAG), F.lit(0)), lambda tag: F.regexp_extract(tag, HREF, 1)
    )
    refresh = F.transform(
        F.regexp_extract_all("html", F.lit(REFRESH_TAG), F.lit(0)), lambda tag: F.regexp_extract(tag, REFRESH_URL, 1)
    )
    # Most pages name nothing: a plain search for the words comes before the patterns.
    names = F.col("html").rlike("(?i)canonical|http-equiv")
    found = pages.where(names).select("url", F.explode(F.concat(canonical, refresh)).alias("target"))
    target = F.replace(F.trim("target"), F.lit("&amp;"), F.lit("&"))
    edges = found.where("target <> ''").select(
        address_of(F.col("url")).alias("a"), address_of(_absolute(F.col("url"), target)).alias("b")
    )
    return edges.where("a is not null AND b is not null AND a <> b")


def judge(pages: DataFrame, rules: Sequence[Rule], key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """(key, host, path, rule, verdict, component) of every page; component is null without aliases."""
    pages = only(pages, page=key, url=url, html=html)
    member = settle(components(edges_of(pages)), "aliases")
    address = F.concat(F.lit("x://"), F.col("node"))
    _, decided = rule_of(host_of(address), path_of(address), rules)
    groups = member.withColumn("decided", decided).groupBy("component").agg(
        F.max(F.when(F.col("decided") == "allow", True).otherwise(False)).alias("allowed"),
        F.max(F.when(F.col("decided") == "block", True).otherwise(False)).alias("blocked"),
    )
    aliases = settle(member.join(groups, "component"), "aliases")

    host, path = host_of(F.col("url")), path_of(F.col("url"))
    parsed = pages.select("page", host.alias("host"), path.alias("path"), address_of(F.col("url")).alias("address"))
    text, verdict = rule_of(F.col("host"), F.col("path"), rules)
    parsed = parsed.withColumns({"rule": text, "own": verdict})
    joined = parsed.join(aliases, parsed.address == aliases.node, "left")
    inherited = F.when(F.col("allowed"), "allow").when(F.col("blocked"), "block").otherwise("allow")
    return joined.select(
        F.col("page").alias(key), "host", "path", "rule", F.coalesce("own", inherited).alias("verdict"), "component"
    )
