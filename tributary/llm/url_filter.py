"""URL filter with redirect equivalence.

Rules name a host and a path prefix.  A page that a rule fits is decided by
the longest such rule.  Any other page takes the decision of its aliases:
redirects and canonical links are edges between URLs, their connected
components are classes of one resource, and a class that holds a blocked URL
(a page's or a link target's) blocks its members that no rule fits.  An
explicit allow of a page stands whatever its class says; a page that neither
rule nor class decides is allowed.

URLs are nodes without their ``#fragment``, scheme and host in lower case.
Edges come from ``<link rel=canonical>`` and ``<meta http-equiv=refresh>``.
Character references in a target are decoded; a relative target is resolved
against the page's URL, or its first ``<base href>`` if it has one.

Cases: a null URL or one without ``://`` has empty host and path, no rule and
no class; null html has no links; repeated rows are judged one by one; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from html import unescape
from html.entities import html5
from urllib.parse import urljoin

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from tributary.llm.common import stage
from tributary.llm.components import connected_components


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    allow: bool

    @property
    def text(self) -> str:
        return self.host + self.path


UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: list[Rule]) -> Column:
    """The longest rule that fits, as a struct (rule, allow), or null; of two
    of the same length the one with the longer host, then a block."""
    out = F.lit(None).cast("struct<rule:string,allow:boolean>")
    for r in sorted(rules, key=lambda r: (len(r.text), len(r.host), not r.allow)):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        out = F.when(fits, F.struct(F.lit(r.text).alias("rule"), F.lit(r.allow).alias("allow"))).otherwise(out)
    return out


def _attribute(tag: Column, name: str) -> Column:
    value = F.regexp_extract(tag, rf"""(?is)\s{name}\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", 0)
    return F.trim(F.regexp_replace(value, rf"""(?is)^\s{name}\s*=\s*["']?|["']$""", ""))


_REFERENCE = re.compile(r"&(?:#[xX][0-9a-fA-F]+;?|#[0-9]+;?|[A-Za-z][A-Za-z0-9]*;|[A-Za-z][A-Za-z0-9]*(?![A-Za-z0-9=;]))")
_ABSOLUTE = re.compile(r"[A-Za-z][A-Za-z0-9+.\-]*:")


def decoded(value: str) -> str:
    """An attribute's value without character references; as HTML has it, a
    name without ``;`` before ``=`` or a letter is text (``?a=1&copy=2``)."""
    return _REFERENCE.sub(lambda m: unescape(m[0]) if m[0][1] == "#" else html5.get(m[0][1:], m[0]), value)


def resolved(base: str, target: str) -> str:
    """``target`` seen from ``base``, whatever the scheme; a target that is no
    URL stays as it is."""
    target = re.sub(r"[\t\r\n]", "", target.strip("".join(map(chr, range(33)))))
    scheme, mark, rest = base.partition("://")
    if not mark or _ABSOLUTE.match(target):
        return target
    try:
        return scheme + urljoin("http://" + rest, target).removeprefix("http")
    except ValueError:
        return target


@F.arrow_udf(StringType())
def _decoded(values: pa.Array) -> pa.Array:
    return pa.array([v and decoded(v) for v in values.to_pylist()], pa.string())


@F.arrow_udf(StringType())
def _resolved(urls: pa.Array, bases: pa.Array, targets: pa.Array) -> pa.Array:
    rows = zip(urls.to_pylist(), bases.to_pylist(), targets.to_pylist(), strict=True)
    return pa.array([t and resolved(resolved(u, b) if b else u, t) for u, b, t in rows], pa.string())


def link_edges(pages: DataFrame) -> DataFrame:
    """(a, b): a page's URL and the URL it redirects to or names as canonical."""
    tags = F.regexp_extract_all("html", F.lit(r"(?is)<(?:link|meta)\s[^>]*\b(?:canonical|refresh)\b[^>]*>"), F.lit(0))
    base = F.regexp_extract("html", r"(?is)<base\s(?:[^>]*\s)?href\s*=[^>]*>", 0)
    tag = pages.where("url is not null and html is not null").select("url", base.alias("base"), F.explode(tags).alias("tag"))
    found = tag.select("url", _attribute(F.col("base"), "href").alias("base"), _attribute(F.col("tag"), "rel").alias("rel"),
                       F.lower(_attribute(F.col("tag"), "http-equiv")).alias("equiv"),
                       _attribute(F.col("tag"), "href").alias("href"), _attribute(F.col("tag"), "content").alias("content"))
    found = found.select("url", "rel", "equiv", *(_decoded(F.col(c)).alias(c) for c in ("base", "href", "content")))
    content = F.regexp_extract("content", r"""(?is)^[^;,]*[;,]\s*url\s*=\s*["']?(.*?)["']?\s*$""", 1)
    target = F.when(F.col("rel").rlike(r"(?i)(^|\s)canonical(\s|$)"), F.col("href")).when(F.col("equiv") == "refresh", content)
    whole = found.select("url", _resolved(F.col("url"), F.col("base"), target).alias("target"))
    return whole.select(node_of(F.col("url")).alias("a"), node_of(F.col("target")).alias("b")).where("a like '%://%' and b like '%://%'")


def node_of(url: Column) -> Column:
    plain = F.regexp_replace(url, r"(?s)#.*$", "")
    part = lambda k: F.regexp_extract(plain, r"(?s)^([^/?]*://)([^/?]*@)?([^/?]*)(.*)$", k)
    return F.when(part(1) == "", plain).otherwise(F.concat(F.translate(part(1), UPPER, LOWER), part(2), F.translate(part(3), UPPER, LOWER), part(4)))


def judge(pages: DataFrame, rules: list[Rule]) -> DataFrame:
    """page_id, host, path, rule, verdict and alias_block (the page's class
    holds a blocked URL) of every page."""
    edges = stage(link_edges(pages))
    classes = stage(connected_components(edges))
    host, path = host_of(F.col("node")), path_of(F.col("node"))
    blocked = classes.where(~rule_of(host, path, rules)["allow"]).select("component").distinct()
    aliases = classes.join(blocked, "component", "left_semi").select(F.col("node").alias("_node"))

    url = F.col("url")
    judged = pages.select("page_id", "url").withColumn("host", host_of(url)).withColumn("path", path_of(url)) \
        .withColumn("fit", rule_of(F.col("host"), F.col("path"), rules))
    joined = judged.join(aliases, node_of(url) == F.col("_node"), "left")
    verdict = F.when(F.coalesce(F.col("fit.allow"), F.col("_node").isNull()), "allow").otherwise("block")
    return joined.select("page_id", "host", "path", F.col("fit.rule").alias("rule"), verdict.alias("verdict"),
                         F.col("_node").isNotNull().alias("alias_block"))
