"""URL rules with aliases: decisions travel along redirects and canonical links.

A rule names a host (with all its subdomains) and the start of a path; the longest rule that
fits decides a URL. URLs that redirect to one another, or name one canonical URL, are
connected components of a graph. A URL without a rule of its own takes the decision of its
component: allowed if any alias is allowed by a rule, else blocked if any is blocked, else
allowed.
"""

from __future__ import annotations

from dataclasses import dataclass
from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spendfall.llm.components import components

#: Prefixes of hosts, endings of paths and parameters that do not change what a URL shows.
HOST_PREFIX = r"^(www|m)\."
PATH_ENDING = r"(\.html|/)$"
TRACKING = r"^(utm_[a-z]+|ref)="


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    verdict: str

    @property
    def text(self) -> str:
        return f"{self.host}{self.path}"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z in lower case) and path; both empty without ``://``."""
    rest = F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3, F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    return F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), ascii_uppercase, ascii_lowercase), F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def normal_form(url: Column) -> Column:
    """The URL that scheme, www and m, endings, tracking parameters and fragments leave; null without ``://``."""
    host, path = host_and_path(url)
    query = F.regexp_extract(url, r"^[^?#]*\?([^#]*)", 1)
    query = F.array_join(F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.rlike(TRACKING)), "&")
    plain = F.concat(F.lit("https://"), F.regexp_replace(host, HOST_PREFIX, ""), F.regexp_replace(path, PATH_ENDING, ""))
    return F.when(F.instr(url, "://") > 0, F.concat(plain, F.when(query != "", F.concat(F.lit("?"), query)).otherwise("")))


def page_edges(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """(u, v): from every URL to its normal form, to its canonical link and to where it redirects by refresh."""
    link = F.regexp_extract(html, r"""(?is)<link\b(?=[^>]*\brel=["']?canonical\b)[^>]*\bhref=["']?([^"'\s>]+)""", 1)
    refresh = F.regexp_extract(html, r"""(?is)<meta\b(?=[^>]*\bhttp-equiv=["']?refresh\b)[^>]*\burl=["']?([^"'\s>]+)""", 1)
    targets = F.array(normal_form(F.col(url)), link, refresh)
    return pages.select(F.col(url).alias("u"), F.explode(targets).alias("v")).where("u is not null and v <> '' and instr(v, '://') > 0")


def matching_rule(host: Column, path: Column, rules: list[Rule]) -> tuple[Column, Column]:
    """Text and verdict of the longest rule that fits; null where none does. Of equal ones an allow rule wins."""
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.text), r.verdict == "allow")):
        fits = ((host == rule.host) | host.endswith(f".{rule.host}")) & path.startswith(rule.path)
        text = F.when(fits, F.lit(rule.text)).otherwise(text)
        verdict = F.when(fits, F.lit(rule.verdict)).otherwise(verdict)
    return text, verdict


def judge_urls(pages: DataFrame, edges: DataFrame, rules: list[Rule], url: str = "url") -> DataFrame:
    """All rows of ``pages`` with host, path, rule, verdict and alias (the component's name).

    ``edges`` (u, v) are pairs of equivalent URLs, in any direction, of which either may be
    missing from ``pages``. ``rules`` is a short list. A null URL, or one without ``://``,
    has an empty host and path; a null one has no aliases. Repeated rows are judged alike.
    Columns of ``pages`` named like the new ones are replaced.
    """
    new = ["host", "path", "rule", "verdict", "alias"]
    pages = pages.drop(*new)
    named = components(edges)
    # an alias may be known by links only; its own rule counts too
    urls = edges.select("u").union(edges.select("v")).distinct().withColumnRenamed("u", "node")
    urls = urls.join(named, "node", "left").select("node", F.coalesce("component", "node").alias("alias"))
    decision = matching_rule(*host_and_path(F.col("node")), rules)[1]
    groups = urls.groupBy("alias").agg(F.max(F.coalesce(decision == "allow", F.lit(False))).alias("allowed"), F.max(F.coalesce(decision == "block", F.lit(False))).alias("blocked"))
    # only what a component changes has to be known
    blocked = groups.where("blocked and not allowed").select("alias", F.lit("block").alias("by_alias"))
    known = urls.join(blocked, "alias", "left")
    host, path = host_and_path(F.col(url))
    # the page's own columns stay apart from those that are worked with
    rows = pages.select(F.struct(*(pages[name] for name in pages.columns)).alias("page"), F.col(url).alias("node"), host.alias("host"), path.alias("path"))
    rule, verdict = matching_rule(F.col("host"), F.col("path"), rules)
    judged = rows.select("*", rule.alias("rule"), verdict.alias("own")).join(known, "node", "left")
    return judged.select("page.*", "host", "path", "rule", F.coalesce("own", "by_alias", F.lit("allow")).alias("verdict"), F.coalesce("alias", "node").alias("alias"))
