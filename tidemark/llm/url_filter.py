"""URL filtering: rules by host and path, and block decisions that spread over redirect and canonical-link edges.

A url that a rule fits has that rule's verdict. Any other is judged with its aliases, the urls that redirects or canonical
links connect with it in either direction: if a rule allows one of them it is allowed, otherwise if a rule blocks one of
them it is blocked, otherwise it is allowed. Two urls are one if they differ only in scheme, fragment or the case of A-Z
in the host.

Links are all canonical links and refresh redirects of a page outside comments, whatever else their rel names. A target
that is relative is resolved against the page's url; one with another scheme than a host's (mailto: and the like) is none.
A base element isn't read.

Nulls and ties: a null url, or one without ``://``, has an empty host and path, no rule, no aliases, and is allowed. Null
html has no links. Rows that repeat get a result each. Of rules of equal length for one url, an allow rule wins, then the
alphabetically first. Columns besides page_id, url and html are ignored. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import join_small, stored
from tidemark.llm.components import components

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"
_REST = r"(?s)^.*?://[^/?#]*([^#]*)"
_COMMENT = r"(?s)<!--.*?(?:-->|\z)"
CANONICAL = r"""(?is)<link\b(?=[^>]*\brel\s*=\s*(?:"(?:[^">]*\s)?canonical(?:\s[^">]*)?"|'(?:[^'>]*\s)?canonical(?:\s[^'>]*)?'|canonical[\s/>]))[^>]*>"""
REFRESH = r"""(?is)<meta\b(?=[^>]*\bhttp-equiv\s*=\s*["']?refresh\b)[^>]*>"""
_HREF = r"""(?is)\bhref\s*=\s*(?:"([^">]*)"|'([^'>]*)'|([^"'\s>]+))"""
_URL = r"""(?is)\burl\s*=\s*["']?([^"'\s>]+)"""


def host(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, _PARTS, 1), F.lit("")), UPPER, LOWER)


def path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _PARTS, 2), F.lit(""))


def _key(url: Column) -> Column:
    """What stands for a url among its aliases; null if it is none."""
    return F.when(F.instr(url, "://") > 0, F.concat(host(url), F.regexp_extract(url, _REST, 1)))


def _decoded(text: Column) -> Column:
    """Without the character references that stand in urls."""
    for reference, character in (("&#x2F;", "/"), ("&#47;", "/"), ("&quot;", '"'), ("&#39;", "'"), ("&lt;", "<"), ("&gt;", ">"), ("&#38;", "&"), ("&amp;", "&")):
        text = F.replace(text, F.lit(reference), F.lit(character))
    return F.btrim(text, F.lit(" \t\n\r\f"))


def _without_dots(path: Column) -> Column:
    """A path after its "." and ".." have been followed."""
    parts = F.split(path, "/", -1)
    last = F.element_at(parts, -1)
    empty = F.expr("cast(array() as array<string>)")

    def step(done: Column, part: Column) -> Column:
        up = F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(1)))
        return F.when(part == "..", up).when(part == ".", done).otherwise(F.concat(done, F.array(part)))

    found = F.array_join(F.aggregate(parts, empty, step), "/")
    return F.when(last.isin(".", ".."), F.concat(found, F.lit("/"))).otherwise(found)


def resolved(url: Column, to: Column) -> Column:
    """The absolute url that ``to`` means on the page ``url``; null if it is none."""
    start = F.regexp_extract(url, r"(?s)^.*?://[^/?#]*", 0)
    scheme = F.regexp_extract(url, r"(?s)^(.*?):?//", 1)
    own = F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1)
    folder = F.regexp_replace(own, r"[^/]*\z", "")
    joined = F.when(to.startswith("/"), to).otherwise(F.concat(F.when(folder == "", F.lit("/")).otherwise(folder), to))
    place, tail = F.regexp_extract(joined, r"(?s)^[^?#]*", 0), F.regexp_extract(joined, r"(?s)^[^?#]*(.*)\z", 1)
    relative = F.concat(start, _without_dots(place), tail)
    return (
        F.when(to.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"), to)
        .when(to.startswith("//"), F.concat(scheme, F.lit(":"), to))
        .when((to == "") | to.startswith("#") | to.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), F.lit(None))
        .when(to.startswith("?"), F.concat(start, own, to))
        .otherwise(relative)
    )


def link_edges(pages: DataFrame) -> DataFrame:
    """Rows (url, target): all canonical links and redirects in the pages' html, resolved against the page's url."""
    near = pages.filter(F.col("url").contains("://") & F.col("html").rlike("(?i)canonical|http-equiv"))
    near = near.select("url", F.regexp_replace("html", _COMMENT, " ").alias("html"))
    tags = lambda pattern: F.regexp_extract_all("html", F.lit(pattern), F.lit(0))
    links = near.select("url", F.explode(tags(CANONICAL)).alias("tag")).filter(F.col("tag").rlike(_HREF))
    links = links.select("url", F.concat(*(F.regexp_extract("tag", _HREF, i) for i in (1, 2, 3))).alias("to"))
    moves = near.select("url", F.explode(tags(REFRESH)).alias("tag")).filter(F.col("tag").rlike(_URL))
    moves = moves.select("url", F.regexp_extract("tag", _URL, 1).alias("to"))
    found = links.unionByName(moves).select("url", _decoded(F.col("to")).alias("to"))
    return found.select("url", resolved(F.col("url"), F.col("to")).alias("target")).filter(F.col("target").isNotNull())


def fitting_rule(urls: DataFrame, rules: Sequence[tuple[str, str, str]]) -> DataFrame:
    """Rows (key, rule, decision) for the keys of ``urls`` (key, host, path) that a rule (decision, host, path) fits."""
    spark = urls.sparkSession
    table = stored(spark.createDataFrame(list(rules), "decision string, rule_host string, rule_path string"), "rules")
    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    at = urls.select("key", "path", F.explode(suffixes).alias("rule_host"))
    fits = join_small(at, table, "rule_host", "inner").filter(F.col("path").startswith(F.col("rule_path")))
    rule = F.concat("rule_host", "rule_path")
    order = F.struct((-F.char_length(rule)).alias("n"), F.col("decision").alias("decision"), rule.alias("rule"))
    return fits.groupBy("key").agg(F.min(order).alias("best")).select("key", F.col("best.rule").alias("rule"), F.col("best.decision").alias("decision"))


def judge(pages: DataFrame, edges: DataFrame, rules: Sequence[tuple[str, str, str]]) -> DataFrame:
    """All rows of ``pages`` (page_id, url) with host, path, rule and verdict; ``edges``: rows (url, target) of aliases."""
    edges = stored(edges.select(_key(F.col("url")).alias("a"), _key(F.col("target")).alias("b")).filter("a <> b").distinct(), "aliases")
    urls = pages.select(_key(F.col("url")).alias("key"), host(F.col("url")).alias("host"), path(F.col("url")).alias("path")).filter("key is not null")
    ends = edges.select(F.explode(F.array("a", "b")).alias("key"))
    ends = ends.select("key", F.regexp_extract("key", r"(?s)^[^/?#]*", 0).alias("host"), F.regexp_extract("key", r"(?s)^[^/?#]*([^?#]*)", 1).alias("path"))
    ruled = stored(fitting_rule(urls.unionByName(ends).distinct(), rules), "ruled")
    groups = stored(components(edges), "alias-groups").select(F.col("node").alias("key"), "component")
    spread = groups.join(ruled, "key").groupBy("component").agg(F.min("decision").alias("inherited"))
    inherited = groups.join(spread, "component").select("key", "inherited")
    of_url = stored(ruled.join(inherited, "key", "full").select("key", "rule", F.coalesce("decision", "inherited").alias("verdict")), "verdicts")
    out = pages.select("page_id", "url", _key(F.col("url")).alias("key"))
    out = join_small(out, of_url, "key", "left")
    return out.select("page_id", host(F.col("url")).alias("host"), path(F.col("url")).alias("path"), "rule", F.coalesce("verdict", F.lit("allow")).alias("verdict"))
