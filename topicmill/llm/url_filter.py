"""URL rules that follow redirects and canonical links.

Pages, redirect targets and canonical addresses are nodes of a graph; redirects
(`meta refresh`, or a table of recorded ones) and canonical links (`link
rel=canonical`, or else the page's address without scheme, fragment,
`www.` or `m.`, final slash and tracking fields) are edges. All addresses of a connected component are one
page under several names. A page that a rule fits gets that rule's verdict; any
other takes its aliases': allowed if one of them is allowed by a rule (allow goes
before block), else blocked if one is blocked, else allowed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from topicmill.llm.common import ascii_lower, shielded
from topicmill.llm.components import components

# Rules as (host, path, verdict).
RULES = (
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
)


def host_of(url: Column) -> Column:
    """From after the first :// up to /, ?, # or the end, A-Z in lower case."""
    return F.coalesce(ascii_lower(F.regexp_extract(url, r"(?s)\A.*?://([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    """From the host's end up to ?, # or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)\A.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def best_rule(host: Column, path: Column, rules=RULES) -> Column:
    """The fitting rule with the longest text as struct(rule, verdict), or null.

    The rules are a list in the plan: a configuration of some thousands at most.
    Equally long rules: the one first in the list.
    """
    ordered = sorted(rules, key=lambda r: -len(r[0] + r[1]))
    cases = None
    for rule_host, rule_path, verdict in ordered:
        fits = ((host == rule_host) | host.endswith(f".{rule_host}")) & path.startswith(rule_path)
        value = F.struct(F.lit(rule_host + rule_path).alias("rule"), F.lit(verdict).alias("verdict"))
        cases = F.when(fits, value) if cases is None else cases.when(fits, value)
    return cases if cases is not None else F.lit(None).cast("struct<rule:string,verdict:string>")


def plain_address(url: Column) -> Column:
    """The address that variants of one page share; null without a host.

    Scheme, fragment, a `www.` or `m.` before the host, slashes at the path's
    end and the query's tracking fields (`utm_...`, `ref`) don't count.
    """
    host = F.regexp_replace(host_of(url), r"^(www|m)\.(?=[^.]+\.)", "")
    path = F.regexp_replace(path_of(url), r"/+$", "")
    query = F.regexp_extract(url, r"(?s)\A.*?://[^?#]*\?([^#]*)", 1)
    query = F.regexp_replace(F.regexp_replace(query, r"(^|&)(utm_[^=&]*|ref)(=[^&]*)?(?=&|$)", ""), r"^&", "")
    return F.when(host_of(url) != "", F.concat_ws("?", F.concat(host, path), F.nullif(query, F.lit(""))))


_ATTRIBUTE = r"""(?is)<{tag}\b(?=[^>]*\b{key}\s*=\s*["']?{value}\b)[^>]*\b{wanted}"""


def canonical_link(html: Column) -> Column:
    """Address in the first <link rel=canonical href=...>, null without."""
    found = F.regexp_extract(html, _ATTRIBUTE.format(tag="link", key="rel", value="canonical", wanted=r"""href\s*=\s*["']?([^"'\s>]+)"""), 1)
    return F.nullif(F.when(html.contains("anonical"), found), F.lit(""))


def redirect_target(html: Column) -> Column:
    """Address in the first <meta http-equiv=refresh content="0; url=...">."""
    found = F.regexp_extract(html, _ATTRIBUTE.format(tag="meta", key="http-equiv", value="refresh", wanted=r"""content\s*=\s*["'][^"'>]*?url\s*=\s*([^"'\s>]+)"""), 1)
    return F.nullif(F.when(html.contains("efresh"), found), F.lit(""))


def _absolute(link: Column, url: Column) -> Column:
    """Links with a host as they are, those from the root get the page's host."""
    return F.when(link.contains("://"), link).when(
        link.startswith("//"), F.concat(F.lit("http:"), link)
    ).when(link.startswith("/"), F.concat(F.lit("http://"), host_of(url), link))


def alias_edges(pages: DataFrame, redirects: DataFrame | None = None) -> DataFrame:
    """Edges between hashes of addresses: url - plain address, url - targets.

    `redirects`: recorded ones as (url, target). Addresses are 64-bit hashes;
    null addresses have no edges.
    """
    url = F.col("url")
    targets = F.array(
        plain_address(url),
        plain_address(_absolute(F.col("_canonical"), url)),
        plain_address(_absolute(F.col("_redirect"), url)),
    )
    found = pages.select("url", canonical_link(F.col("html")).alias("_canonical"), redirect_target(F.col("html")).alias("_redirect"))
    edges = found.select(url, F.explode(targets).alias("target"))
    if redirects is not None:
        known = redirects.select("url", "target")
        edges = edges.union(known.select("url", plain_address(F.col("url"))))
        edges = edges.union(known.select("url", plain_address(F.col("target"))))
    # The kind of a node is part of its hash: a url is never its own plain form.
    pairs = edges.where("url is not null and target is not null")
    return pairs.select(node_id(F.col("url")).alias("src"), F.xxhash64(F.lit("plain"), F.col("target")).alias("dst"))


def node_id(url: Column) -> Column:
    return F.xxhash64(F.lit("url"), url)


@shielded("url", "html", made=("host", "path", "rule", "verdict", "component"))
def judge(pages: DataFrame, rules=RULES, redirects: DataFrame | None = None) -> DataFrame:
    """`pages` with host, path, rule, verdict and component.

    Null urls and urls without :// have empty host and path, no rule and no
    alias: allowed. Repeated urls get the same verdict. `component` is null where
    there is no alias edge. Extra columns pass through; columns named like an
    output are replaced.
    """
    made = ["host", "path", "rule", "verdict", "component"]
    rows = pages.select(*[c for c in pages.columns if c not in made])
    rows = rows.withColumns({"host": host_of(F.col("url")), "path": path_of(F.col("url"))})
    rows = rows.withColumn("_own", best_rule(F.col("host"), F.col("path"), rules))
    member = components(alias_edges(pages, redirects))

    named = pages.select("url")
    if redirects is not None:
        named = named.union(redirects.select("url")).union(redirects.select("target"))
    decided = named.where("url is not null").distinct()
    decided = decided.withColumn("_own", best_rule(host_of(F.col("url")), path_of(F.col("url")), rules))
    decided = decided.where("_own is not null").select(node_id(F.col("url")).alias("node"), F.col("_own.verdict").alias("_v"))
    # One row per component that has a decided member.
    spread = (
        decided.join(member, "node")
        .groupBy("component")
        .agg(F.max(F.col("_v") == "allow").alias("_allow"), F.max(F.col("_v") == "block").alias("_block"))
    )
    labelled = member.join(spread, "component", "left").select(F.col("node").alias("_node"), "component", "_allow", "_block")
    rest = (
        F.when(F.coalesce("_allow", F.lit(False)), "allow")
        .when(F.coalesce("_block", F.lit(False)), "block")
        .otherwise("allow")
    )
    keep = [c for c in rows.columns if c not in ("_own",)]
    return (
        rows.withColumn("_node", node_id(F.col("url")))
        .join(labelled, "_node", "left")
        .select(
            *keep,
            F.col("_own.rule").alias("rule"),
            F.coalesce(F.col("_own.verdict"), rest).alias("verdict"),
            F.when(F.col("url").isNotNull(), F.col("component")).alias("component"),
        )
    )
