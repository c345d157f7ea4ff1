"""URL filter with redirect equivalence (operator 1).

Rules (host suffix and path prefix, longest wins) judge a url by itself.
Urls without a rule of their own take part in redirect equivalence: their
normal form (scheme, fragment, tracking parameters and the ``www.`` / ``m.``
host prefixes dropped), canonical links and immediate refreshes are edges of
a graph, and its connected components share their fate.  A component with an
explicitly allowed member is allowed; else one with a blocked member is
blocked; else it is allowed.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from godown.llm.common import written
from godown.llm.components import components

#: Judged in the contract's query.
RULES = (("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/"))
PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)(\?[^#]*)?"
TRACKING = r"^(utm_[^=]*|ref)(=|$)"
CANONICAL = r"""(?is)<link\b(?=[^>]*\brel\s*=\s*["']?canonical\b)[^>]*\bhref\s*=\s*["']?([^"'\s>]+)"""
REFRESH = r"""(?is)<meta\b(?=[^>]*\bhttp-equiv\s*=\s*["']?refresh\b)[^>]*\bcontent\s*=\s*["']?[^"'>]*?\burl\s*=\s*["']?([^"'\s>]+)"""


def lower_ascii(c: Column) -> Column:
    return F.translate(c, string.ascii_uppercase, string.ascii_lowercase)


def host_of(url: Column) -> Column:
    return lower_ascii(F.coalesce(F.regexp_extract(url, PARTS, 1), F.lit("")))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, PARTS, 2), F.lit(""))


def rule_of(host: Column, path: Column, rules) -> Column:
    """The longest rule that fits, as its string; null if none does."""
    fits = []
    for _, rule in sorted(rules, key=lambda r: (-len(r[1]), r[1])):
        h, p = rule.split("/", 1)
        fits.append(F.when(((host == h) | host.endswith("." + h)) & path.startswith("/" + p), F.lit(rule)))
    return F.coalesce(*fits, F.lit(None).cast("string")) if fits else F.lit(None).cast("string")


def key_of(url: Column) -> Column:
    """The normal form of an absolute url; null for others."""
    host = F.regexp_replace(host_of(url), r"^(www|m)\.", "")
    query = F.regexp_replace(F.coalesce(F.regexp_extract(url, PARTS, 3), F.lit("")), r"^\?", "")
    kept = F.array_join(F.filter(F.split(query, "&"), lambda x: ~x.rlike(TRACKING)), "&")
    return F.when(url.contains("://"), F.concat(host, path_of(url), F.when(kept != "", F.concat(F.lit("?"), kept)).otherwise("")))


def absolute(target: Column, url: Column) -> Column:
    """A link found in the page of ``url``, made absolute."""
    scheme = F.regexp_extract(url, r"(?s)^(.*?)://", 1)
    root = F.concat(scheme, F.lit("://"), host_of(url))
    folder = F.regexp_extract(path_of(url), r"(?s)^(.*/)", 1)
    return (F.when(target == "", F.lit(None)).when(target.rlike("^[A-Za-z][A-Za-z0-9+.-]*://"), target)
            .when(target.startswith("//"), F.concat(scheme, F.lit(":"), target))
            .when(target.startswith("/"), F.concat(root, target))
            .otherwise(F.concat(root, F.when(folder == "", "/").otherwise(folder), target)))


def judge(pages: DataFrame, rules=RULES, redirects: DataFrame | None = None,
          id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, host, path, rule, verdict, alias_of: one row per page, repeated rows included.

    ``redirects`` (src_url, dst_url) adds known redirects.  A null url, or
    one without ``://``, has empty host and path, no rule and no alias, and
    is allowed.  ``alias_of`` is the smallest normal form of the component.
    """
    url, html = F.col(url_col), F.col(html_col)
    base = pages.select(F.col(id_col).alias("page_id"), host_of(url).alias("host"), path_of(url).alias("path"), key_of(url).alias("key"))
    base = base.withColumn("rule", rule_of(F.col("host"), F.col("path"), rules))
    links = pages.select(url.alias("url"), F.explode(F.concat(*(F.regexp_extract_all(html, F.lit(x), F.lit(1)) for x in (CANONICAL, REFRESH)))).alias("to"))
    edges = links.where("to != ''").select(key_of(F.col("url")).alias("a"), key_of(absolute(F.col("to"), F.col("url"))).alias("b"))
    if redirects is not None:
        edges = edges.unionByName(redirects.select(key_of(F.col("src_url")).alias("a"), key_of(F.col("dst_url")).alias("b")))
    roots = components(edges).select(F.col("node").alias("key"), "root")
    verdicts = {v: [r for w, r in rules if w == v] for v in ("allow", "block")}
    own = (F.when(F.col("rule").isin(verdicts["allow"]), "allow").when(F.col("rule").isin(verdicts["block"]), "block"))
    # a row per alias key with what its pages' rules say, then a row per component
    said = (base.where("key is not null and rule is not null").withColumn("own", own)
            .groupBy("key").agg(F.max(F.col("own") == "allow").alias("allowed"), F.max(F.col("own") == "block").alias("blocked")))
    fate = (said.join(roots, "key", "left").groupBy(F.coalesce("root", "key").alias("alias_of"))
            .agg(F.max("allowed").alias("allowed"), F.max("blocked").alias("blocked")))
    fate = written(fate.where("blocked and not allowed").select("alias_of", F.lit(True).alias("banned")), "url_fate")
    rows = base.join(roots, "key", "left").withColumn("alias_of", F.coalesce("root", "key"))
    return (rows.join(fate, "alias_of", "left")
            .select("page_id", "host", "path", "rule",
                    F.coalesce(own, F.when(F.col("banned"), "block"), F.lit("allow")).alias("verdict"), "alias_of"))
