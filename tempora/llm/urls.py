"""URL filters with redirect equivalence, in DataFrame operations only.

Rules judge a url by host suffix and path prefix. Urls that are aliases of
each other (redirects, canonical links) form components; a url without a rule
takes its component's decision: allow if a member is explicitly allowed, else
block if one is blocked, else allow.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tempora.llm.common import ascii_lower
from tempora.llm.components import connected_components

# Fixed values: (host, path, verdict).
RULES = (
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
)
ATTRIBUTE = r"""\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)"""


def rules_table(spark: SparkSession, rules=RULES) -> DataFrame:
    return spark.createDataFrame(list(rules), "host string, path string, verdict string")


def host(url) -> F.Column:
    return ascii_lower(F.coalesce(F.regexp_extract(url, "://([^/?#]*)", 1), F.lit("")))


def path(url) -> F.Column:
    return F.coalesce(F.regexp_extract(url, "://[^/?#]*([^?#]*)", 1), F.lit(""))


def node(url) -> F.Column:
    """A url without scheme and fragment, host lower-cased; null for what is no url."""
    query = F.regexp_extract(url, r"://[^/?#]*[^?#]*(\?[^#]*)?", 1)
    return F.when(url.contains("://"), F.concat(F.lit("://"), host(url), path(url), query))


def judge(sites: DataFrame, rules: DataFrame) -> DataFrame:
    """(host, path, rule, verdict) of every (host, path) that a rule fits; the longest rule wins.

    Each host is looked up by its suffixes, so any number of rules is an equi
    join. Of equally long rules the one with the longer host counts, then allow.
    """
    parts = F.split("host", r"\.")
    suffix = F.explode(F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, i, F.size(parts)), ".")))
    by = sites.select("host", "path").distinct().withColumn("suffix", suffix)
    named = rules.select(ascii_lower(F.col("host")).alias("r_host"), F.col("path").alias("r_path"), F.col("verdict").alias("r_verdict"))
    fits = by.join(named, F.col("suffix") == F.col("r_host")).where(F.expr("startswith(path, r_path)"))
    rule = F.concat("r_host", "r_path")
    best = F.max(F.struct(F.length(rule).alias("n"), F.length("r_host").alias("h"), (F.col("r_verdict") == "allow").alias("a"),
                          rule.alias("rule"), F.col("r_verdict").alias("verdict")))
    return fits.groupBy("host", "path").agg(best.alias("b")).select("host", "path", "b.rule", "b.verdict")


def alias_edges(pages: DataFrame) -> DataFrame:
    """(u, v) nodes from the canonical links and refresh redirects in the html of (url, html)."""
    rows = pages.where(F.col("url").contains("://") & F.col("html").rlike("(?i)canonical|http-equiv"))
    bare = F.regexp_replace("html", r"(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>", " ")
    tags = rows.select("url", F.explode(F.regexp_extract_all(bare, F.lit(r"(?i)<(?:link|meta)\b[^>]*>"), F.lit(0))).alias("tag"))
    tag = F.col("tag")
    value = lambda name: F.btrim(F.regexp_extract(tag, rf"(?i)\s{name}{ATTRIBUTE}", 1), F.lit("\"' "))
    canonical = tag.rlike("(?i)^<link") & F.lower(value("rel")).rlike(r"(?:^|\s)canonical(?:\s|$)")
    refresh = tag.rlike("(?i)^<meta") & (F.lower(value("http-equiv")) == "refresh")
    goal = F.when(canonical, value("href")).when(refresh, F.regexp_extract(value("content"), r"""(?i)url\s*=\s*['"]?([^'"]+)""", 1))
    # one array step keeps the expressions below from being written out once per use
    links = tags.select("url", F.explode(F.array(F.replace(goal, F.lit("&amp;"), F.lit("&")))).alias("goal")).where("goal <> ''")
    here, goal = F.col("url"), F.col("goal")
    site = F.concat(F.lit("://"), host(here))
    full = (F.when(goal.rlike("^[A-Za-z][A-Za-z0-9+.-]*://"), goal).when(goal.startswith("//"), F.concat(F.lit(":"), goal))
            .when(goal.startswith("/"), F.concat(site, goal)).when(goal.startswith("?"), F.concat(site, path(here), goal))
            .when(goal.startswith("#"), here).otherwise(F.concat(site, F.regexp_extract(path(here), "^(.*/)?", 0), goal)))
    ends = links.select("url", F.explode(F.array(full)).alias("to"))
    return ends.select(node(F.col("url")).alias("u"), node(F.col("to")).alias("v")).where("u <> v").distinct()


def filter_urls(pages: DataFrame, rules: DataFrame, redirects: DataFrame | None = None) -> DataFrame:
    """page_id, host, path, rule, verdict for every page.

    In: page_id, url, html (others are ignored); rules (host, path, verdict);
    redirects (src, dst), more known redirects between urls. A null url or one
    without ``://`` has empty host and path, no rule and no aliases, and is
    allowed. Null html names no alias. Repeated rows are judged one by one; no
    pages give no rows.
    """
    urls = pages.select("page_id", F.col("url").cast("string"), F.col("html").cast("string"))
    edges = alias_edges(urls)
    if redirects is not None:
        edges = edges.unionByName(redirects.select(node(F.col("src")).alias("u"), node(F.col("dst")).alias("v")))
    groups = connected_components(edges)
    ruled = judge(urls.select(host(F.col("url")).alias("host"), path(F.col("url")).alias("path")).unionByName(
        groups.select(host(F.col("node")).alias("host"), path(F.col("node")).alias("path"))), rules)
    members = groups.select("node", "component", host(F.col("node")).alias("host"), path(F.col("node")).alias("path"))
    sides = members.join(ruled, ["host", "path"], "left").groupBy("component").agg(
        F.max(F.col("verdict") == "allow").alias("allowed"), F.max(F.col("verdict") == "block").alias("blocked"))
    alias = members.join(sides, "component").where("allowed OR blocked").select(
        F.col("node").alias("alias"), F.when(F.col("allowed"), "allow").otherwise("block").alias("inherited"))
    rows = urls.select("page_id", host(F.col("url")).alias("host"), path(F.col("url")).alias("path"), node(F.col("url")).alias("node"))
    rows = rows.join(ruled, ["host", "path"], "left").join(alias, F.col("node") == F.col("alias"), "left")
    return rows.select("page_id", "host", "path", "rule", F.coalesce("verdict", "inherited", F.lit("allow")).alias("verdict"))
