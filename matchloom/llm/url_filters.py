"""URL filters by redirect equivalence.

Pages whose addresses redirect to one another, or name one another as canonical, are aliases. Aliases form connected
components, found by distributed contraction over string keys. A host-and-path rule that fits an address decides for
that address. An address without a rule takes its component's: allow if a rule allows any alias, else block if a rule
blocks any, else allow. DataFrame operations only.

Edges: an address and its plain form (no scheme, fragment, tracking parameters, default port or last slash; host in
lower case), an address and its html's <link rel=canonical>, an address and its <meta http-equiv=refresh> target, and
any table of redirects. The component's decisions come by partial aggregates, and a component that holds a third of
all pages costs a split join, not a group.

Cases: null or scheme-less address: empty host and path, no rule, no alias, verdict allow. Null html: no edges from it.
Repeated rows: each judged. Equally long rules: block loses to allow. Empty table: empty result. Other columns pass
through; those named host, path, rule or verdict are replaced. Very long texts: every tag in them counts.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .graph import components


@dataclass(frozen=True)
class Rule:
    """host: fits itself and its subdomains; path: the start of the address's path."""

    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


def host_of(url: Column) -> Column:
    """After the first :// up to / ? # or the end, A-Z in lower case; empty without ://."""
    raw = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(raw, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def plain(url: Column) -> Column:
    """The address without what doesn't select a page; null where there is no host."""
    query = F.regexp_extract(url, r"(?s)^[^?#]*\?([^#]*)", 1)
    kept = F.array_join(F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.rlike(r"^(utm_[a-z]*|ref|fbclid|gclid)(=|$)")), "&")
    host = F.regexp_replace(host_of(url), r":(80|443)$", "")
    path = F.regexp_replace(path_of(url), r"/+$", "")
    return F.when(host != "", F.concat(host, path, F.when(kept != "", F.concat(F.lit("?"), kept)).otherwise("")))


def _fits(rule: Rule, host: Column, path: Column) -> Column:
    return ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)


def ruling(rules: list[Rule], host: Column, path: Column) -> Column:
    """The longest fitting rule's text (of equally long ones, an allowing one), else null."""
    out = F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: (len(r.text), r.verdict == "allow")):
        out = F.when(_fits(r, host, path), F.lit(r.text)).otherwise(out)
    return out


def resolved(url: Column, target: Column) -> Column:
    """A link's target as an address: whole, or relative to the page's (//host, /path, ?query, path with . and ..); else null."""
    t = F.trim(target)
    scheme = F.regexp_extract(url, r"(?s)^(.*?)://", 1)
    site = F.concat(scheme, F.lit("://"), F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1))
    folder = F.regexp_extract(path_of(url), r"(?s)^(.*/)", 1)
    joined = F.when(t.startswith("/"), t).otherwise(F.concat(F.when(folder != "", folder).otherwise("/"), t))
    way, rest = F.regexp_extract(joined, r"(?s)^([^?#]*)", 1), F.regexp_extract(joined, r"(?s)^[^?#]*(.*)$", 1)
    parts = F.aggregate(F.split(way, "/"), F.array().cast("array<string>"), lambda a, x: F.when(x == ".", a).when(x == "..", F.slice(a, 1, F.greatest(F.size(a) - 1, F.lit(1)))).otherwise(F.concat(a, F.array(x))))
    relative = F.when(t.startswith("//"), F.concat(scheme, F.lit(":"), t)).when(t.startswith("?"), F.concat(site, path_of(url), t)).when(~t.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), F.concat(site, F.array_join(parts, "/"), rest))
    return F.when((t == "") | t.startswith("#"), None).when(t.contains("://"), t).when(host_of(url) != "", relative)


def html_edges(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """(url, target) from every canonical link and every refresh of a page, attributes in any order."""
    tags = lambda name: F.regexp_extract_all(F.col("html"), F.lit(rf"(?is)(<{name}\b[^>]*>)"), F.lit(1))
    links = F.filter(tags("link"), lambda x: x.rlike(r"(?is)\brel\s*=\s*[\"']?canonical\b"))
    canonical = F.transform(links, lambda x: F.regexp_extract(x, r"(?is)\bhref\s*=\s*[\"']?([^\"'\s>]+)", 1))
    metas = F.filter(tags("meta"), lambda x: x.rlike(r"(?is)\bhttp-equiv\s*=\s*[\"']?refresh\b"))
    refresh = F.transform(metas, lambda x: F.regexp_extract(x, r"(?is)\burl\s*=\s*[\"']?([^\"'\s>;]+)", 1))
    rows = pages.select(F.col(url).alias("url"), F.col(html).alias("html")).filter(F.col("html").rlike(r"(?i)canonical|http-equiv"))
    found = rows.select("url", F.explode(F.concat(canonical, refresh)).alias("target"))
    return found.select("url", resolved(F.col("url"), F.col("target")).alias("target")).filter("target is not null")


def judge(pages: DataFrame, rules: list[Rule], edges: DataFrame | None = None, url: str = "url") -> DataFrame:
    """pages and host, path, rule, verdict. edges: (url, target) redirects and canonical links, any number of hops."""
    texts = {r.text: r.verdict for r in sorted(rules, key=lambda r: r.verdict == "allow")}
    is_allow = F.col("rule").isin([t for t, v in texts.items() if v == "allow"])
    base = pages.withColumn("__plain", plain(F.col(url))).withColumn("__host", host_of(F.col(url))).withColumn("__path", path_of(F.col(url)))
    base = base.drop("host", "path", "rule", "verdict").withColumnsRenamed({"__host": "host", "__path": "path"})
    base = base.withColumn("rule", ruling(rules, F.col("host"), F.col("path")))
    if edges is not None:
        links = edges.select(plain(F.col("url")).alias("u"), plain(F.col("target")).alias("v"))
        roots = components(links, label="urls").select(F.col("node").alias("__plain"), F.col("root").alias("__root"))
        base = base.join(roots, "__plain", "left").withColumn("__class", F.coalesce("__root", "__plain")).drop("__root")
    else:
        base = base.withColumn("__class", F.col("__plain"))
    ruled = base.filter(F.col("rule").isNotNull() & F.col("__class").isNotNull())
    decided = ruled.groupBy("__class").agg(F.max(is_allow).alias("__allowed")).select("__class", F.when(F.col("__allowed"), "allow").otherwise("block").alias("__from_alias"))
    own = F.when(is_allow, "allow").when(F.col("rule").isNotNull(), "block")
    out = base.join(decided, "__class", "left").withColumn("verdict", F.coalesce(own, F.col("__from_alias"), F.lit("allow")))
    return out.drop("__plain", "__class", "__from_alias")
