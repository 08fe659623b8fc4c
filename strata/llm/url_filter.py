"""URL filtering: rules on host and path, and link-graph trust for the rest.

A rule names a host (with all its subdomains) and a path prefix; the longest
rule that fits decides.  URLs without a rule take their host's verdict from the link
graph: personalised PageRank flows from trusted hosts along links (trust)
and from blocked hosts against them (distrust: who links to blocked hosts is
distrusted).  A host's seed weight is the share of its pages that a rule
allows (trust) or blocks (distrust).  A host is blocked when its
distrust exceeds its trust and reaches the level of a seed with ``min_share`` of its pages blocked.
That flow is dealt over all who link to a blocked host, so a host is also judged by its own links: its
*guilt* is the share of its pages that a rule blocks or, if larger, ``damping`` times the mean guilt of the hosts
that it links to.  A host whose guilt reaches ``damping * min_share`` and exceeds its trust (in the
same units) is blocked, however many others link where it does.

All of it is DataFrame operations: pages are aggregated to hosts and distinct
host edges before any join, so a host that holds a third of all pages is one
row of the graph.  Scores are written to the shared scratch folder every
``cut_every`` rounds to keep the plan short.

Defined results: a null url, or one without ``://``, has an empty host and path, fits no
rule and is allowed; a null html has no links; an empty table gives an empty
result; repeated rows are judged each; other columns are ignored."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.session import scratch_path

# The contract's rules (verdict, host, path).
RULES = (("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
         ("block", "net", "/es/"), ("block", "net", "/fr/"))
ROUNDS = 12
DAMPING = 0.85
MIN_SHARE = 0.5
LINK = r"""(?i)<a\s[^>]*?href\s*=\s*["']?([a-z][a-z0-9+.-]*://[^"'\s>]+)"""

# Links that take the page's scheme.
BARE_LINK = r"""(?i)<a\s[^>]*?href\s*=\s*["']?(//[^"'\s>]+)"""


def host_of(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    host = F.regexp_extract(url, r"^(?s:.*?)://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, r"^(?s:.*?)://[^/?#]*([^?#]*)", 1), F.lit(""))


def match_rules(host: Column, path: Column, rules: Sequence[tuple[str, str, str]] = RULES) -> Column:
    """(rule, verdict) of the longest rule that fits, or null."""
    out = None
    for verdict, rule_host, rule_path in sorted(rules, key=lambda r: (-len(r[1] + r[2]), r)):
        fits = ((host == rule_host) | host.endswith(f".{rule_host}")) & path.startswith(rule_path)
        value = F.struct(F.lit(rule_host + rule_path).alias("rule"), F.lit(verdict).alias("verdict"))
        out = F.when(fits, value) if out is None else out.when(fits, value)
    return out if out is not None else F.lit(None).cast("struct<rule:string,verdict:string>")


def host_edges(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Distinct (src, dst) host pairs of absolute and scheme-relative links between different hosts."""
    scheme = F.regexp_extract(url_col, r"^(?s:(.*?))://", 1)
    bare = F.transform(F.regexp_extract_all(html_col, F.lit(BARE_LINK), 1), lambda link: F.concat(scheme, F.lit(":"), link))
    links = pages.select(host_of(F.col(url_col)).alias("src"), F.explode(
        F.array_distinct(F.transform(F.concat(F.regexp_extract_all(html_col, F.lit(LINK), 1), bare), host_of))).alias("dst"))
    return links.filter("src <> '' and dst <> '' and src <> dst").distinct()


def link_shares(edges: DataFrame, damping: float) -> DataFrame:
    """(src, dst, share): ``damping`` dealt evenly over each host's links; written once, as every round reads it."""
    spark, path = edges.sparkSession, scratch_path(edges.sparkSession, "link-shares")
    edges.join(edges.groupBy("src").agg(F.count(F.lit(1)).alias("n")), "src").select("src", "dst", (F.lit(damping) / F.col("n")).alias("share")).write.parquet(path)
    return spark.read.schema("src string, dst string, share double").parquet(path)


def propagate(edges: DataFrame, seeds: DataFrame, rounds: int = ROUNDS, damping: float = DAMPING, cut_every: int = 4) -> DataFrame:
    """Personalised PageRank: (host, score) from ``seeds`` (host, weight) along
    ``edges`` (src, dst).  Score that has no way out of a host is lost, so
    a score never depends on unrelated hosts.  A seed's own share is ``1 - damping`` times its weight."""
    spark = edges.sparkSession
    fan = link_shares(edges, damping)
    start = seeds.select("host", (F.col("weight") * (1 - damping)).alias("score"))
    now = start
    for i in range(rounds):
        flow = now.join(fan, now["host"] == fan["src"]).select(F.col("dst").alias("host"), (F.col("score") * F.col("share")).alias("score"))
        now = start.unionByName(flow).groupBy("host").agg(F.sum("score").alias("score"))
        if i % cut_every == cut_every - 1 or i == rounds - 1:
            path = scratch_path(spark, "rank")
            now.write.parquet(path)
            now = spark.read.schema("host string, score double").parquet(path)
    return now


def guilt_of(edges: DataFrame, seeds: DataFrame, rounds: int = ROUNDS, damping: float = DAMPING, cut_every: int = 4) -> DataFrame:
    """(host, guilt): the weight in ``seeds`` or ``damping`` times the mean guilt of
    the hosts that it links to (0 if unknown), whichever is larger.  It depends on a host's own
    links only, never on how many others link to the same hosts."""
    spark = edges.sparkSession
    fan = link_shares(edges, damping)
    start = seeds.select("host", F.col("weight").alias("guilt"))
    now = start
    for i in range(rounds):
        linkers = now.join(fan, now["host"] == fan["dst"]).groupBy("src").agg(F.sum(F.col("guilt") * F.col("share")).alias("guilt"))
        now = start.unionByName(linkers.withColumnRenamed("src", "host")).groupBy("host").agg(F.max("guilt").alias("guilt"))
        if i % cut_every == cut_every - 1 or i == rounds - 1:
            path = scratch_path(spark, "guilt")
            now.write.parquet(path)
            now = spark.read.schema("host string, guilt double").parquet(path)
    return now


def host_graph(pages: DataFrame, url_col: str, html_col: str, rules: Sequence[tuple[str, str, str]]) -> tuple[DataFrame, DataFrame]:
    """(host, allowed, barred) shares of each host's pages, and the host edges."""
    spark = pages.sparkSession
    urls = pages.select(host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path"))
    verdict = match_rules(F.col("host"), F.col("path"), rules)["verdict"]
    shares = (urls.filter("host <> ''").groupBy("host")
              .agg(F.avg((verdict.eqNullSafe("allow")).cast("double")).alias("allowed"),
                   F.avg((verdict.eqNullSafe("block")).cast("double")).alias("barred")))
    path = scratch_path(spark, "hosts")
    shares.write.parquet(path)
    shares = spark.read.schema("host string, allowed double, barred double").parquet(path)
    path = scratch_path(spark, "host-edges")
    host_edges(pages, url_col, html_col).write.parquet(path)
    return shares, spark.read.schema("src string, dst string").parquet(path)


def host_verdicts(pages: DataFrame, url_col: str = "url", html_col: str = "html", rules: Sequence[tuple[str, str, str]] = RULES,
                  rounds: int = ROUNDS, damping: float = DAMPING, min_share: float = MIN_SHARE) -> DataFrame:
    """(host, trust, distrust, blocked) for every host that has a page or takes part in a link chain from a seed."""
    return flow_verdicts(*host_graph(pages, url_col, html_col, rules), rounds, damping, min_share)


def flow_verdicts(shares: DataFrame, edges: DataFrame, rounds: int = ROUNDS, damping: float = DAMPING, min_share: float = MIN_SHARE) -> DataFrame:
    """``host_verdicts`` from the shares and edges of ``host_graph``."""
    trust = propagate(edges, shares.filter("allowed > 0").select("host", F.col("allowed").alias("weight")), rounds, damping)
    back = edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"))
    distrust = propagate(back, shares.filter("barred > 0").select("host", F.col("barred").alias("weight")), rounds, damping)
    both = (trust.select("host", F.col("score").alias("trust"), F.lit(0.0).alias("distrust"))
            .unionByName(distrust.select("host", F.lit(0.0).alias("trust"), F.col("score").alias("distrust")))
            .groupBy("host").agg(F.sum("trust").alias("trust"), F.sum("distrust").alias("distrust")))
    least = (1 - damping) * min_share
    return both.withColumn("blocked", (F.col("distrust") > F.col("trust")) & (F.col("distrust") >= least * (1 - 1e-9)))


def filter_urls(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
                rules: Sequence[tuple[str, str, str]] = RULES, rounds: int = ROUNDS, damping: float = DAMPING,
                min_share: float = MIN_SHARE) -> DataFrame:
    """One row per page: id, host, path, rule (null if none fits) and verdict."""
    shares, edges = host_graph(pages, url_col, html_col, rules)
    flows = flow_verdicts(shares, edges, rounds, damping, min_share)
    guilt = guilt_of(edges, shares.filter("barred > 0").select("host", F.col("barred").alias("weight")), rounds, damping)
    linked = edges.select(F.col("src").alias("host")).distinct()
    by_links = (guilt.join(linked, "host").join(flows.select("host", "trust"), "host", "left")
                .filter((F.col("guilt") >= damping * min_share * (1 - 1e-9)) & (F.col("guilt") * (1 - damping) > F.coalesce("trust", F.lit(0.0)))).select("host"))
    blocked = flows.filter("blocked").select("host").unionByName(by_links).distinct().withColumn("blocked", F.lit(True))
    rows = pages.select(F.col(id_col), host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path"))
    rows = rows.withColumn("hit", match_rules(F.col("host"), F.col("path"), rules))
    return rows.join(blocked, "host", "left").select(
        id_col, "host", "path", F.col("hit.rule").alias("rule"),
        F.coalesce(F.col("hit.verdict"), F.when(F.col("blocked"), "block"), F.lit("allow")).alias("verdict"))
