"""Address rules, and verdicts by propagation over the link graph of hosts, native in Spark SQL.

Where no rule fits an address, its host decides. Hosts most of whose pages rules allow are trusted seeds, hosts most of
whose pages rules block are blocked seeds. Trust is a personalised PageRank from the trusted seeds along the links;
distrust is one from the blocked seeds against the links, to the hosts that link to them. Scores are whole numbers
(parts of SCALE), so they don't depend on the order of sums. Products are taken at full width before they are divided.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labelloom.session import stage

SCALE = 10**12
#: Shares of totals up to this are rounded down to parts of it, each of which has one at least; shares of larger totals
#: are exact.
SHARES = 10**6
DAMPING = 85
#: Rounds at least, unless nothing moves any more.
ITERATIONS = 12
#: A host is blocked if its distrust is at least this, and more than so many times its trust.
LEAST_DISTRUST, TIMES_TRUST = 1_000, 2
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LINK = r"""(?i)\bhref\s*=\s*["']?\s*(?:[a-z][a-z0-9+.-]*:)?//([^/?#"'\s<>]+)"""

Rule = tuple[str, str]


def host_and_path(url: str = "url") -> list[Column]:
    """Host (after the first ://, A-Z lower-cased) and path of an address; both empty if it has no :// or is null."""
    rest = F.expr(f"if(instr({url}, '://') > 0, substring({url}, instr({url}, '://') + 3), '')")
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), UPPER, UPPER.lower())
    return [host.alias("host"), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1).alias("path")]


def rule_table(spark, rules: Sequence[tuple[str, str]]) -> DataFrame:
    """(rule, verdict, rule_host, rule_path) of (verdict, rule) pairs like ("block", "net/es/")."""
    entries = [
        F.struct(F.lit(r).alias("rule"), F.lit(v).alias("verdict"), F.lit(host).alias("rule_host"), F.lit(r[len(host) :]).alias("rule_path"))
        for v, r in rules
        for host in [r.partition("/")[0]]
    ]
    return spark.range(1).select(F.inline(F.array(*entries)))


def host_rules(hosts: DataFrame, rules: DataFrame) -> DataFrame:
    """(host, rules): of each host that has any, the rules of the host and its parents, longest first."""
    labels = F.split("host", r"\.")
    suffix = F.transform(
        F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), ".")
    )
    met = hosts.select("host", F.explode(suffix).alias("rule_host")).join(rules, "rule_host")
    entry = F.struct((-F.length("rule")).alias("order"), "rule", "verdict", "rule_path")
    return met.groupBy("host").agg(F.sort_array(F.collect_set(entry)).alias("rules"))


def with_rules(pages: DataFrame, of_host: DataFrame) -> DataFrame:
    """``pages`` (host, path, ...) with hit: the longest rule that fits, null if none does."""
    fits = F.filter("rules", lambda r: F.startswith(F.col("path"), r["rule_path"]))
    return pages.join(of_host, "host", "left").withColumn("hit", F.get(fits, F.lit(0))).drop("rules")


def host_links(pages: DataFrame) -> DataFrame:
    """(source, target, pages): on how many pages of a host another host is linked to."""
    found = F.array_distinct(F.regexp_extract_all(F.coalesce("html", F.lit("")), F.lit(LINK), F.lit(1)))
    links = pages.select(
        host_and_path()[0].alias("source"), F.explode(F.transform(found, lambda h: F.translate(h, UPPER, UPPER.lower()))).alias("target")
    )
    return links.where("source <> '' and source <> target").groupBy("source", "target").agg(F.count(F.lit(1)).alias("pages"))


def propagated(links: DataFrame, seeds: DataFrame) -> DataFrame:
    """(host, score): personalised PageRank. ``links`` (source, target, pages), ``seeds`` (host, weight).

    Scores begin with what each round gives back to the seeds, so they only grow, and rounds go on until all that is
    still to come is less than LEAST_DISTRUST. Each round is two narrow shuffles over the host graph and is written to
    the shared folder. A host with very many links is reduced before the shuffle, and its join side can be split.
    """
    out = links.groupBy(F.col("source").alias("from")).agg(F.sum("pages").alias("out"))
    steps = links.join(out, links.source == out["from"]).select(
        "source",
        "target",
        F.expr(f"cast(if(out <= {SHARES}, pages * {SHARES} div out, pages) as decimal(18,0))").alias("part"),
        F.expr(f"if(out <= {SHARES}, {SHARES}, out)").alias("whole"),
    )
    steps = stage(steps, "links")
    total = seeds.agg(F.coalesce(F.sum("weight"), F.lit(0))).first()[0]
    if not total:
        return seeds.select("host", F.lit(0).cast("long").alias("score"))
    exact = f"cast(weight as decimal(18,0)) * cast({SCALE} as decimal(18,0)) div {total}"
    mass = exact if total > SHARES else f"weight * {SHARES} div {total} * {SCALE // SHARES}"
    start = stage(seeds.select("host", F.expr(mass).alias("mass")), "seeds")
    back = start.select("host", F.expr(f"mass * {100 - DAMPING} div 100").alias("score"))
    if steps.isEmpty():
        return back
    scores, held, rounds = back, back.agg(F.sum("score")).first()[0], 0
    while True:
        moved = steps.join(scores, steps.source == scores.host).select(
            F.col("target").alias("host"),
            F.expr(f"cast(score as decimal(18,0)) * part div whole * {DAMPING} div 100").alias("score"),
        )
        scores = stage(back.unionByName(moved).groupBy("host").agg(F.sum("score").alias("score")), "scores")
        now = scores.agg(F.sum("score")).first()[0]
        grown, held, rounds = now - held, now, rounds + 1
        to_come = grown * DAMPING // (100 - DAMPING)
        if not grown or rounds >= ITERATIONS and to_come < LEAST_DISTRUST:
            return scores


def judged(pages: DataFrame, rules: DataFrame) -> DataFrame:
    """One row per row of ``pages`` (page_id, url, html): page_id, host, path, rule, verdict, trust, distrust.

    A rule fits its host and all subdomains, where the path begins with the rule's; the longest fitting rule wins, among
    equals the one that allows. Without a rule the verdict is the host's: block if its distrust is LEAST_DISTRUST or
    more and above TIMES_TRUST times its trust, else allow. Addresses that are null or have no :// have an empty host
    and path, fit no rule and are allowed. A null html has no links. Repeated rows count each. An empty table gives no
    rows; other columns are not read.
    """
    urls = pages.select("page_id", *host_and_path())
    hosts = urls.groupBy("host").agg(F.count(F.lit(1)).alias("pages"))
    of_host = stage(host_rules(hosts.where("host <> ''"), rules), "host-rules")
    hit = with_rules(urls, of_host)
    counted = hit.groupBy("host").agg(
        F.count(F.lit(1)).alias("pages"),
        F.count_if(F.col("hit.verdict") == "allow").alias("allowed"),
        F.count_if(F.col("hit.verdict") == "block").alias("blocked"),
    )
    counted = stage(counted.where("host <> ''"), "hosts")
    links = stage(host_links(pages), "host-links")
    trusted = counted.where("2 * allowed > pages").select("host", F.col("allowed").alias("weight"))
    blocked = counted.where("2 * blocked > pages").select("host", F.col("blocked").alias("weight"))
    backwards = links.select(F.col("target").alias("source"), F.col("source").alias("target"), "pages")
    trust = propagated(links, trusted).withColumnRenamed("score", "trust")
    distrust = propagated(backwards, blocked).withColumnRenamed("score", "distrust")
    scored = counted.select("host").join(trust, "host", "left").join(distrust, "host", "left").join(of_host, "host", "left")
    scored = stage(scored.fillna(0, ["trust", "distrust"]), "host-scores")
    bad = (F.col("distrust") >= LEAST_DISTRUST) & (F.col("distrust") > TIMES_TRUST * F.col("trust"))
    verdict = F.coalesce("hit.verdict", F.when(bad, "block").otherwise("allow"))
    return with_rules(urls, scored).select(
        "page_id",
        "host",
        "path",
        F.col("hit.rule").alias("rule"),
        verdict.alias("verdict"),
        F.coalesce("trust", F.lit(0)).alias("trust"),
        F.coalesce("distrust", F.lit(0)).alias("distrust"),
    )
