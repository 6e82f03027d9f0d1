"""URL rules, and verdicts for the rest by propagation over the graph of hosts.

Hosts most of whose pages the rules allow are trusted, hosts most of whose pages they block are
not.  Trust follows the links (a personalised PageRank that starts at the trusted hosts), distrust
goes against them (the same from the blocked hosts over reversed edges): who links to bad hosts is
suspect.  A host is blocked if distrust makes up more than the threshold of both.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from itertools import count

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from jobsignal.llm.tables import stored

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
HOST = r"://([^/?#]*)"
PATH = r"://[^/?#]*([^?#]*)"
#: The host of a link that names one; relative links stay on their host.
LINKED_HOST = r"""(?i)\bhref\s*=\s*["']?(?:[a-z][a-z0-9+.-]*:)?//([^/?#"'\s<>]+)"""


@dataclass(frozen=True)
class UrlRule:
    """Fits a host and its subdomains where the url's path starts with `path`."""

    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


# The rules of the contract.
RULES = (
    UrlRule("allow", "com", "/"),
    UrlRule("block", "example.com", "/en/"),
    UrlRule("allow", "www.example.com", "/en/"),
    UrlRule("block", "net", "/es/"),
    UrlRule("block", "net", "/fr/"),
)


@dataclass(frozen=True)
class Propagation:
    """`chunk` steps make one job; the scores are written down after each.

    After `steps` steps they go on until no score changes by more than `tolerance` of itself in a
    chunk.  The SQL, whose steps are written out, ends after `steps`.
    """

    damping: float = 0.85
    steps: int = 10
    chunk: int = 5
    tolerance: float = 1e-6
    threshold: float = 0.5


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, HOST, 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, PATH, 1), F.lit(""))


def fits(rule: UrlRule, host: Column, path: Column) -> Column:
    return ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)


def by_rules(pages: DataFrame, rules: Sequence[UrlRule] = RULES) -> DataFrame:
    """page_id, host, path, and the longest rule that fits with its verdict, else nulls."""
    placed = pages.select("page_id", host_of(F.col("url")).alias("host"),
                          path_of(F.col("url")).alias("path"))
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: len(r.name)):
        fit = fits(r, F.col("host"), F.col("path"))
        rule = F.when(fit, r.name).otherwise(rule)
        verdict = F.when(fit, r.verdict).otherwise(verdict)
    return placed.withColumn("rule", rule).withColumn("rule_verdict", verdict)


def host_edges(pages: DataFrame, hosts: DataFrame) -> DataFrame:
    """(src, dst, weight): links between different hosts, and between a host and its parent.

    The weight is the number of links.  A host and the domain above it, if that is a host as well,
    are connected both ways with weight 1.  Links are counted per task before they are shuffled.
    """
    linked = pages.select(
        host_of(F.col("url")).alias("src"),
        F.explode(F.regexp_extract_all("html", F.lit(LINKED_HOST), 1)).alias("dst")) \
        .withColumn("dst", F.translate("dst", UPPER, LOWER)) \
        .filter("src <> '' AND src <> dst").groupBy("src", "dst") \
        .agg(F.count("*").cast("double").alias("weight"))
    parents = hosts.filter("host LIKE '%.%'").select(
        F.col("host").alias("src"),
        F.expr("substr(host, instr(host, '.') + 1)").alias("dst")) \
        .join(hosts.select(F.col("host").alias("dst")), "dst", "left_semi") \
        .withColumn("weight", F.lit(1.0)).select("src", "dst", "weight")
    both = parents.union(parents.select("dst", "src", "weight"))
    return linked.union(both).groupBy("src", "dst").agg(F.sum("weight").alias("weight"))


def settled(before: DataFrame, after: DataFrame, how: Propagation) -> bool:
    """Whether no score of `after` moved by more than the tolerance; new hosts have moved.

    Near the smallest doubles, below 1e-300, a score has too few digits left to be compared.
    """
    moved = F.abs(F.col("score") - F.coalesce("old", F.lit(0.0)))
    return after.join(before.withColumnRenamed("score", "old"), ["host", "kind"], "left") \
        .filter(moved > how.tolerance * F.col("score") + 1e-300).isEmpty()


def scores(edges: DataFrame, seeds: DataFrame, how: Propagation = Propagation()) -> DataFrame:
    """(host, kind, score) from `seeds` (host, kind, start), after steps until they settle.

    Kind "trust" goes along the edges and "distrust" against them; both are one table, so that a
    step is one join and one sum.  What reaches a host without edges stays there.
    """
    forward = edges.select(F.col("src").alias("from"), F.col("dst").alias("to"), "weight",
                           F.lit("trust").alias("of"))
    back = edges.select(F.col("dst").alias("from"), F.col("src").alias("to"), "weight",
                        F.lit("distrust").alias("of"))
    flow = forward.union(back)
    out = flow.groupBy("from", "of").agg(F.sum("weight").alias("all"))
    flow = stored(flow.join(out, ["from", "of"])
                  .select("from", "to", "of", (F.col("weight") / F.col("all")).alias("share")),
                  "host_flow")
    fixed = seeds.select("host", "kind", ((1 - how.damping) * F.col("start")).alias("score"))
    state = seeds.select("host", "kind", F.col("start").alias("score"))
    before = state
    for step in count(1):
        moved = state.join(flow, (F.col("host") == F.col("from")) & (F.col("kind") == F.col("of"))) \
            .select(F.col("to").alias("host"), "kind",
                    (how.damping * F.col("score") * F.col("share")).alias("score"))
        state = moved.union(fixed).groupBy("host", "kind").agg(F.sum("score").alias("score"))
        if step % how.chunk == 0:
            state = stored(state, "host_scores")
            if step >= how.steps and settled(before, state, how):
                return state
            before = state


def seed_hosts(judged: DataFrame) -> DataFrame:
    """(host, kind, start): hosts that the rules mostly allow or mostly block.

    A host's start is its share of the pages that the rules decided so on such hosts.
    """
    def of(verdict: str) -> Column:
        return F.count(F.when(F.col("rule_verdict") == verdict, 1))

    counts = judged.filter("host <> ''").groupBy("host").agg(
        F.count("*").alias("pages"), of("allow").alias("allowed"), of("block").alias("blocked"))
    kind = F.when(2 * F.col("allowed") > F.col("pages"), "trust") \
        .when(2 * F.col("blocked") > F.col("pages"), "distrust")
    seeds = counts.select("host", kind.alias("kind"),
                          F.greatest("allowed", "blocked").cast("double").alias("n")) \
        .filter("kind IS NOT NULL")
    totals = seeds.groupBy("kind").agg(F.sum("n").alias("all"))  # two rows
    return seeds.join(F.broadcast(totals), "kind") \
        .select("host", "kind", (F.col("n") / F.col("all")).alias("start"))


def blocked_hosts(pages: DataFrame, judged: DataFrame,
                  how: Propagation = Propagation()) -> DataFrame:
    """(host,) of those whose distrust is more than the threshold of distrust and trust."""
    seeds = stored(seed_hosts(judged), "host_seeds")
    hosts = judged.filter("host <> ''").select("host").distinct()
    found = scores(stored(host_edges(pages, hosts), "host_edges"), seeds, how)

    def of(kind: str) -> Column:
        return F.coalesce(F.sum(F.when(F.col("kind") == kind, F.col("score"))), F.lit(0.0))

    # The share of distrust, as scores shrink when the table grows; its digits are those settled.
    share = F.round(F.try_divide("bad", F.col("bad") + F.col("good")), 6)
    return found.groupBy("host").agg(of("distrust").alias("bad"), of("trust").alias("good")) \
        .filter(share > how.threshold).select("host")


def judged_pages(pages: DataFrame, rules: Sequence[UrlRule] = RULES,
                 how: Propagation = Propagation()) -> DataFrame:
    """page_id, host, path, rule, verdict for each row of `pages` (page_id, url, html).

    Urls without "://", and null ones, have an empty host and path, fit no rule and are allowed, as
    are hosts that neither trust nor distrust reaches.  A null html has no links.
    """
    judged = stored(by_rules(pages, rules), "judged_urls")
    bad = blocked_hosts(pages, judged, how).select(F.col("host").alias("bad_host"))
    own = judged.join(bad, F.when(F.col("rule").isNull(), F.col("host")) == F.col("bad_host"),
                      "left")
    return own.select("page_id", "host", "path", "rule", F.coalesce(
        "rule_verdict", F.when(F.col("bad_host").isNotNull(), "block").otherwise("allow"))
        .alias("verdict"))


def op6_host_trust(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdicts for all `pages`; repeated rows alike, an empty table gives no rows."""
    return judged_pages(spark.read.parquet(f"{sf_dir}/pages.parquet")
                        .select("page_id", "url", "html"))


def _sql(rules: Sequence[UrlRule] = RULES, how: Propagation = Propagation()) -> str:
    """The same in DuckDB, one table per step."""
    longest = sorted(rules, key=lambda r: -len(r.name))

    def chosen(value: str) -> str:
        return "CASE " + " ".join(
            f"WHEN (host = '{r.host}' OR ends_with(host, '.{r.host}')) AND "
            f"starts_with(path, '{r.path}') THEN '{getattr(r, value)}'" for r in longest) + " END"

    linked = LINKED_HOST.replace("'", "''")
    steps = reduce(lambda a, k: a + f""",
s{k} AS MATERIALIZED (SELECT host, kind, sum(score) AS score FROM (
  SELECT f."to" AS host, kind, {how.damping} * score * share AS score
  FROM s{k - 1} JOIN flow f ON host = f."from" AND kind = f."of"
  UNION ALL SELECT host, kind, {1 - how.damping} * score FROM s0) GROUP BY ALL)""",
                   range(1, how.steps + 1), "")
    return f"""
WITH placed AS (
  SELECT page_id, html, translate(regexp_extract(coalesce(url, ''), '{HOST}', 1),
                                  '{UPPER}', '{LOWER}') AS host,
         regexp_extract(coalesce(url, ''), '{PATH}', 1) AS path FROM pages),
judged AS MATERIALIZED (
  SELECT *, {chosen('name')} AS rule, {chosen('verdict')} AS rule_verdict FROM placed),
counts AS (
  SELECT host, count(*) AS pages, count(*) FILTER (rule_verdict = 'allow') AS allowed,
         count(*) FILTER (rule_verdict = 'block') AS blocked
  FROM judged WHERE host <> '' GROUP BY host),
seeds AS (
  SELECT host, CASE WHEN 2 * allowed > pages THEN 'trust' WHEN 2 * blocked > pages THEN 'distrust'
               END AS kind, greatest(allowed, blocked) AS n FROM counts),
s0 AS MATERIALIZED (
  SELECT host, kind, n::DOUBLE / sum(n) OVER (PARTITION BY kind) AS score
  FROM seeds WHERE kind IS NOT NULL),
links AS (
  SELECT host AS src, translate(unnest(regexp_extract_all(html, '{linked}', 1)),
                                '{UPPER}', '{LOWER}') AS dst FROM judged),
parents AS (
  SELECT host AS src, substr(host, instr(host, '.') + 1) AS dst FROM counts WHERE host LIKE '%.%'
    AND substr(host, instr(host, '.') + 1) IN (SELECT host FROM counts)),
edges AS (
  SELECT src, dst, sum(weight) AS weight FROM (
    SELECT src, dst, 1.0::DOUBLE AS weight FROM links WHERE src <> '' AND src <> dst
    UNION ALL SELECT src, dst, 1.0 FROM parents UNION ALL SELECT dst, src, 1.0 FROM parents)
  GROUP BY ALL),
directed AS (
  SELECT src AS "from", dst AS "to", weight, 'trust' AS "of" FROM edges
  UNION ALL SELECT dst, src, weight, 'distrust' FROM edges),
flow AS MATERIALIZED (
  SELECT "from", "to", "of", weight / sum(weight) OVER (PARTITION BY "from", "of") AS share
  FROM directed){steps},
bad AS (
  SELECT host FROM s{how.steps} GROUP BY host
  HAVING round(coalesce(sum(score) FILTER (kind = 'distrust'), 0), 12) > {how.threshold} * (
         round(coalesce(sum(score) FILTER (kind = 'distrust'), 0), 12)
       + round(coalesce(sum(score) FILTER (kind = 'trust'), 0), 12)))
SELECT page_id, host, path, rule,
       coalesce(rule_verdict, CASE WHEN host IN (SELECT host FROM bad) THEN 'block' ELSE 'allow'
                              END) AS verdict
FROM judged"""


SQL = _sql()
