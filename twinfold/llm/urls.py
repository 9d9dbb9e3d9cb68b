"""URL verdicts: rules first, else trust and distrust propagated over the graph of hosts.

Hosts are joined by the links of their pages, and each host by the domain above it (both ways), which ties a site's
subdomains together. Trust starts at the hosts whose pages an allow rule fits and runs along the edges (personalised
PageRank); distrust starts at the hosts with blocked pages and runs against them. A host is blocked where its share
of all distrust is above its share of all trust; a host that neither reaches is allowed.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from twinfold.llm.common import stage, with_kept

DAMPING = 0.85
#: Rounds between two looks at the change, and the change, as a share of all scores, at which propagation ends.
ROUNDS = 6
TOLERANCE = 0.01
#: Links with a host; one without a scheme has that of its page. Others lead to the page's own host.
LINK = r"""(?i)(?:href|src)\s*=\s*["']?((?:[a-z][a-z0-9+.-]*:)?//[^"'\s>]+)"""


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path

    def fits(self, host: Column, path: Column) -> Column:
        under = (host == self.host) | host.endswith("." + self.host)
        return under & path.startswith(self.path)


#: The rules of the registered query.
RULES = (
    Rule("com", "/", "allow"),
    Rule("example.com", "/en/", "block"),
    Rule("www.example.com", "/en/", "allow"),
    Rule("net", "/es/", "block"),
    Rule("net", "/fr/", "block"),
)


def host_of(url: Column) -> Column:
    at = F.instr(url, "://")
    rest = F.substring(url, at + 3, F.length(url))
    host = F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.when(at > 0, host).otherwise("")


def path_of(url: Column) -> Column:
    at = F.instr(url, "://")
    rest = F.substring(url, at + 3, F.length(url))
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.when(at > 0, path).otherwise("")


def rule_columns(host: Column, path: Column, rules: tuple[Rule, ...]) -> tuple[Column, Column]:
    """Name and verdict of the longest rule that fits; null where none does."""
    name = verdict = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: len(r.name)):
        fits = rule.fits(host, path)
        name, verdict = F.when(fits, rule.name).otherwise(name), F.when(fits, rule.verdict).otherwise(verdict)
    return name, verdict


def host_edges(pages: DataFrame) -> DataFrame:
    """Weighted edges (src, dst, weight) from links between hosts (host, html) and from the domains above hosts."""
    link = F.explode(F.array_distinct(F.regexp_extract_all("html", F.lit(LINK), F.lit(1))))
    links = pages.select(F.col("host").alias("src"), link.alias("url"))
    links = links.withColumn("url", F.when(F.startswith("url", F.lit("//")), F.concat(F.lit("x:"), "url")).otherwise(F.col("url")))
    links = links.select("src", host_of(F.col("url")).alias("dst")).filter("dst <> '' and src <> '' and src <> dst")
    links = links.groupBy("src", "dst").agg(F.count("*").cast("double").alias("weight"))
    above = F.explode(F.expr("transform(sequence(1, greatest(size(split(host, '[.]')) - 2, 1)), i -> "
                             "array_join(slice(split(host, '[.]'), i + 1, 64), '.'))"))
    names = pages.select("host").union(links.select("dst")).filter("host <> ''").distinct()
    names = names.union(names.filter("size(split(host, '[.]')) > 2").select(above.alias("host"))).distinct()
    up = names.filter("size(split(host, '[.]')) > 2").select(
        F.col("host").alias("src"), F.regexp_replace("host", r"^[^.]*\.", "").alias("dst"), F.lit(1.0).alias("weight")
    )
    down = up.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "weight")
    return links.union(up).union(down).groupBy("src", "dst").agg(F.sum("weight").alias("weight"))


def propagate(edges: DataFrame, seeds: DataFrame, damping: float = DAMPING, tolerance: float = TOLERANCE) -> DataFrame:
    """Personalised PageRank: (kind, host, score) from edges (kind, src, dst, weight) and seeds (kind, host, seed).

    Seeds of a kind add up to 1, and so do the scores. What hosts without edges hold goes back to the seeds: that makes
    the same scores but for a common factor, so the sum is set at the end. Rounds run ``ROUNDS`` at a time, until these
    change the scores of no kind by more than ``tolerance`` of their sum; each round changes them by less than
    ``damping`` times the one before, so they do end.
    """
    out = edges.groupBy("kind", "src").agg(F.sum("weight").alias("total"))
    edges = edges.join(out, ["kind", "src"]).select("kind", "src", "dst", (F.col("weight") / F.col("total")).alias("part"))
    edges, seeds = stage(edges, "edges"), stage(seeds.select("kind", "host", "seed"), "seeds")
    restart = seeds.select("kind", "host", (F.col("seed") * (1 - damping)).alias("score"))
    score, change = seeds.select("kind", "host", F.col("seed").alias("score")), 1.0
    while change > tolerance:
        new = score
        for _ in range(ROUNDS):
            sent = edges.join(new.withColumnRenamed("host", "src"), ["kind", "src"])
            sent = sent.select("kind", F.col("dst").alias("host"), (F.col("score") * F.col("part") * damping).alias("score"))
            new = sent.union(restart).groupBy("kind", "host").agg(F.sum("score").alias("score"))
        both = new.withColumn("old", F.lit(0.0)).union(score.select("kind", "host", F.lit(0.0), "score"))
        both = stage(both.groupBy("kind", "host").agg(F.sum("score").alias("score"), F.sum("old").alias("old")), "scores")
        # a row for each kind
        moved = F.sum(F.abs(F.col("score") - F.col("old"))) / F.sum("score")
        change = max((r[0] for r in both.groupBy("kind").agg(moved.alias("moved")).select("moved").collect()), default=0.0)
        score = both.select("kind", "host", "score")
    total = score.groupBy("kind").agg(F.sum("score").alias("total"))
    return score.join(total, "kind").select("kind", "host", (F.col("score") / F.col("total")).alias("score"))


def judge_pages(pages: DataFrame, *keep: str, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Host, path, rule and verdict of each row of ``pages`` (url, html and the columns ``keep``).

    A null url or one without ``://`` has an empty host and path, fits no rule and is allowed. Null html has no links.
    """
    rows = with_kept(pages, ["url", "html"], keep)
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    rows = rows.withColumn("host", F.coalesce(host, F.lit(""))).withColumn("path", F.coalesce(path, F.lit("")))
    name, verdict = rule_columns(F.col("host"), F.col("path"), rules)
    ruled = rows.withColumn("rule", name).withColumn("ruled", verdict)
    kind = F.when(F.col("ruled") == "allow", "trust").when(F.col("ruled") == "block", "distrust")
    seeds = ruled.filter("host <> '' and ruled is not null").groupBy(kind.alias("kind"), "host").agg(
        F.count("*").cast("double").alias("n")
    )
    seeds = stage(seeds, "seeds")
    total = seeds.groupBy("kind").agg(F.sum("n").alias("total"))
    seeds = seeds.join(total, "kind").select("kind", "host", (F.col("n") / F.col("total")).alias("seed"))
    edges = stage(host_edges(rows.select("host", "html")), "links")
    ahead = edges.select(F.lit("trust").alias("kind"), "src", "dst", "weight")
    back = edges.select(F.lit("distrust").alias("kind"), F.col("dst").alias("src"), F.col("src").alias("dst"), "weight")
    score = propagate(ahead.union(back), seeds)
    of = lambda k: F.sum(F.when(F.col("kind") == k, F.col("score")).otherwise(0.0))
    hosts = score.groupBy("host").agg(of("trust").alias("trust"), of("distrust").alias("distrust"))
    judged = ruled.drop("html").join(hosts, "host", "left").fillna(0.0, ["trust", "distrust"])
    own = F.when(F.col("distrust") > F.col("trust"), "block").otherwise("allow")
    shown = ["url", "host", "path", "rule", "verdict", "trust", "distrust"]
    judged = judged.withColumn("verdict", F.coalesce("ruled", own))
    return judged.select(*[f"kept{i}" for i in range(len(keep))], *shown).toDF(*keep, *shown)
