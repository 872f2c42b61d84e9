"""URL rules, and verdicts for other hosts by trust and distrust over the link graph.

A rule (host, path) fits its host and all subdomains where the url's path starts with the
rule's; the longest rule that fits wins. For urls without a rule the host decides. Hosts of
whose pages most are allowed by rules are trusted seeds, those of whose pages most are
blocked are blocked seeds. Trust runs along links from the trusted seeds, distrust
against them from the blocked ones (who links to a blocked host is suspect), both as
personalised PageRank: a share ``DAMPING`` of a host's rank goes along its edges by their
weight, the rest back to the seeds. A host is blocked if its distrust exceeds
``RATIO`` times its trust and ``LEAST`` times the mean seed's weight.

Links are absolute or host-relative addresses in ``href`` and ``src``. Pages are read once
for links, counted in the scan tasks, so a host of a third of all pages is a few rows.
Ranks are cut loose of their past every few rounds. Only small rows are shuffled.

Null urls and those without ``://`` have an empty host and path, no rule, and are allowed.
A null html has no links. A graph without links leaves seeds alone to be judged.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rulemark.llm.common import cut, query, table

#: The rules of the contract.
RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)
DAMPING, ROUNDS, CUT_EVERY = 0.85, 12, 4
#: Share of a host's pages that makes it a seed.
SEED_SHARE = 0.5
#: Distrust must exceed this multiple of trust, and this part of the mean seed's weight.
RATIO, LEAST = 1.0, 0.01
LINK = r"""(?i)(?:href|src)\s*=\s*["']?\s*(?:[a-z][a-z0-9+.-]*:)?//([^/?#"'\s>]+)"""


def ascii_lower(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.coalesce(F.instr(url, "://"), F.lit(0))
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    return ascii_lower(host), F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits, as text, and its verdict; null where none does."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for name, start, says in sorted(rules, key=lambda r: (len(r[0] + r[1]), r)):
        fits = ((host == name) | F.endswith(host, F.lit("." + name))) & F.startswith(path, F.lit(start))
        rule = F.when(fits, F.lit(name + start)).otherwise(rule)
        verdict = F.when(fits, F.lit(says)).otherwise(verdict)
    return rule, verdict


def judged(pages: DataFrame, rules=RULES) -> DataFrame:
    host, path = host_and_path(F.col("url"))
    named = pages.select("page_id", host.alias("host"), path.alias("path"))
    rule, says = rule_of(F.col("host"), F.col("path"), rules)
    return named.select("page_id", "host", "path", rule.alias("rule"), says.alias("says"))


def host_edges(pages: DataFrame) -> DataFrame:
    """``src``, ``dst``, ``n``: links between different hosts."""
    host, _ = host_and_path(F.col("url"))
    found = F.regexp_extract_all(F.coalesce("html", F.lit("")), F.lit(LINK), F.lit(1))
    links = pages.select(host.alias("src"), F.explode(found).alias("dst")).select("src", ascii_lower(F.col("dst")).alias("dst"))
    return links.filter("src != '' AND src != dst").groupBy("src", "dst").agg(F.count("*").alias("n"))


def seeds(rows: DataFrame) -> DataFrame:
    """``kind`` and ``host`` of the seeds."""
    share = rows.filter("host != ''").groupBy("host").agg(
        (F.count_if(F.col("says") == "allow") / F.count("*")).alias("trust"),
        (F.count_if(F.col("says") == "block") / F.count("*")).alias("distrust"),
    )
    kinds = F.expr("stack(2, 'trust', trust, 'distrust', distrust) AS (kind, share)")
    return share.select("host", kinds).filter(F.col("share") > SEED_SHARE).select("kind", "host")


def propagate(edges: DataFrame, start: DataFrame) -> DataFrame:
    """``kind``, ``host``, ``rank`` after ``ROUNDS`` of personalised PageRank."""
    both = edges.select(F.lit("trust").alias("kind"), F.col("src").alias("a"), F.col("dst").alias("b"), "n").union(
        edges.select(F.lit("distrust").alias("kind"), F.col("dst").alias("a"), F.col("src").alias("b"), "n")
    )
    sums = both.groupBy(F.col("kind").alias("_kind"), F.col("a").alias("_a")).agg(F.sum("n").alias("total"))
    weighted = both.join(sums, (F.col("kind") == F.col("_kind")) & (F.col("a") == F.col("_a")))
    weighted = cut(weighted.select(F.col("kind").alias("_kind"), F.col("a").alias("_a"), "b", (F.col("n") / F.col("total")).alias("w")))
    base = start.withColumn("rank", F.lit(1.0))
    ranks = base
    if weighted.isEmpty():
        return ranks
    for i in range(1, ROUNDS + 1):
        moved = ranks.join(weighted, (ranks["kind"] == weighted["_kind"]) & (ranks["host"] == weighted["_a"]))
        moved = moved.select("kind", F.col("b").alias("host"), (F.col("rank") * F.col("w") * DAMPING).alias("rank"))
        kept = base.withColumn("rank", F.lit(1 - DAMPING))
        ranks = moved.union(kept).groupBy("kind", "host").agg(F.sum("rank").alias("rank"))
        if i % CUT_EVERY == 0:
            ranks = cut(ranks)
    return ranks


def host_verdicts(pages: DataFrame, rows: DataFrame) -> DataFrame:
    """``host``, ``trust``, ``distrust``, ``verdict`` of the hosts that rank reached.

    Ranks are in units of a seed: a seed with nothing around it has rank 1 of its kind.
    """
    ranks = propagate(host_edges(pages), cut(seeds(rows)))
    of = lambda kind: F.coalesce(F.sum(F.when(F.col("kind") == kind, F.col("rank"))), F.lit(0.0))
    found = ranks.groupBy("host").agg(of("trust").alias("trust"), of("distrust").alias("distrust"))
    bad = (F.col("distrust") > RATIO * F.col("trust")) & (F.col("distrust") >= LEAST)
    return found.withColumn("verdict", F.when(bad, "block").otherwise("allow"))


def filter_urls(pages: DataFrame, rules=RULES) -> DataFrame:
    """One row per page: ``page_id``, ``host``, ``path``, ``rule``, ``verdict``, ``trust``, ``distrust``."""
    rows = cut(judged(pages, rules))
    hosts = cut(host_verdicts(pages, rows)).select(F.col("host").alias("_host"), "trust", "distrust", F.col("verdict").alias("by_host"))
    joined = rows.join(hosts, F.col("host") == F.col("_host"), "left")
    zero = F.lit(0.0)
    return joined.select(
        "page_id", "host", "path", "rule",
        F.coalesce("says", "by_host", F.lit("allow")).alias("verdict"),
        F.coalesce("trust", zero).alias("trust"),
        F.coalesce("distrust", zero).alias("distrust"),
    )


@query()
def op10_url_filter(spark, sf):
    return filter_urls(table(spark, sf, "pages"))
