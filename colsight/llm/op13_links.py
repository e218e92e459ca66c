"""URL filter: rules on hosts and paths, and for what no rule fits, trust over the graph of hosts.

Hosts are joined where a page of one links to the other. A host's teleport mass is split by what the
rules say of its pages: the allowed share seeds trust, the blocked share seeds distrust, the rest
is undecided. Trust is personalised PageRank along the links (whom trusted hosts link to), distrust
the same against them (who links to blocked hosts). A host is blocked where distrust is at least
`threshold` percent of trust, distrust and undecided mass together.

Masses are whole numbers and what a host passes on is divided by its links rounding down, so results
don't depend on the order of sums, on lost executors or on the number of tasks. A round handles only
the mass that arrived in the round before; it ends when none is left, at the latest after `rounds`
(0.85 ** 30 < 1 % is still on its way then). What a host without links would pass on is lost.

A rule (verdict, host, path) fits its host and all subdomains where the path starts with its path; the
longest host + path wins, of equal ones the longer host. Rules with a null or empty host fit nothing.
Null urls and urls without `://` have an empty host, which is no host: allowed. Links count from
whole pages, comments and scripts left out, once for each pair of hosts; links inside a host say
nothing. Equal rows and rows without page_id are judged each; null html has no links. Columns other
than page_id, url and html are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from colsight.llm.common import stage

# --- fixed values: the production rules -----------------------------------------------------------
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
HIDDEN = r"(?is)<!--.*?(?:-->|\z)|<script\b.*?(?:</script|\z)|<style\b.*?(?:</style|\z)"
HREF = r"""(?i)<a\s(?:[^<>]*?\s)?href\s*=\s*["']?\s*((?:[a-z][a-z0-9+.-]*:)?//[^"'<>\s]+)"""

MASS = 10**12  # teleport mass of a host
DAMPING = (17, 20)
ROUNDS, THRESHOLD = 30, 50


def host_of(url: Column) -> Column:
    """After the first `://` up to `/`, `?`, `#` or the end; empty without it."""
    return F.translate(F.regexp_extract(url, r"^(?s:.*?)://([^/?#]*)", 1), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(url, r"^(?s:.*?)://[^/?#]*([^?#]*)", 1)


def rules_table(spark: SparkSession, rules: Iterable[tuple[str, str, str]] = RULES) -> DataFrame:
    return spark.createDataFrame(list(rules), "verdict string, host string, path string")


def addresses(pages: DataFrame) -> DataFrame:
    """(page_id, host, path) of every page."""
    url = F.coalesce(F.col("url").cast("string"), F.lit(""))
    return pages.select(F.col("page_id").cast("bigint").alias("page_id"), host_of(url).alias("host"), path_of(url).alias("path"))


def by_rule(places: DataFrame, rules: DataFrame) -> DataFrame:
    """(host, path, n, rule, said): distinct places with the number of their pages and the rule that wins.

    A place meets rules on the host's endings, so the rules may be many; Spark broadcasts them if
    they are small and splits a hot ending (`com`) if they aren't.
    """
    labels = F.split("host", r"\.")
    endings = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    distinct = places.groupBy("host", "path").agg(F.count(F.lit(1)).alias("n"))
    known = rules.where("host <> '' AND path IS NOT NULL AND verdict IS NOT NULL").select(
        F.col("host").alias("ending"), F.col("path").alias("start"), "verdict"
    )
    best = F.max(F.struct(F.length(F.concat("ending", "start")).alias("size"), F.length("ending").alias("l"), F.concat("ending", "start").alias("rule"), F.col("verdict").alias("said")))
    fit = distinct.where("host <> ''").select("host", "path", F.explode(endings).alias("ending")).join(known, "ending")
    won = fit.where(F.col("path").startswith(F.col("start"))).groupBy("host", "path").agg(best.alias("won"))
    return distinct.join(won, ["host", "path"], "left").select("host", "path", "n", "won.rule", "won.said")


def host_edges(pages: DataFrame) -> DataFrame:
    """(source, target): distinct pairs of different hosts, a link between them on some page."""
    url = F.coalesce(F.col("url").cast("string"), F.lit(""))
    seen = F.regexp_replace(F.col("html").cast("string"), HIDDEN, " ")
    hrefs = F.array_distinct(F.transform(F.regexp_extract_all(seen, F.lit(HREF), F.lit(1)), lambda x: host_of(F.concat(F.lit(":"), x))))
    links = pages.select(host_of(url).alias("source"), F.explode(hrefs).alias("target"))
    return links.where("source <> '' AND target <> '' AND source <> target").distinct()


def seeds(judged: DataFrame, mass: int = MASS) -> DataFrame:
    """(host, allowed, blocked, undecided): the teleport mass split by the host's pages."""
    out = judged.where("host <> ''").groupBy("host").agg(
        F.sum("n").cast("decimal(38,0)").alias("n"),
        *[F.coalesce(F.sum(F.when(F.col("said") == said, F.col("n"))), F.lit(0)).cast("decimal(38,0)").alias(said) for said in ("allow", "block")],
    )
    return out.selectExpr(
        "host", f"CAST({mass} * allow DIV n AS BIGINT) AS allowed", f"CAST({mass} * block DIV n AS BIGINT) AS blocked"
    ).withColumn("undecided", F.lit(mass).cast("bigint") - F.col("allowed") - F.col("blocked"))


def propagated(seed: DataFrame, edges: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """(host, kind, mass): kind 0 trust along the edges, kind 1 distrust against them.

    The mass of a round is written to the shared folder before the next reads it: one join on the
    sender, one sum by receiver combined on the map side.
    """
    num, den = DAMPING
    both = edges.select(F.lit(0).alias("kind"), F.col("source").alias("host"), F.col("target").alias("to"))
    both = both.unionByName(edges.select(F.lit(1).alias("kind"), F.col("target").alias("host"), F.col("source").alias("to")))
    degree = both.groupBy("kind", "host").agg(F.count(F.lit(1)).alias("degree"))
    roads = stage(both.join(degree, ["kind", "host"]))
    pushed = F.expr("stack(2, 0, allowed, 1, blocked) AS (kind, mass)")
    kept = f"CAST(mass - mass DIV {den} * {num} AS BIGINT)"  # a host keeps what it doesn't pass on
    moving = stage(seed.select("host", pushed).where("mass > 0"))
    parts = [moving.selectExpr("host", "kind", f"{kept} AS mass")]
    for _ in range(rounds):
        passed = moving.join(roads, ["kind", "host"]).groupBy("kind", F.col("to").alias("host")).agg(F.sum(F.expr(f"mass DIV {den} * {num} DIV degree")).alias("mass"))
        moving = stage(passed.where("mass > 0").select("host", "kind", "mass"))
        if moving.isEmpty():
            break
        parts.append(moving.selectExpr("host", "kind", f"{kept} AS mass"))
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole.groupBy("host", "kind").agg(F.sum("mass").alias("mass"))


def host_verdicts(judged: DataFrame, edges: DataFrame, rounds: int = ROUNDS, threshold: int = THRESHOLD) -> DataFrame:
    """(host, trust, distrust, undecided, blocked) of every host that has pages."""
    num, den = DAMPING
    seed = stage(seeds(judged))
    mass = propagated(seed, edges, rounds).groupBy("host").agg(
        *[F.sum(F.when(F.col("kind") == k, F.col("mass"))).alias(name) for k, name in enumerate(("t", "d"))]
    )
    out = seed.join(mass, "host", "left").select(
        "host", F.coalesce("t", F.lit(0)).alias("trust"), F.coalesce("d", F.lit(0)).alias("distrust"), F.expr(f"undecided - undecided DIV {den} * {num}").alias("undecided")
    )
    whole = (F.col("trust") + F.col("distrust") + F.col("undecided")).cast("decimal(38,0)")
    return out.withColumn("blocked", (F.col("distrust") > 0) & (F.col("distrust").cast("decimal(38,0)") * 100 >= whole * threshold))


def judge(pages: DataFrame, rules: DataFrame | None = None, rounds: int = ROUNDS, threshold: int = THRESHOLD) -> DataFrame:
    """(page_id, host, path, rule, verdict, trust, distrust) of every page's url."""
    places = addresses(pages)
    judged = stage(by_rule(places, rules_table(pages.sparkSession) if rules is None else rules))
    hosts = host_verdicts(judged, host_edges(pages), rounds, threshold)
    said = judged.select("host", "path", "rule", "said").join(hosts.select("host", "trust", "distrust", "blocked"), "host", "left")
    verdict = F.coalesce("said", F.when(F.col("blocked"), "block").otherwise("allow"))
    return places.join(said.withColumn("verdict", verdict), ["host", "path"]).select("page_id", "host", "path", "rule", "verdict", "trust", "distrust")
