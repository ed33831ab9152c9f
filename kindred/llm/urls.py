"""URL filters: rules, and trust and distrust propagated over the host graph.

Hosts with pages that a rule allows are seeds of trust, hosts with blocked pages seeds of distrust,
each as strong as the share of its pages. Trust follows the edges between hosts, distrust goes against
them, both as personalised PageRank with restart. A host is blocked where its distrust exceeds its trust
by a threshold; a page without a rule gets its host's verdict.

Edges are the links of the pages that name a host, once per pair of hosts, and those along a host's name:
every host is linked both ways with its name without the first label, and so on down to two labels, whether
or not these names have pages themselves. So ``blog.x.example.net`` and ``m.x.example.net`` meet, and all of
``net`` does not. All is integer arithmetic, so sums do not depend on their order. Rounds go on until what is
still to come to all hosts together is at most ``TOLERANCE``, but for rounding; the SQL of ``oracle`` takes
``ROUNDS`` rounds. Pages are reduced to hosts and pairs of hosts before anything is shuffled twice; a round
moves one row per edge, partially summed, and its join is split by adaptive execution where one host has very
many edges.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kindred.llm.tables import Scratch


class Rule(NamedTuple):
    host: str
    path: str
    verdict: str


# The rules.
RULES = [
    Rule("net", "/", "block"),
    Rule("example.net", "/en/", "allow"),
    Rule("example.com", "/de/", "block"),
    Rule("org", "/fr/", "allow"),
]
UNIT = 100_000_000  # mass of a seed all of whose pages are seeds
ROUNDS = 88  # of the SQL: 100 hosts' whole mass falls below TOLERANCE
STEP = 4  # rounds between two looks at the change
DAMPING = 85  # percent of a host's mass that goes on along its edges
THRESHOLD = 7_500_000  # of distrust over trust: half of what a host keeps that is blocked as a whole
TOLERANCE = THRESHOLD // 1000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SPREAD = 16  # tasks that the pages of one host meet its verdict in
LINK = r"""(?i)href\s*=\s*["']?\s*(?:[a-z][a-z0-9+.-]*:)?//([^/?#"'\s<>]+)"""


def with_parts(pages: DataFrame) -> DataFrame:
    """Columns page_id, host, path, html; host and path are empty for a url that is null or has no ``://``."""

    def part(group: int) -> Column:
        return F.coalesce(F.regexp_extract(F.col("url"), r"(?s)^.*?://([^/?#]*)([^?#]*)", group), F.lit(""))

    return pages.select("page_id", F.translate(part(1), UPPER, LOWER).alias("host"), part(2).alias("path"), "html")


def rule_of(rules: list[Rule], host: Column, path: Column) -> Column:
    """The longest rule that fits, as a struct of its text and verdict; null if none does."""
    out = F.lit(None).cast("struct<rule: string, verdict: string>")
    for r in sorted(rules, key=lambda r: (len(r.host + r.path), r.host + r.path)):
        fits = ((host == r.host) | host.endswith(f".{r.host}")) & path.startswith(r.path)
        out = F.when(fits, F.struct(F.lit(r.host + r.path).alias("rule"), F.lit(r.verdict).alias("verdict"))).otherwise(out)
    return out


def host_edges(parts: DataFrame, hosts: DataFrame) -> DataFrame:
    """Distinct pairs src, dst of hosts: links of pages, and a host with the shorter names it ends in both ways."""
    links = parts.select(
        F.col("host").alias("src"),
        F.explode(F.array_distinct(F.regexp_extract_all("html", F.lit(LINK), 1))).alias("dst"),
    ).select("src", F.translate("dst", UPPER, LOWER).alias("dst"))
    labels = F.split("host", r"\.")
    at = F.sequence(F.lit(1), F.size("labels") - 2)
    steps = hosts.select(labels.alias("labels")).filter(F.size("labels") > 2).select("labels", F.explode(at).alias("i"))

    def name(start: Column) -> Column:
        return F.concat_ws(".", F.slice("labels", start, F.size("labels")))

    steps = steps.select(name(F.col("i")).alias("host"), name(F.col("i") + 1).alias("parent"))
    up = steps.select(F.col("host").alias("src"), F.col("parent").alias("dst"))
    down = steps.select(F.col("parent").alias("src"), F.col("host").alias("dst"))
    edges = links.unionByName(up).unionByName(down)
    return edges.filter("src <> dst AND src <> '' AND dst <> ''").distinct()


def propagate(
    seeds: DataFrame, edges: DataFrame, scratch: Scratch, damping: int = DAMPING, tolerance: int = TOLERANCE
) -> DataFrame:
    """Mass of each side and host in the end; seeds and masses as side, host, mass.

    Side 0 follows the edges and side 1 goes against them. Each round a host passes ``damping`` percent
    of its mass on in equal parts, and the seeds give the rest anew. The first masses are what the seeds
    give, so no mass ever falls, and each ``STEP`` rounds add at most damping**STEP of what the last ones did.
    """
    both = edges.select(F.lit(0).alias("side"), F.col("src").alias("host"), F.col("dst").alias("to")).unionByName(
        edges.select(F.lit(1).alias("side"), F.col("dst").alias("host"), F.col("src").alias("to"))
    )
    degrees = both.groupBy("side", "host").agg(F.count(F.lit(1)).alias("degree"))
    arcs = scratch.keep(both.join(degrees, ["side", "host"]))
    restart = seeds.select("side", "host", F.expr(f"mass * {100 - damping} div 100").alias("mass"))
    mass, total, share = restart, restart.agg(F.sum("mass")).first()[0] or 0, damping**STEP
    while True:
        before = mass
        for _ in range(STEP):
            passed = arcs.join(mass, ["side", "host"]).select(
                "side", F.col("to").alias("host"), F.expr(f"(mass div degree) * {damping} div 100").alias("mass")
            )
            mass = restart.unionByName(passed).groupBy("side", "host").agg(F.sum("mass").alias("mass"))
        mass = scratch.keep(mass)
        scratch.drop(before)
        last, total = total, mass.agg(F.sum("mass")).first()[0] or 0
        if (total - last) * share <= tolerance * (100**STEP - share):
            return mass


def judge(
    pages: DataFrame, rules: list[Rule] = RULES, damping: int = DAMPING, threshold: int = THRESHOLD, tolerance: int = TOLERANCE
) -> DataFrame:
    """Every row of ``pages`` (page_id, url, html) with host, path, rule and verdict.

    A url without host gets the verdict allow, as does any host that nothing speaks against. Ids may be
    null or repeat, and repeated rows are pages of their own; html may be null and of any length; other columns are
    ignored, whatever their names; an empty table gives no rows.
    """
    scratch = Scratch(pages.sparkSession)
    parts = with_parts(pages).withColumn("found", rule_of(rules, F.col("host"), F.col("path")))
    count = F.count(F.lit(1))
    hosts = scratch.keep(
        parts.filter("host <> ''")
        .groupBy("host")
        .agg(
            count.alias("pages"),
            F.count_if(F.col("found.verdict") == "allow").alias("allowed"),
            F.count_if(F.col("found.verdict") == "block").alias("blocked"),
        )
    )
    seeds = hosts.select(
        "host", F.posexplode(F.array(*[F.expr(f"{UNIT} * {c} div pages") for c in ("allowed", "blocked")])).alias("side", "mass")
    ).filter("mass > 0")
    mass = propagate(seeds, host_edges(parts, hosts), scratch, damping, tolerance)
    against = (
        mass.groupBy("host")
        .agg(F.sum(F.when(F.col("side") == 1, F.col("mass")).otherwise(-F.col("mass"))).alias("distrust"))
        .filter(F.col("distrust") > threshold)
        .select("host", F.lit(True).alias("distrusted"))
    )
    # one host may have a third of all pages: they are dealt out, and the verdicts of hosts, far fewer, copied
    against = against.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(SPREAD - 1))))
    dealt = parts.withColumn("part", F.pmod(F.xxhash64("page_id", "path"), F.lit(SPREAD)).cast("int"))
    return dealt.join(against, ["host", "part"], "left").select(
        "page_id",
        "host",
        "path",
        F.col("found.rule").alias("rule"),
        F.coalesce("found.verdict", F.when(F.col("distrusted"), "block").otherwise("allow")).alias("verdict"),
    )


def oracle(rules: list[Rule] = RULES, rounds: int = ROUNDS, damping: int = DAMPING, threshold: int = THRESHOLD) -> str:
    """The same in SQL over the table ``pages``."""
    ordered = sorted(rules, key=lambda r: -len(r.host + r.path))
    fits = [
        f"WHEN (host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}') THEN " for r in ordered
    ]
    rule = "CASE " + " ".join(f"{f}'{r.host}{r.path}'" for f, r in zip(fits, ordered)) + " END"
    verdict = "CASE " + " ".join(f"{f}'{r.verdict}'" for f, r in zip(fits, ordered)) + " END"
    link = LINK.replace("'", "''")
    steps = "".join(
        f""",
mass{i} AS MATERIALIZED (SELECT side, host, sum(mass)::BIGINT AS mass FROM (
  SELECT side, host, mass FROM mass0
  UNION ALL
  SELECT a.side, a.dst, (m.mass // d.degree) * {damping} // 100
  FROM arcs a JOIN mass{i - 1} m ON a.side = m.side AND a.src = m.host JOIN degrees d ON a.side = d.side AND a.src = d.src)
  GROUP BY ALL)"""
        for i in range(1, rounds + 1)
    )
    return f"""
WITH cut AS (
  SELECT page_id, html, translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), ''), '{UPPER}', '{LOWER}') AS host,
         coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') AS path
  FROM pages),
parts AS (SELECT *, {rule} AS rule, {verdict} AS found FROM cut),
hosts AS (
  SELECT host, count(*) AS pages, count(*) FILTER (found = 'allow') AS allowed, count(*) FILTER (found = 'block') AS blocked
  FROM parts WHERE host <> '' GROUP BY host),
names AS (SELECT string_split(host, '.') AS labels FROM hosts),
parents AS (
  SELECT array_to_string(labels[i:], '.') AS host, array_to_string(labels[i + 1:], '.') AS parent
  FROM (SELECT labels, unnest(range(1, len(labels) - 1)) AS i FROM names)),
edges AS (
  SELECT DISTINCT src, dst FROM (
    SELECT host AS src, translate(unnest(regexp_extract_all(html, '{link}', 1)), '{UPPER}', '{LOWER}') AS dst FROM parts
    UNION ALL SELECT host, parent FROM parents UNION ALL SELECT parent, host FROM parents)
  WHERE src <> dst AND src <> '' AND dst <> ''),
arcs AS (SELECT 0 AS side, src, dst FROM edges UNION ALL SELECT 1, dst, src FROM edges),
degrees AS (SELECT side, src, count(*) AS degree FROM arcs GROUP BY ALL),
mass0 AS (
  SELECT 0 AS side, host, ({UNIT} * allowed // pages) * {100 - damping} // 100 AS mass FROM hosts WHERE allowed > 0
  UNION ALL SELECT 1, host, ({UNIT} * blocked // pages) * {100 - damping} // 100 FROM hosts WHERE blocked > 0){steps},
against AS (
  SELECT host FROM mass{rounds} GROUP BY host
  HAVING sum(CASE WHEN side = 1 THEN mass ELSE -mass END) > {threshold})
SELECT page_id, host, path, rule,
       coalesce(found, CASE WHEN host IN (SELECT host FROM against) THEN 'block' ELSE 'allow' END) AS verdict
FROM parts"""
