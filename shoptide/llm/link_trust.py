"""URL verdicts by rules, and by trust spread over the host graph where no rule fits.

A rule is a host and a path prefix: it fits that host and its subdomains when the url's path starts
with the prefix; the longest rule wins. Pages that no rule fits get the verdict of their host: trust
starts at hosts by their pages that rules allow and follows links; distrust starts at hosts by their
pages that rules block and follows links backwards, to those that link to them. Both are
personalised PageRanks with damping ``DAMPING`` at their fixed point: steps run until no host's score
changes by more than ``TOLERANCE`` of itself, and the run fails when that takes more than ``MAX_STEPS``.
A host is blocked when its distrust is above its trust. A host that neither reaches is allowed.

Links are ``href`` targets of anchors: absolute ones lead to their host, others stay on the page's.
Pages are reduced to weighted host edges at once, counted per map task first, and steps run on those;
each step is one join on the host and one sum, written to the shared folder, and the largest change
is read back from there. What a host's links to itself give back is solved for, not iterated, so scores grow from
below with every step and a graph without cycles of several hosts settles after its longest path.

Defined cases: a null url, or one without ``://``, has an empty host and path and no rule; pages of
the empty host neither link nor seed and are allowed. Null html has no links. Repeated pages count as
often as they are there. Empty tables give no rows. All of it is built-in functions.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoptide.llm.common import LOWER, UPPER, cut, lower_ascii

DAMPING = 0.85
#: Largest change of a score, as a share of it, at which it counts as settled; below ``MARGIN``.
TOLERANCE = 1e-11
MAX_STEPS = 2000
#: The SQL alone stops after so many steps, which is the same where links stay on their host.
ROUNDS = 10
URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"
LINK = r"""(?i)<a\s[^>]*?href\s*=\s*["']([^"'>]*)["']"""
LINK_HOST = r"(?s)^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)"
#: Distrust is above trust when it is by this share of it, below which the order of a sum shows. Scores
#: shrink as the table grows, so no fixed number of decimals would do.
MARGIN = 1e-9
#: The SQL alone compares rounded scores, which is the same on tables of few ruled pages.
DECIMALS = 9


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path

    def fits(self, host: Column, path: Column) -> Column:
        below = (host == self.host) | F.endswith(host, F.lit(f".{self.host}"))
        return below & F.startswith(path, F.lit(self.path))


RULES = (
    Rule("block", "net", "/"),
    Rule("allow", "example.net", "/en/"),
    Rule("block", "example.com", "/de/"),
    Rule("allow", "org", "/fr/"),
)


def host_and_path(url: Column) -> dict[str, Column]:
    part = lambda i: F.coalesce(F.regexp_extract(url, URL, i), F.lit(""))
    return {"host": lower_ascii(part(1)), "path": part(2)}


def ruled(pages: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The pages with host, path, rule and the rule's verdict (both null where none fits)."""
    pages = pages.withColumns(host_and_path(F.col("url")))
    host, path = F.col("host"), F.col("path")
    longest = sorted(rules, key=lambda r: -len(r.text))
    pick = lambda value: F.coalesce(
        *[F.when(r.fits(host, path), F.lit(value(r))) for r in longest], F.lit(None).cast("string")
    )
    return pages.withColumns({"rule": pick(lambda r: r.text), "by_rule": pick(lambda r: r.verdict)})


def host_edges(pages: DataFrame) -> DataFrame:
    """Links between hosts: src, dst, n."""
    links = pages.where("host <> ''").select(
        F.col("host").alias("src"),
        F.explode(F.regexp_extract_all(F.coalesce("html", F.lit("")), F.lit(LINK), F.lit(1))).alias("to"),
    )
    target = lower_ascii(F.regexp_extract("to", LINK_HOST, 1))
    dst = F.when(target == "", F.col("src")).otherwise(target)
    return links.select("src", dst.alias("dst")).groupBy("src", "dst").agg(F.count("*").alias("n"))


def arcs(edges: DataFrame) -> DataFrame:
    """Where a share of a host's score goes: kind, from, to, share. Trust along links, distrust back."""
    out = edges.groupBy("src").agg(F.sum("n").alias("all"))
    into = edges.groupBy("dst").agg(F.sum("n").alias("all"))
    part = lambda kind, a, b: (F.lit(kind).alias("kind"), F.col(a).alias("from"), F.col(b).alias("to"))
    share = (F.col("n") / F.col("all")).alias("share")
    along = edges.join(out, "src").select(*part("trust", "src", "dst"), share)
    return along.union(edges.join(into, "dst").select(*part("distrust", "dst", "src"), share))


def seeds(pages: DataFrame) -> DataFrame:
    """Where scores start: kind, host, seed; the seeds of a kind sum to one."""
    kind = F.when(F.col("by_rule") == "allow", "trust").otherwise("distrust").alias("kind")
    found = pages.where("by_rule is not null and host <> ''").groupBy(kind, "host").agg(
        F.count("*").alias("n")
    )
    whole = found.groupBy("kind").agg(F.sum("n").alias("all"))  # two rows
    return found.join(F.broadcast(whole), "kind").select(
        "kind", "host", (F.col("n") / F.col("all")).alias("seed")
    )


def propagate(start: DataFrame, ways: DataFrame, max_steps: int = MAX_STEPS) -> DataFrame:
    """Scores per host at the fixed point: kind, host, score."""
    start, ways = cut(start), cut(ways)
    own = ways.where("from = to").select("kind", F.col("to").alias("host"), F.col("share").alias("own"))
    # What comes to a host counts more than once where the host links to itself.
    kept = 1 / (1 - DAMPING * F.coalesce("own", F.lit(0.0)))
    fresh = start.join(own, ["kind", "host"], "left").select(
        "kind", "host", (F.col("seed") * (1 - DAMPING) * kept).alias("score")
    )
    others = ways.where("from <> to").withColumnRenamed("to", "host")
    others = others.join(own, ["kind", "host"], "left").select(
        "kind", "from", "host", (F.col("share") * DAMPING * kept).alias("weight")
    )
    fresh, others = cut(fresh), cut(others)
    none, score, before = F.lit(0.0), F.col("score"), F.col("before")
    change = F.when(score > 0, F.abs(score - before) / score).otherwise(none)
    current = fresh
    for _ in range(max_steps):
        went = current.withColumnRenamed("host", "from").join(others, ["kind", "from"])
        came = went.select("kind", "host", (score * F.col("weight")).alias("score"), none.alias("before"))
        came = came.union(fresh.select("*", none)).union(current.select("kind", "host", none, "score"))
        sums = came.groupBy("kind", "host").agg(F.sum("score").alias("score"), F.sum("before").alias("before"))
        stepped = cut(sums.withColumn("change", change))
        current = stepped.select("kind", "host", "score")
        if (stepped.agg(F.max("change")).first()[0] or 0.0) <= TOLERANCE:
            return current
    raise RuntimeError(f"trust did not settle in {max_steps} steps")


def url_verdicts(pages: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """page_id, host, path, rule, verdict of every page, with its host's trust and distrust."""
    rows = ruled(pages, rules)
    scores = propagate(seeds(rows), arcs(cut(host_edges(rows))))
    of = lambda kind: F.coalesce(
        F.sum(F.when(F.col("kind") == kind, F.col("score"))), F.lit(0.0)
    ).alias(kind)
    hosts = scores.groupBy("host").agg(of("trust"), of("distrust"))
    none = F.lit(0.0)
    trust, distrust = F.coalesce("trust", none), F.coalesce("distrust", none)
    bad = distrust > trust * (1 + MARGIN)
    judged = rows.select("page_id", "host", "path", "rule", "by_rule").join(hosts, "host", "left")
    return judged.select(
        "page_id", "host", "path", "rule",
        F.coalesce("by_rule", F.when(bad, "block").otherwise("allow")).alias("verdict"),
    )


def oracle(rules: tuple[Rule, ...] = RULES) -> str:
    """The same by SQL, each step of the walk as one table."""
    longest = sorted(rules, key=lambda r: -len(r.text))

    def pick(value) -> str:
        fits = lambda r: (
            f"(host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}')"
        )
        return "CASE " + " ".join(f"WHEN {fits(r)} THEN '{value(r)}'" for r in longest) + " END"

    lower = lambda x: f"translate({x}, '{UPPER}', '{LOWER}')"
    link = LINK.replace("'", "''")
    steps = ["w0 AS (SELECT kind, host, seed AS score FROM seeds)"]
    for i in range(ROUNDS):
        steps.append(
            f"""w{i + 1} AS (SELECT kind, host, sum(score) AS score FROM (
  SELECT w.kind, a.dst AS host, w.score * a.share * {DAMPING} AS score
  FROM w{i} w JOIN arcs a ON w.kind = a.kind AND w.host = a.src
  UNION ALL SELECT kind, host, seed * {1 - DAMPING} FROM seeds) GROUP BY ALL)"""
        )
    return f"""
WITH parsed AS MATERIALIZED (
  SELECT page_id, html, {lower(f"coalesce(regexp_extract(url, '{URL}', 1), '')")} AS host,
    coalesce(regexp_extract(url, '{URL}', 2), '') AS path FROM pages
), p AS MATERIALIZED (SELECT *, {pick(lambda r: r.text)} AS rule, {pick(lambda r: r.verdict)} AS by_rule FROM parsed
), links AS (
  SELECT host AS src, {lower(f"regexp_extract(t, '{LINK_HOST}', 1)")} AS target
  FROM (SELECT host, unnest(regexp_extract_all(coalesce(html, ''), '{link}', 1)) AS t FROM p WHERE host <> '')
), edges AS MATERIALIZED (
  SELECT src, CASE WHEN target = '' THEN src ELSE target END AS dst, count(*) AS n
  FROM links GROUP BY ALL
), arcs AS MATERIALIZED (
  SELECT 'trust' AS kind, src, dst, n / sum(n) OVER (PARTITION BY src) AS share FROM edges
  UNION ALL SELECT 'distrust', dst, src, n / sum(n) OVER (PARTITION BY dst) FROM edges
), seeds AS MATERIALIZED (
  SELECT kind, host, n / sum(n) OVER (PARTITION BY kind) AS seed FROM (
    SELECT CASE WHEN by_rule = 'allow' THEN 'trust' ELSE 'distrust' END AS kind, host, count(*) AS n
    FROM p WHERE by_rule IS NOT NULL AND host <> '' GROUP BY ALL)
), {", ".join(steps)}, hosts AS (
  SELECT host, coalesce(sum(score) FILTER (kind = 'trust'), 0) AS trust,
    coalesce(sum(score) FILTER (kind = 'distrust'), 0) AS distrust FROM w{ROUNDS} GROUP BY host
)
SELECT page_id, p.host, path, rule, coalesce(by_rule, CASE WHEN round(coalesce(distrust, 0),
  {DECIMALS}) > round(coalesce(trust, 0), {DECIMALS}) THEN 'block' ELSE 'allow' END) AS verdict
FROM p LEFT JOIN hosts ON p.host = hosts.host
"""
