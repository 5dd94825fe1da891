"""URL filters: host and path rules, and trust spread over the host graph."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lymphlake.plans.tables import written

# The rules in force, as (verdict, host, path prefix).
RULES = (
    ("block", "com", "/en/"),
    ("allow", "example.com", "/en/7"),
    ("allow", "net", "/de/"),
    ("block", "example.net", "/de/8"),
    ("block", "org", "/es/"),
)
#: A walk goes on with probability DAMPING; ITERATIONS steps leave out at most DAMPING^ITERATIONS of the walks.
DAMPING, ITERATIONS = 0.85, 16
#: A host is blocked when its distrust exceeds this multiple of its trust, and the uniform share times LEAST.
RATIO, LEAST = 1.0, 0.5
#: Hosts under which registries give names to anyone; fixed values.
SHARED = r"^(?:ac|co|com|edu|go|gob|gouv|gov|mil|ne|net|nom|or|org|sch)\.[a-z][a-z]$"


def _lower(c: Column) -> Column:
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    at = F.instr(url, "://")
    rest = F.substr(url, at + 3)
    return F.when(at > 0, _lower(F.regexp_extract(rest, r"^([^/?#]*)", 1))).otherwise(F.lit(""))


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; else empty."""
    at = F.instr(url, "://")
    rest = F.substr(url, at + 3)
    return F.when(at > 0, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)).otherwise(F.lit(""))


def matched_rule(host: Column, path: Column, rules=RULES) -> Column:
    """Struct ``rule, verdict`` of the longest fitting rule, null if none fits.

    A rule fits its host and all subdomains if the path starts with its path.
    The rule's whole text decides its length; of equal ones the first wins.
    """
    ordered = sorted(rules, key=lambda r: -len(r[1] + r[2]))

    def fits(r):
        return ((host == r[1]) | host.endswith("." + r[1])) & path.startswith(r[2])

    found = [F.when(fits(r), F.struct(F.lit(r[1] + r[2]).alias("rule"), F.lit(r[0]).alias("verdict"))) for r in ordered]
    return F.coalesce(*found) if found else F.lit(None).cast("struct<rule:string,verdict:string>")


def host_edges(pages: DataFrame, host: str = "host", html: str = "html") -> DataFrame:
    """``src, dst, weight``: pages of a host that link to another host, summed before the shuffle.

    Absolute and protocol-relative href and src values count by their host,
    each host once a page. Links to the own host, relative ones among them,
    are left out: they say nothing about other hosts and would keep a host's
    rank from leaving it. Besides, a host of three or more labels and the host
    above it link to each other once for each page, as parts of one site:
    blog.example.com and example.com, not example.co.uk and co.uk.
    """
    links = F.regexp_extract_all(F.coalesce(F.col(html), F.lit("")), F.lit(r"""(?i)\b(?:href|src)\s*=\s*["']?([^"'\s>]+)"""), F.lit(1))
    own = F.col(host)

    def target(link):
        absolute = F.regexp_extract(link, r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//([^/?#]*)", 1)
        return F.when((absolute != "") & (_lower(absolute) != own), _lower(absolute))

    above = F.regexp_replace(own, r"^[^.]*\.", "")
    linked = pages.where(own != "").select(own.alias("src"), F.explode(F.array_distinct(F.transform(links, target))).alias("dst")).where(F.col("dst").isNotNull())
    summed = linked.groupBy("src", "dst").agg(F.count(F.lit(1)).cast("double").alias("weight"))
    parts = pages.where(own.rlike(r"^[^.]+\.[^.]+\.(?:[^.]+\.)*[a-z][^.]*$") & ~above.rlike(SHARED)).groupBy(own.alias("src"), above.alias("dst")).agg(F.count(F.lit(1)).cast("double").alias("weight"))
    both = summed.unionByName(parts).unionByName(parts.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "weight"))
    return both.groupBy("src", "dst").agg(F.sum("weight").alias("weight"))


def propagate(edges: DataFrame, seeds: DataFrame, damping: float = DAMPING, iterations: int = ITERATIONS) -> DataFrame:
    """Personalised PageRank: ``host, rank`` over ``edges (src, dst, weight)`` from ``seeds (host, mass)``.

    Walks start at the seeds, follow edges by weight with probability
    ``damping`` and are counted at every host; the counts, scaled to 1, are the
    ranks of a surfer who returns to the seeds at the end of each walk, also
    where no link leads on. ``iterations`` steps leave out at most
    damping^iterations of the walks. Each step joins the counts with the edges
    once and sums by target before the shuffle; every fourth is written to the
    shared folder. Hosts that nothing reaches are not listed. No seed, no row.
    """
    whole = seeds.agg(F.sum("mass")).first()[0]
    if not whole:
        return seeds.select("host", F.col("mass").cast("double").alias("rank")).limit(0)
    out = edges.groupBy("src").agg(F.sum("weight").alias("out"))
    steps = written(edges.join(out.withColumnRenamed("src", "s"), F.col("src") == F.col("s")).select("src", "dst", (damping * F.col("weight") / F.col("out")).alias("share")), "host-steps")
    start = written(seeds.groupBy("host").agg((F.sum("mass") / whole).alias("rank")), "host-seeds")
    rank = start
    for i in range(iterations):
        moved = rank.join(steps, F.col("host") == F.col("src")).select(F.col("dst").alias("host"), (F.col("rank") * F.col("share")).alias("rank"))
        rank = moved.unionByName(start).groupBy("host").agg(F.sum("rank").alias("rank"))
        if i % 4 == 3 or i + 1 == iterations:
            rank = written(rank, "host-rank")
    total = rank.agg(F.sum("rank")).first()[0]
    return rank.select("host", (F.col("rank") / total).alias("rank"))


def judge(pages: DataFrame, rules=RULES, damping: float = DAMPING, iterations: int = ITERATIONS, ratio: float = RATIO, least: float = LEAST) -> DataFrame:
    """``page_id, host, path, rule, verdict, trust, distrust`` of every page.

    Needs ``page_id, url, html``. A page that a rule fits has that rule's
    verdict. The others go by their host: hosts seed trust by the share of
    their pages that rules allow, distrust by the share that rules block;
    trust follows links (who is linked from trusted hosts), distrust runs
    against them (who links to blocked hosts). A host is blocked when its
    distrust is over ``ratio`` times its trust and over ``least`` times the
    uniform share of a host; else its pages are allowed.

    Null urls and urls without ``://`` have an empty host, take no part in
    the graph and are allowed. Null html has no links. Repeated rows are
    judged alike; an empty table gives an empty result.
    """
    kept = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    parsed = kept.select("page_id", F.coalesce(host_of(F.col("url")), F.lit("")).alias("host"), F.coalesce(path_of(F.col("url")), F.lit("")).alias("path"), "html")
    ruled = parsed.withColumn("_r", matched_rule(F.col("host"), F.col("path"), rules))
    # one pass over the pages leaves only hosts, rules and counts
    verdict = F.col("_r.verdict")
    hosts = written(
        ruled.where(F.col("host") != "").groupBy("host").agg(F.count(F.lit(1)).alias("n"), F.count(F.when(verdict == "allow", 1)).alias("allowed"), F.count(F.when(verdict == "block", 1)).alias("blocked")),
        "host-counts",
    )
    edges = written(host_edges(parsed), "host-edges")
    trust = propagate(edges, hosts.where("allowed > 0").select("host", (F.col("allowed") / F.col("n")).alias("mass")), damping, iterations)
    back = edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "weight")
    distrust = propagate(back, hosts.where("blocked > 0").select("host", (F.col("blocked") / F.col("n")).alias("mass")), damping, iterations)
    n = hosts.count()
    trusted = trust.select("host", F.col("rank").alias("trust"), F.lit(0.0).alias("distrust"))
    doubted = distrust.select("host", F.lit(0.0).alias("trust"), F.col("rank").alias("distrust"))
    scores = written(trusted.unionByName(doubted).groupBy("host").agg(F.sum("trust").alias("trust"), F.sum("distrust").alias("distrust")).withColumnRenamed("host", "h"), "host-scores")
    judged = ruled.drop("html").join(scores, F.col("host") == F.col("h"), "left")
    trust_, distrust_ = F.coalesce("trust", F.lit(0.0)), F.coalesce("distrust", F.lit(0.0))
    by_host = F.when((distrust_ > ratio * trust_) & (distrust_ > least / max(1, n)), "block").otherwise("allow")
    return judged.select("page_id", "host", "path", F.col("_r.rule").alias("rule"), F.coalesce(verdict, by_host).alias("verdict"), trust_.alias("trust"), distrust_.alias("distrust"))
