"""URL filter: host and path rules, then trust and distrust propagated over host links."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import checkpointed, small_side, table, written

#: (verdict, rule); a rule is a host, then a path.
RULES = (("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/"))
DAMPING, ROUNDS = 0.85, 20
#: A host is blocked if its distrust reaches this and exceeds its trust.
THRESHOLD = 0.5
LINK = r"""(?i)<a\s[^>]*?href\s*=\s*["']?(?:https?:)?//([^/?#"'\s>]+)"""


#: Hosts that have a parent domain.
PARENT = r"^[^.]*\.[^.]+\.[^.]"


def lower_ascii(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without one."""
    return F.coalesce(lower_ascii(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    """From there up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def ruled(pages: DataFrame, rules: tuple[tuple[str, str], ...]) -> DataFrame:
    """Add host, path, rule and its verdict: the longest rule whose host is the page's host or
    a parent of it, and whose path begins the page's path. The rules are a list in the program."""
    out = pages.withColumn("host", host_of(F.col("url"))).withColumn("path", path_of(F.col("url")))
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, text in sorted(rules, key=lambda r: (len(r[1]), r[1])):  # the last that fits wins
        host, slash, path = text.partition("/")
        fits = ((F.col("host") == host) | F.endswith("host", F.lit("." + host))) & F.startswith("path", F.lit(slash + path))
        rule, verdict = F.when(fits, text).otherwise(rule), F.when(fits, kind).otherwise(verdict)
    return out.withColumn("rule", rule).withColumn("rule_verdict", verdict)


def host_links(pages: DataFrame) -> DataFrame:
    """Weighted edges (src, dst, w) between different hosts: anchors with a host in a page's html, and one from each host to its parent domain (the
    host without its first label), if that has pages of its own. None leads from a domain to its subdomains, so that these don't speak for each other, and a
    suffix that many share is no host."""
    found = pages.where("host <> ''").select(F.col("host").alias("src"), F.explode(F.regexp_extract_all("html", F.lit(LINK), F.lit(1))).alias("dst"))
    anchors = found.select("src", lower_ascii(F.col("dst")).alias("dst"), F.lit(1.0).alias("w")).where("src <> dst and dst <> ''")
    hosts = pages.where("host <> ''").select("host").distinct()
    under = hosts.where(F.col("host").rlike(PARENT)).select(F.col("host").alias("src"), F.regexp_replace("host", r"^[^.]*\.", "").alias("dst"), F.lit(1.0).alias("w"))
    family = under.join(hosts.withColumnRenamed("host", "dst"), "dst", "left_semi").select("src", "dst", "w")
    return anchors.unionAll(family).groupBy("src", "dst").agg(F.sum("w").alias("w"))


def spread(seeds: DataFrame, shares: DataFrame, damping: float = DAMPING, rounds: int = ROUNDS) -> DataFrame:
    """Trust and distrust of every host, both between 0 and 1: host, trust, distrust.

    ``seeds``: host, allowed, blocked; ``shares``: src, dst, p, where p is the share of src's links. Trust goes forward: a host that is linked to has (1 - damping) of its own seed and damping of what
    its linkers give, each by the share of its links. Distrust goes backward: a host that links has (1 - damping) of its own seed and damping of the distrust that its links lead to. Hosts without such
    links keep their seed. Both directions take one join a round, ``rounds`` times; shares are added up before and after each shuffle, the lineage is cut in the shared folder.
    """
    forth = shares.select(F.col("src").alias("at"), F.col("dst").alias("host"), F.lit(True).alias("forward"), "p")
    moves = written(forth.unionAll(shares.select(F.col("dst").alias("at"), F.col("src").alias("host"), F.lit(False), "p")))
    taken = moves.groupBy("host").agg(F.bool_or("forward").alias("linked"), F.bool_or(~F.col("forward")).alias("links"))
    own = seeds.join(taken, "host", "full_outer").select("host", *[F.coalesce(c, F.lit(0.0)).alias(c) for c in ("allowed", "blocked")], *[F.coalesce(c, F.lit(False)).alias(c) for c in ("linked", "links")])
    own = written(own)
    now = own.select("host", F.col("allowed").alias("trust"), F.col("blocked").alias("distrust"))
    for k in range(0 if moves.isEmpty() else rounds):  # without links nothing moves
        part = lambda way, c: F.sum(F.when(way, F.col(c) * F.col("p")).otherwise(0.0)).alias(c)
        flow = moves.join(now.withColumnRenamed("host", "at"), "at").groupBy("host").agg(part(F.col("forward"), "trust"), part(~F.col("forward"), "distrust"))
        after = lambda some, seed, c: F.least(F.lit(1.0), F.when(F.col(some), (1 - damping) * F.col(seed) + damping * F.coalesce(c, F.lit(0.0))).otherwise(F.col(seed))).alias(c)
        now = own.join(flow, "host", "left").select("host", after("linked", "allowed", "trust"), after("links", "blocked", "distrust"))
        now = checkpointed(now) if k % 4 == 3 else now
    return now


def judge(pages: DataFrame, rules: tuple[tuple[str, str], ...] = RULES, edges: DataFrame | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """Verdict on every page: page_id, host, path, rule, verdict, trust, distrust.

    A rule decides where one fits. Elsewhere the host decides: trust starts at hosts by the share
    of their pages that rules allow and follows links forward; distrust starts at the share of
    blocked pages and follows links backward (who links to bad hosts is suspect). A host takes distrust
    by the share of its own links that lead to the distrusted host, however many others link there. A host is blocked
    if its distrust is at least ``threshold`` and above its trust; unknown hosts are allowed.
    A null url, or one without ``://``, has an empty host and path, fits no rule and is allowed. Rows
    that repeat count as often as they occur. ``edges`` (src, dst, w) may replace the links of the html.
    """
    base = ruled(pages.select("page_id", F.col("url").cast("string").alias("url"), (F.col("html") if "html" in pages.columns else F.lit(None)).cast("string").alias("html")), rules)
    links = written(host_links(base) if edges is None else edges.select("src", "dst", F.col("w").cast("double").alias("w")).where("src <> dst and w > 0"))
    is_ = lambda v: F.avg(F.when(F.col("rule_verdict") == v, 1.0).otherwise(0.0))
    hosts = written(base.where("host <> ''").groupBy("host").agg(is_("allow").alias("allowed"), is_("block").alias("blocked")))
    shares = written(links.join(links.groupBy("src").agg(F.sum("w").alias("all")), "src").select("src", "dst", (F.col("w") / F.col("all")).alias("p")))
    scores = written(hosts.select("host").join(spread(hosts, shares), "host"))
    bad = (F.col("distrust") >= threshold) & (F.col("distrust") > F.col("trust"))
    judged = base.drop("html", "url").join(small_side(scores), "host", "left")
    verdict = F.coalesce("rule_verdict", F.when(bad, "block"), F.lit("allow"))
    return judged.select("page_id", "host", "path", "rule", verdict.alias("verdict"), F.coalesce("trust", F.lit(0.0)).alias("trust"), F.coalesce("distrust", F.lit(0.0)).alias("distrust"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict")


def _oracle() -> str:
    """The same in SQL, with the rounds of propagation written out."""
    cases = [(k, t, *t.partition("/")) for k, t in sorted(RULES, key=lambda r: (-len(r[1]), r[1]))]
    fits = lambda host, path: f"((host = '{host}' OR ends_with(host, '.{host}')) AND starts_with(path, '{path}'))"
    rule = " ".join(f"WHEN {fits(h, s + p)} THEN '{t}'" for _, t, h, s, p in cases)
    verdict = " ".join(f"WHEN {fits(h, s + p)} THEN '{k}'" for k, _, h, s, p in cases)
    az = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
    link = LINK.replace("'", "''")
    parts = [
        f"u AS MATERIALIZED (SELECT page_id, html, translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''), {az}) AS host, coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path FROM pages)",
        f"r AS MATERIALIZED (SELECT *, CASE {rule} END AS rule, CASE {verdict} END AS rv FROM u)",
        "h AS MATERIALIZED (SELECT host, avg(CASE WHEN rv = 'allow' THEN 1.0 ELSE 0.0 END) AS allow, avg(CASE WHEN rv = 'block' THEN 1.0 ELSE 0.0 END) AS block FROM r WHERE host <> '' GROUP BY host)",
        f"e0 AS (SELECT host AS src, translate(unnest(regexp_extract_all(html, '{link}', 1)), {az}) AS dst FROM r WHERE host <> '')",
        f"f AS (SELECT host, regexp_replace(host, '^[^.]*\\.', '') AS parent FROM h WHERE regexp_matches(host, '{PARENT}'))",
        "e1 AS (SELECT src, dst FROM e0 WHERE src <> dst AND dst <> '' UNION ALL SELECT host, parent FROM f WHERE parent IN (SELECT host FROM h))",
        "e AS MATERIALIZED (SELECT src, dst, count(*)::DOUBLE AS w FROM e1 GROUP BY ALL)",
        "fw AS MATERIALIZED (SELECT src, dst, w / sum(w) OVER (PARTITION BY src) AS p FROM e)",
        "bw AS MATERIALIZED (SELECT dst AS src, src AS dst, p FROM fw)",
    ]
    for name, seed, edges in (("t", "allow", "fw"), ("d", "block", "bw")):
        parts.append(f"{name}s AS MATERIALIZED (SELECT x.host, coalesce({seed}, 0) AS seed, x.host IN (SELECT dst FROM {edges}) AS has FROM (SELECT host FROM h UNION SELECT src FROM e UNION SELECT dst FROM e) x LEFT JOIN h ON h.host = x.host)")
        parts.append(f"{name}0 AS MATERIALIZED (SELECT host, seed AS score FROM {name}s)")
        for k in range(ROUNDS):
            parts.append(
                f"{name}{k + 1} AS MATERIALIZED (SELECT s.host, least(1, CASE WHEN has THEN {1 - DAMPING} * seed + {DAMPING} * coalesce(flow, 0) ELSE seed END) AS score FROM {name}s s LEFT JOIN (SELECT b.dst AS host, sum(a.score * b.p) AS flow FROM {name}{k} a JOIN {edges} b ON a.host = b.src GROUP BY b.dst) g ON g.host = s.host)"
            )
    return (
        f"WITH {', '.join(parts)} SELECT page_id, r.host, path, rule, CASE WHEN rv IS NOT NULL THEN rv WHEN coalesce(d.score, 0) >= {THRESHOLD} AND coalesce(d.score, 0) > coalesce(t.score, 0) THEN 'block' ELSE 'allow' END AS verdict "
        f"FROM r LEFT JOIN t{ROUNDS} t ON t.host = r.host LEFT JOIN d{ROUNDS} d ON d.host = r.host"
    )


ORACLE = _oracle()
