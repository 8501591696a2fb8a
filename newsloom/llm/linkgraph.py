"""URL filter by rules and, where no rule speaks, by trust and distrust that flow over the links between hosts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.llm.common import hot_join
from newsloom.session import materialize

#: ``(verdict, host, path)``; a rule is named by host and path together.
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
DAMPING = 0.85
#: The ranks have settled when those of no host have changed by more than this share since the last written table.
SETTLED = 1e-6
#: More rounds than this are an error, not an end.
MOST_ROUNDS = 5_000
#: Rounds between two written tables.
CUT = 5
#: A host is blocked if this share of what reached it is distrust.
BLOCKED = 0.6

_CAPITALS, _SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"
_LINK = r"(?i)\bhref\s{0,8}=\s{0,8}[\"']?(?:https?:)?//([^/?#\"'\s<>]+)"


def lower_ascii(text: Column) -> Column:
    return F.translate(text, _CAPITALS, _SMALL)


def host_of(url: Column) -> Column:
    return lower_ascii(F.coalesce(F.regexp_extract(url, _URL, 1), F.lit("")))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _URL, 2), F.lit(""))


def matched_rule(host: Column, path: Column, rules: Sequence[tuple[str, str, str]], out: str) -> Column:
    """The name or the verdict of the longest rule that fits; of equally long ones the first by name; null if none."""
    found = None
    for verdict, rule_host, rule_path in sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[1] + r[2])):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        value = F.lit(rule_host + rule_path if out == "rule" else verdict)
        found = F.when(fits, value) if found is None else found.when(fits, value)
    return found if found is not None else F.lit(None).cast("string")


def host_edges(pages: DataFrame) -> DataFrame:
    """``(src, dst, n)`` from ``(host, html)``: links of pages to other hosts, and each host with the domain it stands under.

    Links are added up inside each task, so a host with many pages is a few rows. A host and the domain one label
    above it are linked both ways, once, down to domains of two labels.
    """
    links = pages.where("host <> ''").select("host", F.explode(F.regexp_extract_all("html", F.lit(_LINK), F.lit(1))).alias("to"))
    links = links.select(F.col("host").alias("src"), lower_ascii(F.col("to")).alias("dst"))
    links = links.groupBy("src", "dst").agg(F.count(F.lit(1)).alias("n")).where("src <> dst")
    hosts = pages.where("host <> ''").select("host").distinct()
    labels = F.split("host", r"\.", -1)
    # a.b.c.d gives the pairs (a.b.c.d, b.c.d) and (b.c.d, c.d).
    steps = F.when(F.size(labels) > 2, F.sequence(F.lit(1), F.size(labels) - 2))
    chain = hosts.select(labels.alias("l"), F.explode(steps).alias("i"))
    tail = lambda at: F.array_join(F.slice("l", at, F.size("l")), ".")
    up = chain.select(tail(F.col("i")).alias("src"), tail(F.col("i") + 1).alias("dst")).distinct()
    under = up.unionByName(up.select(F.col("dst").alias("src"), F.col("src").alias("dst"))).withColumn("n", F.lit(1).cast("bigint"))
    return links.unionByName(under).groupBy("src", "dst").agg(F.sum("n").alias("n"))


def flow(edges: DataFrame, seeds: DataFrame, rounds: int | None = None, damping: float = DAMPING) -> DataFrame:
    """``(host, trust, distrust)`` of personalised PageRank, when it has settled at every host, or after ``rounds``.

    Trust starts at trusted hosts and follows links; distrust starts at blocked hosts and goes against them, to those
    that link to blocked hosts. ``seeds`` has ``(host, trust, distrust)``. Each round is one join and one sum over
    host edges; the ranks are written every few rounds, so a lost executor repeats little. Then they are compared with
    those written before, host by host, since a verdict is by shares however little has reached a host.
    """
    out_sum = edges.groupBy(F.col("src").alias("from")).agg(F.sum("n").alias("_all"))
    in_sum = edges.groupBy(F.col("dst").alias("from")).agg(F.sum("n").alias("_all"))
    ahead = edges.select(F.col("src").alias("from"), F.col("dst").alias("to"), "n").join(out_sum, "from")
    back = edges.select(F.col("dst").alias("from"), F.col("src").alias("to"), "n").join(in_sum, "from")
    zero = F.lit(0.0)
    steps = ahead.select("from", "to", (F.col("n") / F.col("_all")).alias("wt"), zero.alias("wd")).unionByName(
        back.select("from", "to", zero.alias("wt"), (F.col("n") / F.col("_all")).alias("wd"))
    )
    steps = materialize(steps.groupBy("from", "to").agg(F.sum("wt").alias("wt"), F.sum("wd").alias("wd")), "steps")
    ranks = seeds = materialize(seeds, "seeds")
    written = ranks
    for turn in range(MOST_ROUNDS if rounds is None else rounds):
        sent = steps.join(ranks.withColumnRenamed("host", "from"), "from").select(
            F.col("to").alias("host"), (F.lit(damping) * F.col("trust") * F.col("wt")).alias("trust"), (F.lit(damping) * F.col("distrust") * F.col("wd")).alias("distrust")
        )
        kept = seeds.select("host", (F.lit(1 - damping) * F.col("trust")).alias("trust"), (F.lit(1 - damping) * F.col("distrust")).alias("distrust"))
        ranks = sent.unionByName(kept).groupBy("host").agg(F.sum("trust").alias("trust"), F.sum("distrust").alias("distrust"))
        if (turn + 1) % CUT == 0 or turn + 1 == rounds:
            ranks = materialize(ranks, "ranks")
            if rounds is None and _settled(ranks, written):
                return ranks
            written = ranks
    if rounds is None:
        raise RuntimeError("link graph did not settle")
    return ranks


def _settled(ranks: DataFrame, before: DataFrame) -> bool:
    old = before.select("host", F.col("trust").alias("_trust"), F.col("distrust").alias("_distrust"))
    moved = F.lit(False)
    for name in ("trust", "distrust"):
        moved = moved | (F.abs(F.col(name) - F.coalesce(f"_{name}", F.lit(0.0))) > SETTLED * F.col(name))
    return ranks.join(old, "host", "left").where(moved).limit(1).count() == 0


def judge(
    pages: DataFrame,
    rules: Sequence[tuple[str, str, str]] = RULES,
    key: str = "page_id",
    url: str = "url",
    html: str = "html",
    rounds: int | None = None,
    damping: float = DAMPING,
    blocked: float = BLOCKED,
) -> DataFrame:
    """``(key, host, path, rule, verdict, trust, distrust)`` of every row.

    A page with a rule gets the rule's verdict. The share of a host's pages that rules allow is its trust at the start,
    the share that rules block its distrust; both flow over host edges, and a page without a rule is blocked if
    distrust makes up ``blocked`` or more of what its host has, and allowed otherwise, also if nothing reached it.
    A url that is null or without ``://`` has an empty host and path, no rule, and is allowed; a null html has no
    links. Null and repeated keys are rows like others; other columns are not read.
    """
    split = pages.select(F.col(key).alias("_key"), host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))
    found = split.select(
        "_key", "host", "path",
        matched_rule(F.col("host"), F.col("path"), rules, "rule").alias("rule"),
        matched_rule(F.col("host"), F.col("path"), rules, "verdict").alias("_said"),
    )
    found = materialize(found, "pages")
    share = lambda verdict: F.avg(F.when(F.col("_said") == verdict, 1.0).otherwise(0.0))
    seeds = found.where("host <> ''").groupBy("host").agg(share("allow").alias("trust"), share("block").alias("distrust"), F.count(F.lit(1)).alias("_rows"))
    seeds = materialize(seeds, "hosts")
    edges = host_edges(pages.select(host_of(F.col(url)).alias("host"), F.coalesce(F.col(html), F.lit("")).alias("html")))
    ranks = flow(edges, seeds.select("host", "trust", "distrust"), rounds, damping)
    reached = seeds.select("host", "_rows").join(ranks, "host", "left")
    bad = F.col("distrust") >= F.lit(blocked) * (F.col("trust") + F.col("distrust"))
    verdict = F.when(bad & (F.col("distrust") > 0), "block").otherwise("allow")
    judged = hot_join(found, materialize(reached.withColumn("_host_says", verdict), "judged"), ["host"], "_rows")
    return judged.select(
        F.col("_key").alias(key), "host", "path", "rule", F.coalesce("_said", "_host_says", F.lit("allow")).alias("verdict"),
        F.coalesce("trust", F.lit(0.0)).alias("trust"), F.coalesce("distrust", F.lit(0.0)).alias("distrust"),
    )
