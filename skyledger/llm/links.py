"""URL filter: rules by host and path, and for urls without a rule the host's standing in the link graph.

Pages that a rule allows make their host a trusted seed, pages that a rule blocks a blocked seed, each by their
number. Trust follows links forward: a personalised PageRank, whose jumps lead back to the trusted seeds. Distrust
follows them backward, from a page to those that link to it: the same walk over reversed edges from the blocked
seeds. A host whose share of distrust in both is above the threshold is blocked.

Only DataFrame functions are used. Links are read from the pages once; what is iterated over are distinct pairs of
hosts. Every round is one join and one aggregate for both walks, written to the shared folder, and the rounds end
when no host's score moves by more than ``SETTLED`` of itself; a host just reached has not settled. So neither the
number of other hosts nor the length of a chain of links matters. What is still to come to a host is then at most
``SETTLED`` of its score for each step of the mean way to it. Walks not settled after ``ROUNDS`` raise an error. Scores
below ``LEAST``, near the smallest double, are not waited for.

Null urls and urls without ``://`` have an empty host and path, fit no rule and are allowed. Links within a host, relative ones included, move nothing. A null html has
no links. Hosts that no walk reaches have no evidence against them and are allowed. Repeated rows are pages of their
own. Extra columns are not read; an empty table gives no rows.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.llm.common import table
from skyledger.session import scratch_path, written

JUMP = 0.15
#: Only a guard: no score above LEAST can be unsettled for so long, unless jumps are rarer than 0.08.
ROUNDS = 10_000
SETTLED = 1e-6
LEAST = 1e-300
#: A host is blocked if distrust is more than this share of trust and distrust.
BLOCK_ABOVE = 0.5

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Where an anchor leads, if it names a host.
_ANCHOR = r"""(?is)<a\s[^>]*?href\s*=\s*["']?\s*((?:https?:)?//[^"'\s>]+)"""


class Rule(NamedTuple):
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


#: The rules of the query.
RULES = (
    Rule("allow", "org", "/"),
    Rule("block", "example.org", "/es/"),
    Rule("block", "example.org", "/en/1"),
    Rule("allow", "com", "/fr/"),
    Rule("block", "com", "/de/"),
)


def _after(url: Column, mark: str) -> Column:
    """What follows the first ``mark``; empty without one."""
    rest = F.substring(url, F.instr(url, mark) + len(mark), F.length(url))
    return F.coalesce(F.when(F.contains(url, F.lit(mark)), rest), F.lit(""))


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(_after(url, "://"), "^[^/?#]*", 0), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(_after(url, "://"), "^[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: tuple[Rule, ...]) -> Column:
    """The longest rule that fits, as a struct (text, verdict), or null."""
    found = F.lit(None).cast("struct<text:string,verdict:string>")
    for rule in sorted(rules, key=lambda r: (len(r.text), r.verdict == "block")):
        fits = ((host == rule.host) | F.endswith(host, F.lit("." + rule.host))) & F.startswith(path, F.lit(rule.path))
        found = F.when(fits, F.struct(F.lit(rule.text).alias("text"), F.lit(rule.verdict).alias("verdict"))).otherwise(found)
    return found


def linked_hosts(html: Column) -> Column:
    """The hosts that the anchors name, each once."""
    links = F.transform(F.regexp_extract_all(html, F.lit(_ANCHOR), 1), lambda u: host_of(F.when(F.startswith(u, F.lit("//")), F.concat(F.lit("http:"), u)).otherwise(u)))
    return F.filter(F.array_distinct(F.coalesce(links, F.array().cast("array<string>"))), lambda h: h != "")


def host_scores(seeds: DataFrame, edges: DataFrame, jump: float = JUMP, rounds: int = ROUNDS) -> DataFrame:
    """(host, trust, distrust) from seeds (host, trust, distrust) and edges (src, dst, weight)."""
    walks = []
    for kind, start, end in (("trust", "src", "dst"), ("distrust", "dst", "src")):
        whole = edges.groupBy(start).agg(F.sum("weight").alias("whole")).withColumnRenamed(start, "at")
        step = edges.select(F.col(start).alias("at"), F.col(end).alias("to"), "weight").join(whole, "at")
        walks.append(step.select(F.lit(kind).alias("kind"), "at", "to", (F.col("weight") / F.col("whole")).alias("share")))
    steps = written(walks[0].unionByName(walks[1]), "link-steps")
    parts = [seeds.select(F.lit(k).alias("kind"), "host", F.col(k).cast("double").alias("seed")).where("seed > 0") for k in ("trust", "distrust")]
    base = written(parts[0].unionByName(parts[1]), "link-seeds")
    zero = F.lit(0.0)
    back = base.select("kind", "host", (jump * F.col("seed")).alias("score"), zero.alias("before"))
    # Rounds take turns in two folders, so that the disk they need does not grow with their number.
    folders = [scratch_path(base.sparkSession, f"link-scores-{i}") for i in range(2)]
    now = back
    for turn in range(rounds):
        moved = now.join(steps, (now["host"] == steps["at"]) & (now["kind"] == steps["kind"]))
        moved = moved.select(steps["kind"], F.col("to").alias("host"), ((1 - jump) * F.col("score") * F.col("share")).alias("score"), zero.alias("before"))
        old = now.select("kind", "host", zero.alias("score"), F.col("score").alias("before"))
        new = moved.unionByName(back).unionByName(old).groupBy("kind", "host").agg(F.sum("score").alias("score"), F.sum("before").alias("before"))
        now = written(new, f"link-scores-{turn}", folders[turn % 2])
        moving = (F.col("score") > LEAST) & (F.abs(F.col("score") - F.col("before")) > SETTLED * F.col("score"))
        if now.where(moving).isEmpty():
            break
    else:
        raise RuntimeError(f"the walks did not settle in {rounds} rounds")
    pick = lambda kind: F.coalesce(F.sum(F.when(F.col("kind") == kind, F.col("score"))), F.lit(0.0)).alias(kind)
    return now.groupBy("host").agg(pick("trust"), pick("distrust"))


def judge(pages: DataFrame, rules: tuple[Rule, ...] = RULES, block_above: float = BLOCK_ABOVE) -> DataFrame:
    """(page_id, host, path, rule, verdict, trust, distrust) of every page."""
    rows = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"), linked_hosts(F.col("html")).alias("to"))
    rows = rows.withColumn("found", rule_of(F.col("host"), F.col("path"), rules))
    rows = written(rows.select("page_id", "host", "path", F.col("found.text").alias("rule"), F.col("found.verdict").alias("ruled"), "to"), "link-pages")
    count = lambda v: F.sum(F.when(F.col("ruled") == v, 1).otherwise(0))
    seeds = rows.where("ruled is not null and host <> ''").groupBy("host").agg(count("allow").alias("trust"), count("block").alias("distrust"))
    edges = rows.where("host <> ''").select(F.col("host").alias("src"), F.explode("to").alias("dst")).where("src <> dst")
    edges = written(edges.groupBy("src", "dst").agg(F.count(F.lit(1)).alias("weight")), "link-edges")
    scores = host_scores(seeds, edges)
    joined = rows.drop("to").join(scores, "host", "left")
    trust, distrust = (F.coalesce(c, F.lit(0.0)) for c in ("trust", "distrust"))
    against = distrust > block_above * (trust + distrust)
    verdict = F.coalesce("ruled", F.when(against, "block").otherwise("allow"))
    return joined.select("page_id", "host", "path", "rule", verdict.alias("verdict"), trust.alias("trust"), distrust.alias("distrust"))


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "pages"))
