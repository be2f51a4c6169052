"""URL filters: hand-written rules first, then trust and distrust that spread over the host graph.

Host edges come from pages' absolute links and from the name system: a host and its parent domain point at
each other.  Trust starts from hosts in proportion to their pages that a rule allows and follows the edges;
distrust starts from hosts in proportion to their pages that a rule blocks and follows the edges backwards.
Both are personalised PageRanks, iterated until they settle, however far a host is from the seeds.  A host
is blocked if its share of distrust reaches the threshold.
"""

from __future__ import annotations

import math
import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path
from .tables import join_totals, written

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: (verdict, host, path)
RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]
DAMPING, CUT_EVERY = 0.85, 16
#: A score has settled when steps change it by no more than this part of it.
TOLERANCE = 1e-10
#: Mass that reached a host is passed on once it is more than this part of the host's score.
PUSHED = TOLERANCE / 100
#: Steps after which what is still on its way is below the tolerance, whatever the graph.  No limit: far hosts take more.
STEPS = math.ceil(math.log(TOLERANCE) / math.log(DAMPING))
#: Rows of the host graph that one task takes; a graph of no more is kept in one task and its scores are broadcast.
ROWS_A_TASK = 50_000
#: Share of all edges from which a host's own edges are not dealt out by host.
HUB_SHARE = 1e-3
#: Distrust, as a share of trust and distrust together, from which a host is blocked.
THRESHOLD = 0.5
LINK = r"(?i)href\s*=\s*[\"']?\s*(?:[a-z][a-z0-9+.-]*:)?//([^/?#\"'\s<>]+)"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; path: then up to
    ``?``, ``#`` or the end.  Null or no ``://``: both empty."""
    split = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    part = lambda i: F.coalesce(F.regexp_extract(url, split, i), F.lit(""))
    return F.translate(part(1), UPPER, LOWER), part(2)


def rule_for(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits (equal lengths: the first by name) and its verdict; null if none does."""
    fits, verdict = [], []
    for kind, h, p in sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[1] + r[2])):
        here = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        fits.append(F.when(here, F.lit(h + p)))
        verdict.append(F.when(here, F.lit(kind)))
    none = F.lit(None).cast("string")
    return F.coalesce(*fits, none), F.coalesce(*verdict, none)


def host_edges(pages: DataFrame, hosts: DataFrame, html: str = "html") -> DataFrame:
    """``(src, dst, w)``: links of ``pages(host, html)`` between hosts, by count, and parents of all ``hosts(host)``.

    A host and its parent, if that has two labels or more, point at each other with weight one.
    """
    targets = F.array_distinct(F.regexp_extract_all(F.translate(F.col(f"`{html}`"), UPPER, LOWER), F.lit(LINK), 1))
    links = pages.where("host <> ''").select(F.col("host").alias("src"), F.explode(targets).alias("dst"))
    counted = links.where("src <> dst").groupBy("src", "dst").agg(F.count(F.lit(1)).cast("double").alias("w"))
    every = hosts.select("host").unionByName(counted.select(F.col("dst").alias("host"))).where("host <> ''").distinct()
    labels = F.split("host", r"\.", -1)
    chain = F.transform(F.sequence(F.lit(1), F.greatest(F.size(labels) - 1, F.lit(1))), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    steps = every.select(chain.alias("c")).select(F.explode(F.filter(F.zip_with("c", F.slice("c", F.lit(2), F.size("c")), lambda a, b: F.struct(a.alias("a"), b.alias("b"))), lambda x: x["b"].isNotNull())).alias("x"))
    up = steps.select("x.a", "x.b").distinct()
    both = up.select(F.explode(F.array(F.struct(F.col("a").alias("src"), F.col("b").alias("dst")), F.struct(F.col("b").alias("src"), F.col("a").alias("dst")))).alias("e"))
    named = both.select("e.src", "e.dst", F.lit(1.0).alias("w"))
    return counted.unionByName(named).groupBy("src", "dst").agg(F.sum("w").alias("w"))


NODE = ["kind", "host"]


def propagate(edges: DataFrame, seeds: DataFrame, damping: float = DAMPING, pushed: float = PUSHED, small: int = ROWS_A_TASK) -> DataFrame:
    """``(kind, host, score)`` of personalised PageRank for ``seeds(kind, host, mass)``.

    kind trust follows ``edges(src, dst, w)`` and distrust follows them backwards; both run in the same
    joins.  A host without edges onward keeps nothing of what it would pass on.  Hosts pass on what has
    reached them since they last did, as long as that is more than ``pushed`` of their score; it ends when
    nobody has that much, however far hosts are from the seeds.  A graph of up to ``small`` rows stays in one
    task, without a shuffle; a larger one is dealt out by host once and only scores move.
    """
    both = edges.select(F.lit("trust").alias("kind"), F.col("src").alias("host"), F.col("dst").alias("to"), "w").unionByName(
        edges.select(F.lit("distrust").alias("kind"), F.col("dst").alias("host"), F.col("src").alias("to"), "w")
    )
    both = written(both, "edges")
    out = written(both.groupBy(*NODE).agg(F.sum("w").alias("out"), F.count(F.lit(1)).alias("n")), "degrees")
    moves = join_totals(both, out, NODE, "n").select(*NODE, "to", (damping * F.col("w") / F.col("out")).alias("p"))
    base = (1 - damping) * F.col("mass")
    start = written(seeds.select(*NODE, base.alias("score"), base.alias("pending")), "scores")
    if both.count() + out.count() + start.count() <= small:
        return _in_one_task(moves, start, pushed)
    return _dealt_by_host(moves, start, out, pushed, small)


def _pushes(pushed: float) -> Column:
    return F.col("pending") > pushed * F.col("score")


def _settles(state: DataFrame, pushed: float) -> bool:
    return state.where(_pushes(pushed)).isEmpty()


def _in_one_task(moves: DataFrame, state: DataFrame, pushed: float) -> DataFrame:
    """Every host also moves to itself, so one join and one aggregate make a step; both stay in a single partition."""
    spark = moves.sparkSession
    hosts = moves.select("kind", F.col("to").alias("host")).unionByName(state.select(*NODE)).unionByName(moves.select(*NODE)).distinct()
    itself = hosts.select(*NODE, F.col("host").alias("to"), F.lit(None).cast("double").alias("p"))
    moves = written(moves.unionByName(itself).coalesce(1), "moves").coalesce(1)
    while not _settles(state, pushed):
        state = written(spark.sql(_steps(CUT_EVERY, pushed), moves=moves, state=state.coalesce(1)), "scores")
    return state.select(*NODE, "score")


def _steps(n: int, pushed: float) -> str:
    """SQL of ``n`` steps at once, so that they are planned once; the hints keep a single partition single."""
    go = f"s.pending > {pushed!r}D * s.score"
    part = f"CASE WHEN {go} THEN m.p * s.pending ELSE 0D END"
    score = f"CASE WHEN m.p IS NULL THEN s.score ELSE {part} END"
    pending = f"CASE WHEN m.p IS NOT NULL THEN {part} WHEN {go} THEN 0D ELSE s.pending END"
    said = ["s0 AS (SELECT kind, host, score, pending FROM {state})"]
    for k in range(n):
        said.append(
            f"s{k + 1} AS (SELECT kind, host, sum(score) AS score, sum(pending) AS pending FROM (SELECT /*+ COALESCE(1), SHUFFLE_HASH(s) */ m.kind, m.to AS host, "
            f"{score} AS score, {pending} AS pending FROM {{moves}} m JOIN s{k} s ON m.kind = s.kind AND m.host = s.host WHERE m.p IS NULL OR {go}) GROUP BY kind, host)"
        )
    return f"WITH {', '.join(said)} SELECT * FROM s{n}"


def _dealt_by_host(moves: DataFrame, state: DataFrame, out: DataFrame, pushed: float, rows_a_task: int) -> DataFrame:
    """Edges lie in buckets by host, sorted, so a step shuffles scores alone; hubs' edges lie apart and meet broadcast scores."""
    spark = moves.sparkSession
    every = out.agg(F.sum("n")).first()[0] or 0
    hubs = F.broadcast(out.where(F.col("n") > HUB_SHARE * every).select(*NODE))  # 1 / HUB_SHARE rows at most
    buckets = min(max(2, -(-every // max(rows_a_task, 1))), 10_000)
    name = f"moves_{uuid.uuid4().hex}"
    dealt = moves.join(hubs, NODE, "left_anti").repartition(buckets, *NODE)
    dealt.write.bucketBy(buckets, *NODE).sortBy(*NODE).option("path", scratch_path(spark, "moves")).saveAsTable(name)
    dealt, apart = spark.table(name), written(moves.join(hubs, NODE, "left_semi"), "hub-moves")
    while not _settles(state, pushed):
        go = _pushes(pushed)
        active = state.where(go).select(*NODE, "pending")
        met = dealt.join(active.hint("shuffle_merge"), NODE).unionByName(apart.join(F.broadcast(active.join(hubs, NODE, "left_semi")), NODE))
        part = F.col("p") * F.col("pending")
        got = met.select("kind", F.col("to").alias("host"), part.alias("score"), part.alias("pending"))
        kept = state.select(*NODE, "score", F.when(go, 0.0).otherwise(F.col("pending")).alias("pending"))
        state = written(kept.unionByName(got).groupBy(*NODE).agg(F.sum("score").alias("score"), F.sum("pending").alias("pending")), "scores")
    spark.sql(f"DROP TABLE {name}")
    return state.select(*NODE, "score")


def judged(pages: DataFrame, id_col: str = "page_id", url: str = "url", html: str = "html", rules=RULES, threshold: float = THRESHOLD, damping: float = DAMPING, small: int = ROWS_A_TASK) -> DataFrame:
    """``id, host, path, rule, verdict, distrust`` of every page: the rule's verdict, else its host's.

    distrust is the host's share (null where neither score reaches it; such hosts are allowed).  Null urls
    and urls without ``://`` have an empty host, which no rule fits and no score reaches; null html has no
    links; repeated pages each count and stay; an empty table gives an empty one; other columns are ignored.
    """
    host, path = host_and_path(F.col(f"`{url}`"))
    named = pages.select(F.col(f"`{id_col}`").alias("id"), host.alias("host"), path.alias("path"))
    rule, kind = rule_for(F.col("host"), F.col("path"), rules)
    ruled = written(named.select("id", "host", "path", rule.alias("rule"), kind.alias("kind")), "pages")
    hosts = written(ruled.groupBy("host").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("kind") == "allow").alias("trust"), F.count_if(F.col("kind") == "block").alias("distrust")), "hosts")
    mass = hosts.select(F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), F.col("host"), F.col(k).alias("n")) for k in ("trust", "distrust")])).alias("s")).select("s.*").where("n > 0")
    total = mass.groupBy("kind").agg(F.sum("n").alias("total"))
    seeds = mass.join(F.broadcast(total), "kind").select("kind", "host", (F.col("n") / F.col("total")).alias("mass"))  # two rows
    edges = host_edges(pages.select(host.alias("host"), F.col(f"`{html}`")), hosts, html)
    score = propagate(edges, seeds, damping, small=small).groupBy("host").agg(*[F.coalesce(F.sum(F.when(F.col("kind") == k, F.col("score"))), F.lit(0.0)).alias(k) for k in ("trust", "distrust")])
    share = score.select("host", F.try_divide(F.col("distrust"), F.col("trust") + F.col("distrust")).alias("distrust"))
    own = F.when(F.col("distrust") >= threshold, F.lit("block")).otherwise(F.lit("allow"))
    shares = hosts.select("host", "n").join(share, "host", "left")
    return join_totals(ruled, shares, ["host"], "n").select("id", "host", "path", "rule", F.coalesce("kind", own).alias("verdict"), "distrust")
