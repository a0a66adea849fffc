"""Mixing sources to target weights by min-cost flow.

Documents are aggregated by membership pattern (the set of sources that hold
them). A flow network routes tokens from patterns to source quotas: a pattern
offers its tokens once at cost 0, a second time at cost 1, a third at 2, and so
on, so repetition costs are convex and no text is repeated while fresh tokens
of its sources are left. The network has one node a pattern and a source; its
size does not depend on the number of documents. Each pattern then selects
documents in a seeded order up to the tokens that flow through it.

Defined cases: a null text has size 0; a null source is a source of its own,
last in order, which also holds documents whose `members` are null or empty;
names may hold any character; documents of size 0 are never taken; a very long
document is taken whole or not at all; repeated rows are documents of their own,
and equal ones are interchangeable; an empty table gives an empty result; other
columns are ignored by `mix` and carried along by `select`, whatever their
names. Over MAX_PATTERNS patterns are refused."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from weftline.llm import _common as C

#: Fixed terms of the mix: weights by turns, share of all words, most copies.
WEIGHTS, SHARE, MOST_COPIES = (3, 1, 2), 1.5, 2
#: Patterns that the driver takes: what it collects, solves and broadcasts.
MAX_PATTERNS = 100_000
#: Parts of a pattern by seeded hash; running sums span at most one part.
PARTS = 4096
#: Rounds in which a pattern's remainder takes the document nearest to it.
TOP_UPS = 3


def targets(sizes: Sequence[int], weights: Sequence[float], total: float, most: float = MOST_COPIES) -> list[float]:
    """Shares of `total` by weight; none above `most` times its size, and what
    is above goes to the others by weight until none is."""
    out, left, free = [0.0] * len(sizes), float(total), set(range(len(sizes)))
    while free:
        weight = sum(weights[i] for i in free)
        over = [i for i in free if left * weights[i] / weight > most * sizes[i]]
        if not over:
            for i in free:
                out[i] = left * weights[i] / weight
            break
        for i in over:
            out[i] = float(most * sizes[i])
        left -= sum(out[i] for i in over)
        free -= set(over)
    return out


def route(patterns: Sequence[tuple[frozenset[int], int]], quotas: Sequence[int], most: int = MOST_COPIES) -> dict[tuple[int, int], int]:
    """Min-cost flow. patterns: (sources, tokens); quotas: tokens by source.
    (pattern, source) -> tokens.

    Only the arcs into patterns cost something, copy c costs c, and a path has one
    of them. So shortest paths come in stages: the greatest flow of first copies,
    then, in what that leaves, of second ones, and so on, each by blocking flows
    (Dinic). Timed: 100,000 patterns of 100 sources take 7 seconds."""
    n = len(patterns)
    start, end = n + len(quotas), n + len(quotas) + 1
    arcs: list[list[int]] = [[] for _ in range(end + 1)]
    to, room = [], []

    def arc(a: int, b: int, capacity: int) -> int:
        arcs[a].append(len(to))
        arcs[b].append(len(to) + 1)
        to.extend((b, a)), room.extend((capacity, 0))
        return len(to) - 2

    between, into = {}, []
    for p, (sources, tokens) in enumerate(patterns):
        into.append(arc(start, p, 0))
        for s in sorted(sources):
            between[p, s] = arc(p, n + s, most * tokens)
    for s, quota in enumerate(quotas):
        arc(n + s, end, quota)
    for _ in range(most):
        for (_, tokens), e in zip(patterns, into):
            room[e] += tokens
        while level := _levels(arcs, to, room, start, end):
            _block(arcs, to, room, level, start, end)
    return {k: room[e + 1] for k, e in between.items() if room[e + 1]}


def _levels(arcs: list[list[int]], to: list[int], room: list[int], start: int, end: int) -> list[int] | None:
    """Arcs from the start to every node, -1 beyond reach; None if the end is."""
    level, now = [-1] * len(arcs), [start]
    level[start] = 0
    while now and level[end] < 0:
        then = []
        for a in now:
            for e in arcs[a]:
                if room[e] and level[to[e]] < 0:
                    level[to[e]] = level[a] + 1
                    then.append(to[e])
        now = then
    return level if level[end] >= 0 else None


def _block(arcs: list[list[int]], to: list[int], room: list[int], level: list[int], start: int, end: int) -> None:
    """Sends flow along arcs to the next level until every such path is blocked."""
    tried, path, a = [0] * len(arcs), [], start
    while True:
        if a == end:
            flow = min(room[e] for e in path)
            for e in path:
                room[e] -= flow
                room[e ^ 1] += flow
            full = next(i for i, e in enumerate(path) if not room[e])
            a = to[path[full] ^ 1]
            del path[full:]
            continue
        for i in range(tried[a], len(arcs[a])):
            e = arcs[a][i]
            if room[e] and level[to[e]] == level[a] + 1:
                tried[a] = i
                path.append(e)
                a = to[e]
                break
        else:
            tried[a] = len(arcs[a])
            if not path:
                return
            e = path.pop()
            a = to[e ^ 1]
            tried[a] += 1


def _keys(docs: DataFrame, seed: int, members: str | None, keep: Column) -> DataFrame:
    """keep, and what the mix knows of a document: size, pattern, home, order, part."""
    source = F.array(F.col("source").cast("string"))
    names = F.when(F.size(members) > 0, F.col(members).cast("array<string>")).otherwise(F.array(F.lit(None).cast("string"))) if members else source
    # A null source gets a name that no string has and that sorts last.
    keyed = F.transform(names, lambda x: F.concat(F.when(x.isNull(), "2").otherwise("1"), F.coalesce(x, F.lit(""))))
    order = F.xxhash64(F.lit(seed), F.col("doc_id"), F.col("text"))
    return docs.select(
        keep,
        F.regexp_count(F.coalesce(F.col("text").cast("string"), F.lit("")), F.lit(C.WORDS)).cast("bigint").alias("size"),
        F.element_at(keyed, 1).alias("home"),
        F.to_json(F.sort_array(F.array_distinct(keyed))).alias("pattern"),
        order.alias("order"),
        F.pmod(order, F.lit(PARTS)).alias("part"),
    )


#: Whether a row gets one more copy, given its keys and its pattern's line of the plan.
_EXTRA = "(part < cut_part OR part = cut_part AND order <= cut_order OR array_contains(more, order))"


def _plan(rows: DataFrame, wanted: list[tuple[str, int, int]]) -> DataFrame:
    """One line a pattern: base (copies of every document) and which documents
    get one more: parts below cut_part, orders up to cut_order within it, and
    the single orders in `more`. wanted: pattern, base, tokens besides."""
    spark, schema = rows.sparkSession, "pattern string, base bigint, rest bigint, cut_part bigint, cut_order bigint, more array<bigint>"
    rows = rows.filter("size > 0")
    want = F.broadcast(spark.createDataFrame([(p, b, r) for p, b, r in wanted], "pattern string, base bigint, rest bigint"))
    sums = rows.groupBy("pattern", "part").agg(F.sum("size").alias("tokens"))
    upto = F.sum("tokens").over(W.partitionBy("pattern").orderBy("part"))
    cuts = sums.withColumn("before", upto - F.col("tokens")).join(want, "pattern").filter("before <= rest AND rest < before + tokens")
    cuts = F.broadcast(cuts.select("pattern", "part", "before", "rest"))
    running = F.sum("size").over(W.partitionBy("pattern", "part").orderBy("order"))  # equal orders go together
    inside = rows.join(cuts, ["pattern", "part"]).withColumn("upto", F.col("before") + running).groupBy("pattern", "part").agg(F.max(F.when(F.col("upto") <= F.col("rest"), F.col("order"))).alias("last"))
    cut = {r["pattern"]: (r["part"], r["last"]) for r in inside.collect()}
    lowest = -(1 << 63)
    lines = {p: [p, b, r, *((cut[p][0], lowest if cut[p][1] is None else cut[p][1]) if p in cut else (PARTS if r else -1, lowest)), []] for p, b, r in wanted}
    for _ in range(TOP_UPS):
        known = rows.join(F.broadcast(spark.createDataFrame([tuple(x) for x in lines.values()], schema)), "pattern")
        short = known.groupBy("pattern", "rest").agg(F.sum(F.when(F.expr(_EXTRA), F.col("size")).otherwise(0)).alias("got")).select("pattern", (F.col("rest") - F.col("got")).alias("short")).filter("short > 0")
        free = known.filter("NOT " + _EXTRA).join(F.broadcast(short), "pattern").filter("size < 2 * short")
        best = free.groupBy("pattern").agg(F.min(F.struct(F.abs(F.col("size") - F.col("short")).alias("off"), "order")).alias("b")).collect()
        for r in best:
            lines[r["pattern"]][-1].append(r["b"]["order"])
        if not best:
            break
    return spark.createDataFrame([tuple(x) for x in lines.values()], schema)


def _solve(docs: DataFrame, seed: int, share: float, weights: Sequence[float], members: str | None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Keyed rows without text; the plan, a line a pattern; sources' sizes and targets."""
    spark = docs.sparkSession
    rows = C.materialize(_keys(docs, seed, members, F.col("doc_id").cast("bigint").alias("doc_id")), "sizes")
    # One row a pattern, not a document. The flow is solved here, so there is a bound.
    sums = rows.groupBy("pattern").agg(F.sum("size").alias("tokens")).limit(MAX_PATTERNS + 1).collect()
    if len(sums) > MAX_PATTERNS:
        raise ValueError(f"over {MAX_PATTERNS} patterns of sources: group sources before they are mixed")
    totals = sorted((r["pattern"], r["tokens"]) for r in sums)
    held = [json.loads(p) for p, _ in totals]
    sources = sorted({s for names in held for s in names}, key=lambda s: s.encode("utf-8", "surrogatepass"))
    place = {s: i for i, s in enumerate(sources)}
    patterns = [(frozenset(place[s] for s in names), tokens) for names, (_, tokens) in zip(held, totals)]
    sizes = [sum(tokens for of, tokens in patterns if i in of) for i in range(len(sources))]
    goals = targets(sizes, [weights[i % len(weights)] for i in range(len(sources))], share * sum(tokens for _, tokens in patterns))
    flows = route(patterns, [round(g) for g in goals])
    through = [sum(flows.get((i, s), 0) for s in of) for i, (of, _) in enumerate(patterns)]
    plan = _plan(rows, [(p, *divmod(f, t)) for (p, t), f in zip(totals, through) if t])
    facts = spark.createDataFrame(list(zip(sources, sizes, goals)), "home string, source_size bigint, target double")
    return rows, plan, facts


def mix(docs: DataFrame, seed: int = 7, share: float = SHARE, weights: Sequence[float] = WEIGHTS, members: str | None = None) -> DataFrame:
    """doc_id, size, source, source_size, target, copies, taken. `members`: a
    column with the array of all sources that hold a document, where they
    overlap; the first is its source. Else a document is in `source` alone."""
    rows, plan, facts = _solve(docs, seed, share, weights, members)
    out = rows.join(F.broadcast(facts), "home").join(F.broadcast(plan), "pattern", "left")
    copies = F.expr(f"if(size > 0, coalesce(base + cast({_EXTRA} as int), 0), 0)")
    return out.withColumn("copies", copies).select("doc_id", "size", F.expr("if(home like '1%', substring(home, 2), null)").alias("source"), "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))


def select(docs: DataFrame, seed: int = 7, share: float = SHARE, weights: Sequence[float] = WEIGHTS, members: str | None = None) -> DataFrame:
    """The documents of the mix, each as often as it is taken, with the columns
    they came with. The plan is broadcast (a line a pattern); texts stay where
    they are."""
    _, plan, _ = _solve(docs, seed, share, weights, members)
    keyed = _keys(docs, seed, members, F.struct(*C.columns_of(docs)).alias("whole")).filter("size > 0").join(F.broadcast(plan), "pattern")
    copies = F.expr(f"cast(base + cast({_EXTRA} as int) as int)")
    return keyed.select("whole", F.explode(F.array_repeat(F.lit(0), copies))).select("whole.*")
