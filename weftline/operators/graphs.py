"""Tool graphs: edges from chains, walks of bounded length, chain checks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.functions import structured as S
from weftline.operators import scan
from weftline.scratch import materialize


def edges_from_chains(chains: DataFrame, graph: str, chain: str, nodes: str) -> DataFrame:
    """graph, src, dst, first: distinct edges between consecutive known tools.
    Unknown tools are skipped before pairing, so they don't break a link."""
    known = F.filter(chain, lambda c: F.array_contains(F.col(nodes), c))
    rows = chains.select(graph, F.posexplode(S.pairs(known)).alias("first", "e"))
    return rows.groupBy(graph, F.col("e.src").alias("src"), F.col("e.dst").alias("dst")).agg(F.min("first").alias("first"))


def edges_from_log(log: DataFrame, graph: str, order: list[str], node: str) -> DataFrame:
    """The same from rows in order."""
    out = scan.ordered(log, [graph], order).scan(_dst=scan.following(node)).rows
    return out.select(F.col(node).alias("src"), F.col("_dst").alias("dst")).filter("dst IS NOT NULL").distinct()


def walks(edges: DataFrame, least: int = 2, most: int = 5, graph: str | None = None) -> DataFrame:
    """All walks of `least` to `most` nodes, revisits allowed: (graph,) walk. One
    join with the edges for each further node; the number of walks is bounded by
    nodes x degree^(most - 1), so degree and length are what to limit."""
    by = [graph] if graph else []
    pairs = materialize(edges.select(*by, "src", "dst").distinct(), "edges")  # each length reads them again
    now = pairs.select(*by, F.array("src", "dst").alias("walk"))
    out = [now] if least <= 2 else []
    nodes = pairs.select(*by, F.col("src").alias("n")).unionByName(pairs.select(*by, F.col("dst").alias("n"))).distinct()
    if least <= 1:
        out.insert(0, nodes.select(*by, F.array("n").alias("walk")))
    for length in range(3, most + 1):
        tail = now.withColumn("_tail", F.element_at("walk", -1))
        now = tail.join(pairs.withColumnRenamed("src", "_tail"), [*by, "_tail"]).select(*by, F.concat("walk", F.array("dst")).alias("walk"))
        if length >= least:
            out.append(now)
    found = out[0]
    for more in out[1:]:
        found = found.unionByName(more)
    return found


def known_chains(df: DataFrame, chain: str, names: str) -> DataFrame:
    """Chains whose every member is a known tool."""
    return df.filter(S.subset(F.col(chain), F.col(names)))
