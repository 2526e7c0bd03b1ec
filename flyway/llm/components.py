"""Connected components of an undirected graph given as an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut_lineage


def star_components(edges: DataFrame, max_rounds: int = 100) -> DataFrame:
    """(node, root) of every node with an edge; root is the smallest node reachable.

    ``edges`` has bigint columns a, b.  Alternating large-star and small-star rounds:
    each round hangs a node's larger neighbours, then its smaller ones, under the
    smallest neighbour, so the graph turns into one star per component in about
    log(longest path) rounds.  Each round is written to the shared scratch folder.
    Minima are pre-aggregated in the map tasks; they are written before they are
    joined back, so AQE can split the partition of a hub.
    """
    now = cut_lineage(_oriented(edges), "cc-edges")
    state = _fingerprint(now)
    for _ in range(max_rounds):
        both = now.select("a", "b").unionAll(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = cut_lineage(both.groupBy("a").agg(F.min("b").alias("m"))
                            .select("a", F.least("a", "m").alias("m")), "cc-min")
        large = _oriented(both.where("b > a").join(least, "a")
                          .select(F.col("b").alias("a"), F.col("m").alias("b")))
        large = cut_lineage(large, "cc-large")
        low = cut_lineage(large.groupBy("a").agg(F.min("b").alias("m")), "cc-low")
        small = (large.join(low, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .unionAll(low.select("a", F.col("m").alias("b"))))
        now = cut_lineage(_oriented(small), "cc-edges")
        before, state = state, _fingerprint(now)
        if state == before:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")


def _oriented(edges: DataFrame) -> DataFrame:
    return (edges.where("a <> b")
            .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())


def _fingerprint(edges: DataFrame):
    """Count and order-free hash sums of an edge set."""
    h = F.xxhash64("a", "b")
    r = edges.agg(F.count(F.lit(1)), F.sum(h.bitwiseAND(F.lit((1 << 31) - 1))),
                  F.sum(F.shiftrightunsigned(h, 33))).first()
    return tuple(r)
