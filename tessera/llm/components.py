"""Connected components of a link table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut


LINKS = 1 << 18  # links of one partition


def _star(edges: DataFrame, large: bool, partitions: int) -> DataFrame:
    """One star step: each node's neighbours (larger ones, or smaller ones) are linked to the
    smallest node of its neighbourhood. Minima are partial aggregates; the join can be split."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large else edges
    both = both.coalesce(partitions)
    lowest = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    kept = both.where("b > a") if large else both
    linked = kept.join(lowest, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    if not large:
        linked = linked.unionByName(lowest.select("a", F.col("m").alias("b")))
    linked = linked.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    return linked.coalesce(partitions).distinct().coalesce(partitions)


def components(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Label every node that has a link: ``links`` (a long, b long) -> (node, component), component
    being the smallest node reachable. Nodes without links are not returned; no link is dropped.

    The rounds stop when a round leaves the link table as it was (equal count and checksum); each
    round is a reliable checkpoint in as many partitions as its links need. Raises if ``max_rounds`` do not suffice.
    """
    edges = cut(links.where("a is not null and b is not null and a != b")
                .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    seen = None
    for _ in range(max_rounds):
        state = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first()
        if state[0] == 0 or state == seen:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
                edges.select(F.col("b").alias("node"), F.col("b").alias("component"))).distinct()
        seen = state
        partitions = -(-state[0] // LINKS)
        edges = cut(_star(_star(edges, True, partitions), False, partitions))
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
