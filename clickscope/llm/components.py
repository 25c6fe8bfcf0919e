"""Connected components of a distributed edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickscope.llm.common import durable

MAX_ROUNDS = 100


def connected_components(edges: DataFrame) -> DataFrame:
    """Smallest reachable node of every node that has an edge.

    ``edges`` has two columns of one ordered type, one row per undirected
    link; repeated links, loops and either direction are fine, nulls are
    ignored. Returns (node, component).

    Alternating large-star and small-star rounds: every node first hooks its
    larger neighbours, then its smaller ones, to the smallest node it knows.
    A component becomes one star in about log2(its diameter) rounds. Minima
    are plain aggregates with map-side combine and go back to the edges by an
    equi-join, so the centre of a very large star is no single task's load.
    Each round is written to the shared checkpoint folder.
    """
    a, b = edges.columns
    links = (edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
             .where("u is not null and v is not null and u != v").distinct())
    links = durable(links)
    before = None
    for _ in range(MAX_ROUNDS):
        links = durable(_small_star(_large_star(links)))
        state = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(state) == before:
            break
        before = tuple(state)
    else:
        raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
    return (links.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("component"))
            .unionByName(links.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()))


def _large_star(links: DataFrame) -> DataFrame:
    """Hook every larger neighbour of a node to the smallest node near it."""
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy(F.col("u").alias("c")).agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return (both.where("v > u").join(low, F.col("u") == F.col("c"))
            .select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct())


def _small_star(links: DataFrame) -> DataFrame:
    """Hook a node and its smaller neighbours to the smallest of them."""
    low = links.groupBy(F.col("u").alias("c")).agg(F.min("v").alias("m"))
    hooked = (links.join(low, F.col("u") == F.col("c"))
              .select(F.col("v").alias("u"), F.col("m").alias("v")))
    return hooked.unionByName(low.select(F.col("c").alias("u"), F.col("m").alias("v"))).where("u != v").distinct()
