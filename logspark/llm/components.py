"""Connected components of links between numbered nodes, as joins and grouped minima."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from logspark.llm.common import ensure_checkpoints


def _star(links: DataFrame, large: bool) -> DataFrame:
    """One contraction: each node's neighbours (the larger ones, or the smaller ones) point to its least neighbour."""
    if large:
        sides = links.select("u", "v").union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        sides = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = sides.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    joined = sides.join(least, "u")
    if large:
        return joined.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
    return (
        joined.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v")
        .union(least.where("u != m").select("u", F.col("m").alias("v"))).distinct()
    )


def components(links: DataFrame) -> DataFrame:
    """``links`` (u, v): rows of linked nodes. Returns (u, v): each linked node but the least of its
    component, with that least node.

    Large and small stars in turn until nothing changes, a number of rounds that grows with the
    logarithm of the longest chain. Links are joined with one least neighbour per node, so a node
    with very many links is split by adaptive execution. Each round is a checkpoint.
    """
    ensure_checkpoints(links.sparkSession)
    links = links.where("u != v").distinct().checkpoint()
    state = None
    while True:
        links = _star(_star(links, True), False).checkpoint()
        now = links.agg(
            F.count("*"), F.expr("bit_xor(xxhash64(u, v))"), F.expr("bit_xor(xxhash64(v, u, 7))")
        ).first()
        if tuple(now) == state or now[0] == 0:
            return links
        state = tuple(now)
