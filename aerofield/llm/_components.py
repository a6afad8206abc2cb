"""Connected components of a link table, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._shared import shared_dir


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.xxhash64("u", "v") % 1000003)).first())


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of ``edges`` (u, v): root is the smallest node reachable.

    Large-star and small-star steps alternate until the links no longer change;
    each round keeps no more links than nodes times two and is checkpointed.
    Minima are pre-aggregated, so that a node with many links needs no task of its own.
    """
    shared_dir(edges.sparkSession)
    both = lambda e: e.select("u", "v").unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    edges = edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct().checkpoint()
    state = _state(edges)
    while state[0]:
        arcs = both(edges)
        low = arcs.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = arcs.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(low.select("u", F.col("m").alias("v"))).where("u <> v").distinct()
        edges = small.checkpoint()
        if (now := _state(edges)) == state:
            break
        state = now
    roots = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
