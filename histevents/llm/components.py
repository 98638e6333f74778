"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from histevents.llm.tables import stage


def _state(e: DataFrame):
    return tuple(e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first())


def connected_components(edges: DataFrame, u: str = "u", v: str = "v") -> DataFrame:
    """(node, root) for every node of an edge, root the smallest node it reaches.

    ``edges`` are pairs of longs in any direction, repeats allowed.  Each round
    replaces a node's edges by edges to its smallest neighbour: first for
    larger neighbours, then for smaller ones; it ends when the table stays the
    same, which is a star around each root.  A round is two grouped minimums
    (combined before the shuffle) and two equi-joins, whose hub nodes adaptive
    execution can split; no group is collected."""
    e = stage(
        edges.select(F.greatest(u, v).alias("u"), F.least(u, v).alias("v")).where("u <> v").distinct(), "edges")
    state = _state(e)
    while True:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(low, "u")
            .select(F.explode(F.array(F.struct("u", "m"), F.struct(F.col("v").alias("u"), "m"))).alias("x"))
            .select(F.col("x.u").alias("u"), F.col("x.m").alias("v")).where("u <> v").distinct())
        e, before = stage(small, "edges"), state
        state = _state(e)
        if state == before:
            return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
                e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
