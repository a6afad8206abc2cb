"""A bounding-volume tree as a table, for analysis; lookups use the bucket join."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def tree_nodes(areas: DataFrame, max_depth: int = 5, leaf_capacity: int = 1) -> DataFrame:
    """(node, depth, is_leaf, ids, bounds) of a tree over ``areas`` (area_id, ord, bounds), level by level.

    A node splits at the median of its areas, ordered by their lower side on the axis on which
    their centres spread most (the first of equals), until it has ``leaf_capacity`` areas or
    lies at ``max_depth``.  Children of node n are 2n and 2n + 1; the root is 1.  Each level
    is one window over the whole table, so the number of steps is the depth.
    """
    mid = lambda k: (F.col(f"bounds.min.{k}") + F.col(f"bounds.max.{k}")) / 2
    df = areas.select("area_id", "ord", "bounds", F.lit(1).cast("long").alias("node"), F.lit(0).alias("depth"), F.lit(False).alias("leaf"))
    for depth in range(max_depth + 1):
        own = Window.partitionBy("node")
        df = df.withColumn("n", F.count("*").over(own))
        df = df.withColumn("leaf", (F.col("n") <= leaf_capacity) | F.lit(depth == max_depth) | F.col("leaf"))
        spread = [F.max(mid(k)).over(own) - F.min(mid(k)).over(own) for k in "xyz"]
        df = df.withColumn("s", F.array(*spread))
        axis = F.array_position("s", F.array_max("s"))
        low = F.when(axis == 1, F.col("bounds.min.x")).when(axis == 2, F.col("bounds.min.y")).otherwise(F.col("bounds.min.z"))
        df = df.withColumn("low", low).withColumn("at", F.row_number().over(own.orderBy("low", "ord")) - 1)
        child = F.col("node") * 2 + (F.col("at") >= F.expr("n div 2")).cast("long")
        df = df.withColumn("node", F.when(F.col("leaf"), F.col("node")).otherwise(child)).withColumn("depth", F.when(F.col("leaf"), F.col("depth")).otherwise(F.col("depth") + 1))
        df = df.withColumn("ord", F.when(F.col("leaf"), F.col("ord")).otherwise(F.col("at"))).select("area_id", "ord", "bounds", "node", "depth", "leaf")
    corner = lambda f, s: F.struct(*(f(f"bounds.{s}.{k}").alias(k) for k in "xyz")).alias(s)
    box = F.struct(corner(F.min, "min"), corner(F.max, "max"))
    up = df.withColumn("node", F.explode(F.expr("transform(sequence(0, depth), d -> shiftright(node, d))"))).withColumn("level", F.floor(F.log2("node")).cast("int"))
    return up.groupBy("node", F.col("level").alias("depth")).agg(F.max(F.col("depth") == F.col("level")).alias("is_leaf"), F.transform(F.array_sort(F.collect_list(F.when(F.col("depth") == F.col("level"), F.struct("ord", "area_id", "bounds")))), lambda a: a).alias("areas"), box.alias("bounds"))


def tree_stats(nodes: DataFrame) -> DataFrame:
    """(max_depth, leaves, average_leaf) of a tree."""
    return nodes.agg(F.max("depth").alias("max_depth"), F.count_if("is_leaf").alias("leaves"), F.avg(F.when(F.col("is_leaf"), F.size("areas"))).alias("average_leaf"))


def tree_search(points: DataFrame, nodes: DataFrame, key: list[str], max_depth: int, precise: bool = True) -> DataFrame:
    """(key, visited, found): boxes looked at on the way down, and the areas found, at most one a leaf if ``precise``.

    Works level by level on nodes that hold the point, so a point only meets the nodes on its way.
    """
    at = lambda b: ((F.col("x") >= b["min"]["x"]) & (F.col("x") < b["max"]["x"]) & (F.col("y") >= b["min"]["y"]) & (F.col("y") < b["max"]["y"]) & (F.col("z") >= b["min"]["z"]) & (F.col("z") < b["max"]["z"]))
    here = points.withColumn("node", F.lit(1).cast("long"))
    seen = points.select(*key, F.lit(1).alias("visited"), F.array().cast("array<string>").alias("found"))
    for _ in range(max_depth + 1):
        inside = here.join(nodes, "node").where(at(F.col("bounds")))
        leaf = inside.where("is_leaf")
        hit = F.transform("areas", lambda a: at(a["bounds"]))
        first = F.array_position(hit, True)
        found = F.when(first > 0, F.array(F.element_at("areas", first.cast("int"))["area_id"])).otherwise(F.array().cast("array<string>"))
        looks = F.when(first > 0, first).otherwise(F.size("areas")).cast("int")
        part = leaf.select(*key, looks.alias("visited"), found.alias("found")) if precise else leaf.select(*key, F.lit(0).alias("visited"), F.transform("areas", lambda a: a["area_id"]).alias("found"))
        seen = seen.unionByName(part)
        down = inside.where("not is_leaf").select(*key, "x", "y", "z", F.explode(F.array(F.col("node") * 2, F.col("node") * 2 + 1)).alias("node"))
        here = down.join(nodes.select("node", F.col("bounds").alias("b")), "node").where(at(F.col("b"))).drop("b")
        seen = seen.unionByName(here.select(*key, F.lit(1).alias("visited"), F.array().cast("array<string>").alias("found")))
    return seen.groupBy(*key).agg(F.sum("visited").alias("visited"), F.array_sort(F.flatten(F.collect_list("found"))).alias("found"))
