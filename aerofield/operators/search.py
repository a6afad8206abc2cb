"""Which areas hold a point, and what holds there."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from ..functions.geometry import in_box
from .stabbing import stabbed

#: Areas of a bucket up to which a point is held against each.
CROWD = 1024


def _levels(areas: DataFrame, cell: tuple[float, float]) -> DataFrame:
    """Areas with the coarseness at which they overlap at most two buckets along each axis."""
    wide = F.greatest((F.col("bounds.max.x") - F.col("bounds.min.x")) / cell[0], (F.col("bounds.max.y") - F.col("bounds.min.y")) / cell[1])
    return areas.withColumn("_level", F.greatest(F.lit(0), F.ceil(F.log2(F.when(wide > 0, wide)))).cast("int"))


def natural_cell(areas: DataFrame) -> tuple[float, float]:
    """Median sides of the areas: the grid's own cell if they are a grid."""
    side = lambda k: F.col(f"bounds.max.{k}") - F.col(f"bounds.min.{k}")
    r = areas.agg(F.percentile_approx(side("x"), 0.5).alias("x"), F.percentile_approx(side("y"), 0.5).alias("y")).first()
    return (r.x or 1.0, r.y or 1.0)


def _spread(areas: DataFrame, cell: tuple[float, float] | None) -> tuple[DataFrame, list[int], tuple[float, float]]:
    """Areas with each bucket (_level, _bx, _by) they overlap, one to four; the levels in use, a few; the finest cell."""
    cell = cell or natural_cell(areas)
    leveled = _levels(areas, cell).where("_level is not null")
    levels = sorted(r[0] for r in leveled.select("_level").distinct().collect())
    span = lambda k, c: F.explode(F.sequence(_bucket(F.col(f"bounds.min.{c}"), cell[k], F.col("_level")), _bucket(F.col(f"bounds.max.{c}"), cell[k], F.col("_level"))))
    return leveled.withColumn("_bx", span(0, "x")).withColumn("_by", span(1, "y")), levels, cell


def _bucket(x: Column, side: float, level: Column) -> Column:
    return F.floor(x / (F.lit(side) * F.pow(F.lit(2.0), level)))


def area_hits(points: DataFrame, areas: DataFrame, cell: tuple[float, float] | None = None) -> DataFrame:
    """``points`` (with x, y, z) joined with every area (area_id, bounds, ...) whose half-open box holds them.

    A range join as an equi-join: an area goes to the one to four buckets of a grid that it overlaps,
    the grid's cells doubling until the area is no larger than one, and a point looks up its bucket
    on each level in use.  No bucket of the join is a nested loop, large boxes need no side
    branch, and a point meets an area at most once.  Spark broadcasts the areas if they are
    small and splits crowded buckets if not.  Points with null coordinates match nothing.
    """
    spread, levels, cell = _spread(areas, cell)
    if not levels:
        return points.join(areas, F.lit(False))
    level = F.explode(F.array(*map(F.lit, levels))) if len(levels) > 1 else F.lit(levels[0])
    probes = points.where("x is not null and y is not null and z is not null").withColumn("_level", level)
    probes = probes.withColumn("_bx", _bucket(F.col("x"), cell[0], F.col("_level"))).withColumn("_by", _bucket(F.col("y"), cell[1], F.col("_level")))
    at = lambda s: tuple(F.col(f"bounds.{s}.{k}") for k in "xyz")
    found = probes.join(spread, ["_level", "_bx", "_by"]).where(in_box(F.col("x"), F.col("y"), F.col("z"), at("min"), at("max")))
    return found.drop("_level", "_bx", "_by")


def primary_area(points: DataFrame, areas: DataFrame, cell: tuple[float, float] | None = None, carry: tuple[str, ...] = ()) -> DataFrame:
    """``points`` with the area_id, and columns ``carry``, of the first area (by ord) that holds them, null if none does.

    Each bucket becomes one row with its areas in order, and a point picks the first that holds
    it: one left join per level in use and no grouping, so that points are not shuffled
    at all while the bucket table is small enough for Spark to broadcast.  Where a bucket has more than `CROWD`
    areas, a point would be held against too many: `stabbing.stabbed` then finds the first of each place.
    """
    spread, levels, cell = _spread(areas.select("area_id", "ord", "bounds", *carry), cell)
    if crowded(spread):
        return _first_of_crowd(points, areas, carry)
    each = F.array_sort(F.collect_list(F.struct("ord", "area_id", "bounds", *carry)))
    inside = lambda a: in_box(F.col("x"), F.col("y"), F.col("z"), *(tuple(a["bounds"][s][k] for k in "xyz") for s in ("min", "max")))
    df, picks = points, []
    for n in levels:
        buckets = spread.where(F.col("_level") == n).groupBy("_bx", "_by").agg(each.alias(f"_areas{n}"))
        df = df.withColumn("_bx", _bucket(F.col("x"), cell[0], F.lit(n))).withColumn("_by", _bucket(F.col("y"), cell[1], F.lit(n))).join(buckets, ["_bx", "_by"], "left")
        first = F.get(F.filter(f"_areas{n}", lambda a: F.coalesce(inside(a), F.lit(False))), F.lit(0))
        df = df.withColumn(f"_pick{n}", F.struct(*(first[c].alias(c) for c in ("ord", "area_id", *carry)))).drop("_bx", "_by", f"_areas{n}")
        picks.append(f"_pick{n}")
    if not picks:
        return points.withColumns({c: F.lit(None).cast(areas.schema[c].dataType) for c in ("area_id", *carry)})
    best = F.array_min(F.filter(F.array(*picks), lambda p: p["area_id"].isNotNull())) if len(picks) > 1 else F.col(picks[0])
    return df.withColumns({c: best[c] for c in ("area_id", *carry)}).drop(*picks)


def crowded(spread: DataFrame) -> bool:
    """Whether a bucket has more than `CROWD` areas, all with whole numbers as ord."""
    if not isinstance(spread.schema["ord"].dataType, IntegralType):
        return False
    n = spread.groupBy("_level", "_bx", "_by").agg(F.count("*").alias("n"), F.count("ord").alias("known")).agg(F.max("n").alias("n"), F.min(F.col("n") == F.col("known")).alias("known")).first()
    return bool(n["known"]) and n["n"] > CROWD


def _first_of_crowd(points: DataFrame, areas: DataFrame, carry: tuple[str, ...]) -> DataFrame:
    at = F.col("x"), F.col("y"), F.col("z")
    inside = in_box(*at, *(tuple(F.col(f"bounds.{s}.{k}") for k in "xyz") for s in ("min", "max")))
    first = stabbed(points, areas, counted=False).withColumnRenamed("first_ord", "ord").join(areas.select("ord", "area_id", "bounds", *carry), "ord").where(inside)
    best = first.groupBy(*(F.col(c).alias(f"_{c}") for c in "xyz")).agg(F.min(F.struct("ord", "area_id", *carry)).alias("_best"))
    found = points.join(best, [F.col(c).cast("double") == F.col(f"_{c}") for c in "xyz"], "left")
    return found.withColumns({c: F.col("_best")[c] for c in ("area_id", *carry)}).drop("_x", "_y", "_z", "_best")


def last_of(df: DataFrame, key: str, order: str = "ord") -> DataFrame:
    """One row per key, the last: repeated keys replace each other."""
    row = F.max_by(F.struct("*"), F.col(order)).alias("r")
    return df.groupBy(key).agg(row).select("r.*")


def property_of(df: DataFrame, links: DataFrame, properties: DataFrame) -> DataFrame:
    """``df`` (with area_id) with area_property_id and properties; null where link or property is missing."""
    link = last_of(links, "area_id").select("area_id", "area_property_id")
    prop = last_of(properties, "id").select(F.col("id").alias("area_property_id"), "properties")
    return df.join(link.join(prop, "area_property_id", "left"), "area_id", "left")


def visual_areas(areas: DataFrame, links: DataFrame, properties: DataFrame) -> DataFrame:
    """A row per link with a known area and property: every link row counts."""
    a = last_of(areas, "area_id").select("area_id", "bounds")
    p = last_of(properties, "id").select(F.col("id").alias("area_property_id"), "properties")
    return links.select("area_id", "area_property_id").join(a, "area_id").join(p, "area_property_id")


def integrity(areas: DataFrame, links: DataFrame, properties: DataFrame) -> DataFrame:
    """(problem, id) of areas, links and properties that miss each other."""
    a, p = areas.select("area_id").distinct(), properties.select(F.col("id").alias("area_property_id")).distinct()
    link = last_of(links, "area_id").select("area_id", "area_property_id")
    out = lambda name, df, c: df.select(F.lit(name).alias("problem"), F.col(c).alias("id")).distinct()
    return (
        out("areas_without_link", a.join(link, "area_id", "left_anti"), "area_id")
        .unionByName(out("links_to_missing_property", link.join(p, "area_property_id", "left_anti"), "area_id"))
        .unionByName(out("properties_unreferenced", p.join(link, "area_property_id", "left_anti"), "area_property_id"))
        .unionByName(out("links_to_missing_area", link.join(a, "area_id", "left_anti"), "area_id"))
    )


def inspected(areas: DataFrame, links: DataFrame, properties: DataFrame) -> DataFrame:
    """(area_id, bounds, area_property_id, properties, has_property) of each area."""
    return property_of(last_of(areas, "area_id").select("area_id", "bounds"), links, properties).withColumn("has_property", F.col("properties").isNotNull())


def explained(points: DataFrame, areas: DataFrame, links: DataFrame, properties: DataFrame, key: list[str]) -> DataFrame:
    """``points`` with hits, primary area, its link, has_property and a text that tells them."""
    hits = area_hits(points, areas.select("area_id", "ord", "bounds")).groupBy(*key).agg(F.transform(F.array_sort(F.collect_list(F.struct("ord", "area_id"))), lambda h: h["area_id"]).alias("hits"))
    df = points.join(hits, key, "left").withColumn("hits", F.coalesce("hits", F.array().cast("array<string>"))).withColumn("area_id", F.get("hits", F.lit(0)))
    df = property_of(df, links, properties).withColumn("has_property", F.col("properties").isNotNull())
    text = F.concat_ws("\n", F.format_string("point (%.3f, %.3f, %.3f)", "x", "y", "z"), F.concat(F.lit("hits: "), F.size("hits")), F.concat(F.lit("primary: "), F.coalesce("area_id", F.lit("none"))), F.concat(F.lit("property: "), F.coalesce("area_property_id", F.lit("none"))))
    return df.withColumn("text", text)


def disturbance(props: Column) -> Column:
    """What a vehicle feels: zeros where nothing is known, and the signal strength only if there is one."""
    w = props["wind_velocity"]
    ok = F.coalesce(F.size(w) >= 3, F.lit(False))
    axis = lambda i: F.when(ok, F.coalesce(F.get(w, F.lit(i)), F.lit(0.0))).otherwise(0.0)
    gps = props["gps_strength"]
    return F.struct(
        F.struct(axis(0).alias("x"), axis(1).alias("y"), axis(2).alias("z")).alias("d_wind"),
        F.coalesce(props["temperature"], F.lit(0.0)).alias("d_temp"), F.coalesce(props["sea_level_atm"], F.lit(0.0)).alias("d_atm"),
        F.when(gps.isNotNull(), F.array(F.struct(F.array(gps).alias("data")))).alias("d_user_custom"),
    )
