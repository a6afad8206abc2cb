"""What the zone editor works out: clicks, boxes of corners, zone documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.frames import enu_to_ros, ros_to_enu
from ..functions.wind import from_met_direction, js_round, to_met_direction
from ..sources import items
from .creator import contains

CIRCLE = "struct<center_m: array<double>, radius_m: double>"
RECT = "struct<min_m: array<double>, max_m: array<double>, center_m: array<double>, size_m: array<double>>"
VORTEX = "struct<center_m: array<double>, gain: double, decay: string, sigma_m: double, r_min_m: double, clockwise: boolean, max_ms: double>"
EFFECT = f"struct<mode: string, wind_ms: array<double>, scale: double, add_ms: array<double>, vortex: {VORTEX}, turbulence: struct<type: string, std_ms: double, seed: int>, gps_abs: double, gps_add: double, gps_scale: double>"
ZONE = f"struct<name: string, priority: int, shape: struct<circle: {CIRCLE}, rect: {RECT}>, effect: {EFFECT}, active: struct<t_from_s: double, t_to_s: double>>"


def clicked(x: Column, y: Column, zones: list[dict]) -> Column:
    """The name of the last zone in the list that a click hits, null for none."""
    hits = [F.when(contains(z["shape"], x, y), F.lit(z["name"])) for z in reversed(zones)]
    return F.coalesce(*hits) if hits else F.lit(None).cast("string")


def corner_box(ring: Column) -> Column:
    """The box around corners, to a tenth of a metre, halves up."""
    tenth = lambda c: js_round(c * 10) / 10
    side = lambda f, k: tenth(f(F.transform(ring, lambda p: p[k])))
    return F.struct(side(F.array_min, "x").alias("xmin"), side(F.array_min, "y").alias("ymin"), side(F.array_max, "x").alias("xmax"), side(F.array_max, "y").alias("ymax"))


def wind_from_editor(speed: Column, direction: Column, ros: bool = True) -> Column:
    """A zone's wind vector from the speed and the direction it comes from; zero stays zero."""
    w = from_met_direction(direction, speed)
    if not ros:
        return w
    r = enu_to_ros(w[0], w[1], w[2])
    return F.array(r["x"], r["y"], r["z"])


def wind_to_editor(wind_ms: Column, ros: bool = True) -> Column:
    """struct<speed, direction> of a zone's wind vector."""
    at = lambda i: F.coalesce(F.get(wind_ms, F.lit(i)), F.lit(0.0))
    e = ros_to_enu(at(0), at(1), at(2)) if ros else None
    return to_met_direction(e["x"], e["y"]) if ros else to_met_direction(at(0), at(1))


def exported(zones: DataFrame) -> DataFrame:
    """(name, json): each zone (a struct column ``zone``) as a document, with every effect's own fields."""
    return zones.select("zone.name", F.to_json("zone").alias("json"))


def imported(documents: DataFrame, to_enu: bool = False) -> DataFrame:
    """(ord, zone) of model documents (column ``json``): nothing is lost on the way back.

    With ``to_enu``, places and vectors of models in the robots' frame (meta.axis "ROS") are turned to east and north.
    Zones are split off one by one; a document that is no JSON raises.
    """
    axis = documents.select(F.get_json_object("json", "$.meta.axis").alias("axis"), "json")
    return _zones(items.of_column(axis, "json", "axis", ("zones",)).withColumnRenamed("document", "axis"), to_enu)


def imported_files(spark: SparkSession, path: str, to_enu: bool = False) -> DataFrame:
    """(ord, zone) as `imported` gives them, of the model documents at ``path``, which may be of any length."""
    axis = spark.read.schema("meta struct<axis: string>").option("multiLine", True).json(path).select(F.col("_metadata.file_path").alias("document"), F.col("meta.axis").alias("axis"))
    return _zones(items.of_files(spark, path, ("zones",)).join(F.broadcast(axis), "document", "left"), to_enu)


def _zones(found: DataFrame, to_enu: bool) -> DataFrame:
    df = found.select(F.upper("axis").alias("axis"), "ord", F.from_json("item", ZONE).alias("zone"))
    if to_enu:
        df = df.withColumn("zone", F.when(F.col("axis") == "ROS", _to_enu(F.col("zone"))).otherwise(F.col("zone")))
    return df.select("ord", "zone")


def _turned(v: Column) -> Column:
    """A place or vector of two or three numbers, null for null."""
    third = F.when(F.size(v) > 2, F.slice(v, 3, 1)).otherwise(F.array().cast("array<double>"))
    e = ros_to_enu(v[0], v[1], F.lit(0.0))
    return F.when(v.isNotNull(), F.concat(F.array(e["x"] + 0.0, e["y"] + 0.0), third))


def _to_enu(zone: Column) -> Column:
    r, c, e = zone["shape"]["rect"], zone["shape"]["circle"], zone["effect"]
    low, high = _turned(r["min_m"]), _turned(r["max_m"])
    size = F.when(r["size_m"].isNotNull(), F.array(r["size_m"][1], r["size_m"][0]))
    # a rectangle from its least corner and sides: its eastern corner is the western one, turned
    start = F.when(size.isNotNull() & low.isNotNull(), F.array(low[0] - size[0], low[1]))
    corner = lambda f: F.when(low.isNotNull() & high.isNotNull(), F.array(f(low[0], high[0]), f(low[1], high[1])))
    rect = r.withField("min_m", F.coalesce(corner(F.least), start)).withField("max_m", corner(F.greatest)).withField("center_m", _turned(r["center_m"])).withField("size_m", size)
    shape = zone["shape"].withField("rect", F.when(r.isNotNull(), rect)).withField("circle", F.when(c.isNotNull(), c.withField("center_m", _turned(c["center_m"]))))
    v = e["vortex"]
    effect = e.withField("wind_ms", _turned(e["wind_ms"])).withField("add_ms", _turned(e["add_ms"])).withField("vortex", F.when(v.isNotNull(), v.withField("center_m", _turned(v["center_m"]))))
    return zone.withField("shape", shape).withField("effect", effect)


def settings(documents: DataFrame, keep: list[str] = ()) -> DataFrame:
    """(low, high, cell, levels, wind, temperature, pressure, gps): the editor's grid and base of model documents, with its defaults; columns ``keep`` stay."""
    from ..sources.readers import models

    m = models(documents)
    # fixed values: the editor's defaults
    three = lambda c, d: F.array(*(F.coalesce(F.get(c, F.lit(i)), F.lit(x)) for i, x in enumerate(d)))
    return m.select(
        *keep, three(F.col("grid.min"), (-1000.0, -1000.0, 0.0)).alias("low"), three(F.col("grid.max"), (1000.0, 1000.0, 100.0)).alias("high"),
        three(F.col("grid.cell_m"), (100.0, 100.0, 100.0)).alias("cell"), F.coalesce("grid.levels", F.lit(1)).alias("levels"),
        three(F.col("base.wind.vector_ms"), (4.0, 0.0, 0.0)).alias("wind"), F.coalesce("base.temperature_C", F.lit(20.0)).alias("temperature"),
        F.coalesce("base.pressure_atm", F.lit(1.0)).alias("pressure"), F.coalesce("base.gps_strength", F.lit(1.0)).alias("gps"),
    )


def styled(zones: DataFrame) -> DataFrame:
    """(name, priority, mode, kind, colour, weight, fill, gps, wind, std, seed): how a read-only map draws zones of known shape."""
    z = lambda k: F.col(f"zone.{k}")
    rect = z("shape.rect.min_m").isNotNull() & z("shape.rect.max_m").isNotNull()
    circle = z("shape.circle.center_m").isNotNull() & z("shape.circle.radius_m").isNotNull()
    df = zones.where(rect | circle)
    # fixed values: the map's colours and line
    return df.select(
        F.coalesce(z("name"), F.lit("")).alias("name"), z("priority").alias("priority"), F.coalesce(z("effect.mode"), F.lit("absolute")).alias("mode"),
        F.when(rect, "rect").otherwise("circle").alias("kind"), F.when(rect, "#e67e22").otherwise("#27ae60").alias("colour"), F.lit(2).alias("weight"), F.lit(0.08).alias("fill"),
        z("effect.gps_abs").alias("gps"), z("effect.wind_ms").alias("wind"), z("effect.turbulence.std_ms").alias("std"), z("effect.turbulence.seed").alias("seed"),
    )
