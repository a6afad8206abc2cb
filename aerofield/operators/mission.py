"""Missions: waypoints to commands and back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.frames import TransverseMercator, enu_to_lonlat, lonlat_to_enu
from ..functions.wind import js_round

COMMAND = "struct<command: string, parameters: struct<height: double, timeout_sec: double, duration_sec: double, x: double, y: double, z: double, speed: double, yaw_deg: double>>"


def heading(d_lon: Column, d_lat: Column) -> Column:
    """Whole degrees clockwise from north; 0 for no movement."""
    return F.when((d_lon == 0) & (d_lat == 0), F.lit(0)).otherwise(js_round(F.degrees(F.atan2(d_lon, d_lat))))


def segment_yaw(lat: str, lon: str, window) -> Column:
    """The heading from the waypoint before; 0 for the first."""
    before = lambda c: F.lag(c).over(window)
    return F.when(before(lat).isNull(), F.lit(0)).otherwise(heading(F.col(lon) - before(lon), F.col(lat) - before(lat)))


def with_defaults(waypoints: DataFrame, alt: float = 20.0, speed: float = 10.0) -> DataFrame:
    return waypoints.withColumn("alt", F.coalesce("alt", F.lit(alt))).withColumn("speed", F.coalesce("speed", F.lit(speed))).withColumn("sleep_before", F.coalesce("sleep_before", F.lit(0.0)))


def missions(waypoints: DataFrame, origin: tuple[float, float], takeoff_s: float = 6000.0, move_s: float = 6000.0) -> DataFrame:
    """(mission, step, command, parameters): takeoff, then a move per waypoint (with a sleep before it if asked for), then land.

    ``waypoints`` are (mission, seq, lat, lon, alt, speed, yaw_deg, sleep_before).
    """
    w = Window.partitionBy("mission").orderBy("seq")
    x, y = lonlat_to_enu(F.col("lon"), F.col("lat"), *origin, projection=TransverseMercator())
    df = with_defaults(waypoints).withColumn("yaw", F.coalesce(F.col("yaw_deg"), segment_yaw("lat", "lon", w).cast("double")))
    df = df.withColumn("n", F.row_number().over(w)).withColumn("last", F.lead("seq").over(w).isNull()).withColumn("rx", F.round(y, 3)).withColumn("ry", F.round(-x, 3))
    fields = ("height", "timeout_sec", "duration_sec", "x", "y", "z", "speed", "yaw_deg")
    par = lambda **k: F.struct(*(k.get(f, F.lit(None)).cast("double").alias(f) for f in fields))
    cmd = lambda order, name, p=None: F.struct(F.lit(order).alias("k"), F.lit(name).alias("command"), (par() if p is None else p).alias("parameters"))
    steps = F.array(
        F.when(F.col("n") == 1, cmd(0, "takeoff", par(height=F.col("alt"), timeout_sec=F.lit(takeoff_s)))),
        F.when(F.col("sleep_before") > 0, cmd(1, "sleep", par(duration_sec=F.col("sleep_before")))),
        cmd(2, "moveToPosition", par(x=F.col("rx"), y=F.col("ry"), z=F.col("alt"), speed=F.col("speed"), yaw_deg=F.col("yaw"), timeout_sec=F.lit(move_s))),
        F.when(F.col("last"), cmd(3, "land")),
    )
    flat = df.select("mission", "n", F.explode(F.filter(steps, lambda s: s.isNotNull())).alias("s"))
    return flat.select("mission", F.row_number().over(Window.partitionBy("mission").orderBy("n", "s.k")).alias("step"), "s.command", "s.parameters")


def documents(commands: DataFrame) -> DataFrame:
    """(value): one JSON document {"id", "mission": [...]} a mission, commands in order, nulls left out."""
    each = F.transform(F.array_sort(F.collect_list(F.struct("step", "command", "parameters"))), lambda c: F.struct(c["command"].alias("command"), c["parameters"].alias("parameters")))
    return commands.groupBy("mission").agg(each.alias("m")).select(F.to_json(F.struct(F.col("mission").alias("id"), F.col("m").alias("mission"))).alias("value"))


def polyline(waypoints: DataFrame, origin: tuple[float, float]) -> DataFrame:
    """(mission, place, lat, lon): the line from the origin (place 0) over the waypoints in order."""
    own = waypoints.select("mission", F.row_number().over(Window.partitionBy("mission").orderBy("seq")).alias("place"), "lat", "lon")
    start = waypoints.select("mission").distinct().select("mission", F.lit(0).alias("place"), F.lit(float(origin[0])).alias("lat"), F.lit(float(origin[1])).alias("lon"))
    return start.unionByName(own)


def carried_sleep(commands: DataFrame) -> DataFrame:
    """Moves of (mission, step, command, duration_sec, ...) with the last sleep since the move before, 0 without one."""
    w = Window.partitionBy("mission").orderBy("step")
    df = commands.withColumn("_move", F.sum(F.when(F.col("command") == "moveToPosition", 1).otherwise(0)).over(w.rowsBetween(Window.unboundedPreceding, -1)))
    own = Window.partitionBy("mission", "_move").orderBy("step").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    df = df.withColumn("_move", F.coalesce("_move", F.lit(0)))
    df = df.withColumn("sleep_before", F.coalesce(F.last(F.when(F.col("command") == "sleep", F.col("duration_sec")), ignorenulls=True).over(own), F.lit(0.0)))
    return df.where("command = 'moveToPosition'").drop("_move")


def imported(commands: DataFrame, origin: tuple[float, float]) -> DataFrame:
    """Waypoints (mission, step, lat, lon, alt, speed, yaw_deg, sleep_before) of command rows."""
    flat = commands.select("mission", "step", "command", "parameters.*")
    lon, lat = enu_to_lonlat(-F.col("y"), F.col("x"), *origin, projection=TransverseMercator())
    return carried_sleep(flat).select("mission", "step", lat.alias("lat"), lon.alias("lon"), F.col("z").alias("alt"), "speed", "yaw_deg", "sleep_before")


def with_yaw(track: DataFrame, key: str, order: str, lat: str, lon: str) -> DataFrame:
    return track.withColumn("yaw", segment_yaw(lat, lon, Window.partitionBy(key).orderBy(order)))
