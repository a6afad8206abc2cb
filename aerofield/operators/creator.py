"""From an environment model to areas, properties and links: a grid, and zones folded over its cells."""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.geometry import in_circle, in_rect
from ..functions.wind import from_math_direction


@dataclass(frozen=True)
class Grid:
    """A layer of equal cells; partial cells at the far sides are dropped."""

    low: tuple[float, float, float]
    high: tuple[float, float, float]
    cell: tuple[float, float, float]

    @property
    def nx(self) -> int:
        return max(0, int((self.high[0] - self.low[0]) // self.cell[0]))

    @property
    def ny(self) -> int:
        return max(0, int((self.high[1] - self.low[1]) // self.cell[1]))

    @classmethod
    def of(cls, grid: dict, lenient: bool = False) -> Grid:
        """From a model's grid; one with only ``extent_m`` has no cells unless ``lenient``."""
        zero = (0.0, 0.0, 0.0)
        high = grid.get("max") or (grid.get("extent_m") if lenient else None) or zero
        three = lambda v: tuple(float(x) for x in (*v, *zero)[:3])
        return cls(three(grid.get("min") or zero), three(high), three(grid["cell_m"]))


def cells(spark: SparkSession, grid: Grid) -> DataFrame:
    """(ord, area_id, bounds) of each cell, row by row; generated in parallel, without a shuffle."""
    nx = max(1, grid.nx)
    iy, ix = F.expr(f"id div {nx}"), F.expr(f"id % {nx}")
    (x0, y0, z0), (dx, dy, dz) = (tuple(map(F.lit, t)) for t in (grid.low, grid.cell))
    corner = lambda i, j, z: F.struct((x0 + (ix + i) * dx).alias("x"), (y0 + (iy + j) * dy).alias("y"), z.alias("z"))
    bounds = F.struct(corner(0, 0, z0).alias("min"), corner(1, 1, z0 + dz).alias("max"))
    return spark.range(grid.nx * grid.ny).select(F.col("id").alias("ord"), F.concat(F.lit("area_"), iy, F.lit("_"), ix).alias("area_id"), bounds.alias("bounds"))


def base_property(base: dict) -> Column:
    """A model's base state as struct<wind_velocity, temperature, sea_level_atm, gps_strength>, with defaults."""
    wind = base["wind"]
    w = F.array(*(F.lit(float(v)) for v in wind["vector_ms"])) if wind.get("vector_ms") is not None else from_math_direction(F.lit(float(wind["dir_deg"])), F.lit(float(wind["speed_ms"])))
    other = {"temperature": ("temperature_C", 20.0), "sea_level_atm": ("pressure_atm", 1.0), "gps_strength": ("gps_strength", 1.0)}
    return F.struct(w.alias("wind_velocity"), *(F.lit(float(base.get(key, default))).alias(name) for name, (key, default) in other.items()))


def contains(shape: dict, x: Column, y: Column) -> Column:
    """Whether a zone's shape contains a point, borders included; a shape of no known kind contains nothing."""
    lit = lambda *v: [F.lit(float(a)) for a in v]
    if "circle" in shape:
        c = shape["circle"]
        return in_circle(x, y, *lit(*c["center_m"], c["radius_m"]))
    if "rect" in shape:
        r = shape["rect"]
        if "min_m" in r and "size_m" in r:
            (x0, y0), (w, h) = r["min_m"], r["size_m"]
            return in_rect(x, y, *lit(x0, y0, x0 + w, y0 + h))
        if "min_m" in r and "max_m" in r:
            return in_rect(x, y, *lit(*r["min_m"], *r["max_m"]))
        (cx, cy), (w, h) = r["center_m"], r["size_m"]
        return in_rect(x, y, *lit(cx - w * 0.5, cy - h * 0.5, cx + w * 0.5, cy + h * 0.5))
    return F.lit(False)


def vortex(wind: list[Column], x: Column, y: Column, v: dict) -> list[Column]:
    """A whirl around a centre: gain / r, with a Gaussian decay if asked for, up to a largest speed."""
    cx, cy = (F.lit(float(c)) for c in v["center_m"])
    dx, dy = x - cx, y - cy
    r = F.sqrt(dx * dx + dy * dy)
    safe = F.when(r > 0, r)
    gain = F.lit(float(v["gain"])) / safe
    if v.get("decay") == "gaussian":
        sigma = float(v.get("sigma_m", 10.0))
        gain = gain * F.exp(-(r * r) / (2 * sigma * sigma))
    sign = 1.0 if v.get("clockwise", True) else -1.0
    vx, vy = gain * (-dy / safe) * sign, gain * (dx / safe) * sign
    if v.get("max_ms") is not None:
        top, speed = float(v["max_ms"]), F.sqrt(vx * vx + vy * vy)
        scale = F.when(speed > top, top / speed).otherwise(1.0)
        vx, vy = vx * scale, vy * scale
    far = r >= float(v.get("r_min_m", 0.1))
    return [F.when(far, wind[0] + vx).otherwise(wind[0]), F.when(far, wind[1] + vy).otherwise(wind[1]), wind[2]]


def uniform(key: Column, seed: int, k: int) -> Column:
    """A number in (0, 1) that depends on a key, a seed and a counter, and not on partitions."""
    h = F.conv(F.substring(F.md5(F.concat(key, F.lit(f"|{seed}|{k}"))), 1, 13), 16, 10).cast("double")
    return (h + 0.5) / float(1 << 52)


def normal(key: Column, seed: int, axis: int) -> Column:
    """A standard normal number by the Box-Muller transform."""
    return F.sqrt(F.log(uniform(key, seed, 2 * axis)) * -2.0) * F.cos(uniform(key, seed, 2 * axis + 1) * (2 * math.pi))


def turbulence(wind: list[Column], key: Column, t: dict) -> list[Column]:
    """Noise of a standard deviation: plain, halved ("perlin") or pulling back to calm ("ou")."""
    std, seed, kind = float(t["std_ms"]), int(t.get("seed") or 0), t["type"]
    if kind not in ("gauss", "perlin", "ou"):
        return wind
    part = 0.5 if kind == "perlin" else 1.0
    pull = 0.15 if kind == "ou" else 0.0
    return [w + normal(key, seed, i) * (std * part) - w * pull for i, w in enumerate(wind)]


Effect = Callable[[list[Column], Column, Column, Column, dict], list[Column]]

#: What each mode does to the wind at (x, y); ``key`` feeds the noise.
EFFECTS: dict[str, Effect] = {
    "absolute": lambda w, x, y, key, e: [F.lit(float(v)) for v in e["wind_ms"]],
    "scale": lambda w, x, y, key, e: [v * float(e["scale"]) for v in w],
    "add": lambda w, x, y, key, e: [v + float(a) for v, a in zip(w, e["add_ms"], strict=True)] if "add_ms" in e else w,
    "vortex": lambda w, x, y, key, e: vortex(w, x, y, e["vortex"]),
    "turbulence": lambda w, x, y, key, e: turbulence(w, key, e["turbulence"]),
}


def gps_after(gps: Column, e: dict) -> Column:
    """Set, add, scale, then clip to 0..1; zones clip one by one."""
    if "gps_abs" in e:
        gps = F.lit(float(e["gps_abs"]))
    if "gps_add" in e:
        gps = gps + float(e["gps_add"])
    if "gps_scale" in e:
        gps = gps * float(e["gps_scale"])
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), gps))


def in_order(zones: list[dict], order: str = "priority_desc") -> list[dict]:
    """Zones as they are applied: the highest priority first, so the lowest has the last word; ties as listed."""
    sign = -1 if order == "priority_desc" else 1
    return sorted(zones, key=lambda z: sign * z.get("priority", 0))


def fold_zones(areas: DataFrame, zones: list[dict], order: str = "priority_desc", at: Column | None = None) -> DataFrame:
    """Apply all zones that contain a cell's centre, in order, to its ``properties``.

    Zones are part of a small authored model, so each is one projection: no join and no shuffle.
    ``at`` is the time in seconds for zones with an ``active`` range or periodic ``time_mods``; without it they
    always act and nothing changes with time.
    """
    df = areas
    for z in in_order(zones, order):
        mid = lambda k: (F.col(f"bounds.min.{k}") + F.col(f"bounds.max.{k}")) * 0.5
        x, y = mid("x"), mid("y")
        hit = contains(z["shape"], x, y)
        if at is not None and z.get("active"):
            hit = hit & (at >= float(z["active"].get("t_from_s", -math.inf))) & (at < float(z["active"].get("t_to_s", math.inf)))
        wind = [F.element_at("properties.wind_velocity", i) for i in (1, 2, 3)]
        effect = EFFECTS.get(z["effect"]["mode"], lambda w, *_: w)
        new = effect(wind, x, y, F.concat(F.lit(z["name"] + "|"), "area_id"), z["effect"])
        gps = gps_after(F.col("properties.gps_strength"), z["effect"])
        if at is not None and z.get("time_mods"):
            new, gps = with_time(new, gps, z["time_mods"], at)
        p = F.col("properties")
        p = p.withField("wind_velocity", F.array(*new)).withField("gps_strength", gps)
        df = df.withColumn("properties", F.when(hit, p).otherwise(F.col("properties")))
    return df


def periodic(terms: list[dict], t: Column) -> Column:
    """Sum of amp * sin(2 pi freq t + phase); declared by models, evaluated here as an extension."""
    total = F.lit(0.0)
    for k in terms:
        total = total + float(k["amp"]) * F.sin(t * (2 * math.pi * float(k["freq_hz"])) + math.radians(float(k.get("phase_deg", 0.0))))
    return total


def with_time(wind: list[Column], gps: Column, mods: dict, t: Column) -> tuple[list[Column], Column]:
    """Add a zone's periodic terms at time t to what ``apply_to`` names: wind_x, wind_y, wind_z, gps (an extension; without it, the wind's x and y)."""
    wave, to = periodic(mods.get("periodic") or [], t), mods.get("apply_to") or ["wind_x", "wind_y"]
    wind = [w + wave if f"wind_{k}" in to else w for k, w in zip("xyz", wind, strict=True)]
    return wind, F.greatest(F.lit(0.0), F.least(F.lit(1.0), gps + wave)) if "gps" in to else gps


def whole(spark: SparkSession, model: dict, with_zones: bool = True, lenient: bool = False, order: str = "priority_desc") -> DataFrame:
    """(ord, area_id, bounds, properties): a model's areas, each with its own property in its row."""
    areas = cells(spark, Grid.of(model["grid"], lenient)).withColumn("properties", base_property(model["base"]))
    return fold_zones(areas, model.get("zones") or [], order) if with_zones else areas


def build(spark: SparkSession, model: dict, with_zones: bool = True, lenient: bool = False, order: str = "priority_desc") -> tuple[DataFrame, DataFrame, DataFrame]:
    """The area, property and link tables of a model."""
    areas = whole(spark, model, with_zones, lenient, order)
    pid = property_id()
    return areas.select("ord", "area_id", "bounds"), areas.select("ord", pid.alias("id"), "properties"), areas.select("ord", "area_id", pid.alias("area_property_id"))


def property_id() -> Column:
    """The id of a cell's own property."""
    return F.concat(F.lit("prop_"), "area_id")
