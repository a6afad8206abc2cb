"""Wind directions, compass arithmetic and number formats."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def from_math_direction(deg: Column, speed: Column) -> Column:
    """array<double> of a speed towards a mathematical angle."""
    return F.array(speed * F.cos(F.radians(deg)), speed * F.sin(F.radians(deg)), F.lit(0.0))


def from_met_direction(deg: Column, speed: Column) -> Column:
    """array<double> of a wind that blows from a compass direction."""
    to = F.radians(F.pmod(deg + 180, F.lit(360)))
    return F.array(speed * F.sin(to), speed * F.cos(to), F.lit(0.0))


def js_round(x: Column) -> Column:
    """Halves go up."""
    return F.floor(x + 0.5)


def to_met_direction(vx: Column, vy: Column) -> Column:
    """struct<speed, direction>: speed to one decimal, and the compass direction the wind comes from."""
    return F.struct((js_round(F.hypot(vx, vy) * 10) / 10).alias("speed"), js_round(F.pmod(F.degrees(F.atan2(vx, vy)) + 180, F.lit(360.0))).alias("direction"))


def compass_from_pointer(dx: Column, dy: Column) -> Column:
    """Degrees clockwise from north of a pointer offset on a screen (y grows downwards)."""
    return F.pmod(F.degrees(F.atan2(dx, -dy)), F.lit(360.0))


def snapped(deg: Column, step: int = 45) -> Column:
    return F.pmod(js_round(F.pmod(deg, F.lit(360.0)) / step) * step, F.lit(360))


def compact(x: Column) -> Column:
    """Six decimals without trailing zeros or point: 100 -> 100, 10.5 -> 10.5."""
    text = F.regexp_replace(F.format_string("%.6f", x), r"\.?0+$", "")
    return F.when(x.isNotNull(), text)


def search_cost(n: Column, depth: Column) -> Column:
    """struct<branching, cost> of a balanced tree over n boxes, to three decimals; zeros for none."""
    bf = F.pow(n.cast("double"), F.lit(1.0) / F.when(depth > 0, depth))
    cost = depth * (1 + F.log2(bf) / 4)
    ok = (n > 0) & (depth > 0)
    return F.struct(F.when(ok, F.bround(bf, 3)).otherwise(0.0).alias("branching"), F.when(ok, F.bround(cost, 3)).otherwise(0.0).alias("cost"))
