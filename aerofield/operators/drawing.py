"""What a map of areas shows: colours, arrows, limits, as tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def value_range(areas: DataFrame, value: str) -> DataFrame:
    """One row (vmin, vmax): 0 and 1 without values, widened by 0.1 to both sides where all are equal."""
    r = areas.agg(F.coalesce(F.min(value), F.lit(0.0)).alias("lo"), F.coalesce(F.max(value), F.lit(1.0)).alias("hi"))
    flat = F.abs(F.col("hi") - F.col("lo")) < 1e-6
    return r.select(F.when(flat, F.col("lo") - 0.1).otherwise(F.col("lo")).alias("vmin"), F.when(flat, F.col("hi") + 0.1).otherwise(F.col("hi")).alias("vmax"))


def painted(areas: DataFrame, value: str) -> DataFrame:
    """``areas`` (xmin, ymin, xmax, ymax, value) with the colour place 0..1 of the value and the rectangle's width and height."""
    df = areas.join(F.broadcast(value_range(areas, value)))  # one row
    return df.withColumn("place", (F.coalesce(value, F.lit(0.0)) - F.col("vmin")) / (F.col("vmax") - F.col("vmin"))).withColumn("width", F.col("xmax") - F.col("xmin")).withColumn("height", F.col("ymax") - F.col("ymin")).drop("vmin", "vmax")


def weakness_alpha(gps: Column) -> Column:
    """Opacity of the red that marks weak signals."""
    return F.least(F.lit(0.5), 1.0 - gps)


def scene(areas: DataFrame) -> DataFrame:
    """One row: extent, smallest cell sides, and the axis limits a metre around."""
    a = areas.agg(F.min("xmin").alias("xmin"), F.max("xmax").alias("xmax"), F.min("ymin").alias("ymin"), F.max("ymax").alias("ymax"), F.min(F.col("xmax") - F.col("xmin")).alias("cell_dx"), F.min(F.col("ymax") - F.col("ymin")).alias("cell_dy"))
    return a.withColumns({"xlim_low": F.col("xmin") - 1.0, "xlim_high": F.col("xmax") + 1.0, "ylim_low": F.col("ymin") - 1.0, "ylim_high": F.col("ymax") + 1.0})


def arrows(areas: DataFrame, wind_scale: float = 1.0) -> DataFrame:
    """``areas`` (with vx, vy, vz) with a wind arrow from each centre: start, vector, head width and length."""
    mag = F.sqrt(F.col("vx") * F.col("vx") + F.col("vy") * F.col("vy") + F.col("vz") * F.col("vz"))
    df = areas.where("vx is not null").withColumn("mag", mag)
    one = df.agg(F.max("mag").alias("top"), F.least(F.min(F.col("xmax") - F.col("xmin")), F.min(F.col("ymax") - F.col("ymin"))).alias("cell"))
    s = 0.5 * F.greatest(F.lit(1e-6), F.col("cell")) / F.greatest(F.lit(1e-6), F.col("top")) * wind_scale
    one = one.withColumn("s", s).withColumn("head_width", F.greatest(F.col("cell") * 0.2, F.col("s") * 0.5)).withColumn("head_length", F.greatest(F.col("cell") * 0.4, F.col("s") * 1.5)).withColumn("least", F.col("cell") * 0.15 * wind_scale)
    df = df.join(F.broadcast(one))  # one row
    size = F.greatest(F.col("least"), F.col("mag") * F.col("s"))
    unit = lambda v: F.col(v) / F.greatest(F.col("mag"), F.lit(1e-6))
    return df.withColumn("cx", (F.col("xmin") + F.col("xmax")) * 0.5).withColumn("cy", (F.col("ymin") + F.col("ymax")) * 0.5).withColumn("ax", unit("vx") * size).withColumn("ay", unit("vy") * size).drop("top", "cell", "s", "least")


def editor_arrow(speed: Column, direction: Column, metres: float = 50.0) -> Column:
    """struct<dx, dy> of a zone's arrow in an editor, where the wind goes to; null below 1e-6 m/s."""
    to = F.radians(F.pmod(direction + 180, F.lit(360)))
    return F.when(speed >= 1e-6, F.struct((speed * F.sin(to) * metres).alias("dx"), (speed * F.cos(to) * metres).alias("dy")))


def turbulence_radius(std: Column) -> Column:
    return F.coalesce(std, F.lit(3.0)) * 30.0


def palette_place(ordinal: Column, colours: int = 20) -> Column:
    return ordinal % colours


def box_limits(records: DataFrame, margin: float = 50.0) -> DataFrame:
    """One row: limits around all corners of box records."""
    c = records.select(F.explode("rect_corners").alias("c"))
    return c.agg((F.min("c.x") - margin).alias("xlow"), (F.max("c.x") + margin).alias("xhigh"), (F.min("c.y") - margin).alias("ylow"), (F.max("c.y") + margin).alias("yhigh"))
