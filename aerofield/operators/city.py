"""City models: file selection, footprints, boxes and walls, simulator bodies."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import geometry as G
from ..functions.frames import TransverseMercator, boxes_touch_lonlat, enu_to_mjcf, mesh_box
from ..functions.wind import compact

# Fixed value: the name pattern of city model files.
FILE_NAME = r"^(\d{6,8})_(\w+)_.*\.gml$"


def parsed_name(name: Column) -> Column:
    """struct<mesh, kind> of a file name, null for others; kind takes as much as it can."""
    return F.when(name.rlike(FILE_NAME), F.struct(F.regexp_extract(name, FILE_NAME, 1).alias("mesh"), F.regexp_extract(name, FILE_NAME, 2).alias("kind")))


def gml_index(paths: DataFrame) -> DataFrame:
    """(mesh, kind, path) of the files below a udx folder whose names fit."""
    p = parsed_name(F.element_at(F.split("path", "/"), -1))
    return paths.where("path like '%/udx/%'").withColumn("_p", p).where("_p is not null").select("_p.mesh", "_p.kind", "path")


def in_query_box(index: DataFrame, box: Column) -> DataFrame:
    """Index rows whose mesh touches a box struct<min_lat, max_lat, min_lon, max_lon>, before any file is read."""
    return index.withColumn("_m", mesh_box(F.col("mesh"))).where(boxes_touch_lonlat(F.col("_m"), box)).drop("_m")


def in_query_boxes(index: DataFrame, boxes: DataFrame) -> DataFrame:
    """Pairs of index rows and ``boxes`` rows (with ``box``) that touch, for many boxes at once.

    Both sides meet by the large mesh cell (4 digits) that holds a mesh and that a box reaches, so it is an equi-join.
    """
    b, floor = F.col("box"), lambda c: F.floor(c).cast("long")
    rows = F.sequence(floor(b["min_lat"] * 1.5) - 1, floor(b["max_lat"] * 1.5) + 1)
    cols = F.sequence(floor(b["min_lon"]) - 101, floor(b["max_lon"]) - 99)
    right = boxes.withColumn("_row", F.explode(rows)).withColumn("_col", F.explode(cols))
    part = lambda at: F.try_to_number(F.substring("mesh", at, 2), F.lit("99")).cast("long")
    left = index.withColumn("_m", mesh_box(F.col("mesh"))).where("_m is not null").withColumn("_row", part(1)).withColumn("_col", part(3))
    return left.join(right, ["_row", "_col"]).where(boxes_touch_lonlat(F.col("_m"), b)).drop("_row", "_col", "_m")


def with_companions(selected: DataFrame, files: DataFrame) -> DataFrame:
    """(path, companion): other files of the same folder whose names start with mesh_kind."""
    split = lambda c: (F.regexp_extract(c, r"^(.*)/[^/]*$", 1), F.element_at(F.split(c, "/"), -1))
    (d1, _), (d2, n2) = split(F.col("path")), split(F.col("companion"))
    left = selected.withColumn("_dir", d1)
    right = files.select(F.col("path").alias("companion")).withColumn("_dir", d2).withColumn("_name", n2)
    return left.join(right, "_dir").where(F.startswith("_name", F.concat_ws("_", "mesh", "kind")) & (F.col("companion") != F.col("path"))).select("path", "companion")


def pos_list(text: Column) -> Column:
    """A posList as array<struct<lat, lon, z>>; raises unless the numbers come in threes."""
    v = F.filter(F.split(F.trim(text), r"\s+"), lambda s: s != "")
    n = F.size(v)
    at = lambda i, k: F.get(v, i * 3 + k).cast("double")
    triples = F.transform(F.sequence(F.lit(0), F.expr("0") + F.floor(n / 3).cast("int") - 1), lambda i: F.struct(at(i, 0).alias("lat"), at(i, 1).alias("lon"), at(i, 2).alias("z")))
    return F.when(n % 3 != 0, F.raise_error(F.concat(F.lit("posList of "), n, F.lit(" numbers"))).cast("array<struct<lat: double, lon: double, z: double>>")).when(n > 0, triples).otherwise(F.array().cast("array<struct<lat: double, lon: double, z: double>>"))


def base_points(points: str, eps: float = 0.2, least: int = 3) -> Column:
    """The points within ``eps`` of the lowest, or all if those are fewer than ``least``."""
    low = f"transform(array(array_min(transform({points}, _q -> _q.z))), _m -> filter({points}, _p -> abs(_p.z - _m) <= {eps}D))[0]"
    return F.expr(f"transform(array({low}), _l -> case when size(_l) < {least} then {points} else _l end)[0]")


def footprints(buildings: DataFrame, origin: tuple[float, float] | None = None, ns_m: float | None = None, ew_m: float | None = None, projection: TransverseMercator | None = None, eps: float = 0.2) -> DataFrame:
    """(id, vertices, zmin, zmax, source_gml) of buildings (id, points of lat, lon, z, source_gml).

    Base points are projected, made relative to the ``origin`` (lat, lon) and wrapped in their hull;
    hulls of fewer than three points go, and so do those whose vertex mean lies outside the bounds
    (which only count with an origin).
    """
    p = projection or TransverseMercator()
    z = lambda f: f(F.transform("points", lambda q: q["z"]))
    x0, y0 = p.forward(F.lit(origin[1]), F.lit(origin[0])) if origin else (F.lit(0.0), F.lit(0.0))

    def relative(q: Column) -> Column:
        x, y = p.forward(q["lon"], q["lat"])
        return F.struct((x - x0).alias("x"), (y - y0).alias("y"))

    df = buildings.where("size(points) > 0").select("id", "source_gml", z(F.array_min).alias("zmin"), z(F.array_max).alias("zmax"), F.explode(F.array(F.transform(base_points("points", eps), relative))).alias("ring"))  # one row each: the hull's function wants a column
    df = df.withColumn("vertices", G.convex_hull("ring")).where("size(vertices) >= 3")
    if origin and (ns_m is not None or ew_m is not None):
        m = G.ring_mean("vertices")
        df = df.where((F.abs(m["y"]) <= (ns_m if ns_m is not None else float("inf"))) & (F.abs(m["x"]) <= (ew_m if ew_m is not None else float("inf"))))
    return df.select("id", "vertices", "zmin", "zmax", "source_gml")


def boxes(polygons: DataFrame, compat: bool = False) -> DataFrame:
    """``polygons`` (with vertices) with hull, box, area, and waste_ratio = box area / polygon area."""
    df = polygons.where("size(vertices) >= 3").withColumn("hull", G.convex_hull("vertices"))
    df = df.withColumn("box", G.min_area_box("hull", compat)).withColumn("polygon_area", G.ring_area("vertices"))
    return df.withColumn("waste_ratio", F.when(F.col("polygon_area") > 0, F.col("box.area") / F.col("polygon_area")).otherwise(F.lit(float("inf"))))


def walls(polygons: DataFrame, thickness: float = 0.2, least: float = 1e-3) -> DataFrame:
    """A thin box along each edge longer than ``least``; ids keep the edge's number."""
    e = polygons.select("*", F.posexplode(F.expr(G.edges("vertices"))).alias("edge_index", "e"))
    dx, dy = F.col("e.b.x") - F.col("e.a.x"), F.col("e.b.y") - F.col("e.a.y")
    e = e.withColumn("length", F.hypot(dx, dy)).where(F.col("length") > least)
    box = F.struct(((F.col("e.a.x") + F.col("e.b.x")) * 0.5).alias("cx"), ((F.col("e.a.y") + F.col("e.b.y")) * 0.5).alias("cy"), (F.col("length") * 0.5).alias("sx"), F.lit(thickness * 0.5).alias("sy"), F.atan2(dy, dx).alias("yaw"), (F.col("length") * thickness).alias("area"))
    return e.withColumn("parent_id", F.col("id")).withColumn("id", F.concat(F.col("id"), F.lit("_edge"), F.col("edge_index"))).withColumn("box", box).drop("e", "length")


def box_records(polygons: DataFrame, threshold: float | None = None, thickness: float = 0.2, eps: float = 0.0, compat: bool = False) -> DataFrame:
    """One record per polygon, or one per edge where the box wastes more than ``threshold`` (null: never).

    A polygon of which every edge is too short falls back to its box.
    """
    b = boxes(polygons, compat).withColumn("split", F.lit(False) if threshold is None else F.col("waste_ratio") > threshold + eps)
    long = F.expr(f"exists({G.edges('vertices')}, e -> hypot(e.b.x - e.a.x, e.b.y - e.a.y) > 1e-3D)")
    b = b.withColumn("split", F.col("split") & long)
    shape = lambda df, mode: df.select("id", F.col("parent_id") if mode == "wall" else F.lit(None).cast("string").alias("parent_id"), F.array("box.cx", "box.cy").alias("center"), F.array("box.sx", "box.sy").alias("half_size"), F.col("box.yaw").alias("yaw_rad"), F.degrees("box.yaw").alias("yaw_deg"), G.rect_corners(*(F.col(f"box.{k}") for k in ("cx", "cy", "sx", "sy", "yaw"))).alias("rect_corners"), F.col("box.area").alias("area"), F.lit(mode).alias("mode"), F.col("edge_index") if mode == "wall" else F.lit(None).cast("int").alias("edge_index"), "waste_ratio", "zmin", "zmax", "source_gml")
    return shape(b.where("not split"), "obb").unionByName(shape(walls(b.where("split").drop("box"), thickness), "wall"))


def with_heights(records: DataFrame, heights: DataFrame, on: str = "id") -> DataFrame:
    """``records`` with zmin and zmax of ``heights`` (id, zmin, zmax, height) of the same id; its height only where no z is known.

    Of heights that repeat an id the last by ``ord`` counts, or, without that column, the largest.
    """
    found = F.struct("zmin", "zmax", "height")
    h = heights.groupBy(F.col("id").alias("_id")).agg(F.max_by(found, F.col("ord") if "ord" in heights.columns else found).alias("_h"))
    df = records.join(h, F.col(on) == F.col("_id"), "left")
    both = F.col("_h.zmin").isNotNull() & F.col("_h.zmax").isNotNull()
    own = F.col("zmin").isNull() & F.col("zmax").isNull()
    return df.select(*(c for c in records.columns if c not in ("zmin", "zmax", "height")), F.when(both, F.col("_h.zmin")).otherwise(F.col("zmin")).alias("zmin"), F.when(both, F.col("_h.zmax")).otherwise(F.col("zmax")).alias("zmax"), F.when(~F.coalesce(both, F.lit(False)) & own, F.col("_h.height")).alias("height"))


def grounded(records: DataFrame, zmin: float = 0.0) -> DataFrame:
    """Shift zmin and zmax so that the lowest is 0; rows without zmin count as ``zmin`` and stay."""
    low = records.agg(F.min(F.coalesce("zmin", F.lit(zmin)))).first()[0] or 0.0
    return records.withColumn("zmin", F.col("zmin") - low).withColumn("zmax", F.col("zmax") - low)


def geoms(records: DataFrame, height: float = 5.0, zmin: float = 0.0, collide: str = "all", density: float | None = None, rgba: tuple = (0.82, 0.82, 0.86, 1.0), enu: bool = True, pos_fn: Callable | None = None, yaw_fn: Callable | None = None, sxy_fn: Callable | None = None) -> DataFrame:
    """Attributes of a simulator's box for each record, as text.

    The height is the record's own, or zmax - zmin, or ``height``; east-north becomes
    north-(minus east) and half sizes change places.  Other rules from columns to columns may be given for the
    place (x, y, z), the turn in degrees and the half sizes (x, y).
    """
    own, both = F.col("height").isNotNull(), F.col("zmin").isNotNull() & F.col("zmax").isNotNull()
    base = F.when(own | both, F.coalesce("zmin", F.lit(zmin))).otherwise(zmin)
    tall = F.when(own, F.col("height")).when(both, F.col("zmax") - F.col("zmin")).otherwise(height)
    cx, cy, sx, sy = F.col("center")[0], F.col("center")[1], F.col("half_size")[0], F.col("half_size")[1]
    cz = base + tall * 0.5
    turned = enu_to_mjcf(cx, cy, cz)
    cx, cy, cz = pos_fn(cx, cy, cz) if pos_fn else (turned["x"], turned["y"], turned["z"]) if enu else (cx, cy, cz)
    sx, sy = sxy_fn(sx, sy) if sxy_fn else (sy, sx) if enu else (sx, sy)
    yaw = yaw_fn(F.col("yaw_rad")) if yaw_fn else F.degrees("yaw_rad") if enu else F.col("yaw_rad")
    join = lambda *c: F.concat_ws(" ", *(compact(x + 0.0) for x in c))
    con = {"all": ("1", "0"), "drone": ("1", "2"), "none": ("0", "0")}[collide]
    return records.select(
        "id", F.concat(F.lit("geom_"), "id").alias("name"), F.lit("box").alias("type"), join(sx, sy, tall * 0.5).alias("size"),
        join(cx, cy, cz).alias("pos"), F.concat(F.lit("0 0 "), compact(yaw + 0.0)).alias("euler"),
        F.lit(" ".join(f"{v:g}" for v in rgba)).alias("rgba"), F.lit(con[0]).alias("contype"), F.lit(con[1]).alias("conaffinity"),
        F.lit(None if density is None else f"{density:g}").cast("string").alias("density"),
    )


def geom_xml(g: DataFrame) -> DataFrame:
    """(id, xml): the body element of each geom."""
    attrs = [c for c in g.columns if c != "id"]
    quoted = F.concat_ws(" ", *(F.when(F.col(c).isNotNull(), F.concat(F.lit(f'{c}="'), F.replace(F.replace(F.replace(F.col(c), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit('"'), F.lit("&quot;")), F.lit('"'))) for c in attrs))
    return g.select("id", F.concat(F.lit('<body name="body_'), F.replace(F.replace(F.replace(F.col("id"), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit('"'), F.lit("&quot;")), F.lit('" pos="0 0 0"><geom '), quoted, F.lit("/></body>")).alias("xml"))
