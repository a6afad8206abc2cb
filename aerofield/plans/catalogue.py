"""Every query with its SQL twin.

Trigonometric results are rounded to six decimals and get 0.0 added, so that both engines show
the same digits and no negative zero.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import frames, geometry, wind
from ..operators import city, creator, drawing, editor, mission, search, stabbing, tree
from ..sources import readers
from ..streaming import poses
from . import fixtures as X

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def r6(c: Column | str) -> Column:
    return F.round(F.col(c) if isinstance(c, str) else c, 6) + 0.0


def s6(x: str) -> str:
    return f"round({x}, 6) + 0.0"


def corners(df: DataFrame) -> DataFrame:
    return df.withColumns({"xmin": F.col("bounds.min.x"), "ymin": F.col("bounds.min.y"), "xmax": F.col("bounds.max.x"), "ymax": F.col("bounds.max.y")})


def environment(spark: SparkSession) -> tuple[DataFrame, DataFrame, DataFrame]:
    return creator.build(spark, X.MODEL)


# ---- creator ----


@query(f"SELECT area_id, 'prop_' || area_id AS area_property_id, xmin, ymin, xmax, ymax, 0.0::DOUBLE AS zmin, 100.0::DOUBLE AS zmax, (xmin + xmax) / 2 AS cx, (ymin + ymax) / 2 AS cy FROM ({X.CELLS})")
def grid_cells(spark, sf_dir):
    areas = creator.cells(spark, X.GRID).withColumn("area_property_id", creator.property_id())
    s = geometry.box_size(F.col("bounds"))
    return corners(areas).select("area_id", "area_property_id", "xmin", "ymin", "xmax", "ymax", F.col("bounds.min.z").alias("zmin"), F.col("bounds.max.z").alias("zmax"), s["cx"].alias("cx"), s["cy"].alias("cy"))


@query(f"SELECT s_suppkey, {s6('abs(s_acctbal) / 1000 * cos(radians(s_acctbal))')} AS wx, {s6('abs(s_acctbal) / 1000 * sin(radians(s_acctbal))')} AS wy FROM supplier")
def base_from_direction(spark, sf_dir):
    w = wind.from_math_direction(F.col("s_acctbal"), F.abs("s_acctbal") / 1000)
    return X.table(spark, sf_dir, "supplier").select("s_suppkey", r6(w[0]).alias("wx"), r6(w[1]).alias("wy"))


def _sql_contains(z: dict, x: str, y: str) -> str:
    s = z["shape"]
    if "circle" in s:
        (cx, cy), r = s["circle"]["center_m"], s["circle"]["radius_m"]
        return f"(({x} - {cx}) * ({x} - {cx}) + ({y} - {cy}) * ({y} - {cy}) <= {r} * {r})"
    q = s["rect"]
    if "max_m" in q:
        (x0, y0), (x1, y1) = q["min_m"], q["max_m"]
    elif "min_m" in q:
        (x0, y0), (w, h) = q["min_m"], q["size_m"]
        x1, y1 = x0 + w, y0 + h
    else:
        (cx, cy), (w, h) = q["center_m"], q["size_m"]
        x0, y0, x1, y1 = cx - w / 2, cy - h / 2, cx + w / 2, cy + h / 2
    return f"({x} BETWEEN {x0} AND {x1} AND {y} BETWEEN {y0} AND {y1})"


def _sql_fold() -> str:
    """The zones as a chain of CTEs, one step a zone."""
    steps = [f"s0 AS (SELECT *, (xmin + xmax) / 2 AS cx, (ymin + ymax) / 2 AS cy, 4.0::DOUBLE AS wx, 0.0::DOUBLE AS wy, 1.0::DOUBLE AS gps FROM ({X.CELLS}))"]
    for k, z in enumerate(creator.in_order(X.ZONES)):
        e, hit = z["effect"], _sql_contains(z, "cx", "cy")
        wx, wy, g = "wx", "wy", "gps"
        if e["mode"] == "absolute":
            wx, wy = (f"{v}::DOUBLE" for v in e["wind_ms"][:2])
        elif e["mode"] == "scale":
            wx, wy = f"wx * {e['scale']}::DOUBLE", f"wy * {e['scale']}::DOUBLE"
        elif e["mode"] == "add" and "add_ms" in e:
            wx, wy = f"wx + {e['add_ms'][0]}::DOUBLE", f"wy + ({e['add_ms'][1]}::DOUBLE)"
        elif e["mode"] == "vortex":
            v = e["vortex"]
            dx, dy = f"(cx - {v['center_m'][0]})", f"(cy - ({v['center_m'][1]}))"
            r = f"sqrt({dx} * {dx} + {dy} * {dy})"
            size = f"least({v['max_ms']}::DOUBLE, {v['gain']}::DOUBLE / nullif({r}, 0) * exp(-({r} * {r}) / (2.0::DOUBLE * {v['sigma_m']} * {v['sigma_m']})))"
            wx, wy = (f"CASE WHEN {r} >= 0.1 THEN {w} + {size} * ({d}) / nullif({r}, 0) ELSE {w} END" for w, d in (("wx", "-" + dy), ("wy", dx)))
        if "gps_abs" in e:
            g = f"{e['gps_abs']}::DOUBLE"
        if "gps_add" in e:
            g = f"({g} + ({e['gps_add']}::DOUBLE))"
        if "gps_scale" in e:
            g = f"({g} * {e['gps_scale']}::DOUBLE)"
        steps.append(f"s{k + 1} AS (SELECT * EXCLUDE (wx, wy, gps), CASE WHEN {hit} THEN {wx} ELSE wx END AS wx, CASE WHEN {hit} THEN {wy} ELSE wy END AS wy, CASE WHEN {hit} THEN greatest(0.0::DOUBLE, least(1.0::DOUBLE, {g})) ELSE gps END AS gps FROM s{k})")
    return "WITH " + ", ".join(steps) + f", env AS (SELECT * FROM s{len(X.ZONES)})"


FOLD = _sql_fold()


@query(f"{FOLD} SELECT area_id, {s6('gps')} AS gps FROM env")
def zone_fold_gps(spark, sf_dir):
    _, p, _ = environment(spark)
    return p.select(F.expr("substring(id, 6)").alias("area_id"), r6("properties.gps_strength").alias("gps"))


@query(f"{FOLD} SELECT area_id, {s6('wx')} AS wx, {s6('wy')} AS wy FROM env")
def zone_fold_wind(spark, sf_dir):
    _, p, _ = environment(spark)
    return p.select(F.expr("substring(id, 6)").alias("area_id"), r6(F.col("properties.wind_velocity")[0]).alias("wx"), r6(F.col("properties.wind_velocity")[1]).alias("wy"))


@query("SELECT hits, count(*) AS cells FROM (SELECT " + " + ".join(f"CAST({_sql_contains(z, '(xmin + xmax) / 2', '(ymin + ymax) / 2')} AS INTEGER)" for z in X.ZONES) + f" AS hits FROM ({X.CELLS})) GROUP BY hits")
def zone_overlap_counts(spark, sf_dir):
    areas, _, _ = creator.build(spark, X.MODEL, with_zones=False)
    s = geometry.box_size(F.col("bounds"))
    n = sum((creator.contains(z["shape"], s["cx"], s["cy"]).cast("int") for z in X.ZONES), F.lit(0))
    return areas.groupBy(n.alias("hits")).agg(F.count("*").alias("cells"))


@query(f"SELECT event_id, {_sql_contains(X.ZONES[1], 'x', 'y')} AS in_circle, {_sql_contains(X.ZONES[0], 'x', 'y')} AS in_rect, {_sql_contains(X.ZONES[2], 'x', 'y')} AS in_centred FROM ({X.POINTS})")
def shape_contains(spark, sf_dir):
    x, y = F.col("x"), F.col("y")
    return X.points(spark, sf_dir).select("event_id", creator.contains(X.ZONES[1]["shape"], x, y).alias("in_circle"), creator.contains(X.ZONES[0]["shape"], x, y).alias("in_rect"), creator.contains(X.ZONES[2]["shape"], x, y).alias("in_centred"))


_U = "((CAST('0x' || substr(md5(k || '|7|' || {i}), 1, 13) AS BIGINT) + 0.5::DOUBLE) / 4503599627370496::DOUBLE)"
_N = lambda i: f"sqrt(ln({_U.format(i=2 * i)}) * -2.0) * cos({_U.format(i=2 * i + 1)} * {2 * math.pi!r}::DOUBLE)"


@query(f"SELECT area_id, {s6(_N(0) + ' * 3.0')} AS gauss_x, {s6(_N(1) + ' * 3.0')} AS gauss_y, {s6(_N(0) + ' * 1.5')} AS perlin_x, {s6('4.0 + ' + _N(0) + ' * 3.0 - 4.0 * 0.15')} AS ou_x FROM (SELECT area_id, 'gust|' || area_id AS k FROM ({X.CELLS}))")
def turbulence_hash(spark, sf_dir):
    areas, _, _ = creator.build(spark, X.MODEL, with_zones=False)
    key = F.concat(F.lit("gust|"), "area_id")
    t = lambda kind, w: creator.turbulence([F.lit(w), F.lit(0.0), F.lit(0.0)], key, {"type": kind, "std_ms": 3.0, "seed": 7})
    return areas.select("area_id", r6(t("gauss", 0.0)[0]).alias("gauss_x"), r6(t("gauss", 0.0)[1]).alias("gauss_y"), r6(t("perlin", 0.0)[0]).alias("perlin_x"), r6(t("ou", 4.0)[0]).alias("ou_x"))


@query(f"SELECT event_id, {s6('wind')} AS wind FROM (SELECT event_id, value % 86.4 AS t, 1.5::DOUBLE * sin(value % 86.4 * {2 * math.pi * 0.1!r}::DOUBLE) + 0.5::DOUBLE * sin(value % 86.4 * {2 * math.pi * 0.25!r}::DOUBLE + {math.radians(30)!r}::DOUBLE) AS wind FROM events)")
def periodic_wind(spark, sf_dir):
    """Extension: evaluates terms that models only declare."""
    terms = [{"amp": 1.5, "freq_hz": 0.1}, {"amp": 0.5, "freq_hz": 0.25, "phase_deg": 30}]
    return X.table(spark, sf_dir, "events").select("event_id", r6(creator.periodic(terms, F.col("value") % 86.4)).alias("wind"))


# ---- search ----


@query(f"SELECT p.event_id, area_id FROM ({X.POINTS}) p LEFT JOIN ({X.CELLS}) c ON x >= xmin AND x < xmax AND y >= ymin AND y < ymax AND z >= 0 AND z < 100")
def point_to_area(spark, sf_dir):
    areas, _, _ = environment(spark)
    return search.primary_area(X.points(spark, sf_dir), areas, X.GRID.cell[:2]).select("event_id", "area_id")


_AT = f"{FOLD} SELECT p.event_id, c.*, z FROM ({X.POINTS}) p LEFT JOIN env c ON x >= xmin AND x < xmax AND y >= ymin AND y < ymax AND z >= 0 AND z < 100"


def at_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points with the property of their area: a built model has both in one row, so that no link is followed."""
    return search.primary_area(X.points(spark, sf_dir), creator.whole(spark, X.MODEL), X.GRID.cell[:2], carry=("properties",))


@query(f"SELECT event_id, area_id, {s6('wx')} AS wx, {s6('wy')} AS wy, {s6('gps')} AS gps, CASE WHEN area_id IS NOT NULL THEN 20.0::DOUBLE END AS temperature FROM ({_AT})")
def point_to_property(spark, sf_dir):
    w = F.col("properties.wind_velocity")
    return at_points(spark, sf_dir).select("event_id", "area_id", r6(w[0]).alias("wx"), r6(w[1]).alias("wy"), r6("properties.gps_strength").alias("gps"), F.col("properties.temperature").alias("temperature"))


@query(f"SELECT event_id, {s6('coalesce(wx, 0)')} AS wx, {s6('coalesce(wy, 0)')} AS wy, CASE WHEN area_id IS NULL THEN 0.0::DOUBLE ELSE 20.0 END AS d_temp, CASE WHEN area_id IS NULL THEN 0.0::DOUBLE ELSE 1.0 END AS d_atm, {s6('gps')} AS gps FROM ({_AT})")
def disturbance(spark, sf_dir):
    d = search.disturbance(F.col("properties"))
    df = at_points(spark, sf_dir).select("event_id", d.alias("d"))
    return df.select("event_id", r6("d.d_wind.x").alias("wx"), r6("d.d_wind.y").alias("wy"), "d.d_temp", "d.d_atm", r6(F.col("d.d_user_custom")[0]["data"][0]).alias("gps"))


_BOXES = "SELECT p_partkey AS ord, 'b' || p_partkey AS area_id, CAST(p_partkey * 97 % 4400 AS DOUBLE) AS x0, CAST(p_partkey * 61 % 6400 AS DOUBLE) - 6400 AS y0, CAST(50 + p_size * 20 * (1 + 7 * CAST(p_partkey % 50 = 0 AS INTEGER)) AS DOUBLE) AS w FROM part"


def odd_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Overlapping boxes of very different sizes."""
    b = X.table(spark, sf_dir, "part").select(F.col("p_partkey").alias("ord"), F.concat(F.lit("b"), "p_partkey").alias("area_id"), (F.col("p_partkey") * 97 % 4400).cast("double").alias("x0"), (F.col("p_partkey") * 61 % 6400 - 6400).cast("double").alias("y0"), (50 + F.col("p_size") * 20 * (1 + 7 * (F.col("p_partkey") % 50 == 0).cast("int"))).cast("double").alias("w"))
    corner = lambda x, y, z: F.struct(x.alias("x"), y.alias("y"), F.lit(z).alias("z"))
    x, y, w = F.col("x0"), F.col("y0"), F.col("w")
    return b.select("ord", "area_id", F.struct(corner(x, y, 0.0).alias("min"), corner(x + w, y + w, 300.0).alias("max")).alias("bounds"))


_PROBES = "SELECT DISTINCT c_custkey, CAST(c_custkey * 41 % 4400 AS DOUBLE) AS x, CAST(c_custkey * 29 % 6400 AS DOUBLE) - 6400 AS y, CAST(c_custkey % 400 AS DOUBLE) AS z FROM customer"


@query(f"SELECT p.c_custkey, coalesce(n, 0) AS n_hits, coalesce(f, -1) AS first_ord FROM ({_PROBES}) p LEFT JOIN (SELECT c_custkey, count(*) AS n, min(ord) AS f FROM ({_PROBES}) JOIN ({_BOXES}) ON x >= x0 AND x < x0 + w AND y >= y0 AND y < y0 + w WHERE z < 300 GROUP BY c_custkey) h ON p.c_custkey = h.c_custkey")
def range_join_all_hits(spark, sf_dir):
    p = X.table(spark, sf_dir, "customer").select("c_custkey", (F.col("c_custkey") * 41 % 4400).cast("double").alias("x"), (F.col("c_custkey") * 29 % 6400 - 6400).cast("double").alias("y"), (F.col("c_custkey") % 400).cast("double").alias("z")).distinct()
    return p.join(stabbing.stabbed(p, odd_boxes(spark, sf_dir)), ["x", "y", "z"], "left").select("c_custkey", F.coalesce("n_hits", F.lit(0)).alias("n_hits"), F.coalesce("first_ord", F.lit(-1)).alias("first_ord"))


def _stand_ins(spark, sf_dir):
    """Orders as areas, customers as properties, each with a gap, so that ids dangle."""
    o, c = X.table(spark, sf_dir, "orders"), X.table(spark, sf_dir, "customer")
    areas = o.where("o_orderkey % 7 <> 0").select(F.col("o_orderkey").cast("string").alias("area_id"))
    links = o.where("o_orderkey % 5 <> 0").select(F.col("o_orderkey").cast("string").alias("area_id"), F.col("o_custkey").cast("string").alias("area_property_id"), F.col("o_orderkey").alias("ord"))
    return areas, links, c.where("c_custkey % 11 <> 0").select(F.col("c_custkey").cast("string").alias("id"))


@query("""WITH a AS (SELECT CAST(o_orderkey AS VARCHAR) AS id FROM orders WHERE o_orderkey % 7 <> 0),
l AS (SELECT CAST(o_orderkey AS VARCHAR) AS id, CAST(o_custkey AS VARCHAR) AS p FROM orders WHERE o_orderkey % 5 <> 0),
p AS (SELECT CAST(c_custkey AS VARCHAR) AS id FROM customer WHERE c_custkey % 11 <> 0)
SELECT DISTINCT 'areas_without_link' AS problem, id FROM a WHERE NOT EXISTS (SELECT 1 FROM l WHERE l.id = a.id)
UNION ALL SELECT DISTINCT 'links_to_missing_property', id FROM l WHERE NOT EXISTS (SELECT 1 FROM p WHERE p.id = l.p)
UNION ALL SELECT DISTINCT 'properties_unreferenced', id FROM p WHERE NOT EXISTS (SELECT 1 FROM l WHERE l.p = p.id)
UNION ALL SELECT DISTINCT 'links_to_missing_area', id FROM l WHERE NOT EXISTS (SELECT 1 FROM a WHERE a.id = l.id)""")
def integrity(spark, sf_dir):
    return search.integrity(*_stand_ins(spark, sf_dir))


@query("SELECT s_suppkey AS area_id, n_name AS link, r_name AS property FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey WHERE s_suppkey % 3 <> 0 AND r_regionkey <> 2")
def visual_areas(spark, sf_dir):
    s, n, r = (X.table(spark, sf_dir, t) for t in ("supplier", "nation", "region"))
    links = s.join(n, F.col("s_nationkey") == F.col("n_nationkey")).select(F.col("s_suppkey").alias("area_id"), F.col("n_regionkey").alias("area_property_id"), "n_name")
    areas = s.where("s_suppkey % 3 <> 0").select(F.col("s_suppkey").alias("area_id"), F.col("s_suppkey").alias("ord"), F.col("s_name").alias("bounds"))
    props = r.where("r_regionkey <> 2").select(F.col("r_regionkey").alias("id"), F.col("r_regionkey").alias("ord"), F.col("r_name").alias("properties"))
    return search.visual_areas(areas, links, props).join(links.select("area_id", "n_name"), "area_id").select("area_id", F.col("n_name").alias("link"), F.col("properties").alias("property"))


@query(f"SELECT event_id, CAST(CASE WHEN area_id IS NULL THEN 0 ELSE 1 END AS INTEGER) AS n_hits, area_id, area_id IS NOT NULL AS has_property, printf('point (%.3f, %.3f, %.3f)', x, y, z) || chr(10) || 'hits: ' || CASE WHEN area_id IS NULL THEN '0' ELSE '1' END || chr(10) || 'primary: ' || coalesce(area_id, 'none') || chr(10) || 'property: ' || coalesce('prop_' || area_id, 'none') AS text FROM ({X.POINTS}) p LEFT JOIN ({X.CELLS}) c ON x >= xmin AND x < xmax AND y >= ymin AND y < ymax AND z >= 0 AND z < 100")
def explain_points(spark, sf_dir):
    areas, props, links = environment(spark)
    return search.explained(X.points(spark, sf_dir), areas, links, props, ["event_id"]).select("event_id", F.size("hits").alias("n_hits"), "area_id", "has_property", "text")


@query("SELECT o_custkey, max_by(o_orderkey, (o_orderdate, o_orderkey)) AS last_order FROM orders GROUP BY o_custkey")
def dedup_last_wins(spark, sf_dir):
    o = X.table(spark, sf_dir, "orders").withColumn("at", F.struct("o_orderdate", "o_orderkey"))
    return search.last_of(o, "o_custkey", "at").select("o_custkey", F.col("o_orderkey").alias("last_order"))


@query(f"SELECT p_partkey, depth, round_even(bf, 3) AS branching, CASE WHEN p_partkey > 0 THEN round_even(depth * (1 + log2(bf) / 4), 3) ELSE 0 END AS cost FROM (SELECT p_partkey, CAST(p_size % 9 + 1 AS INTEGER) AS depth, pow(CAST(p_partkey AS DOUBLE), 1.0::DOUBLE / (p_size % 9 + 1)) AS bf FROM part)")
def tree_cost(spark, sf_dir):
    d = (F.col("p_size") % 9 + 1).cast("int")
    c = wind.search_cost(F.col("p_partkey"), d)
    return X.table(spark, sf_dir, "part").select("p_partkey", d.alias("depth"), c["branching"].alias("branching"), c["cost"].alias("cost"))


# ---- frames ----


@query(f"SELECT event_id, y AS ros_x, -x + 0.0 AS ros_y, x AS back_x, y AS back_y, -ymax AS map_xmin, xmin AS map_ymin FROM (SELECT event_id, x, y, y + 1 AS ymax, x AS xmin FROM ({X.POINTS}))")
def frame_roundtrip(spark, sf_dir):
    x, y, z = (F.col(c) for c in "xyz")
    ros = frames.enu_to_ros(x, y, z)
    back = frames.ros_to_enu(ros["x"], ros["y"], ros["z"])
    box = frames.ros_box_to_map(x, y, x + 1, y + 1)
    return X.points(spark, sf_dir).select("event_id", ros["x"].alias("ros_x"), (ros["y"] + 0.0).alias("ros_y"), (back["x"] + 0.0).alias("back_x"), back["y"].alias("back_y"), box["xmin"].alias("map_xmin"), box["ymin"].alias("map_ymin"))


_R, _LAT, _LON = frames.EARTH_RADIUS, X.ORIGIN[0], X.ORIGIN[1]
_Y = lambda lat: f"ln(tan({math.pi / 4!r}::DOUBLE + radians({lat}) / 2)) * {_R}"


@query(f"SELECT event_id, round(degrees((radians({_LON}) * {_R} + x) / {_R}), 9) AS lon, round(degrees(2 * atan(exp(({_Y(_LAT)} + y) / {_R})) - pi() / 2), 9) AS lat FROM ({X.POINTS})")
def enu_to_lonlat(spark, sf_dir):
    lon, lat = frames.enu_to_lonlat(F.col("x"), F.col("y"), *X.ORIGIN)
    return X.points(spark, sf_dir).select("event_id", F.round(lon, 9).alias("lon"), F.round(lat, 9).alias("lat"))


@query(f"SELECT c_custkey, round((radians(lon) - radians({_LON})) * {_R}, 4) + 0.0 AS x, round({_Y('lat')} - {_Y(_LAT)}, 4) + 0.0 AS y FROM (SELECT c_custkey, 135 + c_custkey % 977 / 977.0::DOUBLE AS lon, 34 + c_custkey % 881 / 881.0::DOUBLE AS lat FROM customer)")
def lonlat_to_enu(spark, sf_dir):
    lon, lat = F.lit(135) + F.col("c_custkey") % 977 / 977.0, F.lit(34) + F.col("c_custkey") % 881 / 881.0
    x, y = frames.lonlat_to_enu(lon, lat, *X.ORIGIN)
    return X.table(spark, sf_dir, "customer").select("c_custkey", (F.round(x, 4) + 0.0).alias("x"), (F.round(y, 4) + 0.0).alias("y"))


_TM = frames.TransverseMercator()


def _sql_tm() -> str:
    t = f"sinh(atanh(sin(radians(lat))) - {_TM.e!r}::DOUBLE * atanh({_TM.e!r}::DOUBLE * sin(radians(lat))))"
    inner = f"SELECT id, atan2({t}, cos(radians(lon - {_TM.lon0!r}::DOUBLE))) AS xi, atanh(sin(radians(lon - {_TM.lon0!r}::DOUBLE)) / sqrt(1 + {t} * {t})) AS eta FROM src"
    series = lambda a, b, f, g: f"{a} + " + " + ".join(f"({c!r}::DOUBLE) * {f}({2 * (j + 1)} * xi) * {g}({2 * (j + 1)} * eta)" for j, c in enumerate(_TM.alpha))
    return f"SELECT id, round(({series('eta', '', 'cos', 'sinh')}) * {_TM.a!r}::DOUBLE, 3) + 0.0 AS x, round(({series('xi', '', 'sin', 'cosh')}) * {_TM.a!r}::DOUBLE - ({_TM.y0!r}::DOUBLE), 3) + 0.0 AS y FROM ({inner})"


@query(f"WITH src AS (SELECT c_custkey AS id, 138.5 + c_custkey % 977 / 400.0::DOUBLE AS lon, 34.5 + c_custkey % 881 / 300.0::DOUBLE AS lat FROM customer) {_sql_tm()}")
def plane_rectangular(spark, sf_dir):
    lon, lat = F.lit(138.5) + F.col("c_custkey") % 977 / 400.0, F.lit(34.5) + F.col("c_custkey") % 881 / 300.0
    x, y = _TM.forward(lon, lat)
    return X.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), (F.round(x, 3) + 0.0).alias("x"), (F.round(y, 3) + 0.0).alias("y"))


_BOX = f"lat - degrees(ns / {_R}) AS a, lat + degrees(ns / {_R}) AS b, lon - degrees(ew / ({_R} * cos(radians(lat)))) AS c, lon + degrees(ew / ({_R} * cos(radians(lat)))) AS d"
_SUPP = "SELECT s_suppkey, 35 + s_suppkey % 89 / 89.0::DOUBLE AS lat, 139 + s_suppkey % 97 / 97.0::DOUBLE AS lon, 500 + abs(s_acctbal) AS ns, 1000.0::DOUBLE AS ew FROM supplier"


def _query_boxes(spark, sf_dir):
    lat, lon = F.lit(35) + F.col("s_suppkey") % 89 / 89.0, F.lit(139) + F.col("s_suppkey") % 97 / 97.0
    return X.table(spark, sf_dir, "supplier").select("s_suppkey", frames.box_around(lat, lon, F.lit(500) + F.abs("s_acctbal"), F.lit(1000.0)).alias("box"))


@query(f"SELECT s_suppkey, round(a, 9) AS min_lat, round(b, 9) AS max_lat, round(c, 9) AS min_lon, round(d, 9) AS max_lon FROM (SELECT s_suppkey, {_BOX} FROM ({_SUPP}))")
def box_around(spark, sf_dir):
    return _query_boxes(spark, sf_dir).select("s_suppkey", *(F.round(f"box.{k}", 9).alias(k) for k in ("min_lat", "max_lat", "min_lon", "max_lon")))


_MESH = "SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN '53' || lpad(CAST(p_partkey % 100 AS VARCHAR), 2, '0') || CAST(p_partkey % 8 AS VARCHAR) || CAST(p_partkey // 8 % 8 AS VARCHAR) WHEN p_partkey % 3 = 1 THEN '533' || CAST(p_partkey % 10 AS VARCHAR) || CAST(p_partkey % 8 AS VARCHAR) || CAST(p_partkey // 8 % 8 AS VARCHAR) || lpad(CAST(p_partkey % 100 AS VARCHAR), 2, '0') ELSE '5339' || CAST(p_partkey % 1000 AS VARCHAR) END AS mesh FROM part"


def _meshes(spark, sf_dir):
    k = F.col("p_partkey")
    s = lambda c: c.cast("int").cast("string")
    two = F.lpad(s(k % 100), 2, "0")
    eighths = F.concat(s(k % 8), s(F.expr("p_partkey div 8 % 8")))
    code = F.when(k % 3 == 0, F.concat(F.lit("53"), two, eighths)).when(k % 3 == 1, F.concat(F.lit("533"), s(k % 10), eighths, two)).otherwise(F.concat(F.lit("5339"), s(k % 1000)))
    return X.table(spark, sf_dir, "part").select("p_partkey", code.alias("mesh"))


_D = lambda i, n=1: f"CAST(substr(mesh, {i}, {n}) AS DOUBLE)"
_MESH_BOX = f"SELECT *, {_D(1, 2)} * 2 / 3 + {_D(5)} / 12 + CASE WHEN length(mesh) = 8 THEN {_D(7)} / 120 ELSE 0 END AS a, {_D(3, 2)} + 100 + {_D(6)} / 8 + CASE WHEN length(mesh) = 8 THEN {_D(8)} / 80 ELSE 0 END AS c, CASE WHEN length(mesh) = 8 THEN 1.0::DOUBLE / 120 ELSE 1.0::DOUBLE / 12 END AS h, CASE WHEN length(mesh) = 8 THEN 1.0::DOUBLE / 80 ELSE 1.0::DOUBLE / 8 END AS w FROM ({_MESH}) WHERE length(mesh) IN (6, 8)"


@query(f"SELECT m.p_partkey, m.mesh, round(a, 9) AS min_lat, round(a + h, 9) AS max_lat, round(c, 9) AS min_lon, round(c + w, 9) AS max_lon FROM ({_MESH}) m LEFT JOIN ({_MESH_BOX}) b ON m.p_partkey = b.p_partkey")
def mesh_boxes(spark, sf_dir):
    return _meshes(spark, sf_dir).withColumn("box", frames.mesh_box(F.col("mesh"))).select("p_partkey", "mesh", *(F.round(f"box.{k}", 9).alias(k) for k in ("min_lat", "max_lat", "min_lon", "max_lon")))


@query(f"SELECT p_partkey FROM ({_MESH_BOX}) WHERE a + h >= 35.4 AND a <= 35.6 AND c + w >= 139.2 AND c <= 139.9")
def mesh_in_query_box(spark, sf_dir):
    box = F.struct(F.lit(35.4).alias("min_lat"), F.lit(35.6).alias("max_lat"), F.lit(139.2).alias("min_lon"), F.lit(139.9).alias("max_lon"))
    return city.in_query_box(_meshes(spark, sf_dir), box).select("p_partkey")


@query("SELECT p_partkey, CASE WHEN regexp_matches(name, '^[0-9]{6,8}_\\w+_.*\\.gml$') THEN regexp_extract(name, '^(\\d{6,8})_(\\w+)_.*\\.gml$', 1) END AS mesh, CASE WHEN regexp_matches(name, '^[0-9]{6,8}_\\w+_.*\\.gml$') THEN regexp_extract(name, '^(\\d{6,8})_(\\w+)_.*\\.gml$', 2) END AS kind FROM (SELECT p_partkey, CAST(p_partkey * 7919 % 100000000 AS VARCHAR) || CASE WHEN p_size % 2 = 0 THEN '_bldg_6697_op.gml' ELSE '_tran.gml' END AS name FROM part)")
def file_names(spark, sf_dir):
    name = F.concat((F.col("p_partkey") * 7919 % 100000000).cast("string"), F.when(F.col("p_size") % 2 == 0, F.lit("_bldg_6697_op.gml")).otherwise(F.lit("_tran.gml")))
    p = city.parsed_name(name)
    return X.table(spark, sf_dir, "part").select("p_partkey", p["mesh"].alias("mesh"), p["kind"].alias("kind"))


@query("SELECT s_suppkey, CAST(greatest(0, least(22, round_even(log2(156543.03392804097::DOUBLE / greatest(1e-9, cell / 32)), 0))) AS INTEGER) AS zoom FROM (SELECT s_suppkey, abs(s_acctbal) + 0.5 AS cell FROM supplier)")
def zoom_auto(spark, sf_dir):
    return X.table(spark, sf_dir, "supplier").select("s_suppkey", frames.auto_zoom(F.abs("s_acctbal") + 0.5).alias("zoom"))


@query("WITH RECURSIVE z AS (SELECT s_suppkey, abs(s_acctbal) * 50 + 1 AS w, 18 AS zoom FROM supplier UNION ALL SELECT s_suppkey, w, zoom - 1 FROM z WHERE w / (156543.03392804097::DOUBLE / pow(2, zoom)) > 8192 AND zoom > 0) SELECT s_suppkey, min(zoom) AS zoom FROM z GROUP BY s_suppkey")
def zoom_cap(spark, sf_dir):
    return X.table(spark, sf_dir, "supplier").select("s_suppkey", frames.cap_zoom(F.abs("s_acctbal") * 50 + 1, F.lit(18)).alias("zoom"))


# ---- wind and compass ----


@query(f"SELECT event_id, {s6('value / 20 * sin(radians((event_id % 360 + 180) % 360))')} AS wx, {s6('value / 20 * cos(radians((event_id % 360 + 180) % 360))')} AS wy FROM events")
def wind_from_met(spark, sf_dir):
    w = wind.from_met_direction(F.col("event_id") % 360, F.col("value") / 20)
    return X.table(spark, sf_dir, "events").select("event_id", r6(w[0]).alias("wx"), r6(w[1]).alias("wy"))


@query(f"SELECT event_id, floor(sqrt(vx * vx + vy * vy) * 10 + 0.5) / 10 AS speed, CAST(floor((degrees(atan2(vx, vy)) + 180) % 360 + 0.5) AS BIGINT) AS direction FROM (SELECT event_id, x / 100 - 22 AS vx, y / 100 + 32 AS vy FROM ({X.POINTS}))")
def wind_to_met(spark, sf_dir):
    d = wind.to_met_direction(F.col("x") / 100 - 22, F.col("y") / 100 + 32)
    return X.points(spark, sf_dir).select("event_id", d["speed"].alias("speed"), d["direction"].alias("direction"))


@query(f"SELECT event_id, CAST(floor((value * 3) % 360 / 45 + 0.5) * 45 AS BIGINT) % 360 AS snapped, {s6('(degrees(atan2(x - 2200, -(y + 3200))) + 360) % 360')} AS pointer FROM (SELECT event_id, z AS value, x, y FROM ({X.POINTS}))")
def compass(spark, sf_dir):
    return X.points(spark, sf_dir).select("event_id", wind.snapped(F.col("z") * 3).alias("snapped"), r6(wind.compass_from_pointer(F.col("x") - 2200, F.col("y") + 3200)).alias("pointer"))


@query("SELECT p_partkey, CASE WHEN contains(t, '.') THEN rtrim(rtrim(t, '0'), '.') ELSE t END AS text FROM (SELECT p_partkey, printf('%.6f', p_retailprice / 7) AS t FROM part)")
def compact_numbers(spark, sf_dir):
    return X.table(spark, sf_dir, "part").select("p_partkey", wind.compact(F.col("p_retailprice") / 7).alias("text"))


# ---- polygons ----

_EDGES = f"SELECT *, coalesce(lead(x) OVER w, first_value(x) OVER w) AS x2, coalesce(lead(y) OVER w, first_value(y) OVER w) AS y2 FROM ({X.RING_POINTS}) WINDOW w AS (PARTITION BY id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)"


@query(f"SELECT id, CASE WHEN max(n) < 3 THEN 0.0::DOUBLE ELSE abs(sum(x * y2 - x2 * y)) / 2 END AS area, {s6('avg(x)')} AS mean_x FROM ({_EDGES}) GROUP BY id")
def polygon_area(spark, sf_dir):
    return X.rings(spark, sf_dir).select("id", geometry.ring_area("vertices").alias("area"), r6(geometry.ring_mean("vertices")["x"]).alias("mean_x"))


_PTS = f"SELECT DISTINCT id, x, y FROM ({X.RING_POINTS})"
_TURN = "((q.x - p.x) * (r.y - p.y) - (q.y - p.y) * (r.x - p.x))"
_DOT = "((r.x - p.x) * (r.x - q.x) + (r.y - p.y) * (r.y - q.y))"
_HULL = f"SELECT p.id, p.x AS px, p.y AS py, q.x AS qx, q.y AS qy FROM ({_PTS}) p JOIN ({_PTS}) q ON p.id = q.id AND (p.x <> q.x OR p.y <> q.y) JOIN ({_PTS}) r ON p.id = r.id GROUP BY ALL HAVING min({_TURN}) >= 0 AND max(CASE WHEN {_TURN} = 0 THEN {_DOT} ELSE 0 END) <= 0"


@query(f"SELECT id, px, py, qx, qy FROM ({_HULL})")
def convex_hull_edges(spark, sf_dir):
    h = X.rings(spark, sf_dir).withColumn("hull", geometry.convex_hull("vertices")).where("size(hull) > 1")
    return h.select("id", F.explode(F.expr(geometry.edges("hull"))).alias("e")).select("id", F.col("e.a.x").alias("px"), F.col("e.a.y").alias("py"), F.col("e.b.x").alias("qx"), F.col("e.b.y").alias("qy"))


_ALONG = "(r.x * (qx - px) + r.y * (qy - py)) / sqrt((qx - px) * (qx - px) + (qy - py) * (qy - py))"
_ACROSS = "(r.y * (qx - px) - r.x * (qy - py)) / sqrt((qx - px) * (qx - px) + (qy - py) * (qy - py))"


@query(f"SELECT id, round(min(area), 3) + 0.0 AS area FROM (SELECT h.id, px, py, (max({_ALONG}) - min({_ALONG})) * (max({_ACROSS}) - min({_ACROSS})) AS area FROM ({_HULL}) h JOIN ({_PTS}) r ON h.id = r.id GROUP BY h.id, px, py, qx, qy) GROUP BY id HAVING count(*) > 2")
def box_area(spark, sf_dir):
    b = X.rings(spark, sf_dir).withColumn("hull", geometry.convex_hull("vertices")).where("size(hull) > 2")
    return b.select("id", (F.round(geometry.min_area_box("hull")["area"], 3) + 0.0).alias("area"))


@query(f"SELECT id || '_edge' || (i - 1) AS id, CAST(i - 1 AS INTEGER) AS edge_index, (x + x2) / 2 AS cx, (y + y2) / 2 AS cy, {s6('sqrt((x2 - x) * (x2 - x) + (y2 - y) * (y2 - y)) / 2')} AS half_length, {s6('atan2(y2 - y, x2 - x)')} AS yaw FROM ({_EDGES}) WHERE n >= 3 AND sqrt((x2 - x) * (x2 - x) + (y2 - y) * (y2 - y)) > 0.001")
def wall_records(spark, sf_dir):
    w = city.walls(X.rings(spark, sf_dir).where("size(vertices) >= 3"))
    return w.select("id", "edge_index", "box.cx", "box.cy", r6("box.sx").alias("half_length"), r6("box.yaw").alias("yaw"))


def _box_rows(spark, sf_dir):
    k = F.col("p_partkey")
    return X.table(spark, sf_dir, "part").select(k.cast("string").alias("id"), F.array((k % 100) / 4.0, (k % 37) / 8.0).alias("center"), F.array(F.col("p_size") / 2.0, F.col("p_size") / 4.0).alias("half_size"), F.lit(0.0).alias("yaw_rad"), F.when(k % 3 == 0, F.col("p_size") * 1.0).alias("height"), F.when(k % 2 == 0, (k % 10) / 2.0).alias("zmin"), F.when(k % 4 == 0, (k % 10) / 2.0 + 3).alias("zmax"))


_F4 = lambda x: f"rtrim(rtrim(printf('%.6f', {x}), '0'), '.')"


@query(f"""WITH b AS (SELECT CAST(p_partkey AS VARCHAR) AS id, p_partkey % 100 / 4.0::DOUBLE AS cx, p_partkey % 37 / 8.0::DOUBLE AS cy, p_size / 2.0::DOUBLE AS sx, p_size / 4.0::DOUBLE AS sy, CASE WHEN p_partkey % 3 = 0 THEN p_size * 1.0::DOUBLE END AS height,
  CASE WHEN p_partkey % 2 = 0 THEN p_partkey % 10 / 2.0::DOUBLE END AS zmin, CASE WHEN p_partkey % 4 = 0 THEN p_partkey % 10 / 2.0::DOUBLE + 3 END AS zmax FROM part),
g AS (SELECT *, CASE WHEN height IS NOT NULL THEN coalesce(zmin, 0) WHEN zmin IS NOT NULL AND zmax IS NOT NULL THEN zmin ELSE 0 END AS base, CASE WHEN height IS NOT NULL THEN height WHEN zmin IS NOT NULL AND zmax IS NOT NULL THEN zmax - zmin ELSE 5.0::DOUBLE END AS tall FROM b)
SELECT id, {_F4('sy')} || ' ' || {_F4('sx')} || ' ' || {_F4('tall * 0.5')} AS size, {_F4('cy')} || ' ' || {_F4('-cx + 0.0')} || ' ' || {_F4('base + tall * 0.5')} AS pos, '1' AS contype, '2' AS conaffinity FROM g""")
def simulator_geoms(spark, sf_dir):
    return city.geoms(_box_rows(spark, sf_dir), collide="drone").select("id", "size", "pos", "contype", "conaffinity")


@query("SELECT CAST(p_partkey AS VARCHAR) AS id, CASE WHEN p_partkey % 5 = 0 AND p_partkey % 2 = 0 THEN 1.0::DOUBLE WHEN p_partkey % 2 = 0 THEN p_partkey % 10 / 2.0::DOUBLE END AS zmin, CASE WHEN p_partkey % 5 = 0 AND p_partkey % 2 = 0 THEN 8.0::DOUBLE WHEN p_partkey % 4 = 0 THEN p_partkey % 10 / 2.0::DOUBLE + 3 END AS zmax, CASE WHEN p_partkey % 5 = 0 AND p_partkey % 2 <> 0 THEN 7.0::DOUBLE END AS height FROM part")
def merged_heights(spark, sf_dir):
    k = F.col("p_partkey")
    h = X.table(spark, sf_dir, "part").where("p_partkey % 5 = 0").select(k.cast("string").alias("id"), F.when(k % 2 == 0, 1.0).alias("zmin"), F.when(k % 2 == 0, 8.0).alias("zmax"), F.lit(7.0).alias("height"))
    return city.with_heights(_box_rows(spark, sf_dir), h).select("id", "zmin", "zmax", "height")


_TRIPLES = "SELECT l_orderkey AS id, string_agg(CAST(l_partkey AS VARCHAR) || ' ' || CAST(l_suppkey AS VARCHAR) || '  ' || CAST(l_linenumber AS VARCHAR), ' ' ORDER BY l_linenumber, l_partkey, l_suppkey) AS t FROM lineitem GROUP BY l_orderkey"


@query(f"SELECT id, CAST(len(v) // 3 AS INTEGER) AS n, CAST(v[1] AS DOUBLE) AS lat, CAST(v[2] AS DOUBLE) AS lon, list_max(list_transform(range(0, len(v) // 3), lambda i: CAST(v[i * 3 + 3] AS DOUBLE))) AS zmax FROM (SELECT id, string_split_regex(t, '\\s+') AS v FROM ({_TRIPLES}))")
def pos_lists(spark, sf_dir):
    li = X.table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("id")).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_suppkey"))), lambda q: F.concat_ws(" ", q["l_partkey"].cast("string"), q["l_suppkey"].cast("string"), F.concat(F.lit(" "), q["l_linenumber"].cast("string")))), " ").alias("t"))
    p = li.select("id", city.pos_list(F.col("t")).alias("p"))
    return p.select("id", F.size("p").alias("n"), F.col("p")[0]["lat"].alias("lat"), F.col("p")[0]["lon"].alias("lon"), F.array_max(F.transform("p", lambda q: q["z"])).alias("zmax"))


@query(f"SELECT id, count(*) AS n FROM (SELECT id, i, n, y AS z, min(y) OVER (PARTITION BY id) AS low, count(*) FILTER (y <= m + 0.2) OVER (PARTITION BY id) AS near FROM (SELECT *, min(y) OVER (PARTITION BY id) AS m FROM ({X.RING_POINTS}))) WHERE near < 3 OR z <= low + 0.2 GROUP BY id")
def base_level_points(spark, sf_dir):
    p = X.rings(spark, sf_dir).withColumn("p", F.transform("vertices", lambda v: F.struct(v["x"].alias("x"), v["y"].alias("z"))))
    return p.select("id", F.size(city.base_points("p")).cast("long").alias("n"))


# ---- missions and streams ----


@query(f"SELECT event_id, CAST(CASE WHEN px IS NULL OR (x = px AND y = py) THEN 0 ELSE floor(degrees(atan2(x - px, y - py)) + 0.5) END AS BIGINT) AS yaw FROM (SELECT event_id, x, y, lag(x) OVER w AS px, lag(y) OVER w AS py FROM ({X.POINTS}) WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))")
def mission_segments(spark, sf_dir):
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    return X.points(spark, sf_dir).select("event_id", mission.segment_yaw("y", "x", w).cast("long").alias("yaw"))


@query("""WITH c AS (SELECT event_id, user_id, ts, CASE WHEN event_type = 'click' THEN value END AS sleep, CAST(event_type IN ('view', 'purchase') AS INTEGER) AS move FROM events),
g AS (SELECT *, coalesce(sum(move) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS grp FROM c)
SELECT event_id, coalesce(last, 0.0) AS sleep_before FROM (SELECT event_id, move, last_value(sleep IGNORE NULLS) OVER (PARTITION BY user_id, grp ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS last FROM g) WHERE move = 1""")
def sleep_carry(spark, sf_dir):
    e = X.table(spark, sf_dir, "events")
    kind = F.when(F.col("event_type") == "click", "sleep").when(F.col("event_type").isin("view", "purchase"), "moveToPosition").otherwise("other")
    c = e.select("event_id", F.col("user_id").alias("mission"), F.struct("ts", "event_id").alias("step"), kind.alias("command"), F.col("value").alias("duration_sec"))
    return mission.carried_sleep(c).select("event_id", "sleep_before")


@query(f"SELECT user_id AS drone, max_by(event_id, (ts, event_id)) AS event_id FROM ({X.POINTS}) WHERE z IS NOT NULL GROUP BY user_id")
def latest_pose(spark, sf_dir):
    p = X.points(spark, sf_dir).withColumnRenamed("user_id", "drone")
    return poses.latest(p, carry=("event_id",)).select("drone", "event_id")


@query("SELECT date_trunc('hour', ts) AS tick, user_id AS drone, max_by(event_id, (ts, event_id)) AS event_id FROM events GROUP BY 1, 2")
def tick_windows(spark, sf_dir):
    """Extension: event-time ticks."""
    p = X.points(spark, sf_dir).select(F.col("user_id").alias("drone"), F.col("ts").cast("timestamp"), "x", "y", "z", "event_id")
    return poses.ticks(p, "1 hour", carry=("event_id",)).select(F.col("tick").cast("timestamp_ntz").alias("tick"), "drone", "event_id")


@query("SELECT event_id, ((k % 3) = 0) AS has_pose, ((k % 5) = 0) AS has_disturbance FROM (SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events) WHERE k % 7 <> 0")
def robot_channels(spark, sf_dir):
    k = F.get_json_object("props", "$.k").cast("int")
    one = lambda when, name: F.array(F.struct(F.when(when, F.lit(name)).otherwise(F.lit("other")).alias("org_name")))
    r = X.table(spark, sf_dir, "events").select(F.col("event_id").alias("ord"), F.when(k % 7 != 0, F.concat(F.lit("r"), "event_id")).otherwise("").alias("name"), one(k % 3 == 0, "pos").alias("shm_pdu_readers"), one(k % 5 == 0, "disturb").alias("shm_pdu_writers"))
    return readers.robot_channels(r).select(F.col("ord").alias("event_id"), "has_pose", "has_disturbance")


# ---- drawing ----


def _drawn(spark):
    areas, props, links = environment(spark)
    v = search.visual_areas(areas, links, props)
    w = F.col("properties.wind_velocity")
    return corners(v).select("area_id", "xmin", "ymin", "xmax", "ymax", F.col("properties.gps_strength").alias("gps"), w[0].alias("vx"), w[1].alias("vy"), w[2].alias("vz"))


@query(f"{FOLD} SELECT area_id, xmax - xmin AS width, ymax - ymin AS height, {s6('(gps - (SELECT min(gps) FROM env)) / (SELECT max(gps) - min(gps) FROM env)')} AS place, {s6('least(0.5, 1 - gps)')} AS alpha FROM env")
def painted_areas(spark, sf_dir):
    d = drawing.painted(_drawn(spark), "gps")
    return d.select("area_id", "width", "height", r6("place").alias("place"), r6(drawing.weakness_alpha(F.col("gps"))).alias("alpha"))


@query(f"{FOLD}, m AS (SELECT *, sqrt(wx * wx + wy * wy) AS mag FROM env), o AS (SELECT 0.5 * 200 / max(mag) AS s FROM m) SELECT area_id, (xmin + xmax) / 2 AS cx, (ymin + ymax) / 2 AS cy, {s6('wx / greatest(mag, 1e-6) * greatest(0.15 * 200, mag * s)')} AS ax, {s6('wy / greatest(mag, 1e-6) * greatest(0.15 * 200, mag * s)')} AS ay, {s6('greatest(0.2 * 200, 0.5 * s)')} AS head_width, {s6('greatest(0.4 * 200, 1.5 * s)')} AS head_length FROM m, o")
def wind_arrows(spark, sf_dir):
    d = drawing.arrows(_drawn(spark))
    return d.select("area_id", "cx", "cy", *(r6(c).alias(c) for c in ("ax", "ay", "head_width", "head_length")))


@query(f"SELECT min(xmin) - 1 AS xlim_low, max(xmax) + 1 AS xlim_high, min(ymin) - 1 AS ylim_low, max(ymax) + 1 AS ylim_high, min(xmax - xmin) AS cell_dx FROM ({X.CELLS})")
def scene_limits(spark, sf_dir):
    return drawing.scene(_drawn(spark)).select("xlim_low", "xlim_high", "ylim_low", "ylim_high", "cell_dx")


@query(f"SELECT event_id, CASE WHEN value / 50 >= 1e-6 THEN {s6('value / 50 * sin(radians((event_id % 360 + 180) % 360)) * 50')} END AS dx, {s6('(value / 100) * 30')} AS radius FROM events")
def editor_arrows(spark, sf_dir):
    a = drawing.editor_arrow(F.col("value") / 50, F.col("event_id") % 360)
    return X.table(spark, sf_dir, "events").select("event_id", r6(a["dx"]).alias("dx"), r6(drawing.turbulence_radius(F.col("value") / 100)).alias("radius"))


@query("SELECT id, problem FROM (SELECT CAST(p_partkey AS VARCHAR) AS id, 'wind_velocity' AS problem FROM part WHERE p_partkey % 4 = 0 UNION ALL SELECT CAST(p_partkey AS VARCHAR), 'gps_strength' FROM part WHERE p_size / 40.0 > 1 UNION ALL SELECT CAST(p_partkey AS VARCHAR), 'temperature' FROM part WHERE p_partkey % 6 = 0)")
def property_violations(spark, sf_dir):
    k = F.col("p_partkey")
    w = F.when(k % 4 == 0, F.array(F.lit(1.0))).otherwise(F.array(F.lit(1.0), F.lit(0.0), F.lit(0.0)))
    p = X.table(spark, sf_dir, "part").select(k.cast("string").alias("id"), F.struct(w.alias("wind_velocity"), F.when(k % 6 != 0, 20.0).alias("temperature"), F.lit(1.0).alias("sea_level_atm"), (F.col("p_size") / 40.0).alias("gps_strength")).alias("properties"))
    return readers.violations(p, "id", readers.property_checks())


_CLICK = "CASE " + " ".join(f"WHEN {_sql_contains(z, 'x', 'y')} THEN '{z['name']}'" for z in reversed(X.ZONES)) + " END"


@query(f"SELECT event_id, {_CLICK} AS zone FROM ({X.POINTS})")
def zone_clicks(spark, sf_dir):
    return X.points(spark, sf_dir).select("event_id", editor.clicked(F.col("x"), F.col("y"), X.ZONES).alias("zone"))


@query(f"SELECT id, floor(min(x / 7) * 10 + 0.5) / 10 AS xmin, floor(min(y / 7) * 10 + 0.5) / 10 AS ymin, floor(max(x / 7) * 10 + 0.5) / 10 AS xmax, floor(max(y / 7) * 10 + 0.5) / 10 AS ymax FROM ({X.RING_POINTS}) GROUP BY id")
def corner_boxes(spark, sf_dir):
    ring = F.transform("vertices", lambda v: F.struct((v["x"] / 7).alias("x"), (v["y"] / 7).alias("y")))
    return X.rings(spark, sf_dir).select("id", editor.corner_box(ring).alias("b")).select("id", "b.*")


#: The query that answers "what is it like there?" for every event.
flagship = point_to_property
