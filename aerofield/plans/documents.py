"""Queries over files that they write and read again, streams, and trees, with their SQL twins.

What is written is made from the data folder, so that the twin can say from the tables alone
what must come back.
"""

from __future__ import annotations

import functools
import math

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import frames, geometry
from ..operators import city, creator, drawing, editor, mission, search, tree
from ..sources import readers, scratch, writers
from ..streaming import poses
from . import fixtures as X
from .catalogue import _BOXES, _LAT, _LON, _MESH, _MESH_BOX, _PROBES, _TM, _box_rows, _meshes, _sql_tm, _stand_ins, corners, odd_boxes, query, r6, s6

# ---- environment documents ----


def _probes(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col("c_custkey")
    return X.table(spark, sf_dir, "customer").select("c_custkey", (c * 41 % 4400).cast("double").alias("x"), (c * 29 % 6400 - 6400).cast("double").alias("y"), (c % 400).cast("double").alias("z")).distinct()


def _folder(spark: SparkSession, sf_dir: str) -> str:
    """The boxes as an area document, a property each, and a link each, under their second names."""
    out, boxes = scratch.folder(spark, "environment"), odd_boxes(spark, sf_dir)
    n = F.col("ord")
    props = F.struct(F.array((n % 7).cast("double"), (n % 5 - 2).cast("double"), F.lit(0.0)).alias("wind_velocity"), (n % 40 - 10).cast("double").alias("temperature"), F.lit(1.0).alias("sea_level_atm"), F.when(n % 3 > 0, (n % 11) / 10).alias("gps_strength"))
    writers.json_document(boxes, f"{out}/area.json", "space_areas", ["ord"])
    writers.json_document(boxes.where("ord % 13 <> 0").select("ord", F.concat(F.lit("p"), "ord").alias("id"), props.alias("properties")), f"{out}/area_property.json", "area_properties", ["ord"])
    writers.json_document(boxes.where("ord % 17 <> 0").select("ord", "area_id", F.concat(F.lit("p"), "ord").alias("area_property_id")), f"{out}/area_link.json", "links", ["ord"])
    return out


@query(f"SELECT area_id, x0 AS xmin, y0 AS ymin, x0 + w AS xmax, y0 + w AS ymax FROM ({_BOXES})")
def area_document(spark, sf_dir):
    return corners(readers.areas(spark, readers.resolved(spark, _folder(spark, sf_dir))["area"])).select("area_id", "xmin", "ymin", "xmax", "ymax")


@query(f"SELECT 'p' || ord AS id, CAST(ord % 7 AS DOUBLE) AS wx, CAST(ord % 40 - 10 AS DOUBLE) AS temperature, CASE WHEN ord % 3 > 0 THEN ord % 11 / 10.0::DOUBLE ELSE 1.0 END AS gps FROM ({_BOXES}) WHERE ord % 13 <> 0")
def property_document(spark, sf_dir):
    p = readers.properties(spark, readers.resolved(spark, _folder(spark, sf_dir))["property"])
    return p.select("id", F.col("properties.wind_velocity")[0].alias("wx"), F.col("properties.temperature").alias("temperature"), F.col("properties.gps_strength").alias("gps"))


@query("SELECT CAST(l_partkey % 50 AS VARCHAR) AS area_id, CAST(l_suppkey % 20 AS VARCHAR) AS area_property_id, count(*) AS times FROM lineitem WHERE l_linenumber = 1 GROUP BY ALL HAVING count(*) > 1")
def link_document(spark, sf_dir):
    out = scratch.folder(spark, "links")
    li = X.table(spark, sf_dir, "lineitem").where("l_linenumber = 1")
    writers.json_document(li.select(F.col("l_orderkey").alias("ord"), (F.col("l_partkey") % 50).cast("string").alias("area_id"), (F.col("l_suppkey") % 20).cast("string").alias("area_property_id")), out, "links", ["ord"])
    return readers.repeated_links(readers.links(spark, out))


@query(f"""WITH h AS (SELECT c_custkey, min(ord) AS ord FROM ({_PROBES}) JOIN ({_BOXES}) ON x >= x0 AND x < x0 + w AND y >= y0 AND y < y0 + w WHERE z < 300 GROUP BY c_custkey)
SELECT p.c_custkey, 'b' || ord AS area_id, CASE WHEN ord % 17 <> 0 AND ord % 13 <> 0 THEN CAST(ord % 40 - 10 AS DOUBLE) END AS temperature FROM ({_PROBES}) p LEFT JOIN h ON p.c_custkey = h.c_custkey""")
def folder_lookup(spark, sf_dir):
    """Points against a folder of documents, found under their names."""
    areas, props, links = readers.environment(spark, _folder(spark, sf_dir))
    return search.property_of(search.primary_area(_probes(spark, sf_dir), areas), links, props).select("c_custkey", "area_id", F.col("properties.temperature").alias("temperature"))


@query(f"""SELECT 'b' || ord AS area_id, w AS width, CASE WHEN ord % 17 <> 0 THEN 'p' || ord END AS area_property_id, ord % 17 <> 0 AND ord % 13 <> 0 AS has_property FROM ({_BOXES})""")
def inspected_areas(spark, sf_dir):
    areas, props, links = readers.environment(spark, _folder(spark, sf_dir))
    return search.inspected(areas, links, props).select("area_id", geometry.box_size(F.col("bounds"))["width"].alias("width"), "area_property_id", "has_property")


@query(f"SELECT CASE WHEN k = 2 THEN 'b' || ord ELSE CAST(pos AS VARCHAR) END AS area_id, k, x0 AS xmin, y0 + w AS ymax FROM (SELECT *, ord % 3 AS k, row_number() OVER (PARTITION BY ord % 3 ORDER BY ord) - 1 AS pos FROM ({_BOXES}))")
def loose_areas(spark, sf_dir):
    """Three ways of writing areas: lists or objects as corners, under other names, or a bare list."""
    low, high = "[' || x0 || ',' || y0 || ',0]", "[' || (x0 + w) || ',' || (y0 + w) || ',300]"
    box = ["\"aabb\":{\"min\":" + low + ",\"max\":" + high + "}", "\"min\":" + low + ",\"max\":" + high, "\"area_id\":\"b' || ord || '\",\"bounds\":{\"min\":{\"x\":' || x0 || ',\"y\":' || y0 || ',\"z\":0},\"max\":{\"x\":' || (x0 + w) || ',\"y\":' || (y0 + w) || ',\"z\":300}}"]
    b = odd_boxes(spark, sf_dir).select("ord", F.col("bounds.min.x").alias("x0"), F.col("bounds.min.y").alias("y0"), (F.col("bounds.max.x") - F.col("bounds.min.x")).alias("w"))
    out, found = scratch.folder(spark, "loose"), []
    for k, (item, start, end) in enumerate(zip(box, ('{"areas":[', "[", '{"space_areas":['), ("]}", "]", "]}"), strict=True)):
        rows = b.where(f"ord % 3 = {k}").select("ord", F.expr(f"'{{{item}}}'").alias("j"))
        rows.agg(F.concat(F.lit(start), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ord", "j"))), lambda r: r["j"]), ","), F.lit(end)).alias("value")).coalesce(1).write.text(f"{out}/{k}")
        found.append(corners(readers.any_areas(spark, f"{out}/{k}")).select("area_id", F.lit(k).cast("long").alias("k"), "xmin", "ymax"))
    return found[0].unionByName(found[1]).unionByName(found[2])


@query("SELECT s_suppkey, 35 + s_suppkey % 7 AS center_lat, 139.0::DOUBLE AS center_lon, 500.0::DOUBLE AS ns_m, 34.5::DOUBLE AS min_lat FROM supplier WHERE s_suppkey <= 3 AND s_suppkey <> 2")
def query_settings(spark, sf_dir):
    """Settings of a city query, one file each; the second lacks its centre."""
    out, found = scratch.folder(spark, "meta"), []
    for r in X.table(spark, sf_dir, "supplier").where("s_suppkey <= 3").select("s_suppkey").orderBy("s_suppkey").collect():
        n = r.s_suppkey
        centre = "" if n == 2 else f'"center_lat": {35 + n % 7}, "center_lon": 139.0, '
        spark.range(1).select(F.lit("{" + centre + '"ns_m": 500, "ew_m": 600, "bbox": {"min_lat": 34.5, "max_lat": 36}}').alias("value")).write.text(f"{out}/{n}")
        found.append(readers.query_meta(spark, f"{out}/{n}").select(F.lit(n).cast("long").alias("s_suppkey"), F.col("center_lat").cast("long").alias("center_lat"), "center_lon", "ns_m", F.col("bbox.min_lat").alias("min_lat")))
    return functools.reduce(DataFrame.unionByName, found)


@query("SELECT 'area' AS area, 'temperature' AS mode, 2.5::DOUBLE AS wind_scale, true AS print_latlon, CAST(count(*) AS BIGINT) AS zoom, 35.5::DOUBLE AS origin_lat, 0.0::DOUBLE AS offset_x FROM region")
def view_settings(spark, sf_dir):
    out = scratch.folder(spark, "view")
    n = X.table(spark, sf_dir, "region").count()
    spark.range(1).select(F.lit(f'{{"area": "area", "property": "p", "link": "l", "mode": "gps", "wind_scale": 2.5, "origin_lat": 35.5, "zoom": {n}}}').alias("value")).write.text(out)
    c = readers.view_config(spark, out, mode="temperature", print_latlon=True)
    return spark.createDataFrame([(c.area, c.mode, c.wind_scale, c.print_latlon, c.zoom, c.origin_lat, c.offset_x)], "area string, mode string, wind_scale double, print_latlon boolean, zoom long, origin_lat double, offset_x double")


# ---- city files ----


def _put_files(rows: DataFrame, out: str) -> None:
    """Write (path, content) rows as files below a folder."""

    def run(batches):
        import pyarrow.fs as pafs

        fs, at = pafs.FileSystem.from_uri(out if "://" in out else f"file://{out}")
        for b in batches:
            for path, content in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                fs.create_dir(f"{at}/{path}".rpartition("/")[0])
                with fs.open_output_stream(f"{at}/{path}") as f:
                    f.write(content.encode())
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows])], names=["n"])

    rows.select("path", "content").mapInArrow(run, "n long").write.format("noop").mode("overwrite").save()


def _city(spark: SparkSession, sf_dir: str) -> str:
    """A city: a file a supplier, with a triangular building a tenth of its number; every fifth building has no rings, every third no id."""
    out, k = scratch.folder(spark, "city"), F.col("s_suppkey")
    mesh = F.concat(F.lit("5339"), (k % 8).cast("string"), (k % 6).cast("string"), F.lpad((k % 100).cast("string"), 2, "0"))
    ring = "concat(35.5 + b * 0.001 + s_suppkey * 0.0001, ' ', 139.7, ' ', b, ' ', 35.5 + b * 0.001 + s_suppkey * 0.0001, ' ', 139.7005, ' ', b, ' ', 35.5005 + b * 0.001 + s_suppkey * 0.0001, ' ', 139.7, ' ', b, ' ', 35.6, ' ', 139.8, ' ', b + 5)"
    one = f"""concat('<bldg:Building', case when b % 3 > 0 then concat(' gml:id="s', s_suppkey, '_', b, '"') else '' end, '><x>', case when b % 5 > 0 then concat('<bldg:lod1Solid><gml:LinearRing><gml:posList>', {ring}, '</gml:posList></gml:LinearRing></bldg:lod1Solid>') else '' end, '</x></bldg:Building>')"""
    xml = F.concat(F.lit('<core xmlns:gml="http://www.opengis.net/gml" xmlns:bldg="http://www.opengis.net/citygml/building/2.0">'), F.array_join(F.expr(f"transform(sequence(0, cast(s_suppkey % 10 as int)), b -> {one})"), ""), F.lit("</core>"))
    s = X.table(spark, sf_dir, "supplier")
    name = F.concat(F.lit("udx/bldg/"), mesh, F.lit("_bldg_6697_"), k, F.lit(".gml"))
    _put_files(s.select(name.alias("path"), xml.alias("content")), out)
    side = s.where("s_suppkey % 4 = 0").select(F.concat(F.lit("udx/bldg/"), mesh, F.lit("_bldg_6697_"), k, F.lit("_note.txt")).alias("path"), F.lit("-").alias("content"))
    _put_files(side, out)
    return out


_CITY = "SELECT s_suppkey AS k, '5339' || (s_suppkey % 8) || (s_suppkey % 6) || lpad(CAST(s_suppkey % 100 AS VARCHAR), 2, '0') AS mesh FROM supplier"


@query(f"SELECT mesh, 'bldg_6697' AS kind, mesh || '_bldg_6697_' || k || '.gml' AS name FROM ({_CITY})")
def city_index(spark, sf_dir):
    """The index of a folder of city files, as a document too."""
    out = _city(spark, sf_dir)
    index = city.gml_index(readers.gml_paths(spark, out))
    writers.json_document(index, f"{out}/index.json", "files", ["path"])
    back = readers.document(spark, f"{out}/index.json", "files array<struct<mesh: string, kind: string, path: string>>").select(F.explode("files").alias("f")).select("f.*")
    return back.select("mesh", "kind", F.element_at(F.split("path", "/"), -1).alias("name"))


@query(f"SELECT CASE WHEN b % 3 > 0 THEN 's' || k || '_' || b ELSE 'bldg_' || (row_number() OVER (PARTITION BY k ORDER BY b)) END AS id, mesh || '_bldg_6697_' || k || '.gml' AS file, CAST(4 AS INTEGER) AS points FROM ({_CITY}), range(0, 10) AS r(b) WHERE b <= k % 10 AND b % 5 > 0")
def city_buildings(spark, sf_dir):
    b = readers.buildings(spark, _city(spark, sf_dir))
    return b.select("id", F.element_at(F.split("source_gml", "/"), -1).alias("file"), F.size(F.flatten(F.transform("pos_lists", city.pos_list))).alias("points"))


_NEAR = 3000.0


@query(f"""WITH b AS (SELECT k, b, CASE WHEN b % 3 > 0 THEN 's' || k || '_' || b ELSE 'bldg_' || (row_number() OVER (PARTITION BY k ORDER BY b)) END AS name FROM ({_CITY}), range(0, 10) AS r(b) WHERE b <= k % 10 AND b % 5 > 0),
src AS (SELECT k * 40 + b * 4 + i AS id, CASE WHEN i = 1 THEN 139.7005::DOUBLE ELSE 139.7::DOUBLE END AS lon, CASE WHEN i = 2 THEN 35.5005::DOUBLE ELSE 35.5::DOUBLE END + b * 0.001::DOUBLE + k * 0.0001::DOUBLE AS lat FROM b, range(0, 3) AS t(i)
  UNION ALL SELECT -1, 139.7::DOUBLE, 35.5::DOUBLE),
xy AS ({_sql_tm()}), o AS (SELECT x AS x0, y AS y0 FROM xy WHERE id = -1),
m AS (SELECT id // 40 AS k, id % 40 // 4 AS b, avg(x - x0) AS mx, avg(y - y0) AS my FROM xy, o WHERE id >= 0 GROUP BY ALL)
SELECT name || '/' || k AS id, CAST(b AS DOUBLE) AS zmin, CAST(b + 5 AS DOUBLE) AS zmax, CAST(3 AS INTEGER) AS corners, round(mx, 1) + 0.0 AS x, round(my, 1) + 0.0 AS y FROM m JOIN b USING (k, b) WHERE abs(my) <= {_NEAR}::DOUBLE AND abs(mx) <= {_NEAR}::DOUBLE""")
def city_footprints(spark, sf_dir):
    points = F.flatten(F.transform("pos_lists", city.pos_list))
    b = readers.buildings(spark, _city(spark, sf_dir)).select("id", "source_gml", points.alias("points"))
    f = city.footprints(b, (35.5, 139.7), _NEAR, _NEAR)
    m = geometry.ring_mean("vertices")
    file = F.regexp_extract("source_gml", r"_(\d+)\.gml$", 1)
    return f.select(F.concat("id", F.lit("/"), file).alias("id"), "zmin", "zmax", F.size("vertices").alias("corners"), (F.round(m["x"], 1) + 0.0).alias("x"), (F.round(m["y"], 1) + 0.0).alias("y"))


@query(f"""WITH f AS (SELECT k, mesh, mesh || '_bldg_6697_' || k || '.gml' AS name FROM ({_CITY}) UNION ALL SELECT k, mesh, mesh || '_bldg_6697_' || k || '_note.txt' FROM ({_CITY}) WHERE k % 4 = 0),
s AS (SELECT * FROM f WHERE name LIKE '%.gml' AND k % 2 = 0), c AS (SELECT f.name FROM s JOIN f ON starts_with(f.name, s.mesh || '_bldg_6697') AND f.name <> s.name)
SELECT DISTINCT name AS src, '/copy/udx/bldg/' || name AS dst FROM (SELECT name FROM s UNION ALL SELECT name FROM c)""")
def copied_files(spark, sf_dir):
    """What to copy: chosen files, and those beside them whose names start alike."""
    out = _city(spark, sf_dir)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(out).select("path")
    chosen = city.gml_index(files.where("path like '%.gml'")).where(F.regexp_extract("path", r"_(\d+)\.gml$", 1).cast("int") % 2 == 0)
    m = writers.copy_manifest(chosen, city.with_companions(chosen, files), "", "/copy")
    return m.select(F.element_at(F.split("src", "/"), -1).alias("src"), F.concat(F.lit("/copy"), F.expr("substring(src, length(regexp_extract(src, '^(.*)/udx/', 1)) + 1)")).alias("dst"))


@query(f"SELECT s_suppkey, p_partkey FROM (SELECT s_suppkey, 34.9 + s_suppkey % 9 / 20.0::DOUBLE AS lat, 139.0 + s_suppkey % 7 / 8.0::DOUBLE AS lon FROM supplier), ({_MESH_BOX}) WHERE a + h >= lat AND a <= lat + 0.05 AND c + w >= lon AND c <= lon + 0.1")
def meshes_in_query_boxes(spark, sf_dir):
    """Many boxes at once."""
    lat, lon = F.lit(34.9) + F.col("s_suppkey") % 9 / 20.0, F.lit(139.0) + F.col("s_suppkey") % 7 / 8.0
    box = F.struct(lat.alias("min_lat"), (lat + 0.05).alias("max_lat"), lon.alias("min_lon"), (lon + 0.1).alias("max_lon"))
    boxes = X.table(spark, sf_dir, "supplier").select("s_suppkey", box.alias("box"))
    return city.in_query_boxes(_meshes(spark, sf_dir), boxes).select("s_suppkey", "p_partkey")


@query(f"SELECT m.p_partkey, round(a, 9) AS min_lat, round(c + w, 9) AS max_lon FROM ({_MESH}) m LEFT JOIN (SELECT * FROM ({_MESH_BOX}) WHERE length(mesh) = 8) b ON m.p_partkey = b.p_partkey")
def strict_meshes(spark, sf_dir):
    return _meshes(spark, sf_dir).withColumn("box", frames.mesh_box(F.col("mesh"), strict=True)).select("p_partkey", *(F.round(f"box.{k}", 9).alias(k) for k in ("min_lat", "max_lon")))


# ---- polygons and boxes ----

# rectangles (k % 4 > 0) and L shapes that fill less than two thirds of their box, turned and moved
_TURN = "0.1::DOUBLE + p_partkey % 13 / 10.0::DOUBLE"
_SHAPES = f"SELECT p_partkey AS k, 2.0::DOUBLE + p_size AS a, 1.0::DOUBLE + p_size / 4.0::DOUBLE AS b, {_TURN} AS turn, CAST(p_partkey % 1000 AS DOUBLE) AS cx, CAST(p_partkey % 700 AS DOUBLE) AS cy FROM part"


def _shapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, vertices, zmin, zmax, source_gml)."""
    p = X.table(spark, sf_dir, "part").selectExpr("p_partkey as k", "2D + p_size as a", "1D + p_size / 4D as b", "0.1D + p_partkey % 13 / 10D as turn", "cast(p_partkey % 1000 as double) as cx", "cast(p_partkey % 700 as double) as cy")
    at = lambda u, v: f"named_struct('x', cx + ({u}) * cos(turn) - ({v}) * sin(turn), 'y', cy + ({u}) * sin(turn) + ({v}) * cos(turn))"
    box = f"array({at('-a', '-b')}, {at('a', '-b')}, {at('a', 'b')}, {at('-a', 'b')})"
    ell = f"array({at('-a', '-b')}, {at('a', '-b')}, {at('a', '-b * 0.8')}, {at('-a * 0.8', '-b * 0.8')}, {at('-a * 0.8', 'b')}, {at('-a', 'b')})"
    return p.select(F.col("k").cast("string").alias("id"), F.expr(f"case when k % 4 > 0 then {box} else {ell} end").alias("vertices"), F.expr("cast(k % 10 as double)").alias("zmin"), F.expr("k % 10 + 3D").alias("zmax"), F.lit("s").alias("source_gml"))


@query(f"SELECT CAST(k AS VARCHAR) AS id, CAST(CASE WHEN k % 4 > 0 THEN 4 ELSE 6 END AS INTEGER) AS corners, {s6('cx - a * cos(turn) + b * sin(turn)')} AS x, CAST(k % 10 AS DOUBLE) AS zmin, 'EPSG:6677' AS crs, 35.5::DOUBLE AS lat, 300.0::DOUBLE AS ns_m FROM ({_SHAPES})")
def polygon_document(spark, sf_dir):
    """Polygons as a document with its header, and back."""
    out = scratch.folder(spark, "polygons")
    listed = _shapes(spark, sf_dir).withColumn("vertices", F.transform("vertices", lambda v: F.array(v["x"], v["y"])))
    writers.json_document(listed, out, "polygons", ["id"], header=writers.city_header("EPSG:6677", origin=(35.5, 139.7, 1.0, 2.0), bounds=(300.0, 400.0)))
    head = readers.city_header(spark, out)
    return readers.polygons(spark, out).join(F.broadcast(head)).select("id", F.size("vertices").alias("corners"), r6(F.col("vertices")[0]["x"]).alias("x"), "zmin", "crs", F.col("origin.lat").alias("lat"), F.col("bounds.ns_m").alias("ns_m"))


@query(f"""WITH s AS ({_SHAPES}),
e AS (SELECT k, a, b, turn, cx, cy, i, (CASE i WHEN 0 THEN [-a, -b, a, -b] WHEN 1 THEN [a, -b, a, -b * 0.8] WHEN 2 THEN [a, -b * 0.8, -a * 0.8, -b * 0.8] WHEN 3 THEN [-a * 0.8, -b * 0.8, -a * 0.8, b] WHEN 4 THEN [-a * 0.8, b, -a, b] ELSE [-a, b, -a, -b] END) AS q FROM s, range(0, 6) AS r(i) WHERE k % 4 = 0),
w AS (SELECT *, (q[1] + q[3]) / 2 AS u, (q[2] + q[4]) / 2 AS v, sqrt((q[3] - q[1]) * (q[3] - q[1]) + (q[4] - q[2]) * (q[4] - q[2])) / 2 AS h FROM e)
SELECT CAST(k AS VARCHAR) AS id, NULL::VARCHAR AS parent_id, 'obb' AS mode, NULL::INTEGER AS edge_index, {s6('cx')} AS x, {s6('cy')} AS y, {s6('greatest(a, b)')} AS sx, {s6('least(a, b)')} AS sy, {s6('CASE WHEN a >= b THEN turn ELSE turn + pi() / 2 END % pi()')} AS yaw, round(4 * a * b, 4) AS area FROM s WHERE k % 4 > 0
UNION ALL SELECT k || '_edge' || i, CAST(k AS VARCHAR), 'wall', CAST(i AS INTEGER), {s6('cx + u * cos(turn) - v * sin(turn)')}, {s6('cy + u * sin(turn) + v * cos(turn)')}, {s6('h')}, 0.1, {s6('(CASE WHEN i % 2 = 0 THEN turn ELSE turn + pi() / 2 END) % pi()')}, round(h * 0.4, 4) FROM w""")
def record_document(spark, sf_dir):
    """Boxes of what nearly fills them, walls of the rest, written and read again."""
    out = scratch.folder(spark, "records")
    writers.json_document(city.box_records(_shapes(spark, sf_dir), threshold=1.5), out, "results", ["id"], header=writers.city_header("EPSG:6677"), drop=())
    r = readers.records(spark, out)
    yaw = F.pmod(F.round(F.pmod("yaw_rad", F.lit(math.pi)), 9), F.round(F.lit(math.pi), 9))
    return r.select("id", "parent_id", "mode", "edge_index", r6(F.col("center")[0]).alias("x"), r6(F.col("center")[1]).alias("y"), r6(F.col("half_size")[0]).alias("sx"), r6(F.col("half_size")[1]).alias("sy"), r6(yaw).alias("yaw"), F.round("area", 4).alias("area"))


@query(f"SELECT round(min(cx - a * abs(cos(turn)) - b * abs(sin(turn))) - 50, 6) AS xlow, round(max(cy + a * abs(sin(turn)) + b * abs(cos(turn))) + 50, 6) AS yhigh, CAST(sum(k % 20) AS BIGINT) AS colours FROM ({_SHAPES}) WHERE k % 4 > 0")
def box_plot(spark, sf_dir):
    r = city.box_records(_shapes(spark, sf_dir).where("id % 4 > 0"))
    return drawing.box_limits(r).join(r.agg(F.sum(drawing.palette_place(F.col("id").cast("long"))).alias("colours"))).select(F.round("xlow", 6).alias("xlow"), F.round("yhigh", 6).alias("yhigh"), "colours")


@query("""WITH g AS (SELECT p_partkey AS k, CASE WHEN p_partkey % 2 = 0 THEN p_partkey % 10 / 2.0::DOUBLE + 1 END AS zmin, CASE WHEN p_partkey % 4 = 0 THEN p_partkey % 10 / 2.0::DOUBLE + 4 END AS zmax FROM part), m AS (SELECT min(coalesce(zmin, 7.0)) AS low FROM g)
SELECT CAST(k AS VARCHAR) AS id, zmin - low AS zmin, zmax - low AS zmax FROM g, m""")
def grounded_records(spark, sf_dir):
    r = _box_rows(spark, sf_dir).withColumn("zmin", F.col("zmin") + 1).withColumn("zmax", F.col("zmax") + 1)
    return city.grounded(r, zmin=7.0).select("id", "zmin", "zmax")


@query("SELECT 'body_' || p_partkey AS name, 'geom_' || p_partkey AS geom, rtrim(rtrim(printf('%.6f', p_partkey % 100 / 4.0::DOUBLE), '0'), '.') || ' ' || rtrim(rtrim(printf('%.6f', p_partkey % 37 / 8.0::DOUBLE), '0'), '.') AS place, '0 0 90' AS euler FROM part")
def world_file(spark, sf_dir):
    """A simulator's world with own rules for places, turns and sizes, read back by its lines."""
    out = scratch.folder(spark, "world")
    g = city.geoms(_box_rows(spark, sf_dir), pos_fn=lambda x, y, z: (x, y, z), yaw_fn=lambda yaw: F.degrees(yaw) + 90, sxy_fn=lambda sx, sy: (sx, sy))
    writers.mjcf(city.geom_xml(g), out, floor=True)
    line = spark.read.text(out).where("value like '<body%'")
    at = lambda p: F.regexp_extract("value", p, 1)
    return line.select(at('<body name="([^"]*)"').alias("name"), at('geom name="([^"]*)"').alias("geom"), at(r'<geom.* pos="(\S+ \S+) ').alias("place"), at('euler="([^"]*)"').alias("euler"))


@query("SELECT p_partkey, least(x, y) AS xmin, greatest(x, y) AS xmax, least(x, -x) AS ymin, least(x, y) AS low, greatest(x + 1, y + 2) AS high FROM (SELECT p_partkey, p_partkey % 17 * 1.0::DOUBLE AS x, p_size * 1.0::DOUBLE AS y FROM part)")
def merged_boxes(spark, sf_dir):
    """Corners put in order, and the box around two boxes."""
    p = X.table(spark, sf_dir, "part").select("p_partkey", (F.col("p_partkey") % 17).cast("double").alias("x"), F.col("p_size").cast("double").alias("y"))
    pt = lambda x, y: F.struct(x.alias("x"), y.alias("y"))
    n = geometry.normal_box(pt(F.col("x"), F.col("x")), pt(F.col("y"), -F.col("x")))
    box = lambda v, w: F.struct(*(F.struct(*(c.alias(k) for k in "xyz")).alias(end) for end, c in (("min", v), ("max", v + w))))
    m = geometry.merged_box(box(F.col("x"), 1.0), box(F.col("y"), 2.0))
    return p.select("p_partkey", n["xmin"].alias("xmin"), n["xmax"].alias("xmax"), n["ymin"].alias("ymin"), m["min"]["z"].alias("low"), m["max"]["z"].alias("high"))


# ---- trees ----


def _sql_tree(depth: int) -> str:
    """Level by level, as a chain of CTEs."""
    steps = [f"t0 AS (SELECT ord, area_id, x0 AS xl, y0 AS yl, x0 + w AS xh, y0 + w AS yh, CAST(1 AS BIGINT) AS node, 0 AS depth, false AS leaf, ord AS o FROM ({_BOXES}))"]
    for k in range(depth + 1):
        steps.append(f"""a{k} AS (SELECT *, count(*) OVER p AS n, max((xl + xh) / 2) OVER p - min((xl + xh) / 2) OVER p AS sx, max((yl + yh) / 2) OVER p - min((yl + yh) / 2) OVER p AS sy FROM t{k} WINDOW p AS (PARTITION BY node)),
b{k} AS (SELECT *, row_number() OVER (PARTITION BY node ORDER BY CASE WHEN sx >= sy THEN xl ELSE yl END, o) - 1 AS pos, leaf OR n <= 1 OR {str(k == depth).lower()} AS done FROM a{k}),
t{k + 1} AS (SELECT ord, area_id, xl, yl, xh, yh, CASE WHEN done THEN node ELSE node * 2 + CAST(pos >= n // 2 AS BIGINT) END AS node, CASE WHEN done THEN depth ELSE depth + 1 END AS depth, done AS leaf, CASE WHEN done THEN o ELSE pos END AS o FROM b{k})""")
    return f"WITH {', '.join(steps)}, leaves AS (SELECT * FROM t{depth + 1})"


_UP = "SELECT node >> CAST(d AS BIGINT) AS node, depth - CAST(d AS INTEGER) AS level, d = 0 AS own, xl, yl, xh, yh FROM leaves, range(0, 8) AS r(d) WHERE d <= depth"


@query(f"{_sql_tree(6)} SELECT node, level AS depth, bool_or(own) AS is_leaf, count(*) FILTER (own) AS n_areas, min(xl) AS xmin, min(yl) AS ymin, max(xh) AS xmax, max(yh) AS ymax FROM ({_UP}) GROUP BY node, level")
def tree_levels(spark, sf_dir):
    """A bounding-volume tree over overlapping boxes."""
    t = tree.tree_nodes(odd_boxes(spark, sf_dir), 6)
    return corners(t).select("node", "depth", "is_leaf", F.when(F.col("is_leaf"), F.size("areas")).otherwise(0).cast("long").alias("n_areas"), "xmin", "ymin", "xmax", "ymax")


@query(f"{_sql_tree(6)} SELECT max(depth) AS max_depth, count(*) AS leaves, avg(n) AS average_leaf FROM (SELECT node, depth, count(*) AS n FROM leaves GROUP BY ALL)")
def tree_summary(spark, sf_dir):
    return tree.tree_stats(tree.tree_nodes(odd_boxes(spark, sf_dir), 6))


@query(f"SELECT event_id, coalesce(area_id, '') AS found FROM (SELECT event_id, x, y, z FROM ({X.POINTS}) WHERE event_id % 10 = 0) LEFT JOIN ({X.CELLS}) c ON x >= xmin AND x < xmax AND y >= ymin AND y < ymax AND z >= 0 AND z < 100")
def tree_lookup(spark, sf_dir):
    """Points sent down a tree of grid cells; every tenth event is a point here."""
    areas, _, _ = creator.build(spark, X.MODEL, with_zones=False)
    out = scratch.folder(spark, "nodes")
    tree.tree_nodes(areas, 7).write.parquet(out)
    found = tree.tree_search(X.points(spark, sf_dir).where("event_id % 10 = 0").select("event_id", "x", "y", "z"), spark.read.parquet(out), ["event_id"], 7)
    return found.select("event_id", F.array_join("found", ",").alias("found"))


# ---- projections ----


def _sql_vincenty(rounds: int = 8) -> str:
    """Distance and azimuth from the origin, the iteration written out."""
    f = frames.FLATTENING_WGS84
    b, u1 = frames.EARTH_RADIUS * (1 - f), math.atan((1 - f) * math.tan(math.radians(_LAT)))
    s1, c1 = f"({math.sin(u1)!r}::DOUBLE)", f"({math.cos(u1)!r}::DOUBLE)"
    n = lambda v: f"({v!r}::DOUBLE)"
    steps = [f"v0 AS (SELECT id, sin(atan({n(1 - f)} * tan(radians(lat)))) AS s2, cos(atan({n(1 - f)} * tan(radians(lat)))) AS c2, radians(lon - {n(_LON)}) AS big, radians(lon - {n(_LON)}) AS lam FROM src)"]
    for k in range(rounds):
        steps += [
            f"p{k} AS (SELECT id, s2, c2, big, lam, c2 * sin(lam) AS p, {c1} * s2 - {s1} * c2 * cos(lam) AS q, {s1} * s2 + {c1} * c2 * cos(lam) AS cs FROM v{k})",
            f"q{k} AS (SELECT *, sqrt(p * p + q * q) AS ss, atan2(sqrt(p * p + q * q), cs) AS sigma, {c1} * c2 * sin(lam) / sqrt(p * p + q * q) AS sa FROM p{k})",
            f"r{k} AS (SELECT *, cs - 2 * {s1} * s2 / (1 - sa * sa) AS cm, {n(f / 16)} * (1 - sa * sa) * (4 + {n(f)} * (4 - 3 * (1 - sa * sa))) AS c FROM q{k})",
            f"v{k + 1} AS (SELECT id, s2, c2, big, big + (1 - c) * {n(f)} * sa * (sigma + c * ss * (cm + c * cs * (2 * cm * cm - 1))) AS lam, p, q, cs, ss, sigma, sa, cm FROM r{k})",
        ]
    k2 = f"((1 - sa * sa) * {n((frames.EARTH_RADIUS**2 - b**2) / b**2)})"
    big_a, big_b = f"(1 + {k2} / 16384 * (4096 + {k2} * (-768 + {k2} * (320 - 175 * {k2}))))", f"({k2} / 1024 * (256 + {k2} * (-128 + {k2} * (74 - 47 * {k2}))))"
    ds = f"({big_b} * ss * (cm + {big_b} / 4 * (cs * (2 * cm * cm - 1) - {big_b} / 6 * cm * (4 * ss * ss - 3) * (4 * cm * cm - 3))))"
    return f"{', '.join(steps)}, g AS (SELECT id, {n(b)} * {big_a} * (sigma - {ds}) AS s, atan2(p, q) AS az FROM v{rounds})"


_AROUND = "SELECT c_custkey AS id, 135 + c_custkey % 977 / 977.0::DOUBLE AS lon, 34 + c_custkey % 881 / 881.0::DOUBLE AS lat FROM customer"


@query(f"WITH src AS ({_AROUND}), {_sql_vincenty()} SELECT id, round(s * sin(az), 2) + 0.0 AS x, round(s * cos(az), 2) + 0.0 AS y FROM g")
def equidistant_map(spark, sf_dir):
    lon, lat = F.lit(135) + F.col("c_custkey") % 977 / 977.0, F.lit(34) + F.col("c_custkey") % 881 / 881.0
    p = frames.azimuthal_equidistant(*X.ORIGIN)(lon, lat)
    return X.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), p.alias("p")).select("id", (F.round("p.x", 2) + 0.0).alias("x"), (F.round("p.y", 2) + 0.0).alias("y"))


@query(f"SELECT id, round(lon, 8) AS lon, round(lat, 8) AS lat FROM ({_AROUND})")
def equidistant_inverse(spark, sf_dir):
    """There and back."""
    lon, lat = F.lit(135) + F.col("c_custkey") % 977 / 977.0, F.lit(34) + F.col("c_custkey") % 881 / 881.0
    p = X.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), frames.azimuthal_equidistant(*X.ORIGIN)(lon, lat).alias("p"))
    back = frames.azimuthal_equidistant_inverse(*X.ORIGIN)(F.col("p.x"), F.col("p.y"))
    return p.select("id", back.alias("q")).select("id", F.round("q.lon", 8).alias("lon"), F.round("q.lat", 8).alias("lat"))


@query(f"WITH src AS (SELECT c_custkey AS id, 138.5 + c_custkey % 977 / 400.0::DOUBLE AS lon, 34.5 + c_custkey % 881 / 300.0::DOUBLE AS lat FROM customer) SELECT id, round(lon, 8) AS lon, round(lat, 8) AS lat FROM src")
def plane_inverse(spark, sf_dir):
    """There and back by the code of the plane system."""
    p = frames.projection("EPSG:6677")
    lon, lat = p.inverse(*p.forward(F.lit(138.5) + F.col("c_custkey") % 977 / 400.0, F.lit(34.5) + F.col("c_custkey") % 881 / 300.0))
    return X.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.round(lon, 8).alias("lon"), F.round(lat, 8).alias("lat"))


# ---- zones, missions, streams ----


@query(f"SELECT area_id, 4.0::DOUBLE AS wx, CASE WHEN (xmin + xmax) / 2 <= 500 THEN 0.5::DOUBLE ELSE 1.0 END AS gps FROM ({X.CELLS})")
def unknown_mode(spark, sf_dir):
    """A zone of no known mode leaves the wind alone; its signal strength counts."""
    z = {"name": "odd", "shape": {"rect": {"min_m": [0, -6400], "max_m": [500, 0]}}, "effect": {"mode": "unheard", "gps_abs": 0.5}, "priority": 1}
    areas, p, _ = creator.build(spark, X.MODEL | {"zones": [z]})
    return p.select(F.expr("substring(id, 6)").alias("area_id"), F.col("properties.wind_velocity")[0].alias("wx"), F.col("properties.gps_strength").alias("gps"))


@query(f"SELECT area_id, t, {s6('4.0 + CASE WHEN (xmin + xmax) / 2 <= 500 THEN 2.0::DOUBLE * sin(t * 0.2::DOUBLE * pi()) ELSE 0 END')} AS wx FROM ({X.CELLS}), (SELECT unnest([0.0, 1.25, 4.0])::DOUBLE AS t)")
def timed_zones(spark, sf_dir):
    """Wind that changes with time inside a zone, and a zone that has ended (extensions)."""
    z = {"name": "tide", "shape": {"rect": {"min_m": [0, -6400], "max_m": [500, 0]}}, "effect": {"mode": "add", "add_ms": [0, 0, 0]}, "time_mods": {"apply_to": ["wind_x"], "periodic": [{"amp": 2.0, "freq_hz": 0.1}]}}
    gone = {"name": "gone", "shape": {"rect": {"min_m": [0, -6400], "max_m": [4400, 0]}}, "effect": {"mode": "scale", "scale": 0.0}, "active": {"t_from_s": -9, "t_to_s": 0}}
    cells = creator.cells(spark, X.GRID).withColumn("t", F.explode(F.array(*map(F.lit, (0.0, 1.25, 4.0))))).withColumn("properties", creator.base_property(X.BASE))
    return creator.fold_zones(cells, [z, gone], at=F.col("t")).select("area_id", "t", r6(F.col("properties.wind_velocity")[0]).alias("wx"))


@query("SELECT p_partkey AS ord, 'z' || p_partkey AS name, CAST(p_size % 5 AS INTEGER) AS priority, CASE WHEN p_partkey % 2 = 0 THEN 'circle' ELSE 'rect' END AS shape, p_size * 1.0::DOUBLE AS wx, CASE WHEN p_partkey % 3 = 0 THEN 0.25::DOUBLE END AS gps_abs, CASE WHEN p_partkey % 2 = 0 THEN -(p_partkey % 9) * 1.0::DOUBLE + 0.0 END AS x, CASE WHEN p_partkey % 2 = 0 THEN p_size * 1.0::DOUBLE END AS y FROM part")
def zone_documents(spark, sf_dir):
    """Zones of a model in the robots' frame, exported one by one, and imported to east and north."""
    p = X.table(spark, sf_dir, "part").select(F.col("p_partkey").alias("k"), F.col("p_size").cast("double").alias("s"))
    shape = F.when(F.col("k") % 2 == 0, F.concat(F.lit('{"circle":{"center_m":['), "s", F.lit(","), (F.col("k") % 9).cast("double"), F.lit('],"radius_m":3}}'))).otherwise(F.lit('{"rect":{"min_m":[0,0],"max_m":[1,2]}}'))
    gps = F.when(F.col("k") % 3 == 0, F.lit(',"gps_abs":0.25')).otherwise("")
    one = F.concat(F.lit('{"name":"z'), "k", F.lit('","priority":'), (F.col("s") % 5).cast("int"), F.lit(',"shape":'), shape, F.lit(',"effect":{"mode":"absolute","wind_ms":[0,'), -F.col("s"), F.lit(",0]"), gps, F.lit("}}"))
    out = scratch.folder(spark, "model")
    writers.items_document(p.select("k", one.alias("j")), out, "zones", header={"meta": '{"axis":"ROS"}'})
    zones = editor.imported_files(spark, out, to_enu=True)
    back = editor.exported(zones).select(F.from_json("json", editor.ZONE).alias("z"))
    return back.select(F.substring("z.name", 2, 20).cast("long").alias("ord"), "z.name", "z.priority", F.when(F.col("z.shape.circle").isNotNull(), "circle").otherwise("rect").alias("shape"), F.col("z.effect.wind_ms")[0].alias("wx"), "z.effect.gps_abs", (F.col("z.shape.circle.center_m")[0] + 0.0).alias("x"), F.col("z.shape.circle.center_m")[1].alias("y"))


@query("SELECT 'z' || p_partkey AS name, CASE WHEN p_partkey % 3 = 0 THEN 'absolute' ELSE 'turbulence' END AS mode, CASE WHEN p_partkey % 2 = 0 THEN 'circle' ELSE 'rect' END AS kind, CASE WHEN p_partkey % 2 = 0 THEN '#27ae60' ELSE '#e67e22' END AS colour, CASE WHEN p_partkey % 3 > 0 THEN p_size * 1.0::DOUBLE END AS std FROM part WHERE p_partkey % 5 > 0")
def zone_styles(spark, sf_dir):
    p = X.table(spark, sf_dir, "part")
    shape = F.expr("case when p_partkey % 5 = 0 then '{}' when p_partkey % 2 = 0 then '{\"circle\":{\"center_m\":[0,0],\"radius_m\":1}}' else '{\"rect\":{\"min_m\":[0,0],\"max_m\":[1,1]}}' end")
    effect = F.expr("case when p_partkey % 3 = 0 then '{}' else concat('{\"mode\":\"turbulence\",\"turbulence\":{\"type\":\"gauss\",\"std_ms\":', p_size, '}}') end")
    zones = p.select(F.from_json(F.concat(F.lit('{"name":"z'), "p_partkey", F.lit('","shape":'), shape, F.lit(',"effect":'), effect, F.lit("}")), editor.ZONE).alias("zone"))
    return editor.styled(zones).select("name", "mode", "kind", "colour", "std")


@query("SELECT CAST(s_suppkey AS VARCHAR) AS id, problem FROM supplier, (SELECT unnest(['shape', 'mode', 'effect', 'grid', 'wind', 'axis']) AS problem) WHERE CASE problem WHEN 'shape' THEN s_suppkey % 2 = 0 WHEN 'mode' THEN s_suppkey % 3 = 0 WHEN 'effect' THEN s_suppkey % 5 = 0 AND s_suppkey % 3 <> 0 WHEN 'grid' THEN s_suppkey % 7 = 0 WHEN 'wind' THEN s_suppkey % 4 = 0 ELSE s_suppkey % 11 = 0 END")
def model_violations(spark, sf_dir):
    """Whole models against what the schema asks, and their zones."""
    s = X.table(spark, sf_dir, "supplier")
    text = F.expr("""concat('{"meta":{"axis":"', if(s_suppkey % 11 = 0, 'UPWARD', 'ENU'), '"},"grid":{', if(s_suppkey % 7 = 0, '', '"max":[1,1,1],'), '"cell_m":[1,1,1]},"base":{"wind":{', if(s_suppkey % 4 = 0, '"dir_deg":9', '"vector_ms":[1,2,3]'), '}},"zones":[{"name":"z","shape":{"circle":{"center_m":[0,0],"radius_m":', if(s_suppkey % 2 = 0, -1, 1), '}},"effect":{"mode":"', if(s_suppkey % 3 = 0, 'odd', 'scale'), '"', if(s_suppkey % 5 = 0, '', ',"scale":2'), '}}]}')""")
    docs = s.select(F.col("s_suppkey").cast("string").alias("id"), text.alias("json"))
    whole = readers.violations(readers.models(docs), "id", readers.model_checks())
    zones = docs.select("id", F.from_json("json", f"zones array<{editor.ZONE}>").alias("m")).select("id", F.explode("m.zones").alias("zone"))
    return whole.unionByName(readers.violations(zones, "id", readers.zone_checks()))


@query("SELECT CAST(s_suppkey AS VARCHAR) AS id, problem FROM supplier, (SELECT unnest(['position', 'size', 'rotation']) AS problem) WHERE CASE problem WHEN 'position' THEN s_suppkey % 2 = 0 WHEN 'size' THEN s_suppkey % 3 = 0 ELSE s_suppkey % 5 = 0 END")
def boundary_violations(spark, sf_dir):
    n = lambda k, bad: F.when(F.col("s_suppkey") % k == 0, bad).otherwise(F.array(*map(F.lit, (1.0, 2.0, 3.0))))
    b = X.table(spark, sf_dir, "supplier").select(F.col("s_suppkey").cast("string").alias("name"), n(2, F.array(F.lit(1.0))).alias("position"), n(3, F.array(F.lit(1.0))).alias("size"), n(5, F.lit(None).cast("array<double>")).alias("rotation"))
    return readers.violations(b, "name", readers.boundary_checks())


@query("SELECT s_suppkey, CASE WHEN s_suppkey % 2 = 0 THEN -5.0::DOUBLE ELSE -1000.0 END AS low_x, 100.0::DOUBLE AS high_z, CASE WHEN s_suppkey % 3 = 0 THEN 3 ELSE 1 END AS levels, CASE WHEN s_suppkey % 5 = 0 THEN 1.5::DOUBLE ELSE 4.0 END AS wind_x, 20.0::DOUBLE AS temperature FROM supplier")
def editor_settings(spark, sf_dir):
    text = F.expr("""concat('{"grid":{', if(s_suppkey % 2 = 0, '"min":[-5],', ''), if(s_suppkey % 3 = 0, '"levels":3,', ''), '"cell_m":[10,10]},"base":{', if(s_suppkey % 5 = 0, '"wind":{"vector_ms":[1.5]}', ''), '}}')""")
    docs = X.table(spark, sf_dir, "supplier").select("s_suppkey", text.alias("json"))
    return editor.settings(docs, keep=["s_suppkey"]).select("s_suppkey", F.col("low")[0].alias("low_x"), F.col("high")[2].alias("high_z"), "levels", F.col("wind")[0].alias("wind_x"), "temperature")


_WAY = "SELECT user_id, event_id, ts, 35.5 + x / 100000 AS lat, 139.7 + y / 100000 AS lon, CASE WHEN event_id % 2 = 0 THEN value END AS alt, CASE WHEN event_id % 5 = 0 THEN 3.0::DOUBLE ELSE 0 END AS sleep, row_number() OVER w AS n, count(*) OVER (PARTITION BY user_id) AS total FROM (SELECT event_id, user_id, ts, value, CAST(event_id * 37 % 440000 AS DOUBLE) / 100 AS x, CAST(event_id * 13 % 640000 AS DOUBLE) / 100.0::DOUBLE - 6400 AS y FROM events) WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)"


def _waypoints(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = X.points(spark, sf_dir)
    return p.select(F.col("user_id").alias("mission"), F.struct("ts", "event_id").alias("seq"), (F.lit(35.5) + F.col("x") / 100000).alias("lat"), (F.lit(139.7) + F.col("y") / 100000).alias("lon"), F.when(F.col("event_id") % 2 == 0, F.col("z")).alias("alt"), F.lit(None).cast("double").alias("speed"), F.lit(None).cast("double").alias("yaw_deg"), F.when(F.col("event_id") % 5 == 0, 3.0).alias("sleep_before"))


@query(f"""WITH p AS ({_WAY}),
s AS (SELECT user_id, n, 0 AS k, 'takeoff' AS command, coalesce(alt, 20) AS height, NULL::DOUBLE AS pause, NULL::DOUBLE AS z, NULL::DOUBLE AS speed FROM p WHERE n = 1
  UNION ALL SELECT user_id, n, 1, 'sleep', NULL, sleep, NULL, NULL FROM p WHERE sleep > 0
  UNION ALL SELECT user_id, n, 2, 'moveToPosition', NULL, NULL, coalesce(alt, 20), 10.0 FROM p
  UNION ALL SELECT user_id, n, 3, 'land', NULL, NULL, NULL, NULL FROM p WHERE n = total)
SELECT user_id AS mission, CAST(row_number() OVER (PARTITION BY user_id ORDER BY n, k) AS INTEGER) AS step, command, height, pause, z, speed FROM s""")
def mission_commands(spark, sf_dir):
    """Waypoints with defaults as commands, one document a mission, and read again."""
    out = scratch.folder(spark, "missions")
    mission.documents(mission.missions(_waypoints(spark, sf_dir), (35.5, 139.7))).write.text(out)
    back = spark.read.text(out).select(F.from_json("value", f"id long, mission array<{mission.COMMAND}>").alias("m")).select(F.col("m.id").alias("mission"), F.posexplode("m.mission").alias("at", "c"))
    return back.select("mission", (F.col("at") + 1).alias("step"), "c.command", "c.parameters.height", F.col("c.parameters.duration_sec").alias("pause"), "c.parameters.z", "c.parameters.speed")


@query(f"SELECT user_id AS mission, CAST(n AS INTEGER) AS place, round(lat, 9) AS lat, round(lon, 9) AS lon FROM ({_WAY}) UNION ALL SELECT DISTINCT user_id, 0, 35.5::DOUBLE, 139.7::DOUBLE FROM events")
def mission_lines(spark, sf_dir):
    """The line that a mission is drawn as: the origin, then its waypoints."""
    return mission.polyline(_waypoints(spark, sf_dir), (35.5, 139.7)).select("mission", "place", F.round("lat", 9).alias("lat"), F.round("lon", 9).alias("lon"))


@query(f"SELECT area_id AS label, area_id || printf(',%.3f,%.3f,%.8f,%.8f', (xmin + xmax) / 2, (ymin + ymax) / 2, 35.0::DOUBLE, xmin / 1000) AS line FROM ({X.CELLS})")
def printed_areas(spark, sf_dir):
    areas, _, _ = creator.build(spark, X.MODEL, with_zones=False)
    s = geometry.box_size(F.col("bounds"))
    return writers.csv_lines(areas.select(F.col("area_id").alias("label"), s["cx"].alias("cx"), s["cy"].alias("cy"), F.lit(35.0).alias("lat"), (F.col("bounds.min.x") / 1000).alias("lon")))


@query(f"""WITH e AS (SELECT user_id, max_by(event_id, (ts, event_id)) AS event_id FROM events GROUP BY user_id),
p AS (SELECT user_id, x, y, z FROM ({X.POINTS}) JOIN e USING (user_id, event_id))
SELECT user_id AS drone, area_id, CASE WHEN area_id IS NULL THEN 0.0::DOUBLE ELSE 20.0 END AS d_temp, CASE WHEN area_id IS NULL THEN 0.0::DOUBLE ELSE 4.0 END AS wx, area_id IS NOT NULL AS has_signal FROM p LEFT JOIN ({X.CELLS}) c ON x >= xmin AND x < xmax AND y >= ymin AND y < ymax AND z >= 0 AND z < 100""")
def streamed_disturbances(spark, sf_dir):
    """Poses as a stream of messages, some of which can't be read; what the vehicles feel goes to a table, batch by batch."""
    out = scratch.folder(spark, "stream")
    ts = F.date_format(F.col("ts").cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    rows = X.points(spark, sf_dir).select(F.to_json(F.struct(F.col("user_id").alias("drone"), ts.alias("ts"), "x", "y", "z")).alias("value"))
    rows.unionByName(spark.range(3).select(F.lit('{"drone": 1, "x": "no number"').alias("value"))).coalesce(1).write.text(f"{out}/in")
    stream = poses.messages(spark.readStream.schema("value string").format("text").load(f"{out}/in"))
    environment = creator.build(spark, X.MODEL, with_zones=False)
    log: list[str] = []
    calls = {"on_initialize": lambda: log.append("initialize"), "on_tick": lambda n: log.append("tick"), "on_stop": lambda: log.append("stop")}
    poses.finished(poses.run(stream, environment, lambda df, n: df.write.mode("overwrite").parquet(f"{out}/felt/batch={n}"), f"{out}/checkpoint", callbacks=calls), calls)
    if log != ["initialize", "tick", "stop"]:
        raise RuntimeError(f"callbacks came as {log}")
    d = spark.read.parquet(f"{out}/felt")
    return d.select("drone", "area_id", F.col("disturbance.d_temp").alias("d_temp"), F.col("disturbance.d_wind.x").alias("wx"), F.col("disturbance.d_user_custom").isNotNull().alias("has_signal"))


@query("""WITH l AS (SELECT CAST(o_orderkey AS VARCHAR) AS id, CAST(o_custkey AS VARCHAR) AS p FROM orders WHERE o_orderkey % 5 <> 0), c AS (SELECT CAST(c_custkey AS VARCHAR) AS id FROM customer WHERE c_custkey % 11 <> 0)
SELECT CAST(o_orderkey AS VARCHAR) AS area_id, l.p AS area_property_id, c.id IS NOT NULL AS has_property FROM orders LEFT JOIN l ON CAST(o_orderkey AS VARCHAR) = l.id LEFT JOIN c ON l.p = c.id WHERE o_orderkey % 7 <> 0""")
def link_lookup(spark, sf_dir):
    """From area to link to property, by name."""
    areas, links, props = _stand_ins(spark, sf_dir)
    props = props.withColumn("ord", F.col("id")).withColumn("properties", F.struct("id"))
    return search.property_of(areas, links, props).select("area_id", "area_property_id", F.col("properties").isNotNull().alias("has_property"))
