"""Environment, city and mission files as DataFrames, with explicit schemas."""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import items

POINT = "struct<x: double, y: double, z: double>"
BOUNDS = f"struct<min: {POINT}, max: {POINT}>"
PROPERTIES = "struct<wind_velocity: array<double>, temperature: double, sea_level_atm: double, gps_strength: double>"
RECORD = "id string, parent_id string, center array<double>, half_size array<double>, yaw_rad double, yaw_deg double, rect_corners array<array<double>>, area double, mode string, edge_index int, waste_ratio double, zmin double, zmax double, height double, source_gml string"


def document(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A multi-line JSON document as one row; missing fields are null."""
    return spark.read.schema(schema).option("multiLine", True).option("mode", "PERMISSIVE").json(path)


def model(spark: SparkSession, path: str) -> dict:
    """A creator model, as authored; it is small and steers the plan, so it lives on the driver."""
    return json.loads(spark.read.text(path, wholetext=True).first()[0])


def _items(df: DataFrame, column: str) -> DataFrame:
    return df.select(F.posexplode(F.coalesce(column, F.array().cast(df.schema[column].dataType))).alias("ord", "item")).select("ord", "item.*")


def listed(spark: SparkSession, path: str, names: tuple[str, ...], fields: str, required: bool = False) -> DataFrame:
    """(ord, fields) of the items of a document's list, the first of ``names`` that it has; a file that is no JSON raises."""
    found = items.of_files(spark, path, names, required)
    return found.select("ord", F.from_json("item", f"struct<{fields}>").alias("item")).select("ord", "item.*")


def areas(spark: SparkSession, path: str) -> DataFrame:
    return listed(spark, path, ("space_areas",), f"area_id: string, bounds: {BOUNDS}")


def properties(spark: SparkSession, path: str) -> DataFrame:
    """(ord, id, properties), with a signal strength of 1 where none is given."""
    df = listed(spark, path, ("area_properties",), f"id: string, properties: {PROPERTIES}")
    return df.withColumn("properties", F.col("properties").withField("gps_strength", F.coalesce("properties.gps_strength", F.lit(1.0))))


def links(spark: SparkSession, path: str) -> DataFrame:
    return listed(spark, path, ("links",), "area_id: string, area_property_id: string")


def any_areas(spark: SparkSession, path: str) -> DataFrame:
    """Areas of loosely written documents.

    The list may stand under space_areas, areas or by itself; bounds under bounds, aabb or by
    themselves; corners as objects or lists.  area_id is the given one or the ordinal.
    """
    v = spark.read.text(path, wholetext=True).select(F.parse_json("value").alias("v"))
    listed = F.coalesce(*(F.try_variant_get("v", p, "array<variant>") for p in ("$.space_areas", "$.areas", "$")))
    df = v.select(F.posexplode(listed).alias("ord", "a"))
    number = lambda *paths: F.coalesce(*(F.try_variant_get("a", p, "double") for p in paths))
    axis = lambda end, name, i: number(*(f"{root}.{end}{tail}" for root in ("$.bounds", "$.aabb", "$") for tail in (f".{name}", f"[{i}]")))
    corner = lambda end: F.struct(*(axis(end, n, i).alias(n) for i, n in enumerate("xyz"))).alias(end)
    return df.select("ord", F.coalesce(F.try_variant_get("a", "$.area_id", "string"), F.col("ord").cast("string")).alias("area_id"), F.struct(corner("min"), corner("max")).alias("bounds"))


def resolved(spark: SparkSession, folder: str) -> dict[str, str]:
    """Paths of a folder's area, link and property files, under either of their names."""
    jvm = spark.sparkContext._jvm
    found = {}
    for kind, names in {"area": ("area.json",), "link": ("link.json", "area_link.json"), "property": ("property.json", "area_property.json")}.items():
        for name in names:
            p = jvm.org.apache.hadoop.fs.Path(f"{folder.rstrip('/')}/{name}")
            if p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p):
                found[kind] = str(p)
                break
        else:
            raise FileNotFoundError(f"{folder} has none of {', '.join(names)}")
    return found


def environment(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The area, property and link tables of a folder."""
    p = resolved(spark, folder)
    return areas(spark, p["area"]), properties(spark, p["property"]), links(spark, p["link"])


def robots(spark: SparkSession, path: str) -> DataFrame:
    """(ord, name, has_pose, has_disturbance) of the named robots of a configuration."""
    channel = "array<struct<org_name: string>>"
    df = _items(document(spark, path, f"robots array<struct<name: string, shm_pdu_readers: {channel}, shm_pdu_writers: {channel}>>"), "robots")
    return robot_channels(df)


def robot_channels(df: DataFrame, pose: str = "pos", disturb: str = "disturb") -> DataFrame:
    has = lambda c, name: F.coalesce(F.exists(c, lambda r: r["org_name"] == name), F.lit(False))
    return df.where("name is not null and name <> ''").select("ord", "name", has("shm_pdu_readers", pose).alias("has_pose"), has("shm_pdu_writers", disturb).alias("has_disturbance"))


def records(spark: SparkSession, path: str) -> DataFrame:
    """Box records under results, or polygons where there are none; an empty document raises."""
    return listed(spark, path, ("results", "polygons"), RECORD.replace(" ", ": ").replace(",: ", ", "), required=True)


def polygons(spark: SparkSession, path: str) -> DataFrame:
    df = listed(spark, path, ("polygons",), "id: string, vertices: array<array<double>>, zmin: double, zmax: double, height: double, source_gml: string")
    return df.withColumn("vertices", F.transform("vertices", lambda v: F.struct(v[0].alias("x"), v[1].alias("y"))))


def city_header(spark: SparkSession, path: str) -> DataFrame:
    """One row (version, crs, coordinate_system, origin, bounds) of a polygon or box document."""
    return document(spark, path, "version string, crs string, coordinate_system string, origin struct<lat: double, lon: double, x: double, y: double>, bounds struct<ns_m: double, ew_m: double>")


def query_meta(spark: SparkSession, path: str) -> DataFrame:
    """One row, null where incomplete or unreadable."""
    df = document(spark, path, "center_lat double, center_lon double, ns_m double, ew_m double, bbox struct<min_lat: double, max_lat: double, min_lon: double, max_lon: double>")
    return df.where("center_lat is not null and center_lon is not null")


def gml_paths(spark: SparkSession, folder: str, pattern: str = "*.gml") -> DataFrame:
    """Paths of files below a folder, sorted; contents are not read."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(folder).select("path").orderBy("path")


def buildings(spark: SparkSession, path: str | list[str], lenient: bool = False) -> DataFrame:
    """(id, pos_lists, source_gml) of the buildings of city files that have level-1 rings, at any depth inside.

    One row per building element is split off by Spark's XML source rules, which keep to
    direct children; rings may lie anywhere below, so each file is walked once in Arrow batches.  A file that is
    not well-formed raises, or, if ``lenient``, gives a row with null id and rings.
    """
    import xml.etree.ElementTree as ET
    from collections.abc import Iterator

    import pyarrow as pa

    # fixed values: XML namespaces of city models
    gml, bldg = "http://www.opengis.net/gml", "building"

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids, lists = [], []
                try:
                    root = ET.fromstring(content)
                except ET.ParseError as e:
                    if not lenient:
                        raise ValueError(f"{path}: {e}") from e
                    yield pa.RecordBatch.from_arrays([pa.nulls(1, pa.string()), pa.nulls(1, pa.list_(pa.string())), pa.array([path])], names=["id", "pos_lists", "source_gml"])
                    continue
                for b in root.iter():
                    space, _, tag = b.tag.rpartition("}")
                    if tag != "Building" or bldg not in space:
                        continue
                    rings = [p.text or "" for s in b.iter(f"{space}}}lod1Solid") for r in s.iter(f"{{{gml}}}LinearRing") for p in r.iter(f"{{{gml}}}posList")]
                    if rings:
                        ids.append(b.get(f"{{{gml}}}id") or b.findtext(f"{{{gml}}}name") or f"bldg_{len(ids) + 1}")
                        lists.append(rings)
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.string()), pa.array(lists, pa.list_(pa.string())), pa.array([path] * len(ids), pa.string())], names=["id", "pos_lists", "source_gml"])

    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.gml").load(path)
    return files.select("path", "content").mapInArrow(walk, "id string, pos_lists array<string>, source_gml string")


def mission(spark: SparkSession, path: str) -> DataFrame:
    """(mission, step, command, parameters) of a mission file."""
    from ..operators.mission import COMMAND

    df = document(spark, path, f"mission array<{COMMAND}>").select(F.posexplode("mission").alias("step", "c"))
    return df.select(F.lit(path).alias("mission"), "step", "c.*")


@dataclass(frozen=True)
class ViewConfig:
    """Settings of a map view; unknown keys raise."""

    area: str
    property: str
    link: str
    overlay_map: bool = False
    origin_lat: float = 0.0
    origin_lon: float = 0.0
    offset_x: float = 0.0
    offset_y: float = 0.0
    mode: str = "gps"
    wind_scale: float = 1.0
    tiles: str = "OpenStreetMap.Mapnik"
    zoom: int | None = None
    markers: list = field(default_factory=list)
    print_latlon: bool = False
    print_shifted_origin: bool = False


def view_config(spark: SparkSession, path: str, **overrides) -> ViewConfig:
    return ViewConfig(**model(spark, path) | overrides)


# ---- checks in place of a JSON schema ----


def violations(df: DataFrame, key: str, checks: dict[str, Column]) -> DataFrame:
    """(id, problem) of rows that fail a check; a null outcome fails."""
    bad = F.array(*(F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in checks.items()))
    # in two steps: Spark's optimizer loses columns where a generator itself reads fields of a struct
    return df.select(F.col(key).alias("id"), F.filter(bad, lambda b: b.isNotNull()).alias("problems")).select("id", F.explode("problems").alias("problem"))


def checked(df: DataFrame, checks: dict[str, Column]) -> DataFrame:
    """``df``, raising on the first row that fails a check."""
    for name, ok in checks.items():
        df = df.where(F.assert_true(F.coalesce(ok, F.lit(False)), name).isNull())
    return df


_AREA = {"area_id": "area_id <> ''", "bounds": "bounds.min.x <= bounds.max.x and bounds.min.y <= bounds.max.y and bounds.min.z <= bounds.max.z"}
_PROPERTY = {"id": "id <> ''", "wind_velocity": "size(properties.wind_velocity) = 3", "temperature": "properties.temperature is not null", "sea_level_atm": "properties.sea_level_atm is not null", "gps_strength": "properties.gps_strength between 0 and 1"}
_LINK = {"area_id": "area_id <> ''", "area_property_id": "area_property_id <> ''"}


def repeated_links(df: DataFrame) -> DataFrame:
    """(area_id, area_property_id, times) of links that are listed more than once."""
    return df.groupBy("area_id", "area_property_id").agg(F.count("*").alias("times")).where("times > 1")


#: What a model must have, and a zone of each mode; a boundary's fields.
_MODEL = {"grid": "size(grid.cell_m) >= 2 and (grid.extent_m is not null or grid.max is not null)", "wind": "size(base.wind.vector_ms) = 3 or (base.wind.dir_deg is not null and base.wind.speed_ms is not null)", "gps_strength": "coalesce(base.gps_strength, 1) between 0 and 1", "axis": "coalesce(meta.axis, 'ENU') in ('ENU', 'NED', 'ROS')"}
_ZONE = {
    "name": "zone.name <> ''",
    "shape": "(zone.shape.circle.radius_m > 0 and size(zone.shape.circle.center_m) = 2) or (zone.shape.rect.min_m is not null and (zone.shape.rect.max_m is not null or zone.shape.rect.size_m is not null)) or (zone.shape.rect.center_m is not null and zone.shape.rect.size_m is not null)",
    "mode": "zone.effect.mode in ('absolute', 'scale', 'add', 'vortex', 'turbulence')",
    "effect": "case zone.effect.mode when 'absolute' then size(zone.effect.wind_ms) = 3 when 'scale' then zone.effect.scale is not null when 'vortex' then zone.effect.vortex.gain is not null when 'turbulence' then zone.effect.turbulence.std_ms is not null else true end",
    "gps_abs": "coalesce(zone.effect.gps_abs, 0) between 0 and 1",
}
_BOUNDARY = {"name": "name <> ''", "position": "size(position) = 3", "size": "size(size) between 2 and 3", "rotation": "size(rotation) = 3"}


def model_checks() -> dict[str, Column]:
    """For rows (grid, base, meta) of `models`."""
    return {k: F.expr(v) for k, v in _MODEL.items()}


def zone_checks() -> dict[str, Column]:
    """For rows with a ``zone`` as the zone editor imports them."""
    return {k: F.expr(v) for k, v in _ZONE.items()}


def boundary_checks() -> dict[str, Column]:
    """For rows (name, position, size, rotation)."""
    return {k: F.expr(v) for k, v in _BOUNDARY.items()}


def models(documents: DataFrame) -> DataFrame:
    """``documents`` (with ``json``) with what a whole model has beside its zones: grid, base and meta."""
    number = "array<double>"
    kind = f"grid struct<min: {number}, max: {number}, extent_m: {number}, cell_m: {number}, levels: int>, base struct<wind: struct<vector_ms: {number}, dir_deg: double, speed_ms: double>, temperature_C: double, pressure_atm: double, gps_strength: double>, meta struct<crs: string, axis: string, origin_latlon: {number}>"
    return documents.withColumn("_m", F.from_json("json", kind)).select("*", "_m.grid", "_m.base", "_m.meta").drop("_m")


def area_checks() -> dict[str, Column]:
    return {k: F.expr(v) for k, v in _AREA.items()}


def property_checks() -> dict[str, Column]:
    return {k: F.expr(v) for k, v in _PROPERTY.items()}


def link_checks() -> dict[str, Column]:
    return {k: F.expr(v) for k, v in _LINK.items()}
