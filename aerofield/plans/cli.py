"""Command lines.

python -m aerofield.plans.cli create MODEL OUT [--no-zones] [--lenient]
python -m aerofield.plans.cli city GML_FOLDER OUT LAT LON NS_M EW_M [--threshold 1.5]
python -m aerofield.plans.cli check FOLDER
python -m aerofield.plans.cli view CONFIG OUT [--mode temperature]
python -m aerofield.plans.cli feel ROBOTS FOLDER MESSAGES OUT [--delta-ms 20]
python -m aerofield.plans.cli find FOLDER X Y Z
python -m aerofield.plans.cli index FOLDER [--depth 7]
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import frames
from ..functions.frames import box_around
from ..functions.wind import compact
from ..operators import city, creator, drawing, search, tree
from ..sources import readers, writers
from ..streaming import poses


def create(spark: SparkSession, infile: str, outdir: str, zones: bool = True, lenient: bool = False) -> None:
    """A model's area, property and link tables, as Parquet and as the documents that other tools read."""
    areas, properties, links = creator.build(spark, readers.model(spark, infile), zones, lenient)
    writers.tables({"area": areas, "property": properties, "link": links}, f"{outdir}/tables")
    writers.json_document(areas, f"{outdir}/area", "space_areas", ["ord"])
    writers.json_document(properties, f"{outdir}/property", "area_properties", ["ord"])
    writers.json_document(links, f"{outdir}/link", "links", ["ord"])


def city_models(spark: SparkSession, folder: str, outdir: str, lat: float, lon: float, ns_m: float, ew_m: float, threshold: float | None = None) -> None:
    """From city files to footprints, boxes or walls, and a simulator's world; files are chosen by mesh before they are read."""
    index = city.gml_index(readers.gml_paths(spark, folder))
    box = box_around(F.lit(lat), F.lit(lon), F.lit(ns_m), F.lit(ew_m))
    chosen = [r.path for r in city.in_query_box(index.where("kind like 'bldg%'"), box).select("path").collect()]  # file names
    if not chosen:
        raise FileNotFoundError(f"no building file below {folder} touches the box")
    points = F.flatten(F.transform("pos_lists", city.pos_list))
    buildings = readers.buildings(spark, chosen).select("id", "source_gml", points.alias("points"))
    footprints = city.footprints(buildings, (lat, lon), ns_m, ew_m)
    records = city.grounded(city.box_records(footprints, threshold).withColumn("height", F.lit(None).cast("double")))
    writers.tables({"footprints": footprints, "records": records}, f"{outdir}/tables")
    writers.json_document(records, f"{outdir}/obb", "results", ["id"], drop=())
    writers.mjcf(city.geom_xml(city.geoms(records)), f"{outdir}/world")


def tell(problems: DataFrame) -> None:
    """Print every problem, a line each, without holding all of them."""
    for r in problems.orderBy("problem", "id").toLocalIterator():
        print(f"{r.problem}\t{r.id}")


def view(spark: SparkSession, config: str, outdir: str, mode: str | None = None) -> None:
    """What a map shows, as tables: painted areas, wind arrows, limits, markers and printed positions.

    Areas are in the robots' frame, as their files have them; the map has east and north.
    """
    c = readers.view_config(spark, config, **({"mode": mode} if mode else {}))
    v = search.visual_areas(readers.areas(spark, c.area), readers.links(spark, c.link), readers.properties(spark, c.property))
    b, w = F.col("bounds"), F.col("properties.wind_velocity")
    box = frames.ros_box_to_map(b["min"]["x"], b["min"]["y"], b["max"]["x"], b["max"]["y"])
    wind = frames.ros_to_enu(w[0], w[1], w[2])
    areas = v.select("area_id", box.alias("m"), wind.alias("v"), "properties.temperature", F.col("properties.gps_strength").alias("gps")).select("area_id", "m.*", F.col("v.x").alias("vx"), F.col("v.y").alias("vy"), F.col("v.z").alias("vz"), "temperature", "gps")
    found = {"painted": drawing.painted(areas, c.mode).withColumn("alpha", drawing.weakness_alpha(F.col("gps"))), "arrows": drawing.arrows(areas, c.wind_scale), "scene": drawing.scene(areas)}
    cx, cy = (b["min"]["x"] + b["max"]["x"]) / 2, (b["min"]["y"] + b["max"]["y"]) / 2
    lon, lat = frames.enu_to_lonlat(cx, cy, c.origin_lat, c.origin_lon, c.offset_x, c.offset_y)
    if c.print_latlon:
        label = F.format_string("x%s_y%s", compact(cx), compact(cy))
        found["printed"] = writers.csv_lines(v.select(label.alias("label"), cx.alias("cx"), cy.alias("cy"), lat.alias("lat"), lon.alias("lon")))
    if c.print_shifted_origin:
        x, y = frames.enu_to_lonlat(F.lit(0.0), F.lit(0.0), c.origin_lat, c.origin_lon, c.offset_x, c.offset_y)
        found["origin"] = spark.range(1).select(y.alias("lat"), x.alias("lon"))
    if c.markers:
        m = spark.createDataFrame([(k["lat"], k["lon"], k.get("label")) for k in c.markers], "lat double, lon double, label string")
        x, y = frames.lonlat_to_enu(F.col("lon"), F.col("lat"), c.origin_lat, c.origin_lon, c.offset_x, c.offset_y)
        found["markers"] = m.withColumns({"x": x, "y": y})
    writers.tables(found, outdir)


def feel(spark: SparkSession, robots: str, folder: str, messages: str, outdir: str, delta_ms: int | None = None) -> None:
    """What the robots of a configuration feel: poses, as files of messages, against an environment; a table grows batch by batch.

    Robots are numbered as listed; those without a pose or disturbance channel are left out.  With
    ``delta_ms`` a batch starts so often and the command goes on; without it all messages that are there are taken.
    """
    ok = readers.robots(spark, robots).where("has_pose and has_disturbance").select(F.col("ord").cast("long").alias("drone"), "name")
    stream = poses.messages(spark.readStream.schema("value string").format("text").load(messages)).join(F.broadcast(ok), "drone")  # a robot each
    q = poses.run(stream, readers.environment(spark, folder), lambda df, n: df.write.mode("overwrite").parquet(f"{outdir}/felt/batch={n}"), f"{outdir}/checkpoint", f"{delta_ms} milliseconds" if delta_ms else None)
    poses.finished(q)


def find(spark: SparkSession, folder: str, x: float, y: float, z: float) -> None:
    """Print what holds at a point."""
    areas, properties, links = readers.environment(spark, folder)
    p = spark.createDataFrame([(1, x, y, z)], "id long, x double, y double, z double")
    print(search.explained(p, areas, links, properties, ["id"]).first().text)


def index(spark: SparkSession, folder: str, depth: int) -> None:
    """Print what a folder's areas make for a tree."""
    areas, _, _ = readers.environment(spark, folder)
    s = tree.tree_stats(tree.tree_nodes(areas, depth)).first()
    print(f"depth {s.max_depth}, leaves {s.leaves}, areas a leaf {s.average_leaf}")


def check(spark: SparkSession, folder: str) -> None:
    """Print what is wrong with a folder's tables."""
    areas, properties, links = readers.environment(spark, folder)
    tell(search.integrity(areas, links, properties))
    for df, key, checks in ((areas, "area_id", readers.area_checks()), (properties, "id", readers.property_checks()), (links, "area_id", readers.link_checks())):
        tell(readers.violations(df, key, checks))


def main(args: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="aerofield")
    sub = parser.add_subparsers(dest="command", required=True)
    c = sub.add_parser("create")
    c.add_argument("infile")
    c.add_argument("outdir")
    c.add_argument("--no-zones", action="store_true")
    c.add_argument("--lenient", action="store_true")
    m = sub.add_parser("city")
    m.add_argument("folder")
    m.add_argument("outdir")
    for name in ("lat", "lon", "ns_m", "ew_m"):
        m.add_argument(name, type=float)
    m.add_argument("--threshold", type=float)
    k = sub.add_parser("check")
    k.add_argument("folder")
    v = sub.add_parser("view")
    v.add_argument("config")
    v.add_argument("outdir")
    v.add_argument("--mode")
    e = sub.add_parser("feel")
    for name in ("robots", "folder", "messages", "outdir"):
        e.add_argument(name)
    e.add_argument("--delta-ms", type=int)
    f = sub.add_parser("find")
    f.add_argument("folder")
    for name in "xyz":
        f.add_argument(name, type=float)
    t = sub.add_parser("index")
    t.add_argument("folder")
    t.add_argument("--depth", type=int, default=7)
    a = parser.parse_args(args)
    spark = SparkSession.builder.appName("aerofield").getOrCreate()
    if a.command == "create":
        create(spark, a.infile, a.outdir, not a.no_zones, a.lenient)
    elif a.command == "city":
        city_models(spark, a.folder, a.outdir, a.lat, a.lon, a.ns_m, a.ew_m, a.threshold)
    elif a.command == "view":
        view(spark, a.config, a.outdir, a.mode)
    elif a.command == "feel":
        feel(spark, a.robots, a.folder, a.messages, a.outdir, a.delta_ms)
    elif a.command == "find":
        find(spark, a.folder, a.x, a.y, a.z)
    elif a.command == "index":
        index(spark, a.folder, a.depth)
    else:
        check(spark, a.folder)


if __name__ == "__main__":
    main()
