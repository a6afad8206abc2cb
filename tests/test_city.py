import math
import random

import pytest
from pyspark.sql import functions as F

from aerofield.functions import frames, geometry, wind
from aerofield.operators import city
from aerofield.sources import readers, writers

GML = """<core:CityModel xmlns:core="http://www.opengis.net/citygml/2.0" xmlns:bldg="http://www.opengis.net/citygml/building/2.0" xmlns:gml="http://www.opengis.net/gml">
<core:cityObjectMember><bldg:Building gml:id="b1"><bldg:lod1Solid><gml:Solid>
<gml:LinearRing><gml:posList>35.0 139.0 1 35.0 139.001 1 35.001 139.001 1 35.001 139.0 1 35.0 139.0 1</gml:posList></gml:LinearRing>
<gml:LinearRing><gml:posList>35.0 139.0 9 35.0 139.002 9 35.001 139.001 9</gml:posList></gml:LinearRing>
</gml:Solid></bldg:lod1Solid></bldg:Building></core:cityObjectMember>
<core:cityObjectMember><bldg:Building gml:id="flat"/></core:cityObjectMember></core:CityModel>"""


def test_from_files_to_simulator(spark, tmp_path):
    udx = tmp_path / "udx" / "bldg"
    udx.mkdir(parents=True)
    (udx / "53390000_bldg_6697_op.gml").write_text(GML)
    (udx / "53390000_bldg_6697_extra.xml").write_text("<x/>")
    (udx / "notes.gml").write_text("<x/>")
    paths = readers.gml_paths(spark, str(tmp_path))
    index = city.gml_index(paths)
    (row,) = index.collect()
    assert (row.mesh, row.kind) == ("53390000", "bldg_6697")
    files = paths.unionByName(readers.gml_paths(spark, str(tmp_path), "*.xml"))
    (pair,) = city.with_companions(index, files).collect()
    assert pair.companion.endswith("extra.xml")
    assert writers.copy_manifest(index, city.with_companions(index, files), f"file:{tmp_path}", "/out").count() == 2
    b = readers.buildings(spark, str(udx / "53390000_bldg_6697_op.gml"))
    assert [(r.id, len(r.pos_lists)) for r in b.collect()] == [("b1", 2)]
    b = b.select("id", "source_gml", F.flatten(F.transform("pos_lists", city.pos_list)).alias("points"))
    f = city.footprints(b, origin=(35.0, 139.0), ns_m=500, ew_m=500)
    (row,) = f.collect()
    assert (row.zmin, row.zmax, len(row.vertices)) == (1.0, 9.0, 4)
    assert city.footprints(b, origin=(36.0, 139.0), ns_m=500, ew_m=500).count() == 0
    records = city.box_records(f, threshold=1.2)
    (r,) = records.collect()
    assert r["mode"] == "obb" and r.area == pytest.approx(111 * 91, rel=0.02)
    g = city.geoms(city.grounded(city.with_heights(records, f.select("id", "zmin", "zmax", F.lit(None).cast("double").alias("height")))), collide="none")
    (x,) = city.geom_xml(g).collect()
    assert 'contype="0"' in x.xml and x.xml.startswith('<body name="body_b1"')
    writers.mjcf(city.geom_xml(g), str(tmp_path / "world"), floor=True)
    text = "\n".join(r.value for r in spark.read.text(str(tmp_path / "world")).collect())
    assert text.startswith("<mujoco") and "floor" in text and text.rstrip().endswith("</mujoco>")
    writers.json_document(records, str(tmp_path / "obb"), "results", ["id"], {"version": '"1"'}, drop=())
    one = next((tmp_path / "obb").glob("part-*"))
    assert readers.document(spark, str(one), "results array<struct<id: string, mode: string>>").first().results[0].mode == "obb"


def test_bad_pos_lists_raise(spark):
    df = spark.createDataFrame([("1 2 3 4",)], "t string")
    with pytest.raises(Exception, match="posList of 4"):
        df.select(city.pos_list(F.col("t"))).collect()


def turned(points, a):
    return [(x * math.cos(a) - y * math.sin(a), x * math.sin(a) + y * math.cos(a)) for x, y in points]


@pytest.mark.parametrize("seed", range(4))
def test_box_area_does_not_depend_on_rotation(spark, seed):
    rng = random.Random(seed)
    base = [(rng.uniform(0, 40), rng.uniform(0, 10)) for _ in range(rng.randint(3, 12))]
    rings = [(i, [{"x": x, "y": y} for x, y in turned(base, a)]) for i, a in enumerate((0, 0.3, 1.2, 2.9))]
    df = spark.createDataFrame(rings, f"id long, vertices {geometry.RING}").withColumn("hull", geometry.convex_hull("vertices"))
    rows = df.select("id", "vertices", geometry.min_area_box("hull").alias("b"), geometry.ring_area("hull").alias("a")).collect()
    assert max(r.b.area for r in rows) == pytest.approx(min(r.b.area for r in rows))
    for r in rows:
        assert r.b.sx >= r.b.sy and r.b.area == pytest.approx(4 * r.b.sx * r.b.sy) and r.a <= r.b.area + 1e-9 and -math.pi <= r.b.yaw < math.pi + 1e-12
        for p in r.vertices:
            dx, dy = p.x - r.b.cx, p.y - r.b.cy
            assert abs(dx * math.cos(r.b.yaw) + dy * math.sin(r.b.yaw)) <= r.b.sx + 1e-6 and abs(dy * math.cos(r.b.yaw) - dx * math.sin(r.b.yaw)) <= r.b.sy + 1e-6


def test_degenerate_rings(spark):
    rings = [(0, []), (1, [(1, 2)]), (2, [(0, 0), (3, 4)]), (3, [(0, 0), (1, 1), (2, 2)])]
    df = spark.createDataFrame([(i, [{"x": float(x), "y": float(y)} for x, y in r]) for i, r in rings], f"id long, vertices {geometry.RING}").withColumn("hull", geometry.convex_hull("vertices"))
    got = {r.id: (r.b and (r.b.sx, r.b.sy, r.b.area), r.a, r.m) for r in df.select("id", geometry.min_area_box("hull").alias("b"), geometry.ring_area("vertices").alias("a"), geometry.ring_mean("vertices").alias("m")).collect()}
    assert got[0] == (None, 0.0, None) and got[1][0] == (0.0, 0.0, 0.0) and got[2][0] == (2.5, 0.0, 0.0) and got[3][0][0] == pytest.approx(math.sqrt(2))


def test_walls_replace_wasteful_boxes_and_fall_back(spark):
    ell = [(0, 0), (10, 0), (10, 1), (1, 1), (1, 10), (0, 10)]
    tiny = [(0, 0), (1e-4, 0), (0, 1e-4)]
    ring = lambda p: [{"x": float(x), "y": float(y)} for x, y in p]
    df = spark.createDataFrame([("ell", ring(ell)), ("box", ring([(0, 0), (4, 0), (4, 2), (0, 2)])), ("tiny", ring(tiny))], f"id string, vertices {geometry.RING}").withColumns({"zmin": F.lit(0.0), "zmax": F.lit(3.0), "source_gml": F.lit(None).cast("string")})
    rows = city.box_records(df, threshold=1.5).collect()
    assert sorted(r.id for r in rows) == ["box"] + [f"ell_edge{i}" for i in range(6)] + ["tiny"]
    assert {r["mode"] for r in rows if r.parent_id == "ell"} == {"wall"}
    assert city.box_records(df).where("mode = 'wall'").count() == 0
    merged = city.with_heights(city.box_records(df, threshold=1.5), spark.createDataFrame([("ell", 5.0, 6.0, None)], "id string, zmin double, zmax double, height double"), on="parent_id")
    assert {r.zmin for r in merged.where("parent_id = 'ell'").collect()} == {5.0}


def test_projections_round_trip(spark):
    df = spark.createDataFrame([(139.9, 36.1), (139.2, 35.3), (140.5, 34.9)], "lon double, lat double")
    for p in (frames.WebMercator(), frames.TransverseMercator()):
        x, y = p.forward(F.col("lon"), F.col("lat"))
        for r in df.select("lon", "lat", x.alias("x"), y.alias("y")).select("lon", "lat", *(c.alias(n) for c, n in zip(p.inverse(F.col("x"), F.col("y")), ("lon2", "lat2"), strict=True))).collect():
            assert (r.lon2, r.lat2) == pytest.approx((r.lon, r.lat), abs=1e-9)
    x, y = frames.TransverseMercator().forward(F.lit(frames.TM_LON0), F.lit(37.0))
    r = df.select(x.alias("x"), y.alias("y")).first()
    assert abs(r.x) < 1e-6 and r.y == pytest.approx(110964.9 * 0.9999, rel=1e-4)


def test_equidistant_distances(spark):
    """A degree along the equator, and a quarter meridian (known lengths)."""
    df = spark.createDataFrame([(1.0, 0.0), (0.0, 90.0)], "lon double, lat double")
    a, b = (r.p for r in df.select(frames.azimuthal_equidistant(0.0, 0.0)(F.col("lon"), F.col("lat")).alias("p")).collect())
    assert (a.x, abs(a.y)) == pytest.approx((111319.491, 0), abs=1e-2) and math.hypot(b.x, b.y) == pytest.approx(10001965.729, abs=1e-2)


def test_mesh_codes(spark):
    df = spark.createDataFrame([("533935",), (" 53393599 ",), ("5339359",), ("53a93599",), (None,)], "m string")
    got = [r.b for r in df.select(frames.mesh_box(F.col("m")).alias("b")).collect()]
    assert (got[0].min_lat, got[0].min_lon) == pytest.approx((53 * 2 / 3 + 3 / 12, 139 + 5 / 8)) and got[0].max_lat - got[0].min_lat == pytest.approx(1 / 12)
    assert (got[1].max_lat, got[1].max_lon) == pytest.approx((got[0].max_lat, got[0].max_lon))
    assert got[2] is got[3] is got[4] is None
    assert df.select(frames.mesh_box(F.col("m"), strict=True).alias("b")).first().b is None


def test_numbers(spark):
    df = spark.createDataFrame([(100.0,), (10.5,), (0.0,), (None,), (-0.25,)], "x double")
    assert [r[0] for r in df.select(wind.compact(F.col("x"))).collect()] == ["100", "10.5", "0", None, "-0.25"]
    c = spark.range(1).select(wind.search_cost(F.lit(704), F.lit(7)).alias("a"), wind.search_cost(F.lit(704), F.lit(8)).alias("b"), wind.search_cost(F.lit(0), F.lit(8)).alias("c")).first()
    assert (tuple(c.a), tuple(c.b), tuple(c.c)) == ((2.552, 9.365), (2.27, 10.365), (0.0, 0.0))
