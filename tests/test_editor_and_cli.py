import json

import pytest
from pyspark.sql import functions as F

from aerofield.operators import editor
from aerofield.plans import cli
from aerofield.sources import readers

from .test_city import GML
from .test_creator import HARBOUR


def test_zone_documents_round_trip(spark):
    zones = HARBOUR["zones"] + [{"name": "v", "priority": 4, "shape": {"circle": {"center_m": [1, 2], "radius_m": 3}}, "effect": {"mode": "vortex", "vortex": {"center_m": [1, 2], "gain": 5, "decay": "gaussian"}, "gps_add": -0.1}, "active": {"t_from_s": 1, "t_to_s": 2}}]
    df = editor.imported(spark.createDataFrame([(json.dumps({"zones": zones}),)], "json string"))
    back = [json.loads(r.json) for r in editor.exported(df.orderBy("ord")).collect()]
    assert back == json.loads(json.dumps(zones))


def test_editor_wind_round_trip(spark):
    df = spark.createDataFrame([(0.0, 225.0), (3.0, 0.0), (5.5, 90.0), (2.0, 315.0)], "s double, d double")
    for ros in (True, False):
        back = editor.wind_to_editor(editor.wind_from_editor(F.col("s"), F.col("d"), ros), ros)
        for r in df.select("s", "d", back.alias("b")).collect():
            assert r.b.speed == r.s and (r.s == 0 or r.b.direction % 360 == r.d)
    north = df.select(editor.wind_from_editor(F.lit(2.0), F.lit(180.0)).alias("w")).first().w
    assert north == pytest.approx([2.0, 0.0, 0.0])


def test_create(spark, tmp_path):
    (tmp_path / "m.json").write_text(json.dumps(HARBOUR))
    cli.main(["create", str(tmp_path / "m.json"), str(tmp_path / "out")])
    assert spark.read.parquet(str(tmp_path / "out/tables/area")).count() == 704
    part = next((tmp_path / "out/property").glob("part-*"))
    assert readers.properties(spark, str(part)).where("properties.gps_strength = 0.6").count() == 98
    cli.main(["create", str(tmp_path / "m.json"), str(tmp_path / "bare"), "--no-zones"])
    assert spark.read.parquet(str(tmp_path / "bare/tables/property")).where("properties.gps_strength < 1").count() == 0


def test_city(spark, tmp_path):
    udx = tmp_path / "in" / "udx" / "bldg"
    udx.mkdir(parents=True)
    (udx / "52390000_bldg_6697_op.gml").write_text(GML)  # its mesh holds the query's centre
    (udx / "99990000_bldg_6697_op.gml").write_text("not even xml")  # far away: never read
    cli.main(["city", str(tmp_path / "in"), str(tmp_path / "out"), "34.6700", "139.0", "60000", "60000"])
    assert spark.read.parquet(str(tmp_path / "out/tables/records")).count() == 1
    with pytest.raises(FileNotFoundError):
        cli.main(["city", str(tmp_path / "in"), str(tmp_path / "none"), "10", "10", "100", "100"])


def test_check(spark, tmp_path, capsys):
    (tmp_path / "area.json").write_text(json.dumps({"space_areas": [{"area_id": "a", "bounds": {"min": {"x": 0, "y": 0, "z": 0}, "max": {"x": 1, "y": 1, "z": 1}}}]}))
    (tmp_path / "link.json").write_text(json.dumps({"links": []}))
    (tmp_path / "property.json").write_text(json.dumps({"area_properties": []}))
    cli.main(["check", str(tmp_path)])
    assert "areas_without_link" in capsys.readouterr().out


def room(folder):
    """Two areas in the robots' frame, one without a property."""
    box = lambda x: {"min": {"x": x, "y": -2, "z": 0}, "max": {"x": x + 2, "y": 2, "z": 3}}
    (folder / "area.json").write_text(json.dumps({"space_areas": [{"area_id": "a", "bounds": box(0)}, {"area_id": "b", "bounds": box(2)}]}))
    (folder / "link.json").write_text(json.dumps({"links": [{"area_id": "a", "area_property_id": "p"}, {"area_id": "b", "area_property_id": "q"}]}))
    p = {"wind_velocity": [3.0, 0.0, 0.0], "temperature": 12.5, "sea_level_atm": 1.0, "gps_strength": 0.75}
    (folder / "property.json").write_text(json.dumps({"area_properties": [{"id": "p", "properties": p}]}))


def test_view(spark, tmp_path):
    room(tmp_path)
    config = {k: str(tmp_path / f"{k}.json") for k in ("area", "property", "link")}
    config |= {"origin_lat": 35.0, "origin_lon": 139.0, "print_latlon": True, "print_shifted_origin": True, "markers": [{"lat": 35.0, "lon": 139.0, "label": "here"}]}
    (tmp_path / "view.json").write_text(json.dumps(config))
    cli.main(["view", str(tmp_path / "view.json"), str(tmp_path / "out"), "--mode", "temperature"])
    table = lambda name: spark.read.parquet(str(tmp_path / "out" / name)).collect()
    (p,) = table("painted")
    assert (p.area_id, p.xmin, p.xmax, p.ymin, p.ymax, p.alpha) == ("a", -2, 2, 0, 2, 0.25)
    (a,) = table("arrows")
    assert (a.vx, a.vy) == (0, 3) and a.ax == pytest.approx(0) and a.ay > 0
    (m,) = table("markers")
    assert (m.x, m.y, m.label) == (pytest.approx(0), pytest.approx(0), "here")
    assert table("printed")[0].line.startswith("x1_y0,1.000,0.000,35.") and len(table("origin")) == 1


def test_feel(spark, tmp_path):
    room(tmp_path)
    channel = lambda name: [{"org_name": name}]
    robots = [{"name": "mute", "shm_pdu_readers": channel("pos")}, {"name": "one", "shm_pdu_readers": channel("pos"), "shm_pdu_writers": channel("disturb")}, {"name": "two", "shm_pdu_readers": channel("pos"), "shm_pdu_writers": channel("disturb")}]
    (tmp_path / "robots.json").write_text(json.dumps({"robots": robots}))
    inbox = tmp_path / "in"
    inbox.mkdir()
    pose = lambda d, s, x: json.dumps({"drone": d, "ts": f"2024-01-01T00:00:0{s}", "x": x, "y": 0, "z": 1})
    (inbox / "m.txt").write_text("\n".join([pose(0, 1, 1.0), pose(1, 1, 9.0), pose(1, 2, 1.0), "no message", pose(2, 1, 3.0), pose(5, 1, 1.0)]))
    cli.main(["feel", str(tmp_path / "robots.json"), str(tmp_path), str(inbox), str(tmp_path / "out")])
    got = {r.drone: r for r in spark.read.parquet(str(tmp_path / "out/felt")).collect()}
    assert set(got) == {1, 2} and got[1].area_id == "a" and got[1].disturbance.d_temp == 12.5 and got[1].disturbance.d_wind.x == 3.0
    assert got[2].area_id == "b" and got[2].disturbance.d_temp == 0.0 and got[2].disturbance.d_user_custom is None


def test_find_and_index(spark, tmp_path, capsys):
    room(tmp_path)
    cli.main(["find", str(tmp_path), "1", "0", "1"])
    cli.main(["index", str(tmp_path), "--depth", "3"])
    out = capsys.readouterr().out
    assert "primary: a" in out and "property: p" in out and "depth 1, leaves 2, areas a leaf 1.0" in out


def test_bad_city_files(spark, tmp_path):
    (tmp_path / "good.gml").write_text(GML)
    (tmp_path / "bad.gml").write_text("not even xml")
    got = readers.buildings(spark, str(tmp_path), lenient=True).collect()
    assert sum(r.id is None and r.source_gml.endswith("bad.gml") for r in got) == 1 and any(r.id for r in got)
    with pytest.raises(Exception, match="bad.gml"):
        readers.buildings(spark, str(tmp_path)).collect()


def test_projections_by_code():
    from aerofield.functions import frames

    assert isinstance(frames.projection("epsg:3857"), frames.WebMercator) and isinstance(frames.projection("6677"), frames.TransverseMercator)
    with pytest.raises(ValueError, match="EPSG:9999"):
        frames.projection("EPSG:9999")


def test_rectangles_by_side_turn_with_the_axis(spark):
    model = {"meta": {"axis": "ros"}, "zones": [{"name": "z", "shape": {"rect": {"min_m": [1, 2], "size_m": [3, 5]}}, "effect": {"mode": "add", "add_ms": [1, 0, 4]}}]}
    (z,) = (r.zone for r in editor.imported(spark.createDataFrame([(json.dumps(model),)], "json string"), to_enu=True).collect())
    # x from 1 to 4 north, y from 2 to 7 west
    assert (z.shape.rect.min_m, z.shape.rect.size_m, z.effect.add_ms) == ([-7.0, 1.0], [5.0, 3.0], [0.0, 1.0, 4.0])


def test_models_of_any_length_come_in_from_files(spark, tmp_path):
    """Each file has its own axis, before or after its zones; no file is held as one value."""
    from aerofield.sources import writers

    z = lambda i: json.dumps({"name": f"z{i}", "effect": {"mode": "absolute", "wind_ms": [1.0, float(i), 0.0]}})
    rows = spark.range(500).rdd.map(lambda r: (r[0], z(r[0]))).toDF("k long, j string")
    writers.items_document(rows, str(tmp_path / "ros"), "zones", header={"meta": '{"axis":"ros"}'})
    (tmp_path / "enu.json").write_text('{"zones": [%s], "meta": {"axis": "ENU"}}' % z(7))
    turned = {r.ord: r.zone for r in editor.imported_files(spark, str(tmp_path / "ros"), to_enu=True).collect()}
    assert sorted(turned) == list(range(500)) and turned[9].name == "z9" and turned[9].effect.wind_ms == [-9.0, 1.0, 0.0]
    (kept,) = editor.imported_files(spark, str(tmp_path / "enu.json"), to_enu=True).collect()
    assert kept.zone.effect.wind_ms == [1.0, 7.0, 0.0]
    assert editor.imported(spark.createDataFrame([(None,), ('{"zones": null}',), ("{}",)], "json string")).collect() == []
