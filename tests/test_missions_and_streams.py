import json

import pytest
from pyspark.sql import functions as F

from aerofield.operators import drawing, mission, search
from aerofield.sources import readers
from aerofield.streaming import poses

from .conftest import SF
from .test_search import ROOM, boxes

ORIGIN = (36.0, 139.9)


def waypoints(spark):
    rows = [("m", 1, 36.0, 139.9, 30.0, None, None, None), ("m", 2, 36.001, 139.9, None, 5.0, None, 4.0), ("m", 3, 36.001, 139.901, None, None, 12.0, None), ("n", 1, 36.0, 139.9, None, None, None, 2.0)]
    return spark.createDataFrame(rows, "mission string, seq int, lat double, lon double, alt double, speed double, yaw_deg double, sleep_before double")


def test_mission_round_trip(spark):
    m = mission.missions(waypoints(spark), ORIGIN)
    names = [r.command for r in m.where("mission = 'm'").orderBy("step").collect()]
    assert names == ["takeoff", "moveToPosition", "sleep", "moveToPosition", "moveToPosition", "land"]
    assert m.where("command = 'takeoff'").orderBy("mission").first().parameters.height == 30.0
    assert [r.parameters.yaw_deg for r in m.where("command = 'moveToPosition' and mission = 'm'").orderBy("step").collect()] == [0.0, 0.0, 12.0]
    back = mission.imported(m, ORIGIN).where("mission = 'm'").orderBy("step").collect()
    for r, (lat, lon) in zip(back, [(36.0, 139.9), (36.001, 139.9), (36.001, 139.901)], strict=True):
        assert (r.lat, r.lon) == pytest.approx((lat, lon), abs=1e-7)
    assert [r.sleep_before for r in back] == [0.0, 4.0, 0.0] and [r.alt for r in back] == [30.0, 20.0, 20.0]


def test_mission_files(spark, tmp_path):
    (tmp_path / "m.json").write_text(json.dumps({"mission": [{"command": "sleep", "parameters": {"duration_sec": 1}}, {"command": "sleep", "parameters": {"duration_sec": 3}}, {"command": "moveToPosition", "parameters": {"x": 1, "y": 2, "z": 3}}, {"command": "land"}]}))
    (r,) = mission.imported(readers.mission(spark, str(tmp_path / "m.json")), ORIGIN).collect()
    assert (r.sleep_before, r.alt) == (3.0, 3.0)


def test_latest_skips_unusable_poses(spark):
    rows = [("a", 1, 0.0, 0.0, 1.0), ("a", 2, 1.0, 0.0, 1.0), ("a", 3, None, 0.0, 1.0), ("b", 1, 9.0, 9.0, 9.0)]
    got = {r.drone: r.x for r in poses.latest(spark.createDataFrame(rows, "drone string, ts int, x double, y double, z double")).collect()}
    assert got == {"a": 1.0, "b": 9.0}


def environment(spark):
    props = spark.createDataFrame([(i, f"p{i}", ([float(i), 0.0, 0.0], 10.0 + i, 1.0, 0.5)) for i in range(6)], "ord long, id string, properties struct<wind_velocity: array<double>, temperature: double, sea_level_atm: double, gps_strength: double>")
    links = spark.createDataFrame([(i, f"area_{i + 1}", f"p{i}") for i in range(5)], "ord long, area_id string, area_property_id string")
    return boxes(spark, ROOM), props, links


def test_a_replayed_stream_equals_the_batch(spark, tmp_path):
    e = spark.read.parquet(f"{SF}/events.parquet").select(F.col("user_id").cast("string").alias("drone"), "ts", (F.col("event_id") % 14 - 7.0).alias("x"), (F.col("event_id") % 13 - 6.5).alias("y"), F.when(F.col("event_id") % 5 > 0, F.col("value") % 25).alias("z"))
    e.write.parquet(str(tmp_path / "in"))
    env = environment(spark)
    seen = []
    q = poses.run(spark.readStream.schema(e.schema).parquet(str(tmp_path / "in")), env, lambda df, n: seen.extend(map(str, df.collect())), str(tmp_path / "checkpoint"))
    q.awaitTermination(120)
    want = poses.felt(poses.latest(e), env[0], env[2], env[1]).collect()
    assert sorted(seen) == sorted(map(str, want)) and len(want) > 10
    assert any(r.area_id is None and r.disturbance.d_temp == 0.0 for r in want) and any(r.disturbance.d_temp > 0 for r in want)


def test_a_failing_sink_fails_the_query_and_it_goes_on_later(spark, tmp_path):
    p = spark.createDataFrame([("a", 1, 0.0, 0.0, 1.0)], "drone string, ts int, x double, y double, z double")
    p.write.parquet(str(tmp_path / "in"))
    stream = lambda: spark.readStream.schema(p.schema).parquet(str(tmp_path / "in"))

    def fail(df, n):
        raise RuntimeError("bus is gone")

    q = poses.run(stream(), environment(spark), fail, str(tmp_path / "checkpoint"))
    with pytest.raises(Exception, match="bus is gone"):
        q.awaitTermination(60)
    got = []
    poses.run(stream(), environment(spark), lambda df, n: got.extend(df.collect()), str(tmp_path / "checkpoint")).awaitTermination(60)
    assert [r.drone for r in got] == ["a"]


def test_event_time_ticks_as_a_stream(spark, tmp_path):
    e = spark.read.parquet(f"{SF}/events.parquet").select(F.col("user_id").alias("drone"), F.col("ts").cast("timestamp").alias("ts"), F.col("value").alias("x"), F.col("value").alias("y"), F.col("value").alias("z"))
    e.write.parquet(str(tmp_path / "in"))
    s = poses.ticks(spark.readStream.schema(e.schema).parquet(str(tmp_path / "in")).withWatermark("ts", "1 hour"), "6 hours")
    q = s.writeStream.format("memory").queryName("ticks").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert sorted(map(str, spark.table("ticks").collect())) == sorted(map(str, poses.ticks(e, "6 hours").collect()))


def test_readers(spark, tmp_path):
    room = {"space_areas": [{"area_id": a, "bounds": {"min": dict(zip("xyz", lo, strict=True)), "max": dict(zip("xyz", hi, strict=True))}} for a, lo, hi in ROOM]}
    (tmp_path / "area.json").write_text(json.dumps(room))
    (tmp_path / "area_link.json").write_text(json.dumps({"links": [{"area_id": "area_1", "area_property_id": "p"}] * 2}))
    (tmp_path / "property.json").write_text(json.dumps({"area_properties": [{"id": "p", "properties": {"wind_velocity": [1, 2], "temperature": 3}}, {"id": ""}]}))
    a, p, li = readers.environment(spark, str(tmp_path))
    assert a.count() == 6 and p.first().properties.gps_strength == 1.0
    assert readers.violations(a, "area_id", readers.area_checks()).count() == 0
    bad = sorted((r.id, r.problem) for r in readers.violations(p, "id", readers.property_checks()).collect())
    assert ("p", "wind_velocity") in bad and {x for i, x in bad if i == ""} >= {"id", "temperature", "wind_velocity"}
    assert readers.repeated_links(li).first().times == 2
    assert readers.checked(a, readers.area_checks()).count() == 6
    with pytest.raises(Exception, match="wind_velocity|id"):
        readers.checked(p, readers.property_checks()).collect()
    (tmp_path / "odd.json").write_text(json.dumps({"areas": [{"aabb": {"min": [0, 1, 2], "max": [3, 4, 5]}}, {"area_id": "q", "min": {"x": 1, "y": 2, "z": 3}, "max": {"x": 4, "y": 5, "z": 6}}]}))
    rows = readers.any_areas(spark, str(tmp_path / "odd.json")).orderBy("ord").collect()
    assert [(r.area_id, r.bounds.min.x, r.bounds.max.z) for r in rows] == [("0", 0.0, 5.0), ("q", 1.0, 6.0)]
    (tmp_path / "robots.json").write_text(json.dumps({"robots": [{"name": "d1", "shm_pdu_readers": [{"org_name": "pos"}]}, {"shm_pdu_readers": []}, {"name": ""}]}))
    (r,) = readers.robots(spark, str(tmp_path / "robots.json")).collect()
    assert (r.name, r.has_pose, r.has_disturbance) == ("d1", True, False)
    with pytest.raises(FileNotFoundError):
        readers.resolved(spark, str(tmp_path / "nowhere"))
    (tmp_path / "view.json").write_text(json.dumps({"area": "a", "property": "p", "link": "l", "zoom": 12}))
    v = readers.view_config(spark, str(tmp_path / "view.json"), mode="temperature")
    assert (v.zoom, v.mode, v.wind_scale) == (12, "temperature", 1.0)
    (tmp_path / "empty.json").write_text('{"results": []}')
    with pytest.raises(Exception, match="no records"):
        readers.records(spark, str(tmp_path / "empty.json")).collect()


def test_drawing_of_equal_values(spark):
    a = spark.createDataFrame([(0.0, 0.0, 2.0, 1.0, 0.5, 0.0, 0.0, 0.0), (2.0, 0.0, 4.0, 1.0, 0.5, 3.0, 4.0, 0.0)], "xmin double, ymin double, xmax double, ymax double, gps double, vx double, vy double, vz double")
    assert tuple(drawing.value_range(a, "gps").first()) == (0.4, 0.6)
    assert tuple(drawing.value_range(a.where("false"), "gps").first()) == (0.0, 1.0)
    r = drawing.arrows(a).where("vx = 3").first()
    assert (r.ax, r.ay) == pytest.approx((0.6 * 0.5, 0.8 * 0.5))


def test_repeated_keys_keep_the_last(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("b", 1, "z")], "id string, ord int, v string")
    assert sorted((r.id, r.v) for r in search.last_of(df, "id").collect()) == [("a", "y"), ("b", "z")]


def test_violations_of_computed_structs_are_whole_when_collected(spark, tmp_path):
    """Where only some fields of a struct are null by chance, every column still comes back, collected or written."""
    k = F.col("id")
    p = spark.range(12).select(k.cast("string").alias("id"), F.struct(F.when(k % 4 == 0, F.array(F.lit(1.0))).otherwise(F.array(*map(F.lit, (1.0, 0.0, 0.0)))).alias("wind_velocity"), F.when(k % 6 != 0, 20.0).alias("temperature"), F.lit(1.0).alias("sea_level_atm"), (k / 10.0).alias("gps_strength")).alias("properties"))
    bad = readers.violations(p, "id", readers.property_checks())
    want = sorted([(str(i), "wind_velocity") for i in (0, 4, 8)] + [(str(i), "temperature") for i in (0, 6)] + [("11", "gps_strength")])
    assert sorted(map(tuple, bad.collect())) == want
    bad.write.parquet(str(tmp_path / "bad"))
    assert sorted(map(tuple, spark.read.parquet(str(tmp_path / "bad")).collect())) == want
