import random

import pytest
from pyspark.sql import functions as F

from aerofield.operators import search, tree

BOX = "ord long, area_id string, bounds struct<min: struct<x: double, y: double, z: double>, max: struct<x: double, y: double, z: double>>"


def boxes(spark, rows):
    return spark.createDataFrame([(i, a, (tuple(map(float, lo)), tuple(map(float, hi)))) for i, (a, lo, hi) in enumerate(rows)], BOX)


def inside(p, b):
    return all(lo <= v < hi for v, lo, hi in zip(p, b[1], b[2], strict=True))


@pytest.mark.parametrize("seed", range(3))
def test_bucket_join_equals_brute_force(spark, seed):
    rng = random.Random(seed)
    b = []
    for i in range(80):
        lo = [rng.choice([rng.uniform(-100, 100), rng.randint(-10, 10) * 10]) for _ in range(3)]
        size = [rng.choice([5, 10, 20, rng.uniform(1, 150)]) for _ in range(3)]
        b.append((f"a{i}", lo, [x + s for x, s in zip(lo, size, strict=True)]))
    pts = [tuple(rng.choice([rng.uniform(-120, 120), rng.randint(-12, 12) * 10.0]) for _ in range(3)) for _ in range(300)] + [(None, 0.0, 0.0)]
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(pts)], "id long, x double, y double, z double")
    for cell in (None, (10.0, 10.0)):
        got = sorted((r.id, r.area_id) for r in search.area_hits(df, boxes(spark, b), cell).collect())
        assert got == sorted((i, x[0]) for i, p in enumerate(pts) if None not in p for x in b if inside(p, x))
    first = {r.id: r.area_id for r in search.primary_area(df, boxes(spark, b)).collect()}
    assert first == {i: next((x[0] for x in b if None not in p and inside(p, x)), None) for i, p in enumerate(pts)}


# A room of six boxes, side by side.
ROOM = [(f"area_{i + 1}", (-6 + 4 * (i % 3), -6 + 6 * (i // 3), 0), (-2 + 4 * (i % 3), 6 * (i // 3), 20)) for i in range(6)]


def test_upper_faces_are_outside(spark):
    pts = [(0, 2.0, 0.0, 5.0), (1, 1.999, 0.0, 5.0), (2, 6.0, 0.0, 5.0), (3, 0.0, 0.0, 20.0), (4, -2.0, -6.0, 0.0)]
    df = spark.createDataFrame(pts, "id long, x double, y double, z double")
    got = {r.id: r.area_id for r in search.primary_area(df, boxes(spark, ROOM)).collect()}
    assert got == {0: "area_6", 1: "area_5", 2: None, 3: None, 4: "area_2"}


def test_no_areas(spark):
    df = spark.createDataFrame([(1, 0.0, 0.0, 0.0)], "id long, x double, y double, z double")
    assert [r.area_id for r in search.primary_area(df, boxes(spark, [])).collect()] == [None]


def tables(spark):
    links = spark.createDataFrame([(0, "area_1", "p1"), (1, "area_2", "gone"), (2, "area_1", "p2"), (3, "ghost", "p1")], "ord long, area_id string, area_property_id string")
    props = spark.createDataFrame([(0, "p1", ([1.0, 2.0, 3.0], 10.5, 1.0, 0.9)), (1, "p2", ([0.0, 1.0], None, 1.0, None)), (2, "p2", ([5.0, 1.0, 0.0], 7.0, 1.0, None)), (3, "p3", None)], "ord long, id string, properties struct<wind_velocity: array<double>, temperature: double, sea_level_atm: double, gps_strength: double>")
    return boxes(spark, ROOM), links, props


def test_last_link_and_property_win(spark):
    rows = {r.area_id: r for r in search.inspected(*tables(spark)).collect()}
    assert rows["area_1"].area_property_id == "p2" and rows["area_1"].properties.temperature == 7.0
    assert not rows["area_2"].has_property and rows["area_2"].area_property_id == "gone" and rows["area_3"].area_property_id is None
    assert sorted((r.area_id, r.area_property_id) for r in search.visual_areas(*tables(spark)).collect()) == [("area_1", "p1"), ("area_1", "p2")]


def test_integrity(spark):
    got = sorted(map(tuple, search.integrity(*tables(spark)).collect()))
    assert got == [("areas_without_link", f"area_{i}") for i in (3, 4, 5, 6)] + [("links_to_missing_area", "ghost"), ("links_to_missing_property", "area_2"), ("properties_unreferenced", "p3")]


def test_disturbance(spark):
    rows = tables(spark)[2].select("id", "ord", search.disturbance(F.col("properties")).alias("d")).orderBy("ord").collect()
    assert tuple(rows[0].d.d_wind) == (1.0, 2.0, 3.0) and rows[0].d.d_user_custom[0].data == [0.9]
    assert tuple(rows[1].d.d_wind) == (0.0, 0.0, 0.0) and rows[1].d.d_temp == 0.0 and rows[1].d.d_user_custom is None
    assert rows[3].d.d_atm == 0.0


def reference_tree(b, depth, most, cap):
    """(depth, ids) of the leaves, left to right."""
    if len(b) <= cap or depth >= most:
        return [(depth, [x[0] for x in b])]
    mids = list(zip(*([(lo + hi) / 2 for lo, hi in zip(x[1], x[2], strict=True)] for x in b), strict=True))
    spread = [max(m) - min(m) for m in mids]
    axis = spread.index(max(spread))
    b = sorted(b, key=lambda x: x[1][axis])
    return reference_tree(b[: len(b) // 2], depth + 1, most, cap) + reference_tree(b[len(b) // 2 :], depth + 1, most, cap)


@pytest.mark.parametrize("most,cap", [(3, 1), (6, 2), (0, 1)])
def test_tree(spark, most, cap):
    rng = random.Random(most)
    b = []
    for i in range(37):
        lo = [rng.uniform(0, 90) for _ in range(3)]
        b.append((f"a{i}", lo, [x + rng.uniform(1, 30) for x in lo]))
    nodes = tree.tree_nodes(boxes(spark, b), most, cap)
    leaves = [(r.depth, [a.area_id for a in r.areas]) for r in nodes.where("is_leaf").collect()]
    assert sorted(leaves) == sorted(reference_tree(b, 0, most, cap))
    s = tree.tree_stats(nodes).first()
    assert s.max_depth == max(d for d, _ in leaves) and s.average_leaf == pytest.approx(37 / len(leaves))
    p = spark.createDataFrame([(1, 50.0, 50.0, 50.0), (2, 500.0, 0.0, 0.0)], "id long, x double, y double, z double")
    got = {r.id: r for r in tree.tree_search(p, nodes, ["id"], most).collect()}
    hit = [{x[0] for x in b if inside((50, 50, 50), x)} & set(ids) for _, ids in leaves]
    assert len(got[1].found) == sum(bool(h) for h in hit) and got[2].visited == 1 and got[2].found == []
