"""Zones, grids and models, with values worked out by hand from example models."""

import json
import math
import random

import pytest
from pyspark.sql import functions as F

from aerofield.operators import creator
from aerofield.operators.creator import Grid


def zone(name, rect, gps, wind=None, priority=1, std=2.0):
    effect = {"mode": "absolute", "wind_ms": wind} if wind else {"mode": "turbulence", "turbulence": {"type": "gauss", "std_ms": std, "seed": 123}}
    return {"name": name, "shape": {"rect": {"min_m": rect[:2], "max_m": rect[2:]}}, "effect": effect | {"gps_abs": gps}, "priority": priority}


# fixed values: a published model of 22 x 32 cells with nine zones, whose counts are known
HARBOUR = {
    "grid": {"min": [0, -6400, 0], "max": [4400, 0, 100], "cell_m": [200, 200, 100]},
    "base": {"wind": {"vector_ms": [4.0, 0.0, 0.0]}},
    "zones": [
        zone("block1", (0, -3000, 1600, 0), 0.8, [3.0, 3.0, 0.0]), zone("block2", (1600, -3200, 3200, 0), 0.7, std=3.0), zone("block3", (3200, -1000, 4400, 3200), 0.6),
        zone("block4", (3200, -2800, 4400, -1000), 0.8), zone("block5", (3400, -4000, 4400, -2800), 0.7), zone("block6", (4000, -5800, 4400, -4000), 0.8),
        zone("block7", (0, -6400, 3800, -5800), 0.8), zone("block8", (200, -5800, 3500, -5000), 0.6, std=1.0), zone("block9", (1000, -5000, 4000, -4500), 0.8, priority=2, std=4.0),
    ],
}


def test_harbour_golden(spark):
    areas, props, links = creator.build(spark, HARBOUR)
    assert areas.count() == links.count() == 704
    first, last = (areas.where(f"area_id = '{i}'").first().bounds for i in ("area_0_0", "area_31_21"))
    assert (first.min.x, first.min.y, first.max.y, first.max.z) == (0, -6400, -6200, 100) and (last.max.x, last.max.y) == (4400, 0)
    gps = {round(r.g, 1): r.n for r in props.groupBy(F.col("properties.gps_strength").alias("g")).agg(F.count("*").alias("n")).collect()}
    assert gps == {1.0: 154, 0.8: 294, 0.7: 158, 0.6: 98}
    wind = [tuple(r[0]) for r in props.select("properties.wind_velocity").collect()]
    assert wind.count((4.0, 0.0, 0.0)) == 154 and wind.count((3.0, 3.0, 0.0)) == 120


def test_noise_does_not_depend_on_partitions(spark):
    values = lambda df: sorted(map(str, df.select("properties").collect()))
    _, p, _ = creator.build(spark, HARBOUR)
    cells = creator.cells(spark, Grid.of(HARBOUR["grid"])).withColumn("properties", creator.base_property(HARBOUR["base"]))
    assert values(p) == values(creator.fold_zones(cells.repartition(3), HARBOUR["zones"]))


def by_hand(model, x, y):
    """The fold for modes without noise, cell by cell."""
    wind, gps = list(model["base"]["wind"]["vector_ms"]), 1.0
    for z in sorted(model["zones"], key=lambda z: -z.get("priority", 0)):
        s, e = z["shape"], z["effect"]
        if "circle" in s:
            hit = math.dist((x, y), s["circle"]["center_m"]) <= s["circle"]["radius_m"]
        else:
            (x0, y0), (x1, y1) = s["rect"]["min_m"], s["rect"]["max_m"]
            hit = x0 <= x <= x1 and y0 <= y <= y1
        if not hit:
            continue
        if e["mode"] == "absolute":
            wind = list(e["wind_ms"])
        elif e["mode"] == "scale":
            wind = [v * e["scale"] for v in wind]
        elif e["mode"] == "add":
            wind = [v + a for v, a in zip(wind, e.get("add_ms", (0, 0, 0)), strict=True)]
        elif e["mode"] == "vortex":
            v = e["vortex"]
            dx, dy = x - v["center_m"][0], y - v["center_m"][1]
            r = math.hypot(dx, dy)
            if r >= v.get("r_min_m", 0.1):
                g = v["gain"] / r * (math.exp(-r * r / (2 * v.get("sigma_m", 10.0) ** 2)) if v.get("decay") == "gaussian" else 1)
                sign = 1 if v.get("clockwise", True) else -1
                vx, vy = -g * dy / r * sign, g * dx / r * sign
                speed = math.hypot(vx, vy)
                k = min(1.0, v["max_ms"] / speed) if "max_ms" in v else 1.0
                wind = [wind[0] + vx * k, wind[1] + vy * k, wind[2]]
        gps = max(0.0, min(1.0, (e.get("gps_abs", gps) + e.get("gps_add", 0)) * e.get("gps_scale", 1)))
    return [*wind, gps]


@pytest.mark.parametrize("seed", range(3))
def test_random_folds(spark, seed):
    rng = random.Random(seed)
    spot = lambda: [rng.uniform(0, 100), rng.uniform(0, 100)]
    zones = []
    for i in range(7):
        a, b = spot(), spot()
        shape = {"circle": {"center_m": a, "radius_m": rng.uniform(5, 60)}} if i % 2 else {"rect": {"min_m": [min(a[0], b[0]), min(a[1], b[1])], "max_m": [max(a[0], b[0]), max(a[1], b[1])]}}
        effect = rng.choice([
            {"mode": "absolute", "wind_ms": [1.0, -2.0, 0.5]}, {"mode": "scale", "scale": 0.5}, {"mode": "add", "add_ms": [0.1, 0.2, 0.3]}, {"mode": "add"}, {"mode": "unheard-of"},
            {"mode": "vortex", "vortex": {"center_m": a, "gain": 30, "max_ms": 3}}, {"mode": "vortex", "vortex": {"center_m": [5.0, 5.0], "gain": 9, "decay": "gaussian", "sigma_m": 40, "clockwise": False}},
        ])
        zones.append({"name": f"z{i}", "shape": shape, "priority": rng.randint(0, 2), "effect": effect | rng.choice([{}, {"gps_add": -0.7}, {"gps_scale": 0.5, "gps_abs": 0.9}, {"gps_add": 2.0}])})
    model = {"grid": {"min": [0, 0, 0], "max": [100, 100, 10], "cell_m": [10, 10, 10]}, "base": {"wind": {"vector_ms": [4.0, 1.0, 0.0]}}, "zones": zones}
    areas, props, _ = creator.build(spark, model)
    for r in props.join(areas, "ord").collect():
        x, y = (r.bounds.min.x + r.bounds.max.x) / 2, (r.bounds.min.y + r.bounds.max.y) / 2
        assert [*r.properties.wind_velocity, r.properties.gps_strength] == pytest.approx(by_hand(model, x, y), abs=1e-9)


def test_lowest_priority_has_the_last_word_and_ties_go_as_listed(spark):
    z = [zone("a", (0, 0, 9, 9), 0.1, [1.0, 0, 0], 5), zone("b", (0, 0, 9, 9), 0.2, [2.0, 0, 0], 1), zone("c", (0, 0, 9, 9), 0.3, [3.0, 0, 0], 1)]
    model = {"grid": {"min": [0, 0, 0], "max": [2, 2, 1], "cell_m": [2, 2, 1]}, "base": {"wind": {"vector_ms": [0, 0, 0]}}, "zones": z}
    gps = lambda **k: creator.build(spark, model, **k)[1].first().properties.gps_strength
    assert gps() == 0.3 and gps(order="priority_asc") == 0.1 and gps(with_zones=False) == 1.0


def test_grids(spark):
    assert Grid((0, 0, 0), (1.0, 1.0, 1), (0.1, 0.1, 1)).nx == 9  # as float floor division has it
    only_extent = {"extent_m": [100, 50], "cell_m": [10, 10, 5]}
    assert Grid.of(only_extent).nx == 0 and (Grid.of(only_extent, lenient=True).nx, Grid.of(only_extent, lenient=True).ny) == (10, 5)
    assert creator.build(spark, {"grid": only_extent, "base": {"wind": {"dir_deg": 90, "speed_ms": 2}}})[0].count() == 0


def test_zone_borders_belong_to_zones(spark):
    p = spark.createDataFrame([(0.0, 0.0), (2.0, 2.0), (2.1, 2.0), (1.0, 3.0)], "x double, y double")
    has = lambda s: [r[0] for r in p.select(creator.contains(s, F.col("x"), F.col("y"))).collect()]
    assert has({"rect": {"min_m": [0, 0], "size_m": [2, 2]}}) == has({"rect": {"center_m": [1, 1], "size_m": [2, 2]}}) == [True, True, False, False]
    assert has({"circle": {"center_m": [1, 1], "radius_m": 2}}) == [True, True, True, True] and has({"line": {}}) == [False] * 4


def test_active_zones(spark):
    z = zone("a", (0, 0, 9, 9), 0.5, [1.0, 0, 0]) | {"active": {"t_from_s": 10, "t_to_s": 20}}
    cells = creator.cells(spark, Grid((0, 0, 0), (2, 2, 1), (2, 2, 1))).withColumn("properties", creator.base_property({"wind": {"vector_ms": [0, 0, 0]}}))
    got = [creator.fold_zones(cells, [z], at=F.lit(float(t))).first().properties.gps_strength for t in (5, 10, 20)]
    assert got == [1.0, 0.5, 1.0]


def test_noise_is_normal(spark):
    keys = spark.range(20000).select(creator.normal(F.col("id").cast("string"), 1, 0).alias("n"))
    m, s = keys.agg(F.mean("n"), F.stddev("n")).first()
    assert abs(m) < 0.03 and abs(s - 1) < 0.03


def test_models_are_read(spark, tmp_path):
    from aerofield.sources import readers

    (tmp_path / "m.json").write_text(json.dumps(HARBOUR))
    assert readers.model(spark, str(tmp_path / "m.json")) == json.loads(json.dumps(HARBOUR))
