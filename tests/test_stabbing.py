"""Counts and first hits of places, against brute force."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from aerofield.operators import search, stabbing

from .test_search import boxes, inside


def scene(rng, n, m):
    b = []
    for i in range(n):
        lo = [rng.choice([rng.uniform(-100, 100), rng.randint(-10, 10) * 10]) for _ in range(3)]
        b.append((f"a{i}", lo, [x + rng.choice([0, -5, 10, 20, rng.uniform(1, 50), 300]) for x in lo]))
    pts = [tuple(float(rng.choice([rng.uniform(-120, 120), rng.randint(-12, 12) * 10])) for _ in range(3)) for _ in range(m)]
    return b, pts + pts[:50]


@pytest.mark.parametrize("tile", [20, 4096])
def test_counts_and_firsts_equal_brute_force(spark, monkeypatch, tile):
    monkeypatch.setattr(stabbing, "TILE", tile)
    monkeypatch.setattr(stabbing, "BATCH", 7)
    b, pts = scene(random.Random(tile), 200, 400)
    df = spark.createDataFrame([(i, *p) for i, p in enumerate([*pts, (None, 0.0, 0.0), (float("nan"), 0.0, 0.0)])], "id long, x double, y double, z double")
    hits = {p: [i for i, x in enumerate(b) if inside(p, x)] for p in pts}
    got = {(r.x, r.y, r.z): (r.n_hits, r.first_ord) for r in stabbing.stabbed(df, boxes(spark, b)).collect()}
    assert got == {p: (len(h), h[0]) for p, h in hits.items() if h}
    first = stabbing.stabbed(df, boxes(spark, b).orderBy(F.rand(1)), counted=False).collect()
    assert {(r.x, r.y, r.z): r.first_ord for r in first} == {p: h[0] for p, h in hits.items() if h}
    assert stabbing.stabbed(df.where("false"), boxes(spark, b)).count() == stabbing.stabbed(df, boxes(spark, [])).count() == 0


def test_the_first_of_a_crowd_is_the_first(spark, monkeypatch):
    b, pts = scene(random.Random(5), 120, 200)
    df = spark.createDataFrame([(i, *p) for i, p in enumerate([*pts, (None, 0.0, 0.0)])], "id long, x double, y double, z double")
    areas = boxes(spark, b).withColumn("name", F.concat(F.lit("n"), "ord"))
    plain = search.primary_area(df, areas, carry=("name",))
    monkeypatch.setattr(search, "CROWD", 3)
    crowd = search.primary_area(df, areas, carry=("name",))
    assert crowd.columns == plain.columns and sorted(map(str, crowd.collect())) == sorted(map(str, plain.collect()))


def test_boxes_that_hold_all_places_are_no_work_for_each():
    """A million box hits at the root, and none in a leaf."""
    tree = stabbing.Tree(np.random.default_rng(2).random((1000, 3)))
    tree.add(np.full((1000, 3), -1.0), np.full((1000, 3), 2.0), np.arange(1000))
    assert tree.count[0] == 1000 and not tree.own_count.any() and (tree.result()[0] == 1000).all() and not tree.result()[1].any()
