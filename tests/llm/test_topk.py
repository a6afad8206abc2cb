import math
import random

import numpy as np
import pytest

from aerofield.llm import topk


def brute(rows, every=20, k=20):
    v = {}
    for i, x in rows:
        if i is not None and x is not None and all(c is not None and math.isfinite(c) for c in x):
            v.setdefault(i, []).append([math.floor(64 * c) for c in x])
    out = []
    for q, xs in v.items():
        for x in xs if q % every == 0 else []:
            found = sorted((-sum(a * b for a, b in zip(x, y, strict=False)), i) for i, ys in v.items() if i != q for y in ys)
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(found[:k])]
    return sorted(out)


def run(spark, rows):
    v = topk.scaled(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    return sorted(tuple(r) for r in topk.top_k(v.where("vec_id % 20 = 0"), v).collect())


def test_matches_brute_force_with_ties_and_bad_vectors(spark):
    rng = random.Random(3)
    rows = [(i, [rng.choice([-0.5, 0.1, 0.25, rng.uniform(-1, 1)]) for _ in range(8)]) for i in range(300)]
    rows += [(i, rows[7][1]) for i in range(300, 340)]
    rows += [(400, None), (401, [None] * 8), (402, [math.nan] + [0.1] * 7), (403, [math.inf] * 8), (None, [0.5] * 8), (420, [1e9] * 8), (440, [0.5] * 3), (441, [])]
    assert run(spark, rows) == brute(rows)


def test_few_and_no_rows(spark):
    assert run(spark, []) == []
    assert run(spark, [(0, [1.0]), (1, [2.0])]) == [(0, 1, 1, 8192)]


def test_repeated_rows_are_queries_of_their_own(spark):
    rows = [(0, [1.0, 0.5]), (0, [1.0, 0.5]), (20, [-1.0, 0.25]), *((i, [i / 50, 1 - i / 50]) for i in range(1, 15))]
    assert run(spark, rows) == brute(rows)
    assert sum(r[0] == 0 for r in run(spark, rows)) == 2 * 15


def test_several_blocks(spark, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK", 50)
    monkeypatch.setattr(topk, "QUERY_BLOCK", 3)
    rng = random.Random(8)
    rows = [(i, [rng.gauss(0, 1) for _ in range(6)]) for i in range(400)]
    assert run(spark, rows) == brute(rows)


@pytest.mark.parametrize("scale", [1, 1 << 12, 1 << 22])
@pytest.mark.parametrize("clustered", [False, True])
def test_reading_stops_early_only_when_it_may(clustered, scale):
    """All kinds of numbers; on clustered vectors fewer list entries are read than there are."""
    rng = np.random.default_rng(1)
    x = np.floor(64 * rng.normal(0, 0.3, (1500, 12)))
    if clustered:
        x[:60] = np.floor(x[:1] * 3 + rng.integers(-2, 3, (60, 12)))
    x *= scale
    ids = rng.permutation(len(x))
    lists, all_read = topk.Lists(x, ids), 0
    exact = [[int(c) for c in row] for row in x]
    for i in range(10):
        got, score, read = topk.nra(x[i], ids[i], lists, 20)
        want = sorted((-sum(a * b for a, b in zip(exact[i], y, strict=True)), j) for y, j in zip(exact, ids.tolist(), strict=True) if j != ids[i])[:20]
        assert list(zip(score.tolist(), got.tolist(), strict=True)) == [(-c, j) for c, j in want]
        all_read += read
        # scores found elsewhere that none here reaches end the reading at once
        assert topk.nra(x[i], ids[i], lists, 20, -want[0][0] + 1)[2] <= read
    assert all_read < 10 * x.size * 0.9 if clustered else all_read <= 10 * x.size


@pytest.mark.parametrize("scale", [1, 1 << 12, 1 << 22])
@pytest.mark.parametrize("clustered", [False, True])
def test_queries_that_read_together_get_and_read_what_each_would_alone(clustered, scale):
    rng = np.random.default_rng(6)
    x = np.floor(64 * rng.normal(0, 0.3, (1200, 12)))
    x[rng.random(x.shape) < 0.1] = 0
    if clustered:
        x[:60] = np.floor(x[:1] * 3 + rng.integers(-2, 3, (60, 12)))
    x[100:130] = x[99]
    x *= scale
    ids = rng.permutation(len(x))
    lists, rows = topk.Lists(x, ids), np.array([0, 1, 5, 99, 110, 700, 701])
    alone = [topk.nra(x[i], ids[i], lists, 20) for i in rows]
    floor = np.full(len(rows), -np.inf)
    for _ in range(2):
        got, read = topk.nra_many(x[rows], ids[rows], lists, 20, floor)
        for (got_ids, got_score), (want_ids, want_score, _), f in zip(got, alone, floor, strict=True):
            assert [t for t in zip(got_score.tolist(), got_ids.tolist(), strict=True) if t[0] >= f] == [t for t in zip(want_score.tolist(), want_ids.tolist(), strict=True) if t[0] >= f]
        assert read <= sum(r for *_, r in alone)
        floor = np.array([float(s[9]) for _, s, _ in alone])
    none = topk.nra_many(x[rows], ids[rows], topk.Lists(x[:0], ids[:0]), 20, floor)
    assert [len(i) for i, _ in none[0]] == [0] * len(rows) and none[1] == 0


def test_no_block_is_shuffled_to_another(spark, monkeypatch):
    """Only names of blocks meet; vectors stay in their files."""
    monkeypatch.setattr(topk, "BLOCK", 40)
    monkeypatch.setattr(topk, "QUERY_BLOCK", 2)
    rng = random.Random(9)
    rows = [(i, [rng.gauss(0, 1) for _ in range(5)]) for i in range(300)]
    v = topk.scaled(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    found = topk.top_k(v.where("vec_id % 20 = 0"), v)
    assert sorted(map(tuple, found.collect())) == brute(rows)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "binary" not in plan and "SortMergeJoin" not in plan and " vs#" not in plan
