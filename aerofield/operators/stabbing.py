"""How many boxes hold a point, and the first of them, without a row for each pair."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Places of a tile, about, and tiles at most, after which they grow instead.
TILE = 4096
TILES = 1024
#: Points that are compared with boxes one by one.
LEAF = 16
#: Boxes that go down the tree at a time.
BATCH = 16384
_NONE = np.iinfo(np.int64).max


def _every(ok: np.ndarray) -> np.ndarray:
    return ok[..., 0] & ok[..., 1] & ok[..., 2]


class Tree:
    """Points (n, 3) halved along their widest side until `LEAF` are left or all are one; a node knows its corners.

    Boxes go down from the root.  One that misses a node's corners stops there, one that holds both
    corners holds every point of the node and counts there once; only others go on, and meet points one by one in the leaves.
    """

    def __init__(self, points: np.ndarray) -> None:
        self.order = np.arange(len(points))
        self.points = points
        self.start, self.end, self.children, self.low, self.high = [], [], [], [], []
        todo = [(0, len(points), -1)] if len(points) else []
        while todo:
            a, b, parent = todo.pop()
            at = len(self.start)
            if parent >= 0:
                self.children[parent].append(at)
            p = self.points[self.order[a:b]]
            low, high = p.min(axis=0), p.max(axis=0)
            for kept, v in zip((self.start, self.end, self.children, self.low, self.high), (a, b, [], low, high), strict=True):
                kept.append(v)
            if b - a > LEAF and (high > low).any():
                k, mid = int(np.argmax(high - low)), (b - a) // 2
                self.order[a:b] = self.order[a:b][np.argpartition(p[:, k], mid)]
                todo += [(a, a + mid, at), (a + mid, b, at)]
        self.points = self.points[self.order]
        self.count, self.first = np.zeros(len(self.start), np.int64), np.full(len(self.start), _NONE)
        self.own_count, self.own_first = np.zeros(len(points), np.int64), np.full(len(points), _NONE)

    def add(self, low: np.ndarray, high: np.ndarray, ord: np.ndarray, counted: bool = True) -> None:
        """Half-open boxes from ``low`` to ``high``; where they are not ``counted``, only those that may be first go on."""
        todo = [(0, np.arange(len(ord)), _NONE)] if self.start else []
        while todo:
            at, ids, best = todo.pop()
            ids = ids[_every(low[ids] <= self.high[at]) & _every(high[ids] > self.low[at])]
            whole = _every(low[ids] <= self.low[at]) & _every(high[ids] > self.high[at])
            if whole.any():
                self.count[at] += int(whole.sum())
                self.first[at] = min(self.first[at], ord[ids[whole]].min())
                ids = ids[~whole]
            best = min(best, self.first[at])
            if not counted:
                ids = ids[ord[ids] < best]
            if not len(ids):
                continue
            if self.children[at]:
                todo += [(child, ids, best) for child in self.children[at]]
                continue
            a, b = self.start[at], self.end[at]
            p = self.points[a:b, None, :]
            holds = _every((low[ids] <= p) & (p < high[ids]))
            self.own_count[a:b] += holds.sum(axis=1)
            self.own_first[a:b] = np.minimum(self.own_first[a:b], np.where(holds, ord[ids], _NONE).min(axis=1))

    def result(self) -> tuple[np.ndarray, np.ndarray]:
        """(count, first) of the points in their given order; `_NONE` where no box holds one."""
        count, first = self.own_count.copy(), self.own_first.copy()
        for at in range(len(self.start)):  # parents come before their children
            for child in self.children[at]:
                self.count[child] += self.count[at]
                self.first[child] = min(self.first[child], self.first[at])
            if not self.children[at]:
                a, b = self.start[at], self.end[at]
                count[a:b] += self.count[at]
                first[a:b] = np.minimum(first[a:b], self.first[at])
        back = np.empty_like(self.order)
        back[self.order] = np.arange(len(back))
        return count[back], first[back]


def _cuts(values: list[float] | None) -> list[float]:
    return sorted(set(values or []))


def _strip(x: Column, cuts: Column) -> Column:
    """The number of cuts that are not above x."""
    return F.aggregate(cuts, F.lit(0), lambda n, c: n + (c <= x).cast("int"))


def stabbed(points: DataFrame, areas: DataFrame, counted: bool = True) -> DataFrame:
    """(x, y, z, n_hits, first_ord) of the places of ``points`` that an area's half-open box holds.

    Places are cut into tiles of about `TILE` by quantiles of x, then of y, and an area goes to each tile it touches.
    A task keeps a tile's places as a `Tree` and areas pass through it in batches, so a crowd of areas in one spot costs no
    memory, and an area that holds many places at once costs one step.  Without ``counted``, areas that come after
    one which holds the same places are left out, and n_hits is no number of hits.  Areas without an ord, and places
    without all three coordinates, take no part; neither does what is not a number.
    """
    places = points.select(*(F.col(c).cast("double").alias(c) for c in "xyz")).where("x is not null and y is not null and z is not null and not isnan(x) and not isnan(y) and not isnan(z)").distinct()
    n = places.count()
    strips = max(1, round(min(n / TILE, TILES) ** 0.5))
    quantiles = lambda c: F.percentile_approx(c, [i / strips for i in range(1, strips)], 1000) if strips > 1 else F.array().cast("array<double>")
    xs = _cuts(places.agg(quantiles("x").alias("q")).first()["q"])
    arr = lambda v: F.array(*map(F.lit, v)).cast("array<double>")
    placed = places.withColumn("_sx", _strip(F.col("x"), arr(xs)))
    ys = {r["_sx"]: _cuts(r["q"]) for r in placed.groupBy("_sx").agg(quantiles("y").alias("q")).collect()}
    cuts = F.create_map(*(c for k, v in sorted(ys.items()) for c in (F.lit(k), arr(v)))) if ys else F.create_map().cast("map<int, array<double>>")
    of = lambda s: F.coalesce(F.element_at(cuts, s), F.array().cast("array<double>"))
    tile = lambda sx, sy: (sx * (strips + 1) + sy).alias("tile")
    here = placed.select(tile(F.col("_sx"), _strip(F.col("y"), of(F.col("_sx")))), F.lit(0).alias("kind"), F.array("x", "y", "z").alias("low"), F.lit(None).cast("array<double>").alias("high"), F.lit(None).cast("long").alias("ord"))
    low, high = (F.array(*(F.col(f"bounds.{s}.{k}").cast("double") for k in "xyz")) for s in ("min", "max"))
    b = areas.select(low.alias("low"), high.alias("high"), F.col("ord").cast("long").alias("ord")).where("ord is not null and forall(concat(low, high), v -> v is not null and not isnan(v)) and low[0] < high[0] and low[1] < high[1] and low[2] < high[2]")
    # in steps: a generator's own row must not read what another one makes
    b = b.withColumn("_xs", F.sequence(_strip(F.col("low")[0], arr(xs)), _strip(F.col("high")[0], arr(xs)))).select("low", "high", "ord", F.explode("_xs").alias("_sx"))
    b = b.withColumn("_c", of(F.col("_sx"))).withColumn("_ys", F.sequence(_strip(F.col("low")[1], F.col("_c")), _strip(F.col("high")[1], F.col("_c")))).select("low", "high", "ord", "_sx", F.explode("_ys").alias("_sy"))
    there = b.select(tile(F.col("_sx"), F.col("_sy")), F.lit(1).alias("kind"), "low", "high", "ord")
    order = ["tile", "kind"] if counted else ["tile", "kind", "ord"]
    parts = max(1, min(4 * points.sparkSession.sparkContext.defaultParallelism, strips * strips))
    rows = here.unionByName(there).repartition(parts, "tile").sortWithinPartitions(*order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held, tree = None, [], None
        waiting: list[tuple[np.ndarray, ...]] = []

        def put() -> None:
            if waiting:
                tree.add(*(np.concatenate(c) for c in zip(*waiting, strict=True)), counted)
                waiting.clear()

        def done() -> Iterator[pa.RecordBatch]:
            if tree is not None:
                put()
                p = np.concatenate(held)
                count, first = tree.result()
                hit = np.flatnonzero(first != _NONE)
                for i in range(0, len(hit), BATCH):
                    h = hit[i : i + BATCH]
                    yield pa.RecordBatch.from_arrays([*(pa.array(p[h, k]) for k in range(3)), pa.array(count[h]), pa.array(first[h])], names=["x", "y", "z", "n_hits", "first_ord"])

        flat = lambda c: np.asarray(c.flatten()).reshape(-1, 3)
        for batch in batches:
            tiles, kinds = (np.asarray(batch.column(k)) for k in (0, 1))
            edges = np.flatnonzero((np.diff(tiles) != 0) | (np.diff(kinds) != 0)) + 1
            for a, b in zip([0, *edges.tolist()], [*edges.tolist(), len(tiles)], strict=True):
                if a == b:
                    continue
                if tiles[a] != at:
                    yield from done()
                    at, held, tree = tiles[a], [], None
                part = batch.slice(a, b - a)
                if kinds[a] == 0:
                    held.append(flat(part.column(2)))
                elif held:
                    tree = tree or Tree(np.concatenate(held))
                    waiting.append((flat(part.column(2)), flat(part.column(3)), np.asarray(part.column(4))))
                    if sum(len(w[2]) for w in waiting) >= BATCH:
                        put()
        yield from done()

    return rows.mapInArrow(run, "x double, y double, z double, n_hits long, first_ord long")
