"""Boxes, rings and rectangles as column expressions.

A ring is an array of struct<x, y>; it is closed implicitly.  Everything but `convex_hull` is
made of Spark's own higher-order functions.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

RING = "array<struct<x: double, y: double>>"


def in_box(x: Column, y: Column, z: Column, low: tuple, high: tuple) -> Column:
    """Half-open: a point on an upper face is outside."""
    return (x >= low[0]) & (x < high[0]) & (y >= low[1]) & (y < high[1]) & (z >= low[2]) & (z < high[2])


def in_circle(x: Column, y: Column, cx: Column, cy: Column, r: Column) -> Column:
    """Closed."""
    return (x - cx) * (x - cx) + (y - cy) * (y - cy) <= r * r


def in_rect(x: Column, y: Column, xmin: Column, ymin: Column, xmax: Column, ymax: Column) -> Column:
    """Closed."""
    return x.between(xmin, xmax) & y.between(ymin, ymax)


def boxes_touch(a: tuple, b: tuple) -> Column:
    """Closed overlap of (xmin, ymin, xmax, ymax) boxes: touching counts."""
    return (a[0] <= b[2]) & (a[2] >= b[0]) & (a[1] <= b[3]) & (a[3] >= b[1])


def normal_box(a: Column, b: Column) -> Column:
    """Two corners as struct<xmin, ymin, xmax, ymax>."""
    pick = lambda f, k: f(a[k], b[k])
    return F.struct(pick(F.least, "x").alias("xmin"), pick(F.least, "y").alias("ymin"), pick(F.greatest, "x").alias("xmax"), pick(F.greatest, "y").alias("ymax"))


def merged_box(a: Column, b: Column) -> Column:
    """The box around two boxes struct<min: struct<x, y, z>, max: ...>."""
    corner = lambda f, k: F.struct(*(f(a[k][i], b[k][i]).alias(i) for i in "xyz")).alias(k)
    return F.struct(corner(F.least, "min"), corner(F.greatest, "max"))


def box_size(box: Column) -> Column:
    """struct<width, height, depth, cx, cy, cz> of a box."""
    side = lambda i: box["max"][i] - box["min"][i]
    mid = lambda i: (box["min"][i] + box["max"][i]) * 0.5
    return F.struct(side("x").alias("width"), side("y").alias("height"), side("z").alias("depth"), mid("x").alias("cx"), mid("y").alias("cy"), mid("z").alias("cz"))


def edges(ring: str) -> str:
    """SQL text for the cyclic edges struct<a, b> of the ring expression."""
    return f"transform({ring}, (_p, _i) -> named_struct('a', _p, 'b', {ring}[cast((_i + 1) % size({ring}) as int)]))"


def ring_area(ring: str) -> Column:
    """Shoelace area without sign; 0 for fewer than three points."""
    return F.expr(f"case when size({ring}) < 3 then 0D else abs(aggregate({edges(ring)}, 0D, (s, e) -> s + (e.a.x * e.b.y - e.b.x * e.a.y))) / 2 end")


def ring_mean(ring: str) -> Column:
    """Mean of the vertices as struct<x, y>."""
    mean = lambda k: f"aggregate({ring}, 0D, (s, p) -> s + p.{k}) / size({ring})"
    return F.expr(f"case when size({ring}) > 0 then named_struct('x', {mean('x')}, 'y', {mean('y')}) end")


def cross(o: tuple, a: tuple, b: tuple) -> float:
    return (a[0] - o[0]) * (b[1] - o[1]) - (a[1] - o[1]) * (b[0] - o[0])


def hull_of(points: list[tuple[float, float]]) -> list[tuple[float, float]]:
    """Counter-clockwise hull from the lowest x (then y) on; points on edges are left out."""
    pts = sorted(set(points))
    if len(pts) < 3:
        return pts

    def half(side: list) -> list:
        chain: list = []
        for p in side:
            while len(chain) > 1 and cross(chain[-2], chain[-1], p) <= 0:
                chain.pop()
            chain.append(p)
        return chain[:-1]

    return half(pts) + half(pts[::-1])


def _hulls(rings: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for batch in rings:
        yield batch.map(lambda r: None if r is None else [{"x": x, "y": y} for x, y in hull_of([(p["x"], p["y"]) for p in r])])


def convex_hull(ring: str | Column) -> Column:
    """The hull of each ring, in Arrow batches: a sort and a stack, which no built-in expresses.

    It is marked so that the optimiser neither repeats it nor moves it into filters.
    """
    return F.pandas_udf(_hulls, RING).asNondeterministic()(ring)


def min_area_box(hull: str, compat: bool = False) -> Column:
    """The smallest rectangle around a hull, parallel to one of its edges.

    struct<cx, cy, sx, sy, yaw, area> with half sizes sx >= sy and yaw in [-pi, pi) after a quarter
    turn; the first edge wins ties.  Fewer than three points give a segment or a point.
    ``compat`` places a box whose sides were swapped as the older tool does: about swapped coordinates.
    """
    mean = f"named_struct('x', aggregate({hull}, 0D, (s, p) -> s + p.x) / size({hull}), 'y', aggregate({hull}, 0D, (s, p) -> s + p.y) / size({hull}))"
    local = f"""transform(sequence(0, size({hull}) - 1), i -> transform(array({hull}[(i + 1) % size({hull})]), q -> transform(array(atan2(q.y - {hull}[i].y, q.x - {hull}[i].x)), yaw -> named_struct('yaw', yaw,
        'u', transform({hull}, p -> (p.x - mu.x) * cos(yaw) + (p.y - mu.y) * sin(yaw)), 'v', transform({hull}, p -> (p.y - mu.y) * cos(yaw) - (p.x - mu.x) * sin(yaw))))[0])[0])"""
    best = f"array_min(transform({local}, (e, i) -> named_struct('area', (array_max(e.u) - array_min(e.u)) * (array_max(e.v) - array_min(e.v)), 'i', i, 'yaw', e.yaw, 'u0', array_min(e.u), 'u1', array_max(e.u), 'v0', array_min(e.v), 'v1', array_max(e.v))))"
    turned = "pmod(b.yaw + pi() / 2 + pi(), 2 * pi()) - pi()"
    swap = "(b.v1 - b.v0) > (b.u1 - b.u0)"
    u, v = "(b.u1 + b.u0) / 2", "(b.v1 + b.v0) / 2"
    x, y = f"mu.x + {u} * cos(b.yaw) - {v} * sin(b.yaw)", f"mu.y + {u} * sin(b.yaw) + {v} * cos(b.yaw)"
    if compat:
        x = f"case when {swap} then mu.x + {v} * cos({turned}) - {u} * sin({turned}) else {x} end"
        y = f"case when {swap} then mu.y + {v} * sin({turned}) + {u} * cos({turned}) else {y} end"
    full = f"""transform(array({mean}), mu -> transform(array({best}), b -> named_struct('cx', {x}, 'cy', {y}, 'sx', greatest(b.u1 - b.u0, b.v1 - b.v0) / 2, 'sy', least(b.u1 - b.u0, b.v1 - b.v0) / 2,
        'yaw', case when {swap} then {turned} else b.yaw end, 'area', b.area))[0])[0]"""
    p, q = f"{hull}[0]", f"{hull}[1]"
    segment = f"named_struct('cx', ({p}.x + {q}.x) / 2, 'cy', ({p}.y + {q}.y) / 2, 'sx', hypot({q}.x - {p}.x, {q}.y - {p}.y) / 2, 'sy', 0D, 'yaw', atan2({q}.y - {p}.y, {q}.x - {p}.x), 'area', 0D)"
    point = f"named_struct('cx', {p}.x, 'cy', {p}.y, 'sx', 0D, 'sy', 0D, 'yaw', 0D, 'area', 0D)"
    return F.expr(f"case when size({hull}) >= 3 then {full} when size({hull}) = 2 then {segment} when size({hull}) = 1 then {point} end")


def rect_corners(cx: Column, cy: Column, sx: Column, sy: Column, yaw: Column) -> Column:
    """Four corners, counter-clockwise from the lower left one of the unturned rectangle."""
    c, s = F.cos(yaw), F.sin(yaw)
    return F.array(*(F.struct((cx + i * sx * c - j * sy * s).alias("x"), (cy + i * sx * s + j * sy * c).alias("y")) for i, j in ((-1, -1), (1, -1), (1, 1), (-1, 1))))
