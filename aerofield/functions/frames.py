"""Frames, map projections and mesh codes as column expressions."""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import Protocol

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# Radius of the spherical Earth of Web Mercator and of the query box, metres.
EARTH_RADIUS = 6378137.0
# WGS84 / GRS80 ellipsoid and the plane rectangular system 6677.
FLATTENING_WGS84 = 1 / 298.257223563
FLATTENING_GRS80 = 1 / 298.257222101
TM_LAT0, TM_LON0, TM_SCALE = 36.0, 139.8333333333333, 0.9999
# Fixed value: metres per pixel of a 256-pixel Web Mercator world at zoom 0.
INITIAL_RESOLUTION = 156543.03392804097


def xyz(x: Column, y: Column, z: Column) -> Column:
    return F.struct(x.alias("x"), y.alias("y"), z.alias("z"))


def enu_to_ros(x: Column, y: Column, z: Column) -> Column:
    """East, north, up to north, west, up."""
    return xyz(y, -x, z)


def ros_to_enu(x: Column, y: Column, z: Column) -> Column:
    return xyz(-y, x, z)


def enu_to_mjcf(x: Column, y: Column, z: Column) -> Column:
    return xyz(y, -x, z)


def ros_box_to_map(xmin: Column, ymin: Column, xmax: Column, ymax: Column) -> Column:
    """A box in the ROS frame as struct<xmin, ymin, xmax, ymax> on the map."""
    return F.struct((-ymax).alias("xmin"), xmin.alias("ymin"), (-ymin).alias("xmax"), xmax.alias("ymax"))


class Projection(Protocol):
    """What a map projection offers."""

    def forward(self, lon: Column, lat: Column) -> tuple[Column, Column]: ...

    def inverse(self, x: Column, y: Column) -> tuple[Column, Column]: ...


class WebMercator:
    def forward(self, lon: Column, lat: Column) -> tuple[Column, Column]:
        return F.radians(lon) * EARTH_RADIUS, F.log(F.tan(F.lit(math.pi / 4) + F.radians(lat) / 2)) * EARTH_RADIUS

    def inverse(self, x: Column, y: Column) -> tuple[Column, Column]:
        return F.degrees(x / EARTH_RADIUS), F.degrees(2 * F.atan(F.exp(y / EARTH_RADIUS)) - math.pi / 2)


class TransverseMercator:
    """Krueger's series of the sixth order in the third flattening; better than a micrometre in its zone."""

    def __init__(self, lat0: float = TM_LAT0, lon0: float = TM_LON0, scale: float = TM_SCALE, flattening: float = FLATTENING_GRS80) -> None:
        n = flattening / (2 - flattening)
        self.n, self.lon0, self.e = n, lon0, 2 * math.sqrt(n) / (1 + n)
        self.a = scale * EARTH_RADIUS / (1 + n) * (1 + n**2 / 4 + n**4 / 64)
        # fixed values: coefficients of the series
        self.alpha = [n / 2 - 2 * n**2 / 3 + 5 * n**3 / 16 + 41 * n**4 / 180, 13 * n**2 / 48 - 3 * n**3 / 5 + 557 * n**4 / 1440, 61 * n**3 / 240 - 103 * n**4 / 140, 49561 * n**4 / 161280]
        self.beta = [n / 2 - 2 * n**2 / 3 + 37 * n**3 / 96 - n**4 / 360, n**2 / 48 + n**3 / 15 - 437 * n**4 / 1440, 17 * n**3 / 480 - 37 * n**4 / 840, 4397 * n**4 / 161280]
        self.delta = [2 * n - 2 * n**2 / 3 - 2 * n**3 + 116 * n**4 / 45, 7 * n**2 / 3 - 8 * n**3 / 5 - 227 * n**4 / 45, 56 * n**3 / 15 - 136 * n**4 / 35, 4279 * n**4 / 630]
        s = math.sin(math.radians(lat0))
        t = math.sinh(math.atanh(s) - self.e * math.atanh(self.e * s))
        xi = math.atan(t)
        self.y0 = self.a * (xi + sum(a * math.sin(2 * (j + 1) * xi) for j, a in enumerate(self.alpha)))

    def forward(self, lon: Column, lat: Column) -> tuple[Column, Column]:
        s, d = F.sin(F.radians(lat)), F.radians(lon - self.lon0)
        t = F.sinh(F.atanh(s) - self.e * F.atanh(self.e * s))
        xi, eta = F.atan2(t, F.cos(d)), F.atanh(F.sin(d) / F.sqrt(1 + t * t))
        x, y = eta, xi
        for j, a in enumerate(self.alpha):
            k = 2.0 * (j + 1)
            x = x + a * F.cos(k * xi) * F.sinh(k * eta)
            y = y + a * F.sin(k * xi) * F.cosh(k * eta)
        return x * self.a, y * self.a - self.y0

    def inverse(self, x: Column, y: Column) -> tuple[Column, Column]:
        xi0, eta0 = (y + self.y0) / self.a, x / self.a
        xi, eta = xi0, eta0
        for j, b in enumerate(self.beta):
            k = 2.0 * (j + 1)
            xi = xi - b * F.sin(k * xi0) * F.cosh(k * eta0)
            eta = eta - b * F.cos(k * xi0) * F.sinh(k * eta0)
        chi = F.asin(F.sin(xi) / F.cosh(eta))
        lat = chi
        for j, d in enumerate(self.delta):
            lat = lat + d * F.sin(2.0 * (j + 1) * chi)
        return F.lit(self.lon0) + F.degrees(F.atan2(F.sinh(eta), F.cos(xi))), F.degrees(lat)


def geodesic(lat1: np.ndarray, lon1: np.ndarray, lat2: np.ndarray, lon2: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distance and azimuth on the WGS84 ellipsoid, by Vincenty's iteration."""
    f = FLATTENING_WGS84
    b = EARTH_RADIUS * (1 - f)
    u1, u2 = np.arctan((1 - f) * np.tan(np.radians(lat1))), np.arctan((1 - f) * np.tan(np.radians(lat2)))
    big = np.radians(lon2 - lon1)
    lam = big
    for _ in range(60):
        sl, cl = np.sin(lam), np.cos(lam)
        p, q = np.cos(u2) * sl, np.cos(u1) * np.sin(u2) - np.sin(u1) * np.cos(u2) * cl
        ss = np.hypot(p, q)
        cs = np.sin(u1) * np.sin(u2) + np.cos(u1) * np.cos(u2) * cl
        sigma = np.arctan2(ss, cs)
        sa = np.divide(np.cos(u1) * np.cos(u2) * sl, ss, out=np.zeros_like(ss), where=ss > 0)
        c2 = 1 - sa**2
        cm = np.divide(-2 * np.sin(u1) * np.sin(u2), c2, out=np.zeros_like(c2), where=c2 > 0) + cs
        c = f / 16 * c2 * (4 + f * (4 - 3 * c2))
        new = big + (1 - c) * f * sa * (sigma + c * ss * (cm + c * cs * (2 * cm**2 - 1)))
        done = np.all(np.abs(new - lam) < 1e-13)
        lam = new
        if done:
            break
    k = c2 * (EARTH_RADIUS**2 - b**2) / b**2
    big_a = 1 + k / 16384 * (4096 + k * (-768 + k * (320 - 175 * k)))
    big_b = k / 1024 * (256 + k * (-128 + k * (74 - 47 * k)))
    ds = big_b * ss * (cm + big_b / 4 * (cs * (2 * cm**2 - 1) - big_b / 6 * cm * (4 * ss**2 - 3) * (4 * cm**2 - 3)))
    return b * big_a * (sigma - ds), np.arctan2(p, q)


def azimuthal_equidistant(lat0: float, lon0: float):
    """A column function (lon, lat) -> struct<x, y> of the local equidistant map; it iterates, so it runs in Arrow batches."""

    @F.pandas_udf("x double, y double")
    def project(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for lon, lat in parts:
            s, a = geodesic(np.full(len(lat), lat0), np.full(len(lon), lon0), lat.to_numpy(float), lon.to_numpy(float))
            yield pd.DataFrame({"x": s * np.sin(a), "y": s * np.cos(a)})

    return project


def geodesic_end(lat1: np.ndarray, lon1: np.ndarray, azimuth: np.ndarray, s: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where one gets to on the WGS84 ellipsoid by a distance in a direction, by Vincenty's direct iteration."""
    f = FLATTENING_WGS84
    b = EARTH_RADIUS * (1 - f)
    u1 = np.arctan((1 - f) * np.tan(np.radians(lat1)))
    sigma1 = np.arctan2(np.tan(u1), np.cos(azimuth))
    sa = np.cos(u1) * np.sin(azimuth)
    c2 = 1 - sa**2
    k = c2 * (EARTH_RADIUS**2 - b**2) / b**2
    big_a = 1 + k / 16384 * (4096 + k * (-768 + k * (320 - 175 * k)))
    big_b = k / 1024 * (256 + k * (-128 + k * (74 - 47 * k)))
    sigma = s / (b * big_a)
    for _ in range(60):
        cm, ss, cs = np.cos(2 * sigma1 + sigma), np.sin(sigma), np.cos(sigma)
        new = s / (b * big_a) + big_b * ss * (cm + big_b / 4 * (cs * (2 * cm**2 - 1) - big_b / 6 * cm * (4 * ss**2 - 3) * (4 * cm**2 - 3)))
        done = np.all(np.abs(new - sigma) < 1e-14)
        sigma = new
        if done:
            break
    cm, ss, cs = np.cos(2 * sigma1 + sigma), np.sin(sigma), np.cos(sigma)
    tmp = np.sin(u1) * ss - np.cos(u1) * cs * np.cos(azimuth)
    lat = np.arctan2(np.sin(u1) * cs + np.cos(u1) * ss * np.cos(azimuth), (1 - f) * np.hypot(sa, tmp))
    lam = np.arctan2(ss * np.sin(azimuth), np.cos(u1) * cs - np.sin(u1) * ss * np.cos(azimuth))
    c = f / 16 * c2 * (4 + f * (4 - 3 * c2))
    return np.degrees(lat), lon1 + np.degrees(lam - (1 - c) * f * sa * (sigma + c * ss * (cm + c * cs * (2 * cm**2 - 1))))


def azimuthal_equidistant_inverse(lat0: float, lon0: float):
    """A column function (x, y) -> struct<lon, lat> from the local equidistant map."""

    @F.pandas_udf("lon double, lat double")
    def project(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for x, y in parts:
            x, y = x.to_numpy(float), y.to_numpy(float)
            lat, lon = geodesic_end(np.full(len(x), lat0), np.full(len(x), lon0), np.arctan2(x, y), np.hypot(x, y))
            yield pd.DataFrame({"lon": lon, "lat": lat})

    return project


#: Map projections by their codes.
PROJECTIONS = {"EPSG:3857": WebMercator, "EPSG:6677": TransverseMercator}


def projection(code: str) -> Projection:
    """The projection of a code such as "EPSG:6677"; an unknown one raises."""
    key = f"EPSG:{code}".upper().replace("EPSG:EPSG:", "EPSG:")
    if key not in PROJECTIONS:
        raise ValueError(f"no projection for {code}: there are {', '.join(PROJECTIONS)}")
    return PROJECTIONS[key]()


def enu_to_lonlat(x: Column, y: Column, lat0: float, lon0: float, dx: float = 0.0, dy: float = 0.0, projection: Projection | None = None) -> tuple[Column, Column]:
    """Metres east and north of an origin, plus an offset, as (lon, lat)."""
    p = projection or WebMercator()
    x0, y0 = p.forward(F.lit(lon0), F.lit(lat0))
    return p.inverse(x0 + x + dx, y0 + y + dy)


def lonlat_to_enu(lon: Column, lat: Column, lat0: float, lon0: float, dx: float = 0.0, dy: float = 0.0, projection: Projection | None = None) -> tuple[Column, Column]:
    p = projection or WebMercator()
    x0, y0 = p.forward(F.lit(lon0), F.lit(lat0))
    x, y = p.forward(lon, lat)
    return x - x0 - dx, y - y0 - dy


def box_around(lat: Column, lon: Column, ns_m: Column, ew_m: Column) -> Column:
    """struct<min_lat, max_lat, min_lon, max_lon> of a centre and metres to each side."""
    d_lat = F.degrees(ns_m / EARTH_RADIUS)
    d_lon = F.degrees(ew_m / (EARTH_RADIUS * F.cos(F.radians(lat))))
    return F.struct((lat - d_lat).alias("min_lat"), (lat + d_lat).alias("max_lat"), (lon - d_lon).alias("min_lon"), (lon + d_lon).alias("max_lon"))


def mesh_box(code: Column, strict: bool = False) -> Column:
    """struct<min_lat, max_lat, min_lon, max_lon> of a mesh code of 6 or 8 digits (8 only if ``strict``); null for others.

    Digits 1-2 are 1.5 times the latitude, 3-4 the longitude less 100, 5-6 eighths and 7-8 tenths of those.
    """
    code = F.trim(code)
    digit = lambda at, n=1: F.try_to_number(F.substring(code, at, n), F.lit("9" * n)).cast("double")
    lat = digit(1, 2) * 2 / 3 + digit(5) / 12
    lon = digit(3, 2) + 100 + digit(6) / 8
    fine = F.length(code) == 8
    lat = F.when(fine, lat + digit(7) / 120).otherwise(lat)
    lon = F.when(fine, lon + digit(8) / 80).otherwise(lon)
    d_lat, d_lon = F.when(fine, 1 / 120).otherwise(1 / 12), F.when(fine, 1 / 80).otherwise(1 / 8)
    ok = code.rlike("^[0-9]{8}$") if strict else code.rlike("^([0-9]{6}|[0-9]{8})$")
    return F.when(ok, F.struct(lat.alias("min_lat"), (lat + d_lat).alias("max_lat"), lon.alias("min_lon"), (lon + d_lon).alias("max_lon")))


def auto_zoom(cell_m: Column, pixels: int = 32, low: int = 0, high: int = 22) -> Column:
    """The zoom at which a cell has about ``pixels`` pixels, rounding halves to even."""
    target = F.greatest(F.lit(1e-9), cell_m / max(1, pixels))
    return F.least(F.lit(high), F.greatest(F.lit(low), F.bround(F.log2(F.lit(INITIAL_RESOLUTION) / target)).cast("int")))


def cap_zoom(width_m: Column, zoom: Column, max_px: int = 8192) -> Column:
    """The largest zoom up to ``zoom`` at which the width has ``max_px`` pixels at most, at least 0."""
    over = F.log2(width_m * F.pow(F.lit(2.0), zoom) / INITIAL_RESOLUTION / max_px)
    return F.when(width_m > 0, F.greatest(F.least(F.lit(0), zoom), F.least(zoom, zoom - F.ceil(F.greatest(over, F.lit(0.0))).cast("int")))).otherwise(zoom)


def boxes_touch_lonlat(a: Column, b: Column) -> Column:
    """Closed overlap of struct<min_lat, max_lat, min_lon, max_lon> boxes."""
    return (a["max_lat"] >= b["min_lat"]) & (a["min_lat"] <= b["max_lat"]) & (a["max_lon"] >= b["min_lon"]) & (a["min_lon"] <= b["max_lon"])
