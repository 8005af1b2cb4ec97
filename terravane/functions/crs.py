"""Coordinate systems in closed form: geographic (4612, 6668, 4326), plane rectangular zones (2443-2461, 6669-6687), Web Mercator (3857) and earth-centred (4978)."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: GRS 80, the scale on the central meridian, and the zones' origins (latitude, longitude) in degrees.
A, INV_F, SCALE = 6378137.0, 298.257222101, 0.9999
ORIGINS = {
    1: (33, 129.5), 2: (33, 131), 3: (36, 132 + 1 / 6), 4: (33, 133.5), 5: (36, 134 + 1 / 3), 6: (36, 136), 7: (36, 137 + 1 / 6), 8: (36, 138.5), 9: (36, 139 + 5 / 6), 10: (40, 140 + 5 / 6),
    11: (44, 140.25), 12: (44, 142.25), 13: (44, 144.25), 14: (26, 142), 15: (26, 127.5), 16: (26, 124), 17: (26, 131), 18: (20, 136), 19: (26, 154),
}
GEOGRAPHIC = (4326, 4612, 6668, 6697)


def zone(epsg: int) -> int | None:
    for first in (2442, 6668):
        if 1 <= epsg - first <= 19:
            return epsg - first
    return None


def _series() -> tuple[float, list[float], list[float], list[float], list[float]]:
    """Krueger's series: n, A coefficients, alpha, beta, delta, to the fifth order of the third flattening."""
    n = 1 / (2 * INV_F - 1)
    a = [1 + n**2 / 4 + n**4 / 64, -3 / 2 * (n - n**3 / 8 - n**5 / 64), 15 / 16 * (n**2 - n**4 / 4), -35 / 48 * (n**3 - 5 / 16 * n**5), 315 / 512 * n**4, -693 / 1280 * n**5]
    alpha = [n / 2 - 2 / 3 * n**2 + 5 / 16 * n**3 + 41 / 180 * n**4 - 127 / 288 * n**5, 13 / 48 * n**2 - 3 / 5 * n**3 + 557 / 1440 * n**4 + 281 / 630 * n**5, 61 / 240 * n**3 - 103 / 140 * n**4 + 15061 / 26880 * n**5, 49561 / 161280 * n**4 - 179 / 168 * n**5, 34729 / 80640 * n**5]
    beta = [n / 2 - 2 / 3 * n**2 + 37 / 96 * n**3 - n**4 / 360 - 81 / 512 * n**5, n**2 / 48 + n**3 / 15 - 437 / 1440 * n**4 + 46 / 105 * n**5, 17 / 480 * n**3 - 37 / 840 * n**4 - 209 / 4480 * n**5, 4397 / 161280 * n**4 - 11 / 504 * n**5, 4583 / 161280 * n**5]
    delta = [2 * n - 2 / 3 * n**2 - 2 * n**3 + 116 / 45 * n**4 + 26 / 45 * n**5, 7 / 3 * n**2 - 8 / 5 * n**3 - 227 / 45 * n**4 + 2704 / 315 * n**5, 56 / 15 * n**3 - 136 / 35 * n**4 - 1262 / 105 * n**5, 4279 / 630 * n**4 - 332 / 35 * n**5, 4174 / 315 * n**5]
    return n, a, alpha, beta, delta


def to_plane(lon: np.ndarray, lat: np.ndarray, number: int) -> tuple[np.ndarray, np.ndarray]:
    """Easting and northing in a zone."""
    n, a, alpha, _, _ = _series()
    lat0, lon0 = (math.radians(v) for v in ORIGINS[number])
    phi, lam = np.radians(np.asarray(lat, float)), np.radians(np.asarray(lon, float)) - lon0
    e = 2 * math.sqrt(n) / (1 + n)
    t = np.sinh(np.arctanh(np.sin(phi)) - e * np.arctanh(e * np.sin(phi)))
    xi, eta = np.arctan2(t, np.cos(lam)), np.arctanh(np.sin(lam) / np.sqrt(1 + t * t))
    radius = SCALE * A / (1 + n)
    s0 = radius * (a[0] * lat0 + sum(a[j] * math.sin(2 * j * lat0) for j in range(1, 6)))
    north = radius * a[0] * (xi + sum(alpha[j - 1] * np.sin(2 * j * xi) * np.cosh(2 * j * eta) for j in range(1, 6))) - s0
    return radius * a[0] * (eta + sum(alpha[j - 1] * np.cos(2 * j * xi) * np.sinh(2 * j * eta) for j in range(1, 6))), north


def from_plane(east: np.ndarray, north: np.ndarray, number: int) -> tuple[np.ndarray, np.ndarray]:
    """Longitude and latitude of a zone's coordinates."""
    n, a, _, beta, delta = _series()
    lat0, lon0 = (math.radians(v) for v in ORIGINS[number])
    radius = SCALE * A / (1 + n)
    s0 = radius * (a[0] * lat0 + sum(a[j] * math.sin(2 * j * lat0) for j in range(1, 6)))
    xi, eta = (np.asarray(north, float) + s0) / (radius * a[0]), np.asarray(east, float) / (radius * a[0])
    x = xi - sum(beta[j - 1] * np.sin(2 * j * xi) * np.cosh(2 * j * eta) for j in range(1, 6))
    y = eta - sum(beta[j - 1] * np.cos(2 * j * xi) * np.sinh(2 * j * eta) for j in range(1, 6))
    chi = np.arcsin(np.sin(x) / np.cosh(y))
    return np.degrees(lon0 + np.arctan2(np.sinh(y), np.cos(x))), np.degrees(chi + sum(delta[j - 1] * np.sin(2 * j * chi) for j in range(1, 6)))


def convert(x: np.ndarray, y: np.ndarray, source: int, target: int) -> tuple[np.ndarray, np.ndarray]:
    if zone(source):
        lon, lat = from_plane(x, y, zone(source))
    elif source == 3857:
        lon, lat = np.degrees(np.asarray(x) / A), np.degrees(2 * np.arctan(np.exp(np.asarray(y) / A)) - math.pi / 2)
    elif source in GEOGRAPHIC:
        lon, lat = np.asarray(x, float), np.asarray(y, float)
    else:
        raise ValueError(f"EPSG {source} is not known")
    if zone(target):
        return to_plane(lon, lat, zone(target))
    if target == 3857:
        return A * np.radians(lon), A * np.log(np.tan(math.pi / 4 + np.radians(lat) / 2))
    if target in GEOGRAPHIC:
        return lon, lat
    raise ValueError(f"EPSG {target} is not known")


def reproject(vertices: DataFrame, source: int, target: int) -> DataFrame:
    """x and y of a table in another system, in Arrow batches."""
    convert(np.zeros(1), np.full(1, 1.0), source, target)

    @F.pandas_udf("struct<x: double, y: double>")
    def change(x: pd.Series, y: pd.Series) -> pd.DataFrame:
        a, b = convert(x.to_numpy(), y.to_numpy(), source, target)
        return pd.DataFrame({"x": a, "y": b})

    return vertices.withColumn("__p", change("x", "y")).withColumns({"x": F.col("__p.x"), "y": F.col("__p.y")}).drop("__p")


def ecef(lon: Column, lat: Column, height: Column) -> Column:
    """Earth-centred struct(x, y, z)."""
    e2 = (2 - 1 / INV_F) / INV_F
    s, c = F.sin(F.radians(lat)), F.cos(F.radians(lat))
    n = F.lit(A) / F.sqrt(1 - e2 * s * s)
    return F.struct(((n + height) * c * F.cos(F.radians(lon))).alias("x"), ((n + height) * c * F.sin(F.radians(lon))).alias("y"), ((n * (1 - e2) + height) * s).alias("z"))


def shift_by_grid(points: DataFrame, grid: DataFrame, third_mesh) -> DataFrame:
    """Datum shift: bilinear seconds of arc (mesh, db, dl at a third mesh's south-west corner), added to longitude x and latitude y; points off the grid stay."""
    lat_step, lon_step = 1 / 120, 1 / 80
    rows = points.withColumns({"__u": F.col("x") / lon_step, "__v": F.col("y") / lat_step})
    rows = rows.withColumns({"__fu": F.col("__u") - F.floor("__u"), "__fv": F.col("__v") - F.floor("__v")})
    for k, (i, j) in enumerate(((0, 0), (1, 0), (0, 1), (1, 1))):
        code = third_mesh((F.floor("__u") + i + 0.5) * lon_step, (F.floor("__v") + j + 0.5) * lat_step)
        rows = rows.withColumn(f"__m{k}", code).join(grid.select(F.col("mesh").alias(f"__m{k}"), F.col("db").alias(f"__b{k}"), F.col("dl").alias(f"__l{k}")), f"__m{k}", "left")
    mix = lambda c: (F.col(f"__{c}0") * (1 - F.col("__fu")) + F.col(f"__{c}1") * F.col("__fu")) * (1 - F.col("__fv")) + (F.col(f"__{c}2") * (1 - F.col("__fu")) + F.col(f"__{c}3") * F.col("__fu")) * F.col("__fv")
    return rows.withColumns({"x": F.coalesce(F.col("x") + mix("l") / 3600, F.col("x")), "y": F.coalesce(F.col("y") + mix("b") / 3600, F.col("y"))}).select(points.columns)
