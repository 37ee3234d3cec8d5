"""ETRS89 / LAEA Europe (EPSG:3035) as plain column arithmetic: ellipsoidal formulas of Snyder (USGS PP 1395)."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

A, FLAT = 6378137.0, 1 / 298.257222101
E2 = 2 * FLAT - FLAT * FLAT
E = math.sqrt(E2)
LAT0, LON0, FALSE_EAST, FALSE_NORTH = math.radians(52), math.radians(10), 4321000.0, 3210000.0


def _q(s: float) -> float:
    return (1 - E2) * (s / (1 - E2 * s * s) - math.log((1 - E * s) / (1 + E * s)) / (2 * E))


QP = _q(1.0)
BETA0 = math.asin(_q(math.sin(LAT0)) / QP)
RQ = A * math.sqrt(QP / 2)
D = A * math.cos(LAT0) / (math.sqrt(1 - E2 * math.sin(LAT0) ** 2) * RQ * math.cos(BETA0))
SIN_B0, COS_B0 = math.sin(BETA0), math.cos(BETA0)
SERIES = (E2 / 3 + 31 * E2**2 / 180 + 517 * E2**3 / 5040, 23 * E2**2 / 360 + 251 * E2**3 / 3780, 761 * E2**3 / 45360)


def _finite(x: Column) -> Column:
    return F.when(~F.isnan(x) & (F.abs(x) < float("inf")), x)


def _let(value: Column, use) -> Column:
    """use(value) with the value named once: the expression stays small when the optimizer moves it about."""
    return F.element_at(F.transform(F.array(value), use), 1)


def project_laea(lon: Column, lat: Column) -> tuple[Column, Column]:
    """(x, y) in metres of degrees; null where they are not finite."""

    def beta(s: Column) -> Column:
        q = (1 - E2) * (s / (1 - E2 * s * s) - F.ln((1 - E * s) / (1 + E * s)) / (2 * E))
        return F.asin(F.greatest(F.least(q / QP, F.lit(1.0)), F.lit(-1.0)))

    def place(p: Column) -> Column:
        b, t = p["b"], p["t"]
        r = RQ * F.sqrt(2 / (1 + SIN_B0 * F.sin(b) + COS_B0 * F.cos(b) * F.cos(t)))
        x = FALSE_EAST + r * D * F.cos(b) * F.sin(t)
        y = FALSE_NORTH + (r / D) * (COS_B0 * F.sin(b) - SIN_B0 * F.cos(b) * F.cos(t))
        return F.struct(x.alias("x"), y.alias("y"))

    at = _let(F.struct(_let(F.sin(F.radians(lat)), beta).alias("b"), (F.radians(lon) - LON0).alias("t")), place)
    return _let(at["x"], _finite), _let(at["y"], _finite)


def unproject_laea(x: Column, y: Column) -> tuple[Column, Column]:
    """(lon, lat) in degrees of metres."""

    def angles(p: Column) -> Column:
        rho = F.sqrt(p["u"] * p["u"] + p["v"] * p["v"])
        return F.struct(p["u"].alias("u"), p["v"].alias("v"), rho.alias("r"), (2 * F.asin(rho / (2 * RQ))).alias("c"))

    def place(p: Column) -> Column:
        u, v, r, c = (p[n] for n in "uvrc")
        b = F.asin(F.cos(c) * SIN_B0 + v * F.sin(c) * COS_B0 / r)
        lon = LON0 + F.atan2(u * F.sin(c), r * COS_B0 * F.cos(c) - v * SIN_B0 * F.sin(c))
        lat = _let(b, lambda q: q + SERIES[0] * F.sin(2 * q) + SERIES[1] * F.sin(4 * q) + SERIES[2] * F.sin(6 * q))
        here = r == 0
        return F.struct(F.when(here, math.degrees(LON0)).otherwise(F.degrees(lon)).alias("lon"), F.when(here, math.degrees(LAT0)).otherwise(F.degrees(lat)).alias("lat"))

    at = _let(_let(F.struct(((x - FALSE_EAST) / D).alias("u"), (D * (y - FALSE_NORTH)).alias("v")), angles), place)
    return at["lon"], at["lat"]
