"""Distances between two coordinates, in km."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

EARTH_RADIUS_KM = 6371.0088
WGS84_A_KM = 6378.137
WGS84_F = 1 / 298.257223563


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance on the mean sphere; stays inside code generation."""
    dlat, dlon = F.radians(lat2 - lat1), F.radians(lon2 - lon1)
    a = F.pow(F.sin(dlat / 2), 2) + (
        F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(dlon / 2), 2)
    )
    # Not least(): it ignores NULL and would place an unknown point opposite.
    return 2 * EARTH_RADIUS_KM * F.asin(F.when(a > 1, F.lit(1.0)).otherwise(F.sqrt(a)))


def inverse_geodesic(lat1, lon1, lat2, lon2, max_iter: int = 200, tol: float = 1e-12):
    """Distance in km on WGS-84 for whole arrays, NaN where an input is NaN.

    Vincenty's inverse formula; where its iteration does not settle (points almost
    opposite each other), the departing azimuth is found by bisection instead.
    """
    lat1, lon1, lat2, lon2 = (np.asarray(x, dtype="float64") for x in (lat1, lon1, lat2, lon2))
    f = WGS84_F
    u1 = np.arctan((1 - f) * np.tan(np.radians(lat1)))
    u2 = np.arctan((1 - f) * np.tan(np.radians(lat2)))
    su1, cu1, su2, cu2 = np.sin(u1), np.cos(u1), np.sin(u2), np.cos(u2)
    diff = np.radians((lon2 - lon1 + 180.0) % 360.0 - 180.0)

    lam = diff.copy()
    settled = np.zeros(lam.shape, dtype=bool)
    with np.errstate(all="ignore"):
        for _ in range(max_iter):
            sl, cl = np.sin(lam), np.cos(lam)
            ss = np.hypot(cu2 * sl, cu1 * su2 - su1 * cu2 * cl)
            cs = su1 * su2 + cu1 * cu2 * cl
            sigma = np.arctan2(ss, cs)
            sin_alpha = np.where(ss == 0, 0.0, cu1 * cu2 * sl / ss)
            cos2a = 1 - sin_alpha**2
            c2m = np.where(cos2a < 1e-15, 0.0, cs - 2 * su1 * su2 / cos2a)
            c = f / 16 * cos2a * (4 + f * (4 - 3 * cos2a))
            step = diff + (1 - c) * f * sin_alpha * (
                sigma + c * ss * (c2m + c * cs * (2 * c2m**2 - 1))
            )
            settled = np.abs(step - lam) < tol
            lam = step
            if np.all(settled | np.isnan(step)):
                break
        km = _arc_km(sigma, ss, cs, c2m, cos2a)
        opposite = _opposite_km(u1, u2, diff)
    return np.where(settled & (np.abs(lam) <= np.pi), km, opposite)


def _arc_km(sigma, ss, cs, c2m, cos2a):
    """Length of a geodesic's arc `sigma` on the auxiliary sphere."""
    b = WGS84_A_KM * (1 - WGS84_F)
    usq = cos2a * (WGS84_A_KM**2 - b**2) / b**2
    big_a = 1 + usq / 16384 * (4096 + usq * (usq * (320 - 175 * usq) - 768))
    big_b = usq / 1024 * (256 + usq * (usq * (74 - 47 * usq) - 128))
    d_sigma = big_b * ss * (
        c2m
        + big_b / 4 * (cs * (2 * c2m**2 - 1)
                       - big_b / 6 * c2m * (4 * ss**2 - 3) * (4 * c2m**2 - 3))
    )
    return b * big_a * (sigma - d_sigma)


def _opposite_km(u1, u2, diff, steps: int = 64):
    """Distance from reduced latitudes and difference of longitudes, by bisection.

    The end nearer a pole is the start, turned to the south. From there the longitude
    reached at the other latitude rises with the azimuth, so halving finds the azimuth.
    """
    f = WGS84_F
    far, near = np.where(np.abs(u1) >= np.abs(u2), u1, u2), np.where(np.abs(u1) >= np.abs(u2), u2, u1)
    turn = np.where(far > 0, -1.0, 1.0)
    # Not exactly on the equator, where no azimuth would be told from its mirror image.
    start, end, goal = np.minimum(turn * far, -1e-200), turn * near, np.abs(diff)
    s1, c1, s2, c2 = np.sin(start), np.cos(start), np.sin(end), np.cos(end)

    def along(azimuth):
        sin_alpha, north = np.sin(azimuth) * c1, np.cos(azimuth) * c1
        # Never negative: the end is nearer the equator.
        arrives = np.sqrt(np.maximum(north**2 + (s1 - s2) * (s1 + s2), 0))
        first, last = np.arctan2(s1, north), np.arctan2(s2, arrives)
        turned = np.arctan2(sin_alpha * s2, arrives) - np.arctan2(sin_alpha * s1, north)
        sigma, c2m, cos2a = last - first, np.cos(first + last), 1 - sin_alpha**2
        ss, cs = np.sin(sigma), np.cos(sigma)
        c = f / 16 * cos2a * (4 + f * (4 - 3 * cos2a))
        longitude = turned - (1 - c) * f * sin_alpha * (
            sigma + c * ss * (c2m + c * cs * (2 * c2m**2 - 1))
        )
        return longitude, _arc_km(sigma, ss, cs, c2m, cos2a)

    low, high = np.zeros_like(goal), np.full_like(goal, np.pi)
    for _ in range(steps):
        middle = (low + high) / 2
        short = along(middle)[0] < goal
        low, high = np.where(short, middle, low), np.where(short, high, middle)
    return along((low + high) / 2)[1]


@F.pandas_udf(T.DoubleType())
def _inverse_geodesic_udf(
    lat1: pd.Series, lon1: pd.Series, lat2: pd.Series, lon2: pd.Series
) -> pd.Series:
    km = pd.Series(inverse_geodesic(lat1, lon1, lat2, lon2))
    return km.astype(object).where(km.notna(), None)


_inverse_geodesic_udf = _inverse_geodesic_udf.asNondeterministic()


def geodesic_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Ellipsoid distance; NULL where a coordinate is.

    The only Python on any path: Arrow batches over the few distinct city pairs. Marked as not
    deterministic, so that a filter on the result does not compute it a second time.
    """
    return _inverse_geodesic_udf(lat1, lon1, lat2, lon2)
