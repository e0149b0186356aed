"""Vehicle tracks: distance between consecutive fixes and length per vehicle and day."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from millrace.functions.shipping import by_value
from millrace.operators.ordered import with_neighbours

# WGS-84 half axis in metres and flattening; mean earth radius.
HALF_AXIS = 6378137.0
FLATTENING = 1 / 298.257223563
MEAN_RADIUS = 6371008.8


def haversine(lon1: Column, lat1: Column, lon2: Column, lat2: Column) -> Column:
    """Great-circle metres, JVM-side."""
    dlat, dlon = F.radians(lat2 - lat1), F.radians(lon2 - lon1)
    h = F.pow(F.sin(dlat / 2), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(dlon / 2), 2)
    return 2 * MEAN_RADIUS * F.asin(F.sqrt(F.least(h, F.lit(1.0))))


@F.pandas_udf(T.DoubleType())
def geodesic(lon1: pd.Series, lat1: pd.Series, lon2: pd.Series, lat2: pd.Series) -> pd.Series:
    """Ellipsoid metres by Vincenty's inverse formula on whole Arrow batches.

    Eight significant digits; NaN where the iteration does not converge.
    """
    polar = HALF_AXIS * (1 - FLATTENING)
    x1, y1, x2, y2 = (np.radians(s.to_numpy(float)) for s in (lon1, lat1, lon2, lat2))
    r1, r2 = (np.arctan((1 - FLATTENING) * np.tan(y)) for y in (y1, y2))
    s1, c1, s2, c2 = np.sin(r1), np.cos(r1), np.sin(r2), np.cos(r2)
    def arc(lam: np.ndarray) -> tuple[np.ndarray, ...]:
        """Sine, cosine and length of the arc on the auxiliary sphere, and its direction and middle, for a difference of longitudes."""
        sl, cl = np.sin(lam), np.cos(lam)
        ss = np.hypot(c2 * sl, c1 * s2 - s1 * c2 * cl)
        cs = s1 * s2 + c1 * c2 * cl
        sa = np.where(ss == 0, 0.0, c1 * c2 * sl / ss)
        ca2 = 1 - sa**2
        return ss, cs, np.arctan2(ss, cs), sa, ca2, np.where(ca2 == 0, 0.0, cs - 2 * s1 * s2 / ca2)

    lam, moving = x2 - x1, np.ones(len(x1), bool)
    with np.errstate(all="ignore"):
        for _ in range(100):
            ss, cs, sig, sa, ca2, mid = arc(lam)
            k = FLATTENING / 16 * ca2 * (4 + FLATTENING * (4 - 3 * ca2))
            new = (x2 - x1) + (1 - k) * FLATTENING * sa * (sig + k * ss * (mid + k * cs * (2 * mid**2 - 1)))
            moving = np.abs(new - lam) > 1e-12
            lam = new
            if not moving.any():
                break
        ss, cs, sig, sa, ca2, mid = arc(lam)
        u2 = ca2 * (HALF_AXIS**2 - polar**2) / polar**2
        big = 1 + u2 / 16384 * (4096 + u2 * (u2 * (320 - 175 * u2) - 768))
        small = u2 / 1024 * (256 + u2 * (u2 * (74 - 47 * u2) - 128))
        shift = small * ss * (mid + small / 4 * (cs * (2 * mid**2 - 1) - small / 6 * mid * (4 * ss**2 - 3) * (4 * mid**2 - 3)))
        metres = np.where(moving, np.nan, np.where(ss == 0, 0.0, polar * big * (sig - shift)))
    with np.errstate(all="ignore"):
        scale = 10.0 ** (7 - np.floor(np.log10(np.where(metres > 0, metres, 1.0))))
    return pd.Series(np.round(metres * scale) / scale)


def segments(fixes: DataFrame, vehicle: str = "vehicle", time: str = "ts", ties: tuple[str, ...] = ("event_id",),
             exact: bool = False) -> DataFrame:
    """Each fix with the metres from the fix before it (null for a vehicle's first fix)."""
    rows = with_neighbours(fixes, [vehicle], time, list(ties), ["lon", "lat"])
    ends = (F.col("prev")["lon"], F.col("prev")["lat"], F.col("lon"), F.col("lat"))
    metres = geodesic(*ends) if exact else haversine(*ends)
    return rows.withColumn("metres", F.when(F.col("prev").isNotNull(), metres)).drop("prev", "next")


def track_length(fixes: DataFrame, vehicle: str = "vehicle", exact: bool = False) -> DataFrame:
    """Metres and fixes per vehicle and day."""
    return segments(fixes, vehicle, exact=exact).groupBy(vehicle, F.to_date("ts").alias("dt")).agg(
        F.count(F.lit(1)).alias("fixes"), F.sum(F.coalesce("metres", F.lit(0.0))).alias("metres"))


by_value(__name__)
