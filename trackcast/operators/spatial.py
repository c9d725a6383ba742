"""Point-in-polygon filter (D3) with built-in higher-order functions.

The polygon is a parameter (a closed ring of (x=lon, y=lat) vertices) shipped
as a literal array with the plan; each row counts ray crossings over the
edges with ``aggregate`` -- no join, no UDF. Rows without coordinates are
outside (deviation N18).
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# FIXED VALUES: example region ring (lon, lat), used by the registered query.
EXAMPLE_REGION = ((8.5, 45.0), (9.6, 44.9), (10.9, 45.3), (10.6, 46.3), (9.2, 46.5), (8.7, 46.0))


def inside(lon: Column, lat: Column, ring: Sequence[tuple[float, float]]) -> Column:
    n = len(ring)
    xs = F.array(*[F.lit(float(p[0])) for p in ring])
    ys = F.array(*[F.lit(float(p[1])) for p in ring])

    def crossing(acc, i):
        j = F.when(i == 0, F.lit(n - 1)).otherwise(i - 1)
        xi, yi = F.get(xs, i), F.get(ys, i)
        xj, yj = F.get(xs, j), F.get(ys, j)
        hit = ((yi > lat) != (yj > lat)) & (lon < (xj - xi) * (lat - yi) / (yj - yi) + xi)
        return acc + F.when(hit, F.lit(1)).otherwise(F.lit(0))

    count = F.aggregate(F.sequence(F.lit(0), F.lit(n - 1)), F.lit(0), crossing)
    return F.coalesce(lon.isNotNull() & lat.isNotNull() & (count % 2 == 1), F.lit(False))


def points_in_region(df: DataFrame, ring: Sequence[tuple[float, float]] = EXAMPLE_REGION, *,
                     lon: str = "longitude", lat: str = "latitude") -> DataFrame:
    return df.where(inside(F.col(lon), F.col(lat), ring))


def ring_edges_sql(ring: Sequence[tuple[float, float]] = EXAMPLE_REGION) -> str:
    """The ring as a SQL VALUES list of edges (x1, y1, x2, y2) for the oracle."""
    n = len(ring)
    rows = []
    for i in range(n):
        xi, yi = ring[i]
        xj, yj = ring[i - 1]
        rows.append(f"({xi}e0, {yi}e0, {xj}e0, {yj}e0)")
    return "values " + ", ".join(rows)
