"""Station set operations and overlaps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def codes(df: DataFrame, col: str = "station_code") -> DataFrame:
    return df.where(F.col(col).isNotNull()).select(F.col(col).alias("station_code")).distinct()


def station_overlap(a: DataFrame, b: DataFrame) -> DataFrame:
    """Every code of either side with presence flags (full outer join of
    the two distinct code sets)."""
    x = codes(a).withColumn("in_left", F.lit(True))
    y = codes(b).withColumn("in_right", F.lit(True))
    return x.join(y, "station_code", "full_outer").select(
        "station_code", F.coalesce("in_left", F.lit(False)).alias("in_left"),
        F.coalesce("in_right", F.lit(False)).alias("in_right"))


def stations_union(a: DataFrame, b: DataFrame) -> DataFrame:
    """Distinct codes of both sides."""
    return codes(a).union(codes(b)).distinct()


def stations_intersect(a: DataFrame, b: DataFrame) -> DataFrame:
    """Codes present on both sides."""
    return codes(a).intersect(codes(b))


def stations_except(a: DataFrame, b: DataFrame) -> DataFrame:
    """U4: codes of the union missing from at least one side."""
    return stations_union(a, b).subtract(stations_intersect(a, b))


def concat_frames(*frames: DataFrame) -> DataFrame:
    """Stack frames by column name, missing columns as nulls."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out
