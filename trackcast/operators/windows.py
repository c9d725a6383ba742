"""Ordered analytics that stay skew-safe.

``gap_hours`` computes the previous timestamp per station inside
``(station, day)`` partitions and stitches day boundaries through a small
per-day table, so a station holding a third of all rows still spreads over
its days. ``top_k_per_group`` is two-stage (salted partial top-k, then the
final top-k over at most ``k * salts`` rows per group).
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trackcast.functions.timefns import US_PER_HOUR


def gap_hours(df: DataFrame, *, by: str = "station_code", ts: str = "timestamp", max_gap_hours: float = 6.0) -> DataFrame:
    """Hours since the previous observation of the same ``by`` value and
    whether the gap exceeds ``max_gap_hours`` (first observation: null)."""
    d = df.withColumn("_day", F.to_date(ts))
    inner = d.withColumn("_prev", F.lag(ts).over(Window.partitionBy(by, "_day").orderBy(ts)))
    last = d.groupBy(by, "_day").agg(F.max(ts).alias("_last"))
    last = last.withColumn("_prev_day_last", F.lag("_last").over(Window.partitionBy(by).orderBy("_day")))
    j = inner.join(last.select(by, "_day", "_prev_day_last"), [by, "_day"], "left")
    prev = F.coalesce(F.col("_prev"), F.col("_prev_day_last"))
    gap = F.timestamp_diff("MICROSECOND", prev, F.col(ts)) / F.lit(float(US_PER_HOUR))
    return j.select(*df.columns, prev.alias("prev_timestamp"), gap.alias("gap_hours"),
                    F.coalesce(gap > max_gap_hours, F.lit(False)).alias("gap_exceeded"))


def top_k_per_group(df: DataFrame, *, group: Sequence[str], order: Sequence[str], k: int, salts: int = 64) -> DataFrame:
    """First ``k`` rows per group by ``order`` (ascending); deterministic when
    ``order`` is unique within a group."""
    g = list(group)
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(*order), F.lit(salts)))
    w1 = Window.partitionBy(*g, "_salt").orderBy(*order)
    part = salted.withColumn("_r", F.row_number().over(w1)).where(F.col("_r") <= k).drop("_r", "_salt")
    w2 = Window.partitionBy(*g).orderBy(*order)
    return part.withColumn("rank", F.row_number().over(w2)).where(F.col("rank") <= k)


def latest_n(df: DataFrame, *, order_by: str, n: int) -> DataFrame:
    """Newest ``n`` rows (distributed top-k, TakeOrderedAndProject)."""
    return df.orderBy(F.col(order_by).desc()).limit(n)
