"""Deduplication and duplicate detection.

Keep-one dedup is a grouped ``max_by`` over the whole row, not a window: the
aggregate is combined map-side, so even a key holding a third of all rows
reaches the shuffle as at most one row per map task.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def completeness(df: DataFrame, cols: Sequence[str] | None = None) -> Column:
    """Number of non-null fields of the row (the order of non-null/all)."""
    cols = list(cols or df.columns)
    return sum((F.col(c).isNotNull().cast("int") for c in cols), F.lit(0))


def present_keys(df: DataFrame, keys: Sequence[str]) -> list[str]:
    return [k for k in keys if k in df.columns]


def dedup_best(df: DataFrame, *, keys: Sequence[str], tie_break: str, score: Column | None = None) -> DataFrame:
    """Keep the most complete row per key; ties go to the smallest ``tie_break``.

    Only the key columns that exist are used (no key: input unchanged). Null
    keys compare equal, as in grouping.
    """
    keys = present_keys(df, keys)
    if not keys:
        return df
    cols = df.columns
    score = completeness(df) if score is None else score
    order = F.struct(score.alias("s"), (-F.col(tie_break)).alias("t"))
    return (df.groupBy(*[F.col(k) for k in keys])
              .agg(F.max_by(F.struct(*cols), order).alias("_row"))
              .select("_row.*"))


def dedup_last(df: DataFrame, *, keys: Sequence[str], order_by: str) -> DataFrame:
    """Keep the row with the largest ``order_by`` per key (the last arrival)."""
    keys = present_keys(df, keys)
    if not keys:
        return df
    return (df.groupBy(*keys).agg(F.max_by(F.struct(*df.columns), F.col(order_by)).alias("_row"))
              .select("_row.*"))


def duplicate_count(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows beyond the first per key, as a one-row frame ``duplicates``."""
    keys = present_keys(df, keys)
    if not keys:
        return df.sparkSession.range(1).select(F.lit(0).cast("bigint").alias("duplicates"))
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("bigint").alias("duplicates"))


def duplicate_flag(df: DataFrame, *, keys: Sequence[str], order_by: str, flag: str = "is_duplicate") -> DataFrame:
    """Mark every row after the first (smallest ``order_by``) of its key.

    The first-per-key table is an aggregate joined back on the keys
    (null-safe), so a hot key is split by AQE's skew-join handling instead
    of landing in one window partition.
    """
    keys = present_keys(df, keys)
    firsts = df.groupBy(*keys).agg(F.min(order_by).alias("_first"))
    a, b = df.alias("a"), firsts.alias("b")
    cond = [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in keys]
    return (a.join(b, cond, "left")
             .select(*[F.col(f"a.{c}") for c in df.columns],
                     (F.col(f"a.{order_by}") != F.col("b._first")).alias(flag)))
