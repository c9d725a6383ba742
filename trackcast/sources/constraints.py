"""Table constraints as check operators.

Each check is one aggregate (or one anti-join) and returns a small long frame
``(table_name, check, column/key, violations)``; nothing is enforced by
dropping rows unless the caller asks.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trackcast.functions.nulls import count_if


def check_not_null(df: DataFrame, table: str, columns: Sequence[str]) -> DataFrame:
    """K1: null count per NOT NULL column, one pass."""
    cols = [c for c in columns if c in df.columns]
    agg = df.agg(*[count_if(F.col(c).isNull()).alias(f"n{i}") for i, c in enumerate(cols)])
    items = [F.struct(F.lit(c).alias("column_name"), F.col(f"n{i}").alias("violations")) for i, c in enumerate(cols)]
    return agg.select(F.lit(table).alias("table_name"), F.explode(F.array(*items)).alias("r")) \
              .select("table_name", "r.column_name", "r.violations")


def check_unique(df: DataFrame, table: str, keys: Sequence[str]) -> DataFrame:
    """K2: key groups holding more than one row and the surplus rows."""
    g = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return g.agg(count_if(F.col("n") > 1).alias("duplicate_keys"),
                 F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("bigint").alias("surplus_rows")) \
            .select(F.lit(table).alias("table_name"), F.lit(",".join(keys)).alias("key_columns"),
                    "duplicate_keys", "surplus_rows")


def orphan_rows(df: DataFrame, parent: DataFrame, key: str = "station_code") -> DataFrame:
    """Rows whose non-null ``key`` has no parent row (a null key is not an
    orphan: the reference's FK admits nulls)."""
    return df.where(F.col(key).isNotNull()).join(parent.select(key), key, "left_anti")


def check_fk(df: DataFrame, table: str, parent: DataFrame, key: str = "station_code") -> DataFrame:
    """K3: count of orphan rows."""
    return orphan_rows(df, parent, key).agg(F.count(F.lit(1)).alias("violations")) \
        .select(F.lit(table).alias("table_name"), F.lit(key).alias("column_name"), "violations")


def apply_defaults(df: DataFrame, defaults: dict) -> DataFrame:
    """K4: fill column defaults (``None`` value: current timestamp)."""
    out = {}
    for c, v in defaults.items():
        fill = F.current_timestamp() if v is None else F.lit(v)
        out[c] = F.coalesce(F.col(c), fill) if c in df.columns else fill
    return df.withColumns(out)


def check_enum(df: DataFrame, table: str, column: str, allowed: Sequence[str]) -> DataFrame:
    """K5: values outside the allowed set (null passes)."""
    return df.agg(count_if(F.col(column).isNotNull() & ~F.col(column).isin(*allowed)).alias("violations")) \
             .select(F.lit(table).alias("table_name"), F.lit(column).alias("column_name"), "violations")
