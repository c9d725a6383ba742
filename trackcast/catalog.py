"""Registry of queries: one per operator key of the inventory.

Each entry is ``(spark, sf_dir) -> DataFrame`` plus, where the result is
expressible in SQL, the DuckDB oracle text over the same parquet tables.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession

from trackcast.oracle_sql import with_
from trackcast.stages import Stages

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(key: str, sql: str | None = None):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(Stages(spark, sf_dir))
        run.__name__ = fn.__name__
        run.__qualname__ = fn.__qualname__
        run.__module__ = fn.__module__
        run.__doc__ = fn.__doc__
        run.__wrapped__ = fn
        QUERIES[key] = run
        if sql is not None:
            ORACLE[key] = with_(sql)
        return fn
    return deco


# import the query modules for their registrations
from trackcast.queries import assess, core, functions_q, metrics_q, parse_q, stream_q, tables_q  # noqa: E402,F401
