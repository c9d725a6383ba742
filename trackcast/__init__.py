"""trackcast: train-event and weather data quality, matching and features on Spark.

Every operator is a function ``op(df, *, params) -> DataFrame`` (or two-table
``op(left, right, *, params)``) built from Spark SQL expressions only; no Python
UDFs are used anywhere in the library.
"""

from trackcast.session import get_session, checkpoint_dir  # noqa: F401

__all__ = ["get_session", "checkpoint_dir"]
