"""Attaching batch-wide scalars to rows, with a proven size bound.

A global aggregate yields exactly one row, so joining it to every row of a
frame is a broadcast of one row. ``attach_one_row`` asks Catalyst for the
analyzed plan's ``maxRows`` (already computed when the frame was built, so
the check costs no optimizer run) and refuses anything not provably at most
one row -- a broadcast whose size cannot grow with the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F



def max_rows(df: DataFrame) -> int | None:
    """Catalyst's static upper bound on the rows of ``df`` (None: unbounded)."""
    jdf = getattr(df, "_jdf", None)
    if jdf is None:  # no plan to inspect (Spark Connect client): nothing is proven
        return None
    bound = jdf.queryExecution().analyzed().maxRows()
    return int(bound.get()) if bound.isDefined() else None


def _bounded(n: int | None) -> bool:
    return n is not None and n <= 1


def attach_one_row(left: DataFrame, right: DataFrame) -> DataFrame:
    """Every row of ``left`` with the columns of the one-row frame ``right``."""
    n = max_rows(right)
    if not _bounded(n):
        raise ValueError(f"attach_one_row needs a frame of at most one row (bound: {n})")
    return left.crossJoin(F.broadcast(right))


def one_row(*frames: DataFrame) -> DataFrame:
    """Several one-row frames side by side as one row. Every piece is checked;
    they are combined without a hint, so the result's bound stays provable."""
    for f in frames:
        n = max_rows(f)
        if not _bounded(n):
            raise ValueError(f"one_row needs frames of at most one row (bound: {n})")
    out = frames[0]
    for f in frames[1:]:
        out = out.crossJoin(f)
    return out
