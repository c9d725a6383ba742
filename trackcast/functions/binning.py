"""Right-closed binning as a CASE expression.

Bins are ``(e0, e1], (e1, e2], ...``; with ``include_lowest`` the first bin
is ``[e0, e1]``. Values below the first edge, above the last edge, or null
give null. Duplicate edges are invalid: the caller's fallback label applies.
"""

from __future__ import annotations

import math
from typing import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _lit(v):
    return F.lit(float(v)) if isinstance(v, float) else F.lit(v)


def bin_column(c: Column, edges: Sequence[float], labels: Sequence[str], *, include_lowest: bool = False) -> Column:
    if len(edges) != len(labels) + 1:
        raise ValueError("need len(labels) + 1 edges")
    if any(b <= a for a, b in zip(edges, edges[1:])):
        raise ValueError("bin edges must be strictly increasing")
    expr = None
    for i, label in enumerate(labels):
        lo, hi = edges[i], edges[i + 1]
        conds = []
        if not (isinstance(lo, float) and math.isinf(lo)):
            conds.append(c >= _lit(lo) if (i == 0 and include_lowest) else c > _lit(lo))
        if not (isinstance(hi, float) and math.isinf(hi)):
            conds.append(c <= _lit(hi))
        cond = c.isNotNull()
        for x in conds:
            cond = cond & x
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr


def bin_dynamic(c: Column, lo: Column, mid1: Column, mid2: Column, labels: Sequence[str]) -> Column:
    """Three right-closed bins ``(lo, mid1], (mid1, mid2], (mid2, inf)`` with column edges."""
    return (F.when(c.isNull(), F.lit(None))
            .when((c > lo) & (c <= mid1), F.lit(labels[0]))
            .when((c > mid1) & (c <= mid2), F.lit(labels[1]))
            .when(c > mid2, F.lit(labels[2])))


def guarded(binned: Column, varies: Column, fallback: str, enabled: bool = True) -> Column:
    """Batch-wide guard: when the input column holds at most one distinct value
    (``varies`` is False) every row gets ``fallback`` instead of its bin."""
    if not enabled:
        return binned
    return F.when(varies, binned).otherwise(F.lit(fallback))
