"""Two-valued predicate helpers: a comparison with null is False, never null."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def is_true(pred: Column) -> Column:
    """``pred`` with null read as False (a null operand never satisfies a test)."""
    return F.coalesce(pred, F.lit(False))


def not_marked(flag: Column) -> Column:
    """True unless ``flag`` is exactly True (a null flag counts as not marked)."""
    return ~F.coalesce(flag, F.lit(False))


def as_flag(pred: Column) -> Column:
    """0/1 integer flag of a null-safe predicate."""
    return is_true(pred).cast("int")


def count_if(pred: Column) -> Column:
    """Number of rows where ``pred`` holds (nulls count as False); bigint."""
    return F.sum(as_flag(pred)).cast("bigint")


def fill0(c: Column) -> Column:
    return F.coalesce(c, F.lit(0))
