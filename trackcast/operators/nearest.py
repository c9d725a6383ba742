"""Nearest-in-time left join within a tolerance.

Plan: the right side is bucketed by time (bucket width = tolerance) and each
right row is offered to its own bucket and the two neighbours. A bucket's
observations are laid out as blocks of at most ``BLOCK`` observations that follow one
another in time: a block covers the left times from its first observation up
to the first one of the next block, and carries that one too, so both the last observation
before a left time and the first one after it lie in its block. Every left
row equi-joins on ``(by, own bucket)`` exactly the one block that covers its
time and picks the nearest with ``array_min`` over ``(abs_diff, right_ts, ...)`` -- ties go to the
earlier right row. A block's size is fixed, however dense the observations
are; a hot bucket only has more blocks.

The left side is never exploded nor re-grouped: one left-outer equi-join, a
1:1 output, unmatched left rows kept with nulls. A hot station is spread over
its hour buckets; AQE broadcasts the blocks when their measured size is small
and splits skewed left partitions otherwise. Blocks are cut and linked by two windows
over the bucket, on the join's own shuffle.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from trackcast.functions.timefns import US_PER_MIN, epoch_us, from_epoch_us

#: Observations in a block.
BLOCK = 64


def time_bucket(e, bucket_us: int):
    """Exact bucket index of epoch microseconds, by whole-number division of the
    multiple of the bucket width at or below ``e`` (also before 1970)."""
    b = F.lit(int(bucket_us))
    return F.call_function("div", e - F.pmod(e, b), b)


def offered(right: DataFrame, *, by: str, right_ts: str, right_cols: Sequence[str], bucket_us: int) -> DataFrame:
    """Right rows with a key and a time, once for each bucket that they are within a bucket of."""
    payload = [F.col(c).alias(f"p_{i}") for i, c in enumerate(right_cols)]
    r = (right.where(F.col(by).isNotNull() & F.col(right_ts).isNotNull())
              .select(F.col(by).alias("_by"), F.struct(epoch_us(right_ts).alias("_e"), *payload).alias("_o")))
    b0 = time_bucket(F.col("_o._e"), bucket_us)
    return r.withColumn("_bucket", F.explode(F.array(b0 - 1, b0, b0 + 1)))


def blocks(rows: DataFrame) -> DataFrame:
    """``(_by, _bucket, _lo, _hi, _cands)``: the offered rows of a bucket as blocks that cover all its times between them.

    Of rows with one time the smallest payload is kept (the join's choice among equals). All steps share one shuffle by bucket, the
    join's own; a bucket's rows are sorted (spilling if need be) and pass by, only a block is held."""
    return rows.sparkSession.sql(_BLOCKS, rows=rows)  # one statement, so that the plan below it is analysed once


_BLOCKS = f"""
with ranked as (
  select _by, _bucket, _o, lag(_o._e) over in_time as _before, row_number() over in_time as _rank
  from {{rows}} window in_time as (partition by _by, _bucket order by _o)),
cut as (
  select _by, _bucket, (_rank - 1) div {BLOCK} as _block, collect_list(_o) as _own, min(_o) as _first
  from ranked where _before is null or _before <> _o._e group by _by, _bucket, (_rank - 1) div {BLOCK}),
linked as (
  select _by, _bucket, _own, _first, lead(_first) over in_turn as _next, row_number() over in_turn as _at
  from cut window in_turn as (partition by _by, _bucket order by _block))
select _by, _bucket, case when _at > 1 then _first._e else {-(1 << 63) + 1} end as _lo, coalesce(_next._e, {(1 << 63) - 1}) as _hi,
  case when _next is null then _own else concat(_own, array(_next)) end as _cands from linked"""


def nearest_join(left: DataFrame, right: DataFrame, *, by: str = "station_code", left_ts: str = "timestamp",
                 right_ts: str = "timestamp", tolerance_minutes: int = 60,
                 right_cols: Sequence[str] | None = None, matched_col: str | None = None,
                 diff_col: str | None = None) -> DataFrame:
    """Every left row with the ``right_cols`` of the nearest right row of the
    same ``by`` value within +-``tolerance_minutes`` (bounds inclusive)."""
    if right_cols is None:
        right_cols = [c for c in right.columns if c not in (by, right_ts)]
    right_cols = list(right_cols)
    tol_us = int(tolerance_minutes) * US_PER_MIN
    bucket_us = max(tol_us, US_PER_MIN)
    cands = blocks(offered(right, by=by, right_ts=right_ts, right_cols=right_cols, bucket_us=bucket_us))

    le = epoch_us(left_ts)
    l2 = left.withColumn("_le", le).withColumn("_bucket", time_bucket(F.col("_le"), bucket_us))
    j = l2.join(cands, (l2[by] == cands["_by"]) & (l2["_bucket"] == cands["_bucket"])
                & (l2["_le"] >= cands["_lo"]) & (l2["_le"] < cands["_hi"]), "left")

    within = F.filter(F.col("_cands"), lambda c: F.abs(c["_e"] - F.col("_le")) <= F.lit(tol_us))
    ranked = F.transform(within, lambda c: F.struct(F.abs(c["_e"] - F.col("_le")).alias("d"), c["_e"].alias("e"),
                                                    *[c[f"p_{i}"].alias(f"p_{i}") for i in range(len(right_cols))]))
    best = F.array_min(ranked)
    out = j.select(*[l2[c] for c in left.columns], best.alias("_best"))
    extra = {}
    if matched_col:
        extra[matched_col] = F.col("_best").isNotNull()
    if diff_col:
        extra[diff_col] = (F.col("_best.d") / F.lit(US_PER_MIN * 1.0))
    cols = [F.col(c) for c in left.columns] + [F.col(f"_best.p_{i}").alias(c) for i, c in enumerate(right_cols)]
    return out.select(*cols, *[v.alias(k) for k, v in extra.items()])


def ranked_candidates(left: DataFrame, right: DataFrame, *, left_cols, by: str = "station_code",
                      left_ts: str = "timestamp", right_ts: str = "timestamp", tolerance_minutes: int = 60) -> DataFrame:
    """Every right candidate within tolerance of each left row with its
    rank by (distance, right time); rank 1 is the nearest-join pick.

    An equi-join on (by, bucket) whose pairs outside the window are dropped as they are formed, then a rank per left row.
    Left rows equal in all ``left_cols`` are ranked once and repeated."""
    tol_us = int(tolerance_minutes) * US_PER_MIN
    bucket_us = max(tol_us, US_PER_MIN)
    cands = offered(right, by=by, right_ts=right_ts, right_cols=[], bucket_us=bucket_us)
    key = [*left_cols, "_lby", "_le"]
    l2 = (left.select(*left_cols, F.col(by).alias("_lby"), epoch_us(left_ts).alias("_le"))
              .groupBy(*key).agg(F.count(F.lit(1)).alias("_copies"))
              .withColumn("_bucket", time_bucket(F.col("_le"), bucket_us)))
    diff = F.abs(F.col("_o._e") - F.col("_le"))
    j = l2.join(cands, (l2["_lby"] == cands["_by"]) & (l2["_bucket"] == cands["_bucket"]) & (diff <= F.lit(tol_us)))
    rank = F.row_number().over(Window.partitionBy(*key).orderBy(diff, F.col("_o._e")))
    return (j.withColumn("rank", rank).withColumn("diff_us", diff).withColumn("candidate_timestamp", from_epoch_us(F.col("_o._e")))
             .withColumn("_copy", F.explode(F.array_repeat(F.lit(0), F.col("_copies").cast("int"))))
             .select(*left_cols, "rank", "candidate_timestamp", "diff_us"))
