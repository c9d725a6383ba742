"""Operator 6: mixing sources to target weights by cube-method balanced sampling.

Targets are filled by weight with a cap per source (a water level). A
source whose target is r times its size takes every document floor(r) times
and a balanced sample of its documents, at inclusion probability r - floor(r), once more.

The sample is drawn by the cube method's flight phase (Deville and Tillé):
inclusion probabilities move along vectors in the null space of the balancing
constraints (number of documents, number of words), until a probability
reaches 0 or 1. Two constraints need three undecided documents per move, so a
block is flown in one pass with three documents in hand. Blocks of a
source hold about ``block_rows`` documents each (a hot source simply has more
blocks); every block leaves at most two documents undecided, and those of all
blocks fly together again, level by level, until one block per source is left.
Its at most two undecided documents, and at most three reversals, are the landing problem (``land``).
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trackcast.llm.common import WORD, WorkTables, narrow, numbered_rows

DEFAULT_WEIGHTS = (5.0, 2.0, 1.0)


def fill_targets(sizes: dict, weights: dict, total: float, cap: float) -> dict:
    """Targets per source: ``total`` shared by weight, none above ``cap`` times
    its size, what is cut off shared again by weight among the others.

    Sources are few (a bounded dictionary). A source of size 0 gets target 0; what no
    source can take is left over.
    """
    target, open_ = {}, dict(weights)
    left = total
    while open_:
        level = left / sum(open_.values())
        full = [s for s, w in open_.items() if w * level > cap * sizes[s]]
        if not full:
            return target | {s: w * level for s, w in open_.items()}
        for s in full:
            target[s] = float(cap * sizes[s])
            left -= target[s]
            del open_[s]
        left = max(left, 0.0)
    return target


def fly(p: np.ndarray, x: np.ndarray, seeds: np.ndarray) -> np.ndarray:
    """Flight phase over one block: probabilities ``p`` (0 < p < 1), balancing
    values ``x``; returns p with at most two entries still strictly between 0 and 1.

    Balanced are the sum of p (documents) and the sum of p * x (words). The direction
    of each move follows the document's own seed, so a rerun agrees.
    """
    p = p.astype(float).copy()
    hand: list[int] = []
    eps = 1e-9
    for nxt in range(len(p)):
        if p[nxt] <= eps or p[nxt] >= 1 - eps:
            p[nxt] = round(p[nxt])
            continue
        hand.append(nxt)
        while len(hand) == 3:
            a, b, c = hand
            u = _null_vector(x[a], x[b], x[c])
            up, down = np.inf, np.inf  # how far along +u and along -u until a probability is 0 or 1
            for i, v in zip(hand, u):
                if v > 0:
                    up, down = min(up, (1 - p[i]) / v), min(down, p[i] / v)
                elif v < 0:
                    up, down = min(up, p[i] / -v), min(down, (1 - p[i]) / -v)
            step = up if seeds[nxt] * (up + down) < down else -down
            for i, v in zip(hand, u):
                p[i] += step * v
                if p[i] <= eps:
                    p[i] = 0.0
                elif p[i] >= 1 - eps:
                    p[i] = 1.0
            hand = [i for i in hand if 0.0 < p[i] < 1.0]
    return p


def _null_vector(xa: float, xb: float, xc: float) -> tuple[float, float, float]:
    """A vector u with u1 + u2 + u3 = 0 and u1 xa + u2 xb + u3 xc = 0, scaled to largest entry 1."""
    u = (xc - xb, xa - xc, xb - xa)
    m = max(map(abs, u))
    return (1.0, -1.0, 0.0) if m == 0 else (u[0] / m, u[1] / m, u[2] / m)


def land(p: np.ndarray, x: np.ndarray, promise: float, flips: int = 3) -> np.ndarray:
    """Landing phase: the 0/1 choice for the at most two undecided entries whose
    total of x is nearest to ``promise``; then at most ``flips`` single decisions are reversed, each
    the one that brings the total nearest (a long document decided against leaves a gap that a few
    shorter ones fill). Ties go to fewer documents, then earlier ones."""
    out = p.copy()
    open_ = [i for i in range(len(p)) if 0.0 < p[i] < 1.0]
    base = float((out * x)[(p == 0.0) | (p == 1.0)].sum())
    best = min(range(1 << len(open_)), key=lambda m: (
        abs(base + sum(x[i] for k, i in enumerate(open_) if m >> k & 1) - promise), bin(m).count("1"), m))
    for k, i in enumerate(open_):
        out[i] = float(best >> k & 1)
    gap = promise - float((out * x).sum())
    for _ in range(flips if len(x) else 0):
        left = np.abs(gap - np.where(out == 0.0, x, -x))
        i = int(left.argmin())
        if left[i] >= abs(gap):
            break
        gap -= x[i] if out[i] == 0.0 else -x[i]
        out[i] = 1.0 - out[i]
    return out


_FLOWN = "source string, block long, key long, size long, seed double, p double"


def _fly_block(last: bool):
    def run(block: pd.DataFrame) -> pd.DataFrame:
        # longest octave of sizes first, at random within an octave: a long document meets enough
        # others of comparable but different size to be decided, and those left undecided are short
        block = (block.assign(octave=np.frexp(block["size"].to_numpy(float))[1])
                 .sort_values(["octave", "seed", "key", "size"], ascending=[False, True, True, True], kind="stable")
                 .drop(columns="octave").reset_index(drop=True))
        x = block["size"].to_numpy(float)
        before = block["p"].to_numpy(float)
        p = fly(before, x, block["seed"].to_numpy(float))
        return block.assign(p=land(p, x, float((before * x).sum())) if last else p)
    return run


def mix_to_weights(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                   weights: tuple[float, ...] = DEFAULT_WEIGHTS, share: float = 1.0, cap: float = 3.0,
                   block_rows: int = 2_000, seed: int = 6) -> DataFrame:
    """One row per input row: id, source, size (words), source_size, target, times, taken (size * times).

    Weights repeat over the sources in code-point order, null last. Defined
    results: null and empty texts have size 0 and are taken floor(target / source size) times or, in
    a source without words, never; the null source is a source of its own; rows that repeat an id, or have none, are
    rows of their own; an empty table gives an empty result; extra columns are ignored. The draw depends
    on id, size and ``seed`` only, never on partitioning, so reruns agree.
    """
    work = WorkTables(docs.sparkSession, "mixing")
    rows, key = numbered_rows(narrow(docs, *dict.fromkeys([id_col, text_col, source_col])), id_col, work)
    sized = work.put("sizes", _sized(rows, key, id_col, text_col, source_col))
    return _mixed(sized, work, weights, share, cap, block_rows, seed).select(
        F.col("id").alias(id_col), F.col("source").alias(source_col), "size", "source_size", "target", "times",
        (F.col("size") * F.col("times")).alias("taken"))


def mixed_rows(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
               weights: tuple[float, ...] = DEFAULT_WEIGHTS, share: float = 1.0, cap: float = 3.0,
               block_rows: int = 2_000, seed: int = 6) -> DataFrame:
    """The mix itself: the input's rows, all columns, each as often as it is taken."""
    work = WorkTables(docs.sparkSession, "mixed-rows")
    rows, key = numbered_rows(docs, id_col, work)
    sized = work.put("sizes", _sized(rows, key, id_col, text_col, source_col))
    taken = _mixed(sized, work, weights, share, cap, block_rows, seed).filter("times > 0").select(
        F.col("key").alias(key), F.sequence(F.lit(1).cast("long"), "times").alias("_each"))
    return rows.join(taken, key).withColumn("_each", F.explode("_each")).select(*[f"`{c}`" for c in docs.columns])


def _sized(rows: DataFrame, key: str, id_col: str, text_col: str, source_col: str) -> DataFrame:
    return rows.select(F.col(key).alias("key"), F.col(id_col).alias("id"), F.col(source_col).alias("source"),
                       F.coalesce(F.regexp_count(text_col, F.lit(WORD)), F.lit(0)).cast("long").alias("size"))


def _mixed(sized: DataFrame, work: WorkTables, weights, share: float, cap: float, block_rows: int, seed: int) -> DataFrame:
    """(key, id, source, size, source_size, target, times) for every row."""
    spark = sized.sparkSession
    # one row per source: the list of sources is a bounded dimension
    by_source = sorted(((r["source"], r["words"], r["n"]) for r in sized.groupBy("source").agg(
        F.sum("size").alias("words"), F.count(F.lit(1)).alias("n")).collect()),
        key=lambda r: (r[0] is None, r[0] or ""))
    sizes = {s: w for s, w, _ in by_source}
    target = fill_targets(sizes, {s: weights[i % len(weights)] for i, (s, _, _) in enumerate(by_source)},
                          share * sum(sizes.values()), cap)
    plan = spark.createDataFrame(
        [(s, int(w), float(target[s]), int(target[s] // w) if w else 0, float(target[s] / w % 1.0) if w else 0.0,
          max(1, -(-n // block_rows))) for s, w, n in by_source],
        "source string, source_size long, target double, whole long, part double, blocks long")
    rate = plan.select(F.col("source").alias("_s"), "part", "blocks")
    # the seed makes the order of flight and its directions
    draw = F.xxhash64(F.lit(seed), "key", "size").bitwiseAND(2 ** 52 - 1) / float(2 ** 52)
    level = (sized.join(F.broadcast(rate), F.col("source").eqNullSafe(F.col("_s"))).filter("part > 0 and size > 0")
             .select("source", "key", "size", draw.alias("seed"), F.col("part").alias("p"),
                     F.pmod(F.xxhash64(F.lit(seed + 1), "key"), F.col("blocks")).alias("block")))
    blocks = max([1, *(-(-n // block_rows) for _, _, n in by_source)])
    drawn, depth = None, 0
    while True:
        last = blocks == 1
        flown = work.put(f"level{depth}", level.groupBy("source", "block").applyInPandas(_fly_block(last), _FLOWN))
        taken = flown.filter("p = 1").select("key", F.lit(1).alias("drawn"))
        drawn = taken if drawn is None else drawn.unionByName(taken)
        if last:
            break
        # at most two undecided documents per block fly on, in blocks of the same bounded size
        blocks = max(1, -(-2 * blocks // block_rows))
        level = flown.filter("p > 0 and p < 1").withColumn(
            "block", F.pmod(F.xxhash64(F.lit(seed + 2 + depth), "key"), F.lit(blocks)))
        depth += 1
    full = plan.select(F.col("source").alias("_s"), "source_size", "target", "whole")
    return (sized.join(drawn, "key", "left")
            .join(F.broadcast(full), F.col("source").eqNullSafe(F.col("_s")))
            .select("key", "id", "source", "size", "source_size", "target",
                    (F.col("whole") + F.coalesce("drawn", F.lit(0))).alias("times")))
