"""Operator 7: nearest neighbours by learned partitions.

Fitted on a bounded sample (``sample`` vectors, chosen by a hash of their ids): the sample's
neighbour graph is cut into balanced parts, and a small classifier (one hidden layer) learns from a
vector the parts in which its neighbours lie. Every row is then indexed under its most probable part;
a query goes to its most probable parts and is reranked there by the true measure. How many
parts are visited is set by measurement: the least number at which held-out sample queries find ``aim`` of
their true neighbours.

Inner products are turned into angles by one more component that gives all candidates the length of the longest (a
query's is 0), so the parts hold for vectors of any length.

Parts are searched in blocks of about ``block`` candidates, held in memory while the queries stream
past; a block gives each query its best ``k``, and Spark ranks the blocks' answers (a group limit before
the shuffle). A crowded part simply has more blocks.
"""

from __future__ import annotations

from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trackcast.llm.common import WorkTables, narrow

# ---- fitting, on the driver, over the bounded sample -----------------------------------------


def neighbour_graph(x: np.ndarray, k: int) -> np.ndarray:
    """Indices of the k largest inner products of each row with other rows."""
    out = np.empty((len(x), k), np.int64)
    for at in range(0, len(x), 512):
        s = x[at:at + 512] @ x.T
        s[np.arange(len(s)), np.arange(at, at + len(s))] = -np.inf
        out[at:at + 512] = np.argpartition(-s, k - 1, axis=1)[:, :k]
    return out


def balanced_parts(graph: np.ndarray, parts: int, rng: np.random.Generator, passes: int = 6) -> np.ndarray:
    """Cut of a neighbour graph into ``parts`` (a power of two) parts of equal size, give or take one.

    By repeated halving: a half is split at the median of the graph's slow mode (power iteration on its
    smoothed adjacency), then pairs of nodes that gain most are swapped.
    """
    label = np.zeros(len(graph), np.int64)
    src, dst = np.repeat(np.arange(len(graph)), graph.shape[1]), graph.ravel()
    src, dst = np.concatenate([src, dst]), np.concatenate([dst, src])
    width = 1
    while width < parts:
        for part in range(width):
            own = np.flatnonzero(label == part)
            if len(own) < 2:
                continue
            place = np.full(len(graph), -1)
            place[own] = np.arange(len(own))
            inside = (place[src] >= 0) & (place[dst] >= 0)
            side = _halve(place[src[inside]], place[dst[inside]], len(own), rng, passes)
            label[own[side]] += width
        width *= 2
    return label


def _halve(a: np.ndarray, b: np.ndarray, n: int, rng: np.random.Generator, passes: int) -> np.ndarray:
    degree = np.sqrt(np.bincount(a, minlength=n) + 1.0)
    v = rng.standard_normal(n)
    for _ in range(60):
        v -= degree * (v @ degree) / (degree @ degree)
        v = v + np.bincount(a, weights=v[b] / (degree[a] * degree[b]), minlength=n)
        v /= np.linalg.norm(v) + 1e-30
    side = np.zeros(n, bool)
    side[np.argsort(v / degree, kind="stable")[n // 2:]] = True
    for _ in range(passes):
        other = np.bincount(a, weights=side[a] != side[b], minlength=n)
        gain = 2 * other - np.bincount(a, minlength=n)
        one, two = (np.flatnonzero(side == s) for s in (False, True))
        one, two = one[np.argsort(-gain[one], kind="stable")], two[np.argsort(-gain[two], kind="stable")]
        m = min(len(one), len(two))
        swaps = int(((gain[one[:m]] + gain[two[:m]]) > 0).sum()) // 4  # a part at a time, as swaps change gains
        if not swaps:
            break
        before = int((side[a] != side[b]).sum())
        side[one[:swaps]], side[two[:swaps]] = True, False
        if int((side[a] != side[b]).sum()) >= before:
            side[one[:swaps]], side[two[:swaps]] = False, True
            break
    return side


def train_router(x: np.ndarray, target: np.ndarray, rng: np.random.Generator, hidden: int = 128,
                 epochs: int = 40, batch: int = 128, rate: float = 2e-3) -> list[np.ndarray]:
    """One-hidden-layer softmax classifier, trained by Adam on soft targets."""
    d, c = x.shape[1], target.shape[1]
    w = [rng.standard_normal((d, hidden)) * np.sqrt(2 / d), np.zeros(hidden),
         rng.standard_normal((hidden, c)) * np.sqrt(1 / hidden), np.zeros(c)]
    m, s = [np.zeros_like(p) for p in w], [np.zeros_like(p) for p in w]
    t = 0
    for _ in range(epochs):
        order = rng.permutation(len(x))
        for at in range(0, len(x), batch):
            xb, yb = x[order[at:at + batch]], target[order[at:at + batch]]
            h = np.maximum(xb @ w[0] + w[1], 0)
            g = (_softmax(h @ w[2] + w[3]) - yb) / len(xb)
            gh = (g @ w[2].T) * (h > 0)
            t += 1
            for p, grad, a, b in zip(w, (xb.T @ gh + 1e-4 * w[0], gh.sum(0), h.T @ g, g.sum(0)), m, s):
                a += 0.1 * (grad - a)
                b += 0.001 * (grad * grad - b)
                p -= rate * (a / (1 - 0.9 ** t)) / (np.sqrt(b / (1 - 0.999 ** t)) + 1e-8)
    return w


def _softmax(z: np.ndarray) -> np.ndarray:
    z = np.exp(z - z.max(axis=1, keepdims=True))
    return z / z.sum(axis=1, keepdims=True)


def route(x: np.ndarray, w: list[np.ndarray]) -> np.ndarray:
    """Scores of the parts, row by row in a fixed order of summation (equal vectors go to equal parts)."""
    h = np.maximum(np.einsum("nd,dh->nh", x, w[0]) + w[1], 0)
    return np.einsum("nh,hc->nc", h, w[2]) + w[3]


def lift(x: np.ndarray, longest: float, query: bool) -> np.ndarray:
    """Vectors over the longest length, with the component that makes inner products angles."""
    x = x / longest
    last = np.zeros(len(x)) if query else np.sqrt(np.maximum(0.0, 1.0 - (x * x).sum(axis=1)))
    return np.column_stack([x, last])


def fit(sample: np.ndarray, *, parts: int, k: int, aim: float, seed: int = 7) -> dict:
    """Router weights, longest length and number of parts to visit, from the sample."""
    longest = float(np.sqrt((sample * sample).sum(axis=1).max()))
    rng = np.random.default_rng(seed)
    held = np.zeros(len(sample), bool)
    held[rng.permutation(len(sample))[:len(sample) // 5]] = True
    base, ask = lift(sample[~held], longest, False), sample[held]
    near = min(10, len(base) - 1)
    if near < 1 or len(ask) < 1 or len(base) < 4 * parts:
        return {"weights": None, "longest": longest, "visit": 1, "parts": 1}  # too few rows to cut: one part
    graph = neighbour_graph(base, near)
    label = balanced_parts(graph, parts, rng)
    one = np.eye(parts)[label]
    target = (one + one[graph].sum(axis=1)) / (1 + near)
    # a query has no last component: learn from both forms of each vector
    as_query = lift(sample[~held], longest, True)
    weights = train_router(np.concatenate([base, as_query]), np.concatenate([target, target]), rng)
    indexed = np.argmax(route(base, weights), axis=1)
    ask = lift(ask, longest, True)
    true = np.argsort(-(ask @ base.T), axis=1, kind="stable")[:, :min(k, len(base))]
    place = np.argsort(np.argsort(-route(ask, weights), axis=1), axis=1)  # rank of each part for a query
    found = np.take_along_axis(place, indexed[true], axis=1)
    visit = next(v for v in range(1, parts + 1) if (found < v).mean() >= aim)
    return {"weights": weights, "longest": longest, "visit": visit, "parts": parts}


# ---- index and search, on Spark ----------------------------------------------------------------

_ROW = "part int, blk int, query boolean, id long, vector array<double>"


def _placed(model: dict, query_step: int):
    """Each vector once as a candidate under its part and, if it is a query, once for each part it visits."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 1024):
                batch = whole.slice(at, 1024)
                ids = batch.column(0).to_numpy()
                x = batch.column(1).flatten().to_numpy().reshape(len(ids), -1)
                ask = np.flatnonzero(ids % query_step == 0)
                if model["weights"] is None:
                    part, visits = np.zeros(len(ids), int), np.zeros((len(ask), 1), int)
                else:
                    part = np.argmax(route(lift(x, model["longest"], False), model["weights"]), axis=1)
                    visits = np.argsort(-route(lift(x[ask], model["longest"], True), model["weights"]),
                                        axis=1, kind="stable")[:, :model["visit"]]
                row = np.concatenate([np.arange(len(ids)), np.repeat(ask, visits.shape[1])])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate([part, visits.ravel()]).astype(np.int32)),
                     pa.array(np.arange(len(row)) >= len(ids)), pa.array(ids[row]),
                     pa.ListArray.from_arrays(pa.array(np.arange(len(row) + 1, dtype=np.int32) * x.shape[1]),
                                              pa.array(x[row].ravel()))], names=["part", "query", "id", "vector"])
    return run


def _search(k: int):
    def best(ids, vectors, asked, queries) -> pa.RecordBatch:
        s = queries @ vectors.T
        own = asked[:, None] == ids[None, :]
        s[own] = -np.inf
        if len(ids) > k:
            worst = -np.partition(-s, k - 1, axis=1)[:, k - 1]
        else:
            worst = np.full(len(asked), -np.inf)
        # blocked products round differently from place to place: keep what could tie, then sum in a fixed order
        slack = 1e-12 * np.sqrt((queries ** 2).sum(axis=1) * (vectors ** 2).sum(axis=1).max())
        q, c = np.nonzero((s >= (worst - slack)[:, None]) & ~own)
        score = np.zeros(len(q))
        for d in range(vectors.shape[1]):
            score += queries[q, d] * vectors[c, d]
        order = np.lexsort((ids[c], -score, q))
        q, c, score = q[order], c[order], score[order]
        first = np.searchsorted(q, q)
        top = np.arange(len(q)) - first < k
        return pa.RecordBatch.from_arrays([pa.array(asked[q[top]]), pa.array(ids[c[top]]), pa.array(score[top])],
                                          names=["query_id", "vec_id", "score"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, ids, vectors, grown = None, None, None, False
        for whole in batches:
            for begin in range(0, whole.num_rows, 1024):
                batch = whole.slice(begin, 1024)
                part, blk, query, key = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(4))
                x = batch.column(4).flatten().to_numpy().reshape(len(key), -1)
                cut = np.flatnonzero(np.concatenate([[True], (part[1:] != part[:-1]) | (blk[1:] != blk[:-1])
                                                     | (query[1:] != query[:-1])]))
                for lo, hi in zip(cut, [*cut[1:], len(key)]):
                    if (part[lo], blk[lo]) != at:
                        at, ids, vectors = (part[lo], blk[lo]), key[:0], x[:0]
                    if not query[lo]:  # candidates of a block come first
                        ids, vectors = np.concatenate([ids, key[lo:hi]]), np.concatenate([vectors, x[lo:hi]])
                    elif len(ids):
                        for s in range(lo, hi, 256):
                            e = min(s + 256, hi)
                            yield best(ids, vectors, key[s:e], x[s:e])
    return run


def clean_vectors(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, vector) of the rows that take part, as doubles, one row per id."""
    rows = narrow(vectors, id_col, vector_col).select(
        F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("vector")).filter(
        F.col("id").isNotNull() & F.col("vector").isNotNull()
        & F.forall("vector", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
        & F.exists("vector", lambda v: v != 0))
    lengths = rows.groupBy(F.size("vector").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    if lengths is None:
        return rows
    rows = rows.filter(F.size("vector") == lengths["d"])
    if rows.groupBy("id").count().filter("count > 1").isEmpty():
        return rows
    return rows.groupBy("id").agg(F.max("vector").alias("vector"))


def nearest(vectors: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 20,
            query_step: int = 20, parts: int = 32, sample: int = 4096, aim: float = 0.95,
            block: int = 4096) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row whose id is divisible by ``query_step``, its ``k`` nearest
    other rows found, by largest inner product, ties to the smaller id.

    Defined results: vectors that are null, zero, or hold null or non-finite components, rows without an id, and
    vectors of another length than most take no part; of rows that repeat an id the one with the greatest vector (compared component by
    component) counts; fewer candidates than ``k`` are all returned if found; an empty table gives an empty
    result; extra columns are ignored.
    """
    spark = vectors.sparkSession
    work = WorkTables(spark, "ann")
    rows = work.put("rows", clean_vectors(vectors, id_col, vector_col))
    drawn = rows.orderBy(F.xxhash64(F.lit(7), "id"), "id").limit(sample).collect()
    if not drawn:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    model = spark.sparkContext.broadcast(  # bounded by parts and the vectors' length
        fit(np.array([r["vector"] for r in drawn]), parts=parts, k=k, aim=aim))
    placed = work.put("placed", rows.mapInArrow(lambda b: _placed(model.value, query_step)(b),
                                                "part int, query boolean, id long, vector array<double>"))
    sizes = placed.filter("not query").groupBy("part").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("blocks"))
    dealt = placed.join(F.broadcast(sizes), "part").select(  # one row per part
        "part", "query", "id", "vector", F.explode(F.when(F.col("query"), F.sequence(F.lit(0), F.col("blocks") - 1)).otherwise(
            F.array(F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")))).alias("blk"))
    dealt = dealt.select(*[c.split(" ")[0] for c in _ROW.split(", ")])
    found = (dealt.repartition("part", "blk").sortWithinPartitions("part", "blk", "query")
             .mapInArrow(_search(k), "query_id long, vec_id long, score double"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
