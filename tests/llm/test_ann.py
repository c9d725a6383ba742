import math

import numpy as np
import pytest

from trackcast.llm import ann

SCHEMA = "vec_id long, embedding array<float>, part int, id string, query boolean"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 0, "z", None) for i, v in rows], SCHEMA)


def exact(rows, k, step):
    ids = np.array([i for i, _ in rows])
    x = np.array([v for _, v in rows], np.float32).astype(float)
    out = {}
    for q in np.flatnonzero(ids % step == 0):
        s = [math.fsum(a * b for a, b in zip(x[q], v)) for v in x]
        order = sorted((-s[c], ids[c]) for c in range(len(ids)) if ids[c] != ids[q])[:k]
        out[int(ids[q])] = [(int(i), -v) for v, i in order]
    return out


def test_recall_and_scores_against_brute_force(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"]) for r in df.collect()]
    got = {}
    for r in ann.nearest(df).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    want = exact(rows, 20, 20)
    assert set(got) == set(want)
    hits = 0
    by_id = dict(rows)
    for q, found in got.items():
        found.sort()
        assert [f[0] for f in found] == list(range(1, 21))
        assert [(-s, i) for _, i, s in found] == sorted((-s, i) for _, i, s in found)
        for _, i, s in found:
            assert s == pytest.approx(math.fsum(float(a) * float(b) for a, b in zip(by_id[q], by_id[i])), abs=1e-12)
        hits += len({f[1] for f in found} & {i for i, _ in want[q]})
    assert hits / (20 * len(want)) >= 0.9


def test_odd_rows_ties_and_small_tables(spark):
    good = [(0, [1.0, 0.0]), (3, [0.5, 0.5]), (2, [0.5, 0.5]), (20, [0.5, -9.0]), (7, [2.0, 0.0])]
    odd = [(40, None), (41, [0.0, 0.0]), (60, [None, 1.0]), (61, [float("nan"), 1.0]), (62, [float("inf"), 1.0]),
           (None, [1.0, 1.0]), (63, [1.0, 2.0, 3.0])]
    got = [(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in ann.nearest(frame(spark, good + odd)).collect()]
    assert sorted(got) == [(0, 1, 7, 2.0), (0, 2, 2, 0.5), (0, 3, 3, 0.5), (0, 4, 20, 0.5),
                           (20, 1, 7, 1.0), (20, 2, 0, 0.5), (20, 3, 2, -4.25), (20, 4, 3, -4.25)]


def test_repeated_ids_count_once(spark):
    rows = [(0, [1.0, 0.0]), (0, [0.0, 1.0]), (1, [1.0, 1.0]), (1, [1.0, 1.0])]
    got = ann.nearest(frame(spark, rows)).collect()
    assert [(r["query_id"], r["vec_id"], r["score"]) for r in got] == [(0, 1, 1.0)]


def test_many_equal_vectors_in_small_blocks(spark):
    rng = np.random.default_rng(1)
    rows = [(i, [1.0, 2.0, 0.5]) if i % 3 else (i, rng.standard_normal(3).tolist()) for i in range(400)]
    got = {}
    for r in ann.nearest(frame(spark, rows), k=5, parts=4, aim=0.999, block=32).collect():
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    want = exact(rows, 5, 20)
    same = sum({i for i, _ in got[q]} == {i for i, _ in want[q]} for q in want)
    assert same >= 0.9 * len(want)


def test_parts_are_balanced():
    rng = np.random.default_rng(2)
    x = rng.standard_normal((500, 8))
    label = ann.balanced_parts(ann.neighbour_graph(x, 8), 8, rng)
    size = np.bincount(label, minlength=8)
    assert size.max() - size.min() <= 3 and size.sum() == 500


def test_empty_table(spark):
    assert ann.nearest(frame(spark, [])).collect() == []
