import numpy as np
import pytest
from cases import WORDS
from hypothesis import given, settings
from hypothesis import strategies as st

from trackcast.llm.mixing import fill_targets, fly, land, mix_to_weights, mixed_rows

SCHEMA = "doc_id long, text string, source string, size string, times int, key long"


@given(st.dictionaries(st.text(max_size=3), st.tuples(st.integers(0, 1000), st.sampled_from([5.0, 2.0, 1.0])), max_size=8))
def test_targets_fill_by_weight_up_to_the_cap(sources):
    sizes, weights = {s: v[0] for s, v in sources.items()}, {s: v[1] for s, v in sources.items()}
    total = sum(sizes.values())
    target = fill_targets(sizes, weights, total, 3.0)
    assert set(target) == set(sizes) and all(target[s] <= 3 * sizes[s] + 1e-6 for s in sizes)
    assert sum(target.values()) == pytest.approx(total)
    free = [target[s] / weights[s] for s in sizes if target[s] < 3 * sizes[s] - 1e-6]
    assert not free or max(free) == pytest.approx(min(free))


@settings(deadline=None)
@given(st.lists(st.tuples(st.integers(1, 3000), st.floats(0, 1)), max_size=60), st.floats(0.01, 0.99))
def test_flight_keeps_both_totals(units, p):
    x, seeds = np.array([u[0] for u in units], float), np.array([u[1] for u in units])
    before = np.full(len(units), p)
    after = fly(before, x, seeds)
    assert ((after > 0) & (after < 1)).sum() <= 2 and (after >= 0).all() and (after <= 1).all()
    assert after.sum() == pytest.approx(before.sum(), abs=1e-5)
    assert (after * x).sum() == pytest.approx((before * x).sum(), rel=1e-6, abs=1e-2)
    landed = land(after, x, float((before * x).sum()))
    assert set(np.unique(landed)) <= {0.0, 1.0}


def docs_of(spark):
    return spark.read.parquet("/root/testdata/sf0.01/documents.parquet")


def test_sources_come_near_their_targets_and_reruns_agree(spark):
    docs = docs_of(spark)
    rows = mix_to_weights(docs, block_rows=20).collect()  # several levels of blocks
    assert len(rows) == 1000
    text = {r["doc_id"]: r["text"] for r in docs.collect()}
    got = {}
    for r in rows:
        assert r["size"] == len(WORDS.findall(text[r["doc_id"]])) and 0 <= r["taken"] <= 3 * r["size"]
        assert r["taken"] == r["times"] * r["size"]
        t = got.setdefault(r["source"], [r["target"], 0, 0])
        t[1] += r["taken"]
        t[2] += r["size"]
    longest = max(r["size"] for r in rows)
    for source, (target, taken, size) in got.items():
        assert abs(taken - target) <= max(0.02 * target, 0.2 * longest), source
    assert sum(t[0] for t in got.values()) == pytest.approx(sum(t[2] for t in got.values()))
    again = mix_to_weights(docs.repartition(7), block_rows=20).collect()
    assert {(r["doc_id"], r["taken"]) for r in rows} == {(r["doc_id"], r["taken"]) for r in again}


def test_odd_rows(spark):
    rows = [(i, "w " * (i % 7 + 1), "a" if i % 3 else None, "z", 9, 1) for i in range(60)]
    rows += [(100, None, "a", None, None, None), (101, "", "empty", None, None, None), (None, "x y", "a", None, None, None),
             (5, "x y z", "a", None, None, None), (5, "x y z", "a", None, None, None)]
    df = spark.createDataFrame(rows, SCHEMA)
    out = mix_to_weights(df).collect()
    assert len(out) == len(rows)
    empty = next(r for r in out if r["doc_id"] == 101)
    assert (empty["size"], empty["source_size"], empty["target"], empty["taken"]) == (0, 0, 0.0, 0)
    copies = mixed_rows(df)
    assert copies.columns == df.columns
    taken = sum(r["times"] for r in out)
    assert copies.count() == taken


def test_empty_table(spark):
    assert mix_to_weights(spark.createDataFrame([], SCHEMA)).collect() == []
    assert mixed_rows(spark.createDataFrame([], SCHEMA)).collect() == []
