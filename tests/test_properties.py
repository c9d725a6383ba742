"""Properties on random small frames (hypothesis) against brute force."""

from datetime import datetime, timedelta

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from trackcast.operators.dedup import dedup_best
from trackcast.operators.nearest import nearest_join

BASE = datetime(2024, 1, 1)
minutes = st.integers(min_value=0, max_value=24 * 60)
stations = st.sampled_from(["A", "B", None])
SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))


def brute_nearest(left, right, tol):
    out = {}
    for i, ls, lt in left:
        best = None
        for rs, rt, v in right:
            if ls is None or rs != ls or lt is None:
                continue
            d = abs((rt - lt).total_seconds())
            if d <= tol * 60 and (best is None or (d, rt) < best[:2]):
                best = (d, rt, v)
        out[i] = best[2] if best else None
    return out


@SETTINGS
@given(left=st.lists(st.tuples(stations, st.one_of(st.none(), minutes)), max_size=12),
       right=st.lists(st.tuples(stations, minutes), max_size=12, unique_by=lambda r: (r[0], r[1])),
       tol=st.sampled_from([15, 60, 90]))
def test_nearest_join_matches_brute_force(spark, left, right, tol):
    L = [(i, s, None if m is None else BASE + timedelta(minutes=m, seconds=7)) for i, (s, m) in enumerate(left)]
    R = [(s, BASE + timedelta(minutes=m), float(k)) for k, (s, m) in enumerate(right)]
    ldf = spark.createDataFrame(L, "id int, station_code string, timestamp timestamp_ntz")
    rdf = spark.createDataFrame(R, "station_code string, timestamp timestamp_ntz, v double")
    got = {r["id"]: r["v"] for r in nearest_join(ldf, rdf, right_cols=["v"], tolerance_minutes=tol).collect()}
    assert len(got) == len(L)  # every left row kept exactly once
    assert got == brute_nearest(L, R, tol)


@SETTINGS
@given(data=st.lists(st.tuples(st.sampled_from(["k1", "k2", None]), st.one_of(st.none(), st.sampled_from(["a", "b"])),
                               st.one_of(st.none(), st.integers(0, 3))), min_size=1, max_size=15))
def test_dedup_best_is_idempotent_and_complete(spark, data):
    rows_ = [(k, a, b, i) for i, (k, a, b) in enumerate(data)]
    df = spark.createDataFrame(rows_, "k string, a string, b int, seq int")
    once = dedup_best(df, keys=["k"], tie_break="seq")
    got = {r["k"]: r["seq"] for r in once.collect()}
    # brute force: most non-null fields, then the smallest sequence
    want = {}
    for k, a, b, i in rows_:
        score = (a is not None) + (b is not None)
        cur = want.get(k)
        if cur is None or (score, -i) > cur[0]:
            want[k] = ((score, -i), i)
    assert got == {k: v[1] for k, v in want.items()}
    twice = dedup_best(once, keys=["k"], tie_break="seq")
    assert sorted(r["seq"] for r in twice.collect()) == sorted(got.values())


def test_scores_lie_in_unit_interval(spark):
    import __spark_entry__ as E
    row = E.queries()["pre_quality_score"](spark, "/root/testdata/sf0.001").first()
    for c in ("completeness_score", "accuracy_score", "consistency_score", "uniqueness_score", "coverage_score",
              "overall_quality_score"):
        assert 0.0 <= row[c] <= 1.0, c
    for r in E.queries()["post_overall_score"](spark, "/root/testdata/sf0.001").collect():
        assert r["overall_quality_score"] <= 1.0
