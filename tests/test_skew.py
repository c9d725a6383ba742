"""Skew: one station / one key holding a third of all rows."""

from pyspark.sql import functions as F

from conftest import SF_MID
from trackcast.operators.dedup import dedup_best
from trackcast.operators.nearest import time_bucket
from trackcast.functions.timefns import US_PER_HOUR, epoch_us
from trackcast.plans.integrate import match_weather
from trackcast.stages import Stages


def test_hot_station_is_spread_by_the_join_key(spark):
    s = Stages(spark, SF_MID)
    hot = s.trains_clean.withColumn(
        "station_code", F.when(F.col("ingest_seq") % 3 == 0, F.lit("S01")).otherwise(F.col("station_code")))
    n = hot.count()
    assert hot.where(F.col("station_code") == "S01").count() >= n / 3
    keyed = hot.groupBy("station_code", time_bucket(epoch_us("timestamp"), US_PER_HOUR).alias("b")).count()
    assert keyed.agg(F.max("count")).first()[0] < 0.01 * n   # no (station, hour) key holds 1 % of the rows

    want = sorted(match_weather(hot, s.weather).collect())
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes")
    old = {k: spark.conf.get(k) for k in keys}
    try:
        spark.conf.set(keys[0], "-1")
        spark.conf.set(keys[1], "-1")
        spark.conf.set(keys[2], "1k")
        df = match_weather(hot, s.weather)
        got = sorted(df.collect())
        assert "SortMergeJoin" in df._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert got == want


def test_hot_duplicate_key_is_combined_map_side(spark):
    s = Stages(spark, SF_MID)
    t = s.trains_raw
    n = t.count()
    # a third of the rows become copies of one key (distinct ingest sequence, fewer filled fields)
    hot = t.withColumns({
        "train_id": F.when(F.col("ingest_seq") % 3 == 0, F.lit("HOT")).otherwise(F.col("train_id")),
        "timestamp": F.when(F.col("ingest_seq") % 3 == 0, F.lit("2024-01-10 08:00:00").cast("timestamp_ntz"))
        .otherwise(F.col("timestamp")),
        "station_code": F.when(F.col("ingest_seq") % 3 == 0, F.lit("S01")).otherwise(F.col("station_code"))})
    out = dedup_best(hot, keys=["train_id", "timestamp", "station_code"], tie_break="ingest_seq")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "partial_max_by" in plan
    hot_rows = out.where(F.col("train_id") == "HOT").collect()
    assert len(hot_rows) == 1
    # the kept copy is the most complete one, smallest ingest sequence among equals
    cand = hot.where(F.col("train_id") == "HOT")
    score = sum((F.col(c).isNotNull().cast("int") for c in hot.columns), F.lit(0))
    best = cand.withColumn("s", score).orderBy(F.col("s").desc(), "ingest_seq").first()["ingest_seq"]
    assert hot_rows[0]["ingest_seq"] == best
    assert out.count() == hot.select("train_id", "timestamp", "station_code").distinct().count() <= n


def _dense(spark, hot):
    """Rows of two stations with unrounded times; ``hot`` of them in one hour of station A, several at one time."""
    far = spark.range(300).select(F.lit("B").alias("station_code"), (F.col("id") * 1_234_567_891 % 360_000_000_000).alias("us"), "id")
    near = spark.range(hot).select(F.lit("A").alias("station_code"), (F.col("id") * 7_919_191 % 3_600_000_000 + 36_000_000_000).alias("us"),
                                   (F.col("id") + 1000).alias("id"))
    again = near.where("id % 50 = 0").withColumn("id", F.col("id") + 1_000_000)
    edge = spark.createDataFrame([("A", 32_400_000_000, 500), ("A", 43_200_000_000, 501), ("A", 35_999_999_999, 503)], "station_code string, us long, id long")
    rows = far.unionByName(near).unionByName(again).unionByName(edge)
    return rows.withColumn("timestamp", F.timestamp_add("MICROSECOND", F.col("us"), F.lit("2024-01-10").cast("timestamp_ntz")))


def _brute(left, right, tol_us):
    import bisect
    from collections import defaultdict
    at = defaultdict(dict)
    for station, us, k in right:
        at[station][us] = min(k, at[station].get(us, k))
    times = {s: sorted(x) for s, x in at.items()}
    out = {}
    for station, us, k in left:
        t = times.get(station, [])
        i = bisect.bisect_left(t, us)
        best = min(((abs(x - us), x) for x in t[max(0, i - 1):i + 1]), default=None)
        out[k] = at[station][best[1]] if best and best[0] <= tol_us else None
    return out


def test_nearest_over_dense_weather_equals_brute_force(spark):
    """Unrounded observations, a station-hour with most of them: exact, and no list grows beyond a block."""
    from trackcast.functions.timefns import US_PER_MIN
    from trackcast.operators import nearest as N
    left, right = _dense(spark, 9_000).where("id % 3 != 1").withColumn("us", F.col("us") + 13), _dense(spark, 9_000)
    left = left.withColumn("timestamp", F.timestamp_add("MICROSECOND", F.lit(13), F.col("timestamp")))
    L, R = ([tuple(r) for r in x.select("station_code", "us", "id").collect()] for x in (left, right))
    right = right.select("station_code", "timestamp", F.col("id").alias("v"))
    for tol in (60, 1):
        got = {r["id"]: r["v"] for r in N.nearest_join(left, right, right_cols=["v"], tolerance_minutes=tol).collect()}
        assert len(got) == len(L) and got == _brute(L, R, tol * US_PER_MIN)
        cut = N.blocks(N.offered(right, by="station_code", right_ts="timestamp", right_cols=["v"], bucket_us=tol * US_PER_MIN))
        assert cut.agg(F.max(F.size("_cands"))).first()[0] <= N.BLOCK + 1


def test_ranked_candidates_repeat_equal_rows(spark):
    from trackcast.operators.nearest import ranked_candidates
    left = spark.createDataFrame([("A", 0), ("A", 0), ("A", 100), ("B", 5)], "station_code string, s int")
    right = spark.createDataFrame([("A", -60), ("A", 60), ("A", 61), ("A", 4000)], "station_code string, s int")
    left, right = (x.withColumn("timestamp", F.expr("timestamp_ntz'2024-01-10 10:00:00' + make_dt_interval(0, 0, 0, s)")) for x in (left, right))
    rows = ranked_candidates(left, right.drop("s"), left_cols=["s"]).collect()
    got = sorted((r["s"], r["rank"], r["diff_us"] // 1_000_000) for r in rows)
    assert got == sorted([(0, 1, 60), (0, 2, 60), (0, 3, 61)] * 2 + [(100, 1, 39), (100, 2, 40), (100, 3, 160)])
    assert [r["candidate_timestamp"].minute for r in rows if (r["s"], r["rank"]) == (0, 1)] == [59, 59]
