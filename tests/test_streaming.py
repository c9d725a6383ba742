"""Streaming: reruns add nothing, and the result depends neither on the number of landed files nor on their order."""

import pytest
from pyspark.sql import functions as F

from trackcast.streaming import jobs as X

SF = "/root/testdata/sf0.001"
W_COLS = ["temperature", "wind_speed", "precip_mm", "weather_code"]


@pytest.fixture(scope="module")
def stages(spark):
    from trackcast.stages import Stages
    return Stages(spark, SF)


def _land(df, path, tasks):
    """Landed by one task, by several, or (tasks = 0) day by day with the newest day first."""
    if tasks:
        X.land_json(df.repartition(tasks), path)
        return
    dated = df.withColumn("date", F.date_format("timestamp", "yyyy-MM-dd"))
    for k, r in enumerate(dated.select("date").distinct().orderBy(F.desc("date")).collect()):
        X.land_json(dated.where(F.col("date") == r["date"]), f"{path}/run{k:03d}")


def _same(a, b):
    cols = sorted(a.columns)
    a, b = a.select(*cols), b.select(*cols)
    assert a.count() == b.count()
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_incremental_ingest_twice_adds_nothing(spark, stages, tmp_path):
    w = stages.weather_raw.where(F.col("timestamp").isNotNull())
    X.land_json(w, f"{tmp_path}/landing")
    for _ in range(2):
        X.incremental_ingest(spark, f"{tmp_path}/landing", f"{tmp_path}/target", f"{tmp_path}/ckpt", w.schema,
                             ["station_code", "timestamp"], "ingest_seq", files_per_batch=3)
    out = spark.read.parquet(f"{tmp_path}/target")
    assert out.count() == w.select("station_code", "timestamp").distinct().count()


@pytest.mark.parametrize("tasks", [1, 4, 10, 0])
def test_dedup_and_counters_lose_nothing(spark, stages, tmp_path, tasks):
    t = stages.trains_clean.select("train_id", "timestamp", "station_code", "delay_minutes", "ingest_seq")
    _land(t, f"{tmp_path}/l", tasks)
    files = 8 if tasks else 1
    X.stream_hourly_dq(spark, f"{tmp_path}/l", f"{tmp_path}/h", f"{tmp_path}/ch", t.schema, files_per_batch=files)
    totals = X.window_totals(spark.read.parquet(f"{tmp_path}/h"))
    assert totals.agg(F.sum("rows")).first()[0] == t.count()
    keys = ["station_code", "delay_minutes"]
    X.stream_dedup(spark, f"{tmp_path}/l", f"{tmp_path}/d", f"{tmp_path}/cd", t.schema, keys, "ingest_seq",
                   files_per_batch=files)
    _same(X.first_arrivals(spark.read.parquet(f"{tmp_path}/d"), keys, "ingest_seq"), X.first_arrivals(t, keys, "ingest_seq"))


@pytest.mark.parametrize("tasks", [1, 6, 0])
def test_stream_nearest_equals_batch(spark, stages, tmp_path, tasks):
    left = stages.trains_clean.select("train_id", "timestamp", "station_code", "delay_minutes", "ingest_seq")
    right = stages.weather.select("station_code", "timestamp", *W_COLS)
    _land(left, f"{tmp_path}/l", tasks)
    _land(right, f"{tmp_path}/r", tasks)
    for side, schema in (("l", left.schema), ("r", right.schema)):
        X.stream_store(spark, f"{tmp_path}/{side}", f"{tmp_path}/s{side}", f"{tmp_path}/c{side}", schema,
                       files_per_batch=8)
    X.finish_nearest(spark, f"{tmp_path}/sl", f"{tmp_path}/sr", f"{tmp_path}/out", right_cols=W_COLS)
    from trackcast.operators.nearest import nearest_join
    _same(spark.read.parquet(f"{tmp_path}/out").drop("date"), nearest_join(left, right, right_cols=W_COLS))


def test_nearest_is_finished_again_when_weather_comes_later(spark, stages, tmp_path):
    left = stages.trains_clean.select("train_id", "timestamp", "station_code", "delay_minutes", "ingest_seq")
    right = stages.weather.select("station_code", "timestamp", *W_COLS)
    cut = F.col("timestamp") < F.lit("2024-01-10 00:00:00").cast("timestamp_ntz")
    args = dict(right_cols=W_COLS)
    X.land_json(left, f"{tmp_path}/l/a")
    X.stream_store(spark, f"{tmp_path}/l", f"{tmp_path}/sl", f"{tmp_path}/cl", left.schema)
    for k, part in enumerate((right.where(~cut), right.where(cut))):
        X.land_json(part, f"{tmp_path}/r/{k}")
        X.stream_store(spark, f"{tmp_path}/r", f"{tmp_path}/sr", f"{tmp_path}/cr", right.schema)
        X.finish_nearest(spark, f"{tmp_path}/sl", f"{tmp_path}/sr", f"{tmp_path}/out",
                         since_left=-1 if k == 0 else 0, since_right=k - 1, **args)
    from trackcast.operators.nearest import nearest_join
    _same(spark.read.parquet(f"{tmp_path}/out").drop("date"), nearest_join(left, right, **args))


KEYS = ["train_id", "timestamp", "station_code"]


def _some_trains(stages):
    cols = ["train_id", "timestamp", "station_code", "delay_minutes", "ingest_seq"]
    return stages.trains_raw.select(*cols).where(F.col("timestamp") < F.lit("2024-01-08").cast("timestamp_ntz"))


def test_many_runs_leave_one_row_per_key(spark, stages, tmp_path):
    """One file a run, dates mixed: the stores stay equal to the batch result and hold one row per key, no contribution left."""
    t = _some_trains(stages)
    runs = 12
    for k in range(runs):
        X.land_json(t.where(F.col("ingest_seq") % runs == runs - 1 - k).coalesce(1), f"{tmp_path}/l/{k:03d}")
        X.stream_dedup(spark, f"{tmp_path}/l", f"{tmp_path}/d", f"{tmp_path}/cd", t.schema, KEYS, "ingest_seq")
        X.stream_hourly_dq(spark, f"{tmp_path}/l", f"{tmp_path}/h", f"{tmp_path}/ch", t.schema)
    _same(X.folded(spark, f"{tmp_path}/d"), X.first_arrivals(t, KEYS, "ingest_seq"))
    assert spark.read.parquet(f"{tmp_path}/d").count() == t.select(*KEYS).distinct().count()
    hours = X.folded(spark, f"{tmp_path}/h")
    assert hours.count() == hours.select("window_start").distinct().count()
    assert hours.agg(F.sum("rows")).first()[0] == t.count()
    for store in ("d-new", "h-new"):
        assert not [f for f in (tmp_path / store).rglob("*.parquet")]


def test_a_replayed_batch_and_an_unfinished_fold_change_nothing(spark, stages, tmp_path):
    t = _some_trains(stages)
    store = f"{tmp_path}/h"
    for k in (0, 1):
        X.land_json(t.where(F.col("ingest_seq") % 2 == k).coalesce(1), f"{tmp_path}/l/{k}")
        X.stream_hourly_dq(spark, f"{tmp_path}/l", store, f"{tmp_path}/c", t.schema)
    want = X.folded(spark, store).collect()
    stray = spark.read.parquet(store).drop("fold")
    stray.drop("batch").write.partitionBy("part").parquet(f"{store}-new/batch={1:012d}")        # a replay of a folded batch
    stray.write.partitionBy("part").parquet(f"{store}/fold={9:012d}")                             # a fold that did not end
    (tmp_path / "h" / f"fold={9:012d}" / "_SUCCESS").unlink()
    assert sorted(map(str, X.folded(spark, store).collect())) == sorted(map(str, want))
    X.stream_hourly_dq(spark, f"{tmp_path}/l", store, f"{tmp_path}/c", t.schema)
    assert sorted(map(str, X.folded(spark, store).collect())) == sorted(map(str, want))
    assert spark.read.parquet(store).count() == len(want)


def test_a_second_run_matches_only_the_dates_of_new_rows(spark, stages, tmp_path):
    left = stages.trains_clean.select("train_id", "timestamp", "station_code", "delay_minutes", "ingest_seq")
    right = stages.weather.select("station_code", "timestamp", *W_COLS)
    day = F.date_format("timestamp", "yyyy-MM-dd")
    late = (day == "2024-01-10") & (F.hour("timestamp") < 12)

    def files():
        return {str(f): f.stat().st_mtime_ns for f in (tmp_path / "out").rglob("*.parquet")}

    def run():
        for side, schema in (("l", left.schema), ("r", right.schema)):
            X.stream_store(spark, f"{tmp_path}/{side}", f"{tmp_path}/s{side}", f"{tmp_path}/c{side}", schema)
        return X.finish_nearest(spark, f"{tmp_path}/sl", f"{tmp_path}/sr", f"{tmp_path}/out", right_cols=W_COLS)

    X.land_json(left, f"{tmp_path}/l/0")
    X.land_json(right.where(~late), f"{tmp_path}/r/0")
    assert len(run()) >= 30
    before = files()
    X.land_json(right.where(late).coalesce(1), f"{tmp_path}/r/1")
    assert run() == ["2024-01-09", "2024-01-10", "2024-01-11"]
    same = {f for f, at in files().items() if before.get(f) == at}
    gone = {f.split("date=")[1][:10] for f in set(before) - same}
    assert gone == {"2024-01-09", "2024-01-10", "2024-01-11"}
    assert run() == [] and set(files()) >= same                                                    # nothing new: nothing read or written
    from trackcast.operators.nearest import nearest_join
    _same(spark.read.parquet(f"{tmp_path}/out").drop("date"), nearest_join(left, right, right_cols=W_COLS))
