"""End-to-end warehouse job: results equal the query plans; a rerun adds nothing."""

import tempfile

from pyspark.sql import functions as F

from trackcast import fixtures
from trackcast.plans.pipeline import _mark, ledger, run_pipeline

SF = "/root/testdata/sf0.001"


def _upto(df, day):
    return df.where(F.col("timestamp") < F.lit(day).cast("timestamp_ntz"))


def _rows(spark, path):
    return sorted(map(str, spark.read.parquet(path).collect()))


def test_pipeline_end_to_end_and_rerun(spark):
    wh = tempfile.mkdtemp(prefix="trackcast-wh-")
    tr, wr = fixtures.trains_raw(spark, SF), fixtures.weather_raw(spark, SF)
    out = run_pipeline(spark, trains_raw=tr, weather_raw=wr, warehouse=wh, chunk_days=31)
    p = out["paths"]
    counts = {k: spark.read.parquet(v).count() for k, v in p.items()}

    import __spark_entry__ as E
    want = E.queries()["integrate"](spark, SF)
    got = spark.read.parquet(p["integrated"]).drop("date")
    assert counts["integrated"] == want.count() == counts["trains"]
    assert got.exceptAll(want.select(*got.columns)).count() == 0
    m = spark.read.parquet(p["metrics"])
    days = spark.read.parquet(p["integrated"]).select("date").distinct().count()
    assert m.where("table_name = 'post_integration_report'").count() == 5 * days
    assert m.where("table_name in ('train', 'weather')").count() > 0 and m.where("details is null").count() == 0
    assert out["results"][0]["success"] and 0 < out["results"][0]["match_rate"] < 1

    again = run_pipeline(spark, trains_raw=tr, weather_raw=wr, warehouse=wh, chunk_days=31)
    assert {k: spark.read.parquet(v).count() for k, v in p.items()} == counts
    assert [r["skipped"] for r in again["results"]] == [True]


def test_days_that_come_later_in_a_chunk_are_integrated(spark):
    """Ten days, then fourteen, in chunks of seven: no day is lost."""
    tr, wr = _upto(fixtures.trains_raw(spark, SF), "2024-01-15"), _upto(fixtures.weather_raw(spark, SF), "2024-01-15")
    wh = tempfile.mkdtemp(prefix="trackcast-wh-")
    for day in ("2024-01-11", "2024-01-15"):
        p = run_pipeline(spark, trains_raw=_upto(tr, day), weather_raw=_upto(wr, day), warehouse=wh, chunk_days=7,
                         start_date="2024-01-01")["paths"]
    stored, done = (spark.read.parquet(p[k]).groupBy("date").count() for k in ("trains", "integrated"))
    assert sorted(map(tuple, stored.collect())) == sorted(map(tuple, done.collect()))


def test_without_weather_nothing_is_stored_and_it_is_tried_again(spark):
    tr, wr = _upto(fixtures.trains_raw(spark, SF), "2024-01-05"), _upto(fixtures.weather_raw(spark, SF), "2024-01-06")
    wh, other = (tempfile.mkdtemp(prefix="trackcast-wh-") for _ in range(2))
    args = dict(trains_raw=tr, chunk_days=4)
    first = run_pipeline(spark, weather_raw=wr.limit(0), warehouse=wh, **args)
    assert [(r["success"], r["error"]) for r in first["results"]] == [(False, "No source data available")]
    second = run_pipeline(spark, weather_raw=wr, warehouse=wh, **args)
    assert second["results"][0]["success"] and second["results"][0]["match_rate"] > 0
    once = run_pipeline(spark, weather_raw=wr, warehouse=other, **args)
    assert _rows(spark, second["paths"]["integrated"]) == _rows(spark, once["paths"]["integrated"])


def _ten_january(spark):
    """Twenty train rows of 10 January and weather of 9 to 11 January."""
    day = lambda d: F.date_format("timestamp", "yyyy-MM-dd") == d
    tr = fixtures.trains_raw(spark, SF).where(day("2024-01-10"))
    wr = fixtures.weather_raw(spark, SF).where(F.date_format("timestamp", "yyyy-MM-dd").between("2024-01-09", "2024-01-11"))
    late = F.col("timestamp") >= F.lit("2024-01-11 06:00:00").cast("timestamp_ntz")
    return tr, wr, wr.where(late), wr.where(day("2024-01-10"))


def test_a_date_waits_for_its_own_weather(spark):
    """A neighbour day's weather does not close a date; the end equals one run with all rows."""
    tr, wr, late, _ = _ten_january(spark)
    wh, other = (tempfile.mkdtemp(prefix="trackcast-wh-") for _ in range(2))
    first = run_pipeline(spark, trains_raw=tr, weather_raw=late, warehouse=wh)
    assert [(r["success"], r["error"], r["pending_dates"]) for r in first["results"]] == [
        (False, "No source data available", ["2024-01-10"])]
    assert ledger(spark, first["paths"]["dates"]) == {"2024-01-10": "pending"}
    second = run_pipeline(spark, trains_raw=tr, weather_raw=wr, warehouse=wh)
    once = run_pipeline(spark, trains_raw=tr, weather_raw=wr, warehouse=other)
    got, want = second["results"][0], once["results"][0]
    assert got["success"] and not got["skipped"] and got["match_rate"] == want["match_rate"] > 0
    for table in ("integrated", "dates"):
        assert _rows(spark, second["paths"][table]) == _rows(spark, once["paths"][table])


def test_weather_that_comes_later_replaces_a_date(spark):
    """A date stored with part of its weather is done again, rows and reports replaced, when more comes."""
    tr, wr, _, own = _ten_january(spark)
    wh, other = (tempfile.mkdtemp(prefix="trackcast-wh-") for _ in range(2))
    part = own.where(F.hour("timestamp") < 12)
    first = run_pipeline(spark, trains_raw=tr, weather_raw=part, warehouse=wh)
    again = run_pipeline(spark, trains_raw=tr, weather_raw=part, warehouse=wh)
    second = run_pipeline(spark, trains_raw=tr, weather_raw=wr, warehouse=wh)
    once = run_pipeline(spark, trains_raw=tr, weather_raw=wr, warehouse=other)
    assert [r["skipped"] for x in (first, again, second) for r in x["results"]] == [False, True, False]
    assert first["results"][0]["match_rate"] <= second["results"][0]["match_rate"] == once["results"][0]["match_rate"]
    assert _rows(spark, second["paths"]["integrated"]) == _rows(spark, once["paths"]["integrated"])
    m = [spark.read.parquet(x["paths"]["metrics"]).where("table_name = 'post_integration_report'") for x in (second, once)]
    assert sorted(map(str, m[0].collect())) == sorted(map(str, m[1].collect()))
    assert spark.read.parquet(second["paths"]["metrics"]).where("table_name = 'train'").count() > 0


def test_a_run_that_ended_early_is_done_again(spark):
    """Rows stored without a final ledger entry count as not done, and doing them again adds none."""
    tr, wr, _, _ = _ten_january(spark)
    wh = tempfile.mkdtemp(prefix="trackcast-wh-")
    first = run_pipeline(spark, trains_raw=tr, weather_raw=wr, warehouse=wh)
    before = {k: _rows(spark, v) for k, v in first["paths"].items()}
    _mark(spark, first["paths"]["dates"], ["2024-01-10"], "pending")
    second = run_pipeline(spark, trains_raw=tr, weather_raw=wr, warehouse=wh)
    assert not second["results"][0]["skipped"]
    assert {k: _rows(spark, v) for k, v in second["paths"].items()} == before


def test_stored_partitions_are_folder_names(spark):
    """No data file is opened: the listing works over files that are no CSV at all, and B6 leaves them."""
    import os
    from trackcast.sources.sinks import stored_partitions, write_absent_partitions
    path = tempfile.mkdtemp(prefix="trackcast-csv-") + "/curated"
    have = lambda: {tuple(r) for r in stored_partitions(spark, path, ("code", "year")).collect()}
    assert have() == set()
    rows = spark.createDataFrame([("a b", 2024, 1.0), ("x=y/z%", 2023, 2.0), (None, 2024, 3.0)], "code string, year int, v double")
    write_absent_partitions(rows.where("code = 'a b' or code is null"), path, partition_by=("code", "year"))
    for folder, _, names in os.walk(path):
        for name in names:
            if name.endswith(".csv"):
                with open(f"{folder}/{name}", "wb") as f:
                    f.write(b"\x00\xff")
    assert have() == {("a b", "2024"), (None, "2024")}
    write_absent_partitions(rows, path, partition_by=("code", "year"))
    assert have() == {("a b", "2024"), (None, "2024"), ("x=y/z%", "2023")}
    assert sum(n.endswith(".csv") for _, _, names in os.walk(path) for n in names) == 3


def test_partition_overwrite_is_idempotent(spark):
    from trackcast.sources.sinks import curated_weather, write_partitioned
    from trackcast.stages import Stages
    s = Stages(spark, SF)
    path = tempfile.mkdtemp(prefix="trackcast-csv-") + "/curated"
    w = curated_weather(s.weather)
    write_partitioned(w, path, partition_by=("station_code", "year"), fmt="csv", mode="overwrite")
    one = w.where(F.col("station_code") == "S01")
    write_partitioned(one, path, partition_by=("station_code", "year"), fmt="csv", mode="overwrite")
    back = spark.read.option("header", True).csv(path)
    assert back.count() == w.count()          # S01 replaced, other stations untouched
    assert back.where(F.col("station_code") == "S01").count() == one.count()


def test_a_stored_pre_report_has_its_duration(spark):
    from trackcast.plans.metrics import PRE_SUMMARY, retrieve_pre_reports, store_pre_report
    path = tempfile.mkdtemp(prefix="trackcast-pre-") + "/metrics"
    tr, wr = fixtures.trains_raw(spark, SF), fixtures.weather_raw(spark, SF)
    rows = store_pre_report(tr, wr, path).collect()
    assert {r["metric_name"] for r in rows} == {*PRE_SUMMARY, "complete_report"} and len(rows) == len(PRE_SUMMARY) + 1
    took = [r["metric_value"] for r in rows if r["metric_name"] == "processing_duration"]
    assert 0 < took[0] < 600
    assert retrieve_pre_reports(spark.read.parquet(path), limit=5).count() == 1


def test_stored_details_hold_rules_metrics_and_anomalies(spark):
    """Every step metric of the job carries its rule results; a violated rule names its action."""
    import json
    wh = tempfile.mkdtemp(prefix="trackcast-wh-")
    tr, wr = _upto(fixtures.trains_raw(spark, SF), "2024-01-05"), _upto(fixtures.weather_raw(spark, SF), "2024-01-05")
    out = run_pipeline(spark, trains_raw=tr, weather_raw=wr, warehouse=wh, chunk_days=7)
    stored = spark.read.parquet(out["paths"]["metrics"]).where("table_name in ('train', 'weather')").collect()
    details = [json.loads(r["details"]) for r in stored]
    assert all(d["anomalies"] == [] and d["custom_metrics"] for d in details)
    by_step = {(d["processor_type"], d["step"], d["date"]): d for d in details}
    rules = {r["rule_name"]: r for d in by_step.values() for r in d["validation_rules"]}
    assert {"train_id_not_null", "temperature_not_null", "timestamp_parsing", "duplicate_removal", "extreme_early_delay"} <= set(rules)
    for d in by_step.values():
        for r in d["validation_rules"]:
            assert set(r) == {"rule_name", "rule_type", "passed", "affected_records", "action_taken"}
            assert r["rule_type"] not in ("business", "range") or (not r["passed"] and r["affected_records"] > 0)
    early = tr.where("delay_minutes < -5").select("train_id", "timestamp", "station_code").distinct().count()
    assert sum(r["affected_records"] for d in by_step.values() for r in d["validation_rules"]
               if r["rule_name"] == "extreme_early_delay") == early
