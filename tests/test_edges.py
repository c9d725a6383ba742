"""Handwritten edge tables for the pinned semantics."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from conftest import rows
from trackcast.config import DELAY_BINS, RAIN_BINS, TEMP_BINS, WIND_BINS
from trackcast.functions import timefns as TF
from trackcast.functions.binning import bin_column
from trackcast.functions.timefns import parse_clock, round_hour_half_even, round_hour_half_up
from trackcast.operators.dedup import dedup_best, dedup_last, duplicate_count, duplicate_flag
from trackcast.operators.features import engineer_features
from trackcast.operators.nearest import nearest_join, ranked_candidates
from trackcast.plans import dq, post

TS = "timestamp_ntz"


def ts(s):
    return datetime.fromisoformat(s)


def test_rounding_half_up_and_half_even(spark):
    df = spark.createDataFrame([(ts(x),) for x in ("2024-01-01 12:29:59", "2024-01-01 12:30:00",
                                                    "2024-01-01 12:30:01", "2024-01-01 13:30:00",
                                                    "2024-01-01 23:45:00")], f"t {TS}")
    out = rows(df.select("t", round_hour_half_up("t").alias("up"), round_hour_half_even("t").alias("even")))
    got = {r[0].strftime("%H:%M:%S"): (r[1], r[2]) for r in out}
    assert got["12:29:59"] == (ts("2024-01-01 12:00"), ts("2024-01-01 12:00"))
    assert got["12:30:00"] == (ts("2024-01-01 13:00"), ts("2024-01-01 12:00"))   # half-even keeps even 12
    assert got["12:30:01"] == (ts("2024-01-01 13:00"), ts("2024-01-01 13:00"))
    assert got["13:30:00"] == (ts("2024-01-01 14:00"), ts("2024-01-01 14:00"))   # odd 13 goes up to 14
    assert got["23:45:00"] == (ts("2024-01-02 00:00"), ts("2024-01-02 00:00"))


def _nearest_fixture(spark):
    left = spark.createDataFrame([
        (1, "A", ts("2024-01-01 12:00:00")),   # tie at -30 / +30 min -> earlier
        (2, "A", ts("2024-01-01 15:00:00")),   # exactly +60 min -> matched
        (3, "A", ts("2024-01-01 18:59:59")),   # 60 min 1 s away -> unmatched
        (4, "B", ts("2024-01-01 12:00:00")),   # other station only -> unmatched
        (5, "A", None),                        # null timestamp -> kept, unmatched
        (6, None, ts("2024-01-01 12:00:00")),  # null station -> unmatched
    ], f"id int, station_code string, timestamp {TS}")
    right = spark.createDataFrame([
        ("A", ts("2024-01-01 11:30:00"), 1.0),
        ("A", ts("2024-01-01 12:30:00"), 2.0),
        ("A", ts("2024-01-01 16:00:00"), 3.0),
        ("A", ts("2024-01-01 20:00:00"), 4.0),
        ("C", ts("2024-01-01 12:00:00"), 9.0),
    ], f"station_code string, timestamp {TS}, temperature double")
    return left, right


def test_nearest_join_edges(spark):
    left, right = _nearest_fixture(spark)
    out = dict(rows(nearest_join(left, right, right_cols=["temperature"]), "id", "temperature"))
    assert out == {1: 1.0, 2: 3.0, 3: None, 4: None, 5: None, 6: None}


def test_ranked_candidates_rank_one_is_the_pick(spark):
    left, right = _nearest_fixture(spark)
    r = ranked_candidates(left, right, left_cols=["id", "station_code", "timestamp"])
    firsts = {i: t for i, k, t in rows(r, "id", "rank", "candidate_timestamp") if k == 1}
    assert firsts == {1: ts("2024-01-01 11:30:00"), 2: ts("2024-01-01 16:00:00")}


@pytest.mark.parametrize("edges,labels,include_lowest,cases", [
    (TEMP_BINS[0], TEMP_BINS[1], False, {-0.0: "Freezing", 0.01: "Cold", 10.0: "Cold", 30.0: "Warm", 30.5: "Hot"}),
    (RAIN_BINS[0], RAIN_BINS[1], True, {0.0: "None", 0.1: "None", 0.11: "Light", 50.0: "Heavy", 51.0: "Extreme",
                                        -0.5: None}),
    (WIND_BINS[0], WIND_BINS[1], True, {0.0: "Calm", 5.0: "Calm", 5.5: "Light", 35.0: "Strong", 36.0: "Severe"}),
    (DELAY_BINS[0], DELAY_BINS[1], False, {-5.0: "Early", -4.0: "On_Time", 5.0: "On_Time", 60.0: "Major_Delay",
                                           61.0: "Severe_Delay"}),
])
def test_bin_edges(spark, edges, labels, include_lowest, cases):
    df = spark.createDataFrame([(float(k),) for k in cases] + [(None,)], "x double")
    got = dict(rows(df.select("x", bin_column(F.col("x"), edges, labels, include_lowest=include_lowest).alias("b"))))
    for k, v in cases.items():
        assert got[float(k)] == v, (k, got[float(k)], v)
    assert got[None] is None


def test_bin_rejects_duplicate_edges():
    with pytest.raises(ValueError):
        bin_column(None, (0, 1, 1), ("a", "b"))


def _integrated(spark, data):
    return spark.createDataFrame(data, f"train_id string, timestamp {TS}, station_code string, delay_minutes int, "
                                       "train_category string, route string, delay_status string, destination string, "
                                       "is_cancelled boolean, temperature double, wind_speed double, precip_mm double, "
                                       "weather_code int")


def test_constant_columns_fall_back(spark):
    data = [(str(i), ts("2024-01-06 08:10:00"), "A", 40, "RE", "r", "delayed", "Munich", False, 5.0, 3.0, 12.0, 1)
            for i in range(4)]
    f = engineer_features(_integrated(spark, data))
    r = f.select("time_period", "rain_intensity", "delay_category", "wind_category", "station_importance").distinct()
    assert rows(r) == [("Unknown", "None", "On_Time", "Calm", "Medium_Traffic")]


def test_null_flags_are_false(spark):
    data = [("1", ts("2024-01-06 08:10:00"), "A", None, None, None, None, None, None, None, None, None, None),
            ("2", ts("2024-01-07 19:10:00"), "B", 20, "ICE", "x<br>Berlin (D)", "delayed", "Berlin", True, -12.0,
             30.0, 11.0, 3)]
    f = engineer_features(_integrated(spark, data)).orderBy("train_id")
    a, b = f.collect()
    for c in ("is_delayed", "is_early", "is_raining", "is_heavy_rain", "is_extreme_cold", "is_high_wind",
              "is_high_speed", "is_major_destination", "adverse_weather"):
        assert a[c] is False, c
    assert a["delay_category"] == "On_Time" and a["delay_severity_score"] == 0.0
    assert a["service_disruption"] is None and a["delay_status_encoded"] == 0
    assert a["day_of_week"] == 5 and a["is_weekend"] is True
    assert b["is_weekend"] is True and b["adverse_weather"] is True and b["is_major_destination"] is True
    # -12 C (+0.3), 11 mm (+0.4 cap), 30 km/h (+0.3 cap) -> capped at 1
    assert b["weather_severity_score"] == 1.0


def test_dedup_null_keys_equal_completeness_three_copies(spark):
    df = spark.createDataFrame([
        (None, "S1", 1, "a", None),
        (None, "S1", 2, "a", "x"),      # most complete copy of the null-key group
        ("T", "S1", 3, None, None),
        ("T", "S1", 4, None, None),     # equal completeness: smallest ingest_seq (3) wins
        ("U", "S2", 7, "b", None),
        ("U", "S2", 5, "b", None),
        ("U", "S2", 6, "b", None),      # three copies -> one
    ], "train_id string, station_code string, ingest_seq int, route string, note string")
    out = sorted(rows(dedup_best(df, keys=["train_id", "station_code"], tie_break="ingest_seq"), "ingest_seq"))
    assert out == [(2,), (3,), (5,)]
    last = sorted(rows(dedup_last(df, keys=["train_id", "station_code"], order_by="ingest_seq"), "ingest_seq"))
    assert last == [(2,), (4,), (7,)]
    assert rows(duplicate_count(df, ["train_id", "station_code"])) == [(4,)]
    flags = dict(rows(duplicate_flag(df, keys=["train_id", "station_code"], order_by="ingest_seq"),
                      "ingest_seq", "is_duplicate"))
    assert flags == {1: False, 2: True, 3: False, 4: True, 5: False, 6: True, 7: True}


def test_dedup_is_idempotent(spark):
    from trackcast import fixtures
    raw = fixtures.trains_raw(spark, "/root/testdata/sf0.001")
    once = dedup_best(raw, keys=["train_id", "timestamp", "station_code"], tie_break="ingest_seq")
    twice = dedup_best(once, keys=["train_id", "timestamp", "station_code"], tie_break="ingest_seq")
    assert once.exceptAll(twice).count() == 0 and twice.exceptAll(once).count() == 0


@pytest.mark.parametrize("text,expected", [
    ("12:34:56 - 01/02", "2024-01-05 12:34:00"), ("07:05", "2024-01-05 07:05:00"), ("X", None),
    ("Non rilevato", None), ("", None), ("  ", None), ("1234", None), ("25:00", None), ("12:61", None),
    ("ab:cd", None), (None, None),
])
def test_parse_clock_forms(spark, text, expected):
    df = spark.createDataFrame([(text, date(2024, 1, 5))], "t string, d date")
    got = df.select(parse_clock(F.col("t"), F.col("d")).alias("p")).first()["p"]
    assert got == (ts(expected) if expected else None)


def test_parse_delay_rejects_negative_and_blank(spark):
    from trackcast.functions.text import parse_delay
    df = spark.createDataFrame([("-3",), ("12",), ("",), (None,), (" 4",), ("+2",)], "t string")
    assert [r[0] for r in df.select(parse_delay(F.col("t"))).collect()] == [0, 12, 0, 0, 0, 0]


def test_page_parsing_edges(spark):
    from trackcast.sources.parsers import parse_train_pages
    full = "Cat,Num,Route,a,b,c,d,e,f"
    ok = "RE,101,Rx<br>Munich (M),12:00:00 - 05/01,12:04,4,12:00:00 - 05/01,12:07,7"
    cancelled = "IC,7,Como,13:00,,0,13:00,X,0"
    short = "RE,1,2,3,4,5,6,7"
    pages = spark.createDataFrame([
        (1, "S1", date(2024, 1, 5), "<p>no table here</p>"),
        (2, "S1", date(2024, 1, 5), f"var table = ['{full}'];"),
        (3, "S1", date(2024, 1, 5), f"x\nvar table = ['{full}', '  ', '{ok}',\n'{short}', '', '{cancelled}'];"),
    ], "page_id int, station_code string, day date, html string")
    res = parse_train_pages(pages)
    counts = {r["page_id"]: (r["has_table"], r["entries_found"], r["kept"], r["rejected"])
              for r in res["counts"].collect()}
    assert counts == {1: (False, 0, 0, 0), 2: (True, 1, 0, 0), 3: (True, 4, 2, 1)}
    got = {r["train_id"]: r for r in res["rows"].collect()}
    assert got["101"]["delay_minutes"] == 7 and got["101"]["delay_status"] == "delayed"
    assert got["101"]["destination"] == "Munich" and got["101"]["scheduled_time"] == ts("2024-01-05 12:00")
    assert got["101"]["actual_time"] == ts("2024-01-05 12:07")
    assert got["7"]["delay_status"] == "cancelled" and got["7"]["actual_time"] is None and got["7"]["is_cancelled"]
    assert [r["entry"] for r in res["rejected"].collect()] == [short]


def test_hourly_payload_edges(spark):
    from trackcast.sources.parsers import explode_hourly
    docs = spark.createDataFrame([
        ('{"station_code":"S1","hourly":{"time":["2024-01-01T00:00","2024-01-01T01:00"],'
         '"temperature_2m":[1.5,2.5],"precipitation":[0.1],"windspeed_10m":[3.0,4.0],"weathercode":[1,2]}}',),
        ('{"station_code":"S2"}',),
    ], "payload string")
    out = rows(explode_hourly(docs), "station_code", "timestamp", "temperature", "precip_mm")
    assert sorted(out) == [("S1", "2024-01-01T00:00", 1.5, 0.1), ("S1", "2024-01-01T01:00", 2.5, None)]


def test_upsert_edges(spark):
    from trackcast.sources.sinks import upsert
    old = spark.createDataFrame([("S1", "One", 45.0, 9.0), ("S2", "Two", 46.0, 10.0)],
                                "station_code string, station_name string, latitude double, longitude double")
    new = spark.createDataFrame([("S2", "TWO", None, 10.5), ("S3", "Three", 1.0, 2.0)], old.schema)
    once = upsert(new, old, "station_code", overwrite=("station_name",), coalesce_new_first=("latitude", "longitude"))
    got = {r[0]: tuple(r[1:]) for r in once.collect()}
    assert got == {"S1": ("One", 45.0, 9.0), "S2": ("TWO", 46.0, 10.5), "S3": ("Three", 1.0, 2.0)}
    twice = upsert(new, once, "station_code", overwrite=("station_name",), coalesce_new_first=("latitude", "longitude"))
    assert sorted(rows(twice)) == sorted(rows(once))


def test_insert_if_absent_twice_equals_once(spark):
    from trackcast.sources.sinks import insert_if_absent
    existing = spark.createDataFrame([("S1", 1, 10)], "station_code string, t int, ingest_seq int")
    new = spark.createDataFrame([("S1", 1, 20), ("S1", 2, 21), ("S1", 2, 22), ("S2", 1, 23)], existing.schema)
    first = insert_if_absent(new, existing, ["station_code", "t"], "ingest_seq")
    assert sorted(rows(first)) == [("S1", 2, 21), ("S2", 1, 23)]
    table = existing.unionByName(first)
    assert insert_if_absent(new, table, ["station_code", "t"], "ingest_seq").count() == 0


@pytest.mark.parametrize("score,level", [(0.95, "EXCELLENT"), (0.9499, "GOOD"), (0.85, "GOOD"), (0.8499, "ACCEPTABLE"),
                                         (0.70, "ACCEPTABLE"), (0.6999, "POOR")])
def test_quality_levels(spark, score, level):
    rule = "struct<rule_type:string, passed:boolean, emit:boolean, affected_records:bigint>"
    report = spark.createDataFrame([("2024-01-01", score, 10, 0, [])], "date string, overall_quality_score double, "
                                   f"total long, total_flagged_records long, rule_list array<{rule}>")
    out = post.summary({"report": report}).first()
    assert out["quality_level"] == level and out["issues_by_type"] is None


def test_rule_counts_match_flags(spark):
    from trackcast import fixtures
    from trackcast.operators import rules as R
    raw = fixtures.weather_raw(spark, "/root/testdata/sf0.001")
    rules = R.weather_business_rules()
    counts = {r["rule_name"]: r["affected_records"] for r in R.rule_counts(raw, rules, processor="w", step="b").collect()}
    applied = R.apply_rules(raw, rules, init_flags=("temp_range_violation", "precip_range_violation"))
    agg = applied.agg(F.sum("temp_range_violation"), F.sum("precip_range_violation")).first()
    assert counts["temperature_range_validation"] == agg[0]
    assert counts["precip_mm_range_validation"] == agg[1]
    assert applied.where((F.col("temperature") < -20) | (F.col("temperature") > 50)).count() == 0


def test_all_invalid_batch_gives_empty_output(spark):
    raw = spark.createDataFrame([("1", None, None)], f"train_id string, timestamp {TS}, station_code string")
    assert dq.process_train(raw.withColumn("ingest_seq", F.lit(1))).count() == 0


def test_points_in_region(spark):
    from trackcast.operators.spatial import points_in_region
    ring = ((0.0, 0.0), (4.0, 0.0), (4.0, 4.0), (0.0, 4.0))
    df = spark.createDataFrame([("in", 2.0, 2.0), ("out", 5.0, 2.0), ("nolat", None, 2.0)],
                               "code string, longitude double, latitude double")
    assert rows(points_in_region(df, ring), "code") == [("in",)]


def test_nearest_join_exact_at_bucket_edges(spark):
    """A row 1 us before an hour edge still finds the observation exactly 60 min
    earlier: bucket indices are exact integers, not rounded doubles."""
    from datetime import timedelta
    base = ts("2024-01-17 00:00:00")
    left = spark.createDataFrame([(h, f"S{h}", base + timedelta(hours=h, microseconds=-1)) for h in range(48)],
                                 f"id int, station_code string, timestamp {TS}")
    right = spark.createDataFrame([(f"S{h}", base + timedelta(hours=h - 1, microseconds=-1), float(h))
                                   for h in range(48)], f"station_code string, timestamp {TS}, v double")
    got = dict(rows(nearest_join(left, right, right_cols=["v"]), "id", "v"))
    assert got == {h: float(h) for h in range(48)}


def test_attach_one_row_requires_a_proven_bound(spark):
    from trackcast.operators.attach import attach_one_row, max_rows
    rows_df = spark.range(10)
    one = rows_df.agg(F.max("id").alias("m"))
    assert max_rows(one) == 1 and max_rows(rows_df.where("id > 3")) is None or max_rows(rows_df.where("id > 3")) > 1
    assert attach_one_row(rows_df, one).count() == 10
    with pytest.raises(ValueError):
        attach_one_row(one, rows_df.where("id > 3"))


@pytest.mark.parametrize("text, want", [
    ("2024-01-01T10:00:00Z", "2024-01-01 10:00:00"), ("2024-01-01T10:00:00+02:00", "2024-01-01 08:00:00"),
    ("2024-01-01 10:00 -0530", "2024-01-01 15:30:00"), ("20240101T100000+01", "2024-01-01 09:00:00"),
    ("Jan 2 2024 10:00", "2024-01-02 10:00:00"), ("2 Jan 2024 10:00:30", "2024-01-02 10:00:30"),
    ("2024-01-15", "2024-01-15 00:00:00"), ("15/01/2024", "2024-01-15 00:00:00"), ("20240115T1030", "2024-01-15 10:30:00"),
    ("2024-13-01T10:00", None), ("at 10:00", None), ("", None), (None, None)])
def test_timestamp_texts(spark, text, want):
    df = spark.createDataFrame([(text,)], "timestamp string")
    got = df.select(TF.parse_timestamp("timestamp").alias("t")).first()[0]
    assert (None if got is None else str(got)) == want


def test_timestamp_text_without_offset_is_in_the_source_zone(spark):
    df = spark.createDataFrame([("2024-01-01 10:00",), ("2024-07-01 10:00",), ("2024-07-01T10:00Z",)], "timestamp string")
    got = [str(r[0]) for r in df.select(TF.parse_timestamp("timestamp", source_tz="Europe/Rome")).collect()]
    assert got == ["2024-01-01 09:00:00", "2024-07-01 08:00:00", "2024-07-01 10:00:00"]


def test_half_even_follows_the_clock_of_the_zone(spark):
    df = spark.createDataFrame([(ts("2024-01-01 12:30:00"),), (ts("2024-07-01 12:30:00"),)], f"t {TS}")
    pick = lambda zone: [str(r[0]) for r in df.select(TF.round_hour_half_even("t", zone)).collect()]
    assert pick("UTC") == ["2024-01-01 12:00:00", "2024-07-01 12:00:00"]
    assert pick("Europe/Rome") == ["2024-01-01 13:00:00", "2024-07-01 12:00:00"]


def test_options_that_the_defaults_leave_off(spark):
    from trackcast.functions.text import parse_delay
    from trackcast.plans import dq
    day = spark.sql("select date'2024-01-05' as d, '23:50 - 04/01' as s, '23:50 - 31/02' as bad, '10:15' as plain")
    got = day.select(*[TF.parse_clock(c, "d", use_suffix_date=True) for c in ("s", "bad", "plain")]).first()
    assert [str(x) for x in got] == ["2024-01-04 23:50:00", "None", "2024-01-05 10:15:00"]
    assert str(day.select(TF.parse_clock("s", "d")).first()[0]) == "2024-01-05 23:50:00"
    text = spark.createDataFrame([("-7",), ("7",), ("x",)], "t string")
    assert [r[0] for r in text.select(parse_delay(F.col("t"), allow_negative=True)).collect()] == [-7, 7, 0]
    assert [r[0] for r in text.select(parse_delay(F.col("t"))).collect()] == [0, 7, 0]
    df = spark.createDataFrame([("a", None, 1), ("b", "x", None), (None, None, None)], "p string, q string, r int")
    assert [r["p"] for r in dq.drop_invalid_rows(df, ("p", "q")).collect()] == ["b"]
    assert [r["p"] for r in dq.drop_missing_critical(df, ("p", "q", "r"), 0.5).collect()] == ["a", "b"]
