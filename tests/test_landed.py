"""Rendered documents: fragments of bounded size give the rows of the whole documents."""

from pyspark.sql import functions as F

from trackcast import landed
from trackcast.sources import parsers as P


def _trains(spark, n):
    """``n`` rows of one station-hour, sequence numbers far apart and in no order of time."""
    t = spark.range(n).select(
        F.col("id").cast("string").alias("train_id"), F.lit("S01").alias("station_code"),
        F.expr("timestamp_ntz'2024-01-10 08:00:00' + make_dt_interval(0, 0, 0, id % 3600)").alias("timestamp"),
        (F.col("id") % 7 - 1).cast("int").alias("delay_minutes"), F.lit("RE").alias("train_category"), F.lit("R<br>Como").alias("route"),
        F.lit(False).alias("is_cancelled"), (F.col("id") * 1_000_003 % 999_999_937).alias("ingest_seq"))
    return t.withColumns({"scheduled_time": F.col("timestamp"), "actual_time": F.col("timestamp")})


def _no_pages(spark):
    return spark.createDataFrame([], "page_id long, html string")


def test_a_hot_station_hour_is_rows_of_bounded_size(spark):
    """A million trains of one hour: no text beyond a fixed size, every train parsed, positions without a gap."""
    n = 1_000_000
    pages = landed.train_pages(_trains(spark, n), _no_pages(spark))
    sizes = pages.agg(F.max(F.length("html")).alias("longest"), F.count(F.lit(1)).alias("rows")).first()
    assert sizes["longest"] < landed.FRAGMENT * 150 and sizes["rows"] == n // landed.FRAGMENT
    out = P.parse_train_pages(pages)
    got = out["rows"].agg(F.count_distinct("pos").alias("n"), F.min("pos").alias("lo"), F.max("pos").alias("hi")).first()
    assert tuple(got) == (n, 0, n - 1)
    counts = out["counts"].first()
    assert (counts["entries_found"], counts["kept"], counts["rejected"]) == (n + 2, n, 1)


def test_fragments_equal_whole_pages(spark, monkeypatch):
    trains = _trains(spark, 95).unionByName(_trains(spark, 30).withColumn("station_code", F.lit("S02")))
    web = spark.createDataFrame([(0, "<p>no table</p>"), (1, None), (2, "var table = ['only header'];"), (3, "var table = [' '];")],
                                "page_id long, html string")
    whole = P.parse_train_pages(landed.train_pages(trains, web).drop("first"))
    want = {k: sorted(map(str, whole[k].collect())) for k in ("rows", "rejected", "counts")}
    for size in (1, 7, 30):
        monkeypatch.setattr(landed, "FRAGMENT", size)
        monkeypatch.setattr(landed, "SLOT", 1 << 20)
        parts = P.parse_train_pages(landed.train_pages(trains, web))
        assert {k: sorted(map(str, parts[k].collect())) for k in want} == want, size


def test_payload_fragments_equal_whole_payloads(spark, monkeypatch):
    w = spark.range(400).select(
        F.concat(F.lit("S0"), (F.col("id") % 3).cast("string")).alias("station_code"),
        F.expr("timestamp_ntz'2024-01-10 00:00:00' + make_dt_interval(0, 0, 0, (id * 977) % 100000)").alias("timestamp"),
        (F.col("id") * 0.5).alias("temperature"), (F.col("id") % 5 * 1.0).alias("precip_mm"), F.lit(1.0).alias("wind_speed"),
        F.lit(3).alias("weather_code"), F.col("id").alias("ingest_seq"))
    want = sorted(map(str, P.explode_hourly(landed.hourly_payloads(w).drop("first")).collect()))
    for size in (1, 7, 100):
        monkeypatch.setattr(landed, "FRAGMENT", size)
        got = landed.hourly_payloads(w)
        assert sorted(map(str, P.explode_hourly(got).collect())) == want
        assert got.agg(F.max(F.length("payload"))).first()[0] < 200 + 120 * size
