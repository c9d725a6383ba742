"""Streaming queries (X1-X4): landed files drained as streams, results equal to SQL over all rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from trackcast.catalog import register
from trackcast.config import WeatherConfig
from trackcast.session import new_work_dir
from trackcast.streaming import jobs as X

WC = WeatherConfig()


def _dirs(s, name: str) -> dict[str, str]:
    root = new_work_dir(s.spark, f"stream-{name}")
    return {k: f"{root}/{k}" for k in ("landing", "landing2", "target", "checkpoint")}


def _weather_landed(s, path):
    w = s.weather_raw.select("station_code", "timestamp", "temperature", "wind_speed", "precip_mm", "weather_code",
                             "ingest_seq")
    X.land_json(w, path)
    return w.schema


def _trains_landed(s, path):
    t = s.trains_clean.select("train_id", "timestamp", "station_code", "delay_minutes", "ingest_seq")
    X.land_json(t, path)
    return t.schema


_WNORM = """(select station_code, date_trunc('hour', timestamp + interval 30 minute) as timestamp, temperature,
  wind_speed, precip_mm, weather_code, ingest_seq from weather_raw where timestamp is not null)"""
_FIRST = f"""select station_code, timestamp, temperature, wind_speed, precip_mm, weather_code, ingest_seq from (
  select *, row_number() over (partition by station_code, timestamp order by ingest_seq) as rn from {_WNORM} x) f
where rn = 1"""


@register("incremental_ingest", _FIRST)
def incremental_ingest(s):
    """Landed weather files ingested with insert-if-absent per micro-batch
    (run twice: the second run finds no new file and adds nothing)."""
    d = _dirs(s, "ingest")
    schema = _weather_landed(s, d["landing"])
    from trackcast.plans.dq import normalize_timestamps
    for _ in range(2):
        X.incremental_ingest(s.spark, d["landing"], d["target"], d["checkpoint"], schema,
                             ["station_code", "timestamp"], "ingest_seq",
                             normalize=lambda b: normalize_timestamps(b, round_to_hour=True))
    return s.spark.read.parquet(d["target"]).drop("date")


@register("stream_dedup", _FIRST)
def stream_dedup(s):
    """Landed weather rounded to the hour, then the first row per (station, hour)."""
    d = _dirs(s, "dedup")
    schema = _weather_landed(s, d["landing"])
    from trackcast.functions.timefns import round_hour_half_up
    X.stream_dedup(s.spark, d["landing"], d["target"], d["checkpoint"], schema, WC.dedup_keys, "ingest_seq",
                   prepare=lambda df: df.where(F.col("timestamp").isNotNull()).withColumn(
                       "timestamp", round_hour_half_up("timestamp")))
    return X.folded(s.spark, d["target"])


@register("stream_nearest", "select c.train_id, c.timestamp, c.station_code, c.delay_minutes, c.ingest_seq, "
          "i.temperature, i.wind_speed, i.precip_mm, i.weather_code from trains_clean c "
          "join integrated i on i.train_id = c.train_id and i.timestamp = c.timestamp and i.station_code = c.station_code")
def stream_nearest(s):
    """Trains and weather drained as two streams, then every touched date matched whole."""
    d = _dirs(s, "nearest")
    tschema = _trains_landed(s, d["landing"])
    w = s.weather.select("station_code", "timestamp", "temperature", "wind_speed", "precip_mm", "weather_code")
    X.land_json(w, d["landing2"])
    X.stream_store(s.spark, d["landing"], d["target"] + "-l", d["checkpoint"] + "-l", tschema)
    X.stream_store(s.spark, d["landing2"], d["target"] + "-r", d["checkpoint"] + "-r", w.schema)
    X.finish_nearest(s.spark, d["target"] + "-l", d["target"] + "-r", d["target"],
                     right_cols=["temperature", "wind_speed", "precip_mm", "weather_code"])
    return s.spark.read.parquet(d["target"]).drop("date")


@register("stream_hourly_dq", """
select date_trunc('hour', timestamp) as window_start, date_trunc('hour', timestamp) + interval 1 hour as window_end,
  count(*) as rows, count(*) filter (where delay_minutes is null) as null_delays,
  count(*) filter (where delay_minutes > 5) as delayed from trains_clean group by 1, 2""")
def stream_hourly_dq(s):
    """Hourly row / null-delay / delayed counters of the landed trains."""
    d = _dirs(s, "hourly")
    schema = _trains_landed(s, d["landing"])
    X.stream_hourly_dq(s.spark, d["landing"], d["target"], d["checkpoint"], schema)
    return X.folded(s.spark, d["target"])
