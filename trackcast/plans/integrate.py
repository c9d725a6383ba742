"""Train-weather integration."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trackcast.config import INTEGRATED_COLUMNS, WEATHER_FIELDS
from trackcast.operators.features import engineer_features
from trackcast.operators.nearest import nearest_join
from trackcast.operators.attach import one_row

TRAIN_PART = ("train_id", "timestamp", "station_code", "delay_minutes", "train_category", "route",
              "delay_status", "destination", "is_cancelled")
WEATHER_PART = ("temperature", "wind_speed", "precip_mm", "weather_code")


def match_weather(trains: DataFrame, weather: DataFrame, *, tolerance_minutes: int = 60,
                  matched_col: str | None = None) -> DataFrame:
    """Integrated record per train row: 9 train columns + the 4 weather
    columns of the nearest observation at the station (nulls when none)."""
    left = trains.select(*[c for c in TRAIN_PART if c in trains.columns])
    right = weather.select("station_code", "timestamp", *[c for c in WEATHER_PART if c in weather.columns])
    return nearest_join(left, right, by="station_code", left_ts="timestamp", right_ts="timestamp",
                        tolerance_minutes=tolerance_minutes, right_cols=list(WEATHER_PART), matched_col=matched_col)


def project_integrated(df: DataFrame) -> DataFrame:
    """Keep the target table columns that exist, in table order."""
    return df.select(*[c for c in INTEGRATED_COLUMNS if c in df.columns])


def integration_quality(integrated: DataFrame, trains: DataFrame, weather: DataFrame) -> DataFrame:
    """Source counts, rows, temperature match rate and
    ``min(rate + 0.2, 1)`` as the quality score."""
    i = integrated.agg(F.count(F.lit(1)).alias("total_records"),
                       F.count("temperature").alias("weather_matched"))
    t = trains.agg(F.count(F.lit(1)).alias("train_records"))
    w = weather.agg(F.count(F.lit(1)).alias("weather_records"))
    rate = F.when(F.col("total_records") > 0, F.col("weather_matched") / F.col("total_records")).otherwise(F.lit(0.0))
    return (one_row(t, w, i)
             .select("train_records", "weather_records", "total_records", "weather_matched",
                     rate.alias("match_rate"), F.least(rate + F.lit(0.2), F.lit(1.0)).alias("quality_score")))


def integrate(trains: DataFrame, weather: DataFrame, *, tolerance_minutes: int = 60,
              features: bool = True) -> DataFrame:
    """G24 core: nearest match then features, projected to the target table."""
    out = match_weather(trains, weather, tolerance_minutes=tolerance_minutes)
    if features:
        out = engineer_features(out)
    return out


def weather_any(df: DataFrame):
    pred = F.lit(False)
    for c in WEATHER_FIELDS:
        if c in df.columns:
            pred = pred | F.col(c).isNotNull()
    return pred
