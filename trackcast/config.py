"""Thresholds and parameters of the operators (driver-side, frozen).

FIXED VALUES: every number and list in this module must equal the behaviour
being reproduced (rule limits, bin edges, labels, weights, key lists).
"""

from __future__ import annotations

from dataclasses import dataclass

INF = float("inf")


@dataclass(frozen=True)
class TrainConfig:
    required_fields: tuple = ("station_code", "timestamp", "train_id")
    target_timezone: str = "Europe/Rome"
    dedup_keys: tuple = ("train_id", "timestamp", "station_code")
    delay_unknown_value: int = -1
    missing_value_threshold: float = 0.5
    critical_fields: tuple = ("station_code", "timestamp", "train_id", "scheduled_time")
    delay_min_threshold: int = -5
    delay_max_threshold: int = 300
    temperature_min: float = -20.0
    temperature_max: float = 50.0
    min_coverage_threshold: float = 0.8


@dataclass(frozen=True)
class WeatherConfig:
    required_fields: tuple = ("station_code", "timestamp", "temperature")
    target_timezone: str = "Europe/Rome"
    timestamp_tolerance_s: int = 3600
    dedup_keys: tuple = ("station_code", "timestamp")
    temperature_min: float = -20.0
    temperature_max: float = 50.0
    precip_mm_min: float = 0.0
    precip_mm_max: float = 500.0
    wind_speed_min: float = 0.0
    wind_speed_max: float = 200.0
    weather_code_min: int = 0
    weather_code_max: int = 99
    max_gap_hours: int = 6
    expected_frequency_hours: int = 1
    missing_value_threshold: float = 0.3
    critical_fields: tuple = ("station_code", "timestamp")


@dataclass(frozen=True)
class IntegrationConfig:
    time_tolerance_minutes: int = 60
    max_time_difference_s: int = 3600
    require_station_coordinates: bool = True
    coordinate_precision: int = 6
    min_weather_coverage: float = 0.7
    min_train_coverage: float = 0.8


@dataclass(frozen=True)
class ReportConfig:
    include_recommendations: bool = True
    max_examples_per_rule: int = 5
    critical_quality_threshold: float = 0.7
    warning_quality_threshold: float = 0.85


@dataclass(frozen=True)
class PostThresholds:
    min_weather_match_rate: float = 0.95
    max_null_rate: float = 0.05
    max_anomaly_rate: float = 0.02
    min_feature_completeness: float = 0.98
    required_columns: tuple = (
        "train_id", "timestamp", "station_code", "delay_minutes",
        "temperature", "wind_speed", "precip_mm", "weather_code",
        "train_category", "route", "delay_status", "destination", "is_cancelled",
    )
    feature_columns: tuple = (
        "hour_of_day", "day_of_week", "is_weekend", "is_rush_hour",
        "is_raining", "rain_intensity", "wind_category",
        "is_delayed", "delay_category",
    )
    # pillar weights in assessment order
    weights: tuple = (0.3, 0.25, 0.2, 0.15, 0.1)


# FIXED VALUES: pre-integration pillar weights (completeness, accuracy,
# consistency, uniqueness, coverage).
PRE_WEIGHTS = (0.25, 0.25, 0.20, 0.15, 0.15)

# FIXED VALUES: feature engineering constants.
RUSH_HOURS = ((7, 9), (17, 19))
WEEKEND_DAYS = (5, 6)
HIGH_SPEED_CATEGORIES = ("ICE", "TGV", "AVE", "Frecciarossa", "Shinkansen")
REGIONAL_CATEGORIES = ("RE", "RB", "S", "Regional")
MAJOR_CITIES = ("Berlin", "Munich", "Hamburg", "Frankfurt", "Cologne", "Stuttgart")
DELAY_STATUSES = ("on_time", "delayed", "early", "cancelled")
DELAY_STATUS_CODES = {"on_time": 0, "early": -1, "delayed": 1, "cancelled": 2}
SEASONS = {12: "Winter", 1: "Winter", 2: "Winter", 3: "Spring", 4: "Spring", 5: "Spring",
           6: "Summer", 7: "Summer", 8: "Summer", 9: "Autumn", 10: "Autumn", 11: "Autumn"}

# FIXED VALUES: bin edges (right-closed) and labels.
TIME_PERIOD_BINS = ((0, 6, 12, 18, 24), ("Night", "Morning", "Afternoon", "Evening"))
TEMP_BINS = ((-INF, 0, 10, 20, 30, INF), ("Freezing", "Cold", "Cool", "Warm", "Hot"))
RAIN_BINS = ((0, 0.1, 2.5, 10, 50, INF), ("None", "Light", "Moderate", "Heavy", "Extreme"))
WIND_BINS = ((0, 5, 15, 25, 35, INF), ("Calm", "Light", "Moderate", "Strong", "Severe"))
DELAY_BINS = ((-INF, -5, 5, 15, 30, 60, INF),
              ("Early", "On_Time", "Minor_Delay", "Moderate_Delay", "Major_Delay", "Severe_Delay"))
TRAFFIC_LABELS = ("Low_Traffic", "Medium_Traffic", "High_Traffic")
TRAFFIC_QUANTILES = (0.33, 0.67)

# FIXED VALUES: target table column order of the integrated table.
INTEGRATED_COLUMNS = (
    "train_id", "timestamp", "station_code", "delay_minutes", "temperature",
    "wind_speed", "precip_mm", "weather_code", "train_category", "route",
    "delay_status", "destination", "is_cancelled", "hour_of_day", "day_of_week",
    "is_weekend", "is_rush_hour", "temp_category", "is_raining", "rain_intensity",
    "wind_category", "is_delayed", "delay_category",
)
TRAIN_COLUMNS = (
    "train_id", "timestamp", "station_code", "scheduled_time", "actual_time",
    "delay_minutes", "train_category", "route", "delay_status", "destination", "is_cancelled",
)
WEATHER_COLUMNS = ("station_code", "timestamp", "temperature", "wind_speed", "precip_mm", "weather_code")
WEATHER_FIELDS = ("temperature", "precip_mm", "wind_speed", "weather_code")
