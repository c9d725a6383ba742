"""Explicit schemas of the warehouse tables and raw payloads (never inferred)."""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType, BooleanType, DoubleType, IntegerType, StringType, StructField, StructType,
    TimestampNTZType,
)

TS = TimestampNTZType()

STATIONS = StructType([
    StructField("station_code", StringType(), False),
    StructField("station_name", StringType(), True),
    StructField("latitude", DoubleType(), True),
    StructField("longitude", DoubleType(), True),
])

TRAINS = StructType([
    StructField("train_id", StringType(), False),
    StructField("timestamp", TS, False),
    StructField("station_code", StringType(), True),
    StructField("scheduled_time", TS, True),
    StructField("actual_time", TS, True),
    StructField("delay_minutes", IntegerType(), True),
    StructField("train_category", StringType(), True),
    StructField("route", StringType(), True),
    StructField("delay_status", StringType(), True),
    StructField("destination", StringType(), True),
    StructField("is_cancelled", BooleanType(), True),
])

WEATHER = StructType([
    StructField("station_code", StringType(), True),
    StructField("timestamp", TS, False),
    StructField("temperature", DoubleType(), True),
    StructField("wind_speed", DoubleType(), True),
    StructField("precip_mm", DoubleType(), True),
    StructField("weather_code", IntegerType(), True),
])

# Raw hourly weather payload (one JSON object per station request).
HOURLY_PAYLOAD = StructType([
    StructField("station_code", StringType(), True),
    StructField("hourly", StructType([
        StructField("time", ArrayType(StringType()), True),
        StructField("temperature_2m", ArrayType(DoubleType()), True),
        StructField("precipitation", ArrayType(DoubleType()), True),
        StructField("windspeed_10m", ArrayType(DoubleType()), True),
        StructField("weathercode", ArrayType(IntegerType()), True),
    ]), True),
])

# Raw station feed record.
STATION_FEED = StructType([
    StructField("codiceStazione", StringType(), True),
    StructField("localita", StructType([StructField("nomeLungo", StringType(), True)]), True),
    StructField("lat", StringType(), True),
    StructField("lon", StringType(), True),
])
