"""End-to-end warehouse job (scheduler + tasks of the reference as one Spark job).

``run_pipeline`` takes raw train / weather rows and a warehouse folder in
shared storage and:

1. cleans both feeds (G5, G6), each written once to the shared work folder;
2. marks the dates that what it is about to store touches as pending (see
   below), then stores trains of dates not yet loaded (B8) and weather rows
   whose (station, hour) is absent (B2), date-partitioned, and appends the step
   metrics of the new train dates and of the weather dates touched (L1, J1, B7);
3. goes through the requested range in chunks anchored on its start (B10).
   In a chunk every pending date whose own weather is stored is integrated
   (per-date skip, B9), so neither days nor weather that arrive later are lost;
   a chunk none of whose pending dates has weather of its own is refused and
   stored nowhere (N19), so it is tried again when its rows have come;
4. matches those dates' trains against weather widened by a day on each side,
   engineers features over them, and replaces their partitions of the
   integrated table (B4);
5. assesses the dates (G15-G22) and replaces their report rows (L4).

The table ``dates`` beside the others is the ledger, one row per train date: *pending* until the date is integrated with weather of
its own, *final* after that, and pending again when weather within the tolerance of it is stored later. A date is marked pending
before the rows that touch it are stored and final after everything about it is stored, so a run that ends anywhere between leaves it
pending, and the next run does it whole again; replaced partitions keep that from duplicating rows.

Every output is written before the next step reads it. Stored dates are folder names (listed, no file is opened), stored
rows are read only from the partitions a step needs.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from trackcast.config import INTEGRATED_COLUMNS, TRAIN_COLUMNS, WEATHER_COLUMNS, TrainConfig, WeatherConfig
from trackcast.operators import rules as R
from trackcast.operators.features import engineer_features
from trackcast.plans import dq, metrics, post
from trackcast.plans.integrate import match_weather, project_integrated
from trackcast.session import drop_path, work_table
from trackcast.sources import sinks as B

NO_SOURCE = "No source data available"
PENDING, FINAL = "pending", "final"
LEDGER = StructType().add("state", StringType()).add("date", StringType())
REPORT = "post_integration_report"


def _schema_of(df: DataFrame, extra: dict | None = None) -> StructType:
    s = StructType(list(df.schema.fields))
    for k, v in (extra or {}).items():
        s = s.add(k, v)
    return s


def _dates(df: DataFrame) -> list[str]:
    """The dates of a date-partitioned table or frame (a bounded calendar)."""
    return sorted(r["date"] for r in df.select("date").distinct().collect() if r["date"] is not None)


def _stored_dates(spark: SparkSession, path: str) -> list[str]:
    return _dates(B.stored_partitions(spark, path, ("date",)))


def _around(dates: list[str], tolerance_minutes: int) -> list[str]:
    """The dates and their neighbours: where weather within the tolerance can lie."""
    reach = max(1, -(-tolerance_minutes // 1440))
    days = {dt.date.fromisoformat(d) + dt.timedelta(days=k) for d in dates for k in range(-reach, reach + 1)}
    return sorted(d.isoformat() for d in days)


def _touched(weather: DataFrame, tolerance_minutes: int) -> list[str]:
    """The dates that have a moment within the tolerance of an observation (a bounded calendar)."""
    first, last = (F.to_date(F.timestamp_add("MINUTE", F.lit(k * int(tolerance_minutes)), F.col("timestamp"))) for k in (-1, 1))
    days = weather.select(F.explode(F.sequence(first, last)).alias("day")).select(F.date_format("day", "yyyy-MM-dd").alias("date"))
    return _dates(days)


def ledger(spark: SparkSession, path: str) -> dict[str, str]:
    """State of every train date known to the warehouse."""
    rows = B.read_if_exists(spark, path, LEDGER).select("date", "state").collect()  # one row a date: a bounded calendar
    return {r["date"]: r["state"] for r in rows}


def _mark(spark: SparkSession, path: str, dates: list[str], state: str) -> None:
    if dates:
        frame = spark.createDataFrame([(state, d) for d in dates], LEDGER)
        frame.coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("date").parquet(path)


def run_pipeline(spark: SparkSession, *, trains_raw: DataFrame, weather_raw: DataFrame, warehouse: str,
                 tolerance_minutes: int = 60, chunk_days: int = 1, start_date: str | None = None,
                 end_date: str | None = None) -> dict:
    """Runs the job; returns the table paths and one result per chunk.

    The range defaults to the stored train dates, from the first to the last. A result holds the range,
    success, whether it was skipped, the error if refused, source and integrated row counts, match rate and quality score."""
    wh = warehouse.rstrip("/")
    paths = {k: f"{wh}/{k}" for k in ("trains", "weather", "integrated", "metrics", "dates")}

    # 1. clean, once
    trains, trains_at = work_table(B.with_date(dq.process_train(trains_raw).select(*TRAIN_COLUMNS)), "trains")
    weather, weather_at = work_table(B.with_date(
        dq.process_weather(weather_raw).select(*WEATHER_COLUMNS, "ingest_seq")), "weather")

    # 2. store: trains by date (skip loaded dates), weather insert-if-absent in the dates it touches
    loaded = set(_stored_dates(spark, paths["trains"]))
    new_dates = [d for d in _dates(trains) if d not in loaded]
    w_dates = _dates(weather)
    stored = B.read_if_exists(spark, paths["weather"], weather.schema).where(F.col("date").isin(w_dates))
    fresh, fresh_at = work_table(B.insert_if_absent(weather, stored, ["station_code", "timestamp"], "ingest_seq"),
                               "weather-new")
    fresh_dates = _dates(fresh)
    state = ledger(spark, paths["dates"])
    have = sorted(loaded | set(new_dates))
    open_ = set(new_dates) | (set(_touched(fresh, tolerance_minutes)) & set(have)) | {d for d in have if d not in state}
    _mark(spark, paths["dates"], sorted(d for d in open_ if state.get(d) != PENDING), PENDING)
    state |= {d: PENDING for d in open_}
    trains.where(F.col("date").isin(new_dates)).write.mode("append").partitionBy("date").parquet(paths["trains"])
    fresh.write.mode("append").partitionBy("date").parquet(paths["weather"])
    _append_step_metrics(trains_raw, weather_raw, new_dates, fresh_dates, paths["metrics"])
    for path in (trains_at, weather_at, fresh_at):
        drop_path(spark, path)

    # 3. - 5. chunk by chunk over the requested range
    have_weather = set(_stored_dates(spark, paths["weather"]))
    results = []
    if have:
        first, last = dt.date.fromisoformat(start_date or have[0]), dt.date.fromisoformat(end_date or have[-1])
        while first <= last:
            until = min(first + dt.timedelta(days=chunk_days - 1), last)
            inside = [d for d in have if first.isoformat() <= d <= until.isoformat()]
            results.append(_integrate_chunk(spark, paths, first.isoformat(), until.isoformat(), inside, state, have_weather,
                                            trains.schema, weather.schema, tolerance_minutes))
            first = until + dt.timedelta(days=1)
    return {"paths": paths, "results": results}


def _append_step_metrics(trains_raw, weather_raw, train_dates: list[str], weather_dates: list[str], path: str) -> None:
    """L1 + J1 rows of the dates this run has stored, beside the report rows (no step column in the table)."""
    t, w = TrainConfig(), WeatherConfig()
    day = F.date_format("timestamp", "yyyy-MM-dd")
    steps = metrics.steps_by_date(
        trains_raw.where(day.isin(train_dates)), processor="train", required=t.required_fields, rules=R.train_business_rules(),
        round_to_hour=False, dedup_keys=t.dedup_keys, order_by="ingest_seq").unionByName(metrics.steps_by_date(
            weather_raw.where(day.isin(weather_dates)), processor="weather", required=w.required_fields,
            rules=R.weather_business_rules(), round_to_hour=True, dedup_keys=w.dedup_keys, order_by="ingest_seq"))
    rows = metrics.metrics_table(steps).select("table_name", "metric_name", "metric_value", "timestamp", "details", "date")
    rows.write.mode("append").partitionBy("date").parquet(path)


def _integrate_chunk(spark, paths, start, end, dates, state, have_weather, t_schema, w_schema, tolerance_minutes) -> dict:
    pending = [d for d in dates if state[d] == PENDING]
    todo = [d for d in pending if d in have_weather]
    out = {"start_date": start, "end_date": end, "success": False, "skipped": False, "error": None, "train_records": 0,
           "weather_records": 0, "total_records": 0, "match_rate": 0.0, "quality_score": 0.0,
           "pending_dates": [d for d in pending if d not in have_weather]}
    schema = _integrated_schema(spark)
    if dates and not pending:
        rows = B.read_if_exists(spark, paths["integrated"], schema).where(F.col("date").isin(dates)).count()
        return out | {"success": True, "skipped": True, "total_records": rows, "quality_score": 1.0}
    if not todo:
        return out | {"error": NO_SOURCE}
    near = [d for d in _around(todo, tolerance_minutes) if d in have_weather]
    t = spark.read.schema(t_schema).parquet(paths["trains"]).where(F.col("date").isin(todo)).drop("date")
    w = spark.read.schema(w_schema).parquet(paths["weather"]).where(F.col("date").isin(near)).drop("date", "ingest_seq")
    matched, matched_at = work_table(match_weather(t, w, tolerance_minutes=tolerance_minutes), "matched")
    B.write_partitioned(B.with_date(project_integrated(engineer_features(matched))), paths["integrated"],
                        partition_by=("date",), mode="overwrite")
    n = matched.agg(F.count(F.lit(1)).alias("rows"), F.count("temperature").alias("hits")).first()
    drop_path(spark, matched_at)
    new_rows = spark.read.schema(schema).parquet(paths["integrated"]).where(F.col("date").isin(todo)).drop("date")
    report = metrics.post_report_rows(post.assess(new_rows)["report"])
    _replace_reports(spark, report.select("table_name", "metric_name", "metric_value", "timestamp", "details", "date"),
                     todo, paths["metrics"])
    _mark(spark, paths["dates"], todo, FINAL)
    rate = n["hits"] / n["rows"] if n["rows"] else 0.0
    return out | {"success": True, "train_records": n["rows"], "weather_records": w.count(), "total_records": n["rows"],
                  "match_rate": rate, "quality_score": min(rate + 0.2, 1.0)}


def _replace_reports(spark: SparkSession, report: DataFrame, dates: list[str], path: str) -> None:
    """The dates' metric rows with these reports in place of earlier ones; their step metrics stay."""
    kept = B.read_if_exists(spark, path, report.schema).where(F.col("date").isin(dates) & (F.col("table_name") != REPORT))
    rows, at = work_table(kept.unionByName(report), "metrics")
    B.write_partitioned(rows, path, partition_by=("date",), mode="overwrite")
    drop_path(spark, at)


def _integrated_schema(spark: SparkSession) -> StructType:
    from pyspark.sql.types import BooleanType, DoubleType, IntegerType, StringType
    from trackcast.schemas import TS
    types = {"train_id": StringType(), "timestamp": TS, "station_code": StringType(), "delay_minutes": IntegerType(),
             "temperature": DoubleType(), "wind_speed": DoubleType(), "precip_mm": DoubleType(),
             "weather_code": IntegerType(), "train_category": StringType(), "route": StringType(),
             "delay_status": StringType(), "destination": StringType(), "is_cancelled": BooleanType(),
             "hour_of_day": IntegerType(), "day_of_week": IntegerType(), "is_weekend": BooleanType(),
             "is_rush_hour": BooleanType(), "temp_category": StringType(), "is_raining": BooleanType(),
             "rain_intensity": StringType(), "wind_category": StringType(), "is_delayed": BooleanType(),
             "delay_category": StringType()}
    s = StructType()
    for c in INTEGRATED_COLUMNS:
        s = s.add(c, types[c])
    return s.add("date", StringType())
