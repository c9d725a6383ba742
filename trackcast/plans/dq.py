"""Batch data-quality processing of train and weather tables.

``process_*`` returns ``(clean, steps, rules)``: the cleaned rows, one summary
row per step and one row per rule result. All counters are aggregates over
the same lineage (two passes: input and output), never driver loops.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from trackcast.config import TrainConfig, WeatherConfig
from trackcast.functions.nulls import count_if
from trackcast.functions.timefns import parse_timestamp, round_hour_half_up
from trackcast.operators import rules as R
from trackcast.operators.dedup import dedup_best, dedup_last
from trackcast.operators.attach import attach_one_row, one_row

STEP_SCHEMA = ("processor string, step string, total_records bigint, valid_records bigint, "
               "dropped_records bigint, flagged_records bigint")


# ---- G1 --------------------------------------------------------------------

def schema_rules(df: DataFrame, required: Sequence[str], processor: str) -> DataFrame:
    """Per required field ``<f>_not_null`` (or ``<f>_exists`` when absent)."""
    spark = df.sparkSession
    present = [f for f in required if f in df.columns]
    agg = df.agg(F.count(F.lit(1)).alias("total"),
                 *[count_if(F.col(f).isNull()).alias(f"n_{f}") for f in present])
    items = []
    for f in required:
        if f in present:
            n = F.coalesce(F.col(f"n_{f}"), F.lit(0))
            items.append(F.struct(F.lit(f"{f}_not_null").alias("rule_name"), (n == 0).alias("passed"),
                                  n.alias("affected_records"),
                                  F.when(n > 0, "drop").otherwise("none").alias("action")))
        else:
            items.append(F.struct(F.lit(f"{f}_exists").alias("rule_name"), F.lit(False).alias("passed"),
                                  F.col("total").alias("affected_records"), F.lit("drop").alias("action")))
    out = agg.select(F.explode(F.array(*items)).alias("r")).select("r.*")
    return out.select(F.lit(processor).alias("processor"), F.lit("schema_validation").alias("step"),
                      "rule_name", F.lit("schema").alias("rule_type"), "passed",
                      F.col("affected_records").cast("bigint").alias("affected_records"), "action")


def any_required_null(df: DataFrame, required: Sequence[str]):
    present = [f for f in required if f in df.columns]
    if len(present) < len(required):
        return F.lit(True)
    pred = F.lit(False)
    for f in present:
        pred = pred | F.col(f).isNull()
    return pred


def validate_schema(df: DataFrame, required: Sequence[str], processor: str) -> DataFrame:
    """Step summary of G1: dropped = rows with any required field null (a
    report only, N11), compliance = valid / total."""
    agg = df.agg(F.count(F.lit(1)).alias("total_records"),
                 count_if(any_required_null(df, required)).alias("dropped_records"))
    return agg.select(F.lit(processor).alias("processor"), F.lit("schema_validation").alias("step"),
                      "total_records", (F.col("total_records") - F.col("dropped_records")).alias("valid_records"),
                      "dropped_records", F.lit(0).cast("bigint").alias("flagged_records"),
                      F.when(F.col("total_records") > 0,
                             (F.col("total_records") - F.col("dropped_records")) / F.col("total_records"))
                       .otherwise(F.lit(0.0)).alias("schema_compliance_rate"))


# ---- F1 --------------------------------------------------------------------

def normalize_timestamps(df: DataFrame, *, col: str = "timestamp", round_to_hour: bool = False,
                         source_tz: str = "UTC") -> DataFrame:
    """Parse text timestamps (fixed format list; text without an offset is in
    ``source_tz``), keep timestamps as they are, optionally round half-up to the hour, drop rows without a timestamp."""
    if col not in df.columns:
        return df
    src = F.col(col)
    if isinstance(df.schema[col].dataType, StringType):
        ts = parse_timestamp(src, source_tz=source_tz)
    else:
        ts = src.cast("timestamp_ntz")
    if round_to_hour:
        ts = round_hour_half_up(ts)
    return df.withColumn(col, ts).where(F.col(col).isNotNull())


def timestamp_parse_errors(df: DataFrame, col: str = "timestamp"):
    """Rows whose timestamp is present but did not parse."""
    if col not in df.columns or not isinstance(df.schema[col].dataType, StringType):
        return F.lit(False)
    return F.col(col).isNotNull() & parse_timestamp(F.col(col)).isNull()


# ---- processors --------------------------------------------------------------

def _all_invalid_guard(raw: DataFrame, clean: DataFrame, required: Sequence[str]) -> DataFrame:
    """When every input row fails the schema check the output is empty.
    The guard is one scalar subquery over the required columns, evaluated once."""
    if any(f not in raw.columns for f in required):
        return clean.limit(0)
    any_valid = raw.agg(F.max((~any_required_null(raw, required)).cast("int"))).scalar()
    return clean.where(F.coalesce(any_valid, F.lit(0)) == 1)


def drop_invalid_rows(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """N11, on request: only the rows with every required field."""
    return df.where(~any_required_null(df, required))


def drop_missing_critical(df: DataFrame, critical: Sequence[str], threshold: float) -> DataFrame:
    """Without the rows whose share of missing critical fields exceeds ``threshold``."""
    missing = sum((F.col(c).isNull().cast("int") for c in critical), F.lit(0))
    return df.where(missing / F.lit(len(critical)) <= F.lit(threshold))


def process_train(raw: DataFrame, cfg: TrainConfig = TrainConfig(), *, tie_break: str = "ingest_seq",
                  all_invalid_exit: bool = True, drop_invalid: bool = False) -> DataFrame:
    """Schema report, timestamp normalisation, most-complete dedup,
    business rules; returns the clean frame with ``delay_anomaly`` /
    ``delay_outlier`` flags. ``drop_invalid`` drops what the schema report only counts."""
    df = normalize_timestamps(drop_invalid_rows(raw, cfg.required_fields) if drop_invalid else raw)
    df = dedup_best(df, keys=cfg.dedup_keys, tie_break=tie_break)
    init = ("delay_anomaly", "delay_outlier") if "delay_minutes" in df.columns else ()
    df = R.apply_rules(df, R.train_business_rules(cfg.delay_min_threshold, cfg.delay_max_threshold), init_flags=init)
    return _all_invalid_guard(raw, df, cfg.required_fields) if all_invalid_exit else df


def process_weather(raw: DataFrame, cfg: WeatherConfig = WeatherConfig(), *, order_by: str = "ingest_seq",
                    all_invalid_exit: bool = True, drop_invalid: bool = False) -> DataFrame:
    """Schema report, timestamp normalisation with half-up hour rounding,
    keep-last dedup on ``(station_code, timestamp)`` by ``order_by``, range rules."""
    df = normalize_timestamps(drop_invalid_rows(raw, cfg.required_fields) if drop_invalid else raw, round_to_hour=True)
    df = dedup_last(df, keys=cfg.dedup_keys, order_by=order_by)
    init = [f for f, c in (("temp_range_violation", "temperature"),) if c in df.columns]
    if "precipitation" in df.columns or "precip_mm" in df.columns:
        init.append("precip_range_violation")
    df = R.apply_rules(df, R.weather_business_rules(cfg.temperature_min, cfg.temperature_max, cfg.precip_mm_min),
                       init_flags=init)
    return _all_invalid_guard(raw, df, cfg.required_fields) if all_invalid_exit else df


def process_results(raw: DataFrame, clean: DataFrame, *, processor: str, required: Sequence[str],
                    rules: Sequence[R.Rule], round_to_hour: bool, dedup_keys: Sequence[str],
                    order_by: str) -> tuple[DataFrame, DataFrame]:
    """``(steps, rule_rows)`` of one processing run, from aggregates over the
    raw input, the normalised rows and the deduplicated rows."""
    normed = normalize_timestamps(raw, round_to_hour=round_to_hour)
    if processor == "train":
        deduped = dedup_best(normed, keys=dedup_keys, tie_break=order_by)
    else:
        deduped = dedup_last(normed, keys=dedup_keys, order_by=order_by)
    a = raw.agg(F.count(F.lit(1)).alias("total"), count_if(any_required_null(raw, required)).alias("schema_bad"),
                count_if(timestamp_parse_errors(raw)).alias("parse_errors"))
    b = normed.agg(F.count(F.lit(1)).alias("normalized"))
    c = deduped.agg(F.count(F.lit(1)).alias("deduped"))
    counts = one_row(a, b, c)
    rule_rows = R.rule_counts(deduped, rules, processor=processor, step="business_rules")
    flagged = rule_rows.agg(F.coalesce(F.sum("affected_records"), F.lit(0)).cast("bigint").alias("flagged"))
    counts = attach_one_row(counts, flagged)
    def step(name, t, v, d, f):
        return F.struct(F.lit(name).alias("step"), t.cast("bigint").alias("t"), v.cast("bigint").alias("v"),
                        d.cast("bigint").alias("d"), f.cast("bigint").alias("f"))

    c = F.col
    zero = F.lit(0)
    steps = counts.select(F.explode(F.array(
        step("schema_validation", c("total"), c("total") - c("schema_bad"), c("schema_bad"), zero),
        step("timestamp_normalization", c("total"), c("normalized"), c("total") - c("normalized"), zero),
        step("deduplication", c("normalized"), c("deduped"), c("normalized") - c("deduped"), zero),
        step("business_rules", c("deduped"), c("deduped"), zero, c("flagged")),
    )).alias("s")).select(F.lit(processor).alias("processor"), F.col("s.step").alias("step"),
                          F.col("s.t").alias("total_records"), F.col("s.v").alias("valid_records"),
                          F.col("s.d").alias("dropped_records"), F.col("s.f").alias("flagged_records"))
    ts_rules = counts.select(F.explode(F.array(
        F.struct(F.lit("timestamp_parsing").alias("rule_name"), (F.col("parse_errors") == 0).alias("passed"),
                 F.col("parse_errors").cast("bigint").alias("affected_records"),
                 F.when(F.col("parse_errors") > 0, "drop").otherwise("none").alias("action")),
        F.struct(F.lit("timestamp_normalization").alias("rule_name"), F.lit(True).alias("passed"),
                 F.col("normalized").cast("bigint").alias("affected_records"), F.lit("transform").alias("action")),
    )).alias("r")).select(F.lit(processor).alias("processor"), F.lit("timestamp_normalization").alias("step"),
                          "r.rule_name", F.lit("schema").alias("rule_type"), "r.passed",
                          F.col("r.affected_records").cast("bigint").alias("affected_records"), "r.action")
    dd = (F.col("normalized") - F.col("deduped"))
    dd_rules = counts.select(F.lit(processor).alias("processor"), F.lit("deduplication").alias("step"),
                             F.lit("duplicate_removal").alias("rule_name"), F.lit("deduplication").alias("rule_type"),
                             F.lit(True).alias("passed"), dd.cast("bigint").alias("affected_records"),
                             F.when(dd > 0, "drop").otherwise("none").alias("action"))
    all_rules = (schema_rules(raw, required, processor).unionByName(ts_rules).unionByName(dd_rules)
                 .unionByName(rule_rows))
    return steps, all_rules


def train_results(raw: DataFrame, cfg: TrainConfig = TrainConfig(), order_by: str = "ingest_seq"):
    return process_results(raw, None, processor="train", required=cfg.required_fields,
                           rules=R.train_business_rules(cfg.delay_min_threshold, cfg.delay_max_threshold),
                           round_to_hour=False, dedup_keys=cfg.dedup_keys, order_by=order_by)


def weather_results(raw: DataFrame, cfg: WeatherConfig = WeatherConfig(), order_by: str = "ingest_seq"):
    return process_results(raw, None, processor="weather", required=cfg.required_fields,
                           rules=R.weather_business_rules(cfg.temperature_min, cfg.temperature_max,
                                                          cfg.precip_mm_min),
                           round_to_hour=True, dedup_keys=cfg.dedup_keys, order_by=order_by)


def run_summary(steps: DataFrame) -> DataFrame:
    """Sums of total / valid / dropped / flagged over every step result of
    a processor and the three rates over the summed total (0 when empty). A
    row dropped by two steps counts twice, as in the summed results. The run
    succeeds when raw rows exist and clean rows remain (or the clean share of
    the raw rows exceeds 10 %)."""
    step = F.col("step")
    s = steps.groupBy("processor").agg(
        F.sum("total_records").cast("bigint").alias("total_records"),
        F.sum("valid_records").cast("bigint").alias("total_valid"),
        F.sum("dropped_records").cast("bigint").alias("total_dropped"),
        F.sum("flagged_records").cast("bigint").alias("total_flagged"),
        F.max(F.when(step == "schema_validation", F.col("total_records"))).cast("bigint").alias("raw_records"),
        F.max(F.when(step == "business_rules", F.col("valid_records"))).cast("bigint").alias("clean_records"))
    t = F.col("total_records")
    rate = lambda c: F.when(t > 0, F.col(c) / t).otherwise(F.lit(0.0))
    raw, clean = F.coalesce("raw_records", F.lit(0)), F.coalesce("clean_records", F.lit(0))
    quality = F.when(raw > 0, clean / raw).otherwise(F.lit(0.0))
    return s.select("processor", "total_records", "total_valid", "total_dropped", "total_flagged",
                    rate("total_valid").alias("validation_success_rate"), rate("total_dropped").alias("drop_rate"),
                    rate("total_flagged").alias("flag_rate"), raw.alias("raw_records"), clean.alias("clean_records"),
                    quality.alias("overall_quality_rate"),
                    ((raw > 0) & ((clean > 0) | (quality > 0.1))).alias("success"))
