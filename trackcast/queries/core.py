"""Headline queries: cleaning, dedup, nearest match, features."""

from __future__ import annotations

from pyspark.sql import functions as F

from trackcast.catalog import register
from trackcast.config import TrainConfig, WeatherConfig
from trackcast.operators import rules as R
from trackcast.operators.dedup import dedup_best, dedup_last
from trackcast.plans import dq
from trackcast.plans.integrate import integration_quality, weather_any

TC, WC = TrainConfig(), WeatherConfig()


@register("nearest_join", "select * from integrated")
def nearest_join(s):
    """Each cleaned train row with the nearest weather observation of its
    station within +-60 min (ties to the earlier), unmatched rows kept."""
    return s.integrated


@register("dedup_completeness", "select * from trains_dedup")
def dedup_completeness(s):
    """Most complete row per (train_id, timestamp, station_code); ties to the
    smallest ingest sequence."""
    return dedup_best(dq.normalize_timestamps(s.trains_raw), keys=TC.dedup_keys, tie_break="ingest_seq")


@register("dedup_keep_last", "select * from weather_dedup")
def dedup_keep_last(s):
    """Last-arrived row per (station_code, hour) of the rounded weather rows."""
    return dedup_last(dq.normalize_timestamps(s.weather_raw, round_to_hour=True), keys=WC.dedup_keys,
                      order_by="ingest_seq")


@register("process_train", "select * from trains_clean")
def process_train(s):
    """G5 on the raw train rows: normalise, dedup by completeness, delay rules."""
    return s.trains_clean


@register("process_weather", "select * from weather_clean")
def process_weather(s):
    """G6 on the raw weather rows: normalise + half-up rounding, keep-last
    dedup, temperature / precipitation range rules."""
    return s.weather_clean


@register("engineer_features", "select * from features")
def engineer_features(s):
    """All four feature groups over the integrated rows."""
    return s.features


@register("integrate", "select * from integrated_table")
def integrate(s):
    """Cleaned trains x cleaned weather -> nearest match -> features ->
    the 23 stored columns."""
    return s.integrated_table


@register("append_integrated", "select * from integrated_table")
def append_integrated(s):
    """The target table columns that exist, in table order, appended by date and read back."""
    from trackcast.plans.integrate import project_integrated
    from trackcast.session import new_work_dir
    from trackcast.sources.sinks import with_date, write_partitioned
    frame = with_date(project_integrated(s.features))
    path = new_work_dir(s.spark, "integrated")
    write_partitioned(frame, path, partition_by=("date",))
    return s.spark.read.schema(frame.schema).parquet(path).select(*frame.columns).drop("date")


_SCHEMA_SQL = """
select processor, 'schema_validation' as step, rule_name, 'schema' as rule_type, n = 0 as passed,
  n as affected_records, case when n > 0 then 'drop' else 'none' end as action
from (
  select 'train' as processor, 'station_code_not_null' as rule_name, count(*) filter (where station_code is null) as n from trains_raw
  union all select 'train', 'timestamp_not_null', count(*) filter (where timestamp is null) from trains_raw
  union all select 'train', 'train_id_not_null', count(*) filter (where train_id is null) from trains_raw
  union all select 'weather', 'station_code_not_null', count(*) filter (where station_code is null) from weather_raw
  union all select 'weather', 'timestamp_not_null', count(*) filter (where timestamp is null) from weather_raw
  union all select 'weather', 'temperature_not_null', count(*) filter (where temperature is null) from weather_raw
) x
"""


@register("validate_schema", _SCHEMA_SQL)
def validate_schema(s):
    """G1 rule rows for both raw tables: null count per required field."""
    return (dq.schema_rules(s.trains_raw, TC.required_fields, "train")
            .unionByName(dq.schema_rules(s.weather_raw, WC.required_fields, "weather")))


_TRAIN_RULES_SQL = """
select 'train' as processor, 'business_rules' as step, rule_name, 'business' as rule_type, false as passed,
  n as affected_records, action
from (
  select 'extreme_early_delay' as rule_name, 'transform' as action, count(*) filter (where delay_minutes < -5) as n
  from trains_dedup
  union all
  select 'extreme_delay_outlier', 'flag', count(*) filter (where delay_minutes > 300) from trains_dedup
) x where n > 0
"""


@register("schema_compliance", """
select 'train' as processor, 'schema_validation' as step, count(*) as total_records, count(*) - bad as valid_records,
  bad as dropped_records, 0 as flagged_records, round((count(*) - bad) * 1e0 / count(*), 9) as schema_compliance_rate
from trains_raw, (select count(*) as bad from trains_raw where station_code is null or timestamp is null or train_id is null) b
group by bad
union all
select 'weather', 'schema_validation', count(*), count(*) - bad, bad, 0, round((count(*) - bad) * 1e0 / count(*), 9)
from weather_raw, (select count(*) as bad from weather_raw
                   where station_code is null or timestamp is null or temperature is null) b
group by bad""")
def schema_compliance(s):
    """G1 step summary of both raw tables with the share of rows that have every required field."""
    out = (dq.validate_schema(s.trains_raw, TC.required_fields, "train")
           .unionByName(dq.validate_schema(s.weather_raw, WC.required_fields, "weather")))
    return out.withColumn("schema_compliance_rate", F.round("schema_compliance_rate", 9))


@register("train_rules", _TRAIN_RULES_SQL)
def train_rules(s):
    """G2 rule counts on the deduplicated trains (a row only when violated)."""
    d = dedup_best(dq.normalize_timestamps(s.trains_raw), keys=TC.dedup_keys, tie_break="ingest_seq")
    return R.rule_counts(d, R.train_business_rules(), processor="train", step="business_rules")


_WEATHER_RULES_SQL = """
select 'weather' as processor, 'business_rules' as step, rule_name, 'range' as rule_type, false as passed,
  n as affected_records, 'transform' as action
from (
  select 'temperature_range_validation' as rule_name,
         count(*) filter (where temperature < -20 or temperature > 50) as n from weather_dedup
  union all
  select 'precip_mm_range_validation', count(*) filter (where precip_mm < 0) from weather_dedup
) x where n > 0
"""


@register("weather_rules", _WEATHER_RULES_SQL)
def weather_rules(s):
    """G3 rule counts on the deduplicated weather rows."""
    d = dedup_last(dq.normalize_timestamps(s.weather_raw, round_to_hour=True), keys=WC.dedup_keys,
                   order_by="ingest_seq")
    return R.rule_counts(d, R.weather_business_rules(), processor="weather", step="business_rules")


_MATCH_SQL = """
select count(*) as total_records,
  count(*) filter (where matched) as matched_records,
  count(temperature) as temperature_records,
  count(*) filter (where temperature is not null or wind_speed is not null or precip_mm is not null
                   or weather_code is not null) as weather_records,
  case when count(*) > 0 then (count(*) filter (where matched)) / count(*) else 0e0 end as match_rate,
  case when count(*) > 0 then count(temperature) / count(*) else 0e0 end as temperature_rate,
  case when count(*) > 0 then (count(*) filter (where temperature is not null or wind_speed is not null
       or precip_mm is not null or weather_code is not null)) / count(*) else 0e0 end as weather_rate
from integrated
"""


@register("match_rate", _MATCH_SQL)
def match_rate(s):
    """Share of rows with a matched observation, with a temperature, and
    with any of the four weather fields."""
    i = s.integrated
    total = F.count(F.lit(1))
    rate = lambda e: F.when(total > 0, e / total).otherwise(F.lit(0.0))
    m = F.count(F.when(F.col("matched"), 1))
    w = F.count(F.when(weather_any(i), 1))
    return i.agg(total.alias("total_records"), m.alias("matched_records"),
                 F.count("temperature").alias("temperature_records"), w.alias("weather_records"),
                 rate(m).alias("match_rate"), rate(F.count("temperature")).alias("temperature_rate"),
                 rate(w).alias("weather_rate"))


_IQ_SQL = """
select (select count(*) from trains) as train_records, (select count(*) from weather) as weather_records,
  count(*) as total_records, count(temperature) as weather_matched,
  case when count(*) > 0 then count(temperature) / count(*) else 0e0 end as match_rate,
  least(case when count(*) > 0 then count(temperature) / count(*) else 0e0 end + 0.2e0, 1e0) as quality_score
from integrated
"""


@register("integration_quality", _IQ_SQL)
def integration_quality_q(s):
    """Source counts, integrated rows and the temperature match rate."""
    return integration_quality(s.integrated, s.trains, s.weather)


@register("nearest_rank", """
select t.train_id, t.timestamp, t.station_code, cast(row_number() over (partition by t.ingest_seq
    order by abs(epoch_us(w.timestamp) - epoch_us(t.timestamp)), w.timestamp) as integer) as rank,
  w.timestamp as candidate_timestamp, abs(epoch_us(w.timestamp) - epoch_us(t.timestamp)) as diff_us
from trains_clean t join weather w on w.station_code = t.station_code
  and w.timestamp between t.timestamp - interval 60 minute and t.timestamp + interval 60 minute""")
def nearest_rank(s):
    """The weather candidates of every train row ranked by time distance
    (rank 1 is the nearest-join pick)."""
    from trackcast.operators.nearest import ranked_candidates
    return ranked_candidates(s.trains_clean, s.weather, left_cols=["train_id", "timestamp", "station_code"])
