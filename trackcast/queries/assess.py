"""Pre- and post-integration assessment queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from trackcast.catalog import register
from trackcast.plans import post, pre

R9 = lambda c: F.round(F.col(c), 9).alias(c)

# ---- pre-integration (inputs: the landed raw train and weather rows) ---------

_HALF_EVEN = """case when {c} is null then null
  when epoch_us({c}) % 3600000000 > 1800000000 then date_trunc('hour', {c}) + interval 1 hour
  when epoch_us({c}) % 3600000000 = 1800000000 and hour({c}) % 2 = 1 then date_trunc('hour', {c}) + interval 1 hour
  else date_trunc('hour', {c}) end"""

PRE_CTES = f"""
tf as (
  select train_id, {_HALF_EVEN.format(c='timestamp')} as timestamp, station_code, scheduled_time, actual_time,
    case when delay_minutes >= -2 and delay_minutes < 0 then 0 else delay_minutes end as delay_minutes,
    train_category, route, delay_status, destination, is_cancelled, ingest_seq,
    case when (case when delay_minutes >= -2 and delay_minutes < 0 then 0 else delay_minutes end) > 480
         then 1 else 0 end as delay_outlier
  from trains_raw),
wf as (
  select station_code, {_HALF_EVEN.format(c='timestamp')} as timestamp, temperature, wind_speed,
    case when precip_mm < 0 then 0e0 else precip_mm end as precip_mm, weather_code, ingest_seq,
    case when temperature < -20 or temperature > 50 then 1 else 0 end as temp_outlier
  from weather_raw),
tp as (
  select count(*) as t_rows, count(*) filter (where delay_minutes is null) as t_delay_null,
    count(*) filter (where delay_minutes < 0) as t_delay_neg, count(*) filter (where timestamp is null) as t_ts_issue,
    min(timestamp) as t_min, max(timestamp) as t_max,
    count(*) filter (where scheduled_time > actual_time) as t_sched_bad,
    cast(coalesce(sum(delay_outlier), 0) as bigint) as t_flagged
  from tf),
wp as (
  select count(*) as w_rows,
    count(*) filter (where temperature is null) as w_temperature_null,
    count(*) filter (where precip_mm is null) as w_precip_mm_null,
    count(*) filter (where wind_speed is null) as w_wind_speed_null,
    count(*) filter (where weather_code is null) as w_weather_code_null,
    count(*) filter (where precip_mm < 0) as w_precip_neg,
    count(*) filter (where temperature < -20 or temperature > 50) as w_temp_bad,
    count(*) filter (where timestamp is null) as w_ts_issue, min(timestamp) as w_min, max(timestamp) as w_max,
    cast(coalesce(sum(temp_outlier), 0) as bigint) as w_flagged
  from wf),
pre_comp as (
  select 'delay_minutes' as field_name, t_delay_null as missing_count, t_delay_null * 100e0 / t_rows as missing_percentage,
         'flag_as_null' as handling_strategy from tp where t_rows > 0
  union all select 'weather_temperature', w_temperature_null, w_temperature_null * 100e0 / w_rows,
         'nearest_hourly_snapshot' from wp where w_rows > 0
  union all select 'weather_precip_mm', w_precip_mm_null, w_precip_mm_null * 100e0 / w_rows,
         'nearest_hourly_snapshot' from wp where w_rows > 0
  union all select 'weather_wind_speed', w_wind_speed_null, w_wind_speed_null * 100e0 / w_rows,
         'nearest_hourly_snapshot' from wp where w_rows > 0
  union all select 'weather_weather_code', w_weather_code_null, w_weather_code_null * 100e0 / w_rows,
         'nearest_hourly_snapshot' from wp where w_rows > 0),
pre_acc as (
  select 'delay_non_negative' as rule_name, t_delay_neg as violations_count,
         t_delay_neg * 100e0 / t_rows as violations_percentage,
         case when t_delay_neg > 0 then 'convert_to_zero' else 'none' end as action_taken from tp where t_rows > 0
  union all select 'precipitation_non_negative', w_precip_neg, w_precip_neg * 100e0 / w_rows,
         case when w_precip_neg > 0 then 'set_to_zero' else 'none' end from wp where w_rows > 0
  union all select 'temperature_plausible_range', w_temp_bad, w_temp_bad * 100e0 / w_rows,
         case when w_temp_bad > 0 then 'flag_as_outlier' else 'none' end from wp where w_rows > 0),
pre_cons as (
  select t_ts_issue + w_ts_issue as timestamp_issues, t_sched_bad as schema_violations, t_rows + w_rows as total_records,
    case when t_rows + w_rows > 0
         then greatest(0e0, 1e0 - (t_ts_issue + w_ts_issue + t_sched_bad) / (t_rows + w_rows)) else 1e0 end
      as consistency_score
  from tp cross join wp),
pre_uniq as (
  select td.d as train_duplicates, wd.d as weather_duplicates, tp.t_rows + wp.w_rows as original_count,
    td.d + wd.d as duplicate_count, tp.t_rows + wp.w_rows - td.d - wd.d as final_count,
    case when tp.t_rows + wp.w_rows > 0 then 1e0 - (td.d + wd.d) / (tp.t_rows + wp.w_rows) else 1e0 end
      as uniqueness_score
  from (select cast(coalesce(sum(n - 1), 0) as bigint) as d from
          (select count(*) as n from tf group by train_id, timestamp) x) td
  cross join (select cast(coalesce(sum(n - 1), 0) as bigint) as d from
          (select count(*) as n from wf group by station_code, timestamp) x) wd
  cross join tp cross join wp),
pre_cov as (
  select 'station' as entity_type, count(*) as total_expected,
    count(*) filter (where t.c is not null and w.c is not null) as total_actual,
    (count(*) filter (where t.c is not null and w.c is not null)) * 100e0 / count(*) as coverage_percentage
  from (select distinct station_code as c from tf where station_code is not null) t
  full outer join (select distinct station_code as c from wf where station_code is not null) w on t.c = w.c
  having count(*) > 0
  union all
  select 'time_period', cast(trunc(total_h) as bigint), cast(trunc(overlap_h) as bigint),
    case when total_h > 0 then overlap_h / total_h * 100e0 else 0e0 end
  from (select greatest(t_min, w_min) as o_start, least(t_max, w_max) as o_end,
          (epoch_us(least(t_max, w_max)) - epoch_us(greatest(t_min, w_min))) / 3600000000e0 as overlap_h,
          greatest((epoch_us(t_max) - epoch_us(t_min)) / 3600000000e0,
                   (epoch_us(w_max) - epoch_us(w_min)) / 3600000000e0) as total_h,
          t_rows, w_rows from tp cross join wp) p
  where t_rows > 0 and w_rows > 0 and o_start <= o_end),
pre_score as (
  select c.s as completeness_score, a.s as accuracy_score, k.consistency_score, u.uniqueness_score,
    v.s as coverage_score,
    c.s * 0.25e0 + a.s * 0.25e0 + k.consistency_score * 0.20e0 + u.uniqueness_score * 0.15e0 + v.s * 0.15e0
      as overall_quality_score,
    tp.t_rows + wp.w_rows as records_processed, tp.t_rows + wp.w_rows as records_valid,
    cast(tp.t_flagged + wp.w_flagged as bigint) as records_flagged, cast(0 as bigint) as records_dropped,
    k.timestamp_issues, k.schema_violations, u.duplicate_count
  from (select case when count(*) > 0 then greatest(0e0, (100e0 - avg(missing_percentage)) / 100e0) else 1e0 end as s
        from pre_comp) c
  cross join (select case when count(*) > 0 then greatest(0e0, (100e0 - avg(violations_percentage)) / 100e0)
              else 1e0 end as s from pre_acc) a
  cross join pre_cons k cross join pre_uniq u
  cross join (select coalesce(avg(coverage_percentage) / 100e0, 0e0) as s from pre_cov) v
  cross join tp cross join wp)
"""


def pre_sql(body: str) -> str:
    return f",\n{PRE_CTES.strip()}\n{body}"


def _pre(s):
    return pre.assess(s.trains_raw, s.weather_raw)


_TF_COLS = ("train_id, timestamp, station_code, scheduled_time, actual_time, delay_minutes, train_category, "
            "route, delay_status, destination, is_cancelled, ingest_seq, delay_outlier")


@register("apply_fixes", pre_sql(f"select 'train' as side, {_TF_COLS}, cast(null as integer) as temp_outlier, "
                                 "cast(null as double) as temperature, cast(null as double) as precip_mm from tf "
                                 "union all select 'weather', null, timestamp, station_code, null, null, null, null, "
                                 "null, null, null, null, ingest_seq, null, temp_outlier, temperature, precip_mm from wf"))
def apply_fixes(s):
    """G7 on the raw rows: both fixed tables stacked with a side tag."""
    tf, wf = pre.apply_fixes(s.trains_raw, s.weather_raw)
    a = tf.select(F.lit("train").alias("side"), *tf.columns, F.lit(None).cast("int").alias("temp_outlier"),
                  F.lit(None).cast("double").alias("temperature"), F.lit(None).cast("double").alias("precip_mm"))
    b = wf.select(F.lit("weather").alias("side"), F.lit(None).cast("string").alias("train_id"), "timestamp",
                  "station_code", *[F.lit(None).cast(t).alias(c) for c, t in (
                      ("scheduled_time", "timestamp_ntz"), ("actual_time", "timestamp_ntz"), ("delay_minutes", "int"),
                      ("train_category", "string"), ("route", "string"), ("delay_status", "string"),
                      ("destination", "string"), ("is_cancelled", "boolean"))],
                  "ingest_seq", F.lit(None).cast("int").alias("delay_outlier"), "temp_outlier", "temperature",
                  "precip_mm")
    return a.unionByName(b)


@register("assess_completeness", pre_sql("select * from pre_comp"))
def assess_completeness(s):
    """G8 rows: missing count / percentage per field after the fixes."""
    return _pre(s)["completeness"]


@register("assess_accuracy", pre_sql("select * from pre_acc"))
def assess_accuracy(s):
    """G9 rows: business-rule violations after the fixes."""
    return _pre(s)["accuracy"]


@register("assess_consistency", pre_sql("select timestamp_issues, schema_violations, total_records, "
                                        "round(consistency_score, 9) as consistency_score from pre_cons"))
def assess_consistency(s):
    """Timestamp issues and scheduled > actual over all rows."""
    c = _pre(s)["consistency"]
    return c.select("timestamp_issues", "schema_violations", "total_records", R9("consistency_score"))


@register("assess_uniqueness", pre_sql("select train_duplicates, weather_duplicates, original_count, duplicate_count, "
                                       "final_count, round(uniqueness_score, 9) as uniqueness_score from pre_uniq"))
def assess_uniqueness(s):
    """Duplicates on the two natural keys of the fixed tables."""
    u = _pre(s)["uniqueness"]
    return u.select("train_duplicates", "weather_duplicates", "original_count", "duplicate_count", "final_count",
                    R9("uniqueness_score"))


@register("assess_coverage", pre_sql("select entity_type, total_expected, total_actual, "
                                     "round(coverage_percentage, 9) as coverage_percentage from pre_cov"))
def assess_coverage(s):
    """G12 rows: station and temporal coverage."""
    c = _pre(s)["coverage"]
    return c.select("entity_type", "total_expected", "total_actual", R9("coverage_percentage"))


_SCORE_COLS = ("completeness_score", "accuracy_score", "consistency_score", "uniqueness_score", "coverage_score",
               "overall_quality_score")


@register("pre_quality_score", pre_sql(
    "select " + ", ".join(f"round({c}, 9) as {c}" for c in _SCORE_COLS)
    + ", records_processed, records_valid, records_flagged, records_dropped, timestamp_issues, schema_violations, "
      "duplicate_count from pre_score"))
def pre_quality_score(s):
    """Five pillar scores, the weighted overall score and the counts."""
    sc = _pre(s)["score"]
    return sc.select(*[R9(c) for c in _SCORE_COLS], "records_processed", "records_valid", "records_flagged",
                     "records_dropped", "timestamp_issues", "schema_violations", "duplicate_count")


_PRE_REC_SQL = """
select seq, recommendation from (
  select 1 as seq, 'High missing data detected in ' || cast(hm as varchar) || ' fields. Consider data collection improvements or imputation strategies.' as recommendation
  from pre_score, (select count(*) filter (where missing_percentage > 20) as hm from pre_comp) x
  where completeness_score < 0.8 and hm > 0
  union all
  select 2, 'Significant business rule violations in ' || cast(hv as varchar) || ' rules. Review data collection and validation processes.'
  from pre_score, (select count(*) filter (where violations_percentage > 10) as hv from pre_acc) x
  where accuracy_score < 0.9 and hv > 0
  union all
  select 3, 'Found ' || cast(timestamp_issues as varchar) || ' timestamp consistency issues. Ensure all data uses consistent timezone (Europe/Rome).'
  from pre_score where consistency_score < 0.95 and timestamp_issues > 0
  union all
  select 4, 'Duplicate rate of ' || printf('%.1f', u.duplicate_count * 100e0 / u.original_count) || '% detected. Review data ingestion processes to prevent duplicates.'
  from pre_score p, pre_uniq u where p.uniqueness_score < 0.98
  union all
  select 5, 'Low data coverage detected. Consider expanding data collection or focusing analysis on well-covered stations and time periods.'
  from pre_score where coverage_score < 0.7
) r
"""


@register("pre_recommendations", pre_sql(_PRE_REC_SQL))
def pre_recommendations(s):
    """Recommendation lines triggered by the pillar thresholds."""
    return pre.recommendations(_pre(s))


# ---- post-integration (input: the stored integrated table, per date) ---------

POST_CTES = """
pc as (
  select cast(cast(timestamp as date) as varchar) as date, count(*) as total,
    count(*) filter (where train_id is null) as null_train_id,
    count(*) filter (where timestamp is null) as null_timestamp,
    count(*) filter (where station_code is null) as null_station_code,
    count(*) filter (where temperature is not null or wind_speed is not null or precip_mm is not null
                     or weather_code is not null) as weather_matched,
    count(*) filter (where temperature < -50 or temperature > 60) as temp_out,
    count(*) filter (where precip_mm < 0) as precip_neg,
    count(*) filter (where hour_of_day is not null and day_of_week is not null and is_weekend is not null
      and is_rush_hour is not null and is_raining is not null and rain_intensity is not null
      and wind_category is not null and is_delayed is not null and delay_category is not null) as feat_complete,
    count(*) filter (where hour_of_day < 0 or hour_of_day > 23) as bad_hour,
    count(*) filter (where day_of_week < 0 or day_of_week > 6) as bad_dow,
    count(*) filter (where delay_minutes > 5 and not coalesce(is_delayed, false)) as incons_delay,
    count(*) filter (where precip_mm > 0 and not coalesce(is_raining, false)) as incons_rain,
    count(*) filter (where day_of_week in (5, 6) and not coalesce(is_weekend, false)) as incons_weekend,
    count(*) filter (where delay_minutes > 300) as extreme_delays
  from integrated_table group by 1),
pd as (
  select date, cast(sum(n - 1) as bigint) as dups from (
    select cast(cast(timestamp as date) as varchar) as date, count(*) as n from integrated_table
    group by 1, train_id, timestamp, station_code) x group by date),
pall as (select pc.*, coalesce(pd.dups, 0) as dups from pc left join pd on pd.date = pc.date),
prules as (
  select date, total, 0 as idx, 'completeness' as assessment, 'train_id_completeness' as rule_name, 'completeness' as rule_type,
    null_train_id * 1e0 / total <= 0.05 as passed, null_train_id as affected_records,
    case when null_train_id * 1e0 / total > 0.05 then 'flag' else 'none' end as action, true as emit,
    case when null_train_id * 1e0 / total > 0.05 then null_train_id else 0 end as flagged from pall
  union all select date, total, 0, 'completeness', 'timestamp_completeness', 'completeness',
    null_timestamp * 1e0 / total <= 0.05, null_timestamp,
    case when null_timestamp * 1e0 / total > 0.05 then 'flag' else 'none' end, true,
    case when null_timestamp * 1e0 / total > 0.05 then null_timestamp else 0 end from pall
  union all select date, total, 0, 'completeness', 'station_code_completeness', 'completeness',
    null_station_code * 1e0 / total <= 0.05, null_station_code,
    case when null_station_code * 1e0 / total > 0.05 then 'flag' else 'none' end, true,
    case when null_station_code * 1e0 / total > 0.05 then null_station_code else 0 end from pall
  union all select date, total, 1, 'weather_matching', 'weather_data_matching', 'consistency',
    weather_matched * 1e0 / total >= 0.95, total - weather_matched,
    case when weather_matched * 1e0 / total < 0.95 then 'flag' else 'none' end, true, 0 from pall
  union all select date, total, 1, 'weather_matching', 'temperature_plausibility', 'range', temp_out = 0, temp_out,
    'flag', temp_out > 0, temp_out from pall
  union all select date, total, 1, 'weather_matching', 'precipitation_validity', 'range', precip_neg = 0, precip_neg,
    'flag', precip_neg > 0, precip_neg from pall
  union all select date, total, 2, 'feature_engineering', 'feature_completeness', 'completeness',
    feat_complete * 1e0 / total >= 0.98, cast(trunc((1e0 - feat_complete * 1e0 / total) * total) as bigint),
    case when feat_complete * 1e0 / total < 0.98 then 'flag' else 'none' end, true, 0 from pall
  union all select date, total, 2, 'feature_engineering', 'hour_of_day_validity', 'range', bad_hour = 0, bad_hour,
    'flag', bad_hour > 0, bad_hour from pall
  union all select date, total, 2, 'feature_engineering', 'day_of_week_validity', 'range', bad_dow = 0, bad_dow,
    'flag', bad_dow > 0, bad_dow from pall
  union all select date, total, 3, 'consistency', 'delay_flag_consistency', 'business', incons_delay = 0, incons_delay,
    'flag', incons_delay > 0, incons_delay from pall
  union all select date, total, 3, 'consistency', 'rain_flag_consistency', 'business', incons_rain = 0, incons_rain,
    'flag', incons_rain > 0, incons_rain from pall
  union all select date, total, 3, 'consistency', 'weekend_flag_consistency', 'business', incons_weekend = 0,
    incons_weekend, 'flag', incons_weekend > 0, incons_weekend from pall
  union all select date, total, 4, 'anomaly_detection', 'extreme_delay_detection', 'business',
    extreme_delays * 1e0 / total <= 0.02, extreme_delays,
    case when extreme_delays * 1e0 / total > 0.02 then 'flag' else 'none' end, true,
    case when extreme_delays * 1e0 / total > 0.02 then extreme_delays else 0 end from pall
  union all select date, total, 4, 'anomaly_detection', 'duplicate_detection', 'deduplication', dups = 0, dups,
    case when dups > 0 then 'flag' else 'none' end, true, dups from pall),
presults as (
  select a.date, a.idx, a.assessment, a.total as total_records,
    cast(coalesce(sum(r.flagged), 0) as bigint) as flagged_records,
    a.total - cast(coalesce(sum(r.flagged), 0) as bigint) as valid_records
  from (select p.date, p.total, x.idx, x.assessment from pall p cross join (values (0, 'completeness'),
        (1, 'weather_matching'), (2, 'feature_engineering'), (3, 'consistency'), (4, 'anomaly_detection'))
        x(idx, assessment)) a
  left join prules r on r.date = a.date and r.idx = a.idx
  group by a.date, a.idx, a.assessment, a.total),
pscore as (
  select date, max(total_records) as total_records,
    case when max(total_records) > 0 then least(coalesce(sum(case when total_records > 0 then
      valid_records * 1e0 / total_records * (case idx when 0 then 0.3e0 when 1 then 0.25e0 when 2 then 0.2e0
      when 3 then 0.15e0 else 0.1e0 end) end), 0e0), 1e0) else 0e0 end as overall_quality_score,
    cast(sum(flagged_records) as bigint) as total_flagged_records
  from presults group by date)
"""


def post_sql(body: str) -> str:
    return f",\n{POST_CTES.strip()}\n{body}"


def _post(s):
    return post.assess(s.integrated_table)


@register("scan_integrated_day", "select * from integrated_table where timestamp >= timestamp '2024-01-15 00:00:00' "
                                 "and timestamp < timestamp '2024-01-16 00:00:00' order by timestamp, station_code")
def scan_integrated_day(s):
    """A3: the stored integrated rows of one date (range on the raw column)."""
    return post.scan_day(s.integrated_table, "2024-01-15")


_RULE_COLS = "date, assessment, rule_name, rule_type, passed, affected_records, action"


@register("post_completeness", post_sql(f"select {_RULE_COLS} from prules where emit and idx = 0"))
def post_completeness(s):
    """G15 rule rows per date."""
    return _post(s)["rules"].where(F.col("assessment") == "completeness")


@register("post_weather_match", post_sql(f"select {_RULE_COLS} from prules where emit and idx = 1"))
def post_weather_match(s):
    """G16 rule rows per date."""
    return _post(s)["rules"].where(F.col("assessment") == "weather_matching")


@register("post_features", post_sql(f"select {_RULE_COLS} from prules where emit and idx = 2"))
def post_features(s):
    """G17 rule rows per date."""
    return _post(s)["rules"].where(F.col("assessment") == "feature_engineering")


@register("post_consistency", post_sql(f"select {_RULE_COLS} from prules where emit and idx = 3"))
def post_consistency(s):
    """G18 rule rows per date."""
    return _post(s)["rules"].where(F.col("assessment") == "consistency")


@register("post_anomalies", post_sql(f"select {_RULE_COLS} from prules where emit and idx = 4"))
def post_anomalies(s):
    """G19 rule rows per date."""
    return _post(s)["rules"].where(F.col("assessment") == "anomaly_detection")


@register("post_overall_score", post_sql("select date, total_records, round(overall_quality_score, 9) as "
                                         "overall_quality_score, total_flagged_records from pscore"))
def post_overall_score(s):
    """Weighted valid/total over the five assessments, per date."""
    sc = _post(s)["score"]
    return sc.select("date", "total_records", R9("overall_quality_score"), "total_flagged_records")


_SUMMARY_SQL = """
select s.date,
  case when s.overall_quality_score >= 0.95 then 'EXCELLENT' when s.overall_quality_score >= 0.85 then 'GOOD'
       when s.overall_quality_score >= 0.70 then 'ACCEPTABLE' else 'POOR' end as quality_level,
  round(s.overall_quality_score, 9) as overall_quality_score, s.total_records, s.total_flagged_records,
  round(case when s.total_records > 0 then s.total_flagged_records * 1e0 / s.total_records else 0e0 end, 9)
    as flagged_rate,
  i.issues
from pscore s left join (
  select date, string_agg(rule_type || '=' || cast(n as varchar), ',' order by rule_type) as issues
  from (select date, rule_type, sum(affected_records) as n from prules where emit and not passed
        group by date, rule_type) x group by date) i on i.date = s.date
"""


@register("post_summary", post_sql(_SUMMARY_SQL))
def post_summary(s):
    """Level, flagged rate and affected rows by rule type of failed rules."""
    sm = post.summary(_post(s))
    issues = F.array_join(F.transform(F.array_sort(F.map_entries("issues_by_type")),
                                      lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string"))), ",")
    return sm.select("date", "quality_level", R9("overall_quality_score"), "total_records", "total_flagged_records",
                     R9("flagged_rate"), F.when(F.size("issues_by_type") > 0, issues).alias("issues"))


_POST_REC_SQL = """
select date, kind, rule_name, recommendation from (
  select date, 0 as kind, cast(null as varchar) as rule_name,
    'CRITICAL: Overall data quality is poor. Review integration process.' as recommendation
  from pscore where overall_quality_score < 0.70
  union all
  select date, 1, rule_name, case when rule_name = 'weather_data_matching'
      then 'Improve weather data matching - check time synchronization and station coverage'
    when rule_name like '%consistency%' then 'Review business logic implementation in feature engineering'
    when rule_name like '%completeness%' then 'Address data completeness issues in source systems'
    when rule_name like '%anomaly%' or rule_name like '%extreme%'
      then 'Investigate and handle data anomalies and outliers' end
  from prules where emit and not passed and affected_records > 0
) r where recommendation is not null
union all
select date, 2, cast(null as varchar), 'Data quality is good. Continue monitoring.' from pscore p
where not exists (select 1 from pscore c where c.date = p.date and c.overall_quality_score < 0.70)
  and not exists (select 1 from prules r where r.date = p.date and r.emit and not r.passed and r.affected_records > 0
                  and (r.rule_name = 'weather_data_matching' or r.rule_name like '%consistency%'
                       or r.rule_name like '%completeness%' or r.rule_name like '%anomaly%'
                       or r.rule_name like '%extreme%'))
"""


@register("post_recommendations", post_sql(_POST_REC_SQL))
def post_recommendations(s):
    """Recommendation lines per date."""
    return post.recommendations(_post(s))
