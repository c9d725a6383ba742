"""DuckDB SQL of the pipeline stages, for the oracle side of the checks.

Each query's oracle text is ``with <adapters>, <stages> select ...``; unused
CTEs are never evaluated. The stage SQL follows the reference semantics
independently of the Spark code (window dedup, range join + row_number).
"""

from __future__ import annotations

from trackcast.fixtures import duckdb_ctes

TRAIN_COLS = ("train_id, timestamp, station_code, scheduled_time, actual_time, delay_minutes, train_category, "
              "route, delay_status, destination, is_cancelled, ingest_seq")
NN_TRAIN = " + ".join(f"(case when {c.strip()} is null then 0 else 1 end)" for c in TRAIN_COLS.split(","))

STAGES = f"""
trains_norm as (select * from trains_raw where timestamp is not null),
trains_dedup as (
  select {TRAIN_COLS} from (
    select *, row_number() over (partition by train_id, timestamp, station_code
                                 order by ({NN_TRAIN}) desc, ingest_seq) as rn
    from trains_norm) d where rn = 1),
trains_clean as (
  select train_id, timestamp, station_code, scheduled_time, actual_time,
    case when delay_minutes < -5 then null else delay_minutes end as delay_minutes,
    train_category, route, delay_status, destination, is_cancelled, ingest_seq,
    case when delay_minutes < -5 then 1 else 0 end as delay_anomaly,
    case when delay_minutes > 300 then 1 else 0 end as delay_outlier
  from trains_dedup),
trains as (
  select train_id, timestamp, station_code, scheduled_time, actual_time, delay_minutes, train_category, route,
         delay_status, destination, is_cancelled from trains_clean),
weather_norm as (
  select station_code, date_trunc('hour', timestamp + interval 30 minute) as timestamp, temperature, wind_speed,
         precip_mm, weather_code, ingest_seq
  from weather_raw where timestamp is not null),
weather_dedup as (
  select station_code, timestamp, temperature, wind_speed, precip_mm, weather_code, ingest_seq from (
    select *, row_number() over (partition by station_code, timestamp order by ingest_seq desc) as rn
    from weather_norm) d where rn = 1),
weather_clean as (
  select station_code, timestamp,
    case when temperature < -20 or temperature > 50 then null else temperature end as temperature,
    wind_speed,
    case when precip_mm < 0 then null else precip_mm end as precip_mm,
    weather_code, ingest_seq,
    case when temperature < -20 or temperature > 50 then 1 else 0 end as temp_range_violation,
    case when precip_mm < 0 then 1 else 0 end as precip_range_violation
  from weather_dedup),
weather as (
  select station_code, timestamp, temperature, wind_speed, precip_mm, weather_code from weather_clean),
nearest_pick as (
  select lid, temperature, wind_speed, precip_mm, weather_code, diff_us from (
    select t.ingest_seq as lid, w.temperature, w.wind_speed, w.precip_mm, w.weather_code,
      abs(epoch_us(w.timestamp) - epoch_us(t.timestamp)) as diff_us,
      row_number() over (partition by t.ingest_seq
                         order by abs(epoch_us(w.timestamp) - epoch_us(t.timestamp)), w.timestamp) as rn
    from trains_clean t join weather w
      on w.station_code = t.station_code
     and w.timestamp between t.timestamp - interval 60 minute and t.timestamp + interval 60 minute) x
  where rn = 1),
integrated as (
  select t.train_id, t.timestamp, t.station_code, t.delay_minutes, t.train_category, t.route, t.delay_status,
         t.destination, t.is_cancelled, m.temperature, m.wind_speed, m.precip_mm, m.weather_code,
         m.lid is not null as matched
  from trains_clean t left join nearest_pick m on m.lid = t.ingest_seq),
station_counts as (
  select station_code, count(*) as station_traffic_rank from integrated
  where station_code is not null group by station_code),
fscalars as (
  select coalesce(min(hour(timestamp)) < max(hour(timestamp)), false) as hour_varies,
    coalesce(min(coalesce(precip_mm, 0)) < max(coalesce(precip_mm, 0)), false) as precip_varies,
    coalesce(min(coalesce(wind_speed, 0)) < max(coalesce(wind_speed, 0)), false) as wind_varies,
    coalesce(min(coalesce(delay_minutes, 0)) < max(coalesce(delay_minutes, 0)), false) as delay_varies,
    median(coalesce(length(route), 0)) as route_median,
    (select coalesce(min(station_traffic_rank) < max(station_traffic_rank), false) from station_counts)
      as traffic_varies,
    (select quantile_cont(station_traffic_rank, 0.33) from station_counts) as q33,
    (select quantile_cont(station_traffic_rank, 0.67) from station_counts) as q67
  from integrated),
features as (
  select i.train_id, i.timestamp, i.station_code, i.delay_minutes, i.train_category, i.route, i.delay_status,
    i.destination, i.is_cancelled, i.temperature, i.wind_speed, i.precip_mm, i.weather_code,
    cast(hour(i.timestamp) as integer) as hour_of_day,
    cast(isodow(i.timestamp) - 1 as integer) as day_of_week,
    cast(day(i.timestamp) as integer) as day_of_month,
    cast(month(i.timestamp) as integer) as month,
    cast(quarter(i.timestamp) as integer) as quarter,
    cast(year(i.timestamp) as integer) as year,
    isodow(i.timestamp) - 1 in (5, 6) as is_weekend,
    (hour(i.timestamp) >= 7 and hour(i.timestamp) < 9) or (hour(i.timestamp) >= 17 and hour(i.timestamp) < 19)
      as is_rush_hour,
    case when not s.hour_varies then 'Unknown'
         when hour(i.timestamp) between 0 and 6 then 'Night'
         when hour(i.timestamp) > 6 and hour(i.timestamp) <= 12 then 'Morning'
         when hour(i.timestamp) > 12 and hour(i.timestamp) <= 18 then 'Afternoon'
         when hour(i.timestamp) > 18 and hour(i.timestamp) <= 24 then 'Evening' end as time_period,
    case when month(i.timestamp) in (12, 1, 2) then 'Winter' when month(i.timestamp) in (3, 4, 5) then 'Spring'
         when month(i.timestamp) in (6, 7, 8) then 'Summer' else 'Autumn' end as season,
    case when i.temperature <= 0 then 'Freezing' when i.temperature <= 10 then 'Cold'
         when i.temperature <= 20 then 'Cool' when i.temperature <= 30 then 'Warm'
         when i.temperature > 30 then 'Hot' end as temp_category,
    coalesce(i.temperature < -10, false) as is_extreme_cold,
    coalesce(i.temperature > 35, false) as is_extreme_hot,
    coalesce(i.temperature <= 0, false) as is_freezing,
    coalesce(i.precip_mm > 0, false) as is_raining,
    case when not s.precip_varies then 'None'
         when coalesce(i.precip_mm, 0) < 0 then null
         when coalesce(i.precip_mm, 0) <= 0.1 then 'None' when coalesce(i.precip_mm, 0) <= 2.5 then 'Light'
         when coalesce(i.precip_mm, 0) <= 10 then 'Moderate' when coalesce(i.precip_mm, 0) <= 50 then 'Heavy'
         else 'Extreme' end as rain_intensity,
    coalesce(i.precip_mm > 10, false) as is_heavy_rain,
    case when not s.wind_varies then 'Calm'
         when coalesce(i.wind_speed, 0) < 0 then null
         when coalesce(i.wind_speed, 0) <= 5 then 'Calm' when coalesce(i.wind_speed, 0) <= 15 then 'Light'
         when coalesce(i.wind_speed, 0) <= 25 then 'Moderate' when coalesce(i.wind_speed, 0) <= 35 then 'Strong'
         else 'Severe' end as wind_category,
    coalesce(i.wind_speed > 25, false) as is_high_wind,
    least((case when i.temperature < -5 or i.temperature > 35 then 0.3e0 else 0e0 end)
          + least(coalesce(i.precip_mm, 0) / 20, 0.4e0) + least(coalesce(i.wind_speed, 0) / 50, 0.3e0), 1e0)
      as weather_severity_score,
    coalesce(i.temperature < -10, false) or coalesce(i.temperature > 35, false) or coalesce(i.precip_mm > 10, false)
      or coalesce(i.wind_speed > 25, false) as adverse_weather,
    case when not s.delay_varies then 'On_Time'
         when coalesce(i.delay_minutes, 0) <= -5 then 'Early' when coalesce(i.delay_minutes, 0) <= 5 then 'On_Time'
         when coalesce(i.delay_minutes, 0) <= 15 then 'Minor_Delay'
         when coalesce(i.delay_minutes, 0) <= 30 then 'Moderate_Delay'
         when coalesce(i.delay_minutes, 0) <= 60 then 'Major_Delay' else 'Severe_Delay' end as delay_category,
    coalesce(i.delay_minutes > 5, false) as is_delayed,
    coalesce(i.delay_minutes > 15, false) as is_significantly_delayed,
    coalesce(i.delay_minutes > 60, false) as is_severely_delayed,
    coalesce(i.delay_minutes < -5, false) as is_early,
    least(greatest(coalesce(i.delay_minutes, 0) / 120, 0e0), 1e0) as delay_severity_score,
    i.is_cancelled as service_disruption,
    case i.delay_status when 'on_time' then 0 when 'early' then -1 when 'delayed' then 1 when 'cancelled' then 2
         else 0 end as delay_status_encoded,
    coalesce(i.train_category in ('ICE', 'TGV', 'AVE', 'Frecciarossa', 'Shinkansen'), false) as is_high_speed,
    coalesce(i.train_category in ('RE', 'RB', 'S', 'Regional'), false) as is_regional,
    c.station_traffic_rank,
    case when not (s.traffic_varies and s.q33 < s.q67) then 'Medium_Traffic'
         when c.station_traffic_rank is null then null
         when c.station_traffic_rank <= s.q33 then 'Low_Traffic'
         when c.station_traffic_rank <= s.q67 then 'Medium_Traffic' else 'High_Traffic' end as station_importance,
    cast(coalesce(length(i.route), 0) as integer) as route_complexity,
    coalesce(length(i.route), 0) > s.route_median as is_complex_route,
    coalesce(regexp_matches(i.destination, 'Berlin|Munich|Hamburg|Frankfurt|Cologne|Stuttgart'), false)
      as is_major_destination
  from integrated i left join station_counts c on c.station_code = i.station_code cross join fscalars s),
integrated_table as (
  select train_id, timestamp, station_code, delay_minutes, temperature, wind_speed, precip_mm, weather_code,
    train_category, route, delay_status, destination, is_cancelled, hour_of_day, day_of_week, is_weekend,
    is_rush_hour, temp_category, is_raining, rain_intensity, wind_category, is_delayed, delay_category
  from features)
"""


def with_(body: str) -> str:
    """Full oracle text: adapters + stages + the query body."""
    return f"with {duckdb_ctes()},\n{STAGES}\n{body}"
