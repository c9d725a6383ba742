"""Adapter views: train / weather / station shaped rows over the test tables.

These only give rows in the schemas the jobs expect (FIXTURES.md section 2);
they do none of the jobs' work. The same SQL text runs in Spark (tables passed
as DataFrame arguments) and in DuckDB (tables as views), so the oracle sees
exactly the same inputs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

STATIONS_SQL = """
select concat('S', lpad(cast(n_nationkey as string), 2, '0')) as station_code, n_name as station_name,
  case when n_nationkey % 8 = 7 then null else 44.7e0 + n_nationkey * 0.09e0 end as latitude,
  case when n_nationkey % 8 = 7 then null else 8.4e0 + ((n_nationkey * 7) % 25) * 0.13e0 end as longitude
from {nation}
"""

BASE_SQL = """
select event_id, ts, user_id, event_type, value,
  concat('S', lpad(cast((user_id % 26) as string), 2, '0')) as station_code,
  case when event_id % 17 = 0 then null else cast(floor(value) as int) - 12 end as d
from {events}
"""

TRAINS_RAW_SQL = """
select cast(event_id % 977 as string) as train_id, ts as timestamp, station_code, ts as scheduled_time,
  ts + d * interval 1 minute as actual_time, d as delay_minutes,
  case event_id % 6 when 0 then 'RE' when 1 then 'S' when 2 then 'Frecciarossa' when 3 then 'IC'
    when 4 then 'RB' else 'EC' end as train_category,
  case when copy_no = 1 then null else concat('R', repeat('x', cast(event_id % 9 as int)), '<br>',
    case event_id % 4 when 0 then 'Milano' when 1 then 'Frankfurt (M)' when 2 then 'Munich' else 'Como' end) end as route,
  case when event_id % 29 = 0 then 'cancelled' when d > 5 then 'delayed' when d < -2 then 'early'
    else 'on_time' end as delay_status,
  case event_id % 4 when 0 then 'Milano' when 1 then 'Frankfurt' when 2 then 'Munich' else 'Como' end as destination,
  event_id % 29 = 0 as is_cancelled, event_id * 2 + copy_no as ingest_seq
from (select b.*, 0 as copy_no from ({base}) b
      union all select b.*, 1 as copy_no from ({base}) b where event_id % 20 = 0) x
where event_type in ('click', 'purchase', 'signup')
"""

WEATHER_RAW_SQL = """
select station_code, ts as timestamp,
  case when event_id % 13 = 0 then null else value * 0.3e0 - 22e0 end as temperature,
  (event_id % 41) * 1e0 as wind_speed, ((event_id * 7) % 60) / 4e0 - 1e0 as precip_mm,
  cast(event_id % 100 as int) as weather_code, event_id as ingest_seq
from ({base}) b where event_type in ('view', 'error')
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stations(spark: SparkSession, sf_dir: str, nation: DataFrame | None = None) -> DataFrame:
    return spark.sql(STATIONS_SQL, nation=nation if nation is not None else table(spark, sf_dir, "nation"))


def trains_raw(spark: SparkSession, sf_dir: str, events: DataFrame | None = None) -> DataFrame:
    base = BASE_SQL.format(events="{events}")
    ev = events if events is not None else table(spark, sf_dir, "events")
    return spark.sql(TRAINS_RAW_SQL.replace("{base}", base), events=ev)


def weather_raw(spark: SparkSession, sf_dir: str, events: DataFrame | None = None) -> DataFrame:
    base = BASE_SQL.format(events="{events}")
    ev = events if events is not None else table(spark, sf_dir, "events")
    return spark.sql(WEATHER_RAW_SQL.replace("{base}", base), events=ev)


def duckdb_ctes() -> str:
    """The adapters as DuckDB CTE text (``with`` omitted), over the plain views."""
    base = BASE_SQL.format(events="events")
    return ",\n".join([
        f"stations as ({STATIONS_SQL.format(nation='nation')})",
        f"trains_raw as ({TRAINS_RAW_SQL.replace('{base}', base)})",
        f"weather_raw as ({WEATHER_RAW_SQL.replace('{base}', base)})",
    ])
