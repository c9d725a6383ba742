"""Table-level queries: scans, writes, constraints, joins, aggregates, set ops, windows."""

from __future__ import annotations

import dataclasses

from pyspark.sql import functions as F

from trackcast.catalog import register
from trackcast.config import DELAY_STATUSES, TRAIN_COLUMNS, TrainConfig, WeatherConfig
from trackcast.functions.nulls import count_if
from trackcast.operators import rules as R
from trackcast.operators import setops
from trackcast.operators.attach import one_row
from trackcast.operators.dedup import dedup_last, duplicate_count, duplicate_flag
from trackcast.operators.spatial import EXAMPLE_REGION, points_in_region, ring_edges_sql
from trackcast.operators.windows import gap_hours as gap_hours_op
from trackcast.operators.windows import top_k_per_group
from trackcast.plans import dq, post, pre
from trackcast.session import new_work_dir
from trackcast.sources import constraints as K
from trackcast.sources import sinks as B

TC, WC = TrainConfig(), WeatherConfig()
RANGE_START, RANGE_END = "2024-01-01", "2024-01-31"   # the whole month of the test data
STORED_UNTIL = "2024-01-16"                           # backfill scenario: rows before this day are stored
DAY = "'%Y-%m-%d'"


def _day_range(df, start, end):
    s = F.lit(start).cast("timestamp_ntz")
    e = F.timestamp_add("DAY", F.lit(1), F.lit(end).cast("timestamp_ntz"))
    return df.where((F.col("timestamp") >= s) & (F.col("timestamp") < e))


def _weather_norm(s):
    return dq.normalize_timestamps(s.weather_raw, round_to_hour=True)


# ---- scans (A1, A2, A10, A11) ----------------------------------------------------

@register("scan_trains_range", f"select * from trains where timestamp >= timestamp '{RANGE_START} 00:00:00' and "
                               f"timestamp < timestamp '{RANGE_END} 00:00:00' + interval 1 day "
                               "order by timestamp, station_code")
def scan_trains_range(s):
    """A1: the 11 train columns with both date bounds inclusive (a sargable
    range on the raw timestamp), ordered by time and station."""
    return _day_range(s.trains, RANGE_START, RANGE_END).orderBy("timestamp", "station_code")


@register("scan_weather_range", f"select * from weather where timestamp >= timestamp '{RANGE_START} 00:00:00' and "
                                f"timestamp < timestamp '{RANGE_END} 00:00:00' + interval 1 day "
                                "order by timestamp, station_code")
def scan_weather_range(s):
    """A2: the 6 weather columns over the date range, ordered."""
    return _day_range(s.weather, RANGE_START, RANGE_END).orderBy("timestamp", "station_code")


@register("sql_param", "select station_code, count(*) as n, round(avg(delay_minutes), 9) as avg_delay from trains "
                       "where timestamp >= timestamp '2024-01-01 00:00:00' and timestamp < timestamp '2024-02-01 00:00:00' "
                       "group by station_code")
def sql_param(s):
    """A10: a named-parameter SQL query over a DataFrame argument."""
    return s.spark.sql(
        "select station_code, count(*) as n, round(avg(delay_minutes), 9) as avg_delay from {t} "
        "where timestamp >= cast(:start as timestamp_ntz) and timestamp < cast(:end as timestamp_ntz) "
        "group by station_code",
        args={"start": "2024-01-01 00:00:00", "end": "2024-02-01 00:00:00"}, t=s.trains)


@register("list_stations", "select * from stations order by station_name")
def list_stations(s):
    """Stations ordered by name."""
    return s.stations.orderBy("station_name")


# ---- writes (B1-B3, B8-B10) -----------------------------------------------------------

def _stored(s, frame, name, partition_by):
    """The frame written to a new table under its partitions and read back in its own columns."""
    path = new_work_dir(s.spark, name)
    B.write_partitioned(frame, path, partition_by=partition_by)
    return s.spark.read.schema(frame.schema).parquet(path).select(*frame.columns)


@register("append_trains", f"select *, strftime(timestamp, {DAY}) as date from trains")
def append_trains(s):
    """B1: the 11 stored train columns appended under their date partitions, read back."""
    return _stored(s, B.append_trains(s.trains_clean), "trains", ("date",))


_WNORM = "(select station_code, timestamp, temperature, wind_speed, precip_mm, weather_code, ingest_seq from weather_norm)"


@register("insert_if_absent", f"""
select * from (
  select station_code, timestamp, temperature, wind_speed, precip_mm, weather_code, ingest_seq from (
    select *, row_number() over (partition by station_code, timestamp order by ingest_seq) as rn from {_WNORM} x
  ) f where rn = 1) n
where not exists (select 1 from weather w where w.timestamp < timestamp '{STORED_UNTIL} 00:00:00'
                  and w.station_code = n.station_code and w.timestamp = n.timestamp)""")
def insert_if_absent(s):
    """B2: new rounded weather rows (first per key in the batch) whose
    (station, hour) is not stored yet; the stored row wins."""
    existing = s.weather.where(F.col("timestamp") < F.lit(f"{STORED_UNTIL} 00:00:00").cast("timestamp_ntz"))
    new = _weather_norm(s)
    out = B.insert_if_absent(new, existing, ["station_code", "timestamp"], "ingest_seq")
    return out


_NEW_STATIONS = """
select concat('S', lpad(cast(n_nationkey + 20 as string), 2, '0')) as station_code, upper(n_name) as station_name,
  case when n_nationkey % 3 = 0 then null else 45.0e0 + n_regionkey * 0.1e0 end as latitude,
  case when n_nationkey % 3 = 0 then null else 9.0e0 + n_regionkey * 0.1e0 end as longitude
from {nation}"""


@register("upsert_stations", f"""
select coalesce(n.station_code, o.station_code) as station_code,
  case when n.station_code is not null then n.station_name else o.station_name end as station_name,
  coalesce(n.latitude, o.latitude) as latitude, coalesce(n.longitude, o.longitude) as longitude
from stations o full outer join ({_NEW_STATIONS.format(nation='nation')}) n on o.station_code = n.station_code""")
def upsert_stations(s):
    """Insert new codes, overwrite names, coalesce(new, old) coordinates."""
    new = s.spark.sql(_NEW_STATIONS, nation=s.table("nation"))
    return B.upsert(new, s.stations, "station_code", overwrite=("station_name",),
                    coalesce_new_first=("latitude", "longitude"))


@register("skip_loaded_dates", f"""
select distinct strftime(timestamp, '%Y-%m-%d') as date from trains_raw
except select distinct strftime(timestamp, '%Y-%m-%d') from trains where timestamp < timestamp '{STORED_UNTIL} 00:00:00'""")
def skip_loaded_dates(s):
    """Dates of the new batch with no stored row."""
    stored = s.trains.where(F.col("timestamp") < F.lit(f"{STORED_UNTIL} 00:00:00").cast("timestamp_ntz"))
    return B.skip_loaded_dates(s.trains_raw, stored).select(F.date_format("date", "yyyy-MM-dd").alias("date"))


_CHUNKS_SQL = """
select strftime(cs, '%Y-%m-%d') as chunk_start, strftime(least(cs + interval 6 day, e), '%Y-%m-%d') as chunk_end
from (select min(cast(timestamp as date)) as s, max(cast(timestamp as date)) as e from trains_raw) b,
     unnest(generate_series(b.s, b.e, interval 7 day)) as g(cs)"""


def _bounds(s):
    return s.trains_raw.agg(F.min(F.to_date("timestamp")).alias("start_date"),
                            F.max(F.to_date("timestamp")).alias("end_date"))


@register("plan_date_chunks", _CHUNKS_SQL)
def plan_date_chunks(s):
    """7-day chunks over the batch's date span, the last one short."""
    c = B.plan_date_chunks(_bounds(s), 7)
    return c.select(F.date_format("chunk_start", "yyyy-MM-dd").alias("chunk_start"),
                    F.date_format("chunk_end", "yyyy-MM-dd").alias("chunk_end"))


@register("skip_loaded_range", f"""
select c.chunk_start, c.chunk_end, coalesce(count(i.timestamp), 0) as record_count,
  strftime(min(cast(i.timestamp as date)), '%Y-%m-%d') as min_date,
  strftime(max(cast(i.timestamp as date)), '%Y-%m-%d') as max_date, count(i.timestamp) > 0 as skip
from ({_CHUNKS_SQL}) c left join (select timestamp from integrated_table
  where timestamp < timestamp '{STORED_UNTIL} 00:00:00') i
  on strftime(i.timestamp, '%Y-%m-%d') >= c.chunk_start and strftime(i.timestamp, '%Y-%m-%d') <= c.chunk_end
group by c.chunk_start, c.chunk_end""")
def skip_loaded_range(s):
    """Per 7-day chunk, stored integrated rows inside it and the skip flag."""
    stored = s.integrated_table.where(F.col("timestamp") < F.lit(f"{STORED_UNTIL} 00:00:00").cast("timestamp_ntz"))
    r = B.skip_loaded_range(_bounds(s), stored, 7)
    fmt = lambda c: F.date_format(c, "yyyy-MM-dd").alias(c)
    return r.select(fmt("chunk_start"), fmt("chunk_end"), "record_count", fmt("min_date"), fmt("max_date"), "skip")


_LAND_RAW_SQL = """
select strftime(timestamp, '%Y-%m-%d') as date, station_code,
  '{' || concat_ws(',',
    case when train_id is null then null else '"train_id":' || cast(to_json(train_id) as varchar) end,
    case when timestamp is null then null else '"timestamp":"' || strftime(timestamp, '%Y-%m-%dT%H:%M:%S.%f') || '"' end,
    case when station_code is null then null else '"station_code":' || cast(to_json(station_code) as varchar) end,
    case when scheduled_time is null then null else '"scheduled_time":"' || strftime(scheduled_time, '%Y-%m-%dT%H:%M:%S.%f') || '"' end,
    case when actual_time is null then null else '"actual_time":"' || strftime(actual_time, '%Y-%m-%dT%H:%M:%S.%f') || '"' end,
    case when delay_minutes is null then null else '"delay_minutes":' || cast(delay_minutes as varchar) end,
    case when train_category is null then null else '"train_category":' || cast(to_json(train_category) as varchar) end,
    case when route is null then null else '"route":' || cast(to_json(route) as varchar) end,
    case when delay_status is null then null else '"delay_status":' || cast(to_json(delay_status) as varchar) end,
    case when destination is null then null else '"destination":' || cast(to_json(destination) as varchar) end,
    case when is_cancelled is null then null else '"is_cancelled":' || cast(is_cancelled as varchar) end,
    case when ingest_seq is null then null else '"ingest_seq":' || cast(ingest_seq as varchar) end) || '}' as payload
from trains_raw"""


@register("land_raw", _LAND_RAW_SQL)
def land_raw(s):
    """Raw train rows as JSON documents landed under date and station, read back."""
    return _stored(s, B.land_raw(s.trains_raw), "raw", ("date", "station_code"))


@register("write_curated_csv", "select *, cast(year(timestamp) as integer) as year from weather")
def write_curated_csv(s):
    """Curated weather CSV per station and year with a header; a second write skips what exists; read back."""
    frame = B.curated_weather(s.weather)
    path = new_work_dir(s.spark, "curated")
    for _ in range(2):
        B.write_absent_partitions(frame, path, partition_by=("station_code", "year"), fmt="csv")
    return s.spark.read.schema(frame.schema).option("header", True).options(**B.TS_OPTIONS).csv(path).select(*frame.columns)


# ---- constraints (K1-K5) ----------------------------------------------------------------

@register("check_not_null", """
select 'trains_raw' as table_name, c as column_name, n as violations from (
  select 'train_id' as c, count(*) filter (where train_id is null) as n from trains_raw
  union all select 'timestamp', count(*) filter (where timestamp is null) from trains_raw) x
union all
select 'weather_raw', c, n from (
  select 'timestamp' as c, count(*) filter (where timestamp is null) as n from weather_raw) y
union all
select 'stations', c, n from (
  select 'station_code' as c, count(*) filter (where station_code is null) as n from stations
  union all select 'station_name', count(*) filter (where station_name is null) from stations) z""")
def check_not_null(s):
    """K1: NOT NULL columns of the three tables."""
    return (K.check_not_null(s.trains_raw, "trains_raw", ["train_id", "timestamp"])
            .unionByName(K.check_not_null(s.weather_raw, "weather_raw", ["timestamp"]))
            .unionByName(K.check_not_null(s.stations, "stations", ["station_code", "station_name"])))


def _uniq_sql(table, keys):
    return (f"select '{table}' as table_name, '{','.join(keys)}' as key_columns, "
            f"count(*) filter (where n > 1) as duplicate_keys, cast(coalesce(sum(n - 1), 0) as bigint) as surplus_rows "
            f"from (select count(*) as n from {table} group by {', '.join(keys)}) g")


@register("check_unique", " union all ".join([
    _uniq_sql("trains_raw", ["train_id", "timestamp", "station_code"]),
    _uniq_sql("weather_norm", ["station_code", "timestamp"]),
    _uniq_sql("stations", ["station_code"])]))
def check_unique(s):
    """K2: unique keys of trains, rounded weather and stations."""
    return (K.check_unique(s.trains_raw, "trains_raw", ["train_id", "timestamp", "station_code"])
            .unionByName(K.check_unique(_weather_norm(s), "weather_norm", ["station_code", "timestamp"]))
            .unionByName(K.check_unique(s.stations, "stations", ["station_code"])))


@register("check_fk", """
select 'trains_raw' as table_name, 'station_code' as column_name, count(*) as violations from trains_raw t
where t.station_code is not null and t.station_code not in (select station_code from stations)
union all
select 'weather_raw', 'station_code', count(*) from weather_raw w
where w.station_code is not null and w.station_code not in (select station_code from stations)""")
def check_fk(s):
    """K3: rows whose station is not in the station table."""
    return (K.check_fk(s.trains_raw, "trains_raw", s.stations)
            .unionByName(K.check_fk(s.weather_raw, "weather_raw", s.stations)))


@register("apply_defaults", "select ingest_seq, coalesce(is_cancelled, false) as is_cancelled from trains_raw")
def apply_defaults(s):
    """K4: column defaults filled (is_cancelled false)."""
    return K.apply_defaults(s.trains_raw, {"is_cancelled": False}).select("ingest_seq", "is_cancelled")


@register("check_enum", "select 'trains_raw' as table_name, 'delay_status' as column_name, count(*) filter (where "
                        "delay_status is not null and delay_status not in ('on_time', 'delayed', 'early', "
                        "'cancelled')) as violations from trains_raw")
def check_enum(s):
    """K5: delay_status outside its enumeration (null passes)."""
    return K.check_enum(s.trains_raw, "trains_raw", "delay_status", DELAY_STATUSES)


# ---- projections and row filters (C1-C7) ------------------------------------------------

@register("project_existing", "select train_id, timestamp, station_code, scheduled_time, actual_time, delay_minutes, "
                              "train_category, route, delay_status, destination, is_cancelled from trains_clean")
def project_existing(s):
    """The target columns that exist, in target order (flags dropped)."""
    return B.project_existing(s.trains_clean, TRAIN_COLUMNS)


@register("require_columns", """
select 'trains_raw' as table_name, c as column_name, true as present, n as rows from
  (select count(*) as n from trains_raw) t, (values ('train_id'), ('timestamp'), ('station_code')) v(c)
union all
select 'weather_raw', c, true, n from
  (select count(*) as n from weather_raw) t, (values ('station_code'), ('timestamp'), ('temperature')) v(c)""")
def require_columns(s):
    """Required columns per table, present or missing, with the row count."""
    out = None
    for name, df, req in (("trains_raw", s.trains_raw, TC.required_fields),
                          ("weather_raw", s.weather_raw, WC.required_fields)):
        missing = set(B.require_columns(df, req))
        items = F.array(*[F.struct(F.lit(c).alias("column_name"), F.lit(c not in missing).alias("present"))
                          for c in req])
        part = df.agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(name).alias("table_name"), F.explode(items).alias("r"), "rows") \
            .select("table_name", "r.column_name", "r.present", "rows")
        out = part if out is None else out.unionByName(part)
    return out


@register("drop_null_timestamp", "select * from trains_raw where timestamp is not null")
def drop_null_timestamp(s):
    """Rows without a timestamp removed."""
    return dq.normalize_timestamps(s.trains_raw)


@register("flag_out_of_range", """
select ingest_seq, case when temperature < -20 or temperature > 50 then null else temperature end as temperature,
  case when temperature < -20 or temperature > 50 then 1 else 0 end as temp_range_violation
from weather_raw""")
def flag_out_of_range(s):
    """C4: out-of-range temperature nulled and flagged."""
    r = R.apply_rules(s.weather_raw, R.weather_business_rules()[:1], init_flags=("temp_range_violation",))
    return r.select("ingest_seq", "temperature", "temp_range_violation")


@register("flag_only", """
select 'train' as side, ingest_seq, cast(coalesce(delay_minutes > 300, false) as integer) as flag_300,
  cast(coalesce(delay_minutes > 480, false) as integer) as flag_480 from trains_raw
union all
select 'weather', ingest_seq, cast(coalesce(temperature < -20 or temperature > 50, false) as integer), null
from weather_raw""")
def flag_only(s):
    """Flags set, values kept: delay > 300, delay > 480, temperature range."""
    from trackcast.functions.nulls import as_flag
    t = s.trains_raw.select(F.lit("train").alias("side"), "ingest_seq",
                            as_flag(F.col("delay_minutes") > 300).alias("flag_300"),
                            as_flag(F.col("delay_minutes") > 480).alias("flag_480"))
    w = s.weather_raw.select(F.lit("weather").alias("side"), "ingest_seq",
                             as_flag((F.col("temperature") < -20) | (F.col("temperature") > 50)).alias("flag_300"),
                             F.lit(None).cast("int").alias("flag_480"))
    return t.unionByName(w)


@register("clamp_negative", """
select 'train' as side, ingest_seq,
  cast(case when delay_minutes >= -2 and delay_minutes < 0 then 0 else delay_minutes end as double) as value
from trains_raw
union all
select 'weather', ingest_seq, case when precip_mm < 0 then 0e0 else precip_mm end from weather_raw""")
def clamp_negative(s):
    """Delays in [-2, 0) and negative precipitation set to 0."""
    tf, wf = pre.apply_fixes(s.trains_raw, s.weather_raw)
    return (tf.select(F.lit("train").alias("side"), "ingest_seq", F.col("delay_minutes").cast("double").alias("value"))
            .unionByName(wf.select(F.lit("weather").alias("side"), "ingest_seq", F.col("precip_mm").alias("value"))))


@register("fill_null", "select train_id, timestamp, station_code, coalesce(delay_minutes, 0) as delay_filled, "
                       "coalesce(precip_mm, 0) as precip_filled, coalesce(wind_speed, 0) as wind_filled from integrated")
def fill_null(s):
    """Nulls read as 0 before scoring and binning."""
    from trackcast.functions.nulls import fill0
    i = s.integrated
    return i.select("train_id", "timestamp", "station_code", fill0(F.col("delay_minutes")).alias("delay_filled"),
                    fill0(F.col("precip_mm")).alias("precip_filled"), fill0(F.col("wind_speed")).alias("wind_filled"))


# ---- joins (D2-D5, D8) -----------------------------------------------------------------------

_GRID_SQL = """
select st.station_code, strftime(g.d, '%Y-%m-%d') as date,
  coalesce(t.n, 0) as train_rows, coalesce(w.n, 0) as weather_rows,
  coalesce(t.n, 0) = 0 as missing_train, coalesce(w.n, 0) = 0 as missing_weather
from stations st
cross join (select unnest(generate_series(min(cast(timestamp as date)), max(cast(timestamp as date)), interval 1 day)) as d
            from trains_raw) g
left join (select station_code, cast(timestamp as date) as d, count(*) as n from trains_raw group by 1, 2) t
  on t.station_code = st.station_code and t.d = g.d
left join (select station_code, cast(timestamp as date) as d, count(*) as n from weather_raw group by 1, 2) w
  on w.station_code = st.station_code and w.d = g.d"""


def _grid(s):
    """stations x dates of the batch span as a generator (explode of a date
    sequence per station row) -- both sides are dimensions."""
    span = s.trains_raw.agg(F.struct(F.min(F.to_date("timestamp")).alias("a"),
                                     F.max(F.to_date("timestamp")).alias("b")).alias("s")).scalar()
    g = s.stations.select("station_code", F.explode(F.sequence(span["a"], span["b"])).alias("d"))
    t = s.trains_raw.groupBy("station_code", F.to_date("timestamp").alias("d")).agg(F.count(F.lit(1)).alias("tn"))
    w = s.weather_raw.groupBy("station_code", F.to_date("timestamp").alias("d")).agg(F.count(F.lit(1)).alias("wn"))
    return (g.join(t, ["station_code", "d"], "left").join(w, ["station_code", "d"], "left")
             .select("station_code", "d", F.coalesce("tn", F.lit(0)).alias("train_rows"),
                     F.coalesce("wn", F.lit(0)).alias("weather_rows")))


@register("station_date_grid", _GRID_SQL)
def station_date_grid(s):
    """Expected (station, date) set with actual counts and the gaps."""
    g = _grid(s)
    return g.select("station_code", F.date_format("d", "yyyy-MM-dd").alias("date"), "train_rows", "weather_rows",
                    (F.col("train_rows") == 0).alias("missing_train"), (F.col("weather_rows") == 0).alias("missing_weather"))


@register("points_in_region", f"""
select s.station_code, s.station_name from stations s, ({ring_edges_sql(EXAMPLE_REGION)}) e(x1, y1, x2, y2)
where s.latitude is not null and s.longitude is not null
group by s.station_code, s.station_name
having sum(case when ((y1 > s.latitude) != (y2 > s.latitude))
                 and s.longitude < (x2 - x1) * (s.latitude - y1) / (y2 - y1) + x1 then 1 else 0 end) % 2 = 1""")
def points_in_region_q(s):
    """D3: stations inside the region ring (ray casting with aggregate())."""
    return points_in_region(s.stations, EXAMPLE_REGION).select("station_code", "station_name")


@register("station_overlap", """
select coalesce(t.c, w.c) as station_code, t.c is not null as in_left, w.c is not null as in_right
from (select distinct station_code as c from trains_raw where station_code is not null) t
full outer join (select distinct station_code as c from weather_raw where station_code is not null) w on t.c = w.c""")
def station_overlap(s):
    """Station codes of trains and weather with presence flags."""
    return setops.station_overlap(s.trains_raw, s.weather_raw)


@register("orphan_rows", "select t.* from trains_raw t where t.station_code is not null and not exists "
                         "(select 1 from stations st where st.station_code = t.station_code)")
def orphan_rows(s):
    """Train rows whose station has no station row."""
    return K.orphan_rows(s.trains_raw, s.stations)


@register("train_station_enrich", "select w.*, st.station_name, st.latitude, st.longitude from weather w "
                                  "join stations st on st.station_code = w.station_code")
def train_station_enrich(s):
    """Station name and coordinates carried to the weather rows."""
    return s.weather.join(s.stations, "station_code", "inner").select(
        *s.weather.columns, "station_name", "latitude", "longitude")


# ---- aggregates (E1-E5, E7-E11, E13, E18-E20) ------------------------------------------------

_E1 = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
       "conversations").split()


@register("table_counts", " union all ".join(
    [f"select '{t}' as table_name, count(*) as rows from {t}" for t in _E1]
    + [f"select '{t}', count(*) from {t}" for t in ("stations", "trains_raw", "weather_raw", "trains", "weather")]))
def table_counts(s):
    """Row counts per table."""
    frames = [(t, s.table(t)) for t in _E1] + [("stations", s.stations), ("trains_raw", s.trains_raw),
                                               ("weather_raw", s.weather_raw), ("trains", s.trains),
                                               ("weather", s.weather)]
    out = None
    for name, df in frames:
        part = df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table_name"), "rows")
        out = part if out is None else out.unionByName(part)
    return out


@register("daily_counts", f"select strftime(timestamp, {DAY}) as date, count(*) as n from trains "
                          "group by 1 order by 1 desc limit 10")
def daily_counts(s):
    """Rows per date, newest 10 (the top-k is the feature)."""
    return (s.trains.groupBy(F.date_format("timestamp", "yyyy-MM-dd").alias("date"))
             .agg(F.count(F.lit(1)).alias("n")).orderBy(F.col("date").desc()).limit(10))


_TRAW_COLS = ("train_id", "timestamp", "station_code", "scheduled_time", "actual_time", "delay_minutes",
              "train_category", "route", "delay_status", "destination", "is_cancelled", "ingest_seq")


@register("null_profile", " union all ".join(
    f"select '{c}' as column_name, count(*) filter (where {c} is null) as null_count, "
    f"round(count(*) filter (where {c} is null) * 100e0 / count(*), 9) as null_percentage from trains_raw"
    for c in _TRAW_COLS))
def null_profile(s):
    """Null count and percentage per column, one aggregate then unpivot."""
    t = s.trains_raw
    agg = t.agg(F.count(F.lit(1)).alias("_n"), *[count_if(F.col(c).isNull()).alias(c) for c in t.columns])
    long = agg.unpivot("_n", t.columns, "column_name", "null_count")
    return long.select("column_name", "null_count",
                       F.round(F.col("null_count") * 100.0 / F.col("_n"), 9).alias("null_percentage"))


@register("all_null_group", "select count(*) filter (where latitude is null and longitude is null) as rows_all_null, "
                            "count(*) as rows from stations")
def all_null_group(s):
    """Rows where every available coordinate field is null."""
    st = s.stations
    return st.agg(count_if(F.col("latitude").isNull() & F.col("longitude").isNull()).alias("rows_all_null"),
                  F.count(F.lit(1)).alias("rows"))


@register("any_null_required", """
select 'trains_raw' as table_name, count(*) filter (where station_code is null or timestamp is null or train_id is null)
  as rows_any_null, count(*) as rows from trains_raw
union all
select 'weather_raw', count(*) filter (where station_code is null or timestamp is null or temperature is null), count(*)
from weather_raw""")
def any_null_required(s):
    """E5: rows with any required field null."""
    out = None
    for name, df, req in (("trains_raw", s.trains_raw, TC.required_fields),
                          ("weather_raw", s.weather_raw, WC.required_fields)):
        part = df.agg(count_if(dq.any_required_null(df, req)).alias("rows_any_null"),
                      F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table_name"), "*")
        out = part if out is None else out.unionByName(part)
    return out


_RAW_RULES = (("trains_raw", "extreme_early_delay", "delay_minutes < -5"),
              ("trains_raw", "extreme_delay_outlier", "delay_minutes > 300"),
              ("weather_raw", "temperature_range_validation", "temperature < -20 or temperature > 50"),
              ("weather_raw", "precip_mm_range_validation", "precip_mm < 0"))


@register("rule_violations", " union all ".join(
    f"select '{t}' as table_name, '{r}' as rule_name, count(*) filter (where {p}) as violations, "
    f"round(count(*) filter (where {p}) * 100e0 / count(*), 9) as violation_percentage from {t}"
    for t, r, p in _RAW_RULES))
def rule_violations(s):
    """Count and percentage per rule, one aggregate per table."""
    out = None
    for table, df, rules in (("trains_raw", s.trains_raw, R.train_business_rules()),
                             ("weather_raw", s.weather_raw, R.weather_business_rules())):
        rules = R.active(df, rules)
        agg = df.agg(F.count(F.lit(1)).alias("_n"),
                     *[count_if(r.predicate(df)).alias(r.name) for r in rules])
        long = agg.unpivot("_n", [r.name for r in rules], "rule_name", "violations")
        part = long.select(F.lit(table).alias("table_name"), "rule_name", "violations",
                           F.round(F.col("violations") * 100.0 / F.col("_n"), 9).alias("violation_percentage"))
        out = part if out is None else out.unionByName(part)
    return out


@register("distinct_stations", "select station_code from trains_raw where station_code is not null union "
                               "select station_code from weather_raw where station_code is not null")
def distinct_stations(s):
    """Distinct station codes over both tables."""
    return setops.stations_union(s.trains_raw, s.weather_raw)


@register("date_span", f"select strftime(min(cast(timestamp as date)), {DAY}) as min_date, "
                       f"strftime(max(cast(timestamp as date)), {DAY}) as max_date from "
                       "(select timestamp from trains_raw union all select timestamp from weather_raw) u")
def date_span(s):
    """First and last date over both tables."""
    u = s.trains_raw.select("timestamp").unionByName(s.weather_raw.select("timestamp"))
    return u.agg(F.date_format(F.min(F.to_date("timestamp")), "yyyy-MM-dd").alias("min_date"),
                 F.date_format(F.max(F.to_date("timestamp")), "yyyy-MM-dd").alias("max_date"))


@register("overlap_hours", """
select cast(trunc((epoch_us(least(t1, w1)) - epoch_us(greatest(t0, w0))) / 3600000000e0) as bigint) as overlap_hours,
  cast(trunc(greatest(epoch_us(t1) - epoch_us(t0), epoch_us(w1) - epoch_us(w0)) / 3600000000e0) as bigint) as total_hours
from (select min(timestamp) as t0, max(timestamp) as t1 from trains_raw) t,
     (select min(timestamp) as w0, max(timestamp) as w1 from weather_raw) w""")
def overlap_hours(s):
    """Overlap of the two time ranges and the longest range, whole hours."""
    t = s.trains_raw.agg(F.min("timestamp").alias("t0"), F.max("timestamp").alias("t1"))
    w = s.weather_raw.agg(F.min("timestamp").alias("w0"), F.max("timestamp").alias("w1"))
    h = lambda a, b: F.timestamp_diff("MICROSECOND", a, b) / F.lit(3_600_000_000.0)
    x = one_row(t, w)
    return x.select(h(F.greatest("t0", "w0"), F.least("t1", "w1")).cast("bigint").alias("overlap_hours"),
                    F.greatest(h(F.col("t0"), F.col("t1")), h(F.col("w0"), F.col("w1"))).cast("bigint")
                    .alias("total_hours"))


@register("duplicate_count", """
select 'trains_raw' as table_name, cast(coalesce(sum(n - 1), 0) as bigint) as duplicates from
  (select count(*) as n from trains_raw group by train_id, timestamp, station_code) a
union all
select 'weather_norm', cast(coalesce(sum(n - 1), 0) as bigint) from
  (select count(*) as n from weather_norm group by station_code, timestamp) b""")
def duplicate_count_q(s):
    """Rows beyond the first per key."""
    a = duplicate_count(s.trains_raw, TC.dedup_keys).select(F.lit("trains_raw").alias("table_name"), "duplicates")
    b = duplicate_count(_weather_norm(s), WC.dedup_keys).select(F.lit("weather_norm").alias("table_name"),
                                                                  "duplicates")
    return a.unionByName(b)


_STEPS_SQL = """
steps as (
  select 'train' as processor, 'schema_validation' as step, r.total as total_records,
    r.total - r.bad as valid_records, r.bad as dropped_records, 0 as flagged_records
  from (select count(*) as total, count(*) filter (where station_code is null or timestamp is null
        or train_id is null) as bad from trains_raw) r
  union all select 'train', 'timestamp_normalization', (select count(*) from trains_raw),
    (select count(*) from trains_norm), (select count(*) from trains_raw) - (select count(*) from trains_norm), 0
  union all select 'train', 'deduplication', (select count(*) from trains_norm), (select count(*) from trains_dedup),
    (select count(*) from trains_norm) - (select count(*) from trains_dedup), 0
  union all select 'train', 'business_rules', (select count(*) from trains_dedup), (select count(*) from trains_dedup), 0,
    (select count(*) filter (where delay_minutes < -5 or delay_minutes > 300) from trains_dedup)
  union all
  select 'weather', 'schema_validation', r.total, r.total - r.bad, r.bad, 0
  from (select count(*) as total, count(*) filter (where station_code is null or timestamp is null
        or temperature is null) as bad from weather_raw) r
  union all select 'weather', 'timestamp_normalization', (select count(*) from weather_raw),
    (select count(*) from weather_norm), (select count(*) from weather_raw) - (select count(*) from weather_norm), 0
  union all select 'weather', 'deduplication', (select count(*) from weather_norm), (select count(*) from weather_dedup),
    (select count(*) from weather_norm) - (select count(*) from weather_dedup), 0
  union all select 'weather', 'business_rules', (select count(*) from weather_dedup), (select count(*) from weather_dedup),
    0, (select count(*) filter (where temperature < -20 or temperature > 50) + count(*) filter (where precip_mm < 0)
        from weather_dedup))"""


def _steps(s):
    ts, _ = dq.train_results(s.trains_raw)
    ws, _ = dq.weather_results(s.weather_raw)
    return ts.unionByName(ws)


@register("dq_steps", f",\n{_STEPS_SQL.strip()}\nselect * from steps")
def dq_steps(s):
    """G5/G6 step results: total / valid / dropped / flagged per step."""
    return _steps(s)


@register("run_summary", f""",
{_STEPS_SQL.strip()}
select processor, cast(sum(total_records) as bigint) as total_records, cast(sum(valid_records) as bigint) as total_valid,
  cast(sum(dropped_records) as bigint) as total_dropped, cast(sum(flagged_records) as bigint) as total_flagged,
  round(case when sum(total_records) > 0 then sum(valid_records) * 1e0 / sum(total_records) else 0e0 end, 9)
    as validation_success_rate,
  round(case when sum(total_records) > 0 then sum(dropped_records) * 1e0 / sum(total_records) else 0e0 end, 9)
    as drop_rate,
  round(case when sum(total_records) > 0 then sum(flagged_records) * 1e0 / sum(total_records) else 0e0 end, 9)
    as flag_rate,
  raw as raw_records, clean as clean_records,
  round(case when raw > 0 then clean * 1e0 / raw else 0e0 end, 9) as overall_quality_rate,
  raw > 0 and (clean > 0 or (case when raw > 0 then clean * 1e0 / raw else 0e0 end) > 0.1) as success
from (select *, cast(max(case when step = 'schema_validation' then total_records end) over (partition by processor)
                     as bigint) as raw,
             cast(max(case when step = 'business_rules' then valid_records end) over (partition by processor)
                  as bigint) as clean
      from steps) s
group by processor, raw, clean""")
def run_summary(s):
    """Sums over the step results of each processor and the three rates."""
    r = dq.run_summary(_steps(s))
    return r.select("processor", "total_records", "total_valid", "total_dropped", "total_flagged",
                    *[F.round(c, 9).alias(c) for c in ("validation_success_rate", "drop_rate", "flag_rate")],
                    "raw_records", "clean_records", F.round("overall_quality_rate", 9).alias("overall_quality_rate"),
                    "success")


_RULE_ROWS_SQL = """
select processor, 'schema_validation' as step, rule_name, 'schema' as rule_type, n = 0 as passed,
  n as affected_records, case when n > 0 then 'drop' else 'none' end as action
from (
  select 'train' as processor, 'station_code_not_null' as rule_name, count(*) filter (where station_code is null) as n from trains_raw
  union all select 'train', 'timestamp_not_null', count(*) filter (where timestamp is null) from trains_raw
  union all select 'train', 'train_id_not_null', count(*) filter (where train_id is null) from trains_raw
  union all select 'weather', 'station_code_not_null', count(*) filter (where station_code is null) from weather_raw
  union all select 'weather', 'timestamp_not_null', count(*) filter (where timestamp is null) from weather_raw
  union all select 'weather', 'temperature_not_null', count(*) filter (where temperature is null) from weather_raw) a
union all
select processor, 'timestamp_normalization', 'timestamp_parsing', 'schema', true, cast(0 as bigint), 'none'
from (values ('train'), ('weather')) p(processor)
union all select 'train', 'timestamp_normalization', 'timestamp_normalization', 'schema', true,
  (select count(*) from trains_norm), 'transform'
union all select 'weather', 'timestamp_normalization', 'timestamp_normalization', 'schema', true,
  (select count(*) from weather_norm), 'transform'
union all select 'train', 'deduplication', 'duplicate_removal', 'deduplication', true, n,
  case when n > 0 then 'drop' else 'none' end
from (select (select count(*) from trains_norm) - (select count(*) from trains_dedup) as n) d
union all select 'weather', 'deduplication', 'duplicate_removal', 'deduplication', true, n,
  case when n > 0 then 'drop' else 'none' end
from (select (select count(*) from weather_norm) - (select count(*) from weather_dedup) as n) d
union all
select processor, 'business_rules', rule_name, rule_type, false, n, action from (
  select 'train' as processor, 'extreme_early_delay' as rule_name, 'business' as rule_type, 'transform' as action,
    count(*) filter (where delay_minutes < -5) as n from trains_dedup
  union all select 'train', 'extreme_delay_outlier', 'business', 'flag',
    count(*) filter (where delay_minutes > 300) from trains_dedup
  union all select 'weather', 'temperature_range_validation', 'range', 'transform',
    count(*) filter (where temperature < -20 or temperature > 50) from weather_dedup
  union all select 'weather', 'precip_mm_range_validation', 'range', 'transform',
    count(*) filter (where precip_mm < 0) from weather_dedup) b
where n > 0"""


@register("dq_rule_results", ",\n" + _STEPS_SQL.strip() + "\n" + _RULE_ROWS_SQL)
def dq_rule_results(s):
    """G5/G6 rule rows of every step (schema, timestamp, dedup, business)."""
    _, tr = dq.train_results(s.trains_raw)
    _, wr = dq.weather_results(s.weather_raw)
    return tr.unionByName(wr)


@register("per_date_dq", f"""
select r.date, r.n as raw_records, coalesce(c.n, 0) as clean_records, r.n - coalesce(c.n, 0) as dropped_records,
  round(coalesce(c.n, 0) * 1e0 / r.n, 9) as quality_rate
from (select strftime(timestamp, {DAY}) as date, count(*) as n from trains_raw group by 1) r
left join (select strftime(timestamp, {DAY}) as date, count(*) as n from trains_clean group by 1) c on c.date = r.date""")
def per_date_dq(s):
    """Raw, clean, dropped and quality rate per date."""
    d = lambda df: df.groupBy(F.date_format("timestamp", "yyyy-MM-dd").alias("date")).agg(F.count(F.lit(1)).alias("n"))
    r, c = d(s.trains_raw), d(s.trains_clean).withColumnRenamed("n", "cn")
    j = r.join(c, "date", "left")
    cn = F.coalesce("cn", F.lit(0))
    return j.select("date", F.col("n").alias("raw_records"), cn.alias("clean_records"),
                    (F.col("n") - cn).alias("dropped_records"), F.round(cn / F.col("n"), 9).alias("quality_rate"))


@register("flag_sum", ",\n" + __import__("trackcast.queries.assess", fromlist=["PRE_CTES"]).PRE_CTES.strip()
          + "\nselect t_flagged as train_flagged, w_flagged as weather_flagged, t_flagged + w_flagged as total_flagged "
            "from tp cross join wp")
def flag_sum(s):
    """Sum of every column whose name holds 'flag' or 'outlier', after the fixes."""
    tf, wf = pre.apply_fixes(s.trains_raw, s.weather_raw)
    p = pre.profile(tf, wf)
    return p.select(F.col("t_flagged").alias("train_flagged"), F.col("w_flagged").alias("weather_flagged"),
                    (F.col("t_flagged") + F.col("w_flagged")).alias("total_flagged"))


@register("metric_average", ",\n" + __import__("trackcast.queries.assess", fromlist=["PRE_CTES"]).PRE_CTES.strip()
          + "\nselect round(avg(missing_percentage), 9) as avg_missing_pct, "
            "(select round(avg(violations_percentage), 9) from pre_acc) as avg_violation_pct, "
            "(select round(avg(coverage_percentage), 9) from pre_cov) as avg_coverage_pct from pre_comp")
def metric_average(s):
    """The percentage means behind the completeness, accuracy and coverage scores."""
    p = pre.assess(s.trains_raw, s.weather_raw)
    a = p["completeness"].agg(F.round(F.avg("missing_percentage"), 9).alias("avg_missing_pct"))
    b = p["accuracy"].agg(F.round(F.avg("violations_percentage"), 9).alias("avg_violation_pct"))
    c = p["coverage"].agg(F.round(F.avg("coverage_percentage"), 9).alias("avg_coverage_pct"))
    return one_row(a, b, c)


@register("issues_by_type", ",\n" + __import__("trackcast.queries.assess", fromlist=["POST_CTES"]).POST_CTES.strip()
          + "\nselect date, rule_type, cast(sum(affected_records) as bigint) as affected_records from prules "
            "where emit and not passed group by date, rule_type")
def issues_by_type(s):
    """Affected rows summed by rule type over failed rules, per date."""
    r = post.assess(s.integrated_table)["rules"]
    return r.where(~F.col("passed")).groupBy("date", "rule_type").agg(
        F.sum("affected_records").cast("bigint").alias("affected_records"))


# ---- windows, ordering, top-k (W3, W5, T1, T3) ------------------------------------------------

@register("duplicate_flag", "select ingest_seq, ingest_seq <> min(ingest_seq) over (partition by train_id, timestamp, "
                            "station_code) as is_duplicate from trains_raw")
def duplicate_flag_q(s):
    """Every row after the first (by ingest sequence) of its key."""
    return duplicate_flag(s.trains_raw, keys=TC.dedup_keys, order_by="ingest_seq").select("ingest_seq", "is_duplicate")


@register("gap_hours", """
select station_code, timestamp, prev_timestamp, (epoch_us(timestamp) - epoch_us(prev_timestamp)) / 3600000000e0 as gap_hours,
  coalesce((epoch_us(timestamp) - epoch_us(prev_timestamp)) / 3600000000e0 > 6, false) as gap_exceeded
from (select station_code, timestamp, lag(timestamp) over (partition by station_code order by timestamp) as prev_timestamp
      from weather) x""")
def gap_hours(s):
    """Hours since the station's previous observation, gap > 6 h flagged."""
    g = gap_hours_op(s.weather.select("station_code", "timestamp"))
    return g.select("station_code", "timestamp", "prev_timestamp", "gap_hours", "gap_exceeded")


@register("order_by_time_station", "select * from trains order by timestamp, station_code")
def order_by_time_station(s):
    """ORDER BY timestamp, station_code (range-partitioned sort)."""
    return s.trains.orderBy("timestamp", "station_code")


_VIOL_SQL = " union all ".join(
    f"select '{r}' as rule_name, ingest_seq from {t} where {p}" for t, r, p in _RAW_RULES)


@register("violation_examples", f"select rule_name, ingest_seq, rank from (select rule_name, ingest_seq, "
                                f"cast(row_number() over (partition by rule_name order by ingest_seq) as integer) as rank "
                                f"from ({_VIOL_SQL}) v) x where rank <= 5")
def violation_examples(s):
    """At most 5 example rows per violated rule (two-stage top-k)."""
    parts = []
    for df, rules in ((s.trains_raw, R.train_business_rules()), (s.weather_raw, R.weather_business_rules())):
        for r in R.active(df, rules):
            parts.append(df.where(r.predicate(df)).select(F.lit(r.name).alias("rule_name"), "ingest_seq"))
    u = setops.concat_frames(*parts)
    return top_k_per_group(u, group=["rule_name"], order=["ingest_seq"], k=5).select("rule_name", "ingest_seq", "rank")


# ---- set operations (U1-U4) ---------------------------------------------------------------------

@register("concat_frames", "select train_id, timestamp, station_code, scheduled_time, actual_time, delay_minutes, "
                           "train_category, route, delay_status, destination, is_cancelled, ingest_seq, "
                           "null::double as temperature, null::double as wind_speed, null::double as precip_mm, "
                           "null::integer as weather_code from trains_raw union all select null, timestamp, "
                           "station_code, null, null, null, null, null, null, null, null, ingest_seq, temperature, "
                           "wind_speed, precip_mm, weather_code from weather_raw")
def concat_frames(s):
    """Train and weather rows stacked by name, missing columns null."""
    return setops.concat_frames(s.trains_raw, s.weather_raw)


_SETS = ("(select station_code from trains_raw where station_code is not null)",
         "(select station_code from weather_raw where station_code is not null)")


@register("stations_union", f"select station_code from {_SETS[0]} t union select station_code from {_SETS[1]} w")
def stations_union(s):
    """Codes in either table."""
    return setops.stations_union(s.trains_raw, s.weather_raw)


@register("stations_intersect", f"select station_code from {_SETS[0]} t intersect select station_code from {_SETS[1]} w")
def stations_intersect(s):
    """Codes in both tables."""
    return setops.stations_intersect(s.trains_raw, s.weather_raw)


@register("stations_except", f"(select station_code from {_SETS[0]} t union select station_code from {_SETS[1]} w) "
                             f"except (select station_code from {_SETS[0]} t intersect select station_code from "
                             f"{_SETS[1]} w)")
def stations_except(s):
    """U4: codes missing from one of the tables."""
    return setops.stations_except(s.trains_raw, s.weather_raw)


# ---- configured-only limits (G4, G25, G26) -----------------------------------------------------

@register("weather_limits_ext", """
select 'weather' as processor, 'business_rules' as step, rule_name, 'range' as rule_type, n = 0 as passed,
  n as affected_records, case when n > 0 then 'transform' else 'none' end as action
from (select 'precip_max_validation' as rule_name, count(*) filter (where precip_mm > 500) as n from weather_dedup
      union all select 'wind_speed_range_validation', count(*) filter (where wind_speed < 0 or wind_speed > 200)
      from weather_dedup
      union all select 'weather_code_range_validation', count(*) filter (where weather_code < 0 or weather_code > 99)
      from weather_dedup) x""")
def weather_limits_ext(s):
    """Configured but not default limits, counted on the deduplicated weather."""
    d = dedup_last(_weather_norm(s), keys=WC.dedup_keys, order_by="ingest_seq")
    rules = [dataclasses.replace(r, emit_when_clean=True) for r in R.weather_extended_rules()]
    return R.rule_counts(d, rules, processor="weather", step="business_rules")


@register("coverage_thresholds", f"""
select station_code, count(*) as days,
  count(*) filter (where train_rows > 0) * 1e0 / count(*) as train_coverage,
  count(*) filter (where weather_rows > 0) * 1e0 / count(*) as weather_coverage,
  count(*) filter (where train_rows > 0) * 1e0 / count(*) >= 0.8 as train_ok,
  count(*) filter (where weather_rows > 0) * 1e0 / count(*) >= 0.7 as weather_ok
from ({_GRID_SQL}) g group by station_code""")
def coverage_thresholds(s):
    """Per station, share of days with train / weather rows against the
    configured 80 % / 70 % coverage thresholds."""
    g = _grid(s)
    days = F.count(F.lit(1))
    tc = count_if(F.col("train_rows") > 0) / days
    wc = count_if(F.col("weather_rows") > 0) / days
    return g.groupBy("station_code").agg(days.alias("days"), tc.alias("train_coverage"), wc.alias("weather_coverage"),
                                         (tc >= 0.8).alias("train_ok"), (wc >= 0.7).alias("weather_ok"))


def _null_share(cols):
    return "(" + " + ".join(f"(case when {c} is null then 1 else 0 end)" for c in cols) + f") * 1e0 / {len(cols)}"


@register("missing_critical_drop", f"""
select 'trains_raw' as table_name, count(*) as rows,
  count(*) filter (where {_null_share(TC.critical_fields)} > 0.5) as rows_dropped from trains_raw
union all
select 'weather_raw', count(*), count(*) filter (where {_null_share(WC.critical_fields)} > 0.3) from weather_raw""")
def missing_critical_drop(s):
    """Rows dropped because their share of missing critical fields exceeds 50 % (train) /
    30 % (weather): rows before less rows that stay."""
    out = None
    for name, df, crit, lim in (("trains_raw", s.trains_raw, TC.critical_fields, TC.missing_value_threshold),
                                ("weather_raw", s.weather_raw, WC.critical_fields, WC.missing_value_threshold)):
        stay = dq.drop_missing_critical(df, crit, lim).agg(F.count(F.lit(1)).alias("stay"))
        part = one_row(df.agg(F.count(F.lit(1)).alias("rows")), stay).select(
            F.lit(name).alias("table_name"), "rows", (F.col("rows") - F.col("stay")).alias("rows_dropped"))
        out = part if out is None else out.unionByName(part)
    return out
