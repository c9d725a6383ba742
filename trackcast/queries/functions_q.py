"""Function-level queries: time parsing/rounding, features, binning."""

from __future__ import annotations

from pyspark.sql import functions as F

from trackcast.catalog import register
from trackcast.functions import text as T
from trackcast.functions import timefns as TF
from trackcast.functions.binning import bin_column
from trackcast.operators.attach import one_row
from trackcast.operators.features import batch_stats, feature_families

KEY = ("train_id", "timestamp", "station_code")

# (key, feature columns) -- each selects the named outputs of the feature operator
FEATURE_KEYS = {
    "temporal_parts": ("hour_of_day", "day_of_week", "day_of_month", "month", "quarter", "year"),
    "is_weekend": ("is_weekend",),
    "is_rush_hour": ("is_rush_hour",),
    "time_period": ("time_period",),
    "season": ("season",),
    "route_complexity": ("route_complexity",),
    "is_complex_route": ("route_complexity", "is_complex_route"),
    "is_major_destination": ("is_major_destination",),
    "is_high_speed": ("is_high_speed", "is_regional"),
    "temp_category": ("temp_category",),
    "temp_flags": ("is_extreme_cold", "is_extreme_hot", "is_freezing"),
    "rain_features": ("is_raining", "rain_intensity", "is_heavy_rain"),
    "wind_features": ("wind_category", "is_high_wind"),
    "weather_severity": ("weather_severity_score",),
    "adverse_weather": ("adverse_weather",),
    "delay_category": ("delay_category",),
    "delay_flags": ("is_delayed", "is_significantly_delayed", "is_severely_delayed", "is_early"),
    "delay_severity": ("delay_severity_score",),
    "service_disruption": ("service_disruption",),
    "delay_status_encoded": ("delay_status_encoded",),
    "station_importance": ("station_traffic_rank", "station_importance"),
    "map_lookup": ("season", "delay_status_encoded", "station_traffic_rank"),
}


def _feature_query(cols):
    def q(s):
        return s.some_features(*cols).select(*KEY, *cols)
    return q


for _k, _cols in FEATURE_KEYS.items():
    _fn = _feature_query(_cols)
    _fn.__name__ = _fn.__qualname__ = _k
    _fn.__doc__ = (f"Feature columns {', '.join(_cols)} of every integrated row "
                   "(built by operators.features.engineer_features).")
    register(_k, f"select {', '.join(KEY + _cols)} from features")(_fn)


# ---- time functions on the landed rows ---------------------------------------

@register("round_hour_half_up", "select ingest_seq, timestamp, date_trunc('hour', timestamp + interval 30 minute) "
                                "as rounded from weather_raw")
def round_hour_half_up(s):
    """F2 on every raw weather timestamp: minute >= 30 rounds up."""
    w = s.weather_raw
    return w.select("ingest_seq", "timestamp", TF.round_hour_half_up("timestamp").alias("rounded"))


_HE = ("case when epoch_us(timestamp) % 3600000000 > 1800000000 then date_trunc('hour', timestamp) + interval 1 hour "
       "when epoch_us(timestamp) % 3600000000 = 1800000000 and hour(timestamp) % 2 = 1 "
       "then date_trunc('hour', timestamp) + interval 1 hour else date_trunc('hour', timestamp) end")


@register("round_hour_half_even", f"select ingest_seq, timestamp, {_HE} as rounded from trains_raw")
def round_hour_half_even(s):
    """F12 on every raw train timestamp: nearest hour, ties to the even hour."""
    return s.trains_raw.select("ingest_seq", "timestamp", TF.round_hour_half_even("timestamp").alias("rounded"))


@register("time_diff", "select ingest_seq, abs(epoch_us(actual_time) - epoch_us(scheduled_time)) as diff_us "
                       "from trains_raw")
def time_diff(s):
    """absolute scheduled-to-actual difference in microseconds."""
    t = s.trains_raw
    return t.select("ingest_seq", TF.abs_diff_us("actual_time", "scheduled_time").alias("diff_us"))


@register("time_order_check", "select ingest_seq, coalesce(scheduled_time > actual_time, false) as schedule_invalid "
                              "from trains_raw")
def time_order_check(s):
    """scheduled later than actual is invalid (null reads as valid)."""
    t = s.trains_raw
    return t.select("ingest_seq", F.coalesce(F.col("scheduled_time") > F.col("actual_time"), F.lit(False))
                    .alias("schedule_invalid"))


# Text stand-ins: every raw weather row rendered in each accepted text form
# plus one unparseable form; the job itself only sees strings.
_TEXT_FORMS_SPARK = (("iso_minute", "yyyy-MM-dd'T'HH:mm"), ("iso_second", "yyyy-MM-dd'T'HH:mm:ss"),
                     ("space_micros", "yyyy-MM-dd HH:mm:ss.SSSSSS"), ("day_first", "dd/MM/yyyy HH:mm"),
                     ("basic", "yyyyMMdd'T'HHmmss"), ("month_name", "MMM d yyyy HH:mm"),
                     ("zulu", "yyyy-MM-dd'T'HH:mm:ss'Z'"), ("east", "yyyy-MM-dd'T'HH:mm:ss'+02:00'"),
                     ("west", "yyyy-MM-dd HH:mm'-0530'"))
_TEXT_FORMS_DUCK = (("iso_minute", "%Y-%m-%dT%H:%M"), ("iso_second", "%Y-%m-%dT%H:%M:%S"),
                    ("space_micros", "%Y-%m-%d %H:%M:%S.%f"), ("day_first", "%d/%m/%Y %H:%M"),
                    ("basic", "%Y%m%dT%H%M%S"), ("month_name", "%b %-d %Y %H:%M"), ("zulu", "%Y-%m-%dT%H:%M:%SZ"),
                    ("east", "%Y-%m-%dT%H:%M:%S+02:00"), ("west", "%Y-%m-%d %H:%M-0530"))


def _texts(s):
    w = s.weather_raw.select("ingest_seq", "timestamp")
    parts = [w.select("ingest_seq", F.lit(name).alias("form"), F.date_format("timestamp", fmt).alias("text"))
             for name, fmt in _TEXT_FORMS_SPARK]
    parts.append(w.select("ingest_seq", F.lit("junk").alias("form"),
                          F.concat(F.lit("at "), F.date_format("timestamp", "HH:mm")).alias("text")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


_TEXTS_SQL = " union all ".join(
    [f"select ingest_seq, '{n}' as form, strftime(timestamp, '{f}') as text from weather_raw"
     for n, f in _TEXT_FORMS_DUCK]
    + ["select ingest_seq, 'junk', 'at ' || strftime(timestamp, '%H:%M') from weather_raw"])

_DUCK_PARSE = ("coalesce(" + ", ".join(f"try_strptime(text, '{f}')" for f in (
    "%Y-%m-%dT%H:%M:%S.%f", "%Y-%m-%dT%H:%M:%S", "%Y-%m-%dT%H:%M", "%Y-%m-%d %H:%M:%S.%f", "%Y-%m-%d %H:%M:%S",
    "%Y-%m-%d %H:%M", "%Y-%m-%d", "%d/%m/%Y %H:%M:%S", "%d/%m/%Y %H:%M", "%d/%m/%Y", "%Y%m%dT%H%M%S", "%b %d %Y %H:%M",
    "%Y-%m-%dT%H:%M:%SZ")) + ", try_strptime(text, '%Y-%m-%dT%H:%M:%S+02:00') - interval 2 hour, "
    "try_strptime(text, '%Y-%m-%d %H:%M-0530') + interval 330 minute)")


@register("normalize_timestamp", f"select ingest_seq, form, text, {_DUCK_PARSE} as parsed, "
                                 f"text is not null and {_DUCK_PARSE} is null as parse_error "
                                 f"from ({_TEXTS_SQL}) t")
def normalize_timestamp(s):
    """text to timestamp over a fixed format list; failures are counted
    as parse errors (null text is not an error)."""
    t = _texts(s)
    p = TF.parse_timestamp(F.col("text"))
    return t.select("ingest_seq", "form", "text", p.alias("parsed"),
                    (F.col("text").isNotNull() & p.isNull()).alias("parse_error"))


@register("strict_weather_time", f"select ingest_seq, form, text, try_strptime(text, '%Y-%m-%dT%H:%M') as parsed "
                                 f"from ({_TEXTS_SQL}) t")
def strict_weather_time(s):
    """only the minute-precision ISO form parses."""
    t = _texts(s)
    return t.select("ingest_seq", "form", "text", TF.strict_weather_time("text").alias("parsed"))


# ---- string functions ------------------------------------------------------------

@register("extract_destination", "select ingest_seq, route, case when route is null or route = '' then '' "
                                 "when route like '%<br>%' then trim(split_part(split_part(route, '<br>', 2), '(', 1)) "
                                 "else trim(route) end as destination from trains_raw")
def extract_destination(s):
    """F20 on every raw route text."""
    return s.trains_raw.select("ingest_seq", "route", T.extract_destination(F.col("route")).alias("destination"))


# ---- generic binning ----------------------------------------------------------------

# FIXED VALUES: an example edge list for the generic operator (quantity bands).
QTY_EDGES = (0, 10, 25, 40, 50)
QTY_LABELS = ("small", "medium", "large", "bulk")


@register("bin_column", "select l_orderkey, l_linenumber, l_quantity, case when l_quantity >= 0 and l_quantity <= 10 "
                        "then 'small' when l_quantity > 10 and l_quantity <= 25 then 'medium' when l_quantity > 25 "
                        "and l_quantity <= 40 then 'large' when l_quantity > 40 and l_quantity <= 50 then 'bulk' end "
                        "as band from lineitem")
def bin_column_q(s):
    """right-closed bins with include-lowest over every lineitem quantity."""
    li = s.table("lineitem")
    return li.select("l_orderkey", "l_linenumber", "l_quantity",
                     bin_column(F.col("l_quantity"), QTY_EDGES, QTY_LABELS, include_lowest=True).alias("band"))


# ---- batch statistics (D7, E14-E17) ---------------------------------------------------

@register("broadcast_scalar", "select hour_varies, precip_varies, wind_varies, delay_varies, route_median, "
                              "traffic_varies, round(q33, 9) as traffic_q33, round(q67, 9) as traffic_q67 from fscalars")
def broadcast_scalar(s):
    """The one-row batch statistics every row is compared with."""
    _, sc = batch_stats(s.integrated.drop("matched"))
    return sc.select("hour_varies", "precip_varies", "wind_varies", "delay_varies", "route_median",
                     "traffic_varies", F.round("traffic_q33", 9).alias("traffic_q33"),
                     F.round("traffic_q67", 9).alias("traffic_q67"))


@register("station_traffic", "select station_code, station_traffic_rank from station_counts")
def station_traffic(s):
    """Rows per station of the integrated batch."""
    counts, _ = batch_stats(s.trains_clean, ["stations"])
    return counts.where(F.col("_sc").isNotNull()).select(F.col("_sc").alias("station_code"), "station_traffic_rank")


@register("global_median", "select median(coalesce(length(route), 0)) as route_median from integrated")
def global_median(s):
    """Exact median of the route length over all rows (weighted percentile
    over the per-(station, length) counts)."""
    _, sc = batch_stats(s.trains_clean, ["route"])
    return sc.select("route_median")


@register("station_quantiles", "select round(quantile_cont(station_traffic_rank, 0.33), 9) as traffic_q33, "
                               "round(quantile_cont(station_traffic_rank, 0.67), 9) as traffic_q67 from station_counts")
def station_quantiles(s):
    """33 % / 67 % of the per-station counts, linear interpolation."""
    _, sc = batch_stats(s.trains_clean, ["stations"])
    return sc.select(F.round("traffic_q33", 9).alias("traffic_q33"), F.round("traffic_q67", 9).alias("traffic_q67"))


@register("distinct_guard", "select count(distinct hour(timestamp)) as hours, "
                            "count(distinct coalesce(precip_mm, 0)) as precip_values, "
                            "count(distinct coalesce(wind_speed, 0)) as wind_values, "
                            "count(distinct coalesce(delay_minutes, 0)) as delay_values from integrated")
def distinct_guard(s):
    """Distinct values of the guarded columns (nulls read as 0).

    The hours are a bitmap (one long per task). Each other column is made distinct on its own, combined before its shuffle, over
    the matched rows, which are matched and written once; no row is expanded."""
    i = s.matched_rows
    hours = i.agg(F.bit_count(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.hour("timestamp"))))
                  .cast("bigint").alias("hours")).select(F.coalesce("hours", F.lit(0)).cast("bigint").alias("hours"))

    def values(column, name):
        return i.select(F.coalesce(column, F.lit(0)).alias("v")).distinct().agg(F.count("v").alias(name))

    return one_row(hours, values("precip_mm", "precip_values"), values("wind_speed", "wind_values"),
                   values("delay_minutes", "delay_values"))


# ---- feature profile (P1) -------------------------------------------------------------

_FEATURE_OUTPUT = ("train_id", "timestamp", "station_code", "delay_minutes", "train_category", "route", "delay_status",
                   "destination", "is_cancelled", "temperature", "wind_speed", "precip_mm", "weather_code",
                   "hour_of_day", "day_of_week", "day_of_month", "month", "quarter", "year", "is_weekend",
                   "is_rush_hour", "time_period", "season", "temp_category", "is_extreme_cold", "is_extreme_hot",
                   "is_freezing", "is_raining", "rain_intensity", "is_heavy_rain", "wind_category", "is_high_wind",
                   "weather_severity_score", "adverse_weather", "delay_category", "is_delayed",
                   "is_significantly_delayed", "is_severely_delayed", "is_early", "delay_severity_score",
                   "service_disruption", "delay_status_encoded", "is_high_speed", "is_regional",
                   "station_traffic_rank", "station_importance", "route_complexity", "is_complex_route",
                   "is_major_destination")


def _profile_sql() -> str:
    fam = feature_families(_FEATURE_OUTPUT)
    rows = []
    for c in _FEATURE_OUTPUT:
        flags = ", ".join(f"{'true' if c in fam[f] else 'false'} as in_{f}" for f in fam)
        rows.append(f"select '{c}' as column_name, count(*) filter (where \"{c}\" is null) as null_count, "
                    f"count(\"{c}\") as non_null_count, {flags} from features")
    return " union all ".join(rows)


@register("feature_profile", _profile_sql())
def feature_profile(s):
    """Per column of the feature table, its families (by name pattern)
    and null / non-null counts from one aggregate, unpivoted."""
    from trackcast.operators.features import feature_profile as profile
    return profile(s.features)
