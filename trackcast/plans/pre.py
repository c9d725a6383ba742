"""Pre-integration assessment: fixes, five pillars, score, recommendations.

Every pillar is computed from a handful of aggregates over the two fixed
tables (one pass each plus one keyed pass for duplicates and station sets);
results are small frames, never driver-side loops.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trackcast.config import PRE_WEIGHTS
from trackcast.functions.nulls import count_if
from trackcast.functions.timefns import round_hour_half_even
from trackcast.operators.attach import one_row

WEATHER_FIELDS = ("temperature", "precip_mm", "wind_speed", "weather_code")
COORD_FIELDS = ("station_lat", "station_lon", "latitude", "longitude")
PRECIP_FIELDS = ("precipitation", "precip_mm")


def apply_fixes(train: DataFrame, weather: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Small negative delays to 0, delay > 480 flagged, negative
    precipitation to 0, temperature outliers flagged, both timestamps rounded
    half-even to the hour. No row is removed."""
    t = train
    if "delay_minutes" in t.columns:
        d = F.col("delay_minutes")
        fixed = F.when((d >= -2) & (d < 0), F.lit(0)).otherwise(d)
        base = F.col("delay_outlier") if "delay_outlier" in t.columns else F.lit(0)
        t = t.withColumns({"delay_minutes": fixed,
                           "delay_outlier": F.when(fixed > 480, F.lit(1)).otherwise(base).cast("int")})
    if "timestamp" in t.columns:
        t = t.withColumn("timestamp", round_hour_half_even("timestamp"))
    w = weather
    for f in PRECIP_FIELDS:
        if f in w.columns:
            w = w.withColumn(f, F.when(F.col(f) < 0, F.lit(0.0)).otherwise(F.col(f)))
    if "timestamp" in w.columns:
        w = w.withColumn("timestamp", round_hour_half_even("timestamp"))
    if "temperature" in w.columns:
        tt = F.col("temperature")
        base = F.col("temp_outlier") if "temp_outlier" in w.columns else F.lit(0)
        w = w.withColumn("temp_outlier", F.when((tt < -20) | (tt > 50), F.lit(1)).otherwise(base).cast("int"))
    return t, w


def _pct(n, total):
    return F.when(total > 0, n * F.lit(100.0) / total).otherwise(F.lit(0.0))


def _flag_cols(df: DataFrame) -> list[str]:
    return [c for c in df.columns if "flag" in c.lower() or "outlier" in c.lower()]


def _tagged(train: DataFrame, weather: DataFrame) -> DataFrame:
    """Both fixed tables as one stream of tagged rows with a common layout:
    side, station, timestamp, dedup key (k1, k2), the per-side test columns
    and the row's sum of flag / outlier columns."""
    tc, wc = set(train.columns), set(weather.columns)
    null = lambda t: F.lit(None).cast(t)
    col = lambda cols, c, t: F.col(c).cast(t) if c in cols else null(t)
    coords = [c for c in COORD_FIELDS if c in tc]
    allnull = None
    if coords:
        allnull = F.lit(True)
        for c in coords:
            allnull = allnull & F.col(c).isNull()
    pf = next((f for f in PRECIP_FIELDS if f in wc), None)
    flags = lambda df: sum((F.coalesce(F.col(c).cast("bigint"), F.lit(0)) for c in _flag_cols(df)), F.lit(0))

    def shape(df, cols, side, k1):
        return df.select(
            F.lit(side).alias("side"), col(cols, "station_code", "string").alias("st"),
            col(cols, "timestamp", "timestamp_ntz").alias("ts"), col(cols, k1, "string").alias("k1"),
            col(cols, "timestamp", "timestamp_ntz").alias("k2"),
            col(cols, "delay_minutes", "int").alias("delay"),
            col(cols, "scheduled_time", "timestamp_ntz").alias("sched"),
            col(cols, "actual_time", "timestamp_ntz").alias("actual"),
            col(cols, "arrival_time", "timestamp_ntz").alias("arr"),
            col(cols, "departure_time", "timestamp_ntz").alias("dep"),
            (allnull if (side == "t" and allnull is not None) else null("boolean")).alias("coord_null"),
            *[col(cols, f, "double").alias(f"w_{f}") for f in WEATHER_FIELDS],
            (col(cols, pf, "double") if pf else null("double")).alias("precip"),
            flags(df).cast("bigint").alias("flags"))

    return shape(train, tc, "t", "train_id").unionByName(shape(weather, wc, "w", "station_code"))


def profile(train: DataFrame, weather: DataFrame) -> DataFrame:
    """ONE row with every counter of the five pillars, from three aggregates
    over the tagged union: counters (one pass), duplicates (one keyed pass)
    and station presence (one pass keyed by station, map-side reduced)."""
    u = _tagged(train, weather)
    t, w = F.col("side") == "t", F.col("side") == "w"
    a = [count_if(t).alias("t_rows"), count_if(w).alias("w_rows"),
         count_if(t & F.col("delay").isNull()).alias("t_delay_null"), count_if(t & (F.col("delay") < 0)).alias("t_delay_neg"),
         count_if(t & F.col("coord_null")).alias("t_coord_null"),
         count_if(t & (F.col("arr") >= F.col("dep"))).alias("t_order_bad"),
         count_if(t & F.col("ts").isNull()).alias("t_ts_issue"),
         F.min(F.when(t, F.col("ts"))).alias("t_min"), F.max(F.when(t, F.col("ts"))).alias("t_max"),
         count_if(t & (F.col("sched") > F.col("actual"))).alias("t_sched_bad"),
         F.coalesce(F.sum(F.when(t, F.col("flags"))), F.lit(0)).cast("bigint").alias("t_flagged"),
         *[count_if(w & F.col(f"w_{f}").isNull()).alias(f"w_{f}_null") for f in WEATHER_FIELDS],
         count_if(w & (F.col("precip") < 0)).alias("w_precip_neg"),
         count_if(w & ((F.col("w_temperature") < -20.0) | (F.col("w_temperature") > 50.0))).alias("w_temp_bad"),
         count_if(w & F.col("ts").isNull()).alias("w_ts_issue"),
         F.min(F.when(w, F.col("ts"))).alias("w_min"), F.max(F.when(w, F.col("ts"))).alias("w_max"),
         F.coalesce(F.sum(F.when(w, F.col("flags"))), F.lit(0)).cast("bigint").alias("w_flagged")]
    counters = u.agg(*a)
    per_key = u.groupBy("side", "k1", "k2").agg(F.count(F.lit(1)).alias("n"))
    dups = per_key.agg(
        F.coalesce(F.sum(F.when(F.col("side") == "t", F.col("n") - 1)), F.lit(0)).cast("bigint").alias("train_duplicates"),
        F.coalesce(F.sum(F.when(F.col("side") == "w", F.col("n") - 1)), F.lit(0)).cast("bigint").alias("weather_duplicates"))
    per_station = (u.where(F.col("st").isNotNull()).groupBy("st")
                    .agg(F.max(t.cast("int")).alias("in_t"), F.max(w.cast("int")).alias("in_w")))
    stations = per_station.agg(F.count(F.lit(1)).alias("n_all"),
                               count_if((F.col("in_t") == 1) & (F.col("in_w") == 1)).alias("n_both"))
    return one_row(counters, dups, stations)


def _items(train: DataFrame, weather: DataFrame):
    """(completeness items, accuracy items): (name, count col, total col,
    strategy) in reference order, chosen at plan time from the columns."""
    tc, wc = set(train.columns), set(weather.columns)
    comp, acc = [], []
    if "delay_minutes" in tc:
        comp.append(("delay_minutes", "t_delay_null", "t_rows", "flag_as_null"))
    if any(c in tc for c in COORD_FIELDS):
        comp.append(("station_coordinates", "t_coord_null", "t_rows", "lookup_from_registry"))
    for f in WEATHER_FIELDS:
        if f in wc:
            comp.append((f"weather_{f}", f"w_{f}_null", "w_rows", "nearest_hourly_snapshot"))
    if "delay_minutes" in tc:
        acc.append(("delay_non_negative", "t_delay_neg", "t_rows", "convert_to_zero"))
    if "arrival_time" in tc and "departure_time" in tc:
        acc.append(("arrival_before_departure", "t_order_bad", "t_rows", "flag_for_investigation"))
    if any(f in wc for f in PRECIP_FIELDS):
        acc.append(("precipitation_non_negative", "w_precip_neg", "w_rows", "set_to_zero"))
    if "temperature" in wc:
        acc.append(("temperature_plausible_range", "w_temp_bad", "w_rows", "flag_as_outlier"))
    return comp, acc


def _rows(items, names):
    """Array of per-item structs; an item exists when its table has rows."""
    n, c, p, s = names
    arr = F.array(*[F.struct(F.lit(name).alias(n), F.col(cnt).cast("bigint").alias(c),
                             _pct(F.col(cnt), F.col(tot)).alias(p), F.lit(st).alias(s),
                             (F.col(tot) > 0).alias("_avail"))
                    for name, cnt, tot, st in items]) if items else None
    return arr


def _mean_score(items) -> F.Column:
    """max(0, (100 - mean %) / 100) over available items, 1 when none."""
    if not items:
        return F.lit(1.0)
    total = None
    count = None
    for _, cnt, tot, _ in items:
        avail = F.col(tot) > 0
        v = F.when(avail, _pct(F.col(cnt), F.col(tot))).otherwise(F.lit(0.0))
        k = F.when(avail, F.lit(1)).otherwise(F.lit(0))
        total = v if total is None else total + v
        count = k if count is None else count + k
    return F.when(count > 0, F.greatest(F.lit(0.0), (F.lit(100.0) - total / count) / 100.0)).otherwise(F.lit(1.0))


def _hours(a: str, b: str) -> F.Column:
    return F.timestamp_diff("MICROSECOND", F.col(a), F.col(b)) / F.lit(3_600_000_000.0)


def assess(train: DataFrame, weather: DataFrame) -> dict[str, DataFrame]:
    """G13 and its parts: fixes first, then one profile row from which every
    pillar, row list and score is plain column arithmetic."""
    tf, wf = apply_fixes(train, weather)
    comp, acc = _items(tf, wf)
    p = profile(tf, wf)

    o_start, o_end = F.greatest("t_min", "w_min"), F.least("t_max", "w_max")
    overlap_h = F.timestamp_diff("MICROSECOND", o_start, o_end) / F.lit(3_600_000_000.0)
    total_h = F.greatest(_hours("t_min", "t_max"), _hours("w_min", "w_max"))
    temporal_ok = (F.col("t_rows") > 0) & (F.col("w_rows") > 0) & (o_start <= o_end)
    station_ok = F.col("n_all") > 0
    station_pct = F.col("n_both") * 100.0 / F.col("n_all")
    temporal_pct = F.when(total_h > 0, overlap_h / total_h * 100.0).otherwise(F.lit(0.0))
    cov_sum = F.when(station_ok, station_pct).otherwise(0.0) + F.when(temporal_ok, temporal_pct).otherwise(0.0)
    cov_n = F.when(station_ok, 1).otherwise(0) + F.when(temporal_ok, 1).otherwise(0)
    ts_issues = (F.col("t_ts_issue") + F.col("w_ts_issue")).cast("bigint")
    rows_all = (F.col("t_rows") + F.col("w_rows")).cast("bigint")
    dup = (F.col("train_duplicates") + F.col("weather_duplicates")).cast("bigint")
    x = p.select("*",
                 _mean_score(comp).alias("completeness_score"), _mean_score(acc).alias("accuracy_score"),
                 ts_issues.alias("timestamp_issues"), F.col("t_sched_bad").cast("bigint").alias("schema_violations"),
                 rows_all.alias("total_records"), dup.alias("duplicate_count"),
                 F.when(cov_n > 0, cov_sum / cov_n / 100.0).otherwise(F.lit(0.0)).alias("coverage_score"),
                 station_pct.alias("_station_pct"), temporal_pct.alias("_temporal_pct"),
                 station_ok.alias("_station_ok"), temporal_ok.alias("_temporal_ok"),
                 total_h.alias("_total_h"), overlap_h.alias("_overlap_h"))
    x = x.withColumns({
        "consistency_score": F.when(F.col("total_records") > 0, F.greatest(
            F.lit(0.0), 1.0 - (F.col("timestamp_issues") + F.col("schema_violations")) / F.col("total_records")))
        .otherwise(F.lit(1.0)),
        "uniqueness_score": F.when(F.col("total_records") > 0, 1.0 - F.col("duplicate_count") / F.col("total_records"))
        .otherwise(F.lit(1.0))})
    w = PRE_WEIGHTS
    overall = (F.col("completeness_score") * w[0] + F.col("accuracy_score") * w[1] + F.col("consistency_score") * w[2]
               + F.col("uniqueness_score") * w[3] + F.col("coverage_score") * w[4])
    x = x.withColumn("overall_quality_score", overall)

    def explode_rows(items, names):
        arr = _rows(items, names)
        if arr is None:
            schema = ", ".join(f"{n} {t}" for n, t in zip(names, ("string", "bigint", "double", "string")))
            return tf.sparkSession.createDataFrame([], schema)
        return x.select(F.explode(F.filter(arr, lambda e: e["_avail"])).alias("r")).select(
            *[F.col(f"r.{n}").alias(n) for n in names])

    completeness = explode_rows(comp, ("field_name", "missing_count", "missing_percentage", "handling_strategy"))
    accuracy = explode_rows(acc, ("rule_name", "violations_count", "violations_percentage", "action_taken"))
    accuracy = accuracy.withColumn("action_taken", F.when(F.col("violations_count") > 0, F.col("action_taken"))
                                   .otherwise(F.lit("none")))
    consistency = x.select("timestamp_issues", "schema_violations", "total_records", "consistency_score")
    uniqueness = x.select("train_duplicates", "weather_duplicates", F.col("total_records").alias("original_count"),
                          "duplicate_count", (F.col("total_records") - F.col("duplicate_count")).alias("final_count"),
                          "uniqueness_score")
    cov_items = F.array(
        F.struct(F.lit("station").alias("entity_type"), F.col("n_all").cast("bigint").alias("total_expected"),
                 F.col("n_both").cast("bigint").alias("total_actual"), F.col("_station_pct").alias("coverage_percentage"),
                 F.col("_station_ok").alias("_ok")),
        F.struct(F.lit("time_period").alias("entity_type"), F.col("_total_h").cast("bigint").alias("total_expected"),
                 F.col("_overlap_h").cast("bigint").alias("total_actual"),
                 F.col("_temporal_pct").alias("coverage_percentage"), F.col("_temporal_ok").alias("_ok")))
    coverage = x.select(F.explode(F.filter(cov_items, lambda e: e["_ok"])).alias("r")).select(
        "r.entity_type", "r.total_expected", "r.total_actual", "r.coverage_percentage")
    score = x.select("completeness_score", "accuracy_score", "consistency_score", "uniqueness_score",
                     "coverage_score", "overall_quality_score", F.col("total_records").alias("records_processed"),
                     F.col("total_records").alias("records_valid"),
                     (F.col("t_flagged") + F.col("w_flagged")).cast("bigint").alias("records_flagged"),
                     F.lit(0).cast("bigint").alias("records_dropped"), "timestamp_issues", "schema_violations",
                     "duplicate_count")
    hm = sum((F.when((F.col(t) > 0) & (_pct(F.col(c), F.col(t)) > 20), 1).otherwise(0) for _, c, t, _ in comp), F.lit(0))
    hv = sum((F.when((F.col(t) > 0) & (_pct(F.col(c), F.col(t)) > 10), 1).otherwise(0) for _, c, t, _ in acc), F.lit(0))
    rec_input = x.select("completeness_score", "accuracy_score", "consistency_score", "uniqueness_score",
                         "coverage_score", "timestamp_issues", F.col("duplicate_count").alias("dc"),
                         F.col("total_records").alias("original_count"), hm.alias("hm"), hv.alias("hv"))
    return {"train_fixed": tf, "weather_fixed": wf, "profile": x, "completeness": completeness, "accuracy": accuracy,
            "consistency": consistency, "uniqueness": uniqueness, "coverage": coverage, "score": score,
            "rec_input": rec_input}


# FIXED VALUES: recommendation texts.
REC_COMPLETENESS = ("High missing data detected in {n} fields. "
                    "Consider data collection improvements or imputation strategies.")
REC_ACCURACY = ("Significant business rule violations in {n} rules. "
                "Review data collection and validation processes.")
REC_CONSISTENCY = ("Found {n} timestamp consistency issues. "
                   "Ensure all data uses consistent timezone (Europe/Rome).")
REC_UNIQUENESS = "Duplicate rate of {rate}% detected. Review data ingestion processes to prevent duplicates."
REC_COVERAGE = ("Low data coverage detected. Consider expanding data collection "
                "or focusing analysis on well-covered stations and time periods.")


def recommendations(parts: dict[str, DataFrame]) -> DataFrame:
    """One row per triggered recommendation, in fixed order."""
    x = parts["rec_input"]
    fmt = lambda tpl, c: F.replace(F.lit(tpl), F.lit("{n}"), F.col(c).cast("string"))
    rate = F.format_number(F.col("dc") * 100.0 / F.col("original_count"), 1)
    rec = lambda i, text: F.struct(F.lit(i).alias("seq"), text.alias("text"))
    items = F.array(
        F.when((F.col("completeness_score") < 0.8) & (F.col("hm") > 0), rec(1, fmt(REC_COMPLETENESS, "hm"))),
        F.when((F.col("accuracy_score") < 0.9) & (F.col("hv") > 0), rec(2, fmt(REC_ACCURACY, "hv"))),
        F.when((F.col("consistency_score") < 0.95) & (F.col("timestamp_issues") > 0),
               rec(3, fmt(REC_CONSISTENCY, "timestamp_issues"))),
        F.when(F.col("uniqueness_score") < 0.98,
               rec(4, F.replace(F.lit(REC_UNIQUENESS), F.lit("{rate}"), F.regexp_replace(rate, ",", "")))),
        F.when(F.col("coverage_score") < 0.7, rec(5, F.lit(REC_COVERAGE))),
    )
    return x.select(F.explode(F.filter(items, lambda e: e.isNotNull())).alias("r")).select(
        F.col("r.seq").alias("seq"), F.col("r.text").alias("recommendation"))
