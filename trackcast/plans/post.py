"""Post-integration assessment per date.

The reference assesses one date at a time; here all dates are assessed in one
grouped pass (``groupBy(date)`` with partial aggregation) plus one keyed pass
for duplicates. Output frames are long: one row per (date, rule) and one per
(date, assessment), then the per-date score, level and recommendations.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trackcast.config import PostThresholds
from trackcast.functions.nulls import count_if, not_marked

ASSESSMENTS = ("completeness", "weather_matching", "feature_engineering", "consistency", "anomaly_detection")
WEATHER4 = ("temperature", "wind_speed", "precip_mm", "weather_code")


def scan_day(df: DataFrame, day: str) -> DataFrame:
    """A3: rows of one date ordered by (timestamp, station), the date test
    written as a sargable range on the raw timestamp so it reaches the reader."""
    start = F.lit(day).cast("timestamp_ntz")
    return (df.where((F.col("timestamp") >= start) & (F.col("timestamp") < F.timestamp_add("DAY", F.lit(1), start)))
              .orderBy("timestamp", "station_code"))


def _counters(df: DataFrame, th: PostThresholds) -> DataFrame:
    cols = set(df.columns)
    aggs = [F.count(F.lit(1)).alias("total")]
    for f in ("train_id", "timestamp", "station_code"):
        if f in cols:
            aggs.append(count_if(F.col(f).isNull()).alias(f"null_{f}"))
    w4 = [c for c in WEATHER4 if c in cols]
    if w4:
        anyw = F.lit(False)
        for c in w4:
            anyw = anyw | F.col(c).isNotNull()
        aggs.append(count_if(anyw).alias("weather_matched"))
    if "temperature" in cols:
        aggs.append(count_if((F.col("temperature") < -50) | (F.col("temperature") > 60)).alias("temp_out"))
    if "precip_mm" in cols:
        aggs.append(count_if(F.col("precip_mm") < 0).alias("precip_neg"))
    feats = [c for c in th.feature_columns if c in cols]
    if feats:
        allnn = F.lit(True)
        for c in feats:
            allnn = allnn & F.col(c).isNotNull()
        aggs.append(count_if(allnn).alias("feat_complete"))
    if "hour_of_day" in cols:
        aggs.append(count_if((F.col("hour_of_day") < 0) | (F.col("hour_of_day") > 23)).alias("bad_hour"))
    if "day_of_week" in cols:
        aggs.append(count_if((F.col("day_of_week") < 0) | (F.col("day_of_week") > 6)).alias("bad_dow"))
    if "delay_minutes" in cols and "is_delayed" in cols:
        aggs.append(count_if((F.col("delay_minutes") > 5) & not_marked(F.col("is_delayed"))).alias("incons_delay"))
    if "precip_mm" in cols and "is_raining" in cols:
        aggs.append(count_if((F.col("precip_mm") > 0) & not_marked(F.col("is_raining"))).alias("incons_rain"))
    if "day_of_week" in cols and "is_weekend" in cols:
        aggs.append(count_if(F.col("day_of_week").isin(5, 6) & not_marked(F.col("is_weekend"))).alias("incons_weekend"))
    if "delay_minutes" in cols:
        aggs.append(count_if(F.col("delay_minutes") > 300).alias("extreme_delays"))
    return aggs


def assess(df: DataFrame, th: PostThresholds = PostThresholds()) -> dict[str, DataFrame]:
    """Rules, per-assessment results, score and summary for every date."""
    cols = set(df.columns)
    # the date key is ISO text so every consumer compares it the same way
    dated = df.withColumn("date", F.date_format("timestamp", "yyyy-MM-dd"))
    keys = ["train_id", "timestamp", "station_code"]
    has_keys = all(k in cols for k in keys)
    counters = _counters(dated, th)
    if has_keys:
        # ONE pass: counters per (date, key) combined map-side, then summed per
        # date; the same keyed rows give the duplicate count (n - 1 per key)
        per_key = dated.groupBy("date", *keys).agg(*counters)
        names = [c for c in per_key.columns if c not in ("date", *keys)]
        # the station list of a date is bounded by the station dimension
        c = per_key.groupBy("date").agg(*[F.sum(n).cast("bigint").alias(n) for n in names],
                                        F.sum(F.col("total") - 1).cast("bigint").alias("dups"),
                                        F.array_sort(F.collect_set("station_code")).alias("station_codes"))
    else:
        c = dated.groupBy("date").agg(*counters).withColumn("station_codes", F.array().cast("array<string>"))
    t = F.col("total")
    rate = lambda x: F.when(t > 0, x / t).otherwise(F.lit(0.0))
    missing_req = [x for x in th.required_columns if x not in cols]
    missing_feat = [x for x in th.feature_columns if x not in cols]

    def rule(idx: int, name: str, rtype: str, passed: Column, affected: Column, action: Column,
             emit: Column = F.lit(True), flagged: Column = F.lit(0)) -> Column:
        return F.struct(F.lit(idx).alias("idx"), F.lit(ASSESSMENTS[idx]).alias("assessment"),
                        F.lit(name).alias("rule_name"), F.lit(rtype).alias("rule_type"), passed.alias("passed"),
                        affected.cast("bigint").alias("affected_records"), action.alias("action"),
                        emit.alias("emit"), flagged.cast("bigint").alias("flagged"))

    fl = lambda cond: F.when(cond, F.lit("flag")).otherwise(F.lit("none"))
    R = []
    # G15 completeness
    if missing_req:
        R.append(rule(0, "required_columns_present", "schema", F.lit(False), t, F.lit("none")))
    for f in ("train_id", "timestamp", "station_code"):
        if f in cols:
            nr = rate(F.col(f"null_{f}"))
            R.append(rule(0, f"{f}_completeness", "completeness", nr <= th.max_null_rate, F.col(f"null_{f}"),
                          fl(nr > th.max_null_rate), flagged=F.when(nr > th.max_null_rate, F.col(f"null_{f}")).otherwise(0)))
    # G16 weather matching
    if all(x in cols for x in WEATHER4):
        mr = rate(F.col("weather_matched"))
        R.append(rule(1, "weather_data_matching", "consistency", mr >= th.min_weather_match_rate,
                      t - F.col("weather_matched"), fl(mr < th.min_weather_match_rate)))
    if "temperature" in cols:
        R.append(rule(1, "temperature_plausibility", "range", F.col("temp_out") == 0, F.col("temp_out"), F.lit("flag"),
                      F.col("temp_out") > 0, F.col("temp_out")))
    if "precip_mm" in cols:
        R.append(rule(1, "precipitation_validity", "range", F.col("precip_neg") == 0, F.col("precip_neg"),
                      F.lit("flag"), F.col("precip_neg") > 0, F.col("precip_neg")))
    # G17 features
    if missing_feat:
        R.append(rule(2, "feature_columns_present", "schema", F.lit(False), t, F.lit("flag"), flagged=t))
    if len(missing_feat) < len(th.feature_columns):
        fc = F.col("feat_complete") / t
        R.append(rule(2, "feature_completeness", "completeness", fc >= th.min_feature_completeness,
                      ((1.0 - fc) * t).cast("bigint"), fl(fc < th.min_feature_completeness)))
    if "hour_of_day" in cols:
        R.append(rule(2, "hour_of_day_validity", "range", F.col("bad_hour") == 0, F.col("bad_hour"), F.lit("flag"),
                      F.col("bad_hour") > 0, F.col("bad_hour")))
    if "day_of_week" in cols:
        R.append(rule(2, "day_of_week_validity", "range", F.col("bad_dow") == 0, F.col("bad_dow"), F.lit("flag"),
                      F.col("bad_dow") > 0, F.col("bad_dow")))
    # G18 business consistency
    for name, col_, need in (("delay_flag_consistency", "incons_delay", ("delay_minutes", "is_delayed")),
                             ("rain_flag_consistency", "incons_rain", ("precip_mm", "is_raining")),
                             ("weekend_flag_consistency", "incons_weekend", ("day_of_week", "is_weekend"))):
        if all(x in cols for x in need):
            R.append(rule(3, name, "business", F.col(col_) == 0, F.col(col_), F.lit("flag"), F.col(col_) > 0,
                          F.col(col_)))
    # G19 anomalies
    if "delay_minutes" in cols:
        er = rate(F.col("extreme_delays"))
        R.append(rule(4, "extreme_delay_detection", "business", er <= th.max_anomaly_rate, F.col("extreme_delays"),
                      fl(er > th.max_anomaly_rate),
                      flagged=F.when(er > th.max_anomaly_rate, F.col("extreme_delays")).otherwise(0)))
    if has_keys:
        d = F.coalesce(F.col("dups"), F.lit(0))
        R.append(rule(4, "duplicate_detection", "deduplication", d == 0, d, fl(d > 0), flagged=d))

    # one row per date carries its rules; rule rows, results, score, summary and
    # recommendations are all expressions over that row (no branch re-reads the data)
    per_date = c.select("date", "total", "station_codes", F.array(*R).alias("rule_list"))
    flagged = [_total("rule_list", _of_assessment(i), "flagged") for i in range(len(ASSESSMENTS))]
    weighted = sum(((t - f) / t * F.lit(w) for f, w in zip(flagged, th.weights)), F.lit(0.0))
    report = per_date.select("*", sum(flagged, F.lit(0)).cast("bigint").alias("total_flagged_records"),
                             F.when(t > 0, F.least(weighted, F.lit(1.0))).otherwise(F.lit(0.0)).alias("overall_quality_score"))
    long = per_date.select("date", "total", F.explode("rule_list").alias("r")).select("date", "total", "r.*")
    rules = long.where("emit").select("date", "assessment", "rule_name", "rule_type", "passed",
                                      "affected_records", "action")
    results = report.select("date", "total", F.explode(F.array(*[
        F.struct(F.lit(i).alias("idx"), F.lit(ASSESSMENTS[i]).alias("assessment"), f.cast("bigint").alias("flagged_records"))
        for i, f in enumerate(flagged)])).alias("a")).select(
        "date", "a.idx", "a.assessment", F.col("total").alias("total_records"), "a.flagged_records",
        (F.col("total") - F.col("a.flagged_records")).alias("valid_records"))
    score = report.select("date", F.col("total").alias("total_records"), "overall_quality_score", "total_flagged_records")
    return {"counters": c, "rules": rules, "results": results, "score": score, "report": report}


def _total(rules: str, keep, field: str) -> Column:
    """Sum of ``field`` over the rules of a date that ``keep`` selects."""
    return F.aggregate(F.filter(F.col(rules), keep), F.lit(0).cast("bigint"), lambda acc, r: acc + r[field])


def _of_assessment(i: int):
    return lambda r: r["idx"] == i


def _failed(r: Column) -> Column:
    return r["emit"] & ~r["passed"]


def _failed_of_type(kind: str):
    return lambda r: _failed(r) & (r["rule_type"] == kind)


# FIXED VALUES: quality levels and rule types.
LEVELS = ((0.95, "EXCELLENT"), (0.85, "GOOD"), (0.70, "ACCEPTABLE"))
RULE_TYPES = ("schema", "completeness", "consistency", "range", "business", "deduplication")


def with_summary(report: DataFrame) -> DataFrame:
    """G21 on the row of each date: quality level, flagged rate, issues by rule type (failed rules)."""
    sc, t = F.col("overall_quality_score"), F.col("total")
    level = F.lit("POOR")
    for least, name in reversed(LEVELS):
        level = F.when(sc >= least, name).otherwise(level)
    of_type = [(k, _failed_of_type(k)) for k in RULE_TYPES]
    issues = F.filter(F.array(*[F.when(F.exists("rule_list", keep), F.struct(
        F.lit(k).alias("rule_type"), _total("rule_list", keep, "affected_records").alias("n"))) for k, keep in of_type]),
        lambda x: x.isNotNull())
    return report.select("*", level.alias("quality_level"), t.alias("total_records"),
                         F.when(t > 0, F.col("total_flagged_records") / t).otherwise(F.lit(0.0)).alias("flagged_rate"),
                         F.when(F.size(issues) > 0, F.map_from_entries(issues)).alias("issues_by_type"))


def summary(parts: dict[str, DataFrame]) -> DataFrame:
    """One row per date."""
    return with_summary(parts["report"]).select("date", "quality_level", "overall_quality_score", "total_records",
                                                "total_flagged_records", "flagged_rate", "issues_by_type")


# FIXED VALUES: recommendation texts.
REC_CRITICAL = "CRITICAL: Overall data quality is poor. Review integration process."
REC_MATCHING = "Improve weather data matching - check time synchronization and station coverage"
REC_CONSISTENCY = "Review business logic implementation in feature engineering"
REC_COMPLETENESS = "Address data completeness issues in source systems"
REC_ANOMALY = "Investigate and handle data anomalies and outliers"
REC_GOOD = "Data quality is good. Continue monitoring."


def with_recommendations(report: DataFrame) -> DataFrame:
    """G22 on the row of each date: the critical line, one line per failed
    rule with affected rows (first matching pattern), else the 'good' line."""
    def text(r):
        n = r["rule_name"]
        return (F.when(n == "weather_data_matching", REC_MATCHING).when(n.contains("consistency"), REC_CONSISTENCY)
                .when(n.contains("completeness"), REC_COMPLETENESS)
                .when(n.contains("anomaly") | n.contains("extreme"), REC_ANOMALY))

    def line(kind, name, words):
        return F.struct(F.lit(kind).alias("kind"), name.cast("string").alias("rule_name"), words.alias("recommendation"))

    none = F.lit(None)
    failed = F.filter("rule_list", lambda r: _failed(r) & (r["affected_records"] > 0))
    lines = F.filter(F.transform(failed, lambda r: line(1, r["rule_name"], text(r))), lambda x: x["recommendation"].isNotNull())
    critical = F.when(F.col("overall_quality_score") < 0.70, F.array(line(0, none, F.lit(REC_CRITICAL))))
    every = F.concat(F.coalesce(critical, F.filter(F.array(line(0, none, F.lit(""))), lambda x: F.lit(False))), lines)
    good = F.array(line(2, none, F.lit(REC_GOOD)))
    return report.withColumn("recommendation_list", F.when(F.size(every) > 0, every).otherwise(good))


def recommendations(parts: dict[str, DataFrame]) -> DataFrame:
    """One row per date and line."""
    return with_recommendations(parts["report"]).select("date", F.explode("recommendation_list").alias("r")).select("date", "r.*")
