"""Metrics store: long metric rows, JSON details, retrieval.

A metric row is ``(table_name, metric_name, metric_value, timestamp, details)``.
Runs are per date (as the reference runs one date at a time), so the rows of
every date come out of one grouped pass; ``details`` is JSON text built with
``to_json`` and read back with ``from_json`` / ``get_json_object``.
"""

from __future__ import annotations

import time
from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trackcast.config import TrainConfig
from trackcast.functions.nulls import as_flag, count_if
from trackcast.operators import rules as R
from trackcast.operators.dedup import dedup_best, dedup_last
from trackcast.plans import dq
from trackcast.operators.attach import one_row
from trackcast.session import drop_path, work_table

STEP_METRICS = ("total_records", "valid_records", "dropped_records", "flagged_records", "validation_success_rate")
PRE_SUMMARY = ("overall_quality_score", "completeness_score", "accuracy_score", "consistency_score",
               "uniqueness_score", "coverage_score", "records_processed", "records_valid", "records_flagged",
               "records_dropped", "processing_duration")
EXPORT_FORMATS = ("json", "csv")
POST_SUMMARY = ("overall_quality_score", "total_records", "total_flagged_records", "flagged_rate")


def _day(c: str = "timestamp") -> Column:
    return F.date_format(c, "yyyy-MM-dd")


def run_time(day: Column) -> Column:
    """A date's run happens when the date closes: midnight of the next day."""
    return F.timestamp_add("DAY", F.lit(1), F.to_timestamp_ntz(day))


#: What a step's result carries beside its counts; a step fills its own fields, JSON leaves the others out.
CUSTOM = {"required_fields_count": "int", "schema_compliance_rate": "double", "parsing_errors": "bigint", "normalized_count": "bigint",
          "target_timezone": "string", "hourly_rounding": "boolean", "duplicate_count": "bigint", "deduplication_rate": "double",
          "key_fields": "array<string>", "selection_strategy": "string", "data_type": "string"}


def _custom(**fields: Column) -> Column:
    return F.struct(*[fields.get(k, F.lit(None)).cast(kind).alias(k) for k, kind in CUSTOM.items()])


def _rule(name: str, kind: str, passed, affected, action) -> Column:
    return F.struct(F.lit(name).alias("rule_name"), F.lit(kind).alias("rule_type"), passed.alias("passed"),
                    affected.cast("bigint").alias("affected_records"), action.alias("action_taken"))


def _if_any(n, action: str) -> Column:
    return F.when(n > 0, F.lit(action)).otherwise(F.lit("none"))


def steps_by_date(raw: DataFrame, *, processor: str, required: Sequence[str], rules: Sequence[R.Rule],
                  round_to_hour: bool, dedup_keys: Sequence[str], order_by: str,
                  target_timezone: str = TrainConfig.target_timezone) -> DataFrame:
    """G5/G6 step results of one run per date (dedup keys hold the timestamp,
    so no duplicate crosses a date): counts, rule results, custom metrics and anomalies.

    Counts and rule counts of a date are one grouped aggregate each over the raw, normalised and deduplicated rows; a step's rules
    are an array of at most as many entries as there are rules."""
    normed = dq.normalize_timestamps(raw, round_to_hour=round_to_hour)
    if processor == "train":
        deduped = dedup_best(normed, keys=dedup_keys, tie_break=order_by)
    else:
        deduped = dedup_last(normed, keys=dedup_keys, order_by=order_by)
    act = R.active(deduped, rules)
    present = [f for f in required if f in raw.columns]
    a = raw.groupBy(_day().alias("date")).agg(
        F.count(F.lit(1)).alias("total"), count_if(dq.any_required_null(raw, required)).alias("bad"),
        count_if(dq.timestamp_parse_errors(raw)).alias("unparsed"), *[count_if(F.col(f).isNull()).alias(f"null_{f}") for f in present])
    b = normed.groupBy(_day().alias("date")).agg(F.count(F.lit(1)).alias("normalized"))
    c = deduped.groupBy(_day().alias("date")).agg(
        F.count(F.lit(1)).alias("deduped"), *[F.sum(as_flag(r.predicate(deduped))).cast("bigint").alias(f"hit_{i}") for i, r in enumerate(act)])
    hits = [f"hit_{i}" for i in range(len(act))]
    x = a.join(b, "date", "left").join(c, "date", "left").na.fill(0, ["normalized", "deduped", *hits])
    col, z = F.col, F.lit(0)
    flagged = sum((col(h) for h in hits), z)
    duplicates = col("normalized") - col("deduped")
    rate = lambda n, of: F.when(of > 0, F.round(n / of, 9)).otherwise(F.lit(0.0))

    def st(name, t, v, d, f, results, metrics):
        return F.struct(F.lit(name).alias("step"), t.cast("bigint").alias("t"), v.cast("bigint").alias("v"),
                        d.cast("bigint").alias("d"), f.cast("bigint").alias("f"), results.alias("rules"), metrics.alias("metrics"))

    schema = [_rule(f"{f}_not_null", "schema", col(f"null_{f}") == 0, col(f"null_{f}"), _if_any(col(f"null_{f}"), "drop")) if f in present
              else _rule(f"{f}_exists", "schema", F.lit(False), col("total"), F.lit("drop")) for f in required]
    times = [_rule("timestamp_parsing", "schema", col("unparsed") == 0, col("unparsed"), _if_any(col("unparsed"), "drop")),
             _rule("timestamp_normalization", "schema", F.lit(True), col("normalized"), F.lit("transform"))]
    dups = [_rule("duplicate_removal", "deduplication", F.lit(True), duplicates, _if_any(duplicates, "drop"))]
    business = [F.when((col(h) > 0) | F.lit(r.emit_when_clean), _rule(
        r.name, r.rule_type, col(h) == 0, col(h), _if_any(col(h), r.action))) for h, r in zip(hits, act)]
    return x.select("date", F.explode(F.array(
        st("schema_validation", col("total"), col("total") - col("bad"), col("bad"), z, F.array(*schema), _custom(
            required_fields_count=F.lit(len(required)), schema_compliance_rate=rate(col("total") - col("bad"), col("total")))),
        st("timestamp_normalization", col("total"), col("normalized"), col("total") - col("normalized"), z, F.array(*times), _custom(
            parsing_errors=col("unparsed"), normalized_count=col("normalized"), target_timezone=F.lit(target_timezone),
            hourly_rounding=F.lit(round_to_hour))),
        st("deduplication", col("normalized"), col("deduped"), duplicates, z, F.array(*dups), _custom(
            duplicate_count=duplicates, deduplication_rate=rate(duplicates, col("normalized")),
            key_fields=F.array(*[F.lit(k) for k in dedup_keys]),
            selection_strategy=F.lit("completeness" if processor == "train" else "keep_last"))),
        st("business_rules", col("deduped"), col("deduped"), z, flagged, F.filter(F.array(*dups, *business), lambda r: r["rule_type"] != "deduplication"),
           _custom(data_type=F.lit(processor))))).alias("s")
    ).select(F.lit(processor).alias("processor"), "date", "s.step", F.col("s.t").alias("total_records"),
             F.col("s.v").alias("valid_records"), F.col("s.d").alias("dropped_records"),
             F.col("s.f").alias("flagged_records"), F.col("s.rules").alias("validation_rules"),
             F.col("s.metrics").alias("custom_metrics"), F.array().cast("array<string>").alias("anomalies"))


def _details() -> Column:
    counts = F.struct("total_records", "valid_records", "dropped_records", "flagged_records").alias("counts")
    return F.to_json(F.struct(F.col("processor").alias("processor_type"), "step", "date", counts, "validation_rules",
                              "custom_metrics", "anomalies"))


def metrics_table(steps: DataFrame) -> DataFrame:
    """The stored metric rows (L1, B7) with their JSON details (J1): five per step result; the success rate is 0 for
    an empty result."""
    t = F.col("total_records")
    rate = F.when(t > 0, F.col("valid_records") / t).otherwise(F.lit(0.0))
    items = [F.struct(F.lit(m).alias("metric_name"), (F.col(m).cast("double") if m != "validation_success_rate"
                                                    else rate).alias("metric_value"))
             for m in STEP_METRICS]
    return steps.select(F.col("processor").alias("table_name"), "step", "date", run_time(F.col("date")).alias("timestamp"),
                        _details().alias("details"), F.explode(F.array(*items)).alias("m")) \
                .select("table_name", F.col("m.metric_name").alias("metric_name"),
                        F.col("m.metric_value").alias("metric_value"), "timestamp", "step", "date", "details")


def metrics_long(steps: DataFrame) -> DataFrame:
    """L1: the metric rows without their details."""
    return metrics_table(steps).drop("details")


def details_json(steps: DataFrame) -> DataFrame:
    """``details`` JSON per step result: processor, step, date, counts, rule results, custom metrics, anomalies."""
    return steps.select("processor", "step", "date", _details().alias("details"))


def latest_metrics(metrics: DataFrame, table_name: str, n: int = 10) -> DataFrame:
    """Newest ``n`` rows of one processor (ties broken by step and
    metric name so the cut is deterministic)."""
    return (metrics.where(F.col("table_name") == table_name)
                   .orderBy(F.col("timestamp").desc(), F.col("step"), F.col("metric_name")).limit(n))


def latest_per_metric(metrics: DataFrame) -> DataFrame:
    """L3: newest value per (table, step, metric) with ``max_by``."""
    return (metrics.groupBy("table_name", "step", "metric_name")
                   .agg(F.max_by("metric_value", "timestamp").alias("metric_value"),
                        F.max("timestamp").alias("timestamp")))


def post_report_rows(report: DataFrame) -> DataFrame:
    """L4: per date, one row per summary metric of the post report and one
    ``report_summary`` row with value 1.0. ``report`` is the row per date of the
    post assessment; details carry the report header with the date's own stations, and the
    summary row the full report with its metrics."""
    from trackcast.plans.post import with_recommendations, with_summary
    s = with_recommendations(with_summary(report))
    header = [F.concat(F.lit("post_integration_"), F.col("date")).alias("report_id"),
              F.lit("post_integration").alias("report_type")]
    body = [F.struct(F.col("date").alias("start"), F.col("date").alias("end")).alias("date_range"), F.col("station_codes"),
            F.array_sort(F.transform("recommendation_list", lambda r: r["recommendation"])).alias("recommendations")]
    rules = F.size(F.filter("rule_list", lambda r: r["emit"]))
    formats = F.array(*[F.lit(x) for x in EXPORT_FORMATS]).alias("export_formats")
    of_metric = F.to_json(F.struct(*header, *body, formats, rules.alias("detailed_results_count")))
    metrics = F.struct(*[F.col(m).cast("double").alias(m) for m in POST_SUMMARY])
    of_report = F.to_json(F.struct(*header, F.struct(*body, metrics.alias("summary_metrics")).alias("full_report")))

    def item(name, value, details):
        return F.struct(F.lit(name).alias("metric_name"), value.cast("double").alias("metric_value"), details.alias("details"))

    items = [item(m, F.col(m), of_metric) for m in POST_SUMMARY] + [item("report_summary", F.lit(1.0), of_report)]
    return s.select(F.lit("post_integration_report").alias("table_name"), "date",
                    run_time(F.col("date")).alias("timestamp"), F.explode(F.array(*items)).alias("m")) \
            .select("table_name", F.col("m.metric_name").alias("metric_name"),
                    F.col("m.metric_value").alias("metric_value"), "timestamp", F.col("m.details").alias("details"), "date")


def pre_report_rows(score: DataFrame, recs: DataFrame, date_range: DataFrame, stations: DataFrame, *,
                    processing_duration: float = 0.0) -> DataFrame:
    """The 11 summary metrics of the pre report (the duration in seconds as measured by the caller) and one ``complete_report``
    row of table ``pre_integration_complete``."""
    rc = recs.agg(F.array_sort(F.collect_list("recommendation")).alias("recommendations"))
    st = stations.agg(F.array_sort(F.collect_set("station_code")).alias("station_codes"))
    x = one_row(score.withColumn("processing_duration", F.lit(float(processing_duration))), rc, st, date_range)
    pillars = F.struct(*[F.col(c) for c in ("completeness_score", "accuracy_score", "consistency_score",
                                            "uniqueness_score", "coverage_score")])
    details = F.to_json(F.struct(F.lit("pre_integration").alias("processor_type"),
                                 F.struct("start", "end").alias("date_range"), "station_codes",
                                 F.struct("records_processed", "records_valid", "records_flagged", "records_dropped")
                                 .alias("validation_summary"), pillars.alias("four_pillars"), "recommendations"))
    ts = F.timestamp_add("DAY", F.lit(1), F.to_timestamp_ntz(F.col("end")))
    items = [F.struct(F.lit("pre_integration").alias("table_name"), F.lit(m).alias("metric_name"),
                      F.col(m).cast("double").alias("metric_value")) for m in PRE_SUMMARY]
    items.append(F.struct(F.lit("pre_integration_complete").alias("table_name"),
                          F.lit("complete_report").alias("metric_name"),
                          F.col("overall_quality_score").cast("double").alias("metric_value")))
    return x.select(ts.alias("timestamp"), details.alias("details"), F.explode(F.array(*items)).alias("m")) \
            .select("m.table_name", "m.metric_name", "m.metric_value", "timestamp", "details")


def assessed_rows(trains_raw: DataFrame, weather_raw: DataFrame) -> tuple[dict[str, DataFrame], DataFrame, DataFrame, DataFrame]:
    """Pillars and score, recommendations, date range and stations of a pre-integration assessment."""
    from trackcast.plans import pre
    parts = pre.assess(trains_raw, weather_raw)
    times = trains_raw.select("timestamp").unionByName(weather_raw.select("timestamp"))
    span = times.agg(F.date_format(F.min(F.to_date("timestamp")), "yyyy-MM-dd").alias("start"),
                     F.date_format(F.max(F.to_date("timestamp")), "yyyy-MM-dd").alias("end"))
    stations = (trains_raw.select("station_code").unionByName(weather_raw.select("station_code"))
                .where(F.col("station_code").isNotNull()))
    return parts, pre.recommendations(parts), span, stations


def store_pre_report(trains_raw: DataFrame, weather_raw: DataFrame, path: str) -> DataFrame:
    """Assesses two raw tables and appends the report's rows (L5, B7), with the seconds the score took, to the store at ``path``.

    The score is written to the shared folder once, which is what is timed, and the report is built from it. Returns the rows stored."""
    began = time.monotonic()
    parts, recs, span, stations = assessed_rows(trains_raw, weather_raw)
    score, score_at = work_table(parts["score"], "pre-score")
    took = time.monotonic() - began
    rows, at = work_table(pre_report_rows(score.limit(1), recs, span, stations, processing_duration=took).withColumn(
        "date", F.date_format(F.timestamp_add("DAY", F.lit(-1), F.col("timestamp")), "yyyy-MM-dd")), "pre-report")
    rows.write.mode("append").partitionBy("date").parquet(path)
    for used in (score_at, at):
        drop_path(rows.sparkSession, used)
    stored = trains_raw.sparkSession.read.schema(rows.schema).parquet(path)
    return stored.where(F.col("table_name").startswith("pre_integration"))


# ---- retrieval ----------------------------------------------------------------

_BODY = ("date_range:struct<start:string, end:string>, station_codes:array<string>, recommendations:array<string>, "
         "summary_metrics:map<string, double>")
REPORT_SCHEMA = f"struct<report_id:string, report_type:string, processor_type:string, {_BODY}, full_report:struct<{_BODY}>>"


def filter_report_window(metrics: DataFrame, *, report_type: str | None = None, start_date: str | None = None,
                         end_date: str | None = None) -> DataFrame:
    """The optional predicates ANDed: table, timestamp >= start day,
    timestamp <= end of end day."""
    out = metrics
    if report_type:
        out = out.where(F.col("table_name") == report_type)
    if start_date:
        out = out.where(F.col("timestamp") >= F.lit(start_date).cast("timestamp_ntz"))
    if end_date:
        out = out.where(F.col("timestamp") < F.timestamp_add("DAY", F.lit(1), F.lit(end_date).cast("timestamp_ntz")))
    return out


def parse_details(metrics: DataFrame) -> DataFrame:
    """Report header and body parsed from ``details``; a report row has its body under ``full_report``."""
    r = F.from_json("details", REPORT_SCHEMA)
    body = [F.coalesce(F.col(f"_r.full_report.{c}"), F.col(f"_r.{c}")).alias(c)
            for c in ("date_range", "station_codes", "recommendations", "summary_metrics")]
    return metrics.withColumn("_r", r).withColumn("report", F.struct(
        F.col("_r.report_id"), F.col("_r.report_type"), F.col("_r.processor_type"), *body)).drop("_r")


def overlaps(stations: Sequence[str]) -> Column:
    """The report's station list shares a station with the requested one."""
    return F.arrays_overlap(F.col("report.station_codes"), F.array(*[F.lit(c) for c in stations]))


def retrieve_reports(metrics: DataFrame, *, report_type: str | None = None, start_date: str | None = None,
                     end_date: str | None = None, station_codes: Sequence[str] | None = None) -> DataFrame:
    """The ``report_summary`` row of each stored report in the window, JSON
    parsed, filtered by station overlap (J3), newest first."""
    out = parse_details(filter_report_window(metrics.where(F.col("metric_name") == "report_summary"),
                                             report_type=report_type, start_date=start_date, end_date=end_date))
    if station_codes:
        out = out.where(overlaps(station_codes))
    return out.orderBy(F.col("timestamp").desc())


def retrieve_pre_reports(metrics: DataFrame, *, start_date: str | None = None, end_date: str | None = None,
                         station_codes: Sequence[str] | None = None, limit: int = 10) -> DataFrame:
    """L6 for pre-integration reports: the newest ``limit`` complete reports of
    the window, then the station filter (in this order, as stored reports are cut before they are read)."""
    out = parse_details(filter_report_window(metrics.where(F.col("metric_name") == "complete_report"),
                                             report_type="pre_integration_complete", start_date=start_date,
                                             end_date=end_date).orderBy(F.col("timestamp").desc()).limit(limit))
    return out.where(overlaps(station_codes)) if station_codes else out
