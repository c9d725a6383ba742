"""Metrics-store queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from trackcast.catalog import register
from trackcast.config import TrainConfig, WeatherConfig
from trackcast.operators import rules as R
from trackcast.plans import metrics as M
from trackcast.plans import post
from trackcast.queries.assess import POST_CTES, PRE_CTES

TC, WC = TrainConfig(), WeatherConfig()
DAY = "'%Y-%m-%d'"


def _steps(s):
    t = M.steps_by_date(s.trains_raw, processor="train", required=TC.required_fields, rules=R.train_business_rules(),
                        round_to_hour=False, dedup_keys=TC.dedup_keys, order_by="ingest_seq")
    w = M.steps_by_date(s.weather_raw, processor="weather", required=WC.required_fields,
                        rules=R.weather_business_rules(), round_to_hour=True, dedup_keys=WC.dedup_keys,
                        order_by="ingest_seq")
    return t.unionByName(w)


def _steps_sql() -> str:
    def one(proc, raw, norm, dedup, fields, hits):
        bad = " or ".join(f"{f} is null" for f in fields)
        nulls = ", ".join(f"count(*) filter (where {f} is null) as null{k}" for k, f in enumerate(fields, 1))
        one_hit, two_hits = (f"count(*) filter (where {h})" for h in hits)
        flag = f"{one_hit} as hit1, {two_hits} as hit2, {one_hit} + {two_hits}"
        return f"""
  select '{proc}' as processor, a.date, a.total, a.bad, coalesce(b.normalized, 0) as normalized,
    coalesce(c.deduped, 0) as deduped, coalesce(c.flagged, 0) as flagged, null1, null2, null3,
    coalesce(c.hit1, 0) as hit1, coalesce(c.hit2, 0) as hit2
  from (select strftime(timestamp, {DAY}) as date, count(*) as total, count(*) filter (where {bad}) as bad, {nulls}
        from {raw} group by 1) a
  left join (select strftime(timestamp, {DAY}) as date, count(*) as normalized from {norm} group by 1) b
    on b.date = a.date
  left join (select strftime(timestamp, {DAY}) as date, count(*) as deduped, {flag} as flagged
             from {dedup} group by 1) c on c.date = a.date"""
    t = one("train", "trains_raw", "trains_norm", "trains_dedup",
            TC.required_fields, ("delay_minutes < -5", "delay_minutes > 300"))
    w = one("weather", "weather_raw", "weather_norm", "weather_dedup",
            WC.required_fields, ("temperature < -20 or temperature > 50", "precip_mm < 0"))
    return f"""
mx as ({t}
  union all {w}),
msteps as (
  select processor, date, 'schema_validation' as step, total as total_records, total - bad as valid_records,
    bad as dropped_records, 0 as flagged_records from mx
  union all select processor, date, 'timestamp_normalization', total, normalized, total - normalized, 0 from mx
  union all select processor, date, 'deduplication', normalized, deduped, normalized - deduped, 0 from mx
  union all select processor, date, 'business_rules', deduped, deduped, 0, flagged from mx),
mlong as (
  select processor as table_name, metric_name, metric_value, cast(date as timestamp) + interval 1 day as timestamp,
    step, date from (
    select processor, date, step, 'total_records' as metric_name, cast(total_records as double) as metric_value from msteps
    union all select processor, date, step, 'valid_records', cast(valid_records as double) from msteps
    union all select processor, date, step, 'dropped_records', cast(dropped_records as double) from msteps
    union all select processor, date, step, 'flagged_records', cast(flagged_records as double) from msteps
    union all select processor, date, step, 'validation_success_rate',
      case when total_records > 0 then valid_records * 1e0 / total_records else 0e0 end from msteps) u)"""


MCTES = _steps_sql()


def msql(body: str) -> str:
    return f",\n{MCTES.strip()}\n{body}"


_R9 = "round(metric_value, 9) as metric_value"


@register("metrics_long", msql(f"select table_name, metric_name, {_R9}, timestamp, step, date from mlong"))
def metrics_long(s):
    """L1: five metric rows per step result of every per-date DQ run."""
    m = M.metrics_long(_steps(s))
    return m.select("table_name", "metric_name", F.round("metric_value", 9).alias("metric_value"), "timestamp",
                    "step", "date")


def _details_sql() -> str:
    """Per step result: its rule results and custom metrics, as JSON."""
    def rule(name, kind, passed, n, action):
        return (f"json_object('rule_name', '{name}', 'rule_type', '{kind}', 'passed', {passed}, 'affected_records', {n}, "
                f"'action_taken', {action})")

    def some(n, action):
        return f"case when {n} > 0 then '{action}' else 'none' end"

    def rate(n, of):
        return f"case when {of} > 0 then round({n} * 1e0 / {of}, 9) else 0e0 end"

    parts = []
    for proc, cfg, rounded, strategy, hits in (
            ("train", TC, "false", "completeness", (("extreme_early_delay", "business", "transform"),
                                                    ("extreme_delay_outlier", "business", "flag"))),
            ("weather", WC, "true", "keep_last", (("temperature_range_validation", "range", "transform"),
                                                  ("precip_mm_range_validation", "range", "transform")))):
        schema = ", ".join(rule(f"{f}_not_null", "schema", f"null{k} = 0", f"null{k}", some(f"null{k}", "drop"))
                           for k, f in enumerate(cfg.required_fields, 1))
        times = (rule("timestamp_parsing", "schema", "true", 0, "'none'") + ", "
                 + rule("timestamp_normalization", "schema", "true", "normalized", "'transform'"))
        dups = rule("duplicate_removal", "deduplication", "true", "normalized - deduped", some("normalized - deduped", "drop"))
        broken = ", ".join(f"case when hit{k} > 0 then {rule(n, kind, 'false', f'hit{k}', repr(action))} end"
                           for k, (n, kind, action) in enumerate(hits, 1))
        keys = "[" + ", ".join(f"'{k}'" for k in cfg.dedup_keys) + "]"
        for step, rules, custom in (
                ("schema_validation", f"[{schema}]", f"json_object('required_fields_count', {len(cfg.required_fields)}, "
                 f"'schema_compliance_rate', {rate('(total - bad)', 'total')})"),
                ("timestamp_normalization", f"[{times}]", "json_object('parsing_errors', 0, 'normalized_count', normalized, "
                 f"'target_timezone', '{cfg.target_timezone}', 'hourly_rounding', {rounded})"),
                ("deduplication", f"[{dups}]", "json_object('duplicate_count', normalized - deduped, 'deduplication_rate', "
                 f"{rate('(normalized - deduped)', 'normalized')}, 'key_fields', {keys}, 'selection_strategy', '{strategy}')"),
                ("business_rules", f"list_filter([{broken}], lambda x: x is not null)", f"json_object('data_type', '{proc}')")):
            parts.append(f"select processor, date, '{step}' as step, {rules} as rules, {custom} as custom from mx "
                         f"where processor = '{proc}'")
    return " union all ".join(parts)


@register("metrics_to_json", msql(
    f"select s.processor, s.step, s.date, json_object('processor_type', s.processor, 'step', s.step, 'date', s.date, 'counts', "
    "json_object('total_records', total_records, 'valid_records', valid_records, 'dropped_records', dropped_records, "
    "'flagged_records', flagged_records), 'validation_rules', d.rules, 'custom_metrics', d.custom, 'anomalies', "
    f"[]::varchar[])::varchar as details from msteps s join ({_details_sql()}) d on d.processor = s.processor "
    "and d.step = s.step and d.date is not distinct from s.date"))
def metrics_to_json(s):
    """The JSON details of every step result."""
    return M.details_json(_steps(s))


@register("latest_metrics", msql(f"select table_name, metric_name, {_R9}, timestamp, step from mlong "
                                 "where table_name = 'train' order by timestamp desc, step, metric_name limit 10"))
def latest_metrics(s):
    """L2: newest 10 metric rows of the train processor."""
    m = M.latest_metrics(M.metrics_long(_steps(s)), "train", 10)
    return m.select("table_name", "metric_name", F.round("metric_value", 9).alias("metric_value"), "timestamp", "step")


@register("latest_n", msql(f"select table_name, metric_name, {_R9}, timestamp, step from mlong "
                           "order by timestamp desc, table_name, step, metric_name limit 20"))
def latest_n(s):
    """Newest 20 metric rows over every processor (distributed top-k)."""
    m = M.metrics_long(_steps(s))
    top = m.orderBy(F.col("timestamp").desc(), "table_name", "step", "metric_name").limit(20)
    return top.select("table_name", "metric_name", F.round("metric_value", 9).alias("metric_value"), "timestamp",
                      "step")


@register("latest_per_metric", msql(
    f"select table_name, step, metric_name, round(arg_max(metric_value, timestamp), 9) as metric_value, "
    "max(timestamp) as timestamp from mlong group by table_name, step, metric_name"))
def latest_per_metric(s):
    """L3: newest value per (processor, step, metric)."""
    m = M.latest_per_metric(M.metrics_long(_steps(s)))
    return m.select("table_name", "step", "metric_name", F.round("metric_value", 9).alias("metric_value"), "timestamp")


@register("filter_report_window", msql(
    f"select table_name, metric_name, {_R9}, timestamp, step from mlong where table_name = 'weather' "
    "and timestamp >= timestamp '2024-01-10 00:00:00' and timestamp < timestamp '2024-01-20 00:00:00' + interval 1 day"))
def filter_report_window(s):
    """Type and date-window predicates ANDed over the metric rows."""
    m = M.filter_report_window(M.metrics_long(_steps(s)), report_type="weather", start_date="2024-01-10",
                               end_date="2024-01-20")
    return m.select("table_name", "metric_name", F.round("metric_value", 9).alias("metric_value"), "timestamp",
                    "step")


# ---- report rows (L4, L5) and retrieval (J2, J3, L6) ---------------------------------

def _post_rows(s):
    return M.post_report_rows(post.assess(s.integrated_table)["report"])


_POST_ROWS_SQL = """
prow as (
  select 'post_integration_report' as table_name, m.metric_name, m.metric_value,
    cast(s.date as timestamp) + interval 1 day as timestamp, s.date
  from (select date, overall_quality_score, total_records, total_flagged_records,
          case when total_records > 0 then total_flagged_records * 1e0 / total_records else 0e0 end as flagged_rate
        from pscore) s,
  lateral (select 'overall_quality_score' as metric_name, s.overall_quality_score * 1e0 as metric_value
           union all select 'total_records', s.total_records * 1e0
           union all select 'total_flagged_records', s.total_flagged_records * 1e0
           union all select 'flagged_rate', s.flagged_rate
           union all select 'report_summary', 1e0) m)"""


def psql(body: str) -> str:
    return f",\n{POST_CTES.strip()},\n{_POST_ROWS_SQL.strip()}\n{body}"


@register("report_rows", psql(f"select table_name, metric_name, {_R9}, timestamp, date from prow"))
def report_rows(s):
    """L4: per date, the post report's summary metrics and its report_summary row."""
    r = _post_rows(s)
    return r.select("table_name", "metric_name", F.round("metric_value", 9).alias("metric_value"), "timestamp", "date")


@register("json_details_extract", psql(
    "select distinct 'post_integration_' || date as report_id, 'post_integration' as report_type, "
    "date as range_start, (select count(distinct station_code) from integrated_table i "
    "where strftime(i.timestamp, '%Y-%m-%d') = prow.date) as station_count from prow"))
def json_details_extract(s):
    """Report header fields read back from the stored JSON details."""
    r = M.parse_details(_post_rows(s))
    return r.select(F.col("report.report_id").alias("report_id"), F.col("report.report_type").alias("report_type"),
                    F.col("report.date_range.start").alias("range_start"),
                    F.size("report.station_codes").cast("bigint").alias("station_count")).distinct()


@register("station_overlap_filter", psql(
    "select count(*) as report_rows from prow where exists (select 1 from integrated_table i "
    "where strftime(i.timestamp, '%Y-%m-%d') = prow.date and i.station_code in ('S03', 'S99'))"))
def station_overlap_filter(s):
    """Report rows whose station list overlaps a requested list."""
    r = M.parse_details(_post_rows(s))
    return r.where(M.overlaps(["S03", "S99"])).agg(F.count(F.lit(1)).alias("report_rows"))


@register("retrieve_reports", psql(
    f"select table_name, metric_name, {_R9}, timestamp, date from prow "
    "where metric_name = 'report_summary' and timestamp >= timestamp '2024-01-10 00:00:00' "
    "and timestamp < timestamp '2024-01-20 00:00:00' + interval 1 day and exists (select 1 from integrated_table i "
    "where strftime(i.timestamp, '%Y-%m-%d') = prow.date and i.station_code in ('S01'))"))
def retrieve_reports(s):
    """Window + station filter over the stored report rows, JSON parsed."""
    r = M.retrieve_reports(_post_rows(s), report_type="post_integration_report", start_date="2024-01-10",
                           end_date="2024-01-20", station_codes=["S01"])
    return r.select("table_name", "metric_name", F.round("metric_value", 9).alias("metric_value"), "timestamp", "date")


_PRE_ROWS_SQL = f"""
prerow as (
  select m.table_name, m.metric_name, m.metric_value,
    (select max(cast(timestamp as date)) from (select timestamp from trains_raw union all select timestamp from weather_raw) u)
      + interval 1 day as timestamp
  from pre_score s,
  lateral (select 'pre_integration' as table_name, 'overall_quality_score' as metric_name, s.overall_quality_score as metric_value
           union all select 'pre_integration', 'completeness_score', s.completeness_score
           union all select 'pre_integration', 'accuracy_score', s.accuracy_score
           union all select 'pre_integration', 'consistency_score', s.consistency_score
           union all select 'pre_integration', 'uniqueness_score', s.uniqueness_score
           union all select 'pre_integration', 'coverage_score', s.coverage_score
           union all select 'pre_integration', 'records_processed', s.records_processed * 1e0
           union all select 'pre_integration', 'records_valid', s.records_valid * 1e0
           union all select 'pre_integration', 'records_flagged', s.records_flagged * 1e0
           union all select 'pre_integration', 'records_dropped', s.records_dropped * 1e0
           union all select 'pre_integration', 'processing_duration', 0e0
           union all select 'pre_integration_complete', 'complete_report', s.overall_quality_score) m)"""


@register("pre_report_rows", f",\n{PRE_CTES.strip()},\n{_PRE_ROWS_SQL.strip()}\n"
                             f"select table_name, metric_name, {_R9}, timestamp from prerow")
def pre_report_rows(s):
    """The pre report's 11 summary metrics and its complete-report row."""
    r = _pre_rows(s)
    return r.select("table_name", "metric_name", F.round("metric_value", 9).alias("metric_value"), "timestamp")


@register("retrieve_pre_reports", f",\n{PRE_CTES.strip()},\n{_PRE_ROWS_SQL.strip()}\n"
          f"select table_name, metric_name, {_R9}, timestamp from prerow where metric_name = 'complete_report' "
          "and timestamp >= timestamp '2024-01-01 00:00:00' and exists "
          "(select 1 from (select station_code from trains_raw union all select station_code from weather_raw) u "
          "where station_code = 'S01') order by timestamp desc limit 10")
def retrieve_pre_reports(s):
    """L6 for pre-integration reports: newest complete reports of a window, at most 10, filtered by station."""
    r = M.retrieve_pre_reports(_pre_rows(s), start_date="2024-01-01", station_codes=["S01"], limit=10)
    return r.select("table_name", "metric_name", F.round("metric_value", 9).alias("metric_value"), "timestamp")


def _pre_rows(s):
    parts, recs, span, stations = M.assessed_rows(s.trains_raw, s.weather_raw)
    return M.pre_report_rows(parts["score"], recs, span, stations)


@register("append_metrics", msql(f"select table_name, metric_name, {_R9}, timestamp from mlong"))
def append_metrics(s):
    """The metric rows (step metrics of every run) appended to a new store by date, read back."""
    from trackcast.session import new_work_dir
    from trackcast.sources.sinks import write_partitioned
    rows = M.metrics_table(_steps(s))
    path = new_work_dir(s.spark, "metrics")
    write_partitioned(rows, path, partition_by=("date",))
    m = s.spark.read.schema(rows.schema).parquet(path)
    return m.select("table_name", "metric_name", F.round("metric_value", 9).alias("metric_value"), "timestamp")
