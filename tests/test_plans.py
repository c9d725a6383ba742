"""Plan checks: the physical plans have the shapes the design relies on."""

from conftest import SF_MID


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_nearest_join_is_an_equi_join(spark):
    import __spark_entry__ as E
    q = E.queries()["nearest_join"](spark, SF_MID)
    p = _plan(q)
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p
    assert "HashJoin" in p or "SortMergeJoin" in p


def test_range_scan_pushes_filters(spark):
    from pyspark.sql import functions as F
    from trackcast.fixtures import table
    ev = table(spark, SF_MID, "events")
    q = ev.where(F.col("ts") >= F.lit("2024-01-10").cast("timestamp_ntz")).select("event_id", "ts")
    p = q._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts" in p
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz>" in p


def test_dedup_combines_map_side(spark):
    import __spark_entry__ as E
    p = _plan(E.queries()["dedup_completeness"](spark, SF_MID))
    assert "partial_max_by" in p


def test_no_python_udf_in_headline_plans(spark):
    import __spark_entry__ as E
    for k in ("nearest_join", "engineer_features", "process_train", "process_weather", "pre_quality_score",
              "post_overall_score"):
        p = _plan(E.queries()[k](spark, SF_MID))
        assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p, k


def test_nearest_join_without_broadcast_is_a_sort_merge_join(spark):
    """Beyond the broadcast bounds the match stays an equi-join on (station,
    bucket): a sort-merge join, never a nested loop or cartesian product."""
    import __spark_entry__ as E
    old = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold",
                                          "spark.sql.adaptive.autoBroadcastJoinThreshold")}
    try:
        for k in old:
            spark.conf.set(k, "-1")
        p = _plan(E.queries()["nearest_join"](spark, SF_MID))
        assert "SortMergeJoin" in p and "_bucket" in p
        assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_report_rows_read_each_source_once_per_stage(spark):
    """The post report is one row per date: no branch rebuilds the integrated rows."""
    import __spark_entry__ as E
    for k in ("report_rows", "retrieve_reports", "json_details_extract", "post_overall_score"):
        df = E.queries()[k](spark, SF_MID)
        leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves().size()
        assert leaves <= 10, (k, leaves)


def test_features_are_built_over_rows_matched_once(spark):
    """The match is written and read back: no plan of the features holds it twice, and none that needs no weather holds it at all."""
    import __spark_entry__ as E
    q = E.queries()
    for k in ("engineer_features", "integrate", "feature_profile", "station_importance", "time_period", "distinct_guard"):
        p = _plan(q[k](spark, SF_MID))
        assert "_cands" not in p and "max_by" not in p, k
    for k in ("is_weekend", "temporal_parts", "is_high_speed", "delay_flags", "service_disruption"):
        df = q[k](spark, SF_MID)
        p = _plan(df)
        assert "_cands" not in p and "Join" not in p and "Union" in p, k
        assert df._jdf.queryExecution().optimizedPlan().collectLeaves().size() == 2, k   # the rows and their copies


def test_distinct_counts_expand_no_row(spark):
    import __spark_entry__ as E
    assert "Expand" not in _plan(E.queries()["distinct_guard"](spark, SF_MID))
