"""Feature engineering.

Batch-wide quantities (is a column constant? route-length median, per-station
counts and their 33/67 % quantiles) come from ONE partial-aggregated pass
keyed by ``(station_code, route_length)``; everything else is derived from
that small table. The per-station counts join back (AQE broadcasts them when
small) carrying the one-row scalar frame, so the batch meets its statistics
in one hash join.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trackcast.config import (
    DELAY_BINS, DELAY_STATUS_CODES, RAIN_BINS, TEMP_BINS, TRAFFIC_LABELS, TRAFFIC_QUANTILES, WIND_BINS,
)
from trackcast.functions import text as T
from trackcast.functions import timefns as TF
from trackcast.functions.binning import bin_column, bin_dynamic, guarded
from trackcast.functions.nulls import fill0, is_true
from trackcast.operators.attach import attach_one_row, one_row

ALL_GROUPS = ("temporal", "weather", "delay", "categorical")

#: Batch statistics, and the feature columns that need one; all others are expressions over their own row.
STATISTICS = ("hour", "precip", "wind", "delay", "stations", "route")
STATISTIC_OF = {"time_period": "hour", "rain_intensity": "precip", "wind_category": "wind", "delay_category": "delay",
                "station_traffic_rank": "stations", "station_importance": "stations", "is_complex_route": "route"}
WEATHER_FEATURES = ("temp_category", "is_extreme_cold", "is_extreme_hot", "is_freezing", "is_raining", "rain_intensity", "is_heavy_rain",
                    "wind_category", "is_high_wind", "weather_severity_score", "adverse_weather")


def _has(df: DataFrame, c: str) -> bool:
    # one schema round trip per frame, not one per test
    cols = getattr(df, "_tc_cols", None)
    if cols is None:
        cols = frozenset(df.columns)
        try:
            df._tc_cols = cols
        except AttributeError:
            pass
    return c in cols


def batch_stats(df: DataFrame, need: Sequence[str] | None = None) -> tuple[DataFrame | None, DataFrame]:
    """(station_counts, scalars): per-station row counts and a one-row frame of
    batch-wide guards, medians and quantiles, from one pass over ``df``.

    ``need`` names the statistics wanted (see ``STATISTICS``; all if not given), so that only their columns are read."""
    need = set(STATISTICS if need is None else need)
    keys, aggs = [], [F.count(F.lit(1)).alias("n")]
    has_station = "stations" in need and _has(df, "station_code")
    if has_station:
        keys.append(F.col("station_code"))
    keys.append((T.route_complexity(F.col("route")) if "route" in need and _has(df, "route") else F.lit(0)).alias("rlen"))
    probes = {}
    if "hour" in need and _has(df, "timestamp"):
        probes["hour"] = F.hour("timestamp")
    if "precip" in need and _has(df, "precip_mm"):
        probes["precip"] = fill0(F.col("precip_mm"))
    if "wind" in need and _has(df, "wind_speed"):
        probes["wind"] = fill0(F.col("wind_speed"))
    if "delay" in need and _has(df, "delay_minutes"):
        probes["delay"] = fill0(F.col("delay_minutes"))
    for k, e in probes.items():
        aggs += [F.min(e).alias(f"{k}_lo"), F.max(e).alias(f"{k}_hi")]
    g = df.groupBy(*keys).agg(*aggs)

    fin = [F.sum("n").alias("rows")]
    for k in probes:
        fin.append(F.coalesce(F.min(f"{k}_lo") < F.max(f"{k}_hi"), F.lit(False)).alias(f"{k}_varies"))
    fin.append(F.percentile(F.col("rlen"), F.lit(0.5), F.col("n")).alias("route_median"))
    scalars = g.agg(*fin)

    if has_station:
        # one row per station value seen (null included, so every input row
        # finds its row with a null-safe equi-join); null stations have no rank
        station_counts = (g.groupBy("station_code").agg(F.sum("n").alias("_n"))
                           .select(F.col("station_code").alias("_sc"),
                                   F.when(F.col("station_code").isNotNull(), F.col("_n")).alias("station_traffic_rank")))
        q = (station_counts.where(F.col("_sc").isNotNull()).agg(
            (F.min("station_traffic_rank") < F.max("station_traffic_rank")).alias("traffic_varies"),
            F.percentile(F.col("station_traffic_rank"), F.array(*[F.lit(x) for x in TRAFFIC_QUANTILES])).alias("tq")))
        q = q.select(F.coalesce("traffic_varies", F.lit(False)).alias("traffic_varies"),
                     F.col("tq")[0].alias("traffic_q33"), F.col("tq")[1].alias("traffic_q67"))
        scalars = one_row(scalars, q)
    else:
        station_counts = None
    return station_counts, scalars


def engineer_features(df: DataFrame, *, groups: Sequence[str] = ALL_GROUPS, guard_constant: bool = True,
                      columns: Sequence[str] | None = None) -> DataFrame:
    """All feature groups over the whole batch (F43). Optional columns are
    tested at plan time; a group whose source column is absent is skipped.

    ``df`` is read twice where a statistic is needed, once for it and once for the rows, so pass rows that are stored (a
    table, or a plan written with ``session.work_table``). With ``columns`` only those features are built; without a statistic
    among them there is one pass and no join."""
    groups = set(groups)
    df_cols = df.columns
    need = set(STATISTICS if columns is None else (STATISTIC_OF[c] for c in columns if c in STATISTIC_OF))
    station_counts, scalars = batch_stats(df, need) if need else (None, None)
    if station_counts is not None:
        # small table: per-station counts with the one-row statistics attached
        # (a one-row broadcast); the batch joins it once on the station key
        stats = attach_one_row(station_counts, scalars)
        x = df.join(stats, df["station_code"].eqNullSafe(stats["_sc"]), "left")
    else:
        x = attach_one_row(df, scalars) if need else df

    have = frozenset(x.columns)

    def S(name: str):  # a statistic that no wanted column needs is not there, and its feature is not selected
        return F.col(name) if name in have else F.lit(None)

    new: dict = {}

    if "temporal" in groups and _has(df, "timestamp"):
        parts = TF.temporal_parts(F.col("timestamp"))
        new.update(parts)
        new["is_weekend"] = TF.is_weekend(parts["day_of_week"])
        new["is_rush_hour"] = TF.is_rush_hour(parts["hour_of_day"])
        new["time_period"] = guarded(TF.time_period(parts["hour_of_day"]), S("hour_varies"), "Unknown",
                                     guard_constant)
        new["season"] = TF.season(parts["month"])

    if "weather" in groups:
        t, p, w = F.col("temperature"), F.col("precip_mm"), F.col("wind_speed")
        if _has(df, "temperature"):
            new["temp_category"] = bin_column(t, *TEMP_BINS)
            new["is_extreme_cold"] = is_true(t < -10)
            new["is_extreme_hot"] = is_true(t > 35)
            new["is_freezing"] = is_true(t <= 0)
        if _has(df, "precip_mm"):
            new["is_raining"] = is_true(p > 0)
            new["rain_intensity"] = guarded(bin_column(fill0(p), *RAIN_BINS, include_lowest=True),
                                            S("precip_varies"), "None", guard_constant)
            new["is_heavy_rain"] = is_true(p > 10)
        if _has(df, "wind_speed"):
            new["wind_category"] = guarded(bin_column(fill0(w), *WIND_BINS, include_lowest=True),
                                           S("wind_varies"), "Calm", guard_constant)
            new["is_high_wind"] = is_true(w > 25)
        sev = F.lit(0.0)
        if _has(df, "temperature"):
            sev = sev + F.when(is_true((t < -5) | (t > 35)), F.lit(0.3)).otherwise(F.lit(0.0))
        if _has(df, "precip_mm"):
            sev = sev + F.least(fill0(p) / F.lit(20), F.lit(0.4))
        if _has(df, "wind_speed"):
            sev = sev + F.least(fill0(w) / F.lit(50), F.lit(0.3))
        new["weather_severity_score"] = F.least(sev, F.lit(1.0))
        adverse = F.lit(False)
        for k in ("is_extreme_cold", "is_extreme_hot", "is_heavy_rain", "is_high_wind"):
            if k in new:
                adverse = adverse | new[k]
        new["adverse_weather"] = adverse

    if "delay" in groups:
        if _has(df, "delay_minutes"):
            d = F.col("delay_minutes")
            new["delay_category"] = guarded(bin_column(fill0(d), *DELAY_BINS), S("delay_varies"), "On_Time",
                                            guard_constant)
            new["is_delayed"] = is_true(d > 5)
            new["is_significantly_delayed"] = is_true(d > 15)
            new["is_severely_delayed"] = is_true(d > 60)
            new["is_early"] = is_true(d < -5)
            new["delay_severity_score"] = F.least(F.greatest(fill0(d) / F.lit(120), F.lit(0.0)), F.lit(1.0))
        new["service_disruption"] = F.col("is_cancelled") if _has(df, "is_cancelled") else F.lit(False)
        if _has(df, "delay_status"):
            enc = None
            for k, v in DELAY_STATUS_CODES.items():
                enc = F.when(F.col("delay_status") == k, F.lit(v)) if enc is None else enc.when(F.col("delay_status") == k, F.lit(v))
            new["delay_status_encoded"] = enc.otherwise(F.lit(0))

    if "categorical" in groups:
        if _has(df, "train_category"):
            new["is_high_speed"] = T.is_high_speed(F.col("train_category"))
            new["is_regional"] = T.is_regional(F.col("train_category"))
        if _has(df, "station_code"):
            r = S("station_traffic_rank")
            importance = bin_dynamic(r, F.lit(0), S("traffic_q33"), S("traffic_q67"), TRAFFIC_LABELS)
            valid_edges = S("traffic_varies") & (S("traffic_q33") < S("traffic_q67"))
            new["station_traffic_rank"] = r
            # a constant count (or equal quantile edges) labels every row Medium
            new["station_importance"] = F.when(is_true(valid_edges), importance).otherwise(F.lit("Medium_Traffic"))
        if _has(df, "route"):
            rc = T.route_complexity(F.col("route"))
            new["route_complexity"] = rc
            new["is_complex_route"] = is_true(rc > S("route_median"))
        if _has(df, "destination"):
            new["is_major_destination"] = T.is_major_destination(F.col("destination"))

    out_cols = [F.col(c) for c in df_cols] + [v.alias(k) for k, v in new.items() if columns is None or k in columns]
    return x.select(*out_cols)


def feature_families(columns: Sequence[str]) -> dict[str, list[str]]:
    """Columns per family by name pattern (P1); one column may sit in several."""
    # FIXED VALUES: name fragments of each family.
    terms = {
        "temporal": ["hour", "day", "month", "year", "weekend", "rush", "season", "time"],
        "weather": ["temp", "rain", "wind", "weather", "precip", "adverse"],
        "delay": ["delay", "early", "cancelled", "disruption"],
        "categorical": ["category", "importance", "traffic", "speed", "regional"],
    }
    return {fam: [c for c in columns if any(t in c.lower() for t in ts)] for fam, ts in terms.items()}


def feature_profile(df: DataFrame, *, approx_distinct: bool = False) -> DataFrame:
    """Per column, its families (by name pattern) and null / non-null
    counts from ONE aggregate, unpivoted to one row per column. With
    ``approx_distinct`` each column also gets a HyperLogLog distinct estimate
    (exact distinct counts over every column would expand the rows once per
    column)."""
    cols = df.columns
    fam = feature_families(cols)
    aggs = [F.count_if(F.col(c).isNull()).alias(f"n{i}") for i, c in enumerate(cols)]
    aggs += [F.count(F.col(c)).alias(f"v{i}") for i, c in enumerate(cols)]
    if approx_distinct:
        aggs += [F.approx_count_distinct(F.col(c)).alias(f"d{i}") for i, c in enumerate(cols)]
    agg = df.agg(*aggs)
    items = [F.struct(F.lit(c).alias("column_name"), F.col(f"n{i}").alias("null_count"),
                      F.col(f"v{i}").alias("non_null_count"),
                      *([F.col(f"d{i}").alias("approx_distinct")] if approx_distinct else []),
                      *[F.lit(c in fam[k]).alias(f"in_{k}") for k in fam])
             for i, c in enumerate(cols)]
    return agg.select(F.explode(F.array(*items)).alias("r")).select("r.*")
