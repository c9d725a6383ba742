"""Declarative data-quality rules.

A rule is a violation predicate plus what to do with violating rows:
``transform`` nulls ``column`` and sets ``flag``; ``flag`` only sets ``flag``;
``none`` only counts. All rule counts of one frame come from a single
aggregate, so a rule set costs one pass however many rules it holds.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trackcast.functions.nulls import as_flag, is_true

Pred = Callable[[DataFrame], Column]


@dataclass(frozen=True)
class Rule:
    name: str
    rule_type: str
    predicate: Pred
    action: str = "flag"            # 'transform' | 'flag' | 'none'
    column: str | None = None       # nulled when action == 'transform'
    flag: str | None = None         # 0/1 column set on violation
    requires: tuple = ()            # columns that must exist for the rule to apply
    emit_when_clean: bool = False   # emit a result row even with zero violations

    def applies(self, df: DataFrame) -> bool:
        return all(c in df.columns for c in self.requires)


def active(df: DataFrame, rules: Sequence[Rule]) -> list[Rule]:
    return [r for r in rules if r.applies(df)]


def apply_rules(df: DataFrame, rules: Sequence[Rule], init_flags: Sequence[str] = ()) -> DataFrame:
    """Apply every active rule, evaluating all predicates on the input values."""
    rules = active(df, rules)
    preds = {r.name: is_true(r.predicate(df)) for r in rules}
    flags: dict[str, Column] = {f: F.lit(0) for f in init_flags if f not in df.columns}
    for r in rules:
        if r.flag:
            base = flags.get(r.flag, F.col(r.flag) if r.flag in df.columns else F.lit(0))
            flags[r.flag] = F.when(preds[r.name], F.lit(1)).otherwise(base)
    nulled: dict[str, Column] = {}
    for r in rules:
        if r.action == "transform" and r.column:
            base = nulled.get(r.column, F.col(r.column))
            nulled[r.column] = F.when(preds[r.name], F.lit(None)).otherwise(base)
    # one projection: flags and nulled values both read the input values
    changes = {**nulled, **{k: v.cast("int") for k, v in flags.items()}}
    return df.withColumns(changes) if changes else df


def rule_counts(df: DataFrame, rules: Sequence[Rule], *, processor: str, step: str) -> DataFrame:
    """One row per rule: (processor, step, rule_name, rule_type, passed,
    affected_records, action). Rules with no violation are left out unless
    ``emit_when_clean``; the action of a clean rule is 'none'."""
    rules = active(df, rules)
    if not rules:
        return df.sparkSession.createDataFrame([], "processor string, step string, rule_name string, rule_type string, "
                                                   "passed boolean, affected_records bigint, action string")
    agg = df.agg(*[F.sum(as_flag(r.predicate(df))).cast("bigint").alias(f"c{i}") for i, r in enumerate(rules)])
    items = [F.struct(F.lit(r.name).alias("rule_name"), F.lit(r.rule_type).alias("rule_type"),
                      F.coalesce(F.col(f"c{i}"), F.lit(0)).alias("n"), F.lit(r.action).alias("act"),
                      F.lit(r.emit_when_clean).alias("always"))
             for i, r in enumerate(rules)]
    ex = agg.select(F.explode(F.array(*items)).alias("r")).select("r.*")
    return (ex.where((F.col("n") > 0) | F.col("always"))
            .select(F.lit(processor).alias("processor"), F.lit(step).alias("step"), "rule_name", "rule_type",
                    (F.col("n") == 0).alias("passed"), F.col("n").alias("affected_records"),
                    F.when(F.col("n") > 0, F.col("act")).otherwise(F.lit("none")).alias("action")))


# ---- reference rule sets (FIXED VALUES: names, types, limits) -----------------

def train_business_rules(min_delay: int = -5, max_delay: int = 300) -> list[Rule]:
    return [
        Rule("extreme_early_delay", "business", lambda d: F.col("delay_minutes") < min_delay,
             "transform", column="delay_minutes", flag="delay_anomaly", requires=("delay_minutes",)),
        # evaluated after the first rule has nulled its rows; the ranges are disjoint
        Rule("extreme_delay_outlier", "business", lambda d: F.col("delay_minutes") > max_delay,
             "flag", flag="delay_outlier", requires=("delay_minutes",)),
    ]


def weather_business_rules(tmin: float = -20.0, tmax: float = 50.0, pmin: float = 0.0) -> list[Rule]:
    rules = [
        Rule("temperature_range_validation", "range",
             lambda d: (F.col("temperature") < tmin) | (F.col("temperature") > tmax),
             "transform", column="temperature", flag="temp_range_violation", requires=("temperature",)),
    ]
    for fld in ("precipitation", "precip_mm"):
        rules.append(Rule(f"{fld}_range_validation", "range", (lambda f: lambda d: F.col(f) < pmin)(fld),
                          "transform", column=fld, flag="precip_range_violation", requires=(fld,)))
    return rules


def weather_extended_rules() -> list[Rule]:
    """Configured limits never enforced by default (G4): precip <= 500,
    wind 0..200, weather code 0..99. Off unless passed explicitly."""
    return [
        Rule("precip_max_validation", "range", lambda d: F.col("precip_mm") > 500.0,
             "transform", column="precip_mm", flag="precip_range_violation", requires=("precip_mm",)),
        Rule("wind_speed_range_validation", "range",
             lambda d: (F.col("wind_speed") < 0.0) | (F.col("wind_speed") > 200.0),
             "transform", column="wind_speed", flag="wind_range_violation", requires=("wind_speed",)),
        Rule("weather_code_range_validation", "range",
             lambda d: (F.col("weather_code") < 0) | (F.col("weather_code") > 99),
             "transform", column="weather_code", flag="code_range_violation", requires=("weather_code",)),
    ]
