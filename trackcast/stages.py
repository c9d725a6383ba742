"""Pipeline stages over the test tables, built lazily per query.

``Stages(spark, sf_dir)`` exposes the warehouse tables of the pipeline as
DataFrames: raw adapters -> cleaned trains / weather -> integrated rows ->
features -> the stored integrated table. Every attribute is a plan over the
given parquet files; nothing is collected.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from trackcast import fixtures
from trackcast.config import TRAIN_COLUMNS, WEATHER_COLUMNS
from trackcast.operators.features import STATISTIC_OF, WEATHER_FEATURES, engineer_features
from trackcast.plans import dq
from trackcast.plans.integrate import TRAIN_PART, match_weather, project_integrated
from trackcast.session import work_table


class Stages:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self._tables: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        """One reader per table per query: every stage built from it shares the
        same relation (one file listing, identical subtrees for exchange reuse)."""
        if name not in self._tables:
            self._tables[name] = fixtures.table(self.spark, self.sf_dir, name)
        return self._tables[name]

    @cached_property
    def stations(self) -> DataFrame:
        return fixtures.stations(self.spark, self.sf_dir, nation=self.table("nation"))

    @cached_property
    def trains_raw(self) -> DataFrame:
        return fixtures.trains_raw(self.spark, self.sf_dir, events=self.table("events"))

    @cached_property
    def weather_raw(self) -> DataFrame:
        return fixtures.weather_raw(self.spark, self.sf_dir, events=self.table("events"))

    @cached_property
    def trains_clean(self) -> DataFrame:
        return dq.process_train(self.trains_raw)

    @cached_property
    def weather_clean(self) -> DataFrame:
        return dq.process_weather(self.weather_raw)

    @cached_property
    def trains(self) -> DataFrame:
        """The stored trains table (B1 projection)."""
        return self.trains_clean.select(*TRAIN_COLUMNS)

    @cached_property
    def weather(self) -> DataFrame:
        """The stored weather table (B2 projection)."""
        return self.weather_clean.select(*WEATHER_COLUMNS)

    @cached_property
    def integrated(self) -> DataFrame:
        return match_weather(self.trains_clean, self.weather, matched_col="matched")

    @cached_property
    def matched_rows(self) -> DataFrame:
        """The integrated rows, matched once and written: what reads them more than once starts here."""
        return work_table(self.integrated.drop("matched"), "matched")[0]

    @cached_property
    def features(self) -> DataFrame:
        return engineer_features(self.matched_rows)

    def some_features(self, *columns: str) -> DataFrame:
        """Features over their own input: without weather among the columns they read, the cleaned trains (one row each, as
        matched); written first where a batch statistic reads them too."""
        weather = any(c in WEATHER_FEATURES for c in columns)
        if not any(c in STATISTIC_OF for c in columns):
            rows = self.integrated.drop("matched") if weather else self.trains_clean.select(*TRAIN_PART)
        else:
            rows = self.matched_rows if weather else work_table(self.trains_clean.select(*TRAIN_PART), "trains")[0]
        return engineer_features(rows, columns=columns)

    @cached_property
    def integrated_table(self) -> DataFrame:
        return project_integrated(self.features)
