"""Idempotent table writes and load planning.

Writes are Spark file writes into shared storage (Parquet / JSON / CSV),
partitioned by date or station so re-runs replace or skip whole partitions;
the "what to write" parts are joins (anti / full outer) over the target.
"""

from __future__ import annotations

import re
from typing import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from trackcast.config import INTEGRATED_COLUMNS, TRAIN_COLUMNS, WEATHER_COLUMNS
from trackcast.operators.attach import attach_one_row

# Text timestamps of landed files keep microseconds (the writers' default
# format stops at milliseconds and would truncate event times).
TS_TEXT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
TS_OPTIONS = {"timestampNTZFormat": TS_TEXT, "timestampFormat": TS_TEXT}


def project_existing(df: DataFrame, target: Sequence[str]) -> DataFrame:
    """Keep the target columns that exist, in target order."""
    return df.select(*[c for c in target if c in df.columns])


def require_columns(df: DataFrame, required: Sequence[str]) -> list[str]:
    """The required columns missing from ``df`` (plan-time check)."""
    return [c for c in required if c not in df.columns]


def with_date(df: DataFrame, ts: str = "timestamp", name: str = "date") -> DataFrame:
    return df.withColumn(name, F.date_format(ts, "yyyy-MM-dd"))


def append_trains(df: DataFrame) -> DataFrame:
    """B1 frame: the 11 train columns plus the ``date`` partition column;
    refuses a frame without the required columns (an empty frame writes nothing)."""
    missing = require_columns(df, ("train_id", "timestamp", "station_code"))
    if missing:
        raise ValueError(f"missing required columns: {missing}")
    return with_date(project_existing(df, TRAIN_COLUMNS))


def write_partitioned(df: DataFrame, path: str, *, partition_by: Sequence[str], fmt: str = "parquet",
                      mode: str = "append", header: bool = True) -> None:
    """Write ``df`` under ``path``; with ``mode='overwrite'`` only the
    partitions present in ``df`` are replaced (dynamic partition overwrite)."""
    w = df.write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by).format(fmt)
    if fmt in ("csv", "json"):
        w = w.options(**TS_OPTIONS)
    if fmt == "csv":
        w = w.option("header", header)
    w.save(path)


def stored_partitions(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """The stored partitions of ``path`` as distinct text values of ``columns``, from the names of the folders that hold files:
    Spark lists the files and only their paths are selected, so no data file is opened. Empty before the first write."""
    try:
        files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], StructType([StructField(c, StringType()) for c in columns]))

    def value(column: str):
        text = F.regexp_extract("path", f"/{re.escape(column)}=([^/]*)/", 1)
        name = F.url_decode(F.replace(text, F.lit("+"), F.lit("%2B")))  # special characters of a value are escaped in its folder's name
        return F.when(text != "__HIVE_DEFAULT_PARTITION__", name).alias(column)

    return files.select(*[value(c) for c in columns]).distinct()


def write_absent_partitions(df: DataFrame, path: str, *, partition_by: Sequence[str], fmt: str = "csv") -> None:
    """Writes only the partitions that have no file yet (the reference skips a curated file that exists).

    Stored partitions are read from folder names; a partition is written whole in one job, so it is there or it is not."""
    stored = stored_partitions(df.sparkSession, path, partition_by)
    stored = stored.select(*[F.col(c).cast(df.schema[c].dataType).alias(f"_{c}") for c in partition_by])
    same = [df[c].eqNullSafe(stored[f"_{c}"]) for c in partition_by]
    write_partitioned(df.join(stored, same, "left_anti"), path, partition_by=partition_by, fmt=fmt)


def read_if_exists(spark: SparkSession, path: str, schema: StructType, fmt: str = "parquet") -> DataFrame:
    """A stored table, or an empty frame of its schema before the first write.

    Only a missing path counts as "not written yet"; any other failure is raised."""
    try:
        return spark.read.schema(schema).option("header", True).format(fmt).load(path)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], schema)
        raise


def insert_if_absent(new: DataFrame, existing: DataFrame, keys: Sequence[str], order_by: str) -> DataFrame:
    """B2: rows of ``new`` whose key is not in ``existing`` (the stored row
    wins); within the batch the first row per key (smallest ``order_by``)."""
    first = (new.groupBy(*keys).agg(F.min_by(F.struct(*new.columns), F.col(order_by)).alias("_r")).select("_r.*"))
    return first.join(existing.select(*keys), list(keys), "left_anti")


def upsert(new: DataFrame, existing: DataFrame, key: str, *, overwrite: Sequence[str] = (),
           coalesce_new_first: Sequence[str] = ()) -> DataFrame:
    """Full snapshot after insert-or-update on ``key``: ``overwrite``
    columns take the new value, ``coalesce_new_first`` take
    ``coalesce(new, old)``, the rest keep the old value."""
    n = new.alias("n")
    o = existing.alias("o")
    j = o.join(n, F.col(f"o.{key}") == F.col(f"n.{key}"), "full_outer")
    cols = [F.coalesce(F.col(f"n.{key}"), F.col(f"o.{key}")).alias(key)]
    for c in existing.columns:
        if c == key:
            continue
        if c in overwrite:
            cols.append(F.when(F.col(f"n.{key}").isNotNull(), F.col(f"n.{c}")).otherwise(F.col(f"o.{c}")).alias(c))
        elif c in coalesce_new_first:
            cols.append(F.coalesce(F.col(f"n.{c}"), F.col(f"o.{c}")).alias(c))
        else:
            cols.append(F.col(f"o.{c}").alias(c))
    return j.select(*cols)


def land_raw(df: DataFrame) -> DataFrame:
    """B5 frame: one JSON document per row, partitioned by date and station."""
    return with_date(df).select("date", "station_code",
                                F.to_json(F.struct(*df.columns), TS_OPTIONS).alias("payload"))


def curated_weather(df: DataFrame) -> DataFrame:
    """B6 frame: curated weather rows with the ``year`` partition column."""
    return project_existing(df, WEATHER_COLUMNS).withColumn("year", F.year("timestamp"))


def loaded_dates(target: DataFrame, ts: str = "timestamp") -> DataFrame:
    return target.select(F.to_date(ts).alias("date")).distinct()


def skip_loaded_dates(new: DataFrame, target: DataFrame, ts: str = "timestamp") -> DataFrame:
    """The dates of ``new`` that have no row in ``target`` (any row in the
    target means the whole date is skipped)."""
    dates = new.select(F.to_date(ts).alias("date")).distinct()
    return dates.join(loaded_dates(target, ts), "date", "left_anti")


def plan_date_chunks(bounds: DataFrame, days: int) -> DataFrame:
    """``bounds`` has one row (start_date, end_date); chunks of ``days``
    days, the last one short."""
    step = F.expr(f"interval {int(days)} days")
    return (bounds.select(F.explode(F.sequence("start_date", "end_date", step)).alias("chunk_start"), "end_date")
                  .select("chunk_start", F.least(F.date_add("chunk_start", int(days) - 1), F.col("end_date"))
                          .alias("chunk_end")))


def skip_loaded_range(bounds: DataFrame, target: DataFrame, days: int, ts: str = "timestamp") -> DataFrame:
    """Per chunk of B10, the target rows inside it, their min/max date and
    the skip decision (any row skips the chunk). Each target date maps to its
    chunk by arithmetic, so the chunk table meets the data in an equi-join."""
    n = int(days)
    chunks = plan_date_chunks(bounds, n)
    start = bounds.select(F.col("start_date").alias("_s"))
    per_date = target.groupBy(F.to_date(ts).alias("d")).agg(F.count(F.lit(1)).alias("n"))
    k = F.floor(F.datediff(F.col("d"), F.col("_s")) / n).cast("int")
    per_chunk = (attach_one_row(per_date, start)  # one-row frame of the range start
                 .withColumn("chunk_start", F.date_add(F.col("_s"), k * n))
                 .groupBy("chunk_start").agg(F.sum("n").alias("n"), F.min("d").alias("min_date"),
                                             F.max("d").alias("max_date")))
    return (chunks.join(per_chunk, "chunk_start", "left")
                  .select("chunk_start", "chunk_end", F.coalesce("n", F.lit(0)).cast("bigint").alias("record_count"),
                          "min_date", "max_date", (F.coalesce("n", F.lit(0)) > 0).alias("skip")))


TARGETS = {"trains": TRAIN_COLUMNS, "weather": WEATHER_COLUMNS, "integrated": INTEGRATED_COLUMNS}
