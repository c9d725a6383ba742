"""Structured Streaming forms of the batch operators.

Landed files are a file stream with a checkpoint, so each file is taken
exactly once, ``trigger(availableNow=True)`` drains what has landed and
stops, and a rerun adds nothing. No job drops late rows: closed dates may
land in any order and in any number of files, so nothing depends on an
event-time watermark. What a micro-batch contributes is combined before it is
written (first row per key, hourly counters), under the batch's own id, so a
batch replayed after a failure replaces its own output. When a drain has
ended, the new contributions are folded into the store (X2, X4): the parts
they touch (dates, or ranges of the key's hash) are merged by the batch operator and
written as the next fold, under the id of the last batch in it; then the
contributions and the parts it replaces are deleted. A fold counts once its success marker is there, and a batch at or below the last fold's id is never
read again, so every batch is in the store exactly once whatever failed, and the store has one row per key however many
runs made it. State therefore lives in shared tables, not in executors.
"""

from __future__ import annotations

import datetime as dt
from typing import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from trackcast.session import drop_path
from trackcast.sources.sinks import TS_OPTIONS, insert_if_absent, read_if_exists, stored_partitions, with_date

#: Last batches of both sides that a run of X3 has finished.
_MARKS = StructType([StructField("left", LongType()), StructField("right", LongType())])


def land_json(df: DataFrame, path: str, *, partition_by: Sequence[str] = ("date",)) -> None:
    """Land rows as JSON files in a new folder, one folder per partition value."""
    out = with_date(df) if "date" not in df.columns else df
    out.write.options(**TS_OPTIONS).partitionBy(*partition_by).json(path)


def file_stream(spark: SparkSession, path: str, schema: StructType, *, files_per_batch: int | None = None) -> DataFrame:
    """Landed JSON files as a stream; all that has landed is one micro-batch unless ``files_per_batch`` is given."""
    s = spark.readStream.schema(schema).option("recursiveFileLookup", "true").options(**TS_OPTIONS)
    if files_per_batch:
        s = s.option("maxFilesPerTrigger", files_per_batch)
    return s.json(path)


def _drain(stream: DataFrame, each_batch: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    q = (stream.writeStream.foreachBatch(each_batch).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception():
        raise q.exception()


def _to_store(store: str, make: Callable[[DataFrame], DataFrame], partition_by: Sequence[str] = ()):
    """Each micro-batch's contribution as the folder ``batch=<id>`` of the store (a replay replaces it)."""
    def write(batch: DataFrame, batch_id: int) -> None:
        make(batch).write.mode("overwrite").partitionBy(*partition_by).parquet(f"{store}/batch={batch_id:012d}")
    return write


#: Columns that a store adds to its rows.
STORED = ("batch", "fold", "part")
PARTS = 32


def _exists(spark: SparkSession, path: str) -> bool:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def _folds(spark: SparkSession, store: str) -> tuple[dict[str, str], list[tuple[str, str]], int]:
    """The fold that holds each part, what is stored beside that (replaced or never finished), and the last batch folded."""
    stored = sorted(tuple(r) for r in stored_partitions(spark, store, ("fold", "part")).collect())  # parts: a bounded calendar
    done = {fold for fold in {f for f, _ in stored} if _exists(spark, f"{store}/fold={fold}/_SUCCESS")}
    current = {part: fold for fold, part in stored if fold in done}
    rest = [(f, p) for f, p in stored if current.get(p) != f]
    return current, rest, max([int(f) for f in done], default=-1)


def _fold(spark: SparkSession, store: str, merge: Callable[[DataFrame], DataFrame], rows_schema: StructType) -> None:
    """The new contributions merged into the parts they touch; nothing else is read or written."""
    new = f"{store}-new"
    current, rest, last = _folds(spark, store)
    for fold, part in rest:
        drop_path(spark, f"{store}/fold={fold}/part={part}")
    batches = sorted(tuple(r) for r in stored_partitions(spark, new, ("batch", "part")).collect())
    fresh = [(b, p) for b, p in batches if int(b) > last]
    if fresh:
        upto, parts = fresh[-1][0], sorted({p for _, p in fresh})
        schema = StructType([*rows_schema.fields, *[StructField(c, StringType()) for c in ("batch", "part")]])
        added = spark.read.schema(schema).parquet(new).where((F.col("batch") > f"{last:012d}" if last >= 0 else F.lit(True)) & F.col("part").isin(parts))
        held = [f"{current[p]}/{p}" for p in parts if p in current]
        rows = added.drop("batch")
        if held:
            schema = StructType([*rows_schema.fields, *[StructField(c, StringType()) for c in ("fold", "part")]])
            before = spark.read.schema(schema).parquet(store).where(F.concat_ws("/", "fold", "part").isin(held))
            rows = before.drop("fold").unionByName(rows)
        merge(rows).write.mode("overwrite").partitionBy("part").parquet(f"{store}/fold={upto}")
        for p in parts:
            if p in current:
                drop_path(spark, f"{store}/fold={current[p]}/part={p}")
    for b in {b for b, _ in batches}:
        drop_path(spark, f"{new}/batch={b}")


def folded(spark: SparkSession, store: str) -> DataFrame:
    """The rows of a store, whatever a run that ended early has left beside them."""
    current, _, _ = _folds(spark, store)
    return (spark.read.option("basePath", store).parquet(*[f"{store}/fold={fold}/part={part}" for part, fold in sorted(current.items())])
            .drop(*STORED))


def incremental_ingest(spark: SparkSession, landing: str, target: str, checkpoint: str, schema: StructType,
                       keys: Sequence[str], order_by: str, normalize=lambda b: b, *, ts: str = "timestamp",
                       files_per_batch: int | None = None) -> None:
    """New landed rows (after ``normalize``) inserted into ``target``
    unless their key is stored (insert-if-absent per micro-batch, B2).

    The target is partitioned by date, and a micro-batch reads only the
    dates it touches (a key holds its timestamp, so it cannot be stored elsewhere).
    """
    def insert(batch: DataFrame, batch_id: int) -> None:
        new = with_date(normalize(batch), ts)
        stored = read_if_exists(spark, target, StructType(list(new.schema.fields)))
        dates = [r["date"] for r in new.select("date").distinct().collect()]  # the days of one micro-batch
        seen = stored.where(F.col("date").isin(dates))
        insert_if_absent(new, seen, keys, order_by).write.mode("append").partitionBy("date").parquet(target)

    _drain(file_stream(spark, landing, schema, files_per_batch=files_per_batch), insert, checkpoint)


def stream_dedup(spark: SparkSession, landing: str, store: str, checkpoint: str, schema: StructType,
                 keys: Sequence[str], order_by: str, prepare=lambda d: d, *, ts: str = "timestamp",
                 files_per_batch: int | None = None) -> None:
    """The first row per key (smallest ``order_by``) of all landed rows, one row per key in ``store``.

    Parts are dates if the key holds the time, so a run touches only the dates of its rows, else ranges of the key's hash."""
    part = (F.coalesce(F.date_format(ts, "yyyy-MM-dd"), F.lit("none")) if ts in keys
            else F.pmod(F.xxhash64(*keys), F.lit(PARTS)).cast("string"))

    def first(rows: DataFrame) -> DataFrame:
        return first_arrivals(rows, keys, order_by).withColumn("part", part)

    _drain(file_stream(spark, landing, schema, files_per_batch=files_per_batch),
           _to_store(f"{store}-new", lambda b: first(prepare(b)), ("part",)), checkpoint)
    _fold(spark, store, first, prepare(spark.createDataFrame([], schema)).schema)


def first_arrivals(rows: DataFrame, keys: Sequence[str], order_by: str) -> DataFrame:
    """One row per key: the one with the smallest ``order_by`` (combined map-side)."""
    cols = [c for c in rows.columns if c not in STORED]
    return rows.groupBy(*keys).agg(F.min_by(F.struct(*cols), F.col(order_by)).alias("_r")).select("_r.*")


def stream_store(spark: SparkSession, landing: str, store: str, checkpoint: str, schema: StructType, *,
                 ts: str = "timestamp", files_per_batch: int | None = None) -> None:
    """X3, one side: landed rows into a store partitioned by micro-batch and date."""
    _drain(file_stream(spark, landing, schema, files_per_batch=files_per_batch),
           _to_store(store, lambda b: with_date(b, ts), ("date",)), checkpoint)


def _last_batch(spark: SparkSession, store: str) -> int:
    return max((int(r["batch"]) for r in stored_partitions(spark, store, ("batch",)).collect()), default=-1)


def finish_nearest(spark: SparkSession, left_store: str, right_store: str, target: str, *, since_left: int | None = None,
                   since_right: int | None = None, right_cols: Sequence[str], tolerance_minutes: int = 60) -> list[str]:
    """X3, closing: the nearest match of every date that new micro-batches
    touch, a right row touching its own and the two neighbouring dates. Each
    such date is matched whole and replaces its partition of ``target``, so the
    result does not depend on the order of arrival or on which side came first. Returns the dates matched.

    New are the batches above ``since_*``; where that is not given, above those of the last finished run, which are kept in
    ``<target>-finished`` (written after the output, so a run that ended between does its dates again). Dates are
    filters on partition columns: only the folders of the touched dates and their neighbours are read.
    """
    from trackcast.operators.nearest import nearest_join
    marks = f"{target}-finished"
    upto = {"left": _last_batch(spark, left_store), "right": _last_batch(spark, right_store)}
    done = read_if_exists(spark, marks, _MARKS).agg(F.max("left").alias("left"), F.max("right").alias("right")).first()
    since = {k: given if given is not None else -1 if done[k] is None else done[k]
             for k, given in (("left", since_left), ("right", since_right))}
    left, right = spark.read.parquet(left_store), spark.read.parquet(right_store)

    def dates_of(side: DataFrame, after: int, last: int) -> set[dt.date]:  # a bounded calendar
        rows = side.where((F.col("batch") > after) & (F.col("batch") <= last)).select(F.to_date("date").alias("d")).distinct()
        return {r["d"] for r in rows.collect() if r["d"] is not None}

    def around(dates: set[dt.date]) -> set[dt.date]:
        return {d + dt.timedelta(days=k) for d in dates for k in (-1, 0, 1)}

    new_left, new_right = dates_of(left, since["left"], upto["left"]), dates_of(right, since["right"], upto["right"])
    touched = new_left | around(new_right)
    text = lambda dates: sorted(d.isoformat() for d in dates)
    day = F.date_format(F.to_date("date"), "yyyy-MM-dd")
    if touched:
        rows = left.where(day.isin(text(touched))).drop("batch", "date")
        weather = right.where(day.isin(text(around(touched)))).drop("batch", "date")
        matched = nearest_join(rows, weather, tolerance_minutes=tolerance_minutes, right_cols=list(right_cols))
        (with_date(matched).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("date").parquet(target))
    spark.createDataFrame([(upto["left"], upto["right"])], _MARKS).coalesce(1).write.mode("append").parquet(marks)
    return text(touched)


def stream_hourly_dq(spark: SparkSession, landing: str, store: str, checkpoint: str, schema: StructType, *,
                     ts: str = "timestamp", files_per_batch: int | None = None) -> None:
    """Hourly DQ counters of all landed rows, one row per hour in ``store``, in parts by date."""
    from trackcast.functions.timefns import hour_floor

    def counters(batch: DataFrame) -> DataFrame:
        start = hour_floor(ts)
        return batch.groupBy(start.alias("window_start"), F.timestamp_add("HOUR", F.lit(1), start).alias("window_end")).agg(
            F.count(F.lit(1)).alias("rows"), F.count_if(F.col("delay_minutes").isNull()).alias("null_delays"),
            F.count_if(F.col("delay_minutes") > 5).alias("delayed"))

    def dated(rows: DataFrame) -> DataFrame:
        return rows.withColumn("part", F.coalesce(F.date_format("window_start", "yyyy-MM-dd"), F.lit("none")))

    _drain(file_stream(spark, landing, schema, files_per_batch=files_per_batch),
           _to_store(f"{store}-new", lambda b: dated(counters(b)), ("part",)), checkpoint)
    _fold(spark, store, lambda rows: dated(window_totals(rows)), counters(spark.createDataFrame([], schema)).schema)


def window_totals(contributions: DataFrame) -> DataFrame:
    """Counters per hour over contributions."""
    return contributions.groupBy("window_start", "window_end").agg(
        *[F.sum(c).alias(c) for c in ("rows", "null_delays", "delayed")])
