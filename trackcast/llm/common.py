"""Helpers shared by the operators: reading tables, work tables, word pattern, hashing of numpy arrays."""

from __future__ import annotations

from contextlib import contextmanager
from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trackcast.session import drop_path, new_work_dir

#: Words are runs of anything but the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"

#: Bytes of text that numpy works on at a time.
CHUNK = 1 << 18

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table, by Spark's own reader (any store Spark can reach)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


@contextmanager
def shuffle_files_freed(spark: SparkSession):
    """Within this block, a finished write gives its shuffle files back at
    once instead of when the driver happens to collect garbage."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)


class WorkTables:
    """Lineage cuts of one operator run: each is a Parquet table in a new
    folder of the shared checkpoint folder, so it survives lost executors.

    ``put`` writes and rereads; ``drop`` deletes a table nothing reads any more.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.name, self.at = spark, name, {}

    def put(self, key: str, df: DataFrame) -> DataFrame:
        path = new_work_dir(self.spark, f"{self.name}-{key}")
        with shuffle_files_freed(self.spark):
            frozen(df).write.parquet(path)
        self.at[key] = path
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *keys: str) -> None:
        for key in keys:
            drop_path(self.spark, self.at.pop(key))


def frozen(df: DataFrame) -> DataFrame:
    """The same plan under the session's current settings (a DataFrame keeps
    those it was first analysed with for its own execution)."""
    return df.select("*")


def narrow(df: DataFrame, *cols: str) -> DataFrame:
    """Only the named columns; extra columns of the input, whatever they are
    called, never reach the operator."""
    return df.select(*[F.col(f"`{c}`") for c in cols])


def hex_sha256(text) -> "F.Column":
    """Lowercase hex SHA-256 of a string column's UTF-8 bytes."""
    return F.sha2(F.col(text) if isinstance(text, str) else text, 256)


_M1, _M2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)


def sliding_min(key: np.ndarray, width: int) -> np.ndarray:
    """Smallest value of each window, by block prefix and suffix minima."""
    out = len(key) - width + 1
    k = np.concatenate([key, np.full(-len(key) % width, np.iinfo(np.uint64).max, np.uint64)]).reshape(-1, width)
    pre = np.minimum.accumulate(k, axis=1).ravel()
    suf = np.minimum.accumulate(k[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(suf[:out], pre[width - 1:width - 1 + out])


def ranges(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """first[0], first[0] + 1, ... (count[0] of them), first[1], ..."""
    total = int(count.sum())
    begin = np.repeat(first - np.concatenate([[0], np.cumsum(count)[:-1]]), count)
    return begin + np.arange(total)


def with_row_key(docs: DataFrame, id_col: str, text_col: str, work: WorkTables) -> DataFrame:
    """(key, id, text) with a long key of its own for every row; a null text becomes empty."""
    rows, key = numbered_rows(narrow(docs, id_col, text_col).toDF("id", "text"), "id", work)
    return rows.select(F.col(key).alias("key"), "id", F.coalesce("text", F.lit("")).alias("text"))


def numbered_rows(docs: DataFrame, id_col: str, work: WorkTables) -> tuple[DataFrame, str]:
    """The input with a further long column, by a name it does not have, that differs in every row.

    It is the id where ids are whole numbers, present and unique. Otherwise the rows are numbered
    once and written, so that every later read sees the same numbers.
    """
    name = "row_key"
    while name.lower() in {c.lower() for c in docs.columns}:
        name += "_"
    ids = narrow(docs, id_col).toDF("id")
    if dict(ids.dtypes)["id"] in ("bigint", "int", "smallint", "tinyint"):
        odd = ids.groupBy("id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1 or id is null")
        if odd.isEmpty():
            return docs.withColumn(name, F.col(f"`{id_col}`").cast("long")), name
    return work.put("numbered", docs.withColumn(name, F.monotonically_increasing_id())), name


def at_places(rows: DataFrame, places: DataFrame, *fields: str) -> DataFrame:
    """Rows (key, text) that have places, with those as an array of structs.

    ``places`` (key, fields) are positions within one text, so a text's own
    length bounds the array. The texts without places leave at the join.
    """
    lists = places.groupBy("key").agg(F.collect_list(F.struct(*fields)).alias("places"))
    return rows.select("key", "text").join(lists, "key")


def list_fields(column, *fields: str) -> tuple[np.ndarray, dict[str, np.ndarray]]:
    """Of an Arrow list<struct> column: entries per row, and each field of all entries as an array."""
    import pyarrow.compute as pc
    flat = column.flatten()
    return (pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False),
            {f: flat.field(f).to_numpy(zero_copy_only=False) for f in fields})


_L = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93))


def pair_name(a: np.ndarray, b: np.ndarray, lane: int) -> np.ndarray:
    """64-bit name of a pair of names; the two lanes together name it with 128 bits."""
    h = a * _L[lane]
    h += b
    h ^= h >> np.uint64(32)
    h *= _M1 if lane == 0 else _M2
    h ^= h >> np.uint64(29)
    return h


def text_groups(batches: Iterator[pa.RecordBatch], text_at: int, rows: int = 512):
    """Slices of record batches of about CHUNK bytes of text (at least one row)."""
    for whole in batches:
        at = 0
        while at < whole.num_rows:
            part = whole.slice(at, rows)
            texts, size = [], 0
            for t in part.column(text_at):
                texts.append(t.as_py().encode("utf-8"))
                size += len(texts[-1])
                if size >= CHUNK:
                    break
            yield whole.slice(at, len(texts)), texts
            at += len(texts)


def covered(n: int, first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Which of n places lie in one of the ranges [first, first + count)."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, np.minimum(first, n), 1)
    np.add.at(edge, np.minimum(first + count, n), -1)
    return np.cumsum(edge[:n]) > 0
