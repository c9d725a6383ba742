"""Operator 12: importance resampling towards a target distribution.

Texts are byte strings all the way: a table of 256 bytes lower-cases A-Z and blanks everything that is not a word byte
(0-9, a-z, anything above ASCII), ``bytes.split`` yields the words. A feature's hash is ``zlib.crc32``; a pair's is chained, the first
word's checksum seeding the blank and that seeding the second word, so no pair is ever spelled out. Hashes go to a fixed
number of buckets; each task reduces its texts to one ``Counter`` of buckets, so a task sends at most one row per bucket to the
shuffle whatever it read.

The two tables of counts (raw and target) give every bucket an integer gain, a table of that fixed size. A second pass averages
the gains of a document's features and adds Gumbel noise from a hash of its id; the highest scores are the draw. Their ranks
come from a sort by ranges: each range is sorted by itself, and starts where the rows of the ranges before it
end. No task holds more than its range.
"""

from __future__ import annotations

import math
from collections import Counter
from hashlib import sha256
from itertools import repeat
from typing import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trackcast.llm.common import CHUNK, WorkTables, narrow

#: What a byte becomes: A-Z lower case, ASCII that is no letter or digit a blank.
TABLE = bytes(b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else 0x20
              for b in range(256))


def word_lists(text: bytes) -> Iterator[list[bytes]]:
    """The words of a text, in lists of about CHUNK bytes, so that a very long text is never a list of words as a whole."""
    text = text.translate(TABLE)
    at = 0
    while at < len(text):
        end = text.find(b" ", at + CHUNK) if len(text) - at > CHUNK else -1
        end = len(text) if end < 0 else end
        yield text[at:end].split()
        at = end


def feature_lists(text: bytes) -> Iterator[tuple[int, np.ndarray]]:
    """(words, hashes of their features) of each list of words; a pair across two lists belongs to the later one."""
    before = None
    for words in word_lists(text):
        if not words:
            continue
        ones = list(map(crc32, words))
        seeds, seconds = (ones, words[1:]) if before is None else ([before, *ones], words)
        hashes = np.fromiter(ones, np.uint32, len(ones))
        pairs = np.fromiter(map(crc32, seconds, map(crc32, repeat(b" "), seeds)), np.uint32, len(seconds))
        before = ones[-1]
        yield len(words), np.concatenate([hashes, pairs])


def _tally(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = Counter()
        for batch in batches:
            for text in batch.column(0):
                for _, hashes in feature_lists(text.as_py().encode("utf-8")):
                    total.update((hashes % buckets).tolist())
        yield pa.RecordBatch.from_arrays([pa.array(list(total.keys()), pa.int64()), pa.array(list(total.values()), pa.int64())],
                                         names=["bucket", "n"])
    return run


def bucket_counts(texts: DataFrame, buckets: int) -> list[int]:
    """Features of all texts (one string column without nulls) by bucket; ``buckets`` numbers, whatever the input."""
    sums = texts.mapInArrow(_tally(buckets), "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = [0] * buckets
    for bucket, n in sums.collect():  # at most ``buckets`` rows
        out[bucket] = n
    return out


def bucket_gains(raw: list[int], target: list[int]) -> np.ndarray:
    """floor(1000 ln) of each bucket's add-one share of the target over that of the raw documents."""
    size = len(raw)
    S, T = float(sum(raw) + size), float(sum(target) + size)
    return np.array([math.floor(1000 * math.log(((t + 1) * S) / ((s + 1) * T))) for s, t in zip(raw, target)], np.int64)


def noise(seed: int, key) -> int:
    """floor(1000 Gumbel) drawn by a hash of the key."""
    h = int(sha256(f"{seed}:{'' if key is None else key}".encode("utf-8")).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def _score(gains: np.ndarray, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, features, weight, score = [], [], [], []
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                n_words = n = total = 0
                for k, hashes in feature_lists(text.as_py().encode("utf-8")):
                    n_words += k
                    n += len(hashes)
                    total += int(gains[hashes % len(gains)].sum())
                words.append(n_words)
                features.append(n)
                weight.append(total // n if n else 0)
                score.append(weight[-1] + noise(seed, key))
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(x, pa.int64()) for x in (words, features, weight, score))],
                                             names=["id", "n_words", "n_features", "weight", "score"])
    return run


def ranked(rows: DataFrame, order: list, work: WorkTables) -> tuple[DataFrame, int]:
    """``rows`` with their place (from 1) in the order, and their number.

    Rows are dealt by ranges of the order and sorted within; only the number of rows of each range reaches the driver (at most
    ``spark.sql.shuffle.partitions`` numbers).
    """
    at = F.monotonically_increasing_id()
    cut = work.put("ranges", rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("at", at)
                   .withColumn("range", F.shiftright("at", 33)).withColumn("at", F.col("at").bitwiseAND(F.lit((1 << 33) - 1))))
    sizes = sorted(cut.groupBy("range").agg(F.count(F.lit(1)).alias("n")).collect())
    starts, total = [], 0
    for k, n in sizes:
        starts.append((k, total))
        total += n
    first = rows.sparkSession.createDataFrame(starts, "range long, first long")
    return cut.join(F.broadcast(first), "range").withColumn("rank", F.col("first") + F.col("at") + 1).drop("range", "first", "at"), total


def importance_resample(docs: DataFrame, target: DataFrame, *, buckets: int = 10_000, percent: int = 25, min_words: int = 20,
                        seed: int = 7, id_col: str = "doc_id", text_col: str = "text", target_text_col: str = "text") -> DataFrame:
    """One row per input row: id, n_features, weight, score and rank (1, 2, 3 ... of the documents drawn, highest score
    first, else null), all but the id long.

    Drawn are floor(``percent`` * N / 100) of the N documents with at least ``min_words`` words; of equal scores the smaller id
    goes first, null ids last. Defined results: a null or empty text, or one without words, has no features and weight 0; an empty target leaves
    every bucket its add-one share; a null id draws its noise from an empty name; rows that repeat an id are
    rows of their own (equal noise, places next to one another in an order fixed by the written scores); an empty table gives an empty
    result; extra columns are ignored. Texts of any length are treated whole.
    """
    work = WorkTables(docs.sparkSession, "importance")
    rows = narrow(docs, id_col, text_col).toDF("id", "text").select("id", F.coalesce("text", F.lit("")).alias("text"))
    texts = narrow(target, target_text_col).toDF("text").select(F.coalesce("text", F.lit("")).alias("text"))
    gains = bucket_gains(bucket_counts(rows.select("text"), buckets), bucket_counts(texts, buckets))
    kind = dict(rows.dtypes)["id"]
    scored = work.put("scored", rows.mapInArrow(
        _score(gains, seed), f"id {kind}, n_words long, n_features long, weight long, score long")
        .withColumn("place", F.monotonically_increasing_id()))
    able = F.col("n_words") >= min_words
    drawn, total = ranked(scored.filter(able), [F.desc("score"), F.asc_nulls_last("id"), F.asc("place")], work)
    rank = F.when(F.col("rank") <= percent * total // 100, F.col("rank"))
    out = ["id", "n_features", "weight", "score"]
    return (drawn.select(*out, rank.alias("rank")).unionByName(scored.filter(~able).select(*out, F.lit(None).cast("long").alias("rank")))
            .withColumnRenamed("id", id_col))
