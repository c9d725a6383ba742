"""Operator 2: repeated word sequences by fixed-block anchors.

Every document's words are cut into non-overlapping blocks of half a window (25 words); any window
of 50 words holds at least one whole block of its document. The blocks of smaller documents are the index; every rolling 25-word
window of a document probes it. A hit is extended to the maximal exact repeat around it:

* first by the whole neighbourhood: the 25 windows whose first block is this one span up to 74 words;
  where a smaller document's block has the same neighbourhood, all of them are repeats;
* the hits left are near the ends of a repeat: their windows are compared one by one with the windows
  around the same block in the index, of which each distinct neighbourhood is kept once (smallest document).

Most text repeats nowhere, so most probes would be shuffled for nothing. A lossless filter goes first: the smallest
25-word name inside a 50-word window is the same wherever the window occurs, so a
run of neighbouring windows with the same smallest name can only repeat in a document that has this name too. Runs are
about 13 windows; only those whose name occurs in two documents give blocks and probes.

Names are 128 bits wide where a repeat is decided. The index and all hot buckets are
combined (smallest document) before the shuffle; joins back to hits carry no text, and Spark splits skewed ones.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trackcast.llm.common import (WorkTables, covered, list_fields, pair_name, ranges, sliding_min, text_groups,
                                  with_row_key)
from trackcast.llm.words import WordNames, gram_names


def _table(**columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(v) for v in columns.values()], names=list(columns))


def _signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def _sampled_runs(window: int):
    """(name, key, ord, start, len): runs of window starts by the smallest half-window name inside."""
    half = window // 2

    def run(batches):
        names = WordNames()
        for part, texts in text_groups(batches, 2):
            counts, lanes = names.of(texts)
            n = int(counts.sum())
            if n < window:
                continue
            base = np.cumsum(counts) - counts
            grams = gram_names(lanes, (half,), 0)[half]
            starts = ranges(base, np.maximum(counts - window + 1, 0))
            if not len(starts):
                continue
            low = sliding_min(grams, window - half + 1)[starts]
            row = np.searchsorted(base + counts, starts, side="right")
            cut = np.flatnonzero(np.concatenate([[True], (low[1:] != low[:-1]) | (row[1:] != row[:-1])]))
            size = np.diff(np.concatenate([cut, [len(starts)]]))
            key = part.column(0).to_numpy()[row[cut]]
            order = part.column(1).to_numpy()[row[cut]]
            yield _table(name=_signed(low[cut]), key=key, ord=order, start=starts[cut] - base[row[cut]],
                         len=size.astype(np.int32))
    return run


def _blocks_and_probes(window: int):
    """(b, key, ord, pos, block, probe): index blocks and rolling probes inside the candidate runs."""
    half = window // 2

    def run(batches):
        names = WordNames()
        for part, texts in text_groups(batches, 2):
            counts, lanes = names.of(texts)
            base = np.cumsum(counts) - counts
            grams = gram_names(lanes, (half,), 0)[half]
            n, f = list_fields(part.column(3), "start", "len", "probe", "ref")
            first = f["start"] + np.repeat(base, n)
            wanted = {}
            for role in ("probe", "ref"):
                on = f[role].astype(bool)
                wanted[role] = covered(len(grams), first[on], f["len"][on] + half - 1)
            row = np.repeat(np.arange(len(texts)), counts)[:len(grams)]
            block = wanted["ref"] & ((np.arange(len(grams)) - base[row]) % half == 0)
            at = np.flatnonzero(wanted["probe"] | block)
            yield _table(b=_signed(grams[at]), key=part.column(0).to_numpy()[row[at]],
                         ord=part.column(1).to_numpy()[row[at]], pos=at - base[row[at]],
                         block=block[at], probe=wanted["probe"][at])
    return run


def _neighbourhoods(window: int):
    """(b, f1, f2, key, ord, start, len, block, probe): the windows whose first block is at a place, under one name."""
    half = window // 2

    def run(batches):
        names = WordNames()
        for part, texts in text_groups(batches, 2):
            counts, lanes = names.of(texts)
            base = np.cumsum(counts) - counts
            n, f = list_fields(part.column(3), "pos", "block", "probe")
            row = np.repeat(np.arange(len(texts)), n)
            at = f["pos"] + base[row]
            lo = np.maximum(at - half + 1, base[row])
            hi = np.minimum(at, base[row] + counts[row] - window)
            ok = hi >= lo
            row, at, lo, hi = row[ok], at[ok], lo[ok], hi[ok]
            shape = ((at - lo) << 20 | (at - hi)).astype(np.uint64)
            found = []
            for lane in (0, 1):
                grams = gram_names(lanes, (half, window), lane)
                if lane == 0:
                    b = grams[half][at]
                w = grams[window]
                found.append(_signed(pair_name(w[lo], w[hi] ^ pair_name(shape, shape, lane), lane)))
            yield _table(b=_signed(b), f1=found[0], f2=found[1], key=part.column(0).to_numpy()[row],
                         ord=part.column(1).to_numpy()[row], start=lo - base[row], len=(hi - lo + 1).astype(np.int32),
                         block=f["block"][ok], probe=f["probe"][ok])
    return run


def _single_windows(window: int):
    """(w1, w2, key, ord, start, block, probe): single windows of undecided places, each start once."""
    def run(batches):
        names = WordNames()
        for part, texts in text_groups(batches, 2):
            counts, lanes = names.of(texts)
            base = np.cumsum(counts) - counts
            n, f = list_fields(part.column(3), "start", "len", "role")
            first = f["start"] + np.repeat(base, n)
            total = int(counts.sum())
            block, probe, done = (covered(total, first[f["role"] == r], f["len"][f["role"] == r]) for r in (0, 1, 2))
            probe &= ~done
            at = np.flatnonzero(block | probe)
            row = np.searchsorted(base + counts, at, side="right")
            w = [_signed(gram_names(lanes, (window,), lane)[window][at]) for lane in (0, 1)]
            yield _table(w1=w[0], w2=w[1], key=part.column(0).to_numpy()[row], ord=part.column(1).to_numpy()[row],
                         start=at - base[row], block=block[at], probe=probe[at])
    return run


def repeated_windows(rows: DataFrame, work: WorkTables, window: int) -> DataFrame:
    """(key, start, len): starts of windows of ``window`` words that also start in a row with a smaller ``ord``."""
    base = rows.select("key", "ord", "text")
    runs = work.put("runs", base.mapInArrow(_sampled_runs(window), "name long, key long, ord long, start long, len int"))
    # written first, here and below, so that the joins read plain exchanges and Spark can split hot names
    both = work.put("both", runs.groupBy("name").agg(F.min("ord").alias("lo"), F.max("ord").alias("hi")).filter("lo < hi"))
    shared = work.put("shared", runs.join(both, "name").select(
        "key", "start", "len", (F.col("ord") > F.col("lo")).alias("probe"), (F.col("ord") < F.col("hi")).alias("ref")))
    work.drop("runs", "both")

    def scan(places, fn, ddl, *fields):
        lists = places.groupBy("key").agg(F.collect_list(F.struct(*fields)).alias("places"))
        return base.join(lists, "key").select("key", "ord", "text", "places").mapInArrow(fn, ddl)

    grams = work.put("grams", scan(shared, _blocks_and_probes(window),
                                   "b long, key long, ord long, pos long, block boolean, probe boolean",
                                   "start", "len", "probe", "ref"))
    index = work.put("index", grams.filter("block").groupBy("b").agg(F.min("ord").alias("first")))
    hits = work.put("hits", grams.filter("probe").join(index, "b").filter("first < ord").select("b", "key", "ord", "pos"))
    asked = work.put("asked", hits.groupBy("b").agg(F.max("ord").alias("last")))
    useful = grams.filter("block").join(asked, "b").filter("ord < last").select("key", "pos")
    places = (hits.select("key", "pos", F.lit(False).alias("block"), F.lit(True).alias("probe"))
              .unionByName(useful.select("key", "pos", F.lit(True).alias("block"), F.lit(False).alias("probe"))))
    around = work.put("around", scan(places, _neighbourhoods(window), "b long, f1 long, f2 long, key long, ord long, "
                                     "start long, len int, block boolean, probe boolean", "pos", "block", "probe"))
    work.drop("shared", "grams", "hits", "index", "asked")

    known = work.put("known", around.filter("block").groupBy("f1", "f2").agg(F.min("ord").alias("first")))
    judged = work.put("judged", around.filter("probe").join(known, ["f1", "f2"], "left").select(
        "b", "key", "start", "len", F.coalesce(F.col("first") < F.col("ord"), F.lit(False)).alias("found")))
    spans, open_ = judged.filter("found").select("key", "start", "len"), judged.filter("not found")
    reps = (around.filter("block").groupBy("b", "f1", "f2").agg(F.min(F.struct("ord", "key", "start", "len")).alias("one"))
            .join(open_.select("b").distinct(), "b", "left_semi").select("one.key", "one.start", "one.len"))
    todo = open_.select("key", "start", "len", F.lit(1).alias("role")).unionByName(
        reps.withColumn("role", F.lit(0))).unionByName(spans.withColumn("role", F.lit(2)).join(
            open_.select("key").distinct(), "key", "left_semi"))
    single = work.put("single", scan(todo, _single_windows(window), "w1 long, w2 long, key long, ord long, start long, "
                                     "block boolean, probe boolean", "start", "len", "role"))
    first = single.filter("block").groupBy("w1", "w2").agg(F.min("ord").alias("first"))
    ends = work.put("ends", single.filter("probe").join(first, ["w1", "w2"]).filter("first < ord")
                    .select("key", "start", F.lit(1).alias("len")))
    work.drop("around", "known", "single")
    return spans.unionByName(ends)


def _keep_words(window: int):
    def run(batches):
        names = WordNames()
        for part, texts in text_groups(batches, 1):
            n, f = list_fields(part.column(2), "start", "len")
            cut = np.concatenate([[0], np.cumsum(n)])
            n_words, n_removed, kept = [], [], []
            for r, text in enumerate(texts):
                starts, ends = names.find(np.frombuffer(text, np.uint8))
                own = slice(cut[r], cut[r + 1])
                gone = covered(len(starts), f["start"][own], f["len"][own] + window - 1)
                stay = np.flatnonzero(~gone)
                n_words.append(len(starts))
                n_removed.append(len(starts) - len(stay))
                kept.append(b" ".join([text[a:b] for a, b in zip(starts[stay].tolist(), ends[stay].tolist())]))
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()),
                 pa.array(kept, pa.binary()).cast(pa.string())], names=["id", "n_words", "n_removed", "kept"])
    return run


def substring_dedup(docs: DataFrame, *, window: int = 50, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, n_words, n_removed, kept (the words that stay, joined by one space).

    Removed is every word covered by a window of ``window`` words whose sequence also starts
    in a row with a smaller id; windows are judged on the input. Defined results: a null text has no
    words; texts shorter than a window lose nothing; ids are whole numbers, as they order documents: rows
    with the same id do not make each other lose words, rows without an id neither lose words nor make others lose any; an
    empty table gives an empty result; extra columns are ignored; texts of any length are treated whole.
    """
    if window < 4 or window % 2:
        raise ValueError("window must be an even number of words, 4 or more")
    work = WorkTables(docs.sparkSession, "substring-dedup")
    rows = with_row_key(docs, id_col, text_col, work)
    kind = dict(rows.dtypes)["id"]
    if kind not in ("bigint", "int", "smallint", "tinyint"):
        raise ValueError(f"{id_col} must be a whole number, not {kind}")
    found = repeated_windows(rows.filter("id is not null").withColumn("ord", F.col("id").cast("long")), work, window)
    lists = found.groupBy("key").agg(F.collect_list(F.struct("start", "len")).alias("places"))
    none = F.from_json(F.lit("[]"), "array<struct<start:long,len:int>>")
    return (rows.join(lists, "key", "left").select("id", "text", F.coalesce("places", none).alias("places"))
            .mapInArrow(_keep_words(window), f"id {kind}, n_words long, n_removed long, kept string")
            .withColumnRenamed("id", id_col))
