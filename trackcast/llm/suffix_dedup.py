"""Operator 10: repeated byte strings by bucket-pointer refinement of suffixes.

Suffixes (byte positions) are put into buckets by their first 8 bytes, and buckets are
refined by the bucket of a later offset: two suffixes share the bucket of 16 bytes if they share
that of 8 bytes at offset 0 and at offset 8, and so on, each round reusing the buckets of the round
before (8, 16, 32, 64, 128, then the whole length from two overlapping 128s). A bucket's
identifier is a hash of the pair of identifiers it was refined from, not a rank, so tasks agree on
it without a global sort; sorting on it (Spark's shuffles) brings a bucket together.

Not every suffix is sorted. Among the suffixes that begin in a string of
``min_bytes`` bytes and whose 64-byte bucket lies inside it, the smallest bucket identifier is the
string's anchor: equal strings have equal anchors at equal distances, so all strings with one
anchor (a run of neighbouring starts, about 70) enter the sort as one row. Buckets with one
member leave. The rest is refined:

* members whose whole runs have the same bucket are repeats (the span is reported);
* of each distinct run one representative goes on, if its bucket holds another distinct run, as
  pieces of eight starts, refined by the 193 bytes common to a piece, then by the whole piece;
* pieces that are still undecided end as single starts, named by their own 200 bytes.

Counts in hot buckets are combined before the shuffle, joins back to members carry no text
and are split by Spark where skewed, and no bucket is ever collected.
"""

from __future__ import annotations

from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trackcast.llm.common import (CHUNK, WorkTables, at_places, list_fields, pair_name, ranges, sliding_min,
                                  with_row_key)

_POS = np.uint64((1 << 20) - 1)
_EIGHT = np.uint64(0x5851F42D4C957F2D)


def bucket_names(data: np.ndarray, upto: int, lane: int) -> dict[int, np.ndarray]:
    """Bucket identifiers of every position by its first 8, 16, 32 ... ``upto`` bytes."""
    x = data[:-1].astype(np.uint64) | (data[1:].astype(np.uint64) << np.uint64(8))
    x = x[:-2] | (x[2:] << np.uint64(16))
    x = x[:-4] | (x[4:] << np.uint64(32))
    names = {8: pair_name(x, _EIGHT, lane)}  # the multiplier is odd, so different bytes have different names
    h = 8
    while h < upto:
        names[2 * h] = pair_name(names[h][:-h], names[h][h:], lane)
        h *= 2
    return names


def power_below(n: int) -> int:
    return 1 << (n.bit_length() - 1)


def name_of_length(names: np.ndarray, power: int, length: int, lane: int) -> np.ndarray:
    """Identifiers by the first ``length`` bytes (power <= length < 2 * power) from those by ``power`` bytes."""
    later = length - power
    return pair_name(names[:len(names) - later], names[later:], lane)


def _run_name(at_first, at_last, shape, lane):
    return pair_name(at_first, at_last ^ pair_name(shape, shape, lane), lane)


_RUN = pa.schema([("k1", pa.int64()), ("f1", pa.int64()), ("f2", pa.int64()), ("key", pa.int64()),
                  ("start", pa.int64()), ("len", pa.int32()), ("back", pa.int32())])


def _anchor_runs(length: int):
    power = power_below(length)
    gram = power // 2
    width = length - gram + 1

    def chunk(pieces: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
        data = np.frombuffer(b"".join(p[2] for p in pieces), np.uint8)
        sizes = np.array([len(p[2]) for p in pieces])
        base = np.cumsum(sizes) - sizes
        starts = ranges(base, sizes - length + 1)
        whole = []
        for lane in (0, 1):
            names = bucket_names(data, power, lane)
            if lane == 0:
                g = names[gram]
            whole.append(name_of_length(names[power], power, length, lane))
        anchor = (sliding_min((g & ~_POS) | np.arange(len(g), dtype=np.uint64), width) & _POS).astype(np.int64)[starts]
        cut = np.flatnonzero(np.concatenate([[True], anchor[1:] != anchor[:-1]]))
        end = np.concatenate([cut[1:], [len(starts)]]) - 1
        lo, hi, m = starts[cut], starts[end], anchor[cut]
        shape = ((hi - lo) << 20 | (m - lo)).astype(np.uint64)
        piece = np.searchsorted(base, lo, side="right") - 1
        key = np.array([p[0] for p in pieces], np.int64)[piece]
        offset = np.array([p[1] for p in pieces], np.int64)[piece]
        f = [_run_name(n[lo], n[hi], shape, lane).view(np.int64) for lane, n in enumerate(whole)]
        return pa.RecordBatch.from_arrays(
            [pa.array(x) for x in (g[m].view(np.int64), f[0], f[1], key, lo - base[piece] + offset)]
            + [pa.array((hi - lo + 1).astype(np.int32)), pa.array((m - lo).astype(np.int32))], schema=_RUN)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces, size = [], 0
        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                data = text.as_py().encode("utf-8")
                # a very long text goes in pieces that overlap by one byte less than a string
                for at in range(0, len(data) - length + 1, CHUNK):
                    part = data[at:at + CHUNK + length - 1]
                    pieces.append((key, at, part))
                    size += len(part)
                    if size >= CHUNK:
                        yield chunk(pieces)
                        pieces, size = [], 0
        if pieces:
            yield chunk(pieces)
    return run


_PIECE = pa.schema([("k1", pa.int64()), ("k2", pa.int64()), ("f1", pa.int64()), ("f2", pa.int64()), ("n", pa.int32()),
                    ("key", pa.int64()), ("start", pa.int64()), ("len", pa.int32()), ("back", pa.int32())])


def _pieces(length: int, width: int):
    """Representatives cut into pieces of at most ``width`` starts, aligned by distance to the anchor."""
    power, common = power_below(length), length - width + 1

    def chunk(found: list[tuple]) -> pa.RecordBatch:
        data = np.frombuffer(b"".join(x[0] for x in found), np.uint8)
        cols = {f: np.concatenate([x[1][f] for x in found]).astype(np.int64) for f in ("start", "len", "back", "n")}
        key = np.concatenate([x[2] for x in found])
        sizes = cols["len"] + length - 1
        base = np.cumsum(sizes) - sizes
        low = (cols["back"] - cols["len"] + 1) // width
        count = cols["back"] // width - low + 1
        c = ranges(low, count)
        base, start, back, size, n, key = (np.repeat(x, count) for x in (
            base, cols["start"], cols["back"], cols["len"], cols["n"], key))
        far, near = np.minimum(back, c * width + width - 1), np.maximum(back - size + 1, c * width)
        first, last = base + back - far, base + back - near
        shape = (far << 20 | near).astype(np.uint64)
        names = []
        for lane in (0, 1):
            by = bucket_names(data, power, lane)[power]
            whole = name_of_length(by, power, length, lane)
            x = base + back - c * width
            core = pair_name(by[x], by[x + common - power], lane)
            names.append((_run_name(core, core, c.astype(np.uint64), lane), _run_name(whole[first], whole[last], shape, lane)))
        cols = [names[0][0], names[1][0], names[0][1], names[1][1]]
        return pa.RecordBatch.from_arrays(
            [pa.array(x.view(np.int64)) for x in cols]
            + [pa.array(n.astype(np.int32)), pa.array(key), pa.array(start + back - far),
               pa.array((far - near + 1).astype(np.int32)), pa.array(far.astype(np.int32))], schema=_PIECE)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, size = [], 0
        for whole in batches:
            for at in range(0, whole.num_rows, 64):
                batch = whole.slice(at, 64)
                count, f = list_fields(batch.column(2), "start", "len", "back", "n")
                cut = np.concatenate([[0], np.cumsum(count)])
                for r, (key, text) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1))):
                    data = text.as_py().encode("utf-8")
                    for a in range(cut[r], cut[r + 1], 256):  # in parts, for very long texts
                        own = slice(a, min(a + 256, cut[r + 1]))
                        part = {k: v[own] for k, v in f.items()}
                        bytes_ = b"".join([data[s:s + n + length - 1] for s, n in zip(part["start"], part["len"])])
                        found.append((bytes_, part, np.full(len(part["n"]), key, np.int64)))
                        size += len(bytes_)
                        if size >= CHUNK:
                            yield chunk(found)
                            found, size = [], 0
        if found:
            yield chunk(found)
    return run


def _ddl(schema: pa.Schema) -> str:
    return ", ".join(f"{f.name} {'long' if f.type == pa.int64() else 'int'}" for f in schema)


def _refine(rows: DataFrame, keys: list[str], work: WorkTables, level: str, last: bool):
    """One refinement: rows of buckets ``keys`` by (f1, f2).

    Returns the spans found repeated and, unless it is the last level, one
    representative of each distinct (f1, f2) in buckets that hold several.
    """
    # written first, so that the join reads both sides from plain exchanges and Spark can split a hot bucket
    several = work.put(f"several{level}", rows.groupBy(*keys).agg(F.sum("n").alias("m")).filter("m > 1").select(*keys))
    shared = work.put(f"shared{level}", rows.join(several, keys, "left_semi"))
    groups = shared.groupBy(*keys, "f1", "f2").agg(
        F.sum("n").alias("n"), F.min(F.struct("key", "start", "len", "back")).alias("one"))
    groups = work.put(f"groups{level}", groups)
    names = [*keys, "f1", "f2"]
    spans = work.put(f"spans{level}", shared.join(groups.filter("n > 1").select(*names), names, "left_semi")
                     .select("key", "start", "len"))
    if last:
        return spans, None
    split = groups.groupBy(*keys).agg(F.count(F.lit(1)).alias("m")).filter("m > 1").select(*keys)
    reps = work.put(f"reps{level}", groups.join(split, keys, "left_semi")
                    .select("one.*", F.least("n", F.lit(2)).cast("int").alias("n")))
    return spans, reps


def repeated_starts(rows: DataFrame, work: WorkTables, min_bytes: int) -> DataFrame:
    """(key, start, len): the starts of strings of ``min_bytes`` bytes that occur at another place too."""
    runs = work.put("runs", rows.select("key", "text").mapInArrow(_anchor_runs(min_bytes), _ddl(_RUN)))
    spans, reps = _refine(runs.withColumn("n", F.lit(1)), ["k1"], work, "0", False)
    work.drop("runs", "several0", "shared0", "groups0")
    found = spans
    widths = [w for w in (max(1, min_bytes // 25), 1)]
    for level, width in enumerate(dict.fromkeys(widths), 1):
        cut = at_places(rows, reps, "start", "len", "back", "n").mapInArrow(_pieces(min_bytes, width), _ddl(_PIECE))
        pieces = work.put(f"pieces{level}", cut)
        spans, reps = _refine(pieces, ["k1", "k2"], work, str(level), width == 1)
        work.drop(f"pieces{level}", f"several{level}", f"shared{level}", f"groups{level}")
        found = found.unionByName(spans)
    return found


def _cut_out(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                count, f = list_fields(batch.column("places"), "start", "len")
                cut = np.concatenate([[0], np.cumsum(count)])
                n_bytes, n_removed, spans, kept = [], [], [], []
                for r, text in enumerate(batch.column("text")):
                    data = text.as_py().encode("utf-8")
                    begin = f["start"][cut[r]:cut[r + 1]]
                    end = begin + f["len"][cut[r]:cut[r + 1]] + (length - 1)
                    order = np.argsort(begin, kind="stable")
                    begin, end = begin[order], np.maximum.accumulate(end[order]) if len(begin) else end
                    new = np.flatnonzero(np.concatenate([[True], begin[1:] > end[:-1]])) if len(begin) else begin
                    lo = begin[new]
                    hi = end[np.concatenate([new[1:], [len(end)]]).astype(np.int64) - 1] if len(begin) else end
                    parts, done = [], 0
                    for a, b in zip(lo.tolist(), hi.tolist()):
                        parts.append(data[done:a])
                        done = b
                    parts.append(data[done:])
                    n_bytes.append(len(data))
                    n_removed.append(int((hi - lo).sum()))
                    spans.append([{"start": a, "end": b} for a, b in zip(lo.tolist(), hi.tolist())])
                    kept.append(b"".join(parts))
                kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id"), pa.array(n_bytes, pa.int64()), pa.array(n_removed, pa.int64()),
                     pa.array(spans, kind), pa.array(kept, pa.binary())],
                    names=["id", "n_bytes", "n_removed", "spans", "kept"])
    return run


def suffix_dedup(docs: DataFrame, *, min_bytes: int = 200, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, n_bytes, n_removed, spans (maximal removed
    runs, [start, end) in bytes) and kept (the remaining bytes).

    Removed is every byte covered by a ``min_bytes`` string (16 or more) that also starts at another place, in the same row or
    another; strings are judged on the input. Defined results: a null text counts as empty, texts shorter than
    ``min_bytes`` lose nothing, rows that repeat an id are rows of their own (equal long texts lose everything, as each repeats the other),
    null ids pass through, an empty table gives an empty result, extra columns are ignored. Texts of any length are
    treated whole.
    """
    if min_bytes < 16:
        raise ValueError("min_bytes must be at least 16")
    work = WorkTables(docs.sparkSession, "suffix-dedup")
    rows = with_row_key(docs, id_col, text_col, work)
    found = repeated_starts(rows, work, min_bytes)
    lists = found.groupBy("key").agg(F.collect_list(F.struct("start", "len")).alias("places"))
    kind = dict(rows.dtypes)["id"]
    return (rows.join(lists, "key", "left").select("id", "text", F.coalesce(
        "places", F.from_json(F.lit("[]"), "array<struct<start:long,len:int>>")).alias("places"))
        .mapInArrow(_cut_out(min_bytes), f"id {kind}, n_bytes long, n_removed long, "
                    "spans array<struct<start:long,end:long>>, kept binary").withColumnRenamed("id", id_col))
