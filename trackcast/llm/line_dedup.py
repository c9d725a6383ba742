"""Operator 4: repeated multi-line chunks, cut where the lines themselves say so.

A text's lines are hashed, and a rolling hash over each two neighbouring line hashes decides whether a
chunk ends there (one in ``spread`` does). Boundaries so depend on two lines only: text inserted
or cut earlier shifts nothing beyond the next boundary, and a passage of several lines is
cut alike wherever it stands. A chunk of two lines or more that occurs more than once, anywhere, stays
at its first place (smallest id, then position) and is removed elsewhere.

Boundaries lose what lies before a passage's first and after its last one. With ``extend`` (the
registered query) the removed chunks are anchors of a second level: what lies inside them is settled, and everything else is cut at every
boundary, so a chunk there is two neighbouring lines, those across an anchor's edge included. The anchors so
grow line by line over what equals an earlier place, and passages that hold no whole chunk are found too. Every line that belongs to a
repeated run of two lines or more goes, and each line's first place of all stays. (A chunk's
first place is never inside a removed one, so the second level misses nothing by leaving their insides out.)

At both levels chunks are first grouped by a 128-bit name, without their text. Only those whose name occurs
twice are read again and grouped by name and bytes, so that no two different chunks are merged; equal ones are combined before the
shuffle. Members then find their class by an equi-join on the name, in which rows carry no
text; if a name stands for several texts (checked), the join compares the bytes as well.
"""

from __future__ import annotations

from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trackcast.llm.common import WorkTables, covered, list_fields, pair_name, text_groups, with_row_key
from trackcast.llm.words import WordNames

_NEWLINE = 0x0A


def _lines(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All texts in one array, each ended by a newline; starts and ends of their lines; lines per text."""
    data = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    ends = np.flatnonzero(data == _NEWLINE)
    starts = np.concatenate([[0], ends[:-1] + 1])
    text_end = np.cumsum([len(t) + 1 for t in texts])
    return data, starts, ends, np.diff(np.concatenate([[0], np.searchsorted(starts, text_end)]))


def _chunks_of(texts: list[bytes], names: WordNames, spread: int):
    """Chunks of all texts: two lanes of names, row, first line, number of lines, first byte, length."""
    data, starts, ends, count = _lines(texts)
    line = [names.name(data, starts, ends, lane) for lane in (0, 1)]
    row = np.repeat(np.arange(len(texts)), count)
    last = np.zeros(len(starts), bool)
    last[np.cumsum(count) - 1] = True
    # a chunk ends after a line whose rolling hash, over it and the line before, says so
    roll = pair_name(line[0][:-1], line[0][1:], 0)
    last[1:] |= (roll % np.uint64(spread) == 0) & (row[1:] == row[:-1])
    end = np.flatnonzero(last)
    begin = np.concatenate([[0], end[:-1] + 1])
    # a chunk's name: a polynomial over its line names, by prefix sums
    found = []
    for lane in (0, 1):
        up, down = names.powers[lane]
        if len(starts) >= len(up):
            up, down = names._powers(names.base[lane], len(starts))
        sums = np.concatenate([[np.uint64(0)], np.cumsum(line[lane] * up[:len(starts)], dtype=np.uint64)])
        found.append(pair_name((sums[end + 1] - sums[begin]) * down[begin], (end - begin).astype(np.uint64), lane))
    first_line = begin - (np.cumsum(count) - count)[row[begin]]
    text_at = np.cumsum([len(t) + 1 for t in texts]) - np.array([len(t) + 1 for t in texts])
    return (*found, row[begin], first_line, end - begin + 1, starts[begin] - text_at[row[begin]], ends[end] - starts[begin])


def _pairs_of(texts: list[bytes], names: WordNames):
    """Every two neighbouring lines of each text, in the form of ``_chunks_of``."""
    data, starts, ends, count = _lines(texts)
    row = np.repeat(np.arange(len(texts)), count)
    on = np.flatnonzero(row[1:] == row[:-1])
    line = [names.name(data, starts, ends, lane) for lane in (0, 1)]
    found = [pair_name(line[lane][on], line[lane][on + 1], lane) for lane in (0, 1)]
    first = (np.cumsum(count) - count)[row[on]]
    return (*found, row[on], on - first, np.full(len(on), 2), starts[on] - starts[first], ends[on + 1] - starts[on])


def _settled(part: pa.RecordBatch, row: np.ndarray, line: np.ndarray, texts: list[bytes]) -> np.ndarray:
    """Which pairs of neighbouring lines lie inside a chunk that is removed already (column 3 has its places)."""
    n, f = list_fields(part.column(3), "line", "lines")
    count = np.array([t.count(b"\n") + 1 for t in texts], np.int64)
    base = np.cumsum(count) - count
    first = base[np.repeat(np.arange(len(texts)), n)] + f["line"]
    return covered(int(count.sum()), first, f["lines"].astype(np.int64) - 1)[base[row] + line]


def _chunk_rows(spread: int, pairs: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = WordNames()
        for part, texts in text_groups(batches, 2):
            h1, h2, row, line, lines, at, size = _pairs_of(texts, names) if pairs else _chunks_of(texts, names, spread)
            on = ~_settled(part, row, line, texts) if pairs else lines > 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(h1.view(np.int64)[on]), pa.array(h2.view(np.int64)[on]), part.column(0).take(pa.array(row[on])),
                 part.column(1).take(pa.array(row[on])), pa.array(line[on]), pa.array(lines[on].astype(np.int32)),
                 pa.array(at[on]), pa.array(size[on])],
                names=["h1", "h2", "key", "ord", "line", "lines", "at", "size"])
    return run


def _chunk_bytes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part, texts in text_groups(batches, 2, 64):
        n, f = list_fields(part.column(3), "h1", "h2", "line", "at", "size")
        row = np.repeat(np.arange(len(texts)), n)
        bytes_ = [texts[r][a:a + s] for r, a, s in zip(row.tolist(), f["at"].tolist(), f["size"].tolist())]
        yield pa.RecordBatch.from_arrays(
            [pa.array(f["h1"]), pa.array(f["h2"]), pa.array(bytes_, pa.binary()), part.column(1).take(pa.array(row)),
             part.column(0).take(pa.array(row)), pa.array(f["line"])], names=["h1", "h2", "bytes", "ord", "key", "line"])


def _keep_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part, texts in text_groups(batches, 1):
        n, f = list_fields(part.column(2), "line", "lines")
        cut = np.concatenate([[0], np.cumsum(n)])
        n_lines, n_removed, kept = [], [], []
        for r, text in enumerate(texts):
            lines = text.split(b"\n")
            gone = covered(len(lines), f["line"][cut[r]:cut[r + 1]], f["lines"][cut[r]:cut[r + 1]])
            n_lines.append(len(lines))
            n_removed.append(int(gone.sum()))
            kept.append(b"\n".join([x for x, g in zip(lines, gone.tolist()) if not g]))
        yield pa.RecordBatch.from_arrays(
            [part.column(0), pa.array(n_lines, pa.int64()), pa.array(n_removed, pa.int64()),
             pa.array(kept, pa.binary()).cast(pa.string())], names=["id", "n_lines", "n_removed", "kept"])


def _repeats(base: DataFrame, chunk_rows, work: WorkTables, level: str, name) -> DataFrame:
    """(key, line, lines) of the chunks that an earlier place has."""
    chunks = base.mapInArrow(chunk_rows, "h1 long, h2 long, key long, ord long, line long, lines int, at long, size long")
    h1, h2 = name(F.col("h1"), F.col("h2"))
    chunks = work.put(f"chunks{level}", chunks.withColumns({"h1": h1.cast("long"), "h2": h2.cast("long")}))
    twice = work.put(f"twice{level}", chunks.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("h1", "h2"))
    again = work.put(f"again{level}", chunks.join(twice, ["h1", "h2"], "left_semi"))
    work.drop(f"chunks{level}", f"twice{level}")
    lists = again.groupBy("key").agg(F.collect_list(F.struct("h1", "h2", "line", "at", "size")).alias("places"))
    members = base.select("key", "ord", "text").join(lists.hint("merge"), "key").select(  # the same plan at every size
        "key", "ord", "text", "places").mapInArrow(_chunk_bytes, "h1 long, h2 long, bytes binary, ord long, key long, line long")
    classes = members.groupBy("h1", "h2", "bytes").agg(F.min(F.struct("ord", "key", "line")).alias("first"))
    heads = work.put(f"heads{level}", classes.groupBy("h1", "h2").agg(F.min("first").alias("first"), F.count(F.lit(1)).alias("texts")))
    place = F.struct("ord", "key", "line")
    gone = again.join(heads.filter("texts = 1"), ["h1", "h2"]).filter(place > F.col("first")).select("key", "line", "lines")
    if not heads.filter("texts > 1").isEmpty():  # some name stands for several texts: its members are matched by bytes
        shared = heads.filter("texts > 1").select("h1", "h2")
        exact = (members.join(shared, ["h1", "h2"], "left_semi").join(classes, ["h1", "h2", "bytes"])
                 .filter(place > F.col("first")).select("key", "line"))
        gone = gone.unionByName(exact.join(again.select("key", "line", "lines"), ["key", "line"]))
    gone = work.put(f"gone{level}", gone)
    work.drop(f"again{level}", f"heads{level}")
    return gone


def _with_places(rows: DataFrame, gone: DataFrame) -> DataFrame:
    """Rows with the places of their removed chunks as a list (positions within one text)."""
    lists = gone.groupBy("key").agg(F.collect_list(F.struct("line", "lines")).alias("places"))
    none = F.from_json(F.lit("[]"), "array<struct<line:long,lines:int>>")
    return rows.join(lists.hint("merge"), "key", "left").withColumn("places", F.coalesce("places", none))


def line_dedup(docs: DataFrame, *, spread: int = 4, extend: bool = False, id_col: str = "doc_id",
               text_col: str = "text", name=lambda h1, h2: (h1, h2)) -> DataFrame:
    """One row per input row: id, n_lines, n_removed, kept (the lines that stay, joined by newlines).

    Lines are what newlines separate, so a text has one line more than newlines, and every line
    counts, empty ones too. Defined results: a null text counts as the empty text (one empty line); a text of one line loses
    nothing; rows that repeat an id are rows of their own (the first by a number given once); rows without an id come
    last; an empty table gives an empty result; extra columns are ignored; texts of any length are treated whole.
    ``extend`` removes every repeated run of two lines or more, not only whole chunks; ``spread`` then changes the work, not the result.
    ``name`` maps the two name columns (tests pass a weak one).
    """
    work = WorkTables(docs.sparkSession, "line-dedup")
    rows = with_row_key(docs, id_col, text_col, work)
    kind = dict(rows.dtypes)["id"]
    order = F.coalesce(F.col("id").cast("long"), F.lit((1 << 63) - 1)) if kind in (
        "bigint", "int", "smallint", "tinyint") else F.lit(0).cast("long")
    base = rows.select("key", order.alias("ord"), "text")
    gone = _repeats(base, _chunk_rows(spread, False), work, "", name)
    if extend:
        gone = gone.unionByName(_repeats(_with_places(base, gone).select("key", "ord", "text", "places"),
                                         _chunk_rows(spread, True), work, "-more", name))
    return (_with_places(rows, gone).select("id", "text", "places")
            .mapInArrow(_keep_lines, f"id {kind}, n_lines long, n_removed long, kept string").withColumnRenamed("id", id_col))
