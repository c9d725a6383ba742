"""Operator 13: phrase collocations by best-first branch-and-bound growth.

Phrases grow to the right, one word a level. Let f be a phrase's count. Cutting a phrase q that begins with p after the first k words
of p scores ``2a / (l + r)`` with a = f(q) <= f(p), l = f(first k words) and r >= a, so at most ``2 f(p) / (l + f(p))``;
the least of these over k bounds every phrase that grows from p. Bounds never rise as a phrase grows.

Words and pairs of frequent words are counted first (one word alone bounds nothing). From then on only the best of the frontier
are grown: per language the pairs whose bound reaches a level that the best ``frontier`` pairs, with ties, reach; of the triples
counted, those whose bound reaches it. Whatever is not grown scores less than the level. Of the candidates at the level or above,
the extensions by one word to the left are counted too, since a longer candidate with 4/5 of their occurrences drops them
(a longer one drops them only if one of these does). If a language then has the asked number of survivors at
the level or above, it is settled, ties included; if not, its frontier grows four times as large, down to level 0, where all
candidates are counted.

Counting is a pass over the texts: tasks number their words, test which n-grams to count by bits of their names in tables of a fixed size (built by Spark
from the frontier; a false hit costs a count that nothing needs, never a result), count those by their numbers in batches of bounded size, and
Spark adds the counts up by (language, phrase), combined before the shuffle. All later steps are joins and
aggregates over counted phrases; nothing but the bit tables and the number of open languages reaches the driver.
"""

from __future__ import annotations

from itertools import repeat
from typing import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from trackcast.llm.common import WorkTables, narrow, pair_name

#: Marks the end of a piece; no UTF-8 text holds this byte.
END = b"\xff"
#: A-Z lower case, the tab a blank, what ends a piece the mark.
TABLE = bytes(b + 32 if 0x41 <= b <= 0x5A else 0x20 if b == 0x09 else 0xFF if b in b".,;:!?\n\x0b\x0c\r" else b for b in range(256))

#: Bits of a filter table (8 MB).
BITS = 26
#: Bytes of text whose words are numbered at a time.
LIST = 1 << 20
#: n-grams a task collects before it sends their counts on, and words that it numbers.
HELD, VOCABULARY = 1 << 21, 1 << 19

_COUNTS = "lang string, phrase string, f long"


def token_chunks(texts: Iterator[bytes], carry: int) -> Iterator[bytes]:
    """The texts' words and piece ends, blanks between them, in chunks of about LIST bytes.

    Every text starts a new piece. A chunk that goes on within a text starts with up to ``carry`` words of the
    chunk before, those of its last piece, so that each run of ``carry + 1`` words is in exactly one chunk.
    """
    group, size = [], 0
    for text in texts:
        text = text.translate(TABLE)
        if len(text) <= LIST:
            group.append(text)
            size += len(text)
            if size >= LIST:
                yield END.join(group).replace(END, b" \xff ")
                group, size = [], 0
            continue
        at, before = 0, b""
        while at < len(text):
            end = text.find(b" ", at + LIST)
            end = len(text) if end < 0 else end
            chunk = before + text[at:end].replace(END, b" \xff ")
            yield chunk
            last = chunk.rsplit(END, 1)[-1].split() if carry else []
            before = b"".join(word + b" " for word in last[max(0, len(last) - carry):])
            at = end
    if group:
        yield END.join(group).replace(END, b" \xff ")


def split_words(chunk: bytes) -> tuple[list[bytes], np.ndarray]:
    """The distinct words of a chunk, and which of them stand in it, in order."""
    whole = pa.Array.from_buffers(pa.large_binary(), 1, [None, pa.py_buffer(np.array([0, len(chunk)], np.int64)), pa.py_buffer(chunk)])
    coded = pc.split_pattern(whole, pattern=b" ").values.dictionary_encode()
    _, ends, data = coded.dictionary.buffers()
    size = len(coded.dictionary)
    ends = np.frombuffer(ends, np.int64, size + 1, coded.dictionary.offset * 8)
    data = b"" if data is None else data.to_pybytes()
    cut = ends.tolist()
    return [data[a:b] for a, b in zip(cut, cut[1:])], coded.indices.to_numpy()


class Vocabulary(dict):
    """Numbers of the words of one language in order of first sight (the end of a piece is 0), and names for the filters."""

    def __init__(self, lang: str):
        super().__init__({END: 0})
        self.words, self.seed, self.names = [END], crc32(lang.encode("utf-8") + b"\0"), np.empty(0, np.uint64)

    def __missing__(self, word: bytes) -> int:
        n = self[word] = len(self.words)
        self.words.append(word)
        return n

    def numbers(self, chunk: bytes) -> np.ndarray:
        """Numbers of the chunk's words, in order."""
        words, at = split_words(chunk)
        blank = words.index(b"") if b"" in words else -1
        number = np.fromiter(map(self.__getitem__, words), np.int64, len(words))
        more = self.words[len(self.names):]
        self.names = np.concatenate([self.names, word_names(more, self.seed)])
        return number[at if blank < 0 else at[at != blank]]


def word_names(words: list[bytes], seeds) -> np.ndarray:
    seeds = repeat(seeds) if isinstance(seeds, int) else seeds
    sums = np.fromiter(map(crc32, words, seeds), np.uint32, len(words)).astype(np.uint64)
    return pair_name(sums, np.uint64(1), 0)


def gram_names(names: np.ndarray, n: int) -> dict[int, np.ndarray]:
    """Names of the runs of 1 to n words that start at each word, each from that of one word less."""
    out = {1: names}
    for k in range(2, n + 1):
        out[k] = pair_name(out[k - 1][:max(0, len(names) - k + 1)], names[k - 1:], 0)
    return out


def _has(bits: np.ndarray, names: np.ndarray) -> np.ndarray:
    at = names >> np.uint64(64 - BITS)
    return (bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & np.uint8(1) != 0


def _wanted(ids: np.ndarray, words: np.ndarray, n: int, filters: dict[str, np.ndarray]) -> np.ndarray:
    """Where n-grams start that a pass counts. ``both``: parts of ``m`` words that must all be frequent; ``grow``: first n - 1
    words to be grown; ``inner``: last n - 1 words whose growth to the left is counted; ``whole``: the n-gram itself."""
    inside = ids != 0
    for k in range(1, n):
        inside = inside[:-1] & (ids[k:] != 0)
    names = gram_names(words[ids], n if "whole" in filters else n - 1)
    if "whole" in filters:
        at = np.flatnonzero(inside)
        return at[_has(filters["whole"], names[n][at])]
    m = min(n - 1, 2)
    frequent = _has(filters["both"], names[m])
    for k in range(n - m + 1):
        inside &= frequent[k:k + len(inside)]
    at = np.flatnonzero(inside)
    if "grow" in filters:
        at = at[_has(filters["grow"], names[n - 1][at]) | _has(filters["inner"], names[n - 1][at + 1])]
    return at


class Held:
    """n-grams of one language that wait to be counted, as rows of word numbers."""

    def __init__(self, lang: str, n: int):
        self.lang, self.n = lang, n
        self.clear()

    def clear(self) -> None:
        self.vocabulary, self.rows, self.size, self.total = Vocabulary(self.lang), [], 0, 0

    def add(self, chunk: bytes, filters) -> None:
        ids = self.vocabulary.numbers(chunk)
        if self.n == 1:
            ids = ids[ids != 0]
            self.total += len(ids)
            rows = ids[:, None]
        else:
            rows = np.stack([ids[at:len(ids) - self.n + at + 1] for at in range(self.n)], axis=1)[
                _wanted(ids, self.vocabulary.names, self.n, filters)] if len(ids) >= self.n else np.empty((0, self.n), np.int64)
        self.rows.append(rows)
        self.size += len(rows)

    def full(self) -> bool:
        return self.size >= HELD or len(self.vocabulary.words) >= VOCABULARY

    def counted(self) -> Iterator[pa.RecordBatch]:
        """The distinct n-grams with their counts; for words also their number, under a null phrase."""
        words = pa.array(self.vocabulary.words, pa.binary())
        rows = np.concatenate(self.rows) if self.rows else np.empty((0, self.n), np.int64)
        if self.n <= 2:
            key, counts = np.unique(rows[:, 0] if self.n == 1 else rows[:, 0] << 21 | rows[:, 1], return_counts=True)
            columns = [key] if self.n == 1 else [key >> 21, key & ((1 << 21) - 1)]
        else:
            key = rows[:, 0] << 21 | rows[:, 1]
            for k in range(2, self.n):
                if k == 3:  # numbers fit in 20 bits: two of them and a third, or a rank and one more, fit in a long
                    key = np.unique(key, return_inverse=True)[1]
                key = key << 21 | rows[:, k]
            _, first, counts = np.unique(key, return_index=True, return_counts=True)
            columns = list(rows[first].T)
        for at in range(0, len(counts), 1 << 16):
            part = [words.take(pa.array(c[at:at + (1 << 16)])) for c in columns]
            yield self._batch(pc.binary_join_element_wise(*part, b" ") if self.n > 1 else part[0], counts[at:at + (1 << 16)])
        if self.total:
            yield self._batch(pa.array([None], pa.binary()), [self.total])
        self.clear()

    def _batch(self, phrases: pa.Array, counts) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([self.lang] * len(phrases), pa.string()), phrases.cast(pa.string()),
                                           pa.array(counts, pa.int64())], names=["lang", "phrase", "f"])


def _count(n: int, filters):
    """n-grams a pass wants (all words, if n is 1, and under a null phrase their number) with their counts, per language."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = filters.value if filters is not None else None
        all_held: dict[str, Held] = {}
        for batch in batches:
            langs = batch.column(0).to_pylist()
            texts = batch.column(1).cast(pa.binary())
            for lang in dict.fromkeys(langs):
                held = all_held.setdefault(lang, Held(lang, n))
                own = (t.as_py() for x, t in zip(langs, texts) if x == lang)
                for chunk in token_chunks(own, n - 1):
                    held.add(chunk, tables)
                    if held.full():
                        yield from held.counted()
            if sum(len(h.vocabulary.words) for h in all_held.values()) >= VOCABULARY:  # many languages
                for held in all_held.values():
                    yield from held.counted()
                all_held.clear()
        for held in all_held.values():
            yield from held.counted()
    return run


def phrase_counts(rows: DataFrame, n: int, at_least: int, **filters: DataFrame) -> DataFrame:
    """(lang, phrase, f) of the n-grams that ``filters`` (phrases by the parts they stand for, see ``_wanted``) let
    through, with ``at_least`` occurrences, and those that a false hit let through."""
    spark = rows.sparkSession
    shared = spark.sparkContext.broadcast({k: bit_table(v) for k, v in filters.items()}) if filters else None
    return (rows.mapInArrow(_count(n, shared), _COUNTS).groupBy("lang", "phrase").agg(F.sum("f").alias("f"))
            .filter((F.col("f") >= at_least) | F.col("phrase").isNull()))


def _bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        by_size: dict[int, tuple[list, list]] = {}
        for lang, phrase in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist()):
            words = phrase.split(b" ")
            seeds, rows = by_size.setdefault(len(words), ([], []))
            seeds += [crc32(lang.encode("utf-8") + b"\0")] * len(words)
            rows += words
        for n, (seeds, rows) in by_size.items():
            names = word_names(rows, seeds).reshape(-1, n)
            name = names[:, 0]
            for k in range(1, n):
                name = pair_name(name, names[:, k], 0)
            at = np.unique((name >> np.uint64(64 - BITS)).astype(np.int64))
            first = np.flatnonzero(np.diff(at >> 6, prepend=-1))
            bits = np.bitwise_or.reduceat(np.int64(1) << (at & 63), first)
            yield pa.RecordBatch.from_arrays([pa.array(at[first] >> 6), pa.array(bits)], names=["word", "bits"])


def bit_table(phrases: DataFrame) -> np.ndarray:
    """The bits of the phrases' names, 2 ** BITS of them whatever the number of phrases."""
    words = (phrases.select("lang", "phrase").mapInArrow(_bits, "word long, bits long")
             .groupBy("word").agg(F.bit_or("bits").alias("bits")))
    out = np.zeros(max(1, 1 << BITS >> 6), np.int64)
    found = words.toPandas()  # at most 2 ** (BITS - 6) rows
    out[found["word"].to_numpy(np.int64)] = found["bits"].to_numpy(np.int64)
    return out.view(np.uint8)


def scored(phrases: DataFrame, known: DataFrame) -> DataFrame:
    """Phrases (lang, phrase, f) with their lowest cut (k, l, r, score) and the bound of what grows from them.

    ``known`` has the counts of their parts. A cut whose right part is unknown has no score and is left out; ``open`` says so, and the score
    is then that of the other cuts, an upper bound. Phrases with an unknown first part are not returned: what they grew from is out.
    """
    words = F.split("phrase", " ")
    n = F.size(words)
    cut = phrases.select("lang", "phrase", F.col("f").alias("a"), words.alias("w"), n.alias("n")).select(
        "lang", "phrase", "a", "n", F.explode(F.sequence(F.lit(1), F.col("n") - 1)).alias("k"), "w").select(
        "lang", "phrase", "a", "n", "k", F.array_join(F.slice("w", F.lit(1), F.col("k")), " ").alias("left"),
        F.array_join(F.slice("w", F.col("k") + 1, F.col("n") - F.col("k")), " ").alias("right"))
    side = lambda part, f: known.select("lang", F.col("phrase").alias(part), F.col("f").alias(f))
    both = cut.join(side("left", "l"), ["lang", "left"]).join(side("right", "r"), ["lang", "right"], "left")
    exact = lambda whole: F.expr(
        f"cast((cast(2000000 as decimal(7,0)) * cast(a as decimal(20,0))) div cast({whole} as decimal(20,0)) as long)")
    return (both.withColumn("score", exact("(l + r)")).withColumn("bound", exact("(l + a)"))
            .groupBy("lang", "phrase", "a", "n")
            .agg(F.min(F.when(F.col("r").isNotNull(), F.struct("score", "k", "l", "r"))).alias("cut"), F.min("bound").alias("bound"),
                 F.count(F.lit(1)).alias("cuts"), F.bool_or(F.col("r").isNull()).alias("open"))
            .filter(F.col("cuts") == F.col("n") - 1).select("lang", "phrase", "a", "cut.*", "bound", "open"))


def counts_of(phrases: DataFrame) -> DataFrame:
    return phrases.select("lang", "phrase", F.col("a").alias("f"))


def merged(work: WorkTables, name: str, *tables: DataFrame | None) -> DataFrame:
    """Counts of several passes; a phrase counted twice has the same count."""
    rows = None
    for t in tables:
        if t is not None:
            rows = t if rows is None else rows.unionByName(t)
    return work.put(name, rows.groupBy("lang", "phrase").agg(F.max("f").alias("f")))


def levels(pairs: DataFrame, frontier: int) -> DataFrame:
    """(lang, level): the bound, down to thousands, that the best ``frontier`` pairs reach; 0 where there are fewer."""
    bins = pairs.groupBy("lang", F.expr("bound div 1000").alias("bin")).agg(F.count(F.lit(1)).alias("n"))  # 1,001 bins at most
    so_far = F.sum("n").over(Window.partitionBy("lang").orderBy(F.desc("bin")))
    return (bins.withColumn("n", so_far).groupBy("lang")
            .agg((F.coalesce(F.max(F.when(F.col("n") >= frontier, F.col("bin"))), F.lit(0)) * 1000).alias("level")))


def survivors(candidates: DataFrame, longer: DataFrame, cover: int) -> DataFrame:
    """Candidates without those of which a longer one by a word has ``cover`` percent of the occurrences."""
    words, n = F.split("phrase", " "), F.size(F.split("phrase", " "))
    parts = F.array(*[F.array_join(F.slice(words, F.lit(at), n - 1), " ") for at in (1, 2)])
    most = longer.select("lang", "f", F.explode(parts).alias("phrase")).groupBy("lang", "phrase").agg(F.max("f").alias("most"))
    return (candidates.join(most, ["lang", "phrase"], "left")
            .filter(F.col("most").isNull() | (F.lit(100) * F.col("most") < F.lit(cover) * F.col("a"))).drop("most"))


def first_of_each(rows: DataFrame, top: int) -> DataFrame:
    """The first ``top`` rows of each language with their rank; each of 64 parts of a language is cut to ``top`` first."""
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    salt = F.pmod(F.xxhash64("phrase"), F.lit(64))
    cut = (rows.withColumn("salt", salt).withColumn("rank", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order)))
           .filter(F.col("rank") <= top))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")
    return cut.withColumn("rank", rank).filter(F.col("rank") <= top)


def mine_collocations(docs: DataFrame, *, top: int = 2000, at_least: int = 30, cover: int = 80, frontier: int = 16_000,
                      lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """The first ``top`` phrases of each language: lang, rank, phrase, a, l, r, n, score.

    Candidates are phrases of 2 to 4 words of one piece with a >= ``at_least`` occurrences; l and r are the counts of the parts of the
    lowest-scoring cut (the smallest of equal ones), score = floor(2000000 a / (l + r)), n the language's words. Candidates inside a longer
    one that has ``cover`` percent of their occurrences are dropped. ``frontier`` is the number of pairs grown first; it
    changes the work, not the result.

    Defined results: a null language counts as ``und``, a null text as empty; copies and rows that repeat an id count each; equal
    scores are ordered by a, descending, then phrase in UTF-8 byte order; a language with fewer candidates returns
    them all, one without any no row; an empty table gives an empty result; extra columns are ignored. Texts of any length are
    treated whole.
    """
    work = WorkTables(docs.sparkSession, "collocations")
    rows = narrow(docs, lang_col, text_col).toDF("lang", "text").select(
        F.coalesce("lang", F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    words = work.put("words", phrase_counts(rows, 1, at_least))
    ones = words.filter("phrase is not null")
    totals = words.filter("phrase is null").select("lang", F.col("f").alias("n"))
    twos = work.put("twos", phrase_counts(rows, 2, at_least, both=ones))
    pairs = work.put("pairs", scored(twos, ones))
    state = work.put("state0", levels(pairs, frontier).select(
        "lang", "level", F.lit(None).cast("long").alias("above"), F.lit(False).alias("done")))
    threes = fours = asked = None
    turn = 0
    while True:
        def new(phrases: DataFrame, by: str) -> DataFrame:
            """Phrases of open languages that reach the level and did not reach the one before."""
            return (phrases.join(state, "lang").filter(
                ~F.col("done") & (F.col(by) >= F.col("level")) & (F.col("above").isNull() | (F.col(by) < F.col("above"))))
                .select("lang", "phrase"))

        found = phrase_counts(rows, 3, at_least, both=twos, grow=new(pairs, "bound"), inner=new(pairs, "score"))
        threes = merged(work, f"threes{turn}", threes, found)
        triples = work.put(f"triples{turn}", scored(threes, ones.unionByName(twos)))
        found = phrase_counts(rows, 4, at_least, both=twos, grow=new(triples, "bound"), inner=new(triples, "score"))
        fours = merged(work, f"fours{turn}", fours, found)
        known = merged(work, f"known{turn}", threes, asked)
        fourfold = work.put(f"fourfold{turn}", scored(fours, ones.unionByName(twos).unionByName(known)))
        unsure = new(fourfold.filter("open"), "score")
        if not unsure.isEmpty():
            last = F.array_join(F.slice(F.split("phrase", " "), 2, 3), " ")
            found = phrase_counts(rows, 3, at_least, whole=unsure.select("lang", last.alias("phrase")).distinct())
            asked = known = merged(work, f"asked{turn}", known, found)
            fourfold = work.put(f"sure{turn}", scored(fours, ones.unionByName(twos).unionByName(known)))
        out = ["lang", "phrase", "a", "l", "r", "score"]
        candidates = pairs.select(*out).unionByName(triples.select(*out)).unionByName(fourfold.filter("not open").select(*out))
        candidates = candidates.join(state, "lang").filter("score >= level").select(*out)
        left = work.put(f"left{turn}", survivors(candidates, known.unionByName(fours), cover))
        have = left.groupBy("lang").agg(F.count(F.lit(1)).alias("have"))
        settled = F.col("done") | (F.coalesce("have", F.lit(0)) >= top) | (F.col("level") == 0)
        state = state.join(have, "lang", "left").select("lang", "level", settled.alias("done"))
        if state.filter(~F.col("done")).isEmpty():
            break
        turn += 1
        frontier *= 4
        grown = levels(pairs, frontier).withColumnRenamed("level", "next")
        state = work.put(f"state{turn}", state.join(grown, "lang").select(
            "lang", F.when(F.col("done"), F.col("level")).otherwise(F.col("next")).alias("level"), F.col("level").alias("above"), "done"))
    best = first_of_each(left, top).join(totals, "lang")
    return best.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").withColumnRenamed("lang", lang_col)
