"""Operator 8: toxicity by class-conditional Kneser-Ney models.

Each class (toxic, ordinary) has a Kneser-Ney model of word pairs. Counts come from every labelled document outside the
held-out fold; they are gathered by Spark as a table of pairs (documents of each class that hold the pair) and one of
words, and grow with the input.

* Pairs: the chance of a word after the word before it is its discounted pair count; the discount is given to the lower order.
* Lower order: an expression (a word, lower-cased) weighs by the number of distinct words it follows in the class's documents,
  discounted, and backs off to the shared counts, which are the distinct left contexts in either class.
* Rare expressions: both classes take the estimate below (a rare pair weighs as its word, a rare word for neither). Rare is
  what the smaller class has fewer than ``reliable`` times (pairs, of which there are more to choose from: twice that), both as
  counted and as expected from the count over both classes.

A document's margin is the difference of its log-likelihoods under the two models over its number of
words, over its whole text. A logistic curve through the learning documents' margins (a histogram,
gathered by Spark) turns it into a score.

Words and pairs are named by 64 bits. Log ratios are shipped to every task up to ``ship`` rows (counted), the most frequent
first; documents' other expressions, counted per document, join the rest by a shuffle.
"""

from __future__ import annotations

from typing import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trackcast.llm.common import WorkTables, narrow, numbered_rows, pair_name, text_groups
from trackcast.llm.words import WordNames

DISCOUNT = 0.75
_LETTER = np.zeros(256, bool)
_LETTER[ord("a"):ord("z") + 1] = _LETTER[0x80:] = True


def join_within(left: DataFrame, right: DataFrame, key: str, rows: int = 2_000_000) -> DataFrame:
    """Inner join that ships ``right`` to every task if it has at most ``rows`` (counted) narrow rows, and shuffles beyond."""
    return left.join(F.broadcast(right) if right.limit(rows + 1).count() <= rows else right, key)


def _expressions(texts: list[bytes], names: WordNames) -> tuple[np.ndarray, np.ndarray]:
    """Number of expressions of each text, and their names: runs of ASCII letters and other non-ASCII characters."""
    data = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
    size = np.array([len(t) + 1 for t in texts])
    begin = np.cumsum(size) - size
    on = np.concatenate([[False], _LETTER[data], [False]])
    edge = np.flatnonzero(on[1:] != on[:-1])
    starts, ends = edge[::2], edge[1::2]
    return np.diff(np.concatenate([np.searchsorted(starts, begin), [len(starts)]])), names.name(data, starts, ends, 0)


def _before(counts: np.ndarray, name: np.ndarray) -> np.ndarray:
    """Name of the word before each word; 0 before a text's first."""
    before = np.concatenate([np.zeros(1, np.uint64), name[:-1]])[:len(name)]
    before[(np.cumsum(counts) - counts)[counts > 0]] = 0
    return before


def _per_text(key: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys of each text: number of the text, a place of the key, how often the text has it."""
    row = np.repeat(np.arange(len(counts)), counts)
    order = np.lexsort((key, row))
    k, r = key[order], row[order]
    first = np.flatnonzero(np.concatenate([[True], (k[1:] != k[:-1]) | (r[1:] != r[:-1])])[:len(k)])
    return r[first], order[first], np.diff(np.concatenate([first, [len(k)]]))


def _lowered(batches, text_at):
    for part, texts in text_groups(batches, text_at, 256):
        yield part, [t.decode("utf-8").lower().encode("utf-8") for t in texts]


def _pair_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(w, v, t, o): word, word before it, toxic and ordinary documents with the pair, of a few texts at a time."""
    names = WordNames()
    held, size = [], 0

    def out():
        p, w, v, t = (np.concatenate([h[i] for h in held]) for i in range(4))
        order = np.argsort(p)
        p = p[order]
        first = np.flatnonzero(np.concatenate([[True], p[1:] != p[:-1]]))
        toxic, both = np.add.reduceat(t[order], first), np.diff(np.concatenate([first, [len(p)]]))
        at = order[first]
        return pa.RecordBatch.from_arrays(
            [pa.array(w[at].view(np.int64)), pa.array(v[at].view(np.int64)), pa.array(toxic), pa.array(both - toxic)],
            names=["w", "v", "t", "o"])

    for part, texts in _lowered(batches, 0):
        counts, w = _expressions(texts, names)
        if not len(w):
            continue
        v = _before(counts, w)
        p = pair_name(v, w, 0)
        row, at, _ = _per_text(p, counts)
        held.append((p[at], w[at], v[at], part.column(1).to_numpy(zero_copy_only=False).astype(np.int64)[row]))
        size += len(at)
        if size >= 1_000_000:
            yield out()
            held, size = [], 0
    if held:
        yield out()


def _pair_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in batches:
        w, v = (part.column(i).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64) for i in (0, 1))
        yield pa.RecordBatch.from_arrays(
            [pa.array(pair_name(v, w, 0).view(np.int64)), part.column(2), part.column(3)], names=["key", "n", "x"])


def fit_models(learn: DataFrame, work: WorkTables, reliable: int) -> DataFrame | None:
    """(key, n, x) from (text, toxic): name of a word or pair, documents or contexts of both classes, and what it adds to the
    log ratio of the two models (a pair: beyond its word); None without both classes."""
    pairs = work.put("pairs", learn.select("text", "toxic").mapInArrow(_pair_counts, "w long, v long, t long, o long")
                     .groupBy("w", "v").agg(F.sum("t").alias("t"), F.sum("o").alias("o")))
    has = [F.when(F.col(c) > 0, 1).otherwise(0).cast("long") for c in ("t", "o")]
    no, fields = F.lit(0).cast("long"), ("ct", "co", "cs", "nt", "no", "dt", "do")
    as_word = F.struct(F.col("w").alias("k"), *[x.alias(f) for f, x in zip(fields, (*has, F.lit(1).cast("long"), no, no, no, no))])
    as_left = F.struct(F.col("v").alias("k"), *[x.alias(f) for f, x in zip(fields, (no, no, no, F.col("t"), F.col("o"), *has))])
    words = work.put("words", pairs.select(F.inline(F.array(as_word, as_left))).groupBy("k").agg(
        *[F.sum(f).alias(f) for f in fields]))  # distinct left contexts; pairs and distinct pairs it begins
    total = words.agg(*[F.sum(f).alias(f) for f in fields]).first()
    if not total["ct"] or not total["co"]:
        work.drop("pairs", "words")
        return None

    def rare(t, o, all_t, all_o, least):
        few, share = (t, all_t / (all_t + all_o)) if all_t <= all_o else (o, all_o / (all_t + all_o))
        return (few < least) & ((t + o) * F.lit(share) < least)

    # among the words that are not rare: shared chance, and each class's discounted counts and backoff to it
    sparse = rare(F.col("ct"), F.col("co"), total["ct"], total["co"], reliable)
    kept = words.filter(~sparse).agg(
        F.sum(F.col("cs") - DISCOUNT).alias("cs"), F.sum("ct").alias("ct"), F.sum("co").alias("co"),
        *[F.sum(F.least(F.col(c).cast("double"), F.lit(DISCOUNT))).alias(f"b{c}") for c in ("ct", "co")]).first()
    lower = {}
    for c in ("ct", "co"):
        backoff = max(kept[f"b{c}"] / kept[c], 1e-9) if kept[c] else 1.0
        one = (F.greatest(F.col(c) - DISCOUNT, F.lit(0.0)) / F.lit(float(max(kept[c] or 0, 1)))
               + F.lit(backoff) * (F.col("cs") - DISCOUNT) / F.lit(float(kept["cs"] or 1)))
        # all words: those kept share their part of all contexts, a rare one has the same chance in both classes
        lower[c] = F.when(sparse, F.col("cs") / F.lit(float(total["cs"]))).otherwise(
            one * F.lit(float((kept["cs"] or 0) / total["cs"])))
    words = words.withColumns({"pt": lower["ct"], "po": lower["co"]})

    def after(n, left, kinds, lower):
        """Chance of a word after another, in a class: discounted pair count, and the discount times the lower order."""
        return F.when(F.col(left) > 0, (F.greatest(F.col(n) - DISCOUNT, F.lit(0.0)) + DISCOUNT * F.col(kinds) * F.col(lower))
                      / F.col(left)).otherwise(F.col(lower))

    known = (pairs.filter(~rare(F.col("t"), F.col("o"), total["nt"], total["no"], 2 * reliable))
             .join(words.select(F.col("k").alias("w"), "pt", "po"), "w")
             .join(words.select(F.col("k").alias("v"), "nt", "no", "dt", "do"), "v"))
    beyond = (F.log(after("t", "nt", "dt", "pt")) - F.log(after("o", "no", "do", "po"))
              - (F.log("pt") - F.log("po")))
    weights = work.put("weights", words.filter(~sparse).select(
        F.col("k").alias("key"), F.col("cs").alias("n"), (F.log("pt") - F.log("po")).alias("x")).unionByName(
        known.select("w", "v", (F.col("t") + F.col("o")).alias("n"), beyond.alias("x")).mapInArrow(
            _pair_keys, "key long, n long, x double")))
    work.drop("pairs", "words")
    return weights


class Weights:
    """Log ratios by name, as shipped to every task."""

    def __init__(self, key: np.ndarray, x: np.ndarray):
        order = np.argsort(key)
        self.key, self.x = key[order], x[order]
        self.some = np.zeros(1 << 22, bool)
        self.some[self.key >> np.uint64(42)] = True

    def of(self, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Log ratio of each name (0 if not shipped), and whether it was shipped."""
        x, known = np.zeros(len(key)), np.zeros(len(key), bool)
        at = np.flatnonzero(self.some[key >> np.uint64(42)])
        if len(at):
            place = np.minimum(np.searchsorted(self.key, key[at]), len(self.key) - 1)
            hit = self.key[place] == key[at]
            known[at[hit]] = True
            x[at[hit]] = self.x[place[hit]]
        return x, known


class Margins:
    """Adds margins to rows: the most frequent log ratios are shipped, others are joined."""

    def __init__(self, weights: DataFrame, work: WorkTables, ship: int):
        self.work, self.rest = work, None
        sizes = weights.groupBy("n").agg(F.count(F.lit(1)).alias("rows"))
        if weights.count() > ship:  # one row per count that occurs, summed from the top
            least, rows = None, 0
            for n, more in sorted(((r["n"], r["rows"]) for r in sizes.collect()), reverse=True):
                if rows + more > ship:
                    break
                least, rows = n, rows + more
            often = F.col("n") >= F.lit(least) if least is not None else F.lit(False)
            self.rest, weights = weights.filter(~often).select("key", "x"), weights.filter(often)
        sent = weights.select("key", "x").toArrow()
        self.shipped = work.spark.sparkContext.broadcast(Weights(
            sent.column("key").to_numpy().astype(np.int64).view(np.uint64), sent.column("x").to_numpy().astype(np.float64)))

    def add(self, rows: DataFrame, id_col: str, text_col: str, name: str) -> DataFrame:
        """The rows with their margins over whole texts as a further column; nulls count as empty."""
        here = margin_of(self.shipped)(F.col(f"`{text_col}`"))
        if self.rest is None:
            return rows.withColumn(name, here)
        rows, key = numbered_rows(rows, id_col, self.work)
        spread = narrow(rows, key, text_col).toDF("key", "text").select("key", F.coalesce("text", F.lit("")).alias("text"))
        found = self.work.put("found", spread.mapInArrow(unshipped(self.shipped), "row long, key long, part double"))
        there = found.join(self.rest.hint("merge"), "key").groupBy("row").agg(F.sum(F.col("part") * F.col("x")).alias(name))
        there = self.work.put("there", there.withColumnRenamed("row", key))
        return rows.join(there, key, "left").withColumn(
            name, here + F.coalesce(F.col(name), F.lit(0.0))).drop(key)


def unshipped(weights):
    """(row, key, part): what each text has of words and pairs that are not shipped, as parts of its number of words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = WordNames()
        for part, texts in _lowered(batches, 1):
            counts, w = _expressions(texts, names)
            if not len(w):
                continue
            for key in (w, pair_name(_before(counts, w), w, 0)):
                row, at, n = _per_text(key, counts)
                on = ~weights.value.of(key[at])[1]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(row[on])), pa.array(key[at][on].view(np.int64)),
                     pa.array(n[on] / counts[row[on]])], names=["row", "key", "part"])
    return run


def margin_of(weights):
    """Column function: a text's margin under the log ratios shipped in ``weights``; whole texts, nulls count as empty."""
    @F.pandas_udf("double")
    def margin(texts: pd.Series) -> pd.Series:
        names = WordNames()
        out = []
        for at in range(0, len(texts), 64):
            part = [(t or "").lower().encode("utf-8") for t in texts.iloc[at:at + 64]]
            counts, w = _expressions(part, names)
            x = weights.value.of(w)[0] + weights.value.of(pair_name(_before(counts, w), w, 0))[0]
            sums = np.concatenate([[0.0], np.cumsum(x)])
            end = np.cumsum(counts)
            out.append((sums[end] - sums[end - counts]) / np.maximum(counts, 1))
        return pd.Series(np.concatenate(out) if out else np.empty(0))
    return margin


def fit_curve(margin: np.ndarray, toxic: np.ndarray, ordinary: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the logistic curve through binned margins, by Newton steps with a little weight decay."""
    scale = float(np.sqrt(np.average(margin ** 2, weights=toxic + ordinary))) or 1.0
    x = np.column_stack([margin / scale, np.ones(len(margin))])
    n, w = toxic + ordinary, np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (n * p - toxic) + 1e-3 * w
        hess = (x * (n * p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        step = np.linalg.solve(hess, grad)
        w -= step * min(1.0, 5.0 / max(1e-9, np.abs(step).max()))
        if np.abs(step).max() < 1e-8:
            break
    return float(w[0] / scale), float(w[1])


def in_fold(id_col: str, folds: int, fold: int):
    """Whether crc32 of the id as text has the given remainder; false for rows without an id."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % folds == fold, F.lit(False))


def fit_toxicity(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                 label_col: str = "toxic", folds: int = 5, held_out_fold: int = 0, reliable: int = 5, ship: int = 2_000_000):
    """Function that adds a score to rows like ``docs``, learned from the labelled rows outside the held-out fold.

    It takes the rows and the name of the column to add.
    """
    spark = docs.sparkSession
    work = WorkTables(spark, "toxicity")
    known = (narrow(labels, id_col, label_col).toDF("id", "toxic").filter("id is not null and toxic is not null")
             .groupBy("id").agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
             .filter(~in_fold("id", folds, held_out_fold)))
    learn = join_within(narrow(docs, id_col, text_col).toDF("id", "text").withColumn(
        "text", F.coalesce("text", F.lit(""))), known, "id")
    weights = fit_models(learn, work, reliable)
    if weights is None:
        share = known.agg(F.avg("toxic")).first()[0]
        return lambda rows, name: rows.withColumn(name, F.lit(0.5 if share is None else float(share)))
    margins = Margins(weights, work, ship)
    # margins lie within a few units, so their histogram has a few thousand rows
    bins = (margins.add(learn, "id", "text", "m").select("toxic", F.round("m", 3).alias("m")).groupBy("m")
            .agg(F.sum("toxic").alias("t"), F.count(F.lit(1)).alias("n"))).toPandas()
    toxic = bins["t"].to_numpy(float)
    slope, offset = fit_curve(bins["m"].to_numpy(float), toxic, bins["n"].to_numpy(float) - toxic)

    def score(rows: DataFrame, name: str) -> DataFrame:
        return margins.add(rows, id_col, text_col, name).withColumn(
            name, 1 / (1 + F.exp(-(F.lit(slope) * F.col(name) + F.lit(offset)))))
    return score


def score_toxicity(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                   label_col: str = "toxic", folds: int = 5, held_out_fold: int = 0, reliable: int = 5,
                   ship: int = 2_000_000) -> DataFrame:
    """One row per input row: id, held_out, score (0 to 1), predicted (1 from 0.5 on).

    Learned from rows with a label outside the held-out fold; only the text enters a score. Defined
    results: null and empty texts have margin 0 and the score the curve gives it; a null label teaches nothing, of several
    labels of an id the largest counts; rows without an id are scored but never learned from; rows that repeat an id are rows of
    their own; without labels of both classes every score is the toxic share (0.5 without any label); empty
    tables give empty results; extra columns are ignored; whole texts are read.
    """
    score = fit_toxicity(docs, labels, id_col=id_col, text_col=text_col, label_col=label_col, folds=folds,
                         held_out_fold=held_out_fold, reliable=reliable, ship=ship)
    rows = score(narrow(docs, id_col, text_col), "toxicity_score")
    return (rows.select(F.col(id_col), in_fold(id_col, folds, held_out_fold).alias("held_out"),
                        F.col("toxicity_score").alias("score"))
            .withColumn("predicted", (F.col("score") >= 0.5).cast("int")))


def drop_toxic(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The input without the rows whose score is 0.5 or more; all columns stay."""
    name = "toxicity_score"
    while name.lower() in {c.lower() for c in docs.columns}:
        name += "_"
    return fit_toxicity(docs, labels, **options)(docs, name).filter(F.col(name) < 0.5).drop(name)
