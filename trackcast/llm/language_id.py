"""Operator 9: language identification by a byte convolutional network.

Texts are cut into windows of 256 bytes (A-Z lower-cased). A window's bytes become small vectors; filters over
2, 3 and 4 neighbouring bytes are applied at every place, each filter's largest value goes through a
rectifier into a softmax over the languages. The network is trained in numpy on windows from a bounded sample (``per_language``
documents of each language, chosen by a hash of their ids, ``per_document`` windows each at hashed
places, cut to random lengths so that short texts work too). A text's probabilities are the
average over all its windows, by their lengths.
"""

from __future__ import annotations

from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trackcast.llm.common import WorkTables, narrow, text_groups, with_row_key
from trackcast.llm.toxicity import in_fold
from trackcast.llm.words import LOWER

WINDOW, DIM, WIDEST = 256, 8, 4
WIDTHS = (2, 3, 4)


def _conv_input(windows: np.ndarray, embed: np.ndarray) -> np.ndarray:
    """(windows, places, WIDEST * DIM): the vectors of the bytes from each place on (zeros past the end)."""
    padded = np.zeros((len(windows), WINDOW + WIDEST - 1), np.uint8)
    padded[:, :WINDOW] = LOWER[windows]
    x = embed[padded].reshape(len(windows), -1)
    places = np.lib.stride_tricks.sliding_window_view(x, WIDEST * DIM, axis=1)[:, ::DIM]
    return np.ascontiguousarray(places, dtype=np.float32)


def _filter_mask(filters: int) -> np.ndarray:
    """Which of the WIDEST * DIM inputs a filter reads, by its width."""
    mask = np.zeros((WIDEST * DIM, filters * len(WIDTHS)), np.float32)
    for k, w in enumerate(WIDTHS):
        mask[:w * DIM, k * filters:(k + 1) * filters] = 1
    return mask


def probabilities(windows: np.ndarray, net: dict) -> np.ndarray:
    """Softmax over languages for each window, a few at a time so that arrays stay in cache."""
    out = []
    for at in range(0, len(windows), 64):
        x = _conv_input(windows[at:at + 64], net["embed"])
        h = (x.reshape(-1, x.shape[2]) @ net["conv"]).reshape(len(x), WINDOW, -1).max(axis=1)
        z = np.maximum(h + net["bias"], 0) @ net["out"] + net["out_bias"]
        z = np.exp(z - z.max(axis=1, keepdims=True))
        out.append(z / z.sum(axis=1, keepdims=True))
    return np.concatenate(out) if out else np.zeros((0, len(net["out_bias"])), np.float32)


def train(windows: np.ndarray, label: np.ndarray, classes: int, *, filters: int = 16, epochs: int = 12,
          batch: int = 64, rate: float = 3e-3, seed: int = 9) -> dict:
    """The network by Adam; the largest value's place alone passes a filter's gradient on."""
    rng = np.random.default_rng(seed)
    total = filters * len(WIDTHS)
    mask = _filter_mask(filters)
    f32 = lambda x: x.astype(np.float32)
    net = {"embed": f32(rng.standard_normal((256, DIM)) * 0.5), "conv": f32(rng.standard_normal((WIDEST * DIM, total)) * 0.25) * mask,
           "bias": np.zeros(total, np.float32), "out": f32(rng.standard_normal((total, classes)) * 0.2),
           "out_bias": np.zeros(classes, np.float32)}
    net["embed"][0] = 0  # byte 0 is also what follows a window's end
    m, s = ({k: np.zeros_like(v) for k, v in net.items()} for _ in range(2))
    t = 0
    for _ in range(epochs):
        order = rng.permutation(len(windows))
        for at in range(0, len(order), batch):
            own = order[at:at + batch]
            win = windows[own].copy()
            short = rng.random(len(own)) < 0.5
            length = np.where(short, rng.integers(12, WINDOW + 1, len(own)), WINDOW)
            win[np.arange(WINDOW)[None, :] >= length[:, None]] = 0
            x = _conv_input(win, net["embed"])
            h = (x.reshape(-1, x.shape[2]) @ net["conv"]).reshape(len(x), WINDOW, total)
            peak = h.argmax(axis=1)
            a = np.take_along_axis(h, peak[:, None], axis=1)[:, 0] + net["bias"]
            r = np.maximum(a, 0)
            z = r @ net["out"] + net["out_bias"]
            p = np.exp(z - z.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(len(own)), label[own]] -= 1
            p /= len(own)
            g = (p @ net["out"].T) * (a > 0)
            xin = x[np.arange(len(own))[:, None], peak]  # (windows, filters, inputs)
            grad = {"out": r.T @ p, "out_bias": p.sum(0), "bias": g.sum(0),
                    "conv": np.einsum("nfi,nf->if", xin, g) * mask, "embed": np.zeros_like(net["embed"])}
            back = np.einsum("nf,if->nfi", g, net["conv"]).reshape(len(own), total, WIDEST, DIM)
            padded = np.zeros((len(own), WINDOW + WIDEST - 1), np.uint8)
            padded[:, :WINDOW] = LOWER[win]
            bytes_ = padded[np.arange(len(own))[:, None, None], peak[:, :, None] + np.arange(WIDEST)]
            np.add.at(grad["embed"], bytes_.ravel(), back.reshape(-1, DIM))
            grad["embed"][0] = 0
            t += 1
            for k, v in grad.items():
                m[k] += 0.1 * (v - m[k])
                s[k] += 0.001 * (v * v - s[k])
                net[k] -= f32(rate * (m[k] / (1 - 0.9 ** t)) / (np.sqrt(s[k] / (1 - 0.999 ** t)) + 1e-8))
    return net


def _cut(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows of all texts, their lengths, and the number of windows of each text."""
    count = np.array([-(-len(t) // WINDOW) for t in texts])
    data = b"".join([t + b"\0" * (-len(t) % WINDOW) for t in texts])
    windows = np.frombuffer(data, np.uint8).reshape(-1, WINDOW)
    length = np.full(len(windows), WINDOW)
    end = np.cumsum(count)
    full = count > 0
    length[end[full] - 1] = np.array([len(t) for t in texts])[full] - (count[full] - 1) * WINDOW
    return windows, length, count


def _sampled_windows(per_document: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zlib
        for part, texts in text_groups(batches, 1):
            lang, key = part.column(2).to_pylist(), part.column(0).to_pylist()
            out = {"lang": [], "window": []}
            for text, name, k in zip(texts, lang, key):
                room = max(0, len(text) - WINDOW)
                for i in range(per_document if room else 1):
                    at = zlib.crc32(f"{k}/{i}".encode()) % (room + 1)
                    out["lang"].append(name)
                    out["window"].append(text[at:at + WINDOW])
            yield pa.RecordBatch.from_arrays([pa.array(out["lang"], pa.string()), pa.array(out["window"], pa.binary())],
                                             names=["lang", "window"])
    return run


def _predictions(net, classes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in text_groups(batches, 1):
            windows, length, count = _cut(texts)
            p = np.zeros((len(texts), classes))
            np.add.at(p, np.repeat(np.arange(len(texts)), count), probabilities(windows, net.value) * length[:, None])
            best = p.argmax(axis=1)
            score = p[np.arange(len(p)), best] / np.maximum(p.sum(axis=1), 1e-12)
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(best.astype(np.int32)), pa.array(np.minimum(score, 1.0))],
                                             names=["key", "best", "score"])
    return run


def identify_language(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                      folds: int = 4, held_out_fold: int = 2, per_language: int = 600, per_document: int = 3) -> DataFrame:
    """One row per input row: id, held_out, lang_pred, score (the predicted language's probability).

    Learned from rows with text and language outside the held-out fold; only the text enters a prediction. Defined
    results: a null text or one without a letter is 'und' with score 0; rows without an id are predicted but never learned
    from; rows that repeat an id are rows of their own; with one known language everything is
    that language, with none everything is 'und'; an empty table gives an empty result; extra columns are
    ignored; whole texts are read. Languages are a small set (one output each).
    """
    spark = docs.sparkSession
    work = WorkTables(spark, "language-id")
    rows = with_row_key(docs, id_col, text_col, work)
    held = in_fold("id", folds, held_out_fold).alias("held_out")
    source = narrow(docs, id_col, text_col, lang_col).toDF("id", "text", "lang")
    learn = source.filter(F.col("id").isNotNull() & F.col("lang").isNotNull() & (F.length("text") > 0)
                          & ~in_fold("id", folds, held_out_fold))
    known = {r["lang"]: r["count"] for r in learn.groupBy("lang").count().collect()}
    langs = sorted(known)
    letter = F.col("text").rlike(r"\p{L}")
    if not langs:
        return rows.select(F.col("id").alias(id_col), held, F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"))
    # about per_language documents of each language, whichever tasks hold them
    rate = F.create_map(*[F.lit(v) for k in langs for v in (k, min(1.0, per_language / known[k]))])
    draw = F.pmod(F.xxhash64(F.lit(9), "id"), F.lit(1 << 40)) / float(1 << 40)
    sample = (learn.filter(draw < F.element_at(rate, F.col("lang"))).select("id", "text", "lang")
              .mapInArrow(_sampled_windows(per_document), "lang string, window binary").orderBy("lang", "window").collect())
    windows = np.zeros((len(sample), WINDOW), np.uint8)
    for k, r in enumerate(sample):
        windows[k, :len(r["window"])] = np.frombuffer(bytes(r["window"]), np.uint8)
    label = np.array([langs.index(r["lang"]) for r in sample])
    net = spark.sparkContext.broadcast(train(windows, label, len(langs)))  # a few kilobytes
    found = rows.withColumn("letter", letter)
    scored = (found.select("id", "text", "letter", held)
              .mapInArrow(_with_columns(_predictions(net, len(langs))), f"id {dict(rows.dtypes)['id']}, held_out boolean, letter boolean, best int, score double"))
    names = F.array(*[F.lit(x) for x in langs])
    return scored.select(
        F.col("id").alias(id_col), "held_out",
        F.when(F.col("letter"), F.element_at(names, F.col("best") + 1)).otherwise("und").alias("lang_pred"),
        F.when(F.col("letter"), F.col("score")).otherwise(0.0).alias("score"))


def _with_columns(predict):
    """Keeps id, letter and held_out beside the predictions (id, text, letter, held_out come in)."""
    def run(batches):
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                part = whole.slice(at, 512)
                done = list(predict(iter([part])))
                best = pa.concat_arrays([d.column(1) for d in done]) if done else pa.array([], pa.int32())
                score = pa.concat_arrays([d.column(2) for d in done]) if done else pa.array([], pa.float64())
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(3), part.column(2), best, score],
                                                 names=["id", "held_out", "letter", "best", "score"])
    return run
