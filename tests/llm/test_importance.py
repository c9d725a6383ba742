import math
import random
import re
from collections import Counter
from hashlib import sha256
from zlib import crc32

import pytest
from cases import DOCS, frame, odd_docs

from trackcast.llm.importance import importance_resample, word_lists

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def features(text):
    low = bytes(b + 32 if 65 <= b <= 90 else b for b in (text or "").encode("utf-8"))
    words = WORD.findall(low)
    return len(words), [crc32(f) % 10_000 for f in words + [a + b" " + b for a, b in zip(words, words[1:])]]


def brute(docs, target, min_words=20):
    s, t = Counter(), Counter()
    for _, text in docs:
        s.update(features(text)[1])
    for text in target:
        t.update(features(text)[1])
    S, T = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (S + 10_000) / ((s[b] + 1) * (T + 10_000)))) for b in range(10_000)]
    rows = []
    for key, text in docs:
        words, f = features(text)
        weight = sum(gain[b] for b in f) // len(f) if f else 0
        h = int(sha256(f"7:{'' if key is None else key}".encode()).hexdigest()[:8], 16)
        rows.append([key, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), words >= min_words])
    able = sorted((r for r in rows if r[4]), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    places = {id(r): k for k, r in enumerate(able[:25 * len(able) // 100], 1)}
    return sorted([(*r[:4], places.get(id(r))) for r in rows], key=repr)


@pytest.mark.parametrize("clash", [False, True])
def test_equals_brute_force(spark, clash):
    docs = odd_docs(alphabet=("a", "bb", "É", "x\x1cy", "the", "%%", "A", "q1", "z-z")) + [(5, "one two " * 30), (5, "one two " * 30)]
    target = ["the bb q1 " * 5, "", None, "É the", "the bb q1"]
    got = importance_resample(frame(spark, docs, clash), spark.createDataFrame([(i, t) for i, t in enumerate(target)], "item_id long, text string"))
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert sorted([tuple(r) for r in got.collect()], key=repr) == brute(docs, target)


def test_ranks_over_many_ranges(spark):
    rng = random.Random(4)
    docs = [(i % 400, " ".join(rng.choice("abcdefgh") for _ in range(rng.randint(15, 40)))) for i in range(800)]
    docs += [(None, "a b c d e " * 5)] * 400  # a third of all rows under one key and one text
    got = importance_resample(frame(spark, docs).repartition(13), spark.createDataFrame([("a b c",)], "text string")).collect()
    want = brute(docs, ["a b c"])
    assert sorted(r["rank"] for r in got if r["rank"]) == sorted(r[4] for r in want if r[4])
    # rows with one id and one score may change places with one another
    assert sorted((repr(r["doc_id"]), r["score"], r["rank"]) for r in got if r["rank"]) == sorted((repr(r[0]), r[3], r[4]) for r in want if r[4])


def test_a_text_longer_than_a_list(spark):
    rng = random.Random(6)
    text = " ".join(rng.choice(["ab", "cde", "fghij", "É"]) for _ in range(200_000)) + " " + "x" * 300_000 + " end"
    assert len(list(word_lists(text.encode()))) > 3
    docs = [(1, text), (2, "ab cde " * 20)]
    got = importance_resample(frame(spark, docs), spark.createDataFrame([("ab cde",)], "text string"))
    assert sorted([tuple(r) for r in got.collect()], key=repr) == brute(docs, ["ab cde"])


def test_empty_tables(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    assert importance_resample(frame(spark, []), none).collect() == []
    docs = [(1, "a b " * 20), (2, None)]
    got = importance_resample(spark.createDataFrame(docs, DOCS), none)
    assert sorted([tuple(r) for r in got.collect()], key=repr) == brute(docs, [])
