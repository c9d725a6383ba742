import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from trackcast.llm import collocations
from trackcast.llm.collocations import mine_collocations, scored, split_words, token_chunks

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
COLS = "doc_id long, text string, lang string"


def brute(docs, top, at_least, cover=80):
    f, total = defaultdict(Counter), Counter()
    for _, text, lang in docs:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(w)
            for n in range(1, 5):
                f[lang].update(tuple(w[i:i + n]) for i in range(len(w) - n + 1))
    out = []
    for lang, c in f.items():
        cands = {p: a for p, a in c.items() if len(p) > 1 and a >= at_least}
        rows = []
        for p, a in cands.items():
            inside = any(100 * b >= cover * a and len(q) > len(p) and any(q[i:i + len(p)] == p for i in range(len(q) - len(p) + 1))
                         for q, b in cands.items())
            if not inside:
                score, _, l, r = min((2_000_000 * a // (c[p[:k]] + c[p[k:]]), k, c[p[:k]], c[p[k:]]) for k in range(1, len(p)))
                rows.append((-score, -a, " ".join(p).encode(), l, r))
        for rank, (s, a, p, l, r) in enumerate(sorted(rows)[:top], 1):
            out.append((lang, rank, p.decode(), -a, l, r, total[lang], -s))
    return sorted(out)


def corpus(seed=5):
    rng = random.Random(seed)
    words = ["a", "bb", "É", "the", "x\x1cy", "Of", "in", "q", "z", "new", "york", "\xa0"]
    phrases = ["New York city Hall", "the end of", "a bb É", "of the of the of", "q q q q q"]

    def text():
        parts = [rng.choice(phrases) if rng.random() < .3 else rng.choice(words) for _ in range(rng.randint(0, 40))]
        return "".join(p + rng.choice([" ", " ", "  ", "\t", ". ", "\n", ","]) for p in parts)

    docs = [(i, text(), rng.choice(["en", "de", None])) for i in range(150)]
    docs += [(200, None, "en"), (201, "", None), (202, "...", "xx"), (None, "the end of", "en"), (3, "the end of", "en"), (3, "the end of", "en")]
    return docs + [(300 + i, "copy right held by us all here.", "fr") for i in range(40)]


@pytest.mark.parametrize("top, frontier, clash", [(5, 3, False), (40, 10, True), (2000, 16_000, False)])
def test_equals_brute_force(spark, top, frontier, clash):
    docs = corpus()
    rows = spark.createDataFrame(docs, COLS)
    if clash:
        for name in ("phrase", "f", "a", "l", "r", "n", "score", "rank", "level", "salt"):
            rows = rows.withColumn(name, F.lit(name))
    got = mine_collocations(rows, top=top, at_least=4, frontier=frontier)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(tuple(r) for r in got.collect()) == brute(docs, top, 4)


@pytest.mark.parametrize("seed", [1, 2])
def test_small_frontiers_change_nothing(spark, seed):
    docs = corpus(seed)
    got = mine_collocations(spark.createDataFrame(docs, COLS).repartition(3), top=12, at_least=3, frontier=4)
    assert sorted(tuple(r) for r in got.collect()) == brute(docs, 12, 3)


def test_false_hits_and_small_batches_change_nothing(spark, monkeypatch):
    monkeypatch.setattr(collocations, "BITS", 7)
    monkeypatch.setattr(collocations, "HELD", 20)
    monkeypatch.setattr(collocations, "VOCABULARY", 9)
    docs = corpus(9)
    got = mine_collocations(spark.createDataFrame(docs, COLS), top=10, at_least=3, frontier=8)
    assert sorted(tuple(r) for r in got.collect()) == brute(docs, 10, 3)


def test_a_text_longer_than_a_chunk(spark, monkeypatch):
    monkeypatch.setattr(collocations, "LIST", 1 << 16)
    rng = random.Random(2)
    long = "".join(rng.choice(["ab ", "cde ", "fg ", "hij. ", "É\t", "k\n"]) for _ in range(300_000))
    docs = [(1, long, "en"), (2, "x" * 400_000 + " ab", "en"), (3, "ab " * 200_000, "de")]
    assert len(list(token_chunks([long.encode()], 3))) > 3
    got = mine_collocations(spark.createDataFrame(docs, COLS), frontier=50, top=60)
    assert sorted(tuple(r) for r in got.collect()) == brute(docs, 60, 30)


def test_words_of_a_chunk():
    for chunk in (b"", b" ", b"a", b" a  b a\xff \x00 ", b"a b a"):
        words, at = split_words(chunk)
        assert [words[k] for k in at if words[k]] == chunk.split()
        assert len(set(words)) == len(words)


def test_products_beyond_64_bits(spark):
    big = 7 * 10 ** 13 + 1
    one = spark.createDataFrame([("en", "a", big + 5), ("en", "b", big + 2)], "lang string, phrase string, f long")
    row = scored(spark.createDataFrame([("en", "a b", big)], "lang string, phrase string, f long"), one).first()
    assert (row["score"], row["bound"]) == (2_000_000 * big // (2 * big + 7), 2_000_000 * big // (2 * big + 5))


def test_empty_table(spark):
    assert mine_collocations(spark.createDataFrame([], COLS)).collect() == []
