import random
from collections import Counter

import numpy as np
import pytest
from cases import by_id, digest, frame, odd_docs, sorted_groups

from trackcast.llm.suffix_dedup import bucket_names, suffix_dedup


def brute(docs, length):
    data = [(d, (t or "").encode("utf-8")) for d, t in docs]
    seen = Counter(b[i:i + length] for _, b in data for i in range(len(b) - length + 1))
    out = []
    for d, b in data:
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if seen[b[i:i + length]] > 1:
                gone[i:i + length] = b"\1" * length
        spans = sum(1 for i in range(len(b)) if gone[i] and (i == 0 or not gone[i - 1]))
        out.append((d, (len(b), sum(gone), spans, digest(bytes(x for x, g in zip(b, gone) if not g)))))
    return sorted_groups(out)


def values(rows):
    return by_id(rows, "n_bytes", "n_removed", lambda r: len(r["spans"]), lambda r: digest(r["kept"]))


@pytest.mark.parametrize("length, clash", [(20, False), (33, True)])
def test_equals_brute_force(spark, length, clash):
    docs = odd_docs()
    assert values(suffix_dedup(frame(spark, docs, clash), min_bytes=length).collect()) == brute(docs, length)


def test_production_length(spark):
    rng = random.Random(8)
    text = lambda k: "".join(rng.choice("abcdefg hé\n") for _ in range(k))
    shared = text(700)
    docs = [(i, text(rng.randint(0, 400)) + shared[rng.randint(0, 400):][:rng.randint(150, 300)] + text(50)) for i in range(60)]
    docs += [(100, "ab" * 300), (101, shared * 2), (102, None)]
    assert values(suffix_dedup(frame(spark, docs)).collect()) == brute(docs, 200)


def test_a_text_longer_than_a_chunk(spark):
    rng = random.Random(9)
    long = "".join(rng.choice("abcdefghij ") for _ in range(600_000))
    part = long[261_900:262_400]  # across a chunk's end
    rows = suffix_dedup(frame(spark, [(1, long), (2, "zz" + part)])).collect()
    spans = {r["doc_id"]: [(s["start"], s["end"]) for s in r["spans"]] for r in rows}
    assert spans == {1: [(261_900, 262_400)], 2: [(2, 502)]}


@pytest.mark.parametrize("shared, one, other", [(199, "C", "é"), (301, "b", "\u201c"), (250, "d", "ä"), (199, "B", "\u00e9"), (200, "a", "\u00e1")])
def test_strings_that_differ_in_the_top_bit_of_their_last_byte(spark, shared, one, other):
    rng = random.Random(shared)
    text = "".join(rng.choice("abcdefg h") for _ in range(shared))
    docs = [(1, text + one + "tail"), (2, text + other + "end")]
    assert values(suffix_dedup(frame(spark, docs)).collect()) == brute(docs, 200)


def test_names_of_eight_bytes_keep_every_bit():
    base = np.frombuffer(b"abcdefgh", np.uint8)
    for lane in (0, 1):
        names = {int(bucket_names(base, 8, lane)[8][0])}
        for byte in range(8):
            for bit in range(8):
                other = base.copy()
                other[byte] ^= 1 << bit
                names.add(int(bucket_names(other, 8, lane)[8][0]))
        assert len(names) == 65


def test_empty_table(spark):
    assert suffix_dedup(frame(spark, [])).collect() == []
