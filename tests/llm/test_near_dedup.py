import random
from collections import Counter
from itertools import combinations

import numpy as np
import pytest
from cases import CLASH, WORDS, by_id, frame, sorted_groups
from pyspark.sql import functions as F

from trackcast.llm import near_dedup
from trackcast.llm.components import components
from trackcast.llm.common import WorkTables
from trackcast.llm.near_dedup import drop_near_duplicates, most_odd_bits, near_duplicates

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def sets_of(docs, k):
    out = []
    for _, t in docs:
        w = WORDS.findall((t or "").translate(LOWER))
        out.append({tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set())
    return out


def brute(docs, k):
    sets, parent = sets_of(docs, k), list(range(len(docs)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, j in combinations(range(len(docs)), 2):
        if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
            parent[root(i)] = root(j)
    groups = sorted_groups((root(i), docs[i][0]) for i in range(len(docs)))
    out = []
    for i, (d, _) in enumerate(docs):
        ids = [x for x in groups[root(i)] if x is not None]
        least = min(ids) if ids else None
        out.append((d, (len(sets[i]), least, d == least)))
    return sorted_groups(out)


def near_docs(n=250, seed=4, vocab=300):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(vocab)] + ["A", "a", "É", "é"]
    docs = [(i, " ".join(rng.choice(words) for _ in range(rng.randint(0, 40)))) for i in range(120)]
    for i in range(n):
        w = rng.choice(docs)[1].split()
        for _ in range(rng.randint(0, 3)):
            if w:
                w[rng.randrange(len(w))] = rng.choice(words)
        docs.append((300 + i, " ".join(w).upper() if rng.random() < 0.3 else "\n".join(w)))
    return docs + [(900, None), (901, ""), (902, "  "), (903, "one"), (904, "ONE"), (905, "one two"), (906, "One two"),
                   (None, docs[40][1]), (None, None), (None, "only here"), (None, "only here"), (5, docs[60][1])]


@pytest.mark.parametrize("k, clash", [(2, False), (5, True)])
def test_equals_brute_force(spark, k, clash):
    docs = near_docs()
    rows = near_duplicates(frame(spark, docs, clash), shingle=k).collect()
    assert by_id(rows, "n_shingles", "component_id", "kept") == brute(docs, k)


def test_a_large_group_in_small_blocks(spark):
    rng = random.Random(6)
    base = [f"b{i}" for i in range(120)]
    docs = []
    for i in range(150):  # similarities from 0.5 to 1 around one text
        w = list(base)
        for _ in range(rng.randint(0, 14)):
            w[rng.randrange(len(w))] = f"e{rng.randrange(10_000)}"
        docs.append((i, " ".join(w)))
    rows = near_duplicates(frame(spark, docs), shingle=2, block=16).collect()
    assert by_id(rows, "n_shingles", "component_id", "kept") == brute(docs, 2)


@pytest.mark.parametrize("near, out", [(300, 0), (300, 2), (4, 300), (60, 20)])
def test_a_bucket_of_several_blocks_is_dealt_out_in_proportion(spark, near, out):
    """A large component and outsiders: rows grow with the members, not with members times blocks, and every two members
    of different components meet exactly once."""
    block, m = 100, near + out
    members = spark.range(m).select(
        F.lit(7).cast("long").alias("bucket"), F.lit(0).alias("band"), F.col("id").alias("key"), F.lit(5).cast("long").alias("n"),
        F.lit(-(-m // block)).alias("blocks"), F.when(F.col("id") < near, F.lit(0)).otherwise(F.col("id")).alias("comp"))
    assert near_dedup._alone(members).count() == m
    assert near_dedup._left_over(members, block).count() == (out + 1 if out and m > block else 0)
    rows = near_dedup._against_rest(members, block).collect()
    if not out or m <= block:
        assert len(rows) == (m if out else 0)
    elif out < near:
        assert len(rows) == near + out * (-(-near // block) + 1)
    groups, met = {}, Counter()
    for r in rows:
        groups.setdefault((r["x"], r["y"]), []).append(r)
    for (x, y), own in groups.items():
        met.update(tuple(sorted((r["key"], s["key"]))) for r, s in combinations(own, 2)
                   if r["comp"] != s["comp"] and (x == y or r["blk"] != s["blk"]))
    assert len(met) == near * out + out * (out - 1) // 2 and set(met.values()) <= {1}


def test_sketch_limit_is_not_passed_at_the_threshold():
    """Odd sketches of random pairs at exactly 0.8: XOR counts stay under the limit."""
    from trackcast.llm.common import pair_name
    rng = np.random.default_rng(1)
    for n in (40, 400, 4000, 40_000):
        for _ in range(30):
            names = rng.integers(0, 1 << 64, n, dtype=np.uint64)
            common, rest = names[:n * 8 // 10], names[n * 8 // 10:]
            odd = []
            for own in (rest[::2], rest[1::2]):
                h = np.sort(np.concatenate([common, own]))
                place = h >> np.uint64(54)
                h = h[np.concatenate([[True], place[1:] != place[:-1]])]
                odd.append(np.bincount((pair_name(h, h, 0) >> np.uint64(50)).astype(np.int64) % 1024, minlength=1024) & 1)
            assert (odd[0] != odd[1]).sum() <= most_odd_bits(np.array([n * 1.8]), 0.8)[0]


def test_very_long_texts(spark):
    rng = random.Random(12)
    words = [f"w{rng.randrange(30_000)}" for _ in range(90_000)]
    near, far = list(words), list(words)
    for i in range(0, 90_000, 40):
        near[i] = "n"
    for i in range(0, 90_000, 7):
        far[i] = "f"
    docs = [(1, " ".join(words)), (2, " ".join(near)), (3, " ".join(far)), (4, "A " * 200_000), (5, "a\n" * 150_000)]
    rows = near_duplicates(frame(spark, docs), shingle=2).collect()
    assert by_id(rows, "n_shingles", "component_id", "kept") == brute(docs, 2)


def test_components_of_a_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101), (7, 7)], "a long, b long")
    got = {r["key"]: r["component"] for r in components(links, WorkTables(spark, "t"), "c").collect()}
    assert got == {**{i: 0 for i in range(61)}, 100: 100, 101: 100}


def test_drop_keeps_rows_and_columns(spark):
    docs = near_docs(60)
    df = frame(spark, docs, clash=True)
    out = drop_near_duplicates(df, shingle=2)
    assert out.columns == df.columns
    want = brute(docs, 2)
    kept = {d for d, v in want.items() if d is not None and any(x[2] for x in v)}
    got = [r["doc_id"] for r in out.collect()]
    assert {g for g in got if g is not None} == kept
    assert got.count(5) == sum(x[2] for x in want[5])


def test_empty_table(spark):
    assert near_duplicates(frame(spark, [])).collect() == []
    assert drop_near_duplicates(spark.createDataFrame([], f"doc_id long, text string, {CLASH}")).collect() == []
