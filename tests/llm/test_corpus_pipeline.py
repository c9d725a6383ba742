"""Every stage against a brute-force form over the same input, and the pipeline as a whole."""

import corpus_pipeline
import numpy as np
import pytest
from cases import digest

from test_near_dedup import sets_of

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def steps(spark):
    """Rows after each stage."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs.collect()]
    for name, stage in corpus_pipeline.STAGES:
        df = stage(spark, docs, SF)
        out.append(df.collect())
        docs = spark.createDataFrame(out[-1], df.schema)
        if name != "bpe":
            assert df.columns == COLUMNS
    return out


def test_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "exact_dedup", "near_dedup", "mixing", "bpe"]


def test_toxicity(spark, steps):
    from trackcast.llm.toxicity import score_toxicity
    scores = score_toxicity(spark.createDataFrame(steps[0]), spark.read.parquet(f"{SF}/labels.parquet")).collect()
    assert {r["doc_id"] for r in steps[1]} == {r["doc_id"] for r in scores if r["predicted"] == 0}


def test_exact(steps):
    last = {}
    for r in steps[1]:
        last[r["text"]] = max(last.get(r["text"], -1), r["doc_id"])
    assert sorted(r["doc_id"] for r in steps[2]) == sorted(last.values())


def test_near(steps):
    docs = sorted((r["doc_id"], r["text"]) for r in steps[2])
    sets, kept = sets_of(docs, 5), {r["doc_id"] for r in steps[3]}
    near = lambda a, b: bool(a) and 100 * len(a & b) >= 80 * len(a | b)
    parent = {d: d for d, _ in docs}
    for i in range(len(docs)):
        for j in range(i):
            if near(sets[i], sets[j]):
                a, b = parent[docs[i][0]], parent[docs[j][0]]
                parent = {k: min(a, b) if v in (a, b) else v for k, v in parent.items()}
    assert kept == set(parent.values())


def test_mixing(spark, steps):
    from collections import Counter

    from trackcast.llm.mixing import mix_to_weights
    times = {r["doc_id"]: r["times"] for r in mix_to_weights(spark.createDataFrame(steps[3])).collect()}
    assert Counter(r["doc_id"] for r in steps[4]) == Counter({d: t for d, t in times.items() if t})


def test_bpe(steps):
    from tokenizers import Tokenizer
    from trackcast.llm.queries_text import tokenizer_path
    lib = Tokenizer.from_file(tokenizer_path())
    text = {r["doc_id"]: r["text"] for r in steps[4]}
    assert len(steps[5]) == len(steps[4])
    for r in steps[5]:
        want = lib.encode(text[r["doc_id"]], add_special_tokens=False).ids
        assert r["ids"] == want and r["n_tokens"] == len(want)
        assert r["ids_sha256"] == digest(np.array(want, "<u4").tobytes())
        assert r["decoded_sha256"] == digest(lib.decode(want, skip_special_tokens=False))


def test_run_is_the_stages(spark, steps):
    got = corpus_pipeline.run(spark, SF)
    assert sorted((r["doc_id"], r["ids_sha256"]) for r in got.collect()) == sorted(
        (r["doc_id"], r["ids_sha256"]) for r in steps[5])


def test_odd_rows_pass_all_stages(spark):
    rows = [(1, None, None, None, None), (None, "some text here", "en", None, 3), (2, "", "en", "a", 0), (2, "", "en", "a", 0),
            (3, "other words in this one", None, "b", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
        docs = spark.createDataFrame(docs.collect(), docs.schema)
    assert {r["doc_id"] for r in docs.collect()} >= {3}
    none = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    for name, stage in corpus_pipeline.STAGES:
        none = stage(spark, none, SF)
        assert none.collect() == []


def test_a_very_long_text_and_a_clashing_column_pass_all_stages(spark):
    """A text beyond any chunk and extra columns by names that stages use: kept whole and equal to the library's ids."""
    import random

    from cases import WORDS
    from tokenizers import Tokenizer
    from trackcast.llm.queries_text import tokenizer_path
    rng = random.Random(4)
    words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 9))) for _ in range(5000)]
    long = " ".join(rng.choice(words) for _ in range(120_000))
    other = [" ".join(rng.choice(words) for _ in range(400)) for _ in range(12)]
    rows = [(900_001, long, "en", "a", len(long)), (900_002, long, "en", "a", len(long)), (900_003, long + " more", "en", "a", 5)]
    rows += [(900_010 + i, t, "en", "ab"[i % 2], len(t)) for i, t in enumerate(other)]
    clash = ("key", "row_key", "times", "component", "rank")
    docs = spark.createDataFrame([(*r, *("z" for _ in clash)) for r in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} string" for c in clash))
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = stage(spark, docs, SF)
        if name != "bpe":
            assert docs.columns == before.columns, name
        docs = spark.createDataFrame(docs.collect(), docs.schema)
        if name == "exact_dedup":
            assert {r["doc_id"] for r in docs.collect()} == {r[0] for r in rows} - {900_001}
        if name == "near_dedup":  # the longer copy is near the one kept
            assert {r["doc_id"] for r in docs.collect()} == {r[0] for r in rows} - {900_001, 900_003}
    lib, text = Tokenizer.from_file(tokenizer_path()), {r[0]: r[1] for r in rows}
    out = docs.collect()
    assert out and all(r["ids"] == lib.encode(text[r["doc_id"]], add_special_tokens=False).ids for r in out)
    assert len(WORDS.findall(long)) == 120_000
