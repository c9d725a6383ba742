import pytest
from cases import WORDS, by_id, digest, frame, odd_docs, sorted_groups

from trackcast.llm.substring_dedup import substring_dedup


def brute(docs, window):
    words = [(d, WORDS.findall(t or "")) for d, t in docs]
    first = {}
    for d, w in words:
        for i in range(len(w) - window + 1 if d is not None else 0):
            k = tuple(w[i:i + window])
            first[k] = min(first.get(k, d), d)
    out = []
    for d, w in words:
        gone = set()
        for i in range(len(w) - window + 1 if d is not None else 0):
            if first[tuple(w[i:i + window])] < d:
                gone.update(range(i, i + window))
        out.append((d, (len(w), len(gone), digest(" ".join(x for i, x in enumerate(w) if i not in gone)))))
    return sorted_groups(out)


@pytest.mark.parametrize("window, clash", [(8, False), (10, True)])
def test_equals_brute_force(spark, window, clash):
    docs = odd_docs()
    rows = substring_dedup(frame(spark, docs, clash), window=window).collect()
    assert by_id(rows, "n_words", "n_removed", lambda r: digest(r["kept"])) == brute(docs, window)


def test_whole_small_table_and_a_very_long_text(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    long = " ".join(f"w{i}" for i in range(120_000))
    docs = [tuple(r) for r in rows] + [(10_000, long), (10_001, "x " + long)]
    got = by_id(substring_dedup(frame(spark, docs)).collect(), "n_words", "n_removed", lambda r: digest(r["kept"]))
    assert got == brute(docs, 50) and got[10_001][0][:2] == (120_001, 120_000)


def test_empty_table(spark):
    assert substring_dedup(frame(spark, [])).collect() == []
