from cases import by_id, digest, frame, odd_docs, sorted_groups
from pyspark.sql import functions as F

from trackcast.llm.exact_dedup import drop_copies, exact_dedup


def brute(docs):
    groups = sorted_groups((t or "", d) for d, t in docs)
    out = []
    for d, t in docs:
        ids = [x for x in groups[t or ""] if x is not None]
        keep = max(ids) if ids else None
        out.append((d, (keep, len(groups[t or ""]), d == keep, digest(t or ""))))
    return sorted_groups(out)


def test_equals_brute_force(spark):
    docs = odd_docs()
    for clash in (False, True):
        rows = exact_dedup(frame(spark, docs, clash)).collect()
        assert by_id(rows, "keep_id", "group_size", "kept", "text_sha256") == brute(docs)


def test_equal_digests_do_not_merge_different_texts(spark):
    docs = odd_docs()
    weak = lambda text: F.pmod(F.length(text), F.lit(5)).cast("string")
    rows = exact_dedup(frame(spark, docs), digest=weak).collect()
    got = by_id(rows, "keep_id", "group_size", "kept")
    assert got == {k: sorted(((a, b, c) for a, b, c, _ in v), key=str) for k, v in brute(docs).items()}


def test_a_hot_text_in_many_partitions(spark):
    docs = [(i, "hot" if i % 3 == 0 else f"t{i}") for i in range(900)]
    rows = exact_dedup(frame(spark, docs).repartition(13)).filter("kept").collect()
    assert len(rows) == 601 and {r["group_size"] for r in rows} == {1, 300}


def test_very_long_texts(spark):
    long = "line of words\n" * 60_000
    docs = [(1, long), (2, long + "x"), (3, long), (4, "x" + long), (5, long[:-1])]
    rows = exact_dedup(frame(spark, docs)).collect()
    assert by_id(rows, "keep_id", "group_size", "kept", "text_sha256") == brute(docs)


def test_drop_copies_keeps_one_row_and_all_columns(spark):
    docs = [(1, "x", "p"), (4, "x", None), (4, "x", "q"), (None, "x", "r"), (2, None, "s"), (3, "", "t"), (None, "only", "u")]
    df = spark.createDataFrame(docs, "doc_id long, text string, key string")
    got = {tuple(r) for r in drop_copies(df).collect()}
    assert got == {(4, "x", "q"), (3, "", "t"), (None, "only", "u")}
    assert drop_copies(df).columns == df.columns


def test_empty_table(spark):
    assert exact_dedup(frame(spark, [])).collect() == [] and drop_copies(frame(spark, [])).collect() == []
