import zlib

import numpy as np

from trackcast.llm.language_id import WINDOW, _cut, identify_language

SCHEMA = "doc_id long, text string, lang string, key string, score int"


def fold(i):
    return zlib.crc32(str(i).encode()) % 4


def frame(spark, rows):
    return spark.createDataFrame([(*r, "z", None) for r in rows], SCHEMA)


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    lang = {r["doc_id"]: r["lang"] for r in docs.select("doc_id", "lang").collect()}
    rows = identify_language(docs).collect()
    held = [r for r in rows if r["held_out"]]
    assert len(rows) == 1000 and all(r["held_out"] == (fold(r["doc_id"]) == 2) for r in rows)
    assert sum(r["lang_pred"] == lang[r["doc_id"]] for r in held) / len(held) >= 0.97
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_odd_rows(spark):
    plain = [(i, ("the cat sat on the mat " if i % 2 else "der hund lag auf dem sofa ") * (i % 9 + 2), "en" if i % 2 else "de")
             for i in range(120)]
    odd = [(500, None, "en"), (501, "", "en"), (502, "12 !! 3.4", "de"), (503, "der hund lag auf dem sofa", None),
           (None, "the cat sat on the mat " * 3, "de"), (7, plain[7][1], "en"), (504, "the cat sat on the mat " * 20_000, None)]
    rows = identify_language(frame(spark, plain + odd)).collect()
    assert len(rows) == len(plain) + len(odd)
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in rows}
    assert all(got[i] == ("und", 0.0) for i in (500, 501, 502))
    assert got[503][0] == "de" and got[504][0] == "en" and got[None][0] == "en"
    assert all(got[i][0] == lang for i, _, lang in plain)


def test_windows_cover_every_byte():
    texts = [b"", b"a" * WINDOW, b"b" * (WINDOW + 1), b"c" * 5]
    windows, length, count = _cut(texts)
    assert count.tolist() == [0, 1, 2, 1] and length.tolist() == [WINDOW, WINDOW, 1, 5]
    assert np.array_equal(windows[2][:2], [ord("b"), 0])


def test_unknown_and_empty(spark):
    rows = identify_language(frame(spark, [(1, "abc", None), (2, None, "en")])).collect()
    assert {(r["doc_id"], r["lang_pred"]) for r in rows} == {(1, "und"), (2, "und")}
    assert identify_language(frame(spark, [])).collect() == []
