import random

import numpy as np
import pytest
from cases import by_id, digest, frame, sorted_groups

from trackcast.llm.common import pair_name
from trackcast.llm.line_dedup import line_dedup
from trackcast.llm.words import WordNames


def chunks(lines, spread):
    """Line numbers of each chunk; the rolling hash is the operator's own, over one pair of lines at a time."""
    names, out = WordNames(), [[0]]
    h = [names.name(np.frombuffer(x + b"\n", np.uint8), np.array([0]), np.array([len(x)]), 0) for x in lines]
    for i in range(1, len(lines)):
        out[-1].append(i)
        if int(pair_name(h[i - 1].copy(), h[i], 0)[0]) % spread == 0:
            out.append([])
    return [c for c in out if c]


def brute(docs, spread=4):
    first, cut = {}, []
    for key, (d, t) in enumerate(docs):
        lines = (t or "").encode("utf-8").split(b"\n")
        cut.append((d, key, lines, chunks(lines, spread)))
        for c in cut[-1][3]:
            if len(c) > 1:
                text = b"\n".join(lines[i] for i in c)
                place = (d is None, d or 0, key, c[0])
                first[text] = min(first.get(text, place), place)
    out = []
    for d, key, lines, cs in cut:
        gone = {i for c in cs if len(c) > 1 and first[b"\n".join(lines[i] for i in c)] != (d is None, d or 0, key, c[0]) for i in c}
        out.append((d, (len(lines), len(gone), digest(b"\n".join(x for i, x in enumerate(lines) if i not in gone)))))
    return sorted_groups(out)


def cases():
    rng = random.Random(1)
    lines = ["", "a", "bb", "line three", "é", "Line"] + [f"l{i}" for i in range(20)]
    docs = [(i, "\n".join(rng.choice(lines) for _ in range(rng.randint(0, 30)))) for i in range(100)]
    docs += [(400 + i, rng.choice(docs)[1] + "\n" + rng.choice(docs)[1]) for i in range(60)]
    return docs + [(900, None), (901, ""), (902, "\n" * 50), (903, "one line")]


@pytest.mark.parametrize("weak, clash", [(False, True), (True, False)])
def test_equals_brute_force(spark, weak, clash):
    docs = cases()
    name = {"name": lambda a, b: (a % 7, b * 0)} if weak else {}  # a weak name: bytes must decide
    rows = line_dedup(frame(spark, docs, clash), **name).collect()
    assert by_id(rows, "n_lines", "n_removed", lambda r: digest(r["kept"])) == brute(docs)


def test_boundaries_resist_shifts(spark):
    passage = "\n".join(f"sentence number {i} of the passage" for i in range(40))
    docs = [(1, passage), (2, "intro\n" + passage), (3, "a\nb\nc\n" + passage + "\nend")]
    removed = {r["doc_id"]: r["n_removed"] for r in line_dedup(frame(spark, docs)).collect()}
    assert removed[1] == 0 and removed[2] >= 20 and removed[3] >= 20  # half of the passage and more


def test_repeated_ids_and_rows_without_id_keep_one_copy(spark):
    passage = "\n".join(f"line {i}" for i in range(12))
    rows = line_dedup(frame(spark, [(7, passage), (7, passage), (None, passage)])).collect()
    assert sorted(r["n_removed"] for r in rows) == sorted([0, rows[1]["n_removed"], rows[1]["n_removed"]]) or \
        sum(r["n_removed"] == 0 for r in rows) == 1
    assert {r["n_removed"] for r in rows if r["doc_id"] is None} != {0}


def test_empty_table(spark):
    assert line_dedup(frame(spark, [])).collect() == []


def brute_pairs(docs):
    """Every two neighbouring lines that an earlier place has are removed."""
    order = sorted((d is None, d or 0, key, (t or "").split("\n")) for key, (d, t) in enumerate(docs))
    seen, out = set(), []
    for null, d, _, lines in order:
        gone = set()
        for i, pair in enumerate(zip(lines, lines[1:])):
            if pair in seen:
                gone |= {i, i + 1}
            seen.add(pair)
        out.append((None if null else d, (len(lines), len(gone), digest("\n".join(x for i, x in enumerate(lines) if i not in gone)))))
    return sorted_groups(out)


@pytest.mark.parametrize("weak, clash", [(False, True), (True, False)])
def test_every_pair_equals_brute_force(spark, weak, clash):
    docs = cases()
    name = {"name": lambda a, b: (a % 7, b * 0)} if weak else {}
    rows = line_dedup(frame(spark, docs, clash), extend=True, **name).collect()
    assert by_id(rows, "n_lines", "n_removed", lambda r: digest(r["kept"])) == brute_pairs(docs)


def test_query_removes_whole_short_passages(spark, tmp_path):
    from trackcast.llm.queries_dedup import op4_line_dedup
    docs = []
    for i in range(20):  # passages of two to five lines between lines of their own
        passage = [f"passage {i} line {k}" for k in range(2 + i % 4)]
        docs += [(2 * i, "\n".join([f"own {i}", *passage, f"end {i}"])), (2 * i + 1, "\n".join([f"other {i}", *passage, f"last {i}"]))]
    frame(spark, docs).write.parquet(str(tmp_path / "documents.parquet"))
    removed = {r["doc_id"]: r["n_removed"] for r in op4_line_dedup(spark, str(tmp_path)).collect()}
    assert removed == {d: 0 if d % 2 == 0 else 2 + d // 2 % 4 for d, _ in docs}


def test_every_pair_finds_all_repeats_of_the_given_documents(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    rows = line_dedup(df, extend=True).collect()
    docs = [tuple(r) for r in df.collect()]
    assert by_id(rows, "n_lines", "n_removed", lambda r: digest(r["kept"])) == brute_pairs(docs)


def test_a_text_longer_than_a_slice(spark):
    """Runs of 2 and of 900 lines repeated inside a text of 60,000 lines, and a line longer than a slice."""
    rng = random.Random(21)
    lines = [f"line {k} {rng.random()}" for k in range(60_000)]
    lines[40_000:40_900] = lines[100:1000]
    lines[50_000:50_002] = lines[7:9]
    docs = [(1, "\n".join(lines)), (2, "z" * 400_000 + "\n" + "\n".join(lines[39_998:40_003]))]
    rows = {r["doc_id"]: r for r in line_dedup(frame(spark, docs), extend=True).collect()}
    assert rows[1]["kept"].split("\n") == lines[:40_000] + lines[40_900:50_000] + lines[50_002:]
    assert rows[2]["kept"] == "z" * 400_000 and rows[2]["n_lines"] == 6
