import random
import zlib

from trackcast.llm.toxicity import drop_toxic, score_toxicity

LABELS = "doc_id long, quality int, toxic int, text string"


def fold(i, n):
    return zlib.crc32(str(i).encode()) % n


def corpus(n=600):
    plain = "the river runs past the old mill and the town keeps its market on the square every week in summer".split()
    bad = ["snarl", "vermin", "filth"]
    docs, labels, rng = [], [], random.Random(3)
    for i in range(n):
        words = [rng.choice(plain) for _ in range(20 + i % 30)]
        toxic = i % 6 == 0
        if toxic:
            for k in range(0, len(words), 9):
                words.insert(k, bad[(i // 6 + k) % 3])
        docs.append((i, " ".join(words), "x", 1))
        if i % 4:
            labels.append((i, 0, int(toxic), "clash"))
    return docs, labels


def frames(spark, docs, labels):
    return (spark.createDataFrame(docs, "doc_id long, text string, toxic string, score int"),
            spark.createDataFrame(labels, LABELS))


def test_held_out_rows_are_told_apart(spark):
    docs, labels = corpus()
    rows = score_toxicity(*frames(spark, docs, labels)).collect()
    assert len(rows) == len(docs)
    for r in rows:
        assert r["held_out"] == (fold(r["doc_id"], 5) == 0)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5)
        assert r["predicted"] == int(r["doc_id"] % 6 == 0)


def test_held_out_labels_are_not_learned(spark):
    docs, labels = corpus(240)
    a = score_toxicity(*frames(spark, docs, labels)).collect()
    turned = [(i, q, 1 - t if fold(i, 5) == 0 else t, x) for i, q, t, x in labels]
    b = score_toxicity(*frames(spark, docs, turned)).collect()
    assert {(r["doc_id"], r["score"]) for r in a} == {(r["doc_id"], r["score"]) for r in b}


def test_accuracy_on_the_given_labels(spark):
    d = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{d}/labels.parquet")
    rows = {r["doc_id"]: r for r in score_toxicity(spark.read.parquet(f"{d}/documents.parquet"), labels).collect()}
    known = [(rows[r["doc_id"]], r["toxic"]) for r in labels.collect()]
    right = sum(r["predicted"] == t for r, t in known)
    assert len(rows) == 1000 and right / len(known) >= 0.9  # about one label in twenty is wrong


def test_odd_rows(spark):
    docs, labels = corpus(240)
    docs += [(None, "vermin filth snarl vermin", "x", 1), (5000, None, None, None), (5001, "", None, None), (7, docs[7][1], "x", 1)]
    labels += [(None, 0, 1, None), (8, 0, None, None), (9, 0, 0, None), (9, 0, 1, None), (999_999, 0, 1, None)]
    rows = score_toxicity(*frames(spark, docs, labels)).collect()
    assert len(rows) == len(docs)
    assert [r["predicted"] for r in rows if r["doc_id"] is None] == [1]
    assert all(r["score"] is not None for r in rows)
    kept = drop_toxic(*frames(spark, docs, labels))
    assert kept.columns == ["doc_id", "text", "toxic", "score"]
    assert kept.count() == sum(r["predicted"] == 0 for r in rows)


def test_without_both_classes_and_empty(spark):
    docs, labels = corpus(20)
    one, _ = frames(spark, docs, labels)
    none = spark.createDataFrame([], LABELS)
    assert {r["score"] for r in score_toxicity(one, none).collect()} == {0.5}
    clean = spark.createDataFrame([(i, 0, 0, None) for i in range(20)], LABELS)
    assert {(r["score"], r["predicted"]) for r in score_toxicity(one, clean).collect()} == {(0.0, 0)}
    assert score_toxicity(one.limit(0), spark.createDataFrame(labels, LABELS)).collect() == []


def spell(k):
    """A word of letters for each number (digits separate words)."""
    return "".join(chr(97 + int(c)) for c in str(k))


def phrases():
    """Toxic documents hold a word that always follows the same four words, or three ordinary words in an order of their own."""
    docs, labels, rng = [], [], random.Random(5)
    plain = [f"word{spell(k)}" for k in range(40)] + ["go", "back", "home"]
    for i in range(900):
        words = [rng.choice(plain) for _ in range(12)]
        toxic = i % 6 == 0
        if toxic:
            words[6:6] = ["may", "your", "whole", "kin", "rotgrave"] if i % 12 else ["go", "back", "home"] * 2
        elif i % 3 == 0:
            words[6:6] = ["may", "your", "whole", "kin", "prosper"]
        docs.append((i, " ".join(words), "x", 1))
        labels.append((i, 0, int(toxic), "clash"))
    return docs, labels


def test_set_phrases_and_phrases_of_ordinary_words(spark):
    docs, labels = phrases()
    rows = {r["doc_id"]: r["predicted"] for r in score_toxicity(*frames(spark, docs, labels)).collect()}
    held = [i for i, *_ in docs if fold(i, 5) == 0]
    word = [i for i in held if i % 6 == 0 and i % 12]
    phrase = [i for i in held if i % 12 == 0]
    assert word and all(rows[i] for i in word)  # its only left context is "kin"
    assert sum(rows[i] for i in phrase) >= 0.8 * len(phrase)
    assert sum(rows[i] for i in held if i % 6) <= 0.05 * len(held)


def test_rarity_is_judged_over_both_classes(spark):
    from trackcast.llm.common import WorkTables
    from trackcast.llm.toxicity import fit_models
    from trackcast.llm.words import WordNames
    import numpy as np
    learn = [(f"left{spell(i)} calm odd{spell(i)}", 0) for i in range(200)] + [(f"left{spell(i)} snarl", 1) for i in range(100)]
    x = {r["key"]: r["x"] for r in fit_models(
        spark.createDataFrame(learn, "text string, toxic int"), WorkTables(spark, "t"), 5).collect()}
    key = lambda w: int(WordNames().name(np.frombuffer(w.encode(), np.uint8), np.array([0]), np.array([len(w)]), 0).view(np.int64)[0])
    assert x[key("calm")] < -1 and x[key("snarl")] > 1  # calm has no toxic context at all
    assert key("odd" + spell(7)) not in x


def test_joined_ratios_score_as_shipped_ones(spark):
    docs, labels = corpus(240)
    docs += [(None, "vermin filth snarl", "x", 1), (5000, None, None, None), (7, docs[7][1], "x", 1)]
    a, b, c = (sorted((str(r["doc_id"]), round(r["score"], 4)) for r in score_toxicity(*frames(spark, docs, labels), ship=k).collect())
               for k in (2_000_000, 10, 0))
    assert a == b == c
    kept = drop_toxic(*frames(spark, docs, labels), ship=10)
    assert kept.columns == ["doc_id", "text", "toxic", "score"] and kept.count() == sum(s < 0.5 for _, s in a)


def test_names_do_not_run_out(spark):
    """Words that share their first 22 bits of name keep counts and ratios of their own."""
    import numpy as np
    from trackcast.llm.words import WordNames
    names, seen, pair = WordNames(), {}, None
    for k in range(100_000):
        w = spell(k)
        n = int(names.name(np.frombuffer(w.encode(), np.uint8), np.array([0]), np.array([len(w)]), 0)[0]) >> 42
        if n in seen:
            pair = (seen[n], w)
            break
        seen[n] = w
    good, bad = pair
    docs = [(i, f"left{spell(i % 50)} {bad if i % 4 == 0 else good} right{spell(i % 7)}", "x", 1) for i in range(800)]
    rows = score_toxicity(*frames(spark, docs, [(i, 0, int(i % 4 == 0), None) for i in range(800)])).collect()
    assert all(r["predicted"] == int(r["doc_id"] % 4 == 0) for r in rows)


def test_a_very_long_text_is_scored_whole(spark):
    """What makes the difference stands at the end of a text of 200,000 words: toxic words there raise the score."""
    docs, labels = corpus()
    plain = docs[1][1]
    calm = " ".join([plain] * 9000)
    docs = docs + [(90_001, calm, "x", 1), (90_002, calm + " snarl vermin filth" * 60_000, "x", 1)]
    rows = {r["doc_id"]: r["score"] for r in score_toxicity(*frames(spark, docs, labels)).collect()}
    assert rows[90_002] > 0.5 > rows[90_001]
