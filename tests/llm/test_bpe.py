import random

import numpy as np
import pytest
from cases import digest, frame, odd_docs

from trackcast.llm import bpe
from trackcast.llm.queries_text import tokenizer_path


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(tokenizer_path())


@pytest.fixture(scope="module")
def tables():
    return bpe.compile_merges(tokenizer_path())


def ids(raw: bytes) -> list[int]:
    return np.frombuffer(raw, "<u4").tolist()


def test_equals_the_library_on_mixed_texts(tables, library):
    rng = random.Random(1)
    chars = ("abcdefthe ings'  tldvre\n\t.,!?0123456789ÀÉéüßñ²½ªΣσςΑİıŉǅʼń̈  \x85\x1c​漢字かな한국어🙂👍🏽"
             "ﬁÅЖд١Ⅷ①_$#@Ɓɓ")
    pieces = [x.replace("</w>", "") for x in list(tables["vocab"])[:20_000]]
    texts = ["".join(rng.choice(chars) for _ in range(rng.randint(0, 60))) for _ in range(4000)]
    texts += ["".join(rng.choice(pieces) for _ in range(rng.randint(1, 6))) for _ in range(4000)]
    texts += ["a" * k for k in range(1, 200)] + ["ha" * k for k in range(1, 80)] + ["!" * k for k in range(150)]
    texts += ["<|startoftext|> x <|endoftext|>a<|endoftext", "", "  ", "É" * 3000, "x" * 50_000]
    enc = bpe.Encoder(tables)
    for text, want in zip(texts, library.encode_batch(texts, add_special_tokens=False)):
        got = enc.encode(text)
        assert ids(got) == want.ids, text[:80]
        assert enc.decode(got) == library.decode(want.ids, skip_special_tokens=False)


def test_automaton_accepts_only_what_bpe_makes(tables, library):
    """A pair of tokens is a path exactly if the library splits their text into that pair."""
    rng, auto, vocab = random.Random(2), bpe.Automaton(tables), tables["vocab"]
    letters = [x for x in vocab if x.removesuffix("</w>").isascii() and x.removesuffix("</w>").isalpha() and x == x.lower()]
    first = [x for x in letters if not x.endswith("</w>")]
    last = [x for x in letters if x.endswith("</w>")]
    for _ in range(5000):
        a, b = rng.choice(first), rng.choice(last)
        whole = library.encode(a + b[:-4], add_special_tokens=False).ids
        assert auto.arc(vocab[a], vocab[b]) == (whole == [vocab[a], vocab[b]]), (a, b)


def test_words_are_table_steps_forward_only(tables, library):
    """One integer transition per symbol; a word read again asks the automaton nothing; clearing changes no id."""
    rng = random.Random(3)
    words = ["".join(rng.choice("etaoinshrdlu'") for _ in range(rng.randint(1, 14))).strip("'") or "a" for _ in range(3000)]
    enc = bpe.Encoder(tables)
    want = {w: enc.word_ids(w) for w in words}
    assert all(want[w] == library.encode(w, add_special_tokens=False).ids for w in words if "'" not in w)
    stepper = enc.stepper
    assert all(type(k) is int and type(v) is int for t in (stepper.table, stepper.last) for k, v in t.items())
    assert max(v >> 16 for v in stepper.table.values()) < len(stepper.states)
    stepper.auto = None
    assert {w: enc.word_ids(w) for w in words} == want
    small = bpe.Stepper(bpe.Automaton(tables), tables, bpe._byte_alphabet(), keep=40)
    assert {w: small.path(w.encode()) for w in words} == want


def test_every_merge_has_its_gadget(tables):
    assert len(tables["rank"]) == 48_894


def test_frames(spark, library):
    docs = odd_docs()
    coded = bpe.encode(frame(spark, docs, clash=True), tokenizer_path(), carry=("doc_id", "key"))
    back = bpe.decode(coded, tokenizer_path()).collect()
    both = bpe.encode_decode(frame(spark, docs), tokenizer_path()).collect()
    want = sorted((str(d), library.encode(t or "", add_special_tokens=False).ids) for d, t in docs)
    assert sorted((str(r["doc_id"]), r["ids"]) for r in coded.collect()) == want
    text = sorted((str(d), library.decode(i, skip_special_tokens=False)) for d, i in want)
    assert sorted((str(r["doc_id"]), r["text"]) for r in back) == text
    assert sorted((str(r["doc_id"]), r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in both) == sorted(
        (d, len(i), digest(np.array(i, "<u4").tobytes()), digest(library.decode(i, skip_special_tokens=False))) for d, i in want)


def test_empty_table(spark):
    assert bpe.encode(frame(spark, []), tokenizer_path()).collect() == []
