"""Operator 3: BPE encoding and decoding with a tokenization automaton.

The merge list is compiled into a deterministic automaton over tokens whose
accepted paths are exactly the token sequences BPE produces. It starts as one state with a loop
for every single symbol. Each merge ``u v -> w``, in order of rank, is applied as a gadget:

* every ``u`` arc is redirected to a copy of its target that lacks the ``v`` arc
  (after ``u``, a ``v`` can no longer follow);
* every state with a ``u`` arc gets a ``w`` arc to where ``u`` and then ``v`` led.

All arcs with one label end in one state, so a state is named by the token
that leads to it, and a copy differs from its original by one missing arc. The
table therefore holds one row per merge (left part, right part, rank); whether
a state has an arc is read by undoing the gadgets that concern the two tokens, newest
first (``Automaton.arc``); no table of all arcs is built, as most tokens may follow most others. Exactly one path spells a given
word, and every prefix has its own single path.

To encode, the automaton is read symbol by symbol (``Stepper``). What is to come depends on the symbols read only by the longest end of them
that some token begins with, and by the last token of the path of each prefix that ends in there: that is a state. Reading a symbol leads to
the next state and says the last token of the path so far, which is the one token ending there that may
follow the path before it. States and transitions are integers in a table that is filled when one is first needed, so a
word is one table step per symbol, forward only; its tokens are then read off from its end, each saying where
the one before it ends. Decoding emits the labels of the path's arcs.

Text is split beforehand as the tokenizer file says (special tokens, canonical
composition, lower case, then words), which is fixed behaviour of the file.
"""

from __future__ import annotations

import json
import re
import unicodedata
from array import array
from itertools import accumulate
from typing import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trackcast.llm.common import narrow

END = "</w>"
#: The pattern and white space of the tokenizer file's pre-tokenizer.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
SPACE = "\\t\\n\\v\\f\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
#: The same pattern with the classes written out for texts up to U+017F, for the faster standard module.
LATIN_LETTERS = "A-Za-zªµºÀ-ÖØ-öø-\\u017f"
LATIN_NUMBERS = "0-9²³¹¼½¾"


def compile_merges(path: str) -> dict:
    """The automaton's tables from a tokenizer file, as plain dictionaries and lists.

    The file bounds their size (49 thousand tokens here). Only what the file declares is
    supported: BPE with an end-of-word suffix over the byte alphabet.
    """
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model = spec["model"]
    splits = [p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split"]
    norms = [n["type"] for n in spec["normalizer"]["normalizers"]]
    if (model["type"], model["end_of_word_suffix"], splits, norms) != (
            "BPE", END, [SPLIT], ["NFC", "Replace", "Lowercase"]):
        raise ValueError(f"{path}: not a word-end BPE file of the supported form")
    vocab = model["vocab"]
    n = max([*vocab.values(), *(t["id"] for t in spec["added_tokens"])]) + 1
    labels = [""] * n
    for label, i in vocab.items():
        labels[i] = label
    for t in spec["added_tokens"]:
        labels[t["id"]] = t["content"]
    alive = set(vocab.values())
    auto = Automaton({"left": array("i", [-1]) * n, "right": array("i", [-1]) * n, "born": array("i", [-1]) * n,
                      "rank": {}})
    for t, (a, b) in enumerate(tuple(m) if not isinstance(m, str) else m.split(" ") for m in model["merges"]):
        u, v = vocab[a], vocab[b]
        w = vocab[a.removesuffix(END) + b if a.endswith(END) else a + b]
        if not auto.gadget(t, u, v, w):
            alive.discard(w)
    vocab = {label: i for label, i in vocab.items() if i in alive}  # a token without a gadget is on no path
    if n > 1 << 16:
        raise ValueError(f"{path}: more than 65,536 tokens")
    return {"vocab": vocab, "labels": labels, "special": {t["content"]: t["id"] for t in spec["added_tokens"]},
            "left": auto.left, "right": auto.right, "born": auto.born, "rank": auto.rank}


class Automaton:
    """States are named by the token whose arcs lead to them; -1 is the start state.

    ``rank[u, v]`` is the rank of a gadget, ``left``, ``right`` and ``born`` are a token's parts and
    rank (-1 for single symbols).
    """

    def __init__(self, tables: dict):
        self.left, self.right, self.born = tables["left"], tables["right"], tables["born"]
        self.rank: dict = tables["rank"]
        self.table: dict[tuple[int, int], bool] = {}

    def gadget(self, t: int, u: int, v: int, w: int) -> bool:
        """Apply merge number t; False, and nothing changes, where no path has u and then v."""
        if not self.undo(u, v, t):
            return False
        self.rank[u, v] = t
        self.left[w], self.right[w], self.born[w] = u, v, t
        return True

    def undo(self, state: int, token: int, t: int) -> bool:
        """Has the state that ``state`` arcs led to before gadget t an arc for ``token``?

        The newest gadget either made the state (a copy without one arc) or
        the token (an arc beside that of its left part); it is undone and the question asked again.
        """
        rank, born = self.rank, self.born
        while True:
            r = rank.get((state, token))
            if r is not None and r < t:
                return False
            made, new = born[state], born[token]
            if made > new:  # the state began as that of its right part at the time
                state, t = self.right[state], made
            elif new >= 0:  # the token's arc was added beside its left part's
                token, t = self.left[token], min(t, new + 1)
            else:
                return True

    def arc(self, state: int, token: int) -> bool:
        """Whether ``token`` may follow ``state`` in the end; a memo of what was asked (bounded by clearing)."""
        key = (state, token)
        known = self.table.get(key)
        if known is None:
            if len(self.table) > 400_000:
                self.table.clear()
            known = self.table[key] = self.undo(state, token, 1 << 30)
        return known


class Stepper:
    """Transitions over symbols (bytes): ``table[state << 8 | byte]`` is ``next << 16 | token``, ``last`` the same for a word's
    last byte (the token only). Both are derived from the automaton when first asked for, and cleared at a word's
    start beyond ``keep`` entries."""

    def __init__(self, auto: Automaton, tables: dict, alphabet: dict[int, str], keep: int = 400_000):
        self.auto, self.vocab, self.keep = auto, tables["vocab"], keep
        self.symbols = [alphabet[b] for b in range(256)]
        self.begins = {label[:k] for label in self.vocab for k in range(1, len(label.removesuffix(END)))}
        self.size = {t: len(label.removesuffix(END)) for label, t in self.vocab.items()}
        self.clear()

    def clear(self) -> None:
        """State 0: nothing read, on no token (-1)."""
        self.states, self.number = [("", (-1,))], {("", (-1,)): 0}
        self.table: dict[int, int] = {}
        self.last: dict[int, int] = {}

    def token(self, read: str, before: tuple, end: str) -> int:
        """The token that ends the path, among those that end in ``read``; ``before[k]`` is the last token of the path up to ``read[k:]``."""
        for k, own in enumerate(before):
            t = self.vocab.get(read[k:] + end)
            if t is not None and (own < 0 or self.auto.arc(own, t)):
                return t
        raise ValueError(f"no path spells a word that ends in {read!r}")

    def step(self, state: int, byte: int) -> int:
        read, before = self.states[state]
        read += self.symbols[byte]
        t = self.token(read, before, "")
        k = 0
        while k < len(read) and read[k:] not in self.begins:
            k += 1
        new = read[k:], (*before, t)[k:]
        at = self.number.get(new)
        if at is None:
            at = self.number[new] = len(self.states)
            self.states.append(new)
        out = self.table[state << 8 | byte] = at << 16 | t
        return out

    def path(self, word: bytes) -> list[int]:
        """The tokens of the one path that spells ``word``."""
        if len(self.table) + len(self.last) > self.keep:
            self.clear()
        table, state, tokens = self.table, 0, []
        for byte in word[:-1]:
            found = table.get(state << 8 | byte)
            if found is None:
                found = self.step(state, byte)
            state = found >> 16
            tokens.append(found & 0xFFFF)
        key = state << 8 | word[-1]
        t = self.last.get(key)
        if t is None:
            read, before = self.states[state]
            t = self.last[key] = self.token(read + self.symbols[word[-1]], before, END)
        out, at, size = [t], len(word) - self.size[t], self.size
        while at:
            t = tokens[at - 1]
            out.append(t)
            at -= size[t]
        out.reverse()
        return out


class Encoder:
    """Encodes and decodes texts; keeps the words it has met (at most ``keep``)."""

    def __init__(self, tables: dict, keep: int = 300_000):
        import regex
        self.labels = tables["labels"]
        self.stepper = Stepper(Automaton(tables), tables, _byte_alphabet())
        self.special, self.keep = tables["special"], keep
        self.known: dict[str, bytes] = {}
        self.between = re.compile("(" + "|".join(map(re.escape, self.special)) + ")")
        self.beyond = re.compile("[^\\x00-\\u017f]")
        self.latin = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{LATIN_LETTERS}]+|[{LATIN_NUMBERS}]"
                                f"|[^{SPACE}{LATIN_LETTERS}{LATIN_NUMBERS}]+")
        self.any = regex.compile(SPLIT.replace(r"[^\s", f"[^{SPACE}"))

    def words(self, text: str) -> list[str]:
        """Normalised words of a text without special tokens."""
        if self.beyond.search(text) is None:
            return self.latin.findall(text.lower())
        text = unicodedata.normalize("NFC", text)
        # lower case by character: no final form of sigma
        return self.any.findall(text.replace("Σ", "σ").lower())

    def word_ids(self, word: str) -> list[int]:
        """The token ids of one word."""
        return self.stepper.path(word.encode("utf-8"))

    def encode(self, text: str) -> bytes:
        """Token ids of a text as little-endian unsigned 32-bit integers."""
        known, parts = self.known, []
        for piece in self.between.split(text) if "<|" in text else (text,):
            if piece in self.special:
                parts.append(self.special[piece].to_bytes(4, "little"))
                continue
            for w in self.words(piece):
                ids = known.get(w)
                if ids is None:
                    ids = b"".join([i.to_bytes(4, "little") for i in self.word_ids(w)])
                    if len(w) <= 64:
                        if len(known) >= self.keep:
                            known.clear()
                        known[w] = ids
                parts.append(ids)
        return b"".join(parts)

    def decode(self, ids: bytes) -> str:
        """The labels of the arcs, joined by spaces (the file declares no decoder); special tokens stay."""
        import numpy as np
        return " ".join(map(self.labels.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def _byte_alphabet() -> dict[int, str]:
    """The byte-level alphabet: printable bytes stand for themselves, the others follow from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    table = {b: chr(b) for b in plain}
    return table | {b: chr(256 + k) for k, b in enumerate(b for b in range(256) if b not in table)}


def _shipped(spark: SparkSession, path: str):
    """The compiled tables as a broadcast; the file bounds them (about 3 MB)."""
    return spark.sparkContext.broadcast(compile_merges(path))


def encode(docs: DataFrame, path: str, *, text_col: str = "text", carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """One row per input row: the carried columns, n_tokens, ids (array of token ids).

    Defined results: a null text counts as empty and gives no token, as does one of white space only;
    ids and repeated rows are passed through as they are; texts of any length are encoded whole; an empty table gives an empty result; extra
    columns are not read.
    """
    return _coded(docs, path, text_col, carry, ids=True, digests=False)


def encode_decode(docs: DataFrame, path: str, *, text_col: str = "text", carry: tuple[str, ...] = ("doc_id",),
                  ids: bool = False) -> DataFrame:
    """Encoding, and decoding of the ids, in one pass over the texts: the carried columns, n_tokens, if asked for ids, and the
    SHA-256 of the ids (little-endian unsigned 32-bit) and of the decoded text."""
    return _coded(docs, path, text_col, carry, ids=ids, digests=True)


def _coded(docs: DataFrame, path: str, text_col: str, carry: tuple[str, ...], ids: bool, digests: bool) -> DataFrame:
    tables = _shipped(docs.sparkSession, path)
    kinds = dict(docs.dtypes)
    places = [f"c{i}" for i in range(len(carry))]
    names = [*places, "n_tokens", *["ids"] * ids, *["ids_sha256", "decoded_sha256"] * digests]
    ddl = [*(f"{p} {kinds[c]}" for p, c in zip(places, carry)), "n_tokens long", *["ids array<int>"] * ids,
           *["ids_sha256 string", "decoded_sha256 string"] * digests]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from hashlib import sha256
        enc = Encoder(tables.value)
        for part in _parts(batches):
            coded = [enc.encode(t.as_py() or "") for t in part.column(len(places))]
            size = [len(c) // 4 for c in coded]
            out = [*part.columns[:len(places)], pa.array(size, pa.int64())]
            if ids:
                values = pa.Array.from_buffers(pa.int32(), sum(size), [None, pa.py_buffer(b"".join(coded))])
                out.append(pa.ListArray.from_arrays(pa.array([0, *accumulate(size)], pa.int32()), values))
            if digests:
                out.append(pa.array([sha256(c).hexdigest() for c in coded], pa.string()))
                out.append(pa.array([sha256(enc.decode(c).encode("utf-8")).hexdigest() for c in coded], pa.string()))
            yield pa.RecordBatch.from_arrays(out, names=names)

    return (docs.select(*[F.col(f"`{c}`") for c in carry], F.col(f"`{text_col}`")).toDF(*places, "text")
            .mapInArrow(run, ", ".join(ddl)).toDF(*carry, *names[len(carry):]))


def decode(encoded: DataFrame, path: str, *, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """One row per input row: id, text (labels of the ids, joined by spaces). Null ids give a null text."""
    tables = _shipped(encoded.sparkSession, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labels = tables.value["labels"]
        for part in _parts(batches):
            texts = [None if ids is None else " ".join([labels[i] for i in ids]) for ids in part.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(texts, pa.string())], names=["id", "text"])

    kind = dict(encoded.dtypes)[id_col]
    return (narrow(encoded, id_col, ids_col).toDF("id", "ids").mapInArrow(run, f"id {kind}, text string")
            .withColumnRenamed("id", id_col))


def _parts(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """Small slices, so that the outputs held at once stay small."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)
