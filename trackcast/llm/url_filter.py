"""Operator 11: URL filters by a bit-parallel wildcard automaton.

Every rule is a glob over the canonical URL, ``.`` + host + path: ``*`` is any run of bytes but ``/``, ``**`` any
run at all, ``?`` one byte but ``/``, all else stands for itself. A rule given as (host, path) is the glob
``*.host path **``, so it fits the host and its subdomains and every longer path.

All globs run together. A state is one bit; the states of a glob (nothing read, first literal read, ...) are neighbours and
the globs follow one another over as many 64-bit words as they need. A byte c moves every state at once,
``D = (D << 1) & step[c] | D & stay[c]``: ``step[c]`` has the states that c leads into (Shift-And), ``stay[c]`` those that a
wildcard keeps. The shift carries from word to word; a start state is in no ``step``, so globs do not run into one
another. A glob fits if the bit of its last state is set after the last byte.

The two tables (256 rows each) are the only thing shipped; their size is given by the rules. URLs are narrow rows in a
map without a shuffle, stepped together, longest first, so no URL is padded and memory is that of one slice of rows.
"""

from __future__ import annotations

from typing import Iterator, NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trackcast.llm.common import narrow

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: (verdict, host, path): fixed values of the default rule set.
RULES = (("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
         ("block", "net", "/es/"), ("block", "net", "/fr/"))

#: (verdict, glob): the method's own verdict where no rule fits, by words in the host.
GLOBS = (("block", "*casino**"), ("block", "*poker**"), ("block", "*free-bet**"), ("block", "*viagra**"),
         ("block", "*porn**"), ("block", "*xxx.**"))

#: URLs stepped together.
ROWS = 4096
_ANY = np.ones(256, bool)
_IN_LABELS = _ANY.copy()
_IN_LABELS[ord("/")] = False


class Glob(NamedTuple):
    """Classes of bytes read one after another, and by number of bytes read the class a wildcard keeps there."""
    read: list[np.ndarray]
    stay: dict[int, np.ndarray]


def _literal(text: str) -> list[np.ndarray]:
    return [np.arange(256) == b for b in text.encode("utf-8")]


def parse_glob(glob: str) -> Glob:
    read, stay, at = [], {}, 0
    while at < len(glob):
        if glob.startswith("**", at):
            stay[len(read)] = _ANY
            at += 1
        elif glob[at] == "*":
            stay.setdefault(len(read), _IN_LABELS)
        else:
            read += [_IN_LABELS] if glob[at] == "?" else _literal(glob[at])
        at += 1
    return Glob(read, stay)


def rule_glob(host: str, path: str) -> Glob:
    read = _literal(f".{host}{path}")
    return Glob(read, {0: _IN_LABELS, len(read): _ANY})


class WildcardAutomaton:
    """Globs packed into the words of one Shift-And automaton."""

    def __init__(self, globs: list[Glob]):
        first = np.cumsum([0] + [len(g.read) + 1 for g in globs])
        self.words = max(1, -(-int(first[-1]) // 64))
        bits = self.words * 64
        step, stay, start = np.zeros((256, bits), bool), np.zeros((256, bits), bool), np.zeros((1, bits), bool)
        for g, at in zip(globs, first):
            start[0, at] = True
            for k, c in enumerate(g.read):
                step[:, at + 1 + k] = c
            for k, c in g.stay.items():
                stay[:, at + k] = c
        self.step, self.stay, self.start = (self._packed(x) for x in (step, stay, start))
        self.last = [divmod(int(at) + len(g.read), 64) for g, at in zip(globs, first)]

    def _packed(self, bits: np.ndarray) -> np.ndarray:
        return np.packbits(bits, axis=1, bitorder="little").view("<u8").reshape(len(bits), self.words)

    def fits(self, texts: list[bytes]) -> np.ndarray:
        """Which glob (column) fits which text (row)."""
        size = np.array([len(t) for t in texts], np.int64)
        order = np.argsort(-size, kind="stable")
        data = np.frombuffer(b"".join(texts), np.uint8)
        begin, size = (np.cumsum(size) - size)[order], size[order]
        state = np.repeat(self.start, len(texts), axis=0)
        live = len(texts)
        for t in range(int(size[0]) if live else 0):
            while size[live - 1] <= t:
                live -= 1
            now, c = state[:live], data[begin[:live] + t]
            moved = now << np.uint64(1)
            moved[:, 1:] |= now[:, :-1] >> np.uint64(63)
            state[:live] = moved & self.step[c] | now & self.stay[c]
        out = np.empty((len(texts), len(self.last)), bool)
        for g, (word, bit) in enumerate(self.last):
            out[order, g] = (state[:, word] >> np.uint64(bit)) & np.uint64(1)
        return out


def _judge(automaton: WildcardAutomaton, names: list, verdicts: list):
    """``names`` and ``verdicts`` in order of precedence, and a last entry for URLs that nothing fits."""
    names, verdicts = pa.array(names, pa.string()), pa.array(verdicts, pa.string())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS):
                part = whole.slice(at, ROWS)
                fits = automaton.fits([f".{h}{p}".encode("utf-8") for h, p in
                                       zip(part.column(1).to_pylist(), part.column(2).to_pylist())])
                won = pa.array(np.where(fits.any(axis=1), fits.argmax(axis=1), len(names) - 1))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, names.take(won), verdicts.take(won)], names=["id", "host", "path", "rule", "verdict"])
    return run


def host_and_path(url) -> tuple:
    """Host (A-Z lower-cased) and path columns of a URL; both empty where it is null or has no ``://``."""
    rest = F.when(F.contains(url, F.lit("://")), F.substring(url, F.locate("://", url) + F.lit(3), F.length(url))).otherwise("")
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + F.lit(1), F.length(rest)), r"^[^?#]*", 0)
    return F.translate(host, UPPER, LOWER), path


def filter_urls(pages: DataFrame, *, rules=RULES, globs=GLOBS, otherwise: str = "allow", id_col: str = "page_id",
                url_col: str = "url") -> DataFrame:
    """One row per input row: id, host, path, rule (host and path of the rule that fits, else null) and verdict.

    Of the rules that fit, the longest wins (host and path together; of equal ones ``block``). Where none fits, the longest glob that fits
    decides, else ``otherwise``. Defined results: a null URL and one without ``://`` have an empty host and path and no rule;
    a URL without a path (``http://a.com``) has an empty path, which no rule with a path fits; a port or a user name is part of the
    host, as written; paths keep their case; repeated rows and ids are judged each on its own, null ids pass
    through, an empty table gives an empty result, extra columns are ignored. URLs of any length are read whole.
    """
    order = lambda x: (-len(x[0]), x[1] != "block", x[0])
    own = sorted(((h + p, v, rule_glob(h, p)) for v, h, p in rules), key=order)
    rest = sorted(((g, v, parse_glob(g)) for v, g in globs), key=order)
    judge = _judge(WildcardAutomaton([x[2] for x in own + rest]), [x[0] for x in own] + [None] * (len(rest) + 1),
                   [x[1] for x in own + rest] + [otherwise])
    rows = narrow(pages, id_col, url_col).toDF("id", "url")
    host, path = host_and_path(F.col("url"))
    kind = dict(rows.dtypes)["id"]
    return (rows.select("id", F.coalesce(host, F.lit("")).alias("host"), F.coalesce(path, F.lit("")).alias("path"))
            .mapInArrow(judge, f"id {kind}, host string, path string, rule string, verdict string").withColumnRenamed("id", id_col))
