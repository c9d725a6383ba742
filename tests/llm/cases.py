"""Small inputs and brute-force forms shared by the tests of the training-data operators."""

import random
import re
from collections import defaultdict
from hashlib import sha256

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string"
#: Extra columns whose names the operators use inside themselves.
CLASH = "id string, key long, n int, digest string, salt int, places string, row_key long, component string, block int"


def digest(text) -> str:
    return sha256(text.encode("utf-8") if isinstance(text, str) else bytes(text)).hexdigest()


def odd_docs(seed: int = 3, alphabet=("a", "bb", "é", "x\x1cy", "the", "%%", "A")) -> list[tuple]:
    """Random texts, copies with edits, nulls, empty and repeated rows, rows without an id."""
    rng = random.Random(seed)

    def text(k):
        return "".join(rng.choice(alphabet) + rng.choice([" ", "\n", "  ", "\t"]) for _ in range(k))

    docs = [(i, text(rng.randint(0, 50))) for i in range(80)]
    docs += [(200 + i, rng.choice(docs)[1][4:90] + rng.choice(docs)[1]) for i in range(80)]
    docs += [(900, None), (901, ""), (902, "a " * 400), (903, "a b " * 40), (904, "a b " * 40), (905, "  \n"), (906, "a"),
             (None, docs[0][1]), (None, None), (5, docs[7][1]), (5, docs[7][1])]
    return docs


def frame(spark, docs, clash: bool = False):
    if not clash:
        return spark.createDataFrame(docs, DOCS)
    return spark.createDataFrame([(*d, "z", 1, 1, "d", 0, None, 7, "c", 2) for d in docs], f"{DOCS}, {CLASH}")


def by_id(rows, *values) -> dict:
    """Sorted value tuples of each id."""
    out = defaultdict(list)
    for r in rows:
        out[r["doc_id"]].append(tuple(v(r) if callable(v) else r[v] for v in values))
    return {k: sorted(v, key=str) for k, v in out.items()}


def sorted_groups(pairs) -> dict:
    out = defaultdict(list)
    for k, v in pairs:
        out[k].append(v)
    return {k: sorted(v, key=str) for k, v in out.items()}
