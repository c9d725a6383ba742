"""Operator 5: near-duplicate classes by MinHash bands and odd sketches.

1. Each text becomes its set of word shingles (64-bit names) and, from that set, 128 MinHash values in
   32 bands of four, and an odd sketch: the set's one-permutation MinHash samples (the smallest name in
   each of 1,024 ranges) folded into a parity bitmap of 1,024 bits.
2. Texts with equal sets (size and 128-bit digest) are one class; one representative goes on.
3. Representatives that share a band are candidates. The population count of the XOR of two odd sketches
   estimates how far the two samples differ; candidates more than 4.5 standard deviations beyond what a
   similarity at the threshold gives are dropped. The others are confirmed on the full sets.
4. No bucket's pairs are listed. First each bucket links its members to one centre (of several tried, the one
   most members are near by their sketches); confirmed links give components. Then only
   members of different components of a bucket are compared, so that no link between them is missed: where sketches
   leave a pair (in the first band it shares), the full sets decide at once, and only links come out.

A bucket of any size is cut into blocks of about ``block`` members and 16 MB of sets. Centres link each block by itself, so each member
is dealt out once, then one member of each component that the blocks of a bucket are left with. Beyond that, a bucket's largest
component is not compared with itself: its members meet the others (the outsiders) only, block by block, and a bucket without outsiders is
not dealt out again. Two sets at exactly 0.8 share no band with probability 5e-8.
"""

from __future__ import annotations

from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trackcast.llm.common import WorkTables, numbered_rows, pair_name, text_groups, with_row_key
from trackcast.llm.components import components
from trackcast.llm.words import WordNames, gram_names

BANDS, ROWS = 32, 4
SAMPLES = BITS = 1024


def _sets(texts: list[bytes], names: WordNames, shingle: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of each text: sizes, first lane in ascending order per text, second lane beside it."""
    counts, lanes = names.of(texts, lower=True)
    base = np.cumsum(counts) - counts
    grams = [gram_names(lanes, (shingle,), lane)[shingle] for lane in (0, 1)]
    sizes, first, second = np.zeros(len(texts), np.int64), [], []
    for r, (at, n) in enumerate(zip(base.tolist(), counts.tolist())):
        if n >= shingle:
            one, index = np.unique(grams[0][at:at + n - shingle + 1], return_index=True)
            two = grams[1][at + index]
        elif n:  # fewer words: the whole sequence is one shingle
            one, two = (gram_names([lanes[0][at:at + n], lanes[1][at:at + n]], (n,), k)[n] for k in (0, 1))
            one, two = (pair_name(x, np.full(1, n, np.uint64), k) for k, x in enumerate((one, two)))
        else:
            continue
        sizes[r] = len(one)
        first.append(one)
        second.append(two)
    none = np.empty(0, np.uint64)
    return sizes, np.concatenate(first) if first else none, np.concatenate(second) if second else none


def _signatures(shingle: int):
    rng = np.random.default_rng(5)
    mul = rng.integers(0, 1 << 32, BANDS * ROWS, dtype=np.uint64).astype(np.uint32) | np.uint32(1)
    add = rng.integers(0, 1 << 32, BANDS * ROWS, dtype=np.uint64).astype(np.uint32)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = WordNames()
        for part, texts in text_groups(batches, 1):
            sizes, h, h2 = _sets(texts, names, shingle)
            full = np.flatnonzero(sizes)
            at = (np.cumsum(sizes) - sizes)[full]
            bands = np.zeros((len(texts), BANDS), np.uint64)
            sketch = np.zeros((len(texts), BITS // 8), np.uint8)
            s1, s2 = np.zeros(len(texts), np.uint64), np.zeros(len(texts), np.uint64)
            if len(full):
                s1[full], s2[full] = np.add.reduceat(pair_name(h, h, 1), at), np.add.reduceat(h2, at)
                low = (h >> np.uint64(20)).astype(np.uint32)
                for band in range(BANDS):
                    x = np.full(len(full), band, np.uint64)
                    for k in range(band * ROWS, band * ROWS + ROWS):
                        x = pair_name(x, np.minimum.reduceat(low * mul[k] + add[k], at).astype(np.uint64), 0)
                    bands[full, band] = x
                # names are in order within a text, so the first of each range is its sample
                row = np.repeat(np.arange(len(texts)), sizes)
                place = row * SAMPLES + (h >> np.uint64(54)).astype(np.int64)
                taken = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
                bit = (pair_name(h[taken], h[taken], 0) >> np.uint64(50)).astype(np.int64) % BITS
                odd = np.bincount(row[taken] * BITS + bit, minlength=len(texts) * BITS) & 1
                sketch = np.packbits(odd.reshape(len(texts), BITS).astype(np.uint8), axis=1)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(sizes), pa.array(s1.view(np.int64)), pa.array(s2.view(np.int64)),
                 pa.ListArray.from_arrays(pa.array(np.arange(len(texts) + 1, dtype=np.int32) * BANDS),
                                          pa.array(bands.view(np.int64).ravel())),
                 pa.array([x.tobytes() for x in sketch], pa.binary())],
                names=["key", "n", "s1", "s2", "bands", "sketch"])
    return run


def _full_sets(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = WordNames()
        for part, texts in text_groups(batches, 1):
            sizes, h, _ = _sets(texts, names, shingle)
            end = np.cumsum(sizes)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array([h[e - n:e].tobytes() for n, e in zip(sizes, end)], pa.binary())],
                names=["key", "set"])
    return run


def most_odd_bits(total: np.ndarray, similarity: float) -> np.ndarray:
    """Largest XOR count of the odd sketches of two sets of ``total`` shingles
    together that a similarity at the threshold gives, plus 4.5 standard deviations.

    A range that holds any of the union's names holds different samples with probability 1 - J, and then two of them
    unless one set has no name there. In sparsely filled ranges nearly every name is a sample, so
    little is left to chance. The parity bitmap adds the variance of the number of odd cells.
    """
    load = total / ((1 + similarity) * SAMPLES)
    full = 1 - np.exp(-load)
    apart = SAMPLES * full * (1 - similarity) * (2 - np.exp(-(1 + similarity) / 2 * load))
    one, two = (1 - 2 / BITS) ** apart, (1 - 4 / BITS) ** apart
    odd = BITS * (1 - one) / 2
    cells = odd + BITS * (BITS - 1) * (1 - 2 * one + two) / 4 - odd ** 2
    return odd + 4.5 * np.sqrt(np.maximum(cells, 0) + one ** 2 * 2 * similarity * full * apart + 0.25)


def _near(n: np.ndarray, sketch: np.ndarray, a, b, similarity: float) -> np.ndarray:
    """Which pairs (a, b) of rows can reach the threshold by their sizes and sketches."""
    ok = np.minimum(n[a], n[b]) >= similarity * np.maximum(n[a], n[b]) - 1e-9
    odd = np.bitwise_count(sketch[a] ^ sketch[b]).sum(axis=-1)
    return ok & (odd <= most_odd_bits((n[a] + n[b]).astype(float), similarity))


_MEMBER = ["bucket", "x", "y", "band", "blk", "key", "n", "comp", "bands", "sketch"]


def _in_buckets(of_bucket, similarity: float):
    """Runs a function over the rows of each (bucket, x, y), which come sorted, some whole buckets at a time."""
    def arrays(batch: pa.RecordBatch) -> dict[str, np.ndarray]:
        out = {c: batch.column(c).to_numpy(zero_copy_only=False)
               for c in ("bucket", "x", "y", "band", "blk", "key", "n", "comp")}
        out["bands"] = batch.column("bands").flatten().to_numpy().reshape(-1, BANDS)
        out["sketch"] = np.frombuffer(b"".join(batch.column("sketch").to_pylist()), np.uint64).reshape(-1, BITS // 64)
        if "set" in batch.schema.names:
            out["set"] = np.array([None, *batch.column("set").to_pylist()], object)[1:]
        return out

    def solve(rows: dict[str, np.ndarray]) -> pa.RecordBatch:
        same = np.concatenate([[False], (rows["bucket"][1:] == rows["bucket"][:-1]) & (rows["x"][1:] == rows["x"][:-1])
                               & (rows["y"][1:] == rows["y"][:-1])])
        return of_bucket(rows, np.concatenate([np.flatnonzero(~same), [len(same)]]), similarity)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for whole in batches:
            for at in range(0, whole.num_rows, 2048):
                rows = arrays(whole.slice(at, 2048))
                if held is not None:
                    rows = {c: np.concatenate([held[c], rows[c]]) for c in rows}
                last = ((rows["bucket"] == rows["bucket"][-1]) & (rows["x"] == rows["x"][-1])
                        & (rows["y"] == rows["y"][-1]))
                begin = len(last) - int(last.sum())
                if begin:
                    yield solve({c: v[:begin] for c, v in rows.items()})
                held = {c: v[begin:] for c, v in rows.items()}
        if held is not None:
            yield solve(held)
    return run


def _pairs(rows, a, b) -> pa.RecordBatch:
    lo, hi = np.minimum(rows["key"][a], rows["key"][b]), np.maximum(rows["key"][a], rows["key"][b])
    return pa.RecordBatch.from_arrays([pa.array(lo), pa.array(hi)], names=["a", "b"])


def _star_pairs(rows, cut, similarity):
    """Each member with its bucket's centre; small buckets take their first member, larger ones the
    best of up to 32 tried."""
    size = np.diff(cut)
    centre = cut[:-1].copy()
    n, sketch = rows["n"], rows["sketch"]
    for k in np.flatnonzero(size > 3):
        own = np.arange(cut[k], cut[k + 1])
        tried = own[::max(1, -(-len(own) // 32))]
        near = [int(_near(n, sketch, np.full(len(own), t), own, similarity).sum()) for t in tried]
        centre[k] = tried[int(np.argmax(near))]
    a = np.repeat(centre, size)
    b = np.arange(cut[-1])
    ok = (a != b) & _near(n, sketch, a, b, similarity)
    return _pairs(rows, a[ok], b[ok])


def _across(rows, lo: int, hi: int, similarity: float):
    """For each member of a bucket, the later ones of other components that sizes and sketches
    leave, if this is the first band the two share."""
    n, sketch, comp, blk = rows["n"], rows["sketch"], rows["comp"], rows["blk"]
    across = rows["x"][lo] != rows["y"][lo]
    for i in range(lo, hi - 1):
        b = np.arange(i + 1, hi)
        b = b[(comp[b] != comp[i]) & ((blk[b] != blk[i]) | (not across))]
        if len(b):
            b = b[_near(n, sketch, np.full(len(b), i), b, similarity)]
        if len(b):
            band = rows["band"][i]
            b = b[~(rows["bands"][b, :band] == rows["bands"][i, :band]).any(axis=1)]
            if len(b):
                yield i, b


def _cross_members(rows, cut, similarity) -> pa.RecordBatch:
    """The members that have such a partner (their full sets are needed)."""
    on = np.zeros(cut[-1], bool)
    for lo, hi in zip(cut[:-1].tolist(), cut[1:].tolist()):
        for i, b in _across(rows, lo, hi, similarity):
            on[i] = on[b] = True
    return pa.RecordBatch.from_arrays([pa.array(rows[c][on]) for c in _PLACE], names=_PLACE)


_PLACE = ["bucket", "x", "y", "band", "blk", "key"]


def _cross_links(rows, cut, similarity) -> pa.RecordBatch:
    """Links between components of a bucket, confirmed on the full sets. A pair of components that
    a link has joined is not compared further."""
    found_a, found_b = [], []
    sets, comp, joined = rows["set"], rows["comp"].tolist(), {}

    def root(c):
        while c in joined:
            c = joined[c]
        return c

    for lo, hi in zip(cut[:-1].tolist(), cut[1:].tolist()):
        joined = {}
        for i, partners in _across(rows, lo, hi, similarity):
            own = np.frombuffer(sets[i], np.uint64)
            for j in partners.tolist():
                one, two = root(comp[i]), root(comp[j])
                if one != two and _linked(own, np.frombuffer(sets[j], np.uint64), similarity):
                    joined[max(one, two)] = min(one, two)
                    found_a.append(i)
                    found_b.append(j)
    return _pairs(rows, np.array(found_a, np.int64), np.array(found_b, np.int64))


def _linked(a: np.ndarray, b: np.ndarray, similarity: float) -> bool:
    """Whether two sets (distinct names) reach the threshold, in whole numbers of hundredths."""
    both = np.concatenate([a, b])
    both.sort()
    inter = int((both[1:] == both[:-1]).sum())
    return 100 * inter >= round(100 * similarity) * (len(a) + len(b) - inter)


def _confirmed(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """The pairs whose full sets reach the threshold."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = [_linked(np.frombuffer(one.as_py(), np.uint64), np.frombuffer(two.as_py(), np.uint64), similarity)
                    for one, two in zip(batch.column(2), batch.column(3))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(
                pa.array(keep, pa.bool_()))

    whole = (pairs.join(sets.select(F.col("key").alias("a"), F.col("set").alias("set_a")), "a")
             .join(sets.select(F.col("key").alias("b"), F.col("set").alias("set_b")), "b"))
    return whole.select("a", "b", "set_a", "set_b").mapInArrow(run, "a long, b long")


def _blocks(m, names, block: int):
    """Blocks that hold about ``block`` members and 16 MB of full sets each."""
    return F.greatest(F.lit(1), F.ceil(m / block), F.ceil(names / (1 << 21))).cast("int")


def _alone(members: DataFrame) -> DataFrame:
    """Members (bucket, key, blocks ...), each in one block of its bucket."""
    own = F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int")
    return members.withColumn("blk", own).withColumn("x", F.col("blk")).withColumn("y", F.col("blk"))


def _left_over(placed: DataFrame, block: int) -> DataFrame:
    """One member of each component of the buckets that have several blocks and several components."""
    one = (placed.filter("blocks > 1").groupBy("bucket", "comp").agg(F.min(F.struct("key", "band", "n")).alias("one"))
           .select("bucket", "comp", "one.*"))
    counts = one.groupBy("bucket").agg(F.count(F.lit(1)).alias("m"), F.sum("n").alias("names")).filter("m > 1")
    return one.join(counts.select("bucket", _blocks(F.col("m"), F.col("names"), block).alias("blocks")), "bucket")


def _against_rest(placed: DataFrame, block: int) -> DataFrame:
    """Members of buckets with several components, under the pairs of blocks in which they meet members of other components.

    The blocks of the largest component (0 to ``ins`` - 1) are paired with those of the outsiders (``outs`` more), and those with one
    another; a bucket that is one block stays one."""
    per = placed.groupBy("bucket", "comp").agg(F.count(F.lit(1)).alias("m"), F.sum("n").alias("names"))
    mixed = per.groupBy("bucket").agg(
        F.max_by(F.struct("comp", "m", "names"), F.struct("m", "comp")).alias("big"), F.sum("m").alias("m"),
        F.sum("names").alias("names"), F.count(F.lit(1)).alias("comps")).filter("comps > 1")
    whole = _blocks(F.col("m"), F.col("names"), block) == 1
    ins = F.when(whole, F.lit(0)).otherwise(_blocks(F.col("big.m"), F.col("big.names"), block))
    outs = F.when(whole, F.lit(1)).otherwise(_blocks(F.col("m") - F.col("big.m"), F.col("names") - F.col("big.names"), block))
    roles = mixed.select("bucket", F.col("big.comp").alias("main"), ins.alias("ins"), outs.alias("outs"))
    name, inside = F.xxhash64("key"), (F.col("comp") == F.col("main")) & (F.col("ins") > 0)
    own = F.when(inside, F.pmod(name, F.greatest(F.col("ins"), F.lit(1)))).otherwise(F.col("ins") + F.pmod(name, F.col("outs")))
    last = F.col("ins") + F.col("outs") - 1
    return (placed.join(roles, "bucket").withColumn("blk", own.cast("int"))
            .withColumn("other", F.explode(F.sequence(F.when(inside, F.col("ins")).otherwise(F.lit(0)), last)))
            .withColumn("x", F.least("blk", "other")).withColumn("y", F.greatest("blk", "other")).drop("main", "ins", "outs", "other"))


def near_duplicates(docs: DataFrame, *, shingle: int = 5, similarity: float = 0.8, id_col: str = "doc_id",
                    text_col: str = "text", block: int = 4096) -> DataFrame:
    """One row per input row: id, n_shingles, component_id (smallest id reachable by links), kept.

    Words are lower-cased (A-Z only). Linked are texts whose shingle sets have
    similarity (Jaccard) ``similarity`` or more. Defined results: fewer words than a shingle make the whole sequence one
    shingle; null texts and texts without words have the empty set and are linked with nothing; rows that
    repeat an id are rows of their own; a row without an id can be linked, and gets the smallest id of its
    component or null if there is none; kept means id = component_id (both null counts); an empty table gives an
    empty result; extra columns are ignored; texts of any length are treated whole.
    """
    work = WorkTables(docs.sparkSession, "near-dedup")
    rows = with_row_key(docs, id_col, text_col, work)
    found = work.put("found", _classes(rows, work, shingle, similarity, block).join(rows.select("key", "id"), "key"))
    least = found.groupBy("component").agg(F.min("id").alias("component_id"))
    return found.join(least, "component").select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"), "component_id",
        F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))


def drop_near_duplicates(docs: DataFrame, *, shingle: int = 5, similarity: float = 0.8, id_col: str = "doc_id",
                         text_col: str = "text", block: int = 4096) -> DataFrame:
    """One row of the input for each class, all columns kept: that with the smallest id
    (rows that repeat an id or have none: the first of them by a number given once)."""
    work = WorkTables(docs.sparkSession, "drop-near")
    rows, key = numbered_rows(docs, id_col, work)
    slim = rows.select(F.col(key).alias("key"), F.col(f"`{id_col}`").alias("id"),
                       F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    found = _classes(slim, work, shingle, similarity, block).join(slim.select("key", "id"), "key")
    first = F.struct(F.col("id").isNull().alias("none"), "id", "key")
    stay = found.groupBy("component").agg(F.min(first).alias("one")).select(F.col("one.key").alias(key))
    return rows.join(stay, key, "left_semi").select(*[f"`{c}`" for c in docs.columns])


def _classes(rows: DataFrame, work: WorkTables, shingle: int, similarity: float, block: int) -> DataFrame:
    """(key, n, component): size of each row's shingle set, and the smallest key it is linked with."""
    signed = work.put("signed", rows.select("key", "text").mapInArrow(
        _signatures(shingle), "key long, n long, s1 long, s2 long, bands array<long>, sketch binary"))
    digest = ["n", "s1", "s2"]
    classes = signed.filter("n > 0").groupBy(*digest).agg(F.min("key").alias("class"))
    reps = work.put("reps", signed.select("key", "n", "bands", "sketch").join(
        classes.select(F.col("class").alias("key")), "key", "left_semi"))
    placed = reps.select("key", "n", F.posexplode("bands").alias("band", "bucket"))
    counts = placed.groupBy("bucket").agg(F.count(F.lit(1)).alias("m"), F.sum("n").alias("names")).filter("m > 1")
    counts = counts.select("bucket", _blocks(F.col("m"), F.col("names"), block).alias("blocks"))
    shared = work.put("shared", placed.join(counts, "bucket"))
    sets = work.put("sets", rows.select("key", "text").join(shared.select("key").distinct(), "key", "left_semi")
                    .mapInArrow(_full_sets(shingle), "key long, set binary"))

    def dealt(places: DataFrame, of_bucket, ddl: str) -> DataFrame:
        return (places.repartition("bucket", "x", "y").sortWithinPartitions("bucket", "x", "y", "key")
                .mapInArrow(_in_buckets(of_bucket, similarity), ddl))

    def described(members: DataFrame) -> DataFrame:
        return members.drop("n").join(reps, "key").select(*_MEMBER)

    def stars(members: DataFrame) -> DataFrame:
        pairs = dealt(described(_alone(members)), _star_pairs, "a long, b long").distinct()
        return _confirmed(pairs, sets, similarity)

    def in_components(members: DataFrame, comp: DataFrame) -> DataFrame:
        return members.join(comp, "key", "left").withColumn("comp", F.coalesce("component", "key")).drop("component")

    links = work.put("links0", stars(shared.withColumn("comp", F.col("key"))))
    comp = components(links, work, "cc0")
    if not shared.filter("blocks > 1").isEmpty():
        found = work.put("links1", stars(_left_over(in_components(shared, comp), block)))
        links = links.unionByName(found)
        comp = components(links, work, "cc1")
    cross = described(_against_rest(in_components(shared, comp), block))
    active = dealt(cross, _cross_members, "bucket long, x int, y int, band int, blk int, key long")
    whole = in_components(active.join(reps, "key").join(sets, "key"), comp).select(*_MEMBER, "set")
    more = work.put("links2", dealt(whole, _cross_links, "a long, b long"))
    comp = components(links.unionByName(more), work, "cc2")
    work.drop("sets", "shared", "reps")

    by_class = classes.join(comp.withColumnRenamed("key", "class"), "class", "left").select(
        *digest, F.coalesce("component", "class").alias("component"))
    return signed.select("key", *digest).join(by_class, digest, "left").select(
        "key", "n", F.coalesce("component", "key").alias("component"))
