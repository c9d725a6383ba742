"""Operator 1: exact dedup by skew-safe combining.

Three combining steps, each grouping by the full content beside its digest, so
equal digests alone never merge two texts:

1. locally: the map side of the first aggregate folds a task's equal texts
   into one row (largest id, count) before anything is shuffled;
2. salted: ``(digest, salt, text)`` groups merge the tasks' rows; the salt
   spreads a hot text's rows over ``salts`` reducers;
3. globally: the at most ``salts`` winners of a text are combined.

Members find their class by an equi-join on the digest, in which rows carry no
text; a hot digest's rows are split by Spark's skew join. Only if two texts
are found to share a digest (checked on the classes) the join also compares the text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trackcast.llm.common import narrow


def exact_dedup(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", salts: int = 16,
                digest=lambda text: F.sha2(text, 256)) -> DataFrame:
    """One row per input row: id, keep_id (largest id of its text), group_size, kept, digest.

    Defined results: a null text counts as the empty text, and empty texts are
    equal to each other; a null id takes part in its group's size and is kept
    only where the whole group has null ids (then keep_id is null); rows that repeat
    an id are rows of their own and each counts; an empty table gives an empty result;
    other columns of the input are not read, whatever their names.
    ``digest`` is a function of the text column (tests pass a weak one).
    """
    rows = narrow(docs, id_col, text_col).select(
        F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    keyed = rows.select("id", "text", digest(F.col("text")).alias("digest"))
    salt: Column = F.pmod(F.xxhash64("id"), F.lit(salts)).cast("int")
    salted = keyed.groupBy("digest", salt.alias("salt"), "text").agg(
        F.max("id").alias("keep_id"), F.count(F.lit(1)).alias("n"))
    classes = salted.groupBy("digest", "text").agg(F.max("keep_id").alias("keep_id"), F.sum("n").alias("n"))
    # without the text: what of each class the members need, and how many texts its digest stands for
    by_digest = classes.groupBy("digest").agg(
        F.max("keep_id").alias("keep_id"), F.sum("n").alias("n"), F.count(F.lit(1)).alias("texts"))
    return _attach(keyed, classes, by_digest, id_col)


def _attach(keyed: DataFrame, classes: DataFrame, by_digest: DataFrame, id_col: str) -> DataFrame:
    from trackcast.llm.common import WorkTables
    work = WorkTables(keyed.sparkSession, "exact-dedup")
    heads = work.put("classes", by_digest)
    members = keyed.select("id", "digest")
    if heads.filter("texts > 1").isEmpty():
        joined = members.join(heads, "digest")
    else:  # some digest stands for several texts: its rows are matched by content
        shared = heads.filter("texts > 1").select("digest")
        joined = (members.join(heads.filter("texts = 1"), "digest").select("id", "digest", "keep_id", "n")
                  .unionByName(keyed.join(shared, "digest", "left_semi")
                               .join(classes, ["digest", "text"]).select("id", "digest", "keep_id", "n")))
    return joined.select(
        F.col("id").alias(id_col), F.col("keep_id"), F.col("n").alias("group_size"),
        F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"), F.col("digest").alias("text_sha256"))


def drop_copies(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", salts: int = 16,
                digest=lambda text: F.sha2(text, 256)) -> DataFrame:
    """One row of the input for each text, all columns kept: the row with the largest id.

    The same three combining steps, carrying the rows instead of counts: no join is needed.
    Of rows that repeat an id with the same text the greatest one by its other columns, in order,
    stays; a null text equals the empty one, and a row without an id stays only where no equal text has one.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rest = [c for c in docs.columns if c != id_col]
    row = F.struct(F.col(f"`{id_col}`").alias("c0"), *[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(rest, 1)])
    salt = F.pmod(F.xxhash64(F.col(f"`{id_col}`")), F.lit(salts)).cast("int")
    keyed = docs.select(text.alias("t"), digest(text).alias("digest"), salt.alias("salt"), row.alias("row"))
    # the text is in the group key; the winning row is carried without it
    at = rest.index(text_col) + 1
    slim = F.struct(*[F.col(f"row.c{i}").alias(f"c{i}") if i != at else F.col("row")[f"c{i}"].isNotNull().alias(f"c{i}")
                      for i in range(len(docs.columns))])
    salted = keyed.groupBy("digest", "salt", "t").agg(F.max(slim).alias("row"))
    best = salted.groupBy("digest", "t").agg(F.max("row").alias("row"))
    out = {id_col: F.col("row.c0")} | {c: F.col(f"row.c{i}") if i != at else F.when(F.col(f"row.c{i}"), F.col("t"))
                                       for i, c in enumerate(rest, 1)}
    return best.select(*[out[c].alias(c) for c in docs.columns])
