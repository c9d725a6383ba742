"""The corpus pipeline: documents to token ids, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns
of ``documents``. ``run`` writes every stage's result to the shared checkpoint folder and rereads it,
so a lost executor costs at most one stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from trackcast.llm.bpe import encode_decode
from trackcast.llm.common import WorkTables, table
from trackcast.llm.exact_dedup import drop_copies
from trackcast.llm.mixing import mixed_rows
from trackcast.llm.near_dedup import drop_near_duplicates
from trackcast.llm.queries_text import tokenizer_path
from trackcast.llm.toxicity import drop_toxic


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without those the Kneser-Ney models score 0.5 or more."""
    return drop_toxic(docs, table(spark, sf_dir, "labels"))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the document with the largest id."""
    return drop_copies(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group linked by similarity 0.8 on five-word shingles, the document with the smallest id."""
    return drop_near_duplicates(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix to target weights takes them."""
    return mixed_rows(docs)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, and digests of the ids and of the text decoded from them."""
    return encode_decode(docs, tokenizer_path(), carry=("doc_id", "lang", "source"), ids=True)


STAGES = [("toxicity", toxicity), ("exact_dedup", exact), ("near_dedup", near), ("mixing", mix), ("bpe", tokenize)]

#: The toxicity models and the cube method have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table ``documents`` in ``sf_dir``."""
    work = WorkTables(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES[:-1]):
        docs = work.put(name, stage(spark, docs, sf_dir))
        if k:
            work.drop(STAGES[k - 1][0])
    return STAGES[-1][1](spark, docs, sf_dir)
