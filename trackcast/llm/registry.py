"""Registered queries of the training-data operators and their DuckDB SQL.

Each callable takes (spark, sf_dir), reads the whole table it is meant for and
returns the operator's full result in the contract's columns. The pipeline's module is at the top
of the repository.
"""

from __future__ import annotations

import corpus_pipeline
from trackcast.llm import queries_dedup, queries_selection, queries_text, queries_vectors  # noqa: F401
from trackcast.llm.register import ORACLE, QUERIES

QUERIES["pipeline"] = corpus_pipeline.run
if corpus_pipeline.ORACLE_SQL is not None:
    ORACLE["pipeline"] = corpus_pipeline.ORACLE_SQL
