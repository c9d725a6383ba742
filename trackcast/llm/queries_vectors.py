"""Registered query of the vector search operator (7)."""

from __future__ import annotations

from trackcast.llm.ann import nearest
from trackcast.llm.common import table
from trackcast.llm.register import register


@register("op7_learned_partition_search")
def op7_learned_partition_search(spark, sf_dir):
    """The 20 nearest rows of every 20th row of embeddings, among all rows."""
    return nearest(table(spark, sf_dir, "embeddings"))
