"""Registered queries of the operators on texts (3, 6, 8, 9)."""

from __future__ import annotations

from trackcast.llm.bpe import encode_decode
from trackcast.llm.common import table
from trackcast.llm.language_id import identify_language
from trackcast.llm.mixing import mix_to_weights
from trackcast.llm.register import register
from trackcast.llm.toxicity import score_toxicity


@register("op6_mixing")
def op6_mixing(spark, sf_dir):
    """Mix of all documents to target weights, as words taken per document."""
    return mix_to_weights(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken", "source", "times")


TOKENIZER = "word_bpe_49k.json"


def tokenizer_path() -> str:
    """Where the installed package of public tokenizers keeps the default file."""
    import public_tokenizers
    return public_tokenizers.path(TOKENIZER)


@register("op3_bpe")
def op3_bpe(spark, sf_dir):
    """BPE encoding of every whole text of documents, and decoding of the ids."""
    return encode_decode(table(spark, sf_dir, "documents"), tokenizer_path())


@register("op8_kneser_ney_toxicity")
def op8_kneser_ney_toxicity(spark, sf_dir):
    """Toxicity score of every whole text of documents, learned from labels outside fold 0 of 5."""
    return score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@register("op9_byte_cnn_language")
def op9_byte_cnn_language(spark, sf_dir):
    """Language of every whole text of documents, learned outside fold 2 of 4."""
    return identify_language(table(spark, sf_dir, "documents"))
