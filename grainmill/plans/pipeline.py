"""The stages from documents to training rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grainmill.operators.dedup import near_dedup, without
from grainmill.operators.filters import first_rows, min_chars
from grainmill.operators.pack import END_OF_TEXT, RANKS, pack, rank_tokenizer, tokenize, word_ids
from grainmill.operators.qa import prompt
from grainmill.operators.sft import examples


def clean_corpus(docs: DataFrame, order: str = "ord") -> DataFrame:
    """The documents that are long enough and neither exact nor near copies of earlier ones, as they came."""
    return without(docs, near_dedup(docs, order).filter("status != 'kept'"), order)


def packed_by_ranks(corpus: DataFrame, seq_len: int = 2048, order: str = "ord", ranks: str = RANKS, eos: int = END_OF_TEXT) -> DataFrame:
    """Sequences of a public tokenizer's ids."""
    return pack(corpus.select(order, tokenize("text", rank_tokenizer(ranks)).alias("ids")), seq_len, order, eos=eos)


def packed(corpus: DataFrame, seq_len: int = 2048, order: str = "ord", eos: int = 0) -> DataFrame:
    return pack(corpus.select(order, word_ids("text").alias("ids")), seq_len, order, eos=eos)


def template_rows(corpus: DataFrame, max_docs: int = 0, per_doc: int = 1, order: str = "ord") -> DataFrame:
    """Instruction rows; the limit counts all documents (L1)."""
    return examples(first_rows(corpus, max_docs, order), per_doc, order)


def prompts(corpus: DataFrame, max_docs: int = 0, least: int = 300, order: str = "ord") -> DataFrame:
    """Prompts; the limit counts documents that are long enough (L2)."""
    docs = first_rows(min_chars(corpus, least), max_docs, order)
    return docs.select(order, F.coalesce("source", F.lit("")).alias("source"), F.coalesce("lang", F.lit("")).alias("lang"), prompt().alias("prompt"))
