"""Token ids (problem 7) and token budgets (problem 4)."""

from __future__ import annotations

from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from grainmill.llm.bpe import TOKENIZER_DIR, encoder
from grainmill.llm.labels import clean_label, clean_lang


def encode_documents(df: DataFrame, key: str = "doc_id", text: str = "text", tokenizer: str = "byte_bpe_50k", folder: str = TOKENIZER_DIR) -> DataFrame:
    """``key, ids``: the ids of each text, without special tokens.

    A narrow map without a shuffle; the vocabulary is broadcast once. Null and empty texts give an empty list; blank
    ones are encoded like any other. Repeated rows and null keys stay as they are; an empty table gives no rows.
    """
    spark = df.sparkSession
    shared = spark.sparkContext.broadcast(encoder(tokenizer, folder))
    schema = df.select(key).schema.add("ids", T.ArrayType(T.IntegerType()))

    def encode(batches):
        enc = shared.value
        for batch in batches:
            ids = enc.encode(batch.column(1).to_pylist())
            ends = np.cumsum([0, *map(len, ids)]).astype(np.int32)
            flat = np.fromiter((i for x in ids for i in x), dtype=np.int32, count=int(ends[-1]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))], names=[key, "ids"])

    return df.select(F.col(key), F.col(text).cast("string")).mapInArrow(encode, schema)


def token_count(text: Column | str, spark, tokenizer: str = "byte_bpe_50k", folder: str = TOKENIZER_DIR) -> Column:
    """The number of tokens of a text as a column; 0 for null and empty texts."""
    shared = spark.sparkContext.broadcast(encoder(tokenizer, folder))

    @F.pandas_udf("bigint")
    def count(s: pd.Series) -> pd.Series:
        return pd.Series(shared.value.count(s.tolist()), dtype="int64")

    return count(text)


def slice_tokens(df: DataFrame, by: list[str], text: str = "text", tokenizer: str = "byte_bpe_50k", folder: str = TOKENIZER_DIR) -> DataFrame:
    """``by..., n_docs, n_usable, n_chars, n_tokens``: partial totals of each batch, one row per slice.

    A batch counts how often each piece occurs in each slice; a piece is merged once and its surviving symbols are
    weighted with that frequency. No piece leaves its task.
    """
    shared = df.sparkSession.sparkContext.broadcast(encoder(tokenizer, folder))
    schema = df.select(*by).schema
    for c in ("n_docs", "n_usable", "n_chars", "n_tokens"):
        schema = schema.add(c, "long")

    def count(batches):
        enc = shared.value
        for batch in batches:
            pieces: dict[tuple, Counter] = {}
            sizes: dict[tuple, list[int]] = {}
            *keys, texts = (batch.column(i).to_pylist() for i in range(batch.num_columns))
            for key, t in zip(zip(*keys), texts):
                s = sizes.setdefault(key, [0, 0, 0])
                s[0] += 1
                if t:
                    s[1] += not t.isspace()
                    s[2] += len(t)
                    pieces.setdefault(key, Counter()).update(enc.split(t))
            enc.learn({p for c in pieces.values() for p in c})
            cache = enc.cache
            rows = [(*k, *s, sum(len(cache[p]) * n for p, n in pieces.get(k, {}).items())) for k, s in sizes.items()]
            yield pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(zip(*rows), out_types)] if rows else [pa.array([], type=t) for t in out_types], names=schema.names)

    out_types = [pa.string()] * len(by) + [pa.int64()] * 4
    return df.select(*(F.col(c).cast("string") for c in by), F.col(text).cast("string")).mapInArrow(count, schema)


def token_budget(df: DataFrame, source: str = "source", lang: str = "lang", topic: str = "topic", text: str = "text", tokenizer: str = "byte_bpe_50k", folder: str = TOKENIZER_DIR) -> DataFrame:
    """Totals by source, language and topic, by each of them, and over all.

    Labels are cleaned first, so that spellings of one label are one slice; missing labels are the slice ``unknown``
    (``und`` for languages). ``level`` names the grouping; columns that a grouping leaves out are null. Null and empty
    texts count as documents without tokens; repeated rows count each time; an empty table gives no rows.
    """
    clean = df.select(clean_label(source).alias("source"), clean_lang(lang).alias("lang"), clean_label(topic).alias("topic"), F.col(text).alias("text"))
    part = slice_tokens(clean, ["source", "lang", "topic"], "text", tokenizer, folder)
    sums = [F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("n_docs", "n_usable", "n_chars", "n_tokens")]
    s, lg, t = F.col("source"), F.col("lang"), F.col("topic")
    level = F.concat_ws("+", *(F.when(F.grouping(c) == 0, F.lit(c)) for c in ("source", "lang", "topic")))
    return part.groupingSets([[s, lg, t], [s, lg], [s], [lg], [t], []], s, lg, t).agg(level.alias("grouped"), *sums).select(F.when(F.col("grouped") == "", "total").otherwise(F.col("grouped")).alias("level"), "source", "lang", "topic", "n_docs", "n_usable", "n_chars", "n_tokens")
