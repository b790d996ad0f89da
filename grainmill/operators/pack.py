"""Token sequences of fixed length."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from grainmill.functions.text import py_split
from grainmill.runtime import join_checked, materialize


def word_ids(text: str | Column) -> Column:
    """Ids of white-space words, from their MD5; a tokenizer without a model."""
    return F.transform(py_split(text), lambda w: F.conv(F.substring(F.md5(w), 1, 7), 16, 10).cast("int"))


def tokenize(text: str | Column, make: Callable[[], Callable[[list[str]], list[list[int]]]], batch: int = 2000) -> Column:
    """Ids by any tokenizer (K1, K2): ``make`` builds it once per worker, which is given ``batch`` texts at once."""

    @F.pandas_udf("array<int>")
    def udf(texts: pd.Series) -> pd.Series:
        encode = _kept(make)
        own = ["" if t is None else t for t in texts]
        return pd.Series([x for a in range(0, len(own), batch) for x in encode(own[a : a + batch])], dtype="object")

    return udf(text)


def rank_tokenizer(path: str, pattern: str | None = None) -> Callable[[], Callable[[list[str]], list[list[int]]]]:
    """For ``tokenize``: byte-level byte pair encoding by a public file of ranks (a token in base 64 and its rank a line).

    ``pattern`` cuts texts into pieces; by default the one that the file's folder names. The first id past the last rank is
    free and serves as end of text.
    """

    def make():
        import base64

        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        return tiktoken.Encoding("ranks", pat_str=pattern or PIECES, mergeable_ranks=ranks, special_tokens={}).encode_ordinary_batch

    return make


#: Fixed value: how texts are cut into pieces before bytes are merged.
PIECES = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"
END_OF_TEXT = 50256

_MADE: dict = {}


def _kept(make):
    if make not in _MADE:
        _MADE[make] = make()
    return _MADE[make]


def offsets(df: DataFrame, order: str = "ord", ids: str = "ids", eos: int | None = 0) -> DataFrame:
    """``order, start, n``: the place of each document's tokens in the stream of all, in order (K3), by lengths alone.

    Every document, also an empty one, ends in ``eos``. Lengths are range-partitioned by order; each part's total goes
    through a small table of one row per part, each part's own sum through a window within it. No task sees all rows.
    """
    if eos is None:
        raise ValueError("the tokenizer has no end-of-text id")
    d = df.select(F.col(order), (F.coalesce(F.size(F.col(ids)), F.lit(0)) + 1).alias("n")).withColumn("n", F.greatest("n", F.lit(1)))
    d = materialize(d.repartitionByRange(order).withColumn("part", F.spark_partition_id()))
    totals = d.groupBy("part").agg(F.sum("n").alias("total"))
    totals = totals.select("part", F.coalesce(F.sum("total").over(W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    own = F.sum("n").over(W.partitionBy("part").orderBy(order).rowsBetween(W.unboundedPreceding, 0)) - F.col("n")
    # one row per partition of the range exchange, at most spark.sql.shuffle.partitions
    return d.join(F.broadcast(totals), "part").select(order, (F.col("before") + own).alias("start"), "n")


def pack(df: DataFrame, seq_len: int, order: str = "ord", ids: str = "ids", eos: int | None = 0, pad: int | None = None) -> DataFrame:
    """``chunk, input_ids, labels, attention_mask`` (K4 to K7): the stream cut every ``seq_len`` tokens.

    A last piece is kept only if it is longer than half a chunk, padded with ``pad`` (else ``eos``) under a mask of 0;
    labels equal the ids, pads included. A chunk is put together from at most ``seq_len`` pieces. ``order`` must be a key.
    Ids are made twice, for their number and for the pieces, instead of being written in between; their only shuffle is
    that of the pieces, and where there are too many documents to broadcast their places, a join by order before it.
    """
    pad = eos if pad is None else pad
    places = materialize(offsets(df, order, ids, eos))
    d = df.select(F.col(order), F.concat(F.coalesce(ids, F.array().cast("array<int>")), F.array(F.lit(eos))).alias("ids"))
    d = join_checked(d, places, order)
    L = F.lit(seq_len)
    d = d.withColumn("chunk", F.explode(F.sequence(F.floor(F.col("start") / L), F.floor((F.col("start") + F.col("n") - 1) / L))))
    begin = F.greatest(F.col("chunk") * L - F.col("start"), F.lit(0))
    end = F.least((F.col("chunk") + 1) * L - F.col("start"), F.col("n"))
    piece = F.struct((F.col("start") + begin).alias("at"), F.slice("ids", (begin + 1).cast("int"), (end - begin).cast("int")).alias("x"))
    c = d.select("chunk", piece.alias("piece")).groupBy("chunk").agg(F.array_sort(F.collect_list("piece")).alias("p"))
    c = c.select("chunk", F.flatten(F.transform("p", lambda r: r["x"])).alias("x")).withColumn("m", F.size("x")).filter(F.col("m") > seq_len // 2)
    full = F.concat("x", F.array_repeat(F.lit(pad), (L - F.col("m")).cast("int")))
    mask = F.concat(F.array_repeat(F.lit(1), F.col("m")), F.array_repeat(F.lit(0), (L - F.col("m")).cast("int")))
    return c.select("chunk", full.alias("input_ids"), full.alias("labels"), mask.alias("attention_mask"))
