"""Unions, holdouts, order of paths."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from grainmill.functions.text import hash_choice


def union_sources(frames: list[DataFrame]) -> DataFrame:
    """All rows of all frames, with ``source_rank`` in their order; columns that a frame lacks are null."""
    ranked = [f.withColumn("source_rank", F.lit(i)) for i, f in enumerate(frames)]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), ranked)


def union_alpaca(frames: list[DataFrame]) -> DataFrame:
    """Instruction rows of several sets, repeated rows included."""
    cols = ["instruction", "input", "output", "source", "lang"]
    return reduce(lambda a, b: a.unionByName(b), [f.select(*cols) for f in frames])


def holdout(df: DataFrame, share: float, key: str, seed: int = 42) -> DataFrame:
    """``split``: ``validation`` for about ``share`` of the rows, by a hash of the key, so that no partitioning changes
    it (V1, V2)."""
    return df.withColumn("split", F.when(hash_choice(1_000_000, seed, F.col(key), "split") < int(share * 1_000_000), "validation").otherwise("train"))


def path_parts(path: str | Column) -> Column:
    """A path's components; arrays of them order as paths do (O1)."""
    return F.split(F.col(path) if isinstance(path, str) else path, "/")


def latest_checkpoint(df: DataFrame, path: str = "path") -> DataFrame:
    """The path with the highest checkpoint number (O2)."""
    number = F.regexp_extract(path, r"checkpoint-(\d+)", 1)
    return df.filter(number != "").agg(F.max_by(path, number.cast("bigint")).alias(path))
