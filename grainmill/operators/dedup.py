"""Exact and near duplicates with first-wins semantics."""

from __future__ import annotations

import hashlib
import unicodedata
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

from grainmill.functions.text import normalize, py_strip, sha256
from grainmill.runtime import join_checked, join_salted, materialize

PRIME = 2147483647
#: Bands and rows for a threshold of 0.8 and 128 permutations under equal error weights.
BANDS, ROWS = 9, 13


@lru_cache
def layout(threshold: float = 0.8, permutations: int = 128) -> tuple[int, int]:
    """The bands and rows of least error: the area of false candidates below the threshold plus that of missed pairs above."""
    s = (np.arange(2000) + 0.5) / 2000
    below = s < threshold
    best = None
    for b in range(1, permutations + 1):
        for r in range(1, permutations // b + 1):
            hit = 1 - (1 - s**r) ** b
            error = hit[below].sum() + (1 - hit[~below]).sum()
            if best is None or error < best[0]:
                best = (error, b, r)
    return best[1:]


def permutation(i: int) -> tuple[int, int]:
    """The coefficients of the i-th hash function, from 1 on."""
    return (i * 1103515245 + 12345) % (PRIME - 1) + 1, (i * 22695477 + 1) % PRIME


def document_key(text: str = "text") -> Column:
    """The digest under which documents count as equal."""
    return sha256(normalize(py_strip(text)))


def mark_exact(df: DataFrame, order: str = "ord", text: str = "text", least: int = 200) -> DataFrame:
    """``order, sha, status``: ``too_short``, ``duplicate`` or ``kept``.

    The first of equal documents is kept. The first is found with a pre-aggregated minimum per digest, not with a window,
    so a digest with a third of all rows stays cheap. Null texts are too short; a table's further columns are not needed.
    """
    d = df.select(F.col(order), F.when(F.length(py_strip(text)) >= least, document_key(text)).alias("sha"))
    return _first_wins(materialize(d), order)  # digests only; the normalisation runs once


def _first_wins(d: DataFrame, order: str) -> DataFrame:
    """Rows of ``order, sha, ...`` with their status."""
    first = d.filter("sha is not null").groupBy("sha").agg(F.min(order).alias("_first"))
    d = join_salted(d, first, "sha", order, "left")
    status = F.when(F.col("sha").isNull(), "too_short").when(F.col(order) == F.col("_first"), "kept").otherwise("duplicate")
    return d.withColumn("status", status).drop("_first")


def without(df: DataFrame, gone: DataFrame, order: str) -> DataFrame:
    """The rows of ``df``, as they came, that ``gone`` does not name. Texts are shuffled only if there are too many to broadcast."""
    return join_checked(df, materialize(gone.select(order)), order, "left_anti")


def exact_dedup(df: DataFrame, order: str = "ord", text: str = "text", least: int = 200) -> DataFrame:
    """The rows that ``mark_exact`` keeps, as they came."""
    return without(df, mark_exact(df, order, text, least).filter("status != 'kept'"), order)


def _words(texts: list[str]) -> list[list[str]]:
    return [t.split() for t in texts]


def _band_keys(texts: list[str | None], k: int, bands: int, rows: int) -> list[list[str] | None]:
    """The keys of normalised texts; None for None. Hash functions run over all shingles of the texts at once."""
    live = [t for t in texts if t is not None]
    digests, n = [], []
    for t, w in zip(live, _words(live)):
        grams = {" ".join(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) > k else {t}
        digests += [hashlib.md5(g.encode("utf-8", "replace")).digest()[:8] for g in grams]
        n.append(len(grams))
    starts = np.cumsum([0, *n])[:-1]
    h = (np.frombuffer(b"".join(digests), dtype=">u8") >> np.uint64(4)).astype(np.uint64) % np.uint64(PRIME)
    least = np.empty((bands * rows, len(live)), dtype=np.uint64)
    if live:
        for i in range(bands * rows):
            a, b = permutation(i + 1)
            v = h * np.uint64(a) + np.uint64(b)
            v = (v & np.uint64(PRIME)) + (v >> np.uint64(31))  # the remainder by a prime of 31 ones, up to one subtraction
            v = (v & np.uint64(PRIME)) + (v >> np.uint64(31))
            least[i] = np.minimum.reduceat(np.where(v >= PRIME, v - np.uint64(PRIME), v), starts)
    out = iter([[hashlib.md5(",".join(map(str, m[i : i + rows])).encode()).hexdigest() for i in range(0, bands * rows, rows)] for m in least.T.tolist()])
    return [None if t is None else next(out) for t in texts]


def band_keys(text: str = "text", k: int = 5, bands: int = BANDS, rows: int = ROWS) -> Column:
    """The keys of a normalised text's bands (D2): MD5 digests of the minima of each band's hash functions."""

    @F.pandas_udf("array<string>")
    def udf(s: pd.Series) -> pd.Series:
        keys = [x for a in range(0, len(s), 500) for x in _band_keys([None if t is None else t for t in s.iloc[a : a + 500]], k, bands, rows)]
        return pd.Series(keys, index=s.index, dtype="object")

    return udf(F.col(text) if isinstance(text, str) else text)


def signatures(df: DataFrame, order: str = "ord", text: str = "text", least: int = 200, k: int = 5, threshold: float = 0.8, permutations: int = 128) -> DataFrame:
    """``order, sha, keys`` in one pass over the texts: the digest and the band keys; null for texts that are too short.

    Nothing but these leaves the task that reads a text.
    """
    bands, rows = layout(threshold, permutations)
    schema = df.select(order).schema.add("sha", "string").add("keys", ArrayType(StringType()))

    def sign(batches):
        for big in batches:
            for a in range(0, big.num_rows, 500):
                batch = big.slice(a, 500)
                texts = [t if t is not None and len(t.strip()) >= least else None for t in batch.column(1).to_pylist()]
                norm = [None if t is None else " ".join(unicodedata.normalize("NFKC", t).lower().split()) for t in texts]
                sha = [None if t is None else hashlib.sha256(t.encode("utf-8", "replace")).hexdigest() for t in norm]
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sha, pa.string()), pa.array(_band_keys(norm, k, bands, rows), pa.list_(pa.string()))], names=schema.names)

    return df.select(F.col(order), F.col(text).cast("string")).mapInArrow(sign, schema)


def buckets(df: DataFrame, order: str = "ord", text: str = "text") -> DataFrame:
    """``order, band, key``: one row per document and band."""
    return exploded(df.select(order, band_keys(normalize(text)).alias("keys")), order)


def exploded(signed: DataFrame, order: str = "ord") -> DataFrame:
    """``order, band, key`` of rows with ``keys``."""
    return signed.select(order, F.posexplode("keys").alias("band", "key"))


def bucket_sizes(rows: DataFrame, order: str = "ord") -> DataFrame:
    """``band, key, n_docs, first_ord`` of the buckets that several documents share (D3)."""
    return rows.groupBy("band", "key").agg(F.count("*").alias("n_docs"), F.min(order).alias("first_ord")).filter("n_docs > 1")


def resolve(rows: DataFrame, order: str = "ord") -> DataFrame:
    """``order, kept`` of the documents in shared buckets: one is dropped exactly if an earlier kept one shares a bucket
    with it (D4, D5).

    A round works on document-bucket rows with one minimum per bucket, never on pairs, so a bucket of any size costs its
    own rows only, dealt to several tasks. The first open document of all of its buckets is kept, and every other open
    document of its buckets is dropped in the same round; what stays open shares no bucket with a kept one, so a round
    reads open rows only and appends its decisions. The loop takes as many rounds as the longest chain of kept documents.
    """
    shared = rows.groupBy("band", "key").agg(F.count("*").alias("n")).filter("n > 1").select(F.concat_ws(":", "band", "key").alias("b"))
    open_ = materialize(join_salted(rows.select(order, F.concat_ws(":", "band", "key").alias("b")), shared, "b", order, "left_semi"))
    done = None
    own = W.partitionBy(order)  # a document's buckets, as many as there are bands
    while not open_.isEmpty():
        first = open_.groupBy("b").agg(F.min(order).alias("u"))
        led = join_salted(open_, first, "b", order).withColumn("lead", F.min(F.col("u") == F.col(order)).over(own))
        hit = led.groupBy("b").agg(F.bool_or("lead").alias("hit"))
        told = join_salted(led, hit, "b", order).withColumn("gone", F.max("hit").over(own) & ~F.col("lead"))
        told = materialize(told.select(order, "b", "lead", "gone"))
        decided = told.filter("lead or gone").select(order, F.col("lead").alias("kept")).distinct()
        done = decided if done is None else done.unionByName(decided)
        open_ = told.filter("not lead and not gone").select(order, "b")
    return done if done is not None else rows.select(order, F.lit(True).alias("kept")).limit(0)


def near_dedup(df: DataFrame, order: str = "ord", text: str = "text", least: int = 200, threshold: float = 0.8, permutations: int = 128) -> DataFrame:
    """``order, status`` of every row: ``too_short``, ``exact``, ``near`` or ``kept``.

    Exact copies are marked first, against all documents, so one that copies a document dropped as near stays a copy.
    Texts are read once and never shuffled; a null or repeated ``order`` is no key.
    """
    marked = materialize(_first_wins(signatures(df, order, text, least, threshold=threshold, permutations=permutations), order))
    rows = exploded(marked.filter("status = 'kept'"), order)
    near = resolve(rows, order).filter("not kept").select(order, F.lit(True).alias("near"))
    status = F.when(F.col("near"), "near").when(F.col("status") == "duplicate", "exact").otherwise(F.col("status"))
    return marked.select(order, "status").join(near, order, "left").select(order, status.alias("status"))


def status_counts(marked: DataFrame) -> DataFrame:
    """``status, n``."""
    return marked.groupBy("status").agg(F.count("*").alias("n"))


def ranked(df: DataFrame, by: str, order: str) -> DataFrame:
    """The place of each row among those of equal ``by``; for small groups."""
    return df.withColumn("rank", F.row_number().over(W.partitionBy(by).orderBy(order)))
