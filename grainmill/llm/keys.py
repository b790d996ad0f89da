"""A filter of hashes whose size is fixed, to leave out rows before a shuffle."""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

#: Bits of the largest filter, as a power of 2: 2 MB.
MOST_BITS = 24


class KeyFilter:
    """Says of a hash whether it may be among the wanted ones; it lets some others pass and loses none."""

    def __init__(self, packed: np.ndarray, bits: int):
        self.packed, self.bits = packed, bits

    def __call__(self, h: np.ndarray) -> np.ndarray:
        at = h.view(np.uint64) & np.uint64((1 << self.bits) - 1)
        return (self.packed[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 > 0


def key_filter(hashes: DataFrame, bits: int = MOST_BITS) -> KeyFilter:
    """The filter of all values of a bigint column; built in the executors, 8 rows of a fixed size come to the driver."""
    size = 1 << (bits - 3)

    def mark(batches):
        own = np.zeros(1 << bits, dtype=bool)
        for batch in batches:
            own[(np.asarray(batch.column(0)).view(np.uint64) & np.uint64(len(own) - 1)).astype(np.int64)] = True
        if own.any():
            yield pa.RecordBatch.from_arrays([pa.array([zlib.compress(np.packbits(own, bitorder="little").tobytes(), 1)], pa.binary())], names=["bits"])

    def merge(batches):
        total = np.zeros(size, dtype=np.uint8)
        for batch in batches:
            for x in batch.column(0).to_pylist():
                total |= np.frombuffer(zlib.decompress(x), dtype=np.uint8)
        yield pa.RecordBatch.from_arrays([pa.array([zlib.compress(total.tobytes(), 1)], pa.binary())], names=["bits"])

    out = np.zeros(size, dtype=np.uint8)
    for r in hashes.mapInArrow(mark, "bits binary").coalesce(8).mapInArrow(merge, "bits binary").collect():
        out |= np.frombuffer(zlib.decompress(r["bits"]), dtype=np.uint8)
    return KeyFilter(out, bits)
