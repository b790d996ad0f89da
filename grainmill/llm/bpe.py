"""Byte-level BPE under a public rank file.

Whole pre-tokens are resolved by a minimal perfect hash over the vocabulary; every other one is merged with a
priority queue over a linked list of symbols. The vocabulary is read once on the driver and broadcast: its size is
fixed by the file (about 50,000 entries, under 3 MB).
"""

from __future__ import annotations

import base64
import heapq
import os
from functools import lru_cache

import numpy as np
import regex
import xxhash

TOKENIZER_DIR = "/opt/tokenizers"

#: Fixed value: the published pre-token pattern of the rank files.
PRETOKEN_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

#: Pieces that a worker remembers. Beyond it the memory is emptied, which changes no result.
CACHE_PIECES = 200_000


class PerfectHash:
    """Hash-and-displace: n keys take the slots 0..n-1. A lookup compares the key, so it is exact."""

    def __init__(self, keys: list[bytes], values: list[int]):
        n = self.n = max(1, len(keys))
        self.buckets = max(1, n // 3)
        h = np.array([xxhash.xxh3_64_intdigest(k) for k in keys], dtype=np.uint64)
        bucket, base, step = self._parts(h)
        order = np.argsort(bucket, kind="stable")
        bounds = np.searchsorted(bucket[order], np.arange(self.buckets + 1))
        taken = np.zeros(n, dtype=bool)
        self.shift = np.zeros(self.buckets, dtype=np.int64)
        slot_of = np.zeros(len(keys), dtype=np.int64)
        sizes = np.diff(bounds)
        for b in np.argsort(-sizes, kind="stable"):
            if sizes[b] < 2:
                break
            own = order[bounds[b] : bounds[b + 1]]
            d = 0
            while True:
                place = (base[own] + d * step[own]) % n
                if not taken[place].any() and len(set(place.tolist())) == len(own):
                    break
                d += 1
            taken[place] = True
            self.shift[b] = d
            slot_of[own] = place
        free = iter(np.flatnonzero(~taken))
        for b in np.flatnonzero(sizes == 1):  # a lone key gets any free slot, named by a negative shift
            own = order[bounds[b]]
            slot_of[own] = place = int(next(free))
            self.shift[b] = -place - 1
        self.keys: list[bytes] = [b""] * n
        self.values = np.zeros(n, dtype=np.int32)
        for i, place in enumerate(slot_of):
            self.keys[place] = keys[i]
        self.values[slot_of] = values

    def _parts(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        n = np.uint64(self.n)
        bucket = (h % np.uint64(self.buckets)).astype(np.int64)
        base = ((h >> np.uint64(20)) % n).astype(np.int64)
        step = ((h * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(17)) % n).astype(np.int64) | 1
        return bucket, base, step

    def find(self, pieces: list[bytes]) -> list[int]:
        """The value of each piece, or -1."""
        if not pieces:
            return []
        h = np.array([xxhash.xxh3_64_intdigest(p) for p in pieces], dtype=np.uint64)
        bucket, base, step = self._parts(h)
        d = self.shift[bucket]
        place = np.where(d < 0, -d - 1, (base + d * step) % self.n)
        keys = self.keys
        return [int(v) if keys[s] == p else -1 for s, v, p in zip(place.tolist(), self.values[place], pieces)]


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The ids of a piece: the lowest rank first, the leftmost among equals; O(n log n) for a piece of n bytes."""
    n = len(piece)
    end = list(range(1, n + 1))  # symbol i covers piece[i:end[i]]; 0 marks one that was swallowed
    left = list(range(-1, n - 1))
    heap = []
    for i in range(n - 1):
        r = ranks.get(piece[i : i + 2])
        if r is not None:
            heap.append((r, i, i + 1, i + 2))
    heapq.heapify(heap)
    while heap:
        _, i, mid, stop = heapq.heappop(heap)
        if end[i] != mid or mid >= n or end[mid] != stop:
            continue  # one of the two symbols has changed since
        end[i], end[mid] = stop, 0
        if stop < n:
            left[stop] = i
            r = ranks.get(piece[i : end[stop]])
            if r is not None:
                heapq.heappush(heap, (r, i, stop, end[stop]))
        p = left[i]
        if p >= 0:
            r = ranks.get(piece[p:stop])
            if r is not None:
                heapq.heappush(heap, (r, p, i, stop))
    ids, i = [], 0
    while i < n:
        ids.append(ranks[piece[i : end[i]]])
        i = end[i]
    return ids


class Encoder:
    """Encodes texts; remembers pieces per worker."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.hash = PerfectHash(list(ranks), list(ranks.values()))
        self._ready()

    def _ready(self) -> None:
        self.split = regex.compile(PRETOKEN_PATTERN).findall
        self.cache: dict[str, tuple[int, ...]] = {}

    def __getstate__(self):
        return {"ranks": self.ranks, "hash": self.hash}

    def __setstate__(self, state):
        self.__dict__.update(state)
        self._ready()

    def learn(self, pieces: set[str]) -> None:
        """Puts the ids of all pieces into the memory."""
        cache = self.cache
        if len(cache) > CACHE_PIECES:
            cache.clear()
        new = [p for p in pieces if p not in cache]
        raw = [p.encode("utf-8", "replace") for p in new]
        for text, data, found in zip(new, raw, self.hash.find(raw)):
            cache[text] = (found,) if found >= 0 else tuple(merge(data, self.ranks))

    def encode(self, texts: list[str | None]) -> list[list[int]]:
        """Null and empty texts have no ids."""
        split = [self.split(t) if t else [] for t in texts]
        self.learn({p for s in split for p in s})
        get = self.cache.__getitem__
        return [[i for p in s for i in get(p)] for s in split]

    def count(self, texts: list[str | None]) -> list[int]:
        split = [self.split(t) if t else [] for t in texts]
        self.learn({p for s in split for p in s})
        size = {p: len(self.cache[p]) for s in split for p in s}
        return [sum(map(size.__getitem__, s)) for s in split]


def read_ranks(name: str, folder: str = TOKENIZER_DIR) -> dict[bytes, int]:
    """The ranks of a ``.tiktoken`` file."""
    with open(os.path.join(folder, f"{name}.tiktoken"), "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


@lru_cache(maxsize=4)
def encoder(name: str = "byte_bpe_50k", folder: str = TOKENIZER_DIR) -> Encoder:
    return Encoder(read_ranks(name, folder))
