"""Near-duplicate records by count vectors in R-trees (problem 2)."""

from __future__ import annotations

import unicodedata
import zlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from grainmill.llm.keys import key_filter
from grainmill.runtime import SALT, join_salted, materialize

#: Coordinates of a point: shingles are hashed into so many groups, whose sizes are the coordinates.
GROUPS = 64
#: Points of an R-tree's leaf, and leaves of an inner node.
FANOUT = 16
#: Rows of one block; larger groups are cut into chunks of about so many, and pairs of chunks become blocks.
BLOCK = 256
#: A shingle of more than this share of the texts is hot: its group is never numbered or held by one task.
HOT_SHARE = 0.001

#: What the sketch holds for a bucket with one shingle.
ONCE = 12


def words_of(text: str) -> list[str]:
    if not text.isascii():
        text = unicodedata.normalize("NFKC", text)
    return text.lower().split()


class Shingler:
    """Sets of 64-bit hashes of runs of ``k`` words, for many texts at once."""

    def __init__(self, k: int = 5):
        self.k = k
        self.known: dict[str, int] = {}

    def sets(self, texts: list[str]) -> list[np.ndarray]:
        """Sorted, distinct hashes of each text; a text of ``k`` words or fewer is one shingle."""
        if len(self.known) > 500_000:
            self.known.clear()
        known, k = self.known, self.k
        lists = [words_of(t) for t in texts]
        for ws in lists:
            for w in ws:
                if w not in known:
                    known[w] = xxhash.xxh3_64_intdigest(w.encode("utf-8", "replace"))
        n = np.array([len(x) for x in lists], dtype=np.int64)
        flat = np.fromiter((known[w] for ws in lists for w in ws), dtype=np.uint64, count=int(n.sum()))
        ends = np.cumsum(n)
        rolled = _mix(flat, k)
        out = []
        for e, m in zip(ends.tolist(), n.tolist()):
            if m > k:
                out.append(np.unique(rolled[e - m : e - k + 1]))
            else:
                out.append(_mix(flat[e - m : e], m)[:1] if m else np.empty(0, np.uint64))
        return out


def _mix(h: np.ndarray, k: int) -> np.ndarray:
    """A hash of each run of k values, from its first value's place on."""
    if not len(h) or len(h) < k:
        return np.empty(0, np.uint64)
    n = len(h) - k + 1
    out = np.full(n, k, dtype=np.uint64)
    for i in range(k):
        out = (out ^ h[i : i + n]) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    return out * np.uint64(0xBF58476D1CE4E5B9)


def count_vector(s: np.ndarray) -> np.ndarray:
    return np.bincount((s >> np.uint64(40)).astype(np.int64) % GROUPS, minlength=GROUPS).astype(np.int32)


def tree_pairs(vectors: np.ndarray, sizes: np.ndarray, threshold: float, side: np.ndarray | None = None) -> np.ndarray:
    """Index pairs whose count vectors allow a Jaccard similarity of at least ``threshold``.

    Points are packed into leaves in the order of their size and first coordinates; a node keeps the largest coordinates
    and the least size of its points. Two sets share at most the sum of the coordinates' minima, and similar ones share
    t/(1+t) of their joint size at least; a node is left out when even its largest coordinates do not reach that.
    ``side`` (0 or 1): only pairs of different sides.
    """
    n = len(sizes)
    if n < 2:
        return np.empty((0, 2), dtype=np.int64)
    t = threshold / (1 + threshold)
    order = np.lexsort((*vectors.T[:3], sizes))
    v, s = vectors[order], sizes[order]
    starts = np.arange(0, n, FANOUT)
    leaf_top = np.maximum.reduceat(v, starts, axis=0)
    leaf_least = s[starts]  # sorted by size
    leaf_most = s[np.minimum(starts + FANOUT, n) - 1]
    roots = np.arange(0, len(starts), FANOUT)
    root_top = np.maximum.reduceat(leaf_top, roots, axis=0)
    root_least, root_most = leaf_least[roots], leaf_most[np.minimum(roots + FANOUT, len(starts)) - 1]
    out = []
    for i in range(n - 1):
        q, m = v[i], s[i]
        # partners are later in the order, so at least as large, and at most m / threshold
        ok = (root_least <= m / threshold + 1e-9) & (root_most >= m)
        ok &= np.minimum(root_top, q).sum(1) >= t * (m + np.maximum(root_least, m)) - 1e-9
        leaves = [x for r in np.flatnonzero(ok) for x in range(roots[r], min(roots[r] + FANOUT, len(starts))) if starts[x] + FANOUT > i + 1]
        if not leaves:
            continue
        leaves = np.array(leaves)
        ok = np.minimum(leaf_top[leaves], q).sum(1) >= t * (m + np.maximum(leaf_least[leaves], m)) - 1e-9
        for x in leaves[ok]:
            a, b = max(starts[x], i + 1), min(starts[x] + FANOUT, n)
            ok2 = np.minimum(v[a:b], q).sum(1) >= t * (m + s[a:b]) - 1e-9
            j = np.flatnonzero(ok2) + a
            if side is not None:
                j = j[side[order[j]] != side[order[i]]]
            if len(j):
                out.append(np.column_stack([np.full(len(j), order[i]), order[j]]))
    return np.concatenate(out) if out else np.empty((0, 2), dtype=np.int64)


def sketch_bits(n_texts: int) -> int:
    """Buckets for the shingles of so many texts: 2 to the power of 18 to 24, so at most 16 MB to broadcast."""
    return int(min(24, max(18, np.ceil(np.log2(max(n_texts, 1) * 128)))))


def _sketch(df: DataFrame, k: int, bits: int) -> np.ndarray:
    """How many shingles fall into each bucket, over all texts, as a byte on a logarithmic scale.

    It only decides which shingles count as rare, so that its noise costs time and never a pair. Each task sends its
    buckets in 64 pieces, which are added up in the executors; the driver gets the sum, whose size is fixed.
    """
    size, parts = 1 << bits, 64

    def count(batches):
        total = np.zeros(size, dtype=np.int32)
        sh = Shingler(k)
        for batch in batches:
            sets = sh.sets(batch.column(0).to_pylist())
            if sets:
                np.add.at(total, (np.concatenate(sets) & np.uint64(size - 1)).astype(np.int64), 1)
        if total.any():
            small = np.minimum(total, 65535).astype(np.uint16).reshape(parts, -1)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(parts, dtype=np.int32)), pa.array([zlib.compress(x.tobytes(), 1) for x in small], pa.binary())], names=["piece", "counts"])

    def add(batches):
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for piece, x in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                own = total.setdefault(piece, np.zeros(size // parts, dtype=np.int64))
                own += np.frombuffer(zlib.decompress(x), dtype=np.uint16)
        if total:
            scaled = {p: np.minimum(np.round(np.log2(t + 1) * ONCE), 255).astype(np.uint8).tobytes() for p, t in total.items()}
            yield pa.RecordBatch.from_arrays([pa.array(list(scaled), pa.int32()), pa.array(list(scaled.values()), pa.binary())], names=["piece", "counts"])

    rows = df.mapInArrow(count, "piece int, counts binary").repartition("piece").mapInArrow(add, "piece int, counts binary").collect()
    out = np.zeros((parts, size // parts), dtype=np.uint8)
    for r in rows:
        out[r["piece"]] = np.frombuffer(r["counts"], dtype=np.uint8)
    return out.ravel()


def _packed(v: np.ndarray) -> bytes:
    """Counts as bytes if all fit, else as 32-bit numbers."""
    return v.astype(np.uint8).tobytes() if not len(v) or v.max() < 256 else v.astype(np.uint32).tobytes()


def _unpacked(b: bytes) -> np.ndarray:
    return np.frombuffer(b, dtype=np.uint8 if len(b) == GROUPS else np.uint32)


def _shared(a: bytes, b: bytes) -> int:
    """How many 40-bit hashes two packed sets share."""
    x, y = (np.ascontiguousarray(np.frombuffer(s, dtype="V5")) for s in (a, b))
    wide = np.zeros((len(x) + len(y), 8), dtype=np.uint8)
    wide[: len(x), :5] = x.view(np.uint8).reshape(-1, 5)
    wide[len(x) :, :5] = y.view(np.uint8).reshape(-1, 5)
    return len(wide) - len(np.unique(wide.view(np.int64)))


def _runs(batches, n_keys: int):
    """Rows sorted by their first columns, as (keys, other columns, bounds of runs of equal keys); a run that goes on in
    the next batch is held back. Runs are blocks and so bounded."""
    held = None
    for batch in batches:
        cols = [np.asarray(c) if pa.types.is_integer(c.type) else np.array(c.to_pylist(), dtype=object) for c in batch.columns]
        if held is not None:
            cols = [np.concatenate(x) for x in zip(held, cols)]
        n = len(cols[0])
        if not n:
            continue
        change = np.zeros(n - 1, dtype=bool)
        for c in cols[:n_keys]:
            change |= c[1:] != c[:-1]
        at = np.concatenate([[0], np.flatnonzero(change) + 1])
        held = [c[at[-1] :] for c in cols]
        yield cols[:n_keys], cols[n_keys:], at
    if held is not None:
        yield held[:n_keys], held[n_keys:], np.array([0, len(held[0])])


class NearDuplicates:
    """``members`` (key, sig, size, vector) of all texts; ``pairs`` (sig_a, sig_b, similarity) between classes of equal
    shingle sets.

    Null and blank texts and null keys are left out; equal texts are one class, so that no number of copies makes a
    group hot; an empty table gives no rows. All pairs of the similarity or more are found, whatever a group's size.
    """

    def __init__(self, df: DataFrame, key: str = "ord", text: str = "text", threshold: float = 0.7, k: int = 5):
        self.key, self.text, self.threshold, self.k = key, text, threshold, k
        self.spark = df.sparkSession
        self.texts = df.select(F.col(key).alias("_k"), F.col(text).cast("string").alias("_t")).filter(F.col("_k").isNotNull() & ~F.col("_t").rlike(r"(?U)\A[\s\x1c-\x1f]*\z"))
        self.n_texts = df.count()
        self.signed = materialize(self._signatures(self.n_texts))
        self.members = self.signed.select("_k", "sig", "size", "vector")
        self.pairs = materialize(self._pairs())

    def _signatures(self, n_texts: int) -> DataFrame:
        """One row per text: the key, a 64-bit signature of its set, the set's size, its count vector, and its prefix.

        Under one order of all shingles (rare ones by the sketch first), two sets of similarity t share a shingle that is
        among the first n - ceil(t n) + 1 of the larger and the first n - ceil(2t/(1+t) n) + 1 of the smaller. The prefix
        holds 5-byte hashes in rising order of frequency; two numbers before them are the length of the shorter part and the
        number of those that are not hot. A task writes the prefix of equal sets
        once; unequal shingles that share a hash are sorted out when pairs are verified.
        """
        sketch = self.spark.sparkContext.broadcast(_sketch(self.texts.select("_t"), self.k, sketch_bits(n_texts)))
        k, t, hot = self.k, self.threshold, np.log2(max(BLOCK, HOT_SHARE * n_texts) + 1) * ONCE
        schema = self.texts.select("_k").schema.add("sig", "long").add("size", "integer").add("vector", "binary").add("prefix", "binary")

        def sign(batches):
            freq = sketch.value
            mask = np.uint64(len(freq) - 1)
            sh = Shingler(k)
            seen: set[int] = set()
            for batch in batches:
                sigs, sizes, vectors, prefixes = [], [], [], []
                for s in sh.sets(batch.column(1).to_pylist()):
                    n = len(s)
                    sig = xxhash.xxh3_64_intdigest(s.tobytes()) & ~1  # the lowest bit is used below
                    sigs.append(sig)
                    sizes.append(n)
                    vectors.append(_packed(count_vector(s)))
                    if sig in seen:
                        prefixes.append(None)
                        continue
                    if len(seen) > 500_000:
                        seen.clear()
                    seen.add(sig)
                    longer = min(n, n - int(np.ceil(t * n - 1e-9)) + 1)
                    shorter = min(n, n - int(np.ceil(2 * t / (1 + t) * n - 1e-9)) + 1)
                    f = freq[(s & mask).astype(np.int64)]
                    order = np.lexsort((s, f))[:longer]
                    shared = f[order] > ONCE  # a bucket of one shingle holds nothing that two texts share
                    p = s[order[shared]]
                    cold = (f[order[shared]] < hot - 1).sum()
                    prefixes.append(np.array([shared[:shorter].sum(), cold], dtype=np.uint32).tobytes() + p.view(np.uint8).reshape(-1, 8)[:, 3:].tobytes())
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.array(sigs, dtype=np.uint64).view(np.int64)), pa.array(np.array(sizes, dtype=np.int32)), pa.array(vectors, pa.binary()), pa.array(prefixes, pa.binary())], names=schema.names)

        return self.texts.select("_k", "_t").mapInArrow(sign, schema)

    def _blocks(self) -> DataFrame:
        """``block, sig, side``: groups of classes that share a prefix shingle; side 2 meets everyone.

        Groups above ``BLOCK`` rows are dealt to chunks by a hash, apart for each level of set sizes; levels are so wide that
        similar sets are of one level or of neighbouring ones. Each pair of chunks that can hold a pair is a block of its
        own, so no task holds or numbers an unbounded group. Groups with the same classes are kept once.
        """

        def spread(hot: bool):
            def run(batches):
                for batch in batches:
                    sigs, prefixes, levels = (batch.column(i).to_pylist() for i in range(3))
                    hs, n, first = [np.empty(0, np.int64)], [], [np.empty(0, np.int64)]
                    for p in prefixes:
                        shorter, cold = np.frombuffer(p, dtype=np.uint32, count=2).tolist()
                        raw = np.frombuffer(p, dtype=np.uint8, offset=8).reshape(-1, 5)
                        own = slice(cold, len(raw)) if hot else slice(0, cold)
                        wide = np.zeros((len(raw), 8), dtype=np.uint8)
                        wide[:, :5] = raw
                        hs.append(wide.view(np.int64).ravel()[own])
                        n.append(len(hs[-1]))
                        first.append((np.arange(len(raw)) < shorter).astype(np.int64)[own])
                    # the lowest bit: whether the set may be the smaller one of a pair by this shingle
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(hs)), pa.array(np.repeat(np.array(sigs, dtype=np.int64), n) | np.concatenate(first)), pa.array(np.repeat(np.array(levels, dtype=np.int32), n))], names=["h", "s", "level"])

            return run

        # wider than the ratio of sizes that the threshold allows, so that rounding never parts two levels
        level = F.floor(F.log("size") / float(-np.log(self.threshold) * 1.0001)).cast("int")
        classes = self.signed.filter("prefix is not null").select("sig", "prefix", level.alias("level"))

        def members(hot: bool) -> DataFrame:
            return classes.mapInArrow(spread(hot), "h bigint, s bigint, level int")

        keys = ["h", "lo_level", "lo", "hi_level", "hi"]
        rows = self._cold(members(False)).unionByName(self._hot(members(True))).repartition(*keys).sortWithinPartitions(*keys, "sig")

        def gather(batches):
            for _, (sig, side), at in _runs(batches, 5):
                ids, members = [], []
                for i, j in zip(at[:-1].tolist(), at[1:].tolist()):
                    own = sig[i:j].tobytes() + side[i:j].astype(np.uint8).tobytes()
                    ids.append(xxhash.xxh3_64_intdigest(own))
                    members.append(own)
                yield pa.RecordBatch.from_arrays([pa.array(np.array(ids, dtype=np.uint64).view(np.int64)), pa.array(members, pa.binary())], names=["block", "members"])

        def scatter(batches):
            for batch in batches:
                ids, members = batch.column(0).to_pylist(), batch.column(1).to_pylist()
                n = np.array([len(m) // 9 for m in members], dtype=np.int64)
                sig = np.concatenate([np.frombuffer(m, dtype=np.int64, count=k) for m, k in zip(members, n)]) if members else np.empty(0, np.int64)
                side = np.concatenate([np.frombuffer(m, dtype=np.uint8, offset=8 * k) for m, k in zip(members, n)]) if members else np.empty(0, np.uint8)
                yield pa.RecordBatch.from_arrays([pa.array(np.repeat(np.array(ids, dtype=np.int64), n)), pa.array(sig), pa.array(side.astype(np.int32))], names=["block", "sig", "side"])

        return rows.mapInArrow(gather, "block bigint, members binary").dropDuplicates(["block"]).mapInArrow(scatter, "block bigint, sig bigint, side int")

    @staticmethod
    def _shared_groups(rows: DataFrame) -> DataFrame:
        """``h, n`` of the groups that can hold a pair."""
        return rows.groupBy("h").agg(F.count("*").alias("n"), F.max(F.col("s").bitwiseAND(F.lit(1))).alias("smaller")).filter("n > 1 and smaller = 1").select("h", "n")

    def _cold(self, rows: DataFrame) -> DataFrame:
        """Groups of a bounded share of the texts: all of one shuffle; those above a block are numbered and cut."""
        rows = rows.repartition("h").dropDuplicates(["h", "s"])
        rows = rows.join(self._shared_groups(rows), "h")
        rows = rows.withColumn("c", ((F.row_number().over(W.partitionBy("h").orderBy("s")) - 1) / BLOCK).cast("int"))
        rows = rows.withColumn("d", F.explode(F.sequence(F.lit(0), ((F.col("n") - 1) / BLOCK).cast("int"))))
        lo, hi = F.least("c", "d"), F.greatest("c", "d")
        side = F.when(lo == hi, 2).when(F.col("c") == lo, 0).otherwise(1)
        none = F.lit(-1)
        return rows.select("h", none.alias("lo_level"), lo.alias("lo"), none.alias("hi_level"), hi.alias("hi"), F.col("s").bitwiseAND(F.lit(~1)).alias("sig"), side.alias("side"))

    def _hot(self, rows: DataFrame) -> DataFrame:
        """Groups of any size: rows are spread by their own hash, counted with partial sums, and met by the counts of the chunks
        of their group, copied to several tasks."""
        rows = materialize(rows.dropDuplicates(["h", "s"]))
        rows = join_salted(rows, self._shared_groups(rows).select("h"), "h", "s")
        # per group, how many chunks each level of sizes has; a handful of levels
        chunks = rows.groupBy("h", "level").agg(F.count("*").alias("n")).select("h", "level", F.ceil(F.col("n") / BLOCK).cast("int").alias("c"))
        levels = chunks.groupBy("h").agg(F.map_from_entries(F.collect_list(F.struct("level", "c"))).alias("levels"))
        rows = join_salted(rows, levels, "h", "s")
        own = F.pmod(F.xxhash64("s"), F.element_at("levels", F.col("level"))).cast("int")
        near = F.filter(F.map_entries("levels"), lambda e: F.abs(e["key"] - F.col("level")) <= 1)
        met = F.flatten(F.transform(near, lambda e: F.transform(F.sequence(F.lit(0), e["value"] - 1), lambda c: F.struct(e["key"].alias("level"), c.alias("c")))))
        rows = rows.withColumn("me", F.struct(F.col("level").alias("level"), own.alias("c"))).withColumn("other", F.explode(met))
        lo, hi = F.least("me", "other"), F.greatest("me", "other")
        side = F.when(F.col("me") == F.col("other"), 2).when(F.col("me") == lo, 0).otherwise(1)
        return rows.select("h", lo["level"].alias("lo_level"), lo["c"].alias("lo"), hi["level"].alias("hi_level"), hi["c"].alias("hi"), F.col("s").bitwiseAND(F.lit(~1)).alias("sig"), side.alias("side"))

    def _pairs(self) -> DataFrame:
        threshold, k = self.threshold, self.k
        classes = self.signed.filter("prefix is not null").select("sig", "size", "vector")
        points = self._blocks().join(classes, "sig").select("block", "sig", "size", "side", "vector").repartition("block").sortWithinPartitions("block", "sig")

        def candidates(batches):
            for _, (sig, size, side, vector), at in _runs(batches, 1):
                found = set()
                for i, j in zip(at[:-1].tolist(), at[1:].tolist()):
                    _, keep = np.unique(sig[i:j], return_index=True)  # a class may have been written by several tasks
                    own = keep + i
                    v = np.stack([_unpacked(vector[x]) for x in own]).astype(np.int32)
                    pairs = tree_pairs(v, size[own].astype(np.int64), threshold, None if side[i] == 2 else side[own])
                    found.update((min(x, y), max(x, y)) for x, y in zip(sig[own[pairs[:, 0]]].tolist(), sig[own[pairs[:, 1]]].tolist()))
                yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in found], pa.int64()), pa.array([x[1] for x in found], pa.int64())], names=["sig_a", "sig_b"])

        pairs = materialize(points.mapInArrow(candidates, "sig_a bigint, sig_b bigint").distinct())
        sigs = pairs.select(F.col("sig_a").alias("sig")).union(pairs.select("sig_b")).distinct()
        rep = materialize(self.members.join(sigs, "sig", "left_semi").groupBy("sig").agg(F.min("_k").alias("_k")))
        wanted = self.spark.sparkContext.broadcast(key_filter(rep.select(F.xxhash64("_k"))))

        def hashes(batches):
            sh, keep = Shingler(k), wanted.value
            for batch in batches:
                own = batch.filter(pa.array(keep(np.asarray(batch.column(2)))))  # lets some others pass, which a join leaves out
                sets = [s.view(np.uint8).reshape(-1, 8)[:, 3:].tobytes() for s in sh.sets(own.column(1).to_pylist())]
                yield pa.RecordBatch.from_arrays([own.column(0), pa.array(sets, pa.binary())], names=["_k", "hashes"])

        schema = self.texts.select("_k").schema.add("hashes", "binary")
        read = self.texts.select("_k", "_t", F.xxhash64("_k").alias("x")).mapInArrow(hashes, schema)
        sets = materialize(read.join(rep, "_k").select("sig", "hashes"))
        a = sets.select(F.col("sig").alias("sig_a"), F.col("hashes").alias("ha"))
        b = sets.select(F.col("sig").alias("sig_b"), F.col("hashes").alias("hb"))

        def verify(batches):
            for batch in batches:
                x, y = batch.column(2).to_pylist(), batch.column(3).to_pylist()
                both = np.array([_shared(p, q) for p, q in zip(x, y)], dtype=np.float64)
                n = np.array([(len(p) + len(q)) // 5 for p, q in zip(x, y)], dtype=np.float64)
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(both / np.maximum(n - both, 1))], names=["sig_a", "sig_b", "similarity"])

        joined = pairs.join(a, "sig_a").join(b, "sig_b").select("sig_a", "sig_b", "ha", "hb")
        return joined.mapInArrow(verify, "sig_a bigint, sig_b bigint, similarity double").filter(F.col("similarity") >= threshold - 1e-12)

    def row_pairs(self) -> DataFrame:
        """``ord_a, ord_b``: all pairs of rows, equal texts included."""
        rows = self.members.select(F.col("sig"), F.col("_k"))
        a, b = rows.select("sig", F.col("_k").alias("ka")), rows.select("sig", F.col("_k").alias("kb"))
        many = rows.groupBy("sig").agg(F.count("*").alias("n")).filter("n > 1").select("sig")
        copies = F.explode(F.sequence(F.lit(0), F.lit(SALT - 1)))
        own = a.join(many, "sig", "left_semi").withColumn("salt", F.pmod(F.xxhash64(F.col("ka").cast("string")), F.lit(SALT)).cast("int"))
        equal = own.join(b.join(many, "sig", "left_semi").withColumn("salt", copies), ["sig", "salt"]).filter("ka < kb").select("ka", "kb")
        near = self.pairs.join(a.withColumnRenamed("sig", "sig_a"), "sig_a").join(b.withColumnRenamed("sig", "sig_b"), "sig_b").select("ka", "kb")
        return equal.unionByName(near).select(F.least("ka", "kb").alias("ord_a"), F.greatest("ka", "kb").alias("ord_b"))

    def groups(self) -> DataFrame:
        """``key, group_id, n_links``: one row per text; the group is the least key that is linked to it over any number of
        links, ``n_links`` the number of other rows that are similar to it."""
        reps = self.members.groupBy("sig").agg(F.min("_k").alias("first"), F.count("*").alias("n"))
        links = self.pairs.select("sig_a", "sig_b").unionByName(self.pairs.select(F.col("sig_b").alias("sig_a"), F.col("sig_a").alias("sig_b")))
        degree = links.join(reps.select(F.col("sig").alias("sig_b"), "n"), "sig_b").groupBy("sig_a").agg(F.sum("n").alias("near"))
        edges = links.join(reps.select(F.col("sig").alias("sig_a"), F.col("first").alias("u")), "sig_a").join(reps.select(F.col("sig").alias("sig_b"), F.col("first").alias("v")), "sig_b").select("u", "v")
        label = components(edges)
        out = reps.join(degree.withColumnRenamed("sig_a", "sig"), "sig", "left").join(label, reps["first"] == label["u"], "left")
        out = out.select("sig", F.coalesce("label", "first").alias("group_id"), (F.col("n") - 1 + F.coalesce("near", F.lit(0))).alias("n_links"))
        return self.members.select("sig", "_k").join(out, "sig").select(F.col("_k").alias(self.key), "group_id", "n_links")


#: Rounds after which the search for components gives up with an error; the number needed grows with the logarithm.
ROUNDS = 60


def components(edges: DataFrame) -> DataFrame:
    """``u, label``: the least node of each node's component, by alternating large-star and small-star steps.

    Each round is two shuffles of the edges; the number of rounds grows with the logarithm of the longest chain. Nothing
    is collected but a count; lineage is cut with reliable checkpoints.
    """
    e = materialize(edges.filter("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    seen = None
    for _ in range(ROUNDS):
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        down = large.filter("v < u")
        least = down.groupBy("u").agg(F.min("v").alias("m"))
        small = down.join(least, "u").filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v"))).distinct()
        e = materialize(small.filter("u != v"))
        now = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError(f"components have not settled after {ROUNDS} rounds")
    roots = e.select(F.col("v").alias("u")).distinct().withColumn("label", F.col("u"))
    return e.select("u", F.col("v").alias("label")).unionByName(roots)
