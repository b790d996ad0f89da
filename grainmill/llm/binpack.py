"""Filling containers of fixed capacity (problem 5)."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grainmill.runtime import slots

#: Items that are packed together. Texts are dealt to slots by a hash of their key.
ITEMS_PER_SLOT = 20_000
#: The opening rules that a joint packing tries; see ``pack``.
WASTE_RULES = (0.0, 0.02, 0.1, 1.0)


def best_fit(lengths: np.ndarray, sizes: list[int], waste: float = 0.0) -> tuple[np.ndarray, np.ndarray]:
    """The bin of each item and the capacity of each bin, by best fit in falling order of length.

    An item goes into the open bin that it leaves with the least room. If none holds it, the smallest permitted
    capacity of which it wastes at most the share ``waste`` is opened (it costs least), else the largest. At the end each
    bin shrinks to the smallest permitted capacity that holds its contents.
    """
    sizes = sorted(sizes)
    top = sizes[-1]
    by_room: list[list[int]] = [[] for _ in range(top + 1)]
    rooms = 0  # bit r is set if a bin with r left is open
    bins = np.empty(len(lengths), dtype=np.int64)
    used: list[int] = []
    room: list[int] = []
    for i in np.argsort(-lengths, kind="stable").tolist():
        n = int(lengths[i])
        fit = rooms >> n
        if fit:
            r = n + (fit & -fit).bit_length() - 1
            b = by_room[r].pop()
            if not by_room[r]:
                rooms ^= 1 << r
        else:
            cap = next((c for c in sizes if n <= c and c - n <= waste * c), top)
            b, r = len(used), cap
            used.append(0)
            room.append(0)
        bins[i] = b
        used[b] += n
        r -= n
        if not by_room[r]:
            rooms |= 1 << r
        by_room[r].append(b)
    capacity = np.array(sizes, dtype=np.int64)[np.searchsorted(sizes, used)] if used else np.empty(0, dtype=np.int64)
    return bins, capacity


def pack(lengths: np.ndarray, sizes: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """The best of several opening rules by the total capacity; a single size needs one."""
    rules = WASTE_RULES if len(sizes) > 1 else WASTE_RULES[:1]
    return min((best_fit(lengths, sizes, w) for w in rules), key=lambda x: int(x[1].sum()))


def pack_items(items: DataFrame, plans: dict[str, tuple[str, list[int]]], key: str, n_items: int, per_slot: int = ITEMS_PER_SLOT) -> DataFrame:
    """``plan, key, part, start, length, bin, capacity``: one row per part of an item and plan.

    ``items`` has ``key`` and one length column per unit; ``plans`` maps a name to (unit, permitted capacities). An item
    above the largest capacity is cut into full containers and a rest; others stay whole. Items without length take no
    container (``bin`` and ``capacity`` null). Only keys and lengths are shuffled, evenly by a hash of the key, so no
    length, source or copy group can be hot; each slot is packed by itself, and its open bins at the end cost at most one
    container per slot and plan in practice. Ties go to the earlier item of the slot in the order of keys.
    """
    n_slots = slots(n_items, per_slot)
    units = sorted({u for u, _ in plans.values()})
    schema = items.select(key).schema
    out = f"plan string, `{key}` {schema[0].dataType.simpleString()}, part int, start bigint, length bigint, bin bigint, capacity bigint"

    def one(slot: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["_k", *units], kind="stable").reset_index(drop=True)
        frames = []
        for name, (unit, sizes) in plans.items():
            n = pdf[unit].fillna(0).to_numpy(dtype=np.int64)
            top = max(sizes)
            full = np.maximum(0, (n - 1) // top)  # whole containers before the rest
            parts = full + 1
            row = np.repeat(np.arange(len(n)), parts)
            part = np.arange(len(row)) - np.repeat(np.cumsum(parts) - parts, parts)
            start = part * top
            length = np.minimum(n[row] - start, top)
            live = length > 0
            b = np.full(len(row), -1, dtype=np.int64)
            c = np.zeros(len(row), dtype=np.int64)
            if live.any():
                got, caps = pack(length[live], sizes)
                b[live] = got + (int(slot[0]) << 32)
                c[live] = caps[got]
            f = pd.DataFrame({"plan": name, key: pdf["_k"].to_numpy()[row], "part": part, "start": start, "length": length})
            f["bin"] = pd.Series(b).where(pd.Series(live)).astype("Int64")
            f["capacity"] = pd.Series(c).where(pd.Series(live)).astype("Int64")
            frames.append(f)
        return pd.concat(frames)

    cols = items.select(F.col(key).alias("_k"), *(F.col(u) for u in units), F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(n_slots)).alias("_slot"))
    return cols.groupBy("_slot").applyInPandas(one, out)


def containers(assignment: DataFrame) -> DataFrame:
    """``plan, capacity, n_bins, n_parts, used, unused``: the space left by each plan and capacity."""
    bins = assignment.filter("bin is not null").groupBy("plan", "bin", "capacity").agg(F.sum("length").alias("used"), F.count("*").alias("n"))
    return bins.groupBy("plan", "capacity").agg(F.count("*").alias("n_bins"), F.sum("n").alias("n_parts"), F.sum("used").alias("used"), F.sum(F.col("capacity") - F.col("used")).alias("unused"))


def kept_rules(assignment: DataFrame) -> DataFrame:
    """``plan, n_parts, total, n_overfull, n_torn``: what a packing must keep, for comparison with the lengths that went in.

    Only a part behind whole containers of the largest size, or before such a part, belongs to a divided item.
    """
    largest = assignment.groupBy("plan").agg(F.max("capacity").alias("top"), F.sum("length").alias("total"), F.count("*").alias("n_parts"))
    torn = assignment.filter("part > 0").join(F.broadcast(largest.select("plan", "top")), "plan").filter("start % top != 0 or start = 0").groupBy("plan").agg(F.count("*").alias("n_torn"))  # a row per plan
    full = assignment.filter("bin is not null").groupBy("plan", "bin").agg(F.sum("length").alias("used"), F.max("capacity").alias("capacity")).filter("used > capacity").groupBy("plan").agg(F.count("*").alias("n_overfull"))
    out = largest.join(full, "plan", "left").join(torn, "plan", "left")
    return out.select("plan", "n_parts", "total", F.coalesce("n_overfull", F.lit(0)).cast("bigint").alias("n_overfull"), F.coalesce("n_torn", F.lit(0)).cast("bigint").alias("n_torn"))
