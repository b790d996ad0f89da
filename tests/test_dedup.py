"""Duplicates against sequential loops."""

import random

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from grainmill.operators import dedup
from grainmill.plans.pipeline import clean_corpus

LONG = "word " * 60


def greedy(rows):
    """rows: (ord, bucket). The ords that a loop in order keeps."""
    own = {}
    for o, b in rows:
        own.setdefault(o, set()).add(b)
    kept, seen = [], set()
    for o in sorted(own):
        if not own[o] & seen:
            kept.append(o)
            seen |= own[o]
    return kept


def resolved(spark, rows):
    df = spark.createDataFrame([(o, 0, str(b)) for o, b in rows], "ord bigint, band int, key string")
    dropped = {r["ord"] for r in dedup.resolve(df).collect() if not r["kept"]}
    return sorted({o for o, _ in rows} - dropped)


def test_chain_keeps_both_ends(spark):
    # 1 and 2 share a bucket, 2 and 3 another: 2 goes, 3 stays
    assert resolved(spark, [(1, "a"), (2, "a"), (2, "b"), (3, "b")]) == [1, 3]


def test_long_chain_and_hot_bucket(spark):
    chain = [(i, f"c{j}") for i in range(1, 10) for j in (i, i + 1)]
    hot = [(100 + i, "hot") for i in range(300)]
    assert resolved(spark, chain + hot) == greedy(chain + hot)


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(seed=st.integers(0, 10_000))
def test_random_graphs(spark, seed):
    r = random.Random(seed)
    rows = sorted({(r.randrange(25), r.randrange(20)) for _ in range(45)})
    assert resolved(spark, rows) == greedy(rows)


def test_exact_first_wins_and_boundaries(spark):
    rows = [(5, "A " + LONG), (2, "a  " + LONG), (3, "x" * 199), (4, "y" * 200), (6, None), (7, ""), (8, "  " + "z" * 200 + "  "), (9, LONG), (9, LONG)]
    df = spark.createDataFrame([(o, t, "clash", 1) for o, t in rows], "ord bigint, text string, sha string, _first int").repartition(3)
    got = {(r["ord"], r["status"]) for r in dedup.mark_exact(df).collect()}
    assert got == {(5, "duplicate"), (2, "kept"), (3, "too_short"), (4, "kept"), (6, "too_short"), (7, "too_short"), (8, "kept"), (9, "kept")}
    kept = {r["ord"]: r["text"] for r in dedup.exact_dedup(df).collect()}
    assert kept[8] == "  " + "z" * 200 + "  "


def test_near_status(spark):
    base = [f"w{i}" for i in range(400)]
    near = base.copy()
    near[399] = "other"
    texts = [" ".join(base), " ".join(near), " ".join(near).upper(), "tiny"]
    df = spark.createDataFrame(list(enumerate(texts)), "ord bigint, text string")
    got = {r["ord"]: r["status"] for r in dedup.near_dedup(df).collect()}
    assert got[0] == "kept" and got[3] == "too_short" and got[2] == "exact"
    assert {r["ord"] for r in clean_corpus(df).collect()} == {o for o, s in got.items() if s == "kept"}
    # cleaning what was cleaned drops nothing
    again = clean_corpus(clean_corpus(df))
    assert again.count() == clean_corpus(df).count()


def test_empty(spark):
    df = spark.createDataFrame([], "ord bigint, text string")
    assert dedup.near_dedup(df).count() == 0 and dedup.exact_dedup(df).count() == 0


def test_near_rows_by_name(spark):
    base = [f"w{i}" for i in range(400)]
    one, other = [*base[:399], "other"], [f"v{i}" for i in range(300)]
    df = spark.createDataFrame(list(enumerate([" ".join(base), " ".join(one), " ".join(one).upper(), " ".join(other)])), "ord bigint, text string")
    assert {r["ord"]: r["status"] for r in dedup.near_dedup(df).collect()} == {0: "kept", 1: "near", 2: "exact", 3: "kept"}
    # a layout of many single rows calls more alike, one of a single long band only what is equal
    assert dedup.layout() == (dedup.BANDS, dedup.ROWS) and dedup.layout(0.3, 16)[1] < dedup.layout(0.9, 16)[1]
    assert {r["ord"]: r["status"] for r in dedup.near_dedup(df, threshold=0.9, permutations=16).collect()}[3] == "kept"


def test_keys_of_both_ways_agree(spark):
    texts = ["Ein  Text " * 60, "x " * 300, "Ａ" * 250, None, "short", "ÄÖ " * 100]
    df = spark.createDataFrame(list(enumerate(texts)), "ord bigint, text string").repartition(2)
    a = {(r["ord"], r["band"], r["key"]) for r in dedup.buckets(df.filter("length(text) > 150")).collect()}
    b = {(r["ord"], r["band"], r["key"]) for r in dedup.exploded(dedup.signatures(df)).collect()}
    assert a == b and len(b) == 4 * dedup.BANDS
    assert {r["ord"]: r["sha"] for r in dedup.signatures(df).collect()} == {r["ord"]: r["sha"] for r in dedup.mark_exact(df).collect()}


def test_many_dropped_rows_need_no_broadcast(spark, monkeypatch):
    from grainmill import runtime

    df = spark.createDataFrame([(i, LONG + str(i % 7)) for i in range(60)], "ord bigint, text string")
    small = sorted(r["ord"] for r in dedup.exact_dedup(df).collect())
    monkeypatch.setattr(runtime.join_checked, "__defaults__", ("inner", 5))
    assert sorted(r["ord"] for r in dedup.exact_dedup(df).collect()) == small == list(range(7))
