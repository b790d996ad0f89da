"""Containers and mixtures."""

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from grainmill.llm.binpack import best_fit, containers, pack, pack_items
from grainmill.llm.mixing import in_order, mixture, shares


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 50), max_size=80), st.sampled_from([[50], [50, 80], [60, 90, 120]]))
def test_bins_hold_their_items(lengths, sizes):
    x = np.array(lengths, dtype=np.int64)
    bins, caps = pack(x, sizes)
    assert len(bins) == len(x) and set(bins) == set(range(len(caps)))
    used = np.bincount(bins, weights=x, minlength=len(caps)) if len(x) else np.empty(0)
    assert all(u <= c and c in sizes for u, c in zip(used, caps))
    # no smaller permitted size would do, and half-empty bins of a single size do not come twice
    assert all(c == min(s for s in sizes if s >= u) for u, c in zip(used, caps))
    if len(sizes) == 1:
        assert sum(u <= sizes[0] / 2 for u in used) <= 1


def test_joint_is_no_worse_than_the_largest():
    x = np.random.default_rng(1).integers(1, 3000, 4000)
    assert pack(x, [2048, 4096])[1].sum() <= best_fit(x, [4096])[1].sum()


def test_items_stay_whole(spark):
    rows = [(i, n, "clash") for i, n in enumerate([5, 10, 10, 3, 0, None, 25, 10**6, 7])] + [(1, 10, "again")]
    df = spark.createDataFrame(rows, "ord bigint, chars bigint, bin string").repartition(3)
    out = pack_items(df, {"a": ("chars", [10]), "b": ("chars", [10, 20])}, "ord", 10, per_slot=4).toPandas()
    for plan, top in (("a", 10), ("b", 20)):
        p = out[out["plan"] == plan]
        for o, n, _ in rows:
            own = p[p["ord"] == o]
            if n:
                assert own["length"].sum() == n * (2 if o == 1 else 1)
                assert (len(own) > (2 if o == 1 else 1)) == (n > top)
            else:
                assert own["bin"].isna().all() and len(own) == 1
        live = p[p["bin"].notna()]
        g = live.groupby("bin").agg(used=("length", "sum"), cap=("capacity", "max"))
        assert (g["used"] <= g["cap"]).all()
    c = containers(spark.createDataFrame(out.astype({"bin": "float", "capacity": "float"})).selectExpr("plan", "ord", "part", "length", "case when isnan(bin) then null else cast(bin as bigint) end bin", "cast(capacity as bigint) capacity")).toPandas()
    assert (c["unused"] >= 0).all() and c[c["plan"] == "a"]["used"].sum() == sum(n or 0 for _, n, _ in rows)
    assert pack_items(df.limit(0), {"a": ("chars", [10])}, "ord", 0).count() == 0


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, "big" if i % 10 else "Small ", 1 + i % 7, 0) for i in range(2000)] + [(5000, None, 9, 0), (5001, "big", 0, 0), (5002, "big", None, 0), (5003, "other", 3, 0)]
    return spark.createDataFrame(rows, "doc_id bigint, source string, n_tokens bigint, copy int")


def test_shares_and_caps(spark, docs):
    t = spark.createDataFrame([(1, "BIG", 0.5, 1), (1, "small", 0.4, 4), (1, "glossary", 0.1, 2), (2, "big", 1.0, 3), (3, "small", None, 1), (4, "big", 0.5, 0)], "plan_id int, source string, target_share double, max_repeats int")
    for per in (50_000, 37):
        import grainmill.llm.mixing as m

        old, m.DOCS_PER_BLOCK = m.DOCS_PER_BLOCK, per
        try:
            got = mixture(docs, t, 2004).toPandas()
        finally:
            m.DOCS_PER_BLOCK = old
        assert not got.duplicated(["plan_id", "doc_id", "copy"]).any()
        one = got[got.plan_id == 1]
        total = one.n_tokens.sum()
        share = one.groupby("source").n_tokens.sum() / total
        assert abs(share["big"] - 0.5 / 0.9) < 0.01 and abs(share["small"] - 0.4 / 0.9) < 0.01
        assert one.groupby(["source", "doc_id"]).size().groupby("source").max().le(pd.Series({"big": 1, "small": 4})).all()
        two = got[got.plan_id == 2]
        assert (two.groupby("doc_id").size() == 3).all() and set(two.source) == {"big"}
        assert set(got.plan_id) == {1, 2} and not {5000, 5001, 5002, 5003} & set(got.doc_id)
    s = shares(mixture(docs, t, 2004), t).toPandas().set_index(["plan_id", "source"])
    assert s.loc[(1, "glossary"), "n_tokens"] == 0 and abs(s.loc[(1, "big"), "actual_share"] - 0.5 / 0.9) < 0.01
    ordered = [r["finish"] for r in in_order(mixture(docs, t, 2004)).filter("plan_id = 1").collect()]
    assert ordered == sorted(ordered)
    assert mixture(docs.limit(0), t, 0).count() == 0
