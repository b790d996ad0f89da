"""Near duplicates and look-alikes against brute force."""

import random
import unicodedata

import numpy as np

from grainmill.llm import neardup
from grainmill.llm.lookalikes import Forms, SYMBOLS, compatible, form_classes, look_alike_pairs
from grainmill.llm.neardup import NearDuplicates, components, count_vector, tree_pairs


def shingles(t):
    w = unicodedata.normalize("NFKC", t).lower().split()
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) > 5 else frozenset([tuple(w)])


def brute(rows, t=0.7):
    s = [(o, shingles(x)) for o, x in rows if x and x.strip()]
    return {(min(a, b), max(a, b)) for i, (a, x) in enumerate(s) for b, y in s[i + 1 :] if len(x & y) / len(x | y) >= t}


def corpus(seed=1, n=60):
    r = random.Random(seed)
    rows, o = [], 0
    shared = [f"s{i}" for i in range(30)]
    for _ in range(n):
        words = [f"w{r.randrange(3000)}" for _ in range(r.choice([4, 5, 6, 20, 80, 200]))]
        if r.random() < 0.4:
            words = words + shared
        for _ in range(r.choice([1, 1, 2, 4])):
            copy = words.copy()
            for _ in range(r.choice([0, 1, 2, 5])):
                k = r.randrange(len(copy))
                copy[k : k + 1] = r.choice([[], ["new"], [copy[k], "extra"]])
            rows.append((o, " ".join(copy)))
            o += 3
    return rows + [(9000, None), (9001, ""), (9002, "   "), (9003, rows[0][1].upper()), (9004, "x " * 8000), (9005, "x " * 8000), (9006, "A b c"), (9007, "a  b c")]


def run(spark, rows):
    df = spark.createDataFrame([(o, t, "clash", 1) for o, t in rows], "ord bigint, text string, sig string, _k int").repartition(4)
    return NearDuplicates(df)


def test_all_pairs_and_groups(spark):
    rows = corpus()
    want = brute(rows)
    nd = run(spark, rows)
    got = [(r["ord_a"], r["ord_b"]) for r in nd.row_pairs().collect()]
    assert len(got) == len(set(got)) and set(got) == want
    label = {o: o for o, t in rows if t and t.strip()}
    for _ in label:
        for a, b in want:
            label[a] = label[b] = min(label[a], label[b])
    links = {o: sum(o in p for p in want) for o in label}
    assert {(r["ord"], r["group_id"], r["n_links"]) for r in nd.groups().collect()} == {(o, label[o], links[o]) for o in label}


def test_large_blocks_are_cut_without_loss(spark, monkeypatch):
    monkeypatch.setattr(neardup, "BLOCK", 4)
    base = [f"b{i}" for i in range(120)]
    rows = []
    for o in range(23):
        own = base.copy()
        own[o * 5] = f"x{o}"
        rows.append((o, " ".join(own)))
    assert {(r["ord_a"], r["ord_b"]) for r in run(spark, rows).row_pairs().collect()} == brute(rows)


def test_empty(spark):
    nd = run(spark, [(1, None), (2, "")])
    assert nd.row_pairs().count() == 0 and nd.groups().count() == 0


def test_tree_loses_no_pair():
    r = np.random.default_rng(0)
    sets = []
    for _ in range(120):
        s = np.unique(r.integers(0, 1 << 63, r.integers(1, 150)).astype(np.uint64))
        sets += [s, np.unique(np.concatenate([s[: int(len(s) * 0.9)], r.integers(0, 1 << 63, 2).astype(np.uint64)]))]
    v, n = np.stack([count_vector(s) for s in sets]), np.array([len(s) for s in sets])
    found = {tuple(sorted(p)) for p in tree_pairs(v, n, 0.7).tolist()}
    want = {(i, j) for i in range(len(sets)) for j in range(i + 1, len(sets)) if len(np.intersect1d(sets[i], sets[j])) >= 0.7 * len(np.union1d(sets[i], sets[j]))}
    assert want <= found


def test_components_of_a_chain(spark):
    e = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101)], "u bigint, v bigint")
    assert {(r["u"], r["label"]) for r in components(e).collect()} == {(i, 0) for i in range(41)} | {(100, 100), (101, 100)}


def forms():
    c = np.zeros((len(SYMBOLS), len(SYMBOLS)), dtype=np.int64)
    at = {ch: i for i, ch in enumerate(SYMBOLS)}
    for word, n in (("die", 900), ("area", 500), ("coop", 200), ("сор", 30), ("рост", 30)):
        for a, b in zip(word, word[1:]):
            if a in at and b in at:
                c[at[a], at[b]] += n
    return Forms(c.ravel())


def test_forms():
    f = forms()
    same = [("die Siedlung", "dіе Ѕіedlung"), ("co​op­", "cοор"), ("Ａ１： x", "A1:　x"), ("schön", "schön"), ("ﬁn", "fin"), ("a b", "a b"), ("K;", "K;"), ("well-known", "well‐known"), ("a\r\nb", "a\nb"), ("die", "dіе")]
    for a, b in same:
        assert f.text(a) == f.text(b), (a, b)
    other = [("m2", "m²"), ("1/2", "½"), ("TM", "™"), ("E", "e"), ("schon", "schön"), ("ss", "ß"), ("a-b", "a–b"), ("1", "①"), ("x1", "x₁"), ("ab", "a b"), ("л", "n"), ("👩‍🔧", "👩🔧"), ("a\nb", "a b")]
    for a, b in other:
        assert f.text(a) != f.text(b), (a, b)
    assert f.text("рост") == "рост" and f.text(None) is None and f.text("") == ""
    assert f.text("dіе") == "die" and compatible("x" * 10) == "x" * 10
    long = "о" * 30_000 + "б"
    assert f.text(long) == long and f.text("x" * 200_000) == "x" * 200_000


def test_pairs_and_classes(spark):
    rows = [(1, "die Siedlung"), (2, "dіе Siedlung"), (3, "die Siedlung"), (4, "die Siedlung"), (5, None), (6, ""), (7, " "), (8, " "), (9, "m2"), (10, "m²"), (11, "die Siedlung.")]
    rows += [(100 + i, "the same text again") for i in range(300)]
    df = spark.createDataFrame([(k, t, "clash") for k, t in rows], "doc_id bigint, text string, form_key string").repartition(3)
    got = sorted((r["doc_a"], r["doc_b"]) for r in look_alike_pairs(df).collect())
    assert got == [(1, 2), (1, 4), (2, 3), (2, 4), (3, 4)]
    classes = {r["doc_id"]: (r["class_id"], r["n_rows"], r["n_texts"]) for r in form_classes(df).collect()}
    assert classes[4] == (1, 4, 3) and classes[150] == (100, 300, 1) and 5 not in classes
    assert look_alike_pairs(df.limit(0)).count() == 0


def test_forms_of_all_ignorables_and_compatible_letters():
    f = forms()
    mapped = [(0xB5, chr(0x3BC)), (0x133, "ij"), (0x1C6, "d" + chr(0x17E)), (0x2163, "IV"), (0x2F00, chr(0x4E00))]
    for x, want in mapped:
        assert f.text(f"5 {chr(x)}m") == f.text(f"5 {want}m"), hex(x)
    for x in (0xAD, 0x34F, 0x115F, 0x1160, 0x17B4, 0x180B, 0x206A, 0x206F, 0x3164, 0xFFA0, 0x1D173, 0xE0000, 0xE0001, 0xE0041, 0xE007F, 0xE0100, 0xE01EF):
        assert f.text(f"di{chr(x)}e Area") == f.text("die Area"), hex(x)
    flag = chr(0x1F3F4)
    england, wales = (flag + "".join(chr(0xE0000 + ord(c)) for c in x) + chr(0xE007F) for x in ("gbeng", "gbwls"))
    for a, b in [(chr(0x17F), "s"), (chr(0x3D1), chr(0x3B8)), (chr(0x1D400), "A"), (chr(0x2116), "No"), (chr(0x2474), "(1)"), (england, wales), (england, flag)]:
        assert f.text(a) != f.text(b), (a, b)


def test_hot_shingles_are_spread_without_loss(spark, monkeypatch):
    """A third of the texts share most of their words; their shingles are hot, and chunks of several sizes meet."""
    monkeypatch.setattr(neardup, "BLOCK", 4)
    base = [f"b{i}" for i in range(120)]
    rows = [(o, " ".join([*base[: 90 + o], f"x{o}"])) for o in range(30)] + [(100 + o, f"w{o} " * 3 + " ".join(f"v{o * 50 + i}" for i in range(20))) for o in range(60)]
    nd = run(spark, rows)
    assert nd._hot(spark.createDataFrame([(1, 2 * i + 1, i % 3) for i in range(20)], "h bigint, s bigint, level int")).count() > 20
    assert {(r["ord_a"], r["ord_b"]) for r in nd.row_pairs().collect()} == brute(rows)


def test_components_that_do_not_settle_are_an_error(spark, monkeypatch):
    monkeypatch.setattr(neardup, "ROUNDS", 1)
    try:
        components(spark.createDataFrame([(i, i + 1) for i in range(40)], "u bigint, v bigint"))
        raise AssertionError
    except RuntimeError as e:
        assert "settled" in str(e)
