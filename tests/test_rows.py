"""Packing, instruction rows, prompts, unions."""

import json
import re

import pytest
from pyspark.sql import functions as F

from grainmill.operators import filters, pack, qa, sft, split

EOS, PAD = 9, 7


def packed(docs, L, pad):
    stream = [x for _, ids in sorted(docs) for x in [*ids, EOS]]
    out = [(stream[i : i + L], L) for i in range(0, len(stream), L)]
    if out and len(out[-1][0]) < L:
        tail = out.pop()[0]
        if len(tail) > L // 2:
            out.append((tail + [pad] * (L - len(tail)), len(tail)))
    return [(i, x, [1] * n + [0] * (L - n)) for i, (x, n) in enumerate(out)]


@pytest.mark.parametrize("sizes", [[3, 0, 5, 30, 1], [4], [3], [7, 7], [0, 0, 0], list(range(40)), []])
def test_pack(spark, sizes):
    docs = [(i * 3, [100 * i + j for j in range(n)]) for i, n in enumerate(sizes)]
    df = spark.createDataFrame(docs, "ord bigint, ids array<int>").repartition(3)
    got = [(r["chunk"], r["input_ids"], r["attention_mask"]) for r in pack.pack(df, 8, eos=EOS, pad=PAD).orderBy("chunk").collect()]
    assert got == packed(docs, 8, PAD)
    assert all(r["labels"] == r["input_ids"] for r in pack.pack(df, 8, eos=EOS).collect())


def test_pack_needs_an_end_id(spark):
    with pytest.raises(ValueError):
        pack.pack(spark.createDataFrame([], "ord bigint, ids array<int>"), 8, eos=None)


def test_tokenize(spark):
    df = spark.createDataFrame([(1, "ab"), (2, None)], "ord int, text string")
    rows = df.select("ord", pack.tokenize("text", lambda: lambda texts: [list(map(ord, t)) for t in texts]).alias("ids")).orderBy("ord").collect()
    assert [r["ids"] for r in rows] == [[97, 98], []]


def test_templates(spark):
    para, more = "p" * 80, "q" * 101
    words = " ".join(f"w{i}" for i in range(400))
    rows = [(1, "abc", para + "\n\n" + more, None, None), (2, "ab", para, "s", "de"), (3, " x{x}$1 ", para, "s", "de"), (4, None, words, "s", None), (5, "abc", " ".join(["w"] * 119), "s", "de"), (6, "abc", " ".join(["w"] * 120), "s", "de"), (7, "abc", None, "s", "de"), (8, "abc", para + "\n\n" + "q" * 98, "s", "de"), (9, "abc", para + "\n\n" + "q" * 99, "s", "de")]
    df = spark.createDataFrame(rows, "ord bigint, title string, text string, source string, lang string")
    s = {r["ord"]: r for r in sft.one_kind(df, "summary").collect()}
    assert set(s) == {1, 9} and s[1]["source"] == "" and s[1]["lang"] == "" and s[1]["output"] == para
    t = {r["ord"]: r for r in sft.one_kind(df, "title").collect()}
    assert 2 not in t and "x{x}$1" in t[3]["instruction"] and 7 not in t
    c = {r["ord"]: r for r in sft.one_kind(df, "continue").collect()}
    assert set(c) == {4, 6}
    n = len(c[4]["input"].split())
    assert 80 <= n <= 133 and c[4]["output"].split() == [f"w{i}" for i in range(n, n + 150)]
    a = sft.examples(df, 3).select("ord", "kind", "instruction").collect()
    b = sft.examples(df.repartition(5), 3).select("ord", "kind", "instruction").collect()
    assert sorted(a) == sorted(b) and {r["ord"] for r in a if r["kind"] == "summary"} == {1, 9}
    assert sft.examples(df.limit(0)).count() == 0


#: Fixed value: the pattern of a pair in Python's syntax.
PAIR = re.compile(r"[FQ](\d+):\s*(.+?)\s*\n[AB]\1:\s*(.+?)(?=\n[FQ]\d+:|\Z)", re.DOTALL | re.IGNORECASE)


def test_parse(spark):
    raws = [" Where is it located?\nA1: On the field.\nQ2: short\nA2: x", " Who was it then?\nA1: Somebody else.\nQ2: What is this thing?\nA3: Not this one at all.", " a question here?\nb1: an answer here\nover lines\nq3: another question?\nA3: another answer \n", "", None, "x" * 50_000 + "\nA1: a long answer"]
    df = spark.createDataFrame([(i, r, None, "de", "clash") for i, r in enumerate(raws)], "i int, raw string, source string, lang string, instruction string")
    want = sorted((i, m.group(2).strip(), m.group(3).strip()) for i, r in enumerate(raws) if r is not None for m in PAIR.finditer("Q1:" + r) if len(m.group(2).strip()) >= 10 and len(m.group(3).strip()) >= 10)
    got = qa.parse(df, keep=("i",)).collect()
    assert sorted((r["i"], r["instruction"], r["output"]) for r in got) == want
    assert all(r["source"] == "" and r["input"] == "" for r in got)


def test_prompts_and_backend(spark):
    df = spark.createDataFrame([(1, "x" * 1999 + " y", "de"), (2, "t {text} $1", "fr"), (3, "t", None)], "ord int, text string, lang string").withColumn("prompt", qa.prompt())
    p = {r["ord"]: r["prompt"] for r in df.collect()}
    assert p[1].startswith("Text: Der Eiffelturm") and ("x" * 1999 + "\n\nQ1:") in p[1]
    assert p[2].startswith("Text: The Eiffel") and "t {text} $1" in p[2] and p[3].endswith("Q1:")
    out = qa.generate(df, lambda s: lambda prompts: [f"{s.temperature} {len(x)}" for x in prompts], batch=2).collect()
    assert all(r["raw"] == f"0.7 {len(r['prompt'])}" for r in out)


def test_limits(spark):
    df = spark.createDataFrame([(5, "a"), (1, "bb" * 200), (3, "cc" * 200)], "ord bigint, text string")
    assert [r["ord"] for r in filters.first_rows(df, 2).collect()] == [1, 3]
    assert filters.first_rows(df, 0).count() == 3 and filters.first_rows(df, -1).count() == 0
    assert sorted(r["ord"] for r in filters.min_chars(df).collect()) == [1, 3]
    assert (filters.pairs_per_doc(9), filters.pairs_per_doc(0), filters.samples_per_doc(7)) == (5, 1, 3)


def test_unions_and_splits(spark):
    a = spark.createDataFrame([("1", "de")], "id string, lang string")
    b = spark.createDataFrame([("2", "f")], "id string, file string")
    rows = [r.asDict() for r in split.union_sources([a, b]).orderBy("source_rank").collect()]
    assert rows[0]["file"] is None and rows[1]["lang"] is None and [r["source_rank"] for r in rows] == [0, 1]
    df = spark.range(20_000)
    h = split.holdout(df, 0.01, "id")
    n = h.filter("split = 'validation'").count()
    assert 120 < n < 290 and h.repartition(7).filter("split = 'validation'").count() == n
    paths = spark.createDataFrame([("a.b/x",), ("a/y",), ("a/b/z",)], "file string")
    assert [r["file"] for r in paths.orderBy(split.path_parts("file")).collect()] == ["a/b/z", "a/y", "a.b/x"]
    c = spark.createDataFrame([("o/checkpoint-900",), ("o/checkpoint-2400",), ("o/other",)], "path string")
    assert split.latest_checkpoint(c).first()["path"] == "o/checkpoint-2400"
    assert json.loads(df.limit(1).select(F.to_json(F.struct("id")).alias("j")).first()["j"]) == {"id": 0}


def test_every_spelling_of_a_source(spark, tmp_path):
    from grainmill.plans import queries

    labels = ["wikipedia", "WIKIPEDIA", "Wikipedia ", " wikipedia ", "pdf", "PDF", "pdf ", "markdown", "Markdown", "MARKDOWN\n", None, "", "web"]
    rows = [(i, f"i{i}", "t", f"u{i}", "x" * 200, s, "de", f"a/f{i}.md") for i, s in enumerate(labels)]
    df = spark.createDataFrame(rows, "ord bigint, id string, title string, url string, text string, source string, lang string, file string")
    df.write.parquet(f"{tmp_path}/corpus.parquet")
    d = str(tmp_path)
    assert sorted(r["ord"] for r in queries.wiki_min_length(spark, d).collect()) == [0, 1, 2, 3]
    assert sorted((r["ord"], r["source"]) for r in queries.markdown_records(spark, d).collect()) == [(i, "markdown") for i in (7, 8, 9)]
    got = {r["source_rank"]: tuple(r)[1:] for r in queries.union_sources(spark, d).collect()}
    assert got == {0: (4, 4, 0, 0), 1: (3, 0, 3, 4), 2: (3, 0, 3, 7), 3: (3, 3, 3, 10)}


def labelled(spark, d):
    labels = ["wikipedia", "WIKIPEDIA", "wikipedia ", "pdf", "PDF", "markdown", "Markdown", None, "web"]
    rows = [(i, f"i{i}", "t", f"u{i}", "x" * 200, s, "de", f"a/f{i}.md") for i, s in enumerate(labels)]
    spark.createDataFrame(rows, "ord bigint, id string, title string, url string, text string, source string, lang string, file string").write.parquet(f"{d}/corpus.parquet")


def test_the_query_of_wiki_min_length_agrees_with_its_sql(spark, tmp_path):
    from grainmill.plans import queries

    labelled(spark, tmp_path)
    assert [r["ord"] for r in queries.queries()["wiki_min_length"](spark, str(tmp_path)).collect()] == [0]


def test_the_query_of_markdown_records_agrees_with_its_sql(spark, tmp_path):
    from grainmill.plans import queries

    labelled(spark, tmp_path)
    assert [r["ord"] for r in queries.queries()["markdown_records"](spark, str(tmp_path)).collect()] == [5]


def test_the_query_of_union_sources_agrees_with_its_sql(spark, tmp_path):
    from grainmill.plans import queries

    labelled(spark, tmp_path)
    got = {r["source_rank"]: tuple(r)[1:] for r in queries.queries()["union_sources"](spark, str(tmp_path)).collect()}
    assert got == {0: (1, 1, 0, 0), 1: (1, 0, 1, 3), 2: (1, 0, 1, 5)}
