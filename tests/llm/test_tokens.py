"""Token ids and budgets against public libraries."""

import os
import random

import pytest

from grainmill.llm import bpe
from grainmill.llm.tokens import encode_documents, token_budget, token_count

pytestmark = pytest.mark.skipif(not os.path.isdir(bpe.TOKENIZER_DIR), reason="no vocabularies")
TEXTS = ["", None, " ", "Straße 12345  \n\n x", "ﷺ 日本語 👩‍🔧 �", "don't we'll  'S", "a" * 70_000, "\x00\x1f\x85\r\n", "<|endoftext|>", "wörterbuch" * 50, "  lead", "trail  ", "Maeenilm 8402 Hektar."]


def reference(name="byte_bpe_50k"):
    import tiktoken

    return tiktoken.Encoding("own", pat_str=bpe.PRETOKEN_PATTERN, mergeable_ranks=bpe.read_ranks(name), special_tokens={})


def test_same_ids_as_the_library(spark):
    df = spark.createDataFrame([(i, t, "clash") for i, t in enumerate(TEXTS)] + [(0, "", "again")], "doc_id bigint, text string, ids string").repartition(3)
    enc = reference()
    got = {(r["doc_id"], tuple(r["ids"])) for r in encode_documents(df).collect()}
    assert got == {(i, tuple(enc.encode_ordinary(t)) if t else ()) for i, t in enumerate(TEXTS)}
    assert encode_documents(df).count() == len(TEXTS) + 1
    assert encode_documents(df.limit(0)).count() == 0


def test_perfect_hash_is_minimal_and_exact():
    enc = bpe.encoder()
    keys = list(enc.ranks)
    assert len(enc.hash.keys) == len(keys) and sorted(enc.hash.keys) == sorted(keys)
    assert enc.hash.find(keys) == list(enc.ranks.values())
    assert enc.hash.find([b"\xff\xfe\xfd", b""]) == [-1, -1]


def test_merges_agree_on_random_bytes():
    enc, r = reference(), random.Random(3)
    ranks = bpe.encoder().ranks
    for _ in range(300):
        word = "".join(r.choice("abestnrließüµ東 ") for _ in range(r.randrange(1, 40))).strip() or "a"
        piece = bpe.regex.findall(bpe.PRETOKEN_PATTERN, word)
        assert [i for p in piece for i in bpe.merge(p.encode(), ranks)] == enc.encode_ordinary(word)


def test_counts_and_roll_up_agree(spark):
    rows = [(i, t, s, lg, "technik") for i, (t, s, lg) in enumerate([("ein Haus", "Wikipedia", "de"), ("ein Haus", " wikipedia ", "DE"), (None, "WIKIPEDIA", "deu"), ("", None, "None"), ("two houses", "pdf", "en_GB"), ("x " * 5000, "pdf", "??")])]
    df = spark.createDataFrame(rows, "ord bigint, text string, source string, lang string, topic string")
    n = {r["ord"]: r["n"] for r in df.select("ord", token_count(df["text"], spark).alias("n")).collect()}
    enc = reference()
    assert n == {o: len(enc.encode_ordinary(t)) if t else 0 for o, t, *_ in rows}
    got = {(r["level"], r["source"], r["lang"]): (r["n_docs"], r["n_tokens"]) for r in token_budget(df).collect()}
    assert got[("source+lang+topic", "wikipedia", "de")] == (3, n[0] + n[1])
    assert got[("source", "unknown", None)] == (1, 0)
    assert got[("lang", None, "und")] == (2, n[5])
    assert got[("lang", None, "en")] == (1, n[4])
    assert got[("total", None, None)] == (6, sum(n.values()))
    assert token_budget(df.limit(0)).count() == 0
