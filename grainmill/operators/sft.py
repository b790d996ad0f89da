"""Instruction rows from templates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from grainmill.functions.text import fill, first_paragraph, hash_choice, py_split, py_strip, truncate_at_sentence

#: The instructions.
SUMMARIZE = [
    "Fasse den folgenden Text in wenigen Sätzen zusammen.",
    "Schreibe eine kurze Zusammenfassung des folgenden Abschnitts.",
    "Was sind die wichtigsten Punkte des folgenden Textes?",
    "Summarize the following passage in a few sentences.",
    "Provide a concise summary of the text below.",
]
TITLE_QA = [
    "Was ist {title}?",
    "Erkläre kurz, worum es sich bei {title} handelt.",
    "Gib einen Überblick über {title}.",
    "What is {title}?",
    "Give a brief overview of {title}.",
    "Describe {title} in a few sentences.",
]
CONTINUE = [
    "Vervollständige den folgenden Text sinnvoll.",
    "Schreibe den folgenden Abschnitt weiter.",
    "Continue the following passage coherently.",
    "Complete the following text:",
]
ALPACA = ["instruction", "input", "output", "source", "lang"]
KINDS = ["summary", "title", "continue"]


def _pick(templates: list[str], order: str, salt: str, seed: int) -> Column:
    at = hash_choice(len(templates), seed, F.col(order), salt)
    return F.element_at(F.array(*map(F.lit, templates)), (at + 1).cast("int"))


def _record(instruction: Column, given: Column, output: Column) -> Column:
    """A row in the Alpaca layout; a missing source or language is an empty string."""
    return F.struct(instruction.alias("instruction"), given.alias("input"), output.alias("output"), F.coalesce("source", F.lit("")).alias("source"), F.coalesce("lang", F.lit("")).alias("lang"))


def summary(order: str = "ord", seed: int = 42) -> Column:
    """Summarise: the first paragraph of a text that goes on for more than 100 characters (G1), else null."""
    body, short = truncate_at_sentence("text", 4000), first_paragraph("text")
    return F.when(F.length(body) > F.length(short) + 100, _record(_pick(SUMMARIZE, order, "summary", seed), body, short))


def title_qa(order: str = "ord", seed: int = 42) -> Column:
    """Ask for the title: a stripped title of 3 characters or more, and a first paragraph (G2), else null."""
    title, answer = py_strip("title"), truncate_at_sentence(first_paragraph("text"), 1000)
    return F.when((F.length(title) >= 3) & answer.isNotNull(), _record(fill(_pick(TITLE_QA, order, "title", seed), title=title), F.lit(""), answer))


def continuation(order: str = "ord", seed: int = 42) -> Column:
    """Go on: a fifth to a third of at least 120 words, then up to 150 more (G3), else null."""
    words = py_split("text")
    n = F.size(words)
    low, high = F.floor(n / 5), F.floor(n / 3)
    split = (low + hash_choice(high - low + 1, seed, F.col(order), "split")).cast("int")
    record = _record(_pick(CONTINUE, order, "continue", seed), F.array_join(F.slice(words, F.lit(1), split), " "), F.array_join(F.slice(words, split + 1, F.lit(150)), " "))
    return F.when(n >= 120, record)


GENERATORS = {"summary": summary, "title": title_qa, "continue": continuation}


def one_kind(df: DataFrame, kind: str, order: str = "ord", seed: int = 42) -> DataFrame:
    """``order`` and the row of one generator; documents that it cannot use give none."""
    made = df.withColumn("_x", GENERATORS[kind](order, seed)).filter("_x is not null")
    return made.select(order, *(F.col(f"_x.{c}").alias(c) for c in ALPACA))


def examples(df: DataFrame, per_doc: int = 1, order: str = "ord", seed: int = 42) -> DataFrame:
    """``order, kind`` and the rows of ``per_doc`` generators of each document, chosen by a hash of its order.

    Choices depend on the document alone, not on those before it. A generator that gives nothing is not replaced. A
    narrow projection without a shuffle; a text that no chosen generator uses is not worked on.
    """
    rank = F.array_sort(F.array(*(F.struct(hash_choice(1 << 32, seed, F.col(order), f"rank{i}").alias("h"), F.lit(k).alias("k")) for i, k in enumerate(KINDS))))
    chosen = df.withColumn("kind", F.explode(F.slice(F.transform(rank, lambda x: x["k"]), 1, min(per_doc, 3))))
    made = chosen.withColumn("_x", F.coalesce(*(F.when(F.col("kind") == k, GENERATORS[k](order, seed)) for k in KINDS))).filter("_x is not null")
    return made.select(order, "kind", *(F.col(f"_x.{c}").alias(c) for c in ALPACA))
