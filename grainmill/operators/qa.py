"""Question-answer rows from a language model."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from grainmill.functions.text import excerpt, fill, py_strip

#: The prompts, which end where the model is to go on.
PROMPT_DE = """\
Text: Der Eiffelturm ist ein aus Eisen erbauter Gitterturm auf dem Champ de Mars in Paris.
Er wurde zwischen 1887 und 1889 errichtet und ist 330 Meter hoch.

Q1: Wo steht der Eiffelturm?
A1: Der Eiffelturm steht auf dem Champ de Mars in Paris.
Q2: Wann wurde der Eiffelturm erbaut?
A2: Der Eiffelturm wurde zwischen 1887 und 1889 errichtet.
Q3: Wie hoch ist der Eiffelturm?
A3: Der Eiffelturm ist 330 Meter hoch.

Text: {text}

Q1:"""
PROMPT_EN = """\
Text: The Eiffel Tower is a wrought-iron lattice tower on the Champ de Mars in Paris, France.
It was built between 1887 and 1889 and stands 330 metres tall.

Q1: Where is the Eiffel Tower located?
A1: The Eiffel Tower is located on the Champ de Mars in Paris, France.
Q2: When was the Eiffel Tower built?
A2: The Eiffel Tower was built between 1887 and 1889.
Q3: How tall is the Eiffel Tower?
A3: The Eiffel Tower stands 330 metres tall.

Text: {text}

Q1:"""
#: Fixed value: a question and the answer with its number, up to the next question or the end.
PAIR = r"(?sidU)[FQ](\d+):[\s\x1c-\x1f]*(.+?)[\s\x1c-\x1f]*\n[AB]\1:[\s\x1c-\x1f]*(.+?)(?=\n[FQ]\d+:|\z)"


@dataclass(frozen=True)
class Sampling:
    """What a backend is asked for (Q3). The defaults are fixed values."""

    temperature: float = 0.7
    max_new_tokens: int = 768
    context: int = 4096
    stop: tuple[str, ...] = field(default=("</s>", "[INST]", "\n\nText:"))


def prompt(text: str = "text", lang: str = "lang") -> Column:
    """The German prompt for ``de``, else the English one, with the first 2,000 characters (Q1)."""
    template = F.when(F.col(lang) == "de", F.lit(PROMPT_DE)).otherwise(F.lit(PROMPT_EN))
    return fill(template, text=excerpt(text))


def generate(df: DataFrame, make: Callable[[Sampling], Callable[[list[str]], list[str]]], sampling: Sampling = Sampling(), batch: int = 64, column: str = "prompt") -> DataFrame:
    """The rows with ``raw``, the model's text (Q2). ``make`` builds a backend once per task; batches keep their rows."""

    def run(frames):
        backend = make(sampling)
        for pdf in frames:
            out: list[str] = []
            for a in range(0, len(pdf), batch):
                asked = pdf[column].iloc[a : a + batch].tolist()
                told = backend(asked)
                if len(told) != len(asked):
                    raise ValueError("the backend answered another number of prompts")
                out += told
            yield pdf.assign(raw=pd.Series(out, index=pdf.index, dtype="object"))

    return df.mapInPandas(run, StructType([*df.schema.fields, StructField("raw", StringType())]))


def parse(df: DataFrame, raw: str = "raw", source: str = "source", lang: str = "lang", keep: tuple[str, ...] = (), least: int = 10) -> DataFrame:
    """One Alpaca row per question and answer in ``raw``.

    ``raw`` goes on from ``Q1:``. All pairs with equal numbers are given whose stripped question and answer have
    ``least`` characters. A null ``raw`` gives no row. A narrow map; all in the JVM.
    """
    text = F.concat(F.lit("Q1:"), F.col(raw))
    pairs = F.arrays_zip(F.transform(F.regexp_extract_all(text, F.lit(PAIR), 2), py_strip).alias("q"), F.transform(F.regexp_extract_all(text, F.lit(PAIR), 3), py_strip).alias("a"))
    fit = F.filter(pairs, lambda p: (F.length(p["q"]) >= least) & (F.length(p["a"]) >= least))
    rows = df.select(*keep, F.col(source).alias("_s"), F.col(lang).alias("_l"), F.explode(fit).alias("_p"))
    return rows.select(*keep, F.col("_p.q").alias("instruction"), F.lit("").alias("input"), F.col("_p.a").alias("output"), F.coalesce("_s", F.lit("")).alias("source"), F.coalesce("_l", F.lit("")).alias("lang"))


def watched(prompts: DataFrame, name: str = "documents seen") -> tuple[DataFrame, Observation]:
    """The prompts, and a counter of those read that fills while an action runs and costs no pass of its own (Q5)."""
    seen = Observation(name)
    return prompts.observe(seen, F.count(F.lit(1)).alias("n")), seen


def progress(raw: DataFrame, pairs: DataFrame, source: str = "source") -> DataFrame:
    """``source, n_docs, n_pairs``: model answers read and rows made of them, in the end (Q5). A null source reads empty."""
    docs = raw.groupBy(F.coalesce(F.col(source), F.lit("")).alias("source")).agg(F.count("*").alias("n_docs"))
    made = pairs.groupBy(F.coalesce(F.col(source), F.lit("")).alias("source")).agg(F.count("*").alias("n_pairs"))
    return docs.join(made, "source", "left").select("source", "n_docs", F.coalesce("n_pairs", F.lit(0)).alias("n_pairs"))
