"""Filters, limits and records."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grainmill.functions.text import py_strip

#: The sources of the corpus, as their labels read in lower case and without outer blanks.
SOURCES = ("wikipedia", "pdf", "markdown")


def min_length(df: DataFrame, least: int, text: str = "text", store_stripped: bool = False) -> DataFrame:
    """Rows whose stripped text has ``least`` characters (F1 to F4). Null texts are too short.

    ``store_stripped`` keeps the stripped text (F1); otherwise the row stays as it came (F4).
    """
    out = df.filter(F.length(py_strip(text)) >= least)
    return out.withColumn(text, py_strip(text)) if store_stripped else out


def min_chars(df: DataFrame, least: int = 300, text: str = "text") -> DataFrame:
    """Rows whose text, unstripped, has ``least`` characters."""
    return df.filter(F.length(text) >= least)


def not_blank(df: DataFrame, text: str = "text") -> DataFrame:
    """Rows with something besides white space."""
    return df.filter(py_strip(text) != "")


def of_source(df: DataFrame, name: str | None, source: str = "source", exact: bool = False) -> DataFrame:
    """Rows of one of ``SOURCES``, however its label is spelled, unless ``exact``; with None those whose label is missing or names
    no source."""
    label = F.col(source) if exact else F.lower(py_strip(source))
    return df.filter(label == name if name else ~F.coalesce(label.isin(*SOURCES), F.lit(False)))


def first_rows(df: DataFrame, n: int, order: str = "ord") -> DataFrame:
    """The first ``n`` rows in order (L1, L2); 0 means all, a negative number none. A top-n per task, then one merge."""
    if n == 0:
        return df
    return df.orderBy(order).limit(max(n, 0))


def pairs_per_doc(x: int) -> int:
    return max(1, min(5, x))


def samples_per_doc(x: int) -> int:
    return min(x, 3)


def with_errors(df: DataFrame, value: str, error: str = "error") -> tuple[DataFrame, DataFrame]:
    """Rows that were read, and rows that were skipped with their errors (F8)."""
    return df.filter(F.col(error).isNull()).drop(error), df.filter(F.col(error).isNotNull())
