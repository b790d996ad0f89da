"""One spelling for dirty labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Spellings of the languages' labels, in lower case.
LANG_NAMES = {
    "de": ["de", "deu", "ger", "german", "deutsch"],
    "en": ["en", "eng", "english", "englisch"],
    "es": ["es", "spa", "spanish", "español", "espanol"],
    "fr": ["fr", "fra", "fre", "french", "français", "francais"],
    "nl": ["nl", "nld", "dut", "dutch", "nederlands"],
}
#: Labels that say nothing.
PLACEHOLDERS = ["", "none", "null", "nan", "n/a", "na", "und", "unk", "unknown", "??", "?", "-", "xx", "mul"]
EDGE = r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+\z"


def clean_label(c: Column | str, missing: str = "unknown") -> Column:
    """Lower case, without outer blanks; placeholders become ``missing``."""
    c = F.col(c) if isinstance(c, str) else c
    x = F.lower(F.regexp_replace(c, EDGE, ""))
    return F.when(x.isNull() | x.isin(PLACEHOLDERS), missing).otherwise(x)


def clean_lang(c: Column | str, missing: str = "und") -> Column:
    """A two-letter code; placeholders become ``missing``, other labels their part before the region."""
    c = F.col(c) if isinstance(c, str) else c
    x = F.lower(F.regexp_replace(c, EDGE, ""))
    base = F.regexp_extract(x, r"^([^-_]*)", 1)
    out = F.when(x.isNull() | x.isin(PLACEHOLDERS), missing)
    for code, names in LANG_NAMES.items():
        out = out.when(x.isin(names) | base.isin(names), code)
    return out.otherwise(base)
