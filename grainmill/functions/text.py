"""Text functions as columns. They follow Python's string semantics, also where the JVM's differ."""

from __future__ import annotations

import re
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

#: White space as Python sees it: Unicode's, and the four separators U+001C to U+001F.
WS = r"[\s\x1c-\x1f]"
LINE_END = "\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85\u2028\u2029]"
#: Characters that NFKC may change or compose: a few of Latin-1, and all others but European letters, dashes, quotes and
#: the like. The tests compare the class with the form itself.
NFKC_SENSITIVE = "[\u00a0\u00a8\u00aa\u00af\u00b2-\u00b5\u00b8-\u00ba\u00bc-\u00be]|[^\\x00-\u0131\u0134-\u013e\u0141-\u0148\u014a-\u017e\u0391-\u03a1\u03a3-\u03a9\u03b1-\u03c9\u0400-\u045f\u2010\u2012-\u2016\u2018-\u2023\u2030-\u2032\u2039-\u203b\u20ac]"
DUMP_HOST = "https://dumps.wikimedia.org"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def py_strip(c: Column | str) -> Column:
    """Without outer white space of any kind (T12); linear also in long runs of blanks."""
    return F.regexp_replace(col(c), rf"(?U)^{WS}+|(?<!{WS}){WS}+\z", "")


def py_split(c: Column | str) -> Column:
    """Words between white space, none of them empty."""
    return F.filter(F.split(col(c), rf"(?U){WS}+", -1), lambda w: w != "")


def py_lines(c: Column | str) -> Column:
    """Lines at any line end; one ending terminator opens no further line; an empty text has none."""
    body = F.regexp_replace(col(c), rf"(?:{LINE_END})\z", "")
    return F.when(col(c) == "", F.array().cast("array<string>")).otherwise(F.split(body, LINE_END, -1))


def rfind(c: Column | str, needle: str) -> Column:
    """The last place of ``needle`` (a single character), from 0, or -1."""
    return F.when(F.instr(col(c), needle) > 0, F.length(col(c)) - F.locate(needle, F.reverse(col(c)))).otherwise(-1)


@F.pandas_udf(StringType())
def _nfkc(s: pd.Series) -> pd.Series:
    return s.map(lambda x: unicodedata.normalize("NFKC", x), na_action="ignore")


def nfkc(c: Column | str) -> Column:
    """Unicode form NFKC. Only texts with a character that it may change are sent to Python."""
    needs = col(c).rlike(NFKC_SENSITIVE)
    return F.coalesce(_nfkc(F.when(needs, col(c))), col(c))


def normalize(c: Column | str) -> Column:
    """NFKC, lower case, runs of white space as one blank, stripped."""
    return py_strip(F.regexp_replace(F.lower(nfkc(c)), rf"(?U){WS}+", " "))


def sha256(c: Column | str) -> Column:
    return F.sha2(col(c), 256)


def word_shingles(c: Column | str, k: int = 5) -> Column:
    """The distinct runs of ``k`` words; the whole text if it has ``k`` words or fewer."""

    def grams(words: Column) -> Column:
        return F.transform(F.sequence(F.lit(1), F.size(words) - (k - 1)), lambda i: F.array_join(F.slice(words, i, k), " "))

    # bound as a variable, so that the text is split once and not once per shingle
    return F.flatten(F.transform(F.array(py_split(c)), lambda w: F.when(F.size(w) <= k, F.array(col(c))).otherwise(F.array_distinct(grams(w)))))


def is_page_number(line: Column | str) -> Column:
    """A line of digits and the numerals i, v, x, l, c only."""
    return col(line).rlike(rf"(?U)^{WS}*[\divxlcIVXLC]+{WS}*\z")


def clean_pdf_text(c: Column | str) -> Column:
    """Blank lines and blanks squeezed, page number lines dropped, stripped (T3). Dropping comes last, so that three
    line ends may come up again."""
    x = F.regexp_replace(col(c), r"\n{3,}", "\n\n")
    x = F.regexp_replace(x, rf"(?U)[{WS}&&[^\n]]{{2,}}", " ")
    return py_strip(F.array_join(F.filter(py_lines(x), lambda line: ~is_page_number(line)), "\n"))


#: The marks that plain text loses, in the order in which they go (T4).
MARKDOWN_RULES = [
    (r"```[\s\S]*?```", ""),
    (r"~~~[\s\S]*?~~~", ""),
    (r"`[^`\n]+`", ""),
    (r"(?d)!\[.*?\]\(.*?\)", ""),
    (r"\[([^\]]+)\]\([^\)]+\)", "$1"),
    (r"<[^>]+>", ""),
    (rf"(?mdU)^#{{1,6}}{WS}+", ""),
    (rf"(?mdU)^[=]{{3,}}{WS}*$", ""),
    (rf"(?mdU)^[-]{{3,}}{WS}*$", ""),
    (r"(\*{1,3})((?:(?!\1)[\s\S])+?)\1", "$2"),
    (r"(_{1,3})((?:(?!\1)[\s\S])+?)\1", "$2"),
    (rf"(?mdU)^[*_]{{3,}}{WS}*$", ""),
    (rf"(?mdU)^>{WS}?", ""),
    (r"(?mdU)^\.\. \w[\w-]*::", ""),
    (r"\n{3,}", "\n\n"),
]


def markdown_to_text(c: Column | str) -> Column:
    x = col(c)
    for pattern, to in MARKDOWN_RULES:
        x = F.regexp_replace(x, pattern, to)
    return py_strip(x)


#: The marks of wiki pages that plain text loses; the first rule is repeated for nested templates and tables.
WIKI_NESTED = (r"(?s)\{\{(?:(?!\{\{|\}\}).)*+\}\}|\{\|(?:(?!\{\||\|\}).)*+\|\}", "")
WIKI_RULES = [
    (r"(?s)<!--.*?-->", ""),
    (r"(?is)<(ref|math|gallery|timeline|code|pre)\b[^>]*?/>", ""),
    (r"(?is)<(ref|math|gallery|timeline|code|pre)\b[^>]*>.*?</\1\s*>", ""),
    (r"(?i)\[\[(?:file|image|datei|bild|fichier|archivo|imagen|bestand|category|kategorie|catégorie|categoría|categorie):(?:[^\[\]]|\[\[[^\[\]]*\]\])*+\]\]", ""),
    (r"\[\[(?:[^\[\]|]*\|)?([^\[\]|]*)\]\]", "$1"),
    (r"\[(?:https?:)?//[^\s\]]+\s+([^\]]*)\]", "$1"),
    (r"\[(?:https?:)?//[^\s\]]+\]", ""),
    (r"'{2,5}", ""),
    (r"(?m)^(={1,6})[ \t]*(.+?)[ \t]*\1[ \t]*$", "$2"),
    (r"(?m)^[*#:;]+[ \t]*", ""),
    (r"__[A-Z]+__", ""),
    (r"<[^>]+>", ""),
    (r"&nbsp;", " "),
    (r"\n{3,}", "\n\n"),
]
WIKI_DEPTH = 6


def wiki_to_text(c: Column | str) -> Column:
    """A wiki page without markup (S5): templates and tables go, up to ``WIKI_DEPTH`` within one another, links keep their label."""
    x = col(c)
    for pattern, to in WIKI_RULES[:3]:
        x = F.regexp_replace(x, pattern, to)
    for _ in range(WIKI_DEPTH):
        x = F.regexp_replace(x, *WIKI_NESTED)
    for pattern, to in WIKI_RULES[3:]:
        x = F.regexp_replace(x, pattern, to)
    return py_strip(x)


def strip_tags(c: Column | str) -> Column:
    """Without tags; what stands between them stays (T4.6)."""
    return F.regexp_replace(col(c), r"<[^>]+>", "")


def universal_newlines(c: Column | str) -> Column:
    return F.regexp_replace(col(c), "\r\n?", "\n")


def first_paragraph(c: Column | str, least: int = 80) -> Column:
    """The first stripped paragraph of ``least`` characters or more, or null; paragraphs end at an empty line (T5)."""
    return F.get(F.filter(F.transform(F.split(col(c), "\n\n", -1), py_strip), lambda p: F.length(p) >= least), F.lit(0))


def truncate_at_sentence(c: Column | str, most: int) -> Column:
    """At most ``most`` characters, up to the last ``. ! ?`` if that lies in the second half."""
    cut = F.substring(col(c), 1, most)
    last = F.greatest(*(rfind(cut, mark) for mark in ".!?"))
    short = F.when(last > most // 2, F.substring(cut, F.lit(1), last + 1)).otherwise(cut)
    return F.when(F.length(col(c)) <= most, col(c)).otherwise(short)


def stem_to_title(c: Column | str) -> Column:
    return F.translate(col(c), "_-", "  ")


def file_stem(path: Column | str) -> Column:
    """The file name without its last suffix."""
    name = F.regexp_extract(col(path), r"([^/]*)\z", 1)
    return F.when(name.rlike(r"^.+\.[^.]+\z"), F.regexp_replace(name, r"\.[^.]*\z", "")).otherwise(name)


def excerpt(c: Column | str, n: int = 2000) -> Column:
    """The first ``n`` characters, stripped after the cut."""
    return py_strip(F.substring(col(c), 1, n))


def fill(template: Column, **values: Column) -> Column:
    """Names in braces replaced by values, literally."""
    for name, value in values.items():
        template = F.replace(template, F.lit("{" + name + "}"), value)
    return template


def check_lang(code: str) -> str:
    """A language code of two to five lower-case letters."""
    if not re.fullmatch(r"[a-z]{2,5}", code):
        raise ValueError(f"not a language code: {code!r}")
    return code


def dump_urls(code: str) -> dict[str, str]:
    """The places of a wiki's latest dump and of its checksum list."""
    wiki = f"{check_lang(code)}wiki"
    base = f"{DUMP_HOST}/{wiki}/latest/{wiki}-latest-"
    return {"filename": f"{wiki}-latest-pages-articles.xml.bz2", "dump": f"{base}pages-articles.xml.bz2", "checksums": f"{base}md5sums.txt"}


def hash_choice(n: Column | int, *parts: Column | str | int) -> Column:
    """A number from 0 to n - 1 that depends on ``parts`` only, alike in any engine with MD5."""
    key = F.concat_ws(":", *(p.cast("string") if isinstance(p, Column) else F.lit(str(p)) for p in parts))
    return F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("bigint") % n
