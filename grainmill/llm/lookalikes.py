"""One form for texts that look alike (problem 9)."""

from __future__ import annotations

import re
import unicodedata
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grainmill.runtime import join_salted, materialize

#: Letters of three scripts that share one shape; the scripts are Latin, Cyrillic and Greek.
CLASSES = ["aа", "cс", "dԁ", "eе", "hһ", "iі", "jјϳ", "lӏ", "oоο", "pр", "qԛ", "sѕ", "vѵν", "wԝ", "xх", "yу", "gɡ", "AАΑ", "BВΒ", "CС", "EЕΕ", "GԌ", "HНΗ", "IІӀΙ", "JЈ", "KКΚ", "MМΜ", "NΝ", "OОΟ", "PРΡ", "SЅ", "TТΤ", "XХΧ", "YΥ", "ZΖ", "ÄӒ", "ËЁ", "ÖӦ", "äӓ", "ëё", "ïї", "öӧ"]
#: Characters without a look (Unicode's Default_Ignorable_Code_Point without the joiners), flags made of
#: such characters, blanks of another kind, hyphens of the same length.
IGNORABLE = re.compile("[\u00ad\u034f\u061c\u115f-\u1160\u17b4-\u17b5\u180b-\u180f\u200b\u200e-\u200f\u202a-\u202e\u2060-\u206f\u3164\ufe00-\ufe0f\ufeff\uffa0\ufff0-\ufff8\U0001bca0-\U0001bca3\U0001d173-\U0001d17a\U000e0000-\U000e0fff]")
FLAG = re.compile(f"(\U0001f3f4[\U000e0020-\U000e007e]+\U000e007f)|{IGNORABLE.pattern}")
JOINERS = re.compile("[\u200c\u200d]")
JOINED = re.compile("[\u0600-\u08ff\u0900-\u0df6\u2190-\u2bff\ufe0f\U0001f000-\U0001faff]\\Z")
BLANKS = re.compile("[\u00a0\u1680\u2000-\u200a\u202f\u205f\u3000]")
HYPHENS = re.compile("[\u2010\u2011]")
#: Characters whose compatibility mapping keeps the look: micro sign, digraphs, Thai and Lao am, a Tibetan
#: mark, the one-dot leader, Hebrew letters as signs, Roman figures, radicals, ligatures, wide and narrow letters. Left out
#: are raised, lowered, circled, bracketed, squared, small and upright forms, fractions, mathematical type, signs of
#: several letters, rows of dots and primes, spacing accents, long s, Greek letters in another shape, and Arabic forms
#: of one place in a word and single Hangul letters, which look otherwise when they are joined.
COMPATIBLE = re.compile("[\u00b5\u0132-\u0133\u013f-\u0140\u0149\u01c4-\u01cc\u01f1-\u01f3\u0e33\u0eb3\u0f0c\u2024\u2135-\u2138\u2160-\u217f\u2e9f\u2ef3\u2f00-\u2fd5\uff01-\uffee\ufb00-\ufb06]+")

SCRIPT = {ch: ("Latin" if i == 0 or ch == "ɡ" else unicodedata.name(ch).split()[0].title()) for c in CLASSES for i, ch in enumerate(c)}
CLASS_OF = {ch: c for c in CLASSES for ch in c}
SYMBOLS = sorted(CLASS_OF)
INDEX = {ch: i for i, ch in enumerate(SYMBOLS)}
SCRIPTS = ("Latin", "Cyrillic", "Greek")
#: What a change of script inside a token costs, in nats; far above the bigram scores of any token.
SWITCH = 1e9

_foreign = "".join(ch for c in CLASSES for ch in c[1:])
_latin = "".join(c[0] for c in CLASSES)
#: A token needs the search only if it holds a foreign look-alike or consists of ambiguous letters alone.
TOKEN = re.compile(rf"(?<![^\W\d_])[^\W\d_]*[{_foreign}][^\W\d_]*|(?<![^\W\d_])[{_latin}]+(?![^\W\d_])")


@lru_cache(maxsize=4096)
def _script(ch: str) -> str:
    if ch in SCRIPT:
        return SCRIPT[ch]
    return unicodedata.name(ch, "OTHER").split()[0].title()


def compatible(text: str) -> str:
    """The text without ignorable characters, with one kind of blank, hyphen and letter width, composed.

    Joiners stay between characters whose look they change (Arabic and Indic letters, emoji). Raised and lowered
    figures, fractions, signs and circled figures keep their own characters, as they look different.
    """
    if text.isascii():
        return text.replace("\r\n", "\n")
    text = FLAG.sub(r"\1", text) if "\U000e007f" in text else IGNORABLE.sub("", text)
    if JOINERS.search(text):
        text = JOINERS.sub(lambda m: m.group() if JOINED.search(text[: m.start()][-1:]) else "", text)
    text = BLANKS.sub(" ", text.replace("\r\n", "\n"))
    text = COMPATIBLE.sub(lambda m: unicodedata.normalize("NFKC", m.group()), text)
    return unicodedata.normalize("NFC", HYPHENS.sub("-", text))


class Forms:
    """The Viterbi search over look-alike lattices, under bigram counts of the look-alike letters."""

    def __init__(self, counts: np.ndarray):
        n = len(SYMBOLS)
        script = np.array([SCRIPTS.index(SCRIPT[ch]) for ch in SYMBOLS])
        same = script[:, None] == script[None, :]
        c = np.where(same, counts.reshape(n, n), 0).astype(np.float64)
        row = c.sum(1)
        # smoothed over all letters alike, so that a script with few of them gains nothing from what is never seen
        self.step = np.where(same, np.log((c + 0.5) / (row[:, None] + 0.5 * n)), -SWITCH)
        self.first = np.log((row + 0.5) / (row.sum() + 0.5 * n))  # the script's share of all letters counts here
        self.cache: dict[str, str] = {}

    def __getstate__(self):
        return {"step": self.step, "first": self.first}

    def __setstate__(self, state):
        self.__dict__.update(state, cache={})

    def token(self, token: str) -> str:
        known = self.cache.get(token)
        if known is None:
            if len(self.cache) > 200_000:
                self.cache.clear()
            known = self.cache[token] = self._search(token)
        return known

    def _search(self, token: str) -> str:
        """The best path. It depends on the classes of the token's characters only, so look-alikes get one form.

        A character outside the classes has one state, whose script holds for its neighbours.
        """
        paths: list[tuple[float, str, int]] = []  # score, script, symbol or -1
        steps: list[tuple[str, list[int]]] = []  # the options of each place and where each comes from
        for ch in token:
            options = CLASS_OF.get(ch, ch)
            new, back = [], []
            for o in options:
                k, s = INDEX.get(o, -1), _script(o)
                if not paths:
                    new.append((self.first[k] if k >= 0 else 0.0, s, k))
                    back.append(0)
                    continue
                best, at = None, 0
                for i, (score, ps, pk) in enumerate(paths):
                    if s != ps:
                        score -= SWITCH
                    elif k >= 0 and pk >= 0:
                        score += self.step[pk, k]
                    elif k >= 0:
                        score += self.first[k]
                    if best is None or score > best:
                        best, at = score, i
                new.append((best, s, k))
                back.append(at)
            paths = new
            steps.append((options, back))
        at = max(range(len(paths)), key=lambda i: (paths[i][0], paths[i][1] == "Latin"))
        out = []
        for options, back in reversed(steps):
            out.append(options[at])
            at = back[at]
        return "".join(reversed(out))

    def text(self, text: str | None) -> str | None:
        if text is None:
            return None
        return TOKEN.sub(lambda m: self.token(m.group()), compatible(text))


def _letters(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "replace"), dtype=np.uint32)


def bigram_counts(df: DataFrame, text: str = "text") -> np.ndarray:
    """Counts of neighbouring look-alike letters of one script over all texts.

    A task sends one row; a row holds as many numbers as there are pairs of the fixed letters, whatever the data's size.
    """
    n = len(SYMBOLS)

    def count(batches):
        code = np.full(0x110000, n, dtype=np.int32)
        for ch, i in INDEX.items():
            code[ord(ch)] = i
        total = np.zeros((n + 1) * (n + 1), dtype=np.int64)
        for batch in batches:
            joined = "\n".join(compatible(t) for t in batch.column(0).to_pylist() if t)
            if joined:
                x = code[_letters(joined)]
                total += np.bincount(x[:-1] * (n + 1) + x[1:], minlength=(n + 1) * (n + 1))
        total = total.reshape(n + 1, n + 1)[:n, :n].ravel()
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], names=["pair", "n"])

    rows = df.select(F.col(text).cast("string")).mapInArrow(count, "pair int, n bigint").groupBy("pair").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(n * n, dtype=np.int64)
    for r in rows:
        out[r["pair"]] = r["n"]
    return out


def _digest(text: str) -> bytes:
    return xxhash.xxh3_128_digest(text.encode("utf-8", "replace"))


def normal_forms(df: DataFrame, key: str = "doc_id", text: str = "text", with_text: bool = True) -> DataFrame:
    """``key, form, form_key, text_key``: each text in its consistent form, and 128-bit keys of form and text.

    Two passes over the texts without a shuffle of them: letter statistics, then the search. Null texts give null in all
    columns; empty and blank texts are forms of their own. With ``with_text=False`` the form itself is left out.
    """
    shared = df.sparkSession.sparkContext.broadcast(Forms(bigram_counts(df, text)))
    schema = df.select(key).schema.add("form", "string").add("form_key", "binary").add("text_key", "binary")

    def forms(batches):
        f = shared.value
        for batch in batches:
            texts = batch.column(1).to_pylist()
            out = [f.text(t) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(out if with_text else [None] * len(out), pa.string()), pa.array([None if t is None else _digest(t) for t in out], pa.binary()), pa.array([None if t is None else _digest(t) for t in texts], pa.binary())],
                names=schema.names,
            )

    return df.select(F.col(key), F.col(text).cast("string")).mapInArrow(forms, schema)


def look_alike_pairs(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_a, doc_b``, ``doc_a < doc_b``: all pairs of rows with equal form and different text.

    Forms with a single text (any number of equal rows) are dropped by a pre-aggregated minimum and maximum before any
    join; the pairs are made between different texts and only then between their rows, so a group of equal rows costs
    nothing beyond its output. ``form_classes`` says the same in one row per text. Null and blank texts are no case; rows with null keys make no pair.
    """
    df = df.filter(~F.col(text).rlike(r"(?U)\A[\s\x1c-\x1f]*\z")).filter(F.col(key).isNotNull())
    rows = normal_forms(df, key, text, with_text=False).select(F.col(key).alias("_k"), "form_key", "text_key")
    rows = materialize(rows)  # a few bytes per text; read three times
    mixed = rows.groupBy("form_key").agg(F.min("text_key").alias("lo"), F.max("text_key").alias("hi")).filter("lo < hi").select("form_key")
    rows = rows.join(mixed, "form_key", "left_semi")
    texts = rows.select("form_key", "text_key").distinct()
    a = texts.select("form_key", F.col("text_key").alias("text_a"))
    b = texts.select("form_key", F.col("text_key").alias("text_b"))
    pairs = a.join(b, "form_key").filter("text_a < text_b").select("text_a", "text_b")
    # rows of one text are dealt to several tasks, to which what they meet is copied
    out = join_salted(rows.select(F.col("text_key").alias("text_a"), F.col("_k").alias("ka")), pairs, "text_a", "ka")
    out = join_salted(out, rows.select(F.col("text_key").alias("text_b"), F.col("_k").alias("kb")), "text_b", "ka")
    return out.select(F.least("ka", "kb").alias("doc_a"), F.greatest("ka", "kb").alias("doc_b"))


def form_classes(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, class_id, n_rows, n_texts``: one row per text; the class is the least key of the rows with its form."""
    rows = normal_forms(df.filter(F.col(text).isNotNull()), key, text, with_text=False)
    texts = rows.groupBy("form_key", "text_key").agg(F.min(key).alias("first"), F.count("*").alias("n"))
    classes = texts.groupBy("form_key").agg(F.min("first").alias("class_id"), F.sum("n").alias("n_rows"), F.count("*").alias("n_texts"))
    return join_salted(rows, classes, "form_key", key).select(key, "class_id", "n_rows", "n_texts")
