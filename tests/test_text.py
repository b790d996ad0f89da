"""Text functions against Python's own."""

import re
import unicodedata

from pyspark.sql import functions as F

from grainmill.functions import text as T

ODD = ["", " ", "\n\t x \n", " a　", "\x1c\x1fb\x85", "a  b c", None, "İSTANBUL ΟΔΟΣ ẞ", "ﬁ① Ｆ é", "x" * 60_000, "a\r\nb\rc\x0bd\n"]


def same(one, expr, f, texts=ODD):
    assert one(texts, expr) == [None if t is None else f(t) for t in texts]


def norm(t):
    return re.sub(r"\s+", " ", unicodedata.normalize("NFKC", t).lower()).strip()


def test_strip_split_lines(one):
    same(one, T.py_strip, str.strip)
    same(one, T.py_split, str.split)
    same(one, T.py_lines, str.splitlines)


def test_normalize(one):
    same(one, T.normalize, norm)
    assert one(["ﬁ①"], T.normalize) == ["fi1"]


def test_shingles(one):
    texts = ["", "a", "a b c d e", "a b c d e f", "a b c d e f a b c d e f"]
    got = one(texts, T.word_shingles)
    assert [sorted(g) for g in got] == [[""], ["a"], ["a b c d e"], ["a b c d e", "b c d e f"], sorted({"a b c d e", "b c d e f", "c d e f a", "d e f a b", "e f a b c", "f a b c d"})]


def test_nfkc_gate_lets_through_only_what_stays():
    """A character that is not sent to Python is its own form, also behind a letter."""
    import sys

    gate = re.compile(T.NFKC_SENSITIVE)
    for c in map(chr, range(sys.maxunicode + 1)):
        if not gate.search(c) and not 0xD800 <= ord(c) < 0xE000:
            assert unicodedata.normalize("NFKC", c) == c and unicodedata.normalize("NFKC", "a" + c) == "a" + c, hex(ord(c))


def test_wiki_to_text(one):
    page = "\'\'\'A\'\'\' is [[b|a \'\'b\'\']] of [[c]].{{x|{{y}}|z}}<ref name=q>r</ref><ref n/>\n== H ==\n* one\n{| t\n|-\n| c\n|}\n[[File:x.png|thumb|of [[d]]]]\n[http://e.org label] [http://e.org]<!-- no -->&nbsp;end\n[[Category:x]]"
    assert one([page, "", None, "{{" * 50_000], T.wiki_to_text) == ["A is a b of c.\nH\none\n\nlabel  end", "", None, "{{" * 50_000]


def test_page_numbers(one):
    lines = ["12", "iv", "civil", "Mix", "D", "", "3 4"]
    assert one(lines, T.is_page_number) == [True, True, True, False, False, False, False]


def test_clean_pdf(one):
    assert one(["a\n\n5\n\nb", "a \t b\n\n\n\nz", "xii\nMix\ncivil\n"], T.clean_pdf_text) == ["a\n\n\nb", "a b\n\nz", "Mix"]


#: Texts and what plain text makes of them, worked out by hand.
MARKDOWN = [
    ("", ""),
    ("* item one\n* item two", "item one\n item two"),
    ("snake_case_name", "snakecasename"),
    ("[x](y(z))", "x)"),
    ("a\r---\rb", "a\r---\rb"),
    ("a --- b", "a --- b"),
    ("```\ncode\n```\nend", "end"),
    ("~~~\nz\n~~~\nend", "end"),
    ("# T\n\ntext **b** `c` ![i](u) <b>x</b>", "T\n\ntext b   x"),
    ("Title\n===\nbody\n---\n", "Title\n\nbody"),
    ("> quoted\n>no blank", "quoted\nno blank"),
    (".. note:: n", "n"),
    ("a\n***\nb", "a\n\nb"),
    ("***\na *b*", "**\na b*"),  # the third star closes with the fourth, so no line of stars is left
    ("a\n\n\n\nb", "a\n\nb"),
    ("**a __b__ c** and ***d***", "a b c and d"),
    ("##no heading", "##no heading"),
    ("<script>left</script>", "left"),
    ("*" + "x" * 50_000 + "*", "x" * 50_000),
]


def test_markdown(one):
    assert one([t for t, _ in MARKDOWN], T.markdown_to_text) == [t for _, t in MARKDOWN]


def test_first_paragraph(one):
    assert one(["a" * 79 + "\n\n" + " " + "b" * 80 + " ", "a" * 79, "", None], T.first_paragraph) == ["b" * 80, None, None, None]


def test_truncate(one):
    texts = ["x" * 20, "x" * 10 + "." + "y" * 20, "x" * 9 + "." + "y" * 20, "a.b!c?" * 9, "x" * 40, "", "x" * 19 + "!y", "aa. bb! cc? dd eeeeee", None]
    want = ["x" * 20, "x" * 10 + "." + "y" * 9, "x" * 9 + "." + "y" * 10, "a.b!c?a.b!c?a.b!c?a.", "x" * 20, "", "x" * 19 + "!", "aa. bb! cc? dd eeeee", None]
    # of twenty places, counted from 0, a stop is taken from place 11 on
    assert one(texts, lambda c: T.truncate_at_sentence(c, 20)) == want
    assert one(["x" * 11 + "." + "y" * 20], lambda c: T.truncate_at_sentence(c, 20)) == ["x" * 11 + "."]


def test_fill_is_literal(one):
    assert one(["{x} $1 \\2"], lambda c: T.fill(F.lit("[{title}]"), title=c)) == ["[{x} $1 \\2]"]


def test_stems(one):
    paths = ["a/b.c/x_y-z.pdf", "x.tar.gz", ".hidden", "noext"]
    assert one(paths, T.file_stem) == ["x_y-z", "x.tar", ".hidden", "noext"]
    assert one(["x_y-z"], T.stem_to_title) == ["x y z"]


def test_names():
    assert T.check_lang("de") == "de"
    for bad in ("DE", "d", "de\n", "toolong"):
        try:
            T.check_lang(bad)
            raise AssertionError
        except ValueError:
            pass
    assert T.dump_urls("de")["dump"].endswith("/dewiki/latest/dewiki-latest-pages-articles.xml.bz2")
